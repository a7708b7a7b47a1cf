"""The business questions, each a function of ``Tables`` and explicit parameters."""
