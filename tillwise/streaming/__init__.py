"""Event windows over arriving files."""
