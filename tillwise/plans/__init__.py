"""Reusable plan fragments: lean facts, dimension lookups, calendar spines, global ordering."""
