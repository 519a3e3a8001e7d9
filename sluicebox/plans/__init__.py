"""Whole runs: clean a table, transform it, and do so for every file of a directory."""
