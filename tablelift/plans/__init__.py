"""Whole runs made of operators: staged paths, pre-flight checks, clean-up, validation."""
