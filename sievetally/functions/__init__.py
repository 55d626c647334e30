"""Column functions: built-in expressions only, no Python runs per row."""
