"""Column builders: exact percentages, null handling, row checks."""
