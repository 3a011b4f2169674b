"""A PySpark engine that links noisy name lists to known rosters and makes the result searchable."""
