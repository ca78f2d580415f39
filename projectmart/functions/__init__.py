"""Column functions: parsing, repair, rounding, bucketing."""
