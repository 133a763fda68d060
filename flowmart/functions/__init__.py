"""Column functions: classification, rounding, event text and exact sums."""
