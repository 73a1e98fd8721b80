"""Reading, writing and the logical tables."""
