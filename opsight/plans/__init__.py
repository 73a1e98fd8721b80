"""The operators applied to the logical tables, each with its checking SQL."""
