"""Stand-in inputs derived from the test tables, and whole chains."""
