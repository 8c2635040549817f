"""Reading raw files, the test feeds, and tables kept as snapshot plus change feed."""
