"""Usage analytics on Spark: type, classify and rank computer-usage messages."""
