"""DataFrame-to-DataFrame operators: no I/O, safe in batch and inside a micro-batch."""
