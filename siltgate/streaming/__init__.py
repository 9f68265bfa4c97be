"""The same gate over micro-batches."""
