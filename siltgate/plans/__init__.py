"""Size checks, skew-safe joins and the end-to-end composition."""
