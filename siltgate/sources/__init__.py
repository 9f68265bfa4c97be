"""Raw readers and versioned tables."""
