"""Results in batches."""
