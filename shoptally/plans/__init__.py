"""Named queries, their SQL cross-checks, and the batch pipeline."""
