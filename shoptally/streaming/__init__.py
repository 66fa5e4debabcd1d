"""Incremental versions of batch aggregates."""
