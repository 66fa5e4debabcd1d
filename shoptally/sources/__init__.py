"""Schemas, readers, writers and the mapping from the test tables to the retail model."""
