"""Readers and writers for documents, spend snapshots and partitioned tables."""
