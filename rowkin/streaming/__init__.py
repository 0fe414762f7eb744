"""Matching of micro-batches against a growing master table."""
