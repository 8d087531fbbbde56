"""Batch tables, streams and generated workloads."""
