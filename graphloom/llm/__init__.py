"""Operators of a training-data pipeline: filters, deduplication, archives and binary output."""
