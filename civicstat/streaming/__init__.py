"""Structured Streaming runs of the batch operators (see incremental.py)."""

from civicstat.streaming.incremental import long_table_stream, running_coverage, validate_batches
