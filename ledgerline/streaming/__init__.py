"""Structured Streaming: CDC extraction per micro-batch and plain incremental append."""

from ledgerline.streaming.cdc_stream import read_change_log, start_append, start_extraction

__all__ = ["read_change_log", "start_append", "start_extraction"]
