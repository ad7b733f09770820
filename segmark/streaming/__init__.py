"""Streaming: incremental load of raw order files."""
