"""lagframe.streaming: incremental ingest of landed files.

The original collects data in batch; nothing in it is event-time streaming (no
watermarks or windows). What streams naturally on Spark is the arrival of landed
files, so the case-file ingest (A1) feeding the case table (A6) also runs as a
Structured Streaming job that remembers which files it has already loaded.
"""
