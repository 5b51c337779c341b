"""Incremental loading: stored high-water marks for batch loads, and a
file-stream ingest that processes each new file exactly once."""
