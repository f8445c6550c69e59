"""Row-level and aggregate transforms: ingest, staging, marts, windows, serving, quality."""
