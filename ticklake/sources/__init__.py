"""Data sources and catalog: test-data adapter, the partitioned lake, namespaces and views."""
