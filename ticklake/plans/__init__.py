"""Jobs and plans: refresh (full/incremental), snapshots, compaction, CLI jobs and the query registry."""
