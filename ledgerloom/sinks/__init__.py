"""Writers: snapshots, partition refresh, insert-if-absent, versions, catalog and manifest."""
