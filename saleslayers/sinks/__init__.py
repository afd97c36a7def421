"""Writers: appends, rewritten versions, rewritten partitions, the ingest audit."""
