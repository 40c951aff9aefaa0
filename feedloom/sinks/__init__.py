"""Writers: files, keyed append, compaction."""
