"""Writers.  All are partitioned by wiki and language."""
