"""logtide: a PySpark engine for sharded, append-only record streams."""
