"""millrace: incremental warehouse loading as PySpark DataFrame operators."""

from millrace.session import configure, shared_dir, stage

__all__ = ["configure", "shared_dir", "stage"]
