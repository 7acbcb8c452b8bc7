"""postlens: postings analytics expressed as Spark DataFrame / SQL / ML / Structured Streaming jobs.

Every public operator takes and returns DataFrames (or Columns); nothing is collected to the driver except
final, bounded results (top-k reports, one-row metrics).
"""

from postlens.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
