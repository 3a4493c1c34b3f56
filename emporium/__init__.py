"""Spark-native marketplace analytics.

Every operator takes and returns DataFrames and is built from built-in
Spark SQL expressions, so the work runs on the executors and Catalyst can
push filters and prune columns down to the Parquet scans.
"""

from emporium.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
