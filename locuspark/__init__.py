"""locuspark: Spark-native operators for statistical-genomics analyses.

Every public operator takes DataFrames and returns a DataFrame; the heavy
work runs on executors as joins, aggregates, windows and Arrow batches.
"""

from locuspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
