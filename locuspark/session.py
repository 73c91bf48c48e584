"""Session helpers.

The library never creates its own cluster configuration beyond what a test
needs: on a real cluster the session (and its ``spark.checkpoint.dir``) is
supplied by the caller.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "locuspark") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LOCUSPARK_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session (the shared folder the
    cluster names).  Only where it is unset on a local master, as in tests, a
    scratch folder is created; a cluster without the setting is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="locuspark-ckpt-")  # one machine: tests and trials
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df):
    """The rows as a Parquet table in the checkpoint folder, read again.

    For loops of joins: a checkpoint keeps the estimated size of its plan, which a join multiplies, so after
    some rounds the estimates alone take minutes; a table has its real size.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, *cols):
    """Deal rows anew before per-row heavy work (Python batches, md5 draws, codon scans).

    By ``cols``, the keys that the next grouping needs, or evenly; the number of
    partitions is the session's ``spark.sql.shuffle.partitions``.
    """
    if cols:
        return df.repartition(*cols)
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


ROWS_A_TASK, FEW_ROWS = 1 << 18, 1 << 14


def by_size(df, rows, *cols):
    """Deal ``rows`` rows by the keys ``cols`` to tasks of some ``ROWS_A_TASK`` rows.

    To as many tasks as the session has partitions at least, where each gets ``FEW_ROWS``.  Partitions that Spark sizes
    itself are merged up to 64 MB of shuffled bytes, which for rows that compress well are gigabytes of memory in the
    sorts and hash tables of one task.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, -(-rows // ROWS_A_TASK), min(least, -(-rows // FEW_ROWS))), *cols)
