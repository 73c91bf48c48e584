"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.session import checkpoint_dir, cut_lineage  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ID_SHIFT = 33  # monotonically_increasing_id(): partition number above, row number below


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def no_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def row_key(id_col: Column, text_col: Column) -> Column:
    """Content key of a row: md5 of id and text, null and empty text told apart.

    It does not depend on the partitioning, so a second scan of the same table
    gives the same keys.  Rows with equal id and equal text share a key.
    """
    return F.md5(F.concat_ws("\x1f", no_null(id_col.cast("string")),
                             F.when(text_col.isNull(), "0").otherwise("1"), no_null(text_col)))


def all_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def numbered(df: DataFrame) -> DataFrame:
    """Materialise ``df`` (reliable checkpoint) with a row number ``rid`` and its partition ``run``.

    Both are fixed once written: a lost executor rereads them and does not
    draw them again.
    """
    out = cut_lineage(df.withColumn("rid", F.monotonically_increasing_id()))
    return out.withColumn("run", F.shiftright("rid", ID_SHIFT))


def attach(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Join ``values`` (one row per key, keys not null) to ``rows`` without a hot key.

    ``rows`` has a ``run`` column (see :func:`numbered`).  The distinct
    (run, key) pairs meet ``values`` first, so a key meets at most one row per
    run; the rows then join on (run, key), at most one input partition's share.
    """
    pairs = rows.select("run", *keys).distinct()
    return rows.join(pairs.join(values, keys), ["run", *keys])
