"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition yields one sorted run of (digest, best id, count), at
most one entry per digest.  Runs then meet in binomial rounds: round ``r``
joins the ``fan_in`` runs whose numbers agree above the low ``r * log2(fan_in)``
bits, by an exchange on (run group, digest prefix), a sort-merge inside each
partition, and a streaming pass that folds neighbours with the same digest into
one entry.  The last round has a single run, spread over the cluster by digest
prefix.  The result travels back down the same tree: to the runs, then to the
rows of each run.  A text held by a third of all rows costs one entry per run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import ascii_lower, no_null, numbered

FAN_IN = 16
KEY = ["digest", "n_bytes", "check"]  # the digest, verified by length and a second, independent hash
RUN_SCHEMA = "run long, digest string, n_bytes long, check long, best_id long, best_rid long, n long"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold neighbouring rows of one (run, key) into the first of them, adding up ``n``.

    Input is sorted by run, key and then best identifier, so the first row of
    each stretch is the one to keep.  Only the open stretch crosses batches.
    Columns stay Arrow columns, so a null id leaves the others exact.
    """
    carry = None
    for batch in batches:
        if carry is not None:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        new = np.ones(batch.num_rows, dtype=bool)
        for c in ("run", *KEY):
            column = batch.column(c)
            new[1:] &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = ~new[1:]
        first = np.flatnonzero(new)
        total = np.add.reduceat(batch.column("n").to_numpy(), first)
        out = batch.take(pa.array(first))
        at = out.schema.get_field_index("n")
        out = out.set_column(at, out.schema.field(at), pa.array(total))  # the field as it came: the next batch has it, nullable or not
        carry = out.slice(len(first) - 1)
        yield out.slice(0, len(first) - 1)
    if carry is not None:
        yield carry


def _merge(entries: DataFrame) -> DataFrame:
    best = [F.col("best_id").asc_nulls_last(), F.col("best_rid")]
    return entries.select(*RUN_COLUMNS).sortWithinPartitions("run", *KEY, *best).mapInArrow(_fold, RUN_SCHEMA)


RUN_COLUMNS = [part.split()[0] for part in RUN_SCHEMA.split(", ")]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z (null counts as
    empty); equality of digests is verified by byte length and a second hash,
    and entries that differ there stay apart.  ``keep`` says whether the
    smallest ("min") or the largest ("max") id of a group stays.  Null ids lose
    against any other; between rows with the same id one fixed row stays.
    Extra columns are ignored.  An empty table gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    rank = (lambda c: c) if keep == "min" else F.bitwise_not  # ~x falls as x grows, over all 64-bit integers
    norm = docs.select(F.col(id_col).cast("long").alias("id"), ascii_lower(no_null(F.col(text_col))).alias("t"))
    rows = numbered(norm.select("id", F.sha2("t", 256).alias("digest"),
                                F.octet_length("t").cast("long").alias("n_bytes"), F.xxhash64("t").alias("check")))
    leaves = _merge(rows.select("run", *KEY, rank(F.col("id")).alias("best_id"), F.col("rid").alias("best_rid"),
                                F.lit(1).cast("long").alias("n")))
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    root = leaves
    while runs > 1:
        root = _merge(root.withColumn("run", F.expr(f"run div {fan_in}"))
                      .repartition(F.col("run"), F.substring("digest", 1, 4)))
        runs = -(-runs // fan_in)
    root = root.select(*KEY, rank(F.col("best_id")).alias("keep_id"), F.col("best_rid").alias("keep_rid"),
                       F.col("n").alias("group_size"))
    down = leaves.select("run", *KEY).join(root, KEY)
    return rows.join(down, ["run", *KEY]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("digest").alias("text_sha256"))
