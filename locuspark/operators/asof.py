"""As-of lookups and global running sums without a single-partition window.

A right table below a checked size is sent, sorted, to the tasks that have the left rows: binary search,
no shuffle, the left table read once.  Larger ones meet the left rows in one range exchange on (group, key,
side, row number), so that neither a repeated key nor a large group has to stay in one task; each task
sorts its range and runs through it once, and the few rows that come before any right row of their
range take the last right row of the ranges before.  Left rows with a null key take no part in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from locuspark.functions.buckets import BUCKETS, bucket_of, cut_points
from locuspark.session import cut_lineage

SENT_ROWS, SENT_BYTES = 500_000, 64 << 20  # largest right table that is sent to the tasks


def _search(sent, by: list[str], key: str, vals: list[str], backward: bool, inclusive: bool):
    """Left batches -> the same with the values of the sorted right table's nearest row."""
    side = "right" if inclusive == backward else "left"
    spans: dict[tuple, tuple[int, int]] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for i, group in enumerate(zip(*(table.column(f"_by_{b}").to_pylist() for b in by)) if by else ()):
            spans[group] = (spans.get(group, (i, i))[0], i + 1)
        keys = table.column("_k").to_numpy()
        for batch in batches:
            own = batch.column("_k")
            at = np.full(batch.num_rows, -1, np.int64)
            usable = own.is_valid().to_numpy(zero_copy_only=False)
            if len(keys) and usable.any():
                wanted = own.fill_null(table.column("_k")[0]).to_numpy(zero_copy_only=False)
                if by:
                    rows: dict[tuple, list[int]] = {}
                    for i, group in enumerate(zip(*(batch.column(b).to_pylist() for b in by))):
                        rows.setdefault(group, []).append(i)
                    parts = [(np.array(r), *spans[g]) for g, r in rows.items() if g in spans]
                else:
                    parts = [(np.arange(batch.num_rows), 0, len(keys))]
                for row, lo, hi in parts:
                    found = lo + np.searchsorted(keys[lo:hi], wanted[row], side) - (1 if backward else 0)
                    at[row] = np.where((found >= lo) & (found < hi) & usable[row], found, -1)
            take = pa.array(at, mask=at < 0)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            for v in vals:
                got = table.column(f"_v_{v}").take(take)
                columns.append(got.combine_chunks() if isinstance(got, pa.ChunkedArray) else got)
            yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                                             [*batch.schema.names[:-1], *vals])
    return run


def _same(column, before) -> np.ndarray:
    """Whether values equal those before, nulls being equal to each other."""
    equal = pc.fill_null(pc.equal(column, before), False)
    return pc.or_(equal, pc.and_(column.is_null(), before.is_null())).to_numpy(zero_copy_only=False)


def _merge(groups: list[str], names: list[str], vals: list[str]):
    """A sorted range -> its left rows with the last right row before them in their group, and one row for what the range ends with.

    ``_open`` marks left rows before the first right row of the range's first group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen, after the last right row of its group if there is one: at most two rows
        first_group, seen_right = True, False
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            skip = held.num_rows if held is not None else 0
            t = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = t.num_rows
            new = np.zeros(n, bool)
            for g in groups:
                c = t.column(g)
                new[1:] |= ~_same(c[1:], c[:-1])
            new[0] = True
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            right = t.column("_right").to_numpy(zero_copy_only=False)
            last = np.maximum.accumulate(np.where(right, np.arange(n), -1))
            last = np.where(last >= start, last, -1)
            lead = (start == 0) & first_group
            out = np.flatnonzero(~right & (np.arange(n) >= skip))
            take = pa.array(last[out], mask=last[out] < 0)
            rows = t.take(pa.array(out))
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in (*groups, *names)] + [t.column(f"_v_{v}").take(take) for v in vals]
                + [pa.array(lead[out] & (last[out] < 0)), pa.array(np.zeros(len(out), bool))],
                [*groups, *names, *(f"_v_{v}" for v in vals), "_open", "_end"])
            first_group = first_group and not new[1:].any()
            seen_right = bool(right[start[-1]:].any())
            keep = [int(last[-1])] if last[-1] >= 0 else []
            held = t.take(pa.array([*keep, *([n - 1] if n - 1 not in keep else [])]))
        if held is not None and seen_right:
            end = held.slice(0, 1)
            yield pa.RecordBatch.from_arrays(
                [end.column(g) for g in groups] + [pa.nulls(1, schema.field(c).type) for c in names]
                + [end.column(f"_v_{v}") for v in vals] + [pa.array([False]), pa.array([True])],
                [*groups, *names, *(f"_v_{v}" for v in vals), "_open", "_end"])
    return run


def _by_ranges(left: DataFrame, right: DataFrame, by: list[str], vals: list[str], backward: bool, r_first: bool,
               ranges: int | None) -> DataFrame:
    """``left`` with ``_k``, ``right`` with ``_by_*, _k, _v_*``: one range exchange and one pass."""
    names = [c for c in left.columns if c != "_k"]
    groups = [f"_by_{b}" for b in by]
    kind = left.schema
    none = lambda field: F.lit(None).cast(field.dataType).alias(field.name)
    both = left.select(*[F.col(b).alias(f"_by_{b}") for b in by], "_k", *names, F.lit(False).alias("_right"),
                       *[F.lit(None).cast(right.schema[f"_v_{v}"].dataType).alias(f"_v_{v}") for v in vals])
    both = both.unionByName(right.where("_k IS NOT NULL").select(
        *groups, "_k", *[none(kind[c]) for c in names], F.lit(True).alias("_right"), *[f"_v_{v}" for v in vals]))
    both = cut_lineage(both.withColumn("_n", F.monotonically_increasing_id()))  # inputs are read once; the exchange samples this
    way = (lambda c: F.col(c).asc()) if backward else (lambda c: F.col(c).desc())
    side = F.col("_right").desc() if r_first else F.col("_right").asc()
    order = [*[way(g) for g in groups], way("_k"), side, F.col("_n").asc()]
    n = ranges or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = both.where("_k IS NOT NULL").repartitionByRange(n, *order).sortWithinPartitions(*order)
    fields = [both.schema[c] for c in (*groups, *names, *(f"_v_{v}" for v in vals))]
    schema = StructType([*[StructField(f.name, f.dataType) for f in fields],
                         StructField("_open", BooleanType()), StructField("_end", BooleanType())])
    found = cut_lineage(known.select(*groups, *names, "_right", *[f"_v_{v}" for v in vals]).mapInArrow(
        _merge(groups, names, vals), schema).withColumn("_p", F.spark_partition_id()))
    state = F.struct(*groups, *[f"_v_{v}" for v in vals])
    ends = found.where("_end").select("_p", state.alias("_s"))  # one row a range
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges_df = left.sparkSession.range(n).select(F.col("id").cast("int").alias("_p")).join(ends, "_p", "left")
    carried = ranges_df.select("_p", F.last("_s", ignorenulls=True).over(before).alias("_c"))
    rows = found.where("NOT _end").join(F.broadcast(carried), "_p")
    fits = F.col("_open") & F.col("_c").isNotNull()
    for g in groups:
        fits = fits & F.col(g).eqNullSafe(F.col(f"_c.{g}"))
    rows = rows.select(*names, *[F.when(fits, F.col(f"_c._v_{v}")).otherwise(F.col(f"_v_{v}")).alias(v) for v in vals])
    return rows.unionByName(both.where("_k IS NULL").select(*names, *[F.col(f"_v_{v}").alias(v) for v in vals]))


def asof_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              value_cols: Sequence[str], by: Sequence[str] = (), direction: str = "backward",
              inclusive: bool = True, buckets: int | None = None) -> DataFrame:
    """For each left row, ``value_cols`` of the nearest right row.

    backward: latest right row with key <= (or <) the left key;
    forward: earliest right row with key >= (or >) the left key.
    Left rows without a match, and those with a null key, get NULLs.  Right
    keys must not repeat within a ``by`` group; right rows with a null key match
    nothing; null groups match each other.  Keys of one type are compared as they are, others as doubles.
    ``buckets`` asks for the range exchange, with so many ranges, whatever the right table's size.
    """
    by, vals = list(by), list(value_cols)
    backward = direction == "backward"
    kinds = {left.schema[left_key].dataType, right.schema[right_key].dataType}
    kind = kinds.pop() if len(kinds) == 1 else "double"
    rows = left.select("*", F.col(left_key).cast(kind).alias("_k"))
    slim = right.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col(right_key).cast(kind).alias("_k"),
                        *[F.col(v).alias(f"_v_{v}") for v in vals]).where("_k IS NOT NULL")
    if buckets is None and slim.limit(SENT_ROWS + 1).count() <= SENT_ROWS:
        table = slim.orderBy(*[f"_by_{b}" for b in by], "_k").toArrow()
        if table.nbytes <= SENT_BYTES:
            sent = left.sparkSession.sparkContext.broadcast(table.combine_chunks())
            schema = StructType([*left.schema.fields, *[StructField(v, right.schema[v].dataType) for v in vals]])
            return rows.mapInArrow(_search(sent, by, "_k", vals, backward, inclusive), schema)
    # at equal keys the right row must be seen first iff the match is inclusive
    return _by_ranges(rows, slim, by, vals, backward, inclusive, buckets)


def asof_step(points: DataFrame, steps: DataFrame, t_col: str = "t", by: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """Value of the latest step with step.t <= t; before the first step the
    first value, after the last the last value; NULL where t is NULL.
    ``steps``: (by..., t, value).
    """
    by = list(by)
    found = asof_join(points, steps, t_col, "t", ["value"], by, "backward", True, buckets)
    firsts = steps.groupBy(*by).agg(F.min_by("value", "t").alias("_first"))  # one row per group
    if by:
        found = found.join(firsts, by, "left")
    else:
        found = found.withColumn("_first", F.lit(firsts.first()[0]))
    value = F.when(F.col(t_col).isNotNull(), F.coalesce("value", "_first"))
    return found.withColumn("value", value).drop("_first")


def next_step(points: DataFrame, steps: DataFrame, t_col: str = "t", by: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """Time of the next step strictly after t (NULL when none)."""
    s = steps.select(*by, "t", F.col("t").alias("next_t"))
    return asof_join(points, s, t_col, "t", ["next_t"], by, "forward", False, buckets)


def running_sum(df: DataFrame, order_col: str, value_col: str, out_col: str = "cum", buckets: int = BUCKETS) -> DataFrame:
    """Inclusive running sum of ``value_col`` over the whole table ordered by
    ``order_col`` (unique, numeric): a window per bucket plus the sums of the buckets before."""
    b = df.withColumn("_b", bucket_of(F.col(order_col), cut_points(df, order_col, buckets)))
    w = Window.partitionBy("_b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("_local", F.sum(value_col).over(w))
    sums = b.groupBy("_b").agg(F.sum(value_col).alias("_bt"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most ``buckets`` rows
    sums = sums.withColumn("_off", F.coalesce(F.sum("_bt").over(before), F.lit(0))).drop("_bt")
    return b.join(F.broadcast(sums), "_b").withColumn(out_col, F.col("_local") + F.col("_off")).drop(
        "_b", "_local", "_off")
