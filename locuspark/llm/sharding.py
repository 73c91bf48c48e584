"""Resharding by minimum-cost flow.

Old shards supply bytes, new shards take up to their capacity, and a byte costs
nothing where it already lies and one unit elsewhere (or what ``cost`` says).
The flow between shards is solved on the driver: its size is the number of
shards, whatever the data.  Documents of an old shard lie on a line of bytes,
ordered by size class and then by a hash, and the flow cuts that line into one
stretch per target.  The cuts are found with block sums (a block holds some
hundred rows), and each cut is one order key, so a document's new shard follows
from its own row and a table with one entry per cut: texts are shuffled once,
into the files of their new shard, and only those of affected shards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.llm.common import all_columns, cut_lineage, free_name, no_null, row_key, shared_path

BLOCK_ROWS = 500
BIG_SHARE = 50  # a document above capacity / BIG_SHARE is placed by itself; at most shards * BIG_SHARE of them exist
FILE_BYTES = 32 << 20
NO_SHARD = -1
ORDER = "struct<c: int, h: bigint, k: string>"


def min_cost_flow(supply: list[int], capacity: list[int], cost: np.ndarray) -> np.ndarray:
    """Cheapest flow of all ``supply`` into ``capacity`` (integers, enough room), by shortest augmenting paths."""
    if sum(supply) > sum(capacity):
        raise ValueError("capacities do not hold the supply")
    left, room = np.array(supply, np.int64), np.array(capacity, np.int64)
    flow = np.zeros((len(left), len(room)), np.int64)
    while left.any():
        # Bellman-Ford over the residual graph: source -> rows (supply left) -> columns, columns -> rows (flow back)
        rows = np.where(left > 0, 0.0, np.inf)
        cols, by_col, by_row = np.full(len(room), np.inf), np.full(len(room), -1), np.full(len(left), -1)
        while True:
            there = rows[:, None] + cost
            best = there.min(0)
            better = best < cols - 1e-9
            cols[better], by_col[better] = best[better], there.argmin(0)[better]
            back = np.where(flow > 0, cols[None, :] - cost, np.inf)
            low = back.min(1)
            nearer = low < rows - 1e-9
            rows[nearer], by_row[nearer] = low[nearer], back.argmin(1)[nearer]
            if not nearer.any():
                break
        j = int(np.where(room > 0, cols, np.inf).argmin())
        path, end, most = [], j, int(room[j])
        while True:
            i = int(by_col[j])
            path.append((i, j, 1))
            if by_row[i] < 0:
                most = min(most, int(left[i]))
                break
            j = int(by_row[i])
            path.append((i, j, -1))
            most = min(most, int(flow[i, j]))
        for a, b, sign in path:
            flow[a, b] += sign * most
        left[i] -= most
        room[end] -= most
    return flow


@dataclass
class Plan:
    """``cuts``: (old, c, h, k, shard), in order of the old shard's line; ``big``: (row_key, shard) singly placed."""

    cuts: list[tuple] = field(default_factory=list)
    big: list[tuple] = field(default_factory=list)
    affected: list[int] = field(default_factory=list)
    moved_bytes: int = 0


def _order(old: Column, id_col: str, text_col: str) -> dict[str, Column]:
    """Row key, size, old shard and place on the old shard's line: size class (largest first), then hash."""
    key = row_key(F.col(id_col), F.col(text_col))
    size = (F.octet_length(no_null(F.col(text_col))) + 1).cast("long")
    return {"k": key, "size": size, "old": F.coalesce(old.cast("int"), F.lit(NO_SHARD)),
            "c": (4096 - F.floor(F.log2(size) * 8)).cast("int"),
            "h": F.conv(F.substring(key, 1, 15), 16, 10).cast("long")}


def _big_first(slim: DataFrame, capacity: list[int]) -> tuple[list[tuple], list[int]]:
    """Place documents above a small share of a shard, largest first: at home while they fit, else where most room is."""
    limit = max(sum(capacity) // (len(capacity) * BIG_SHARE), 1)
    big = slim.where(F.col("size") > limit).groupBy("k", "old", "size").count().orderBy(F.desc("size"), "k").collect()
    room, placed = list(capacity), []
    for r in big:
        need = r["size"] * r["count"]
        home = r["old"] if 0 <= r["old"] < len(room) and room[r["old"]] >= need else None
        j = max(range(len(room)), key=lambda x: (room[x], -x)) if home is None else home
        room[j] -= need
        placed.append((r["k"], j, r["old"], need))
    return placed, room


def plan_reshard(docs: DataFrame, old: Column, n_new: int, id_col: str = "doc_id", text_col: str = "text",
                 cost: np.ndarray | None = None, block_rows: int = BLOCK_ROWS) -> Plan:
    """Solve the transfers from the old shards to ``n_new`` shards of equal capacity.

    ``old`` gives the old shard number of a row; null means that it lies in no
    shard.  ``cost[i, j]`` is the price of moving a byte from old shard i to new
    shard j; without it a byte that stays is free and any other costs 1.
    """
    slim = cut_lineage(docs.select(*[e.alias(n) for n, e in _order(old, id_col, text_col).items()]))
    sizes = {r["old"]: r["bytes"] for r in slim.groupBy("old").agg(F.sum("size").alias("bytes")).collect()}
    total = sum(sizes.values())
    capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    plan = Plan()
    if not total:
        return plan
    big, room = _big_first(slim, capacity)
    plan.big = [(k, j) for k, j, _, _ in big]
    olds = sorted(sizes)
    supply = [sizes[i] - sum(need for _, _, o, need in big if o == i) for i in olds]
    free = [max(r, 0) for r in room]
    if sum(free) < sum(supply):  # a single document above a whole capacity leaves the rest short of room
        free[free.index(min(free))] += sum(supply) - sum(free)
    price = np.array([[(0.0 if i == j else 1.0) if cost is None or i < 0 else float(cost[i, j])
                       for j in range(n_new)] for i in olds])
    flow = min_cost_flow(supply, free, price)
    stay = {i: int(flow[x, i]) if 0 <= i < n_new else 0 for x, i in enumerate(olds)}
    kept_big = {i: sum(need for _, j, o, need in big if o == i == j) for i in olds}
    plan.moved_bytes = sum(sizes[i] - stay[i] - kept_big[i] for i in olds)
    whole = {i for i in olds if stay[i] + kept_big[i] == sizes[i] and 0 <= i < n_new
             and flow[:, i].sum() + sum(need for _, j, _, need in big if j == i) == sizes[i]}
    plan.affected = sorted(set(range(n_new)) - whole)
    bounds = []
    for x, i in enumerate(olds):  # own shard first, then the others by number
        at, targets = 0, sorted(np.flatnonzero(flow[x]).tolist(), key=lambda j: (j != i, j))
        if targets:
            plan.cuts.append((i, 0, 0, "", targets[0]))
        for a, b in zip(targets, targets[1:]):
            at += int(flow[x, a])
            bounds.append((i, at, b))
    plan.cuts += _find_cuts(slim, plan.big, bounds, block_rows)
    plan.cuts.sort()
    return plan


def _find_cuts(slim: DataFrame, big: list[tuple], bounds: list[tuple], block_rows: int) -> list[tuple]:
    """The order key of the first row whose middle lies beyond each bound (old, bytes, next shard)."""
    spark = slim.sparkSession
    if not bounds:
        return []
    if big:
        alone = spark.createDataFrame([(k,) for k, _ in big], "k string")
        slim = slim.join(F.broadcast(alone), "k", "left_anti")
    classes = slim.groupBy("old", "c").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("subs"))  # shards x classes
    rows = slim.join(F.broadcast(classes), ["old", "c"]).withColumn(
        "sub", F.expr("shiftright(shiftright(h, 30) * subs, 30)"))
    line = Window.partitionBy("old").orderBy("c", "sub")
    blocks = rows.groupBy("old", "c", "sub").agg(F.sum("size").alias("bytes"))
    blocks = blocks.withColumn("end", F.sum("bytes").over(line)).withColumn("begin", F.col("end") - F.col("bytes"))
    asked = F.broadcast(spark.createDataFrame(bounds, "old int, at long, shard int"))
    hit = blocks.join(asked, "old").where("begin <= at and at < end").select("old", "c", "sub", "begin", "at", "shard")
    inner = Window.partitionBy("old", "at", "shard").orderBy("c", "h", "k")
    near = rows.join(F.broadcast(hit), ["old", "c", "sub"]).withColumn(
        "middle", F.col("begin") + F.sum("size").over(inner) - F.col("size") / 2)
    key = F.struct("c", "h", "k")
    found = near.groupBy("old", "at", "shard").agg(
        F.min(F.when(F.col("middle") >= F.col("at"), key)).alias("first"), F.max(key).alias("last")).collect()
    return [(r["old"], *(r["first"] or (r["last"]["c"], r["last"]["h"], r["last"]["k"] + "~")), r["shard"])
            for r in found]


def place(docs: DataFrame, plan: Plan, old: Column, out: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Add the new shard number ``out`` to every row; no shuffle, the plan is broadcast (a few entries per shard)."""
    spark = docs.sparkSession
    lines: dict[int, list] = {}
    for o, c, h, k, shard in plan.cuts:
        lines.setdefault(o, []).append(((c, h, k), shard))
    cuts = spark.createDataFrame(list(lines.items()), f"_o int, _cuts array<struct<at: {ORDER}, shard: int>>")
    big = spark.createDataFrame(plan.big, "_k string, _big int")
    rows = docs.select(F.struct(*all_columns(docs)).alias("row"),
                       *[e.alias(n) for n, e in _order(old, id_col, text_col).items()])
    rows = rows.join(F.broadcast(cuts), F.col("old") == F.col("_o"), "left").join(
        F.broadcast(big), F.col("k") == F.col("_k"), "left")
    passed = F.filter("_cuts", lambda x: x["at"] <= F.struct("c", "h", "k"))
    shard = F.coalesce("_big", F.element_at(passed, -1)["shard"], F.lit(0))
    return rows.select("row", shard.alias("to")).select("row.*", F.col("to").alias(out))


def reshard(docs: DataFrame, old: Column, n_new: int, path: str | None = None, id_col: str = "doc_id",
            text_col: str = "text", cost: np.ndarray | None = None, file_bytes: int = FILE_BYTES,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Move ``docs`` from their old shards into ``n_new`` shards of nearly equal bytes; returns the new shards' rows.

    All columns stay; the shard number is added as ``shard`` (with leading
    underscores where that name is taken).  The files of affected shards are
    rewritten below ``path`` (default: a new shared folder), by shard; rows of
    shards that neither lose nor gain anything are not rewritten and come from
    ``docs``.  A text counts its UTF-8 bytes plus 1, null as none.  Shard sizes
    differ by the rounding of a few cuts, each at most half a document that is
    no larger than 1/50 of a shard.  Rows with equal id and text go to the same
    shard.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "shards")
    plan = plan_reshard(docs, old, n_new, id_col, text_col, cost, block_rows)
    name = free_name(docs, "shard")
    placed = place(docs, plan, old, name, id_col, text_col)
    if not plan.affected:
        return placed
    moved, file = placed.where(F.col(name).isin(plan.affected)), free_name(placed, "_file")
    files = max(_files(docs, text_col, n_new, file_bytes), 1)
    dealt = F.pmod(F.xxhash64(row_key(F.col(id_col), F.col(text_col))), F.lit(files))
    moved.withColumn(file, dealt).repartition(F.col(name), F.col(file)).drop(file).write.mode("overwrite").partitionBy(
        name).parquet(path)
    rewritten = spark.read.schema(placed.schema).parquet(path).select(all_columns(placed))
    if len(plan.affected) == n_new:
        return rewritten
    return rewritten.union(placed.where(~F.col(name).isin(plan.affected)))


def _files(docs: DataFrame, text_col: str, n_new: int, file_bytes: int) -> int:
    """Files per shard for files of about ``file_bytes``."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return -(-total // (file_bytes * n_new))


def with_slots(rows: DataFrame, shard: str = "shard", id_col: str = "doc_id", block_rows: int = BLOCK_ROWS,
               out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in the order of a hash of the id.

    Rows fall into blocks of some hundred by hash; a block is numbered by a
    window, and the blocks before it are added from a table of block counts.
    """
    packed = rows.select(F.struct(*all_columns(rows)).alias("row"), F.col(shard).alias("to"), F.col(id_col).alias("id"))
    counts = {r[0]: r[1] for r in packed.groupBy("to").count().collect()}  # one number per shard
    blocks = [F.lit(x) for s, n in counts.items() for x in (s, -(-n // block_rows))]
    subs = F.element_at(F.create_map(*blocks), F.col("to")) if blocks else F.lit(1)
    keyed = packed.withColumn("h", F.xxhash64("id")).withColumn("sub", F.pmod(F.col("h"), subs.cast("long")))
    before = keyed.groupBy("to", "sub").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("to").orderBy("sub")) - F.col("n")).drop("n")
    inside = F.row_number().over(Window.partitionBy("to", "sub").orderBy("h", "id"))
    at = keyed.withColumn("at", inside).join(before, ["to", "sub"])
    return at.select("row", (F.col("before") + F.col("at") - 1).cast("long").alias("slot")).select(
        "row.*", F.col("slot").alias(out))
