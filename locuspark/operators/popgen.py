"""Population-genetics table operators: diversity, trees, weighted draws."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.functions.rng import hash60
from locuspark.operators.intervals import interval_overlap_pairs
from locuspark.operators.merge_tree import suffix_sums
from locuspark.session import by_size, cut_lineage, saved


def harmonic(n: Column) -> Column:
    """a1 = sum_{i=1}^{n-1} 1/i; 0 when n < 2 (guards ``sequence`` counting down)."""
    return F.when(n >= 2, F.aggregate(F.sequence(F.lit(1), n.cast("int") - 1), F.lit(0.0),
                                      lambda acc, i: acc + F.lit(1.0) / i)).otherwise(F.lit(0.0))


def allele_counts(haps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Derived-allele count k per (by..., site) from (by..., hap, site, allele)."""
    by = list(by)
    return (haps.where(F.col("allele") == 1).select(*by, "hap", "site").distinct()
            .groupBy(*by, "site").agg(F.count(F.lit(1)).alias("k")))


def allele_freq(haps: DataFrame, by: Sequence[str], n_haps) -> DataFrame:
    """Derived-allele frequency k/N per (by..., site)."""
    n = n_haps if isinstance(n_haps, Column) else F.lit(int(n_haps))
    return allele_counts(haps, by).select(*by, "site", "k", (F.col("k") / n.cast("double")).alias("freq"))


def diversity(haps: DataFrame, by: Sequence[str], n_haps, seq_len: int,
              group_sizes: DataFrame | None = None) -> DataFrame:
    """Segregating sites S, nucleotide diversity pi and Watterson theta.

    ``n_haps`` is an int, or the name of a column of ``group_sizes`` (by...,
    n) giving N per group.  Sites absent from ``haps`` carry no derived
    allele.  N < 2 gives 0, 0, 0.
    """
    by = list(by)
    k = allele_counts(haps, by)
    if group_sizes is not None:
        k = k.join(group_sizes.select(*by, F.col(n_haps).alias("_n")), by)
        n = F.col("_n")
    else:
        k = k.withColumn("_n", F.lit(int(n_haps)))
        n = F.col("_n")
    kd = F.col("k").cast("double")
    nd = n.cast("double")
    per = k.select(*by, "_n",
                   ((F.col("k") > 0) & (F.col("k") < n)).cast("int").alias("seg"),
                   F.when(n >= 2, F.lit(2.0) * kd * (nd - kd) / (nd * (nd - 1.0))).otherwise(0.0).alias("pi_site"))
    agg = per.groupBy(*by).agg(F.sum("seg").alias("S"), F.sum("pi_site").alias("pi_sum"), F.max("_n").alias("_n"))
    if group_sizes is not None:
        agg = group_sizes.select(*by, F.col(n_haps).alias("_n0")).join(agg, by, "left") \
            .withColumn("_n", F.coalesce("_n", "_n0")).drop("_n0")
    a1 = harmonic(F.col("_n"))
    small = F.col("_n") < 2
    S = F.when(small, 0).otherwise(F.coalesce("S", F.lit(0))).cast("bigint")
    return agg.select(
        *by, S.alias("segregating_sites"),
        F.when(small, 0.0).otherwise(F.coalesce("pi_sum", F.lit(0.0)) / float(seq_len)).alias("pi"),
        F.when(small | (a1 <= 0), 0.0).otherwise(S / a1 / float(seq_len)).alias("theta_w"),
    )


# ---------------------------------------------------------------- trees

def branch_lengths(nodes: DataFrame) -> DataFrame:
    """Edge child -> parent with length max(parent.time - child.time, 0)."""
    p = nodes.select("tree_id", F.col("node").alias("parent"), F.col("time").alias("p_time"))
    j = nodes.select("tree_id", "node", "parent", "time").join(p, ["tree_id", "parent"])
    return j.select("tree_id", "node", "parent",
                    F.greatest(F.col("p_time") - F.col("time"), F.lit(0.0)).alias("branch_length"))


def tree_metrics(nodes: DataFrame) -> DataFrame:
    """Total tree length and time to the MRCA (root time) per tree."""
    bl = branch_lengths(nodes).groupBy("tree_id").agg(F.sum("branch_length").alias("total_tree_length"))
    root = nodes.where(F.col("parent").isNull()).groupBy("tree_id").agg(F.max("time").alias("time_to_mrca"))
    leaves = leaf_nodes(nodes).groupBy("tree_id").agg(F.count(F.lit(1)).alias("n_leaves"))
    return (root.join(bl, "tree_id", "left").join(leaves, "tree_id", "left")
            .select("tree_id", F.coalesce("total_tree_length", F.lit(0.0)).alias("total_tree_length"),
                    "time_to_mrca", F.coalesce("n_leaves", F.lit(0)).cast("bigint").alias("n_leaves")))


def leaf_nodes(nodes: DataFrame) -> DataFrame:
    kids = nodes.where(F.col("parent").isNotNull()).select("tree_id", F.col("parent").alias("node")).distinct()
    return nodes.select("tree_id", "node").join(kids, ["tree_id", "node"], "left_anti")


SIBLING_BUCKETS = 64  # shares that the children of one node are ordered in


def _siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with their next sibling, in the order of (share, node); the children of a large node are ordered in shares."""
    family = ["tree_id", "parent"]
    dealt = nodes.withColumn("share", F.pmod(F.xxhash64("node"), F.lit(SIBLING_BUCKETS)))
    own = dealt.withColumn("sib", F.lead("node").over(Window.partitionBy(*family, "share").orderBy("node")))
    heads = dealt.groupBy(*family, "share").agg(F.min("node").alias("head"))  # at most 64 rows a node
    heads = heads.withColumn("head", F.lead("head").over(Window.partitionBy(*family).orderBy("share"))).where("head IS NOT NULL")
    o, h = own.alias("o"), heads.alias("h")
    return o.join(h, F.expr("o.tree_id = h.tree_id AND o.parent <=> h.parent AND o.share = h.share AND o.sib IS NULL"), "left").select(
        "o.tree_id", "o.node", "o.parent", "o.share", F.coalesce("o.sib", "h.head").alias("sib"))


SMALL_TREE = 1 << 14  # nodes up to which a tree is numbered in one task
BIN_NODES = 1 << 16  # nodes of small trees that are numbered together


def _number(table: pa.Table) -> pa.Table:
    """Preorder numbers of the leaves of some whole trees, as NumPy arrays; a node of a circle has none (null)."""
    n, names = len(table), pa.chunked_array([*table["node"].chunks, *table["parent"].chunks])
    tree = table["tree_id"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = names.combine_chunks().dictionary_encode().indices
    known = codes.is_valid().to_numpy(zero_copy_only=False)[n:]
    codes = codes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    key, up = tree * 2 * (n + 1) + codes[:n], tree * 2 * (n + 1) + codes[n:]
    by_key = np.argsort(key, kind="stable")
    at = by_key[np.minimum(np.searchsorted(key, up, sorter=by_key), n - 1)]
    parent = np.where(known, np.where(key[at] == up, at, -2), -1)  # -1: none, -2: no such node
    depth, end = (parent >= 0).astype(np.int64), parent.copy()
    for _ in range(n.bit_length()):
        depth, end = depth + np.where(end >= 0, depth[end], 0), np.where(end >= 0, end[end], end)
    kept = end == -1
    inner = kept & (parent >= 0)
    leaf = np.ones(n, bool)
    leaf[parent[inner]] = False
    rows = np.flatnonzero(kept)
    rows = rows[np.argsort(depth[rows], kind="stable")]
    levels = np.split(rows, np.flatnonzero(np.diff(depth[rows])) + 1)
    size = leaf.astype(np.int64)
    for level in levels[:0:-1]:
        np.add.at(size, parent[level], size[level])
    family = np.where(inner, parent, n + tree)
    order = rows[np.argsort(family[rows], kind="stable")]
    before = np.cumsum(size[order]) - size[order]
    first = np.ones(len(order), bool)
    first[1:] = np.diff(family[order]) != 0
    lo = np.zeros(n, np.int64)
    lo[order] = before - before[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    for level in levels[1:]:
        lo[level] += lo[parent[level]]
    out = kept | (end >= 0)
    return pa.table({"tree_id": table["tree_id"], "node": table["node"], "lo": pa.array(lo, mask=end >= 0),
                     "hi": pa.array(lo + size, mask=end >= 0), "leaf": leaf}).filter(pa.array(out))


def leaf_ranges(nodes: DataFrame) -> DataFrame:
    """Preorder numbers of the leaves: (tree_id, node, lo, hi, leaf), where a node's leaves are those numbered lo to hi - 1.

    ``nodes``: tree_id, node (unique in its tree), parent (a node of the tree, or null); several roots are allowed, rows with a
    null tree_id or node are left out, and a circle of parents is an error.  Trees of up to ``SMALL_TREE`` nodes are dealt
    into bins and numbered there; the Euler tours of all larger ones are ranked at once by pointer doubling, two rows a node,
    in as many rounds as the largest tree's number of nodes has bits.
    """
    nodes = saved(nodes.where("tree_id IS NOT NULL AND node IS NOT NULL").select("tree_id", "node", "parent"))
    large = cut_lineage(nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SMALL_TREE))
    total, n_large = nodes.count(), large.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    some = nodes.join(F.broadcast(large), "tree_id", "left_anti") if n_large else nodes
    bins = -(-max(total - n_large, 1) // BIN_NODES)
    some = by_size(some.withColumn("bin", F.pmod(F.xxhash64("tree_id"), F.lit(bins))), total - n_large, "bin")
    kinds = {c: nodes.schema[c].dataType.simpleString() for c in ("tree_id", "node")}
    found = saved(some.groupBy("bin").applyInArrow(
        _number, f"tree_id {kinds['tree_id']}, node {kinds['node']}, lo long, hi long, leaf boolean"))
    if not found.where("lo IS NULL").isEmpty():
        raise ValueError("the steps run in a circle")
    return found.unionByName(_toured(nodes.join(F.broadcast(large), "tree_id", "left_semi"))) if n_large else found


def _toured(nodes: DataFrame) -> DataFrame:
    """:func:`leaf_ranges` of large trees."""
    nodes = saved(nodes)
    sib = saved(_siblings(nodes))
    first = sib.where("parent IS NOT NULL").groupBy("tree_id", F.col("parent").alias("node")).agg(
        F.min(F.struct("share", "node"))["node"].alias("child"))
    step = lambda node, out: F.struct("tree_id", F.col(node).alias("node"), F.lit(out).alias("out"))
    row = lambda e, to, s: F.struct(e.alias("e"), to.alias("to"), s.cast("long").alias("s"))
    tour = sib.join(first, ["tree_id", "node"], "left").select(F.explode(F.array(
        row(step("node", False), F.when(F.col("child").isNull(), step("node", True)).otherwise(step("child", False)),
            F.col("child").isNull()),
        row(step("node", True), F.when(F.col("sib").isNotNull(), step("sib", False)).when(
            F.col("parent").isNotNull(), step("parent", True)), F.lit(0)))).alias("x")).select(
                "x.*", (F.col("x.s") == 1).alias("leaf"))
    tour = saved(tour)
    ranked = suffix_sums(tour.drop("leaf"))
    bounds = ranked.groupBy("e.tree_id", "e.node").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    leaves = tour.where("leaf").select("e.tree_id", "e.node", F.lit(True).alias("leaf"))
    return bounds.join(leaves, ["tree_id", "node"], "left").select(
        "tree_id", "node", "lo", "hi", F.coalesce("leaf", F.lit(False)).alias("leaf"))


def _leaves_in(ranges: DataFrame, wanted: DataFrame, *payload: str) -> DataFrame:
    """(tree_id, payload..., hap) for every leaf in the range lo to hi - 1 of a ``wanted`` row."""
    pairs = interval_overlap_pairs(
        wanted.select(F.struct(*payload).alias("region_id"), F.col("tree_id").alias("chrom"), F.col("lo").alias("start"),
                      F.col("hi").alias("end")),
        ranges.where("leaf").select(F.col("node").alias("region_id"), F.col("tree_id").alias("chrom"),
                                    F.col("lo").alias("start"), F.col("hi").alias("end")))
    return pairs.select(F.col("chrom").alias("tree_id"), "a_id.*", F.col("b_id").alias("hap"))


def leaf_descendants(nodes: DataFrame) -> DataFrame:
    """(tree_id, node, leaf) for every node and every leaf below it (a leaf
    is its own descendant): a range join of the nodes with the numbered leaves (see :func:`leaf_ranges`).
    """
    ranges = saved(leaf_ranges(nodes))
    return _leaves_in(ranges, ranges, "node").withColumnRenamed("hap", "leaf")


def mutations_to_haplotypes(mutations: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each mutation (tree_id, node, site) gives the derived allele to all
    leaves under the node; repeat hits stay 1.

    ``ranges`` are those of :func:`leaf_ranges`: a mutation takes its node's range and meets
    its leaves in a range join, so (node, leaf) pairs are made for mutated nodes only.
    """
    hit = mutations.select("tree_id", "node", "site").distinct().join(ranges.select("tree_id", "node", "lo", "hi"), ["tree_id", "node"])
    wanted = saved(hit.select("tree_id", "site", "lo", "hi"))
    return _leaves_in(ranges, wanted, "site").select("tree_id", "hap", "site").distinct().withColumn("allele", F.lit(1))


# ---------------------------------------------------------------- weighted draws

SENT_ITEMS = 1 << 20  # items below which all of them are sent to the tasks (16 MB)
BLOCK_ITEMS, BLOCKS = 1 << 14, 50_000  # items in a block, at least; blocks, at most


def _cut_items(size: int):
    """Items in order -> blocks: their items and the weights summed up to each."""
    def flush(item: list[int], w: list[int]) -> pa.RecordBatch:
        both = np.stack([np.array(item, np.int64), np.cumsum(np.array(w, np.int64))])
        return pa.RecordBatch.from_arrays([pa.array([int(both[1, -1])]), pa.array([both.tobytes()], pa.binary())], ["total", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, w = [], []
        for batch in batches:
            item += batch.column(0).to_pylist()
            w += batch.column(1).to_pylist()
            while len(item) >= size:
                yield flush(item[:size], w[:size])
                item, w = item[size:], w[size:]
        if item:
            yield flush(item, w)
    return run


def _pick(blob: bytes, u: np.ndarray) -> np.ndarray:
    """The first item of a block whose summed weight reaches ``u``."""
    item, upto = np.frombuffer(blob, np.int64).reshape(2, -1)
    return item[np.searchsorted(upto, u, "left")]


def _drawn(draw: list, u: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([draw if isinstance(draw, pa.Array) else pa.array(draw), pa.array(u), pa.array(item)],
                                      ["draw_id", "u", "item"])


def _pick_sent(sent):
    """All blocks in the task: the block's place first, then the place inside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, blobs = sent.value
        items = [np.frombuffer(b, np.int64).reshape(2, -1) for b in blobs]
        item, upto = (np.concatenate([b[0] for b in items]), np.concatenate([b[1] + o for b, o in zip(items, before)]))
        for batch in batches:
            u = batch.column(1).to_numpy()
            yield _drawn(batch.column(0), u, item[np.searchsorted(upto, u, "left")])
    return run


def _to_blocks(sent):
    """Draws with their block, what of u is left for it, and one of the block's shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, upto, shares = sent.value
        for batch in batches:
            u = batch.column(1).to_numpy()
            block = np.searchsorted(upto, u, "left")
            share = u % shares[block]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(share), batch.column(0), batch.column(1), pa.array(u - before[block]),
                 pa.nulls(len(u), pa.binary())], ["block", "share", "draw_id", "u", "rest", "items"])
    return run


def _pick_streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's items first, then the draws that fall into it."""
    blob = None
    for batch in batches:
        heads = np.flatnonzero(batch.column("items").is_valid().to_numpy(zero_copy_only=False)).tolist()
        for start, end in zip([0, *[h + 1 for h in heads]], [*heads, batch.num_rows]):
            if end > start:
                part = batch.slice(start, end - start)
                yield _drawn(part.column("draw_id"), part.column("u").to_numpy(), _pick(blob, part.column("rest").to_numpy()))
            if end < batch.num_rows:
                blob = batch.column("items")[end].as_py()


def weighted_sample(items: DataFrame, draws: DataFrame, seed: int = 7, sent_items: int = SENT_ITEMS,
                    block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Sampling with replacement proportional to integer weights.

    ``items``: item (integer, unique), w (BIGINT >= 0); ``draws``: draw_id.
    Each draw u = 1 + hash60(seed, draw_id) mod total picks the first item
    (in item order) whose cumulative weight reaches u.  All weights 0 ->
    uniform; no items -> no rows.  Output: draw_id, u, item.

    Items in order are cut into blocks with summed weights.  The sums of the blocks, at most 50,000 and
    one for each partition, are searched first, then the block.  Up to ``sent_items`` items all blocks are sent to the
    draws' tasks and nothing is shuffled; beyond, draws go to their block, and a block that draws
    more than a task's share goes to several tasks.  All arithmetic is in 64-bit integers.
    """
    spark = items.sparkSession
    raw_total, n = items.agg(F.sum("w"), F.count(F.lit(1))).first()  # two numbers
    kind = items.schema["item"].dataType.simpleString()
    schema = f"draw_id {draws.schema['draw_id'].dataType.simpleString()}, u long, item long"
    if not n:
        return spark.createDataFrame([], schema).withColumn("item", F.col("item").cast(kind))
    it = items.select(F.col("item").cast("long"), (F.col("w") if raw_total else F.lit(1)).cast("long").alias("w")).where("w > 0")
    cut = it.repartitionByRange("item").sortWithinPartitions("item").mapInArrow(
        _cut_items(max(block_items, -(-n // BLOCKS))), "total long, items binary")
    blocks = cut_lineage(cut.withColumn("id", F.monotonically_increasing_id()))
    sums = blocks.select("id", "total").orderBy("id").collect()
    upto = np.cumsum([r["total"] for r in sums], dtype=np.int64)
    before = upto - np.array([r["total"] for r in sums], np.int64)
    u = (F.lit(1) + F.pmod(hash60(F.lit(seed), F.col("draw_id")), F.lit(int(upto[-1])))).cast("bigint").alias("u")
    drawn = draws.select("draw_id", u)
    if n <= sent_items:
        blobs = [r["items"] for r in blocks.orderBy("id").select("items").collect()]
        out = drawn.mapInArrow(_pick_sent(spark.sparkContext.broadcast((before, blobs))), schema)
        return out.withColumn("item", F.col("item").cast(kind))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = np.maximum(1, -(-(upto - before) * tasks // upto[-1])) if upto[-1] < (1 << 62) // tasks else np.array(
        [max(1, -(-r["total"] * tasks // int(upto[-1]))) for r in sums], np.int64)
    number = spark.createDataFrame([(r["id"], i, int(s)) for i, (r, s) in enumerate(zip(sums, shares))], "id long, block long, n long")
    heads = blocks.join(F.broadcast(number), "id").select("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("share"), "items")
    sent = drawn.mapInArrow(_to_blocks(spark.sparkContext.broadcast((before, upto, shares))),
                            f"block long, share long, {schema.split(',')[0]}, u long, rest long, items binary")
    dealt = heads.unionByName(sent, allowMissingColumns=True).repartition("block", "share").sortWithinPartitions(
        "block", "share", F.col("items").isNull())
    return dealt.mapInArrow(_pick_streamed, schema).withColumn("item", F.col("item").cast(kind))
