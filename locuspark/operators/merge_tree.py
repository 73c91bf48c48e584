"""Binary merge trees as tables: cut into clusters, truncate, subtree sizes.

``merges``: step (0-based, in order of height), left, right, height.  Leaves are
nodes 0..n-1, and step i makes node n+i.  Work goes by pointer doubling, so the
number of rounds is the logarithm of the depth (for sizes, of the number of nodes), each
cut by a checkpoint, and no ancestor pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.session import cut_lineage, saved


def _parents(merges: DataFrame, n: int) -> DataFrame:
    made = (F.col("step") + n).alias("up")
    return merges.select(F.explode(F.array("left", "right")).alias("node"), made)


def _tops(parents: DataFrame) -> DataFrame:
    """node -> up, its topmost ancestor, for every node that has a parent."""
    jump = cut_lineage(parents)
    while True:
        over = jump.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        step = jump.join(over, "up", "left")
        if step.where(F.col("higher").isNotNull()).isEmpty():
            return jump
        jump = cut_lineage(step.select("node", F.coalesce("higher", "up").alias("up")))


def cut_tree(merges: DataFrame, n: int, k: int) -> DataFrame:
    """M3: (leaf, cluster 1..) for the lowest cut with at most ``k`` clusters.

    Merges of equal height are all made or all left, so ties may give fewer
    than ``k``.  Clusters are numbered by their smallest leaf.
    """
    leaves = merges.sparkSession.range(n).select(F.col("id").alias("leaf"))
    if k >= n:
        return leaves.withColumn("cluster", (F.col("leaf") + 1).cast("int"))
    cut = merges.where(F.col("step") == n - max(k, 1) - 1).select("height").first()[0]  # steps go by height
    made = merges.where(F.col("height") <= cut)
    tops = _tops(_parents(made, n))
    homes = leaves.join(tops, leaves["leaf"] == tops["node"], "left").select(
        "leaf", F.coalesce("up", "leaf").alias("top"))
    names = homes.groupBy("top").agg(F.min("leaf").alias("first"))  # at most k rows
    names = names.withColumn("cluster", F.row_number().over(Window.orderBy("first"))).drop("first")
    return homes.join(F.broadcast(names), "top").select("leaf", "cluster")


def suffix_sums(steps: DataFrame) -> DataFrame:
    """Lists ranked by pointer doubling: ``s`` of each step becomes the sum from it to the end of its list.

    ``steps``: e (unique, of any type), to (the next step; null at an end), s.  Each round doubles the jumps, so there are
    as many rounds as the length of the longest list has bits; steps in a circle are an error.
    """
    steps = saved(steps)
    for _ in range(steps.count().bit_length() + 1):
        open_ = steps.where("to IS NOT NULL")
        if open_.isEmpty():
            return steps
        ahead = steps.select(F.col("e").alias("to"), F.col("to").alias("far"), F.col("s").alias("more"))
        steps = saved(steps.where("to IS NULL").unionByName(open_.join(ahead, "to").select(
            "e", F.col("far").alias("to"), (F.col("s") + F.col("more")).alias("s"))))
    raise ValueError("the steps run in a circle")


def subtree_sizes(merges: DataFrame, n: int) -> DataFrame:
    """(node, size) of every made node: its leaves, from an Euler tour ranked by pointer doubling.

    The tour enters and leaves every node but the root once.  Each of its steps knows the next one; doubling the
    jumps gives the number of leaves entered from a step to the end, and a node's size is the difference between
    entering and leaving it.  There are two rows a node at all times, however deep the tree.
    """
    enter, leave = (lambda x: 2 * x), (lambda x: 2 * x + 1)
    made = F.col("step") + n
    left, right = F.col("left"), F.col("right")
    root = 2 * n - 2
    row = lambda e, to, leaves: F.struct(e.cast("long").alias("e"), to.cast("long").alias("to"), leaves.cast("long").alias("s"))
    entered = lambda x: (x < n).cast("long")
    tour = merges.select(F.explode(F.array(
        row(leave(left), enter(right), F.lit(0)),
        row(leave(right), F.when(made != root, leave(made)), F.lit(0)),
        row(enter(made), enter(left), F.lit(0)),
        row(enter(left), F.when(left < n, leave(left)), entered(left)),
        row(enter(right), F.when(right < n, leave(right)), entered(right)))).alias("x")).select("x.*")
    # a made node is named as a child (next step unknown there) and by its own merge: one row of both
    tour = suffix_sums(tour.groupBy("e").agg(F.max("to").alias("to"), F.max("s").alias("s")))
    node = F.expr("e div 2")
    size = F.sum(F.when(F.col("e") % 2 == 0, F.col("s")).otherwise(-F.col("s")))
    return tour.groupBy(node.alias("node")).agg(size.alias("size")).where(F.col("node") >= n)


def truncate_tree(merges: DataFrame, n: int, p: int) -> DataFrame:
    """M3: the tree's last ``p`` clusters as a table: (node, size), before the last ``p - 1`` merges."""
    top = merges.where(F.col("step") >= n - p)
    inner = top.select((F.col("step") + n).alias("node"))
    ends = _parents(top, n).select("node").join(inner, "node", "left_anti")
    return ends.join(subtree_sizes(merges, n), "node", "left").select("node", F.coalesce("size", F.lit(1)).alias("size"))
