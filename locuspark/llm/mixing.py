"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down the tree domain - language - source.  At each node the
children share it by weight; a child that cannot use its share (its documents
times the allowed epochs are fewer tokens) takes what it can, and the shortage
goes to its siblings.  Only what all siblings together cannot use stays with
the parent's own siblings, because a parent's capacity is that of its subtree.
Each leaf then takes whole epochs and, of one more seeded epoch order, the
longest prefix of documents within the rest of its budget.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.functions.rng import hash60
from locuspark.llm.common import all_columns, cut_lineage, free_name, no_null, row_key

WORD = r"[^\x20\x09-\x0D]+"
LEAF = ["domain", "lang", "source"]
BLOCK_ROWS = 500
BROADCAST_LEAVES = 100_000


@dataclass(frozen=True)
class Mix:
    """Target weights (positive integers, 1 where not named; 0 leaves a node out) and the budget."""

    domains: Mapping[str, int]
    langs: Mapping[str, int]
    sources: Mapping[str, int]
    permille: int = 600  # budget in thousandths of all tokens
    max_epochs: int = 2
    seed: int = 42


def _weight(name: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in weights.items():
        out = F.when(F.col(name) == value, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split ``budget`` (of the parent) over its children by ``w``, none above ``cap``; adds ``got``.

    Children in order of cap / w: the first ones fill up, and from the first
    that does not, all share the rest by weight.  Integers throughout.
    """
    down = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), name)
    whole = Window.partitionBy(*parent)
    d = nodes.where("w > 0").withColumn("used", F.sum("cap").over(down) - F.col("cap"))
    d = d.withColumn("rest", F.sum("w").over(whole) - F.sum("w").over(down) + F.col("w"))
    full = F.col("cap").cast("decimal(18,0)") * F.col("rest").cast("decimal(18,0)") <= \
        (F.col("budget") - F.col("used")).cast("decimal(18,0)") * F.col("w").cast("decimal(18,0)")
    d = d.withColumn("full", full)
    d = d.withColumn("taken", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole))
    d = d.withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(whole))
    part = F.expr("CAST((CAST(budget - taken AS DECIMAL(18,0)) * CAST(w AS DECIMAL(18,0))) div open AS BIGINT)")
    return d.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(part))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``domain, lang, source, docs, tokens, budget`` from one row per leaf with its docs and tokens."""
    # a node of weight 0 takes nothing, so what is below it is no capacity of its parents
    drawn = (_weight("domain", mix.domains) > 0) & (_weight("lang", mix.langs) > 0) & (_weight("source", mix.sources) > 0)
    leaf = leaves.withColumn("cap", F.when(drawn, F.col("tokens") * mix.max_epochs).otherwise(0))
    lang = leaf.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    domain = lang.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    total = F.sum("tokens").over(Window.partitionBy("root"))
    top = domain.withColumn("root", F.lit(0)).withColumn("w", _weight("domain", mix.domains)).withColumn(
        "all", total).withColumn("budget", F.expr(f"all * {mix.permille} div 1000"))
    top = _share(top, ["root"], "domain").select("domain", F.col("got").alias("budget"))
    mid = lang.drop("tokens").withColumn("w", _weight("lang", mix.langs)).join(top, "domain")
    mid = _share(mid, ["domain"], "lang").select("domain", "lang", F.col("got").alias("budget"))
    low = leaf.withColumn("w", _weight("source", mix.sources)).join(mid, ["domain", "lang"])
    return _share(low, ["domain", "lang"], "source").select(*LEAF, "docs", "tokens", F.col("got").alias("budget"))


def _small(leaves: DataFrame) -> DataFrame:
    """The (materialised) leaf table, broadcast while it has few rows; beyond, the join shuffles and AQE splits hot leaves."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def mix_plan(docs: DataFrame, domain: Column, mix: Mix, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, domain, lang, source, n_tokens, leaf_budget, copies, epoch, h, k``.

    ``copies`` says how often the row is in the mix.  Tokens are words (runs of
    other than space and 0x09-0x0D); null text has none.  Null domain, language
    or source is the empty string, which is a node like any other.  Leaves of
    weight 0 or without tokens get nothing.  Within a leaf, rows are ordered by
    a hash of seed, epoch and id, then by row key; equal rows count one by one.
    Extra columns are ignored; an empty table gives an empty result.
    """
    slim = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), no_null(domain.cast("string")).alias("domain"),
        no_null(F.col(lang_col).cast("string")).alias("lang"),
        no_null(F.col(source_col).cast("string")).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        row_key(F.col(id_col), F.col(text_col)).alias("k")))
    leaves = cut_lineage(slim.groupBy(*LEAF).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")))
    shares = leaves.join(leaf_budgets(leaves, mix).select(*LEAF, "budget"), LEAF, "left").withColumn(
        "budget", F.coalesce("budget", F.lit(0)))
    epochs = F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0 END")
    rest = F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE -1 END")
    shares = cut_lineage(shares.withColumns({"epoch": epochs, "rest": rest,
                                             "subs": F.ceil(F.col("docs") / block_rows)}))
    rows = slim.join(_small(shares), LEAF).withColumn("h", hash60(mix.seed, F.col("epoch"), F.col("doc_id")))
    rows = rows.withColumn("sub", F.expr("shiftright(shiftright(h, 30) * subs, 30)"))
    line = Window.partitionBy(*LEAF).orderBy("sub")
    blocks = rows.groupBy(*LEAF, "sub").agg(F.sum("n_tokens").alias("t")).withColumn(
        "before", F.sum("t").over(line) - F.col("t")).drop("t")
    inner = Window.partitionBy(*LEAF, "sub").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, 0)
    upto = rows.withColumn("upto", F.sum("n_tokens").over(inner)).join(blocks, [*LEAF, "sub"])
    extra = (F.col("rest") > 0) & (F.col("before") + F.col("upto") <= F.col("rest"))
    return upto.select("doc_id", *LEAF, "n_tokens", F.col("budget").alias("leaf_budget"),
                       (F.col("epoch") + extra.cast("int")).cast("long").alias("copies"), "epoch", "h", "k")


def mix_documents(docs: DataFrame, domain: Column, mix: Mix, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The mixed corpus: all columns of ``docs``, each row as often as :func:`mix_plan` says.

    A leaf's choice is its whole epochs and the last order key of its prefix,
    so the texts meet one row per leaf and are not shuffled by document.
    """
    chosen = mix_plan(docs, domain, mix, id_col, text_col, lang_col, source_col)
    last = F.max(F.when(F.col("copies") > F.col("epoch"), F.struct("h", "k"))).alias("last")
    leaves = cut_lineage(chosen.groupBy(*LEAF).agg(F.first("epoch").alias("epoch"), last))
    names = {c: free_name(docs, f"_{c}") for c in (*LEAF, "epoch", "last", "h", "k")}
    leaves = leaves.select([F.col(c).alias(n) for c, n in names.items() if c in leaves.columns])
    keyed = docs.withColumns({names["domain"]: no_null(domain.cast("string")),
                              names["lang"]: no_null(F.col(lang_col).cast("string")),
                              names["source"]: no_null(F.col(source_col).cast("string"))})
    both = keyed.join(_small(leaves), [names[c] for c in LEAF])
    h = hash60(mix.seed, F.col(names["epoch"]), F.col(id_col))
    mine = F.struct(h.alias("h"), row_key(F.col(id_col), F.col(text_col)).alias("k"))
    copies = F.col(names["epoch"]) + F.coalesce((mine <= F.col(names["last"])).cast("int"), F.lit(0))
    out = both.withColumn(names["h"], F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return out.select(all_columns(docs))
