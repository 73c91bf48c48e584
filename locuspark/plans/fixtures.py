"""Analysis inputs derived from the driver's tables.

Each derivation exists twice, as a DataFrame builder and as the DuckDB SQL
text used by the oracles, and both read the *whole* table: no id subsets,
modulo filters or prefixes.  Arithmetic is reduced modulo before
multiplying so nothing overflows at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.session import by_size, spread

CHROM_COUNT = 5
CHROM_SPAN = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- intervals

def intervals_a(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    start = (F.pmod(e.event_id, CHROM_SPAN) * 7919 + F.pmod(e.user_id, CHROM_SPAN) * 104729) % CHROM_SPAN
    return e.select(
        e.event_id.alias("region_id"),
        F.concat(F.lit("chr"), (F.pmod(e.user_id, CHROM_COUNT) + 1).cast("string")).alias("chrom"),
        start.cast("bigint").alias("start"),
        (start + 100 + F.pmod(e.event_id, 901) * 31 % 901).cast("bigint").alias("end"),
    )


def intervals_b(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    start = (F.pmod(o.o_orderkey, CHROM_SPAN) * 15485863 + 17) % CHROM_SPAN
    return o.select(
        o.o_orderkey.alias("region_id"),
        F.concat(F.lit("chr"), (F.pmod(o.o_custkey, CHROM_COUNT) + 1).cast("string")).alias("chrom"),
        start.cast("bigint").alias("start"),
        (start + 100 + F.pmod(o.o_custkey, 901)).cast("bigint").alias("end"),
    )


def chrom_sizes(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        F.concat(F.lit("chr"), (r.r_regionkey + 1).cast("string")).alias("chrom"),
        (F.lit(4001001) + r.r_regionkey.cast("bigint") * 1000).alias("length"),
    )


INTERVALS_A_SQL = f"""
SELECT event_id AS region_id,
       'chr' || CAST(user_id % {CHROM_COUNT} + 1 AS VARCHAR) AS chrom,
       CAST(((event_id % {CHROM_SPAN}) * 7919 + (user_id % {CHROM_SPAN}) * 104729) % {CHROM_SPAN} AS BIGINT) AS start,
       CAST(((event_id % {CHROM_SPAN}) * 7919 + (user_id % {CHROM_SPAN}) * 104729) % {CHROM_SPAN}
            + 100 + (event_id % 901) * 31 % 901 AS BIGINT) AS "end"
FROM events"""

INTERVALS_B_SQL = f"""
SELECT o_orderkey AS region_id,
       'chr' || CAST(o_custkey % {CHROM_COUNT} + 1 AS VARCHAR) AS chrom,
       CAST(((o_orderkey % {CHROM_SPAN}) * 15485863 + 17) % {CHROM_SPAN} AS BIGINT) AS start,
       CAST(((o_orderkey % {CHROM_SPAN}) * 15485863 + 17) % {CHROM_SPAN} + 100 + o_custkey % 901 AS BIGINT) AS "end"
FROM orders"""

CHROM_SIZES_SQL = """
SELECT 'chr' || CAST(r_regionkey + 1 AS VARCHAR) AS chrom,
       CAST(4001001 + r_regionkey * 1000 AS BIGINT) AS length
FROM region"""


# ---------------------------------------------------------------- sequences

# The letter recoding that turns prose into a DNA alphabet.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTER_BASES = "ACGTACGTACGTACGTACGTACGTAC"


def sequences(spark, sf_dir) -> DataFrame:
    """Every letter of every text is a base: A-Z by the recoding, all others N (any base)."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    bases = F.translate(F.regexp_replace(d.text, "[^\\p{L}]", ""), LETTERS + LETTERS.lower(), LETTER_BASES * 2)
    return d.select(
        d.doc_id.alias("record_no"),
        F.concat(F.lit("doc"), d.doc_id.cast("string")).alias("seqid"),
        F.regexp_replace(bases, "[^ACGT]", "N").alias("seq"),
    )


SEQUENCES_SQL = f"""
SELECT doc_id AS record_no, 'doc' || CAST(doc_id AS VARCHAR) AS seqid,
       regexp_replace(translate(regexp_replace(text, '[^\\p{{L}}]', '', 'g'), '{LETTERS}{LETTERS.lower()}',
                                '{LETTER_BASES * 2}'), '[^ACGT]', 'N', 'g') AS seq
FROM documents"""


# ---------------------------------------------------------------- genotypes

def genotypes(spark, sf_dir) -> DataFrame:
    """Long VCF-like table: one row per (supplier sample, part site) seen in lineitem."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    li = by_size(li, li.count(), "l_suppkey", "l_partkey").distinct()
    s, k = F.col("l_suppkey"), F.col("l_partkey")
    inbred = F.pmod(F.pmod(s, 4) * 31 + F.pmod(F.floor(k / 60), 4) * 17, 4) == 0
    h = F.pmod(F.pmod(s, 1000) * 7919 + F.pmod(k, 1000) * 104729, 1000) / F.lit(1000.0)
    permille = F.lit(100) + F.pmod(F.pmod(k, 97) * 13, 97) * 8
    p = permille / F.lit(1000.0)
    gt = (F.when(F.pmod(s + k, 53) == 0, F.lit("./."))
          .when(F.pmod(s + k, 89) == 0, F.lit("0/."))
          .when(~inbred & (h < F.lit(2.0) * p * (F.lit(1.0) - p)), F.lit("0/1"))
          .when(F.pmod(F.pmod(s, 3) * F.pmod(k, 3), 3) == 0, F.lit("1|1"))
          .otherwise(F.lit("0/0")))
    info = F.when(F.pmod(k, 7) == 0, F.lit("DP=10;AF=.")).otherwise(
        F.concat(F.lit("DP=10;AF=0."), F.lpad(permille.cast("string"), 3, "0"), F.lit(",0.5")))
    return li.select(
        F.concat(F.lit("s"), s.cast("string")).alias("sample"),
        F.concat(F.lit("chr"), (F.pmod(k, CHROM_COUNT) + 1).cast("string")).alias("chrom"),
        (k * 20000 + F.pmod(k, 1000) * 37 % 1000).cast("bigint").alias("pos"),
        info.alias("info"),
        gt.alias("gt"),
    )


GENOTYPES_SQL = """
SELECT 's' || CAST(s AS VARCHAR) AS sample,
       'chr' || CAST(k % 5 + 1 AS VARCHAR) AS chrom,
       CAST(k * 20000 + (k % 1000) * 37 % 1000 AS BIGINT) AS pos,
       CASE WHEN k % 7 = 0 THEN 'DP=10;AF=.'
            ELSE 'DP=10;AF=0.' || lpad(CAST(100 + ((k % 97) * 13) % 97 * 8 AS VARCHAR), 3, '0') || ',0.5' END AS info,
       CASE WHEN (s + k) % 53 = 0 THEN './.'
            WHEN (s + k) % 89 = 0 THEN '0/.'
            WHEN NOT (((s % 4) * 31 + (floor(k / 60)::BIGINT % 4) * 17) % 4 = 0)
                 AND ((s % 1000) * 7919 + (k % 1000) * 104729) % 1000 / 1000.0::DOUBLE
                     < 2.0::DOUBLE * ((100 + ((k % 97) * 13) % 97 * 8) / 1000.0::DOUBLE) * (1.0::DOUBLE - (100 + ((k % 97) * 13) % 97 * 8) / 1000.0::DOUBLE)
                 THEN '0/1'
            WHEN ((s % 3) * (k % 3)) % 3 = 0 THEN '1|1'
            ELSE '0/0' END AS gt
FROM (SELECT DISTINCT l_suppkey AS s, l_partkey AS k FROM lineitem) t"""


# ---------------------------------------------------------------- population genetics

N_HAPS = 50
SEQ_LEN = 1000


def haplotypes(spark, sf_dir) -> DataFrame:
    """Derived-allele carriers: (pop, hap, site) where some line has quantity > 25."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", "l_partkey", "l_quantity")
    return (li.groupBy(F.col("l_returnflag").alias("pop"),
                       F.pmod("l_suppkey", N_HAPS).alias("hap"),
                       F.pmod("l_partkey", SEQ_LEN).alias("site"))
            .agg(F.max((F.col("l_quantity") > 25).cast("int")).alias("allele")))


HAPLOTYPES_SQL = f"""
SELECT l_returnflag AS pop, l_suppkey % {N_HAPS} AS hap, l_partkey % {SEQ_LEN} AS site,
       max(CAST(l_quantity > 25 AS INTEGER)) AS allele
FROM lineitem GROUP BY 1, 2, 3"""


def tree_nodes(spark, sf_dir) -> DataFrame:
    """One heap-shaped tree per customer over its orders.

    node = rank of the order within the customer (1-based), parent =
    floor(node / 2); leaves (2*node > size) sit at time 0, inner nodes at
    o_totalprice / node.
    """
    from pyspark.sql import Window
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    wsize = Window.partitionBy("o_custkey")
    t = o.select(
        F.col("o_custkey").alias("tree_id"),
        F.col("o_orderkey").alias("order_key"),
        F.row_number().over(w).cast("bigint").alias("node"),
        F.count(F.lit(1)).over(wsize).alias("size"),
        F.col("o_totalprice"),
    )
    return t.select(
        "tree_id", "node", "order_key",
        F.when(F.col("node") > 1, F.floor(F.col("node") / 2)).cast("bigint").alias("parent"),
        F.when(F.col("node") * 2 > F.col("size"), F.lit(0.0))
         .otherwise(F.col("o_totalprice") / F.col("node")).alias("time"),
    )


TREE_NODES_SQL = """
SELECT tree_id, node, order_key,
       CASE WHEN node > 1 THEN CAST(floor(node / 2) AS BIGINT) END AS parent,
       CASE WHEN node * 2 > size THEN 0.0 ELSE o_totalprice / node END AS time
FROM (SELECT o_custkey AS tree_id, o_orderkey AS order_key, o_totalprice,
             CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS node,
             count(*) OVER (PARTITION BY o_custkey) AS size
      FROM orders) t"""


def mutations(spark, sf_dir, nodes: DataFrame | None = None) -> DataFrame:
    """Each line item is one mutation on the edge above its order's node."""
    nodes = nodes if nodes is not None else tree_nodes(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (li.join(nodes.select("tree_id", "node", "order_key"),
                    li.l_orderkey == F.col("order_key"))
            .select("tree_id", "node", F.pmod("l_partkey", SEQ_LEN).alias("site")))


# The demography steps (time, population size) used by the as-of operators.
DEMOGRAPHY_STEPS = [(0.0, 10000.0), (1000.0, 100.0), (1050.0, 10000.0)]


def step_points(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return li.select("l_orderkey", "l_linenumber",
                     (F.pmod("l_orderkey", 1500) + F.col("l_quantity") / 100.0 - 0.25).alias("t"))


STEP_POINTS_SQL = """
SELECT l_orderkey, l_linenumber, (l_orderkey % 1500) + l_quantity / 100.0 - 0.25 AS t FROM lineitem"""


def steps_df(spark) -> DataFrame:
    return spark.createDataFrame(DEMOGRAPHY_STEPS, "t double, value double")


STEPS_SQL = "SELECT * FROM (VALUES (0.0::DOUBLE, 10000.0::DOUBLE), (1000.0, 100.0), (1050.0, 10000.0)) s(t, value)"


def weights(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return p.select(F.col("p_partkey").alias("item"),
                    F.round(F.col("p_retailprice") * 100).cast("bigint").alias("w"))


WEIGHTS_SQL = "SELECT p_partkey AS item, CAST(round(p_retailprice * 100) AS BIGINT) AS w FROM part"


# ---------------------------------------------------------------- vectors / labelled rows

def vectors(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def _text_features(docs: DataFrame, *more) -> DataFrame:
    return docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", " ", ""))).cast("double").alias("n_spaces"),
        (F.length(F.regexp_replace("text", "[^0-9]", ""))).cast("double").alias("n_digits"),
        "lang", "source", *more)


def features(spark, sf_dir) -> DataFrame:
    """Features of all documents."""
    return _text_features(spread(table(spark, sf_dir, "documents"), "doc_id"))


def labelled(spark, sf_dir) -> DataFrame:
    """Features of the documents with a quality label, and the label as ``y``."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return _text_features(table(spark, sf_dir, "documents").join(lab, "doc_id"), "y")


def unlabelled(spark, sf_dir) -> DataFrame:
    """Features of the documents without a label."""
    docs = table(spark, sf_dir, "documents")
    return _text_features(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_anti"))


LABELLED_SQL = """
SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(length(d.text) - length(replace(d.text, ' ', '')) AS DOUBLE) AS n_spaces,
       CAST(length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits,
       d.lang, d.source, l.quality AS y
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


# ---------------------------------------------------------------- merge trees

def merges(spark, sf_dir):
    """A merge table over the parts, and their number: parts join one cluster in order of price, the dearer the higher.

    Leaves are numbered by part key; a merge's height is the price in cents, so parts of one price merge at one height.
    """
    from locuspark.operators.asof import running_sum
    from locuspark.session import cut_lineage
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"), F.lit(1).alias("one"))
    p = cut_lineage(p.withColumn("by_price", F.col("cents") * (1 << 31) + F.col("p_partkey")))
    p = running_sum(running_sum(p, "p_partkey", "one", "leaf"), "by_price", "one", "place")  # from 1
    p = cut_lineage(p.select((F.col("leaf") - 1).alias("leaf"), (F.col("place") - 1).alias("place"), "cents"))
    n = p.count()
    step = F.col("place") - 1
    first = p.where("place = 0").agg(F.coalesce(F.max("leaf"), F.lit(0))).first()[0]  # one number
    steps = p.where("place > 0").select(
        step.alias("step"), F.when(step == 0, F.lit(first)).otherwise(n + step - 1).alias("left"),
        F.col("leaf").alias("right"), F.col("cents").cast("double").alias("height"))
    return steps, n


MERGES_SQL = """SELECT place - 1 AS step, CASE WHEN place = 1 THEN first ELSE n + place - 2 END AS "left", leaf AS "right",
       CAST(cents AS DOUBLE) AS height
FROM (SELECT leaf, place, cents, count(*) OVER () AS n, min(CASE WHEN place = 0 THEN leaf END) OVER () AS first
      FROM (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS leaf, cents,
                   row_number() OVER (ORDER BY cents, p_partkey) - 1 AS place
            FROM (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part) x) y) z
WHERE place > 0"""
