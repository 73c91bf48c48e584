"""Training-data pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` applies them in order, each to the Parquet table
that its predecessor's rows were written to (below ``spark.checkpoint.dir``).
All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm import queries as q
from locuspark.llm.common import all_columns, free_name, row_key, shared_path, table
from locuspark.llm.decontaminate import decontaminate
from locuspark.llm.mixing import mix_documents
from locuspark.llm.sharding import reshard, with_slots
from locuspark.llm.simhash import simhash_near_dedup
from locuspark.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of at least 0.5 go; labels are learned as in ``op8_toxicity``."""
    scored = toxicity(docs, table(spark, sf_dir, "labels").where(~q.held_out()))
    return scored.where(F.col(scored.columns[-2]) < 0.5).select(all_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest doc_id.

    Rows with equal id and text are copies of each other; one of them stays.
    """
    marked = simhash_near_dedup(docs, with_key=True)
    key = free_name(docs, "_row_key")
    stay = marked.where("keep").select(F.col("row_key").alias(key))
    rows = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(stay, key, "left_semi")
    return rows.dropDuplicates([key]).select(all_columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that ``op1_decontaminate`` calls contaminated go."""
    key = free_name(docs, "_row_key")
    bad = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(
        F.col("row_key").alias(key)).distinct()
    rows = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(bad, key, "left_anti")
    return rows.select(all_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mix of ``op3_mixing`` within one epoch, so that no document repeats after dedup."""
    return mix_documents(docs, q.domain(), q.mix_target(max_epochs=1))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns plus ``shard`` and ``slot``, as in ``op7_resharding``."""
    new = reshard(docs, q.old_shard(), q.SHARDS)
    return with_slots(new, new.columns[-1], out=free_name(docs, "slot"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated),
          ("mixing", mix_sources), ("sharding", shard)]

#: Toxicity scores and SimHash fingerprints are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
