"""Documents to packed training sequences: quality, language, near copies, mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is
written as Parquet and read again as the next one's docs.  All but the last return the columns of
documents.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.llm import language_svm, mixing, packing, quality_ratio, simhash_tree
from retailcast.llm.common import keyed, written
from retailcast.llm.queries import MIX_SEED, mix_weights, table, trusted_ids

LEAST_LANGUAGE_SCORE = 0.2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose likelihood ratio reaches the threshold."""
    return quality_ratio.keep_good(docs, trusted_ids(spark, sf_dir))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or without a clear language go."""
    model = language_svm.fit_languages(docs.where(~language_svm.held_out()))
    return language_svm.keep_known(docs, model, LEAST_LANGUAGE_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest key."""
    rows = keyed(docs)
    groups = simhash_tree.simhash_components(rows.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text")))
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias("key"))
    return rows.join(stay, "key", "left_semi").select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: rows repeat by epochs, and rows it doesn't take go."""
    rows = keyed(docs)
    weights = mix_weights(spark, sf_dir)
    weights = rows.select("key", F.col("doc.doc_id").alias("doc_id")).join(weights, "doc_id").select(F.col("key").alias("doc_id"), "weight")
    drawn = mixing.mix(rows.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text"), F.col("doc.source").alias("source")),
                       quality=weights, seed=MIX_SEED)
    taken = drawn.where("epochs > 0").select(F.col("doc_id").alias("key"), F.explode(F.sequence(F.lit(1).cast("long"), "epochs")).alias("epoch"))
    return rows.join(taken, "key").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids."""
    return packing.pack_documents(docs, special=True)


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; returns the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
