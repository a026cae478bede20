"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is
written as Parquet and read again as the next one's docs.  All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, jaccard, langid
from quarry.llm.common import checked_broadcast, text_key
from quarry.llm.exact import without_copies
from quarry.llm.mixing import mix_sources
from quarry.session import materialize

#: A document is in none of the learnt languages if its trigrams are so many standard deviations unlikelier than theirs.
LEAST_DEVIATION = -12.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the tagger has learnt; those without letters or in another language go."""
    passages = langid.sample_passages(docs)
    told = langid.identify(docs, langid.train(passages), fit=langid.familiarity(passages))
    return told.filter((F.col("lang_pred") != "und") & (F.col("deviation") >= LEAST_DEVIATION)).select(*_columns(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text (white space aside), the one with the smallest id stays."""
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar sets of five-word shingles (0.8 or more), the one with the smallest id stays."""
    found = jaccard.jaccard_components(docs, k=5, percent=80)
    gone = materialize(found.filter(~F.col("kept")).select(F.col("doc_id").alias("__i"), F.col("__th").alias("__t")), "near-copies")
    return (docs.withColumn("__th", text_key()).join(checked_broadcast(gone, 32), F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t")), "left_anti")
            .select(*_columns(docs)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(~F.col("contaminated")).select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left."""
    return mix_sources(docs.select("doc_id", "text", "source")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [("language ID", known_language), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("benchmark decontamination", drop_contaminated), ("mixing", mix)]

#: Language ID, the similarity join's components and rounding into copies are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
