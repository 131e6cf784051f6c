"""A corpus pipeline: toxic documents go, near-duplicates and repeated passages go, leaked
benchmark documents go, and the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.llm.containment import drop_contaminated
from stammwerk.llm.packing import pack_documents
from stammwerk.llm.shared import stored
from stammwerk.llm.simhash import drop_near_duplicates
from stammwerk.llm.substrings import strip_repeats
from stammwerk.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SimHash operator with its contract's four-word shingles and four differing bits."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay even if nothing is left of their text; n_chars follows the text."""
    stripped = strip_repeats(docs)
    if "n_chars" not in docs.columns:
        return stripped
    chars = F.when(F.col("text").isNotNull(), F.char_length("text").cast("long"))
    return stripped.withColumn("n_chars", F.coalesce(chars, "n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs).drop("text_key")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Fingerprints, fitted models and tokenizers have no SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
