"""A corpus pipeline over ``documents``: each stage calls one operator of ``dimloom.llm``.

Every stage but the last returns the columns of ``documents``; ``run`` writes
each one's rows as Parquet in the shared folder and reads them again, so a
lost executor repeats no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.llm import jaccard, lines, mixing, packing, quality
from dimloom.llm.queries import vocabulary
from dimloom.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_rules(docs, model).where("kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated chunks of lines; ``n_chars`` follows the text."""
    out = lines.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix's schedule begins it."""
    mixed = mixing.mix_sources(docs).where("starts > 0")
    return mixed.withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("starts")))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix and their places in sequences."""
    return packing.pack_sequences(docs, vocabulary())


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("jaccard_join", jaccard_stage), ("mix_sources", mixing_stage), ("best_fit_packing", packing_stage)]

#: SQL cannot express the trained classifier; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
