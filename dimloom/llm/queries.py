"""The registered queries of the training-data operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimloom.llm import (chat, jaccard, licenses, lines, main_text, merkle, mixing, near_vectors, orchard, packing, quality, repeats,
                         surrogates)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.quality_rules(docs, model).drop("text")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file, on every machine the same."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(table(spark, sf_dir, "documents"), vocabulary())


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(*chat.from_turns(table(spark, sf_dir, "conversations")), chat.ASK)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, key="op5")  # a user's key is a secret of theirs


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known, rows = licenses.trained(spark, docs)
    return licenses.license_scan(docs, known, rows=rows)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90).drop("print")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.substring_dedup(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.judged_pages(table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_mix_sources": op4_mix_sources,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_license_scan": op6_license_scan,
    "op7_near_vectors": op7_near_vectors,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_html_extraction": op12_html_extraction,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op3_chat_formatting": chat.ORACLE,
    "op9_line_dedup": lines.ORACLE,
    "op11_centroid_clustering": orchard.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
