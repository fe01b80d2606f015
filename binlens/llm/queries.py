"""Registered queries ``opN_<name>``: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from binlens.llm import decontamination, filter_audit, html_extraction, jaccard_join, language_id, packing, pitman_yor, quality_rules, sharding, simhash, toxicity, vector_codes, zip_archive
from binlens.llm.common import split_remainder, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = split_remainder("doc_id", 5)
    models = language_id.fit(docs.where(rest != 0))
    return language_id.identify(docs.withColumn("held_out", rest == 0), models, passthrough=("doc_id", "held_out"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    # the vocabulary of byte_bpe_50k.json as ranks: the same ids, tested in tests/llm
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = split_remainder("doc_id", 3)
    return toxicity.score(docs.withColumn("held_out", rest == 1), toxicity.fit(docs.where(rest != 1), labels),
                          passthrough=("doc_id", "held_out"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = html_extraction.train(html_extraction.labelled_pages())
    return html_extraction.extract(table(spark, sf_dir, "pages"), field)


def op6_zip_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_archive.round_trip(table(spark, sf_dir, "pages"), spark)


def op7_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), split_remainder("doc_id", 10) == 0)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_html_extraction": op5_html_extraction,
    "op6_zip_archive": op6_zip_archive,
    "op7_feistel_sharding": op7_feistel_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_pitman_yor": op10_pitman_yor,
    "op11_vector_codes": op11_vector_codes,
    "op12_simhash": op12_simhash,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {"op2_quality_rules": quality_rules.ORACLE, "op11_vector_codes": vector_codes.oracle(),
                           "op13_filter_audit": filter_audit.ORACLE}
