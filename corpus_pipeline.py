"""From ``documents`` to packed training sequences, stage by stage.

Each stage takes the rows that its predecessor kept and returns the columns of ``documents`` (the last one:
packed pieces); ``run`` writes each result as Parquet in the shared folder and reads it back.

1. quality rules: failing lines go, documents that lose too much or fail the base rules go;
2. language ID: documents in no recognisable language go;
3. n-gram Jaccard join: one document of each group of near duplicates stays, that with the smallest id;
4. benchmark decontamination: documents that hold a benchmark item go;
5. best-fit packing into sequences.

Null texts fall out in stage 1.  Other columns, whatever their names, pass unchanged; ``n_chars`` follows
the text where lines were taken out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binlens.llm import decontamination, jaccard_join, language_id, packing, quality_rules
from binlens.llm.common import shared_table, split_remainder, table
from binlens.llm.queries import tokenizer_path

MIN_LANGUAGE_SCORE = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = docs.select("text", F.struct(*[f"`{c}`" for c in docs.columns if c != "text"]).alias("row"))
    kept = quality_rules.clean(row, passthrough=("row",), with_text=True).where("kept")
    return kept.select(*(F.col("cleaned_text").alias("text") if c == "text" else
                         F.length("cleaned_text").cast("long").alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    models = language_id.fit(docs.where(split_remainder("doc_id", 5) != 0))
    row = docs.select("text", F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    found = language_id.identify(row, models, passthrough=("row",))
    known = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return known.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # suffix automata, a randomised SVD and a tokenizer are not SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
