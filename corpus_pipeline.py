"""Clean a corpus in stages, each over all that the one before kept, and pack what is left for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontamination, jaccard, lines, packing, quality
from docflow.session import write_once


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after texts have lost lines."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without their failed lines.

    A null text has no words and goes, as do empty texts and those of white space. Equal rows have equal fates. Nulls in other columns pass;
    an empty table gives an empty one.
    """
    return recounted(quality.kept_documents(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line, in the order of keys and lines; those with no word left go.

    Equal lines are one at any length; longer ones may be an edit apart for every twelve characters, two at most. A null text passes
    as it is, rows of null key come last. Rows of equal key and text are one document, and keep or lose the same lines.
    An empty table gives an empty one.
    """
    return recounted(lines.drop_lines(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id.

    Texts without words, null ones included, are near to nothing and stay. Rows of one key stay or go together, rows of null key
    stay. What is near is decided on the texts as the stages before have left them. An empty table gives an empty one.
    """
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of ten words, and no whole shorter item, with the benchmark.

    Null and empty texts share nothing and stay, on either side; equal rows have equal fates. Empty tables are fine on either side.
    """
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of 4096, one row per piece.

    A null text is an empty one: its end token alone. Equal rows are packed each. An empty table gives an empty one.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packed),
]

#: The tokenizer and the packing cannot be said in SQL; the stages before them are compared with SQL and brute force in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
