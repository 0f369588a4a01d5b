"""From raw documents to a mixed, tokenized corpus.

Each stage takes what its predecessor kept, acts on its decisions and, but for
the last, returns the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm import line_dedup, mixing, ngram_join, sentencepiece_codec, toxicity
from labwatch.llm.common import sessions_checkpoint, table, written_place


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; the labels of other folds teach what toxic is."""
    return toxicity.ordinary_only(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur earlier, or nearly so, go from the text; documents without a word left go."""
    out = line_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that gives every source the same share for as long as it lasts."""
    return mixing.mixed(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the proof that they decode to its text.

    ``position`` keeps the order of the mix, which readers of its files don't.
    """
    return sentencepiece_codec.encode(written_place(docs), sentencepiece_codec.model_path(), place="written_place")


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_each_group),
    ("mixing", mixed_sources),
    ("sentencepiece", tokenized),
]

#: A trained classifier, an edit join and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = f"{sessions_checkpoint(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    raise ValueError("no stage")
