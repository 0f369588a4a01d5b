"""Samples, panel and register built by the library from the derived inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import testbed as tb
from labwatch import vocab
from labwatch.functions.keys import sample_key
from labwatch.operators.collapse import fill_and_keep_one, one_hot
from labwatch.operators.joins import Dimensions
from labwatch.plans import matrices, panel, register

CARRIED = [
    "lab_id", "test_id", "test_kit", "sex", "age", "location", "state", "date_testing", "patient_id", "file_name",
]
OWN_NAMES = {p: [p] for p in vocab.PATHOGENS}


def hot(spark: SparkSession, sf_dir: str, derive: tb.Derive = str) -> DataFrame:
    """One row per test result, with its sample key and the 12 result codes."""
    long = tb.long_results(spark, sf_dir, derive).withColumn("sample_id", sample_key(F.col("test_id"), F.col("test_kit")))
    return one_hot(long, OWN_NAMES, "analyte")


def samples(spark: SparkSession, sf_dir: str, derive: tb.Derive = str) -> DataFrame:
    return fill_and_keep_one(hot(spark, sf_dir, derive), CARRIED)


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions(tb.municipalities(spark, sf_dir), tb.macroregions(spark, sf_dir))


def full_panel(spark: SparkSession, sf_dir: str, derive: tb.Derive = str) -> DataFrame:
    return panel.enrich(samples(spark, sf_dir, derive), dimensions(spark, sf_dir))


def register_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register.wide(tb.raw_register(spark, sf_dir), tb.AS_OF)


def source(spark: SparkSession, sf_dir: str, with_register: bool = True) -> matrices.Source:
    reg = register_samples(spark, sf_dir) if with_register else None
    return matrices.source(full_panel(spark, sf_dir), reg, dimensions(spark, sf_dir), tb.AS_OF)
