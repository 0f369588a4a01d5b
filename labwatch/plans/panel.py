"""The panel: all laboratories in one table with method, age band, week and geography."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import as_date
from labwatch.operators.joins import Dimensions, attach_band, attach_epiweek, attach_geography, attach_method, fix_places


def join_labs(
    archive: DataFrame | None, labs: Mapping[str, DataFrame], cutover: str = vocab.LAB_CUTOVER, distinct: bool = False
) -> DataFrame:
    """Archive before the cut-over day, laboratories from it on; archive-only laboratories at any time.

    Sample keys are unique within a laboratory and archive keys carry their
    own prefix, so a plain union equals the distinct one; ``distinct`` brings
    back the 25-column exchange for inputs that break this.
    """
    day = as_date(cutover)
    columns = ["lab_id", *vocab.PANEL_COLUMNS]
    branches = [
        lab.where(F.col("date_testing") >= day).withColumn("lab_id", F.lit(lab_id)).select(*columns)
        for lab_id, lab in labs.items()
    ]
    if archive is not None:
        only = F.col("lab_id").isin(vocab.ARCHIVE_ONLY_LABS)
        branches.insert(0, archive.where(only | ((F.col("date_testing") < day) & ~only)).select(*columns))
    union = reduce(DataFrame.unionByName, branches)
    return union.distinct() if distinct else union


def enrich(samples: DataFrame, dims: Dimensions, start: str = vocab.PANEL_START) -> DataFrame:
    """Method, age band, week, corrected names and geography, from the panel's first day on."""
    df = samples.where(F.col("date_testing") >= as_date(start))
    df = attach_method(df, dims.test_methods)
    df = attach_band(df, dims.age_groups)
    df = attach_epiweek(df)
    df = fix_places(df, dims.fix_state, dims.fix_location)
    return attach_geography(df, dims.places)


def combined(
    archive: DataFrame | None, labs: Mapping[str, DataFrame], dims: Dimensions, cutover: str = vocab.LAB_CUTOVER,
    start: str = vocab.PANEL_START,
) -> DataFrame:
    return enrich(join_labs(archive, labs, cutover), dims, start)


def for_reports(panel: DataFrame) -> DataFrame:
    """The panel without anything that identifies a sample, laboratory, file or patient."""
    return panel.drop(*vocab.IDENTIFYING_COLUMNS)
