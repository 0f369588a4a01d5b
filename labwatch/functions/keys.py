"""Row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_text(*parts: Column) -> Column:
    """Concatenation that skips NULL parts; dates read as ISO text."""
    return F.concat_ws("", *[p.cast("string") for p in parts])


def sample_key(*parts: Column) -> Column:
    return F.md5(joined_text(*parts))


def prefixed(prefix: str, c: Column) -> Column:
    """NULL stays NULL."""
    return F.concat(F.lit(prefix), c)
