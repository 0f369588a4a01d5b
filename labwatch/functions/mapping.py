"""Vocabulary lookups written as CASE expressions and literal maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.text import starts_with


def lookup(c: Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """Exact match through a literal map; anything else, NULL included, gives the default."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(literal, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def lookup_keep(c: Column, mapping: Mapping[str, object]) -> Column:
    """Exact match, unmatched values kept."""
    return F.coalesce(lookup(c, mapping), c)


def first_of(*branches: tuple[Column, object], default: object = None) -> Column:
    """CASE with branches in order."""
    (cond, value), *rest = branches
    expr = F.when(cond, value)
    for cond, value in rest:
        expr = expr.when(cond, value)
    return expr if default is None else expr.otherwise(default)


def by_prefix(c: Column, prefixes: Mapping[str, object], default: object = None) -> Column:
    return first_of(*[(starts_with(c, p), F.lit(v)) for p, v in prefixes.items()], default=default)


def state_name(code: Column, default: str | None = None) -> Column:
    return lookup(code, vocab.STATE_NAMES, default)


def region_label(c: Column) -> Column:
    return lookup(c, vocab.REGION_LABELS)


def sex_by_prefix(c: Column) -> Column:
    return by_prefix(c, {"F": "F", "M": "M"})


def sex_exact(c: Column) -> Column:
    return F.when(c.isin("F", "M"), c)


def or_label(c: Column, label: str = vocab.NOT_REPORTED) -> Column:
    return F.coalesce(c, F.lit(label))


def any_of(conditions: Iterable[Column]) -> Column:
    out = None
    for cond in conditions:
        out = cond if out is None else out | cond
    return out


def all_of(conditions: Iterable[Column]) -> Column:
    out = None
    for cond in conditions:
        out = cond if out is None else out & cond
    return out
