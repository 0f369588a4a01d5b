"""Text cleaning."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_pairs() -> tuple[str, str]:
    """Latin letters whose canonical decomposition starts with an ASCII letter."""
    accented, plain = [], []
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            accented.append(chr(code))
            plain.append(base)
    # fixed values: letters with a stroke and ordinal signs, which do not decompose
    return "".join(accented) + "ØøŁłĐđĦħŦŧıªº", "".join(plain) + "OoLlDdHhTtiao"


#: Letters that become two.
_PAIRS = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "TH", "þ": "th"}


_ACCENTED, _PLAIN = _accent_pairs()


def unaccent(c: Column) -> Column:
    """Text of single-byte characters has no accents and skips the per-character lookup."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(
        reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), _PAIRS.items(), F.translate(c, _ACCENTED, _PLAIN))
    )


def normalize_text(c: Column) -> Column:
    """Upper case without accents, stripped of blanks, then of tabs and backslashes."""
    return F.btrim(F.btrim(F.upper(unaccent(c))), F.lit("\t\\"))


def strip_nonword(c: Column) -> Column:
    """Keep letters, digits, underscores and white space."""
    return F.regexp_replace(c, r"(?U)[^\w\s]", "")


def squeeze(c: Column) -> Column:
    """Drop dots and colons, fold white space to one blank."""
    return F.regexp_replace(F.regexp_replace(c, "[.:]", ""), r"\s+", " ")


def remove_terms(c: Column, terms: Iterable[str]) -> Column:
    return reduce(lambda acc, term: F.replace(acc, F.lit(term), F.lit("")), terms, c)


def starts_with(c: Column, prefix: str) -> Column:
    """Case-insensitive prefix test; the prefix is literal text."""
    return F.upper(c).startswith(prefix.upper())
