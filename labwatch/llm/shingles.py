"""Word shingles of whole texts as sorted sets of 64-bit hashes, batch by batch in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from labwatch.llm.common import BYTE_BASE, SPACE, U64, mix, powers, text_bytes

WIDTH = 5
INVERSE = U64(pow(int(BYTE_BASE), -1, 1 << 64))
PLACE = mix(np.arange(1, WIDTH + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
ALONE = U64(0x5851F42D4C957F2D)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, ``A-Z`` lowered, and each row's first word (n + 1 offsets)."""
    raw, offsets = text_bytes(column)
    if not len(raw):
        return np.zeros(0, U64), np.zeros(len(column) + 1, np.int64)
    low = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    word = ~SPACE[low]
    begins = np.zeros(len(raw) + 1, bool)
    begins[offsets] = True  # a row begins: no word crosses it
    opens = word.copy()
    opens[1:] &= ~word[:-1] | begins[1:-1]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | begins[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    letter = mix(np.arange(1, 257, dtype=U64))[low] * powers(BYTE_BASE, len(raw))[:-1]
    total = np.zeros(len(raw) + 1, U64)
    np.cumsum(letter, out=total[1:])
    words = mix((total[ends] - total[starts]) * powers(INVERSE, len(raw))[starts])
    return words, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every row, sorted, one row after another, and each row's first (n + 1 offsets).

    Rows with fewer words than a shingle have one, made of all their words;
    rows without words, and nulls, have none.
    """
    words, offsets = word_hashes(column)
    rows, sizes = len(column), np.diff(offsets)
    n = max(len(words) - WIDTH + 1, 0)
    full = np.zeros(n, U64)
    for k in range(WIDTH):
        full += mix(words[k : n + k] + U64(k)) * PLACE[k]
    full = mix(full)
    row = np.repeat(np.arange(rows), sizes)
    inside = row[:n] == row[WIDTH - 1 :] if n else np.zeros(0, bool)
    few = np.flatnonzero((sizes > 0) & (sizes < WIDTH))
    single = np.zeros(len(few), U64)
    for k in range(WIDTH - 1):
        has = sizes[few] > k
        single[has] += mix(words[offsets[few[has]] + k] + U64(k)) * PLACE[k]
    single = mix(single ^ (ALONE + sizes[few].astype(U64)))
    of, token = np.concatenate([row[:n][inside], few]), np.concatenate([full[inside], single])
    order = np.lexsort((token, of))
    of, token = of[order], token[order]
    if len(of):
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (token[1:] != token[:-1])
        of, token = of[new], token[new]
    return token, np.searchsorted(of, np.arange(rows + 1))
