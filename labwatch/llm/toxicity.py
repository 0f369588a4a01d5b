"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
A window of the text is compressed with either; where the toxic dictionary
saves bytes against the ordinary one, the window resembles toxic text. How
many windows save how much decides on the document, with thresholds that are
calibrated on labelled rows.

A window is one word between two copies of a fixed carrier that both
dictionaries hold. The compressor looks for no match in the last bytes of its
input and never bothers with tiny blocks, so the carrier makes it weigh every
word, and what a word costs does not depend on its neighbours. Each distinct
word of a batch is compressed once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import give_back, lean, pieces, table, texts

#: Labelled rows of each kind that the classifier is fitted on, at most (the rows with the least hash).
TOXIC_ROWS, ORDINARY_ROWS = 2_000, 6_000
#: Bytes of a dictionary, rows and share of rows a segment must occur in, how many times likelier it must be in its class.
DICTIONARY, LEAST_ROWS, LEAST_SHARE, CONTRAST = 1_024, 5, 0.025, 20.0
#: Lengths of beginnings, and when a longer one counts as the same.
SEGMENT, SAME = range(5, 13), 0.7
LEVEL, THRESHOLD = 3, 0.7
#: Savings in bytes that are counted as features.
SAVED = (2, 3, 4, 5, 6)
BATCH_BYTES, REMEMBERED = 8 << 20, 400_000
CARRIER = bytes(33 + (i * 37 + i * i * 11) % 94 for i in range(48))

words = re.compile(rb"[^\s.,;:!?\"()]+").findall


def windows(text: str) -> list[bytes]:
    return words(text.lower().encode())


def segments(window: bytes) -> list[bytes]:
    """The word with its ends, and its beginnings."""
    framed = b" " + window + b" "
    return [framed[:k] for k in SEGMENT if k < len(framed)] + [framed]


def packed(chosen: list[bytes], limit: int) -> bytes:
    """Segments one after another up to ``limit`` bytes, the first nearest to the end.

    Beginnings that are not chosen yet come first, longer forms of the same
    word then fill the rest; what is part of another segment is left out.
    """
    got: list[bytes] = []
    size = 0
    for longer in (False, True):
        for s in chosen:
            if size + len(s) <= limit and not any(s in g or not longer and s.startswith(g.rstrip()) for g in got):
                got.append(s)
                size += len(s)
    return b"".join(reversed(got))


def dictionaries(toxic: list[str], ordinary: list[str], limit: int = DICTIONARY) -> tuple[bytes, bytes]:
    """The content of the toxic and of the ordinary dictionary."""
    counts = Counter(s for t in toxic for s in {s for w in set(windows(t)) for s in segments(w)})
    least = max(LEAST_ROWS, LEAST_SHARE * len(toxic))
    counts = {s: n for s, n in counts.items() if n >= least}
    longest = Counter()
    for s, n in counts.items():
        longest[s[:-1]] = max(longest[s[:-1]], n)
    # a beginning that nearly always goes on the same way says no more than the longer one
    in_toxic = {s: n for s, n in counts.items() if longest[s] < SAME * n}
    stems = {s[: SEGMENT[0]] for s in in_toxic}
    in_ordinary: Counter = Counter()
    plain: Counter = Counter()
    for t in ordinary:
        own = set(windows(t))
        in_ordinary.update({s for w in own if (b" " + w + b" ")[: SEGMENT[0]] in stems for s in segments(w) if s in in_toxic})
        plain.update(b" " + w + b" " for w in own)
    a, b = len(toxic), len(ordinary)
    odds = {s: (n / a) / ((in_ordinary[s] + 1) / b) for s, n in in_toxic.items()}
    chosen = sorted((s for s in odds if odds[s] > CONTRAST), key=lambda s: (-in_toxic[s] * math.log(odds[s]), s))
    first = packed(chosen, limit)
    usual = [s for s, _ in plain.most_common(2_000) if odds.get(s, 0) <= CONTRAST]
    second = packed(sorted(usual, key=lambda s: (-plain[s], s)), limit)
    return first + CARRIER, second + CARRIER


class Distance:
    """Bytes that the toxic dictionary saves against the ordinary one, window by window."""

    def __init__(self, toxic: bytes, ordinary: bytes, level: int = LEVEL):
        import zstandard

        def compressor(content: bytes):
            kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kept.precompute_compress(level=level)
            return zstandard.ZstdCompressor(level=level, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False).compress

        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)
        self.known: dict[bytes, int] = {}

    def saved(self, text: str) -> list[int]:
        out = []
        for w in windows(text):
            n = self.known.get(w)
            if n is None:
                if len(self.known) >= REMEMBERED:
                    self.known = {}
                framed = CARRIER + b" " + w + b" " + CARRIER
                self.known[w] = n = len(self.ordinary(framed)) - len(self.toxic(framed))
            out.append(n)
        return out

    def features(self, text: str) -> list[float]:
        got = np.asarray(self.saved(text) or [0])
        return [math.log1p(int((got >= k).sum())) for k in SAVED] + [float(got.max()), math.log1p(got.size)]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def held_out(key: Column) -> Column:
    """The fold that labels are never learned from."""
    return F.crc32(key.cast("string")) % 3 == 1


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, ordinary_rows: int) -> tuple[list[str], list[str]]:
    """Distinct texts of at most so many labelled rows of the learning folds."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("toxic = 1").orderBy(*by).limit(toxic_rows).unionAll(known.filter("toxic = 0").orderBy(*by).limit(ordinary_rows))
    # bounded by the two limits, so the documents need not be moved
    rows = docs.select(F.col("doc_id"), F.col("text")).filter(F.length("text") > 0).join(F.broadcast(chosen), "doc_id").select("toxic", "text").distinct().collect()
    rows = sorted((r["toxic"], r["text"]) for r in rows)
    toxic = [t for y, t in rows if y == 1]
    seen = set(toxic)
    return toxic, [t for y, t in rows if y == 0 and t not in seen]


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS, dictionary: int = DICTIONARY) -> tuple[bytes, bytes, list[float]] | None:
    """Dictionaries and calibration; None where a class has no labelled text.

    The dictionaries are trained on one half of the sample and the
    calibration is fitted on the other, so that chance matches count.
    """
    toxic, ordinary = sample(docs, labels, toxic_rows, ordinary_rows)
    if not toxic or not ordinary:
        return None
    half = lambda rows, k: rows[k::2] if len(rows) > 1 else rows
    contents = dictionaries(half(toxic, 0), half(ordinary, 0), dictionary)
    distance = Distance(*contents)
    rows = [(t, 1) for t in half(toxic, 1)] + [(t, 0) for t in half(ordinary, 1)]
    weights = fit(np.array([distance.features(t) for t, _ in rows]), np.array([y for _, y in rows], float))
    del toxic, ordinary, distance, rows
    give_back()  # the driver goes on with other work
    return *contents, weights.tolist()


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``row struct`` (all columns of ``docs``), ``held_out``, ``score`` and ``predicted`` for every row.

    Scores read nothing but the text. Null and empty texts are scored as
    texts without windows. Without labelled text of both classes every score
    is 0.0. Repeated rows give repeated rows; extra columns ride along inside
    ``row``. Only ``doc_id``, ``text`` and the labels are needed.
    """
    model = train(docs, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, ordinary, weights = model
        distance, w = Distance(toxic, ordinary), np.asarray(weights)
        for batch in pieces(batches, BATCH_BYTES):
            x = np.array([distance.features(t) for t in texts(batch.column(0).field("text"))])
            score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.record_batch({"row": batch.column(0), "score": pa.array(score, pa.float64())})

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    scored = rows.mapInArrow(lean(run), f"row {rows.schema['row'].dataType.simpleString()}, score double") if model else rows.withColumn("score", F.lit(0.0))
    return scored.select("row", F.coalesce(held_out(F.col("row.doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def ordinary_only(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that are predicted toxic."""
    return toxicity(docs, labels, **options).filter("predicted = 0").select("row.*")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("row.doc_id").cast("long").alias("doc_id"), "held_out", "score", "predicted")
