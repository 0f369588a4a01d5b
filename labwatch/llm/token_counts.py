"""Token counts by overlap resynchronisation.

Ordinary texts are counted by their pre-tokens: a byte-level BPE never merges
across them, so each distinct pre-token of a batch goes through the tokenizer
once. Huge texts are never given to the tokenizer whole. They are cut into
overlapping chunks, each chunk is encoded with offsets, and neighbours are
spliced at a boundary that both encodings share and that is provably stable:
a new pre-token starts there whatever stands further to the left or right.
Where the overlap holds no such boundary, it is widened, at last to the rest
of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import pieces, table, texts

#: Texts up to so many code points are counted by pre-tokens, longer ones by chunks.
CHUNK, OVERLAP = 32_768, 256
LIMIT = 1024
#: Bytes of text that a task tokenizes at a time, and distinct pre-tokens it remembers.
BATCH_BYTES, REMEMBERED = 4 << 20, 400_000
#: How the byte-level vocabulary splits text before it merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Counter:
    """Counts tokens of whole texts with one tokenizer file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import re

        import regex

        self.tokenizer, self.chunk, self.overlap = load(path), chunk, overlap
        self.split = regex.compile(PATTERN).findall
        self.blank = regex.compile(r"\s").match
        self.letter = regex.compile(r"\p{L}").match
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, int] = {}
        # by pre-tokens only where the file splits as PATTERN does and changes nothing before
        kind = self.tokenizer.pre_tokenizer
        plain = kind is not None and "ByteLevel" in repr(kind) and "add_prefix_space=False" in repr(kind)
        self.by_pretoken = plain and self.tokenizer.normalizer is None

    def whole(self, batch: list[str]) -> list[int]:
        """Counts of ordinary texts."""
        if not self.by_pretoken:
            return [len(e) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        counts, words = [0] * len(batch), []
        for i, text in enumerate(batch):
            parts = [text]
            if self.cut and any(s in text for s in self.special):
                parts = self.cut.split(text)
                counts[i] = len(parts) - 1
            words.append([w for p in parts for w in self.split(p)])
        new = list({w for row in words for w in row} - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list({w for row in words for w in row})
        for word, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.known[word] = len(e)
        return [n + sum(map(self.known.__getitem__, row)) for n, row in zip(counts, words, strict=True)]

    def stable(self, text: str, at: int) -> bool:
        """A pre-token starts at ``at`` whatever follows or precedes the two characters there.

        A blank followed by a letter, after a letter: the blank opens the
        letter's pre-token and the letters before it end theirs. No special
        token may reach over the place.
        """
        if not (0 < at < len(text) - 1 and text[at] == " " and self.letter(text, at + 1) and self.letter(text, at - 1)):
            return False
        return not any(text.find(s, max(0, at - len(s) + 1), at + len(s) - 1) >= 0 for s in self.special)

    def long(self, text: str) -> int:
        """Count of a huge text from overlapping chunks."""
        total, start, n = 0, 0, len(text)
        overlap = self.overlap
        while True:
            end = min(n, start + self.chunk)
            while True:
                left = self.starts(text, start, end)
                if end == n:
                    return total + len(left)
                low = max(start + 1, end - overlap)
                right = self.starts(text, low, min(n, end + overlap))
                seen = set(right)
                at = next((p for p in reversed(left) if p > low and p in seen and p < end - 1 and self.stable(text, p)), None)
                if at is not None:
                    break
                overlap *= 2
                end = min(n, end + overlap)  # the chunk grows with the overlap
            total += sum(p < at for p in left)
            start, overlap = at, self.overlap

    def starts(self, text: str, start: int, end: int) -> list[int]:
        """Where the tokens of one chunk start."""
        return [start + a for a, _ in self.tokenizer.encode(text[start:end], add_special_tokens=False).offsets]

    def __call__(self, batch: list[str]) -> list[int]:
        out = [0] * len(batch)
        short = [i for i, t in enumerate(batch) if len(t) <= self.chunk]
        for i, n in zip(short, self.whole([batch[i] for i in short]), strict=True):
            out[i] = n
        for i, t in enumerate(batch):
            if len(t) > self.chunk:
                out[i] = self.long(t)
        return out


def token_counts(docs: DataFrame, path: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    Null and empty texts count zero bytes and tokens. Repeated rows give
    repeated rows. Other columns are not read. The work is narrow, one pass
    over the scan; a lost task is simply run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(path, chunk, overlap)
        for batch in pieces(batches, BATCH_BYTES):
            rows = texts(batch.column(1))
            tokens = count(rows)
            yield pa.record_batch(
                {"doc_id": batch.column(0), "n_bytes": pa.array([len(t.encode()) for t in rows], pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "over_limit": pa.array([n > limit for n in tokens], pa.bool_())}
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())
