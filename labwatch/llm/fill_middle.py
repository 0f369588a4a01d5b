"""Fill-in-the-middle on seekable compressed frames.

A text is stored as independent zstandard frames, each cut between code
points, with the cumulative counts of units (code points) and bytes. A cut
after so many units lies in the frame that a binary search over the counts
finds; only that frame is decompressed to place it. The output is a list of
parts, literal marks and ranges of the stored text: written as frames of its
own, and digested by streaming its frames in order. Restoring reads the output's
frames, finds the marks and streams prefix, middle and suffix. Beside the
compressed frames no more than one frame is held as text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import pieces, table, text_bytes

#: Bytes of text in a frame, bytes of a batch, compression level.
FRAME_BYTES, BATCH_BYTES, LEVEL = 256 << 10, 4 << 20, 1
# The marks, the share of texts left plain, the share of the rest with the suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = re.compile(b"<[PSM]>")
PLAIN_FROM, SPM_BELOW = 90, 20


def unit_starts(data: bytes | np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text begin a code point."""
    return (np.frombuffer(data, np.uint8) & 0xC0) != 0x80


class Frames:
    """Text as compressed frames; ``units`` and ``ends`` count code points and bytes before each frame and at the end."""

    def __init__(self, size: int = FRAME_BYTES):
        self.size, self.frames, self.units, self.ends = max(size, 4), [], [0], [0]  # a code point has 4 bytes at most
        self.open: list[bytes] = []
        self.held = 0
        self.pack, self.unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()

    @classmethod
    def of(cls, data, size: int = FRAME_BYTES) -> Frames:
        out = cls(size)
        out.append(data)
        return out.close()

    def append(self, data) -> None:
        """Add text; ``data`` (bytes or a view of them) must end between code points."""
        view, at = memoryview(data), 0
        while at < len(view):
            end = min(len(view), at + self.size - self.held)
            while at < end < len(view) and view[end] & 0xC0 == 0x80:
                end -= 1  # never inside a code point
            if end > at:
                self.open.append(bytes(view[at:end]))
                self.held += end - at
            if self.held >= self.size or end < len(view):
                self.close()
            at = end

    def close(self) -> Frames:
        if self.held:
            data = b"".join(self.open)
            self.frames.append(self.pack.compress(data))
            self.units.append(self.units[-1] + int(np.count_nonzero(unit_starts(data))))
            self.ends.append(self.ends[-1] + len(data))
            self.open, self.held = [], 0
        return self

    def frame(self, k: int) -> bytes:
        return self.unpack.decompress(self.frames[k], max_output_size=self.ends[k + 1] - self.ends[k])

    def place(self, unit: int) -> int:
        """The byte at which the text after ``unit`` units begins."""
        if unit >= self.units[-1]:
            return self.ends[-1]
        k = bisect_right(self.units, unit) - 1
        inside = unit - self.units[k]
        return self.ends[k] + (int(np.flatnonzero(unit_starts(self.frame(k)))[inside]) if inside else 0)

    def read(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes from ``start`` to ``end``, a frame at a time."""
        end = self.ends[-1] if end is None else end
        k = bisect_right(self.ends, start) - 1
        while start < end:
            data, base = self.frame(k), self.ends[k]
            stop = min(end, self.ends[k + 1])
            yield data[start - base : stop - base]
            start, k = stop, k + 1

    def find(self, mark: bytes, start: int = 0) -> int:
        """Where ``mark`` first stands at or after ``start``, across frames too; -1 if nowhere."""
        tail, at = b"", start
        for data in self.read(start):
            found = (tail + data).find(mark)
            if found >= 0:
                return at - len(tail) + found
            at, tail = at + len(data), (tail + data)[-(len(mark) - 1) :]
        return -1


def digest(parts: Iterable[bytes]) -> str:
    out = hashlib.sha256()
    for part in parts:
        out.update(part)
    return out.hexdigest()


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 that depend on seed and id; a null id draws like the empty string."""
    head = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16]
    return [int.from_bytes(head[i : i + 4], "big") for i in range(0, 16, 4)]


def transform(text: Frames, plain: bool, draw: list[int]) -> tuple[str, int | None, int | None, Frames]:
    """Form, units of prefix and middle (None if plain), and the output's frames."""
    n = text.units[-1]
    if plain or not n or draw[2] % 100 >= PLAIN_FROM:
        return "plain", None, None, text
    low, high = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    p, m = text.place(low), text.place(high)
    form = "spm" if draw[3] % 100 < SPM_BELOW else "psm"
    order = ((SUFFIX, m, None), (PREFIX, 0, p), (MIDDLE, p, m)) if form == "spm" else ((PREFIX, 0, p), (SUFFIX, m, None), (MIDDLE, p, m))
    out = Frames(text.size)
    for mark, start, end in order:
        out.append(mark)
        for data in text.read(start, end):
            # a frame of the output may end where the stored one was cut, between code points
            out.append(data)
    return form, low, high - low, out.close()


def restored(out: Frames, form: str) -> Iterator[bytes]:
    """The text that an output was made of, in order, a frame at a time."""
    if form == "plain":
        yield from out.read()
        return
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    b = out.find(second, len(first))
    m = out.find(MIDDLE, b + len(second))
    lead, follow, middle = (len(first), b), (b + len(second), m), (m + len(MIDDLE), None)
    prefix, suffix = (follow, lead) if form == "spm" else (lead, follow)
    for part in (prefix, middle, suffix):
        yield from out.read(*part)


def fill_middle(docs: DataFrame, text: str = "text", seed: int = 1, frame_bytes: int = FRAME_BYTES, frames: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``form``, lengths, digests, and the output's frames with their cumulative counts.

    ``output_frames`` holds independent zstandard frames, ``output_units`` and
    ``output_bytes`` the code points and bytes before each and at the end;
    ``frames=False`` leaves them out. Null and empty texts have no units and
    are plain; so are texts that hold a mark. A null id is drawn for like an empty one.
    Repeated rows give repeated rows, an empty table none; other columns are
    not read. The work is narrow; a batch is cut by bytes and a text by
    frames, so a very long one holds up nothing but its own task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            rows = []
            raw, offsets = text_bytes(batch.column(1))
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                data = memoryview(raw)[offsets[i] : offsets[i + 1]]
                stored = Frames.of(data, frame_bytes)
                form, prefix, middle, out = transform(stored, MARKS.search(data) is not None, draws(doc_id, seed))
                row = {
                    "doc_id": doc_id, "n": stored.units[-1], "form": form, "prefix_chars": prefix, "middle_chars": middle,
                    "output_sha256": digest(out.read()), "restored_sha256": digest(restored(out, form)), "n_frames": len(stored.frames),
                }
                rows.append(row | {"output_frames": out.frames, "output_units": out.units, "output_bytes": out.ends} if frames else row)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "n_frames"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, n_frames long"
    if frames:
        names, kinds = [*names, "output_frames", "output_units", "output_bytes"], [*kinds, pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        schema += ", output_frames array<binary>, output_units array<long>, output_bytes array<long>"
    arrow = pa.schema(list(zip(names, kinds, strict=True)))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInArrow(run, schema)


def output_text(transformed: DataFrame) -> DataFrame:
    """``doc_id, output`` from the frames of ``fill_middle``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in pieces(batches, BATCH_BYTES):
            rows = [b"".join(unpack.decompress(f, max_output_size=b - a) for f, a, b in zip(frames, ends, ends[1:], strict=False)).decode() for frames, ends in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.record_batch({"doc_id": batch.column(0), "output": pa.array(rows, pa.string())})

    return transformed.select("doc_id", "output_frames", "output_bytes").mapInArrow(run, "doc_id long, output string")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle(table(spark, sf_dir, "documents"), frames=False).drop("n_frames")


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
c AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= {PLAIN_FROM} THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substr(t, 1, least(a, b)) AS prefix, substr(t, least(a, b) + 1, abs(a - b)) AS middle, substr(t, greatest(a, b) + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
