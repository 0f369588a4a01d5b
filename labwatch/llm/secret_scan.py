"""Secret scan: keyword prefilter, anchored expressions near the hits, checksum validation.

One Aho-Corasick automaton walks each text once and reports where a keyword
starts. Only there an expression is tried, anchored, never searched for. Runs
of hexadecimal digits have no keyword; their anchors are every twelfth byte: a
run of 24 covers at least two neighbouring ones, so the few places where two
neighbours are such digits are all that has to be looked at. Tokens with an
embedded checksum are reported only where it fits.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import pieces, table, texts

BATCH_BYTES = 8 << 20

# The three base kinds, in the order in which ties are listed.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: Prefixes of tokens that end in six base-62 digits of the CRC-32 of the 30 before.
CHECKED = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "checked")


def base62(n: int, width: int = 6) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out.rjust(width, "0")


def checksum_fits(body: str) -> bool:
    return base62(zlib.crc32(body[:30].encode())) == body[30:36]


class Scanner:
    """Finds the spans ``(kind, start, end)`` of one text, in code points, end exclusive."""

    def __init__(self):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for word in ASSIGN_WORDS:
            self.words.add_word(word, (len(word), 0))
        self.words.add_word("akia", (4, 1))
        for word in CHECKED:
            self.words.add_word(word, (len(word), 3))
        self.words.make_automaton()
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        self.checked = re.compile("(?:" + "|".join(CHECKED) + ")([0-9A-Za-z]{36})(?![0-9A-Za-z])")
        self.hexdigit = np.zeros(256, bool)
        self.hexdigit[[*range(48, 58), *range(97, 103)]] = True
        self.run = re.compile(rb"[0-9a-f]+")

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        raw = text.encode()
        # lower case of ASCII letters only, so that places stay the same
        low = text.lower() if len(raw) == len(text) else raw.lower().decode()
        out, done = [], [0, 0, 0, 0]
        hits = sorted((end + 1 - n, kind) for end, (n, kind) in self.words.iter(low))
        for at, kind in hits:
            if at < done[kind]:
                continue  # inside the kind's last match
            m = (self.assign, self.access, None, self.checked)[kind].match(text, at)
            if not m:
                continue
            if kind == 3:
                if checksum_fits(m[1]):
                    out.append((at, m.end(), "checked"))
                    done[3] = m.end()
                continue
            done[kind] = m.end()
            if len(m[2]) >= MIN_VALUE if kind == 0 else m.end() - at >= MIN_ACCESS:
                out.append((at, m.end(), KINDS[kind]))
        out += self.hex(raw, len(raw) == len(text))
        return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))

    def hex(self, raw: bytes, ascii_only: bool) -> list[tuple[int, int, str]]:
        step = MIN_HEX // 2
        anchors = self.hexdigit[np.frombuffer(raw, np.uint8)[::step]]
        out, end = [], 0
        for k in np.flatnonzero(anchors[:-1] & anchors[1:]) * step:
            if k < end:
                continue
            start = int(k)
            while start > end and self.hexdigit[raw[start - 1]]:
                start -= 1
            m = self.run.match(raw, start)
            end = m.end()
            if end - start >= MIN_HEX:
                before = start if ascii_only else len(raw[:start].decode())
                out.append((before, before + end - start, "hex"))
        return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, the digest of their spans, and all spans.

    ``spans`` lists ``kind:start:end`` by start, then kind; ``checked`` spans
    (tokens whose embedded checksum fits) are the method's additions. Null and
    empty texts have no span; the digest is then that of the empty string.
    Repeated rows give repeated rows. Only ``doc_id`` and the text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in pieces(batches, BATCH_BYTES):
            found = [scanner.spans(t) for t in texts(batch.column(1))]
            base = [[s for s in row if s[2] != "checked"] for row in found]
            count = lambda kind: pa.array([sum(s[2] == kind for s in row) for row in base], pa.int64())
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0), "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
                    "base_sha256": pa.array([hashlib.sha256(listed(row).encode()).hexdigest() for row in base]),
                    "spans": pa.array([listed(row) for row in found], pa.string()),
                    "n_checked": pa.array([len(a) - len(b) for a, b in zip(found, base, strict=True)], pa.int64()),
                }
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
