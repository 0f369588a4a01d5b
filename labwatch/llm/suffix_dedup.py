"""Removal of repeated passages by suffix arrays.

A byte goes if a string of 50 bytes that covers it also starts in a document
with a smaller id. Three steps:

1. *Anchors.* In every string of 50 bytes the 24-byte part with the least hash
   is its anchor (the first of several). Equal strings have equal anchors at
   the same place, so a string whose anchor occurs in one document alone
   repeats nowhere. Only 32 bits of an anchor's hash are dealt out beside its
   part, one anchor in about 14 bytes; what two hashes share by chance is
   looked at and found not to repeat. Of a small table, a field of bits that
   travels with each task tells which anchors repeat. The texts of a larger
   one, for which no such field is large enough, are dealt to buckets, and each
   bucket gets a bit for each of its anchors.
2. *Shards.* Where an anchor occurs in several documents, the strings it
   anchors are dealt to the anchor's shard with the bytes around it, and after
   them the places where they stand. All copies of a string meet in one shard,
   however many documents there are. Strings of an anchor that occurs too often
   for one shard are dealt one by one instead, by all their bytes.
3. *Suffix arrays.* A shard sorts the suffixes that start a whole string: ranks
   of eight bytes are put together to ranks of 50. Suffixes that share 50 bytes
   with the one before make a group, which gets its least document. A shard
   holds several arrays of bounded size, which are merged by binary search of
   each one's distinct strings in the others' sorted ones. Then its places pass
   by, a block at a time, and take what was found of their strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.bloom import bloom, bloom_places
from labwatch.llm.common import BYTE_BASE, MIX1, MIX2, U64, kept, let_go, mix, pieces, powers, table, text_bytes
from labwatch.llm.shingles import INVERSE

#: Bytes of a passage, of an anchor, of text a task looks at, of an array, of text for each shard, of hashes for each part.
SPAN, ANCHOR = 50, 24
BATCH_BYTES, PART_BYTES, SHARD_BYTES, GROUP_BYTES = 1 << 20, 4 << 20, 4 << 20, 8 << 20
#: Bytes of text up to which a field tells which anchors repeat (it holds what can repeat in 3 times as many). Bytes of a bucket,
#: of stretches a task gathers before it deals them out, of text for each part of the documents.
SMALL_BYTES, BUCKET_BYTES, GATHER_BYTES, DOCUMENT_BYTES = 64 << 20, 8 << 20, 24 << 20, 16 << 20
#: Occurrences of an anchor from which its strings are dealt one by one.
HOT = 20_000
#: In place of an anchor's place: the stretch is one string, dealt by all its bytes.
WHOLE = 255
#: Rows of a shard: stretches, places. Runs of bytes a task gathers before it puts them together by document.
STRETCHES, PLACES = 0, 1
RUNS = 1_000_000
BYTES = mix(np.arange(1, 257, dtype=U64))
LAST = (1 << 63) - 1


def word_keys(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts as they do; zeros stand behind the end."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray((len(raw),), ">u8", padded, strides=(1,)).astype(U64)


def suffix_array(raw: np.ndarray, at: np.ndarray | None = None, most: int = 8) -> np.ndarray:
    """All suffixes in order, or those at some places, by their first ``most`` bytes, all of which stand in the text.

    The first pass sorts by eight bytes. For some places, ranks of eight bytes
    are put side by side, as many as a number holds, and ranked again until
    they reach over ``most``. For all of them, each later pass doubles what is
    compared: a suffix's rank and the rank of the one so many bytes further on
    decide, and only groups that are not sorted yet are touched.
    """
    n = len(raw)
    key = word_keys(raw)
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    if at is not None:
        rank[order] = np.cumsum(new) - 1
        bits = int(rank[order[-1]]).bit_length()
        both, used = rank[at], bits
        for k in (*range(8, most - 8, 8), most - 8):
            if used + bits > 63:
                order = np.argsort(both)
                step = np.zeros(len(at), np.int64)
                step[1:] = both[order][1:] != both[order][:-1]
                both[order] = np.cumsum(step)
                used = int(both[order[-1]]).bit_length()
            both, used = both << bits | rank[at + k], used + bits
        return at[np.argsort(both)]
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    done = 8
    while True:
        # places in the order whose group has more than one member
        head = np.flatnonzero(new)
        size = np.diff(np.r_[head, n])
        open_ = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_):
            return order
        at = order[open_]
        further = at + done
        second = np.where(further < n, rank[np.minimum(further, n - 1)], -1 - at)  # past the end the shorter suffix is the lesser
        both = rank[at] << 32 | second + n  # ranks and places of a shard need less than 31 bits
        resort = np.argsort(both)
        at, both = at[resort], both[resort]
        order[open_] = at
        differs = np.ones(len(at), bool)
        differs[1:] = both[1:] != both[:-1]
        new[open_] = differs
        rank[at] = open_[np.flatnonzero(differs)[np.cumsum(differs) - 1]]
        done *= 2


def common_prefixes(raw: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in the order, the bytes its suffix shares with the one before, ``most`` at most."""
    n = len(raw)
    key = np.concatenate([word_keys(raw), np.zeros(1, U64)])
    common = np.zeros(len(order), np.int64)
    grow, done = np.arange(1, len(order)), 0
    while len(grow) and done < most:
        a, b = order[grow] + done, order[grow - 1] + done
        unlike = key[a] ^ key[b]
        # bytes that eight have in common from the front, none beyond the end or ``most``
        # (a number whose second bit is cleared isn't rounded up to the next power of two)
        equal = (64 - np.frexp((unlike & ~(unlike >> U64(1))).astype(np.float64))[1]) >> 3
        equal = np.minimum(equal, np.minimum(n - np.maximum(a, b), most - done))
        common[grow] += equal
        grow, done = grow[equal == 8], done + 8
    return common


def anchor_codes(key: np.ndarray, at: np.ndarray | slice, salt: int) -> np.ndarray:
    """Hashes of the anchors at some places, from all word keys and as many behind them."""
    n = len(key)
    code = np.full(n - ANCHOR + 8 if isinstance(at, slice) else len(at), U64(salt))
    for k in range(0, ANCHOR, 8):
        code ^= key[k : k + len(code)] if isinstance(at, slice) else key[at + k]
        code *= MIX1
        code ^= code >> U64(29)
    return code


def anchors(key: np.ndarray, offsets: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """``(start, anchor)``: every place where a string of ``span`` bytes starts within its row, and where its anchor is."""
    n = len(key)
    empty = np.zeros(0, np.int64)
    if n < span:
        return empty, empty
    # a hash in the upper half, the place in the lower one: the least of the next `width` is the first of the least hashes
    value = (anchor_codes(key, slice(None), 1) * MIX2)[: n - ANCHOR + 1]
    value &= U64(0xFFFFFFFF00000000)
    value |= np.arange(len(value), dtype=U64)
    width, have = span - ANCHOR + 1, 1
    while have < width:
        step = min(have, width - have)
        value = np.minimum(value[:-step], value[step:])
        have += step
    inside = np.ones(n - span + 1, bool)
    ends = offsets[1:]
    # the last span - 1 places of a row start nothing whole
    first = np.maximum(ends - span + 1, offsets[:-1])
    late = np.zeros(n + 1, np.int32)
    np.add.at(late, first, 1)
    np.add.at(late, ends, -1)
    inside = np.cumsum(late[: n - span + 1]) == 0
    starts = np.flatnonzero(inside)
    return starts, (value[starts] & U64(0xFFFFFFFF)).astype(np.int64)


def anchored(key: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, anchor``: where the neighbouring strings with one anchor start, and where it is."""
    start, at = anchors(key, offsets)
    head = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    return start[head], start[np.r_[head[1:], len(at)] - 1] if len(at) else head, at[head]


def dealt_codes(key: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
    """The bits that are dealt out of the hashes of some anchors."""
    return (anchor_codes(key, at, 2) >> U64(32 - bits)).view(np.int64)


#: What is known of an anchor in a batch: whether two documents hold it, and how often it occurs, from 64 on the power of two below.
TWO, OFTEN = 128, 127
TIMES = np.r_[np.arange(64), 1 << np.arange(6, 63)]


def counted(code: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """The parts that some anchors are dealt to, with the rest of each one's hash, once and in order, and what is known of it; rows ascend."""
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    head = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    count = np.diff(np.r_[head, len(code)])
    # rows ascend within a code, so the first and the last tell whether they differ
    two = row[head] != row[head + count - 1]
    mark = (np.searchsorted(TIMES, count, side="right") - 1 + np.where(two, TWO, 0)).astype(np.uint8)
    code = code[head]
    part, rest = code >> 32, code.astype("<u4")
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)] if len(part) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    return part[cuts[:-1]], [rest[a:b].tobytes() for a, b in spans], [mark[a:b].tobytes() for a, b in spans]


def dealt_bits(total: int) -> int:
    """Bits of the hash that choose the part; with the 32 dealt out, one hash in some thousands is another's by chance, at any size."""
    return max(4, int(np.ceil(np.log2(max(1.0, total * 5 / 14 / GROUP_BYTES)))))


def repeated_anchors(docs: DataFrame, text: str, total: int, most: int = HOT) -> DataFrame:
    """``code long, hot boolean``: hashes, cut to the bits dealt out, of the anchors that occur in two documents at least."""
    bits = dealt_bits(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            raw, offsets = text_bytes(batch.column(1))
            key = word_keys(raw)
            _, _, at = anchored(key, offsets)
            part, codes, marks = counted(dealt_codes(key, at, bits), np.searchsorted(offsets, at, side="right") - 1)
            yield pa.record_batch({"part": pa.array(part, pa.int64()), "codes": pa.array(codes, pa.binary()), "marks": pa.array(marks, pa.binary())})

    def both(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, seen, often, part = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def reduced() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Each code once, with the documents known of it (two at most) and its occurrences."""
            codes = np.concatenate([code, *(c for c, _ in held)])
            documents = np.concatenate([seen, *((m >> 7) + 1 for _, m in held)])
            times = np.concatenate([often, *(TIMES[m & OFTEN] for _, m in held)])
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            head = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            return codes[head], np.minimum(np.add.reduceat(documents[order], head), 2), np.add.reduceat(times[order], head)

        for batch in group:
            part = batch.column(0)[0].as_py()
            for c, m in zip(batch.column(1), batch.column(2), strict=True):
                held.append((np.frombuffer(c.as_buffer(), "<u4").astype(np.int64), np.frombuffer(m.as_buffer(), np.uint8).astype(np.int64)))
                size += len(held[-1][0])
            if size > max(4_000_000, len(code)):
                code, seen, often = reduced()
                held, size = [], 0
        code, seen, often = reduced()
        found = seen > 1
        yield pa.record_batch({"code": pa.array((part << 32) + code[found], pa.int64()), "hot": pa.array(often[found] > most, pa.bool_())})

    return dealt(docs, text, run, "part long, codes binary, marks binary").groupBy("part").applyInArrow(both, "code long, hot boolean")


def dealt(docs: DataFrame, text: str, run, schema: str) -> DataFrame:
    return numbered(docs, text).select("d", "text", "th").mapInArrow(run, schema)


def numbered(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id, d, th, text``; ``d`` puts rows without an id last, ``th`` tells rows that share an id apart."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(whole).alias("th"), whole.alias("text"))


def in_field(field: np.ndarray, ids: np.ndarray) -> np.ndarray:
    places = bloom_places(ids, len(field) * 8)
    return (field[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).all(0)


def contexts(docs: DataFrame, text: str, bits: int, filtered: np.ndarray, hot: np.ndarray, parts: int) -> tuple[DataFrame, DataFrame]:
    """The distinct stretches of bytes that hold strings with a repeated anchor, and where they stand.

    Neighbouring strings with one anchor make one stretch; a string of a hot
    anchor is a stretch of its own. Two hashes name a stretch: of its anchor
    and of all its bytes, or two of the whole string. The first frame has for
    all that a task gathers (``block``) and each part a row with stretches and
    one with the places that refer to them, ``part, kind, block, data``, both
    packed; the second one the stretches alone, ``part, stretches``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(parts)
        for batch in pieces(batches, BATCH_BYTES):
            raw, offsets = text_bytes(batch.column(1))
            key = word_keys(raw)
            first, last, at = anchored(key, offsets)
            code = dealt_codes(key, at, bits)
            maybe = in_field(filtered, code)
            blocks.add(raw, key, offsets, batch.column(0).to_numpy(), batch.column(2).to_numpy(), *stretches(first, last, at, maybe, in_field(hot, code)))
            if blocks.size > GATHER_BYTES:
                yield blocks.out()
        if blocks.size:
            yield blocks.out()

    dealt_out = dealt(docs, text, run, "part long, kind int, block long, data binary")
    return dealt_out, dealt_out.filter(F.col("kind") == STRETCHES).select("part", F.col("data").alias("stretches"))


def compressed(texts: pa.Array) -> list[bytes]:
    """Each text as a compressed block."""
    pack = zstandard.ZstdCompressor(level=1)
    return [pack.compress(x.as_buffer()) for x in texts.cast(pa.binary())]


def bucketed(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """``bucket, d, th, text``: texts that hold a whole string, packed; rows with one id and text share a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"bucket": batch.column(0), "d": batch.column(1), "th": batch.column(2), "text": pa.array(compressed(batch.column(3)), pa.binary())})

    rows = numbered(docs, text).filter(F.octet_length("text") >= SPAN)
    return rows.select(F.pmod(F.xxhash64("d", "th"), F.lit(buckets)).alias("bucket"), "d", "th", "text").mapInArrow(run, "bucket long, d long, th long, text binary")


def bucket_texts(rows: Iterable[tuple]) -> Iterator[tuple[np.ndarray, ...]]:
    """``raw, offsets, d, th`` of a bucket's packed texts, a batch at a time; rows with one id and text count once."""
    seen: set[tuple[int, int]] = set()
    held: list[bytes] = []
    own: list[tuple[int, int]] = []
    size, unpack = 0, zstandard.ZstdDecompressor()

    def out() -> tuple[np.ndarray, ...]:
        d, th = np.array(own, np.int64).T
        return np.frombuffer(b"".join(held), np.uint8), np.r_[0, np.cumsum([len(x) for x in held])], d, th

    for d, th, data in rows:
        if (d, th) in seen:
            continue
        seen.add((d, th))
        own.append((d, th))
        held.append(unpack.decompress(data.as_buffer()))
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield out()
            held, own, size = [], [], 0
    if held:
        yield out()


def repeated_in_buckets(texts: DataFrame, bits: int, most: int = HOT) -> DataFrame:
    """``bucket, part, n, bits``: for the anchors of a bucket that are dealt to a part, in the order of their hashes, which of
    them occur in two documents at least; behind them, if any of them does, which occur too often."""

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, row, bucket, rows = [], [], 0, 0

        def texts_() -> Iterator[tuple]:
            nonlocal bucket
            for batch in group:
                bucket = batch.column(0)[0].as_py()
                yield from zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True)

        for raw, offsets, d, _ in bucket_texts(texts_()):
            key = word_keys(raw)
            _, _, at = anchored(key, offsets)
            code.append(dealt_codes(key, at, bits))
            row.append(rows + np.searchsorted(offsets, at, side="right") - 1)
            rows += len(d)
        part, codes, marks = counted(np.concatenate(code), np.concatenate(row))
        yield pa.record_batch({"part": pa.array(part, pa.int64()), "bucket": pa.array(np.full(len(part), bucket)), "codes": pa.array(codes, pa.binary()), "marks": pa.array(marks, pa.binary())})

    def both(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, buckets, codes, marks = 0, [], [], []
        for batch in group:
            part = batch.column(0)[0].as_py()
            buckets.append(batch.column(1).to_numpy())
            codes += [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(2)]
            marks += [np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(3)]
        bucket, n, code, mark = np.concatenate(buckets), np.array([len(x) for x in codes]), np.concatenate(codes), np.concatenate(marks)
        order = np.argsort(code, kind="stable")
        head = np.flatnonzero(np.r_[True, code[order][1:] != code[order][:-1]])
        count = np.diff(np.r_[head, len(code)])
        found, hot = np.empty((2, len(code)), bool)
        found[order] = np.repeat(np.add.reduceat((mark[order] >> 7) + np.int64(1), head) > 1, count)
        hot[order] = np.repeat(np.add.reduceat(TIMES[mark[order] & OFTEN], head) > most, count)
        ends = np.cumsum(n)
        data = [np.packbits(found[a:b]).tobytes() + (np.packbits(hot[a:b]).tobytes() if hot[a:b].any() else b"") for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
        yield pa.record_batch({"bucket": pa.array(bucket), "part": pa.array(np.full(len(n), part)), "n": pa.array(n, pa.int64()), "bits": pa.array(data, pa.binary())})

    codes = texts.groupBy("bucket").applyInArrow(run, "part long, bucket long, codes binary, marks binary")
    return codes.groupBy("part").applyInArrow(both, "bucket long, part long, n long, bits binary")


def bucket_contexts(texts: DataFrame, bits: int, repeated: DataFrame, parts: int) -> DataFrame:
    """The first frame of ``contexts`` from the texts of buckets and what was found of their anchors."""

    def marks(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        found, hot = [np.zeros(0, bool)], [np.zeros(0, bool)]
        for _, _, _, n, data in rows:
            x, size = np.frombuffer(data.as_buffer(), np.uint8), (n + 7) // 8
            found.append(np.unpackbits(x[:size], count=n).view(bool))
            hot.append(np.unpackbits(x[size:], count=n).view(bool) if len(x) > size else np.zeros(n, bool))
        return np.concatenate(found), np.concatenate(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(parts)
        rows = (r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True))
        for _, group in groupby(rows, lambda r: r[0]):
            of_kind: tuple[list, list] = ([], [])
            for r in group:
                of_kind[r[1]].append(r)
            found, hot = marks(of_kind[0])
            held = []
            for raw, offsets, d, th in bucket_texts(r[2:] for r in of_kind[1]):
                key = word_keys(raw)
                first, last, at = anchored(key, offsets)
                held.append((raw, offsets, d, th, first, last, at, dealt_codes(key, at, bits)))
            codes, number = np.unique(np.concatenate([x[-1] for x in held]), return_inverse=True)
            if len(codes) != len(found):  # the rows aren't those that were there before
                found, hot = np.ones(len(codes), bool), np.zeros(len(codes), bool)
            for raw, offsets, d, th, first, last, at, code in held:
                own, number = number[: len(code)], number[len(code) :]
                blocks.add(raw, word_keys(raw), offsets, d, th, *stretches(first, last, at, found[own], hot[own]))
                if blocks.size > GATHER_BYTES:
                    yield blocks.out()
        if blocks.size:
            yield blocks.out()

    both = repeated.select("bucket", F.lit(0).alias("kind"), F.col("part").alias("d"), F.col("n").alias("th"), F.col("bits").alias("data"))
    both = both.unionByName(texts.select("bucket", F.lit(1).alias("kind"), "d", "th", F.col("text").alias("data")))
    return both.repartition("bucket").sortWithinPartitions("bucket", "kind", "d").mapInArrow(run, "part long, kind int, block long, data binary")


def stretches(first: np.ndarray, last: np.ndarray, at: np.ndarray, maybe: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, end, place`` of the stretches whose anchor may repeat; strings of a hot one stand alone."""
    first, last, at, alone = first[maybe], last[maybe], at[maybe], hot[maybe]
    count = np.where(alone, last - first + 1, 1)
    which = np.repeat(np.arange(len(first)), count)
    begin = first[which] + np.arange(len(which)) - (np.cumsum(count) - count)[which]
    return begin, np.where(alone[which], begin, last[which]) + SPAN, np.where(alone[which], WHOLE, at[which] - begin)


class Blocks:
    """The stretches that a task gathers, each once, and where they stand; dealt out together, so that each part gets few rows."""

    def __init__(self, parts: int):
        self.parts, self.blocks = parts, TaskContext.get().partitionId() << 32
        self.clear()

    def clear(self) -> None:
        self.text: list[bytes] = []
        self.named: list[tuple[np.ndarray, ...]] = []
        self.stand: list[tuple[np.ndarray, ...]] = []
        self.documents: list[tuple[np.ndarray, ...]] = []
        self.size = self.n = self.rows = 0

    def add(self, raw: np.ndarray, key: np.ndarray, offsets: np.ndarray, d: np.ndarray, th: np.ndarray, first: np.ndarray, end: np.ndarray, place: np.ndarray) -> None:
        if not len(first):
            return
        code, ctx = names(raw, key, first, end, place)
        row = np.searchsorted(offsets, first, side="right") - 1
        one, which = least_of_each(code, ctx, d[row])
        data = raw.tobytes()
        self.text.append(b"".join([data[a:b] for a, b in zip(first[one].tolist(), end[one].tolist(), strict=True)]))
        self.named.append((code[one], ctx[one], d[row[one]], (end - first)[one], place[one]))
        self.stand.append((self.rows + row, first - offsets[row], self.n + which))
        self.documents.append((d, th))
        self.size += len(self.text[-1]) + 40 * len(one) + 24 * len(row)
        self.n += len(one)
        self.rows += len(d)

    def out(self) -> pa.RecordBatch:
        """``part, kind, block, data``; then it is empty."""
        (code, ctx, low, size, place), (row, start, number), (d, th) = ([np.concatenate(x) for x in zip(*held, strict=True)] for held in (self.named, self.stand, self.documents))
        data, ends, block = b"".join(self.text), np.cumsum(size), self.blocks
        self.clear()
        self.blocks += 1
        one, which = least_of_each(code, ctx, low)
        # by part, each stretch with its number there
        part = (code[one] % U64(self.parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        one, part = one[order], part[order]
        cuts = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        number = at[which[number]]
        within = np.argsort(number, kind="stable")
        edges = np.searchsorted(number[within], cuts)
        own = []
        for a, b, c, e in zip(cuts[:-1], cuts[1:], edges[:-1], edges[1:], strict=True):
            x, y = one[a:b], np.sort(within[c:e])
            own.append(packed(data, low[x], ends[x] - size[x], ends[x], place[x]))
            own.append(places(row[y], start[y], number[y] - a, d, th))
        ids = pa.array(np.repeat(part[cuts[:-1]], 2))
        return pa.record_batch({"part": ids, "kind": pa.array([STRETCHES, PLACES] * (len(cuts) - 1), pa.int32()), "block": pa.array(np.full(len(ids), block)), "data": pa.array(own, pa.binary())})


def places(row: np.ndarray, start: np.ndarray, number: np.ndarray, d: np.ndarray, th: np.ndarray) -> bytes:
    """Places in documents as one compressed block: how many documents and places, the documents, then each place's document, start, number."""
    new = np.r_[True, row[1:] != row[:-1]]
    own = row[new]
    numbers = (np.array([len(own), len(row)]), d[own], th[own])
    small = (np.cumsum(new) - 1, start, number)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*(x.astype("<i8").tobytes() for x in numbers), *(x.astype("<u4").tobytes() for x in small)]))


def unpacked(block: pa.Buffer) -> tuple[np.ndarray, ...]:
    """``d, th`` of the documents and ``row, start, number`` of the places."""
    x = zstandard.ZstdDecompressor().decompress(block)
    rows, n = np.frombuffer(x, "<i8", 2)
    return (*np.frombuffer(x, "<i8", 2 * rows, 16).reshape(2, rows), *np.frombuffer(x, "<u4", 3 * n, 16 + 16 * rows).astype(np.int64).reshape(3, n))


def names(raw: np.ndarray, key: np.ndarray, first: np.ndarray, end: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``code, ctx`` of stretches, from where their anchors are in them (``WHOLE``: dealt by all bytes)."""
    base = powers(BYTE_BASE, len(raw))
    total = np.zeros(len(raw) + 1, U64)
    np.cumsum(BYTES[raw] * base[:-1], out=total[1:])
    ctx = mix((total[end] - total[first]) * powers(INVERSE, len(raw))[first] ^ mix((end - first).astype(U64)))
    by_all = place == WHOLE
    code = anchor_codes(key, np.where(by_all, first, first + place), 2)
    if by_all.any():
        own = np.full(int(by_all.sum()), U64(3))
        for k in span_keys(key, first[by_all]):
            own = mix(own ^ k) * MIX1
        code[by_all] = own
    return code, ctx


def packed(data: bytes, low: np.ndarray, first: np.ndarray, end: np.ndarray, place: np.ndarray) -> bytes:
    """Stretches as one compressed block: their number, documents, sizes, anchors' places, bytes."""
    text = b"".join([data[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)])
    numbers = (np.array([len(low)]), low, end - first)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype("<i8").tobytes() for x in numbers) + place.astype(np.uint8).tobytes() + text)


class Stretches:
    """Stretches side by side: bytes, sizes, ends in the bytes, least documents, places of anchors."""

    def __init__(self, blocks: list[bytes]):
        low, size, place, text = [], [], [], []
        for block in blocks:
            x = zstandard.ZstdDecompressor().decompress(block)
            n = int.from_bytes(x[:8], "little")
            low.append(np.frombuffer(x, "<i8", n, 8))
            size.append(np.frombuffer(x, "<i8", n, 8 + 8 * n))
            place.append(np.frombuffer(x, np.uint8, n, 8 + 16 * n))
            text.append(np.frombuffer(x, np.uint8, -1, 8 + 17 * n))
        self.counts = [len(x) for x in low]
        self.low, self.size, self.place, self.raw = (np.concatenate(x) for x in (low, size, place, text))
        self.ends = np.cumsum(self.size)

    def once(self) -> tuple[bytes, np.ndarray]:
        """Packed again, each stretch with its least document; and which of these each stretch is."""
        code, ctx = names(self.raw, word_keys(self.raw), self.ends - self.size, self.ends, self.place)
        one, which = least_of_each(code, ctx, self.low)
        return packed(self.raw.tobytes(), self.low[one], (self.ends - self.size)[one], self.ends[one], self.place[one]), which


def least_of_each(code: np.ndarray, ctx: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place with the least document for each stretch, and which of these each place has."""
    order = np.lexsort((low, ctx, code))
    new = np.r_[True, (ctx[order][1:] != ctx[order][:-1]) | (code[order][1:] != code[order][:-1])]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def span_keys(key: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The ``SPAN`` bytes from each place on as numbers that compare as they do."""
    return [key[at + k] for k in (*range(0, SPAN - 8, 8), SPAN - 8)]


def found_at(there: list[np.ndarray], keys: list[np.ndarray]) -> np.ndarray:
    """Where each key stands in sorted ones, -1 if it doesn't (binary search for all keys at a time)."""
    n = len(keys[0])
    low, high = np.zeros(n, np.int64), np.full(n, len(there[0]))
    while (low < high).any():
        mid = (low + high) // 2
        at = np.minimum(mid, len(there[0]) - 1)
        less, equal = np.zeros(n, bool), np.ones(n, bool)
        for a, b in zip(there, keys, strict=True):
            less |= equal & (a[at] < b)
            equal &= a[at] == b
        step = low < high
        low = np.where(step & less, mid + 1, low)
        high = np.where(step & ~less, mid, high)
    at = np.minimum(low, len(there[0]) - 1)
    same = low < len(there[0])
    for a, b in zip(there, keys, strict=True):
        same &= a[at] == b
    return np.where(same, at, -1)


def least_documents(texts_: list[bytes], low: np.ndarray, most: int = PART_BYTES) -> list[np.ndarray]:
    """For each string of ``SPAN`` bytes of each stretch, the least document among all stretches that hold it."""
    sizes = np.array([len(t) for t in texts_])
    values = least_of_strings(np.frombuffer(b"".join(texts_), np.uint8), sizes, low, most)
    return np.split(values, np.cumsum(sizes - SPAN + 1)[:-1])


def least_of_strings(raw: np.ndarray, sizes: np.ndarray, low: np.ndarray, most: int = PART_BYTES) -> np.ndarray:
    """The same for stretches one after another, all their strings in order.

    Stretches are put into arrays of ``most`` bytes at most (one stretch at
    least); the arrays are merged by binary search.
    """
    ends = np.cumsum(sizes)
    cuts = np.r_[np.flatnonzero(np.diff((ends - 1) // most, prepend=-1)), len(sizes)]
    arrays = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own, counts = raw[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b] - SPAN + 1
        # places where a whole string starts, the only suffixes that count
        at = np.arange(counts.sum()) + np.repeat((SPAN - 1) * np.arange(b - a), counts)
        document = np.zeros(len(own), np.int64)
        document[at] = np.repeat(low[a:b], counts)
        order = suffix_array(own, at, SPAN)
        head = np.flatnonzero(common_prefixes(own, order, SPAN) < SPAN)
        least = np.minimum.reduceat(document[order], head)
        arrays.append((at, order, np.diff(np.r_[head, len(order)]), least, span_keys(word_keys(own), order[head]) if len(cuts) > 2 else []))
    out = []
    for i, (at, order, count, least, keys) in enumerate(arrays):
        merged = least.copy()
        for j, other in enumerate(arrays):
            if i != j:
                found = found_at(other[4], keys)
                merged = np.where(found >= 0, np.minimum(merged, other[3][found]), merged)
        value = np.zeros(order.max() + 1, np.int64)
        value[order] = np.repeat(merged, count)
        out.append(value[at])
    return np.concatenate(out)


class Shard:
    """Stretches of a part, copies put together as they come, then what was found of their strings."""

    def __init__(self, part: int):
        self.part = part
        self.blocks: list[int] = []
        self.new: list[bytes] = []
        self.size = 0
        #: Stretches without copies, packed; for each block, where its stretches begin in ``slot``, which names them there.
        self.single: bytes | None = None
        self.begin: dict[int, int] = {}
        self.slot = np.zeros(0, np.int32)
        self.runs: tuple[np.ndarray, ...] | None = None

    def add(self, block: int, data: bytes) -> None:
        self.blocks.append(block)
        self.new.append(data)
        self.size += len(data)
        if self.size > 2 * len(self.single or b"") + PART_BYTES:
            self.put_together()

    def put_together(self) -> Stretches:
        """All stretches so far; copies from many batches don't pile up."""
        held = Stretches(([self.single] if self.single else []) + self.new)
        counts = held.counts[1:] if self.single else held.counts
        before = held.counts[0] if self.single else 0
        self.begin.update(zip(self.blocks, (len(self.slot) + np.cumsum(counts) - counts).tolist(), strict=True))
        self.single, which = held.once()
        self.slot = np.concatenate([which[self.slot], which[before:]]).astype(np.int32)
        self.blocks, self.new, self.size = [], [], 0
        return held

    def judge(self) -> None:
        """For each stretch the runs of its strings with one least document: where its runs begin, then first string, number of strings, document."""
        if self.new:
            self.put_together()
        rows = Stretches([self.single])
        least, counts = least_of_strings(rows.raw, rows.size, rows.low), rows.size - SPAN + 1
        begins = np.cumsum(counts) - counts
        new = np.r_[True, least[1:] != least[:-1]]
        new[begins] = True
        head = np.flatnonzero(new)
        first = np.searchsorted(head, begins)
        self.runs = np.r_[first, len(head)], head - np.repeat(begins, np.diff(np.r_[first, len(head)])), np.diff(np.r_[head, len(least)]), least[head]

    def removed(self, block: int, data: pa.Buffer) -> tuple[np.ndarray, ...]:
        """``d, th, start, end``: the runs of bytes that go at a block's places."""
        if self.runs is None:
            self.judge()
        d, th, row, start, number = unpacked(data)
        begins, at, strings, low = self.runs
        own = self.slot[self.begin[block] + number]
        count = begins[own + 1] - begins[own]
        run = np.arange(count.sum()) + np.repeat(begins[own] - np.cumsum(count) + count, count)
        row, start = np.repeat(row, count), np.repeat(start, count) + at[run]
        gone = low[run] < d[row]
        row, start, run = row[gone], start[gone], run[gone]
        return d[row], th[row], start, start + strings[run] - 1 + SPAN


def together(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """``d, th`` of the documents and ``row, start, end`` of their runs, those that touch being one, from ``d, th, start, end`` of many."""
    d, th, start, end = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((th, d))
    d, th = d[order], th[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (th[1:] != th[:-1])]
    # texts have less than 2 GB: documents stand far apart on one line
    apart = (np.cumsum(new) - 1) << 32
    runs = union(np.column_stack([start[order] + apart, end[order] + apart]))
    return d[new], th[new], runs[:, 0] >> 32, runs[:, 0] & 0xFFFFFFFF, runs[:, 1] & 0xFFFFFFFF


def judged(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """``part, runs``: runs of bytes that go, packed for parts of the documents. Rows come by shard, stretches before places."""
    shard = Shard(-1)
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> pa.RecordBatch:
        d, th, row, start, end = together(held)
        part = ((mix(d.view(U64)) ^ th.view(U64)) % U64(parts)).astype(np.int64)[row]
        order = np.argsort(part, kind="stable")
        part, row, start, end = part[order], row[order], start[order], end[order]
        cuts = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
        blocks = [places(row[a:b], start[a:b], end[a:b], d, th) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.record_batch({"part": pa.array(part[cuts[:-1]]), "runs": pa.array(blocks, pa.binary())})

    size = 0
    for batch in batches:
        for part, kind, block, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
            if part != shard.part:
                shard = Shard(part)
            if kind == STRETCHES:
                shard.add(block, data.as_py())
                continue
            held.append(shard.removed(block, data.as_buffer()))
            size += len(held[-1][0])
            if size > RUNS:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def by_document(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``d, th, runs``: the maximal runs of each document of a part, as pairs ``(start, end)``."""
    held: list[tuple[np.ndarray, ...]] = []
    size = least = 0

    def add(d: np.ndarray, th: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        held.append((d[row], th[row], start, end))

    for batch in group:
        for block in batch.column(1):
            add(*unpacked(block.as_buffer()))
            size += len(held[-1][0])
            if size > 2 * least + RUNS:
                one = together(held)
                held.clear()
                add(*one)
                size = least = len(held[0][0])
    d, th, row, start, end = together(held)
    first = np.searchsorted(row, np.arange(len(d) + 1)).tolist()
    data = np.column_stack([start, end]).astype("<i8").tobytes()
    for at in range(0, len(d), 4096):
        cut = first[at : at + 4097]
        runs = [data[16 * a : 16 * b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.record_batch({"d": pa.array(d[at : at + 4096]), "th": pa.array(th[at : at + 4096]), "runs": pa.array(runs, pa.binary())})


def union(runs: np.ndarray) -> np.ndarray:
    """Maximal runs of a set of ``(start, end)``; runs that touch are one."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    head = np.r_[True, runs[1:, 0] > reach[:-1]]
    last = np.r_[np.flatnonzero(head)[1:] - 1, len(runs) - 1]
    return np.column_stack([runs[head, 0], reach[last]])


def repeats(docs: DataFrame, text: str = "text", most: int = HOT) -> DataFrame:
    """``d, th, runs binary``: the maximal runs of bytes that go, for each document that loses any."""
    total = numbered(docs, text).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, parts = dealt_bits(total), max(16, -(-total // SHARD_BYTES))
    if total <= SMALL_BYTES:
        codes = kept(repeated_anchors(docs, text, total, most))
        filtered = bloom(codes.select("code"), codes.count())
        hot = codes.filter("hot").select("code")
        dealt_out, _ = contexts(docs, text, bits, filtered, bloom(hot, hot.count()), parts)
    else:
        texts = bucketed(docs, text, -(-total // BUCKET_BYTES))
        repeated = kept(repeated_in_buckets(texts, bits, most))
        let_go(docs.sparkSession, wait=True)  # of the texts, which are dealt out once more
        dealt_out = bucket_contexts(texts, bits, repeated, parts)
    to = max(16, -(-total // DOCUMENT_BYTES))
    runs = dealt_out.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(partial(judged, parts=to), "part long, runs binary")
    return runs.groupBy("part").applyInArrow(by_document, "d long, th long, runs binary")


def suffix_dedup(docs: DataFrame, text: str = "text", texts_kept: bool = False, most: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, with ``texts_kept`` also ``kept_bytes``.

    ``kept_bytes`` is binary, as a removal may cut a character. Documents with
    less than 50 bytes, empty and null texts lose nothing. Rows with equal ids
    don't take bytes from one another; rows without an id come last. Repeated
    rows give repeated rows; an empty table gives none; other columns are not
    read.
    """
    gone = kept(repeats(docs, text, most))
    let_go(docs.sparkSession, wait=True)  # of the shards, before texts are dealt out
    field = bloom(gone.select("th"), gone.count())

    def maybe(th: pa.Array) -> np.ndarray:
        return in_field(field, th.to_numpy())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x.as_buffer().to_pybytes() for x in batch.column(3).cast(pa.binary())]
            yield pa.record_batch({"doc_id": batch.column(0), "d": batch.column(1), "th": batch.column(2), "n_bytes": pa.array([len(x) for x in data], pa.int64()), "all_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string())})

    def affected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(maybe(batch.column(1))))
            yield pa.record_batch({"d": batch.column(0), "th": batch.column(1), "text": pa.array(compressed(batch.column(2)), pa.binary())})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_removed, n_spans, digest, left = [], [], [], []
            for x, r in zip(batch.column(2), batch.column(3), strict=True):
                runs, data = np.frombuffer(r.as_buffer(), "<i8").reshape(-1, 2), zstandard.ZstdDecompressor().decompress(x.as_buffer())
                edge = [0, *runs.ravel().tolist(), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True))
                n_removed.append(len(data) - len(rest))
                n_spans.append(len(runs))
                digest.append(hashlib.sha256(rest).hexdigest())
                left.append(rest if texts_kept else None)
            yield pa.record_batch({"d": batch.column(0), "th": batch.column(1), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "sha": pa.array(digest, pa.string()), "left": pa.array(left, pa.binary())})

    rows = numbered(docs, text)
    base = rows.mapInArrow(whole, "doc_id long, d long, th long, n_bytes long, all_sha256 string")
    hit = rows.select("d", "th", "text").mapInArrow(affected, "d long, th long, text binary").join(gone, ["d", "th"])
    changed = hit.mapInArrow(cut, "d long, th long, n_removed long, n_spans long, sha string, left binary").dropDuplicates(["d", "th"])
    out = base.join(changed, ["d", "th"], "left")
    zero = F.lit(0).cast("long")
    out = out.select("doc_id", "d", "th", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "all_sha256").alias("kept_sha256"), "left")
    if not texts_kept:
        return out.drop("d", "th", "left")
    bytes_ = rows.select("d", "th", "text").dropDuplicates(["d", "th"])
    return out.join(bytes_, ["d", "th"]).withColumn("kept_bytes", F.coalesce("left", F.col("text").cast("binary"))).drop("d", "th", "left", "text")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))
