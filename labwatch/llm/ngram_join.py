"""N-gram Jaccard join in metric space.

The Jaccard distance is a metric, and sets of shingles of any kind may serve
as its pivots. The join uses two kinds.

* Shingles. A document belongs to the regions of its first shingles, rare ones
  first: as many as two sets at distance 0.2 can differ by, plus some. Linked
  documents share as many as were added, and a rare shingle's region holds a
  few documents at most.
* Documents. Where common shingles are left among a document's first ones, it
  stands in a dense part of the space. Dense documents are dealt to the
  Voronoi regions of document pivots; the triangle inequality tells which
  documents beyond the border a region needs (its window). Regions that are
  still large are split again while that parts them, and what doesn't separate
  is joined block by block. No pair is given up anywhere.

Texts with equal sets are one class from the start. Pivots that share a least
hash with many documents link most near copies first; from then on only pairs
of different components are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch.llm.bloom import bloom, bloom_places
from labwatch.llm.common import U64, kept, lean, mix, pieces, table, written
from labwatch.llm.shingles import shingle_sets

#: Link two documents when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Documents that a rare shingle's region may hold, common shingles that are told apart (the most common ones).
RARE, COMMON = 16, 1_000_000
#: A document looks at one more of its first shingles for every so many it has, and has to share as many more.
MORE = 10
#: Least hashes of a document, how many a document pivot shares, pivots of a split.
HASHES, AGREE, PIVOTS = 4, 3, 16
#: Shingles of a region that is joined at once, and how much larger its parts may be together than a region that is split.
LEAF, GROWTH = 4_000_000, 2.0
BATCH_BYTES, HELD_TOKENS, GROUP_BYTES = 4 << 20, 3_000_000, 8 << 20
OWNER = np.dtype([("cls", "<u8"), ("n", "<u2"), ("least", "<u2")])


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64, copy=False).view(np.int64), pa.int64())


def batches_of(docs: DataFrame, text: str, run, schema: str, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), *more).mapInArrow(lean(run), schema)


def classes_of(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A digest of each row's set."""
    total = np.zeros(len(tokens) + 1, U64)
    np.cumsum(mix(tokens + U64(0x1234567)), out=total[1:])
    return mix((total[offsets[1:]] - total[offsets[:-1]]) ^ (np.diff(offsets).astype(U64) * U64(0x9E3779B97F4A7C15)))


def described(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id, n, cls, least array<long>`` of every row; ``least`` are its least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            tokens, offsets = shingle_sets(batch.column(1))
            n = np.diff(offsets)
            least = np.zeros((batch.num_rows, HASHES), U64)
            for k in range(HASHES):
                if (n > 0).any():
                    least[n > 0, k] = np.minimum.reduceat(mix(tokens ^ mix(np.full(1, k + 1, U64))), offsets[:-1][n > 0])
            values = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * HASHES, pa.int32()), as_long(least.ravel()))
            yield pa.record_batch({"doc_id": batch.column(0), "n": pa.array(n, pa.int64()), "cls": as_long(classes_of(tokens, offsets)), "least": values})

    return batches_of(docs, text, run, "doc_id long, n long, cls long, least array<long>")


def packed(keys: np.ndarray) -> bytes:
    """Sorted 32-bit keys as differences, byte by byte, so that the shuffle's compression finds the small ones."""
    return np.diff(keys.astype(np.uint32), prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def bits_for(total: int, size: int) -> int:
    """Bits that number so many groups that each gets about ``GROUP_BYTES``."""
    return max(4, int(np.ceil(np.log2(max(1, total * size / GROUP_BYTES)))))


def common_shingles(docs: DataFrame, text: str, total: int) -> tuple[int, np.ndarray, np.ndarray]:
    """``(shift, codes, counts)``: upper bits of the shingles in more than ``RARE`` documents, sorted, and in how many.

    Counts cover all documents. Only the order of a document's shingles
    depends on them, so shingles that agree in the upper bits do no harm.
    """
    bits = bits_for(total, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            tokens = np.sort(np.concatenate(held)) >> U64(32 - bits)
            new = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
            codes, counts = tokens[new], np.diff(np.r_[new, len(tokens)])
            for group in np.split(np.arange(len(codes)), np.flatnonzero(np.diff((codes >> U64(32)).astype(np.int64))) + 1):
                own, n = codes[group].astype(np.uint32), counts[group].astype(np.uint32)
                once = n == 1
                yield int(codes[group[0]] >> U64(32)), packed(own[once]), np.column_stack([own[~once], n[~once]]).tobytes()

        def out():
            rows = list(flush())
            return pa.record_batch({"part": pa.array([r[0] for r in rows], pa.int64()), "once": pa.array([r[1] for r in rows], pa.binary()), "more": pa.array([r[2] for r in rows], pa.binary())})

        for batch in pieces(batches, BATCH_BYTES):
            tokens, _ = shingle_sets(batch.column(1))
            held.append(tokens)
            size += len(tokens)
            if size >= HELD_TOKENS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def add(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, once, more = 0, [], []
        for batch in group:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
                once += [unpacked(x.as_buffer()) for x in batch.column(1)]
                more += [np.frombuffer(x.as_buffer(), np.uint32).reshape(-1, 2) for x in batch.column(2)]
        key = np.concatenate(once + [m[:, 0] for m in more])
        n = np.concatenate([np.ones(sum(map(len, once)), np.int64)] + [m[:, 1].astype(np.int64) for m in more])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        n = np.add.reduceat(n, new) if len(new) else n
        key = key[new]
        hot = n > RARE
        yield pa.record_batch({"code": pa.array((np.int64(part) << 32) | key[hot].astype(np.int64), pa.int64()), "n": pa.array(n[hot], pa.int64())})

    counted = batches_of(docs, text, run, "part long, once binary, more binary").groupBy("part").applyInArrow(add, "code long, n long")
    # the most common ones at most: 16 bytes each
    top = counted.orderBy(F.desc("n"), "code").limit(COMMON).toPandas().sort_values("code")
    return 32 - bits, top["code"].to_numpy(np.int64).astype(U64), top["n"].to_numpy(np.int64)


def first_shingles(tokens: np.ndarray, offsets: np.ndarray, shift: int, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(token, row, is_common, least)``: the shingles by which each row must meet its links, rare ones first, then the less common.

    ``least`` says for each row how many rare ones of them a link shares at
    least: two sets that share ``s`` elements share ``k`` of their first
    ``size - s + k``, and no more of these than the common ones can be common.
    """
    n = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    weight = np.zeros(len(tokens), np.int64)
    if len(codes):
        at = np.minimum(np.searchsorted(codes, tokens >> U64(shift)), len(codes) - 1)
        weight = np.where(codes[at] == tokens >> U64(shift), counts[at], 0)
    order = np.lexsort((tokens, weight, row)) if weight.any() else np.arange(len(tokens))  # sorted by row and token already
    place = np.arange(len(tokens)) - np.repeat(offsets[:-1], n)
    more = 1 + n // MORE
    chosen = order[place < (n - -(-PERCENT * n // 100) + more)[row]]
    is_common = weight[chosen] > 0
    least = more - np.bincount(row[chosen][is_common], minlength=len(n))
    return tokens[chosen], row[chosen], is_common, np.clip(least, 1, 65535)


def met(docs: DataFrame, text: str, total: int, common: tuple[int, np.ndarray, np.ndarray]) -> DataFrame:
    """``a, b, shared``: pairs of classes that share enough of their rare first shingles; ``b`` null: a dense class."""
    bits = bits_for(total * (105 - PERCENT + 100 // MORE) // 100, 10)
    parts = U64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            tokens, offsets = shingle_sets(batch.column(1))
            cls, n = classes_of(tokens, offsets), np.diff(offsets)
            token, row, is_common, least = first_shingles(tokens, offsets, *common)
            dense = np.unique(cls[row[is_common]])
            token, row = token[~is_common], row[~is_common]
            _, one = np.unique(cls, return_index=True)  # equal sets of a batch speak once
            own = np.zeros(len(cls), bool)
            own[one] = True
            token, row = token[own[row]], row[own[row]]
            part, key = (token & parts).astype(np.int64), (token >> U64(32)).astype(np.uint32)
            order = np.lexsort((key, part))
            part, key, row = part[order], key[order], row[order]
            out = []
            for group in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1) if len(part) else ():
                used, index = np.unique(row[group], return_inverse=True)
                owners = np.zeros(len(used), OWNER)
                owners["cls"], owners["n"], owners["least"] = cls[used], np.minimum(n[used], 65535), least[used]
                out.append((int(part[group[0]]), packed(key[group]), index.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), owners.tobytes(), None))
            out += [(-1 - int(c % U64(64)), None, None, None, int(c.astype(U64).view(np.int64))) for c in dense]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()))] if out else [pa.array([], kind) for kind in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64())], ["part", "keys", "owner", "owners", "cls"])

    def pairs(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, index, owners, dense, seen = [], [], [], [], 0
        for batch in group:
            for k, i, o in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                if k.is_valid:
                    keys.append(unpacked(k.as_buffer()))
                    index.append(np.ascontiguousarray(np.frombuffer(i.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64) + seen)
                    owners.append(np.frombuffer(o.as_buffer(), OWNER))
                    seen += len(owners[-1])
            dense.append(batch.column(4).drop_null().to_numpy())
        dense = np.unique(np.concatenate(dense))
        out = [np.column_stack([dense, dense, np.zeros((len(dense), 2), np.int64)])]
        if keys:
            owner, first, same = np.unique(np.concatenate(owners), return_index=True, return_inverse=True)
            who, key = same[np.concatenate(index)], np.concatenate(keys)
            order = np.lexsort((who, key))
            who, key = who[order], key[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (who[1:] != who[:-1])]
            who, key = who[new], key[new]
            start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
            n, cls, least = owner["n"].astype(np.int64)[who], owner["cls"].view(np.int64)[who] if owner["cls"].flags.c_contiguous else np.ascontiguousarray(owner["cls"]).view(np.int64)[who], owner["least"].astype(np.int64)[who]
            for gap in range(1, len(key)):
                i = np.flatnonzero(start[gap:] <= np.arange(len(key) - gap))
                if not len(i):
                    break
                low, high = np.minimum(n[i], n[i + gap]), np.maximum(n[i], n[i + gap])
                i = i[((100 * low >= PERCENT * high) | (high == 65535)) & (cls[i] != cls[i + gap])]
                out.append(np.column_stack([np.minimum(cls[i], cls[i + gap]), np.maximum(cls[i], cls[i + gap]), np.ones(len(i), np.int64), np.minimum(least[i], least[i + gap])]))
        a, b, shared_, least = np.concatenate(out).T
        order = np.lexsort((b, a))
        a, b, shared_, least = a[order], b[order], shared_[order], least[order]
        head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
        total_ = np.add.reduceat(shared_, head) if len(head) else shared_
        yield pa.record_batch({"a": pa.array(a[head], pa.int64()), "b": pa.array(b[head], pa.int64(), mask=total_ == 0), "shared": pa.array(total_, pa.int64()), "least": pa.array(least[head], pa.int64())})

    found = batches_of(docs, text, run, "part long, keys binary, owner binary, owners binary, cls long").groupBy("part").applyInArrow(pairs, "a long, b long, shared long, least long")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("least").alias("least")).filter("b is null or shared >= least").drop("least")


def fetched(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``cls, tokens binary`` of the wanted classes (``cls, rep``), read from their representatives."""
    field = bloom(wanted.select("rep"), wanted.count())
    size = len(field) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False) if not batch.column(0).null_count else np.array([0 if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            at = bloom_places(ids, size)
            maybe = (field[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(0)
            for piece in pieces([batch.filter(pa.array(maybe))], BATCH_BYTES):
                tokens, offsets = shingle_sets(piece.column(1))
                yield pa.record_batch({"cls": as_long(classes_of(tokens, offsets)), "tokens": pa.array([tokens[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())})

    # a few sets more than wanted do no harm
    return kept(batches_of(docs, text, run, "cls long, tokens binary").dropDuplicates(["cls"]))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def links(inter: int, a: int, b: int) -> bool:
    return 100 * inter >= PERCENT * (a + b - inter)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                keep.append(100 * min(len(a), len(b)) >= PERCENT * max(len(a), len(b)) and links(shared(a, b), len(a), len(b)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.select("a", "b").join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a")
    both = with_a.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``cls, comp``: the least class that each class of the edges reaches (least label of the neighbours, then the label's label).

    The joins merge sorted sides, so that no round leaves a table with the driver.
    """
    both = kept(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("cls"), F.least("a", "m").alias("comp")))
    while True:
        near = both.join(labels.hint("merge"), both["b"] == labels["cls"]).groupBy("a").agg(F.min("comp").alias("m")).withColumnRenamed("a", "cls")
        new = labels.join(near.hint("merge"), "cls").select("cls", "comp", F.least("comp", "m").alias("low"))
        up = labels.select(F.col("cls").alias("low"), F.col("comp").alias("up"))
        new = written(new.join(up.hint("merge"), "low", "left").select("cls", F.least("low", "up").alias("comp"), F.col("comp").alias("was")))
        if new.filter("comp != was").isEmpty():
            return new.select("cls", "comp")
        labels = new.select("cls", "comp")


def apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose classes are not in one component yet."""
    side = lambda c: comps.select(F.col("cls").alias(c), F.col("comp").alias(f"{c}_comp"))
    known = pairs.join(side("a").hint("merge"), "a", "left").join(side("b").hint("merge"), "b", "left")
    return known.filter(F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b")).select("a", "b")


def split(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    """Deal the documents of one region to its pivots' regions, windows included."""
    limit = 1 - PERCENT / 100
    # a core nearer than this to its pivot is the pivot's, so that what links with it still shares shingles with the pivot
    near = 1 - 2 * limit
    sets = [np.frombuffer(x.as_buffer(), U64) for x in rows.column("tokens").combine_chunks()]
    centers = [np.frombuffer(x.as_buffer(), U64) for x in pivots.column("p_tokens").combine_chunks()]
    d = np.ones((len(sets), len(centers)))
    for i, s in enumerate(sets):
        for j, c in enumerate(centers):
            both = shared(s, c)
            d[i, j] = 1 - both / (len(s) + len(c) - both)
    core = rows.column("core").to_numpy()
    least, own = d.min(1), d.argmin(1)
    eps = 1e-9
    out_row, out_region, out_core = [], [], []

    def put(which: np.ndarray, name: int, is_core: bool) -> None:
        out_row.append(which)
        out_region.append(np.full(len(which), name))
        out_core.append(np.full(len(which), is_core))

    home = core & (least <= near)
    for j in range(len(centers)):
        put(np.flatnonzero(home & (own == j)), j, True)
        window = (d[:, j] <= np.minimum(least + 2 * limit, near + limit) + eps) & ~(home & (own == j))
        put(np.flatnonzero(window), j, False)
    put(np.flatnonzero(core & ~home), -1, True)
    put(np.flatnonzero((least >= near - limit - eps) & ~(core & ~home)), -1, False)
    at = np.concatenate(out_row)
    take = lambda c: rows.column(c).take(pa.array(at))
    names = [f"{r}.{j}" for r, j in zip(take("region").to_pylist(), np.concatenate(out_region), strict=True)]
    return pa.table({"parent": take("region"), "region": pa.array(names, pa.string()), "cls": take("cls"), "comp": take("comp"), "core": pa.array(np.concatenate(out_core)), "n": take("n")})


def join_region(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components among the documents of one region: a forest that joins whatever links.

    Sets that link share one of their first shingles in the region's own
    order, rarest first. Documents come by size; each meets the ones before it
    that share a first shingle and are of another component by now, and the
    sets of all these are compared at a time.
    """
    rows = pa.Table.from_batches(group)
    order = np.argsort(rows.column("n").to_numpy(), kind="stable")
    rows = rows.take(pa.array(order))
    cls, core, sizes = rows.column("cls").to_numpy(), rows.column("core").to_numpy(zero_copy_only=False), rows.column("n").to_numpy()
    _, label = np.unique(rows.column("comp").to_numpy(), return_inverse=True)
    flat = np.concatenate([np.frombuffer(x.as_buffer(), U64) for x in rows.column("tokens").combine_chunks()])
    del rows
    _, token, common = np.unique(flat, return_inverse=True, return_counts=True)
    del flat
    starts = np.r_[0, np.cumsum(sizes)]
    of = np.repeat(np.arange(len(sizes)), sizes)
    # shingles by document, rare ones first, and of these the ones that a link must share
    token = token[np.lexsort((token, common[token], of))]
    place = np.arange(len(token)) - starts[of]
    first = place < (sizes - -(-PERCENT * sizes // 100) + 1)[of]
    posted = np.lexsort((of[first], token[first]))
    posting, key = of[first][posted], token[first][posted]
    begin, end = np.searchsorted(key, token), np.searchsorted(key, token, side="right")
    mark = np.zeros(len(common), bool)
    a, b = [], []
    for i in range(1, len(sizes)):
        own = slice(starts[i], starts[i + 1])
        lists = [posting[x:y] for x, y in zip(begin[own][first[own]], end[own][first[own]], strict=True)]
        near = np.unique(np.concatenate(lists))
        near = near[: np.searchsorted(near, i)]
        near = near[(label[near] != label[i]) & (core[near] | core[i]) & (100 * sizes[near] >= PERCENT * sizes[i])]
        if not len(near):
            continue
        mark[token[own]] = True
        n = sizes[near]
        head = np.r_[0, np.cumsum(n)]
        at = np.arange(head[-1]) - np.repeat(head[:-1], n) + np.repeat(starts[near], n)
        inter = np.add.reduceat(mark[token[at]].astype(np.int64), head[:-1])
        mark[token[own]] = False
        for j in near[100 * inter >= PERCENT * (n + sizes[i] - inter)]:
            if label[j] != label[i]:
                a.append(cls[j])
                b.append(cls[i])
                label[label == label[j]] = label[i]
    yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def dense_links(dense: DataFrame, sets: DataFrame, comps: DataFrame, leaf: int = LEAF, pivots: int = PIVOTS, growth: float = GROWTH) -> DataFrame:
    """Links between components among the dense classes, by document pivots.

    Regions of at most ``leaf`` shingles are joined at once. Larger ones are
    split by pivots while that makes less of them; where a part would hold more
    than half of the region, or all parts with their windows ``growth`` times
    as much, its documents lie too close together for any pivot to part them,
    and it is joined block by block.
    """
    spark = dense.sparkSession
    n = sets.select("cls", F.floor(F.octet_length("tokens") / 8).alias("n"))
    rows = kept(dense.distinct().join(n, "cls").join(comps, "cls", "left").select(F.lit("0").alias("region"), "cls", F.coalesce("comp", "cls").alias("comp"), F.lit(True).alias("core"), "n"))
    found = spark.createDataFrame([], "a long, b long")

    def joined(rows: DataFrame, blocks: Column) -> DataFrame:
        dealt = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        with_sets = dealt.join(sets, "cls").select("region", "low", "high", "cls", "comp", "core", "n", "tokens")
        return kept(with_sets.groupBy("region", "low", "high").applyInArrow(lean(join_region), "a long, b long"))

    level = 0
    while True:
        sizes = rows.groupBy("region").agg(F.sum("n").alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.max("core").alias("any")).filter("c0 != c1 and any")
        rows = kept(rows.join(sizes.select("region", "size"), "region"))
        found = found.unionAll(joined(rows.filter(F.col("size") <= leaf), F.lit(1)))
        large = rows.filter(F.col("size") > leaf)
        if large.isEmpty():
            return found
        chosen = large.filter("core").withColumn("turn", F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("cls", F.lit(level)), "cls"))).filter(F.col("turn") <= pivots)
        dealt = large.withColumn("salt", F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / leaf)).cast("int"))
        salts = dealt.select("region", "salt").distinct()
        centers = chosen.select("region", "cls").join(sets, "cls").join(salts, "region").select(F.col("region").alias("p_region"), F.col("salt").alias("p_salt"), F.col("tokens").alias("p_tokens"))
        members = dealt.join(sets, "cls").select("region", "salt", "cls", "comp", "core", "n", "tokens")
        parted = kept(members.groupBy("region", "salt").cogroup(centers.groupBy("p_region", "p_salt")).applyInArrow(split, "parent string, region string, cls long, comp long, core boolean, n long"))
        whole = large.select(F.col("region").alias("parent"), "size").distinct()
        parts = parted.groupBy("parent", "region").agg(F.sum("n").alias("part")).groupBy("parent").agg(F.sum("part").alias("held"), F.max("part").alias("most"))
        # every part has half of its region at most, so the splits come to an end
        dense_ = kept(parts.join(whole, "parent").filter((F.col("held") > growth * F.col("size")) | (F.col("most") * 2 > F.col("size"))).select("parent"))
        stuck = large.join(dense_.withColumnRenamed("parent", "region"), "region", "left_semi")
        found = found.unionAll(joined(stuck, F.greatest(F.ceil(F.col("size") * 2 / leaf), F.lit(2))))
        rows = parted.join(dense_, "parent", "left_anti").select("region", "cls", "comp", "core", "n")
        level += 1


def ngram_join(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` for every row.

    ``component_id`` is the smallest id among the documents that links reach,
    its own included; ``class_id`` the smallest among those with the same set.
    Texts without words, and nulls, have no shingle and link with nothing.
    Rows without an id link, but don't name a component. Repeated rows give
    repeated rows; an empty table gives none; other columns are not read.
    """
    rows = kept(described(docs, text))
    full = rows.filter("n > 0")
    classes = kept(full.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("least").alias("least")))
    total = full.agg(F.sum("n")).first()[0] or 0

    # document pivots: the class with the least digest among those that share a least hash; the one shared most often
    hashes = classes.select("cls", F.posexplode("least").alias("k", "value"))
    first = hashes.groupBy("k", "value").agg(F.min("cls").alias("a"), F.count("*").alias("size")).filter("size > 1")
    meet = hashes.join(first, ["k", "value"]).filter("a != cls").groupBy(F.col("cls").alias("b"), "a").agg(F.count("*").alias("times")).filter(F.col("times") >= AGREE)
    stars = meet.groupBy("b").agg(F.max(F.struct("times", F.col("a").alias("a"))).alias("best")).select("best.a", "b")
    stars = kept(stars)

    pairs = kept(met(docs, text, total, common_shingles(docs, text, total)))
    dense, pairs = pairs.filter("b is null").select(F.col("a").alias("cls")), pairs.filter("b is not null")
    # first of all each class with the one it shares most with
    best = pairs.groupBy("b").agg(F.max(F.struct("shared", F.col("a").alias("a"))).alias("best")).select("best.a", "b")
    ends = [stars.select(F.col("a").alias("cls")), stars.select(F.col("b").alias("cls")), pairs.select(F.col("a").alias("cls")), pairs.select(F.col("b").alias("cls")), dense]
    wanted = ends[0]
    for more in ends[1:]:
        wanted = wanted.unionAll(more)
    sets = fetched(docs, text, kept(classes.select("cls", "rep").join(wanted.distinct(), "cls", "left_semi")))

    edges = kept(linked(stars.unionAll(best).distinct(), sets))
    comps = components(edges)
    edges = edges.unionAll(linked(apart(pairs, comps), sets)).unionAll(dense_links(dense, sets, comps))
    comps = components(edges)

    named = classes.join(comps, "cls", "left").select("cls", "rep", F.coalesce("comp", "cls").alias("comp"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "comp").select("cls", "rep", "component_id")
    out = rows.join(named, "cls", "left")
    own = lambda c: F.when(F.col("n") > 0, F.col(c)).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own("component_id").alias("component_id"), own("rep").alias("class_id"))


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (of rows that repeat it, the least text).

    Documents without a shingle, and rows without an id, stay.
    """
    chosen = ngram_join(docs, text).filter("n_shingles > 0 and doc_id is not null and doc_id != component_id").select(F.col("doc_id").alias("gone__")).distinct()
    return docs.join(chosen, F.col("doc_id") == F.col("gone__"), "left_anti")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


#: The same rows in DuckDB: all pairs that share a shingle, and whatever links reach. For small tables.
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id::BIGINT AS doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS k FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n, md5(string_agg(k, chr(10) ORDER BY k)) AS h FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT x, b FROM reach JOIN e ON y = a),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x),
same AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS class_id FROM n)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(class_id, doc_id) AS class_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id) LEFT JOIN same USING (doc_id)"""
