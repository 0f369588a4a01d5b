"""Nearest neighbours by an inverted multi-index.

Vectors are cut into two halves and each half is quantised by its own small
codebook; a vector's cell is its pair of centroids. For a query all cells are
visited best first: the pairs are traversed with a heap by the sum of the two
halves' nearness (inner products, as that is what the search maximises), until
the visited cells hold enough vectors. Those are reranked exactly, in double
precision, against the original vectors.

Cells are held in shards of about equal size. A cell or shard that a common
vector has filled is split further by a salt, and a query visits every part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch.llm.common import kept, table

#: Centroids of each half, vectors that the codebooks are fitted on, k-means rounds.
CENTROIDS, SAMPLE, ROUNDS = 32, 20_000, 8
#: Share of the index that a query's cells must hold at least, and vectors in a shard.
VISITED, SHARD = 0.6, 8_192
#: Queries that meet in one task.
QUERIES = 16_384
NEAREST = 20


def k_means(x: np.ndarray, k: int, rounds: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        a = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        for j in range(k):
            if (own := a == j).any():
                c[j] = x[own].mean(0)
    return c


def vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(kept, matrix)``: which rows hold ``width`` finite components, not all zero, and their values in double precision."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    good = sizes == width
    chosen = column.filter(pa.array(good))
    flat = chosen.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)  # null components become NaN
    fine = np.isfinite(flat).all(1) & (flat != 0).any(1)
    good[np.flatnonzero(good)[~fine]] = False
    return good, flat[fine]


def nearest(books: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The cell of each vector."""
    half = books[0].shape[1]
    code = [np.argmin((b * b).sum(1) - 2 * part @ b.T, axis=1) for b, part in zip(books, (x[:, :half], x[:, half:]), strict=True)]
    return code[0] * len(books[1]) + code[1]


def visited(near: tuple[np.ndarray, np.ndarray], counts: np.ndarray, enough: int) -> list[int]:
    """Cells in the order of their summed nearness until they hold ``enough`` vectors (multi-sequence traversal)."""
    left, right = (np.argsort(-d, kind="stable") for d in near)
    a, b = near[0][left], near[1][right]
    heap, seen, cells, held = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(left[i] * len(right) + right[j])
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (-(a[p] + b[q]), p, q))
    return cells


def search(vecs: DataFrame, every: int = 20, k: int = NEAREST, centroids: int = CENTROIDS, sample: int = SAMPLE, share: float = VISITED, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row whose ``vec_id`` is divisible by ``every``.

    Candidates are all rows with another ``vec_id``. Ties go to the smaller
    id. Vectors that are null, zero, of another width than most of the fitted
    sample, or hold null or non-finite components take no part, neither do
    rows without an id. Rows that repeat an id with another vector are
    searched one by one; repeated rows are one query and as many candidates.
    An empty table gives no rows; other columns are not read.
    """
    spark = vecs.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = vecs.filter("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fitted = [r["embedding"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    widths = np.bincount([len(e) for e in fitted]) if fitted else np.zeros(1, int)
    width = int(np.argmax(widths))
    good = np.array([e for e in fitted if len(e) == width and None not in e], float).reshape(-1, width) if width > 1 else np.zeros((0, 2))
    good = good[np.isfinite(good).all(1) & (good != 0).any(1)]
    if not len(good):
        return spark.createDataFrame([], out)
    half = width // 2
    books = k_means(good[:, :half], centroids, ROUNDS), k_means(good[:, half:], centroids, ROUNDS)
    cells = len(books[0]) * len(books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = vectors(batch.column(1), width)
            if len(x):
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))
                yield pa.record_batch({"vec_id": batch.column(0).filter(pa.array(keep)), "embedding": flat, "cell": pa.array(nearest(books, x), pa.int32())})

    index = kept(rows.mapInArrow(assign, "vec_id long, embedding array<double>, cell int"))
    # at most one row for each pair of centroids
    sizes = dict(index.groupBy("cell").count().collect())
    counts = np.zeros(cells, np.int64)
    for cell, n in sizes.items():
        counts[cell] = n
    total = int(counts.sum())
    # neighbouring cells share a shard; a shard that one cell has overfilled gets several salts
    place = np.minimum(np.cumsum(counts) - counts, max(total - 1, 0)) // shard
    salts = np.maximum(1, -(-np.bincount(place, weights=counts).astype(np.int64) // shard))
    first = np.cumsum(salts) - salts
    enough = max(k + 1, int(np.ceil(share * total)))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = place[batch.column(2).to_numpy()]
            spread = batch.column(3).to_numpy() % salts[home]
            none = pa.nulls(batch.num_rows, pa.list_(pa.int32()))
            yield pa.record_batch({"part": pa.array(first[home] + spread, pa.int64()), "vec_id": batch.column(0), "embedding": batch.column(1), "cell": batch.column(2), "cells": none})

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, width)
            near = x[:, :half] @ books[0].T, x[:, half:] @ books[1].T
            part, row, wanted = [], [], []
            for i in range(len(x)):
                by_shard: dict[int, list[int]] = {}
                for cell in visited((near[0][i], near[1][i]), counts, enough):
                    by_shard.setdefault(int(place[cell]), []).append(cell)
                for home, cs in by_shard.items():
                    for salt in range(int(salts[home])):
                        part.append(int(first[home]) + salt)
                        row.append(i)
                        wanted.append(cs)
            take = pa.array(row, pa.int64())
            yield pa.record_batch({"part": pa.array(part, pa.int64()), "vec_id": batch.column(0).take(take), "embedding": batch.column(1).take(take), "cell": pa.nulls(len(part), pa.int32()), "cells": pa.array(wanted, pa.list_(pa.int32()))})

    schema = "part long, vec_id long, embedding array<double>, cell int, cells array<int>"
    asked = index.filter(F.col("vec_id") % every == 0).withColumn("version", F.xxhash64("embedding")).dropDuplicates(["vec_id", "version"])
    blocks = max(1, -(-asked.count() // queries))
    stored = index.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))).mapInArrow(shards, schema)
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.drop("version").mapInArrow(routes, schema).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def rerank(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = pa.Table.from_batches(group)
        is_query = pc.is_valid(data.column("cells")).to_numpy()
        x = data.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, width)
        ids, cell = data.column("vec_id").to_numpy(), data.column("cell").to_numpy()
        stored_rows, asked_rows = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        there, there_ids, there_cell = x[stored_rows], ids[stored_rows], cell[stored_rows].astype(np.int64)
        wanted = data.column("cells").combine_chunks().filter(pa.array(is_query)).to_pylist()
        in_cell = np.zeros(cells, bool)
        for at in range(0, len(asked_rows), 256):
            rough = x[asked_rows[at : at + 256]] @ there.T
            for score, q, own in zip(rough, asked_rows[at : at + 256], wanted[at : at + 256], strict=True):
                in_cell[:] = False
                in_cell[own] = True
                pick = np.flatnonzero(in_cell[there_cell] & (there_ids != ids[q]))
                if len(pick) > k:  # what may be among the nearest once rounding is settled, all ties included
                    pick = pick[score[pick] >= np.partition(score[pick], len(pick) - k)[len(pick) - k] - 1e-9]
                exact = (there[pick] * x[q]).sum(1)
                top = np.lexsort((there_ids[pick], -exact))[:k]
                version = np.full(len(top), int.from_bytes(hashlib.blake2b(x[q].tobytes(), digest_size=7).digest(), "big"))
                yield pa.record_batch({"query_id": pa.array(np.full(len(top), ids[q])), "version": pa.array(version), "vec_id": pa.array(there_ids[pick][top]), "score": pa.array(exact[top], pa.float64())})

    found = stored.unionByName(asked).groupBy("part", "block").applyInArrow(rerank, "query_id long, version long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "version").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
