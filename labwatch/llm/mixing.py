"""Mixing sources to target weights by Pfair scheduling.

Each source is a periodic task whose share of the output is its target
weight. Its j-th block may not run before ``floor((j - 1) / weight)`` and must
have run by ``ceil(j / weight)``; of the released blocks the one with the
earliest deadline goes next. On a single output this meets every window, so
after any number of blocks no source is a whole block away from its target.

Weights are taken as they are, as exact fractions, and so are release times
and deadlines. Where the weights have a common measure the schedule repeats,
and one period of it is computed; where they have none that is short, or the
documents end before, as many slots are computed as there are. When a source
has run out, the rest go on with their weights to one another: a new phase.
Blocks grow with the number of documents, so that a schedule has a bounded
number of slots whatever the weights. The documents never leave Spark: a
document's place follows from its rank in its source, and ranks come from counts
of hash buckets, so that no source, however large, has to be numbered in one task.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch.llm.common import table

#: Documents in a block at least, blocks at most (but for the last one of each source), rows that one task numbers.
BLOCK, MOST_BLOCKS, BUCKET_ROWS = 64, 50_000, 4_000


def shares(weights: dict[str, float]) -> dict[str, Fraction]:
    """Each source's exact part of the whole."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    total = sum(exact.values())
    return {k: w / total for k, w in exact.items()}


def slots_of(share: dict[str, Fraction], blocks: dict[str, int]) -> tuple[list[str], bool]:
    """The sources of the slots by release time and earliest deadline, and whether they are a whole period.

    They end with a period, or with the slot in which a source's last block goes.
    """
    period = math.lcm(*(w.denominator for w in share.values()))
    # the j-th block of a source: release floor((j - 1) / w), deadline ceil(j / w)
    waiting = [(0, -(-w.denominator // w.numerator), k, 1) for k, w in share.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out: list[str] = []
    while len(out) < period:
        while waiting and waiting[0][0] <= len(out):
            _, deadline, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, k, j))
        _, k, j = heapq.heappop(ready)
        out.append(k)
        if j == blocks[k]:
            return out, False
        up, down = share[k].denominator, share[k].numerator
        heapq.heappush(waiting, (j * up // down, -(-(j + 1) * up // down), k, j + 1))
    return out, True


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> list[dict]:
    """Phases: for each source that takes part, the number of its phase, its first block, its slots in the period, the period and the first slot.

    Sources of weight zero follow when all others have ended, with equal weights.
    """
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    done, base, rows, phases = dict.fromkeys(blocks, 0), 0, [], dict.fromkeys(blocks, 0)
    while left := [k for k in sorted(blocks) if done[k] < blocks[k]]:
        active = [k for k in left if weights[k] > 0]
        share = shares({k: weights[k] for k in active} if active else dict.fromkeys(left, 1))
        order, whole = slots_of(share, {k: blocks[k] - done[k] for k in share})
        places: dict[str, list[int]] = {k: [] for k in share}
        for i, k in enumerate(order):
            places[k].append(i)
        size, end = len(order), len(order)
        if whole:  # the first source to end, in some later round of the period
            end = min((n - 1) // len(places[k]) * size + places[k][(n - 1) % len(places[k])] for k in share if (n := blocks[k] - done[k])) + 1
        for k in share:
            if places[k]:
                rows.append({"s": k, "phase": phases[k], "first": done[k], "base": base, "size": size, "places": places[k]})
                phases[k] += 1
            done[k] += end // size * len(places[k]) + sum(p < end % size for p in places[k])
        base += end
    return rows


def source_key(column: str) -> Column:
    """A text for every source; the null source has its own."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column).cast("string")))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK, most_blocks: int = MOST_BLOCKS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``row struct`` (all columns of ``docs``), ``block``, ``slot`` and ``position`` for every row.

    ``weights`` gives a target weight by source (``None`` is the null source);
    without it all sources weigh the same. A source that it doesn't name has
    the weight zero and follows when the others have ended: nothing is dropped.
    A block has ``block`` rows, or so many more that there are ``most_blocks``.
    ``slot`` is the place of the row's block, ``position`` the row's place
    (``slot * block`` plus its place in the block, so the last block of a
    source may leave a gap). Within a source rows follow a hash of ``key``;
    rows with an equal key are in any order. An empty table gives no rows;
    extra columns ride along inside ``row``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), source_key(source).alias("s"), F.xxhash64(F.col(key)).alias("h"))
    # one row for each source, as many as a table of target weights has
    counts = {r["s"]: r["n"] for r in docs.select(source_key(source).alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect()}
    given = dict.fromkeys(counts, 1.0) if weights is None else {("n" if k is None else f"s{k}"): w for k, w in weights.items()}
    block = max(block, -(-sum(counts.values()) // most_blocks))
    plan = schedule({k: -(-n // block) for k, n in counts.items()}, {k: given.get(k, 0) for k in counts})
    buckets = max(1, -(-sum(counts.values()) // bucket_rows))

    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sizes = docs.select(source_key(source).alias("s"), F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("bucket")).groupBy("s", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("s", "bucket", (F.sum("n").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("s", "bucket").orderBy("h", F.col(f"row.`{key}`"))) - 1)
    ranked = ranked.join(before, ["s", "bucket"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "bucket")
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block)).withColumn("within", F.col("rank") % block)

    phases = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(plan)), "array<struct<s:string,phase:int,first:bigint,base:bigint,size:bigint,places:array<int>>>")))
    starts: dict[str, list[int]] = {}
    for r in plan:
        starts.setdefault(r["s"], []).append(r["first"])
    first = F.from_json(F.lit(json.dumps(starts)), "map<string,array<bigint>>")
    # the phase of a block: how many of its source's phases start at or before it (a phase may pass without a block)
    phase = F.size(F.filter(first[F.col("s")], lambda x: x <= F.col("block"))) - 1
    placed = ranked.withColumn("phase", phase).join(phases, ["s", "phase"])
    turn = F.col("block") - F.col("first")
    per = F.size("places")
    slot = F.col("base") + F.floor(turn / per) * F.col("size") + F.get("places", (turn % per).cast("int"))
    return placed.select("row", "block", slot.alias("slot"), (slot * block + F.col("within")).alias("position"))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, **options) -> DataFrame:
    """All rows and columns of ``docs``, in the order of the mix; written files keep it."""
    return mix(docs, weights, **options).orderBy("position").select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document when all sources weigh the same."""
    placed = mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return placed.select("row.doc_id", "row.source", "block", "slot", "position")
