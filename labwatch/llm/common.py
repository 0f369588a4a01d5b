"""Helpers that the operators share: table access, Arrow text batches, byte-wise words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contract's word separators: blank and \t \n \v \f \r.
SEPARATORS = "\t\n\x0b\x0c\r "
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

U64 = np.uint64
#: Odd multipliers of a 64-bit mixer and of the byte and word polynomials.
MIX1, MIX2, BYTE_BASE = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_place(docs: DataFrame) -> DataFrame:
    """``docs`` and ``written_place``: where each row stands in the files it was read from, in the order they were written.

    Files of one job are numbered in the order of its partitions, so rows that
    were written sorted stand in that order, whatever order a reader takes the
    files in. Null for rows that come from no file, or from one named otherwise.
    """
    try:
        name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        docs.select(name, row)
    except AnalysisException:
        return docs.withColumn("written_place", F.lit(None).cast("long"))
    part = lambda i: F.regexp_extract(name, r"^part-([0-9]+)-.*-c([0-9]+)[.]", i).try_cast("long")
    return docs.withColumn("written_place", F.shiftleft(part(1), 44).bitwiseOR(F.shiftleft(part(2), 36)).bitwiseOR(row))


def whole_text(column: str = "text") -> Column:
    """The text, a null being empty."""
    return F.coalesce(F.col(column), F.lit(""))


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def pieces(batches, most: int):
    """Cut Arrow batches so that each piece holds about ``most`` bytes of memory (one row at least)."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, int(rows * most / max(batch.nbytes, 1))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def give_back() -> None:
    """Hand freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def lean(run):
    """A task function that gives its memory back when it ends: an idle worker holds nothing while others work."""

    def leaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return leaned


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and each row's start and end in them (n + 1 offsets)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def sessions_checkpoint(spark: SparkSession) -> str:
    """The shared folder the session names; one below the warehouse where it names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm-checkpoints"


def let_go(spark: SparkSession, wait: bool = False) -> None:
    """Have executors let go of the shuffle files of earlier steps: they do once the driver has collected the plans that made them.

    Py4J takes up to a second to tell the JVM of plans that Python no longer
    holds; ``wait`` is for steps that leave much on disk.
    """
    gc.collect()
    if wait:
        time.sleep(1.5)
    spark.sparkContext._jvm.System.gc()


def kept(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage through files in the shared folder; they outlive a lost executor.

    Shuffle files of earlier steps go first.
    """
    spark = df.sparkSession
    let_go(spark)
    spark.sparkContext.setCheckpointDir(sessions_checkpoint(spark))
    return df.checkpoint(eager=eager)


def written(df: DataFrame) -> DataFrame:
    """The same cut by a table in the shared folder.

    For loops: a checkpointed frame carries the constraints of the plan that
    made it, and those of the next round are derived from all of them.
    """
    path = f"{sessions_checkpoint(df.sparkSession).rstrip('/')}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
