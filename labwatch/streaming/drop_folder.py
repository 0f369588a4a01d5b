"""Files dropped into a folder, merged into a laboratory's table one batch of files at a time.

Only the paths travel through the stream: layouts differ from file to file,
so each batch reads its own files with their own headers. Rows that do not fit
their header are set apart instead of failing the batch. The stream's
checkpoint remembers which files were taken, the table which batches it holds;
a batch that is replayed after a crash, wherever it happened, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labwatch.plans.labs import LABS, final
from labwatch.sinks.buckets import BUCKETS, Storage, manifest, merge_into
from labwatch.sources.delimited import BROKEN, FORMATS, layouts, read_apart, stacked
from labwatch.sources.header_repair import prepare

#: Files in a batch. One laboratory's headers are repaired by looking at the values of each file.
PER_BATCH, FILE_BY_FILE = 256, ("HLAGYN",)


def arrivals(spark: SparkSession, folder: str, pattern: str = "*.csv", per_batch: int = 1) -> DataFrame:
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_batch)
    )
    return reader.load(folder).select("path")


def ingest(
    spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[list[str], int], None], pattern: str = "*.csv",
    per_batch: int = 1,
) -> StreamingQuery:
    """Take all files present, ``per_batch`` at a time, then stop.

    The source bounds a batch. A batch that was planned with another
    ``per_batch`` and is replayed keeps all its files.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.select("path").collect())
        if paths:
            handle(paths, batch_id)

    return (
        arrivals(spark, folder, pattern, per_batch)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the stream behind a checkpoint; a new checkpoint is a new stream wherever it lies."""
    return json.loads(Storage(spark, checkpoint).read(f"{checkpoint}/metadata"))["id"]


def deliver(spark: SparkSession, lab_id: str, paths: list[str], staging: str, quarantine: str | None, batch_id: int, date_order: str | None = None) -> DataFrame:
    """Prepared rows of one batch of files, read once into the shared folder; broken rows go to the quarantine.

    The quarantine holds ``file_name`` and the raw line under the number of
    the batch, which a replay overwrites. Without one a broken row fails.
    """
    sep, encoding = FORMATS[lab_id]
    prepared, broken = [], []
    for i, layout in enumerate(layouts(spark, paths, sep, encoding)):
        seen = Observation()
        counted = F.count(BROKEN).alias("broken")
        read_apart(spark, layout, sep, encoding).observe(seen, counted).write.parquet(f"{staging}/{i}")
        rows = spark.read.parquet(f"{staging}/{i}")
        if seen.get["broken"]:
            broken.append(rows.where(F.col(BROKEN).isNotNull()).select("file_name", BROKEN))
        prepared.append(prepare(lab_id, rows.where(F.col(BROKEN).isNull()).drop(BROKEN), date_order))
    if broken:
        if quarantine is None:
            raise ValueError(f"rows with more fields than their header in {paths}")
        stacked(broken).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
    return stacked(prepared)


def ingest_lab(
    spark: SparkSession, lab_id: str, folder: str, table: str, checkpoint: str, now: Callable[[], Column] | None = None,
    pattern: str = "*.csv", archive: str | None = None, quarantine: str | None = None, per_batch: int = PER_BATCH, buckets: int = BUCKETS,
    date_order: str | None = None,
) -> StreamingQuery:
    """Merge dropped files of a laboratory into its table, ``per_batch`` files at a time.

    Samples spread over files of one batch become one. Files whose batch is
    in the table move to ``archive``, into a folder for their batch. Dropping
    a file again under another name changes nothing but times.
    """
    plan = LABS[lab_id]
    clock = now or (lambda: F.localtimestamp())

    def handle(paths: list[str], batch_id: int) -> None:
        stream, state = stream_id(spark, checkpoint), manifest(spark, table)
        if state is None or state.applied.get(stream, -1) < batch_id:
            staging = f"{table}/_staging/{uuid.uuid4().hex}"
            try:
                samples = plan.wide(deliver(spark, lab_id, paths, staging, quarantine, batch_id, date_order))
                merge_into(spark, table, samples, lambda known, batch: final(plan, batch, known, clock()), buckets=buckets, once=(stream, batch_id))
            finally:
                Storage(spark, table).delete(staging)
        if archive:
            storage = Storage(spark, folder)
            with ThreadPoolExecutor(16) as pool:
                list(pool.map(lambda p: storage.move(p, f"{archive}/{stream}/{batch_id}"), paths))

    return ingest(spark, folder, checkpoint, handle, pattern, 1 if lab_id in FILE_BY_FILE else per_batch)
