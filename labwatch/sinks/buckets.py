"""Keyed tables in hash buckets, with a small manifest for each state.

A row lies in the bucket of its key's hash. A merge reads and rewrites only the
buckets that its batch touches: their new files go beside the old ones, under
the next version, and a manifest that names the version of every bucket is then
put in place by one rename. So the files of other buckets stay as they are,
readers see one state or the other, a job that dies leaves nothing but files no
manifest names, and of two merges that begin from the same state one fails.
A retried merge overwrites what its forerunner left of the same version.

The manifest also remembers the last batch of each stream, so a batch that is
delivered again after a crash is recognised and merged once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Partition columns of the files; readers do not see them.
BUCKET, VERSION = "merge_bucket", "merge_version"
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    version: int
    key: str
    buckets: int
    schema: str
    #: bucket -> version of its files
    files: dict[int, int] = field(default_factory=dict)
    #: stream -> last batch merged
    applied: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(**{**found, "files": {int(b): v for b, v in found["files"].items()}})


class Storage:
    """The file system behind a path, by Spark's own connectors."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path_of(path))

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files below a folder."""
        return self.fs.getContentSummary(self.path_of(path)).getLength()

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path_of(folder))] if self.exists(folder) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path_of(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, path: str, data: bytes) -> bool:
        """Write whole or not at all; False if the file is there already."""
        draft = self.path_of(f"{path}.{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(data))
        stream.close()
        if not self.exists(path) and self.fs.rename(draft, self.path_of(path)):
            return True
        self.fs.delete(draft, False)
        return False

    def move(self, path: str, folder: str) -> None:
        """Move a file into a folder; a file that is gone has been moved before."""
        source = self.path_of(path)
        if self.fs.exists(source):
            self.fs.mkdirs(self.path_of(folder))
            if not self.fs.rename(source, self.path_of(folder, source.getName())):
                raise OSError(f"{path} could not be moved to {folder}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.path_of(path), True)


def _states(storage: Storage, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in storage.names(f"{path}/_manifests") if n.endswith(".json"))


def _manifest(storage: Storage, path: str, version: int) -> Manifest:
    return Manifest.from_json(storage.read(f"{path}/_manifests/{version:09d}.json"))


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest state of a table, or nothing before the first."""
    storage = Storage(spark, path)
    done = _states(storage, path)
    return _manifest(storage, path, done[-1]) if done else None


def _rows(spark: SparkSession, path: str, state: Manifest, only: Iterable[int] | None = None) -> DataFrame:
    wanted = state.files if only is None else {b: state.files[b] for b in only if b in state.files}
    schema = StructType.fromJson(json.loads(state.schema))
    if not wanted:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{BUCKET}={b}/{VERSION}={v}" for b, v in sorted(wanted.items())]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*[f"`{f.name}`" for f in schema])


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest state, or nothing before the first."""
    state = manifest(spark, path)
    return None if state is None else _rows(spark, path, state)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def merge_into(
    spark: SparkSession, path: str, batch: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    key: str = "sample_id", buckets: int = BUCKETS, once: tuple[str, int] | None = None,
) -> Manifest:
    """Merge a batch into the table and give its new state.

    ``merge`` gets the known rows of the touched buckets (None before the
    first state) and the batch; its result must keep every row's key.
    ``buckets`` holds for a new table, an old one keeps its own number: choose
    it so that a bucket has the size of a few files. ``once`` names a stream
    and one of its batches: a batch not after the last one of its stream is
    not merged again.

    The batch is written first, to a folder of its own that goes afterwards:
    computed once however often the merge reads it, and of a size the planner
    knows when it chooses between broadcast and sort-merge.
    """
    storage, state = Storage(spark, path), manifest(spark, path)
    if state and once and state.applied.get(once[0], -1) >= once[1]:
        return state
    n = state.buckets if state else buckets
    staging = f"{path}/_staging/{uuid.uuid4().hex}"
    batch.write.parquet(staging)
    try:
        ready = spark.read.schema(batch.schema).parquet(staging)
        touched = [r[0] for r in ready.select(bucket_of(key, n).alias("b")).distinct().collect()]  # at most n numbers
        merged = merge(_rows(spark, path, state, touched) if state else None, ready)
        version = state.version + 1 if state else 1
        schema = StructType([f for f in merged.schema.fields]).json()
        if touched:
            placed = merged.withColumns({BUCKET: bucket_of(key, n), VERSION: F.lit(version)}).repartition(BUCKET)
            placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, VERSION).parquet(path)
        base = state or Manifest(0, key, n, schema)
        files = {**base.files, **dict.fromkeys(touched, version)}
        applied = {**base.applied, **({once[0]: once[1]} if once else {})}
        new = replace(base, version=version, schema=schema, files=files, applied=applied)
        if not storage.put(f"{path}/_manifests/{version:09d}.json", new.to_json().encode()):
            raise RuntimeError(f"another merge has made version {version} of {path}")
        return new
    finally:
        storage.delete(staging)


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Drop all but the newest ``keep`` states and the files that only older ones name; gives how many folders went.

    For times without a merge or a reader of an old state: files that no
    manifest names yet go as well.
    """
    storage = Storage(spark, path)
    done = _states(storage, path)
    for version in done[:-keep]:
        storage.delete(f"{path}/_manifests/{version:09d}.json")
    used = {(b, v) for version in done[-keep:] for b, v in _manifest(storage, path, version).files.items()}
    dropped = 0
    for bucket in (n for n in storage.names(path) if n.startswith(f"{BUCKET}=")):
        for version in (n for n in storage.names(f"{path}/{bucket}") if n.startswith(f"{VERSION}=")):
            if (int(bucket.split("=")[1]), int(version.split("=")[1])) not in used:
                storage.delete(f"{path}/{bucket}/{version}")
                dropped += 1
    return dropped
