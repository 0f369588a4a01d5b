"""A bit field of many ids, built by Spark and small enough to travel with a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from labwatch.llm.common import U64, mix


def bloom(ids: DataFrame, expected: int) -> np.ndarray:
    """A bit field of the column's values; 16 MB at most, whatever their number."""
    bits = min(27, max(16, int(np.ceil(np.log2(max(expected, 1) * 16)))))
    size = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(size, bool)
        for batch in batches:
            field[bloom_places(batch.column(0).drop_null().to_numpy(), size).ravel()] = True
        packed = np.packbits(field).reshape(-1, 1 << 12 if bits >= 15 else size >> 3)
        used = np.flatnonzero(packed.any(1))
        yield pa.record_batch({"slice": pa.array(used, pa.int64()), "bits": pa.array([packed[i].tobytes() for i in used], pa.binary())})

    def either(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at = None, 0
        for batch in group:
            for x in batch.column(1):
                at = batch.column(0)[0].as_py()
                own = np.frombuffer(x.as_buffer(), np.uint8)
                total = own.copy() if total is None else total | own
        yield pa.record_batch({"slice": pa.array([at], pa.int64()), "bits": pa.array([total.tobytes()], pa.binary())})

    rows = ids.mapInArrow(run, "slice long, bits binary").groupBy("slice").applyInArrow(either, "slice long, bits binary").collect()
    field = np.zeros((size >> 15 if bits >= 15 else 1, 1 << 12 if bits >= 15 else size >> 3), np.uint8)
    for r in rows:
        field[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return field.ravel()


def bloom_places(ids: np.ndarray, size: int) -> np.ndarray:
    h = mix(ids.astype(np.int64).view(U64) if len(ids) else np.zeros(0, U64))
    return np.stack([((h >> U64(s)) & U64(size - 1)).astype(np.int64) for s in (0, 11, 23, 35)])
