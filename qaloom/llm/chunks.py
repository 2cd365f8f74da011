"""Chunks of many texts: what a lookup by key needs to shuffle is one entry for each distinct key of a chunk.

A chunk's distinct keys go to their parts (by hash) as one packed row for each part; the part answers each chunk;
the answers meet the chunk's positions again. Keys are spread evenly, however often one stands in the corpus."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import SparkSession

CHUNK = 8 << 20


def part_count(spark: SparkSession) -> int:
    """Twice the shuffle partitions, which follow the size of the job. There is no cap: a chunk makes no more rows than
    it has distinct keys, so with very many parts rows are packed less, but their number stays in proportion."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunk_ids():
    """Ids for the chunks that this task makes; they are written down once, and never made again."""
    at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    while True:
        yield at
        at += 1


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte, so that the high bytes, mostly 0, stand together; compressed, as a shuffle would
    do it less well."""
    return squeeze(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unplanes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unsqueeze(packed), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.decompress(data)
