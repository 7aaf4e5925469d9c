"""A Bloom filter over 64-bit hashes, built by Spark in parts of fixed size.

All places of a hash lie in one part, so the task that gets the hashes of a part
builds it alone.  The filter's size follows the number of hashes up to a fixed
bound, so it can be sent to every task; beyond the bound it only passes more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_BITS = 1 << 23             # one megabyte
MAX_PARTS = 32
BITS_PER_HASH = 12
_PLACES = 5


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each hash inside its part."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    step = (mixed >> np.uint64(35)) | np.uint64(1)
    return ((mixed >> np.uint64(8))[:, None] + step[:, None] * np.arange(_PLACES, dtype=np.uint64)) & np.uint64(bits - 1)


def _set(part: np.ndarray, places: np.ndarray) -> None:
    at = places.ravel()
    np.bitwise_or.at(part, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


class SplitFilter:
    """The whole filter, in a task: ``has`` gives a mask over signed or unsigned hashes."""

    def __init__(self, data: bytes, parts: int):
        self.bytes, self.parts = np.frombuffer(data, np.uint8), parts
        self.bits = len(data) * 8 // parts

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(0, bool)
        part = np.mod(hashes.view(np.int64) >> 40, self.parts)
        at = _places(hashes.view(np.uint64), self.bits).astype(np.int64)
        got = self.bytes[part[:, None] * (self.bits >> 3) + (at >> 3)] >> (at & 7).astype(np.uint8)
        return (got & 1).all(axis=1)


def _build(bits: int):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part = None, np.zeros(bits >> 3, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                              names=["part", "bits"])

        for batch in batches:           # sorted by part
            parts, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "h"))
            for p in np.unique(parts).tolist():
                if p != current and current is not None:
                    yield done()
                    part[:] = 0
                current = p
                _set(part, _places(hashes[parts == p].view(np.uint64), bits))
        if current is not None:
            yield done()

    return body


def build(hashes: DataFrame, n: int, max_parts: int = MAX_PARTS) -> tuple[bytes, int]:
    """(bytes, parts) of the filter of ``hashes`` (h long; about ``n`` rows), for :class:`SplitFilter`."""
    wanted = max(n, 1) * BITS_PER_HASH
    parts = min(max(-(-wanted // PART_BITS), 1), max_parts)
    bits = PART_BITS if parts > 1 else min(max(1 << (wanted - 1).bit_length(), 1 << 12), PART_BITS)
    owned = hashes.select("h", F.pmod(F.shiftright("h", 40), F.lit(parts)).cast("int").alias("part"))
    rows = owned.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_build(bits), "part int, bits binary")
    whole = bytearray(parts * bits >> 3)
    for row in rows.toLocalIterator():      # max_parts megabytes at most
        at = row["part"] * (bits >> 3)
        whole[at:at + (bits >> 3)] = row["bits"]
    return bytes(whole), parts
