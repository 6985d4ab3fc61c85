"""Which keys stand in several rows, found by hashes that travel packed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

#: Bits of a hash: those that choose its group, and those that travel, in whole bytes; of 50 in all, two of 36 million ids often
#: share one, and all reads are read again for it. Hashes that a task holds at once.
TOP, LOW, HELD = 10, 48, 1 << 20


def hash_of(cols: list[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - TOP - LOW)


def _pack(batches):
    held, n = [], 0

    def out():
        h = np.sort(np.concatenate(held))
        # two of a hash tell as much as more
        h = h[np.concatenate([np.ones(min(2, len(h)), dtype=bool), h[2:] != h[:-2]])]
        group = h >> LOW
        cut = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(h)]])
        # differences are small, and their highest bytes, put together, compress to little
        low = np.diff(h, prepend=0)
        low[cut[:-1]] = h[cut[:-1]] & (1 << LOW) - 1
        low = low.astype("<i8").view(np.uint8).reshape(-1, 8)[:, : LOW // 8]
        return pa.RecordBatch.from_arrays([pa.array(group[cut[:-1]]), pa.array([low[i:j].T.tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())], names=["_group", "_low"])

    for b in batches:
        held.append(b["_k"].to_numpy())
        n += b.num_rows
        if n >= HELD:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def _unpacked(low: bytes) -> np.ndarray:
    h = np.zeros((8, 8 * len(low) // LOW), dtype=np.uint8)
    h[: LOW // 8] = np.frombuffer(low, dtype=np.uint8).reshape(LOW // 8, -1)
    return np.cumsum(np.ascontiguousarray(h.T).view("<i8").ravel())


def _again(batches):
    now, parts = None, []

    def out():
        h = np.sort(np.concatenate([_unpacked(p) for p in parts]))
        return pa.RecordBatch.from_arrays([pa.array((now << LOW) + np.unique(h[1:][h[1:] == h[:-1]]), pa.int64())], names=["_k"])

    for b in batches:
        for group, low in zip(b["_group"].to_pylist(), b["_low"].to_pylist()):
            if parts and group != now:
                yield out()
                parts = []
            now = group
            parts.append(low)
    if parts:
        yield out()


def repeated(df: DataFrame, cols: list[str]) -> DataFrame:
    """_k: the hash_of(cols) that several rows have; besides equal values, hardly any others share one."""
    ship(df.sparkSession)
    packed = df.select(hash_of(cols).alias("_k")).mapInArrow(_pack, "_group long, _low binary")
    return packed.repartition("_group").sortWithinPartitions("_group").mapInArrow(_again, "_k long")
