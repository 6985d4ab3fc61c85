"""Shared plumbing of the training-data operators: staged tables, byte kernels, bounded sketches, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..staging import delete, delete_at_exit, shared_folder

#: Bytes of text that the numpy kernels hold at once (a longer single text is handled alone).
CHUNK_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_POLY = 0xD6E8FEB86659FD93
_POLY_INV = pow(_POLY, -1, 1 << 64)


# ---------------------------------------------------------------- staged tables
class Stage:
    """Writes intermediate tables below the shared folder, so that lost executors cost only their own tasks."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        delete_at_exit(spark, self.base)
        self.n = 0
        tune(spark)

    def write(self, df: DataFrame, label: str = "t", codec: str = "lz4_raw") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{label}"
        df.write.option("compression", codec).parquet(path)
        self.sweep()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes staged tables that no later result reads."""
        for t in tables:
            delete(self.spark, t._stage_path)
        self.sweep()

    def sweep(self) -> None:
        """Has Spark's cleaner free the shuffle files of finished plans, and keeps the driver's heap small."""
        gc.collect()
        self.spark._jvm.System.gc()


def tune(spark: SparkSession) -> None:
    """Ships the kernels and bounds Arrow batches by bytes too, since single texts may be long."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def lean(run):
    """The same function of batches, which gives a worker's free memory back to the system when a task ends.

    Workers live on between tasks; what they kept would add to the needs of the executor's next stages.
    """

    def out(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
        if trim is not None:
            trim(0)

    return out


# ---------------------------------------------------------------- byte kernels
def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix64((b + np.uint64(1)) * _MULT)


_TABLES = {True: byte_table(True), False: byte_table(False)}
_NEXT = {k: mix64(t) | np.uint64(1) for k, t in _TABLES.items()}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", _POLY), ("i", _POLY_INV)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _POW[key] = np.cumprod(x, dtype=np.uint64)
    return _POW["p"], _POW["i"]


def prefix_hash(buf: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash over neighbouring bytes, and the bytes' own terms; span_hash() reads any span.

    Terms are products of two neighbours: with one term a byte, sums modulo 2^64 cancel for some regular strings.
    """
    p, _ = _powers(len(buf))
    term = _TABLES[lower][buf]
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    if len(buf) > 1:
        pair = _NEXT[lower][buf[1:]]
        pair *= term[:-1]
        pair *= p[: len(pair)]
        np.cumsum(pair, out=out[1:-1])
    return out, term


def span_hash(pre: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans starts[i] <= k < ends[i], none of them empty."""
    sums, term = pre
    _, inv = _powers(len(sums))
    h = (sums[ends - 1] - sums[starts]) * inv[starts]
    h += term[ends - 1]
    return mix64(h)


def word_spans(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of texts laid end to end, and each text's first word number."""
    if not len(buf):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(bounds), dtype=np.int64)
    solid = ~_SPACE[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[bounds] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, row after, bytes, bounds) of runs of texts of about limit bytes; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    n = len(col)
    if not n:
        return
    off = np.frombuffer(off, dtype=kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def ngram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = (h ^ words[i : i + n]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


# ---------------------------------------------------------------- bounded count sketch
class Cells:
    """Counts in a fixed number of hash cells; its size never grows with the data."""

    BLOCK = 4096

    def __init__(self, bits: int):
        self.bits = bits
        self.counts = np.zeros(1 << bits, dtype=np.int64)

    def add(self, hashes: np.ndarray, weight: np.ndarray | None = None) -> None:
        at = (hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        np.add.at(self.counts, at, 1 if weight is None else weight)

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        return cell_rows(self.counts)


def cell_rows(counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(block, places, counts) of the cells that are not 0."""
    for b in range(len(counts) // Cells.BLOCK):
        part = counts[b * Cells.BLOCK : (b + 1) * Cells.BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            yield b, at.astype(np.uint16).tobytes(), part[at].astype(np.uint32).tobytes()


def sum_cells(rows: DataFrame, bits: int) -> np.ndarray:
    """Sums (task, block, at, counts) rows in two rounds, streaming; only 2^bits numbers reach the driver."""

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for salt, block, at, n in zip(b["salt"].to_pylist(), b["block"].to_pylist(), b["at"].to_pylist(), b["counts"].to_pylist()):
                s = sums.setdefault((salt, block), np.zeros(Cells.BLOCK, dtype=np.int64))
                s[np.frombuffer(at, dtype=np.uint16)] += np.frombuffer(n, dtype=np.uint32 if len(n) == 2 * len(at) else np.int64)
        keys = sorted(sums)
        nz = [np.flatnonzero(sums[k]) for k in keys]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([x.astype(np.uint16).tobytes() for x in nz], pa.binary()), pa.array([sums[k][x].tobytes() for k, x in zip(keys, nz)], pa.binary())],
            names=["salt", "block", "at", "counts"],
        )

    kind = "salt int, block int, at binary, counts binary"
    first = rows.select(F.pmod("task", F.lit(8)).cast("int").alias("salt"), "block", "at", "counts").repartition("salt", "block").mapInArrow(add, kind)
    total = np.zeros(1 << bits, dtype=np.int64)
    for r in first.withColumn("salt", F.lit(0)).repartition("block").mapInArrow(add, kind).collect():
        total[r.block * Cells.BLOCK + np.frombuffer(r.at, dtype=np.uint16).astype(np.int64)] += np.frombuffer(r.counts, dtype=np.int64)
    return total


def id_bitmap(ids: DataFrame, bits: int = 20) -> np.ndarray:
    """Which of 2^bits hash cells the values of the first column (longs) fall in: a bounded filter without false negatives."""

    def run(batches):
        cells, task = Cells(bits), TaskContext.get().partitionId()
        for b in batches:
            cells.add(mix64(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
        rows = list(cells.rows())
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["task", "block", "at", "counts"]
        )

    return sum_cells(ids.mapInArrow(run, "task int, block int, at binary, counts binary"), bits) > 0


def in_bitmap(ids: pa.Array, bitmap: np.ndarray) -> np.ndarray:
    return bitmap[(mix64(ids.to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(len(bitmap) - 1)).astype(np.int64)]


# ---------------------------------------------------------------- connected components
def connected_components(stage: Stage, edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node that edges (a, b) reach, the node itself included.

    Alternating large-star and small-star rounds on aggregated minima: each round shuffles only the edges
    left, no neighbour list is gathered, and each round is written to the shared folder. Null ends are
    ignored; no edges give an empty table.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    cur = stage.write(e, "edges")
    old = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage.write(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hop = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stage.write(hop.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        sign = tuple(new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        stage.drop(cur, large)
        cur = new
        if sign == old or not sign[0]:
            break
        old = sign
    low = cur.groupBy("v").agg(F.lit(1).alias("one")).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stage.write(cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(low), "components")
