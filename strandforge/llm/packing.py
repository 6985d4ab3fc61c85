"""Packing of documents into fixed-width sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, lean
from .ragged_bpe import load

#: Plan entries that may be broadcast. The plan's size depends on the width alone, not on the documents.
MAX_PLAN = 2_000_000


def word_vocabulary() -> str:
    """Path of the installed word-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def shortest_pack_first(histogram: dict[int, int], width: int) -> tuple[int, list[tuple[int, int, int, int, int, int, int]]]:
    """Number of sequences, and (length class, rank from, rank to, start, length, first sequence, offset) entries.

    Lengths are placed longest first into the emptiest packs. Packs with the same pattern are kept as ranges
    with a count, so each step places as many pieces as both the class and the pattern have. As many packs are
    opened as the tokens need at least; a length that exceeds the most space left is cut to fill it, and its rest
    goes back into the histogram. All sequences together hold less than one width of padding.
    """
    total = sum(k * n for k, n in histogram.items() if k > 0)
    packs = -(-total // width)
    items: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    for k, n in histogram.items():
        if k > 0 and n > 0:
            items[k].append((k, 0, n, 0))
    room = {width: [(0, packs)]}
    spaces, lengths = [-width], [-k for k in items]
    heapq.heapify(lengths)
    out = []
    while lengths:
        size = -lengths[0]
        todo = items[size]
        if not todo:
            heapq.heappop(lengths)
            del items[size]
            continue
        space = -spaces[0]
        free = room[space]
        if not free:
            heapq.heappop(spaces)
            del room[space]
            continue
        cls, lo, hi, start = todo.pop()
        seq, m = free.pop()
        k, piece = min(hi - lo, m), min(size, space)
        out.append((cls, lo, lo + k, start, piece, seq, width - space))
        if lo + k < hi:
            todo.append((cls, lo + k, hi, start))
        if k < m:
            free.append((seq + k, m - k))
        if piece < space:
            if space - piece not in room:
                room[space - piece] = []
                heapq.heappush(spaces, piece - space)
            room[space - piece].append((seq, k))
        if piece < size:
            if size - piece not in items:
                heapq.heappush(lengths, piece - size)
            items[size - piece].append((cls, lo, lo + k, start + piece))
    return packs, out


def by_rank(plan) -> dict[int, tuple[list[int], list[list[tuple[int, int, int, int]]]]]:
    """For each class the first ranks of its finest intervals, and each interval's (start, length, sequence - rank, offset)."""
    found = {}
    classes = defaultdict(list)
    for cls, lo, hi, start, length, seq, offset in plan:
        classes[cls].append((lo, hi, start, length, seq - lo, offset))
    for cls, rows in classes.items():
        marks = sorted({r[0] for r in rows})
        parts = [[] for _ in marks]
        at = {m: i for i, m in enumerate(marks)}
        for lo, hi, *piece in sorted(rows, key=lambda r: r[2]):
            i = at[lo]
            while i < len(marks) and marks[i] < hi:
                parts[i].append(tuple(piece))
                i += 1
        found[cls] = (marks, parts)
    return found


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", width: int = 4096, end_id: int = 2, max_plan: int = MAX_PLAN) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    A document is its token ids and then end_id; a null or empty text is end_id alone. Each document's whole
    multiples of width fill sequences of their own; the rest enters the length histogram (below width entries, all
    that reaches the driver), whose plan places ranks of each length. Ranks are counted within the tasks that
    tokenised, and shifted by running sums of (length, task) counts, so that no length's documents meet in
    one task. Pieces of a sequence fill it from 0 without gaps; what is left at its end is padding. Ids may be
    null or repeat, each row is a document. Other columns are ignored; an empty table gives an empty table.
    A plan of more than max_plan entries is an error, since it is broadcast; it grows with the width alone.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "packing")
    wide = 1 << 16

    def tokenise(batches):
        bpe = load(tokenizer_path)
        kind = np.uint16 if max(bpe.size, end_id + 1) <= wide else np.uint32
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        full = 0
        for b in batches:
            n, rank, before, ids = [], [], [], []
            for x in bpe.encode([t or "" for t in b["text"].to_pylist()]):
                m = len(x) + 1
                n.append(m)
                rank.append(seen[m % width])
                seen[m % width] += 1
                before.append(full)
                full += m // width
                ids.append(np.append(x, end_id).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array([x % width for x in n], pa.int32()), pa.array([part] * len(n), pa.int32()), pa.array(rank, pa.int64()), pa.array(before, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n", "rest", "part", "rank", "full", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stage.write(rows.mapInArrow(lean(tokenise), "doc_id long, n long, rest int, part int, rank long, full long, ids binary"), "ids")
    sizes = rows.groupBy("rest", "part").agg(F.count("*").alias("m"))
    histogram = {r.rest: r.m for r in sizes.groupBy("rest").agg(F.sum("m").alias("m")).collect()}
    packs, plan = shortest_pack_first(histogram, width)
    if len(plan) > max_plan:
        raise ValueError(f"a plan of {len(plan)} entries for width {width} is too large to broadcast")
    table = spark.sparkContext.broadcast(by_rank(plan))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("rest", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    ranked = rows.join(base, ["rest", "part"]).select("doc_id", "n", "rest", "part", (F.col("rank") + F.col("base")).alias("rank"), "full", "ids")

    def cut(batches):
        places = table.value
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, n, rest, part, rank, full, raw in zip(*(b[c].to_pylist() for c in ("doc_id", "n", "rest", "part", "rank", "full", "ids"))):
                ids = np.frombuffer(raw, dtype=np.uint16 if len(raw) == 2 * n else np.uint32).astype("<u4").tobytes()
                pieces = [(i * width, width, (1 << 62) + (part << 32) + full + i, 0) for i in range(n // width)]
                if rest:
                    marks, parts = places[rest]
                    pieces += [(n - rest + start, size, shift + rank, offset) for start, size, shift, offset in parts[bisect_right(marks, rank) - 1]]
                for start, size, seq, offset in pieces:
                    for col, v in zip(cols, (doc, start, size, n, seq, offset, ids[4 * start : 4 * (start + size)])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return ranked.mapInArrow(lean(cut), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
