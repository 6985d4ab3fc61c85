"""Benchmark decontamination by template canonicalisation, window hash join and slot consistency."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, id_bitmap, in_bitmap, lean, mix64, ngram_hashes, prefix_hash, span_hash, text_chunks, word_spans

#: Units that may follow a number (fixed values).
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ml cl l litre litres liter liters "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars cent cents euro euros pound pounds usd eur gbp hz khz mhz w kw v kb mb gb"
).split()
_KINDS = {"number": np.uint64(0x1D8E4E27C47D124F), "name": np.uint64(0x72B5A1C3E0F4D689), "unit": np.uint64(0x3C79AC492BA7B653)}

_DIGIT, _UPPER, _SOLID = (np.zeros(256, dtype=bool) for _ in range(3))
_DIGIT[48:58] = True
_UPPER[65:91] = True
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True


def _word_hash(words: list[str]) -> np.ndarray:
    buf = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    end = np.cumsum([len(w.encode()) for w in words])
    return span_hash(prefix_hash(buf), np.concatenate([[0], end[:-1]]), end)


class Templates:
    """Tokens of texts laid end to end: their spans, literal hashes, and template hashes with typed placeholders.

    Tokens are words without the punctuation around them, A-Z lower-cased. One that starts with a digit is a
    number; a unit word behind a number is a unit; one with a capital first letter only, not at the start of a
    sentence, is a name.
    """

    def __init__(self, buf: np.ndarray, bounds: np.ndarray):
        raw_start, raw_end, first = word_spans(buf, bounds)
        solid = np.flatnonzero(_SOLID[buf])
        if len(solid):
            lo = np.searchsorted(solid, raw_start)
            hi = np.searchsorted(solid, raw_end)
        else:
            lo = hi = np.zeros(len(raw_start), dtype=np.int64)
        real = hi > lo
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))[real]
        self.start, self.end = solid[lo[real]] if len(solid) else raw_start[:0], solid[hi[real] - 1] + 1 if len(solid) else raw_end[:0]
        self.first = np.searchsorted(text, np.arange(len(bounds)))
        n = len(self.start)
        opens = np.ones(n, dtype=bool)
        #: whether a token, or the end, stands first on its line
        self.new_line = np.ones(n + 1, dtype=bool)
        if n > 1:
            tail = buf[raw_end[real][:-1] - 1]
            opens[1:] = np.isin(tail, np.frombuffer(b".!?:", dtype=np.uint8)) | (text[1:] != text[:-1])
            line = np.cumsum(np.concatenate([[0], buf == 10]))
            self.new_line[1:n] = (line[self.start[1:]] != line[self.start[:-1]]) | (text[1:] != text[:-1])
            opens[1:] |= self.new_line[1:n]
        self.literal = span_hash(prefix_hash(buf), self.start, self.end)
        head = buf[self.start] if n else buf[:0]
        second = buf[np.minimum(self.start + 1, self.end - 1)] if n else head
        number = _DIGIT[head]
        unit = np.isin(self.literal, _UNIT_HASH)
        unit[1:] &= number[:-1] & (text[1:] == text[:-1])
        unit[:1] = False
        name = _UPPER[head] & ~opens & ~(_UPPER[second] & (self.end - self.start > 1))
        self.slot = number | unit | name
        self.template = self.literal.copy()
        for mask, kind in ((name, "name"), (unit, "unit"), (number, "number")):
            self.template[mask] = _KINDS[kind]

    def windows(self, size: int, least: int, shortest: int):
        """(text, place in it, token number, hash) of all windows with at least `least` literal tokens; literal windows too.

        Windows of less than `shortest` tokens are whole lines only.
        """
        n = len(self.start)
        if n < size:
            z = np.zeros(0, dtype=np.int64)
            return z, z, z, np.zeros(0, dtype=np.uint64)
        at = np.arange(n - size + 1)
        text = np.searchsorted(self.first, at, side="right") - 1
        whole = at + size <= self.first[text + 1]
        if size < shortest:
            whole &= self.new_line[at] & self.new_line[at + size]
            for k in range(1, size):
                whole &= ~self.new_line[at + k]
        slots = np.concatenate([[0], np.cumsum(self.slot)])
        used = slots[at + size] - slots[at]
        salt = np.uint64(size)
        found = []
        for h, fit, seed in ((self.literal, whole, 0x11), (self.template, whole & (used > 0) & (size - used >= least), 0x7777)):
            pick = np.flatnonzero(fit)
            found.append((text[pick], pick - self.first[text[pick]], pick, mix64(ngram_hashes(h, size)[pick] + np.uint64(seed) * salt)))
        return tuple(np.concatenate(x) for x in zip(*found))


_UNIT_HASH = _word_hash(UNITS)
_ROWS = "id long, place int, size int, tokens int, h long, slots array<string>"


def _scan(sizes, wanted, least: int, shortest: int):
    """Rows of the windows of all given sizes whose hash passes the filter, with the raw values of their slots."""

    def run(batches):
        for b in batches:
            ids = b["id"].to_pylist()
            for i, j, buf, bounds in text_chunks(b["text"]):
                t = Templates(buf, bounds)
                data = buf.tobytes()
                own = np.diff(t.first)
                cols: list[list] = [[] for _ in range(6)]
                for size in sizes:
                    text, place, at, h = t.windows(size, least, shortest)
                    if wanted is None:
                        # a short text is one window of its own length; longer ones only have windows of the largest size
                        pick = np.flatnonzero(own[text] == size) if size < max(sizes) else np.arange(len(h))
                    else:
                        pick = np.flatnonzero(in_bitmap(pa.array(h.view(np.int64)), wanted.value))
                    for x, p, k, v in zip(text[pick].tolist(), place[pick].tolist(), at[pick].tolist(), h[pick].view(np.int64).tolist()):
                        slots = [data[t.start[q] : t.end[q]].lower().decode("utf-8", "replace") for q in range(k, k + size) if t.slot[q]]
                        for c, y in zip(cols, (ids[i + x], p, size, int(own[x]), v, slots)):
                            c.append(y)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "place", "size", "tokens", "h", "slots"])

    return run


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shortest: int = 5, least_literal: int = 5) -> DataFrame:
    """One row per leaked (doc_id, item_id): windows (number of item windows found), tokens (of the item), exact.

    Items and documents are cut into tokens and canonicalised: numbers, units and names become typed
    placeholders. Every window of `window` tokens of an item is joined by hash with every window of every
    document, in literal form, and in template form if it has a placeholder and `least_literal` literal tokens.
    Windows of a document and an item on one diagonal form a match; it counts if every item slot value stands
    for one document value throughout. exact tells whether all values are the same. Items of fewer tokens
    than window are one window; those of fewer than `shortest` count only where they are a whole line of a
    document, as so few words stand in many texts by chance. Items without a token hold nothing.

    Null and empty texts hold nothing; null ids of either side are left out. Rows that repeat an id are one
    document or item. Other columns are ignored; an empty table on either side gives an empty table. The item
    hashes pass through a filter of fixed size before the join, so that only windows that may match are
    shuffled; the join itself holds for any number of items.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "decontaminate")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text")).where("id is not null and text is not null")
    sizes = list(range(1, window + 1))
    own = stage.write(items.mapInArrow(_scan(sizes, None, least_literal, 0), _ROWS).distinct(), "items")
    used = sorted(r.size for r in own.select("size").distinct().collect())  # at most window numbers
    wanted = spark.sparkContext.broadcast(id_bitmap(own.select("h"), 22))
    found = stage.write(docs.mapInArrow(lean(_scan(used, wanted, least_literal, shortest)), _ROWS).select("id", "place", "h", F.col("slots").alias("values")), "windows")
    both = found.join(own.select(F.col("id").alias("item_id"), F.col("place").alias("item_place"), "h", "tokens", "slots"), "h").where(F.size("slots") == F.size("values"))
    both = both.select(F.col("id").alias("doc_id"), "item_id", (F.col("place") - F.col("item_place")).alias("shift"), "item_place", "tokens", "slots", "values").distinct()
    both = stage.write(both, "matches")
    key = ["doc_id", "item_id", "shift"]
    slots = both.select(*key, F.explode(F.arrays_zip("slots", "values")).alias("s")).select(*key, F.col("s.slots").alias("x"), F.col("s.values").alias("y")).distinct()
    slots = slots.groupBy(*key, "x").agg(F.count("*").alias("n"), F.max(F.col("x") != F.col("y")).alias("other"))
    bad = slots.groupBy(*key).agg(F.max("n").alias("n"), F.max("other").alias("other"))
    whole = both.groupBy(*key).agg(F.count_distinct("item_place").alias("windows"), F.max("tokens").alias("tokens"))
    good = whole.join(bad, key, "left").where("n is null or n = 1")
    return good.groupBy("doc_id", "item_id").agg(F.max("windows").alias("windows"), F.max("tokens").cast("long").alias("tokens"), F.max(~F.coalesce("other", F.lit(False))).alias("exact"))
