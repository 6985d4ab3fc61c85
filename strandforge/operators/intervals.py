"""Interval joins, islands and box clustering on coordinate columns (closed intervals)."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from ..staging import SHORT_ROWS, SHUFFLED_ONCE, staged

#: Bins grow by this factor from level to level; an interval takes the first level where it meets few bins.
LEVEL_FACTOR, LEVELS, FEW = 64, 4, 32
#: Least width of the bins in which spans are counted, and the rows that a task holds of one bin before it adds them up.
SWEEP_WIDTH, HELD = 8192, 1 << 20
#: Most right spans that every task may hold at once, stretches into which they are dealt then, left rows that travel as one and that are counted at once.
HOLD, STRETCHES, PACK, COUNTED = 1 << 21, 512, 1 << 14, 1 << 17
#: Numbered values of held right spans whose sums travel as one; twice as many are told by two bytes.
NUMBERS = 1 << 12


def _width(bin_size: int, level: str):
    return f"({bin_size} * cast(power({LEVEL_FACTOR}, {level}) as bigint))"


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], how: str = "inner", left_id: list[str] | None = None, bin_size: int = 256) -> DataFrame:
    """Rows of left and right with equal keys whose closed spans overlap.

    Both sides are dealt into bins and joined by (keys, level, bin), so one busy key spreads over its bins; the
    bin of the later start alone reports a pair, so nothing is counted twice. Long spans use wider bins: a pair
    meets at the level of its longer span, the right one of equals, so no span is dealt into more than a few bins a level.
    Bins are narrow, since all pairs of a bin are compared.
    how: inner, left, left_semi or left_anti; all but inner need left_id, columns that tell left rows apart. Semi and
    anti joins count spans (Sweep) and make no pairs, but for left rows too wide for that.
    Null keys or ends match nothing; columns other than the keys must not share names.
    """
    ls, le = left_span
    rs, re = right_span
    level = lambda s, e: f"least({LEVELS - 1}, cast(ceil(log({LEVEL_FACTOR}, greatest(1, ({e} - {s}) / {float(bin_size * FEW)}))) as int))"
    # negative codes: the left span is the longer, at level -code; others: the right span's level
    r_codes = f"concat(array({level(rs, re)}), transform(filter(sequence(1, {LEVELS - 1}), i -> i > {level(rs, re)}), i -> -i))"
    l_codes = f"filter(concat(array(-{level(ls, le)}), filter(sequence(0, {LEVELS - 1}), i -> i >= {level(ls, le)})), i -> i >= 0 or {level(ls, le)} > 0)"

    def dealt(df: DataFrame, codes: str, s: str, e: str) -> DataFrame:
        rows = df.where(f"{s} <= {e}").withColumn("_level", F.explode(F.expr(f"array_distinct({codes})")))
        return rows.withColumn("_bin", F.explode(F.expr(f"sequence({s} div {_width(bin_size, 'abs(_level)')}, {e} div {_width(bin_size, 'abs(_level)')})")))

    r = dealt(right, r_codes, rs, re)
    used = F.broadcast(r.select("_level").distinct())  # at most 2 * LEVELS - 1 rows
    # a plan by size would broadcast the right rows, which may be many once dealt
    pairs = dealt(left, l_codes, ls, le).join(used, "_level", "left_semi").join(r.hint("merge"), [*keys, "_level", "_bin"]).where(f"greatest({ls}, {rs}) <= least({le}, {re}) and greatest({ls}, {rs}) div {_width(bin_size, 'abs(_level)')} = _bin").drop("_level", "_bin")
    if how == "inner":
        return pairs
    if how == "left":
        missing = interval_join(left, right, keys, left_span, right_span, "left_anti", left_id, bin_size)
        return pairs.unionByName(missing, allowMissingColumns=True)
    sweep = Sweep(left, right, keys, left_span, right_span)
    found = sweep.counts(sweep.narrow).where("n_same > 0" if how == "left_semi" else "n_same = 0").select(*left.columns)
    if sweep.rest is None:
        return found
    wide = interval_join(sweep.rest, right, keys, left_span, right_span, "inner", None, bin_size)
    return found.unionByName(sweep.rest.join(wide.select(*left_id).distinct(), left_id, how))


class _Spans:
    """Spans of one bin, which tell how many of them others meet, and which one if it is the only one."""

    def __init__(self, s: np.ndarray, e: np.ndarray, number: np.ndarray):
        a, b = np.argsort(s), np.argsort(e)
        self.s, self.e = s[a], e[b]
        self.sum_s, self.sum_e = (np.concatenate([[0], np.cumsum(number[k])]) for k in (a, b))

    def meet(self, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # those that start in time, less those that ended before
        a, b = np.searchsorted(self.s, e, side="right"), np.searchsorted(self.e, s, side="left")
        return a - b, self.sum_s[a] - self.sum_e[b]


class _Bin:
    """The right spans of one bin, and those of them with a given mark."""

    def __init__(self, parts: list[pa.RecordBatch], like: pa.Schema):
        self.rows = pa.Table.from_batches(parts, like).combine_chunks()
        self.s, self.e = (self.rows[c].to_numpy() for c in ("_s", "_e"))
        self.all = _Spans(self.s, self.e, np.arange(len(self.s)))
        self._marked: dict = {}

    def same(self, mark) -> np.ndarray:
        if mark is None:
            return np.zeros(len(self.s), dtype=bool)
        return pc.fill_null(pc.equal(self.rows["_mark"], mark), False).to_numpy()

    def marked(self, mark) -> _Spans:
        if mark not in self._marked:
            at = np.flatnonzero(self.same(mark))
            self._marked[mark] = _Spans(self.s[at], self.e[at], at)
        return self._marked[mark]


def _by_bin(batches):
    """(right spans, left rows) of one bin after the other; the left rows of a bin may come in several parts."""
    parts, now, found = [], None, None
    for b in batches:
        g = b["_g"].to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]]) if len(g) else [0]
        for i, j in zip(cut[:-1], cut[1:]):
            rows = b.slice(i, j - i)
            if now is None or g[i] >> 1 != now[0]:
                # bins are sorted by a hash, so two of one hash must not pass for one
                parts, found, now = [], None, (g[i] >> 1, rows["_key"][0])
            if pc.any(pc.not_equal(rows["_key"], now[1])).as_py():
                raise ValueError("two bins have one hash; take another bin width")
            if g[i] & 1:
                found = found or _Bin(parts, b.schema)
                yield found, rows
            else:
                parts.append(rows)


def _key(keys: list[str]):
    """The keys as one string, with lengths, so that no two lists of keys read alike."""
    return F.concat(*(x for k in keys for x in (F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string"))))


def _sums(bin_: _Bin, rows: pa.Table, n: np.ndarray, by: list[str], plain: bool):
    """Of the 1/n that each left row gives to each right span it meets, the sums by (by, mark) and right span: a left row, spans, same, sums."""
    s, e = rows["_s"].to_numpy(), rows["_e"].to_numpy()
    # whole numbers of 2^-62 in two halves, so that what is added and taken off again leaves nothing
    q = (1 << 62) // n
    codes = np.zeros(len(n), dtype=np.int64)
    for c in [*(f"l_{c}" for c in by), "_mark"]:
        x = rows[c].combine_chunks().dictionary_encode(null_encoding="encode")
        x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
        codes = np.unique(codes * (len(x.dictionary) + 1) + x.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
        first, last = at[np.argsort(s[at])], at[np.argsort(e[at])]
        a, b = np.searchsorted(s[first], bin_.e, side="right"), np.searchsorted(e[last], bin_.s, side="left")
        half = lambda f: np.concatenate([[0], np.cumsum(f(q[first]))])[a] - np.concatenate([[0], np.cumsum(f(q[last]))])[b]
        high, low = half(lambda x: x >> 31), half(lambda x: x & (1 << 31) - 1)
        hit = np.flatnonzero((high > 0) | (low > 0))
        mark = rows["_mark"][int(at[0])].as_py()
        same = np.ones(len(hit), dtype=bool) if plain else bin_.same(mark)[hit]
        yield int(at[0]), hit, same, high[hit] * 2.0**-31 + low[hit] * 2.0**-62


def _added(bin_: _Bin, rows: pa.Table, n: np.ndarray, by: list[str], keep: list[str], plain: bool):
    for one, hit, same, share in _sums(bin_, rows, n, by, plain):
        own = [rows[f"l_{c}"].take(pa.array(np.full(len(hit), one))).combine_chunks() for c in by]
        yield pa.RecordBatch.from_arrays([*own, pa.array(same), *(bin_.rows[f"r_{c}"].take(pa.array(hit)).combine_chunks() for c in keep), pa.array(share)], names=[*by, "same", *keep, "share"])


class Sweep:
    """How many right spans each left row meets, and sums over left rows for each right span, without a row a pair.

    A left row is dealt into the bin of its start, a right span into all bins it meets and the one before; a bin's right
    spans are sorted by starts and by ends, and two searches tell how many of them a left row meets. Bins are as wide as the
    mean right span at least, so right spans are dealt into few in all. Work grows with both tables, not with the pairs.
    narrow: the left rows that this counts; rest: the others (wider than a bin, or without keys or ends), None if there are none.
    same: (left, right) columns whose equal values make a pair "same"; without them all pairs are.
    """

    def __init__(self, left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], same: tuple[str, str] | None = None, width: int | None = None):
        (ls, le), (rs, re) = left_span, right_span
        ship(left.sparkSession)
        self.same, self.keys, self.left_span = same, keys, left_span
        valid = " and ".join([f"{ls} <= {le}", *(f"{k} is not null" for k in keys)])
        right = right.where(" and ".join([f"{rs} <= {re}", *(f"{k} is not null" for k in keys)]))
        size = left.agg(F.count("*").alias("n"), F.count_if(F.expr(valid)).alias("valid"), F.max(F.expr(f"if({valid}, {le} - {ls}, 0)")).alias("most"), F.avg(F.expr(f"if({valid}, {le} - {ls}, null)")).alias("mean")).first()
        self.width = width or int(max(SWEEP_WIDTH, 4 * (size.mean or 0), right.agg(F.avg(F.expr(f"{re} - {rs}"))).first()[0] or 0))
        narrow = F.coalesce(F.expr(f"{valid} and {le} - {ls} <= {self.width}"), F.lit(False))
        self.narrow = left.where(narrow)
        self.rest = None if size.n == size.valid and (size.most or 0) <= self.width else left.where(~narrow)
        self.right = right.withColumn("_bin", F.explode(F.expr(f"sequence({rs} div {self.width} - 1, {re} div {self.width})"))).withColumns({"_s": F.col(rs).cast("long"), "_e": F.col(re).cast("long")})

    def _dealt(self, left: DataFrame, left_cols: list[str], right_cols: list[str]) -> DataFrame:
        ls, le = self.left_span
        mark = [F.col(self.same[i]).cast("string") if self.same else F.lit("") for i in range(2)]

        def cut(df: DataFrame, side: int, own: list[str], others: list) -> DataFrame:
            df = df.withColumns({"_key": F.concat(_key(self.keys), F.col("_bin").cast("string")), "_mark": mark[side]})
            g = F.xxhash64("_key").bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(1 - side)).alias("_g")
            return df.select(g, "_key", "_mark", "_s", "_e", *(F.col(c).alias(f"{'lr'[side]}_{c}") for c in own), *others)

        none = lambda df, cols, p: [F.lit(None).cast(df.schema[c].dataType).alias(f"{p}_{c}") for c in cols]
        rows = left.withColumns({"_bin": F.expr(f"{ls} div {self.width}"), "_s": F.col(ls).cast("long"), "_e": F.col(le).cast("long")})
        a, b = cut(rows, 0, left_cols, none(self.right, right_cols, "r")), cut(self.right, 1, right_cols, none(left, left_cols, "l"))
        return a.unionByName(b).repartition(F.shiftright("_g", 1)).sortWithinPartitions("_g")

    def counts(self, left: DataFrame, keep: list[str] = []) -> DataFrame:
        """The left rows with n_same, n_other and, for each right column c of keep, same_c and other_c of the only such span."""
        cols, plain = left.columns, self.same is None

        def run(batches):
            for bin_, rows in _by_bin(batches):
                s, e = rows["_s"].to_numpy(), rows["_e"].to_numpy()
                n, number = bin_.all.meet(s, e)
                n_same, which = (n, number) if plain else (np.zeros(len(s), dtype=np.int64), np.zeros(len(s), dtype=np.int64))
                for mark in [] if plain else pc.unique(rows["_mark"]).to_pylist():
                    if mark is not None:
                        at = np.flatnonzero(pc.fill_null(pc.equal(rows["_mark"], mark), False).to_numpy(zero_copy_only=False))
                        n_same[at], which[at] = bin_.marked(mark).meet(s[at], e[at])
                one = lambda m, k: pa.array(np.where(m == 1, k, 0), mask=m != 1)
                a, b = one(n_same, which), one(n - n_same, number - which)
                kept = [bin_.rows[f"r_{c}"].combine_chunks().take(x) for c in keep for x in (a, b)] if len(bin_.s) else [pa.nulls(len(s), rows.schema.field(f"r_{c}").type) for c in keep for _ in (a, b)]
                yield pa.RecordBatch.from_arrays([*(rows[f"l_{c}"] for c in cols), pa.array(n_same), pa.array(n - n_same), *kept], names=[*cols, "n_same", "n_other", *(f"{o}_{c}" for c in keep for o in ("same", "other"))])

        kind = lambda df, c: df.schema[c].dataType.simpleString()
        schema = [f"`{c}` {kind(left, c)}" for c in cols] + ["n_same long", "n_other long"] + [f"`{o}_{c}` {kind(self.right, c)}" for c in keep for o in ("same", "other")]
        return self._dealt(left, cols, keep).mapInArrow(run, ", ".join(schema))

    def shares(self, left: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
        """Parts of the sums by (by, same, keep) to which each left row gives 1/n for each of the n right spans it meets."""
        plain = self.same is None

        def added(bin_, held):
            return _added(bin_, pa.Table.from_batches([r for r, _ in held]).combine_chunks(), np.concatenate([n for _, n in held]), by, keep, plain)

        def run(batches):
            now, held = None, []
            for bin_, rows in _by_bin(batches):
                if held and (bin_ is not now or sum(len(n) for _, n in held) > HELD):
                    yield from added(now, held)
                    held = []
                now, n = bin_, bin_.all.meet(rows["_s"].to_numpy(), rows["_e"].to_numpy())[0]
                hit = np.flatnonzero(n)
                if len(hit):
                    held.append((rows.take(pa.array(hit)), n[hit]))
            if held:
                yield from added(now, held)

        kind = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
        schema = [*(kind(left, c) for c in by), "same boolean", *(kind(self.right, c) for c in keep), "share double"]
        return self._dealt(left, by, keep).mapInArrow(run, ", ".join(schema))


class _Axis:
    """Spans of many groups behind one another on one axis, so that rows of all groups are searched for at once."""

    def __init__(self, group: np.ndarray, s: np.ndarray, e: np.ndarray, number: np.ndarray, groups: int):
        self.low, self.high = np.zeros(groups, dtype=np.int64), np.full(groups, -1, dtype=np.int64)
        some = np.unique(group)
        for k, i, j in zip(some, np.searchsorted(group, some), np.searchsorted(group, some, side="right")):
            self.low[k], self.high[k] = s[i:j].min(), e[i:j].max()
        # a place before and one behind each group's spans
        self.at = np.concatenate([[0], np.cumsum(self.high - self.low + 3)])[:-1]
        self.spans = _Spans(self._place(group, s), self._place(group, e), number)

    def _place(self, group: np.ndarray, x: np.ndarray) -> np.ndarray:
        low = self.low[group]
        return np.clip(x, low - 1, self.high[group] + 1) - low + 1 + self.at[group]

    def meet(self, group: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As _Spans.meet; groups below 0 have no spans. Fast if s is sorted within groups."""
        s, e = (np.where(group < 0, -1, self._place(group, x)) if len(self.at) else np.full(len(x), -1) for x in (s, e))
        return self.spans.meet(s, e)


class _HeldSpans:
    """All right spans, as a task holds them."""

    def __init__(self, raw: bytes):
        self.rows = pa.ipc.open_stream(raw).read_all().sort_by([("_key", "ascending"), ("_s", "ascending")]).combine_chunks()
        self.s, self.e = (self.rows[c].to_numpy() for c in ("_s", "_e"))
        self.keys, key = self._codes(self.rows["_key"], {})
        self.marks, mark = self._codes(self.rows["_mark"], {})
        self.first = np.searchsorted(key, np.arange(len(self.keys) + 1))
        self.all = _Axis(key, self.s, self.e, np.arange(len(key)), len(self.keys))
        pair = np.where(mark < 0, -1, key * len(self.marks) + mark)
        at = np.argsort(pair, kind="stable")[np.count_nonzero(pair < 0) :]
        self.marked = _Axis(pair[at], self.s[at], self.e[at], at, len(self.keys) * len(self.marks))

        self.rows = self.rows.append_column("_row", pa.array(np.arange(len(key))))
        self._numbers: dict = {}

    def numbers(self, keep: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first row of each value of the columns keep, in order, and of each row which of them it has."""
        if tuple(keep) not in self._numbers:
            code = np.zeros(len(self.s), dtype=np.int64)
            for c in keep:
                x = self.rows[f"r_{c}"].combine_chunks().dictionary_encode(null_encoding="encode")
                x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
                code = np.unique(code * (len(x.dictionary) + 1) + x.indices.to_numpy(), return_inverse=True)[1]
            first, code = np.unique(code, return_index=True, return_inverse=True)[1:]
            self._numbers[tuple(keep)] = np.sort(first), np.argsort(np.argsort(first))[code]
        return self._numbers[tuple(keep)]

    @staticmethod
    def _codes(x: pa.ChunkedArray, known: dict) -> tuple[dict, np.ndarray]:
        """Numbers of the values, which are those in known, or, if that is empty, new ones; -1 for null and others."""
        x = x.combine_chunks().dictionary_encode()
        x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
        known = known or {v: k for k, v in enumerate(x.dictionary.to_pylist())}
        code = np.array([*(known.get(v, -1) for v in x.dictionary.to_pylist()), -1], dtype=np.int64)
        return known, code[pc.fill_null(x.indices, -1).to_numpy(zero_copy_only=False)]

    def meet(self, rows: pa.Table, plain: bool) -> tuple[np.ndarray, ...]:
        """Of each left row how many spans it meets, the sum of their numbers, and the same for spans of its mark."""
        s, e = rows["_s"].to_numpy(), rows["_e"].to_numpy()
        key = self._codes(rows["_key"], self.keys)[1] if self.keys else np.full(len(s), -1)
        at = np.lexsort((s, key))
        back = np.empty_like(at)
        back[at] = np.arange(len(at))
        s, e, key = s[at], e[at], key[at]
        n, number = (x[back] for x in self.all.meet(key, s, e))
        if plain:
            return n, number, n, number
        mark = self._codes(rows["_mark"], self.marks)[1][at] if self.marks else np.full(len(s), -1)
        return n, number, *(x[back] for x in self.marked.meet(np.where((key < 0) | (mark < 0), -1, key * len(self.marks) + mark), s, e))

    def near(self, key, s: int, e: int) -> _Bin:
        """The spans of a key that meet a stretch."""
        k = self.keys.get(key)
        i, j = (0, 0) if k is None else self.first[k : k + 2]
        at = i + np.flatnonzero((self.s[i:j] <= e) & (self.e[i:j] >= s))
        return _Bin(self.rows.take(pa.array(at)).to_batches(), self.rows.schema)


_opened: dict[str, _HeldSpans] = {}


def _open(held) -> _HeldSpans:
    """Once in each worker; the last two stay."""
    name, raw = held.value
    if name not in _opened:
        while len(_opened) > 1:
            del _opened[next(iter(_opened))]
        _opened[name] = _HeldSpans(raw)
    return _opened[name]


def _joined(batches, most: int):
    """Tables of at least so many rows, but the last."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _short(x: np.ndarray) -> pa.Array:
    """Numbers from 0 on, in as few bytes as the largest needs."""
    return pa.array(x.astype(np.min_scalar_type(int(x.max(initial=0)))))


def _packed(rows: pa.Table, width: int) -> pa.RecordBatch:
    """Left rows by (key, stretch), as compressed bytes; starts are differences."""
    rows = pa.table({c: rows[c].combine_chunks() if c in ("_s", "_e", "_n") else rows[c].combine_chunks().dictionary_encode() for c in rows.column_names})
    key, s = rows["_key"].combine_chunks(), rows["_s"].to_numpy()
    key = key.chunk(0) if isinstance(key, pa.ChunkedArray) else key
    order = np.lexsort((s, key.indices.to_numpy()))
    rows, k, s = rows.drop(["_key"]).take(pa.array(order)).combine_chunks(), key.indices.to_numpy()[order], s[order]
    size, at, step = rows["_e"].to_numpy() - s, s // width, np.diff(s, prepend=0)
    cut = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (at[1:] != at[:-1])) + 1, [len(s)]])
    cut = [(x, min(x + PACK, j)) for i, j in zip(cut[:-1], cut[1:]) for x in range(i, j, PACK)]
    out = []
    for i, j in cut:
        part = rows.slice(i, j - i)
        step[i] = 0
        part = part.set_column(part.column_names.index("_s"), "_s", _short(step[i:j])).set_column(part.column_names.index("_e"), "_e", _short(size[i:j]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(part)
        out.append(sink.getvalue().to_pybytes())
    names = key.dictionary.to_pylist()
    return pa.RecordBatch.from_arrays([pa.array([names[k[i]] for i, _ in cut], pa.string()), pa.array([at[i] for i, _ in cut], pa.int64()), pa.array([s[i] for i, _ in cut], pa.int64()), pa.array(out, pa.binary())], names=["_key", "_bin", "_from", "_rows"])


def _unpacked(raws: list[tuple[int, bytes]]) -> pa.Table:
    parts = []
    for first, raw in raws:
        t = pa.ipc.open_stream(raw).read_all()
        s = first + np.cumsum(t["_s"].to_numpy().astype(np.int64))
        put = {"_s": pa.array(s), "_e": pa.array(s + t["_e"].to_numpy().astype(np.int64))}
        parts.append(pa.table({c: put.get(c, t[c].cast(t[c].type.value_type) if pa.types.is_dictionary(t[c].type) else t[c]) for c in t.column_names}))
    return pa.concat_tables(parts).combine_chunks()


def _sums_packed(which: np.ndarray, share: np.ndarray) -> bytes:
    """Sums of sorted numbers below 2 * NUMBERS; of the differences, the second bytes are nearly all 0 and compress."""
    return np.diff(which, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes() + share.astype("<f8").tobytes()


def _sums_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 10
    which = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 2 * n).reshape(2, n).T).view("<u2").ravel()
    return np.cumsum(which.astype(np.int64)), np.frombuffer(raw, "<f8", n, 2 * n)


class Held:
    """What Sweep tells, with all right spans, of which there are HOLD at most, in every task.

    Left rows may be of any width and are counted where they are read. Only to add up shares do they travel, packed by
    (key, stretch of positions), without the columns that tell them apart.
    narrow: the left rows that can meet any span; keep: the columns of the right spans that are asked for.
    """

    def __init__(self, left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], same: tuple[str, str] | None, keep: list[str]):
        spark = left.sparkSession
        ship(spark)
        self.same, self.keys, self.left_span = same, keys, left_span
        valid = lambda s, e: " and ".join([f"{s} <= {e}", *(f"{k} is not null" for k in keys)])
        self.narrow, self.right, self.rest = left.where(valid(*left_span)), right, None
        rows = self._spans(right.where(valid(*right_span)), 1, right_span, [F.col(c).alias(f"r_{c}") for c in keep]).toArrow()
        ends = rows.group_by("_key").aggregate([("_s", "min"), ("_e", "max")])
        self.width = max(SWEEP_WIDTH, sum(e - s for s, e in zip(ends["_s_min"].to_pylist(), ends["_e_max"].to_pylist())) // STRETCHES)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(rows)
        self.held = spark.sparkContext.broadcast((uuid.uuid4().hex, sink.getvalue().to_pybytes()))

    def _spans(self, df: DataFrame, side: int, span: tuple[str, str], others: list) -> DataFrame:
        mark = F.col(self.same[side]).cast("string") if self.same else F.lit("")
        key = _key(self.keys) if len(self.keys) > 1 else F.col(self.keys[0]).cast("string")
        return df.select(key.alias("_key"), mark.alias("_mark"), F.col(span[0]).cast("long").alias("_s"), F.col(span[1]).cast("long").alias("_e"), *others)

    def counts(self, left: DataFrame, cols: list[str], keep: list[str], only: bool = False) -> DataFrame:
        """cols of the left rows that meet spans, with n_same, n_other and, for each c of keep, same_c and other_c of the only such span.

        only: the left rows alone that have one such span of either kind.
        """
        plain, held = self.same is None, self.held

        def run(batches):
            spans = _open(held)
            for rows in _joined(batches, COUNTED):
                n, number, n_same, which = spans.meet(rows, plain)
                other, rest = n - n_same, number - which
                hit = np.flatnonzero((n_same == 1) | (other == 1) if only else n > 0)
                if len(hit):
                    one = lambda m, k: pa.array(np.where(m == 1, k, 0)[hit], mask=(m != 1)[hit])
                    kept = [spans.rows[f"r_{c}"].take(x).combine_chunks() for c in keep for x in (one(n_same, which), one(other, rest))]
                    out = [*(rows[f"l_{c}"].take(pa.array(hit)).combine_chunks() for c in cols), pa.array(n_same[hit]), pa.array(other[hit]), *kept]
                    yield pa.RecordBatch.from_arrays(out, names=[*cols, "n_same", "n_other", *(f"{o}_{c}" for c in keep for o in ("same", "other"))])

        kind = lambda df, c: df.schema[c].dataType.simpleString()
        schema = [f"`{c}` {kind(left, c)}" for c in cols] + ["n_same long", "n_other long"] + [f"`{o}_{c}` {kind(self.right, c)}" for c in keep for o in ("same", "other")]
        return self._spans(left, 0, self.left_span, [F.col(c).alias(f"l_{c}") for c in cols]).mapInArrow(run, ", ".join(schema))

    def sums(self, parts: list[tuple[DataFrame, str | None]], by: list[str], keep: list[str]) -> DataFrame:
        """Sums by (by, same, keep) to which each left row gives 1/n for each right span it meets.

        parts: left rows, and the column that has n; without one, n are the spans that the row meets. What is added up
        travels by numbers of the held values, a few thousand together, about nine bytes a sum.
        """
        held, group = self.held, [*by, "_bucket"]
        found = self._shares(*parts[0], by, keep)
        for part in parts[1:]:
            found = found.unionByName(self._shares(*part, by, keep))

        def out(own, schema, sums, count):
            spans, hit = _open(held), np.flatnonzero(count)
            number = own[-1] * NUMBERS + (hit >> 1)
            at = pa.array(spans.numbers(keep)[0][number])
            mine = [pa.array([x] * len(hit), schema.field(c).type) for c, x in zip(by, own)]
            return pa.RecordBatch.from_arrays([*mine, pa.array((hit & 1).astype(bool)), *(spans.rows[f"r_{c}"].take(at).combine_chunks() for c in keep), pa.array(sums[hit])], names=[*by, "same", *keep, "share"])

        def run(batches):
            now = None
            for b in batches:
                for *own, raw in zip(*(b[c].to_pylist() for c in [*group, "_sums"])):
                    if now != own:
                        if now is not None:
                            yield out(now, b.schema, sums, count)
                        now, sums, count = own, np.zeros(2 * NUMBERS), np.zeros(2 * NUMBERS, dtype=np.int64)
                    which, share = _sums_of(raw)
                    sums += np.bincount(which, share, 2 * NUMBERS)
                    count += np.bincount(which, minlength=2 * NUMBERS)
            if now is not None:
                yield out(now, b.schema, sums, count)

        kind = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
        schema = [*(kind(found, c) for c in by), "same boolean", *(kind(self.right, c) for c in keep), "share double"]
        return found.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, ", ".join(schema))

    def _shares(self, left: DataFrame, total: str | None, by: list[str], keep: list[str]) -> DataFrame:
        plain, held, width = self.same is None, self.held, self.width

        def pack(batches):
            for rows in _joined(batches, HELD):
                yield _packed(rows, width)

        def added(key, raws):
            rows = _unpacked(raws)
            s, e = rows["_s"].to_numpy(), rows["_e"].to_numpy()
            spans = _open(held)
            bin_ = spans.near(key, s.min(), e.max())
            met = bin_.all.meet(s, e)[0]
            hit = np.flatnonzero(met)
            if len(hit):
                rows, number, ones, buckets, out = rows.take(pa.array(hit)).combine_chunks(), spans.numbers(keep)[1][bin_.rows["_row"].to_numpy()], [], [], []
                for one, at, same, share in _sums(bin_, rows, rows["_n"].to_numpy() if total else met[hit], by, plain):
                    which = 2 * number[at] + same
                    order = np.argsort(which, kind="stable")
                    which, share = which[order], share[order]
                    bucket = which // (2 * NUMBERS)
                    cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]]) if len(bucket) else [0]
                    for i, j in zip(cut[:-1], cut[1:]):
                        ones.append(one)
                        buckets.append(bucket[i])
                        out.append(_sums_packed(which[i:j] % (2 * NUMBERS), share[i:j]))
                own = [rows[f"l_{c}"].take(pa.array(ones, pa.int64())).combine_chunks() for c in by]
                yield pa.RecordBatch.from_arrays([*own, pa.array(buckets, pa.int64()), pa.array(out, pa.binary())], names=[*by, "_bucket", "_sums"])

        def run(batches):
            now, raws = None, []
            for b in batches:
                for key, at, *raw in zip(*(b[c].to_pylist() for c in ("_key", "_bin", "_from", "_rows"))):
                    if raws and ((key, at) != now or len(raws) * PACK > 4 * HELD):
                        yield from added(now[0], raws)
                        raws = []
                    now = key, at
                    raws.append(raw)
            if raws:
                yield from added(now[0], raws)

        schema = [*(f"`{c}` {left.schema[c].dataType.simpleString()}" for c in by), "_bucket long", "_sums binary"]
        rows = self._spans(left, 0, self.left_span, [*(F.col(c).alias(f"l_{c}") for c in by), *([F.col(total).cast("long").alias("_n")] if total else [])])
        packed = staged(rows.mapInArrow(pack, "_key string, _bin long, _from long, _rows binary"), SHORT_ROWS | SHUFFLED_ONCE)
        return packed.repartition("_key", "_bin").sortWithinPartitions("_key", "_bin").mapInArrow(run, ", ".join(schema))


def islands(df: DataFrame, keys: list[str], start: str, end: str, dist: int = 0, bin_size: int = 1 << 16, name: str = "island") -> DataFrame:
    """Adds the start of each row's island: a maximal run of spans with gaps of at most dist.

    Two steps, so that no task holds a whole key: sums of bins are scanned in order, then rows within a bin.
    """
    b = df.withColumn("_b", F.expr(f"{start} div {bin_size}"))
    per_bin = b.groupBy(*keys, "_b").agg(F.max(end).alias("_hi"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bin.withColumn("_carry", F.max("_hi").over(before)).drop("_hi")
    inside = Window.partitionBy(*keys, "_b").orderBy(start, end)
    rows = b.join(carry, [*keys, "_b"])
    reach = F.greatest(F.col("_carry"), F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("_reach", reach).withColumn("_new", F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach") + dist), F.col(start)))
    rows = rows.withColumn("_own", F.last("_new", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    last = rows.groupBy(*keys, "_b").agg(F.max("_new").alias("_last"))
    last = last.withColumn("_from", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    return rows.join(last, [*keys, "_b"]).withColumn(name, F.coalesce("_own", "_from")).drop("_b", "_carry", "_reach", "_new", "_own", "_from")


def merge_boxes(boxes: list[list], dist: int) -> list[list]:
    """[start1, end1, start2, end2, count] boxes, merged where both sides overlap until none do."""
    boxes = sorted(boxes)
    changed = len(boxes) > 1
    while changed:
        changed = False
        passed: list[list] = []
        live: list[list] = []
        for box in boxes:
            # in order of starts; those that end before this one can meet no later one, unless another round widens them
            passed += [k for k in live if k[1] + dist < box[0]]
            live = [k for k in live if k[1] + dist >= box[0]]
            at = 0
            while at < len(live):
                k = live[at]
                if box[0] <= k[1] + dist and k[0] <= box[1] + dist and box[2] <= k[3] + dist and k[2] <= box[3] + dist:
                    box = [min(box[0], k[0]), max(box[1], k[1]), min(box[2], k[2]), max(box[3], k[3]), box[4] + k[4]]
                    del live[at]
                    at, changed = 0, True
                else:
                    at += 1
            live.append(box)
        boxes = sorted(passed + live)
    return boxes


def chain_boxes(boxes: list[list], dist: int) -> list[list]:
    """Boxes around all that are linked by chains of boxes that overlap on both sides, each with the next."""
    boxes = sorted(boxes)
    up = list(range(len(boxes)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    open_boxes: list[int] = []
    for i, box in enumerate(boxes):
        open_boxes = [j for j in open_boxes if boxes[j][1] + dist >= box[0]]
        for j in open_boxes:
            if box[2] <= boxes[j][3] + dist and boxes[j][2] <= box[3] + dist:
                up[root(i)] = root(j)
        open_boxes.append(i)
    found: dict[int, list] = {}
    for i, box in enumerate(boxes):
        k = found.setdefault(root(i), [*box[:4], 0])
        found[root(i)] = [min(k[0], box[0]), max(k[1], box[1]), min(k[2], box[2]), max(k[3], box[3]), k[4] + box[4]]
    return list(found.values())


def _merge_sorted(groups: list[str], dist: int, merge):
    """Merges rows that come sorted by group, one group at a time."""

    def done(key, boxes):
        return [[*key[:2], b[0], b[1], *key[2:4], b[2], b[3], b[4]] for b in merge(boxes, dist)]

    def run(batches):
        key, boxes = None, []
        for pdf in batches:
            out = []
            keys = pdf[groups].itertuples(index=False, name=None)
            for k, box in zip(keys, pdf[["start1", "end1", "start2", "end2", "no_splits"]].to_numpy().tolist()):
                if k != key:
                    out += done(key, boxes) if boxes else []
                    key, boxes = k, []
                boxes.append(box)
            yield pd.DataFrame(out, columns=_BOX)
        yield pd.DataFrame(done(key, boxes) if boxes else [], columns=_BOX)

    return run


_BOX = ["chr1", "strand1", "start1", "end1", "chr2", "strand2", "start2", "end2", "no_splits"]


def cluster_boxes(pairs: DataFrame, dist: int = 0, linkage: str = "box") -> DataFrame:
    """Clusters of segment pairs: boxes that overlap in both segments merge until none do; counts add up.

    With linkage "pairwise" only given boxes link, not the merged ones: clusters are chains of overlapping pairs.

    Equal boxes are counted first. Islands of either segment in turn cut the boxes into independent groups;
    only those meet in one task.
    """
    keys = ["chr1", "strand1", "chr2", "strand2"]
    boxes = pairs.groupBy(*_BOX[:-1]).agg(F.count("*").alias("no_splits"))
    groups = list(keys)
    for i, seg in enumerate(("1", "2", "1", "2")):
        boxes = islands(staged(boxes), groups, f"start{seg}", f"end{seg}", dist, name=f"_i{i}")
        groups.append(f"_i{i}")
    kinds = {f.name: f.dataType.simpleString() for f in boxes.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in _BOX)
    alone = F.count("*").over(Window.partitionBy(*groups)) == 1
    boxes = staged(boxes.withColumn("_alone", alone))
    many = boxes.where("not _alone").drop("_alone").repartition(*groups).sortWithinPartitions(*groups)
    return boxes.where("_alone").select(*_BOX).unionByName(many.mapInPandas(_merge_sorted(groups, dist, {"box": merge_boxes, "pairwise": chain_boxes}[linkage]), schema))


def distinct_spans(*tables: DataFrame) -> DataFrame:
    """The different rows of tables of the same columns."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.distinct()


def numbered_clusters(clusters: DataFrame) -> DataFrame:
    """The cluster table: running ids in coordinate order, lengths of both segments.

    Rows are dealt by ranges of the order and numbered within; one number a range reaches the driver.
    """
    order = ["chr1", "start1", "start2", "chr2", "end1", "end2", "strand1", "strand2"]
    dealt = staged(clusters.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before, offsets = 0, {}
    for r in sorted(dealt.groupBy("_range").count().collect(), key=lambda r: r["_range"]):
        offsets[r["_range"]] = before
        before += r["count"]
    first = F.element_at(F.create_map(*(F.lit(x) for kv in offsets.items() for x in kv)), F.col("_range")) if offsets else F.lit(0)
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + first
    return dealt.withColumn("clust_id", F.concat(F.lit("cluster"), number.cast("string"))).drop("_range").withColumns({"len1": F.expr("end1 + 1 - start1"), "len2": F.expr("end2 + 1 - start2")})
