"""Sequence kernels: native column expressions, and Arrow functions for alignments."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import ship  # noqa: F401  (kernels run on workers)


def normalise_dna(seq) -> Column:
    """Upper case, U as T, anything but A, C, G, T as N."""
    return F.regexp_replace(F.translate(F.upper(seq), "U", "T"), "[^ACGT]", "N")


def reverse_complement(seq) -> Column:
    return F.translate(F.reverse(seq), "ACGTN", "TGCAN")


def strip_non_acgt(seq) -> Column:
    return F.regexp_replace(seq, "[^ACGT]", "")


def strip_unprintable(text) -> Column:
    return F.regexp_replace(text, "[^\\x20-\\x7E]", "")


def alphabet(seq: str) -> Column:
    """Distinct bases in order of appearance."""
    return F.expr(f"array_distinct(transform(sequence(1, greatest(1, length({seq}))), i -> substring({seq}, i, 1)))")


def within_range(a, b, r: int) -> Column:
    return F.abs(F.col(a) - F.col(b)) <= r


def phred_sum(qual: str) -> Column:
    return F.expr(f"aggregate(filter(sequence(1, greatest(1, length({qual}))), i -> i <= length({qual})), 0L, (a, i) -> a + least(41, ascii(substring({qual}, i, 1)) - 33))")


def mean_phred(qual: str) -> Column:
    """Mean quality; null for an empty read."""
    return phred_sum(qual) / F.nullif(F.length(qual), F.lit(0))


def passes(seq: str, qual: str, quality: int, minlen: int) -> Column:
    """Long enough, and of enough mean quality."""
    return F.coalesce((F.length(seq) >= minlen) & (mean_phred(qual) >= quality), F.lit(False))


def slice_bases(col, left, right) -> Column:
    """Half-open slice from 0."""
    return F.substring(col, left + 1, F.greatest(right - left, F.lit(0)))


def adapter_position(seq: str, adapter: str, mmrate: float) -> Column:
    """Leftmost place where the whole adapter fits with at most floor(length * mmrate) mismatches; null if none."""
    n, budget = len(adapter), int(len(adapter) * mmrate + 1e-9)
    if not budget:
        return F.expr(f"nullif(instr({seq}, '{adapter}'), 0) - 1")
    misses = f"aggregate(sequence(1, {n}), 0, (a, k) -> a + if(substring({seq}, i + k, 1) <> substring('{adapter}', k, 1), 1, 0))"
    return F.expr(f"get(filter(sequence(0, greatest(0, length({seq}) - {n})), i -> length({seq}) >= {n} and {misses} <= {budget}), 0)")


def find_adapter(seq: str, adapter: str, mmrate: float) -> int | None:
    """adapter_position() of one read."""
    n, budget = len(adapter), int(len(adapter) * mmrate + 1e-9)
    x, y = (np.frombuffer(t.encode(), dtype=np.uint8) for t in (seq, adapter))
    if len(x) < n:
        return None
    hit = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(x, n) != y).sum(axis=1) <= budget)
    return int(hit[0]) if len(hit) else None


def trim_bounds(seq: str, adapters5: list[str], adapters3: list[str], mode: int, mmrate: float, drop_last: bool = False) -> tuple[Column, Column]:
    """(left, right) after adapter trimming; mode 0 trims 5', 1 trims 3', 2 both. Of several hits the last adapter's counts.

    drop_last: a read without a 3' hit ends before its last base.
    """
    left, right = F.lit(0), F.greatest(F.length(seq) - 1, F.lit(0)) if drop_last else F.length(seq)
    if mode in (0, 2):
        for a in adapters5:
            left = F.coalesce(adapter_position(seq, a, mmrate) + len(a), left)
    if mode in (1, 2):
        for a in adapters3:
            right = F.coalesce(adapter_position(seq, a, mmrate), right)
    return left, right


def window_trim(qual: str, left: str, right: str, wsize: int, quality: int) -> Column:
    """New right bound: windows of wsize are cut from the 3' end while their mean quality is below quality."""
    total = f"aggregate(sequence(1, {wsize}), 0L, (a, j) -> a + ascii(substring({qual}, cast({right} - (k + 1) * {wsize} + j as int), 1)) - 33)"
    windows = f"cast(({right} - {left}) div {wsize} as int)"
    return F.expr(f"cast({right} - {wsize} * coalesce(get(filter(sequence(0, greatest(0, {windows} - 1)), k -> k < {windows} and {total} >= {quality * wsize}), 0), {windows}) as int)")


# ---------------------------------------------------------------- alignments, a batch of pairs at once
#: Cells of alignment matrices that are held at once.
CELLS = 1 << 22


def padded(texts: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts as rows of one matrix, filled up, and their lengths."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.full((len(texts), int(size.max(initial=0))), fill, dtype=np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("ascii", "replace"), dtype=np.uint8)
    return out, size


def _alike(first: list[str], second: list[str]):
    """Places of pairs of like sizes whose matrices together have about CELLS cells."""
    n, m = (np.array([len(t) + 1 for t in x], dtype=np.int64) for x in (first, second))
    order = np.lexsort([m, n])
    at = 0
    while at < len(order):
        end, high = at + 1, m[order[at]]
        while end < len(order):
            high = max(high, m[order[end]])
            if (end + 1 - at) * n[order[end]] * high > CELLS:
                break
            end += 1
        yield order[at:end]
        at = end


def common_substrings(first: list[str], second: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in first, in second, lengths) of the longest common substrings; the first in first, then in second, of equals."""
    out = np.zeros((3, len(first)), dtype=np.int64)
    for rows in _alike(first, second):
        (x, _), (y, _) = padded([first[r] for r in rows], 0), padded([second[r] for r in rows], 1)
        every = np.arange(len(rows))
        run = np.zeros((len(rows), y.shape[1] + 1), dtype=np.int32)
        i, j, best = np.zeros((3, len(rows)), dtype=np.int64)
        for k in range(x.shape[1]):
            run[:, 1:] = np.where(y == x[:, k : k + 1], run[:, :-1] + 1, 0)
            at = run.argmax(axis=1)
            n = run[every, at]
            more = n > best
            i[more], j[more], best[more] = (k - n + 1)[more], (at - n)[more], n[more]
        out[:, rows] = i, j, best
    return out[0], out[1], out[2]


def common_substring(a: str, b: str) -> tuple[int, int, int]:
    """(place in a, place in b, length) of the longest common substring."""
    return tuple(int(v[0]) for v in common_substrings([a], [b]))


_COMPLEMENT = str.maketrans("ACGTN", "TGCAN")


def merged_mates(fwd: list[str], rev: list[str], minovlps: int, prefix: bool = False) -> list[str | None]:
    """Forward reads, then what the reverse complements of their mates have behind the overlap (or, prefix, before it); null below minovlps."""
    other = [r[::-1].translate(_COMPLEMENT) for r in rev]
    found = zip(fwd, other, *(v.tolist() for v in common_substrings(fwd, other)))
    return [f[: i + n] + (o[:j] if prefix else o[j + n :]) if n and n >= minovlps else None for f, o, i, j, n in found]


def merge_mates(fwd: str, rev: str, minovlps: int) -> str | None:
    return merged_mates([fwd], [rev], minovlps)[0]


_PAIRING = np.full((256, 256), -1, dtype=np.int32)
for _a, _b in ("AT", "TA", "GC", "CG", "GT", "TG"):
    _PAIRING[ord(_a), ord(_b)] = 1
_PAIRING[ord("N"), :] = _PAIRING[:, ord("N")] = 0


def _duplexes(first: list[str], second: list[str]) -> dict[str, np.ndarray]:
    """Best local duplexes of each pair, one for each best-scoring end, in row order; x and y hold the alignments from behind.

    reverse(first) is aligned with second: +1 for a base pair (G-T too), -1 else, 0 with N, gaps -2. A cell's
    own pair counts as a match only once the path goes on below it, so a full duplex of n has n - 1 matches.
    """
    a, n = padded([t[::-1] for t in first], 0)
    b, m = padded(second, 0)
    s = _PAIRING[a[:, :, None], b[:, None, :]]
    h = np.zeros((len(n), a.shape[1] + 1, b.shape[1] + 1), dtype=np.int32)
    slope = 2 * np.arange(b.shape[1], dtype=np.int32)
    for i in range(a.shape[1]):
        own = np.maximum(np.maximum(h[:, i, :-1] + s[:, i], h[:, i, 1:] - 2), 0)
        # gaps along the row: the best of all cells to the left, less 2 a step
        h[:, i + 1, 1:] = np.maximum.accumulate(own + slope, axis=1) - slope
    real = (np.arange(a.shape[1])[None, :, None] < n[:, None, None]) & (np.arange(b.shape[1])[None, None] < m[:, None, None])
    inner = np.where(real, h[:, 1:, 1:], 0)
    top = inner.max(axis=(1, 2), initial=0)
    pair, i, j = np.nonzero((inner == top[:, None, None]) & (inner > 0))
    i, j = i + 1, j + 1
    x, y = [], []
    size, matches = np.zeros(len(pair), dtype=np.int64), np.zeros(len(pair), dtype=np.int64)
    live = np.arange(len(pair))
    while len(live):
        p, k, q = pair[live], i[live], j[live]
        cell = h[p, k, q]
        both = cell == h[p, k - 1, q - 1] + s[p, k - 1, q - 1]
        up = ~both & (cell == h[p, k - 1, q] - 2)
        for steps, chars in ((x, np.where(both | up, a[p, k - 1], 45)), (y, np.where(up, 45, b[p, q - 1]))):
            steps.append(np.zeros(len(pair), dtype=np.uint8))
            steps[-1][live] = chars
        k, q = k - (both | up), q - ~up
        i[live], j[live] = k, q
        size[live] += 1
        below = h[p, k, q]
        matches[live] += both & (below > 0) & (below - 1 == h[p, k - 1, q - 1])
        live = live[below > 0]
    none = np.zeros((0, len(pair)), dtype=np.uint8)
    return {"pair": pair, "xl": size, "xm": matches, "xs": top[pair], "xc": matches / np.maximum(size, 1), "xr": matches / np.maximum(n + m, 1)[pair], "x": np.array(x) if x else none, "y": np.array(y) if y else none}


def _duplex_row(found: dict[str, np.ndarray], k: int) -> dict:
    n = int(found["xl"][k])
    text = {f"xa{i}": found[c][:n, k][::-1].tobytes().decode() for i, c in ((1, "x"), (2, "y"))}
    return text | {c: int(found[c][k]) for c in ("xl", "xm", "xs")} | {c: float(found[c][k]) for c in ("xc", "xr")}


def duplex_ends(first: str, second: str) -> list[dict]:
    """All best-scoring duplexes of two strands."""
    found = _duplexes([first], [second])
    return [_duplex_row(found, k) for k in range(len(found["pair"]))]


def best_duplexes(first: list[str], second: list[str], cmplmin: float = 0.0, ratiomin: float = 0.0, best_by: str = "last") -> list[dict | None]:
    """For each pair the last end (or, best_by="cmpl", the first of the most complementary) that reaches both limits; null if none does."""
    out: list[dict | None] = [None] * len(first)
    for rows in _alike(first, second):
        found = _duplexes([first[r] for r in rows], [second[r] for r in rows])
        ok = np.flatnonzero((found["xr"] >= ratiomin) & (found["xc"] >= cmplmin))
        order = ok if best_by == "last" else ok[np.lexsort([-ok, found["xc"][ok], found["pair"][ok]])]
        pair = found["pair"][order]
        for k in order[np.append(pair[1:] != pair[:-1], True)] if len(order) else ():
            out[rows[found["pair"][k]]] = _duplex_row(found, k)
    return out


def best_duplex(first: str, second: str, cmplmin: float = 0.0, ratiomin: float = 0.0, best_by: str = "last") -> dict | None:
    return best_duplexes([first], [second], cmplmin, ratiomin, best_by)[0]


DUPLEX = "xa1 string, xa2 string, xl int, xm int, xs int, xc double, xr double"


def _of_pairs(a: pd.Series, b: pd.Series, f) -> list:
    """Results of f for the pairs of which neither is null or empty, null for the others."""
    rows = [k for k, (x, y) in enumerate(zip(a, b)) if x and y]
    out: list = [None] * len(a)
    for k, v in zip(rows, f([a.iat[k] for k in rows], [b.iat[k] for k in rows])):
        out[k] = v
    return out


def duplex_udf(cmplmin: float = 0.0, ratiomin: float = 0.0, best_by: str = "last"):
    """Arrow function (first, second) -> struct of the duplex, null where there is none."""

    @F.pandas_udf(DUPLEX)
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        cols = [c.split()[0] for c in DUPLEX.split(", ")]
        rows = _of_pairs(a, b, lambda x, y: best_duplexes(x, y, cmplmin, ratiomin, best_by))
        return pd.DataFrame([r or dict.fromkeys(cols) for r in rows], columns=cols)

    return run


def merge_udf(minovlps: int, prefix: bool = False):
    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_of_pairs(a, b, lambda x, y: merged_mates(x, y, minovlps, prefix)), dtype="object")

    return run
