"""Byte-pair merging on ragged numpy arrays, rank by rank in step over all words of a batch."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np

_ABSENT = np.int32(np.iinfo(np.int32).max)
_P = 0xA3B195354A39B70D
_P_INV = pow(_P, -1, 1 << 64)
SPACE, LETTER, NUMBER, OTHER, SPECIAL = range(5)
#: Characters of text that one numpy pass holds (a longer single text is handled alone).
CHUNK_CHARS = 1 << 19


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and single-character lower case of every code point, as the tokenizers library sees them."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    kind = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    low = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, sys.maxunicode + 1)])
    every = "".join(map(chr, points))
    for pat, k in ((r"[\p{L}]+", LETTER), (r"[\p{N}]+", NUMBER), (r"\s+", SPACE)):
        for _, (a, b) in pre_tokenizers.Split(Regex(pat), "removed", invert=True).pre_tokenize_str(every):
            kind[points[a:b]] = k
    apart = [c for c in every if c != "\n"]
    for c, x in zip(apart, normalizers.Lowercase().normalize_str("\n".join(apart)).split("\n")):
        if len(x) == 1:
            low[ord(c)] = ord(x)
    return kind, low


def _told_apart(cps: np.ndarray, solid: np.ndarray, starts: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of equal words, and a first word of each: words of one hash count as equal only if their characters are.

    The words hold all solid characters, in order.
    """
    at = np.empty(int(codes.max(initial=-1)) + 1, dtype=np.int64)
    at[codes[::-1]] = np.arange(len(codes))[::-1]
    if not len(codes):
        return codes, at
    first = at[codes]
    place = np.cumsum(size) - size
    index = np.repeat(starts[first] - place, size)
    index += np.arange(len(index))
    same = size == size[first]
    if not same.all():
        np.minimum(index, len(cps) - 1, out=index)
    same &= np.logical_and.reduceat(cps[index] == cps[solid], place)
    if same.all():
        return codes, at
    other: dict[bytes, int] = {}
    codes, at = codes.copy(), at.tolist()
    for i in np.flatnonzero(~same):
        word = cps[starts[i] : starts[i] + size[i]].tobytes()
        if word not in other:
            other[word] = len(at)
            at.append(int(i))
        codes[i] = other[word]
    return codes, np.array(at, dtype=np.int64)


class RaggedBPE:
    """A lower-casing word-level BPE vocabulary in the tokenizers library's JSON form.

    Supported form: NFC, white space collapsed, lower case; words by the usual contraction/letters/number/other
    pattern; byte-level symbols; an end-of-word suffix. Added special strings inside a text are one token each,
    as the library does by default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._special_ids = np.array([*self.special.values(), 0], dtype=np.int32)
        chars = _byte_symbols()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int32)
        self.final = np.array([vocab[c + suffix] for c in chars], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        key = left << 20 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made[order]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self._index()

    def _index(self) -> None:
        """Buckets of the pair keys, for look-ups in a few gathers."""
        self.shift = np.uint64(64 - 18)
        slot = ((self.keys.astype(np.uint64) * np.uint64(_P)) >> self.shift).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        nth = np.arange(len(order)) - np.searchsorted(slot[order], slot[order])
        self.depth = int(nth.max(initial=-1)) + 1
        self.slots = np.full((self.depth, 1 << 18), -1, dtype=np.int64)
        self.where = np.full((self.depth, 1 << 18), -1, dtype=np.int32)
        self.slots[nth, slot[order]] = self.keys[order]
        self.where[nth, slot[order]] = order

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Row of each pair key in the merge table, or -1."""
        slot = ((key.astype(np.uint64) * np.uint64(_P)) >> self.shift).astype(np.int64)
        out = np.where(self.slots[0][slot] == key, self.where[0][slot], -1)
        for d in range(1, self.depth):
            miss = np.flatnonzero((out < 0) & (self.slots[d - 1][slot] >= 0))
            if not len(miss):
                break
            s = slot[miss]
            out[miss] = np.where(self.slots[d][s] == key[miss], self.where[d][s], -1)
        return out

    # ------------------------------------------------------------ words
    def _code_points(self, text: str) -> np.ndarray:
        low = _tables()[1]

        def plain(s: str) -> np.ndarray:
            if not s.isascii():
                if not unicodedata.is_normalized("NFC", s):
                    s = unicodedata.normalize("NFC", s)
                if "İ" in s:
                    s = s.replace("İ", "i̇")
            return low[np.frombuffer(s.encode("utf-32-le", "replace"), dtype=np.uint32)]

        if self._special_at is None or "<" not in text or not self._special_at.search(text):
            return plain(text)
        parts, at, names = [], 0, list(self.special)
        for m in self._special_at.finditer(text):
            parts += [plain(text[at : m.start()]), np.array([sys.maxunicode + 1 + names.index(m[0])], dtype=np.uint32)]
            at = m.end()
        return np.concatenate([*parts, plain(text[at:])])

    @staticmethod
    def _starts(cps: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First positions of words; a word ends at the next start or at white space."""
        n = len(cps)
        fresh = np.ones(n + 1, dtype=bool)
        fresh[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER) | (kind[1:] == SPECIAL)
        fresh[bounds] = True
        for i in np.flatnonzero((cps == 0x27) & fresh[:n]):
            end = bounds[np.searchsorted(bounds, i, side="right")]
            tail = "".join(chr(c) if c <= sys.maxunicode else " " for c in cps[i + 1 : min(i + 3, end)])
            size = 1 if tail[:1] in ("s", "t", "m", "d") and tail else 2 if tail in ("re", "ve", "ll") else 0
            if size:
                fresh[i + 1 : i + 1 + size] = False
                fresh[i + 1 + size] = True
        return np.flatnonzero(fresh[:n] & (kind != SPACE))

    def words(self, texts: list[str]):
        """Yields (first text, text after, unique word ids as ragged arrays, word codes, first word of each text)."""
        import pandas as pd

        table = _tables()[0]
        i = 0
        while i < len(texts):
            parts, size, j = [], 0, i
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_CHARS):
                parts.append(self._code_points(texts[j]))
                size += len(texts[j])
                j += 1
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            cps = np.concatenate(parts)
            kind = np.where(cps > sys.maxunicode, SPECIAL, table[np.minimum(cps, sys.maxunicode)])
            starts = self._starts(cps, kind, bounds)
            ends = np.append(starts[1:], len(cps)).astype(np.int64)
            if len(starts):
                blank = np.append(np.flatnonzero(kind == SPACE), len(cps))
                ends = np.minimum(ends, blank[np.searchsorted(blank, starts)])
            power = np.cumprod(np.full(len(cps) + 1, _P, dtype=np.uint64))
            back = np.cumprod(np.full(len(cps) + 1, _P_INV, dtype=np.uint64))
            pre = np.zeros(len(cps) + 1, dtype=np.uint64)
            np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * power[:-1], out=pre[1:])
            h = (pre[ends] - pre[starts]) * back[starts]
            codes, at = _told_apart(cps, kind != SPACE, starts, ends - starts, pd.factorize(h)[0])
            ids, off = self._unique_ids(cps, starts[at], ends[at])
            yield i, j, ids, off, codes, np.searchsorted(starts, bounds)
            i = j

    def _unique_ids(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = ends - starts
        flat = cps[np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())] if len(size) else cps[:0]
        word = np.repeat(np.arange(len(size)), size)
        width = 1 + (flat >= 0x80).astype(np.int64) + (flat >= 0x800) + (flat >= 0x10000)
        special = flat > sys.maxunicode
        width[special] = 1
        at = np.cumsum(width) - width
        sym = np.zeros(int(width.sum()), dtype=np.int64)
        f = flat.astype(np.int64)
        for w, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            pick = np.flatnonzero((width == w) & ~special)
            for k in range(w):
                bits = f[pick] >> (6 * (w - 1 - k))
                sym[at[pick] + k] = (lead | bits) if k == 0 else (0x80 | bits & 0x3F)
        seq = np.repeat(word, width)
        last = np.ones(len(seq), dtype=bool)
        last[:-1] = seq[1:] != seq[:-1]
        ids = np.where(last, self.final[sym], self.inner[sym])
        if special.any():
            ids[at[special]] = self._special_ids[flat[special] - sys.maxunicode - 1]
        return self.merge(ids, seq, len(size))

    # ------------------------------------------------------------ merging
    def merge(self, sym: np.ndarray, seq: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Merges each sequence's lowest-rank pair, all sequences in step, until none is left: (ids, offsets)."""
        done_sym, done_seq = [], []
        sym, seq = sym.astype(np.int32), seq.astype(np.int64)
        while len(sym) > 1:
            same = seq[1:] == seq[:-1]
            row = self._find(sym[:-1].astype(np.int64) << 20 | sym[1:].astype(np.int64))
            row[~same] = -1
            rank = np.append(np.where(row >= 0, self.ranks[row], _ABSENT), _ABSENT)
            head = np.flatnonzero(np.concatenate([[True], ~same]))
            low = np.minimum.reduceat(rank, head)
            size = np.diff(np.append(head, len(sym)))
            each = np.repeat(low, size)
            hit = (rank == each) & (rank != _ABSENT)
            at = np.flatnonzero(hit)
            if not len(at):
                break
            # of overlapping hits (a symbol paired with itself) every second one counts, from the left
            new_run = np.concatenate([[True], np.diff(at) > 1])
            run = at[new_run][np.cumsum(new_run) - 1]
            at = at[(at - run) % 2 == 0]
            sym[at] = self.made[row[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            idle = each == _ABSENT
            done = idle & keep
            done_sym.append(sym[done])
            done_seq.append(seq[done])
            keep &= ~idle
            sym, seq = sym[keep], seq[keep]
        sym = np.concatenate([*done_sym, sym])
        seq = np.concatenate([*done_seq, seq])
        order = np.argsort(seq, kind="stable")
        return sym[order], np.searchsorted(seq[order], np.arange(n + 1))

    # ------------------------------------------------------------ texts
    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), dtype=np.int64)
        for i, j, _, off, codes, first in self.words(texts):
            total = np.concatenate([[0], np.cumsum(np.diff(off)[codes])])
            out[i:j] = total[first[1:]] - total[first[:-1]]
        return out

    def encode(self, texts: list[str]):
        """The token ids of each text, one array a text."""
        for _, _, ids, off, codes, first in self.words(texts):
            size = np.diff(off)[codes]
            end = np.cumsum(size)
            flat = ids[np.repeat(off[:-1][codes] - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)]
            cut = np.concatenate([[0], end])[first]
            for a, b in zip(cut[:-1], cut[1:]):
                yield flat[a:b]


@lru_cache(4)
def load(path: str) -> RaggedBPE:
    return RaggedBPE(path)
