"""Word-shingle sets of texts, computed on Arrow buffers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import ngram_hashes, prefix_hash, span_hash, text_chunks, word_spans


def shingle_sets(col: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: k words each; fewer words give the whole sequence; none give none."""
    for i, j, buf, bounds in text_chunks(col):
        starts, ends, first = word_spans(buf, bounds)
        pre = prefix_hash(buf)
        words = span_hash(pre, starts, ends)
        grams = ngram_hashes(words, k)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                yield ngram_hashes(words[a:b], b - a)
            else:
                yield np.zeros(0, dtype=np.uint64)


def signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()
