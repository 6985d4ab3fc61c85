import itertools
import random

import pyarrow as pa
import pytest

from strandforge.llm.ngram_join import ngram_jaccard_components
from strandforge.llm.shingles import shingle_sets
from tests.llm.texts import DOCS, awkward, crowded, split_words


def brute(rows):
    sets = {}
    for i, t, *_ in rows:
        w = split_words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(up), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * len(sets[a] | sets[b]) and root(a) != root(b):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: len(s) for i, s in sets.items()}, {i: root(i) for i in up}


@pytest.mark.parametrize("seed,bits", [(1, 20), (2, 12)])
def test_equals_brute_force(spark, seed, bits):
    rows = awkward(seed)
    sizes, comps = brute(rows)
    got = ngram_jaccard_components(crowded(spark.createDataFrame(rows, DOCS)), sketch_bits=bits).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == sizes[r.doc_id]
        assert r.component_id == comps.get(r.doc_id)
    assert len(set(comps.values())) < len(comps) - 10


def test_near_copies_around_one_text(spark):
    """Copies that link with their original but hardly with each other, and a chain."""
    base = [f"b{i}" for i in range(100)]
    rows = [(100, " ".join(base))]
    for k in range(30):
        w = list(base)
        w[3 * k] = f"n{k}"
        w[(3 * k + 50) % 100] = f"m{k}"
        rows.append((k, " ".join(w)))
    for k in range(6):
        rows.append((200 + k, " ".join(base[15 * k :] + [f"t{i}" for i in range(15 * k)])))
    full = [(i, t, None, None, None) for i, t in rows]
    _, comps = brute(full)
    got = {r.doc_id: r.component_id for r in ngram_jaccard_components(spark.createDataFrame(full, DOCS)).collect()}
    assert got == comps


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f", None, None, None)] * 2 + [(2, "a b c d e f", None, None, None)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard_components(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert ngram_jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("block,times", [(3, 1), (512, 600_000)])
def test_blocks_and_heavy_grams(spark, monkeypatch, block, times):
    """Columns cut into blocks, and frequencies of billions, change nothing."""
    import strandforge.llm.ngram_join as J

    plain = J.sum_cells
    monkeypatch.setattr(J, "sum_cells", lambda *a: plain(*a) * times)
    rnd = random.Random(4)
    rows = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(60)]
        for k in range(12):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
            rows.append((100 * family + k, " ".join(w + ["one", "shared", "tail", "of", "every", "text"]), None, None, None))
    _, comps = brute(rows)
    got = {r.doc_id: r.component_id for r in ngram_jaccard_components(spark.createDataFrame(rows, DOCS), block=block).collect()}
    assert got == comps and 4 <= len(set(comps.values())) < 40


def test_hashes_of_regular_strings_differ():
    """The Thue-Morse word and its complement, which sums of single bytes modulo 2^64 cannot tell apart."""
    t = "a"
    for _ in range(13):
        t += t.translate(str.maketrans("ab", "ba"))
    other = t.translate(str.maketrans("ab", "ba"))
    a, b = shingle_sets(pa.array([t, other]))
    assert a[0] != b[0]
