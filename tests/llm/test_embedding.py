import math

import numpy as np
import pytest

from strandforge.llm.embedding_dedup import embedding_components, linked_blocks, quantised
from tests.llm.texts import crowded

KIND = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, n=150, dim=12):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=dim) if i % 3 or not rows else np.array(rows[rng.integers(len(rows))][1]) * rng.uniform(0.5, 2) + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    rows += [(n + i, rows[4][1], rows[4][2]) for i in range(20)]
    m = len(rows)
    rows += [(m, None, 1), (m + 1, [0.0] * dim, 1), (m + 2, [1.0] * (dim - 1) + [float("nan")], 1), (m + 3, [1.0] * (dim - 1) + [None], 1), (m + 4, rows[0][1], None), (m + 5, [], 1), (m + 6, [float("inf")] * dim, 1), (None, rows[0][1], rows[0][2]), (m + 7, [1e-38] * dim, 2), (m + 8, [1e38] * dim, 2), (m + 9, rows[0][1][:-1], rows[0][2])]
    return rows


def brute(rows):
    links, up = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    good = [(i, np.array(v, dtype=float), c) for i, v, c in rows if i is not None and v and c is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for a in range(len(good)):
        for b in range(a):
            (i, u, c), (j, v, d) = good[a], good[b]
            if c == d and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.93:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return links, {i: root(i) for i in up}


@pytest.mark.parametrize("tile", [2048, 16])
def test_equals_brute_force(spark, tile):
    rows = vectors()
    links, comps = brute(rows)
    assert sum(links.values()) > 300
    got = embedding_components(crowded(spark.createDataFrame(rows, KIND)), tile=tile).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_links == links[r.vec_id], r
        assert r.component_id == comps.get(r.vec_id)
        assert r.vec_id is None or r.kept == (r.vec_id == r.component_id)
    assert embedding_components(spark.createDataFrame([], KIND)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for dim in (2, 64, 2500):
        x = rng.normal(size=(60, dim)) * rng.choice([1, 10, 100], size=(60, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        q, s, length, err = quantised(x)
        near, exact = (q.astype(float) @ q.astype(float).T) * s[:, None] * s[None], x @ x.T
        assert (np.abs(near - exact) <= length[:, None] * err[None] + err[:, None] + 1e-9).all()
        for t in (0.0, 0.3, 0.93):
            got = np.concatenate([h for _, h in linked_blocks(x, x, t, step=7)])
            assert (got == (exact >= t)).all()
