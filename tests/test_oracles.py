"""Each query of the sequencing engine against its SQL form."""

import math
from pathlib import Path

import duckdb
import pytest

from strandforge.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    return c


def rows(df):
    cell = lambda v: "" if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "<NA>" else f"{v:.6f}" if isinstance(v, float) else str(int(v) if hasattr(v, "dtype") and v.dtype.kind == "i" else v)
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    got, want = QUERIES[name](spark, sf).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    # whole numbers may come as floats where a column has nulls
    norm = lambda t: tuple(x[:-7] if x.endswith(".000000") else x for x in t)
    assert sorted(map(norm, a)) == sorted(map(norm, b))


def test_only_clusters_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"q_cluster_2d"}


def test_clusters_equal_brute_force(spark, sf):
    """Any two boxes that overlap in both segments are merged, until none do; here pair by pair."""
    from strandforge.plans.catalog import _boxes

    boxes = {}
    for r in _boxes(spark, sf).collect():
        boxes.setdefault((r.chr1, r.strand1, r.chr2, r.strand2), []).append([r.start1, r.end1, r.start2, r.end2, 1])
    want = []
    for key, group in boxes.items():
        left = list(group)
        while left:
            box = left.pop()
            hit = next((x for x in left if box[0] <= x[1] and x[0] <= box[1] and box[2] <= x[3] and x[2] <= box[3]), None)
            if hit is None:
                want.append((*key, *box))
                continue
            left.remove(hit)
            merged = [min(box[0], hit[0]), max(box[1], hit[1]), min(box[2], hit[2]), max(box[3], hit[3]), box[4] + hit[4]]
            # what was done already may meet the larger box
            again = [w for w in want if w[:4] == key and merged[0] <= w[5] and w[4] <= merged[1] and merged[2] <= w[7] and w[6] <= merged[3]]
            want = [w for w in want if w not in again]
            left += [merged, *(list(w[4:]) for w in again)]
    got = [(r.chr1, r.strand1, r.chr2, r.strand2, r.start1, r.end1, r.start2, r.end2, r.no_splits) for r in QUERIES["q_cluster_2d"](spark, sf).collect()]
    assert sorted(got) == sorted(want) and sum(r[8] for r in got) == sum(map(len, boxes.values()))


def test_entry(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.columns == ["sample_id", "orientation", "name", "freq"]
    assert set(e.oracle_sql()) <= set(e.queries())
