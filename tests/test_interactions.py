import pytest

from strandforge.plans.catalog import QUERIES


@pytest.mark.parametrize("name", ["q_pair_pivot_counts", "q_graph_edges"])
def test_hits_are_not_joined_back_to_the_reads(spark, sf, name, monkeypatch):
    """The reads with a unique hit come with their columns, so neither they nor all reads are dealt for a join."""
    from strandforge.operators import analysis as A

    staged, plans = A.staged, []
    put = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(A, "staged", lambda df, *a: put(df) or staged(df, *a))
    out = QUERIES[name](spark, sf)
    if name == "q_pair_pivot_counts":
        put(out)  # the graph joins the names of its nodes at last
    assert len(plans) > 2 and not any("Join" in p for p in plans) and out.count()


def test_edges_are_named_without_a_join(spark, sf):
    """Edges bring the names of their ends, so neither they nor the nodes are dealt."""
    out = QUERIES["q_graph_edges"](spark, sf)
    assert out.count() and "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_consecutive_reads(spark, monkeypatch):
    """As rows joined by their places in each group; rows without a group follow none, and no row travels alone."""
    from strandforge.operators import analysis as A
    from strandforge.operators import following

    monkeypatch.setattr(following, "PARTS", 3)
    rows = [(f"r{i:03d}", [f"q{i % 37}", None][i % 11 == 0], [i % 4, None][i % 13 == 0], "antisense" if i % 3 else "sense", f"g{i % 29}") for i in range(400)]
    df = spark.createDataFrame(rows, "read_id string, qname string, seg int, ori string, partner string").repartition(5)
    out = A.consecutive(df, "qname", ["seg", "read_id"], ["ori", "partner"], {"partner": "partner2", "read_id": "id2"})
    want = []
    for q in {r[1] for r in rows} - {None}:
        own = sorted((r for r in rows if r[1] == q), key=lambda r: (r[2] is None, r[2] or 0, r[0]))
        want += [(a[3], a[4], b[4], b[0]) for a, b in zip(own, own[1:])]
    assert sorted(map(tuple, out.collect())) == sorted(want) and len(want) > 300
    assert "Window" not in QUERIES["q_graph_edges"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert A.consecutive(df.limit(0), "qname", ["seg"], ["ori"], {"ori": "o"}).count() == 0
