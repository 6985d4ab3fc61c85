import random

from strandforge.operators.intervals import cluster_boxes, interval_join, islands, merge_boxes, numbered_clusters


def spans(rnd, n, top, longest):
    out = []
    for i in range(n):
        s = rnd.randint(0, top)
        out.append((i, rnd.choice("ab"), s, s + rnd.choice([0, 5, longest, longest * 40])))
    return out


def test_interval_join_equals_nested_loops(spark):
    rnd = random.Random(3)
    left, right = spans(rnd, 300, 50_000, 30), spans(rnd, 200, 50_000, 400)
    left += [(900, None, 1, 5), (901, "a", None, 5)]
    a = spark.createDataFrame(left, "i long, chrom string, s long, e long")
    b = spark.createDataFrame(right, "j long, chrom string, fs long, fe long")
    want = sorted((i, j) for i, c, s, e in left for j, d, fs, fe in right if c == d and s is not None and max(s, fs) <= min(e, fe))
    args = (["chrom"], ("s", "e"), ("fs", "fe"))
    for size in (16, 100, 4096):
        got = interval_join(a, b, *args, bin_size=size).select("i", "j").collect()
        assert sorted(map(tuple, got)) == want
    hit = {i for i, _ in want}
    assert {r.i for r in interval_join(a, b, *args, how="left_semi", left_id=["i"]).collect()} == hit
    assert {r.i for r in interval_join(a, b, *args, how="left_anti", left_id=["i"]).collect()} == {r[0] for r in left} - hit
    assert interval_join(a, b, *args, how="left", left_id=["i"]).count() == len(want) + len({r[0] for r in left} - hit)
    assert interval_join(a.limit(0), b, *args).count() == 0


def test_islands_over_bins(spark):
    rnd = random.Random(4)
    rows = spans(rnd, 400, 20_000, 20)
    got = {r.i: r.island for r in islands(spark.createDataFrame(rows, "i long, chrom string, s long, e long"), ["chrom"], "s", "e", dist=3, bin_size=64).collect()}
    for c in "ab":
        reach = start = None
        for i, _, s, e in sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[3])):
            if reach is None or s > reach + 3:
                start = s
            reach = e if reach is None else max(reach, e)
            assert got[i] == start


def test_boxes_do_not_depend_on_order(spark):
    rnd = random.Random(5)
    for dist in (0, 20):
        boxes = []
        for _ in range(60):
            s, t = rnd.randint(0, 400), rnd.randint(0, 400)
            boxes.append([s, s + rnd.randint(5, 30), t, t + rnd.randint(5, 30), 1])
        want = merge_boxes([list(b) for b in boxes], dist)
        for _ in range(5):
            rnd.shuffle(boxes)
            assert merge_boxes([list(b) for b in boxes], dist) == want
        assert sum(b[4] for b in want) == 60
        rows = [("c", "+", b[0], b[1], "c", "-", b[2], b[3]) for b in boxes]
        df = spark.createDataFrame(rows, "chr1 string, strand1 string, start1 long, end1 long, chr2 string, strand2 string, start2 long, end2 long")
        got = sorted([r.start1, r.end1, r.start2, r.end2, r.no_splits] for r in cluster_boxes(df, dist).collect())
        assert got == want


def test_cluster_counts(spark):
    same = [("c", "+", 10, 20, "c", "+", 50, 60)] * 8 + [("d", "+", 10, 20, "c", "+", 50, 60), ("c", "-", 10, 20, "c", "+", 50, 60)]
    df = spark.createDataFrame(same, "chr1 string, strand1 string, start1 long, end1 long, chr2 string, strand2 string, start2 long, end2 long")
    got = numbered_clusters(cluster_boxes(df)).orderBy("clust_id").collect()
    assert sorted(r.no_splits for r in got) == [1, 1, 8]
    assert {r.clust_id for r in got} == {"cluster1", "cluster2", "cluster3"} and got[0].len1 == 11


def test_pairwise_linkage_equals_brute_force(spark):
    import random

    from strandforge.operators.intervals import cluster_boxes

    rnd = random.Random(12)
    rows = []
    for _ in range(150):
        a, b = rnd.randint(0, 300), rnd.randint(0, 120)
        rows.append(("c", "+", a, a + rnd.randint(1, 25), "c", rnd.choice("+-"), b, b + rnd.randint(1, 25)))
    df = spark.createDataFrame(rows, "chr1 string, strand1 string, start1 long, end1 long, chr2 string, strand2 string, start2 long, end2 long")
    left, want = list(rows), []
    while left:
        group = [left.pop()]
        for x in group:
            near = [y for y in left if x[5] == y[5] and x[2] <= y[3] and y[2] <= x[3] and x[6] <= y[7] and y[6] <= x[7]]
            group += near
            left = [y for y in left if y not in near] if near else left
        want.append((group[0][5], min(g[2] for g in group), max(g[3] for g in group), min(g[6] for g in group), max(g[7] for g in group), len(group)))
    key = lambda df: sorted((r.strand2, r.start1, r.end1, r.start2, r.end2, r.no_splits) for r in df.collect())
    chains = key(cluster_boxes(df, linkage="pairwise"))
    assert chains == sorted(want) and len(chains) >= len(key(cluster_boxes(df)))


def test_spans_of_all_lengths_meet_once(spark):
    """Also left spans of whole chromosomes, which are dealt into few bins."""
    import random

    from strandforge.operators.intervals import interval_join

    rnd = random.Random(13)
    def spans(n):
        out = []
        for k in range(n):
            a, size = rnd.randint(0, 250_000_000), int(10 ** rnd.uniform(0, 8.3))
            out.append((k, a, a + size))
        return out

    one, two = spans(150), spans(150) + [(900, 5, 4), (901, None, 7)]
    left = spark.createDataFrame([("c", *r) for r in one], "chrom string, a long, s1 long, e1 long")
    right = spark.createDataFrame([("c", *r) for r in two], "chrom string, b long, s2 long, e2 long")
    got = sorted((r.a, r.b) for r in interval_join(left, right, ["chrom"], ("s1", "e1"), ("s2", "e2")).collect())
    assert got == sorted((a, b) for a, s, e in one for b, t, f in two if t is not None and t <= f and max(s, t) <= min(e, f)) and len(got) > 500
    plan = interval_join(left, right, ["chrom"], ("s1", "e1"), ("s2", "e2"))
    dealt = spark.createDataFrame([("c", 0, 0, 250_000_000)], left.schema)
    assert interval_join(dealt, right, ["chrom"], ("s1", "e1"), ("s2", "e2")).count() == sum(t is not None and t <= f and t <= 250_000_000 for _, t, f in two) and plan.columns == ["chrom", "a", "s1", "e1", "b", "s2", "e2"]


def test_counted_hits_equal_hits(spark):
    """Reads of any width, equal read ids, null marks and dense features: as the joined pairs tell."""
    from pyspark.sql import functions as F

    from strandforge.operators import analysis as A

    rnd = random.Random(8)
    reads = [(f"r{i}", f"s{i % 3}", rnd.choice("ab"), rnd.choice(["+", "-", None]), s := rnd.randint(-9000, 40_000), s + rnd.choice([0, 20, 9000, 60_000])) for i in range(400)]
    reads += reads[:5] + [(*reads[9][:4], 100, 120), ("n", "s0", None, "+", 1, 5), ("m", "s0", "a", "+", None, 5)]
    features = [(f"g{j}", rnd.choice("abc"), rnd.choice(["+", "-", None]), s := rnd.randint(-9000, 40_000), s + rnd.choice([0, 50, 300, 30_000])) for j in range(60)]
    r = spark.createDataFrame(reads, "read_id string, sample_id string, chrom string, strand string, start1 long, end1 long")
    f = spark.createDataFrame(features, "name string, chrom string, f_strand string, f_start long, f_end long")
    found = A.hits(r, f, ["read_id"])
    met = A.Met(r, f, ["read_id"], ["sample_id"])
    assert met.rest is not None and met.sweep.narrow.count() > 100
    rows = lambda df: sorted(map(str, df.withColumn("freq", F.round("freq", 9)).collect() if "freq" in df.columns else df.collect()))
    assert rows(met.frequency()) == rows(A.feature_frequency(found, ["read_id"], ["sample_id"]))
    assert rows(A.Met(r, f, ["read_id"], []).unique(["name"])) == rows(A.unique_hits(found, ["read_id"], ["name"]))
    assert A.Met(r, f.limit(0), ["read_id"], []).unique(["name"]).count() == 0 == A.Met(r, f.limit(0), ["read_id"], ["sample_id"]).frequency().count()


def test_shares_of_a_power_of_two_are_exact(spark):
    from strandforge.operators import analysis as A

    r = spark.createDataFrame([("x", "s", "a", "+", 500, 500)] + [(f"r{i}", "s", "a", "+", i, i) for i in range(100)], "read_id string, sample_id string, chrom string, strand string, start1 long, end1 long")
    f = spark.createDataFrame([(f"g{j}", "a", "+", 400, 600) for j in range(128)] + [("h", "a", "+", 0, 99)], "name string, chrom string, f_strand string, f_start long, f_end long")
    got = {x.name: x.freq for x in A.Met(r, f, ["read_id"], ["sample_id"]).frequency().collect()}
    assert got == {"h": 100.0} | {f"g{j}": 1 / 128 for j in range(128)}


def test_semi_and_left_joins_make_and_write_no_extra_pairs(spark, monkeypatch):
    from strandforge.operators import intervals

    a = spark.range(300).selectExpr("id as i", "'a' as chrom", "id as s", "id + 9 as e")
    b = spark.range(300).selectExpr("id as j", "'a' as chrom", "id as fs", "id + 500 as fe")
    args = (["chrom"], ("s", "e"), ("fs", "fe"))
    monkeypatch.setattr(intervals, "staged", lambda df: 1 / 0)
    assert interval_join(a, b, *args, how="left", left_id=["i"]).count() == sum(max(i, j) <= min(i + 9, j + 500) for i in range(300) for j in range(300))
    for how in ("left_semi", "left_anti"):
        plan = interval_join(a, b, *args, how=how, left_id=["i"])._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def odd_reads(spark):
    rnd = random.Random(21)
    reads = [(f"r{i}", f"s{i % 3}", rnd.choice(["a", "b", None]), rnd.choice(["+", "-", None]), s := rnd.randint(-9000, 90_000), s + rnd.choice([0, 20, 9000, 60_000])) for i in range(300)]
    reads += reads[:5] * 3 + [(*reads[9][:4], 100, 120), ("m", "s0", "a", "+", None, 5), ("w", "s0", "a", "+", 9, 3)]
    # some only just meet, some touch none
    features = [(f"g{j % 55}", rnd.choice(["a", "b", "c", None]), rnd.choice(["+", "-", None]), s := rnd.randint(-9000, 90_000), s + rnd.choice([0, 50, 300, 30_000])) for j in range(60)]
    r = spark.createDataFrame(reads, "read_id string, sample_id string, chrom string, strand string, start1 long, end1 long")
    return r, spark.createDataFrame(features, "name string, chrom string, f_strand string, f_start long, f_end long")


def test_held_and_dealt_features_tell_the_same(spark, monkeypatch):
    from pyspark.sql import functions as F

    from strandforge.operators import analysis as A
    from strandforge.operators import intervals

    r, f = odd_reads(spark)
    rows = lambda df: sorted(map(str, df.withColumn("freq", F.round("freq", 9)).collect() if "freq" in df.columns else df.collect()))
    cols = ["read_id", "start1"]

    def told():
        one = A.Met(r, f, ["read_id"], [])
        return [rows(A.Met(r, f, ["read_id"], ["sample_id"]).frequency()), rows(one.unique(["name"])), rows(one.with_unique(["name"], cols).select("read_id", "start1", "orientation", "name"))]

    found = A.hits(r, f, ["read_id"])
    best = A.unique_hits(found, ["read_id"], ["name"])
    want = [rows(A.feature_frequency(found, ["read_id"], ["sample_id"])), rows(best), rows(r.select(*cols).join(best, "read_id").select("read_id", "start1", "orientation", "name"))]
    assert len(want[1]) > 20 and told() == want
    monkeypatch.setattr(intervals, "HOLD", 0)
    assert told() == want


def test_hits_of_repeated_reads_are_not_joined(spark, monkeypatch):
    """Reads are counted where they are read, also those whose id stands in several rows."""
    from strandforge.operators import analysis as A

    monkeypatch.setattr(A, "interval_join", lambda *a, **b: 1 / 0)
    r, f = odd_reads(spark)
    met = A.Met(r, f, ["read_id"], [])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert met.rest is not None and met.unique(["name"]).count() and A.Met(r, f, ["read_id"], ["sample_id"]).frequency().count()
    once = A.Met(r.dropDuplicates(["read_id"]), f, ["read_id"], [])
    assert once.rest is None and "Join" not in plan(once.unique(["name"])) + plan(once.with_unique(["name"], ["read_id", "start1"]))


def test_repeated_hashes(spark):
    from strandforge.operators.repeats import hash_of, repeated

    df = spark.range(5000).selectExpr("cast(id % 4000 as string) as a", "if(id = 7, null, 'x') as b").union(spark.createDataFrame([("n", None)] * 4, "a string, b string"))
    assert {x._k for x in repeated(df, ["a", "b"]).collect()} == {x.k for x in df.groupBy("a", "b").count().where("count > 1").select(hash_of(["a", "b"]).alias("k")).collect()}
    assert repeated(df.limit(0), ["a"]).count() == 0


def test_ids_of_one_row_share_no_hash(spark):
    """Of 36 million ids, some of these share a hash of 50 bits, so all reads were read again."""
    import numpy as np
    import pyarrow as pa

    from strandforge.operators.repeats import LOW, TOP, _pack, _unpacked

    n = 36_000_000
    assert n * n / 2 / 2 ** (TOP + LOW) < 0.01
    h = np.random.default_rng(3).integers(0, 1 << TOP + LOW, 3000)
    h = np.concatenate([h, [0, (1 << TOP + LOW) - 1, 5 << LOW, 5 << LOW]])
    got = [(g << LOW) + x for b in _pack([pa.record_batch([pa.array(h)], names=["_k"])]) for g, low in zip(*(c.to_pylist() for c in b.columns)) for x in _unpacked(low).tolist()]
    assert sorted(got) == sorted(h.tolist())


def test_sums_travel_in_few_bytes(spark):
    """Neither the reads nor the sums of a feature are shuffled a row each, and names that several features share are added up."""
    from strandforge.operators import analysis as A

    n = 20_000
    r = spark.range(8 * n).selectExpr("concat('read-', id) as read_id", "concat('s', id % 2) as sample_id", "'a' as chrom", "'+' as strand", "id * 3 as start1", "id * 3 + id % 50 as end1").union(spark.sql("select 'again', null, 'b', '-', 5l, 9l from range(3)"))
    f = spark.range(n).selectExpr("concat('g', id % 15000) as name", "if(id = 77, null, 'x') as other", "'a' as chrom", "if(id % 3 = 0, '+', '-') as f_strand", "id * 20 as f_start", "id * 20 + 60 as f_end").union(spark.sql("select null, 'y', 'b', '-', 0l, 100l"))
    for keep in (("name",), ("name", "other")):
        got = A.Met(r, f, ["read_id"], ["sample_id"], keep).frequency()
        rows = got.collect()
        want = A.feature_frequency(A.hits(r, f, ["read_id"]), ["read_id"], ["sample_id"]).collect()
        told = lambda x: sorted((str(y.sample_id), y.orientation, str(y.name), round(y.freq, 9)) for y in x)
        assert told(rows) == told(want) and len(rows) > 30_000
    # the sums of names come from their own place, not from a shuffle of a row for each
    assert "Aggregate" not in A.Met(r.where("read_id != 'again'"), f, ["read_id"], ["sample_id"]).frequency()._jdf.queryExecution().optimizedPlan().toString()


def test_packed_sums():
    import numpy as np

    from strandforge.operators.intervals import NUMBERS, _sums_of, _sums_packed

    rnd = np.random.default_rng(4)
    for which in (np.array([0]), np.array([2 * NUMBERS - 1]), np.sort(rnd.integers(0, 2 * NUMBERS, 9000)), np.arange(2 * NUMBERS)):
        share = rnd.random(len(which))
        raw = _sums_packed(which, share)
        a, b = _sums_of(raw)
        assert len(raw) == 10 * len(which) and (a == which).all() and (b == share).all()


def test_frequencies_are_not_dealt_by_sample(spark):
    """Few samples would take all rows to few tasks; their sums go to the frequencies instead."""
    from strandforge.operators import analysis as A

    f = spark.range(60_000).selectExpr("concat('s', id % 3) as sample_id", "concat('g', id) as name", "if(id % 5 = 0, 0d, 0.5d) as freq").union(spark.sql("select 'none', 'g', 0d"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        out = A.normalised(f, ["sample_id"])
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = {(x.sample_id, x.name): x.freq for x in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(got) == 60_001 and got["none", "g"] is None and abs(got["s1", "g1"] - 1 / 16_000) < 1e-12
    assert A.normalised(f.drop("sample_id"), []).agg({"freq": "sum"}).first()[0] > 0.999999
