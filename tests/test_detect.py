from pyspark.sql import functions as F

from strandforge.config import Options
from strandforge.operators import detect as D
from strandforge.operators.analysis import annotate_with_clusters, graph, wide_report

ALN = "sample_id string, qname string, rec_no long, flag int, rname string, pos0 long, mapq int, cigar string, seq string, qual string, xj int"
A, B = "GGGGGCCCCCAAAAATTTTT", "AAAAATTTTTGGGGGCCCCC"


def aln(spark, rows):
    return spark.createDataFrame([(s, q, n, f, r, p, m, c, x, "I" * len(x), j) for s, q, n, f, r, p, m, c, x, j in rows], ALN)


def segs(spark, cigar, seq, **opt):
    known = opt.pop("known", None)
    df = aln(spark, [("s", "q", 0, 0, "c", 100, 30, cigar, seq, 2)])
    spliced = D.near_introns(D.gaps(df).withColumnRenamed("rname", "chrom"), spark.createDataFrame(known, "chrom string, a long, b long")) if known else None
    return [(x.xx, x.xy, x.pos0, x.seq, x.cigar) for x in D.segments(df, Options(**opt), spliced).first().segs]


def test_segments(spark):
    assert segs(spark, "40M", A + B) == [(1, 40, 100, A + B, "40M")]
    assert segs(spark, "20M100N20=", A + B) == [(1, 20, 100, A, "20M"), (21, 40, 220, B, "20=")]
    assert segs(spark, "20M100N10M2D5M5N5M", A + B) == [(1, 20, 100, A, "20M"), (21, 35, 220, B[:15], "10M2D5M")]  # the last part is too short
    assert segs(spark, "5S15M100N18M2S", A + B) == [(1, 20, 100, A, "5S15M"), (21, 40, 215, B, "18M2S")]
    assert segs(spark, "5S15M100N18M2S", A + B, exclclipping=True) == [(6, 20, 100, A[5:], "15M"), (21, 38, 215, B[:18], "18M")]
    # a gap at a known intron (both ends within 5) joins its sides
    assert segs(spark, "20M100N20M", A + B, known=[("c", 124, 215)]) == [(1, 40, 100, A + B, "20M100N20M")]
    assert len(segs(spark, "20M100N20M", A + B, known=[("c", 125, 215)])) == 2
    assert len(segs(spark, "20M100N20M", A + B, known=[("d", 119, 220)])) == 2


def test_detect_routes(spark):
    two, three = "20M100N20M", "20M100N20M100N20M"
    rows = [
        ("s", "split", 0, 16, "c", 100, 30, two, A + B, 2), ("s", "multi", 0, 0, "c", 100, 30, three, A + B + A, 3), ("s", "single", 0, 0, "c", 100, 30, "40M", A + B, None),
        ("s", "late", 0, 0, "c", 100, 30, two, A + B, 2), ("s", "late", 1, 0, "c", 900, 30, "40M", A + B, 1), ("s", "late", 2, 0, "c", 100, 30, two, A + B, 2),
        ("s", "unmapped", 0, 4, "c", 100, 30, two, A + B, 2), ("s", "lowq", 0, 0, "c", 100, 10, two, A + B, 2), ("s", "short", 0, 0, "c", 1, 30, "15M", A[:15], 1),
    ]
    opt = Options(sitelenratio=0.0)
    single, splits = D.detect(aln(spark, rows), opt)
    assert sorted(r.qname for r in single.collect()) == ["late", "single"]
    got = [(r.qname, r.route, r.flag) for r in splits.select("qname", "route", "flag").distinct().collect()]
    assert ("split", "splits", 16) in got and ("late", "splits", 0) in got and ("multi", "multsplits", 0) in got and len(got) == 3
    n = D.run_counts(aln(spark, rows), single, splits, opt).first()
    assert (n.reads, n.aligned, n.splits, n.multsplits) == (4, 2, 2, 1)
    assert D.detect(aln(spark, []), opt)[1].count() == 0


def test_introns_of_two_exons(spark):
    j = spark.createDataFrame([(1, "c", "t", 10, 20), (1, "c", "t", 50, 60), (2, "c", "u", 5, 9)], "feature_no long, chrom string, transcript string, start1 long, end1 long")
    assert [(r.a, r.b) for r in D.introns(j).collect()] == [(20, 50)]


def test_clusters_widen_features(spark):
    f = spark.createDataFrame([(1, "c", 100, 200, "+", "A", "mRNA", "p"), (2, "c", 500, 600, "+", "B", "mRNA", "p")], "feature_no long, chrom string, f_start long, f_end long, f_strand string, name string, biotype string, product string")
    c = spark.createDataFrame([("cluster1", "c", "+", 90, 120, "c", "+", 800, 850, 5), ("cluster2", "c", "+", 190, 230, "c", "-", 510, 520, 2), ("cluster3", "c", "+", 510, 700, "c", "+", 520, 530, 1)], "clust_id string, chr1 string, strand1 string, start1 long, end1 long, chr2 string, strand2 string, start2 long, end2 long, no_splits long")
    got = {r.name: (r.f_start, r.f_end, r.biotype) for r in annotate_with_clusters(f, c).collect()}
    assert got == {"cluster1/A/cluster2": (90, 230, "mRNA"), "B": (500, 600, "mRNA"), "cluster1": (800, 850, "cluster"), "cluster2": (510, 520, "cluster")}


def test_graph_and_report(spark):
    s = spark.createDataFrame([("t/c/1", "t", "c", 1, "A", "sense", "A", "sense", 6, 0.5, None, 0.01), ("t/c/2", "t", "c", 2, "A", "sense", "B", "antisense", 1, None, -2.0, 1.0)], "sample_id string, grp string, condition string, replicate int, fst_rna string, fst_rna_ori string, sec_rna string, sec_rna_ori string, supp_reads long, gcs double, ghs double, pval double")
    nodes, edges = graph(s)
    assert nodes.count() == 2 and edges.count() == 2
    assert edges.where("source = target").count() == 1
    adj = s.groupBy("condition", "fst_rna", "fst_rna_ori", "sec_rna", "sec_rna_ori").agg(F.lit(0.5).alias("padj"))
    w = wide_report(s, adj, [("t/c/1", "c", 1), ("t/c/2", "c", 2)])
    assert w.columns == ["fst_rna", "sec_rna", "fst_rna_ori", "sec_rna_ori", "c_001_supp_reads", "c_001_gcs", "c_001_ghs", "c_001_pval", "c_002_supp_reads", "c_002_gcs", "c_002_ghs", "c_002_pval", "c_002_padj"]
    row = w.where("sec_rna = 'B'").first()
    assert (row.c_001_supp_reads, row.c_001_gcs, row.c_002_supp_reads, row.c_002_ghs) == (0, ".", 1, "-2.0")
