import json
import math
import os
import random

from strandforge.config import Options
from strandforge.functions.register import register_functions
from strandforge.plans.stages import run
from strandforge.streaming.reads import run_preprocessing

A, B = "GGGGGCCCCCAAAAATTTTT", "AAAAATTTTTGGGGGCCCCC"


def write_inputs(top):
    rnd = random.Random(7)
    for cond in ("c1", "c2"):
        for s in range(2):
            d = top / "aligned" / cond
            d.mkdir(parents=True, exist_ok=True)
            lines = ["@HD\tVN:1.0", "@SQ\tSN:chr1\tLN:10000"]
            for i in range(12):
                pos = 1000 + rnd.randint(0, 5)
                lines.append(f"split{i}\t0\tchr1\t{pos}\t30\t20M2000N20M\t*\t0\t0\t{A + B}\t{'I' * 40}\tXJ:i:2\tXE:f:-5.5")
            for i in range(30):
                lines.append(f"single{i}\t0\tchr1\t{rnd.choice([1005, 5005, 9000])}\t30\t40M\t*\t0\t0\t{A + B}\t{'I' * 40}\tXJ:i:1")
            (d / f"S{s}.sam").write_text("\n".join(lines) + "\n")
    gff = [f"chr1\tx\tgene\t{s}\t{e}\t.\t+\t.\tID=g{i};gene_name=gene{i};gene_biotype=mRNA" for i, (s, e) in enumerate([(900, 1100), (2950, 3200), (4900, 5100)])]
    (top / "a.gff3").write_text("\n".join(gff) + "\n")


def test_complete(spark, tmp_path):
    write_inputs(tmp_path)
    out = tmp_path / "out"
    opt = Options(trtms=str(tmp_path / "aligned"), outdir=str(out), features=str(tmp_path / "a.gff3"), named=True, stats=True, outcnt=True, outjgf=True, sitelenratio=0.0, energy="model")
    run(spark, "complete", opt)
    clusters = spark.read.csv(str(out / "clustering/clusters"), sep="\t", header=True).collect()
    assert len(clusters) == 1 and clusters[0].no_splits == "48" and clusters[0].clustID == "cluster1"
    ints = spark.read.csv(str(out / "analysis/allints"), sep="\t", header=True)
    row = ints.first()
    assert ints.count() == 1 and {row.fst_rna, row.sec_rna} == {"gene0", "gene1"}
    assert row.c1_001_supp_reads == "12" and row.c2_002_supp_reads == "12" and 0 < float(row.c1_001_pval) < 1 and 0 < float(row.c1_002_padj) <= 1
    pairs = spark.read.csv(str(out / "analysis/interactions"), sep="\t", header=True)
    assert len(pairs.columns) == 25 and pairs.count() == 48
    counts = spark.read.csv(str(out / "analysis/counts"), sep="\t", header=True).first()
    assert counts.id.startswith("gene0_gene1_") and counts.c1_001 == "12"
    stats = spark.read.csv(str(out / "detect/stats"), sep="\t", header=True).collect()
    assert {(r.Reads, r.Aligned, r.Splits) for r in stats} == {("42", "30", "12")}
    assert {r.kind for r in spark.read.text(str(out / "analysis/graph")).select("kind").distinct().collect()} == {"graph", "node", "edge"}
    assert "detect" in json.loads((out / "data.json").read_text())
    sam = spark.read.text(str(out / "detect/sam")).count()
    assert sam == 96
    named = (out / "detect/trtms/c1/S0_splits.sam").read_text().splitlines()
    assert named[1] == "@SQ\tSN:chr1\tLN:10000" and len([x for x in named if not x.startswith("@")]) == 24
    assert len([x for x in (out / "detect/trtms/c2/S1_single.sam").read_text().splitlines() if x.startswith("single")]) == 30
    assert {r.qname for r in spark.read.format("sam").load(str(out / "detect/trtms/c1/S0_splits.sam")).collect()} == {f"split{i}" for i in range(12)}
    g = json.loads((out / "analysis/graph.json").read_text())
    assert len(g["nodes"]) == 2 and len(g["edges"]) == 1 and {n["label"] for n in g["nodes"].values()} == {"gene0", "gene1"} and g["edges"][0]["source"] in g["nodes"]


def write_reads(top):
    d = top / "trtms" / "c1"
    d.mkdir(parents=True)
    (d / "S1.fastq").write_text("".join(f"@r{i}\n{'ACGTA' * 5}AGATCGGAAG\n+\n{'I' * 35}\n" for i in range(5)) + "@bad\nAC\n+\nII\n")


def test_preproc_and_align_commands(spark, tmp_path):
    write_reads(tmp_path)
    (tmp_path / "ad.fa").write_text(">a\nAGATCGGAAG\n")
    opt = Options(trtms=str(tmp_path / "trtms"), outdir=str(tmp_path / "out"), adpt3=str(tmp_path / "ad.fa"), named=True)
    run(spark, "preproc", opt)
    assert (tmp_path / "out/preproc/trtms/c1/S1_preproc.fastq").read_text() == "".join(f"@r{i}\n{'ACGTA' * 5}\n+\n{'I' * 25}\n" for i in range(5))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out/preproc/reads")).collect())
    assert text.count("ACGTA" * 5) == 5 and "AGATCGG" not in text and "bad" not in text
    assert any("-i" in c and "S1" in c for c in run(spark, "align", opt))


def test_stream(spark, tmp_path):
    write_reads(tmp_path)
    q = run_preprocessing(spark, str(tmp_path / "trtms/*"), str(tmp_path / "out"), str(tmp_path / "cp"), [], ["AGATCGGAAG"], Options())
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 5 and {r.seq for r in got.collect()} == {"ACGTA" * 5} and os.path.isdir(tmp_path / "cp")


def test_sql_functions(spark):
    register_functions(spark)
    r = spark.sql("select dna_revcomp('AACG') as a, lc_substring('AACCT', 'TTAACC') as b, duplex_align('AAAA', 'TTTT').xm as c, binom_sf(5, 100, 0.02) as d, adapter_pos('AACCGGTT', 'CAGG', 0.25D) as e, chi2_sf_even(6D, 2) as f").first()
    assert r.e == 2 and math.isclose(r.f, math.exp(-3) * 4, rel_tol=1e-12)
    assert (r.a, r.b, r.c) == ("CGTT", "AACC", 3) and 0 < r.d < 1
    assert [(x.op_no, x.n, x.op) for x in spark.sql("select * from cigar_segments('3M5N2=')").collect()] == [(0, 3, "M"), (1, 5, "N"), (2, 2, "=")]


def test_staged_tables_need_a_shared_folder(spark, monkeypatch):
    import pytest

    from strandforge import staging

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "local-cluster[3,2,1024]"

    with pytest.raises(ValueError):
        staging.shared_folder(Cluster)
    Cluster.conf.get = staticmethod(lambda key, default=None: "hdfs://x/stage/")
    assert staging.shared_folder(Cluster) == "hdfs://x/stage"
    assert staging.shared_folder(spark)
