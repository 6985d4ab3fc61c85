import gzip
import io
import json
import struct

import pytest

from strandforge.config import Options, parse_args, parse_config
from strandforge.sources import readers, samples


def bam_bytes(records):
    out = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\x00" + struct.pack("<i", 1000)
    for name, flag, pos, mapq, cigar, seq, tags in records:
        ops = b"".join(struct.pack("<I", n << 4 | readers._OPS.index(o)) for n, o in cigar)
        codes = [readers._BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
        body = struct.pack("<iiBBHHHiiii", 0, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\x00" + ops + packed + bytes([30] * len(seq)) + tags
        out += struct.pack("<i", len(body)) + body
    return gzip.compress(out[:40]) + gzip.compress(out[40:])  # several members, as block gzip has


def test_bam(spark, tmp_path):
    path = tmp_path / "x.bam"
    path.write_bytes(bam_bytes([("r1", 16, 99, 20, [(3, "="), (50, "N"), (2, "M")], "ACGTN", b"XJi" + struct.pack("<i", 2) + b"XAZhello\x00" + b"XCf" + struct.pack("<f", 0.5) + b"ZBBs" + struct.pack("<ihh", 2, 1, -1)), ("r2", 4, -1, 0, [], "", b"")]))
    readers.register_formats(spark)
    a, b = spark.read.format("bam").load(str(path)).orderBy("rec_no").collect()
    assert (a.qname, a.flag, a.rname, a.pos0, a.mapq, a.cigar, a.seq, a.qual, a.xj) == ("r1", 16, "chr1", 99, 20, "3=50N2M", "ACGTN", "?????", 2)
    assert a.tags["XA"] == "hello" and a.tags["XC"] == "0.5" and a.tags["ZB"] == "s,1,-1" and b.cigar == "*" and b.xj is None


def test_sam_fastq_fasta(spark, tmp_path):
    d = tmp_path / "ctrls" / "c1"
    d.mkdir(parents=True)
    (d / "s.sam").write_text("@HD\tVN:1.0\nr1\t16\tchr1\t100\t22\t1X51=\t*\t0\t0\tACG\t*\tXX:i:1\tXY:i:52\nr2\t0\tchr1\t7\t9\t3M\t*\t0\t0\tAAA\tIII\n")
    readers.register_formats(spark)
    rows = spark.read.format("sam").load(str(d / "s.sam")).orderBy("rec_no").collect()
    assert [(r.sample_id, r.qname, r.pos0, r.xx, r.xy) for r in rows] == [("ctrls/c1/s", "r1", 99, 1, 52), ("ctrls/c1/s", "r2", 6, None, None)]
    (d / "r.fastq").write_text("@a 1\nacgu\n+\nIIII\n@b\nAXGT\n+\nIIII")  # no line end at the end
    with gzip.open(d / "z.fastq.gz", "wt") as f:
        f.write("@c\nAC\n+\nII\n")
    got = spark.read.format("fastq").load(str(d / "r.fastq")).orderBy("read_no").collect()
    assert [(r.id, r.seq) for r in got] == [("a 1", "ACGT"), ("b", "ANGT")]
    assert spark.read.format("fastq").load(str(d / "z.fastq.gz")).first().seq == "AC"
    (d / "a.fa").write_text(">x one\nACG\nT\n>y\nGG\n")
    assert [(r.id, r.seq) for r in spark.read.format("fasta").load(str(d / "a.fa")).collect()] == [("x", "ACGT"), ("y", "GG")]
    with pytest.raises(ValueError):
        list(readers.parse_fastq(io.BytesIO(b"@a\nACG\n+\nI\n")))


def test_gff3(spark, tmp_path):
    lines = ["##gff", "chr1\tx\tregion\t1\t9999\t.\t+\t.\tID=r", "chr1\tx\tgene\t100\t500\t.\t+\t.\tID=g1;gene_name=A;Name=B;gene_name=C;gene_biotype=mRNA;product=p q", "chr1\tx\texon\t100\t150\t.\t+\t.\tID=e1;Parent=t1", "chr1\tx\texon\t300\t600\t.\t+\t.\tID=e2;Parent=t1", "chr1\tx\tgene\t700\t900\t.\t-\t.\tID=g2", "chr1\tx\texon\t700\t720\t.\t-\t.\tParent=t2"]
    p = tmp_path / "a.gff3"
    p.write_text("\n".join(lines) + "\n")
    features, junctions = readers.read_gff3(spark, str(p))
    got = {r.id: r for r in features.collect()}
    assert set(got) == {"g1", "g2"} and (got["g1"].name, got["g1"].biotype, got["g1"].product, got["g2"].name) == ("A", "mRNA", "p q", "g2")
    assert sorted((j.transcript, j.start1, j.end1) for j in junctions.collect()) == [("t1", 100, 150), ("t2", 700, 720)]


def test_catalogue(tmp_path):
    for g, c, n in (("ctrls", "c1", 2), ("trtms", "c1", 4)):
        for i in range(n):
            f = tmp_path / g / c / f"S{i // 2}_R{i % 2 + 1}.fastq"
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_text("")
    (tmp_path / "trtms" / "note.txt").write_text("")
    found = samples.discover("preproc", "PE", str(tmp_path / "trtms"), str(tmp_path / "ctrls"))
    assert [(s.group, len(s.files)) for s in found] == [("ctrls", 2), ("trtms", 2), ("trtms", 2)]
    text = samples.catalogue_json("preproc", "PE", found, "/out")
    tree = json.loads(text)["preproc"]
    first = tree["trtms"][0]["samples"][0]
    assert first["output"]["forward"] == "/out/preproc/trtms/c1/S0_preproc.fastq" and first["output"]["R1only"].endswith("/S0_R1only.fastq")
    assert "\\/out" in text
    with pytest.raises(FileNotFoundError):
        samples.discover("preproc", "SE", str(tmp_path / "none"))
    assert samples.discover("preproc", "SE", str(tmp_path / "trtms"))[0].group == "trtms"


def _file(i, cond, mate=None):
    return f"S{i}_{cond}" + (f"_{mate}" if mate else "") + ".fastq"


@pytest.mark.parametrize("readtype", ["SE", "PE"])
def test_catalogue_of_the_known_samples(tmp_path, readtype):
    """The whole document, for eight pairs or twelve single files in two groups and two conditions."""
    if readtype == "PE":
        layout = [("ctrls", "cond1", [1]), ("ctrls", "cond2", [2]), ("trtms", "cond1", [3, 4, 5]), ("trtms", "cond2", [6, 7, 8])]
    else:
        layout = [("ctrls", "cond1", [1, 2, 3]), ("ctrls", "cond2", [4, 5, 6]), ("trtms", "cond1", [7, 8, 9]), ("trtms", "cond2", [10, 11, 12])]
    want = {}
    for g, c, numbers in layout:
        rows = []
        for i in numbers:
            names = {"forward": _file(i, c, "R1"), "reverse": _file(i, c, "R2")} if readtype == "PE" else {"forward": _file(i, c)}
            for n in names.values():
                f = tmp_path / g / c / n
                f.parent.mkdir(parents=True, exist_ok=True)
                f.write_text("")
            out = {"forward": _file(i, c, "preproc")} | ({r: _file(i, c, r) for r in ("R1only", "R2only", "R1unmerged", "R2unmerged")} if readtype == "PE" else {})
            rows.append({"input": {k: f"{tmp_path}/{g}/{c}/{n}" for k, n in names.items()}, "output": {k: f"/out/preproc/{g}/{c}/{n}" for k, n in out.items()}})
        want.setdefault(g, []).append({"condition": c, "samples": rows})
    found = samples.discover("preproc", readtype, str(tmp_path / "trtms"), str(tmp_path / "ctrls"))
    text = samples.catalogue_json("preproc", readtype, found, "/out")
    assert text == json.dumps({"preproc": want}, indent=4).replace("/", "\\/")


def test_other_mate_endings_and_aligned_names():
    s = samples.Sample("trtms", "c", {"forward": "/in/xfwd.fastq", "reverse": "/in/xrev.fastq"})
    assert samples.outputs("preproc", "PE", s, "/o") == {"forward": "/o/preproc/trtms/c/x_preproc.fastq", "R1only": "/o/preproc/trtms/c/x_R1only.fastq", "R2only": "/o/preproc/trtms/c/x_R2only.fastq", "R1unmerged": "/o/preproc/trtms/c/x_R1unmerged.fastq", "R2unmerged": "/o/preproc/trtms/c/x_R2unmerged.fastq"}
    a = samples.Sample("trtms", "c", {r: f"/in/x_{e}.fastq" for r, e in (("forward", "preproc"), ("R1only", "R1only"), ("R1unmerged", "R1unmerged"), ("R2only", "R2only"), ("R2unmerged", "R2unmerged"))})
    assert samples.outputs("align", "PE", a, "/o") == {"matched": "/o/align/trtms/c/x_preproc_matched.bam", "matched_R1only": "/o/align/trtms/c/x_R1only_matched.bam", "matched_R2only": "/o/align/trtms/c/x_R2only_matched.bam", "matched_unmerged": "/o/align/trtms/c/x_unmerged_matched.bam"}


def test_adapters_keep_their_order_and_none_is_dropped(spark, tmp_path):
    from strandforge.plans.stages import _adapters

    readers.register_formats(spark)
    f = tmp_path / "a.fa"
    f.write_text(">z\nACGT\n>a\nGGTT\n>z2\nACGT\n")
    assert _adapters(spark, str(f)) == ["GGTT", "ACGT", "ACGT"]
    with pytest.raises(ValueError):
        _adapters(spark, str(f), most=2)


def test_folding_results_meet_their_pairs():
    from strandforge.functions.energy import matched_results

    said = "AC&GU\n((&)) ( -1.20)\nAA&AA\n..&.. (  0.00)\n"
    assert matched_results(["AC&GU", None, "AA&AA"], said) == [("((&))", -1.2), None, ("..&..", 0.0)]
    with pytest.raises(ValueError):
        matched_results(["AC&GU", "A&C", "AA&AA"], said)


def test_clusters_are_numbered_in_order_over_ranges(spark):
    from strandforge.operators.intervals import numbered_clusters

    rows = [("c%d" % (i % 3), "+", (i * 37) % 101, (i * 37) % 101 + 5, "c1", "-", i % 7, i % 7 + 3, 1) for i in range(90)]
    df = spark.createDataFrame(rows, "chr1 string, strand1 string, start1 long, end1 long, chr2 string, strand2 string, start2 long, end2 long, no_splits long").repartition(5)
    got = sorted(numbered_clusters(df).collect(), key=lambda r: int(r.clust_id[7:]))
    assert [int(r.clust_id[7:]) for r in got] == list(range(1, 91))
    key = lambda r: (r.chr1, r.start1, r.start2, r.chr2, r.end1)
    assert [key(r) for r in got] == sorted(map(key, got))
    assert numbered_clusters(df.limit(0)).count() == 0


def test_options(tmp_path):
    assert parse_config("quality = 25 # mean\nadpt5 = \n# c\nwtrim = 1\nmmrate=0.2") == {"quality": 25, "wtrim": True, "mmrate": 0.2}
    f = tmp_path / "p.cfg"
    f.write_text("subcall = x\nquality = 25\nminlen = 9\ntrtms = t\noutdir = o\n".replace("subcall = x\n", ""))
    sub, opt = parse_args(["detect", "--config", str(f), "--quality", "30", "--mapq=3"])
    assert (sub, opt.quality, opt.minlen, opt.mapq, opt.wsize) == ("detect", 30, 9, 3, 3)
    opt.check(sub)
    with pytest.raises(ValueError):
        parse_config("nonsense = 1")
    with pytest.raises(ValueError):
        Options().check("detect")


def test_files_read_in_ranges_equal_whole_files(spark, tmp_path):
    """Every size of range, with quality lines that look like first lines."""
    import random

    readers.register_formats(spark)
    rnd = random.Random(3)
    records = [(f"r{i}", "ACGT" * rnd.randint(1, 5)) for i in range(40)]
    quals = ["".join(rnd.choice("@+I") for _ in s) for _, s in records]
    text = "".join(f"@{i}\n{s}\n+\n{q}\n" for (i, s), q in zip(records, quals)).encode()
    for size in (1, 7, 50, 333, len(text) - 1, len(text)):
        got = []
        for start in range(0, len(text), size):
            got += readers.parse_fastq(readers.fastq_lines_between(io.BytesIO(text), start, start + size))
        assert got == [(i, s, q) for (i, s), q in zip(records, quals)]
        lines = [x for start in range(0, len(text), size) for x in readers.whole_lines(io.BytesIO(text), start, start + size)]
        assert b"".join(lines) == text
    d = tmp_path / "g" / "c"
    d.mkdir(parents=True)
    (d / "S1.fastq").write_bytes(text)
    (d / "S2.fastq").write_bytes(text[: len(text) // 3].rpartition(b"\n@")[0] + b"\n")
    (d / "S3.fastq.gz").write_bytes(gzip.compress(text))
    key = lambda df: sorted((r.path, r.read_no, r.id, r.seq, r.qual) for r in df.collect())
    whole = key(spark.read.format("fastq").load(str(d)))
    split = readers.load_numbered(spark, "fastq", str(d), 200)
    assert key(split) == whole and split.select("part").distinct().count() > 5
    assert key(readers.load_numbered(spark, "fastq", str(d), 1 << 20)) == whole
