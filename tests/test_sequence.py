import random

import pytest
from pyspark.sql import functions as F

from strandforge.config import Options
from strandforge.functions import sequence as S
from strandforge.functions.energy import parse_fold, stacking_energy
from strandforge.operators.preproc import preprocess_paired, preprocess_single

READS = "sample_id string, read_no long, id string, seq string, qual string"


def brute_adapter(seq, ad, budget):
    for i in range(len(seq) - len(ad) + 1):
        if sum(x != y for x, y in zip(seq[i:], ad)) <= budget:
            return i
    return None


def test_adapter_position(spark):
    rnd = random.Random(1)
    ad = "AGATCGGAAG"
    seqs = ["".join(rnd.choice("ACGT") for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    seqs += [s[:10] + ad[:4] + "T" + ad[5:] + s[:5] for s in seqs[:50]] + ["", ad, ad[:-1]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, seq string")
    for rate in (0.0, 0.1, 0.3):
        got = {r.i: r.p for r in df.select("i", S.adapter_position("seq", ad, rate).alias("p")).collect()}
        for i, s in enumerate(seqs):
            assert got[i] == brute_adapter(s, ad, int(len(ad) * rate + 1e-9)), (s, rate)


def test_window_trim(spark):
    rnd = random.Random(2)
    quals = ["".join(chr(33 + rnd.randint(0, 41)) for _ in range(rnd.randint(0, 20))) for _ in range(200)]
    df = spark.createDataFrame([(i, q, 0, len(q)) for i, q in enumerate(quals)], "i int, q string, l int, r int")
    got = {r.i: r.e for r in df.select("i", S.window_trim("q", "l", "r", 3, 20).alias("e")).collect()}
    for i, q in enumerate(quals):
        end = len(q)
        while end >= 3 and sum(ord(c) - 33 for c in q[end - 3 : end]) / 3 < 20:
            end -= 3
        assert got[i] == end, q


def test_reverse_complement_is_an_involution(spark):
    r = spark.sql("select 'ACGTNNAC' as s").select(S.reverse_complement(S.reverse_complement(F.col("s"))).alias("x"), S.reverse_complement(F.col("s")).alias("y"), S.normalise_dna("s").alias("z")).first()
    assert (r.x, r.y, r.z) == ("ACGTNNAC", "GTNNACGT", "ACGTNNAC")


@pytest.mark.parametrize("a,b,n", [("", "A", 0), ("ACGT", "ACGT", 4), ("AACCT", "TTAACC", 4), ("AAAA", "CCCC", 0)])
def test_common_substring(a, b, n):
    i, j, k = S.common_substring(a, b)
    assert k == n and a[i : i + k] == b[j : j + k]


def test_merge_mates():
    frag = "ACGTTGCATTACGGATCCATTGCA"
    rev = frag[8:][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert S.merge_mates(frag[:16], rev, 5) == frag
    assert S.merge_mates("AAAAAAA", "AAAAAAA", 5) is None


def test_duplex_of_the_documented_pair():
    got = S.best_duplex("AGGGGTCTTTCCGTCTTGCCGCGGGTACACTGCATCTTCACAGCGAGTTCAA", "TTCGATCAAGAAGAAC")
    assert (got["xa1"], got["xa2"], got["xl"], got["xm"], got["xs"]) == ("TTTCTGG", "GAAGAAC", 7, 5, 5)
    assert round(got["xc"], 6) == 0.714286 and round(got["xr"], 7) == 0.0735294
    assert [(e["xl"], e["xm"]) for e in S.duplex_ends("AAAA", "TTTT")] == [(4, 3)]
    assert S.duplex_ends("AAAA", "AAAA") == [] and S.best_duplex("", "ACG") is None
    assert [(e["xa1"], e["xa2"], e["xm"], e["xl"]) for e in S.duplex_ends("ACACAC", "GTGTGTNGTGTGT")] == [("CACACA", "GTGTGT", 5, 6)] * 2
    assert S.best_duplex("AAAA", "TTTT", cmplmin=0.8) is None


def test_energy():
    assert parse_fold("((.&.))  (-123.40)") == ("((.&.))", -123.4)
    assert parse_fold("nothing here") is None
    assert stacking_energy("AAAA", "TTTT") == round(4.09 - 3 * 0.93, 2)
    assert stacking_energy("A", "A") is None


def test_single_reads(spark):
    rows = [("s", 0, "ok", "ACGTACGTACGTACGTACGTAGATCGGAAGTT", "I" * 32), ("s", 1, "short", "ACAGATCGGAAGTT", "I" * 14), ("s", 2, "poor", "ACGTACGTACGTACGTACGT", "#" * 20), ("s", 3, "empty", "", "")]
    out = preprocess_single(spark.createDataFrame(rows, READS), [], ["AGATCGGAAG"], Options(mmrate=0.1)).collect()
    assert [(r.id, r.seq, len(r.qual)) for r in out] == [("ok", "ACGTACGTACGTACGTACGT", 20)]
    left = preprocess_single(spark.createDataFrame([("s", 0, "x", "AGATCGGAAG" + "ACGTC" * 4, "I" * 30)], READS), ["AGATCGGAAG"], [], Options(modetrm=0)).first()
    assert left.seq == "ACGTC" * 4


def test_paired_reads_are_routed(spark):
    frag = "ACGTTGCATTACGGATCCATTGCAGGCTAACC"
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    fwd = [("s", 0, "m", frag[:22], "I" * 22), ("s", 1, "a", "A" * 20, "I" * 20), ("s", 2, "f", "C" * 20, "I" * 20), ("s", 3, "r", "C" * 20, "#" * 20), ("s", 4, "n", "C", "I")]
    rev = [("s", 0, "m", rc(frag[8:]), "I" * 24), ("s", 1, "a", "A" * 20, "I" * 20), ("s", 2, "f", "G" * 20, "#" * 20), ("s", 3, "r", "G" * 20, "I" * 20), ("s", 4, "n", "C", "I")]
    opt = Options(unprd=True, unmrg=True)
    got = {(r.read_no, r.route): r for r in preprocess_paired(spark.createDataFrame(fwd, READS), spark.createDataFrame(rev, READS), [], [], opt).collect()}
    assert set(got) == {(0, "merged"), (1, "R1unmerged"), (1, "R2unmerged"), (2, "R1only"), (3, "R2only")}
    assert got[0, "merged"].seq == frag and len(got[0, "merged"].qual) == len(frag)
    assert got[3, "R2only"].seq == "G" * 20


def _scalar_ends(first, second):
    """The same alignment, cell by cell."""
    a, b = first[::-1], second
    pair = lambda x, y: 0 if "N" in x + y else 1 if x + y in ("AT", "TA", "GC", "CG", "GT", "TG") else -1
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + pair(a[i - 1], b[j - 1]), h[i - 1][j] - 2, h[i][j - 1] - 2)
    top = max(map(max, h))
    out = []
    for i0 in range(len(a) + 1):
        for j0 in range(len(b) + 1):
            if not top or h[i0][j0] != top:
                continue
            i, j, x, y, matches = i0, j0, "", "", 0
            while h[i][j] > 0:
                if h[i][j] == h[i - 1][j - 1] + pair(a[i - 1], b[j - 1]):
                    x, y, i, j = a[i - 1] + x, b[j - 1] + y, i - 1, j - 1
                    matches += i > 0 and j > 0 and h[i][j] > 0 and h[i][j] - 1 == h[i - 1][j - 1]
                elif h[i][j] == h[i - 1][j] - 2:
                    x, y, i = a[i - 1] + x, "-" + y, i - 1
                else:
                    x, y, j = "-" + x, b[j - 1] + y, j - 1
            out.append({"xa1": x, "xa2": y, "xl": len(x), "xm": matches, "xs": top, "xc": matches / len(x), "xr": matches / (len(a) + len(b))})
    return out


def test_batches_equal_pairs_one_by_one(monkeypatch):
    rnd = random.Random(11)
    seq = lambda: "".join(rnd.choice("ACGTACGTACGTN") for _ in range(rnd.randint(1, 40)))
    pairs = [(seq(), seq()) for _ in range(300)]
    first, second = map(list, zip(*pairs))
    monkeypatch.setattr(S, "CELLS", 5000)
    for cmpl, ratio, by in ((0.0, 0.0, "last"), (0.5, 0.1, "last"), (0.3, 0.0, "cmpl")):
        got = S.best_duplexes(first, second, cmpl, ratio, by)
        for (a, b), g in zip(pairs, got):
            ok = [e for e in _scalar_ends(a, b) if e["xr"] >= ratio and e["xc"] >= cmpl]
            assert g == ((ok[-1] if by == "last" else max(ok, key=lambda e: e["xc"])) if ok else None)
    for (a, b), i, j, n in zip(pairs, *S.common_substrings(first, second)):
        size = max(k for k in range(41) if any(a[p : p + k] in b for p in range(len(a) - k + 1)))
        p = next(p for p in range(len(a)) if a[p : p + size] in b)
        assert (i, j, n) == ((p, b.index(a[p : p + size]), size) if size else (0, 0, 0))


def test_other_forms_of_merging_and_trimming(spark):
    frag = "ACGTTGCAAGGCTTACCGATAGC"
    rev = frag[8:][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert S.merged_mates([frag[:16]], [rev], 5) == [frag] and S.merged_mates([frag[:16]], ["GG" + rev + "CCC"], 5, prefix=True) == [frag[:16] + "GGG"]
    left, right = S.trim_bounds("s", [], ["TTACC"], 1, 0.0, drop_last=True)
    got = [tuple(r) for r in spark.createDataFrame([(frag,), ("ACGT",), ("",)], "s string").select(left, right).collect()]
    assert got == [(0, 12), (0, 3), (0, 0)] and S.find_adapter(frag, "TTACC", 0.0) == 12 and S.find_adapter("AC", "ACG", 0.5) is None
