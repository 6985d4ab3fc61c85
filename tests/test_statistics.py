import math
import random

from pyspark.sql import functions as F

from strandforge.functions import statistics as T


def tail(x, n, p):
    return math.fsum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1, n + 1))


def test_binomial_tail():
    rnd = random.Random(6)
    for _ in range(200):
        n = rnd.randint(1, 60)
        x, p = rnd.randint(0, n), rnd.random()
        assert math.isclose(T.binomial_tail(x, n, p), tail(x, n, p), rel_tol=1e-9, abs_tol=1e-300)
    assert T.binomial_tail(50, 1000, 1e-4) > 0  # no cancellation in the upper tail
    assert T.binomial_tail(3, 3, 0.5) == 0 and T.binomial_tail(1, 5, 0.0) == 0 and T.binomial_tail(1, 5, 1.0) == 1


def test_combined_pvalue(spark):
    for ps in ([0.05], [0.01, 0.2], [1.0, 1.0, 1.0], [0.3, 0.001, 0.02, 0.9]):
        adj = [min(1, p * len(ps) / (i + 1)) for i, p in enumerate(sorted(ps))]
        h = -sum(map(math.log, adj))
        want = math.exp(-h) * sum(h**i / math.factorial(i) for i in range(len(ps)))
        got = spark.createDataFrame([(ps,)], "ps array<double>").select(T.combined_pvalue("ps").alias("p")).first().p
        assert math.isclose(got, max(1e-10, want), rel_tol=1e-9)


def test_pvalue_threshold_and_scores(spark):
    df = spark.createDataFrame([(4, 100, 0.1, 0.1), (5, 100, 0.1, 0.1), (5, 100, None, 0.1)], "s int, n long, f1 double, f2 double")
    got = [r.p for r in df.select(T.interaction_pvalue("s", "n", "f1", "f2", F.lit(False)).alias("p")).collect()]
    assert got[0] == 1.0 and math.isclose(got[1], tail(5, 100, 0.02), rel_tol=1e-9) and got[2] == T.FLOOR
    s = spark.createDataFrame([(0.5, -4.0), (0.7, -9.0), (0.9, None)], "c double, e double").agg(T.global_complementarity("c").alias("g"), T.global_hybridisation("e").alias("h")).first()
    assert math.isclose(s.g, 0.7 * 0.9) and math.isclose(s.h, -math.sqrt(6.5 * 9))
    assert spark.createDataFrame([(None,)], "e double").agg(T.global_hybridisation("e").alias("h")).first().h is None
