"""SQL names of the sequence kernels."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from . import sequence as S
from .statistics import binomial_tail_udf


class CigarSegments:
    """Table function: (op_no, n, op) of a CIGAR."""

    def eval(self, cigar: str):
        import re

        for i, (n, op) in enumerate(re.findall(r"(\d+)([MIDNSHP=X])", cigar or "")):
            yield i, int(n), op


def register_functions(spark: SparkSession) -> None:
    """dna_revcomp, adapter_pos, lc_substring, duplex_align, merge_mates, binom_sf, chi2_sf_even, hyb_energy and the table function cigar_segments."""
    from .energy import stacking_udf

    ship(spark)

    @F.pandas_udf("string")
    def revcomp(s: pd.Series) -> pd.Series:
        table = str.maketrans("ACGTN", "TGCAN")
        return s.map(lambda x: x[::-1].translate(table), na_action="ignore")

    @F.pandas_udf("string")
    def lc_substring(a: pd.Series, b: pd.Series) -> pd.Series:
        rows = lambda x, y: [t[i : i + n] for t, i, _, n in zip(x, *(v.tolist() for v in S.common_substrings(x, y)))]
        return pd.Series(S._of_pairs(a, b, rows), dtype="object")

    @F.pandas_udf("long")
    def adapter_pos(seq: pd.Series, adapter: pd.Series, mmrate: pd.Series) -> pd.Series:
        found = [S.find_adapter(s, a, r) if s is not None and a else None for s, a, r in zip(seq, adapter, mmrate)]
        return pd.Series(found, dtype="Int64")

    spark.udf.register("adapter_pos", adapter_pos)
    # P(chi-square with 2 k degrees of freedom > x), in closed form
    spark.sql(
        "create or replace temporary function chi2_sf_even(x double, k int) returns double return "
        "case when x <= 0 then 1d else aggregate(sequence(1, k), named_struct('s', 0d, 't', exp(-x / 2)), (a, i) -> named_struct('s', a.s + a.t, 't', a.t * x / 2 / i), a -> a.s) end"
    )
    for name, f in {"dna_revcomp": revcomp, "lc_substring": lc_substring, "duplex_align": S.duplex_udf(), "merge_mates": S.merge_udf(5), "binom_sf": binomial_tail_udf(), "hyb_energy": stacking_udf()}.items():
        spark.udf.register(name, f)
    spark.udtf.register("cigar_segments", F.udtf(CigarSegments, returnType="op_no int, n int, op string"))
