"""Read trimming, filtering and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Options
from ..functions import sequence as S


def trim_reads(reads: DataFrame, adapters5: list[str], adapters3: list[str], opt: Options) -> DataFrame:
    """Adapter trimming, then window trimming; adds trim_left and trim_right and cuts seq and qual."""
    left, right = S.trim_bounds("seq", adapters5, adapters3, opt.modetrm, opt.mmrate, opt.compat_drop_last_base)
    out = reads.withColumn("trim_left", left.cast("int")).withColumn("trim_right", F.greatest(left, right).cast("int"))
    if opt.wtrim:
        out = out.withColumn("trim_right", S.window_trim("qual", "trim_left", "trim_right", opt.wsize, opt.quality))
    cut = lambda c: S.slice_bases(F.col(c), F.col("trim_left"), F.col("trim_right"))
    return out.withColumn("seq", cut("seq")).withColumn("qual", cut("qual"))


def preprocess_single(reads: DataFrame, adapters5: list[str], adapters3: list[str], opt: Options) -> DataFrame:
    """Trimmed reads that pass; one narrow stage."""
    return trim_reads(reads, adapters5, adapters3, opt).where(S.passes("seq", "qual", opt.quality, opt.minlen))


def zip_mates(fwd: DataFrame, rev: DataFrame) -> DataFrame:
    """The n-th forward read of a sample with its n-th reverse read."""
    keys = ["sample_id", "read_no"]
    named = lambda df, p: df.select(*keys, *(F.col(c).alias(f"{p}_{c}") for c in ("id", "seq", "qual")))
    return named(fwd, "fwd").join(named(rev, "rev"), keys)


def preprocess_paired(fwd: DataFrame, rev: DataFrame, adapters5: list[str], adapters3: list[str], opt: Options) -> DataFrame:
    """Routes each pair: merged, R1only, R2only, R1unmerged and R2unmerged (both mates), or neither."""
    pairs = zip_mates(trim_reads(fwd, adapters5, adapters3, opt), trim_reads(rev, adapters5, adapters3, opt))
    ok = {p: S.passes(f"{p}_seq", f"{p}_qual", opt.quality, opt.minlen) for p in ("fwd", "rev")}
    pairs = pairs.withColumns({"ok1": ok["fwd"], "ok2": ok["rev"]}).where("ok1 or ok2")
    both = F.col("ok1") & F.col("ok2")
    # the function sees only pairs that may merge
    pairs = pairs.withColumn("merged", S.merge_udf(opt.minovlps, opt.compat_merge_prefix)(F.when(both, F.col("fwd_seq")), F.when(both, F.col("rev_seq"))))
    from_fwd = F.least(F.length("merged"), F.length("fwd_qual"))
    merged_qual = F.concat(F.substring(F.col("fwd_qual"), F.lit(1), from_fwd), F.expr("right(reverse(rev_qual), greatest(0, length(merged) - length(fwd_qual)))"))
    row = lambda route, i, s, q: F.struct(F.lit(route).alias("route"), F.col(i).alias("id"), F.col(s).alias("seq"), q.alias("qual"))
    none = F.array().cast("array<struct<route:string,id:string,seq:string,qual:string>>")
    routes = (
        F.when(F.col("merged").isNotNull(), F.array(row("merged", "fwd_id", "merged", merged_qual)))
        .when(both, F.array(row("R1unmerged", "fwd_id", "fwd_seq", F.col("fwd_qual")), row("R2unmerged", "rev_id", "rev_seq", F.col("rev_qual"))) if opt.unmrg else none)
        .when(F.col("ok1"), F.array(row("R1only", "fwd_id", "fwd_seq", F.col("fwd_qual"))) if opt.unprd else none)
        .otherwise(F.array(row("R2only", "rev_id", "rev_seq", F.col("rev_qual"))) if opt.unprd else none)
    )
    return pairs.select("sample_id", "read_no", F.explode(routes).alias("r")).select("sample_id", "read_no", "r.*")
