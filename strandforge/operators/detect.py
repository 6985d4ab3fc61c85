"""Split-read detection on alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Options
from ..functions import energy as E
from ..functions import sequence as S


def filter_alignments(rows: DataFrame, opt: Options) -> DataFrame:
    """Mapped, longer than minlen, and of a mapping quality above mapq."""
    return rows.where(f"flag & 4 = 0 and length(seq) > {opt.minlen} and mapq > {opt.mapq}")


def strand_of(flag: str = "flag"):
    return F.when(F.col(flag).bitwiseAND(16) != 0, "-").otherwise("+")


def cigar_ops(cigar: str = "cigar"):
    """Array of (n, op)."""
    return F.expr(f"transform(regexp_extract_all({cigar}, '(\\\\d+)([MIDNSHP=X])', 0), x -> named_struct('n', cast(left(x, length(x) - 1) as int), 'op', right(x, 1)))")


def until_single(rows: DataFrame) -> DataFrame:
    """The records of each read up to the first that is not split (xj below 2), which `one` marks."""
    order = Window.partitionBy("sample_id", "qname").orderBy("rec_no")
    rows = rows.withColumn("one", F.coalesce(F.col("xj"), F.lit(0)) < 2)
    return rows.withColumn("before", F.coalesce(F.max("one").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))).where("not before").drop("before")


def passing(pairs: DataFrame, opt: Options) -> DataFrame:
    """Pairs complementary enough, and of low enough energy or none."""
    return pairs.where((F.col("xc") >= opt.cmplmin) & (F.col("xe").isNull() | (F.col("xe") <= opt.nrgmax)))


def gaps(rows: DataFrame) -> DataFrame:
    """One row per N of a CIGAR: (keys, op_no, a, b), the last base before and the first after it, from 0."""
    ops = rows.withColumn("ops", cigar_ops())
    at = "aggregate(slice(ops, 1, i), pos0, (p, o) -> p + if(o.op in ('M', '=', 'X', 'D', 'N'), o.n, 0))"
    found = ops.withColumn("g", F.explode_outer(F.expr(f"transform(filter(sequence(0, greatest(0, size(ops) - 1)), i -> get(ops, i).op = 'N'), i -> named_struct('op_no', i, 'a', {at} - 1, 'b', {at} + get(ops, i).n))")))
    return found.where("g is not null").select("sample_id", "qname", "rec_no", "rname", "g.*")


def introns(junctions: DataFrame) -> DataFrame:
    """(chrom, a, b): end of each exon and start of the next of its transcript, all of them."""
    w = Window.partitionBy("feature_no", "transcript").orderBy("start1", "end1")
    return junctions.withColumn("a", F.lag("end1").over(w)).withColumn("b", F.col("start1")).where("a is not null").select("chrom", "a", "b").distinct()


def near_introns(gap: DataFrame, known: DataFrame, reach: int = 5) -> DataFrame:
    """The gaps both of whose ends lie within reach of an intron's: an equi-join on chromosome and coarse place."""
    size = 2 * reach + 1
    near = known.toDF("chrom", "ia", "ib").withColumn("_cell", F.explode(F.expr(f"sequence((ia - {reach}) div {size}, (ia + {reach}) div {size})")))
    cond = [gap["chrom"] == near["chrom"], F.expr("_at") == F.col("_cell"), F.abs(F.col("a") - F.col("ia")) <= reach, F.abs(F.col("b") - F.col("ib")) <= reach]
    return gap.withColumn("_at", F.expr(f"a div {size}")).join(near, cond, "left_semi").drop("_at")


def segments(rows: DataFrame, opt: Options, spliced: DataFrame | None = None) -> DataFrame:
    """Adds segs: the parts of each record between gaps that are no known splice sites, as an array.

    Each part has xx and xy (its first and last base in the read, from 1), pos0, seq, and cigar. Leading and
    trailing clips are left out with exclclipping. Parts shorter than minlen are left out.
    """
    keys = ["sample_id", "qname", "rec_no"]
    ops = rows.withColumn("ops", cigar_ops())
    if spliced is not None:
        ops = ops.join(spliced.groupBy(*keys).agg(F.collect_set("op_no").alias("known")), keys, "left")
    else:
        ops = ops.withColumn("known", F.array().cast("array<int>"))
    numbered = "transform(z.ops, (o, i) -> named_struct('i', i, 'n', o.n, 'op', o.op, 'cut', o.op = 'N' and not array_contains(coalesce(z.known, array()), i)))"
    zero = "named_struct('done', cast(array() as array<struct<x:int,y:int,p:bigint,c:string>>), 'x', 1, 'y', 0, 'p', pos0, 'q', pos0, 'c', '')"
    skip = "o.op = 'S'" if opt.exclclipping else "false"
    part = "array(named_struct('x', s.x, 'y', s.y, 'p', s.p, 'c', s.c))"
    step = f"""case
      when o.cut then named_struct('done', concat(s.done, {part}), 'x', s.y + 1, 'y', s.y, 'p', s.q + o.n, 'q', s.q + o.n, 'c', '')
      when {skip} and s.c = '' then named_struct('done', s.done, 'x', s.x + o.n, 'y', s.y + o.n, 'p', s.p, 'q', s.q, 'c', s.c)
      when {skip} then s
      else named_struct('done', s.done, 'x', s.x, 'y', s.y + if(o.op in ('D', 'N'), 0, o.n), 'p', s.p, 'q', s.q + if(o.op in ('M', '=', 'X', 'D', 'N'), o.n, 0), 'c', concat(s.c, o.n, o.op))
    end"""
    walk = f"aggregate({numbered}, {zero}, (s, o) -> {step}, s -> concat(s.done, {part}))"
    # bound as a lambda's variable, a CIGAR is parsed once
    segs = f"""filter(transform(flatten(transform(array(struct(ops, known)), z -> {walk})), (w, k) -> named_struct('seg_no', k, 'xx', w.x, 'xy', w.y, 'pos0', w.p, 'cigar', w.c, 'seq', substring(seq, w.x, w.y - w.x + 1), 'qual', substring(qual, w.x, w.y - w.x + 1))),
      w -> length(w.seq) >= {opt.minlen} and length(w.seq) > 0)"""
    return ops.withColumn("segs", F.expr(segs)).drop("ops", "known")


def each_segment(rows: DataFrame) -> DataFrame:
    """One row a segment, as struct s, beside the record's other columns."""
    return rows.withColumn("s", F.explode_outer("segs")).where("s is not null").drop("segs")


def pair_segments(rows: DataFrame) -> DataFrame:
    """All pairs i < j of a record's segments that do not overlap in the read: (s1, s2, pair_no)."""
    every = "flatten(transform(segs, (s, i) -> transform(slice(segs, i + 2, size(segs)), t -> named_struct('s1', s, 's2', t))))"
    # the outer form, since for the other one the planner adds filters that evaluate the whole array twice more
    found = rows.select("sample_id", "qname", "rec_no", "rname", "flag", F.posexplode_outer(F.expr(f"filter({every}, p -> p.s2.xx > p.s1.xy)")).alias("pair_no", "p"))
    return found.where("p is not null").select("*", "p.*").drop("p")


def route(pairs: DataFrame) -> DataFrame:
    """Reads with one passing pair are splits, with more multsplits."""
    n = F.count("*").over(Window.partitionBy("sample_id", "qname"))
    return pairs.withColumn("route", F.when(n == 1, "splits").otherwise("multsplits"))


def detect(alignments: DataFrame, opt: Options, junctions: DataFrame | None = None, energies: E.EnergyProvider | None = None) -> tuple[DataFrame, DataFrame]:
    """(singles, splits with route) of alignments (sample_id, qname, rec_no, flag, rname, pos0, mapq, cigar, seq, qual, xj).

    A read's records count up to the first that is not split (xj below 2); that one makes the read single.
    """
    rows = until_single(filter_alignments(alignments, opt))
    singles = rows.where("one").drop("one")
    chimeric = rows.where("not one").drop("one")
    spliced = None
    if opt.splicing and junctions is not None:
        # annotation counts from 1
        known = introns(junctions).select("chrom", (F.col("a") - 1).alias("a"), (F.col("b") - 1).alias("b"))
        spliced = near_introns(gaps(chimeric).withColumnRenamed("rname", "chrom"), known)
    pairs = pair_segments(segments(chimeric, opt, spliced))
    pairs = pairs.withColumn("flag", F.col("flag").bitwiseAND(16)).withColumns({"seq1": F.col("s1.seq"), "seq2": F.col("s2.seq")})
    pairs = pairs.withColumn("d", S.duplex_udf(opt.cmplmin, opt.sitelenratio, opt.best_by)("seq1", "seq2")).where("d is not null").select("*", "d.*").drop("d")
    scored = (energies or {"existing": E.existing_energy, "model": E.nearest_neighbour}[opt.energy])(pairs)
    return singles, route(passing(scored, opt))


def run_counts(alignments: DataFrame, singles: DataFrame, splits: DataFrame, opt: Options) -> DataFrame:
    """(sample_id, reads, aligned, splits, multsplits): sums over results, so repeated tasks count once."""
    reads = filter_alignments(alignments, opt).groupBy("sample_id").agg(F.count_distinct("qname").alias("reads"))
    one = singles.groupBy("sample_id").agg(F.count("*").alias("aligned"))
    two = splits.groupBy("sample_id").agg(F.count_if(F.col("route") == "splits").alias("splits"), F.count_distinct(F.when(F.col("route") == "multsplits", F.col("qname"))).alias("multsplits"))
    return reads.join(one, "sample_id", "left").join(two, "sample_id", "left").na.fill(0)
