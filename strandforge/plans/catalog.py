"""Registered queries of the sequencing engine and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Options
from ..functions import sequence as S
from ..functions import statistics as T
from ..operators import analysis as A
from ..operators import detect as D
from ..operators.intervals import cluster_boxes, distinct_spans, interval_join, islands
from ..operators.preproc import zip_mates
from ..shipping import ship
from ..sources.readers import attribute
from ..sources.samples import ROLES, assign_roles
from ..staging import staged
from .views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ADAPTER, LONG_ADAPTER = "ACG", "ACGTACGT"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _r(c, n: int = 6):
    return F.round(c, n)


def _aligned(spark, d):
    """The reads as alignment records with a sequence, in the order of segments; some have the mark of a split."""
    extra = {"seq": "repeat('A', cast(end1 - start1 as int))", "rec_no": "row_number() over (partition by sample_id, qname order by seg, read_id)", "xj": "cast(if(mapq % 3 = 0, 1, 2) as int)", "rname": "chrom"}
    return view(spark, d, "reads").withColumns({c: F.expr(e) for c, e in extra.items()})


# ---------------------------------------------------------------- scans, filters, catalogue
@query(f"{with_views('reads')} select read_id, chrom, start1, mapq from v_reads where (flag & 4) = 0 and end1 - start1 > 15 and mapq > 10")
def q_scan_filter_reads(spark, d):
    return D.filter_alignments(_aligned(spark, d), Options(minlen=15, mapq=10)).select("read_id", "chrom", "start1", "mapq")


@query(
    f"""{with_views('sample')}, n as (select *, row_number() over (partition by grp, condition order by lower(path), path) - 1 as no from v_sample)
select grp as "group", condition, cast(no // 5 as bigint) as sample_no, (['{"','".join(ROLES['align']['PE'])}'])[no % 5 + 1] as role, path from n"""
)
def q_catalog_roles(spark, d):
    return assign_roles(view(spark, d, "sample").withColumnRenamed("grp", "group"), ROLES["align"]["PE"])


@query(f"{with_views('sample')} select grp, condition, replicate, o_orderkey, cast(row_number() over (partition by grp, condition order by o_orderkey desc) = 1 as integer) as is_last from v_sample")
def q_last_flag(spark, d):
    return A.last_flags(view(spark, d, "sample").select("grp", "condition", "replicate", "o_orderkey"), ["grp", "condition"], "o_orderkey")


@query(
    f"""{with_views('reads')}, r as (select *, max(case when mapq % 3 = 0 then 1 else 0 end) over (partition by sample_id, qname order by seg, read_id rows between unbounded preceding and 1 preceding) as before from v_reads)
select qname, cast(count(*) as bigint) as records, min(start1) as lo, max(start1) as hi, cast(count(case when mapq % 3 = 0 then 1 end) as bigint) as singles from r where coalesce(before, 0) = 0 group by qname"""
)
def q_group_by_qname(spark, d):
    rows = D.until_single(_aligned(spark, d))
    return rows.groupBy("qname").agg(F.count("*").alias("records"), F.min("start1").alias("lo"), F.max("start1").alias("hi"), F.count_if("one").alias("singles"))


# ---------------------------------------------------------------- sequences
@query(
    f"""{with_views('seqs')}, s as (select *, list_sum(list_transform(range(1, length(qual) + 1), lambda i: ascii(substring(qual, i, 1)) - 33)) as q from v_seqs)
select doc_id, cast(q as bigint) as phred_sum, round(q * 1.0 / length(qual), 6) as mean_phred from s where q * 1.0 / length(qual) >= 17 and length(seq) >= 15"""
)
def q_phred_filter(spark, d):
    s = view(spark, d, "seqs").where(S.passes("seq", "qual", 17, 15))
    return s.select("doc_id", S.phred_sum("qual").alias("phred_sum"), _r(S.mean_phred("qual")).alias("mean_phred"))


@query(f"{with_views('seqs')} select doc_id, case when instr(seq, '{ADAPTER}') > 0 then substring(seq, 1, instr(seq, '{ADAPTER}') - 1) else seq end as trimmed from v_seqs")
def q_trim_exact(spark, d):
    left, right = S.trim_bounds("seq", [], [ADAPTER], 1, 0.0)
    return view(spark, d, "seqs").select("doc_id", S.slice_bases(F.col("seq"), left, right).alias("trimmed"))


@query(f"{with_views('seqs')} select doc_id, case when instr(seq, '{ADAPTER}') > 0 then substring(seq, instr(seq, '{ADAPTER}') + {len(ADAPTER)}) else seq end as trimmed from v_seqs")
def q_trim_five_prime(spark, d):
    left, right = S.trim_bounds("seq", [ADAPTER], [], 0, 0.0)
    return view(spark, d, "seqs").select("doc_id", S.slice_bases(F.col("seq"), left, right).alias("trimmed"))


@query(
    f"""{with_views('seqs')} select doc_id, cast(list_filter(range(0, length(seq) - {len(LONG_ADAPTER)} + 1), lambda i:
  list_sum(list_transform(range(1, {len(LONG_ADAPTER)} + 1), lambda k: case when substring(seq, i + k, 1) <> substring('{LONG_ADAPTER}', k, 1) then 1 else 0 end)) <= 3)[1] as bigint) as hit from v_seqs"""
)
def q_trim_hamming(spark, d):
    return view(spark, d, "seqs").select("doc_id", S.adapter_position("seq", LONG_ADAPTER, 0.4).cast("long").alias("hit"))


@query(
    f"""{with_views('seqs')} select doc_id, cast(64 - 3 * coalesce(list_filter(range(0, 21), lambda k:
  list_sum(list_transform(range(1, 4), lambda j: ascii(substring(qual, 64 - (k + 1) * 3 + j, 1)) - 33)) >= 60)[1], 21) as integer) as right_bound from v_seqs"""
)
def q_nibble(spark, d):
    s = view(spark, d, "seqs").withColumn("l", F.lit(0)).withColumn("r", F.length("qual"))
    return s.select("doc_id", S.window_trim("qual", "l", "r", 3, 20).alias("right_bound"))


@query(f"{with_views('seqs')} select doc_id, translate(reverse(seq), 'ACGTN', 'TGCAN') as rc from v_seqs")
def q_revcomp(spark, d):
    return view(spark, d, "seqs").select("doc_id", S.reverse_complement(F.col("seq")).alias("rc"))


@query("select c_custkey, regexp_replace(upper(c_name), '[^ACGT]', '', 'g') as bases, regexp_replace(translate(upper(c_name), 'U', 'T'), '[^ACGT]', 'N', 'g') as dna from customer")
def q_strip_non_acgt(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select("c_custkey", S.strip_non_acgt(F.upper("c_name")).alias("bases"), S.normalise_dna("c_name").alias("dna"))


def _mates(spark, d):
    s = view(spark, d, "seqs")
    return tuple(s.where(f"doc_id % 2 = {k}").selectExpr("'s' as sample_id", "doc_id div 2 as read_no", "concat('r', doc_id) as id", "seq", "qual") for k in (0, 1))


@query(f"{with_views('seqs')} select a.doc_id // 2 as read_no, a.seq as fwd_seq, b.seq as rev_seq from v_seqs a join v_seqs b on a.doc_id % 2 = 0 and b.doc_id % 2 = 1 and a.doc_id // 2 = b.doc_id // 2")
def q_mate_zip(spark, d):
    return zip_mates(*_mates(spark, d)).select("read_no", "fwd_seq", "rev_seq")


@query(
    f"""{with_views('seqs')}, s as (select doc_id, seq, concat(substring(seq, 40, 25), 'ACGTTGCA') as other from v_seqs),
runs as (select *, unnest(list_filter(list_transform(range(1, length(seq) + 1), lambda i: {{'i': i, 'n': coalesce(list_max(list_filter(range(1, length(seq) - i + 2), lambda n: instr(other, substring(seq, i, n)) > 0)), 0)}}), lambda r: r.n >= 5)) as run from s),
best as (select doc_id, seq, other, arg_min(run, (-run.n, run.i)) as b from runs group by doc_id, seq, other)
select s.doc_id, case when b is not null then concat(substring(s.seq, 1, b.i + b.n - 1), substring(s.other, instr(s.other, substring(s.seq, b.i, b.n)) + b.n)) end as merged from s left join best on best.doc_id = s.doc_id"""
)
def q_lcs_merge(spark, d):
    ship(spark)
    s = view(spark, d, "seqs").withColumn("rev", S.reverse_complement(F.expr("concat(substring(seq, 40, 25), 'ACGTTGCA')")))
    return s.select("doc_id", S.merge_udf(5)("seq", "rev").alias("merged"))


#: Alignment rows one after the other, each cell the best of the gaps from its left; then every best end is traced back.
_PAIRS_UP = "case when instr(' AT TA GC CG GT TG ', concat(' ', {}, {}, ' ')) > 0 then 1 else -1 end"
_DUPLEX = f"""{with_views('seqs').replace('with ', 'with recursive ', 1)}, s as (select doc_id, reverse(substring(seq, 1, 32)) as a, substring(seq, 33, 32) as b from v_seqs),
h as (select doc_id, a, b, 0 as i, list_transform(range(0, length(b) + 1), lambda j: 0) as cells from s
  union all select doc_id, a, b, i + 1, list_concat([0], list_transform(range(1, length(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: own[k] - 2 * (j - k))))) from
    (select *, list_transform(range(1, length(b) + 1), lambda j: cast(greatest(0, cells[j] + {_PAIRS_UP.format('substring(a, i + 1, 1)', 'substring(b, j, 1)')}, cells[j + 1] - 2) as bigint)) as own from h where i < length(a))),
hm as (select doc_id, any_value(a) as a, any_value(b) as b, list(cells order by i) as m, max(list_max(cells)) as top from h group by doc_id),
tr as (select doc_id, e.i as ei, e.j as ej, e.i, e.j, '' as x, '' as y, 0 as xm, 0 as xl from
    (select doc_id, m, top, unnest(list_transform(range(0, 33 * 33), lambda c: {{'i': c // 33, 'j': c % 33}})) as e from hm where top > 0) where m[e.i + 1][e.j + 1] = top
  union all select doc_id, ei, ej, case when diag or up then i - 1 else i end, case when diag or not up then j - 1 else j end, concat(case when diag or up then substring(a, i, 1) else '-' end, x),
    concat(case when diag or not up then substring(b, j, 1) else '-' end, y), xm + case when diag and i > 1 and j > 1 and m[i][j] > 0 and m[i][j] - 1 = m[i - 1][j - 1] then 1 else 0 end, xl + 1 from
    (select tr.*, a, b, m, m[i + 1][j + 1] = m[i][j] + {_PAIRS_UP.format('substring(a, i, 1)', 'substring(b, j, 1)')} as diag, m[i + 1][j + 1] = m[i][j + 1] - 2 as up from tr join hm on hm.doc_id = tr.doc_id where m[i + 1][j + 1] > 0)),
ended as (select tr.*, top from tr join hm on hm.doc_id = tr.doc_id where m[i + 1][j + 1] = 0 and xm / 64.0 >= 0.1),
last as (select *, row_number() over (partition by doc_id order by ei desc, ej desc) as k from ended)
select s.doc_id, x as xa1, y as xa2, cast(coalesce(xl, 0) as integer) as xl, cast(coalesce(xm, 0) as integer) as xm, cast(coalesce(top, 0) as integer) as xs, round(xm * 1.0 / xl, 6) as xc, round(xm / 64.0, 6) as xr from s left join last on last.doc_id = s.doc_id and k = 1"""


@query(_DUPLEX)
def q_duplex_align(spark, d):
    ship(spark)
    s = view(spark, d, "seqs").withColumns({"a": F.substring("seq", 1, 32), "b": F.substring("seq", 33, 32)})
    return s.select("doc_id", S.duplex_udf(0.0, 0.1)("a", "b").alias("x")).select("doc_id", "x.xa1", "x.xa2", *(F.coalesce(f"x.{c}", F.lit(0)).alias(c) for c in ("xl", "xm", "xs")), _r("x.xc").alias("xc"), _r("x.xr").alias("xr"))


_ATTR = "concat('ID=gene', cast(p_partkey as varchar(20)), ';gene_name=', p_brand, ';Name=', p_name, ';gene_name=again;product=', p_type)"


@query(
    f"""with a as (select p_partkey, {_ATTR} as attr from part) select p_partkey, regexp_extract(attr, '(?:^|;)ID=([^;]*)', 1) as id, regexp_extract(attr, '(?:^|;)gene_name=([^;]*)', 1) as name,
regexp_extract(attr, '(?:^|;)product=([^;]*)', 1) as product, regexp_extract(attr, '(?:^|;)gene_biotype=([^;]*)', 1) as biotype from a"""
)
def q_gff_attributes(spark, d):
    a = spark.read.parquet(f"{d}/part.parquet").selectExpr("p_partkey", f"{_ATTR} as attr")
    return a.select("p_partkey", attribute("attr", "ID").alias("id"), attribute("attr", "gene_name", "Name").alias("name"), attribute("attr", "product").alias("product"), attribute("attr", "gene_biotype", "gene_type").alias("biotype"))


# ---------------------------------------------------------------- interval joins
_THETA = "r.chrom = f.chrom and greatest(r.start1, f.f_start) <= least(r.end1, f.f_end)"
_SPANS = (["chrom"], ("start1", "end1"), ("f_start", "f_end"))


@query(f"{with_views('reads', 'feature')} select r.read_id, f.name, case when r.strand = f.f_strand then 'sense' else 'antisense' end as orientation from v_reads r join v_feature f on {_THETA}")
def q_interval_join(spark, d):
    return A.hits(view(spark, d, "reads"), view(spark, d, "feature"), ["read_id"]).select("read_id", "name", "orientation")


@query(f"{with_views('reads', 'feature')} select r.read_id, f.name from v_reads r left join v_feature f on {_THETA}")
def q_interval_join_left(spark, d):
    return interval_join(view(spark, d, "reads").select("read_id", "chrom", "start1", "end1"), view(spark, d, "feature").select("chrom", "f_start", "f_end", "name"), *_SPANS, "left", ["read_id"]).select("read_id", "name")


@query(f"{with_views('reads', 'feature')} select r.read_id from v_reads r where exists (select 1 from v_feature f where {_THETA})")
def q_interval_join_semi(spark, d):
    return interval_join(view(spark, d, "reads").select("read_id", "chrom", "start1", "end1"), view(spark, d, "feature"), *_SPANS, "left_semi", ["read_id"]).select("read_id")


@query(f"{with_views('reads', 'feature')} select r.read_id from v_reads r where not exists (select 1 from v_feature f where {_THETA})")
def q_interval_join_anti(spark, d):
    return interval_join(view(spark, d, "reads").select("read_id", "chrom", "start1", "end1"), view(spark, d, "feature"), *_SPANS, "left_anti", ["read_id"]).select("read_id")


_EXONS = "select feature_no, chrom, concat('t', cast(feature_no as varchar(20))) as transcript, f_start + k * 90 as start1, f_start + k * 90 + 40 as end1 from v_feature cross join (values (0), (1), (2)) as e(k)"


@query(
    f"""{with_views('feature')}, exons as ({_EXONS}), introns as (select chrom, lag(end1) over (partition by feature_no, transcript order by start1, end1) as a, start1 as b from exons),
gap as (select feature_no, chrom, f_start + 40 + feature_no % 13 - 6 as a, f_start + 90 + feature_no % 7 - 3 as b from v_feature)
select g.feature_no, g.a, g.b from gap g where exists (select 1 from introns i where i.chrom = g.chrom and i.a is not null and abs(g.a - i.a) <= 5 and abs(g.b - i.b) <= 5)"""
)
def q_splice_match(spark, d):
    f = view(spark, d, "feature")
    exons = f.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).selectExpr("feature_no", "chrom", "concat('t', feature_no) as transcript", "f_start + k * 90 as start1", "f_start + k * 90 + 40 as end1")
    gap = f.selectExpr("feature_no", "chrom", "f_start + 40 + feature_no % 13 - 6 as a", "f_start + 90 + feature_no % 7 - 3 as b")
    return D.near_introns(gap, D.introns(exons)).select("feature_no", "a", "b")


# ---------------------------------------------------------------- split reads
def _segs(spark, d):
    """Reads with the segments of each record as an array, by qname and chromosome."""
    r = view(spark, d, "reads")
    seg = F.struct(F.col("seg").alias("seg_no"), (F.col("start1") % 97).alias("xx"), (F.col("start1") % 97 + F.col("mapq")).alias("xy"), "read_id")
    return r.groupBy("sample_id", "qname", "chrom").agg(F.array_sort(F.collect_list(seg)).alias("segs")).withColumns({"rec_no": F.lit(0), "flag": F.lit(0), "rname": F.col("chrom")})


_PAIRS = """, x as (select *, start1 % 97 as xx, start1 % 97 + mapq as xy from v_reads),
pairs as (select a.sample_id, a.qname, a.chrom, a.read_id as r1, b.read_id as r2, a.seg as seg1, b.seg as seg2 from x a join x b on a.qname = b.qname and a.chrom = b.chrom and (a.seg, a.xx, a.xy, a.read_id) < (b.seg, b.xx, b.xy, b.read_id) and b.xx > a.xy)"""


@query(f"{with_views('reads')}{_PAIRS} select qname, r1, r2 from pairs")
def q_within_read_pairs(spark, d):
    return D.pair_segments(_segs(spark, d)).select("qname", F.col("s1.read_id").alias("r1"), F.col("s2.read_id").alias("r2"))


@query(f"{with_views('reads')}{_PAIRS} select qname, r1, r2, case when count(*) over (partition by qname) = 1 then 'splits' else 'multsplits' end as route from pairs")
def q_route_single_split_multi(spark, d):
    return D.route(D.pair_segments(_segs(spark, d))).select("qname", F.col("s1.read_id").alias("r1"), F.col("s2.read_id").alias("r2"), "route")


_CIGAR = "concat(cast(20 + l_linenumber as varchar(9)), 'M', cast(100 + l_partkey % 50 as varchar(9)), 'N', cast(18 + l_suppkey % 9 as varchar(9)), '=', '2D', '4S')"


@query(
    f"""with c as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_partkey * 10 as pos0, {_CIGAR} as cigar, 20 + l_linenumber as n1, 100 + l_partkey % 50 as gap, 18 + l_suppkey % 9 as n2 from lineitem)
select l_orderkey, l_extendedprice, seg.k as seg_no, cast(seg.xx as integer) as xx, cast(seg.xy as integer) as xy, seg.p as pos0, seg.c as cigar from (select *, unnest([
  {{'k': 0, 'xx': 1, 'xy': n1, 'p': pos0, 'c': concat(regexp_extract_all(cigar, '\\d+[A-Z=]')[1])}},
  {{'k': 1, 'xx': n1 + 1, 'xy': n1 + n2 + 4, 'p': pos0 + n1 + gap, 'c': concat(regexp_extract_all(cigar, '\\d+[A-Z=]')[3], '2D4S')}}]) as seg from c)"""
)
def q_cigar_segments(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_orderkey", "l_extendedprice", "l_partkey * 10 as pos0", f"{_CIGAR} as cigar", "repeat('A', 200) as seq", "repeat('I', 200) as qual")
    return D.each_segment(D.segments(rows, Options())).select("l_orderkey", "l_extendedprice", "s.seg_no", "s.xx", "s.xy", "s.pos0", "s.cigar")


@query(
    f"""{with_views('reads')}, m as (select *, seg = 1 as one from v_reads where (flag & 4) = 0 and end1 - start1 > 5 and mapq > 3),
two as (select *, count(*) over (partition by sample_id, qname) as n from m where not one)
select m.sample_id, cast(count(distinct m.qname) as bigint) as reads, cast(count(case when one then 1 end) as bigint) as aligned,
  cast((select count(*) from two where two.sample_id = m.sample_id and n = 1) as bigint) as splits, cast((select count(distinct qname) from two where two.sample_id = m.sample_id and n > 1) as bigint) as multsplits
from m group by m.sample_id"""
)
def q_run_stats(spark, d):
    opt = Options(minlen=5, mapq=3)
    rows = D.filter_alignments(_aligned(spark, d), opt)
    return D.run_counts(rows, rows.where("seg = 1"), D.route(rows.where("seg > 1")), opt)


# ---------------------------------------------------------------- frequencies and interactions
_HITS = f"""{with_views('reads', 'feature')}, hits as (select r.*, f.name, f.biotype, f.f_strand, case when r.strand = f.f_strand then 'sense' else 'antisense' end as orientation from v_reads r join v_feature f on {_THETA}),
freq as (select sample_id, orientation, name, sum(w) as freq from (select *, 1.0 / count(*) over (partition by read_id) as w from hits) group by sample_id, orientation, name)"""


def _met(spark, d, by=("sample_id",)):
    return A.Met(view(spark, d, "reads"), view(spark, d, "feature"), ["read_id"], list(by))


@query(f"{_HITS} select sample_id, orientation, name, round(freq, 6) as freq from freq")
def q_feature_freq(spark, d):
    return _met(spark, d).frequency().withColumn("freq", _r("freq"))


@query(f"{_HITS} select sample_id, orientation, name, round(freq / sum(freq) over (partition by sample_id), 6) as freq from freq")
def q_feature_freq_norm(spark, d):
    return A.normalised(_met(spark, d).frequency(), ["sample_id"]).withColumn("freq", _r("freq"))


_UNIQUE = """, g as (select read_id, count(case when orientation = 'sense' then 1 end) as ns, count(case when orientation = 'antisense' then 1 end) as na, max(case when orientation = 'sense' then name end) as s,
  max(case when orientation = 'antisense' then name end) as a from hits group by read_id),
best as (select read_id, case when ns = 1 then 'sense' else 'antisense' end as orientation, case when ns = 1 then s else a end as name from g where ns = 1 or na = 1)"""


@query(f"{_HITS}{_UNIQUE} select read_id, orientation, name from best")
def q_unique_hit(spark, d):
    return _met(spark, d, ()).unique(["name"]).select("read_id", "orientation", "name")


#: Pairs of consecutive reads of a query name that both have a unique hit.
_INTER = (
    _UNIQUE
    + """, b as (select v.*, best.orientation as ori, best.name as partner, row_number() over (partition by v.qname order by v.seg, v.read_id) as k from v_reads v join best on v.read_id = best.read_id),
ints as (select x.sample_id, x.cmpl, x.energy, case when (x.partner, x.ori) <= (y.partner, y.ori) then x.partner else y.partner end as fst_rna, case when (x.partner, x.ori) <= (y.partner, y.ori) then x.ori else y.ori end as fst_rna_ori,
  case when (x.partner, x.ori) <= (y.partner, y.ori) then y.partner else x.partner end as sec_rna, case when (x.partner, x.ori) <= (y.partner, y.ori) then y.ori else x.ori end as sec_rna_ori
  from b x join b y on x.qname = y.qname and y.k = x.k + 1)"""
)
_KEY = "fst_rna, fst_rna_ori, sec_rna, sec_rna_ori"


def _interactions(spark, d, cols=("sample_id", "cmpl", "energy")):
    found = _met(spark, d, ()).with_unique(["name"], ["read_id", "qname", "seg", *cols]).withColumnsRenamed({"orientation": "ori", "name": "partner"})
    b = A.consecutive(found, "qname", ["seg", "read_id"], [*cols, "ori", "partner"], {"ori": "ori2", "partner": "partner2"}).where("partner2 is not null")
    return A.partner_key(b, "partner", "ori", "partner2", "ori2").withColumnsRenamed({"cmpl": "xc", "energy": "xe"})


@query(f"{_HITS}{_INTER} select sample_id, {_KEY}, cast(count(*) as bigint) as supp_reads from ints group by sample_id, {_KEY}")
def q_pair_support(spark, d):
    return A.interaction_scores(_interactions(spark, d), ["sample_id"]).select("sample_id", *A.ORDER, "supp_reads")


@query(
    f"""{_HITS}{_INTER} select sample_id, {_KEY}, cast(count(*) as bigint) as supp_reads, round(nullif(median(cmpl) * max(cmpl), 0), 6) as gcs,
round(case when median(energy) < 0 and min(energy) < 0 then -sqrt(median(energy) * min(energy)) else sqrt(abs(median(energy) * min(energy))) end, 6) as ghs from ints group by sample_id, {_KEY}"""
)
def q_pair_scores(spark, d):
    s = A.interaction_scores(_interactions(spark, d), ["sample_id"])
    return s.withColumns({"gcs": _r("gcs"), "ghs": _r("ghs")})


@query(
    f"""{_HITS}{_INTER} select concat_ws('_', fst_rna, sec_rna, fst_rna_ori, sec_rna_ori) as id, {', '.join(f"cast(count(case when sample_id = 's{k}' then 1 end) as bigint) as c_{k:03d}" for k in range(4))} from ints group by {_KEY}"""
)
def q_pair_pivot_counts(spark, d):
    s = A.interaction_scores(_interactions(spark, d), ["sample_id"])
    return A.count_table(s, [(f"s{k}", "c", k) for k in range(4)])


@query(
    f"""{_HITS}{_INTER}, norm as (select sample_id, orientation, name, freq / sum(freq) over (partition by sample_id) as f from freq), s as (select sample_id, {_KEY}, count(*) as n from ints group by sample_id, {_KEY})
select s.sample_id, {_KEY}, round(coalesce(a.f, 0), 6) as f1, round(coalesce(b.f, 0), 6) as f2 from s left join norm a on a.sample_id = s.sample_id and a.name = fst_rna and a.orientation = fst_rna_ori
left join norm b on b.sample_id = s.sample_id and b.name = sec_rna and b.orientation = sec_rna_ori"""
)
def q_freq_lookup(spark, d):
    s = A.interaction_scores(_interactions(spark, d), ["sample_id"])
    s = A.with_frequencies(s, A.normalised(_met(spark, d).frequency(), ["sample_id"]))
    return s.select("sample_id", *A.ORDER, _r(F.coalesce("f1", F.lit(0.0))).alias("f1"), _r(F.coalesce("f2", F.lit(0.0))).alias("f2"))


@query(
    f"""{_HITS}{_INTER}, norm as (select sample_id, orientation, name, freq / sum(freq) over (partition by sample_id) as f from freq), s as (select sample_id, {_KEY}, count(*) as x from ints group by sample_id, {_KEY}),
n as (select sample_id, count(*) as n from v_reads group by sample_id),
t as (select s.*, n.n, least(1, case when fst_rna = sec_rna and fst_rna_ori = sec_rna_ori then 1 else 2 end * coalesce(a.f * b.f, 0)) as p from s join n on n.sample_id = s.sample_id
  left join norm a on a.sample_id = s.sample_id and a.name = fst_rna and a.orientation = fst_rna_ori left join norm b on b.sample_id = s.sample_id and b.name = sec_rna and b.orientation = sec_rna_ori),
tail as (select *, case when x >= n or p <= 0 then 0.0 when p >= 1 then 1.0 else coalesce(list_sum(list_transform(range(x + 1, n + 1), lambda k:
  exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p)))), 0.0) end as q from t)
select sample_id, {_KEY}, cast(x as bigint) as supp_reads, round(case when x < 5 then 1.0 else greatest(1e-10, q) end, 9) as pval from tail"""
)
def q_binom_pvalue(spark, d):
    ship(spark)
    scores = A.interaction_scores(_interactions(spark, d), ["sample_id"])
    freq = A.normalised(_met(spark, d).frequency(), ["sample_id"])
    reads = view(spark, d, "reads").groupBy("sample_id").agg(F.count("*").alias("n_reads"))
    samples = reads.select("sample_id", F.lit("trtms").alias("grp"), F.lit("c").alias("condition"), F.lit(1).alias("replicate"))
    return A.interaction_stats(scores, freq, reads, samples)[0].select("sample_id", *A.ORDER, "supp_reads", _r("pval", 9).alias("pval"))


@query(
    """with p as (select o_custkey, list_sort(list(1.0 / (2 + o_orderkey % 17))) as ps from orders group by o_custkey),
h as (select o_custkey, len(ps) as n, list_sum(list_transform(range(1, len(ps) + 1), lambda i: -ln(least(1.0, ps[i] * len(ps) / i)))) as h from p)
select o_custkey, round(case when h = 0 then 1.0 else greatest(1e-10, least(1.0, list_sum(list_transform(range(0, n), lambda i: exp(i * ln(h) - lgamma(i + 1) - h))))) end, 6) as padj from h"""
)
def q_padj_fisher(spark, d):
    p = spark.read.parquet(f"{d}/orders.parquet").groupBy("o_custkey").agg(F.collect_list(F.expr("1d / (2 + o_orderkey % 17)")).alias("ps"))
    return p.select("o_custkey", _r(T.combined_pvalue("ps")).alias("padj"))


@query(f"{with_views('reads')} select read_id, round(cmpl, 6) as cmpl, round(energy, 6) as energy from v_reads where cmpl >= 0.03 and energy <= -4")
def q_energy_filter(spark, d):
    return D.passing(view(spark, d, "reads").withColumns({"xc": F.col("cmpl"), "xe": F.col("energy")}), Options(cmplmin=0.03, nrgmax=-4.0)).select("read_id", _r("cmpl").alias("cmpl"), _r("energy").alias("energy"))


# ---------------------------------------------------------------- clusters
@query(
    f"""{with_views('reads')}, r as (select *, max(end1) over (partition by chrom, strand order by start1, end1, read_id rows between unbounded preceding and 1 preceding) as reach from v_reads),
n as (select *, case when reach is null or start1 > reach then start1 end as new from r)
select read_id, chrom, strand, max(new) over (partition by chrom, strand order by start1, end1, read_id rows unbounded preceding) as island from n"""
)
def q_islands_1d(spark, d):
    return islands(view(spark, d, "reads"), ["chrom", "strand"], "start1", "end1").select("read_id", "chrom", "strand", "island")


def _boxes(spark, d):
    """Consecutive reads of a query name on one chromosome as boxes, coarsened so that some overlap."""
    order = Window.partitionBy("qname", "chrom").orderBy("seg", "read_id")
    nxt = {"start2": F.lead("start1").over(order), "end2": F.lead("end1").over(order), "strand2": F.lead("strand").over(order)}
    b = view(spark, d, "reads").withColumns(nxt).where("start2 is not null")
    wide = lambda s, e: (F.expr(f"{s} div 2000 * 2000"), F.expr(f"{e} div 2000 * 2000 + 1500"))
    (s1, e1), (s2, e2) = wide("start1", "end1"), wide("start2", "end2")
    return b.select(F.col("chrom").alias("chr1"), F.col("strand").alias("strand1"), s1.alias("start1"), e1.alias("end1"), F.col("chrom").alias("chr2"), "strand2", s2.alias("start2"), e2.alias("end2"))


@query()
def q_cluster_2d(spark, d):
    ship(spark)
    return cluster_boxes(_boxes(spark, d), 0)


_CLUSTERS = """, cl as (select concat('cluster', cast(min(o_orderkey) as varchar(20))) as clust_id, concat('chr', cast(k % 5 as varchar(4))) as chrom, case when k % 3 = 0 then '+' else '-' end as strand, k * 500 as start1, k * 500 + 300 as end1,
  cast(count(*) as bigint) as no_splits from (select o_orderkey, (o_custkey * 7) % 4000 as k from orders) group by k)"""


def _cluster_rows(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey", "(o_custkey * 7) % 4000 as k")
    g = o.groupBy("k").agg(F.min("o_orderkey").alias("o"), F.count("*").alias("no_splits"))
    return g.selectExpr("concat('cluster', o) as clust_id", "concat('chr', k % 5) as chrom", "case when k % 3 = 0 then '+' else '-' end as strand", "k * 500 as start1", "k * 500 + 300 as end1", "no_splits")


@query(f"{with_views('feature')}{_CLUSTERS} select r.clust_id, f.name, r.no_splits from cl r join v_feature f on {_THETA} where r.no_splits >= 2 and r.strand = f.f_strand")
def q_cluster_feature_join(spark, d):
    met = interval_join(_cluster_rows(spark, d).where("no_splits >= 2"), view(spark, d, "feature"), *_SPANS)
    return met.where("strand = f_strand").select("clust_id", "name", "no_splits")


@query(
    f"""{with_views('feature')}{_CLUSTERS}, met as (select f.feature_no, r.* from cl r join v_feature f on {_THETA} where r.no_splits >= 2 and r.strand = f.f_strand),
w as (select f.feature_no, min(m.start1) as lo, max(m.end1) as hi, string_agg(distinct case when m.start1 < f.f_start then m.clust_id end, '/' order by case when m.start1 < f.f_start then m.clust_id end) as pre,
  string_agg(distinct case when m.end1 > f.f_end then m.clust_id end, '/' order by case when m.end1 > f.f_end then m.clust_id end) as post from met m join v_feature f on f.feature_no = m.feature_no group by f.feature_no)
select concat_ws('/', w.pre, f.name, w.post) as name, f.chrom, least(f.f_start, coalesce(w.lo, f.f_start)) as f_start, greatest(f.f_end, coalesce(w.hi, f.f_end)) as f_end, f.biotype from v_feature f left join w on w.feature_no = f.feature_no
union all select clust_id, chrom, start1, end1, 'cluster' from cl where no_splits >= 2 and clust_id not in (select clust_id from met)"""
)
def q_cluster_annotate(spark, d):
    c = _cluster_rows(spark, d)
    # both segments at one place: each new feature then stands once
    rows = c.select("clust_id", F.col("chrom").alias("chr1"), F.col("strand").alias("strand1"), "start1", "end1", F.col("chrom").alias("chr2"), F.col("strand").alias("strand2"), F.col("start1").alias("start2"), F.col("end1").alias("end2"), "no_splits")
    out = A.annotate_with_clusters(view(spark, d, "feature").withColumn("product", F.lit("")), rows)
    return out.select("name", "chrom", "f_start", "f_end", "biotype").distinct()


@query(f"{with_views('reads', 'feature')} select chrom, start1, end1 from v_reads union select chrom, f_start, f_end from v_feature")
def q_union_intervals(spark, d):
    f = view(spark, d, "feature").select("chrom", F.col("f_start").alias("start1"), F.col("f_end").alias("end1"))
    return distinct_spans(view(spark, d, "reads").select("chrom", "start1", "end1"), f)


# ---------------------------------------------------------------- graph
@query(f"{_HITS}{_INTER} select fst_rna as label, fst_rna_ori as orientation from ints union select sec_rna, sec_rna_ori from ints")
def q_graph_nodes(spark, d):
    return A.graph(_interactions(spark, d, ()))[0].select("label", "orientation")


@query(f"{_HITS}{_INTER} select distinct concat(fst_rna, ':', fst_rna_ori) as source, concat(sec_rna, ':', sec_rna_ori) as target, 'basepairing' as relation from ints")
def q_graph_edges(spark, d):
    name = lambda p: F.concat(f"{p}_rna", F.lit(":"), f"{p}_rna_ori")
    return A.graph(_interactions(spark, d, ()))[1].select(name("fst").alias("source"), name("sec").alias("target"), "relation")
