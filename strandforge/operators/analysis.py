"""Annotation of reads, interaction tables, statistics and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import statistics as T
from ..staging import SHORT_ROWS, SHUFFLED_ONCE, staged
from . import intervals
from .following import followed, packed
from .intervals import Held, Sweep, interval_join
from .repeats import hash_of, repeated

ORDER = ["fst_rna", "fst_rna_ori", "sec_rna", "sec_rna_ori"]


def hits(reads: DataFrame, features: DataFrame, key: list[str]) -> DataFrame:
    """Overlaps of reads (key, chrom, strand, start1, end1) with features (chrom, f_start, f_end, f_strand, name, ...), with orientation."""
    found = interval_join(reads, features, ["chrom"], ("start1", "end1"), ("f_start", "f_end"))
    return found.withColumn("orientation", F.when(F.col("strand") == F.col("f_strand"), "sense").otherwise("antisense"))


def feature_frequency(found: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """Each read gives 1/n to each of the n features it meets; sums by (by, orientation, name)."""
    share = 1.0 / F.count("*").over(Window.partitionBy(*by, *key))
    return found.withColumn("w", share).groupBy(*by, "orientation", "name").agg(F.sum("w").alias("freq"))


def normalised(freq: DataFrame, by: list[str]) -> DataFrame:
    """Frequencies that sum to 1 over `by`."""
    if not by:
        return normalised(freq.withColumn("_all", F.lit(0)), ["_all"]).drop("_all")
    freq = staged(freq, SHUFFLED_ONCE)
    # written too, so that its size is known and the frequencies are not dealt by a few values of `by` for the join
    total = staged(freq.groupBy(*by).agg(F.sum("freq").alias("t")), SHUFFLED_ONCE)
    return freq.join(total, by).withColumn("freq", F.col("freq") / F.nullif("t", F.lit(0.0))).drop("t")


def unique_hits(found: DataFrame, key: list[str], keep: list[str]) -> DataFrame:
    """Of each segment the only sense hit, else the only antisense hit; segments without such a hit go."""
    row = F.struct(*keep)
    n = lambda o: F.count_if(F.col("orientation") == o)
    one = lambda o: F.max(F.when(F.col("orientation") == o, row))
    g = found.groupBy(*key).agg(n("sense").alias("ns"), n("antisense").alias("na"), one("sense").alias("s"), one("antisense").alias("a"))
    g = g.withColumn("orientation", F.when(F.col("ns") == 1, "sense").when(F.col("na") == 1, "antisense")).where("orientation is not null")
    return g.withColumn("h", F.when(F.col("orientation") == "sense", F.col("s")).otherwise(F.col("a"))).select(*key, "orientation", "h.*")


class Met:
    """feature_frequency() and unique_hits() of the hits of reads and features, for which no row a hit is made.

    Hits are counted for each read. Where every task can hold all features (Held), reads whose (by, key) stands in several rows
    are counted alike and their counts added up; else (Sweep) these, and reads that are too wide for that, are joined
    with the features.
    """

    def __init__(self, reads: DataFrame, features: DataFrame, key: list[str], by: list[str], keep: tuple[str, ...] = ("name",)):
        self.features, self.key, self.by = features, key, by
        self.reads = reads
        args = (["chrom"], ("start1", "end1"), ("f_start", "f_end"), ("strand", "f_strand"))
        self.held = features.limit(intervals.HOLD + 1).count() <= intervals.HOLD
        own = reads if self.held else reads.select(*dict.fromkeys([*by, *key, "chrom", "strand", "start1", "end1"]))
        again = staged(repeated(reads, [*by, *key]), SHORT_ROWS | SHUFFLED_ONCE)
        self.sweep = Held(own, features, *args, list(keep)) if self.held else Sweep(own, features, *args)
        self.once, self.rest = self.sweep.narrow, self.sweep.rest
        if not again.isEmpty():
            part = lambda df, how: df.withColumn("_k", hash_of([*by, *key])).join(again, "_k", how).drop("_k")
            many = part(self.once, "left_semi")
            self.once, self.rest = part(self.once, "left_anti"), many if self.rest is None else self.rest.unionByName(many)

    def frequency(self) -> DataFrame:
        named = lambda found: found.select(*self.by, F.when(F.col("same"), "sense").otherwise("antisense").alias("orientation"), "name", F.col("share").alias("freq"))
        if self.held:
            parts = [(self.once, None)]
            if self.rest is not None:
                cols = list(dict.fromkeys([*self.by, *self.key, "chrom", "strand", "start1", "end1"]))
                each = self.sweep.counts(self.rest, cols, []).withColumn("_n", F.sum(F.expr("n_same + n_other")).over(Window.partitionBy(*self.by, *self.key)))
                parts.append((each, "_n"))
            return named(self.sweep.sums(parts, self.by, ["name"]))
        found = named(self.sweep.shares(self.once, self.by, ["name"]))
        if self.rest is not None:
            found = found.unionByName(feature_frequency(hits(self.rest, self.features, self.key), self.key, self.by))
        return found.groupBy(*self.by, "orientation", "name").agg(F.sum("freq").alias("freq"))

    def _one(self, counted: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
        found = counted.withColumn("orientation", F.expr("case when n_same = 1 then 'sense' when n_other = 1 then 'antisense' end")).where("orientation is not null")
        return found.select(*cols, "orientation", *(F.expr(f"if(n_same = 1, same_{c}, other_{c})").alias(c) for c in keep))

    def _many(self, keep: list[str]) -> DataFrame:
        """unique() of the rest."""
        if not self.held:
            return unique_hits(hits(self.rest, self.features, self.key), self.key, keep)
        # where the counts of a key sum up to 1, one row alone has the hit
        row = lambda o: F.max(F.when(F.col(f"n_{o}") == 1, F.struct(*(F.col(f"{o}_{c}").alias(c) for c in keep)))).alias(o)
        sums = self.sweep.counts(self.rest, self.key, keep).groupBy(*self.key).agg(F.sum("n_same").alias("_ns"), F.sum("n_other").alias("_no"), row("same"), row("other"))
        sums = sums.select(*self.key, F.col("_ns").alias("n_same"), F.col("_no").alias("n_other"), *(F.col(f"{o}.{c}").alias(f"{o}_{c}") for c in keep for o in ("same", "other")))
        return self._one(sums, self.key, keep)

    def unique(self, keep: list[str]) -> DataFrame:
        """By key, which must not stand under several `by`; keep: columns of the features, as given."""
        counted = staged(self.sweep.counts(self.once, self.key, keep, only=True), SHORT_ROWS) if self.held else self.sweep.counts(self.once, keep)
        found = self._one(counted, self.key, keep)
        return found if self.rest is None else found.unionByName(self._many(keep))

    def with_unique(self, keep: list[str], cols: list[str]) -> DataFrame:
        """cols (the key among them) of all rows whose key has a unique hit, and what that is."""
        if not self.held:
            # written first, so that its size is known before the reads are dealt for the join
            return self.reads.select(*cols).join(staged(self.unique(keep)), self.key)
        found = self._one(self.sweep.counts(self.once, cols, keep, only=True), cols, keep).where(" and ".join(f"{k} is not null" for k in self.key))
        if self.rest is None:
            return found
        again = self.reads.select(*cols).join(staged(self._many(keep)), self.key)
        return found.unionByName(again)


def consecutive(found: DataFrame, group: str, order: list[str], keep: list[str], after: dict[str, str]) -> DataFrame:
    """Pairs of rows that follow each other in their group: keep of the first, and columns of the second under new names."""
    found = found.select(*dict.fromkeys([group, *order, *keep, *after]))
    return followed(staged(packed(found, group), SHORT_ROWS | SHUFFLED_ONCE), found, group, order, keep, after)


def partner_key(df: DataFrame, name1: str, ori1: str, name2: str, ori2: str) -> DataFrame:
    """Adds fst_rna, fst_rna_ori, sec_rna, sec_rna_ori: both partners in order."""
    a, b = F.struct(F.col(name1).alias("n"), F.col(ori1).alias("o")), F.struct(F.col(name2).alias("n"), F.col(ori2).alias("o"))
    lo, hi = F.least(a, b), F.greatest(a, b)
    return df.withColumns({"fst_rna": lo["n"], "fst_rna_ori": lo["o"], "sec_rna": hi["n"], "sec_rna_ori": hi["o"]})


def interaction_scores(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Support, global complementarity and hybridisation scores by (by, ordered partners); one shuffle."""
    return pairs.groupBy(*by, *ORDER).agg(F.count("*").alias("supp_reads"), T.global_complementarity("xc").alias("gcs"), T.global_hybridisation("xe").alias("ghs"))


def with_frequencies(scores: DataFrame, freq: DataFrame) -> DataFrame:
    """Adds f1 and f2, the sample's frequencies of both partners; null where a partner has none."""
    side = lambda p, c: freq.select("sample_id", F.col("name").alias(p), F.col("orientation").alias(f"{p}_ori"), F.col("freq").alias(c))
    return scores.join(side("fst_rna", "f1"), ["sample_id", "fst_rna", "fst_rna_ori"], "left").join(side("sec_rna", "f2"), ["sample_id", "sec_rna", "sec_rna_ori"], "left")


def interaction_stats(scores: DataFrame, freq: DataFrame, reads: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per replicate with pval, per condition with padj).

    scores: by sample_id; freq: (sample_id, orientation, name, freq); reads: (sample_id, n_reads); samples: (sample_id,
    grp, condition, replicate). A replicate without the interaction enters the adjustment with p = 1.
    """
    s = with_frequencies(scores, freq).join(reads, "sample_id", "left")
    same = (F.col("fst_rna") == F.col("sec_rna")) & (F.col("fst_rna_ori") == F.col("sec_rna_ori"))
    s = s.withColumn("n_reads", F.coalesce("n_reads", F.lit(0))).withColumn("pval", T.interaction_pvalue("supp_reads", "n_reads", "f1", "f2", same))
    s = s.join(samples, "sample_id").select("sample_id", "grp", "condition", "replicate", *ORDER, "supp_reads", "gcs", "ghs", "pval")
    size = samples.groupBy("grp", "condition").agg(F.count("*").cast("int").alias("k"))
    adj = s.groupBy("grp", "condition", *ORDER).agg(F.collect_list("pval").alias("ps")).join(size, ["grp", "condition"])
    adj = adj.withColumn("ps", F.expr("concat(ps, array_repeat(1d, k - size(ps)))"))
    return s, adj.select("grp", "condition", *ORDER, T.combined_pvalue("ps").alias("padj"))


def wide_report(stats: DataFrame, adjusted: DataFrame, samples: list[tuple[str, str, int]]) -> DataFrame:
    """The interaction table with a block of columns for each (sample_id, condition, replicate) in order, padj after a condition's last."""
    ids = [s[0] for s in samples]
    cells = stats.groupBy(*ORDER).pivot("sample_id", ids).agg(F.first("supp_reads").alias("supp_reads"), F.first("gcs").alias("gcs"), F.first("ghs").alias("ghs"), F.first("pval").alias("pval"))
    conditions = list(dict.fromkeys(s[1] for s in samples))
    padj = adjusted.groupBy(*ORDER).pivot("condition", conditions).agg(F.first("padj"))
    padj = padj.select(*ORDER, *(F.col(f"`{c}`").alias(f"_padj_{i}") for i, c in enumerate(conditions)))
    both = cells.join(padj, ORDER, "left")
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    cols = [F.col(c) for c in ("fst_rna", "sec_rna", "fst_rna_ori", "sec_rna_ori")]
    last = {s[1]: s[0] for s in samples}
    for sid, cond, rep in samples:
        name = f"{cond}_{rep:03d}"
        cols.append(F.coalesce(F.col(f"`{sid}_supp_reads`"), F.lit(0)).alias(f"{name}_supp_reads"))
        cols += [dot(f"`{sid}_{m}`").alias(f"{name}_{m}") for m in ("gcs", "ghs", "pval")]
        if last[cond] == sid:
            cols.append(dot(f"_padj_{conditions.index(cond)}").alias(f"{name}_padj"))
    return both.select(*cols)


def count_table(stats: DataFrame, samples: list[tuple[str, str, int]]) -> DataFrame:
    """id and one support column per sample."""
    key = F.concat_ws("_", "fst_rna", "sec_rna", "fst_rna_ori", "sec_rna_ori")
    t = stats.groupBy(key.alias("id")).pivot("sample_id", [s[0] for s in samples]).agg(F.sum("supp_reads"))
    return t.select("id", *(F.coalesce(F.col(f"`{sid}`"), F.lit(0)).alias(f"{cond}_{rep:03d}") for sid, cond, rep in samples))


def graph(interactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, label, orientation), one for each partner and orientation, and edges (source, target, relation, and the partners)."""
    interactions = staged(interactions.select(*ORDER).distinct(), SHUFFLED_ONCE)
    ends = interactions.select(F.col("fst_rna").alias("label"), F.col("fst_rna_ori").alias("orientation")).union(interactions.select("sec_rna", "sec_rna_ori")).distinct()
    # hashes of the content as ids: no global numbering is needed
    node = lambda a, b: F.hex(F.xxhash64(a, b))
    nodes = ends.select(node("label", "orientation").alias("id"), "label", "orientation")
    edges = interactions.select(node("fst_rna", "fst_rna_ori").alias("source"), node("sec_rna", "sec_rna_ori").alias("target"), F.lit("basepairing").alias("relation"), *ORDER)
    return nodes, edges


def annotate_with_clusters(features: DataFrame, clusters: DataFrame, least: int = 2) -> DataFrame:
    """Features widened and renamed by the clusters they meet on their strand, and clusters that meet none as features.

    A cluster that reaches over a feature's start puts its id before the name, over its end behind the name
    (ids in order, joined by "/"). features: (feature_no, chrom, f_start, f_end, f_strand, name, biotype, product).
    """
    seg = lambda k: clusters.where(f"no_splits >= {least}").select(F.concat("clust_id", F.lit(f"_{k}")).alias("seg_id"), "clust_id", F.col(f"chr{k}").alias("chrom"), F.col(f"strand{k}").alias("strand"), F.col(f"start{k}").alias("start1"), F.col(f"end{k}").alias("end1"))
    segs = seg(1).unionByName(seg(2))
    met = interval_join(segs, features, ["chrom"], ("start1", "end1"), ("f_start", "f_end")).where("strand = f_strand")
    met = staged(met.select("seg_id", "clust_id", "start1", "end1", "feature_no", "f_start", "f_end"))
    ids = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("clust_id"))))
    wider = met.groupBy("feature_no").agg(F.min("start1").alias("lo"), F.max("end1").alias("hi"), ids(F.expr("start1 < f_start")).alias("pre"), ids(F.expr("end1 > f_end")).alias("post"))
    out = features.join(wider, "feature_no", "left")
    out = out.withColumn("name", F.array_join(F.concat(F.coalesce("pre", F.array()), F.array("name"), F.coalesce("post", F.array())), "/"))
    out = out.withColumns({"f_start": F.least("f_start", "lo"), "f_end": F.greatest("f_end", "hi")}).drop("lo", "hi", "pre", "post")
    alone = segs.join(met.select("seg_id").distinct(), "seg_id", "left_anti")
    new = alone.select(F.lit(None).cast("long").alias("feature_no"), "chrom", F.col("start1").alias("f_start"), F.col("end1").alias("f_end"), F.col("strand").alias("f_strand"), F.col("clust_id").alias("name"), F.lit("cluster").alias("biotype"), F.lit(".").alias("product"))
    return out.select(*new.columns).unionByName(new)


def last_flags(samples: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds is_last: 1 on the last row of each condition."""
    return samples.withColumn("is_last", (F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order))) == 1).cast("int"))
