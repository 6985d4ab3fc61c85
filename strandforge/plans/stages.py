"""The five subcalls over files: preproc, (align), detect, clustering, analysis."""

from __future__ import annotations

import json
import os
import shlex

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Options
from ..functions import energy as E
from ..operators import analysis as A
from ..operators import detect as D
from ..operators.intervals import cluster_boxes, numbered_clusters
from ..operators.preproc import preprocess_paired, preprocess_single
from ..sources import readers, samples, writers


def align_commands(opt: Options, found: list[samples.Sample]) -> list[str]:
    """Command lines for an external split-read aligner; running it is outside this engine."""
    q = shlex.quote
    index = os.path.join(opt.outdir, "align", os.path.basename(opt.dbref) + ".idx")
    out = [f"segemehl.x -x {q(index)} -d {q(opt.dbref)}"]
    for s in found:
        for role, path in s.files.items():
            target = os.path.join(opt.outdir, "align", s.group, s.condition, samples.add_suffix(os.path.basename(path), "_matched").rpartition(".")[0] + ".bam")
            out.append(f"segemehl.x -S -b -A {opt.accuracy} -U {opt.minfragsco} -W {opt.minsplicecov} -Z {opt.minfraglen} -t {opt.threads} -m {opt.minlen} -i {q(index)} -d {q(opt.dbref)} -q {q(path)} -o {q(target)}")
    return out


def _adapters(spark: SparkSession, path: str, most: int = 1000) -> list[str]:
    """Sequences of a FASTA file in the order of their names; each becomes part of the plan, so more than `most` are an error."""
    if not path:
        return []
    rows = spark.read.format("fasta").load(path).select("id", "seq").distinct().orderBy("id", "seq").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} adapters in {path}")
    return [r.seq for r in rows]


def _files(found: list[samples.Sample], roles: tuple[str, ...]) -> list[tuple[samples.Sample, str, str]]:
    return [(s, role, s.files[role]) for s in found for role in roles if role in s.files]


#: Larger uncompressed FASTQ and SAM files are read in ranges of so many bytes.
SPLIT_BYTES = 128 << 20


def _load(spark: SparkSession, kind: str, files: list[tuple[samples.Sample, str, str]]) -> DataFrame:
    """Rows of all files with sample_id, grp, condition and role."""
    parts = []
    for s, role, path in files:
        fmt = kind or ("bam" if path.endswith(".bam") else "sam")
        df = readers.load_numbered(spark, fmt, path, SPLIT_BYTES)
        parts.append(df.withColumns({"sample_id": F.lit(_sample_id(s)), "grp": F.lit(s.group), "condition": F.lit(s.condition), "role": F.lit(role)}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_preproc(spark: SparkSession, opt: Options) -> str:
    readers.register_formats(spark)
    found = samples.discover("preproc", opt.readtype, opt.trtms, opt.ctrls)
    a5, a3 = _adapters(spark, opt.adpt5), _adapters(spark, opt.adpt3)
    fwd = _load(spark, "fastq", _files(found, ("forward",)))
    if opt.readtype == "SE":
        reads = preprocess_single(fwd, a5, a3, opt).withColumn("route", F.lit("forward"))
    else:
        reads = preprocess_paired(fwd, _load(spark, "fastq", _files(found, ("reverse",))), a5, a3, opt)
    target = os.path.join(opt.outdir, "preproc", "reads")
    writers.write_fastq(reads, target, ["sample_id", "route"], opt.named)
    for s in found if opt.named else ():
        for role, name in samples.outputs("preproc", opt.readtype, s, opt.outdir).items():
            route = "merged" if role == "forward" and opt.readtype == "PE" else role
            writers.one_file(spark, writers.partition_folder(spark, target, sample_id=_sample_id(s), route=route), name)
    _write_catalogue(spark, opt, "preproc", found)
    return target


def _sample_id(s: samples.Sample) -> str:
    return f"{s.group}/{s.condition}/{s.stem}"


def _write_catalogue(spark: SparkSession, opt: Options, subcall: str, found: list[samples.Sample]) -> None:
    writers.write_text(spark, os.path.join(opt.outdir, "data.json"), samples.catalogue_json(subcall, opt.readtype, found, opt.outdir))


def _energies(opt: Options) -> E.EnergyProvider:
    if opt.energy in ("existing", "model"):
        return {"existing": E.existing_energy, "model": E.nearest_neighbour}[opt.energy]
    return E.external_program(shlex.split(opt.energy))


def run_detect(spark: SparkSession, opt: Options) -> str:
    readers.register_formats(spark)
    found = samples.discover("detect", opt.readtype, opt.trtms, opt.ctrls)
    rows = _load(spark, "", _files(found, ("matched",)))
    junctions = readers.read_gff3(spark, opt.features)[1] if opt.splicing and opt.features else None
    singles, splits = D.detect(rows, opt, junctions, _energies(opt))
    top = os.path.join(opt.outdir, "detect")
    splits.write.mode("overwrite").partitionBy("sample_id", "route").parquet(f"{top}/splits")
    singles.write.mode("overwrite").partitionBy("sample_id").parquet(f"{top}/single")
    done = spark.read.parquet(f"{top}/splits")
    writers.sam_lines(done).write.mode("overwrite").partitionBy("sample_id", "route").text(f"{top}/sam")
    counts = D.run_counts(rows, spark.read.parquet(f"{top}/single"), done, opt)
    counts.write.mode("overwrite").parquet(f"{top}/counts")
    if opt.stats:
        names = F.split("sample_id", "/")
        table = counts.withColumns({"condition": F.concat_ws("/", names[0], names[1]), "sample_no": F.col("sample_id")})
        writers.write_table(writers.stats_table(table), f"{top}/stats")
    if opt.named:
        _named_alignments(spark, opt, found, top)
    _write_catalogue(spark, opt, "detect", found)
    return top


def _named_alignments(spark: SparkSession, opt: Options, found: list[samples.Sample], top: str) -> None:
    """SAM files with headers, named after each sample; references are those of the sample's own input."""
    writers.single_lines(spark.read.parquet(f"{top}/single")).write.mode("overwrite").partitionBy("sample_id").text(f"{top}/sam_single")
    for s in found:
        refs = spark.read.format("references").load(s.files["matched"]).orderBy("ref_no").select("name", "length")
        head = writers.sam_head([tuple(r) for r in refs.collect()])  # as many as the genome has sequences
        for kind, name in samples.outputs("detect", opt.readtype, s, opt.outdir).items():
            values = {"sample_id": _sample_id(s)} | ({} if kind == "single" else {"route": kind})
            folder = writers.partition_folder(spark, f"{top}/sam_single" if kind == "single" else f"{top}/sam", **values)
            writers.one_file(spark, folder, name.rpartition(".")[0] + ".sam", head)


def split_boxes(splits: DataFrame) -> DataFrame:
    """(chr1, strand1, start1, end1, chr2, ...) of split pairs, inclusive and from 0."""
    strand = D.strand_of()
    end = lambda k: (F.col(f"s{k}.pos0") + F.length(f"s{k}.seq") - 1).alias(f"end{k}")
    return splits.select(F.col("rname").alias("chr1"), strand.alias("strand1"), F.col("s1.pos0").alias("start1"), end(1), F.col("rname").alias("chr2"), strand.alias("strand2"), F.col("s2.pos0").alias("start2"), end(2))


def run_clustering(spark: SparkSession, opt: Options) -> str:
    top = os.path.join(opt.outdir, "clustering")
    splits = spark.read.parquet(os.path.join(opt.outdir, "detect", "splits")).where("route = 'splits'")
    clusters = numbered_clusters(cluster_boxes(split_boxes(splits), opt.clustdist, opt.linkage))
    writers.write_table(writers.cluster_table(clusters), f"{top}/clusters")
    return f"{top}/clusters"


def interactions(singles: DataFrame, splits: DataFrame, features: DataFrame, wider: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(annotated pairs, normalised frequencies, reads) by sample; true 1-based read intervals, or `wider` on the left."""
    f = features.select("chrom", "f_start", "f_end", "f_strand", "name", "biotype", "product").withColumn("feature", F.xxhash64("chrom", "f_start", "f_end", "f_strand", "name"))
    one = singles.select("sample_id", F.concat_ws("#", "qname", F.col("rec_no").cast("string")).alias("read"), F.lit(0).alias("seg"), F.col("rname").alias("chrom"), D.strand_of().alias("strand"), (F.col("pos0") + 1 - wider).alias("start1"), (F.col("pos0") + F.length("seq")).alias("end1"))
    pair = F.concat_ws("#", "qname", F.col("rec_no").cast("string"), F.col("pair_no").cast("string"))
    seg = lambda k: splits.select("sample_id", pair.alias("read"), F.lit(k).alias("seg"), F.col("rname").alias("chrom"), D.strand_of().alias("strand"), (F.col(f"s{k}.pos0") + 1 - wider).alias("start1"), (F.col(f"s{k}.pos0") + F.length(f"s{k}.seq")).alias("end1"))
    reads = one.unionByName(seg(1)).unionByName(seg(2))
    found = A.hits(reads, f, ["sample_id", "read", "seg"])
    freq = A.normalised(A.feature_frequency(found, ["read", "seg"], ["sample_id"]), ["sample_id"])
    best = A.unique_hits(found.where("seg > 0"), ["sample_id", "read", "seg"], ["name", "biotype", "product", "f_strand", "chrom", "strand", "start1", "end1"])
    side = lambda k: best.where(f"seg = {k}").select("sample_id", "read", *(F.col(c).alias(f"{c}_{k}") for c in ("orientation", "name", "biotype", "product", "f_strand", "chrom", "strand", "start1", "end1")))
    scores = splits.select("sample_id", pair.alias("read"), "qname", F.col("xc").cast("double").alias("xc"), F.col("xe").cast("double").alias("xe"), "xd", "xa1", "xa2")
    both = side(1).join(side(2), ["sample_id", "read"]).join(scores, ["sample_id", "read"])
    total = singles.select("sample_id").unionAll(splits.select("sample_id")).groupBy("sample_id").agg(F.count("*").alias("n_reads"))
    return A.partner_key(both, "name_1", "orientation_1", "name_2", "orientation_2"), freq, total


def interaction_rows(pairs: DataFrame) -> DataFrame:
    """The 24 columns of the per-sample interaction files."""
    side = lambda k: ["strand_{0}", "start1_{0}", "end1_{0}", "chrom_{0}", "name_{0}", "biotype_{0}", "f_strand_{0}", "product_{0}", "orientation_{0}"]
    cols = ["qname", *(c.format(1) for c in side(1)), *(c.format(2) for c in side(2)), "xc", "xa1", "xa2", "xe", "xd"]
    return pairs.select("sample_id", *(F.col(c).alias(h) for c, h in zip(cols, writers.INTERACTIONS)))


def run_analysis(spark: SparkSession, opt: Options) -> str:
    top, base = os.path.join(opt.outdir, "analysis"), os.path.join(opt.outdir, "detect")
    features, _ = readers.read_gff3(spark, opt.features)
    if opt.clust:
        t = readers.read_clusters(spark, os.path.join(opt.outdir, "clustering", "clusters"))
        # cluster tables count from 0, annotation from 1
        features = A.annotate_with_clusters(features, t.withColumns({c: F.col(c) + 1 for c in ("start1", "end1", "start2", "end2")}))
    singles, splits = spark.read.parquet(f"{base}/single"), spark.read.parquet(f"{base}/splits").where("route = 'splits'")
    pairs, freq, total = interactions(singles, splits, features, int(opt.compat_coords))
    pairs.write.mode("overwrite").partitionBy("sample_id").parquet(f"{top}/pairs")
    pairs = spark.read.parquet(f"{top}/pairs")
    writers.write_table(interaction_rows(pairs), f"{top}/interactions", ["sample_id"])
    ids = sorted((r.sample_id for r in total.select("sample_id").distinct().collect()), key=str.lower)
    listed, seen = [], {}
    for i in ids:
        cond = "/".join(i.split("/")[:2])
        seen[cond] = seen.get(cond, 0) + 1
        listed.append((i, cond, seen[cond]))
    names = [(i, c.partition("/")[2] if len({x.partition("/")[2] for x in seen}) == len(seen) else c.replace("/", "_"), n) for i, c, n in listed]
    table = spark.createDataFrame([(i, i.split("/")[0], c, n) for i, c, n in names], "sample_id string, grp string, condition string, replicate int")
    stats, adjusted = A.interaction_stats(A.interaction_scores(pairs, ["sample_id"]), freq, total, table)
    stats.write.mode("overwrite").parquet(f"{top}/stats_long")
    adjusted.write.mode("overwrite").parquet(f"{top}/padj_long")
    stats, adjusted = spark.read.parquet(f"{top}/stats_long"), spark.read.parquet(f"{top}/padj_long")
    writers.write_table(A.wide_report(stats, adjusted, names).orderBy("fst_rna", "fst_rna_ori", "sec_rna", "sec_rna_ori"), f"{top}/allints")
    if opt.outcnt:
        writers.write_table(A.count_table(stats, names).orderBy("id"), f"{top}/counts")
    if opt.outjgf:
        nodes, edges = A.graph(stats)
        if opt.named:
            writers.write_text(spark, f"{top}/graph.json", json.dumps(writers.graph_document(nodes, edges), indent=4))
        writers.graph_lines(nodes, edges).write.mode("overwrite").partitionBy("kind").text(f"{top}/graph")
    if opt.stats:
        found = stats.groupBy("sample_id").agg(F.count("*").alias("interactions"))
        counts = spark.read.parquet(f"{base}/counts").join(found, "sample_id", "left").join(table.select("sample_id", F.col("condition")), "sample_id")
        writers.write_table(writers.stats_table(counts.na.fill(0).withColumn("sample_no", F.col("sample_id"))), f"{top}/stats")
    return top


def run(spark: SparkSession, subcall: str, opt: Options) -> list[str]:
    """Runs a subcall; complete runs all but the external aligner, whose output trtms and ctrls then hold."""
    opt.check(subcall)
    steps = {"preproc": run_preproc, "detect": run_detect, "clustering": run_clustering, "analysis": run_analysis}
    if subcall == "align":
        return align_commands(opt, samples.discover("align", opt.readtype, opt.trtms, opt.ctrls))
    if subcall == "complete":
        names = (["preproc"] if opt.preproc else []) + ["detect"] + (["clustering"] if opt.clust else []) + ["analysis"]
        return [steps[n](spark, opt) for n in names]
    return [steps[subcall](spark, opt)]
