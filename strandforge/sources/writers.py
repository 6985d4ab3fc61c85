"""Sinks: FASTQ, SAM, report tables and the interaction graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INTERACTIONS = (
    "qname fst_seg_strd fst_seg_strt fst_seg_end fst_seg_ref fst_seg_name first_seg_bt fst_seg_anno_strd fst_seg_prod fst_seg_ori "
    "sec_seg_strd sec_seg_strt sec_seg_end sec_seg_ref sec_seg_name sec_seg_bt sec_seg_anno_strd sec_seg_prod sec_seg_ori "
    "cmpl fst_seg_compl_aln sec_seg_cmpl_aln mfe mfe_struc"
).split()
CLUSTER_HEADER = "clustID fst_seg_chr fst_seg_strd fst_seg_strt fst_seg_end sec_seg_chr sec_seg_strd sec_seg_strt sec_seg_end no_splits fst_seg_len sec_seg_len".split()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file of any store that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def one_file(spark: SparkSession, folder: str, target: str, head: str = "") -> None:
    """Copies what tasks wrote to a folder into one file, after a head, stream by stream; an empty file if there is none."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    top, to = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(target)
    fs = to.getFileSystem(conf)
    out = fs.create(to, True)
    if head:
        out.write(bytearray(head.encode()))
    if fs.exists(top):
        for name in sorted(str(s.getPath()) for s in fs.listStatus(top) if s.getPath().getName().startswith("part-")):
            part = fs.open(jvm.org.apache.hadoop.fs.Path(name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            part.close()
    out.close()


def partition_folder(spark: SparkSession, top: str, **values: str) -> str:
    """Where a partitioned table keeps the rows of these values."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([top, *(f"{k}={name(v)}" for k, v in values.items())])


def sam_head(references: list[tuple[str, int]]) -> str:
    return "@HD\tVN:1.6\tSO:unknown\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in references) + "@PG\tID:strandforge\tPN:strandforge\n"


def fastq_lines(reads: DataFrame) -> DataFrame:
    return reads.withColumn("value", F.concat_ws("\n", F.concat(F.lit("@"), "id"), "seq", F.lit("+"), "qual"))


def write_fastq(reads: DataFrame, path: str, by: list[str], in_order: bool = False) -> None:
    """One directory per sample (and route), each with as many files as tasks wrote; in_order: part after part in the order of reads."""
    if in_order:
        reads = reads.repartitionByRange(*by, "read_no").sortWithinPartitions(*by, "read_no")
    fastq_lines(reads).select("value", *by).write.mode("overwrite").partitionBy(*by).text(path)


def sam_lines(splits: DataFrame) -> DataFrame:
    """Two SAM lines a split pair with its scores as tags."""
    tag = lambda name, kind, col: F.when(F.col(col).isNotNull(), F.concat(F.lit(f"{name}:{kind}:"), F.col(col).cast("string")))

    def line(k: int):
        own = [tag("XA", "Z", f"xa{k}"), tag("XC", "f", "xc"), tag("XD", "Z", "xd"), tag("XE", "f", "xe"), tag("XL", "i", "xl"), tag("XM", "i", "xm"), tag("XN", "i", f"s{k}.seg_no"), tag("XR", "f", "xr"), tag("XS", "i", "xs"), tag("XX", "i", f"s{k}.xx"), tag("XY", "i", f"s{k}.xy")]
        return F.concat_ws("\t", "qname", F.col("flag").cast("string"), "rname", (F.col(f"s{k}.pos0") + 1).cast("string"), F.lit("255"), F.col(f"s{k}.cigar"), F.lit("*\t0\t0"), F.col(f"s{k}.seq"), F.lit("*"), *own)

    return splits.select("sample_id", "route", F.concat_ws("\n", line(1), line(2)).alias("value"))


def single_lines(singles: DataFrame) -> DataFrame:
    """A SAM line for each read that is not split."""
    cols = ["qname", F.col("flag").cast("string"), "rname", (F.col("pos0") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*\t0\t0"), "seq", "qual"]
    return singles.select("sample_id", F.concat_ws("\t", *cols).alias("value"))


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Tab-separated with a header."""
    w = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "")
    (w.partitionBy(*by) if by else w).csv(path)


def stats_table(counts: DataFrame) -> DataFrame:
    """Run counters (condition, sample_no, reads, aligned, splits, multsplits, ...) with replicates as three digits from 0."""
    rep = F.row_number().over(Window.partitionBy("condition").orderBy("sample_no")) - 1
    more = [F.col("interactions").alias("Interactions")] if "interactions" in counts.columns else []
    return counts.withColumn("rep", rep).select(F.col("condition").alias("Condition"), F.lpad(F.col("rep").cast("string"), 3, "0").alias("Replicate"), F.col("reads").alias("Reads"), F.col("aligned").alias("Aligned"), F.col("splits").alias("Splits"), F.col("multsplits").alias("MultSplits"), *more).orderBy("Condition", "Replicate")


def cluster_table(numbered: DataFrame) -> DataFrame:
    cols = ["clust_id", "chr1", "strand1", "start1", "end1", "chr2", "strand2", "start2", "end2", "no_splits", "len1", "len2"]
    return numbered.select(*(F.col(c).alias(h) for c, h in zip(cols, CLUSTER_HEADER)))


def graph_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The JSON graph as three kinds of rows: kind (graph, node, edge) and value; one JSON text a row, so no task holds the graph."""
    spark = nodes.sparkSession
    head = spark.range(1).select(F.lit("graph").alias("kind"), F.to_json(F.struct(F.lit("false").alias("directed"))).alias("value"))
    n = nodes.select(F.lit("node").alias("kind"), F.to_json(F.struct("id", "label", F.struct("orientation").alias("metadata"))).alias("value"))
    e = edges.select(F.lit("edge").alias("kind"), F.to_json(F.struct("source", "target", "relation")).alias("value"))
    return head.unionByName(n).unionByName(e)


def graph_document(nodes: DataFrame, edges: DataFrame, most: int = 1_000_000) -> dict:
    """The whole JSON graph as one document on the driver, for graphs of at most `most` nodes and edges."""
    if nodes.count() + edges.count() > most:
        raise ValueError("the graph is too large for one document; use graph_lines()")
    found = {r["id"]: {"label": r["label"], "metadata": {"orientation": r["orientation"]}} for r in nodes.orderBy("id").collect()}
    return {"graph": {"directed": "false"}, "nodes": found, "edges": [r.asDict() for r in edges.select("source", "target", "relation").orderBy("source", "target").collect()]}
