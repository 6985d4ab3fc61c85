"""Reads that arrive as files: the preprocessing stage as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Options
from ..operators.preproc import preprocess_single


def stream_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Reads of FASTQ files as they land in a directory; a file is a batch's unit and is read whole."""
    files = spark.readStream.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    lines = files.withColumn("l", F.split(F.regexp_replace("value", "\r", ""), "\n"))
    each = lines.select("path", "l", F.explode(F.expr("sequence(0, greatest(0, cast(size(l) / 4 as int) - 1))")).alias("n")).where("size(l) >= 4 * n + 4")
    line = lambda k: F.expr(f"get(l, 4 * n + {k})")
    return each.select(F.regexp_extract("path", "([^/]+/[^/]+/[^/.]+)[^/]*$", 1).alias("sample_id"), F.col("n").cast("long").alias("read_no"), F.substring(line(0), 2, 1 << 20).alias("id"), line(1).alias("seq"), line(3).alias("qual"))


def run_preprocessing(spark: SparkSession, landing: str, out: str, checkpoint: str, adapters5: list[str], adapters3: list[str], opt: Options, once: bool = True) -> StreamingQuery:
    """Stateless: the same trimming and filtering as for tables, each file exactly once into Parquet."""
    rows = preprocess_single(stream_fastq(spark, landing), adapters5, adapters3, opt)
    w = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("sample_id")
    return (w.trigger(availableNow=True) if once else w).start()
