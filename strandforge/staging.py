"""Tables written to the cluster's shared folder, to cut lineage where an input is used many times."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, a temporary one, but only if all tasks run in this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: staged tables need a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "strandforge-stage")
    return root.rstrip("/")


_written: set[str] = set()


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Results read staged tables lazily, so what is still there goes when the driver ends."""

    def clean() -> None:
        try:
            delete(spark, path)
        except Exception:  # the JVM may have gone first; then the folder's owner cleans it
            pass

    if path not in _written:
        _written.add(path)
        atexit.register(clean)


#: With a limit of bytes Spark adds up the sizes of all columns after each row, which costs more than to send a short row.
SHORT_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}
#: What a job has shuffled goes when it ends, instead of when the driver happens to collect its garbage.
SHUFFLED_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def setting(spark: SparkSession, conf: dict[str, str]):
    """Settings of the session, for the jobs that run meanwhile."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, conf: dict[str, str] = {}) -> DataFrame:
    """The same rows, read back from the shared folder; conf: settings to write them with."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/core-{uuid.uuid4().hex[:12]}"
    delete_at_exit(spark, path)
    with setting(spark, conf):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
