"""Genomic relations derived from the driver's tables, as expressions that hold in Spark and in plain SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Hex digits as bases, and as quality characters of 10 to 25.
HEX, BASES, QUALS = "0123456789abcdef", "ACGTACGTACGTACGT", "+,-./0123456789:"
_READ_ID = "concat_ws('-', cast(l_orderkey as varchar(20)), cast(l_linenumber as varchar(20)), cast(l_partkey as varchar(20)), cast(l_suppkey as varchar(20)), cast(cast(floor(l_quantity) as bigint) as varchar(20)), cast(cast(round(l_extendedprice * 100) as bigint) as varchar(20)))"

VIEWS: dict[str, tuple[str, list[str]]] = {
    "feature": (
        "part",
        [
            "p_partkey as feature_no", "concat('chr', cast(p_partkey % 5 as varchar(4))) as chrom", "(p_partkey * 7919) % 2000000 as f_start", "(p_partkey * 7919) % 2000000 + p_size * 20 as f_end",
            "case when p_partkey % 2 = 0 then '+' else '-' end as f_strand", "concat('g', cast(p_partkey as varchar(20))) as name", "p_brand as biotype",
        ],
    ),
    "reads": (
        "lineitem",
        [
            f"{_READ_ID} as read_id", "l_orderkey as qname", "l_linenumber as seg", "concat('chr', cast(l_suppkey % 5 as varchar(4))) as chrom", "(l_partkey * 104729 + l_linenumber * 31) % 2000000 as start1",
            "(l_partkey * 104729 + l_linenumber * 31) % 2000000 + cast(floor(l_quantity) as bigint) as end1", "case when l_suppkey % 2 = 0 then '+' else '-' end as strand", "cast(floor(l_quantity) as integer) as mapq",
            "cast((l_suppkey % 2) * 16 + case when l_partkey % 7 = 0 then 4 else 0 end as integer) as flag", "l_discount as cmpl", "-100 * l_tax - 1 as energy", "concat('s', cast(l_orderkey % 4 as varchar(4))) as sample_id",
        ],
    ),
    "sample": ("orders", ["o_orderstatus as grp", "o_orderpriority as condition", "o_orderkey % 3 as replicate", "o_orderkey", "concat(o_orderstatus, '/', o_orderpriority, '/F', cast(o_orderkey as varchar(20)), '.fastq') as path"]),
    "seqs": (
        "documents",
        [
            "doc_id", f"translate(concat(md5(cast(doc_id as varchar(20))), md5(cast(doc_id + 1 as varchar(20)))), '{HEX}', '{BASES}') as seq",
            f"translate(concat(md5(cast(doc_id + 2 as varchar(20))), md5(cast(doc_id + 3 as varchar(20)))), '{HEX}', '{QUALS}') as qual",
        ],
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, exprs = VIEWS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*exprs)


def with_views(*names: str) -> str:
    """The views as the head of a SQL query."""
    return "with " + ",\n".join(f"v_{n} as (select {', '.join(VIEWS[n][1])} from {VIEWS[n][0]})" for n in names)
