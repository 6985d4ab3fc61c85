"""Line dedup by content-defined chunks of lines, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage

#: A chunk ends where the rolling hash of two lines is a multiple of this; a line of so many characters is a chunk.
DIVISOR, LONG_LINE = 3, 200


def _chunked(docs: DataFrame, divisor: int, long_line: int) -> DataFrame:
    """Adds lines, and ends: the last line number (from 0) of each chunk."""
    rows = docs.withColumn("lines", F.split("text", "\n"))
    rows = rows.withColumn("hashes", F.expr("transform(lines, l -> cast(conv(left(md5(l), 7), 16, 10) as bigint))"))
    rows = rows.withColumn("sizes", F.expr("transform(lines, l -> length(l))"))
    cut = f"i = size(hashes) - 1 or (coalesce(get(hashes, i - 1), 0) * 31 + get(hashes, i)) % {divisor} = 0 or get(sizes, i) >= {long_line} or get(sizes, i + 1) >= {long_line}"
    return rows.withColumn("ends", F.expr(f"filter(sequence(0, size(hashes) - 1), i -> {cut})")).drop("hashes", "sizes")


#: (k, first line, last line) of each chunk.
_CHUNKS = "transform(ends, (e, k) -> struct(k as k, coalesce(get(ends, k - 1) + 1, 0) as a, e as b))"
_BODY = "array_join(slice(lines, c.a + 1, c.b - c.a + 1), '\\n')"


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, long_line: int = LONG_LINE) -> DataFrame:
    """One row per document: doc_id, text without repeated chunks, n_lines, removed_lines.

    Lines are hashed; a rolling hash over each line and the one before chooses where chunks end, so inserted or
    deleted lines shift no boundary beyond the next. A line of long_line characters or more is a chunk of its
    own. Chunks of several lines, and long lines, that occur more than once in all texts stay only where they
    stand first, by (doc_id, place); chunks of equal hash count as equal only if their bytes are. Blank chunks
    and single short lines are never removed.

    A null text stays null with 0 lines, an empty one is one empty line. Rows with a null id are kept as they
    are and compared with nothing. Rows that repeat an id are documents of their own if their texts differ (the
    order is then by a hash of the text); rows equal in both are one document, and stay alike. Other columns are ignored; an empty table gives an empty table. Only chunk hashes,
    the texts of repeated chunks, and each text twice are shuffled.
    """
    out = _edited(docs, id_col, text_col, divisor, long_line)
    return out.select("doc_id", "edited", "n_lines", "removed_lines").withColumnRenamed("edited", "text")


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", divisor: int = DIVISOR, long_line: int = LONG_LINE) -> DataFrame:
    """The documents with all their columns and without repeated chunks; length_col, if there, is brought up to date.

    A document of which only white space is left leaves the table: all it said stands elsewhere.
    """
    # the condition names a column that keeps it above the edit; pushed below, it would repeat the edit for each use
    out = _edited(docs, id_col, text_col, divisor, long_line).withColumn("place", F.monotonically_increasing_id())
    out = out.where("place >= 0 and (removed_lines = 0 or length(trim(replace(edited, '\n', ' '))) > 0)")
    cols = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == text_col:
            old = F.col("edited")
        elif c == length_col:
            old = F.when(F.col("removed_lines") > 0, F.length("edited").cast(docs.schema[c].dataType)).otherwise(old)
        cols.append(old.alias(c))
    return out.select(*cols)


def _edited(docs: DataFrame, id_col: str, text_col: str, divisor: int, long_line: int) -> DataFrame:
    """(doc_id, edited, n_lines, removed_lines, row with all other columns)."""
    spark = docs.sparkSession
    stage = Stage(spark, "lines")
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), rest.alias("row"))
    # rows that repeat an id are told apart by their texts
    whole = whole.withColumn("version", F.xxhash64("text"))
    key = ["doc_id", "version"]
    docs = whole.drop("row")
    usable = docs.where("doc_id is not null and text is not null")
    rows = _chunked(usable, divisor, long_line)
    chunks = rows.select(*key, "lines", F.explode(F.expr(_CHUNKS)).alias("c")).withColumn("body", F.expr(_BODY))
    chunks = chunks.where(f"(c.b > c.a or length(body) >= {long_line}) and length(trim(replace(body, '\\n', ' '))) > 0").select(*key, F.col("c.k").alias("k"), F.xxhash64("body").alias("h"))
    chunks = stage.write(chunks, "chunks")
    # both sides of this join come straight from a shuffle, so that Spark can split a hash that very many chunks have
    often = stage.write(chunks.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "often")
    # the places whose hash repeats, by document, and the bytes that stand there
    places = chunks.join(often, "h").groupBy(*key).agg(F.collect_set("k").alias("ks"))
    texts = usable.join(places, key)
    bodies = _chunked(texts, divisor, long_line).select(*key, "lines", F.explode(F.expr(f"filter({_CHUNKS}, c -> array_contains(ks, c.k))")).alias("c")).select(*key, F.col("c.k").alias("k"), F.expr(_BODY).alias("body"))
    bodies = stage.write(bodies.distinct(), "bodies")
    # the first place of each body stays; a body that occurs once is its own first
    first = bodies.groupBy("body").agg(F.min(F.struct(*key, "k")).alias("first")).select("first.*")
    # written, so that the shuffled bodies are freed before the texts are read again
    first = stage.write(first, "first")
    stage.drop(chunks, often)
    gone = bodies.select(*key, "k").join(first, [*key, "k"], "left_anti").groupBy(*key).agg(F.collect_set("k").alias("gone"))
    out = whole.join(gone, key, "left")
    touched = _chunked(out, divisor, long_line)
    kept = F.expr(f"filter({_CHUNKS}, c -> not array_contains(gone, c.k))")
    touched = touched.withColumn("left", F.when(F.col("gone").isNotNull(), F.transform(kept, lambda c: F.array_join(F.slice("lines", c["a"] + 1, c["b"] - c["a"] + 1), "\n"))))
    removed = F.expr(f"aggregate({_CHUNKS}, 0, (n, c) -> n + if(array_contains(gone, c.k), c.b - c.a + 1, 0))")
    return touched.select(
        "doc_id", "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("edited"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.when(F.col("gone").isNotNull(), removed), F.lit(0)).cast("long").alias("removed_lines"),
    )


ORACLE = f"""
with split_up as (select doc_id, text, string_split(text, chr(10)) as lines from documents),
hashed as (select *, list_transform(lines, lambda l: cast('0x' || left(md5(l), 7) as bigint)) as hs from split_up),
ended as (select *, list_filter(range(1, len(lines) + 1), lambda i: i = len(lines) or (coalesce(hs[i - 1], 0) * 31 + hs[i]) % {DIVISOR} = 0
  or length(lines[i]) >= {LONG_LINE} or coalesce(length(lines[i + 1]), 0) >= {LONG_LINE}) as ends from hashed),
numbered as (select doc_id, lines, ends, unnest(range(1, len(ends) + 1)) as k from ended where doc_id is not null and text is not null),
bounded as (select doc_id, k, lines, coalesce(ends[k - 1], 0) + 1 as a, ends[k] as b from numbered),
chunks as (select doc_id, k, a, b, array_to_string(lines[a:b], chr(10)) as body from bounded),
fit as (select *, (b > a or length(body) >= {LONG_LINE}) and length(trim(replace(body, chr(10), ' '))) > 0 as ok from chunks),
ranked as (select *, row_number() over (partition by ok, body order by doc_id, k) as nth from fit),
final as (select doc_id, coalesce(string_agg(body, chr(10) order by k) filter (where not ok or nth = 1), '') as kept,
  coalesce(sum(b - a + 1) filter (where ok and nth > 1), 0) as removed from ranked group by doc_id)
select d.doc_id, coalesce(f.kept, d.text) as text, coalesce(len(d.lines), 0) as n_lines, cast(coalesce(f.removed, 0) as bigint) as removed_lines
from split_up d left join final f on d.doc_id = f.doc_id
"""
