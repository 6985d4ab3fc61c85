"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence, with size-derived bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cells, Stage, connected_components, id_bitmap, in_bitmap, lean, sum_cells
from .shingles import shingle_sets, signature

#: Cells of the frequency sketch that orders the n-grams of a document; a fixed bound, not a function of the data.
SKETCH_BITS = 20
#: Rows of a column that one product holds; longer columns are cut into blocks.
BLOCK = 512


def _needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def parity_bits(s: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set's hashes fall in each of about as many cells, 64 cells a number.

    The cells in which two sets differ are no more than the n-grams in which they do; halves of a power of two of
    cells added up give the parities of half as many.
    """
    cells = max(64, 1 << max(0, len(s) - 1).bit_length())
    odd = np.bincount((s >> np.uint64(24) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _scan(k: int, bits: int):
    def run(batches):
        cells, task = Cells(bits), TaskContext.get().partitionId()
        names = ["kind", "doc_id", "n", "sig", "odd", "task", "block", "at", "counts"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        for b in batches:
            n, sig, odd = [], [], []
            for s in shingle_sets(b["text"], k):
                n.append(len(s))
                sig.append(signature(s) if len(s) else None)
                odd.append(parity_bits(s))
                cells.add(s)
            m = len(n)
            none = [pa.nulls(m, t) for t in types[5:]]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, np.int32)), b["doc_id"].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(odd, types[4]), *none], names=names)
        rows = list(cells.rows())
        if rows:
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), *(pa.nulls(m, t) for t in types[1:5]), pa.array(np.full(m, task, np.int32)), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=names
            )

    return run


def _prefixes(k: int, percent: int, counts):
    def run(batches):
        weight = counts.value
        mask = np.uint64(len(weight) - 1)
        for b in batches:
            n, parts, size = [], [], [0]
            for s in shingle_sets(b["text"], k):
                p = len(s) - _needed(len(s), percent) + 1 if len(s) else 0
                # by weight, then by hash: the sets are sorted by hash
                order = np.argsort(weight[(s & mask).astype(np.int64)], kind="stable")[:p]
                n.append(len(s))
                parts.append(s[order])
                size.append(size[-1] + p)
            flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(n, pa.int32()), lists], names=["doc_id", "n", "prefix"])

    return run


def _sets(k: int, wanted):
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(in_bitmap(b["doc_id"], wanted.value)))
            parts = list(shingle_sets(b["text"], k))
            size = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.ListArray.from_arrays(pa.array(size), pa.array(flat))], names=["doc_id", "grams"])

    return run


def _alike(na: str, nb: str, percent: int) -> str:
    """Sizes that leave a link possible."""
    return f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb})"


def _room(na: str, pa: str, nb: str, pb: str, percent: int) -> str:
    """Sizes and the places of a shared n-gram leave enough possible overlap, if no earlier one is shared."""
    return f"{_alike(na, nb, percent)} and ({100 + percent}) * least({na} - {pa}, {nb} - {pb}) >= {percent} * ({na} + {nb})"


def _product(rows: DataFrame, columns: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs (a, b) of different components, by overlap counts accumulated over the columns' products.

    rows: (gram, doc_id, n, pos, component); columns: (gram, m), their numbers of rows. A column of more than
    `block` rows is cut into blocks, and each pair of blocks is a product of its own, so that no task holds a
    whole column. Counts are summed before the shuffle by pair; pairs below the size-derived bounds are discarded.
    """
    cut = rows.join(columns, "gram").withColumn("blocks", F.expr(f"cast(ceil(m / {block}) as int)"))
    cut = cut.withColumn("block", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cut = cut.select("gram", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"), "block", "doc_id", "n", "pos", "component")
    a, b = (cut.select("gram", "ti", "tj", *(F.col(c).alias(f"{c}_{x}") for c in ("block", "doc_id", "n", "pos", "component"))) for x in "ab")
    fits = f"doc_id_a < doc_id_b and component_a <> component_b and (ti = tj or block_a <> block_b) and {_room('n_a', 'pos_a', 'n_b', 'pos_b', percent)}"
    both = a.join(b, ["gram", "ti", "tj"]).where(fits).groupBy(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
    counted = both.agg(F.count("*").alias("c"), F.max("pos_a").alias("xa"), F.max("pos_b").alias("xb"), F.first("n_a").alias("na"), F.first("n_b").alias("nb"))
    # room shrinks along the order, so c counts all shared n-grams up to the last one that had room
    return counted.where(f"{100 + percent} * (c + least(na - 1 - xa, nb - 1 - xb)) >= {percent} * (na + nb)").select("a", "b")


def _possible(pairs: DataFrame, odd: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the sets' parities leave possible: |A & B| <= (|A| + |B| - differing cells) / 2."""
    side = lambda x: odd.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("odd").alias(f"o{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_alike("na", "nb", percent))
    half = lambda x: f"zip_with(slice({x}, 1, size({x}) div 2), slice({x}, size({x}) div 2 + 1, size({x}) div 2), (p, q) -> p ^ q)"
    # sizes that leave a link possible differ by one doubling of the cells at most
    both = both.withColumn("x", F.expr(f"if(size(oa) > size(ob), {half('oa')}, oa)")).withColumn("y", F.expr(f"if(size(ob) > size(oa), {half('ob')}, ob)"))
    differ = "aggregate(zip_with(x, y, (p, q) -> bit_count(p ^ q)), 0, (s, z) -> s + z)"
    return both.where(f"{100 + percent} * (na + nb - {differ}) >= {2 * percent} * (na + nb)").select("a", "b")


def _verified(stage: Stage, docs: DataFrame, odd: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough, counted on the whole sets; one document may stand in very many pairs.

    Both sides of each join come straight from a shuffle and nothing behind it needs a document's rows together,
    so that Spark can split such a document.
    """
    pairs = stage.write(_possible(pairs, odd, percent), "possible")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    # a bounded filter, so that texts without a candidate are not shingled or shuffled again
    wanted = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids))
    sets = stage.write(docs.mapInArrow(lean(_sets(k, wanted)), "doc_id long, grams array<long>"), "sets")
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb")), "b")
    found = both.select("a", "b", F.size(F.array_intersect("ga", "gb")).alias("common"), F.expr("size(ga) + size(gb)").alias("total"))
    out = stage.write(found.where(f"common > 0 and 100 * common >= {percent} * (total - common)").select("a", "b"), "links")
    stage.drop(sets, pairs)
    return out


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, sketch_bits: int = SKETCH_BITS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id of the graph of pairs with Jaccard >= percent/100.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a document's set holds its distinct
    k-word shingles. Equal sets are merged first, so exact copies are never paired. Every other link of two
    sets must share one of the n - ceil(n * percent / 100) + 1 n-grams that come first in a global order; the
    order is by a bounded frequency sketch, then by hash, and decides cost only, never the result. Two rounds
    multiply the incidence rows of those n-grams: first each column's rows with the column's two leading
    documents, so that this round stays linear; then, for columns that still hold different components, all rows
    across components, in blocks of `block` rows. Overlap counts are accumulated over the columns, and pairs below
    bounds derived from sizes, places and the parities of both sets discarded; what is left is counted on whole sets.

    Null or blank texts have no shingles and link with nothing. A null id gives a null component and no
    links. Of rows that repeat an id each gets its own n_shingles, and a link of one text counts for the id.
    Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "ngram-join")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scan = stage.write(docs.mapInArrow(lean(_scan(k, sketch_bits)), "kind int, doc_id long, n long, sig binary, odd array<long>, task int, block int, at binary, counts binary"), "scan")
    feats = scan.where("kind = 0").select("doc_id", "n", "sig")
    counts = spark.sparkContext.broadcast(sum_cells(scan.where("kind = 1").select("task", "block", "at", "counts"), sketch_bits))
    reps = stage.write(feats.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "reps")
    odd = scan.where("kind = 0 and n > 0 and doc_id is not null").select("doc_id", "n", "odd")
    known = docs.where("doc_id is not null")

    pre = known.mapInArrow(lean(_prefixes(k, percent, counts)), "doc_id long, n int, prefix array<long>")
    pre = pre.join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    rows = stage.write(pre.select("doc_id", "n", F.posexplode("prefix").alias("pos", "gram")), "incidence")
    cols = stage.write(rows.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram"), "columns")
    shared = stage.write(rows.join(cols, "gram"), "shared")
    stage.drop(rows, cols)

    lead = F.struct("doc_id", "n", "pos")
    leads = stage.write(shared.groupBy("gram").agg(F.min_by(lead, F.struct("pos", "doc_id")).alias("lead"), F.min_by(lead, "doc_id").alias("low")), "leads")
    star = shared.join(leads, "gram").select("doc_id", "n", "pos", F.explode(F.expr("array_distinct(array(lead, low))")).alias("y"))
    star = star.where("doc_id <> y.doc_id and " + _room("n", "pos", "y.n", "y.pos", percent))
    star = stage.write(star.select(F.col("doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct(), "star")
    links = _verified(stage, known, odd, star, k, percent)
    comps = connected_components(stage, links)

    labelled = shared.join(comps.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    labelled = stage.write(labelled.select("gram", "doc_id", "n", "pos", "component"), "labelled")
    mixed = labelled.groupBy("gram").agg(F.count("*").alias("m"), F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("gram", "m")
    mixed = stage.write(mixed, "mixed")
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stage.write(_product(labelled, mixed, percent, block).join(tried, ["a", "b"], "left_anti"), "rest")
    more = _verified(stage, known, odd, rest, k, percent)
    final = connected_components(stage, links.unionByName(more))
    stage.drop(shared, leads, star, labelled, mixed, rest)

    named = reps.select("sig", "rep").join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select("sig", F.coalesce("component", "rep").alias("component"))
    out = feats.join(named, "sig", "left")
    return out.select("doc_id", feats["n"].alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
