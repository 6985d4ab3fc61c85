"""Embedding near-duplicates: int8 tile products with rigorous error bounds, exact recomputation near the threshold."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, connected_components

#: Slack for the rounding of double sums, well above it and well below any quantisation bound.
_SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes (as exact float32), scale, length of the decoded vector and length of its error, for each row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    decoded = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: 1,000 terms of 127 * 127 stay below 2^24."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1000):
        out += a[:, k : k + 1000] @ b[:, k : k + 1000].T
    return out


def linked_blocks(a: np.ndarray, b: np.ndarray, threshold: float, step: int = 256):
    """Yields (first row, boolean block) of the rows of a and b (unit vectors) whose cosine reaches the threshold."""
    qa, sa, la, ea = quantised(a)
    qb, sb, _, eb = quantised(b) if b is not a else (qa, sa, la, ea)
    for i in range(0, len(a), step):
        r = slice(i, i + step)
        near = _product(qa[r], qb) * sa[r, None] * sb[None]
        # |u.v - decoded product| <= |decoded u| |error of v| + |error of u| |v|
        bound = la[r, None] * eb[None] + ea[r, None] + _SLACK
        hit = near - bound >= threshold
        x, y = np.nonzero((near + bound >= threshold) & ~hit)
        for k in range(0, len(x), 65536):
            p, q = x[k : k + 65536], y[k : k + 65536]
            hit[p, q] = np.einsum("ij,ij->i", a[i + p], b[q]) >= threshold
        yield i, hit


def _tile_links(threshold: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, ti, tj = key
        pdf = pdf.sort_values("vec_id", kind="stable")
        x = np.array([np.asarray(e, dtype=np.float64) for e in pdf["embedding"]])
        # scaled by the largest component first, so that squares neither overflow nor vanish
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ids, weight, tile = (pdf[c].to_numpy() for c in ("vec_id", "m", "tile"))
        at_a, at_b = np.flatnonzero(tile == ti), np.flatnonzero(tile == tj)
        links, lab = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        if len(at_a) and len(at_b):
            a = x[at_a]
            for i, hit in linked_blocks(a, a if ti == tj else x[at_b], threshold):
                if ti == tj:
                    hit &= np.arange(len(at_b))[None] > (i + np.arange(len(hit)))[:, None]
                rows = at_a[i : i + len(hit)]
                links[rows] += hit @ weight[at_b]
                links[at_b] += weight[rows] @ hit
                for k in np.flatnonzero(hit.any(axis=1)):
                    met = np.unique(np.append(lab[at_b[hit[k]]], lab[rows[k]]))
                    if len(met) > 1:
                        lab[np.isin(lab, met)] = met[0]
        keep = (links > 0) | (lab != np.arange(len(ids)))
        return pd.DataFrame({"vec_id": ids[keep], "n": links[keep], "other": ids[lab[keep]]})

    return run


def embedding_components(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = 2048) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (vec_id = component_id).

    Vectors link when labels are equal and the cosine reaches the threshold. Equal vectors of a label are
    merged and counted first, so large groups of copies cost one vector. The others are dealt by hash into
    tiles of about `tile` vectors of one label and dimension; each pair of tiles is one task's work, which
    returns link counts and a spanning forest, never the pairs.

    A vector that is null, empty, zero, or holds a null or non-finite component, a null label or a null id
    links with nothing (0 links, its own component; null for a null id). Different dimensions never link.
    Rows that repeat an id count as separate vectors of one node. Other columns are ignored; an empty table
    gives an empty table.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).cast("string").alias("label"))
    fit = F.coalesce(F.expr("size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"), F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("fit", fit)
    reps = stage.write(rows.where("fit").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "distinct")
    sized = reps.withColumn("dim", F.size("embedding"))
    tiles = sized.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = sized.join(tiles, ["label", "dim"]).withColumn("tile", F.expr("cast(pmod(xxhash64(rep, embedding), tiles) as int)"))
    # each vector goes to every pair of tiles that holds its own
    pairs = dealt.withColumn("with", F.explode(F.expr("sequence(0, tiles - 1)"))).select(F.col("rep").alias("vec_id"), "embedding", "m", "label", "dim", "tile", F.least("tile", "with").alias("ti"), F.greatest("tile", "with").alias("tj"))
    found = stage.write(pairs.groupBy("label", "dim", "ti", "tj").applyInPandas(_tile_links(threshold), "vec_id long, n long, other long"), "links")
    comps = connected_components(stage, found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("n").alias("n"))
    named = reps.join(counts, "rep", "left").join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(named, F.col("fit") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
