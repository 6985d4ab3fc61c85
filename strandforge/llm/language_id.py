"""Language identification of web pages by Bayesian evidence fusion."""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cells, Stage, lean, sum_cells, text_chunks

#: Hash buckets of byte trigrams a language; a fixed bound of what is broadcast.
BUCKET_BITS = 15
MAX_LANGUAGES = 500
_UNSEEN = "script|style|noscript|template|head|nav|footer"
_MARK = re.compile(rf"<(?:({_UNSEEN})\b|(!--)|/({_UNSEEN})\s*>)", re.I)
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*=\s*(?:[\"']\s*)?([A-Za-z]{2,8})", re.I)
_LONG_REFERENCE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9a-fA-F]{9,});?")
_URL = re.compile(r"^[^:/?#]*://([^/?#]*)([^?#]*)")
_CODE = re.compile(r"/([A-Za-z]{2})(?=/|$)")


def visible_text(page: str | None) -> str:
    """Text of a page without scripts, styles, navigation and markup, in time linear in its length.

    An unseen element without an end, and a comment without one, are ordinary markup.
    """
    if not page:
        return ""
    marks = list(_MARK.finditer(page))
    ends: dict[str, list[tuple[int, int]]] = {}
    for m in marks:
        if m[3]:
            ends.setdefault(m[3].lower(), []).append(m.span())
    at, parts, comment_end = 0, [], 0
    for m in marks:
        if m.start() < at or m[3]:
            continue
        if m[2]:
            if 0 <= comment_end < m.end():
                found = page.find("-->", m.end())
                comment_end = found + 3 if found >= 0 else -1
            close = comment_end
            if close < 0:
                continue
        else:
            own = ends.get(m[1].lower(), [])
            k = bisect_left(own, (m.end(), 0))
            if k == len(own):
                continue
            close = own[k][1]
        parts.append(page[at : m.start()])
        at = close
    text = " ".join([*parts, page[at:]])
    cut = text.rfind(">") + 1  # behind it no tag ends
    return html_lib.unescape(_LONG_REFERENCE.sub("\ufffd", _TAG.sub(" ", text[:cut]) + text[cut:]))


def declared_language(page: str | None) -> str:
    """The lang attribute of an html tag, lower-cased; "" without one."""
    at = 0
    while page and (m := _HTML.search(page, at)):
        end = page.find(">", m.end())
        end = len(page) if end < 0 else end
        if found := _LANG.search(page, m.end(), end):
            return found[1].lower()
        at = end
    return ""


def address_parts(url: str | None) -> tuple[str, str, str]:
    """Host, registered part (its last two labels), and suffix: a two-letter path segment, else the last label."""
    m = _URL.match(url or "")
    if not m:
        return "", "", ""
    host = m[1].lower().rpartition("@")[2].split(":")[0]
    labels = host.split(".")
    code = _CODE.search(m[2])
    return host, ".".join(labels[-2:]), "/" + code[1].lower() if code else "." + labels[-1]


def _trigrams(buf: np.ndarray, bounds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of lower-cased texts, letters only, and each text's first one."""
    x = buf.astype(np.uint32)
    x[(buf >= 65) & (buf <= 90)] += 32
    x[(buf < 65) | ((buf > 90) & (buf < 97)) | ((buf > 122) & (buf < 128))] = 32
    if len(x) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(len(bounds), dtype=np.int64)
    g = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    ok = (x[1:-1] != 32) | ((x[:-2] != 32) & (x[2:] != 32))
    last = bounds[1:-1]
    for back in (1, 2):
        at = last - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    slot = (g * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.int64)
    kept = np.flatnonzero(ok)
    return slot[kept], np.searchsorted(kept, bounds)


def _train(stage: Stage, docs: DataFrame, langs: list[str], bits: int) -> np.ndarray:
    """log P(bucket | language), from all trigrams of all documents with a language."""
    index = {x: i for i, x in enumerate(langs)}
    total_bits = bits + max(1, (len(langs) - 1).bit_length())

    def run(batches):
        cells, task = Cells(max(12, total_bits)), TaskContext.get().partitionId()
        for b in batches:
            lang = np.array([index[x] for x in b["lang"].to_pylist()], dtype=np.int64)
            for i, j, buf, bounds in text_chunks(b["text"]):
                slot, first = _trigrams(buf, bounds, bits)
                cells.counts += np.bincount(np.repeat(lang[i:j], np.diff(first)) << bits | slot[: first[-1]], minlength=len(cells.counts))
        rows = list(cells.rows())
        yield pa.RecordBatch.from_arrays([pa.array([task] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["task", "block", "at", "counts"])

    n = sum_cells(docs.mapInArrow(run, "task int, block int, at binary, counts binary"), max(12, total_bits))
    n = n[: len(langs) << bits].reshape(len(langs), -1) + 0.5
    return np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32)


def identify_languages(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", text_col: str = "text", lang_col: str = "lang", temper: float = 0.2, strength: float = 8.0, bits: int = BUCKET_BITS, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """One row per page: page_id, lang, confidence, text_lang, declared, suffix, host.

    Text likelihoods come from byte trigrams counted over all documents of each language. With a flat prior
    they give each page a first opinion; grouped sums of these give how often each declared markup language
    and each address suffix goes with each language, and the languages of hosts, smoothed towards their
    registered domain and that towards all pages (with `strength` pages of weight each), without the page's own
    share. The posterior multiplies the tempered likelihood, both kinds of evidence and the host's prior.

    Null pages have no text and undecided likelihoods; null or odd URLs an empty host and suffix; a missing
    declaration is a value of its own. Ids may be null or repeat, each row is judged for itself. Documents with
    a null language or text teach nothing; without any, lang is null and confidence 0. Ties go to the first
    language by name. Other columns are ignored; an empty table gives an empty table. More than max_languages
    languages are an error: the table of likelihoods, 2^bits numbers a language, is broadcast.
    """
    spark = pages.sparkSession
    stage = Stage(spark, "language")
    taught = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    langs = sorted(r.lang for r in taught.select("lang").distinct().limit(max_languages + 1).collect())
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    model = spark.sparkContext.broadcast(_train(stage, taught, langs, bits) if langs else np.zeros((0, 1 << bits), dtype=np.float32))
    names = ["page_id", "host", "domain", "declared", "suffix", "ll", "post"]

    def run(batches):
        logp = model.value
        for b in batches:
            texts = pa.array([visible_text(x) for x in b["html"].to_pylist()], pa.string())
            declared = [declared_language(x) for x in b["html"].to_pylist()]
            address = [address_parts(u) for u in b["url"].to_pylist()]
            ll = np.zeros((len(texts), len(logp)))
            for i, j, buf, bounds in text_chunks(texts):
                slot, first = _trigrams(buf, bounds, bits)
                for k in range(len(logp)):
                    c = np.concatenate([[0], np.cumsum(logp[k][slot], dtype=np.float64)])
                    ll[i:j, k] = c[first[1:]] - c[first[:-1]]
            ll *= temper
            post = np.exp(ll - ll.max(axis=1, keepdims=True, initial=-np.inf)) if len(logp) else ll
            post = post / post.sum(axis=1, keepdims=True) if len(logp) else post
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], *(pa.array([a[k] for a in address], pa.string()) for k in range(2)), pa.array(declared, pa.string()), pa.array([a[2] for a in address], pa.string()), pa.array(list(ll), pa.list_(pa.float64())), pa.array(list(post), pa.list_(pa.float64()))], names=names
            )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    seen = stage.write(rows.mapInArrow(lean(run), "page_id long, host string, domain string, declared string, suffix string, ll array<double>, post array<double>"), "opinions")
    if not langs:
        return seen.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang"), "declared", "suffix", "host")

    def sums(name: str) -> list:
        return [F.array(*(F.sum(F.col("post")[k]) for k in range(len(langs)))).alias(name)]

    everything = np.array(seen.agg(*sums("n")).first().n or [0.0] * len(langs), dtype=np.float64)
    share = (everything + 1) / (everything + 1).sum()
    out = seen
    for key in ("host", "domain", "declared", "suffix"):
        # written first, so that the size of each table of sums is known and a hot host can be split or never shuffled
        out = out.join(stage.write(seen.groupBy(key).agg(*sums(f"n_{key}")), key), key)
    lists = F.array(*(F.lit(float(x)) for x in share))
    total = F.array(*(F.lit(float(x)) for x in everything))
    own = "zip_with({}, post, (n, p) -> greatest(n - p, 0d))"
    out = out.withColumn("g", lists).withColumn("all", total)
    plus = lambda n: f"aggregate({n}, 0d, (a, x) -> a + x)"
    for level, below in (("domain", "g"), ("host", "p_domain")):
        out = out.withColumn(f"o_{level}", F.expr(own.format(f"n_{level}")))
        out = out.withColumn(f"p_{level}", F.expr(f"zip_with(o_{level}, {below}, (n, p) -> (n + {strength} * p) / ({plus(f'o_{level}')} + {strength}))"))
    # P(evidence | language) up to a factor that all languages share: pages of that kind over pages, without this page
    for kind in ("declared", "suffix"):
        out = out.withColumn(f"o_{kind}", F.expr(own.format(f"n_{kind}")))
        out = out.withColumn(f"e_{kind}", F.expr(f"zip_with(o_{kind}, all, (n, t) -> ln((n + 0.5d) / (t + 1d)))"))
    out = out.withColumn("score", F.expr("zip_with(zip_with(ll, e_declared, (a, b) -> a + b), zip_with(e_suffix, transform(p_host, p -> ln(p)), (a, b) -> a + b), (a, b) -> a + b)"))
    out = out.withColumn("best", F.expr("array_max(score)"))
    names_of = F.array(*(F.lit(x) for x in langs))
    out = out.withColumn("names", names_of)
    return out.select(
        "page_id", F.expr("get(names, cast(array_position(score, best) - 1 as int))").alias("lang"), F.expr("1d / aggregate(score, 0d, (a, x) -> a + exp(x - best))").alias("confidence"),
        F.when(F.expr("array_max(ll) > array_min(ll)") | (len(langs) == 1), F.expr("get(names, cast(array_position(ll, array_max(ll)) - 1 as int))")).alias("text_lang"), "declared", "suffix", "host",
    )
