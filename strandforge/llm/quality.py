"""Quality classifier by co-training of a text view and a page-metadata view."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, lean, mix64, prefix_hash, span_hash, text_chunks, word_spans

#: Rows that fit the classifier: at most so many labelled documents, and so many unlabelled ones for pseudo-labels.
MAX_LABELLED, MAX_UNLABELLED = 12_000, 6_000
#: Words that the text view keeps, the most telling ones.
WORDS = 3000
STATS = 12
_LETTER, _UP, _NUM, _SIGN = (np.zeros(256, dtype=bool) for _ in range(4))
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_UP[65:91] = True
_NUM[48:58] = True
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(mask)])
    return (c[bounds[1:]] - c[bounds[:-1]]).astype(np.float64)


def text_features(col: pa.Array):
    """Yields (first text, text after, word hashes, words' first numbers, statistics) of runs of whole texts.

    A word counts bare, without signs around it, A-Z lower-cased.
    """
    for i, j, buf, bounds in text_chunks(col):
        starts, ends, first = word_spans(buf, bounds)
        solid = np.flatnonzero(~_SIGN[buf])
        lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        bare = hi > lo
        s, e = starts.copy(), ends.copy()
        if len(solid):
            s[bare], e[bare] = solid[lo[bare]], solid[hi[bare] - 1] + 1
        h = span_hash(prefix_hash(buf), s, e)
        n = np.maximum(np.diff(first), 1).astype(np.float64)
        size = np.maximum(np.diff(bounds), 1).astype(np.float64)
        owner = np.repeat(np.arange(j - i), np.diff(first))
        key = h ^ mix64(owner.astype(np.uint64))
        distinct = np.bincount(owner[np.unique(key, return_index=True)[1]], minlength=j - i)
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        signed = ends - starts - (e - s)
        letters = _sums(_LETTER[buf], bounds)
        stats = np.stack(
            [
                np.log1p(np.diff(first)), distinct / n, np.log1p(n) * distinct / n, _sums(same, first) / n, _sums(signed >= 2, first) / n, _sums(~bare, first) / n,
                _sums(_UP[buf], bounds) / np.maximum(letters, 1), _sums(_NUM[buf], bounds) / size, _sums(_SIGN[buf], bounds) / size, letters / size / 1.0, _sums((ends - starts), first) / n / 10, (np.diff(first) < 8).astype(np.float64),
            ],
            axis=1,
        )
        yield i, j, h, first, stats


class Rows:
    """Rows of 0/1 features, kept as positions, beside dense columns."""

    def __init__(self, lists: list[np.ndarray], width: int, dense: np.ndarray):
        self.row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.col = np.concatenate([*lists, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        self.lists, self.width, self.dense = lists, width, dense

    def take(self, at: np.ndarray) -> Rows:
        return Rows([self.lists[i] for i in at], self.width, self.dense[at])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=len(self.lists)) + self.dense @ w[self.width : -1] + w[-1]

    def tdot(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.col, weights=r[self.row], minlength=self.width), r @ self.dense, [r.sum()]])


def _found(words: list[np.ndarray], chosen: np.ndarray) -> list[np.ndarray]:
    """Places of each document's words among the chosen ones (sorted)."""
    out = []
    for w in words:
        at = np.minimum(np.searchsorted(chosen, w), len(chosen) - 1) if len(chosen) else np.zeros(0, dtype=np.int64)
        out.append(np.unique(at[chosen[at] == w]) if len(chosen) else at)
    return out


def _logistic(x: Rows, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; the last coefficient is the constant."""
    w = np.zeros(x.width + x.dense.shape[1] + 1)
    v = w.copy()
    weight = weight / weight.sum()
    # a bound of the curvature by a few power steps
    u = np.ones(len(w))
    for _ in range(10):
        u = x.tdot(weight * x.dot(u)) + 1e-12
        norm = np.linalg.norm(u)
        u /= norm
    rate = 1 / (0.25 * norm * 1.1 + ridge)
    for t in range(steps):
        g = x.tdot(weight * (_sigmoid(x.dot(v)) - y)) + ridge * np.append(v[:-1], 0)
        new = v - rate * g
        v = new + (t / (t + 3)) * (new - w)
        w = new
    return w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Head:
    """One yes/no property: calibrated views and their combination."""

    chosen: np.ndarray
    scale: tuple[np.ndarray, np.ndarray]
    text: np.ndarray
    meta_keys: np.ndarray
    meta: np.ndarray
    mix: np.ndarray

    def text_margin(self, words: np.ndarray, owner: np.ndarray, n: int, stats: np.ndarray) -> np.ndarray:
        out = (stats - self.scale[0]) / self.scale[1] @ self.text[len(self.chosen) : -1] + self.text[-1]
        if len(self.chosen) and len(words):
            at = np.minimum(np.searchsorted(self.chosen, words), len(self.chosen) - 1)
            hit = np.flatnonzero(self.chosen[at] == words)
            pair = np.unique(owner[hit] * len(self.chosen) + at[hit])
            out += np.bincount(pair // len(self.chosen), weights=self.text[pair % len(self.chosen)], minlength=n)
        return out

    def meta_margin(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.meta_keys):
            return np.full(len(keys), self.meta[-1])
        at = np.minimum(np.searchsorted(self.meta_keys, keys), len(self.meta_keys) - 1)
        return np.where(self.meta_keys[at] == keys, self.meta[:-1][at], 0).sum(axis=1) + self.meta[-1]

    def combined(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return _sigmoid(self.mix[0] * text + self.mix[1] * meta + self.mix[2])


def _telling(words: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The words (in at least three documents) whose presence is the least independent of y."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    flat = np.concatenate(words)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    uniq, code = np.unique(flat, return_inverse=True)
    n = np.bincount(code, minlength=len(uniq)).astype(np.float64)
    pos = np.bincount(code, weights=y[owner], minlength=len(uniq))
    share = max(min(y.mean(), 1 - 1e-9), 1e-9)
    score = np.where(n >= 3, (pos - n * share) ** 2 / (n * share * (1 - share) * np.maximum(1 - n / len(words), 0.05)), 0)
    keep = np.argsort(-score, kind="stable")[:most]
    return np.sort(uniq[keep[score[keep] > 4]])


def constant(answer: bool) -> Head:
    """The same answer for every document, with a probability of 0.95."""
    none = np.zeros(0, dtype=np.uint64)
    return Head(none, (np.zeros(STATS), np.ones(STATS)), np.zeros(STATS + 1), none, np.zeros(1), np.array([0.0, 0.0, 3.0 if answer else -3.0]))


def co_train(words, stats, meta, y, pool_words, pool_stats, pool_meta, held=None, rounds: int = 3, confident: float = 0.97, most_words: int = WORDS) -> Head:
    """Fits both views; in each round a view gives its confident pseudo-labels of the pool to the other view.

    A view may give labels of a kind only if its answers of that kind and confidence are right on the held-out
    fifth of the labelled rows to the same degree. The held-out fifth also fits the combination of both views,
    that is, their calibration. One kind of label only gives a constant answer.
    """
    y = y.astype(np.float64)
    held = (np.arange(len(y)) % 5 == 4 if held is None else held) & (len(y) >= 50)
    fit = ~held
    if not len(y) or y[fit].min() == y[fit].max():
        return constant(bool(len(y)) and y.min() == 1)
    centre, spread = stats[fit].mean(axis=0), stats[fit].std(axis=0) + 1e-6
    dense, pool_dense = ((s - centre) / spread for s in (stats, pool_stats))
    meta_keys = np.unique(meta[fit])
    none = lambda m: np.zeros((len(m), 0))
    pool_dense = pool_dense.reshape(len(pool_words), STATS)
    meta_x, pool_meta_x = (Rows(_found(list(m), meta_keys), len(meta_keys), none(m)) for m in (meta, pool_meta))
    chosen = _telling([w for w, f in zip(words, fit) if f], y[fit], most_words)
    text_x, pool_x = Rows(_found(words, chosen), len(chosen), dense), Rows(_found(pool_words, chosen), len(chosen), pool_dense)
    fit_at, held_at = np.flatnonzero(fit), np.flatnonzero(held)
    given = {"text": (np.zeros(0, int), np.zeros(0)), "meta": (np.zeros(0, int), np.zeros(0))}
    for step in range(rounds + 1):
        fitted = {}
        for view, x, px in (("text", text_x, pool_x), ("meta", meta_x, pool_meta_x)):
            at, lab = given[view]
            more = px.take(at)
            xs, ys = Rows([*(x.lists[i] for i in fit_at), *more.lists], x.width, np.vstack([x.dense[fit_at], more.dense])), np.append(y[fit], lab)
            # rare and common answers weigh alike half-way; pseudo-labels weigh less than labels
            share = np.where(ys == 1, ys.mean(), 1 - ys.mean())
            fitted[view] = _logistic(xs, ys, np.append(np.ones(fit.sum()), np.full(len(at), 0.3)) / np.sqrt(share))
        if step == rounds:
            break
        for view, other, x, px in (("text", "meta", text_x, pool_x), ("meta", "text", meta_x, pool_meta_x)):
            p, known = _sigmoid(px.dot(fitted[view])), _sigmoid(x.take(held_at).dot(fitted[view]))
            at, lab = [], []
            for answer in (0.0, 1.0):
                sure = known >= confident if answer else known <= 1 - confident
                if sure.sum() >= 10 and (y[held][sure] == answer).mean() >= confident:
                    pick = np.flatnonzero(p >= confident if answer else p <= 1 - confident)
                    at.append(pick)
                    lab.append(np.full(len(pick), answer))
            given[other] = (np.concatenate(at), np.concatenate(lab)) if at else (np.zeros(0, int), np.zeros(0))
    mix = np.array([1.0, 1.0, 0.0])
    if held.any() and 0 < y[held].sum() < held.sum():
        views = np.stack([text_x.take(held_at).dot(fitted["text"]), meta_x.take(held_at).dot(fitted["meta"])], axis=1)
        mix = _logistic(Rows([np.zeros(0, int)] * len(views), 0, views), y[held], np.ones(held.sum()), ridge=1e-2, steps=500)
    return Head(chosen, (centre, spread), fitted["text"], meta_keys, fitted["meta"], mix)


_META = ("source", "lang", "n_chars")


def _meta_keys(b) -> np.ndarray:
    """Five hashed metadata features of each row: source, language, size class, and two pairs."""
    import zlib

    rows = []
    for s, lang, n in zip(*(b[c].to_pylist() for c in _META)):
        size = -1 if n is None else int(np.log2(max(int(n), 0) + 1) * 2)
        parts = (f"s={s}", f"l={lang}", f"n={size}", f"sl={s}|{lang}", f"ln={lang}|{size}")
        rows.append([zlib.crc32(p.encode()) | i << 32 for i, p in enumerate(parts)])
    return np.array(rows, dtype=np.uint64).reshape(-1, 5)


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    cols = docs.columns
    kind = {"source": "string", "lang": "string", "n_chars": "long"}
    meta = [(F.col(c) if c in cols else F.lit(None)).cast(k).alias(c) for c, k in kind.items()]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *meta)


def fit_quality(stage: Stage, docs: DataFrame, labels: DataFrame, max_labelled: int, max_unlabelled: int) -> dict[str, Head]:
    """Heads `good` (quality = 1) and `toxic` (toxic = 1), fitted on bounded samples chosen by hash of the id."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and (quality is not null or toxic is not null)")
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    marked = labels.join(ids, "doc_id", "left_semi").orderBy(*order).limit(max_labelled)
    plain = ids.join(labels, "doc_id", "left_anti").orderBy(*order).limit(max_unlabelled)
    sample = marked.unionByName(plain.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic")))
    sample = stage.write(sample.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 4), "sample")
    kind = "doc_id long, quality int, toxic int, held boolean, words array<long>, stats array<double>, meta array<long>"

    def run(batches):
        for b in batches:
            meta = _meta_keys(b)
            words, stats = [], []
            for i, j, h, first, s in text_features(b["text"]):
                words += [np.unique(h[x:y]).view(np.int64) for x, y in zip(first[:-1], first[1:])]
                stats += list(s)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["quality"], b["toxic"], b["held"], pa.array(words, pa.list_(pa.int64())), pa.array(stats, pa.list_(pa.float64())), pa.array(list(meta.view(np.int64)), pa.list_(pa.int64()))],
                names=["doc_id", "quality", "toxic", "held", "words", "stats", "meta"],
            )

    # the sample has max_labelled + max_unlabelled rows at most
    rows = stage.write(docs.join(F.broadcast(sample), "doc_id").mapInArrow(lean(run), kind), "features")
    telling = stage.spark.sparkContext.broadcast(np.unique(np.concatenate([_telling_words(rows, c) for c in ("quality", "toxic")])))

    def narrow(batches):
        for b in batches:
            words = [w[np.isin(w, telling.value)] for w in (x.values.to_numpy(zero_copy_only=False) for x in b["words"])]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.int64())) if n == "words" else b[n] for n in b.schema.names], names=b.schema.names)

    t = rows.mapInArrow(narrow, kind).toArrow().combine_chunks()
    ids = t["doc_id"].to_numpy()
    order = np.lexsort([ids, mix64(ids.astype(np.uint64))])
    words = [np.array(t["words"][int(i)].as_py(), dtype=np.int64).view(np.uint64) for i in order]
    flat = lambda c, width, kind: np.asarray(t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=kind).reshape(-1, width)[order]
    stats, meta = flat("stats", STATS, np.float64), flat("meta", 5, np.int64).view(np.uint64)
    held = np.array(t["held"].to_pylist(), dtype=bool)[order]
    value = {c: np.array([-1 if v is None else v for v in t[c].to_pylist()], dtype=np.int64)[order] for c in ("quality", "toxic")}
    del t, flat
    pa.default_memory_pool().release_unused()
    stage.sweep()
    rest = np.flatnonzero((value["quality"] < 0) & (value["toxic"] < 0))
    heads = {}
    for name, col in (("good", "quality"), ("toxic", "toxic")):
        own = np.flatnonzero(value[col] >= 0)
        if not len(own):
            heads[name] = constant(name == "good")
            continue
        heads[name] = co_train([words[i] for i in own], stats[own], meta[own], value[col][own], [words[i] for i in rest], stats[rest], meta[rest], held[own])
    return heads


def _telling_words(rows: DataFrame, label: str, most: int = WORDS) -> np.ndarray:
    """Of the words of the labelled, not held-out rows, those least independent of the label; `most` reach the driver."""
    own = rows.where(f"{label} is not null and not held")
    n, pos = own.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    if not 0 < pos < n:
        return np.zeros(0, dtype=np.int64)
    share = pos / n
    words = own.select(F.explode("words").alias("w"), F.col(label).alias("y")).groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("p")).where("n >= 3")
    score = F.expr(f"pow(p - n * {share}, 2) / (n * {share * (1 - share)} * greatest(1 - n / {n}, 0.05))")
    top = words.withColumn("score", score).where("score > 4").orderBy(F.desc("score"), "w").limit(most).select("w").toArrow()
    return top["w"].to_numpy()


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, max_unlabelled: int = MAX_UNLABELLED, least_good: float = 0.5, most_toxic: float = 0.5) -> DataFrame:
    """One row per document: doc_id, good, toxic (probabilities), keep (good >= least_good and toxic < most_toxic).

    Two views, the text and the metadata (source, lang, n_chars where the table has them), are co-trained for
    each of both properties on at most max_labelled labelled and max_unlabelled other documents; then all
    documents are scored with calibrated, combined views over their whole texts, in one narrow stage.

    A null or blank text is scored as a text without words. Null metadata are values of their own. Ids may be
    null or repeat, each row is scored for itself; labels that repeat an id count once, for the worse. Without
    labels of two kinds a property is constant; if no label meets a document, good is 0.95 and toxic 0.05. Other columns are
    ignored; an empty table gives an empty table.
    """
    score = _scorer(docs, labels, id_col, text_col, max_labelled, max_unlabelled, least_good, most_toxic)

    def run(batches):
        for b in batches:
            good, toxic, keep = score(b)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(good), pa.array(toxic), pa.array(keep)], names=["doc_id", "good", "toxic", "keep"])

    return _prepared(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, good double, toxic double, keep boolean")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, max_unlabelled: int = MAX_UNLABELLED, least_good: float = 0.5, most_toxic: float = 0.5) -> DataFrame:
    """The rows that classify_quality() keeps, with all their columns, in the same narrow stage."""
    score = _scorer(docs, labels, id_col, text_col, max_labelled, max_unlabelled, least_good, most_toxic)
    names = docs.columns

    def run(batches):
        for b in batches:
            own = {n: b.column(i) for i, n in enumerate(names)}
            none = pa.nulls(b.num_rows, pa.string())
            cols = {"text": own[text_col].cast(pa.string()), **{c: own.get(c, none) for c in _META}}
            yield b.filter(pa.array(score(cols)[2]))

    return docs.mapInArrow(lean(run), docs.schema)


def _scorer(docs, labels, id_col, text_col, max_labelled, max_unlabelled, least_good, most_toxic):
    """A function from columns of a batch to (good, toxic, keep)."""
    spark = docs.sparkSession
    heads = fit_quality(Stage(spark, "quality"), _prepared(docs, id_col, text_col), labels, max_labelled, max_unlabelled)
    shared = spark.sparkContext.broadcast(heads)

    def score(b):
        meta = _meta_keys(b)
        out = {"good": [], "toxic": []}
        for i, j, h, first, stats in text_features(b["text"]):
            owner = np.repeat(np.arange(j - i), np.diff(first))
            for name, head in shared.value.items():
                out[name].append(head.combined(head.text_margin(h, owner, j - i, stats), head.meta_margin(meta[i:j])))
        good, toxic = (np.concatenate(out[k]) if out[k] else np.zeros(0) for k in ("good", "toxic"))
        return good, toxic, (good >= least_good) & (toxic < most_toxic)

    return score
