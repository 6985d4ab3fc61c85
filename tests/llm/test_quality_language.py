import collections
import math
import random
import re
import zlib

import numpy as np

from strandforge.llm.language_id import address_parts, declared_language, identify_languages, visible_text
from strandforge.llm.quality import classify_quality, co_train, keep_quality, text_features
from tests.llm.texts import DOCS, awkward, crowded

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    good = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(n):
        kind = rnd.choice(["good", "good", "junk", "toxic"])
        t = [rnd.choice(good) for _ in range(rnd.randint(8, 60))]
        if kind == "junk":
            t = [rnd.choice(good) + "!!!" for _ in range(5)] * rnd.randint(2, 6)
        if kind == "toxic":
            t[rnd.randrange(len(t))] = rnd.choice(["badword", "worse"])
        rows.append((i, " ".join(t), "en", "s%d" % (i % 3), 5))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in classify_quality(df, spark.createDataFrame(labels[:250], LABELS)).collect()}
    wrong = sum(got[i].keep != (q == 1 and t == 0) for i, q, t in labels[250:])
    assert wrong <= 3
    kept = keep_quality(df, spark.createDataFrame(labels[:250], LABELS))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}


def test_awkward_rows(spark):
    df = crowded(spark.createDataFrame(awkward(), DOCS))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 1, 1), (5, None, None), (9999, 0, 0)], LABELS)
    got = classify_quality(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.good <= 1 and 0 <= r.toxic <= 1 for r in got)
    assert all(r.keep for r in classify_quality(df, labels.limit(0)).collect())
    assert classify_quality(df.limit(0), labels).count() == 0 and keep_quality(df.limit(0), labels).count() == 0
    assert keep_quality(df.drop("lang", "source"), labels.limit(0)).count() == df.count()


def test_co_training_uses_the_pool():
    """The metadata view alone knows a kind of document that has no labels in the text view's words."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 200)
    words = [np.unique(np.array([10 + v, 100 + rng.integers(50)], dtype=np.uint64)) for v in y]
    meta = np.array([[v + 1, 7, 7, 7, 7] for v in y], dtype=np.uint64)
    pool_y = rng.integers(0, 2, 300)
    pool = [np.array([500 + v], dtype=np.uint64) for v in pool_y]
    pool_meta = np.array([[v + 1, 7, 7, 7, 7] for v in pool_y], dtype=np.uint64)
    head = co_train(words, np.zeros((200, 12)), meta, y, pool, np.zeros((300, 12)), pool_meta)
    p = head.combined(head.text_margin(np.array([10, 11], dtype=np.uint64), np.array([0, 1]), 2, np.zeros((2, 12))), head.meta_margin(np.array([[1, 7, 7, 7, 7], [2, 7, 7, 7, 7]], dtype=np.uint64)))
    assert p[0] < 0.1 and p[1] > 0.9
    one = co_train(words, np.zeros((200, 12)), meta, np.ones(200, dtype=int), [], np.zeros((0, 12)), np.zeros((0, 5), dtype=np.uint64))
    assert one.combined(np.zeros(1), np.zeros(1))[0] > 0.9


def test_features_are_per_text():
    import pyarrow as pa

    texts = ["a b a", "", "Same same", "x" * 50]
    (i, j, h, first, stats), = text_features(pa.array(texts))
    assert first.tolist() == [0, 3, 3, 5, 6] and h[3] == h[4] and stats.shape == (4, 12)
    assert stats[0, 1] == 2 / 3 and stats[2, 3] == 0.5 and stats[1, 0] == 0


PAGES = "page_id long, url string, html string"


def test_languages(spark):
    rnd = random.Random(3)
    voc = {"en": ["the", "thing", "shall", "with"], "de": ["der", "schön", "nicht", "einen"], "fr": ["le", "très", "être", "dans"]}
    text = lambda lang, n: " ".join(rnd.choice(voc[lang]) for _ in range(n))
    docs = [(i, text(lang, 80), lang, None, None) for i, lang in enumerate(["en", "de", "fr"] * 20)] + [(900, None, "en", None, None), (901, "x", None, None, None)]
    pages, want = [], {}
    for i in range(120):
        lang = rnd.choice(["en", "de", "fr"])
        pages.append((i, f"http://{lang}{i % 4}.example.net/{lang}/{i}", f'<html lang="{lang}"><script>{text("en", 20)}</script><p>{text(lang, 40)}</p></html>'))
        want[i] = lang
    # wrong declaration: text wins; no text: declaration, suffix and host decide
    pages += [(200, "http://de1.example.net/de/x", f"<html lang='en'><p>{text('de', 60)}"), (201, "http://fr1.example.net/fr/y", '<html lang="fr"></html>'), (202, "http://fr2.example.net/fr/", None), (203, None, f"<p>{text('fr', 50)}</p>"), (None, "odd", ""), (205, "http://de3.example.net/q", "<p></p>")]
    want |= {200: "de", 201: "fr", 202: "fr", 203: "fr", 205: "de"}
    got = {r.page_id: r for r in identify_languages(crowded(spark.createDataFrame(pages, PAGES)), spark.createDataFrame(docs, DOCS)).collect()}
    assert len(got) == len(pages)
    assert {i: got[i].lang for i in want} == want
    assert got[201].text_lang is None and got[200].declared == "en" and 0 < got[None].confidence < 0.9
    nothing = identify_languages(spark.createDataFrame(pages, PAGES), spark.createDataFrame([], DOCS)).collect()
    assert len(nothing) == len(pages) and {r.lang for r in nothing} == {None}
    assert identify_languages(spark.createDataFrame([], PAGES), spark.createDataFrame(docs, DOCS)).count() == 0


def test_page_parts():
    assert visible_text("<p>a&amp;b<!-- x --><style>p{}</style> c</p>").split() == ["a&b", "c"]
    assert address_parts("http://u@A.b.Example.co:80/de/x?y") == ("a.b.example.co", "example.co", "/de")
    assert address_parts("http://x.org/long/") == ("x.org", "x.org", ".org") and address_parts(None) == ("", "", "")


def test_labels_that_meet_no_document(spark):
    rows, _ = corpus(30)
    df = spark.createDataFrame(rows, DOCS)
    for labels in ([(999, 1, 0)], [(1, None, 0)], [(None, 0, 1)]):
        got = classify_quality(df, spark.createDataFrame(labels, LABELS)).collect()
        assert all(r.keep and r.good > 0.9 and r.toxic < 0.1 for r in got)


def test_very_long_pages_take_linear_time():
    import time

    for unit in ("<script ", "<html ", "<!-- ", "<", "</script ", "<style>", "<html lang=" + " " * 50, "&#" + "9" * 50):
        page = unit * (3_000_000 // len(unit))
        begin = time.perf_counter()
        visible_text(page)
        declared_language(page)
        assert time.perf_counter() - begin < 10, unit
    assert visible_text("a<script>b</script >c<!--d-->e<nav>f<b>g") .split() == ["a", "c", "e", "f", "g"]
    assert visible_text("<!--a<script>--> b </script> c").split() == ["b", "c"] and visible_text("&#" + "9" * 5000 + ";") == "\ufffd"
    assert declared_language("<HTML class=x\nLANG = 'De-at'>") == "de" and declared_language("<html><p lang=fr>") == "" == declared_language(None)


def _languages_one_by_one(pages, docs, bits, temper=0.2, strength=8.0):
    """Every sum of the fusion in plain Python; (lang, confidence, text_lang, host) of each page."""

    def buckets(text):
        x = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
        x = [b if 97 <= b <= 122 or b >= 128 else 32 for b in x]
        for a, b, c in zip(x, x[1:], x[2:]):
            if b != 32 or (a != 32 and c != 32):
                yield (a << 16 | b << 8 | c) * 0x9E3779B1 % (1 << 32) >> 32 - bits

    taught = [(t, lang) for _, t, lang, *_ in docs if t is not None and lang is not None]
    langs = sorted({lang for _, lang in taught})
    counts = {lang: collections.Counter(b for t, own in taught if own == lang for b in buckets(t)) for lang in langs}
    size = {lang: sum(c.values()) + 0.5 * (1 << bits) for lang, c in counts.items()}
    seen = []
    for i, url, page in pages:
        ll = [temper * sum(math.log((counts[lang][b] + 0.5) / size[lang]) for b in buckets(visible_text(page))) for lang in langs]
        top = max(ll)
        post = [math.exp(v - top) for v in ll]
        host, domain, suffix = address_parts(url)
        seen.append({"id": i, "ll": ll, "post": [p / sum(post) for p in post], "host": host, "domain": domain, "suffix": suffix, "declared": declared_language(page)})
    n = range(len(langs))
    every = [sum(s["post"][k] for s in seen) for k in n]
    share = [(v + 1) / (sum(every) + len(langs)) for v in every]
    out = []
    for s in seen:
        others = {key: [max(sum(t["post"][k] for t in seen if t[key] == s[key]) - s["post"][k], 0) for k in n] for key in ("host", "domain", "declared", "suffix")}
        domain = [(others["domain"][k] + strength * share[k]) / (sum(others["domain"]) + strength) for k in n]
        host = [(others["host"][k] + strength * domain[k]) / (sum(others["host"]) + strength) for k in n]
        score = [s["ll"][k] + sum(math.log((others[e][k] + 0.5) / (every[k] + 1)) for e in ("declared", "suffix")) + math.log(host[k]) for k in n]
        best = max(score)
        out.append((s["id"], langs[score.index(best)], 1 / sum(math.exp(v - best) for v in score), langs[s["ll"].index(max(s["ll"]))] if max(s["ll"]) > min(s["ll"]) else None, s["host"]))
    return out


def test_languages_equal_brute_force(spark):
    rnd = random.Random(6)
    voc = {"en": ["the", "thing", "shall", "with"], "de": ["der", "schön", "nicht", "einen"], "fr": ["le", "très", "être", "dans"]}
    text = lambda lang, n: " ".join(rnd.choice(voc[lang]) for _ in range(n))
    docs = [(i, text(lang, 30), lang, None, None) for i, lang in enumerate(["en", "de", "fr"] * 7)] + [(50, None, "en", None, None), (51, "x", None, None, None)]
    pages = [(i, rnd.choice([f"http://h{i % 3}.example.{rnd.choice(['de', 'org'])}/{rnd.choice(['en', 'fr', 'x'])}/{i}", None, "odd"]), rnd.choice(["", "<html lang='de'>", "<html lang=EN>", "<script>der</script>"]) + text(rnd.choice(list(voc)), rnd.randint(0, 4))) for i in range(60)]
    pages += [(60, None, None), (61, "http://one/", "&amp;"), (61, "http://one/", "&amp;"), (None, "http://h1.example.de/fr/9", "<p>le")]
    want = _languages_one_by_one(pages, docs, 12)
    got = [(r.page_id, r.lang, r.confidence, r.text_lang, r.host) for r in identify_languages(crowded(spark.createDataFrame(pages, PAGES)), spark.createDataFrame(docs, DOCS), bits=12).collect()]
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert (a[0], a[1], a[3], a[4]) == (b[0], b[1], b[3], b[4]) and math.isclose(a[2], b[2], rel_tol=1e-4), (a, b)


def _quality_one_by_one(heads, rows):
    """Both properties of each document, word after word."""
    from strandforge.llm.common import prefix_hash, span_hash
    from strandforge.llm.quality import _META

    signs = set(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

    def word_key(w):
        buf = np.frombuffer(w, dtype=np.uint8)
        return int(span_hash(prefix_hash(buf), np.array([0]), np.array([len(buf)]))[0])

    out = []
    for _, text, lang, source, size in rows:
        raw = (text or "").encode()
        words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
        bare = [w.strip(bytes(signs)) or w for w in words]
        keys = [word_key(w) for w in bare]
        n, chars = max(len(words), 1), max(len(raw), 1)
        letters = sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in raw)
        distinct = len(set(keys))
        stats = [
            math.log1p(len(words)), distinct / n, math.log1p(n) * distinct / n, sum(a == b for a, b in zip(keys, keys[1:])) / n,
            sum(len(w) - len(b) >= 2 for w, b in zip(words, bare)) / n, sum(all(c in signs for c in w) for w in words) / n, sum(65 <= c <= 90 for c in raw) / max(letters, 1), sum(48 <= c <= 57 for c in raw) / chars,
            sum(c in signs for c in raw) / chars, letters / chars, sum(map(len, words)) / n / 10, float(len(words) < 8),
        ]
        bucket = -1 if size is None else int(math.log2(max(size, 0) + 1) * 2)
        meta = [zlib.crc32(p.encode()) | i << 32 for i, p in enumerate((f"s={source}", f"l={lang}", f"n={bucket}", f"sl={source}|{lang}", f"ln={lang}|{bucket}"))]
        assert _META == ("source", "lang", "n_chars")
        answer = {}
        for name, h in heads.items():
            places = {int(v): k for k, v in enumerate(h.chosen)}
            z = sum((s - c) / d * w for s, c, d, w in zip(stats, *h.scale, h.text[len(h.chosen) : -1])) + h.text[-1] + sum(h.text[places[k]] for k in set(keys) if k in places)
            known = {int(v): k for k, v in enumerate(h.meta_keys)}
            m = sum(h.meta[known[k]] for k in meta if k in known) + h.meta[-1]
            answer[name] = 1 / (1 + math.exp(-(h.mix[0] * z + h.mix[1] * m + h.mix[2])))
        out.append((answer["good"], answer["toxic"], answer["good"] >= 0.5 and answer["toxic"] < 0.5))
    return out


def test_scores_equal_brute_force(spark, monkeypatch):
    import strandforge.llm.quality as Q

    rows, labels = corpus(200, seed=3)
    rows += [(900 + i, t, "en", None, None) for i, t in enumerate([None, "", "...", "(A) b!! b!!", "Été 12 x"])]
    heads = {}
    plain = Q.fit_quality
    monkeypatch.setattr(Q, "fit_quality", lambda *a: heads.update(plain(*a)) or heads)
    got = {r.doc_id: (r.good, r.toxic, r.keep) for r in classify_quality(crowded(spark.createDataFrame(rows, DOCS)), spark.createDataFrame(labels, LABELS)).collect()}
    for row, want in zip(rows, _quality_one_by_one(heads, rows)):
        assert np.allclose(got[row[0]][:2], want[:2], rtol=1e-6) and got[row[0]][2] == want[2], row
