"""The pipeline's stages against brute force on one small corpus."""

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_decontamination import brute_literal
from tests.llm.test_ngram_join import brute as groups
from tests.llm.test_quality_language import LABELS, corpus
from tests.llm.texts import DOCS, words


def tables(spark, top):
    rnd = random.Random(9)
    rows, labels = corpus(300, seed=4)
    n = len(rows)
    clean = [(n + i, words(rnd, rnd.randint(40, 90), 4000), "en", "s1", 9) for i in range(40)]
    clean += [(n + 100 + i, clean[i][1] + " tail", "en", "s2", 9) for i in range(10)]
    shared = "\n".join(f"shared line {k} of the footer" for k in range(12))
    clean += [(n + 200 + i, words(rnd, 50, 4000) + "\n" + shared, "de", "s0", 9) for i in range(6)]
    items = [(k, words(rnd, 20, 4000)) for k in range(5)]
    clean += [(n + 300 + k, words(rnd, 30, 4000) + " " + t + " " + words(rnd, 9, 4000), "en", "s1", 9) for k, t in items]
    clean += [(n + 400, None, None, None, None), (n + 401, "", "en", "s1", 0)]
    docs = [r for r in rows if len(r[1].split()) > 7] + clean
    spark.createDataFrame(docs, DOCS).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return docs, {i: (q, t) for i, q, t in labels}, items


def test_stages(spark, tmp_path):
    docs, labels, items = tables(spark, str(tmp_path))
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {}
    for name, step in P.STAGES:
        df = step(spark, df, str(tmp_path))
        df.write.parquet(f"{tmp_path}/out-{name}")
        df = spark.read.parquet(f"{tmp_path}/out-{name}")
        out[name] = df
        if name != "packing":
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    read = lambda n: {r.doc_id: r.text for r in out[n].collect()}

    kept = read("quality")
    good = {i for i, (q, t) in labels.items() if q == 1 and t == 0} & {d[0] for d in docs}
    bad = {i for i in labels if i in {d[0] for d in docs}} - good
    assert len(good - set(kept)) <= 2 and len(bad & set(kept)) <= 2

    lined = read("lines")
    assert all(lined[i] == t for i, t in kept.items() if i in lined and (t is None or "\n" not in t))
    footers = [i for i, t in lined.items() if t and "shared line 5 of the footer" in t]
    assert len(footers) <= 1 or sum("shared line" in (lined[i] or "") for i in lined) < 6 * 12
    assert set(kept) - set(lined) <= {i for i, t in kept.items() if t and t.strip()}

    single = read("near_duplicates")
    _, comps = groups([(i, t, None, None, None) for i, t in lined.items()])
    assert set(single) == {i for i, c in comps.items() if i == c} and len(single) < len(lined)

    clean = read("decontamination")
    leaks = {d for d, _ in brute_literal(list(single.items()), items)}
    assert set(single) - set(clean) == leaks and len(leaks) == 5

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    got = {r.doc_id: r.n for r in out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == total
    whole = P.run(spark, str(tmp_path))
    assert whole.select("doc_id", "start", "length", "ids_crc32").exceptAll(out["packing"].select("doc_id", "start", "length", "ids_crc32")).count() < 5
    assert whole.agg(F.sum("length")).first()[0] == sum(total.values())


def test_empty_documents(spark, tmp_path):
    tables(spark, str(tmp_path))
    df = spark.createDataFrame([], DOCS)
    for _, step in P.STAGES:
        df = step(spark, df, str(tmp_path))
        assert df.count() == 0


def test_awkward_rows(spark, tmp_path):
    """Null ids, rows that repeat an id, null and long texts, and columns named as the operators name theirs."""
    from tests.llm.texts import awkward, crowded

    tables(spark, str(tmp_path))
    rnd = random.Random(3)
    item = spark.read.parquet(f"{tmp_path}/benchmark.parquet").first().text
    rows = awkward(5, 60) + [(3, "another text of a repeated id " + words(rnd, 40), None, None, None), (None, None, None, None, None), (None, words(rnd, 60), None, None, None), (700, words(rnd, 30000), "en", "s0", 1), (701, "x " + item, None, None, None), (701, words(rnd, 50), None, None, None)]
    df = crowded(spark.createDataFrame(rows, DOCS)).withColumn("spots", F.array(F.lit(1)))
    cols, n = df.columns, {}
    for name, step in P.STAGES:
        df = step(spark, df, str(tmp_path))
        df.write.parquet(f"{tmp_path}/awkward-{name}")
        df = spark.read.parquet(f"{tmp_path}/awkward-{name}")
        n[name] = df.count()
        if name != "packing":
            assert df.columns == cols
            assert df.where("n = 7 and `row` = 7 and DOC = 7").count() == n[name]
        if name == "near_duplicates":
            ids = [r.doc_id for r in df.collect()]
            assert ids.count(3) == 2 and None in ids
        if name == "decontamination":
            # rows of one id are one document here: both go if one holds an item
            assert df.where("doc_id = 701").count() == 0
    assert 0 < n["decontamination"] < n["near_duplicates"] <= n["lines"] <= n["quality"] <= len(rows)


def test_entry_has_all():
    import __spark_entry__ as e

    q = e.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {k.split("_")[0] + "_" for k in q if k.startswith("op")} and "pipeline" in q
