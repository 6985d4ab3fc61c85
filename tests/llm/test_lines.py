import hashlib
import random
from pathlib import Path

import duckdb
import pytest

from strandforge.llm import line_dedup
from tests.llm.texts import DOCS, crowded


def table(seed):
    rnd = random.Random(seed)
    blocks = [[" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(rnd.randint(1, 8))) for _ in range(rnd.randint(2, 9))] for _ in range(12)]
    long = ["long line " + "x" * 250, "another long line " + "y" * 300]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 4)):
            lines += rnd.choice(blocks) if rnd.random() < 0.6 else [f"own {rnd.random()}"] * rnd.randint(1, 2)
            if rnd.random() < 0.2:
                lines.append(rnd.choice(long))
        rows.append((i, "\n".join(lines), "en", "s", len("\n".join(lines))))
    return rows + [(100, "", None, None, 0), (101, "\n\n\n", None, None, 3), (102, None, None, None, None), (103, "\n", None, None, 1), (104, "é" * 210, None, None, 210), (105, "é" * 210, None, None, 210), (None, rows[0][1], None, None, 0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_sql(spark, tmp_path, seed):
    df = spark.createDataFrame(table(seed), DOCS).coalesce(1)
    df.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{next(Path(tmp_path / 'd').glob('*.parquet'))}'")
    want = sorted(con.sql(line_dedup.ORACLE).fetchall(), key=str)
    want = sorted(((c if c is None else c, *r) for c, *r in want), key=str)
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(crowded(df)).select("doc_id", "text", "n_lines", "removed_lines").collect()), key=str)
    assert got == want
    assert sum(r[3] for r in got) > 10


def test_boundaries_resist_shifts(spark):
    rnd = random.Random(5)
    body = [f"line {rnd.random()} of the text" for _ in range(40)]
    rows = [(1, "\n".join(body), "", "", 0), (2, "\n".join(["new one", "new two"] + body[:20] + ["in between"] + body[20:]), "", "", 0)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}

    def chunks(lines):
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        ends = [i for i in range(len(h)) if i == len(h) - 1 or ((h[i - 1] if i else 0) * 31 + h[i]) % line_dedup.DIVISOR == 0]
        return [tuple(lines[a + 1 : b + 1]) for a, b in zip([-1, *ends], ends)]

    one, two = chunks(rows[0][1].split("\n")), chunks(rows[1][1].split("\n"))
    again = [c for c in two if c in one]
    assert len(again) >= len(one) - 4  # two insertions touch two chunks each at most
    assert got[1].removed_lines == 0 and got[2].removed_lines == sum(len(c) for c in again if len(c) > 1) > 0
    assert {"new one", "new two", "in between"} <= set(got[2].text.split("\n"))


def test_documents_keep_their_columns(spark):
    rows = [(1, "a b\n" + "x" * 250, "en", "s", 254), (2, "x" * 250 + "\nown words", "de", "t", 260), (3, "x" * 250, "fr", "u", 250), (4, "", "fr", "u", 0), (None, "x" * 250, None, None, 250)]
    got = line_dedup.dedup_documents(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], (2, "own words", "de", "t", 9), rows[3], rows[4]], key=str)
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0 and line_dedup.dedup_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame(table(1), DOCS)
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_ids_keep_what_stands_nowhere_else(spark):
    shared, own = "x" * 250, "y" * 250
    rows = [(1, shared, None, None, 0), (2, shared, None, None, 0), (2, own, None, None, 0), (3, own + "\n" + shared, None, None, 0), (3, own + "\n" + shared, None, None, 0)]
    got = sorted((r.doc_id, r.text, r.removed_lines) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(1, shared, 0), (2, "", 1), (2, own, 0), (3, "", 2), (3, "", 2)]
