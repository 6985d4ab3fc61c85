"""Small tables with awkward rows."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n, vocab=400):
    return " ".join(f"w{int(vocab * rnd.random() ** 2)}" for _ in range(n))


def awkward(seed=1, n=80):
    """Random documents, exact and near copies, ties, short, blank, null and very long texts."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(words(rnd, rnd.choice([1, 3, 4, 5, 6, 30, 120])))
    for k in range(25):
        base = rows[rnd.randrange(n)].split()
        for _ in range(rnd.choice([0, 1, 2, 6])):
            base[rnd.randrange(len(base))] = f"x{rnd.randrange(1000)}"
        rows.append(" ".join(base))
    rows += [rows[5]] * 6 + [rows[5].upper(), "  " + rows[6].replace(" ", "\t\n ") + " "]
    rows += ["", "   \n\t", None, None, "a" * 5000, "é ñ ü 中文 " * 50, words(rnd, 6000), "a a a a a a a", "The\x0bend\x0cof\rall"]
    out = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", None]), None if t is None else len(t)) for i, t in enumerate(rows)]
    out.append((None, rows[7], "en", "s1", 3))
    return out


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def crowded(df):
    """The same table with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(7) for c in ("component_id", "a", "b", "n", "gram", "pos", "rank", "part", "ids", "lines", "ends", "gone", "row", "good", "keep", "h", "task", "size", "key", "DOC", "id", "value")})
