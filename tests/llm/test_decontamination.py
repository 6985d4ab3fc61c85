import random
import re

from strandforge.llm.decontamination import benchmark_leaks
from tests.llm.texts import DOCS, awkward, crowded

ITEMS = "item_id long, text string"
Q = "If Alice has 12 apples and gives 5 kg of them to Robert, how many apples does Alice keep after 12 days of waiting"


def leaks(spark, docs, items, **k):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in benchmark_leaks(crowded(d), crowded(spark.createDataFrame(items, ITEMS)), **k).collect()}


def test_templates_and_slots(spark):
    docs = [
        (1, "Now: " + Q.replace("12", "77").replace("Alice", "Maria").replace("Robert", "Tom").replace("5 kg", "9 lb")),
        (2, Q.replace("after 12", "after 13")),
        (3, "see " + Q.upper() + " end"),
        (4, "say short item one two three here"),
        (5, None), (6, ""), (None, Q),
        (7, "Some other text with 12 numbers of 5 kg and no question of that kind at all in it"),
        (8, "“" + Q + "”!"),
    ]
    got = leaks(spark, docs, [(1, Q), (2, "short item one two three"), (3, "too short"), (4, None), (None, Q), (5, "")])
    assert set(got) == {(1, 1), (3, 1), (4, 2), (8, 1)} | ({(2, 1)} & set(got))
    assert not got[1, 1].exact and got[3, 1].exact and got[8, 1].exact and got[4, 2].tokens == 5
    # different values for one slot: only windows that hold no conflict could speak for it, and none of them agrees throughout
    assert (2, 1) not in got


def brute_literal(docs, items, size=10):
    tok = lambda t: [w for w in (re.sub(r"^[^0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff]+$", "", x) for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) if w]
    found = set()
    for i, t in items:
        w = tok(t)
        n = min(size, len(w))
        if n < 5:
            found |= {(d, i) for d, x in docs if w and any(tok(line) == w for line in (x or "").split("\n"))}
            continue
        wins = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for d, x in docs:
            y = tok(x)
            if any(tuple(y[k : k + n]) in wins for k in range(len(y) - n + 1)):
                found.add((d, i))
    return found


def test_equals_brute_force_on_words(spark):
    """Texts without numbers' slots or names: the literal windows alone decide."""
    docs = [(i, (t or "").lower() if t is not None else None) for i, t, *_ in awkward(3) if i is not None]
    items = [(k, " ".join((t or "").split()[2:20])) for k, (_, t) in enumerate(docs) if k % 7 == 0]
    docs = [(i, t) for i, t in docs]
    got = set(leaks(spark, docs, items))
    assert brute_literal(docs, items) == got and len(got) > 10


def test_empty_sides(spark):
    d, b = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert benchmark_leaks(d, b).count() == 0
    assert benchmark_leaks(spark.createDataFrame([(1, Q, None, None, None)], DOCS), b).count() == 0


def test_rows_before_a_text_do_not_matter(spark):
    """A number at the end of a text makes no unit of the first word of the next."""
    item = "in the box there were seven cats and one very old dog"
    alone = leaks(spark, [(2, item)], [(1, item)])
    assert set(alone) == {(2, 1)} == set(leaks(spark, [(1, "the number is 5"), (2, item)], [(1, item)]))
    got = benchmark_leaks(spark.createDataFrame([(1, "ends with 5"), (2, item), (3, "5"), (4, item)], "doc_id long, text string").coalesce(1), spark.createDataFrame([(1, item)], ITEMS))
    assert {r.doc_id for r in got.collect()} == {2, 4}


def test_short_items_are_whole_lines(spark):
    items = [(1, "forty two"), (2, "Yes."), (3, "four words stand here"), (4, "...")]
    docs = [(1, "the answer is forty two today"), (2, "what is it?\nForty two!\nthanks"), (3, "yes"), (4, "oh yes"), (5, "four words\nstand here"), (6, "four words stand here\nand more"), (7, "forty\ntwo"), (8, "...")]
    assert set(leaks(spark, docs, items)) == {(2, 1), (3, 2), (6, 3)}


def brute_templates(docs, items, size=10, least=5):
    """Windows of words with numbers, units and names replaced, compared one by one; slots must agree on each diagonal."""
    from strandforge.llm.decontamination import UNITS

    def tokens(t):
        out, opens = [], True
        for line in t.split("\n"):
            opens = True
            for raw in re.split(r"[\x20\x09\x0B-\x0D]+", line):
                w = re.sub(r"^[^0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff]+$", "", raw)
                if not w:
                    continue
                kind = "#" if w[0].isdigit() else "unit" if w.lower() in UNITS and out and out[-1][1] == "#" else "name" if w[0].isupper() and not opens and not (len(w) > 1 and w[1].isupper()) else None
                out.append((w.lower(), kind))
                opens = raw[-1] in ".!?:"
        return out

    found = {}
    for i, t in items:
        x = tokens(t)
        for d, u in docs:
            y = tokens(u)
            for shift in range(-len(x), len(y)):
                slots, windows, exact = {}, 0, True
                for k in range(len(x) - size + 1):
                    if not 0 <= k + shift <= len(y) - size:
                        continue
                    a, b = x[k : k + size], y[k + shift : k + shift + size]
                    literal = [w for w, _ in a] == [w for w, _ in b] and [q for _, q in a] == [q for _, q in b]
                    form = lambda z: [q or w for w, q in z]
                    if literal or (form(a) == form(b) and any(q for _, q in a) and sum(not q for _, q in a) >= least):
                        windows += 1
                        for (v, q), (w, _) in zip(a, b):
                            if q:
                                slots.setdefault(v, set()).add(w)
                if windows and all(len(v) == 1 for v in slots.values()):
                    exact = all(v == {k} for k, v in slots.items())
                    n, e = found.get((d, i), (0, False))
                    found[d, i] = max(n, windows), e or exact
    return found


def test_templates_equal_brute_force(spark):
    rnd = random.Random(8)
    names, units = ["Alice", "Bob", "Maria", "Tom"], ["kg", "lb", "km", "miles"]
    frames = ["{n} has {a} {u} of flour and gives {b} {v} to {m}. How many {u} does {n} keep of the {a} after this?", "a train with {a} cars leaves at {b} and {n} waits {a} hours for {m} near the old station of the town"]
    fill = lambda f: f.format(n=rnd.choice(names), m=rnd.choice(names), a=rnd.randint(1, 9), b=rnd.randint(10, 30), u=rnd.choice(units), v=rnd.choice(units))
    items = [(k, fill(frames[k % 2])) for k in range(4)]
    docs = [(k, f"some words before {k}: " + fill(rnd.choice(frames)) + " and after") for k in range(40)]
    docs += [(100 + k, items[k % 4][1].replace("after this", f"after {k} more")) for k in range(8)]
    got = {k: (r.windows, r.exact) for k, r in leaks(spark, docs, items).items()}
    assert got == brute_templates(docs, items) and 20 < len(got) < 150
