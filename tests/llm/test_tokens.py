import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strandforge.llm.packing import pack_documents, shortest_pack_first
from strandforge.llm.ragged_bpe import load
from strandforge.llm.token_counts import token_counts
from tests.llm.texts import DOCS, awkward, crowded

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_merging_equals_the_library(library):
    rnd = random.Random(1)
    parts = ["'s", "'t", "'re", "'", "a", "aa", "THE", "é", "é", "İ", "Σ", "ς", " ", "\n", " ", "1", "23", "!", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "ß", "'LL", "\x1c", "\x85", "the ", " of", "中文", "ﬁ", "ǅ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + ["", " ", "x" * 20000, "ab" * 9000]
    texts += ["a" + chr(c) + "b" + chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    bpe = load(PATH)
    assert [list(map(int, x)) for x in bpe.encode(texts)] == want
    assert bpe.counts(texts).tolist() == [len(x) for x in want]


def test_merges_only_make_later_ranks():
    """What lets equal pairs merge in one step: no merge can use a token that a later rank makes."""
    bpe = load(PATH)
    made = {int(m): int(r) for r, m in zip(bpe.ranks, bpe.made)}
    assert len(made) == len(bpe.made)
    assert all(max(made.get(int(k) >> 20, -1), made.get(int(k) & 0xFFFFF, -1)) < r for k, r in zip(bpe.keys, bpe.ranks))


def test_token_counts(spark, library):
    rows = awkward()
    got = token_counts(crowded(spark.createDataFrame(rows, DOCS)), PATH, limit=100).collect()
    want = sorted(((i if i is not None else -1), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts(spark.createDataFrame([], DOCS), PATH).count() == 0


def check(pieces, ids, width):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        x = ids[r.doc_id]
        assert r.doc_tokens == len(x) and r.length > 0
        assert bytes(r.ids) == struct.pack(f"<{r.length}I", *x[r.start : r.start + r.length])
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d, x in ids.items():
        at = 0
        for s, n in sorted(by_doc[d]):
            assert s == at
            at += n
        assert at == len(x)
    padding = 0
    for spans in by_seq.values():
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
        assert at <= width
        padding += width - at
    assert padding < width


@pytest.mark.parametrize("width", [16, 64, 4096])
def test_packing_round_trip(spark, library, width):
    rows = awkward()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t, *_ in rows}
    check(pack_documents(crowded(spark.createDataFrame(rows, DOCS)).repartition(5), PATH, width=width).collect(), ids, width)


def test_packing_of_nothing(spark):
    assert pack_documents(spark.createDataFrame([], DOCS), PATH).count() == 0
    one = pack_documents(spark.createDataFrame([(1, None, None, None, None)], DOCS), PATH).collect()
    assert [(r.start, r.length, bytes(r.ids)) for r in one] == [(0, 1, struct.pack("<I", 2))] and zlib.crc32(bytes(one[0].ids)) > 0


def test_plan_is_bounded_by_the_width():
    rnd = random.Random(2)
    sizes = []
    for scale in (10, 1000, 10**6, 10**9):
        packs, plan = shortest_pack_first({k: rnd.randint(0, scale) for k in range(1, 256)}, 256)
        sizes.append(len(plan))
        assert all(0 <= p[1] < p[2] and p[4] > 0 for p in plan)
    assert max(sizes) < 20 * 256


def test_words_of_one_hash_are_told_apart(library):
    """The Thue-Morse word of 4,096 letters and its complement have one polynomial hash modulo 2^64."""
    t = "a"
    for _ in range(12):
        t += t.translate(str.maketrans("ab", "ba"))
    other = t.translate(str.maketrans("ab", "ba"))
    texts = [f"{t} {other} x {t}", other, f"{other} {t}"]
    bpe = load(PATH)
    assert [list(map(int, x)) for x in bpe.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_repeated_ids_are_documents_of_their_own(spark):
    rows = [(1, "a b c", None, None, None), (1, "a b c", None, None, None), (1, "other words", None, None, None), (None, "x", None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(r.n_tokens for r in token_counts(df, PATH).collect()) == [1, 2, 3, 3]
    pieces = pack_documents(df, PATH).collect()
    assert sum(r.length for r in pieces) == 1 + 2 + 3 + 3 + 4 and len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)
