"""Hard negatives, byte-pair encoding and ranked search: brute force, the public library, planted cases."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import bpe, hardneg, ranked

from .conftest import LONG

# -------------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, label int, vector array<long>, key int, score string, mean string"


def brute_negatives(rows, n_pos=5, n_neg=10, low=30, high=90):
    """Expected (anchor, positive, rank, negative, positive score, negative score) rows."""
    width = max([len(v) for _, _, v in rows], default=0)
    rows = [(i, la, np.array([*v, *[0] * (width - len(v))], dtype=object)) for i, la, v in rows]
    out = []
    for a, la, va in rows:
        if a % 10:
            continue
        scored = [(-int(va @ v) if width else 0, i, lb) for i, lb, v in rows if i != a]
        for p, pid, _ in sorted(s for s in scored if s[2] == la)[:n_pos]:
            fit = sorted((n, i) for n, i, lb in scored if lb != la and low * -p <= 100 * -n <= high * -p)
            out += [(a, pid, r, i, -p, -n) for r, (n, i) in enumerate(fit[:n_neg], 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "s", "m") for r in rows], VECTORS)
    out = hardneg.mine(df, F.col("vec_id") % 10 == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("width,top", [(20, 60), (64, 200), (3, 5), (16, 1 << 24)])
def test_negatives_against_brute_force(spark, width, top):
    rng = np.random.default_rng(width)
    rows = [(i, int(rng.integers(3)), rng.integers(-top // 4, top, width).tolist()) for i in range(150)]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, rows, n_pos=2, n_neg=3, group=4) == brute_negatives(rows, 2, 3)  # several groups of anchors


def test_negatives_of_equal_vectors(spark):
    """A third of the rows is one vector: ties by id, also over many blocks and tasks."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, [9, 9, 9] if i % 3 else rng.integers(0, 10, 3).tolist()) for i in range(300)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_edges(spark):
    ok = [(0, 1, [3, 4]), (10, 2, [5]), (11, 1, [1, 1, 1]), (12, 2, [2, 2]), (13, 2, []), (20, 7, [9, 9]), (30, 3, [-5, 1]), (31, 3, [5, 1])]
    none = [(None, 1, [1, 1]), (14, None, [1, 1]), (15, 1, None), (16, 1, [1, None])]
    expected = brute_negatives(ok)
    assert expected and mined(spark, ok + none) == expected
    assert mined(spark, ok + none + [ok[2], ok[2], (12, 3, [0]), (12, 2, [7, 7])]) == expected  # least (label, vector) of an id
    assert mined(spark, []) == [] and mined(spark, none) == [] and mined(spark, [(10, 1, [1])]) == []


def test_bounds_hold_every_score():
    rng = np.random.default_rng(0)

    def rows(n):
        x = rng.integers(-300, 300, (n, 32)).astype(np.int32)
        parts = [x.reshape(n, s, -1) for s in hardneg.SEGMENTS]
        out = object.__new__(hardneg.Rows)
        out.x, out.top = x, 300
        out.mean = np.concatenate([p.mean(axis=2) for p in parts], axis=1)
        out.dev = np.concatenate([p.std(axis=2) for p in parts], axis=1)
        return out

    a, b, widths = rows(40), rows(50), []
    exact = a.x.astype(int) @ b.x.T.astype(int)

    def useful(i, lower, upper):
        assert i is None and (lower <= exact).all() and (exact <= upper).all()
        widths.append((upper - lower).mean())
        return np.ones(lower.shape, bool)

    i, j, score = hardneg.close_pairs(a, b, np.ones((40, 50), bool), useful)
    assert (score == exact[i, j]).all() and len(score) == 2000
    assert widths[1] < 0.9 * widths[0]  # finer segments narrow the interval


def test_bounds_drop_pairs():
    """Smooth vectors: most pairs fall at the segments and are never scored."""
    rng = np.random.default_rng(1)
    x = np.repeat(rng.integers(-100, 100, (200, 16)), 4, axis=1).astype(np.int32)
    t = object.__new__(hardneg.Rows)
    parts = [x.reshape(200, s, -1) for s in hardneg.SEGMENTS]
    t.x, t.top = x, 100
    t.mean = np.concatenate([p.mean(axis=2) for p in parts], axis=1)
    t.dev = np.concatenate([p.std(axis=2) for p in parts], axis=1)
    exact = x.astype(int) @ x.T.astype(int)
    least = np.sort(exact, axis=1)[:, -5].astype(float)
    i, j, score = hardneg.close_pairs(t, t, np.ones((200, 200), bool),
                                      lambda i, lo, up: up >= (least[:, None] if i is None else least[i]))
    assert len(score) < 0.05 * 40_000 and (score >= least[i]).sum() == (exact >= least[:, None]).sum()


# ---------------------------------------------------------------- byte-pair encoding

@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return bpe.Vocabulary.read(tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def test_every_character_as_the_library(vocabulary, library):
    encoder = bpe.Encoder(vocabulary)
    for start in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)}1 {chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sdtmlre  \n\t\r1234é中ñ….,!? \u0085\x1c😀<|>endoftx")) | st.text() | st.just("x<|endoftext|> y"))
def test_texts_as_the_library(vocabulary, library, text):
    encoder = bpe.Encoder(vocabulary)
    found = ids_of(encoder, text)
    assert found == library.encode(text, add_special_tokens=False).ids
    assert encoder.decode(np.array(found, np.int64)) == library.decode(found, skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256)))
def test_any_ids_decode_as_the_library(vocabulary, library, ids):
    assert bpe.Encoder(vocabulary).decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_long_words_and_full_memo(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 10)
    encoder = bpe.Encoder(vocabulary)
    rng = random.Random(0)
    text = " ".join("".join(rng.choices("abcdeé", k=k)) for k in range(60)) + " " + "xyab" * 50_000
    assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.memo) <= 10


def test_merges_skip_stale_pairs():
    """aa before ab: the queued (a, b) is stale once its a is merged away."""
    vocabulary = bpe.Vocabulary([0] * 97 + [1, 2] + [0] * 157, {(1, 1): 0, (1, 2): 1, (3, 2): 2}, [3, 4, 5], {})
    assert bpe.merge_word(vocabulary, b"aab") == [5]
    assert bpe.merge_word(vocabulary, b"aaab") == [3, 4]
    assert bpe.merge_word(vocabulary, b"") == []


def test_encode_and_decode_frames(spark, vocabulary, library, edge_docs, edge_rows, no_docs):
    docs = edge_docs.withColumn("ids", F.lit("clash"))
    out = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    assert out.columns == [*docs.columns, "decoded"]
    expected = sorted(repr((i, library.encode(t or "", add_special_tokens=False).ids, t or "")) for i, t, _, _ in edge_rows)
    assert sorted(repr(tuple(r)) for r in out.select("doc_id", "ids", "decoded").collect()) == expected
    assert bpe.decode(bpe.encode(no_docs, vocabulary), vocabulary).collect() == []
    odd = spark.createDataFrame([(None,), ([],), ([-1, 99999999],), ([31373],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, vocabulary).collect()] == ["", "", "", "hello"]


def test_other_vocabularies_are_refused(tmp_path):
    tokenizers = pytest.importorskip("public_tokenizers")
    with pytest.raises(ValueError):
        bpe.Vocabulary.read(tokenizers.path("word_bpe_49k.json"))


# --------------------------------------------------------------------- ranked search

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k=10):
    """Expected (item_id, rank, doc_id, score) rows of (doc_id, text) and (item_id, text)."""
    def terms(t):
        return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(t or "")]

    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c in counted:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
                        for w in set(terms(text)) if w in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, **kw):
    out = ranked.search(docs, spark.createDataFrame(items, "item_id long, text string"), **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_search_against_brute_force(spark, make_docs, monkeypatch, seed):
    monkeypatch.setattr(ranked, "SHARD_DOCS", 40)
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(4000)]
    docs = [(rng.randrange(400), " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for _ in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 20)))) for i in range(30)] + [(7, docs[7][1])] * 2
    df = make_docs([(d, t, "en", "a") for d, t in docs]).repartition(3)
    expected = brute_search(docs, items)
    assert searched(spark, df, items) == expected
    assert searched(spark, df, items, block_terms=50) == expected  # several blocks of items
    assert searched(spark, df, items, k=1) == brute_search(docs, items, 1)


def test_search_of_equal_documents(spark, make_docs):
    """Hundreds of copies tie at the k-th place: the smallest ids come first."""
    docs = [(i, "Alpha beta, GAMMA!" if i % 3 else f"alpha x{i} beta") for i in range(600)]
    items = [(1, "alpha BETA gamma"), (2, "beta"), (3, "x3 x6 unknown")]
    assert searched(spark, make_docs([(d, t, "en", "a") for d, t in docs]), items) == brute_search(docs, items)


def test_search_edges(spark, make_docs, edge_docs, edge_rows, no_docs):
    items = [(1, LONG), (None, "École WORD1"), (2, None), (3, "?!"), (4, "word19999"), (4, "short"), (5, "")]
    docs = [(i, t) for i, t, _, _ in edge_rows]
    assert searched(spark, edge_docs, items) == brute_search(docs, items)
    assert searched(spark, no_docs, items) == [] and searched(spark, edge_docs, []) == []


def test_nra_reads_little_of_skewed_lists():
    rng = np.random.default_rng(0)
    n, lists = 5000, []
    for t in range(12):
        docs = rng.permutation(n)[:2000]
        impacts = np.sort((rng.pareto(1.0, 2000) * 100).astype(np.int64) + 1)[::-1]
        lists.append((docs, impacts))
    total = np.zeros(n, np.int64)
    for docs, impacts in lists:
        total[docs] += impacts
    expected = np.lexsort((np.arange(n), -total))[:10]
    found, scores, _ = ranked.nra(lists, n, 10)
    assert found.tolist() == expected.tolist() and scores.tolist() == total[expected].tolist()
    top = [(np.arange(10), np.full(10, 10**6)), (np.arange(10), np.full(10, 10**6)), (rng.permutation(n), np.sort(rng.integers(1, 99, n))[::-1])]
    assert ranked.nra(top[:2] + [(top[2][0][top[2][0] >= 10], top[2][1][:n - 10])], n, 10)[0].tolist() == list(range(10))


def test_nra_leaves_lists_unread():
    """Members seen in every list are settled before the long tails are read."""
    lists = [(np.arange(1000), np.r_[np.full(10, 10**6 - t), np.full(990, 1 + t)]) for t in range(3)]
    found, _, read = ranked.nra(lists, 1000, 10)
    assert found.tolist() == list(range(10)) and read == 30


def test_terms_of_pieces(monkeypatch):
    text = "Ab-cd éÉ x1 " * 500 + "z" * 3000
    whole = ranked.term_counts(text)
    monkeypatch.setattr(ranked, "_PIECE", 7)
    assert ranked.term_counts(text) == whole and whole[b"ab"] == 500 and whole["éÉ".encode()] == 500
