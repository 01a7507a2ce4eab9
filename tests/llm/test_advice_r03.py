"""Findings of the second review, each as a case: ties, system turns, neutral pairs, odd columns."""

from __future__ import annotations

import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from vigil.llm import chat, decontam, fm, mixing, pii, simhash

from .conftest import as_set


# ----------------------------------------------------------------------------- mixing

def mixed(spark, rows, partitions=5, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
    report = mixing.mix_report(df, [1.0], **kw).toPandas()
    assert mixing.mix(df, [1.0], **kw).count() == (report.taken / report["size"].where(report["size"] > 0)).sum()
    return report


@pytest.mark.parametrize("share", [0.5, 0.37, 1.0, 1.25])
def test_equal_rows_are_taken_up_to_the_target(spark, share):
    out = mixed(spark, [(1, "one two three four five six seven eight nine ten", "a")] * 400, share=share, max_epochs=2.0)
    assert abs(out.taken.sum() - 4000 * share) <= 5 and out.taken.max() <= 20


def test_ties_beside_other_rows(spark):
    """A group of equal rows among others: only the tied group at the cut is split."""
    rows = [(7, "a b c d", "s")] * 300 + [(i, f"w{i} " * (i % 9 + 1), "s") for i in range(300)] + [(None, f"n{i} x", "s") for i in range(200)]
    total = sum(len(t.split()) for _, t, _ in rows)
    for share in (0.2, 0.45, 0.7, 0.9):
        out = mixed(spark, rows, share=share, max_epochs=2.0)
        assert abs(out.taken.sum() - share * total) <= 9
        again = mixing.mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string"), [1.0], share=share)
        assert sorted(again.toPandas().taken) == sorted(out.taken)


# ------------------------------------------------------------------------- system turns

@pytest.mark.parametrize("length", [100, 3_600, 20_000])
def test_every_later_window_has_the_system_turn(spark, length):
    system = "s" * length
    turns = [(1, 0, "system", system)] + [(1, k, "user" if k % 2 else "assistant", f"{k} " + "t" * 900) for k in range(1, 30)]
    windows = chat.format_windows(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")).orderBy("window")
    rows = windows.collect()
    assert len(rows) > 2 and all(chat.parse(r.text)[0] == ("system", system) for r in rows)
    for r in rows:
        fresh = chat.parse(r.text)[r.n_context:]
        assert r.over_budget == (r.n_tokens > chat.BUDGET) and (not r.over_budget or len(fresh) <= 1 or r.window == 0)
    back = chat.read_back(windows.orderBy(F.rand(3)).repartition(3)).first()  # in any order
    assert back.n_turns == 30


# ------------------------------------------------------------------------ neutral pairs

@pytest.mark.parametrize("n", [400, 4000])
def test_a_pair_of_neutral_terms_at_production_defaults(n):
    """Each term is in half of the toxic and half of the clean texts; only together they are toxic."""
    rng = np.random.default_rng(n)
    texts, labels = [], []
    for i in range(n):
        words, half = set(rng.integers(10, 3000, 40).tolist()), rng.random() < 0.5
        words |= ({3, 5} if half else set()) if i % 2 else ({3} if half else {5})
        texts.append(np.array(sorted(words)))
        labels.append(i % 2)
    model = fm.fit(texts, np.array(labels))
    alone = fm.associated(np.array([3, 5]), *[np.array([sum(t in x for x, y in zip(texts, labels) if y >= least) for t in (3, 5)], float)
                                              for least in (0, 1)], sum(labels), n - sum(labels), 10.0)
    assert len(alone) == 0  # no linear screen would keep them
    score = [model.score(np.array(t)) for t in ([3, 5], [3], [5])]
    assert score[0] >= 0.7 and max(score[1:]) < 0.5


def test_noise_has_no_pairs():
    rng = np.random.default_rng(0)
    rows = np.repeat(np.arange(2000), 60)
    flat = rng.integers(0, 300, len(rows))
    cells = np.unique(np.stack([rows, flat]), axis=1)
    assert len(fm.paired(cells[1], cells[0], rng.integers(0, 2, 2000).astype(float), np.arange(300), 7.0)) == 0


# -------------------------------------------------------------------------- odd columns

def test_dotted_and_map_columns(spark):
    rows = [(1, "some words of a text", {"a": 1}, "x"), (2, "some words of a text", {"b": 2}, "y"), (3, "quite another one", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.m` map<string, int>, `a.b` string")
    assert as_set(simhash.deduplicate(docs), "doc_id") == [(1,), (3,)]
    items = spark.createDataFrame([(1, "quite another one")], "item_id long, text string")
    assert as_set(decontam.decontaminate(docs, items), "doc_id") == [(1,), (2,)]


# ------------------------------------------------------------------------------- PII

def replaced(make_docs, *texts):
    out = {r.doc_id: r for r in pii.replace(make_docs([(k, t, "en", "a") for k, t in enumerate(texts)]), "k").collect()}
    return [(out[k].text, out[k].n_entities) for k in range(len(texts))]


SECRETS = ["password=4111111111111111xyzSECRETtail", "token: 12345678901234abcdefabcdefabcdefabcdef", '{"api_key": "abcdefghijkl12"}',
           '{"password":"hunter2hunter2"}', "'secret' : 'AbCdEfGhIjKlMn'", "see 12345678901234abcdefabcdefabcdefabcdef there"]


def test_labelled_secrets_go_whole(make_docs):
    for old, (new, n) in zip(SECRETS, replaced(make_docs, *SECRETS)):
        assert n == 1 and len(new) == len(old), new
        value = max(re.findall(r"[A-Za-z0-9]+", old), key=len)
        assert not any(value[k:k + 6] in new for k in range(len(value) - 5)), new
        assert re.sub("[A-Za-z0-9]", "", new) == re.sub("[A-Za-z0-9]", "", old)


def test_names_of_all_forms(make_docs):
    names = ["Anna Maria Smith", "John McDonald", "Peter O'Brien", "ANNA SMITH", "Maria von Trapp", "Carlos de la Vega", "Anna Maria",
             "JOHN O'BRIEN-HALL", "Hans Meyer-Schmidt", "Анна Иванова"]
    out = replaced(make_docs, *[f"Then {n} came, {n} left." for n in names])
    for name, (new, n) in zip(names, out):
        assert n == 2 and new.startswith("Then ") and new.endswith(" left.")
        first = new[5:new.index(" came")]
        assert new == f"Then {first} came, {first} left."  # one entity, one surrogate
        assert len(first.split()) == len(name.split()) and (first == first.upper()) == (name == name.upper())
        old = [w for w in name.split() if w not in pii.PARTICLES]
        assert not set(old) & set(first.split()) and [w for w in first.split() if w in pii.PARTICLES] == [w for w in name.split() if w in pii.PARTICLES]
    both = replaced(make_docs, "ANNA SMITH is Anna Smith. O'Brien? Peter O'Brien!")[0][0]
    upper, mixed = re.match(r"([A-Z]+ [A-Z]+) is (\w+ \w+)\.", both).groups()
    assert upper == mixed.upper() and "Brien" not in both


def test_no_false_alarms_of_numbers(make_docs):
    texts = ["version 10.1.2.3", "v10.1.2.3 and Version: none", "ISBN 978-3-16-148410-0", "ISBN-13: 9783161484100", "pages 10-12, 1999-2003", "3.14159 2.71828",
             "password: short", "token = two words only", "Anna went home", "MARIA!"]
    assert replaced(make_docs, *texts) == [(t, 0) for t in texts]


def test_long_parts_of_mail_addresses(make_docs):
    mails = ["a" * 71 + "@mail.example.org", "x@" + ".".join(["sub"] * 20) + ".org", "y@" + "d" * 80 + ".com", "password=john.smithsonian_x@mail.com"]
    for old, (new, n) in zip(mails, replaced(make_docs, *mails)):
        assert n == 1 and len(new) == len(old) and new.count("@") == 1 and new.split(".")[-1] == old.split(".")[-1]
        assert not any(w in new.split("=")[-1] for w in ("aaaa", "sub.sub", "dddd", "smith"))


def test_clashing_output_name_and_key(spark):
    docs = spark.createDataFrame([(1, "x", "mail a.b@c.org")], "doc_id long, N_Entities string, text string")
    one, other = (pii.replace(docs, k).select("doc_id", "n_entities", "text").first() for k in ("k", "other"))
    assert one.n_entities == 1 and one.text != other.text != "mail a.b@c.org"


def test_detection_and_surrogates_against_brute_force(spark, make_docs):
    """Entities found by a scan in Python; one surrogate for each, distinct, of its form, nobody's value."""
    rng = np.random.default_rng(4)
    parts = [*SECRETS, "Anna Smith", "JOHN DOE", "Peter van der Berg", "mail a.b@c.org", "A.B@C.org", "10.1.2.3", "+49 30 1234 5678", "4111-1111 1111 1111",
             "DE89 3704 0044 0532 0130 00", "123-45-6789", "plain words", "ISBN 978-3-16-148410-0", "Юрий Петров"]
    texts = [". ".join(rng.choice(parts, 6)) for _ in range(150)]
    docs = make_docs([(k, t, "en", "a") for k, t in enumerate(texts)])
    found = pii.entities_of(docs).collect()
    expected = [(t, m.group()) for t in set(texts) for m in regex.finditer(pii.ENTITY, t)]
    assert sorted(r.mention for r in found) == sorted(m for _, m in expected)
    table = {(r.kind, r.value): r.surrogate for r in pii.assign_surrogates(pii.entities_of(docs), "k").collect()}
    assert table.keys() == {(r.kind, r.value) for r in found}
    assert len({(k, s) for (k, _), s in table.items()}) == len(table)
    assert not {(k, s) for (k, _), s in table.items()} & table.keys()
    shape = [("[0-9]", "0"), ("[a-z]", "a"), ("[A-Z]", "A"), ("[а-я]", "ж"), ("[А-Я]", "Ж")]
    for (kind, value), new in table.items():
        if kind in ("secret", "card", "phone", "iban", "ssn"):
            for pattern, by in shape:
                value, new = re.sub(pattern, by, value), re.sub(pattern, by, new)
            assert value == new
    out = {r.doc_id: r for r in pii.replace(docs, "k").collect()}
    for k, t in enumerate(texts):
        assert out[k].n_entities >= len(list(regex.finditer(pii.ENTITY, t)))
        assert not any(m.group() in out[k].text for m in regex.finditer(pii.ENTITY, t))


# ------------------------------------------------------------------- dense fingerprints

@pytest.mark.parametrize("shard_rows", [200_000, 300])
def test_dense_fingerprints_keep_all_links(spark, shard_rows):
    """Thousands of fingerprints around a few centers: dense shards are dealt out anew."""
    from vigil.operators import graph

    rng = np.random.default_rng(11)
    x = []
    for center in rng.integers(0, 1 << 64, 3, dtype=np.uint64):
        for _ in range(700):
            flips = rng.choice(64, rng.integers(0, 8), replace=False)
            x.append(int(center) ^ sum(1 << int(f) for f in flips))
    x = np.unique(np.array(x + rng.integers(0, 1 << 64, 300, dtype=np.uint64).tolist(), dtype=np.uint64))
    near = np.bitwise_count(x[:, None] ^ x[None]) <= 3
    root = np.arange(len(x))
    while True:
        new = np.where(near, root[None], len(x)).min(axis=1)
        if (new == root).all():
            break
        root = new
    nodes = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    links = simhash.links(nodes, 3, 4, shard_rows).collect()
    place = {int(v): k for k, v in enumerate(x.view(np.int64))}
    assert all(near[place[r.a], place[r.b]] for r in links)
    found = graph.components(spark.createDataFrame([(place[r.a], place[r.b]) for r in links], "a long, b long"))
    got = np.arange(len(x))
    for r in found.collect():
        got[r.node] = r.root
    assert (got == root).all()


def test_benchmark_in_blocks_of_hashes(spark, make_docs, monkeypatch):
    items = spark.createDataFrame([(k, f"alpha{k} beta gamma{k % 3} delta") for k in range(40)] + [(99, "two words")], "item_id long, text string")
    docs = make_docs([(k, f"x alpha{k} beta gamma{k % 3} delta {'two words' if k % 5 == 0 else ''}", "en", "a") for k in range(60)] + [(70, None, None, None)])
    expected = as_set(decontam.scan(docs, items), "doc_id", "n_words", "n_hit", "items")
    assert sum(r[2] > 0 for r in expected) >= 44
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(decontam, "BLOCK_HASHES", 7)
    assert as_set(decontam.scan(docs, items), "doc_id", "n_words", "n_hit", "items") == expected
