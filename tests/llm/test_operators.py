"""Properties of the operators on small inputs: planted cases, round trips, brute force."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.llm import chat, decontam, fm, langid, linededup, mixing, pii, quality, simhash, terms, urlfilter
from vigil.operators import graph

from .conftest import as_set

# ------------------------------------------------------------------ decontamination

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, "Only three words"), (3, None), (4, "?!"), (None, ITEM), (5, ITEM)],
                                 "item_id long, text string")


def test_decontamination_hits_and_items(make_docs, items):
    docs = make_docs([
        (1, f"start {ITEM.upper()} end", "en", "a"), (2, "ALPHA beta, gamma; delta", "en", "a"),
        (3, "say only-three\nwords twice: only three words", "en", "a"), (4, None, None, None),
        (5, " ".join(ITEM.split()[:10]), "en", "a"), (5, "clean", "en", "a"), (6, f"x {ITEM} y {ITEM}", "en", "a")])
    rows = {(r.doc_id, r.n_words): r for r in decontam.scan(docs, items).collect()}
    assert {k: (r.n_hit, r["items"]) for k, r in rows.items()} == {
        (1, 14): (12, ["1", "5"]), (2, 4): (0, []), (3, 8): (6, ["2"]), (4, 0): (0, []),
        (5, 10): (10, ["1", "5"]), (5, 1): (0, []), (6, 26): (24, ["1", "5"])}
    assert [(s["from"], s["to"]) for s in rows[(6, 26)].spans] == [(1, 13), (14, 26)]


def test_decontamination_removes(make_docs, items):
    docs = make_docs([(1, f"Keep this, {ITEM}. And this!", "en", "a"), (2, "Clean text.", "en", "a")])
    assert [r.doc_id for r in decontam.decontaminate(docs, items).collect()] == [2]
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, items, remove="spans").collect()}
    assert cut == {1: "Keep this. And this!", 2: "Clean text."}
    with pytest.raises(ValueError):
        decontam.decontaminate(docs, items, remove="words")


def test_decontamination_without_broadcast(make_docs, items, monkeypatch):
    docs = make_docs([(1, f"a {ITEM}", "en", "a"), (2, "b only three words", "en", "a"), (3, "c", "en", "a")])
    with_broadcast = as_set(decontam.scan(docs, items).drop("spans"))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", -1)
    assert as_set(decontam.scan(docs, items).drop("spans")) == with_broadcast


# ------------------------------------------------------------------------ URL rules

def test_url_rules_against_brute_force(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("a.b.org", "", "block"), ("org", "/x", "block"), ("b.org", "/xy", "allow"),
             ("tie.io", "/", "allow"), ("tie.io", "/", "block")]
    urls = [None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1?x#y",
            "http://m.example.com/en/", "http://notexample.com/en/", "http://example.com/EN/", "http://x.net/es/a/es/",
            "http://net?/es/", "http://a.b.org", "http://z.a.b.org#f", "http://b.org/xyz", "http://c.org/xy",
            "http://tie.io/", "http://deep." * 3 + "tie.io/a/b", "http://user@example.com:80/en/", "http://é.com/ü"]
    pages = spark.createDataFrame([(i // 2, u) for i, u in enumerate(urls * 2)], "page_id long, url string")

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.sub("[A-Z]", lambda m: m.group().lower(), re.match("[^/?#]*", rest).group())
        path = re.match("[^/?#]*([^?#]*)", rest).group(1)
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
                if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        return host, path, best[3] if best else None, best[4] if best else "allow"

    got = as_set(urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")))
    want = sorted(((i // 2, *brute(u)) for i, u in enumerate(urls * 2)), key=repr)
    assert got == want
    kept = urlfilter.filter_pages(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert kept.count() == sum(brute(u)[3] == "allow" for u in urls * 2)


def test_url_without_rules(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/"), (None, None)], "page_id long, url string")
    assert {r.verdict for r in urlfilter.judge(pages, none, default="block").collect()} == {"block"}
    assert urlfilter.judge(pages.limit(0), none).count() == 0


# ------------------------------------------------------------------------------ PII

def test_surrogates(make_docs):
    text = ("Anna Smith (anna.smith@mail.example.org) met John Doe; Anna Smith called +1 (017) 555-7713 from 10.1.2.3. "
            "Card 4111 1111 1111 1111, token = \"0123456789abcdef0123456789abcdef\". Анна Иванова. GPL version 3, CC 4.0.")
    docs = make_docs([(1, text, "en", "a"), (2, "Write ANNA.smith@mail.example.org now", "en", "a"), (3, "no data", "en", "a"),
                      (4, "anna.smith@mail.example.org", "en", "a"), (5, None, None, None), (6, "", "en", "a")])
    out = {r.doc_id: r for r in pii.replace(docs, "k").collect()}
    new = out[1].text
    for private in ("Anna Smith", "anna.smith@mail.example.org", "John Doe", "555-7713", "10.1.2.3", "4111 1111", "0123456789abcdef", "Иванова"):
        assert private not in new
    assert "GPL version 3, CC 4.0." in new and out[1].n_entities == 9
    person = re.match(r"(\w+ \w+) \(", new).group(1)
    assert new.count(person) == 2 and person.split()[0] in pii.GIVEN[("latin", "f")]
    mail = re.search(r"\(([^)]*@[^)]*)\)", new).group(1)
    assert re.fullmatch(r"[a-z]{4}\.[a-z]{5}@[a-z]{4}\.[a-z]{7}\.org", mail)
    assert mail in out[2].text and out[4].text == mail
    digits = [int(c) for c in re.search(r"Card ([\d ]{19})", new).group(1).replace(" ", "")]
    assert sum(sum(divmod(2 * d, 10)) if k % 2 == 0 else d for k, d in enumerate(digits)) % 10 == 0
    assert (out[3].text, out[5].text, out[6].text) == ("no data", None, "")


def test_surrogates_stay_distinct_when_the_format_is_too_small(spark):
    many = spark.range(3000).select(F.lit("secret").alias("kind"), F.lpad(F.col("id").cast("string"), 3, "0").alias("value"))
    few = many.filter("length(value) <= 3").distinct()
    out = pii.assign_surrogates(few, "k").collect()
    assert len(out) == few.count() == len({r.surrogate for r in out})
    assert not {r.surrogate for r in out} & {r.value for r in few.collect()}


# ----------------------------------------------------------------------------- chat

def _windows(spark, rows, **limits):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_windows(turns, chat.Limits(**limits)).collect()


def test_windows_keep_system_and_history(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "x" * 200) for k in range(1, 12)]
    out = _windows(spark, rows, budget=260, history_turns=2, history_tokens=130)
    assert len(out) > 2 and [w.window for w in out] == list(range(len(out)))
    assert sum(w.n_turns for w in out) == 12 and all(w.n_tokens <= 260 and not w.over_budget for w in out)
    fresh = []
    for w in out:
        turns = chat.parse(w.text)
        assert turns[0] == ("system", "be brief") and len(turns) == w.n_context + w.n_turns
        if w.window:
            assert w.n_context >= 2 and turns[1:w.n_context] == fresh[-(w.n_context - 1):]
        fresh += turns[w.n_context:]
        assert [chat.unescape(w.text[s.start:s.end]) for s in w.loss] == [t for r, t in turns[w.n_context:] if r == "assistant"]
    assert fresh == [(r, t) for _, _, r, t in rows]


def test_windows_odd_turns(spark):
    hard = "\\### <turn x>\n</turn>\n\\\\ \\< end\\"
    rows = [(None, None, None, None), (2, 0, "a>b\\", hard), (2, 0, "assistant", hard), (2, 1, "assistant", "y" * 5000),
            (2, 1, "assistant", "y" * 5000), (3, 5, "assistant", "")]
    out = _windows(spark, rows, budget=100)
    assert [t for w in out if w.conv_id == 2 for t in chat.parse(w.text)[w.n_context:]] == [
        ("a>b\\", hard), ("assistant", hard), ("assistant", "y" * 5000), ("assistant", "y" * 5000)]
    assert sum(w.over_budget for w in out) == 2
    assert [chat.parse(w.text) for w in out if w.conv_id is None] == [[("", "")]]
    assert _windows(spark, []) == []


# -------------------------------------------------------------------------- quality

def test_quality_repeats_against_brute_force(make_docs):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcde"), size=n)) for n in (0, 1, 2, 3, 4, 10, 50, 300)] + ["x y z x y z", "q " * 60]
    got = {r.doc_id: r.n_repeat_words for r in quality.ledger(make_docs([(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        assert got[i] == len({k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)})


def test_quality_policies_and_ablations(make_docs):
    good = " ".join(f"word{i}" for i in range(60))
    rows = quality.ledger(make_docs([(1, good, "en", "a"), (2, "few words", "en", "a"), (3, good.upper(), "en", "a"),
                                     (4, "### " * 60, "en", "a"), (5, None, None, None)])).cache()
    kept = {r.doc_id: (r.kept_base, r.kept_v1, r.kept_v2) for r in quality.apply_policies(rows).collect()}
    assert kept == {1: (True, True, True), 2: (False,) * 3, 3: (True, True, False), 4: (False,) * 3, 5: (False,) * 3}
    a = {(r.policy, r.rule): r for r in quality.ablations(rows).collect()}
    only = a[("v2", "shouting")]
    assert (only.n_failed, only.n_only, only.n_kept, only.n_kept_without) == (1, 1, 1, 2)
    assert len(a) == sum(bin(m).count("1") for m in quality.POLICIES.values())


# ------------------------------------------------------------------------- language

def test_language_levels(make_docs):
    rng = np.random.default_rng(5)
    syllables = {"en": ["the", "ing", "wh"], "de": ["sch", "ung", "ein"], "fr": ["eau", "que", "oi"], "es": ["cio", "dad", "el"]}
    rows = [(k * 4 + j, " ".join("".join(rng.choice(s, 2)) for _ in range(30)), lang, "a")
            for k in range(40) for j, (lang, s) in enumerate(syllables.items())]
    rows += [(None, "theing whthe", "en", "a"), (1000, None, "en", "a"), (1001, "123 ...", "en", "a"), (1002, "", None, "a")]
    out = {r.doc_id: r for r in langid.identify(make_docs(rows)).collect()}
    truth = {i: lang for i, _, lang, _ in rows}
    assert all(out[i].lang_pred == truth[i] for i in range(160))
    assert [(out[i].lang_pred, out[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert out[None].lang_pred == "en" and out[None].held_out is False


# ------------------------------------------------------------------------ line dedup

def brute_lines(rows, min_chars=20, min_docs=3):
    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            k = key(line)
            last = max(holders[k], key=lambda d: (d is not None, d or 0))
            if not (len(k) >= min_chars and len(holders[k]) >= min_docs and doc_id != last):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_bits", [1 << 28, 1 << 10])
def test_line_dedup_against_brute_force(make_docs, edge_rows, max_bits, monkeypatch):
    monkeypatch.setattr(linededup, "MIN_BITS", 1 << 10)
    rng = np.random.default_rng(11)
    pool = [f"a common line number {i} of some length" for i in range(30)] + ["tiny", "", "exactly twenty chars"]
    rows = [(int(i % 90), "\n".join(rng.choice(pool, size=rng.integers(1, 12))), "en", "a") for i in range(120)]
    rows = rows + [r for r in edge_rows]
    docs = make_docs(rows)
    found = linededup.drops(docs, max_bits=max_bits)
    out = linededup._with_drops(docs, F.lit(0).alias("row"), found)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept or "") for r in out.collect()), key=repr)
    assert got == brute_lines([(i, t) for i, t, _, _ in rows])


# ---------------------------------------------------------------------------- mixing

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        rest = [s for s in names if s not in fixed]
        t = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if t[s] > cap * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: cap * sizes[s] for s in over}


def test_mixing_targets_and_taken(make_docs):
    rng = np.random.default_rng(2)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 40))), "en", s)
            for i, s in enumerate(rng.choice(["a", "b", "c", "d", "e", None], size=600, p=[.5, .1, .1, .1, .19, .01]))]
    rows += [rows[0], rows[0], (None, "w w w", "en", "a"), (None, None, "en", "empty")]
    docs = make_docs([(i, t, la, None if s is None else str(s)) for i, t, la, s in rows])
    out = mixing.mix_report(docs, [3, 1, 2]).toPandas()
    assert len(out) == len(rows)
    joined = docs.select("doc_id", "source").toPandas()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    by_target = {round(v, 6): k for k, v in want.items()}
    out["source"] = out["target"].round(6).map(by_target)
    for s, part in out.groupby("source", dropna=False):
        s = None if pd.isna(s) else s
        assert abs(part["taken"].sum() - want[s]) <= 40
        assert (part["source_size"] == sizes[s]).all()
    assert (out["taken"] <= 2 * out["size"]).all() and len(joined) == len(rows)
    again = mixing.mix_report(docs, [3, 1, 2]).toPandas()
    assert sorted(map(tuple, again.fillna(-1).values.tolist())) == sorted(map(tuple, out.drop(columns="source").fillna(-1).values.tolist()))
    mixed = mixing.mix(docs, [3, 1, 2])
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(F.when(F.col("text") != "", F.size(F.split("text", " "))))).first()[0]
    assert words == out["taken"].sum()


# --------------------------------------------------------------------------- toxicity

def test_machine_learns_a_pair():
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for k in range(400):  # 1 and 2 together are toxic, each alone is not
        t = {1} if k % 4 == 1 else {2} if k % 4 == 2 else {1, 2} if k % 4 == 3 else set()
        texts.append(np.array(sorted(t | set(rng.choice(np.arange(10, 40), 5).tolist())), dtype=np.int64))
        labels.append(int(k % 4 == 3))
    m = fm.fit(texts, np.array(labels), association=3.0, rounds=300)
    got = [m.score(np.array(x, dtype=np.int64)) for x in ([1, 2], [1], [2], [])]
    assert got[0] > 0.7 and max(got[1:]) < 0.5
    assert fm.fit([], np.array([])).score(texts[0]) < 0.01
    assert fm.fit(texts[:2], np.array([1, 1])).score(texts[0]) > 0.99


def test_terms_are_those_of_words():
    a, b = terms.word_terms("The CAT, the dog", 22), terms.word_terms("dog cat THE", 22)
    assert list(a) == list(b) and len(a) == 3
    assert len(terms.word_terms(None, 22)) == len(terms.word_terms("... \n", 22)) == 0
    assert set(terms.word_terms("über", 22)) == set(terms.word_terms("--über--", 22))
    once, twice = (set(terms.word_terms(t, 22, (4,))) for t in ("prefixed", "prefixed prefers"))
    assert len(twice - once) >= 2


# ---------------------------------------------------------------------------- SimHash

def test_links_of_dense_and_sparse_shards():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, size=int(rng.integers(0, 6)), replace=False)))
            for b in base for _ in range(60)]
    x = np.unique(np.concatenate([np.array(near, dtype=np.uint64), rng.integers(0, 1 << 63, 800, dtype=np.uint64)]))
    ids = {int(v): i for i, v in enumerate(x)}

    def roots(pairs):
        parent = list(range(len(x)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in pairs:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(x))]

    i, j = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3, 1))
    want = roots(zip(i, j))
    for search in (simhash.links_in, simhash._sweep):
        found = search(x, 3)
        assert all((np.bitwise_count(e[0] ^ e[1]) <= 3).all() for e in found)
        assert roots((ids[int(a)], ids[int(b)]) for e in found for a, b in zip(*e)) == want


@pytest.mark.parametrize("blocks,shard_rows", [(4, 200_000), (5, 200_000), (4, 60)])
def test_links_through_shards(spark, blocks, shard_rows):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, size=int(rng.integers(0, 4)), replace=False)) for b in base for _ in range(12)]
    # one large group whose members share their upper bits
    dense = [int(base[0]) ^ int(v) for v in rng.integers(0, 1 << 12, 400)]
    x = np.array(sorted(set(near + dense)), dtype=np.uint64)
    nodes = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    links = simhash.links(nodes, 3, blocks, shard_rows)
    got = {r.node: r.root for r in graph.components(links).collect()}
    prints = {i: int(v) for i, v in enumerate(x)}
    from .test_queries import brute_groups

    want = brute_groups(prints)
    signed = x.view(np.int64)
    classes, expected = {}, {}
    for i in prints:
        classes.setdefault(got.get(int(signed[i]), int(signed[i])), set()).add(i)
        expected.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}
    assert graph.components(edges.limit(0)).count() == 0


def test_deduplicate_keeps_one_of_each_group(make_docs):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(3, long, "en", "a"), (1, long, "en", "b"), (1, long, "en", "b"), (2, long + " tail", "en", "a"),
            (None, long, "en", "a"), (4, "", "en", "a"), (5, None, "en", "a"), (6, "another text of its own here", "en", "a"),
            (None, "only without an id, twice", "en", "a"), (None, "only without an id, twice", "en", "a")]
    docs = make_docs(rows)
    out = simhash.deduplicate(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    ids = sorted((i for i, _ in kept if i is not None))
    assert ids.count(1) == 1 and 3 not in ids and 4 in ids and 5 not in ids and 6 in ids
    assert kept.count((None, "only without an id, twice")) == 1 and (None, long) not in kept
