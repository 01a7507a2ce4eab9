"""Every corpus query that SQL can express against its oracle, the others against
brute force on the small tables."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import pytest

from vigil.llm.queries import REGISTRY
from vigil.plans.compare import compare

ORACLES = sorted(n for n, (_, sql) in REGISTRY.items() if sql)


@pytest.mark.parametrize("name", ORACLES)
def test_oracle(spark, duck, sf_dir, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, duck, name, fn, sql, sf_dir)
    assert r["status"] == "match", r


def _docs(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def brute_fingerprint(text):
    import re

    import xxhash

    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, distance=3):
    """doc_id → smallest doc_id reachable, by comparing all pairs of fingerprints."""
    values = np.array(sorted(set(prints.values())), dtype=np.uint64)
    low = {int(v): min(d for d, f in prints.items() if f == int(v)) for v in values}
    group = {int(v): int(v) for v in values}
    changed = True
    while changed:
        changed = False
        for v in values:
            near = [int(u) for u in values[np.bitwise_count(values ^ v) <= distance]]
            least = min((group[u] for u in near), key=lambda g: low[g])
            for u in near:
                if group[u] != least:
                    group[u], changed = least, True
    return {d: low[group[f]] for d, f in prints.items()}


def test_simhash_query(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    prints = {d: brute_fingerprint(r.text) for d, r in docs.items()}
    low = brute_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in REGISTRY["op10_simhash"][0](spark, sf_dir).collect()}
    assert got == {d: (f"{prints[d]:016x}", low[d]) for d in docs}


def test_chat_query(spark, sf_dir):
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    said = "\\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in REGISTRY["op4_chat_format"][0](spark, sf_dir).collect()}
    assert set(got) == set(turns)
    for c, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, role, t in rows if role == "assistant")
        want = (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest(),
                len(loss), hashlib.sha256(loss.encode()).hexdigest())
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want
        assert r.formatted_chars >= sum(len(t) for _, _, t in rows)


def test_language_query_held_out(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    rows = REGISTRY["op6_language_id"][0](spark, sf_dir).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    test = [r for r in rows if r.held_out]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in test]) > 0.95


def test_toxicity_query_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"  # sf0.001 has a handful of toxic labels
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = REGISTRY["op9_toxicity"][0](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in toxic]
    caught = [r.predicted for r in test if toxic[r.doc_id]]
    clean = [r.predicted for r in test if not toxic[r.doc_id]]
    assert np.mean(caught) > 0.8 and np.mean(clean) < 0.01


def test_pii_query(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    rows = REGISTRY["op3_pii_surrogates"][0](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    import re

    mail, card = re.compile(r"[\w.%+-]+@[\w.-]+\.\w+"), re.compile(r"\b\d{16}\b")
    for r in rows:
        old = docs[r.doc_id].text
        assert r.n_entities > 0 or r.text == old
        for found in mail.findall(old) + card.findall(old):
            assert found not in r.text
