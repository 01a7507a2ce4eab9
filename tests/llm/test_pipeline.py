"""The pipeline against a brute-force version of its stages on the small tables."""

from __future__ import annotations

import re

from .test_operators import brute_lines, brute_targets
from .test_queries import brute_fingerprint, brute_groups


def test_pipeline_rows(spark, sf_dir):
    import corpus_pipeline
    from vigil.llm import toxicity

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = {r.doc_id: r.score for r in toxicity.with_scores(docs, labels).collect()}
    rows = {r.doc_id: r for r in docs.collect() if score[r.doc_id] < toxicity.THRESHOLD}
    text = {i: kept for i, _, _, kept in brute_lines([(i, r.text) for i, r in rows.items()])}
    low = brute_groups({i: brute_fingerprint(t) for i, t in text.items()})
    text = {i: t for i, t in text.items() if low[i] == i}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))

    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    lengths = {len(w) for w in windows}

    def leaks(t):
        w = words(t)
        return any(tuple(w[k:k + n]) in windows for n in lengths for k in range(len(w) - n + 1))

    text = {i: t for i, t in text.items() if not leaks(t)}
    sizes = {}
    for i, t in text.items():
        sizes[rows[i].source] = sizes.get(rows[i].source, 0) + len(t.split())
    targets = brute_targets(sizes)

    out = corpus_pipeline.run(spark, sf_dir).collect()
    taken, copies = {}, {}
    for r in out:
        assert r.text == text[r.doc_id] and r.source == rows[r.doc_id].source and r.lang == rows[r.doc_id].lang
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    longest = max(len(t.split()) for t in text.values())
    for s, t in targets.items():
        assert abs(taken.get(s, 0) - t) <= longest


def test_planted_cases(spark, make_docs, tmp_path):
    """Copies, near copies, benchmark passages, shared passages and toxic documents
    are caught; clean documents stay as they are."""
    import corpus_pipeline

    clean = [(100 + k, " ".join(f"c{k}w{j}" for j in range(80)), "en", "a") for k in range(40)]
    passage = " ".join(f"passage{j}" for j in range(60))
    item = " ".join(f"item{j}" for j in range(20))
    insults = ["insultone", "insulttwo"]
    toxic = [(300 + k, " ".join([f"t{k}w{j}" for j in range(30)] + insults), "en", "b") for k in range(60)]
    rows = clean + toxic
    rows += [(200, clean[0][1], "en", "a"), (201, clean[1][1] + " and", "en", "a"),
             (210, f"{clean[2][1]} x\n{item}", "en", "a")]
    rows += [(220 + k, f"own{k} " * 30 + f"\n{passage}\n", "en", "a") for k in range(4)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    marked = [(i, 1, int(i >= 300)) for i, *_ in rows if i < 200 or i >= 300]
    spark.createDataFrame(marked, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path)).cache()
        at[name] = {r.doc_id: r.text for r in docs.collect()}
    assert not any(i >= 300 for i in at["toxicity"])
    assert set(at["toxicity"]) == {i for i, *_ in rows if i < 300}
    assert [passage in at["line_dedup"][220 + k] for k in range(4)] == [False, False, False, True]
    assert 200 not in at["simhash"]
    assert 210 in at["simhash"] and 210 not in at["decontamination"]
    assert all(at["decontamination"][i] == t for i, t, _, _ in clean)
