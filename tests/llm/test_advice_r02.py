
from __future__ import annotations

import re

from vigil.llm import fm, pii, toxicity


def test_training_reads_3000_documents_of_a_label(spark, make_docs, monkeypatch):
    docs = make_docs([(k, f"word{k}", "en", "a") for k in range(12_000)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(12_000)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(fm, "fit", lambda texts, y: seen.append((len(texts), int(y.sum()))))
    toxicity.train(docs, labels)
    assert seen == [(6000, 3000)]


def test_mentions_of_one_entity_share_its_surrogate(make_docs):
    texts = ["Card 4111 1111 1111 1111 or 4111111111111111 or 4111-1111-1111-1111.", "Call +49 30 1234 5678 or +49-30-1234-5678.",
             "IBAN DE89 3704 0044 0532 0130 00 or DE89370400440532013000.",
             "Smith wrote: Anna Smith and John Doe-Hall met. Anna left; Smith's car, Doe-Hall, Smith-like, Smithson, anna, 12."]
    out = {r.doc_id: r for r in pii.replace(make_docs([(k, t, "en", "a") for k, t in enumerate(texts)]), "k").collect()}
    for k, n in ((0, 3), (1, 2), (2, 2)):
        bare = [re.sub("[^A-Z0-9]", "", x) for x in re.sub("^(Card|Call|IBAN) ", "", out[k].text).rstrip(".").split(" or ")]
        assert len(bare) == n and len(set(bare)) == 1 and bare[0] != re.sub("[^A-Z0-9]", "", texts[k].split(" or ")[1])
        assert re.sub("[A-Z0-9]", "", out[k].text[5:]) == re.sub("[A-Z0-9]", "", texts[k][5:])
    given, family, other = re.search(r"wrote: (\w+) (\w+) and \w+ (\w+) met", out[3].text).groups()
    assert out[3].text.startswith(f"{family} wrote") and given != "Anna"
    assert out[3].text.endswith(f"met. {given} left; {family}'s car, {other}, {family}-like, Smithson, anna, 12.")
    assert out[3].n_entities == 7


def test_secrets_are_replaced_whole(make_docs):
    key = "".join(chr(97 + (7 * k * k + k) % 26) for k in range(1000))
    jwt = "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl=="
    texts = [f"token = {key}. End", f"see {'0123456789abcdef' * 60} here", f"token={jwt}, then", "Password: Abcdefgh1234x",
             "API_KEY=abcdefghijklmn", "abcdefabcdefabcdefabcdefabcdefabcdef"]
    out = {r.doc_id: r for r in pii.replace(make_docs([(k, t, "en", "a") for k, t in enumerate(texts)]), "k").collect()}
    assert all(out[k].n_entities == 1 and len(out[k].text) == len(t) for k, t in enumerate(texts))
    assert out[0].text.endswith(". End") and not any(key[k:k + 8] in out[0].text for k in range(len(key) - 8))
    assert re.fullmatch("see [0-9a-f]{960} here", out[1].text) and "0123456789abcdef" not in out[1].text
    assert re.fullmatch(r"token=\w{12}\.\w{12}\.\w{12}==, then", out[2].text)
    assert not any(part in out[2].text for part in jwt.rstrip("=").split("."))
    assert "Abcdefgh" not in out[3].text and "abcdefgh" not in out[4].text and "abcdef" * 5 not in out[5].text
