import zlib
from collections import Counter

import numpy as np
import pytest

from wellmart.llm import langid


def gram_bucket(gram):
    """Plain-integer form of the hash of one n-gram."""
    h, m = 0, 0xFFFFFFFF
    for k, ch in enumerate(gram):
        c = ord(ch)
        c = 32 if c < 97 or 122 < c < 128 else c
        h = ((h ^ c) * int(langid._MIX[k]) + k + 1) & m
    return ((h ^ (h >> 15)) * int(langid._MIX[2]) & m) >> (32 - langid.BITS)


def brute_vector(text):
    """Counts per bucket, n-gram by n-gram; behind its end a text reads blanks."""
    t = "  " + text.lower() + "  "
    return Counter(gram_bucket((t + "  ")[i:i + n]) for i in range(len(t)) for n in langid.ORDERS)


TEXTS = ["a", "Zum Beispiel: \u00dcber 12 \u6f22\u5b57!", "x" * 64, "one two, three " * 9, "\u0130stanbul 7", "caf\u00e9 \U0001f600 z"]


@pytest.mark.parametrize("limit", [1 << 19, 64, 7, 1])
def test_vectors_logits_and_frequencies_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(langid, "BATCH_CHARS", limit)
    want = [brute_vector(t) for t in TEXTS]
    for t, w in zip(TEXTS, want):
        idx, count = langid.vector(t)
        assert dict(zip(idx.tolist(), count.tolist())) == w
    rng = np.random.default_rng(3)
    weights, idf, bias = rng.normal(size=(1 << langid.BITS, 3)), rng.uniform(0.1, 2, 1 << langid.BITS), rng.normal(size=3)
    model = langid.Model(["p", "q", "r"], np.concatenate([weights * idf[:, None], idf[:, None]], axis=1), bias)
    expect = []
    for w in want:
        i, n = np.array(list(w)), np.array(list(w.values()))
        x = n * idf[i]
        expect.append(langid.SCALE * (x / x.sum()) @ weights[i] + bias)
    assert np.allclose(model.logits(TEXTS), expect)
    lang, score = model.predict([None, *TEXTS, "", "12"])
    assert lang == ["und", *[model.classes[k] for k in np.argmax(expect, axis=1)], "und", "und"]
    assert np.allclose(score[1:-2], langid.softmax(np.array(expect)).max(axis=1))


def test_frequencies_count_texts(spark):
    rows = [(t,) for t in TEXTS] + [(TEXTS[0],), (None,), ("123",)]
    got, n = langid.document_frequencies(spark.createDataFrame(rows, "text string"))
    want = Counter(b for t in [*TEXTS, TEXTS[0]] for b in brute_vector(t))
    assert n == len(TEXTS) + 1 and {int(i): int(got[i]) for i in np.flatnonzero(got)} == want


def test_one_very_long_text_is_read_in_pieces(monkeypatch):
    text = "long words stand here " * 100_000
    whole = [p for p in langid.pieces([text, "short", text])]
    assert max(codes.shape[1] for codes, _, _ in whole) <= langid.BATCH_CHARS
    short = langid.vector(text)
    monkeypatch.setattr(langid, "BATCH_CHARS", 1 << 30)
    assert all((a == b).all() for a, b in zip(short, langid.vector(text)))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.language_id(docs).collect()
    assert len(got) == len(want)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in test) >= 0.97 * len(test)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_prediction_ignores_labels_and_neighbours(spark, docs):
    from pyspark.sql import functions as F

    fold = langid.held_out(F.col("doc_id"))
    hidden = docs.withColumn("lang", F.when(fold, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("other")).repartition(7)
    a = sorted(langid.language_id(docs).collect())
    b = sorted(langid.language_id(hidden).collect())
    assert [(r["doc_id"], r["lang_pred"]) for r in a] == [(r["doc_id"], r["lang_pred"]) for r in b]
    assert all(abs(x["score"] - y["score"]) < 1e-6 for x, y in zip(a, b))


def test_edges(spark, edge, empty):
    got = langid.language_id(edge).collect()
    assert len(got) == edge.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (0, 1, 2, 12, 13))
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 7, 9)} <= {"en"}
    assert langid.language_id(empty).count() == 0
    unlabelled = edge.drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in langid.language_id(unlabelled).collect()} == {"und"}


def test_draw_with_thousands_of_labels(spark):
    labels = [f"dirty {k}" for k in range(3000)]
    rows = [(k, f"text {k}", lang) for k, lang in enumerate(labels)] + [(10 ** 6 + k, f"more {k}", "en") for k in range(2000)]
    counts = {**{lang: 1 for lang in labels}, "en": 2000}
    got = langid.draw(spark.createDataFrame(rows, "doc_id long, text string, lang string"), counts, 100).collect()
    assert {r["lang"] for r in got} == set(counts)
    assert 5 <= sum(r["lang"] == "en" for r in got) <= 60  # 20 on average
