import hashlib

import numpy as np
import pytest

from wellmart.llm import substrings as sub


def brute(rows, k=13):
    least = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            least[g] = min(least.get(g, sub.NO_ID), sub.NO_ID if d is None else d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = {p for i in range(len(w) - k + 1) if least[tuple(w[i:i + k])] < (sub.NO_ID if d is None else d) for p in range(i, i + k)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket_bytes", [1 << 14, 8 << 20])
def test_matches_brute_force(docs, edge, bucket_bytes):
    for df in (docs, edge):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = [tuple(r) for r in sub.substring_digest(df, bucket_bytes=bucket_bytes).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_hot_buckets_are_split(spark, docs, edge):
    from pyspark.sql import functions as F

    # One passage in a third of the rows, several chunks (one a partition), every bucket of some weight hot.
    passage = " ".join(f"p{i}" for i in range(40))
    hot = docs.select(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" " + passage))).otherwise(F.col("text")).alias("text"), "doc_id")
    for df in (hot.repartition(7, "doc_id"), edge):
        source = sub._source(df, "doc_id", "text")
        assert max(sub.hot_buckets(source, 13, 3, 50, 1 << 9, 1).values()) > 2
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = [tuple(r) for r in sub.substring_digest(df, bucket_bytes=1 << 12, hot=1).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_hash_collisions_are_told_apart(monkeypatch):
    docs = [[b"%d" % (i % 40 + s) for i in range(60)] for s in (0, 3, 0, 7)]
    monkeypatch.setattr(sub, "gram_hashes", lambda w, size: np.zeros(max(0, len(w) - size + 1), np.uint64))
    buf, found = sub.super_kmers(docs, 13, 3)
    strings = [buf[a:b] for a, b in found[:, 2:4].tolist()]
    blob = sub.pack(strings, [[i] for i in range(len(strings))], found[:, 0], found[:, 0], found[:, 0], found[:, 1])
    doc, _, _, start, end = sub.repeats([blob], 13)
    hit = {(int(d), p) for d, s, e in zip(doc, start, end) for p in range(s, e)}
    want = set()
    least = {}
    for d, w in enumerate(docs):
        for i in range(len(w) - 12):
            least.setdefault(tuple(w[i:i + 13]), d)
    for d, w in enumerate(docs):
        for i in range(len(w) - 12):
            if least[tuple(w[i:i + 13])] < d:
                want |= {(d, p) for p in range(i, i + 13)}
    assert hit == want and want


def test_empty(empty):
    assert sub.substring_digest(empty).count() == 0


def high_bits(text: str) -> int:
    """The 32 bits that once told texts of one id apart."""
    import xxhash

    return xxhash.xxh64_intdigest(text, 42) >> 32


def test_texts_of_one_id_whose_short_hashes_meet(spark):
    import random

    r = random.Random(0)
    passage = " ".join(f"p{i}" for i in range(13))
    had = {}
    while True:  # two texts of 13 and 44 words of equal high bits, by trying
        n = r.choice((0, 31))
        text = " ".join([passage] + [f"{r.random():.9f}"] * n) if n else " ".join(passage.split()[:12] + [f"{r.random():.12f}"])
        other = had.setdefault(high_bits(text), text)
        if len(other) != len(text) and len(other.split()) != len(text.split()):
            break
    for ids in ((None, None), (5, 5)):
        rows = [(ids[0], text), (ids[1], other), (1, passage), (2, text), (2, other), (9, passage + " x")]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = [tuple(x) for x in sub.substring_digest(df).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("few", [True, False])
def test_many_texts_under_null_and_repeated_ids(spark, monkeypatch, few):
    import random

    if not few:
        monkeypatch.setattr(sub, "REPEATED_IDS", 0)
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    passages = [[r.choice(words) for _ in range(30)] for _ in range(20)]
    rows = [(r.choice([None, None, 1, 2, 3, i + 10]), " ".join([r.choice(words) for _ in range(r.randint(0, 30))] + r.choice(passages) * r.randint(0, 2)))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(x) for x in sub.substring_digest(df, bucket_bytes=1 << 14).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
