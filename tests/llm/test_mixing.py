from collections import Counter, defaultdict

import numpy as np
import pytest

from wellmart.llm import mixing


def test_targets():
    assert mixing.targets([10, 10, 10], [1, 1, 1]) == [10, 10, 10]
    t = mixing.targets([1, 100, 100], [5, 2, 1])
    assert t[0] == 3 and t[1] == pytest.approx(132) and t[2] == pytest.approx(66)
    t = mixing.targets([1, 1, 100, 0], [5, 2, 1, 5])
    assert t == [3, 3, 96, 0]
    assert mixing.targets([], []) == []


def test_targets_match_the_water_level():
    import random

    r = random.Random(7)
    for n in (1, 2, 5, 40):
        sizes, weights = [r.choice([0, 1, 10, 1000, 50000]) for _ in range(n)], [float((5, 2, 1)[i % 3]) for i in range(n)]
        low, high = 0.0, 3.0 * sum(sizes) + 1
        for _ in range(200):  # the level at which min(3 x size, weight x level) add up to all words
            level = (low + high) / 2
            low, high = (level, high) if sum(min(3 * s, w * level) for s, w in zip(sizes, weights)) < sum(sizes) else (low, level)
        assert mixing.targets(sizes, weights) == pytest.approx([min(3 * s, w * high) for s, w in zip(sizes, weights)], abs=1e-6)


def test_many_sources_are_joined_without_broadcast(docs, monkeypatch):
    many = docs.selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN 'big' ELSE concat('host', doc_id) END AS source")
    want = sorted(map(str, mixing.plan(many).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10)
    assert sorted(map(str, mixing.plan(many).collect())) == want
    monkeypatch.setattr(mixing, "MAX_DRAWS", 40)  # one block a source: blocks grow, no row is lost
    check(many)


def test_slices_follow_the_bytes(docs, monkeypatch):
    planned = mixing.plan(docs, block_rows=2)
    held = {r["row"]["doc_id"]: len(r["row"]["text"].encode()) * len(r["draws"]) for r in planned.collect()}
    size = planned.schema["draws"].metadata["bytes"]
    assert abs(size - sum(held.values())) < 0.2 * size
    whole = [r["doc_id"] for r in mixing.mixed_rows(planned).collect()]
    monkeypatch.setattr(mixing, "SLICE_BYTES", size // 16 // 4)
    cut = mixing.mixed_rows(planned)
    assert cut.rdd.getNumPartitions() >= 4 * mixing.SHARDS and [r["doc_id"] for r in cut.collect()] == whole


def test_split_is_exact_and_even():
    counts = np.array([1000, 3, 0, 77, 12345])
    out = mixing.split_counts(counts, 16)
    assert (out.sum(axis=0) == counts).all()
    assert out.sum(axis=1).max() - out.sum(axis=1).min() <= 1
    assert (out == mixing.split_counts(counts, 16)).all()


def check(df, **settings):
    got = mixing.plan(df, **settings).collect()
    assert len(got) == df.count()
    size, taken, target, sizes = Counter(), Counter(), {}, defaultdict(list)
    for r in got:
        s = r["row"]["source"]
        words = len((r["row"]["text"] or "").encode().split())
        assert r["size"] == words and r["taken"] == words * len(r["draws"]) and len(r["draws"]) <= 3
        assert len({d["pass"] for d in r["draws"]}) == len(r["draws"])
        size[s] += words
        taken[s] += r["taken"]
        target[s] = r["target"]
        sizes[s].append((words, r["source_size"]))
    for s in size:
        assert {x[1] for x in sizes[s]} == {size[s]}
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    want = mixing.targets([size[s] for s in order], [float((5, 2, 1)[i % 3]) for i in range(len(order))])
    assert [target[s] for s in order] == pytest.approx(want)
    assert sorted(map(str, got)) == sorted(map(str, mixing.plan(df.repartition(5), **settings).collect()))
    return size, taken, target


def test_documents(docs):
    for settings in ({"block_rows": 4}, {}):
        size, taken, target = check(docs, **settings)
        most = {}
        for r in docs.collect():
            most[r["source"]] = max(most.get(r["source"], 0), len(r["text"].split()))
        assert all(abs(taken[s] - target[s]) <= (most[s] / 2 if settings else 0.02 * size[s]) for s in size)


def test_word_counts():
    import pyarrow as pa

    texts = [None, "", "a", " a  b\n", "", "\tx y\x0bz\r\f", None, "é 漢 字", "q", "q "]
    col = pa.array(texts, pa.string())
    want = [len((t or "").encode().split()) for t in texts]
    assert mixing.word_counts(col).tolist() == want
    assert mixing.word_counts(col[3:8]).tolist() == want[3:8]
    assert mixing.word_counts(col[:0]).tolist() == [] and mixing.word_counts(col[:2]).tolist() == [0, 0]


def test_nearest():
    import random

    r = random.Random(4)
    for n in (1, 5, 12, 900):
        sizes = [r.randint(1, 400) for _ in range(n)]
        lack = 0.4 * sum(sizes)
        got = sum(s for s, c in zip(sizes, mixing.nearest(sizes, lack)) if c)
        if n <= 12:
            want = min(abs(sum(s for k, s in enumerate(sizes) if m >> k & 1) - lack) for m in range(1 << n))
            assert abs(got - lack) == want
        else:
            assert abs(got - lack) <= 1
    assert mixing.nearest([0, 0, 7], 0.0) == [False, False, False] and mixing.nearest([], 5.0) == []
    big = [r.randint(10 ** 6, 10 ** 8) for _ in range(150)]
    got = sum(s for s, c in zip(big, mixing.nearest(big, 0.5 * sum(big))) if c)
    assert abs(got - 0.5 * sum(big)) < 1e-3 * sum(big)


def test_edges(edge, empty):
    check(edge)
    check(edge, block_rows=1)
    assert mixing.plan(empty).count() == 0
    assert mixing.mixed_rows(mixing.plan(edge)).columns == edge.columns


def test_shards_take_disjoint_draws(docs, tmp_path):
    plan = mixing.plan(docs, block_rows=2, shards=4)
    draws = [(r["row"]["doc_id"], d["pass"], d["shard"]) for r in plan.collect() for d in r["draws"]]
    assert len({x[:2] for x in draws}) == len(draws) and {x[2] for x in draws} == {0, 1, 2, 3}
    mixing.write_mix(plan, str(tmp_path / "mix"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "mix"))
    assert Counter((r["row"]["doc_id"], r["shard"]) for r in back.collect()) == Counter((d, s) for d, _, s in draws)


def test_rows_stand_by_shard_in_seeded_order(docs):
    draws = [(s, p, r["doc_id"]) for r in mixing.mix_digest(docs, block_rows=2).collect() for s, p in zip(r["shards"], r["places"])]
    assert {d[0] for d in draws} == set(range(mixing.SHARDS))
    planned = mixing.plan(docs, block_rows=2)
    assert [r["doc_id"] for r in mixing.mixed_rows(planned).collect()] == [d[2] for d in sorted(draws)]
    assert sorted(draws) != sorted(draws, key=lambda d: (d[0], d[2]))
