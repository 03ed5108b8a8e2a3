import random

import numpy as np
import xxhash

from wellmart.llm import simhash
from wellmart.llm.components import components
from conftest import prose


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.encode().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(fps))]


def compare(got, texts, ids):
    fps = [brute_fingerprint(t) for t in texts]
    want = sorted(zip(map(str, ids), (f"{f:016x}" for f in fps), map(str, brute_components(fps, ids))))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_matches_brute_force(docs, rows):
    compare(simhash.near_duplicates(docs, leaf=16).collect(), [r["text"] for r in rows.values()], list(rows))


def test_edge_rows(edge):
    got = edge.collect()
    compare(simhash.near_duplicates(edge, leaf=4, block=4).collect(), [r["text"] for r in got], [r["doc_id"] for r in got])


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).columns == empty.columns


def test_keep_one(edge):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    named = {r["component_id"] for r in simhash.near_duplicates(edge.where("doc_id IS NOT NULL")).collect()}
    assert ids == sorted(named)


def test_keep_one_decides_by_row(spark):
    clean = [prose(k, 60) for k in range(10, 18)]
    rows = [(7, t, "s", None) for t in clean[:5]] * 2  # one id, five documents, each twice
    rows += [(3, clean[0], None, "s"), (9, clean[5], None, "s"), (9, clean[5], "s", None)]  # a smaller id; one id, other columns differ
    rows += [(None, clean[1], None, None), (None, clean[6], "s", None), (None, clean[6], "t", None), (None, clean[6].upper(), None, None)]
    rows += [(8, None, clean[7], None), (8, clean[7], None, None)]  # the same values but for nulls
    want = sorted([(3, clean[0]), *((7, t) for t in clean[1:5]), (9, clean[5]), (None, clean[6].lower()), (8, None), (8, clean[7])], key=str)
    seen = set()
    for parts in (1, 5):
        kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, a string, b string").repartition(parts)).collect()
        assert sorted(((r[0], r[1] and r[1].lower()) for r in kept), key=str) == want
        assert {tuple(r) for r in kept} <= set(rows)
        seen.add(tuple(sorted(map(str, kept))))
    assert len(seen) == 1


def test_tree_finds_every_link(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(300)]
    near = [b ^ sum(1 << k for k in r.sample(range(64), r.randint(1, 4))) for b in base[:150] for _ in range(3)]
    fps = sorted({*base, *near, *(base[0] ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a))})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for settings in ({"segments": 1, "leaf": 32}, {"segments": 2, "leaf": 16}, {"segments": 2, "leaf": 16, "block": 20}, {"segments": 4, "leaf": 8}):
        roots = {x["node"]: x["root"] for x in components(simhash.links(nodes, 3, **settings)).collect()}
        got = [roots.get(x, x) for x in signed]
        want = brute_components(fps, list(range(len(fps))))
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(100, 260)]
    hub = [(5, i) for i in range(300, 700)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + hub + [(9, 9)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 261)}, 5: 5, **{i: 5 for i in range(300, 700)}}
