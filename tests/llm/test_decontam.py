import hashlib
import re

import numpy as np
import pytest

from wellmart.llm import decontam as dec


def words_of(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=13):
    windows = {}
    for i, t in items:
        w = words_of(t)
        for s in range(max(1, len(w) - k + 1) if w else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add(i)
    sizes = {len(g) for g in windows}
    out = []
    for d, t in docs:
        w = words_of(t)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(str, out))


@pytest.mark.parametrize("settings", [{}, {"block_words": 700}, {"block_words": 700, "pass_blocks": 3}])
def test_matches_brute_force(spark, docs, settings):
    from conftest import SF

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    item = [(r["item_id"], r["text"]) for r in bench.collect()]
    extra = [(900, "the of"), (901, item[0][1].upper()), (902, None), (903, "..."), (904, " ".join(words_of(item[1][1])[:13])), (905, "the the the")]
    bench = bench.union(spark.createDataFrame(extra, "item_id long, text string"))
    made = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(5000 + i, f"lead {t}\n{t} tail {t}") for i, (_, t) in enumerate(item[:6])] + [(6000, "the " * 500), (6001, None), (6002, "")], "doc_id long, text string"))
    got = dec.decontam_digest(made, bench, **settings).collect()
    assert sorted(str(tuple(r)) for r in got) == brute([(r["doc_id"], r["text"]) for r in made.collect()], item + extra)


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan"), plan.count("MapInArrow")


def test_blocks_share_one_scan_and_one_index(spark):
    from conftest import SF

    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert len(list(dec.item_blocks(bench, "item_id", "text", 700))) > 6
    assert scans(dec.decontam_digest(docs, bench, block_words=700)) == (1, 1)
    more = scans(dec.decontam_digest(docs, bench, block_words=700, pass_blocks=3))
    assert more[0] == 1 and more[1] > 2


def test_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, edge.where("doc_id = 3").first()["text"]), (2, "one")], "item_id long, text string")
    got = dec.decontam_digest(edge, bench).collect()
    assert sorted(str(tuple(r)) for r in got) == brute([(r["doc_id"], r["text"]) for r in edge.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    none = bench.where("item_id < 0")
    assert dec.clean_rows(edge, none).count() == edge.count() and dec.clean_rows(edge, none).columns == edge.columns
    assert dec.clean_rows(empty, bench).count() == 0
    kept = {r["doc_id"] for r in dec.clean_rows(edge, bench).collect()}
    assert 3 not in kept and 7 in kept


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(1)
    runs = [rng.integers(1, 6, rng.integers(1, 40)) for _ in range(60)]
    text = np.concatenate([x for r in runs for x in (r, [0])])
    index = dec.FMIndex(text, 6)
    for n in (1, 2, 3, 5):
        for _ in range(30):
            p = rng.integers(1, 6, n)
            table = np.zeros((1, 7), np.int64)
            table[0, 7 - n:] = p
            lo, hi = index.search(table, np.array([n]))
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want
