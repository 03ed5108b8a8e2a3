import re

import corpus_pipeline as P
from test_decontam import brute as brute_hits
from test_quality import bits, brute as measures
from test_simhash import brute_components, brute_fingerprint
from wellmart.llm import quality
from conftest import SF


def stage(spark, name, df):
    return dict(P.STAGES)[name](spark, df, SF)


def test_stages_against_brute_force(spark, docs, rows):
    df = docs
    for name, f in P.STAGES[:3]:
        before = df.collect()
        df = spark.createDataFrame(f(spark, df, SF).collect(), docs.schema)
        got = sorted(r["doc_id"] for r in df.collect())
        if name == "quality_rules":
            want = [r["doc_id"] for r in before if not bits(measures(r["text"])) & quality.V2.mask]
        elif name == "simhash_near_dedup":
            ids = [r["doc_id"] for r in before]
            want = set(brute_components([brute_fingerprint(r["text"]) for r in before], ids))
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            out = brute_hits([(r["doc_id"], r["text"]) for r in before], items)
            want = [int(re.match(r"\((\d+)", x)[1]) for x in out if x.endswith("False)")]
        assert got == sorted(want) and df.columns == docs.columns


def test_run(spark, rows):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    out = got.collect()
    assert 0 < len(out) and {r["doc_id"] for r in out} <= set(rows)
    assert all(rows[r["doc_id"]]["text"] == r["text"] for r in out)
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_edges(spark, edge, empty):
    for df in (edge, empty):
        for k, (name, f) in enumerate(P.STAGES):
            out = f(spark, df, SF)
            if k < 4:
                assert out.columns == df.columns, name
            out.count()
