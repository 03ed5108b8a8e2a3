import re

from pyspark.sql import functions as F

from wellmart.llm import quality as q

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = BLANK.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {p for i, g in enumerate(grams) if seen[g] > 1 for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_upper": sum("A" <= c <= "Z" for c in text), "n_letters": sum(c.isascii() and c.isalpha() for c in text)}


def bits(m):
    env = {k: v for k, v in m.items()}
    return sum(1 << i for i, (_, rule) in enumerate(q.RULES) if eval(rule.replace(" OR ", " or ").replace(" AND ", " and "), {}, env))


def test_measures_and_bits(docs, edge):
    for df in (docs, edge):
        for r in q.ledger(df).collect():
            m = brute(r["row"]["text"])
            assert {k: r[k] for k in q.MEASURES} == m
            assert r["fail_bits"] == bits(m)


def test_policies_and_ablation(docs, edge, empty):
    rows = q.ledger(docs).cache()
    for policy in (q.BASE, q.V1, q.V2):
        got = q.apply_policy(rows, policy)
        assert got.where(F.col("kept") != ((F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))) == 0)).count() == 0
    table = {r["rule"]: r for r in q.ablation(rows, q.V2).collect()}
    all_bits = [r["fail_bits"] & q.V2.mask for r in rows.collect()]
    for rule in q.V2.rules:
        bit = 1 << q.BIT[rule]
        assert table[rule]["failed"] == sum(1 for b in all_bits if b & bit)
        assert table[rule]["failed_alone"] == sum(1 for b in all_bits if b == bit)
    assert q.kept_rows(edge).columns == edge.columns and q.kept_rows(empty).count() == 0
    assert {r["doc_id"] for r in q.kept_rows(edge).collect()} >= {3, 4, 6, 7, 8, 16}


def test_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = q.apply_policy(q.ledger(docs), q.V2).select("row.quality", "kept", "n_words").where("n_words >= 50").collect()
    assert not [r for r in rows if r["quality"] == 1 and not r["kept"]]
    assert not [r for r in rows if r["quality"] == 0 and r["kept"]]


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = q.kept_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
