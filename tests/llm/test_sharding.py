import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from wellmart.llm import sharding as sh


def check(df, **settings):
    rows = df.collect()
    got = sh.shard(df, **settings).collect()
    n, shards = len(rows), settings.get("shards", 16)
    assert Counter(map(str, rows)) == Counter(str(r["row"]) for r in got)
    for r in got:
        data = (r["row"]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(0 <= s < shards for s in by)
    count = [len(by.get(s, [])) for s in range(shards)]
    assert count == [math.ceil((s + 1) * n / shards) - math.ceil(s * n / shards) for s in range(shards)]
    again = sh.shard(df.repartition(6), **settings).collect()
    assert sorted((str(r["row"]), r["shard"], r["slot"]) for r in again) == sorted((str(r["row"]), r["shard"], r["slot"]) for r in got)
    return got


def test_rows_are_dealt_once_and_evenly(docs):
    a = check(docs, bucket_bytes=1 << 15)
    check(docs)
    b = sh.shard(docs, bucket_bytes=1 << 15, seed=1).collect()
    at = lambda rows: {r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert sum(at(a)[d] == at(b)[d] for d in at(a)) < 20
    assert {r["shard"] for r in a if r["row"]["source"] == "src1"} != {0}


def test_edges(edge, empty):
    check(edge, shards=3)
    check(edge, bucket_bytes=200)
    assert sh.shard(empty).count() == 0
    assert sorted(sh.sharded_rows(edge).columns) == sorted({*edge.columns, "slot"})


def test_half_the_rows_are_one_row(spark, docs):
    """Copies of a row that fills a bucket by itself spread over buckets; each stays a row of its own."""
    n = docs.count()
    hot = spark.range(n).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "repeat('same words ', 40) AS text",
                                    *[f"CAST(NULL AS {t}) AS {c}" for c, t in docs.dtypes if c not in ("doc_id", "text")])
    both = docs.select("doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")]).union(hot)
    got = check(both, bucket_bytes=1 << 13)
    at = sorted(r["shard"] for r in got if r["row"]["doc_id"] is None)
    assert len(at) == n and set(at) == set(range(16)) and max(at.count(s) for s in range(16)) < n / 4
    rows = both.select(F.struct("*").alias("row"), F.col("doc_id").alias("_i"), sh.row_bytes(F.col("text")).alias("size"),
                       F.lit(0).alias("text_crc32"), F.xxhash64("doc_id", "text").alias("_h"))
    bucket = F.pmod("_h", F.lit(256)).cast("int").alias("bucket")
    dealt = sh.deal_repeated(rows, rows.select(bucket).distinct(), bucket, 3, 1 << 13, 4)
    assert dealt.groupBy("_h").count().agg(F.max("count")).first()[0] < n / 4
    assert dealt.count() == 2 * n


def test_offsets_are_prefix_sums(spark):
    rows = [(b, b % 7 + 1) for b in range(0, 3 * sh.RANGE, 5)]
    got = {r["bucket"]: r["offset"] for r in sh.bucket_offsets(spark.createDataFrame(rows, "bucket int, n long")).collect()}
    total = 0
    for b, n in rows:
        assert got[b] == total
        total += n


def test_written_shards(docs, tmp_path):
    placed = sh.shard(docs, bucket_bytes=1 << 15)
    sh.write_shards(placed, str(tmp_path / "s"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "s"))
    assert sorted((r["row"]["doc_id"], r["shard"], r["slot"]) for r in back.collect()) == sorted(
        (r["row"]["doc_id"], r["shard"], r["slot"]) for r in placed.collect())


def test_plan_has_no_python(docs):
    plan = sh.shard(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
