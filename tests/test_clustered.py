"""Clustered outputs, products by blocks, and intermediates with an owner."""

import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wellmart.operators.joins import product_join
from wellmart.session import ensure_checkpoint_dir
from wellmart.sources.sinks import CUTS, cut_lineage, publish, scratch


@pytest.fixture
def settings(spark):
    before = {}

    def put(**kv):
        for k, v in kv.items():
            k = k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_read(df) -> int:
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value()


def test_keyed_reads_skip_files_and_hot_keys_split(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="128k", spark__sql__shuffle__partitions="64")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id") % 4001))
    rows = spark.range(0, 60000, 1, 8).select(key.alias("api"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    at = publish(rows, str(tmp_path / "t"), cluster_by="api")
    back = spark.read.parquet(at)
    assert back.count() == 60000 and back.exceptAll(rows).isEmpty()
    files = back.select("api", F.input_file_name().alias("f")).distinct().collect()
    per_key = Counter(r["api"] for r in files)
    assert len(glob.glob(f"{at}/*.parquet")) >= 8 and per_key["hot"] > 2
    assert sum(per_key.values()) < 3 * len(per_key)  # a well lies in few files
    light = sorted(k for k in per_key if per_key[k] == 1)
    assert len(light) > len(per_key) / 2
    in_file = dict(back.groupBy(F.input_file_name()).count().collect())
    home = {r["api"]: r["f"] for r in files}
    assert max(in_file.values()) < 60000 / 2
    assert all(0 < rows_read(back.where(F.col("api") == k)) <= in_file[home[k]] for k in light[:3])
    assert rows_read(back.where("api = 'w17x'")) == 0  # inside the range of every file, but in none


def product(spark, n, m):
    left = spark.range(n + 50).select(F.when(F.col("id") < n, F.lit("big")).otherwise((F.col("id") % 7).cast("string")).alias("a"), F.col("id").alias("x"))
    right = spark.range(m + 50).select(F.when(F.col("id") < m, F.lit("big")).otherwise((F.col("id") % 9).cast("string")).alias("b"), F.col("id").alias("y"))
    null = spark.sql("SELECT CAST(NULL AS string) AS k, 1L AS v")
    return left.union(null), right.union(null).union(right.where("y < 3"))


def test_product_by_blocks_equals_the_join_and_spreads(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    left, right = product(spark, 300, 200)
    want = left.join(right, F.col("a") == F.col("b"))
    got = product_join(left, right, "a", "b", pairs=5000, block=50)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    tasks = got.where("a = 'big'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 0.5 * 300 * 203
    plain = want.where("a = 'big'").groupBy(F.spark_partition_id()).count().collect()
    assert len(plain) == 1


def test_product_without_a_heavy_key_is_the_plain_join(spark):
    left, right = product(spark, 5, 4)
    got = product_join(left, right, "a", "b")
    assert "__l0" not in got._jdf.queryExecution().toString()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, left.join(right, F.col("a") == F.col("b")).collect()))


def test_intermediates_go_with_their_owner(spark):
    ensure_checkpoint_dir(spark)
    held = list(CUTS)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        assert cut_lineage(spark.range(3), "owned").count() == 3
        path = CUTS[-1]
        with scratch(spark):
            cut_lineage(spark.range(2), "inner")
            inner = CUTS[-1]
        assert CUTS[-1] == path and not os.path.exists(inner.removeprefix("file:")) and os.path.exists(path.removeprefix("file:"))
        raise ZeroDivisionError
    assert CUTS == held and not os.path.exists(path.removeprefix("file:"))
