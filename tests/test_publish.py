"""Full refresh without a gap: versions and one pointer."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from wellmart.sources.sinks import POINTER, current, publish
from wellmart.sources.tables import Catalog


def read(spark, path):
    return sorted(r[0] for r in spark.read.parquet(current(spark, path)).collect())


def test_refresh_keeps_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish(spark.range(3), path)
    held = spark.read.parquet(current(spark, path))  # a reader of the first version
    assert first == current(spark, path) and read(spark, path) == [0, 1, 2]
    publish(spark.range(5), path, sort_within=["id"])
    assert held.count() == 3 and read(spark, path) == [0, 1, 2, 3, 4]
    publish(spark.range(1), path + "/")
    assert read(spark, path) == [0] and not os.path.exists(first)
    assert len([n for n in os.listdir(path) if not n.startswith(".")]) == 3  # two versions and the pointer


def test_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    with pytest.raises(Exception, match="broken row"):
        publish(spark.range(0, 100, 1, 8).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken row")))), path)
    assert read(spark, path) == [0, 1, 2]
    publish(spark.range(2), path)
    assert read(spark, path) == [0, 1] and len([n for n in os.listdir(path) if not n.startswith(".")]) == 3


def test_killed_run_leaves_the_old_table(spark, tmp_path):
    path, repo = str(tmp_path / "t"), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    publish(spark.range(3), path)
    code = f"""
import sys, time
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from wellmart.session import local_session
from wellmart.sources.sinks import publish
spark = local_session(2)
slow = F.udf(lambda x: (time.sleep(0 if x < 900 else 600), x)[1], "long")
publish(spark.range(0, 1000, 1, 10).select(slow("id").alias("id")), {path!r})
"""
    run = subprocess.Popen([sys.executable, "-c", code], start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        for _ in range(240):
            if any(f.endswith(".parquet") for d, _, names in os.walk(path) if "_temporary" in d for f in names):
                break
            time.sleep(0.5)
        else:
            pytest.fail("the run wrote nothing")
        assert read(spark, path) == [0, 1, 2]  # while it writes
    finally:
        os.killpg(run.pid, 9)
        run.wait()
    assert read(spark, path) == [0, 1, 2]
    publish(spark.range(4), path)
    assert read(spark, path) == [0, 1, 2, 3] and len([n for n in os.listdir(path) if not n.startswith(".")]) == 3


def test_plain_tables_are_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.createDataFrame([("4201", 1)], "API string, RunNumber int").write.parquet(path)
    assert current(spark, path) == path
    catalog = Catalog(raw=str(tmp_path), live="", stage="", overrides={"x": path})
    assert catalog.read(spark, "x").count() == 1
    publish(spark.createDataFrame([("a ", 1), ("b", 2)], "API string, RunNumber int"), path)
    assert sorted(r.API for r in catalog.read(spark, "x").collect()) == ["A", "B"]
    publish(spark.createDataFrame([("c", 1)], "API string, RunNumber int"), path)
    assert POINTER in os.listdir(path) and not [n for n in os.listdir(path) if n.endswith(".parquet")]
