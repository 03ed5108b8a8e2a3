"""End-to-end: typed scans of raw/live tables -> four jobs -> written outputs."""

import datetime as dt

from tests.test_jobs import frame
from wellmart.plans import batch
from wellmart.sources.sinks import current
from wellmart.sources.tables import Catalog


def D(*a):
    return dt.datetime(*a)


def test_batch_run_writes_all_outputs(spark, tmp_path):
    raw, live, stage = (str(tmp_path / d) for d in ("raw", "live", "stage"))
    tables = {
        ("raw", "cmpHeader"): [
            dict(API10="4201", CompletionID="C1", state_name="Texas", FirstProducedDate=D(2015, 1, 1),
                 CompletionDate=D(2015, 1, 1)),
            dict(API10="4202", CompletionID="C2", state_name="Louisiana", CompletionDate=D(2015, 2, 1))],
        ("raw", "cmpASvFactJobDetailDenormalized"): [
            dict(DRWellID="D1", API="4201", IngredientName="Water", CalcIngredientMass=10.0, PurposeName="Base Carrier")],
        ("raw", "cmpFracDetail_New"): [
            dict(cmpFracDetailId="F1", CompletionID="C1", materialDescription="Ottawa 40/70", materialType="PROPPANT",
                 materialAmount=5.0, materialUnit="LB")],
        ("raw", "cmpPipe"): [dict(CompletionID="C1", CasingRecordType="CASING", StringType="SURFACE", CasingBottom=500.0)],
        ("raw", "cmpInitialPotentialTest"): [
            {"completion_dr_id": "C2", "testDate": D(2015, 2, 10), "TestOil": 5.0, "24HourGas": 1.0}],
        ("raw", "cmpOKProductionTest"): [{"completionID": "C9", "TestDate": D(2015, 1, 1)}],
        ("raw", "cmpGasMeasurementTest"): [dict(API="4202", CompletionID="C2", RunNumber=1, volumePerDay=3.0)],
        ("raw", "cmpFieldTest"): [dict(API="4201", CompletionID="C1", RunNumber=1, BottomHoleTemp=100.0)],
        ("live", "espHeader"): [
            dict(api="4201", hpdiEntityId=1, play="Permian", completionDate=D(2015, 1, 1), proppantLbs=1.0),
            dict(api="4202", hpdiEntityId=2, play="Other", completionDate=D(2015, 2, 1), treatmentBbls=1.0)],
    }
    for (db, name), rows in tables.items():
        frame(spark, name, rows).write.parquet(f"{raw if db == 'raw' else live}/{name}")
    paths = batch.run(spark, Catalog(raw=raw, live=live, stage=stage))
    widths = {"frac_detail": 48, "piping": 20, "initial_tests": 20, "well_test": 30, "header_mart": 98}
    for key, width in widths.items():
        df = spark.read.parquet(paths[key])
        assert len(df.columns) == width, key
        assert df.count() > 0, key
    mart = {r.api: r for r in spark.read.parquet(paths["header_mart"]).collect()}
    assert mart["4201"].proppantType == "SAND" and mart["4201"].surfaceCasingDepth == 500.0
    assert mart["4202"]["24HourGas"] == 1.0 and mart["4202"].treatmentType == "UNKNOWN"
    # one job on its own, through the command line (same session via getOrCreate)
    from wellmart.__main__ import main
    stage2 = str(tmp_path / "stage2")
    main(["--raw", raw, "--live", live, "--stage", stage2, "--jobs", "piping"])
    assert spark.read.parquet(current(spark, f"{stage2}/espPiping")).count() == spark.read.parquet(paths["piping"]).count()
    # the mart alone, from published tables elsewhere; nothing is written there
    details, stage3 = str(tmp_path / "published"), str(tmp_path / "stage3")
    for key, view in batch.VIEWS.items():
        spark.read.parquet(paths[key]).write.parquet(f"{details}/{view}")
    main(["--raw", raw, "--live", live, "--stage", stage3, "--details", details, "--jobs", "header_mart"])
    again = spark.read.parquet(current(spark, f"{stage3}/espHeaderMart"))
    assert again.exceptAll(spark.read.parquet(paths["header_mart"])).count() == 0 and again.count() == len(mart)
    named = Catalog(raw=raw, live=live, stage=stage3, overrides={"vEspPiping": "/x/pipes"})
    assert batch._published(named, "piping") == "/x/pipes"
    assert batch._published(named, "well_test") == f"{stage3}/espWellTest"
    import pytest
    with pytest.raises(ValueError):
        batch.run(spark, Catalog(raw=raw, live=live, stage=stage2), ["nope"])


def test_keys_ignore_case_and_trailing_blanks(spark, tmp_path):
    raw, live, stage = (str(tmp_path / d) for d in ("raw", "live", "stage"))
    tables = {
        ("raw", "cmpHeader"): [dict(API10="42w1 ", CompletionID="c1", state_name="Texas", CompletionDate=D(2015, 1, 1))],
        ("raw", "cmpPipe"): [dict(CompletionID="C1 ", CasingRecordType="CASING", StringType="SURFACE", CasingBottom=500.0)],
        ("raw", "cmpInitialPotentialTest"): [{"completion_dr_id": "C1", "testDate": D(2015, 2, 10), "TestOil": 5.0, "24HourGas": 1.0}],
        ("raw", "cmpOKProductionTest"): [{"completionID": "C9", "TestDate": D(2015, 1, 1)}],
        ("raw", "cmpGasMeasurementTest"): [dict(API="42W1", CompletionID="C1", RunNumber=1, volumePerDay=3.0)],
        ("raw", "cmpFieldTest"): [dict(API="42w1", CompletionID="c1  ", RunNumber=1, BottomHoleTemp=100.0)],
        ("live", "espHeader"): [dict(api="42W1", hpdiEntityId=1, play="Permian", completionDate=D(2015, 1, 1), proppantLbs=1.0)],
    }
    for (db, name), rows in tables.items():
        frame(spark, name, rows).write.parquet(f"{raw if db == 'raw' else live}/{name}")
    paths = batch.run(spark, Catalog(raw=raw, live=live, stage=stage), ["piping", "well_test"])
    pipe = spark.read.parquet(paths["piping"]).collect()
    assert [(r.API, r.completionId, r.play) for r in pipe] == [("42W1", "C1", "PERMIAN")]
    # gas and field run of one completion meet: one test row with both, none of EXCEPT's leftovers
    tests = spark.read.parquet(paths["well_test"]).collect()
    assert [(r.api, r.completionId, r.bottomHoleTemp) for r in tests] == [("42W1", "C1", 100.0)]


def test_session_settings_are_kept_and_cuts_are_dropped(spark, tmp_path):
    import os

    import pytest

    from wellmart import session
    from wellmart.sources import sinks

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "123456")
    try:
        session.configure(spark)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "123456"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "local-cluster[2,1,1024]"
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Cluster)

    held = len(sinks.CUTS)
    assert sinks.cut_lineage(spark.range(5).toDF("x"), "t").count() == 5
    path = sinks.CUTS[-1].removeprefix("file:")
    assert os.path.isdir(path)
    sinks.drop_cuts(spark, held)
    assert not os.path.isdir(path) and len(sinks.CUTS) == held


def test_null_keys_collect_nothing(spark):
    from pyspark.sql import functions as F

    from wellmart.operators.lists import distinct_list

    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, F.lit("w")).alias("k"), F.concat(F.lit(", i"), F.col("id") % 50).alias("item"))
    got = {r["k"]: r["l"] for r in distinct_list(df, ["k"], F.col("item"), "l").collect()}
    assert got == {None: None, "w": "i0, i10, i20, i30, i40"}
    plan = distinct_list(df, ["k"], F.col("item"), "l")._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull" in plan.lower()
