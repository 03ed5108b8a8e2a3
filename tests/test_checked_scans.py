"""Scans against the declared layout: drifted files stop the run at its start, unreadable values cost one row."""

import pytest
from pyspark.sql import functions as F

from wellmart.plans import batch
from wellmart.sources.sinks import current
from wellmart.sources.tables import SCHEMAS, Catalog, SchemaDrift, schema


def catalog(tmp_path):
    return Catalog(raw=str(tmp_path / "raw"), live=str(tmp_path / "live"), stage=str(tmp_path / "stage"))


def write(spark, cat, name, rows=1, db="raw", **changed):
    """A table of the declared layout; ``changed`` maps a column to an expression, or None to leave it out."""
    columns = [changed.get(f.name, F.lit("k" if f.name.lower() in ("api", "api10", "completionid") else None).cast(f.dataType))
               for f in schema(name).fields]
    df = spark.range(rows).select(*[c.alias(f.name) for c, f in zip(columns, schema(name).fields) if c is not None])
    df.write.mode("overwrite").parquet(cat.path(name, db))
    return df


def test_agreeing_files_are_read_as_they_are(spark, tmp_path):
    cat = catalog(tmp_path)
    for name in SCHEMAS:
        write(spark, cat, name)
        df = cat.read(spark, name)
        assert df.columns == schema(name).fieldNames() and [f.dataType for f in df.schema] == [f.dataType for f in schema(name)]
        assert df.count() == 1
    assert cat.check(spark, [(n, "raw") for n in SCHEMAS]) == {}


def test_all_faults_are_named_before_the_run(spark, tmp_path):
    cat = catalog(tmp_path)
    write(spark, cat, "cmpHeader", state_name=None)
    spark.read.parquet(cat.path("cmpHeader")).withColumn("StateName", F.lit("x")).write.parquet(cat.path("moved"))
    cat.overrides["cmpHeader"] = cat.path("moved")
    write(spark, cat, "cmpPipe", CasingTop=F.array(F.lit(1.0)))
    write(spark, cat, "espHeader", db="live")
    with pytest.raises(SchemaDrift) as e:
        batch.run(spark, cat, ["piping"])
    assert e.value.faults == ["cmpHeader.state_name is missing (not declared: StateName)",
                              "cmpPipe.CasingTop is array<double>, not double"]
    with pytest.raises(SchemaDrift):
        cat.read(spark, "cmpPipe")
    assert not (tmp_path / "stage").exists()


def test_unreadable_values_are_set_aside(spark, tmp_path):
    cat = catalog(tmp_path)
    odd = F.when(F.col("id") % 10 == 3, F.lit("n/a")).when(F.col("id") % 10 == 4, F.lit(None)).otherwise(F.col("id").cast("string"))
    write(spark, cat, "cmpGasMeasurementTest", 50, volumePerDay=odd, RunNumber=F.when(F.col("id") == 13, F.lit(1 << 40)).otherwise(F.col("id")))
    good = cat.read(spark, "cmpGasMeasurementTest")
    assert dict(good.dtypes)["volumePerDay"] == "double" and dict(good.dtypes)["RunNumber"] == "int"
    assert sorted((r.RunNumber, r.volumePerDay) for r in good.where("volumePerDay IS NOT NULL").collect()) == [
        (i, float(i)) for i in range(50) if i % 10 not in (3, 4)]
    assert good.where("volumePerDay IS NULL").count() == 5  # NULL is a value
    rejects = cat.check(spark, [("cmpGasMeasurementTest", "raw")])["cmpGasMeasurementTest"]
    assert sorted((r.RunNumber, r.volumePerDay, *sorted(r.rejected_columns)) for r in rejects.collect()) == sorted(
        [(i, "n/a", "volumePerDay") for i in (3, 23, 33, 43)] + [(1 << 40, "n/a", "RunNumber", "volumePerDay")])


def test_run_publishes_rejects_and_ends(spark, tmp_path):
    cat = catalog(tmp_path)
    write(spark, cat, "cmpHeader", state_name=F.lit("Texas"))
    write(spark, cat, "cmpPipe", 4, CasingRecordType=F.lit("CASING"), StringType=F.lit("SURFACE"), CasingBottom=F.when(F.col("id") == 0, F.lit("deep")).otherwise(F.lit("500.5")))
    write(spark, cat, "espHeader", db="live")
    out = batch.run(spark, cat, ["piping"])
    assert {r.casingBottom for r in spark.read.parquet(out["piping"]).collect()} == {500.5}
    kept = spark.read.parquet(current(spark, cat.path("cmpPipe_rejects", "stage")))
    assert [(r.CasingBottom, r.rejected_columns) for r in kept.collect()] == [("deep", ["CasingBottom"])]
