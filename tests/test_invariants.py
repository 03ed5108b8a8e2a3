"""Invariants on the benchmark tables."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from wellmart.functions.rules import TREATMENT_TYPES
from wellmart.plans import header_mart
from wellmart.sources.tables import read_table, schema

SF = os.environ.get("WELLMART_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
Q = queries()


def test_union_count_is_sum_of_feeds(spark):
    n = Q["union_feeds"](spark, SF).count()
    assert n == read_table(spark, SF, "lineitem").count() + read_table(spark, SF, "orders").count()


def test_treatment_classes_are_known(spark):
    got = {r[0] for r in Q["treatment_classify"](spark, SF).select("treatmentType").distinct().collect()}
    assert got <= set(TREATMENT_TYPES) | {None}
    assert len(got) > 3


def test_latest_row_one_per_well_and_is_latest(spark):
    df = Q["latest_row"](spark, SF)
    o = read_table(spark, SF, "orders")
    assert df.count() == o.select("o_custkey").distinct().count()
    latest = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("m"), F.min("o_orderdate").alias("mn"))
    bad = df.join(latest, "o_custkey").where((F.col("o_orderdate") != F.col("m")) | (F.col("minDate") != F.col("mn")))
    assert bad.count() == 0


def test_except_results_disjoint(spark):
    df = Q["keys_only_in"](spark, SF)
    gas = df.where(F.col("GM_RunNumber").isNotNull() & F.col("FT_RunNumber").isNull()).select("API", "CompletionID")
    field = df.where(F.col("FT_RunNumber").isNotNull() & F.col("GM_RunNumber").isNull()).select("API", "CompletionID")
    assert gas.intersect(field).count() == 0
    assert gas.count() > 0 and field.count() > 0


def test_every_mart_well_has_a_rank_one_row(spark):
    df = Q["header_mart"](spark, SF)
    per = df.groupBy("api").agg(F.min("dateRank").alias("r"))
    assert per.where(F.col("r") != 1).count() == 0


def test_left_joins_keep_every_header_row(spark):
    n_orders = read_table(spark, SF, "orders").count()
    assert Q["month_window_join"](spark, SF).select("o_orderkey").distinct().count() == n_orders
    assert Q["surface_min"](spark, SF).count() == n_orders


#: The source's header pull after dateRank, in order; "a=b" is column a under the name b.
HEADER_PULL = """state county field reservoir reservoirAlias primaryProduct wellbore perfInterval perfIntervalSource section township
range quarterQuarter abstract survey upperPerforation lowerPerforation totalDepth tvd latitude27 longitude27 basin playArea
spudDate completionDate firstProductionDate lastProductionDate maxIpOil maxIpGas maxIpOilPending maxIpGasPending
cum3MonthsOil cum3MonthsGas cum3MonthsWater cum6MonthsOil cum6MonthsGas cum6MonthsWater cum12MonthsOil cum12MonthsGas
cum12MonthsWater cum24MonthsOil cum24MonthsGas cum24MonthsWater cum60MonthsOil cum60MonthsGas cum60MonthsWater cumTotalOil
cumTotalGas cumTotalWater vnUltimateOil_Bbl=EUROil vnUltimateGas_Mcf=EURgas azimuth lateralLength cumulativeGasOilRatio
firstGasOilRatio lastGasOilRatio pracIPGasOilRatio first3MonthsGasOilRatio wellType oilGravity gasGravity lastProductionOil
lastProductionGas lastProductionWater allocFlag intermediateCasing simulFrac padDrill linerSize tubingSize stages
proppantLbs=totalProppantLbs treatmentBbls=totalTreatmentBbls""".split()


def test_mart_query_runs_the_whole_header_pull(spark):
    names = [c.split("=")[-1] for c in HEADER_PULL]
    mart = Q["header_mart"](spark, SF)
    assert len(mart.columns) == 98 and mart.columns[5:5 + len(names)] == names
    declared = {f.name: f.dataType for f in schema("espHeader")}
    assert all(mart.schema[c.split("=")[-1]].dataType == declared[c.split("=")[0]] for c in HEADER_PULL)


def test_header_pull_takes_each_column_from_its_own(spark):
    fields = schema("espHeader")
    values = [datetime(2000, 1, 1) + timedelta(i) if "timestamp" in f.dataType.simpleString() else
              {"string": f"V{i}", "double": float(i)}.get(f.dataType.simpleString(), i) for i, f in enumerate(fields)]
    of = dict(zip(fields.names, values))
    header = spark.createDataFrame([values], fields)
    row = header_mart.header_pull(header, header.select("api")).first()
    assert [row[n] for n in (c.split("=")[-1] for c in HEADER_PULL)] == [of[c.split("=")[0]] for c in HEADER_PULL]
