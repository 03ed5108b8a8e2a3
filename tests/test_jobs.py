"""Golden tests of the four jobs on small literal inputs (expected values computed by hand)."""

import datetime as dt

import pytest
from pyspark.sql.types import StructType

from wellmart.plans import frac_detail, header_mart, piping, well_test
from wellmart.sources.tables import schema


def D(*a):
    return dt.datetime(*a)


def frame(spark, name_or_schema, rows):
    st = schema(name_or_schema) if isinstance(name_or_schema, str) else name_or_schema
    names = [f.name for f in st.fields]
    for r in rows:
        unknown = set(r) - set(names)
        assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], st)


# ----------------------------------------------------------------- piping

@pytest.fixture(scope="module")
def piping_out(spark):
    ch = frame(spark, "cmpHeader", [
        dict(API10="4201", CompletionID="C1", state_name="Texas", PurposeOfFiling="Initial"),
        dict(API10="4202", CompletionID="C2", state_name="LOUISIANA"),
        dict(API10="4203", CompletionID="C3", state_name="Kansas"),
        dict(API10="4204", CompletionID="-1", state_name="TEXAS "),
        dict(API10="4205", CompletionID="C5", state_name="TEXAS "),
        dict(API10="4206", CompletionID=None, state_name="TEXAS"),
    ])
    pipe = frame(spark, "cmpPipe", [
        dict(CompletionID="C1", CasingRecordType="CASING", StringType="SURFACE", CasingSize=9.625, HoleSize=12.25,
             CasingBottom=10.0, CasingTop=0.0, CasingWeight=36.0, CementAmount=0.0, CementClass="UNKNOWN",
             TopOfCement=0.0, TopCementDeterminedBy="UNKNOWN", SlurryVolume=0.0),
        dict(CompletionID="C1", CasingRecordType="casing", StringType="production", CasingSize=5.5, HoleSize=0.0,
             CasingBottom=5000.0, CasingTop=6000.0, CasingWeight=600.0, CementAmount=100.0, CementClass="H",
             TopOfCement=0.0, TopCementDeterminedBy="cbl", SlurryVolume=12.0),
        dict(CompletionID="C1"),  # all ten measures NULL: dropped
        dict(CompletionID="C2", CasingRecordType="UNKNOWN", CasingSize=200.0, CasingBottom=8000.0, CasingTop=0.0),
        dict(CompletionID="C3", CasingRecordType="LINER", CasingBottom=100.0),
        dict(CompletionID="-1", CasingRecordType="LINER", CasingBottom=100.0),
        dict(CompletionID="C5", CasingRecordType="liner", CasingBottom=100.0, CasingTop=50.0),
        dict(CompletionID=None, CasingRecordType="LINER", CasingBottom=100.0),
    ])
    hdr = frame(spark, "espHeader", [
        dict(api="4201", play="Permian", operator="OP A", firstProductionDate=D(2015, 3, 1), completionDate=D(2015, 1, 1)),
        dict(api="4201", play="Delaware", operator="OP A", firstProductionDate=D(2015, 3, 1), completionDate=D(2015, 1, 1)),
        dict(api="4201", play="Old", operator="OP Z", firstProductionDate=D(2014, 3, 1), completionDate=D(2014, 1, 1)),
        dict(api="4202", play="Haynesville", operator="OP B", firstProductionDate=D(2015, 5, 1)),
        dict(api="4205", play="Eagle Ford", operator="OP C"),
        dict(api="0", play="Nowhere"),
        dict(api=None, play="Null api"),
    ])
    return piping.build(ch, pipe, hdr).collect()


def test_piping_shape_and_rows(piping_out):
    assert list(piping_out[0].asDict()) == list(piping.OUTPUT_COLUMNS)
    # 4201: two casing rows x two tied rank-1 header rows; 4202 and 4205: one each
    assert sorted((r.API, r.play) for r in piping_out) == [
        ("4201", "DELAWARE"), ("4201", "DELAWARE"), ("4201", "PERMIAN"), ("4201", "PERMIAN"),
        ("4202", "HAYNESVILLE"), ("4205", "EAGLE FORD")]


def test_piping_cleaning_rules(piping_out):
    by = {(r.API, r.casingType, r.play): r for r in piping_out}
    surface = by[("4201", "SURFACE", "PERMIAN")]
    assert (surface.casingBottom, surface.casingTop, surface.cementAmount, surface.cementClass,
            surface.cementTop, surface.cementTopSource, surface.slurryVolume, surface.casingLength) == (None,) * 8
    assert surface.firstProductionDate == D(2014, 3, 1)  # earliest of the well, not of the rank-1 rows
    prod = by[("4201", "PRODUCTION", "PERMIAN")]
    assert (prod.holeSize, prod.casingWeight, prod.casingLength, prod.cementTopSource) == (None, None, None, "CBL")
    assert prod.filingPrupose == "INITIAL"
    c2 = by[("4202", "CASING", "HAYNESVILLE")]
    assert (c2.casingSize, c2.casingTop, c2.casingLength) == (None, 0.0, 8000.0)
    assert by[("4205", "LINER", "EAGLE FORD")].casingLength == 50.0


# ----------------------------------------------------------------- frac detail

@pytest.fixture(scope="module")
def frac_out(spark):
    ch = frame(spark, "cmpHeader", [
        dict(API10="4201", CompletionID="C1", FirstProducedDate=D(2014, 11, 20), TotalDepthMD=9000.0,
             TotalDepthTVD=8000.0, Reservoir="WOLFCAMP", PurposeOfFiling="initial"),
        dict(API10="4201", CompletionID="C2", FirstProducedDate=D(2015, 1, 31), TotalDepthTVD=8500.0),
        dict(API10="4202", CompletionID="C3", FirstProducedDate=D(1950, 6, 1)),
    ])
    ff = frame(spark, "cmpASvFactJobDetailDenormalized", [
        dict(DRWellID="D1", API="4201", IngredientName="Water", CalcIngredientMass=349860.0, IngredientMassUOM="lb",
             PurposeName="Base Carrier", FFVersion=2, MD=9100.0),
        dict(DRWellID="D1", API="4201", IngredientName="Sand", CalcIngredientMass=1000.0, IngredientMassUOM="LB",
             PurposeName="Proppant", IngredientIsSand="Y", TradeSandMeshSize="", IngredientSandMeshSize="40/70",
             FFVersion=3, MD=9100.0),
        dict(DRWellID="D2", API="4202", IngredientName="Quartz & silica", CalcIngredientMass=500.0,
             IngredientMassUOM="lb", PurposeName="PROPPANT", FFVersion=9, PurposeDescription="NULL", MD=1.0),
    ])
    fd = frame(spark, "cmpFracDetail_New", [
        dict(cmpFracDetailId="F1", API10="4201", CompletionID="C1", materialDescription="PRIME PLUS 40/70",
             materialType="PROPPANT", materialAmount=5000.0, materialUnit="LB", StageNumber=3, isSummary="1",
             contractorName="Halliburton"),
        dict(cmpFracDetailId="F2", API10="4201", CompletionID="C1", materialDescription="Water",
             materialType="BASE CARRIER", materialAmount=42000.0, materialUnit="GAL", StageNumber=-1, isSummary="0"),
        dict(cmpFracDetailId="F3", API10="4201", CompletionID="C1", materialDescription="Friction Reducer",
             materialType="FRICTION REDUCER", materialAmount=10.0, materialUnit="GAL", StageNumber=5),
        dict(cmpFracDetailId="F4", API10=None, CompletionID="C9", materialDescription="16-30 white",
             materialType="ADDITIVE", materialAmount=5.0, materialUnit="unknown"),
        dict(cmpFracDetailId="F5", API10="4201", CompletionID="C2", materialDescription="Fresh Water",
             materialType="BASE CARRIER", materialAmount=100.0, materialUnit="bbl"),
    ])
    hdr = frame(spark, "espHeader", [
        dict(api="4201", play="Permian", operator="OP A", firstProductionDate=D(2015, 3, 1), stages=20, tvd=1.0),
        dict(api="4201", play="Permian", operator="OP OLD", firstProductionDate=D(2015, 1, 15)),
        dict(api="4202", play="Haynesville", operator="OP B", firstProductionDate=D(2015, 5, 1)),
    ])
    return frac_detail.build(ff, ch, fd, hdr).collect()


def test_frac_detail_shape(frac_out):
    assert len(frac_out[0]) == 48
    assert list(frac_out[0].asDict())[:4] == ["api10", "play", "completionId", "fracDetailId"]
    # disclosure: 2 rows of well 4201 x 2 completions with different TVD + 1 row; state: 5 rows
    assert len(frac_out) == 10
    assert sorted(r.trueVerticalDepth for r in frac_out if r.fracDetailId == "D1") == [8000.0, 8000.0, 8500.0, 8500.0]


def test_frac_detail_disclosure_rules(frac_out):
    water = [r for r in frac_out if r.fracDetailId == "D1" and r.materialName == "WATER"][0]
    assert (water.materialUnit, water.materialType, water.sourceColumn, water.filingPurpose) == \
        ("LBS", "BASE CARRIER", "FF 2", "FRACFOCUS")
    assert water.cumWaterBbl is None  # LBS never equals LB
    assert water.firstProducedDate == D(2014, 11, 20)
    sand = [r for r in frac_out if r.materialName == "SAND"][0]
    assert (sand.proppantType, sand.proppantMeshSize, sand.materialUnit) == ("SAND", "40/70", "LBS")
    d2 = [r for r in frac_out if r.fracDetailId == "D2"][0]
    assert (d2.materialName, d2.proppantType, d2.proppantMeshSize, d2.sourceColumn) == \
        ("QUARTZ & SILICA", "UNKNOWN", "UNKNOWN", "FF")
    assert d2.purposeDescription is None
    assert d2.firstProducedDate == D(2015, 5, 1)  # the 1950 date is dropped, the header minimum used


def test_frac_detail_state_rules(frac_out):
    by = {r.fracDetailId: r for r in frac_out if r.sourceColumn == "STATE ANGENCY"}
    f1, f2, f3, f4 = by["F1"], by["F2"], by["F3"], by["F4"]
    assert (f1.supplierName, f1.proppantType, f1.proppantMeshSize, f1.isSummary) == \
        ("HEXION", "RESIN COATED", "40/70", "YES")
    assert (f1.stageNumber, f1.numberOfStages) == (3, 5)  # filled from the well's highest stage
    assert (f2.stageNumber, f2.numberOfStages, f2.isSummary) == (None, 20, "NO")  # then the header's stages
    assert f2.supplierName == "UNKNOWN"
    assert f1.firstProducedDate == D(2014, 11, 20)  # two month boundaries before the earliest
    assert f2.cumWaterBbl == pytest.approx(47010.0 / 42)
    assert f1.cumWaterBbl is None and f3.cumWaterBbl is None
    assert {f1.treatmentType, f2.treatmentType, f3.treatmentType} == {"WATER FRAC"}
    assert (f4.api10, f4.treatmentType, f4.proppantMeshSize, f4.materialUnit, f4.firstProducedDate) == \
        (None, None, "16/30", None, None)
    assert f1.currentOperator == "OP A" and f1.trueVerticalDepth == 8000.0
    f5 = by["F5"]
    assert (f5.cumWaterBbl, f5.treatmentType, f5.completionId) == (100.0, "UNKNOWN", "C2")  # Bbl: as is


# ----------------------------------------------------------------- well test

@pytest.fixture(scope="module")
def well_test_out(spark):
    ch = frame(spark, "cmpHeader", [
        dict(API10="4201", CompletionID="C1", state_name="Texas", FormType="W-2", CompletionDate=D(2015, 1, 1)),
        dict(API10="4202", CompletionID="C2", state_name="Louisiana", FormType="F"),
        dict(API10="4203", CompletionID="C3", state_name="oklahoma"),
        dict(API10="4204", CompletionID="C4", state_name="MONTANA", FormType="G-1"),
        dict(API10="4205", CompletionID="C5", state_name="Texas", FormType="W-2"),
    ])
    cols = "`24HourOil`"
    assert cols
    ip = frame(spark, "cmpInitialPotentialTest", [
        {"completion_dr_id": "C2", "testDate": D(1950, 1, 1), "Duration": "12 HRS", "TestOil": 50.0, "TestGas": 7.0,
         "TestWater": 3.0, "24HourGas": 100.0, "ChokeSize": "0.0", "ProducingMethod": "unknown",
         "SizeAndTypeOfPump": "n/a"},
        {"completion_dr_id": "C1", "testDate": D(2015, 2, 1), "Duration": "24 HRS", "TestOil": 10.0,
         "TestGas": 20.0, "24HourWater": 5.0, "ProducingMethod": "flowing"},
        {"completion_dr_id": "C4", "testDate": D(2015, 2, 1), "Duration": "12 HRS", "24HourGas": 30.0},
        {"completion_dr_id": "C3", "testDate": D(2015, 3, 1), "24HourOil": 5.0, "OilGravity": 40.0},
        {"completion_dr_id": "C5", "testDate": D(1951, 1, 1), "24HourOil": 1.0},
        {"completion_dr_id": "C5", "testDate": D(1951, 1, 2), "24HourOil": 2.0},
    ])
    ok = frame(spark, "cmpOKProductionTest", [
        {"completionID": "C3", "TestDate": D(2015, 3, 1), "TestFormation": "HUNTON", "24HourGas": 0.0,
         "24HourOil": 5.0, "ChokeSize": "0", "OilGravity": 40.0},
        {"completionID": "C3", "TestDate": D(2015, 3, 2), "TestFormation": "OTHER", "24HourOil": 5.0,
         "OilGravity": 40.0},
    ])
    gm = frame(spark, "cmpGasMeasurementTest", [
        dict(API="4201", CompletionID="C1", RunNumber=1, volumePerDay=99.0),
        dict(API="4201", CompletionID="C1", RunNumber=2, volumePerDay=50.0),
        dict(API="4204", CompletionID="C4", RunNumber=1, volumePerDay=77.0),
        dict(API="4205", CompletionID="C5", RunNumber=2, volumePerDay=55.0),
        dict(API=None, CompletionID=None, RunNumber=1, volumePerDay=1.0),
    ])
    ft = frame(spark, "cmpFieldTest", [
        dict(API="4201", CompletionID="C1", RunNumber=1, BottomHoleTemp=180.0, GravityLiquidHydrocarbon=41.7,
             RunChokeSize="16/64", TimeOfRun="24"),
        dict(API="4202", CompletionID="C2", RunNumber=1, BottomHoleTemp=150.0, GravityLiquidHydrocarbon=38.2),
        dict(API="4205", CompletionID="C5", RunNumber=2, BottomHoleTemp=99.0),
        dict(API=None, CompletionID=None, RunNumber=1, BottomHoleTemp=1.0),
    ])
    hdr = frame(spark, "espHeader", [
        dict(api="4201", play="Permian", operator="OP A", firstProductionDate=D(2015, 3, 1)),
        dict(api="4202", play="Haynesville", operator="OP B", firstProductionDate=D(2015, 4, 1)),
        dict(api="4204", play="Bakken", operator="OP D", firstProductionDate=D(2015, 4, 1)),
    ])
    initial, tests = well_test.build(ch, ip, ok, gm, ft, hdr)
    return initial.collect(), tests.collect()


def test_initial_tests_rate_fill(well_test_out):
    initial, _ = well_test_out
    assert list(initial[0].asDict()) == list(well_test.INITIAL_TEST_COLUMNS)
    by = {r.CompletionID: r for r in initial}
    c2, c1, c4, c3 = by["C2"], by["C1"], by["C4"], by["C3"]
    assert (c2["24HourOil"], c2["24HourGas"], c2["24HourWater"]) == (50.0, 100.0, 3.0)  # Louisiana
    assert (c2.ChokeSize, c2.ProducingMethod, c2.SizeAndTypeOfPump) == (None, None, "N/A")
    assert (c1["24HourOil"], c1["24HourGas"], c1["24HourWater"]) == (10.0, 20.0, 5.0)  # Texas, 24 hours
    assert (c4["24HourOil"], c4["24HourGas"], c4["24HourWater"]) == (0.0, 30.0, None)  # 0 from the sibling
    assert c3.TestFormation == "HUNTON"  # Oklahoma: NULL gas matched 0 gas; the other test date did not match
    assert len(initial) == 6


def test_well_tests_children_and_rank(well_test_out):
    _, tests = well_test_out
    assert len(tests[0]) == 30
    # both tables but run 2 only: no child row; test dates on/after the 1951 floor
    c5 = sorted((r for r in tests if r.completionId == "C5"), key=lambda r: r["24HourOil"])
    assert [(r.testDate, r.bottomHoleTemp, r.runNUmberGM, r.runNumberFT) for r in c5] == \
        [(None, None, None, None), (D(1951, 1, 2), None, None, None)]
    # no published header for C3 or C5: they share the NULL rank partition, ranked
    # on the raw test date (C3 2015-03-01, then 1951-01-02, then 1951-01-01)
    assert [r.dateRank for r in c5] == [3, 2]
    assert [r.dateRank for r in tests if r.completionId == "C3"] == [1]
    assert all(r.api is not None for r in tests)  # NULL child keys match nothing
    by = {r.completionId: r for r in tests if r.completionId != "C5"}
    c1, c2, c3, c4 = by["C1"], by["C2"], by["C3"], by["C4"]
    assert (c1["24HourGas"], c1.oilGravity, c1.bottomHoleTemp, c1.chokeSize, c1.runNumberFT, c1.runNUmberGM) == \
        (20.0, 41, 180.0, "16/64", 1, 1)
    assert (c4["24HourGas"], c4.runNUmberGM, c4.runNumberFT) == (30.0, 1, None)  # gas-only
    assert (c2.bottomHoleTemp, c2.oilGravity, c2.testDate, c2.pumpType) == (150.0, 38, None, None)  # field-only
    assert (c3.bottomHoleTemp, c3.testFormation, c3.play, c3.oilGravity) == (None, "HUNTON", None, 40)
    assert (c1.play, c1.currentOperator, c1.firstProductionDate) == ("Permian", "OP A", D(2015, 3, 1))
    assert c1["24HourGasOilRatio"] == 2.0
    assert {r.dateRank for r in tests if r.completionId != "C5"} == {1}


# ----------------------------------------------------------------- header mart

def test_header_mart(spark):
    hdr = frame(spark, "espHeader", [
        dict(api="4201", hpdiEntityId=1, play="Permian", operator="OP A", firstProductionDate=D(2015, 3, 1),
             completionDate=D(2015, 1, 31), proppantLbs=1e6, treatmentBbls=None, playArea="delaware"),
        dict(api="4201", hpdiEntityId=1, play="Permian", operator="OP A", firstProductionDate=D(2014, 3, 1),
             completionDate=D(2014, 1, 1), proppantLbs=1e6),
        dict(api="4202", hpdiEntityId=2, play="Other", operator="OP B", firstProductionDate=D(2015, 5, 1),
             completionDate=D(2015, 4, 1), proppantLbs=None, treatmentBbls=5.0),
        dict(api="4209", hpdiEntityId=9, play="None", operator="OP N"),  # no detail: dropped
    ])
    frac_schema = StructType.fromDDL("api10 string, materialType string, proppantType string, "
                                     "treatmentType string, proppantMeshSize string, materialName string, "
                                     "cumWaterBbl double")
    frac = frame(spark, frac_schema, [
        dict(api10="4201", materialType="PROPPANT", proppantType="SAND", proppantMeshSize="40/70", cumWaterBbl=10.0),
        dict(api10="4201", materialType="PROPPANT", proppantType="RESIN COATED", proppantMeshSize="40/70"),
        dict(api10="4201", materialType="BASE CARRIER", treatmentType="WATER FRAC", cumWaterBbl=99.0),
        dict(api10="4202", materialType="PROPPANT", proppantType=None),
    ])
    pipe = frame(spark, StructType.fromDDL("API string, casingType string, casingBottom double"), [
        dict(API="4201", casingType="SURFACE", casingBottom=500.0),
        dict(API="4201", casingType="surface ", casingBottom=450.0),
        dict(API="4201", casingType="PRODUCTION", casingBottom=10.0),
    ])
    test_cols = ", ".join(f"`{c}` double" if c not in ("testFormation", "producingMethod", "pumpType", "chokeSize")
                          else f"`{c}` string" for c, _ in header_mart.MART_TEST_COLUMNS)
    tests = frame(spark, StructType.fromDDL(f"api string, completionDate timestamp_ntz, dateRank long, {test_cols}"), [
        {"api": "4201", "completionDate": D(2014, 12, 31, 9), "dateRank": 1, "24HourOil": 11.0},
        {"api": "4201", "completionDate": D(2013, 1, 1), "dateRank": 2, "24HourOil": 22.0},
        {"api": "4202", "completionDate": D(2015, 1, 1), "dateRank": 1, "24HourOil": 33.0},
    ])
    out = header_mart.build(hdr, frac, pipe, tests).collect()
    assert len(out[0]) == 98
    by = {(r.api, r.dateRank): r for r in out}
    assert set(by) == {("4201", 1), ("4201", 2), ("4202", 1)}
    top = by[("4201", 1)]
    assert (top.proppantType, top.proppantMeshSize, top.treatmentType) == ("RESIN COATED, SAND", "40/70", None)
    assert (top.totalWaterBbl, top.surfaceCasingDepth, top["24HourOil"], top.playArea, top.play) == \
        (99.0, 450.0, 11.0, "DELAWARE", "PERMIAN")
    assert by[("4201", 2)]["24HourOil"] is None  # rank-2 header rows keep NULL test columns
    w2 = by[("4202", 1)]
    # known treatment total but no treatment list -> UNKNOWN; no proppant total -> NULL
    assert (w2.treatmentType, w2.proppantType, w2["24HourOil"]) == ("UNKNOWN", None, None)
