"""Typed scans of the raw and published inputs.

Each input has a declared schema. The files' own schema is compared with it
before a job starts (``Catalog.check``); values of another type are cast one by
one and rows that cannot be are set aside (``conform``). Well and completion keys
compare without case and trailing blanks, so the scan folds them to one
spelling (``fold_keys``) and every later join, grouping, rank and EXCEPT can
compare them plainly. A job reads only the columns it selects; Parquet scans get column pruning and filter pushdown from
Catalyst, so listing the full schema here costs nothing at read time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StructField, StructType

from wellmart.sources.sinks import current

_NUM = "double"
_TS = "timestamp_ntz"

# Input schemas (column names as the source tables spell them).
SCHEMAS: dict[str, str] = {
    "cmpHeader": ", ".join([
        "API10 string", "CompletionID string", "PurposeOfFiling string", "TypeOfCompletion string",
        "FormType string", "state_name string", f"CompletionDate {_TS}", f"CompletionSpudDate {_TS}",
        f"FirstProducedDate {_TS}", f"TotalDepthMD {_NUM}", f"TotalDepthTVD {_NUM}", "Reservoir string",
        f"DateDrillingCommenced {_TS}", f"DateDrillingCompleted {_TS}", "DrillingContractor string",
        "PipelineConnection string", "Remarks string"]),
    "cmpASvFactJobDetailDenormalized": ", ".join([
        "DRWellID string", "API string", "FFAPI14 string", f"FirstSpuddate {_TS}", f"JobStartDate {_TS}",
        f"JobEndDate {_TS}", f"MD {_NUM}", "IngredientID long", "CasNumber string", "IngredientName string",
        f"CalcIngredientMass {_NUM}", "IngredientMassUOM string", "PurposeName string", "PurposeID long",
        "PurposeDescription string", "SupplierID long", "SupplierName string",
        "IngredientIsResinCoated string", "TradeIsResinCoated string", "IngredientIsArtificial string",
        "TradeIsArtificial string", "IngredientIsSand string", "TradeIsSand string",
        "TradeSandMeshSize string", "IngredientSandMeshSize string", "TradeSandQuality string",
        "IngredientSandQuality string", "TradeID long", "TradeName string", "DisclosureStatus string",
        "DisclosureID long", f"PercentHighAdditive {_NUM}", f"IngredientHFJobPercent {_NUM}",
        "MatchingStrategy string", f"PercentofConfidence {_NUM}", "FFVersion int"]),
    "cmpFracDetail_New": ", ".join([
        "cmpFracDetailId string", "API10 string", "CompletionID string", f"BeginDateTime {_TS}",
        f"EndDateTime {_TS}", f"DepthIntervalFrom {_NUM}", f"DepthIntervalTo {_NUM}", "isSummary string",
        "StageNumber int", "numberOfStages int", "stimulatedFormation string", "materialDescription string",
        f"materialAmount {_NUM}", "materialUnit string", "materialType string", "contractorName string"]),
    "cmpPipe": ", ".join([
        "CompletionID string", "CasingRecordType string", "StringType string", f"CasingSize {_NUM}",
        f"HoleSize {_NUM}", f"CasingBottom {_NUM}", f"CasingTop {_NUM}", f"CasingWeight {_NUM}",
        f"CementAmount {_NUM}", "CementClass string", f"TopOfCement {_NUM}", "TopCementDeterminedBy string",
        f"SlurryVolume {_NUM}"]),
    "cmpInitialPotentialTest": ", ".join([
        "completion_dr_id string", f"testDate {_TS}", "Duration string", f"OilGravity {_NUM}",
        f"TestOil {_NUM}", f"TestGas {_NUM}", f"TestWater {_NUM}", f"`24HourOil` {_NUM}",
        f"`24HourGas` {_NUM}", f"`24HourWater` {_NUM}", "ChokeSize string", f"CasingPressure {_NUM}",
        f"TestFlowingTubePressure {_NUM}", "ProducingMethod string", "SizeAndTypeOfPump string"]),
    "cmpOKProductionTest": ", ".join([
        "completionID string", f"TestDate {_TS}", "TestFormation string", f"`24HourOil` {_NUM}",
        f"`24HourGas` {_NUM}", f"`24HourWater` {_NUM}", "ChokeSize string", f"OilGravity {_NUM}",
        f"CasingPressure {_NUM}", f"TestFlowingTubePressure {_NUM}"]),
    "cmpGasMeasurementTest": "API string, CompletionID string, RunNumber int, volumePerDay double",
    "cmpFieldTest": ", ".join([
        "API string", "CompletionID string", "RunNumber int", "TimeOfRun string", f"BottomHoleTemp {_NUM}",
        f"BottomHoleTempDepth {_NUM}", "RunChokeSize string", f"GravityDryGas {_NUM}",
        f"GravityLiquidHydrocarbon {_NUM}"]),
}

# Published well header: keys, fields the detail jobs use, and the mart's pass-through columns.
HEADER_STRINGS = [
    "api", "play", "operator", "reservoirAlias", "state", "county", "field", "reservoir",
    "primaryProduct", "wellbore", "perfIntervalSource", "section", "township", "range",
    "quarterQuarter", "abstract", "survey", "basin", "playArea", "wellType", "allocFlag",
    "intermediateCasing", "simulFrac", "padDrill", "linerSize", "tubingSize"]
HEADER_DATES = ["firstProductionDate", "completionDate", "spudDate", "lastProductionDate"]
HEADER_NUMBERS = (
    ["latitude27", "longitude27", "upperPerforation", "lowerPerforation", "tvd", "perfInterval",
     "totalDepth", "maxIpOil", "maxIpGas", "maxIpOilPending", "maxIpGasPending"]
    + [f"cum{m}Months{p}" for m in (3, 6, 12, 24, 60) for p in ("Oil", "Gas", "Water")]
    + ["cumTotalOil", "cumTotalGas", "cumTotalWater", "vnUltimateOil_Bbl", "vnUltimateGas_Mcf",
       "azimuth", "lateralLength", "cumulativeGasOilRatio", "firstGasOilRatio", "lastGasOilRatio",
       "pracIPGasOilRatio", "first3MonthsGasOilRatio", "oilGravity", "gasGravity",
       "lastProductionOil", "lastProductionGas", "lastProductionWater", "proppantLbs", "treatmentBbls"])
SCHEMAS["espHeader"] = ", ".join(
    [f"`{c}` string" for c in HEADER_STRINGS] + ["hpdiEntityId long", "stages int"]
    + [f"{c} {_TS}" for c in HEADER_DATES] + [f"{c} {_NUM}" for c in HEADER_NUMBERS])


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


@dataclass
class Catalog:
    """Where the inputs live: one base path per source database.

    ``details`` is the base path of the published detail tables (``vEsp...``)
    the mart reads; without it the mart reads the tables written under ``stage``.
    """

    raw: str
    live: str
    stage: str
    fmt: str = "parquet"
    overrides: dict[str, str] = field(default_factory=dict)
    details: str | None = None

    def path(self, name: str, db: str = "raw") -> str:
        if name in self.overrides:
            return self.overrides[name]
        return f"{getattr(self, db).rstrip('/')}/{name}"

    def load(self, spark: SparkSession, name: str, db: str = "raw") -> DataFrame:
        """The table as its files describe it; formats without a schema of their own get the declared one."""
        reader = spark.read.format(self.fmt)
        if name in SCHEMAS and self.fmt not in SELF_DESCRIBING:
            reader = reader.schema(schema(name))
        return reader.load(current(spark, self.path(name, db)))

    def read(self, spark: SparkSession, name: str, db: str = "raw") -> DataFrame:
        """The table's good rows in the declared layout, keys folded (``conform``)."""
        df = self.load(spark, name, db)
        return fold_keys(conform(df, name)[0] if name in SCHEMAS else df)

    def check(self, spark: SparkSession, tables: Iterable[tuple[str, str]]) -> dict[str, DataFrame]:
        """Compare (name, db) tables with their declared layouts before anything runs.

        Raises one ``SchemaDrift`` that names every fault of every table. Returns
        the rejects of the tables that hold columns of another type.
        """
        faults, rejects = [], {}
        for name, db in tables:
            df = self.load(spark, name, db)
            found = schema_faults(df.schema, name)
            faults += found
            if not found and other_types(df.schema, name):
                rejects[name] = conform(df, name)[1]
        if faults:
            raise SchemaDrift(faults)
        return rejects


#: Formats whose files carry column names and types.
SELF_DESCRIBING = ("parquet", "orc", "avro")


class SchemaDrift(ValueError):
    """Files do not hold the declared columns; ``faults`` lists each."""

    def __init__(self, faults: list[str]):
        super().__init__("; ".join(faults))
        self.faults = faults


def _by_name(found: StructType) -> dict[str, list[StructField]]:
    out: dict[str, list[StructField]] = {}
    for f in found.fields:
        out.setdefault(f.name.lower(), []).append(f)
    return out


def schema_faults(found: StructType, name: str) -> list[str]:
    """What keeps a table from being read: a declared column missing, ambiguous, or no plain value.

    A renamed column is missing under its name; the undeclared columns are
    listed with it. Names compare without case; columns not declared are ignored.
    """
    columns, declared = _by_name(found), schema(name)
    known = {f.name.lower() for f in declared.fields}
    others = [f.name for f in found.fields if f.name.lower() not in known]
    faults = []
    for f in declared.fields:
        here = columns.get(f.name.lower(), [])
        if not here:
            faults.append(f"{name}.{f.name} is missing" + (f" (not declared: {', '.join(others)})" if others else ""))
        elif len(here) > 1:
            faults.append(f"{name}.{f.name} is ambiguous: {', '.join(h.name for h in here)}")
        elif not isinstance(here[0].dataType, AtomicType) or isinstance(here[0].dataType, BinaryType):
            faults.append(f"{name}.{f.name} is {here[0].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return faults


def other_types(found: StructType, name: str) -> list[str]:
    """Declared columns that the files hold in another type."""
    columns = _by_name(found)
    return [f.name for f in schema(name).fields if columns[f.name.lower()][0].dataType != f.dataType]


def conform(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(good rows in the declared layout, rejected rows as they came with ``rejected_columns``).

    Columns of another type are cast value by value; a row with a value that
    cannot be (text in a number column, a number too large) is rejected whole
    instead of ending the job late. NULLs are good. Where all types agree this
    is a plain selection and nothing is rejected.
    """
    faults = schema_faults(df.schema, name)
    if faults:
        raise SchemaDrift(faults)
    columns, cast = _by_name(df.schema), set(other_types(df.schema, name))
    raw = {f.name: F.col(f"`{columns[f.name.lower()][0].name}`") for f in schema(name).fields}
    typed = {f.name: raw[f.name].try_cast(f.dataType) if f.name in cast else raw[f.name] for f in schema(name).fields}
    good = df.select(*[c.alias(n) for n, c in typed.items()])
    if not cast:
        return good, df.withColumn("rejected_columns", F.array().cast("array<string>")).limit(0)
    bad = [F.when(raw[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in typed if n in cast]
    failed = df.withColumn("rejected_columns", F.array_compact(F.array(*bad)))
    return (failed.where(F.size("rejected_columns") == 0).select(*[c.alias(n) for n, c in typed.items()]),
            failed.where(F.size("rejected_columns") > 0))


#: Columns that hold a well or completion key, in lower case.
KEY_COLUMNS = ("api", "api10", "completionid", "completion_dr_id", "drwellid")


def fold_keys(df: DataFrame) -> DataFrame:
    """Key columns of text type upper-cased and without trailing blanks; all others as they are."""
    kinds = dict(df.dtypes)
    return df.select(*[F.upper(F.rtrim(F.col(f"`{c}`"))).alias(c) if c.lower() in KEY_COLUMNS and kinds[c] == "string"
                       else F.col(f"`{c}`") for c in df.columns])


_INFERRED: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the benchmark tables (``<sf_dir>/<name>.parquet``).

    The schema is inferred from the file footer once per path and process;
    later reads pass it explicitly (no footer read at plan time).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _INFERRED.get(path)
    if known is not None:
        return spark.read.schema(known).parquet(path)
    df = spark.read.parquet(path)
    _INFERRED[path] = df.schema
    return df
