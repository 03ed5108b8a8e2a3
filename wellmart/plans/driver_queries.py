"""The operators run on the benchmark tables, each with an ANSI-SQL oracle.

Role map (well data -> benchmark tables):
  well               = customer (api = customer key)
  header row         = order (completion date = order date)
  material row       = line item joined with its part (material = part name,
                       material type = part type, amount = quantity)
  well test          = line item of a customer's order, or an event
Every query reads whole tables; a filter on a flag or status splits a table
into roles. Every computed column carries the same
alias in the Spark plan and in its oracle SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellmart.functions import rules
from wellmart.functions.semantics import (
    any_not_null,
    eq_ci,
    first_non_empty,
    guarded_ratio,
    in_ci,
    isnull,
    label_if_total,
    ne_ci,
    not_in_ci,
    null_if_ci,
    null_outside,
    typed_null,
    varchar,
)
from wellmart.operators.classify import classify_text
from wellmart.operators.joins import month_window_join, null_as_zero_on
from wellmart.operators.lists import distinct_list, prefixed
from wellmart.operators.measures import sum_by_unit
from wellmart.operators.ranking import dense_rank_by, latest_row, partition_agg, top_group
from wellmart.operators.setops import distinct_ci, keys_only_in_each, union_all, union_distinct
from wellmart.plans import batch, frac_detail, header_mart, piping, well_test
from wellmart.plans.frac_detail import (
    completion_summary,
    disclosure_unit,
    first_produced,
    flag_type,
    floored_date,
    mesh_size,
    proppant_type,
    summary_flag,
    supplier_repair,
    vendor,
    version_label,
)
from wellmart.plans.well_test import choke_size, rate_fill
from wellmart.session import ensure_checkpoint_dir
from wellmart.sources.sinks import checkpoint_root, publish
from wellmart.sources.tables import Catalog, read_table, schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _keyed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table that grows with the others, to be joined by its key. Its file may be far smaller than its rows,
    and the plan-time estimate is the file's, so it would be broadcast through the driver: it is merged."""
    return _t(spark, sf, name).hint("merge")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# Projections, constants, typed NULLs, filters
# --------------------------------------------------------------------------

@register("conform_rename", """
SELECT DISTINCT c_custkey AS customerId,
       substr(CAST(c_custkey AS VARCHAR), 1, 14) AS api14,
       upper(c_name) AS customerName,
       c_nationkey AS stateId,
       c_acctbal AS balance,
       upper(c_mktsegment) AS segment,
       'FRACFOCUS' AS sourceColumn,
       CAST(NULL AS VARCHAR) AS completionType,
       CAST(NULL AS DOUBLE) AS depthIntervalFrom,
       CAST(NULL AS BIGINT) AS ingredientId
FROM customer
""")
def conform_rename(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("customerId"),
        varchar("c_custkey", 14).alias("api14"),
        F.upper("c_name").alias("customerName"),
        F.col("c_nationkey").alias("stateId"),
        F.col("c_acctbal").alias("balance"),
        F.upper("c_mktsegment").alias("segment"),
        F.lit("FRACFOCUS").alias("sourceColumn"),
        typed_null("string").alias("completionType"),
        typed_null("double").alias("depthIntervalFrom"),
        typed_null("bigint").alias("ingredientId"),
    ).distinct()


@register("state_filter", """
SELECT c.c_custkey, n.n_name AS state, c.c_mktsegment AS segment
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE (upper(rtrim(n.n_name)) IN ('NATION_1', 'NATION_3', 'NATION_7', 'NATION_12', 'NATION_20')
       AND upper(rtrim(c.c_mktsegment)) <> 'BUILDING')
   OR (upper(rtrim(n.n_name)) = 'NATION_5' AND c.c_acctbal > 0
       AND upper(rtrim(c.c_mktsegment)) <> 'MACHINERY')
""")
def state_filter(spark, sf):
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    listed = in_ci("n_name", ["nation_1", "Nation_3 ", "NATION_7", "nation_12", "Nation_20"])
    cond = ((listed & ne_ci("c_mktsegment", "building"))
            | (eq_ci("n_name", "nation_5") & (F.col("c_acctbal") > 0) & ne_ci("c_mktsegment", "Machinery ")))
    return j.where(cond).select("c_custkey", F.col("n_name").alias("state"),
                                F.col("c_mktsegment").alias("segment"))


@register("key_range_filter", """
SELECT o_orderkey, o_custkey, CAST(o_custkey AS VARCHAR) AS api
FROM orders WHERE CAST(o_custkey AS VARCHAR) > '5'
""")
def key_range_filter(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                       F.col("o_custkey").cast("string").alias("api"))
    return o.where(F.col("api") > F.lit("5"))


@register("range_to_null", """
SELECT * FROM (
  SELECT p_partkey,
         CASE WHEN p_size <= 10 THEN NULL WHEN p_size >= 40 THEN NULL ELSE p_size END AS sizeClean,
         CASE WHEN p_retailprice <= 920.0 THEN NULL WHEN p_retailprice >= 980.0 THEN NULL
              ELSE p_retailprice END AS priceClean,
         CASE WHEN p_size <= 12 OR p_size > 45 THEN NULL ELSE p_size END AS weightClean
  FROM part) a
WHERE sizeClean IS NOT NULL OR priceClean IS NOT NULL OR weightClean IS NOT NULL
""")
def range_to_null(spark, sf):
    p = _t(spark, sf, "part").select(
        "p_partkey",
        null_outside("p_size", 10, 40).alias("sizeClean"),
        null_outside("p_retailprice", 920.0, 980.0).alias("priceClean"),
        null_outside("p_size", 12, 45, high_inclusive=False).alias("weightClean"))
    return p.where(any_not_null("sizeClean", "priceClean", "weightClean"))


_CROSS_SQL = """
SELECT *, CASE WHEN casingBottom > casingTop THEN casingBottom - casingTop ELSE NULL END AS casingLength
FROM (
  SELECT DISTINCT l_orderkey, l_linenumber,
    CASE WHEN q <= 10 THEN NULL ELSE q END AS casingBottom,
    CASE WHEN q <= 10 AND top = 0 THEN NULL ELSE top END AS casingTop,
    CASE WHEN tax <= 0 AND upper(rtrim(cls)) = 'N' THEN NULL ELSE tax END AS cementAmount,
    CASE WHEN tax <= 0 AND upper(rtrim(cls)) = 'N' THEN NULL ELSE cls END AS cementClass,
    CASE WHEN tax <= 0 AND upper(rtrim(cls)) = 'N' AND disc = 0 THEN NULL ELSE disc END AS cementTop,
    CASE WHEN tax <= 0 AND upper(rtrim(cls)) = 'N' AND disc = 0 AND upper(rtrim(src)) = 'O' THEN NULL
         ELSE src END AS cementTopSource,
    CASE WHEN disc = 0 THEN NULL ELSE disc END AS slurryVolume
  FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, CAST((l_linenumber - 1) * 5 AS DOUBLE) AS top,
               abs(l_tax) AS tax, l_returnflag AS cls, abs(l_discount) AS disc, l_linestatus AS src
        FROM lineitem) raw
) cleaned
WHERE casingBottom IS NOT NULL OR casingTop IS NOT NULL OR cementAmount IS NOT NULL
   OR cementClass IS NOT NULL OR cementTop IS NOT NULL OR cementTopSource IS NOT NULL
   OR slurryVolume IS NOT NULL
"""


@register("cross_field_null", _CROSS_SQL)
def cross_field_null(spark, sf):
    raw = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"),
        ((F.col("l_linenumber") - 1) * 5).cast("double").alias("top"),
        F.abs("l_tax").alias("tax"), F.col("l_returnflag").alias("cls"),
        F.abs("l_discount").alias("disc"), F.col("l_linestatus").alias("src"))
    q, top, tax, disc = F.col("q"), F.col("top"), F.col("tax"), F.col("disc")
    no_cement = (tax <= 0) & eq_ci("cls", "N")
    # One select: every CASE reads the raw columns (same-level aliases are invisible).
    cleaned = raw.select(
        "l_orderkey", "l_linenumber",
        F.when(q <= 10, None).otherwise(q).alias("casingBottom"),
        F.when((q <= 10) & (top == 0), None).otherwise(top).alias("casingTop"),
        F.when(no_cement, None).otherwise(tax).alias("cementAmount"),
        F.when(no_cement, None).otherwise(F.col("cls")).alias("cementClass"),
        F.when(no_cement & (disc == 0), None).otherwise(disc).alias("cementTop"),
        F.when(no_cement & (disc == 0) & eq_ci("src", "O"), None).otherwise(F.col("src"))
        .alias("cementTopSource"),
        F.when(disc == 0, None).otherwise(disc).alias("slurryVolume"),
    ).distinct()
    kept = cleaned.where(any_not_null(*cleaned.columns[2:]))
    # Next level reads the cleaned values.
    return kept.select("*", F.when(F.col("casingBottom") > F.col("casingTop"),
                                   F.col("casingBottom") - F.col("casingTop")).alias("casingLength"))


@register("text_sentinel_null", """
SELECT o_orderkey, priority, statusFlag,
       CASE WHEN upper(rtrim(supplier)) IN ('LOOKUP OPERATOR NAME IN HEADER', 'OIPERATOR') THEN operator
            WHEN supplier IS NULL THEN 'UNKNOWN'
            WHEN upper(rtrim(supplier)) = 'N/A' THEN 'UNKNOWN'
            ELSE supplier END AS supplierName
FROM (
  SELECT o.o_orderkey, c.c_name AS operator,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Lookup operator name in header ' WHEN '2-HIGH' THEN 'oiperator'
              WHEN '3-MEDIUM' THEN 'n/a' WHEN '5-LOW' THEN NULL ELSE o.o_orderpriority END AS supplier,
         CASE WHEN upper(rtrim(o.o_orderpriority)) IN ('4-NOT SPECIFIED', 'NULL', 'UNKNOWN', '') THEN NULL
              ELSE o.o_orderpriority END AS priority,
         CASE WHEN o.o_orderstatus = 'F' THEN 'YES' WHEN o.o_orderstatus = 'O' THEN 'NO'
              ELSE 'P?' END AS statusFlag
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey) a
""")
def text_sentinel_null(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    p = F.col("o_orderpriority")
    supplier = (F.when(p == "1-URGENT", "Lookup operator name in header ").when(p == "2-HIGH", "oiperator")
                .when(p == "3-MEDIUM", "n/a").when(p == "5-LOW", None).otherwise(p))
    flag = (F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0 ")
            .otherwise(F.concat(F.lower("o_orderstatus"), F.lit("?"))))
    return o.join(c, c["c_custkey"] == o["o_custkey"], "left").select(
        "o_orderkey", null_if_ci("o_orderpriority", ["4-not specified", "NULL", "UNKNOWN", ""]).alias("priority"),
        summary_flag(flag).alias("statusFlag"), supplier_repair(supplier, F.col("c_name")).alias("supplierName"))


@register("flag_priority", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN upper(rtrim(unit)) = 'LB' THEN 'LBS' ELSE upper(unit) END AS materialUnit,
  CASE WHEN upper(rtrim(resinI)) = 'Y' OR upper(rtrim(resinT)) = 'Y' THEN 'RESIN COATED'
       WHEN upper(rtrim(artI)) = 'Y' OR upper(rtrim(artT)) = 'Y' THEN 'ARTIFICIAL'
       WHEN upper(rtrim(sandI)) = 'Y' OR upper(rtrim(sandT)) = 'Y' THEN 'SAND'
       WHEN upper(rtrim(purpose)) = 'PROPPANT' THEN 'UNKNOWN' ELSE NULL END AS proppantType,
  CASE WHEN tradeMesh IS NOT NULL AND rtrim(tradeMesh) <> '' THEN tradeMesh
       WHEN ingMesh IS NOT NULL AND rtrim(ingMesh) <> '' THEN ingMesh
       WHEN upper(rtrim(purpose)) = 'PROPPANT' THEN 'UNKNOWN' ELSE NULL END AS proppantMeshSize,
  CASE WHEN tradeQ IS NOT NULL AND rtrim(tradeQ) <> '' THEN tradeQ
       WHEN ingQ IS NOT NULL AND rtrim(ingQ) <> '' THEN ingQ ELSE NULL END AS sandQuality,
  CASE WHEN version = 1 THEN 'FF 1' WHEN version = 2 THEN 'FF 2' WHEN version = 3 THEN 'FF 3'
       ELSE 'FF' END AS sourceColumn
FROM (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'A' THEN 'lb' WHEN l_returnflag = 'N' THEN 'gal' ELSE 'Bbl' END AS unit,
    CASE WHEN l_discount >= 0.09 THEN 'Y' END AS resinI,
    CASE WHEN l_tax >= 0.07 THEN 'y' ELSE 'N' END AS resinT,
    CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS artI,
    'N' AS artT,
    CASE WHEN l_linestatus = 'F' THEN 'Y' END AS sandI,
    CASE WHEN l_quantity > 45 THEN 'Y ' END AS sandT,
    CASE WHEN l_linenumber = 1 THEN 'PROPPANT' ELSE 'OTHER' END AS purpose,
    CASE WHEN l_quantity > 40 THEN '' WHEN l_quantity > 30 THEN NULL
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '/' || CAST(CAST(l_quantity AS INTEGER) + 20 AS VARCHAR)
    END AS tradeMesh,
    CASE WHEN l_linenumber > 5 THEN '  ' ELSE '40/70' END AS ingMesh,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS tradeQ,
    l_linestatus AS ingQ,
    l_linenumber AS version
  FROM lineitem) raw
""")
def flag_priority(spark, sf):
    li = _t(spark, sf, "lineitem")
    qi = F.col("l_quantity").cast("int")
    raw = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", "lb").when(F.col("l_returnflag") == "N", "gal")
        .otherwise("Bbl").alias("unit"),
        F.when(F.col("l_discount") >= 0.09, "Y").alias("resinI"),
        F.when(F.col("l_tax") >= 0.07, "y").otherwise("N").alias("resinT"),
        F.when(F.col("l_returnflag") == "A", "Y").otherwise("N").alias("artI"),
        F.lit("N").alias("artT"),
        F.when(F.col("l_linestatus") == "F", "Y").alias("sandI"),
        F.when(F.col("l_quantity") > 45, "Y ").alias("sandT"),
        F.when(F.col("l_linenumber") == 1, "PROPPANT").otherwise("OTHER").alias("purpose"),
        F.when(F.col("l_quantity") > 40, "").when(F.col("l_quantity") > 30, None)
        .otherwise(F.concat(qi.cast("string"), F.lit("/"), (qi + 20).cast("string"))).alias("tradeMesh"),
        F.when(F.col("l_linenumber") > 5, "  ").otherwise("40/70").alias("ingMesh"),
        F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag")).alias("tradeQ"),
        F.col("l_linestatus").alias("ingQ"),
        F.col("l_linenumber").alias("version"),
    )
    proppant = eq_ci("purpose", "PROPPANT")
    return raw.select(
        "l_orderkey", "l_linenumber",
        disclosure_unit(F.col("unit")).alias("materialUnit"),
        flag_type([F.col("resinI"), F.col("resinT")], [F.col("artI"), F.col("artT")],
                  [F.col("sandI"), F.col("sandT")], proppant).alias("proppantType"),
        first_non_empty("tradeMesh", "ingMesh").when(proppant, "UNKNOWN").alias("proppantMeshSize"),
        first_non_empty("tradeQ", "ingQ").alias("sandQuality"),
        version_label(F.col("version")).alias("sourceColumn"),
    )


@register("casing_type_normalise", """
SELECT p_partkey,
  CASE WHEN upper(rtrim(recordType)) = 'PROMO'
            AND upper(rtrim(stringType)) IN ('RING', 'GEAR', 'ROD', 'BOLT', 'PLATE', 'ANVIL')
         THEN upper(stringType)
       WHEN recordType IS NULL OR rtrim(recordType) = '' OR upper(rtrim(recordType)) = 'UNKNOWN' THEN 'CASING'
       ELSE upper(recordType) END AS casingType
FROM (SELECT p_partkey, split_part(p_name, ' ', 2) AS stringType,
             CASE WHEN p_size > 47 THEN '' WHEN p_size > 44 THEN 'unknown' WHEN p_size = 1 THEN NULL
                  ELSE p_type END AS recordType
      FROM part) raw
""")
def casing_type_normalise(spark, sf):
    p = _t(spark, sf, "part").select(
        "p_partkey", F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("stringType"),
        F.when(F.col("p_size") > 47, "").when(F.col("p_size") > 44, "unknown")
        .when(F.col("p_size") == 1, None).otherwise(F.col("p_type")).alias("recordType"))
    return p.select("p_partkey", casing_type(F.col("recordType"), F.col("stringType")).alias("casingType"))


def casing_type(record_type, string_type):
    """The piping job's casing-type rule with part types / part nouns in the roles of record / string types."""
    return piping.casing_type(record_type, string_type, casing_value="PROMO",
                              strings=("ring", "gear", "rod", "bolt", "plate", "anvil"))


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------

@register("inner_distinct", """
SELECT DISTINCT o.o_custkey, l.l_returnflag, CAST(year(o.o_orderdate) AS BIGINT) AS orderYear
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def inner_distinct(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    return (o.join(li, li["l_orderkey"] == o["o_orderkey"])
            .select("o_custkey", "l_returnflag", F.year("o_orderdate").cast("bigint").alias("orderYear"))
            .distinct())


@register("left_fallback", """
WITH h AS (
  SELECT * FROM (
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
                                           o_orderkey DESC) AS rn
    FROM orders) x WHERE rn = 1)
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS api,
       coalesce(CASE WHEN l.l_quantity <= 10 THEN NULL ELSE l.l_quantity END, h.o_totalprice) AS depthIntervalFrom,
       coalesce(CASE WHEN l.l_linenumber > 4 THEN NULL ELSE l.l_linenumber END,
                CAST(h.o_orderkey AS INTEGER)) AS numberOfStages,
       coalesce(CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE l.l_returnflag END, h.o_orderpriority) AS formation,
       h.o_orderkey AS latestOrder
FROM orders o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN h ON h.o_custkey = o.o_custkey
""")
def left_fallback(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    wells = o.select("o_orderkey", "o_custkey")
    h = latest_row(o, ["o_custkey"], ["o_orderdate"],
                   payload=["o_orderkey", "o_totalprice", "o_orderpriority"])
    h = h.select(F.col("o_custkey").alias("h_api"), F.col("o_orderkey").alias("h_orderkey"),
                 F.col("o_totalprice").alias("h_total"), F.col("o_orderpriority").alias("h_priority"))
    j = (wells.join(li, wells["o_orderkey"] == li["l_orderkey"], "left")
         .join(h, F.col("h_api") == F.col("o_custkey"), "left"))
    return j.select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("api"),
        isnull(F.when(F.col("l_quantity") <= 10, None).otherwise(F.col("l_quantity")), "h_total", "double")
        .alias("depthIntervalFrom"),
        isnull(F.when(F.col("l_linenumber") > 4, None).otherwise(F.col("l_linenumber")), "h_orderkey", "int")
        .alias("numberOfStages"),
        isnull(F.when(F.col("l_linestatus") == "O", None).otherwise(F.col("l_returnflag")), "h_priority",
               "string").alias("formation"),
        F.col("h_orderkey").alias("latestOrder"))


@register("null_as_zero_join", """
SELECT DISTINCT a.k AS l_orderkey, a.ln AS lineA, r.ln AS lineR, a.q AS qtyA, r.q AS qtyR, a.s AS l_linestatus
FROM (SELECT l_orderkey AS k, l_linenumber AS ln, l_linestatus AS s,
             CASE WHEN l_quantity <= 10 THEN NULL ELSE l_quantity END AS q
      FROM lineitem WHERE l_returnflag = 'A') a
JOIN (SELECT l_orderkey AS k, l_linenumber AS ln, l_linestatus AS s,
             CASE WHEN l_quantity <= 10 THEN 0.0 ELSE l_quantity END AS q
      FROM lineitem WHERE l_returnflag = 'R') r
  ON a.k = r.k AND coalesce(a.q, 0) = coalesce(r.q, 0) AND a.s = r.s
""")
def null_as_zero_join(spark, sf):
    li = _t(spark, sf, "lineitem")

    def side(flag, small):
        return li.where(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ln"), F.col("l_linestatus").alias("s"),
            F.when(F.col("l_quantity") <= 10, small).otherwise(F.col("l_quantity")).alias("q"))

    a, r = side("A", F.lit(None).cast("double")), side("R", F.lit(0.0))
    on = (F.col("a.k") == F.col("r.k")) & null_as_zero_on(a, r, [("q", "q")], "a", "r") \
        & (F.col("a.s") == F.col("r.s"))
    return a.alias("a").join(r.alias("r"), on).select(
        F.col("a.k").alias("l_orderkey"), F.col("a.ln").alias("lineA"), F.col("r.ln").alias("lineR"),
        F.col("a.q").alias("qtyA"), F.col("r.q").alias("qtyR"), F.col("a.s").alias("l_linestatus")).distinct()


_RUN_SQL = "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END"


def _runs(li: DataFrame, flag: str) -> DataFrame:
    return li.where(F.col("l_returnflag") == flag).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus",
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("RunNumber"))


@register("per_key_cartesian", f"""
SELECT h.o_custkey AS API, h.o_orderkey AS CompletionID, gm.l_linenumber AS gmLine, ft.l_linenumber AS ftLine,
       gm.l_quantity AS volumePerDay, ft.l_extendedprice AS bottomHoleTemp,
       gm.run AS GM_RunNumber, ft.run AS FT_RunNumber
FROM orders h
JOIN (SELECT *, {_RUN_SQL} AS run FROM lineitem WHERE l_returnflag = 'A') gm ON gm.l_orderkey = h.o_orderkey
JOIN (SELECT *, {_RUN_SQL} AS run FROM lineitem WHERE l_returnflag = 'R') ft ON ft.l_orderkey = h.o_orderkey
WHERE upper(rtrim(h.o_orderstatus)) = 'F' AND h.o_orderkey <> -1 AND gm.run = 1 AND ft.run = 1
""")
def per_key_cartesian(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    h = o.where(eq_ci("o_orderstatus", "f") & (F.col("o_orderkey") != -1)).select("o_custkey", "o_orderkey")
    gm = _runs(li, "A").where(F.col("RunNumber") == 1).alias("gm")
    ft = _runs(li, "R").where(F.col("RunNumber") == 1).alias("ft")
    j = (h.join(gm, F.col("gm.l_orderkey") == h["o_orderkey"])
         .join(ft, F.col("ft.l_orderkey") == h["o_orderkey"]))
    return j.select(F.col("o_custkey").alias("API"), F.col("o_orderkey").alias("CompletionID"),
                    F.col("gm.l_linenumber").alias("gmLine"), F.col("ft.l_linenumber").alias("ftLine"),
                    F.col("gm.l_quantity").alias("volumePerDay"),
                    F.col("ft.l_extendedprice").alias("bottomHoleTemp"),
                    F.col("gm.RunNumber").alias("GM_RunNumber"), F.col("ft.RunNumber").alias("FT_RunNumber"))


@register("wells_with_detail", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (
  SELECT api FROM (
    SELECT DISTINCT api FROM (
      SELECT o_custkey AS api FROM orders WHERE o_orderstatus = 'P'
      UNION ALL SELECT user_id FROM events
      UNION ALL SELECT s_suppkey FROM supplier) x) u
  WHERE u.api = c.c_custkey)
""")
def wells_with_detail(spark, sf):
    # Three feeds: orders of one status (every customer has some order), all events, all suppliers.
    o, ev, c = _t(spark, sf, "orders"), _t(spark, sf, "events"), _t(spark, sf, "customer")
    u = union_distinct(
        o.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("api")),
        ev.select(F.col("user_id").alias("api")),
        _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("api")))
    return c.join(u, c["c_custkey"] == u["api"], "left_semi").select("c_custkey", "c_name")


@register("surface_min", """
SELECT DISTINCT h.o_orderkey, h.o_custkey,
       MIN(p.l_quantity) OVER (PARTITION BY p.l_orderkey) AS surfaceCasingDepth
FROM orders h LEFT JOIN lineitem p ON p.l_orderkey = h.o_orderkey AND upper(rtrim(p.l_returnflag)) = 'R'
""")
def surface_min(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    surface = (li.where(eq_ci("l_returnflag", "r")).groupBy("l_orderkey")
               .agg(F.min("l_quantity").alias("surfaceCasingDepth")))
    return (o.join(surface, surface["l_orderkey"] == o["o_orderkey"], "left")
            .select("o_orderkey", "o_custkey", "surfaceCasingDepth").distinct())


_HDR_SQL = """
  SELECT o_orderkey, o_custkey AS api, o_orderdate AS cd,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 45 DAY END AS fpd
  FROM orders"""


def _month_headers(o: DataFrame) -> DataFrame:
    return o.select("o_orderkey", F.col("o_custkey").alias("api"), F.col("o_orderdate").alias("cd"),
                    F.when(F.col("o_orderpriority") == "5-LOW", None)
                    .otherwise(F.timestamp_add("DAY", F.lit(45), F.col("o_orderdate"))).alias("fpd"))


@register("month_window_join", f"""
WITH hdr AS ({_HDR_SQL}),
h AS (SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY api ORDER BY fpd DESC NULLS LAST, cd DESC NULLS LAST)
                     AS BIGINT) AS dateRank FROM hdr),
t AS (SELECT o.o_custkey AS api, l.l_orderkey, l.l_linenumber, l.l_shipdate AS testDate
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
w AS (SELECT *, DENSE_RANK() OVER (PARTITION BY api ORDER BY testDate DESC NULLS LAST) AS dateRank FROM t)
SELECT h.o_orderkey, h.api, h.dateRank AS headerRank, w.l_orderkey AS testOrder, w.l_linenumber AS testLine,
       w.testDate
FROM h LEFT JOIN w ON w.api = h.api AND h.dateRank = 1 AND w.dateRank = 1
  AND ((w.testDate + INTERVAL 1 MONTH >= h.cd AND w.testDate - INTERVAL 1 MONTH <= h.cd)
    OR (w.testDate + INTERVAL 1 MONTH >= h.fpd AND w.testDate - INTERVAL 1 MONTH <= h.fpd))
""")
def month_window_join_q(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    h = dense_rank_by(_month_headers(o), ["api"], ["fpd", "cd"], "dateRank")
    t = li.join(o, o["o_orderkey"] == li["l_orderkey"]).select(
        F.col("o_custkey").alias("api"), "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("testDate"))
    w = top_group(t, ["api"], ["testDate"])  # only rank 1 is joined
    j = month_window_join(h, w, ("api", "api"), ["cd", "fpd"], "testDate", 1,
                          extra=F.col("h.dateRank") == 1)
    return j.select(F.col("h.o_orderkey").alias("o_orderkey"), F.col("h.api").alias("api"),
                    F.col("h.dateRank").alias("headerRank"), F.col("w.l_orderkey").alias("testOrder"),
                    F.col("w.l_linenumber").alias("testLine"), F.col("w.testDate").alias("testDate"))


# --------------------------------------------------------------------------
# Distinct lists and per-well aggregates
# --------------------------------------------------------------------------

def _materials(spark, sf) -> DataFrame:
    """Material rows: line items with their part and order (well = customer)."""
    li, p, o = _t(spark, sf, "lineitem"), _t(spark, sf, "part"), _t(spark, sf, "orders")
    return (li.join(p, p["p_partkey"] == li["l_partkey"])
            .join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == li["l_orderkey"]))


_MATERIALS_SQL = """lineitem l JOIN part p ON p.p_partkey = l.l_partkey
     JOIN orders o ON o.o_orderkey = l.l_orderkey"""


@register("distinct_list_pair", f"""
WITH u AS (
  SELECT o.o_custkey AS api10, l.l_orderkey AS completionId,
         CASE WHEN p.p_size > 45 THEN NULL ELSE p.p_type END AS materialType,
         CASE WHEN p.p_size < 3 THEN NULL ELSE upper(p.p_name) END AS materialName
  FROM {_MATERIALS_SQL}),
g AS (
  SELECT api10, completionId,
         string_agg(DISTINCT item, '' ORDER BY item)
           FILTER (WHERE upper(rtrim(materialType)) NOT IN ('ECONOMY', 'SMALL')) AS s
  FROM (SELECT *, coalesce(', ' || materialType, '') || coalesce(', ' || materialName, '') AS item FROM u) x
  GROUP BY api10, completionId)
SELECT api10, completionId, CASE WHEN s IS NULL OR s = '' THEN NULL ELSE substr(s, 2) END AS materialStuff
FROM g
""")
def distinct_list_pair(spark, sf):
    m = _materials(spark, sf).select(
        F.col("o_custkey").alias("api10"), F.col("l_orderkey").alias("completionId"),
        F.when(F.col("p_size") > 45, None).otherwise(F.col("p_type")).alias("materialType"),
        F.when(F.col("p_size") < 3, None).otherwise(F.upper("p_name")).alias("materialName"))
    return distinct_list(m, ["api10", "completionId"], prefixed("materialType", "materialName"),
                         "materialStuff", where=not_in_ci("materialType", ["Economy", "small "]), drop=1)


def _frac_rows(spark, sf) -> DataFrame:
    """Published-detail shape (api10, materialType, lists' fields, cumWaterBbl) from material rows."""
    return _materials(spark, sf).select(
        F.col("o_custkey").alias("api10"),
        F.when(F.col("l_returnflag") == "R", "PROPPANT").when(F.col("l_returnflag") == "A", "BASE CARRIER")
        .otherwise(F.upper("p_type")).alias("materialType"),
        F.col("p_type").alias("proppantType"),
        F.upper(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))).alias("treatmentType"),
        F.col("p_size").cast("string").alias("proppantMeshSize"),
        F.upper("p_name").alias("materialName"),
        F.col("l_quantity").alias("cumWaterBbl"))


_FRAC_ROWS_SQL = f"""
  SELECT o.o_custkey AS api10,
         CASE WHEN l.l_returnflag = 'R' THEN 'PROPPANT' WHEN l.l_returnflag = 'A' THEN 'BASE CARRIER'
              ELSE upper(p.p_type) END AS materialType,
         p.p_type AS proppantType, upper(split_part(p.p_name, ' ', 1)) AS treatmentType,
         CAST(p.p_size AS VARCHAR) AS proppantMeshSize, upper(p.p_name) AS materialName,
         l.l_quantity AS cumWaterBbl
  FROM {_MATERIALS_SQL}"""

_LISTS_SQL = f"""
lists AS (
  SELECT api10,
    CASE WHEN pt IS NULL OR pt = '' THEN NULL ELSE substr(pt, 3) END AS proppantTypeStuff,
    CASE WHEN tt IS NULL OR tt = '' THEN NULL ELSE substr(tt, 3) END AS treatmentTypeStuff,
    CASE WHEN pm IS NULL OR pm = '' THEN NULL ELSE substr(pm, 3) END AS proppantMeshSizeStuff,
    CASE WHEN bc IS NULL OR bc = '' THEN NULL ELSE substr(bc, 2) END AS baseCarrierTypeStuff,
    cumWaterBbl
  FROM (
    SELECT api10,
      string_agg(DISTINCT ', ' || proppantType, '' ORDER BY ', ' || proppantType)
        FILTER (WHERE upper(rtrim(materialType)) = 'PROPPANT') AS pt,
      string_agg(DISTINCT ', ' || treatmentType, '' ORDER BY ', ' || treatmentType)
        FILTER (WHERE upper(rtrim(materialType)) <> 'PROPPANT') AS tt,
      string_agg(DISTINCT ', ' || proppantMeshSize, '' ORDER BY ', ' || proppantMeshSize)
        FILTER (WHERE upper(rtrim(materialType)) = 'PROPPANT') AS pm,
      string_agg(DISTINCT ', ' || materialName, '' ORDER BY ', ' || materialName)
        FILTER (WHERE upper(rtrim(materialType)) = 'BASE CARRIER' OR upper(materialName) LIKE '%WATER%'
                OR upper(materialName) LIKE '%SILVERSTIM%' OR upper(materialName) LIKE '%FRAC FLUID%') AS bc,
      max(cumWaterBbl) AS cumWaterBbl
    FROM ({_FRAC_ROWS_SQL}) f
    GROUP BY api10) a)"""


@register("conditional_lists", f"""
WITH {_LISTS_SQL}
SELECT c.c_custkey, f.proppantTypeStuff, f.treatmentTypeStuff, f.proppantMeshSizeStuff,
       f.baseCarrierTypeStuff, f.cumWaterBbl
FROM customer c LEFT JOIN lists f ON f.api10 = c.c_custkey
""")
def conditional_lists(spark, sf):
    lists = header_mart.material_lists(_frac_rows(spark, sf), with_base_carrier=True)
    c = _t(spark, sf, "customer")
    return c.join(lists, lists["api10"] == c["c_custkey"], "left").select(
        "c_custkey", "proppantTypeStuff", "treatmentTypeStuff", "proppantMeshSizeStuff",
        "baseCarrierTypeStuff", "cumWaterBbl")


def _folded_sql(name, column, where):
    """A list whose items ignore case and trailing blanks, in their smallest spelling."""
    return f"""{name} AS (
  SELECT api10, string_agg(item, '' ORDER BY item) AS s
  FROM (SELECT api10, min(', ' || {column}) AS item FROM m WHERE {where} AND {column} IS NOT NULL
        GROUP BY api10, upper(rtrim({column}))) x GROUP BY api10)"""


@register("case_folded_lists", f"""
WITH m AS (
  SELECT o_custkey AS api10, l_returnflag = 'R' AS proppant, l_quantity AS water,
    CASE l_linenumber % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN upper(p_type) || ' ' ELSE p_type END AS ptype,
    CASE l_linenumber % 2 WHEN 0 THEN lower(p_brand) || '  ' ELSE p_brand END AS ttype,
    CASE WHEN p_size % 4 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN CAST(p_size AS VARCHAR) || ' MESH'
         ELSE CAST(p_size AS VARCHAR) || ' Mesh ' END AS mesh
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
{_folded_sql("a", "ptype", "proppant")}, {_folded_sql("b", "ttype", "NOT proppant")}, {_folded_sql("c", "mesh", "proppant")}
SELECT w.api10, substr(a.s, 3) AS "proppantTypeStuff", substr(b.s, 3) AS "treatmentTypeStuff",
       substr(c.s, 3) AS "proppantMeshSizeStuff", w.water AS "cumWaterBbl"
FROM (SELECT api10, max(water) AS water FROM m GROUP BY api10) w
LEFT JOIN a ON a.api10 = w.api10 LEFT JOIN b ON b.api10 = w.api10 LEFT JOIN c ON c.api10 = w.api10
""")
def case_folded_lists(spark, sf):
    li, o, p = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "part")
    col, line, size = F.col, F.col("l_linenumber"), F.col("p_size").cast("string")
    rows = li.join(o, o["o_orderkey"] == li["l_orderkey"]).join(p, p["p_partkey"] == li["l_partkey"]).select(
        col("o_custkey").alias("api10"), F.when(col("l_returnflag") == "R", "proppant ").otherwise("OTHER").alias("materialType"),
        F.when(line % 3 == 0, F.lower("p_type")).when(line % 3 == 1, F.concat(F.upper("p_type"), F.lit(" ")))
        .otherwise(col("p_type")).alias("proppantType"),
        F.when(line % 2 == 0, F.concat(F.lower("p_brand"), F.lit("  "))).otherwise(col("p_brand")).alias("treatmentType"),
        F.when(col("p_size") % 4 == 0, None).when(line % 2 == 0, F.concat(size, F.lit(" MESH")))
        .otherwise(F.concat(size, F.lit(" Mesh "))).alias("proppantMeshSize"),
        col("l_quantity").alias("cumWaterBbl"))
    return header_mart.material_lists(rows)


@register("label_if_total", f"""
WITH {_LISTS_SQL}
SELECT c_custkey,
  CASE WHEN proppantTypeStuff IS NOT NULL AND lbs IS NOT NULL THEN proppantTypeStuff
       WHEN lbs IS NOT NULL THEN 'UNKNOWN' ELSE NULL END AS proppantType,
  CASE WHEN proppantMeshSizeStuff IS NOT NULL AND lbs IS NOT NULL THEN proppantMeshSizeStuff
       WHEN lbs IS NOT NULL THEN 'UNKNOWN' ELSE NULL END AS proppantMeshSize,
  CASE WHEN treatmentTypeStuff IS NOT NULL AND bbls IS NOT NULL THEN treatmentTypeStuff
       WHEN bbls IS NOT NULL THEN 'UNKNOWN' ELSE NULL END AS treatmentType
FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS lbs,
             CASE WHEN c_acctbal > 5000 THEN c_acctbal END AS bbls FROM customer) c
LEFT JOIN lists f ON f.api10 = c.c_custkey
""")
def label_if_total_q(spark, sf):
    lists = header_mart.material_lists(_frac_rows(spark, sf))
    c = _t(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("lbs"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal")).alias("bbls"))
    j = c.join(lists, lists["api10"] == c["c_custkey"], "left")
    return j.select("c_custkey",
                    label_if_total("proppantTypeStuff", "lbs").alias("proppantType"),
                    label_if_total("proppantMeshSizeStuff", "lbs").alias("proppantMeshSize"),
                    label_if_total("treatmentTypeStuff", "bbls").alias("treatmentType"))


# --------------------------------------------------------------------------
# Latest record, ranks, partition aggregates
# --------------------------------------------------------------------------

@register("latest_row", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, minDate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn,
         min(o_orderdate) OVER (PARTITION BY o_custkey) AS minDate
  FROM orders) x
WHERE rn = 1
""")
def latest_row_q(spark, sf):
    o = _t(spark, sf, "orders")
    return latest_row(o, ["o_custkey"], ["o_orderdate"], payload=["o_orderkey", "o_orderdate", "o_totalprice"],
                      partition_min={"minDate": "o_orderdate"})


@register("latest_group", """
SELECT c.c_custkey, c.c_name, h.o_orderkey, h.o_orderdate
FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY o_custkey
                                   ORDER BY year(o_orderdate) DESC NULLS LAST, o_orderdate DESC NULLS LAST) AS dr
      FROM orders) h
JOIN customer c ON c.c_custkey = h.o_custkey AND h.dr = 1
""")
def latest_group_q(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                       F.year("o_orderdate").alias("orderYear"))
    top = top_group(o, ["o_custkey"], ["orderYear", "o_orderdate"])
    c = _t(spark, sf, "customer")
    return top.join(c, c["c_custkey"] == top["o_custkey"]).select("c_custkey", "c_name", "o_orderkey",
                                                                   "o_orderdate")


@register("rank_across_join", """
WITH ip AS (
  SELECT o_custkey AS API, o_orderkey AS CompletionID, o_orderdate AS completionDate,
         CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_totalprice END AS gas,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS TestDate
  FROM orders),
d AS (
  SELECT o.o_custkey AS API, l.l_orderkey AS CompletionID, l.l_linenumber AS dLine, l.l_quantity AS bottomHoleTemp
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE l.l_returnflag = 'R'),
h AS (
  SELECT h_api, fpd FROM (
    SELECT o_custkey AS h_api, o_orderdate AS fpd,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
    FROM orders) x WHERE rn = 1),
j AS (
  SELECT ip.*, d.dLine, d.bottomHoleTemp, h.h_api, h.fpd
  FROM ip LEFT JOIN d ON d.API = ip.API AND d.CompletionID = ip.CompletionID
  LEFT JOIN h ON h.h_api = ip.API
  WHERE d.bottomHoleTemp IS NOT NULL OR ip.gas IS NOT NULL)
SELECT CompletionID, dLine, API,
       CAST(DENSE_RANK() OVER (PARTITION BY h_api ORDER BY fpd DESC NULLS LAST, completionDate DESC NULLS LAST,
                                TestDate DESC NULLS LAST) AS BIGINT) AS dateRank
FROM j
""")
def rank_across_join(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    ip = o.select(F.col("o_custkey").alias("API"), F.col("o_orderkey").alias("CompletionID"),
                  F.col("o_orderdate").alias("completionDate"),
                  F.when(F.col("o_totalprice") > 300000, None).otherwise(F.col("o_totalprice")).alias("gas"),
                  F.when(F.col("o_orderpriority") == "1-URGENT", None).otherwise(F.col("o_orderdate"))
                  .alias("TestDate"))
    d = (li.where(F.col("l_returnflag") == "R")
         .join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
         .select(F.col("o_custkey").alias("d_API"), F.col("l_orderkey").alias("d_CompletionID"),
                 F.col("l_linenumber").alias("dLine"), F.col("l_quantity").alias("bottomHoleTemp")))
    h = latest_row(o, ["o_custkey"], ["o_orderdate"], payload=["o_orderkey", "o_orderdate"]).select(
        F.col("o_custkey").alias("h_api"), F.col("o_orderdate").alias("fpd"))
    j = (ip.join(d, (F.col("d_API") == F.col("API")) & (F.col("d_CompletionID") == F.col("CompletionID")), "left")
         .join(h, F.col("h_api") == F.col("API"), "left")
         .where(any_not_null("bottomHoleTemp", "gas")))
    r = dense_rank_by(j, ["h_api"], ["fpd", "completionDate", "TestDate"], "dateRank")
    return r.select("CompletionID", "dLine", "API", "dateRank")


@register("min_threshold", """
SELECT o_orderkey, o_custkey,
       CASE WHEN min(o_orderdate) OVER (PARTITION BY o_custkey) >= TIMESTAMP '1995-03-01'
            THEN min(o_orderdate) OVER (PARTITION BY o_custkey) ELSE NULL END AS firstProducedDate
FROM orders
""")
def min_threshold(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    m = partition_agg(o, ["o_custkey"], {"__min": F.min("o_orderdate")})
    return m.select("o_orderkey", "o_custkey",
                    floored_date(F.col("__min"), "1995-03-01").alias("firstProducedDate"))


@register("stage_fill", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN stage = -1 THEN NULL ELSE stage END AS stageNumber,
       CASE WHEN nos IS NULL AND stage <> -1 AND stage IS NOT NULL
            THEN max(stage) OVER (PARTITION BY l_orderkey) ELSE nos END AS numberOfStages
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 7 THEN -1 ELSE l_linenumber END AS stage,
             CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS nos
      FROM lineitem) x
""")
def stage_fill(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, -1).otherwise(F.col("l_linenumber")).alias("stage"),
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_quantity").cast("int")).alias("nos"))
    m = partition_agg(li, ["l_orderkey"], {"__maxStage": F.max("stage")})
    stage, nos = F.col("stage"), F.col("nos")
    return m.select("l_orderkey", "l_linenumber",
                    frac_detail.stage_number(stage).alias("stageNumber"),
                    frac_detail.stage_fill(nos, stage, F.col("__maxStage")).alias("numberOfStages"))


@register("sum_by_unit", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN upper(materialName) LIKE '%RING%' AND upper(rtrim(materialUnit)) = 'LB'
         THEN SUM(materialAmount) OVER (PARTITION BY api10, completionId) / (8.33 * 42)
       WHEN upper(materialName) LIKE '%RING%' AND upper(rtrim(materialUnit)) = 'GAL'
         THEN SUM(materialAmount) OVER (PARTITION BY api10, completionId) / 42
       WHEN upper(materialName) LIKE '%RING%' AND upper(rtrim(materialUnit)) = 'BBL'
         THEN SUM(materialAmount) OVER (PARTITION BY api10, completionId)
       ELSE NULL END AS cumWaterBbl
FROM (SELECT l.l_orderkey, l.l_linenumber, l.l_orderkey AS api10, l.l_linestatus AS completionId,
             p.p_name AS materialName, l.l_quantity AS materialAmount,
             CASE WHEN l.l_returnflag = 'A' THEN 'lb' WHEN l.l_returnflag = 'N' THEN 'GAL' ELSE 'bbl' END
               AS materialUnit
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey) x
""")
def sum_by_unit_q(spark, sf):
    li, p = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    rows = li.join(p, p["p_partkey"] == li["l_partkey"]).select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").alias("api10"), F.col("l_linestatus").alias("completionId"),
        F.col("p_name").alias("materialName"), F.col("l_quantity").alias("materialAmount"),
        F.when(F.col("l_returnflag") == "A", "lb").when(F.col("l_returnflag") == "N", "GAL").otherwise("bbl")
        .alias("materialUnit"))
    out = sum_by_unit(rows, ["api10", "completionId"], "materialAmount", "materialName", "materialUnit",
                      name_pattern="%RING%")
    return out.select("l_orderkey", "l_linenumber", "cumWaterBbl")


# --------------------------------------------------------------------------
# Set operations
# --------------------------------------------------------------------------

@register("union_feeds", """
SELECT CAST(l_orderkey AS VARCHAR) AS fracDetailId, l_orderkey AS api10, l_quantity AS materialAmount,
       upper(l_linestatus) AS materialDisclosueStatus, 'FRACFOCUS' AS sourceColumn,
       CAST(NULL AS INTEGER) AS stageNumber, l_shipdate AS jobDate
FROM lineitem
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS materialDisclosureStatus,
       'STATE ANGENCY', CASE WHEN o_orderstatus = 'F' THEN 1 END, o_orderdate
FROM orders
""")
def union_feeds(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    a = li.select(F.col("l_orderkey").cast("string").alias("fracDetailId"), F.col("l_orderkey").alias("api10"),
                  F.col("l_quantity").alias("materialAmount"),
                  F.upper("l_linestatus").alias("materialDisclosueStatus"), F.lit("FRACFOCUS").alias("sourceColumn"),
                  typed_null("int").alias("stageNumber"), F.col("l_shipdate").alias("jobDate"))
    b = o.select(F.col("o_orderkey").cast("string").alias("fracDetailId"), F.col("o_custkey").alias("api10"),
                 F.col("o_totalprice").alias("materialAmount"),
                 typed_null("string").alias("materialDisclosureStatus"), F.lit("STATE ANGENCY").alias("sourceColumn"),
                 F.when(F.col("o_orderstatus") == "F", 1).alias("stageNumber"), F.col("o_orderdate").alias("jobDate"))
    return union_all(a, b)


_CHILD_BASE_SQL = """
  SELECT o.o_custkey AS API, l.l_orderkey AS CompletionID, l.l_returnflag AS flag,
         CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 2 END AS RunNumber,
         l.l_quantity AS volumePerDay, l.l_extendedprice AS BottomHoleTemp, l.l_linestatus AS TimeOfRun
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""


@register("keys_only_in", f"""
WITH base AS ({_CHILD_BASE_SQL}),
gm AS (SELECT API, CompletionID, RunNumber, volumePerDay FROM base WHERE flag = 'A'),
ft AS (SELECT API, CompletionID, RunNumber, BottomHoleTemp, TimeOfRun FROM base WHERE flag = 'R'),
hdr AS (SELECT o_custkey AS API, o_orderkey AS CompletionID, o_orderpriority AS FormType,
               o_orderstatus AS state FROM orders),
a AS (
  SELECT h.API, h.CompletionID, h.FormType, ft.BottomHoleTemp, ft.TimeOfRun, g.volumePerDay,
         ft.RunNumber AS FT_RunNumber, g.RunNumber AS GM_RunNumber
  FROM hdr h JOIN gm g ON g.CompletionID = h.CompletionID JOIN ft ON ft.CompletionID = h.CompletionID
  WHERE upper(rtrim(h.state)) = 'F' AND h.CompletionID <> -1 AND g.RunNumber = 1 AND ft.RunNumber = 1),
gmo AS (SELECT h.* FROM (SELECT API, CompletionID FROM gm EXCEPT SELECT API, CompletionID FROM ft) x
        JOIN hdr h ON h.API = x.API AND h.CompletionID = x.CompletionID),
fto AS (SELECT h.* FROM (SELECT API, CompletionID FROM ft EXCEPT SELECT API, CompletionID FROM gm) x
        JOIN hdr h ON h.API = x.API AND h.CompletionID = x.CompletionID),
b AS (
  SELECT x.API, x.CompletionID, x.FormType, CAST(NULL AS DOUBLE) AS BottomHoleTemp,
         CAST(NULL AS VARCHAR) AS TimeOfRun, y.volumePerDay, CAST(NULL AS INTEGER) AS FT_RunNumber,
         y.RunNumber AS GM_RunNumber
  FROM gmo x JOIN gm y ON y.API = x.API AND y.CompletionID = x.CompletionID WHERE y.RunNumber = 1),
c AS (
  SELECT x.API, x.CompletionID, x.FormType, y.BottomHoleTemp, y.TimeOfRun, CAST(NULL AS DOUBLE) AS volumePerDay,
         y.RunNumber AS FT_RunNumber, CAST(NULL AS INTEGER) AS GM_RunNumber
  FROM fto x JOIN ft y ON y.API = x.API AND y.CompletionID = x.CompletionID WHERE y.RunNumber = 1)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c
""")
def keys_only_in_q(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    base = li.join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("API"), F.col("l_orderkey").alias("CompletionID"), F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("RunNumber"),
        F.col("l_quantity").alias("volumePerDay"), F.col("l_extendedprice").alias("BottomHoleTemp"),
        F.col("l_linestatus").alias("TimeOfRun"))
    gm = base.where(F.col("flag") == "A").select("API", "CompletionID", "RunNumber", "volumePerDay")
    ft = base.where(F.col("flag") == "R").select("API", "CompletionID", "RunNumber", "BottomHoleTemp", "TimeOfRun")
    hdr = o.select(F.col("o_custkey").alias("h_API"), F.col("o_orderkey").alias("h_CID"),
                   F.col("o_orderpriority").alias("FormType"), F.col("o_orderstatus").alias("state"))
    g1 = gm.where(F.col("RunNumber") == 1).select(
        F.col("API").alias("g_API"), F.col("CompletionID").alias("g_CID"), "volumePerDay",
        F.col("RunNumber").alias("GM_RunNumber"))
    f1 = ft.where(F.col("RunNumber") == 1).select(
        F.col("API").alias("f_API"), F.col("CompletionID").alias("f_CID"), "BottomHoleTemp", "TimeOfRun",
        F.col("RunNumber").alias("FT_RunNumber"))
    out_cols = ["API", "CompletionID", "FormType", "BottomHoleTemp", "TimeOfRun", "volumePerDay",
                "FT_RunNumber", "GM_RunNumber"]
    a = (hdr.where(eq_ci("state", "f") & (F.col("h_CID") != -1))
         .join(g1, F.col("g_CID") == F.col("h_CID")).join(f1, F.col("f_CID") == F.col("h_CID"))
         .select(F.col("h_API").alias("API"), F.col("h_CID").alias("CompletionID"), "FormType", "BottomHoleTemp",
                 "TimeOfRun", "volumePerDay", "FT_RunNumber", "GM_RunNumber"))

    gas_keys, field_keys = keys_only_in_each(gm, ft, ["API", "CompletionID"])

    def only(keys, side, pre, cols):
        k = keys.join(hdr, (F.col("h_API") == F.col("API")) & (F.col("h_CID") == F.col("CompletionID")))
        j = k.join(side, (F.col(f"{pre}_API") == F.col("API")) & (F.col(f"{pre}_CID") == F.col("CompletionID")))
        return j.select("API", "CompletionID", "FormType", *cols)

    b = only(gas_keys, g1, "g", [typed_null("double").alias("BottomHoleTemp"), typed_null("string").alias("TimeOfRun"),
                                 "volumePerDay", typed_null("int").alias("FT_RunNumber"), "GM_RunNumber"])
    c = only(field_keys, f1, "f", ["BottomHoleTemp", "TimeOfRun", typed_null("double").alias("volumePerDay"),
                                   "FT_RunNumber", typed_null("int").alias("GM_RunNumber")])
    return union_all(a.select(*out_cols), b, c)


# --------------------------------------------------------------------------
# Keyword classifiers
# --------------------------------------------------------------------------
# The benchmark part names carry no trade names, so a material description is
# derived from each part row: a trade word picked by the part key, then the
# part name; for mesh sizes the part name, then a grade picked by the part key
# written with a separator picked by the part size.

# Description vocabularies for the benchmark rows (chosen here, not source rules).
TRADE_WORDS = ("PRIME PLUS", "CoolSet", "Badger", "pearl", "UNIMIN", "Python", "CARBOLITE", "Titan",
               "CERAPROP", "Ottawa", "resin", "Ceramic", "Northern White", "plain", "SB Excel", "atlas")
MESH_GRADES = ("20/40", "30/50", "40/70", "100", "16/30", "12/20", "8/12", "20/70", "30/70", "40/80",
               "10/20", "16/20", "12/18", "13/40")
MESH_SEPARATORS = ("/", "-", " ")
TREATMENT_TYPE_WORDS = ("BASE CARRIER", "FRICTION REDUCER", "GELLING AGENT", "CROSSLINKER", "Biocide",
                        "SURFACTANT", "FOAMER")
TREATMENT_NAME_WORDS = ("WATER", "ACID", "PROPANE", "NITROGEN", "CO2", "GEL", "SLICKWATER", "X-LINK",
                        "ENERGIZER", "CARBON DIOXIDE")


def _pick(words, key_col):
    """``words[key mod n]`` as a column (1-based element_at)."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (key_col % len(words) + 1).cast("int"))


def _pick_sql(words, key_sql):
    arr = ", ".join(f"'{w}'" for w in words)
    return f"[{arr}][({key_sql} % {len(words)}) + 1]"


def _vendor_sql():
    return rules.rule_case_sql("d", "g", rules.VENDOR_RULES,
                               [("contractor IS NOT NULL", "upper(contractor)"), ("g", "'UNKNOWN'")])


def _ptype_sql():
    return rules.rule_case_sql("d", "g", rules.PROPPANT_TYPE_RULES, [("g", "'UNKNOWN'")])


def _mesh_sql():
    return rules.rule_case_sql("d", "g", rules.MESH_RULES, [("g", "'UNKNOWN'")])


_SPELLINGS = ("upper(x)", "lower(x)", "x || '  '", "x", "lower(x) || ' '")


def _spelled_sql(column, key):
    arms = " ".join(f"WHEN {i} THEN {e.replace('x', column)}" for i, e in enumerate(_SPELLINGS))
    return f"CASE ({key}) % {len(_SPELLINGS)} {arms} END"


def _spelled(column, key):
    c = F.col(column)
    forms = (F.upper(c), F.lower(c), F.concat(c, F.lit("  ")), c, F.concat(F.lower(c), F.lit(" ")))
    out = None
    for i, form in enumerate(forms):
        out = F.when(key % len(forms) == i, form) if out is None else out.when(key % len(forms) == i, form)
    return out


# One priority per customer is reported once an order, each time in another spelling; some have none.
_SPELLED_SQL = f"""SELECT o.o_custkey AS API, {_spelled_sql('o.o_orderpriority', 'o.o_orderkey')} AS remarks,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE {_spelled_sql('c.c_mktsegment', 'o.o_orderkey + 1')} END AS contractor,
    o.o_orderstatus AS state, year(o.o_orderdate) AS "year"
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey"""


@register("case_folded_distinct", f"""
SELECT DISTINCT ON (API, upper(rtrim(remarks)), upper(rtrim(contractor)), upper(rtrim(state)), "year")
  API, remarks, contractor, state, "year"::INTEGER AS "year"
FROM ({_SPELLED_SQL}) x ORDER BY remarks NULLS FIRST, contractor NULLS FIRST, state NULLS FIRST
""")
def case_folded_distinct(spark, sf):
    key = F.col("o_orderkey")
    o = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return distinct_ci(o.select(
        F.col("o_custkey").alias("API"), _spelled("o_orderpriority", key).alias("remarks"),
        F.when(key % 7 == 0, None).otherwise(_spelled("c_mktsegment", key + 1)).alias("contractor"),
        F.col("o_orderstatus").alias("state"), F.year("o_orderdate").alias("year")))


@register("dictionary_classify", f"""
SELECT l_orderkey, l_linenumber, {_vendor_sql()} AS supplierName, {_ptype_sql()} AS proppantType, {_mesh_sql()} AS proppantMeshSize
FROM (SELECT l_orderkey, l_linenumber, upper({_pick_sql(TRADE_WORDS, 'l_partkey')} || ' ' || {_pick_sql(MESH_GRADES, 'l_suppkey')}) AS d,
             upper(rtrim(p_type)) = 'PROMO' AS g, CASE WHEN l_linenumber > 3 THEN NULL ELSE p_brand END AS contractor
      FROM lineitem JOIN part ON p_partkey = l_partkey) x
""")
def dictionary_classify(spark, sf):
    part = F.col("l_partkey")
    rows = _t(spark, sf, "lineitem").join(_t(spark, sf, "part"), F.col("p_partkey") == part).select(
        "l_orderkey", "l_linenumber",
        F.upper(F.concat_ws(" ", _pick(TRADE_WORDS, part), _pick(MESH_GRADES, F.col("l_suppkey")))).alias("d"),
        eq_ci("p_type", "promo").alias("g"), F.when(F.col("l_linenumber") > 3, None).otherwise(F.col("p_brand")).alias("contractor"))
    rows = classify_text(rows, "d", "g", {"v": rules.VENDOR_RULES, "t": rules.PROPPANT_TYPE_RULES, "m": rules.MESH_RULES})
    unknown = F.when(F.col("g"), "UNKNOWN")
    return rows.select("l_orderkey", "l_linenumber", F.coalesce("v", F.upper("contractor"), unknown).alias("supplierName"),
                       F.coalesce("t", unknown).alias("proppantType"), F.coalesce("m", unknown).alias("proppantMeshSize"))


@register("vendor_classify", f"""
SELECT p_partkey, {_vendor_sql()} AS supplierName, {_ptype_sql()} AS proppantType
FROM (SELECT p_partkey, upper({_pick_sql(TRADE_WORDS, 'p_partkey')} || ' ' || p_name) AS d,
             upper(rtrim(p_type)) = 'PROMO' AS g,
             CASE WHEN p_size > 40 THEN NULL ELSE p_brand END AS contractor
      FROM part) x
""")
def vendor_classify(spark, sf):
    p = _t(spark, sf, "part").select(
        "p_partkey", F.upper(F.concat(_pick(TRADE_WORDS, F.col("p_partkey")), F.lit(" "), F.col("p_name"))).alias("d"),
        eq_ci("p_type", "promo").alias("g"),
        F.when(F.col("p_size") > 40, None).otherwise(F.col("p_brand")).alias("contractor"))
    return p.select("p_partkey", vendor("d", "g", F.col("contractor")).alias("supplierName"),
                    proppant_type("d", "g").alias("proppantType"))


@register("mesh_classify", f"""
SELECT p_partkey, {_mesh_sql()} AS proppantMeshSize
FROM (SELECT p_partkey,
             upper(p_name || ' ' || replace({_pick_sql(MESH_GRADES, 'p_partkey')}, '/',
                                            {_pick_sql(MESH_SEPARATORS, 'p_size')})) AS d,
             upper(rtrim(p_type)) = 'PROMO' AS g
      FROM part) x
""")
def mesh_classify(spark, sf):
    grade = F.replace(_pick(MESH_GRADES, F.col("p_partkey")), F.lit("/"), _pick(MESH_SEPARATORS, F.col("p_size")))
    p = _t(spark, sf, "part").select(
        "p_partkey", F.upper(F.concat(F.col("p_name"), F.lit(" "), grade)).alias("d"),
        eq_ci("p_type", "promo").alias("g"))
    return p.select("p_partkey", mesh_size("d", "g").alias("proppantMeshSize"))


_EXCLUDED_SQL = ", ".join(f"'{t.upper()}'" for t in rules.LIST_EXCLUDED_TYPES)


_TREATMENT_CASE_SQL = """CASE WHEN m LIKE '%FRICTION REDUCER%'
              AND (m LIKE '%GELLING AGENT%' OR m LIKE '% GEL%' OR m LIKE '%GELLED%' OR m LIKE '%MGEL%' OR m LIKE '%GELW%')
              AND (m LIKE '%CROSSLINKER%' OR m LIKE '%X-LINK%' OR m LIKE '%X LINK%') AND m LIKE '%ACID%' THEN 'HYBRID'
         WHEN m NOT LIKE '%BASE CARRIER, WATER%'
              AND (m LIKE '%PROPANE %' OR m LIKE '%PROPANE, %' OR m LIKE '%GAS FRAC%') THEN 'GAS FRAC'
         WHEN (m LIKE '%BASE CARRIER, ACID%' OR m LIKE '%BASE CARRIER, 15%ACID%' OR m LIKE '%BASE CARRIER, GEL%ACID%'
               OR m LIKE '%ACID FRAC%') AND NOT (rtrim(m) LIKE 'PROPPANT') THEN 'ACID FRAC'
         WHEN (m LIKE '%BASE CARRIER, NITROGEN%' OR m LIKE '%BASE CARRIER, CO2%' OR m LIKE '%BASE CARRIER, CARBON%')
              OR (m LIKE '%FOAM%' AND (m LIKE '%CO2%' OR rtrim(m) LIKE '%CARBON%DIOXIDE' OR m LIKE '%NITROGEN%'))
              OR (m LIKE '%ENERGIZED%' OR m LIKE '%ENERGIZER%') THEN 'ENERGIZED'
         WHEN (m LIKE '%GELLING AGENT%' AND m LIKE '%CROSSLINKER%') AND NOT (m LIKE '%FRICTION REDUCER%')
           THEN 'CONVENTIONAL'
         WHEN (m LIKE '%BASE CARRIER, WATER%' AND m LIKE '%FRICTION REDUCER%' AND m NOT LIKE '%CROSSLINKER%')
              OR m LIKE '%SLICKWATER%' THEN 'WATER FRAC'
         ELSE 'UNKNOWN' END"""


@register("treatment_classify", f"""
WITH u AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS api10, l.l_orderkey AS completionId,
         {_pick_sql(TREATMENT_TYPE_WORDS, 'l.l_partkey')} AS materialType,
         {_pick_sql(TREATMENT_NAME_WORDS, 'l.l_suppkey')} || ' ' || upper(p.p_name) AS materialName
  FROM {_MATERIALS_SQL}),
g AS (
  SELECT api10, completionId,
         string_agg(DISTINCT item, '' ORDER BY item)
           FILTER (WHERE upper(rtrim(materialType)) NOT IN ({_EXCLUDED_SQL})) AS s
  FROM (SELECT *, coalesce(', ' || materialType, '') || coalesce(', ' || materialName, '') AS item FROM u) x
  GROUP BY api10, completionId),
m AS (SELECT api10, completionId, upper(CASE WHEN s IS NULL OR s = '' THEN NULL ELSE substr(s, 2) END) AS m FROM g),
t AS (
  SELECT api10, completionId,
    {_TREATMENT_CASE_SQL} AS treatmentType
  FROM m)
SELECT u.l_orderkey, u.l_linenumber, t.treatmentType
FROM u LEFT JOIN t ON t.api10 = u.api10 AND t.completionId = u.completionId
""")
def treatment_classify(spark, sf):
    u = _materials(spark, sf).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("api10"), F.col("l_orderkey").alias("completionId"),
        _pick(TREATMENT_TYPE_WORDS, F.col("l_partkey")).alias("materialType"),
        F.concat(_pick(TREATMENT_NAME_WORDS, F.col("l_suppkey")), F.lit(" "), F.upper("p_name")).alias("materialName"),
        F.col("l_quantity").alias("materialAmount"))
    t = completion_summary(u)
    j = u.join(t, (F.col("__t_api10") == F.col("api10")) & (F.col("__t_cid") == F.col("completionId")), "left")
    return j.select("l_orderkey", "l_linenumber", "treatmentType")


# --------------------------------------------------------------------------
# Well-test rules, dates, casts
# --------------------------------------------------------------------------

@register("rate_fill", """
SELECT event_id,
  CASE WHEN upper(rtrim(state)) = 'LOUISIANA' AND oil24 IS NULL THEN TestOil
       WHEN (upper(rtrim(state)) = 'MONTANA' OR upper(rtrim(state)) = 'TEXAS') AND upper(Duration) LIKE '24%'
            AND oil24 IS NULL THEN TestOil
       WHEN oil24 IS NULL AND gas24 IS NOT NULL THEN 0
       ELSE oil24 END AS "24HourOil",
  CASE WHEN upper(rtrim(state)) = 'LOUISIANA' AND gas24 IS NULL THEN TestGas
       WHEN (upper(rtrim(state)) = 'MONTANA' OR upper(rtrim(state)) = 'TEXAS') AND upper(Duration) LIKE '24%'
            AND gas24 IS NULL THEN TestGas
       WHEN oil24 IS NOT NULL AND gas24 IS NULL THEN 0
       ELSE gas24 END AS "24HourGas",
  CASE WHEN upper(rtrim(state)) = 'LOUISIANA' AND water24 IS NULL THEN TestWater
       WHEN (upper(rtrim(state)) = 'MONTANA' OR upper(rtrim(state)) = 'TEXAS') AND upper(Duration) LIKE '24%'
            AND water24 IS NULL THEN TestWater
       WHEN water24 IS NULL AND oil24 IS NOT NULL AND gas24 IS NOT NULL THEN 0
       ELSE water24 END AS "24HourWater",
  CASE WHEN upper(ChokeSize) LIKE '0.0%' THEN NULL ELSE ChokeSize END AS chokeSize,
  upper(CASE WHEN upper(rtrim(method)) = 'ERROR' THEN NULL ELSE method END) AS producingMethod
FROM (
  SELECT e.event_id,
         CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN 'Louisiana' WHEN 'MACHINERY' THEN 'MONTANA'
                             WHEN 'BUILDING' THEN 'texas ' ELSE 'Oklahoma' END AS state,
         CASE WHEN e.value > 250 THEN '24 HRS' ELSE '12 HRS' END AS Duration,
         e.value + 1 AS TestOil, e.value + 2 AS TestGas, e.value + 3 AS TestWater,
         CASE WHEN e.event_type IN ('click', 'view') THEN NULL ELSE e.value END AS oil24,
         CASE WHEN e.event_type IN ('view', 'signup') THEN NULL ELSE e.value * 2 END AS gas24,
         CASE WHEN e.event_type IN ('error', 'view') THEN NULL ELSE e.value / 2 END AS water24,
         CASE WHEN e.value < 10 THEN '0.0' || e.event_type ELSE upper(e.event_type) END AS ChokeSize,
         e.event_type AS method
  FROM events e JOIN customer c ON c.c_custkey = e.user_id) x
""")
def rate_fill_q(spark, sf):
    ev, c = _t(spark, sf, "events"), _t(spark, sf, "customer")
    seg, v, et = F.col("c_mktsegment"), F.col("value"), F.col("event_type")
    x = ev.join(c, c["c_custkey"] == ev["user_id"]).select(
        "event_id",
        F.when(seg == "HOUSEHOLD", "Louisiana").when(seg == "MACHINERY", "MONTANA").when(seg == "BUILDING", "texas ")
        .otherwise("Oklahoma").alias("state"),
        F.when(v > 250, "24 HRS").otherwise("12 HRS").alias("Duration"),
        (v + 1).alias("TestOil"), (v + 2).alias("TestGas"), (v + 3).alias("TestWater"),
        F.when(et.isin("click", "view"), None).otherwise(v).alias("oil24"),
        F.when(et.isin("view", "signup"), None).otherwise(v * 2).alias("gas24"),
        F.when(et.isin("error", "view"), None).otherwise(v / 2).alias("water24"),
        F.when(v < 10, F.concat(F.lit("0.0"), et)).otherwise(F.upper(et)).alias("ChokeSize"),
        et.alias("method"))
    c_ = F.col
    oil, gas, water = rate_fill(c_("state"), c_("Duration"), c_("oil24"), c_("gas24"), c_("water24"),
                                c_("TestOil"), c_("TestGas"), c_("TestWater"))
    return x.select("event_id", oil.cast("double").alias("24HourOil"), gas.cast("double").alias("24HourGas"),
                    water.cast("double").alias("24HourWater"), choke_size(c_("ChokeSize")).alias("chokeSize"),
                    F.upper(null_if_ci("method", ["error"])).alias("producingMethod"))


@register("first_date_reconcile", """
SELECT u.o_orderkey,
       CASE WHEN date_diff('month', h.minDate, u.o_orderdate) >= -3 AND date_diff('month', h.minDate, u.o_orderdate) <= 0
            THEN u.o_orderdate ELSE h.minDate END AS firstProducedDate
FROM orders u
LEFT JOIN (SELECT o.o_custkey AS api, min(l.l_shipdate) AS minDate
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY o.o_custkey) h
  ON h.api = u.o_custkey
""")
def first_date_reconcile(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    h = (li.join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
         .groupBy(F.col("o_custkey").alias("h_api")).agg(F.min("l_shipdate").alias("minDate")))
    j = o.join(h, F.col("h_api") == F.col("o_custkey"), "left")
    return j.select("o_orderkey", first_produced(F.col("minDate"), F.col("o_orderdate")).alias("firstProducedDate"))


@register("ratios_and_casts", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_shipdate <= TIMESTAMP '1995-03-01' THEN NULL ELSE l_shipdate END AS testDate,
  CASE WHEN l_extendedprice > 0 AND l_quantity - 10 > 0 THEN l_extendedprice / (l_quantity - 10) ELSE NULL END
    AS gasOilRatio,
  CASE WHEN l_tax * 1000 > 0 AND l_quantity - 10 > 0 THEN (l_tax * 1000) / (l_quantity - 10) ELSE NULL END
    AS waterOilRatio,
  coalesce(CAST(trunc(CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_extendedprice / 100 END) AS BIGINT),
           CAST(trunc(l_quantity * 1.5) AS BIGINT)) AS oilGravity,
  coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END,
           substr(CAST(l_orderkey AS VARCHAR), 1, 34)) AS chokeSize
FROM lineitem
""")
def ratios_and_casts(spark, sf):
    li = _t(spark, sf, "lineitem")
    c = F.col
    oil = c("l_quantity") - 10
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(c("l_shipdate") <= _ts("1995-03-01"), None).otherwise(c("l_shipdate")).alias("testDate"),
        guarded_ratio(c("l_extendedprice"), oil).alias("gasOilRatio"),
        guarded_ratio(c("l_tax") * 1000, oil).alias("waterOilRatio"),
        isnull(F.when(c("l_linestatus") == "O", None).otherwise(c("l_extendedprice") / 100).cast("bigint"),
               (c("l_quantity") * 1.5).cast("bigint"), "bigint").alias("oilGravity"),
        isnull(F.when(c("l_returnflag") == "N", None).otherwise(c("l_returnflag")), varchar("l_orderkey", 34),
               "string").alias("chokeSize"))


# --------------------------------------------------------------------------
# Whole jobs on the role-mapped tables
# --------------------------------------------------------------------------

_PIPING_CH_SQL = """ch AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS API, CAST(o.o_orderkey AS VARCHAR) AS cid, o.o_orderpriority AS purpose,
         CASE n.n_nationkey % 3 WHEN 0 THEN 'texas ' WHEN 1 THEN 'Oklahoma' ELSE n.n_name END AS state
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey)"""
_PIPING_EH_SQL = """eh AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS api, lower(c.c_mktsegment) AS play, c.c_acctbal AS lat, c.c_acctbal / 2 AS lon,
         c.c_name AS operator, o.o_orderdate AS cd,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderdate + INTERVAL 45 DAY END AS fpd
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)"""


def _piping_sql(ch, eh):
    """The piping job over the CTEs ch (completion headers) and eh (published headers)."""
    return f"""WITH {ch},
cp AS (
  SELECT CASE WHEN l_linenumber = 7 THEN '-1' ELSE CAST(l_orderkey AS VARCHAR) END AS cid,
         CASE l_returnflag WHEN 'R' THEN 'casing ' WHEN 'A' THEN NULL ELSE 'Liner hanger' END AS rt,
         CASE l_linestatus WHEN 'O' THEN 'surface' ELSE 'other' END AS st,
         CAST(l_linenumber AS DOUBLE) * 20 - 20 AS size, l_quantity * 2.5 AS hole, l_quantity AS bottom,
         CAST(l_linenumber - 1 AS DOUBLE) * 5 AS top, l_extendedprice / 100 AS weight, l_tax AS amount,
         CASE l_returnflag WHEN 'N' THEN 'unknown' ELSE l_returnflag END AS class, l_discount AS toc,
         CASE l_linestatus WHEN 'O' THEN 'Unknown ' ELSE 'log' END AS tocBy, l_discount * 10 AS slurry
  FROM lineitem),
j AS (
  SELECT ch.API, ch.cid, purpose, state, cp.*, amount <= 0 AND upper(rtrim(class)) = 'UNKNOWN' AS dry
  FROM ch JOIN cp ON cp.cid = ch.cid
  WHERE upper(rtrim(state)) IN ('LOUISIANA', 'MONTANA', 'NEW MEXICO', 'NORTH DAKOTA', 'OKLAHOMA', 'TEXAS', 'WYOMING')
    AND cp.cid <> '-1'),
cl AS (
  SELECT DISTINCT API, cid AS completionId, purpose, state,
    CASE WHEN upper(rtrim(rt)) = 'CASING' AND upper(rtrim(st)) IN ('CONDUCTOR', 'INTERMEDIATE', 'LINER', 'PRODUCTION', 'SURFACE', 'TUBING')
           THEN upper(st)
         WHEN rt IS NULL OR rtrim(rt) = '' OR upper(rtrim(rt)) = 'UNKNOWN' THEN 'CASING' ELSE upper(rt) END AS casingType,
    CASE WHEN size <= 0.99 OR size >= 100 THEN NULL ELSE size END AS casingSize,
    CASE WHEN hole <= 0 OR hole >= 100 THEN NULL ELSE hole END AS holeSize,
    CASE WHEN bottom <= 10 THEN NULL ELSE bottom END AS casingBottom,
    CASE WHEN bottom <= 10 AND top = 0 THEN NULL ELSE top END AS casingTop,
    CASE WHEN weight <= 0 OR weight > 500 THEN NULL ELSE weight END AS casingWeight,
    CASE WHEN dry THEN NULL ELSE amount END AS cementAmount,
    CASE WHEN dry THEN NULL ELSE class END AS cementClass,
    CASE WHEN dry AND toc = 0 THEN NULL ELSE toc END AS cementTop,
    CASE WHEN dry AND toc = 0 AND upper(rtrim(tocBy)) = 'UNKNOWN' THEN NULL ELSE tocBy END AS tocBy,
    CASE WHEN slurry = 0 THEN NULL ELSE slurry END AS slurryVolume
  FROM j),
{eh},
h AS (
  SELECT DISTINCT api, play, lat, lon, operator, minDate FROM (
    SELECT *, DENSE_RANK() OVER (PARTITION BY api ORDER BY fpd DESC NULLS LAST, cd DESC NULLS LAST) AS dr,
           MIN(fpd) OVER (PARTITION BY api) AS minDate FROM eh WHERE api > '0') x WHERE dr = 1)
SELECT DISTINCT cl.API, completionId, upper(h.play) AS play, lat AS latitude, lon AS longitude, minDate AS firstProductionDate,
  operator AS currentOperator, upper(purpose) AS "filingPrupose", casingType, casingSize, holeSize, casingBottom, casingTop,
  casingWeight, cementAmount, cementClass, cementTop, upper(tocBy) AS cementTopSource, slurryVolume,
  CASE WHEN casingBottom > casingTop THEN casingBottom - casingTop END AS casingLength
FROM cl JOIN h ON h.api = cl.API
WHERE casingSize IS NOT NULL OR holeSize IS NOT NULL OR casingBottom IS NOT NULL OR casingTop IS NOT NULL
   OR casingWeight IS NOT NULL OR cementAmount IS NOT NULL OR cementClass IS NOT NULL OR cementTop IS NOT NULL
   OR tocBy IS NOT NULL OR slurryVolume IS NOT NULL
"""


@register("piping_job", _piping_sql(_PIPING_CH_SQL, _PIPING_EH_SQL))
def piping_job(spark, sf):
    o, c, n = _t(spark, sf, "orders"), _keyed(spark, sf, "customer"), _t(spark, sf, "nation")
    col = F.col
    wells = o.join(c, c["c_custkey"] == o["o_custkey"])
    nation = col("n_nationkey") % 3
    cmp_header = wells.join(n, n["n_nationkey"] == c["c_nationkey"]).select(
        col("o_custkey").cast("string").alias("API10"), col("o_orderkey").cast("string").alias("CompletionID"),
        col("o_orderpriority").alias("PurposeOfFiling"),
        F.when(nation == 0, "texas ").when(nation == 1, "Oklahoma").otherwise(col("n_name")).alias("state_name"),
        col("o_orderdate").alias("CompletionDate"))
    esp_header = wells.select(
        col("o_custkey").cast("string").alias("api"), F.lower("c_mktsegment").alias("play"),
        col("c_acctbal").alias("latitude27"), (col("c_acctbal") / 2).alias("longitude27"), col("c_name").alias("operator"),
        F.when(col("o_orderpriority") == "5-LOW", None)
        .otherwise(F.timestamp_add("DAY", F.lit(45), col("o_orderdate"))).alias("firstProductionDate"),
        col("o_orderdate").alias("completionDate"))
    return piping.build(cmp_header, _pipes(spark, sf), esp_header)


def _pipes(spark, sf):
    li, col = _t(spark, sf, "lineitem"), F.col
    flag, status, line = col("l_returnflag"), col("l_linestatus"), col("l_linenumber")
    return li.select(
        F.when(line == 7, "-1").otherwise(col("l_orderkey").cast("string")).alias("CompletionID"),
        F.when(flag == "R", "casing ").when(flag == "A", None).otherwise("Liner hanger").alias("CasingRecordType"),
        F.when(status == "O", "surface").otherwise("other").alias("StringType"),
        (line.cast("double") * 20 - 20).alias("CasingSize"), (col("l_quantity") * 2.5).alias("HoleSize"),
        col("l_quantity").alias("CasingBottom"), ((line - 1).cast("double") * 5).alias("CasingTop"),
        (col("l_extendedprice") / 100).alias("CasingWeight"), col("l_tax").alias("CementAmount"),
        F.when(flag == "N", "unknown").otherwise(flag).alias("CementClass"), col("l_discount").alias("TopOfCement"),
        F.when(status == "O", "Unknown ").otherwise("log").alias("TopCementDeterminedBy"),
        (col("l_discount") * 10).alias("SlurryVolume"))


# --------------------------------------------------------------------------
# Flagship: the well-header mart on the role-mapped tables
# --------------------------------------------------------------------------

def mart_inputs(spark, sf):
    o, c, n = _t(spark, sf, "orders"), _keyed(spark, sf, "customer"), _t(spark, sf, "nation")
    li, p = _t(spark, sf, "lineitem"), _keyed(spark, sf, "part")
    col = F.col
    header = (o.join(c, c["c_custkey"] == o["o_custkey"]).join(n, n["n_nationkey"] == c["c_nationkey"]).select(
        col("o_custkey").cast("string").alias("api"), col("o_orderkey").alias("hpdiEntityId"),
        col("c_mktsegment").alias("play"), col("c_name").alias("operator"),
        F.when(col("o_orderpriority") == "5-LOW", None)
        .otherwise(F.timestamp_add("DAY", F.lit(45), col("o_orderdate"))).alias("firstProductionDate"),
        col("o_orderdate").alias("completionDate"), col("n_name").alias("state"),
        col("o_totalprice").alias("totalDepth"), F.lower("c_mktsegment").alias("playArea"),
        F.when(col("c_acctbal") > 0, col("c_acctbal")).alias("proppantLbs"),
        F.when(col("c_acctbal") > 5000, col("c_acctbal")).alias("treatmentBbls")))
    # The published header's layout: what the tables have no column for is a typed NULL.
    header = header.select(*[col(f.name) if f.name in header.columns else typed_null(f.dataType.simpleString()).alias(f.name)
                             for f in schema("espHeader")])
    lo = li.join(_keyed(spark, sf, "orders").select("o_orderkey", "o_custkey"), col("o_orderkey") == col("l_orderkey"))
    frac = (lo.join(p, p["p_partkey"] == col("l_partkey")).select(
        col("o_custkey").cast("string").alias("api10"),
        F.when(col("l_returnflag") == "R", "PROPPANT").otherwise(F.upper("p_type")).alias("materialType"),
        col("p_type").alias("proppantType"),
        F.upper(F.split_part(col("p_name"), F.lit(" "), F.lit(1))).alias("treatmentType"),
        col("p_size").cast("string").alias("proppantMeshSize"), F.upper("p_name").alias("materialName"),
        col("l_quantity").alias("cumWaterBbl")))
    piping = lo.where(col("l_returnflag").isin("R", "A")).select(
        col("o_custkey").cast("string").alias("API"),
        F.when(col("l_returnflag") == "R", "surface").otherwise("PRODUCTION").alias("casingType"),
        col("l_extendedprice").alias("casingBottom"))
    gas, oil, water = col("l_extendedprice"), col("l_quantity"), col("l_linenumber").cast("double")
    tests = lo.where(col("l_returnflag") == "N").select(
        col("o_custkey").cast("string").alias("api"), col("l_shipdate").alias("completionDate"),
        col("l_linestatus").alias("testFormation"), gas.alias("24HourGas"), oil.alias("24HourOil"),
        water.alias("24HourWater"), guarded_ratio(gas, oil).alias("24HourGasOilRatio"),
        guarded_ratio(water, oil).alias("24HourWaterOilRatio"), oil.cast("bigint").alias("oilGravity"),
        typed_null("double").alias("casingPressure"), typed_null("double").alias("flowingTubePressue"),
        F.upper("l_returnflag").alias("producingMethod"), typed_null("string").alias("pumpType"),
        (gas / 10).alias("bottomHoleTemp"), typed_null("double").alias("bottomHoleTempDepth"),
        col("l_linenumber").cast("string").alias("chokeSize"), typed_null("double").alias("dryGasGravity"))
    # The mart joins rank 1 only, and every well with a test has one.
    tests = top_group(tests, ["api"], ["completionDate"]).withColumn("dateRank", F.lit(1).cast("bigint"))
    return header, frac, piping, tests


_MART_TEST_SQL = ", ".join(
    f'w."{src}" AS "{name}"' for src, name in header_mart.MART_TEST_COLUMNS)


def _nulls_sql(kind, names):
    return ", ".join(f'CAST(NULL AS {kind}) AS "{n}"' for n in names.split())


# The mart's header columns in order, written out from the source, not from MART_HEADER_COLUMNS.
_MART_HEADER_SQL = ", ".join([
    "h.state", _nulls_sql("VARCHAR", "county field reservoir reservoirAlias primaryProduct wellbore"),
    _nulls_sql("DOUBLE", "perfInterval"),
    _nulls_sql("VARCHAR", "perfIntervalSource section township range quarterQuarter abstract survey"),
    _nulls_sql("DOUBLE", "upperPerforation lowerPerforation"), "h.totalDepth", _nulls_sql("DOUBLE", "tvd latitude27 longitude27"),
    _nulls_sql("VARCHAR", "basin"), "upper(h.playArea) AS playArea", _nulls_sql("TIMESTAMP", "spudDate"),
    "h.completionDate", "h.firstProductionDate", _nulls_sql("TIMESTAMP", "lastProductionDate"),
    _nulls_sql("DOUBLE", """maxIpOil maxIpGas maxIpOilPending maxIpGasPending
        cum3MonthsOil cum3MonthsGas cum3MonthsWater cum6MonthsOil cum6MonthsGas cum6MonthsWater
        cum12MonthsOil cum12MonthsGas cum12MonthsWater cum24MonthsOil cum24MonthsGas cum24MonthsWater
        cum60MonthsOil cum60MonthsGas cum60MonthsWater cumTotalOil cumTotalGas cumTotalWater EUROil EURgas
        azimuth lateralLength cumulativeGasOilRatio firstGasOilRatio lastGasOilRatio pracIPGasOilRatio
        first3MonthsGasOilRatio"""),
    _nulls_sql("VARCHAR", "wellType"),
    _nulls_sql("DOUBLE", "oilGravity gasGravity lastProductionOil lastProductionGas lastProductionWater"),
    _nulls_sql("VARCHAR", "allocFlag intermediateCasing simulFrac padDrill linerSize tubingSize"), _nulls_sql("INTEGER", "stages"),
    "h.proppantLbs AS totalProppantLbs", "h.treatmentBbls AS totalTreatmentBbls"])


_MART_INPUT_SQL = """lo AS (SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
hdr AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS api, o.o_orderkey AS hpdiEntityId, c.c_mktsegment AS play,
         c.c_name AS operator,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderdate + INTERVAL 45 DAY END AS firstProductionDate,
         o.o_orderdate AS completionDate, n.n_name AS state, o.o_totalprice AS totalDepth,
         lower(c.c_mktsegment) AS playArea,
         CASE WHEN c.c_acctbal > 0 THEN c.c_acctbal END AS proppantLbs,
         CASE WHEN c.c_acctbal > 5000 THEN c.c_acctbal END AS treatmentBbls
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
frac AS (
  SELECT CAST(lo.o_custkey AS VARCHAR) AS api10,
         CASE WHEN lo.l_returnflag = 'R' THEN 'PROPPANT' ELSE upper(p.p_type) END AS materialType,
         p.p_type AS proppantType, upper(split_part(p.p_name, ' ', 1)) AS treatmentType,
         CAST(p.p_size AS VARCHAR) AS proppantMeshSize, upper(p.p_name) AS materialName,
         lo.l_quantity AS cumWaterBbl
  FROM lo JOIN part p ON p.p_partkey = lo.l_partkey),
piping AS (
  SELECT CAST(o_custkey AS VARCHAR) AS API,
         CASE WHEN l_returnflag = 'R' THEN 'surface' ELSE 'PRODUCTION' END AS casingType,
         l_extendedprice AS casingBottom
  FROM lo WHERE l_returnflag IN ('R', 'A')),
wt0 AS (
  SELECT CAST(o_custkey AS VARCHAR) AS api, l_shipdate AS completionDate, l_linestatus AS testFormation,
         l_extendedprice AS "24HourGas", l_quantity AS "24HourOil", CAST(l_linenumber AS DOUBLE) AS "24HourWater",
         CASE WHEN l_extendedprice > 0 AND l_quantity > 0 THEN l_extendedprice / l_quantity END AS "24HourGasOilRatio",
         CASE WHEN l_linenumber > 0 AND l_quantity > 0 THEN CAST(l_linenumber AS DOUBLE) / l_quantity END
           AS "24HourWaterOilRatio",
         CAST(trunc(l_quantity) AS BIGINT) AS oilGravity, CAST(NULL AS DOUBLE) AS casingPressure,
         CAST(NULL AS DOUBLE) AS flowingTubePressue, upper(l_returnflag) AS producingMethod,
         CAST(NULL AS VARCHAR) AS pumpType, l_extendedprice / 10 AS bottomHoleTemp,
         CAST(NULL AS DOUBLE) AS bottomHoleTempDepth, CAST(l_linenumber AS VARCHAR) AS chokeSize,
         CAST(NULL AS DOUBLE) AS dryGasGravity
  FROM lo WHERE l_returnflag = 'N'),
wt AS (SELECT *, DENSE_RANK() OVER (PARTITION BY api ORDER BY completionDate DESC NULLS LAST) AS dateRank FROM wt0)"""


def _mart_sql(inputs, header_sql):
    """The mart over the CTEs hdr, frac, piping and wt."""
    return f"""WITH {inputs},
ms AS (
  SELECT api10,
    CASE WHEN pt IS NULL OR pt = '' THEN NULL ELSE substr(pt, 3) END AS proppantTypeStuff,
    CASE WHEN tt IS NULL OR tt = '' THEN NULL ELSE substr(tt, 3) END AS treatmentTypeStuff,
    CASE WHEN pm IS NULL OR pm = '' THEN NULL ELSE substr(pm, 3) END AS proppantMeshSizeStuff,
    cumWaterBbl
  FROM (
    SELECT api10,
      string_agg(DISTINCT ', ' || proppantType, '' ORDER BY ', ' || proppantType)
        FILTER (WHERE upper(rtrim(materialType)) = 'PROPPANT') AS pt,
      string_agg(DISTINCT ', ' || treatmentType, '' ORDER BY ', ' || treatmentType)
        FILTER (WHERE upper(rtrim(materialType)) <> 'PROPPANT') AS tt,
      string_agg(DISTINCT ', ' || proppantMeshSize, '' ORDER BY ', ' || proppantMeshSize)
        FILTER (WHERE upper(rtrim(materialType)) = 'PROPPANT') AS pm,
      max(cumWaterBbl) AS cumWaterBbl
    FROM frac GROUP BY api10) a),
ut AS (SELECT DISTINCT api FROM (SELECT api10 AS api FROM frac UNION ALL SELECT api FROM wt
                                 UNION ALL SELECT API FROM piping) x),
hp AS (
  SELECT DISTINCT h.api, h.hpdiEntityId, upper(h.play) AS play, h.operator,
         CAST(DENSE_RANK() OVER (PARTITION BY h.api ORDER BY h.firstProductionDate DESC NULLS LAST,
                                 h.completionDate DESC NULLS LAST) AS BIGINT) AS dateRank,
         {header_sql}
  FROM hdr h WHERE EXISTS (SELECT api FROM ut u WHERE u.api = h.api))
SELECT DISTINCT h.*, f.cumWaterBbl AS totalWaterBbl,
  MIN(p.casingBottom) OVER (PARTITION BY p.API) AS surfaceCasingDepth,
  CASE WHEN f.proppantTypeStuff IS NOT NULL AND h.totalProppantLbs IS NOT NULL THEN f.proppantTypeStuff
       WHEN h.totalProppantLbs IS NOT NULL THEN 'UNKNOWN' ELSE NULL END AS proppantType,
  CASE WHEN f.proppantMeshSizeStuff IS NOT NULL AND h.totalProppantLbs IS NOT NULL THEN f.proppantMeshSizeStuff
       WHEN h.totalProppantLbs IS NOT NULL THEN 'UNKNOWN' ELSE NULL END AS proppantMeshSize,
  CASE WHEN f.treatmentTypeStuff IS NOT NULL AND h.totalTreatmentBbls IS NOT NULL THEN f.treatmentTypeStuff
       WHEN h.totalTreatmentBbls IS NOT NULL THEN 'UNKNOWN' ELSE NULL END AS treatmentType,
  {_MART_TEST_SQL}
FROM hp h
LEFT JOIN ms f ON f.api10 = h.api
LEFT JOIN piping p ON p.API = h.api AND upper(rtrim(p.casingType)) = 'SURFACE'
LEFT JOIN wt w ON w.api = h.api AND h.dateRank = 1 AND w.dateRank = 1
  AND ((w.completionDate + INTERVAL 1 MONTH >= h.completionDate AND w.completionDate - INTERVAL 1 MONTH <= h.completionDate)
    OR (w.completionDate + INTERVAL 1 MONTH >= h.firstProductionDate
        AND w.completionDate - INTERVAL 1 MONTH <= h.firstProductionDate))
"""


@register("header_mart", _mart_sql(_MART_INPUT_SQL, _MART_HEADER_SQL))
def header_mart_q(spark, sf):
    header, frac, piping, tests = mart_inputs(spark, sf)
    return header_mart.build(header, frac, piping, tests)


# --------------------------------------------------------------------------
# Whole jobs on the role-mapped tables: a well holds two orders (its
# completions), a line item is a material row or a test by its return flag
# --------------------------------------------------------------------------

_SQL_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "int": "INTEGER",
              "bigint": "BIGINT"}


def _well(key):
    return F.floor(F.col(key) / 2).cast("string")


def _days(n, column):
    return F.timestamp_add("DAY", F.lit(n), F.col(column))


def _layout_sql(cols, layout):
    """SELECT list in ``layout`` order: given expressions cast to the type, others typed NULL."""
    return ", ".join(f'CAST({cols.get(n, "NULL")} AS {_SQL_TYPES[t]}) AS "{n}"' for n, t in layout)


_JOB_HEADER_SQL = """
  SELECT CAST(o_orderkey // 2 AS VARCHAR) AS API10,
         CASE WHEN o_orderkey = 1 THEN '-1' ELSE CAST(o_orderkey AS VARCHAR) END AS cid, o_orderpriority AS purpose,
         o_orderstatus AS form, c_name, c_mktsegment, n_name, o_totalprice, o_orderdate AS cdate,
         CASE n_nationkey % 4 WHEN 0 THEN 'texas ' WHEN 1 THEN 'Oklahoma' WHEN 2 THEN 'LOUISIANA' ELSE n_name END AS state,
         CASE WHEN o_orderkey % 50 = 0 THEN TIMESTAMP '1950-06-01' WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE o_orderdate + INTERVAL 20 DAY END AS fpd
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""

_JOB_ESP_SQL = """
  SELECT * FROM (SELECT *, MIN(fpd) OVER (PARTITION BY api) AS minDate, ROW_NUMBER() OVER (PARTITION BY api
      ORDER BY fpd DESC NULLS LAST, play DESC NULLS LAST, lat DESC NULLS LAST, lon DESC NULLS LAST, tvd DESC NULLS LAST,
               stages DESC NULLS LAST, alias DESC NULLS LAST, operator DESC NULLS LAST) AS rn
    FROM (SELECT CASE WHEN o_orderkey % 10 = 7 THEN NULL ELSE CAST(o_orderkey // 2 AS VARCHAR) END AS api,
                 c_mktsegment AS play, c_acctbal AS lat, c_acctbal / 2 AS lon, o_totalprice AS tvd,
                 n_nationkey AS stages, lower(c_mktsegment) AS alias, c_name AS operator,
                 CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 45 DAY END AS fpd
          FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) e
    WHERE api > '0') x WHERE rn = 1"""


def _job_headers(spark, sf):
    """(completion header, published header) rows of the whole orders table."""
    o, c, n = _t(spark, sf, "orders"), _keyed(spark, sf, "customer"), _t(spark, sf, "nation")
    col = F.col
    wells = o.join(c, c["c_custkey"] == o["o_custkey"]).join(n, n["n_nationkey"] == c["c_nationkey"])
    nation, key, low = col("n_nationkey") % 4, col("o_orderkey"), col("o_orderpriority") == "5-LOW"
    cmp_header = wells.select(
        _well("o_orderkey").alias("API10"), F.when(key == 1, "-1").otherwise(key.cast("string")).alias("CompletionID"),
        col("o_orderpriority").alias("PurposeOfFiling"), col("o_orderstatus").alias("TypeOfCompletion"),
        col("o_orderstatus").alias("FormType"),
        F.when(nation == 0, "texas ").when(nation == 1, "Oklahoma").when(nation == 2, "LOUISIANA")
        .otherwise(col("n_name")).alias("state_name"),
        col("o_orderdate").alias("CompletionDate"), _days(-30, "o_orderdate").alias("CompletionSpudDate"),
        F.when(key % 50 == 0, _ts("1950-06-01 00:00:00")).when(low, None)
        .otherwise(_days(20, "o_orderdate")).alias("FirstProducedDate"),
        col("o_totalprice").alias("TotalDepthMD"), (col("o_totalprice") / 2).alias("TotalDepthTVD"),
        col("c_mktsegment").alias("Reservoir"), _days(-60, "o_orderdate").alias("DateDrillingCommenced"),
        _days(-40, "o_orderdate").alias("DateDrillingCompleted"), col("c_name").alias("DrillingContractor"),
        col("n_name").alias("PipelineConnection"), col("o_orderstatus").alias("Remarks"))
    esp_header = wells.select(
        F.when(key % 10 == 7, None).otherwise(_well("o_orderkey")).alias("api"), col("c_mktsegment").alias("play"),
        col("c_acctbal").alias("latitude27"), (col("c_acctbal") / 2).alias("longitude27"),
        col("c_acctbal").alias("upperPerforation"), (col("c_acctbal") / 2).alias("lowerPerforation"),
        col("o_totalprice").alias("tvd"), col("n_nationkey").alias("stages"),
        F.lower("c_mktsegment").alias("reservoirAlias"), col("c_name").alias("operator"),
        F.when(low, None).otherwise(_days(45, "o_orderdate")).alias("firstProductionDate"))
    return cmp_header, esp_header


_JOB_TYPE_WORD_SQL = _pick_sql(TREATMENT_TYPE_WORDS, "l_partkey")
_JOB_NAME_SQL = (f"{_pick_sql(TREATMENT_NAME_WORDS, 'l_suppkey')} || ' ' || {_pick_sql(TRADE_WORDS, 'l_partkey')} "
                 f"|| ' ' || {_pick_sql(MESH_GRADES, 'l_partkey')}")
_JOB_UNIT_SQL = "CASE l_linenumber % 4 WHEN 0 THEN 'GAL' WHEN 1 THEN 'bbl ' WHEN 2 THEN 'unknown ' ELSE 'lb' END"
_JOB_TYPE_SQL = f"CASE WHEN l_suppkey % 3 = 0 THEN 'Proppant ' ELSE {_JOB_TYPE_WORD_SQL} END"

_DISCLOSURE_SQL = _layout_sql({
    "fracDetailId": "did", "api10": "API", "api14": "substr(ffapi, 1, 14)", "completionId": "did",
    "spudDate": "l_shipdate - INTERVAL 90 DAY",
    "firstProducedDate": "CASE WHEN minFP >= TIMESTAMP '1951-01-01' THEN minFP END",
    "completionDate": "l_shipdate", "filingPurpose": "'FRACFOCUS'", "jobStartDate": "l_shipdate - INTERVAL 1 DAY",
    "jobEndDate": "l_shipdate", "measuredDepth": "coalesce(md, o_totalprice)", "trueVerticalDepth": "o_totalprice / 2",
    "formation": "c_mktsegment", "ingredientId": "l_partkey", "CASNumber": "l_linestatus", "materialName": "upper(nm)",
    "materialAmount": "l_quantity", "materialUnit": "CASE WHEN upper(rtrim(unit)) = 'LB' THEN 'LBS' ELSE upper(unit) END",
    "materialType": "upper(ty)", "purposeId": "l_suppkey",
    "purposeDescription": "CASE WHEN upper(rtrim(pd)) IN ('NULL', 'UNKNOWN', '') THEN NULL ELSE pd END",
    "supplierId": "l_suppkey", "supplierName": "upper(sup)",
    "proppantType": "CASE WHEN resin = 'Y' THEN 'RESIN COATED' WHEN art = 'Y' THEN 'ARTIFICIAL' "
                    "WHEN sand = 'Y' THEN 'SAND' WHEN upper(rtrim(ty)) = 'PROPPANT' THEN 'UNKNOWN' END",
    "proppantMeshSize": "CASE WHEN rtrim(tmesh) <> '' THEN tmesh WHEN rtrim(imesh) <> '' THEN imesh "
                        "WHEN upper(rtrim(ty)) = 'PROPPANT' THEN 'UNKNOWN' END",
    "sandQuality": "CASE WHEN rtrim(l_returnflag) <> '' THEN l_returnflag END", "tradeId": "l_partkey",
    "tradeName": "nm", "materialDisclosueStatus": "'OPEN'", "disclosureId": "l_orderkey",
    "percentHighAdditive": "l_tax", "materialAmountPercent": "l_discount", "materialMatchingStrategy": "'EXACT'",
    "materialMatchingPercentConfidence": "l_tax", "drillingCommencedDate": "cdate - INTERVAL 60 DAY",
    "drillingCompletedDate": "cdate - INTERVAL 40 DAY", "drillingContractor": "c_name", "pipelineConnection": "n_name",
    "sourceColumn": "CASE l_linenumber WHEN 1 THEN 'FF 1' WHEN 2 THEN 'FF 2' WHEN 3 THEN 'FF 3' ELSE 'FF' END",
}, frac_detail.LAYOUT)
_STATE_SQL = _layout_sql({
    "fracDetailId": "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", "api10": "API10",
    "completionId": "h.cid", "spudDate": "cdate - INTERVAL 30 DAY", "firstProducedDate": "fpd", "completionDate": "cdate",
    "filingPurpose": "upper(purpose)", "completionType": "upper(form)", "jobStartDate": "l_shipdate",
    "jobEndDate": "l_shipdate + INTERVAL 2 DAY", "depthIntervalFrom": "CASE WHEN l_linenumber > 3 THEN l_quantity END",
    "depthIntervalTo": "CASE WHEN l_linenumber > 3 THEN l_quantity * 2 END",
    "isSummary": "CASE l_linenumber % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' ELSE 'PARTIAL' END",
    "stageNumber": "CASE WHEN stage = -1 THEN NULL ELSE stage END",
    "numberOfStages": "CASE WHEN stages IS NULL AND stage <> -1 AND stage IS NOT NULL THEN maxStage ELSE stages END",
    "measuredDepth": "o_totalprice", "trueVerticalDepth": "o_totalprice / 2", "formation": "fm", "materialName": "nm",
    "materialAmount": "l_quantity",
    "materialUnit": "CASE WHEN upper(rtrim(unit)) IN ('NULL', 'UNKNOWN', '') THEN NULL ELSE unit END",
    "materialType": "upper(ty)", "supplierName": _vendor_sql(), "proppantType": _ptype_sql(),
    "proppantMeshSize": _mesh_sql(), "drillingCommencedDate": "cdate - INTERVAL 60 DAY",
    "drillingCompletedDate": "cdate - INTERVAL 40 DAY", "drillingContractor": "c_name", "pipelineConnection": "n_name",
    "remarks": "form", "sourceColumn": "'STATE ANGENCY'",
}, frac_detail.LAYOUT)


_FRAC_INPUT_SQL = f"""
WITH hd AS ({_JOB_HEADER_SQL}),
eh AS ({_JOB_ESP_SQL}),
ff AS (
  SELECT *, CAST(l_orderkey AS VARCHAR) AS did, CAST(l_orderkey // 2 AS VARCHAR) AS API,
    CAST(10000000000000 + l_orderkey AS VARCHAR) || '99' AS ffapi, CASE WHEN l_linenumber > 2 THEN l_quantity END AS md,
    {_JOB_NAME_SQL} AS nm, {_JOB_TYPE_SQL} AS ty, {_JOB_UNIT_SQL} AS unit,
    CASE l_linenumber % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'carries' ELSE NULL END AS pd,
    CASE l_suppkey % 4 WHEN 0 THEN 'lookup operator name in header ' WHEN 1 THEN NULL WHEN 2 THEN 'n/a'
         ELSE 'Supplier ' || CAST(l_suppkey AS VARCHAR) END AS sup,
    CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END AS resin, CASE WHEN l_linenumber <= 2 THEN 'Y' END AS art,
    CASE WHEN l_linenumber <= 4 THEN 'Y' END AS sand, CASE WHEN l_linenumber = 5 THEN '40/70' ELSE ' ' END AS tmesh,
    CASE WHEN l_linenumber = 6 THEN '30/50' END AS imesh
  FROM lineitem WHERE l_returnflag <> 'N'),
fd AS (
  SELECT *, MAX(stage) OVER (PARTITION BY l_orderkey // 2) AS maxStage, upper(nm) AS d,
         coalesce(upper(rtrim(ty)) = 'PROPPANT', FALSE) AS g
  FROM (SELECT *, {_JOB_NAME_SQL} AS nm, {_JOB_TYPE_SQL} AS ty, {_JOB_UNIT_SQL} AS unit,
               CASE WHEN l_linenumber = 7 THEN 'none' ELSE CAST(l_orderkey AS VARCHAR) END AS cid,
               CASE WHEN l_linenumber = 3 THEN -1 ELSE l_linenumber END AS stage,
               CASE WHEN l_linestatus = 'F' THEN 9 END AS stages, CASE WHEN l_linenumber > 4 THEN l_linestatus END AS fm,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE 'contractor ' || CAST(l_suppkey AS VARCHAR) END AS contractor
        FROM lineitem WHERE l_returnflag = 'N') x)"""
_DISCLOSURE_FEED_SQL = f"""SELECT DISTINCT {_DISCLOSURE_SQL}
   FROM ff JOIN (SELECT *, MIN(fpd) OVER (PARTITION BY API10) AS minFP FROM hd) h ON h.API10 = ff.API"""
_STATE_FEED_SQL = f"SELECT DISTINCT {_STATE_SQL} FROM fd LEFT JOIN hd h ON h.cid = fd.cid"


@register("frac_detail_job", f"""{_FRAC_INPUT_SQL},
u AS (
  ({_DISCLOSURE_FEED_SQL})
  UNION ALL
  ({_STATE_FEED_SQL})),
it AS (
  SELECT api10, completionId, materialAmount, coalesce(', ' || materialType, '') || coalesce(', ' || materialName, '') AS item,
         upper(rtrim(materialType)) NOT IN ({_EXCLUDED_SQL}) AS listed FROM u),
g AS (SELECT api10, completionId, string_agg(DISTINCT item, '' ORDER BY item) FILTER (WHERE listed) AS s,
             SUM(materialAmount) AS total FROM it GROUP BY api10, completionId),
t AS (SELECT api10, completionId, total, upper(CASE WHEN s = '' THEN NULL ELSE substr(s, 2) END) AS m FROM g)
SELECT u.api10, e.play, u.completionId, fracDetailId, e.operator AS currentOperator, spudDate, completionDate,
  CASE WHEN (year(firstProducedDate) - year(minDate)) * 12 + month(firstProducedDate) - month(minDate) BETWEEN -3 AND 0
       THEN firstProducedDate ELSE minDate END AS firstProducedDate,
  filingPurpose, completionType, jobStartDate, jobEndDate, coalesce(depthIntervalFrom, e.lat) AS depthIntervalFrom,
  coalesce(depthIntervalTo, e.lon) AS depthIntervalTo, isSummary, stageNumber,
  coalesce(numberOfStages, e.stages) AS numberOfStages, measuredDepth,
  coalesce(trueVerticalDepth, e.tvd) AS trueVerticalDepth, coalesce(formation, e.alias) AS formation, ingredientId,
  CASNumber, materialName, materialAmount, materialUnit, materialType, purposeId, purposeDescription, supplierId,
  CASE WHEN upper(rtrim(supplierName)) IN ('LOOKUP OPERATOR NAME IN HEADER', 'OIPERATOR') THEN e.operator
       WHEN supplierName IS NULL OR upper(rtrim(supplierName)) = 'N/A' THEN 'UNKNOWN' ELSE supplierName END AS supplierName,
  proppantType, proppantMeshSize, sandQuality,
  CASE WHEN u.api10 IS NOT NULL AND u.completionId IS NOT NULL THEN {_TREATMENT_CASE_SQL} END AS treatmentType,
  CASE WHEN upper(materialName) NOT LIKE '%WATER%' THEN NULL
       WHEN upper(rtrim(materialUnit)) = 'LB' THEN total / (8.33 * 42)
       WHEN upper(rtrim(materialUnit)) = 'GAL' THEN total / 42
       WHEN upper(rtrim(materialUnit)) = 'BBL' THEN total END AS cumWaterBbl,
  tradeId, tradeName, materialDisclosueStatus, disclosureId, percentHighAdditive, materialAmountPercent,
  materialMatchingPercentConfidence, drillingCommencedDate, drillingCompletedDate, drillingContractor,
  pipelineConnection, remarks, sourceColumn
FROM u LEFT JOIN eh e ON e.api = u.api10
LEFT JOIN t ON t.api10 IS NOT DISTINCT FROM u.api10 AND t.completionId IS NOT DISTINCT FROM u.completionId
""")
def frac_detail_job(spark, sf):
    ff, cmp_header, fd, esp_header = _frac_inputs(spark, sf)
    return frac_detail.build(ff, cmp_header, fd, esp_header)


@register("disclosure_feed", f"{_FRAC_INPUT_SQL} {_DISCLOSURE_FEED_SQL}")
def disclosure_feed(spark, sf):
    ff, cmp_header, _, _ = _frac_inputs(spark, sf)
    return frac_detail.disclosure_feed(ff, cmp_header)


@register("state_feed", f"{_FRAC_INPUT_SQL} {_STATE_FEED_SQL}")
def state_feed(spark, sf):
    _, cmp_header, fd, _ = _frac_inputs(spark, sf)
    return frac_detail.state_feed(fd, cmp_header, dictionary=True)


def _frac_inputs(spark, sf):
    """Disclosure rows, completion headers, state rows and published headers."""
    cmp_header, esp_header = _job_headers(spark, sf)
    li, col = _t(spark, sf, "lineitem"), F.col
    line, supp, part = col("l_linenumber"), col("l_suppkey"), col("l_partkey")
    name = F.concat_ws(" ", _pick(TREATMENT_NAME_WORDS, supp), _pick(TRADE_WORDS, part), _pick(MESH_GRADES, part))
    kind = F.when(supp % 3 == 0, "Proppant ").otherwise(_pick(TREATMENT_TYPE_WORDS, part))
    unit = (F.when(line % 4 == 0, "GAL").when(line % 4 == 1, "bbl ").when(line % 4 == 2, "unknown ").otherwise("lb"))
    ff = li.where(col("l_returnflag") != "N").select(
        col("l_orderkey").cast("string").alias("DRWellID"), _well("l_orderkey").alias("API"),
        F.concat((col("l_orderkey") + 10000000000000).cast("string"), F.lit("99")).alias("FFAPI14"),
        _days(-90, "l_shipdate").alias("FirstSpuddate"), _days(-1, "l_shipdate").alias("JobStartDate"),
        col("l_shipdate").alias("JobEndDate"), F.when(line > 2, col("l_quantity")).alias("MD"),
        part.alias("IngredientID"), col("l_linestatus").alias("CasNumber"), name.alias("IngredientName"),
        col("l_quantity").alias("CalcIngredientMass"), unit.alias("IngredientMassUOM"), kind.alias("PurposeName"),
        supp.alias("PurposeID"),
        F.when(line % 3 == 0, "Unknown").when(line % 3 == 1, "carries").alias("PurposeDescription"),
        supp.alias("SupplierID"),
        F.when(supp % 4 == 0, "lookup operator name in header ").when(supp % 4 == 1, None).when(supp % 4 == 2, "n/a")
        .otherwise(F.concat(F.lit("Supplier "), supp.cast("string"))).alias("SupplierName"),
        F.when(line == 1, "Y").otherwise("N").alias("IngredientIsResinCoated"), F.lit("N").alias("TradeIsResinCoated"),
        F.when(line <= 2, "y").alias("IngredientIsArtificial"), typed_null("string").alias("TradeIsArtificial"),
        typed_null("string").alias("IngredientIsSand"), F.when(line <= 4, "Y ").alias("TradeIsSand"),
        F.when(line == 5, "40/70").otherwise(" ").alias("TradeSandMeshSize"),
        F.when(line == 6, "30/50").alias("IngredientSandMeshSize"), F.lit("").alias("TradeSandQuality"),
        col("l_returnflag").alias("IngredientSandQuality"), part.alias("TradeID"), name.alias("TradeName"),
        F.lit("open").alias("DisclosureStatus"), col("l_orderkey").alias("DisclosureID"),
        col("l_tax").alias("PercentHighAdditive"), col("l_discount").alias("IngredientHFJobPercent"),
        F.lit("exact").alias("MatchingStrategy"), col("l_tax").alias("PercentofConfidence"), line.alias("FFVersion"))
    fd = li.where(col("l_returnflag") == "N").select(
        F.concat_ws("-", col("l_orderkey").cast("string"), line.cast("string")).alias("cmpFracDetailId"),
        _well("l_orderkey").alias("API10"),
        F.when(line == 7, "none").otherwise(col("l_orderkey").cast("string")).alias("CompletionID"),
        col("l_shipdate").alias("BeginDateTime"), _days(2, "l_shipdate").alias("EndDateTime"),
        F.when(line > 3, col("l_quantity")).alias("DepthIntervalFrom"),
        F.when(line > 3, col("l_quantity") * 2).alias("DepthIntervalTo"),
        F.when(line % 3 == 0, "1").when(line % 3 == 1, "0 ").otherwise("partial").alias("isSummary"),
        F.when(line == 3, -1).otherwise(line).alias("StageNumber"),
        F.when(col("l_linestatus") == "F", 9).alias("numberOfStages"),
        F.when(line > 4, col("l_linestatus")).alias("stimulatedFormation"), name.alias("materialDescription"),
        col("l_quantity").alias("materialAmount"), unit.alias("materialUnit"), kind.alias("materialType"),
        F.when(line == 2, None).otherwise(F.concat(F.lit("contractor "), supp.cast("string"))).alias("contractorName"))
    return ff, cmp_header, fd, esp_header


_JOB_IP_SQL = """
  SELECT *, CASE WHEN l_linenumber = 7 THEN '-1' ELSE CAST(l_orderkey AS VARCHAR) END AS ipid, l_shipdate AS tdate,
    CASE WHEN l_linestatus = 'O' THEN '24 HRS' ELSE '12' END AS dur,
    CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity + 0.75 END AS grav, l_quantity * 10 AS tg,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS oil24,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_quantity END AS gas24,
    CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_discount END AS water24,
    CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_linenumber = 3 THEN '0.0/64'
         ELSE 'c' || CAST(l_linenumber AS VARCHAR) END AS choke,
    CASE WHEN l_discount > 0.03 THEN l_discount END AS casing, l_tax AS tubing,
    CASE WHEN l_linestatus = 'O' THEN 'N/A ' WHEN l_linenumber = 1 THEN 'unknown' ELSE 'Rod' END AS pump
  FROM lineitem"""


@register("well_test_job", f"""
WITH hd AS ({_JOB_HEADER_SQL}),
eh AS ({_JOB_ESP_SQL}),
ip AS ({_JOB_IP_SQL}),
pt AS (SELECT *, coalesce(oil24, 0) + CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END AS poil, coalesce(gas24, 0) AS pgas,
              coalesce(choke, '0') AS pchoke FROM ip WHERE ipid <> '-1'),
a AS (
  SELECT DISTINCT API10 AS API, cid, purpose, state, cdate, tdate, dur, grav, tg,
    CASE WHEN (la OR mt) AND oil24 IS NULL THEN l_extendedprice WHEN oil24 IS NULL AND gas24 IS NOT NULL THEN 0
         ELSE oil24 END AS oil,
    CASE WHEN (la OR mt) AND gas24 IS NULL THEN tg WHEN oil24 IS NOT NULL AND gas24 IS NULL THEN 0 ELSE gas24 END AS gas,
    CASE WHEN (la OR mt) AND water24 IS NULL THEN l_tax
         WHEN water24 IS NULL AND oil24 IS NOT NULL AND gas24 IS NOT NULL THEN 0 ELSE water24 END AS water,
    CASE WHEN choke LIKE '0.0%' THEN NULL ELSE choke END AS choke, NULL AS fm, casing, tubing,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'FLOWING' END AS pm,
    CASE WHEN pump = 'unknown' THEN NULL ELSE upper(pump) END AS pump, l_extendedprice AS toil, l_tax AS twater
  FROM (SELECT *, upper(rtrim(state)) = 'LOUISIANA' AS la,
               upper(rtrim(state)) IN ('MONTANA', 'TEXAS') AND dur LIKE '24%' AS mt FROM hd JOIN ip ON ipid = cid) x
  WHERE upper(rtrim(state)) IN ('LOUISIANA', 'MONTANA', 'NEW MEXICO', 'NORTH DAKOTA', 'TEXAS', 'WYOMING') AND ipid <> '-1'),
b AS (
  SELECT DISTINCT API10 AS API, cid, purpose, state, cdate, ip.tdate, ip.dur, ip.grav, ip.tg, ip.oil24, ip.gas24,
    ip.water24, ip.choke, pt.l_returnflag AS fm, ip.casing, ip.tubing,
    CASE WHEN ip.l_returnflag = 'N' THEN NULL ELSE 'FLOWING' END AS pm,
    CASE WHEN ip.pump = 'unknown' THEN NULL ELSE upper(ip.pump) END AS pump, ip.l_extendedprice AS toil, ip.l_tax AS twater
  FROM hd JOIN ip ON ip.ipid = cid JOIN pt ON pt.ipid = ip.ipid AND coalesce(ip.gas24, 0) = pgas
    AND coalesce(ip.oil24, 0) = poil AND coalesce(ip.water24, 0) = coalesce(pt.water24, 0)
    AND upper(rtrim(coalesce(ip.choke, '0'))) = upper(pchoke) AND coalesce(ip.grav, 0) = coalesce(pt.grav, 0)
    AND coalesce(ip.casing, 0) = coalesce(pt.casing, 0) AND ip.tubing = pt.tubing AND ip.tdate = pt.tdate
  WHERE upper(rtrim(state)) = 'OKLAHOMA'),
s AS (SELECT * FROM a UNION ALL SELECT * FROM b),
gm AS (SELECT CAST(l_orderkey // 2 AS VARCHAR) AS API, CAST(l_orderkey AS VARCHAR) AS cid,
              CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS run, l_extendedprice AS vol
       FROM lineitem WHERE l_returnflag = 'R'),
ft AS (SELECT CAST(l_orderkey // 2 AS VARCHAR) AS API, CAST(l_orderkey AS VARCHAR) AS cid,
              CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS run, 'T' || CAST(l_linenumber AS VARCHAR) AS ttime,
              l_quantity AS temp, l_tax AS tdepth,
              substr('choke size of the field test run, line ' || CAST(l_linenumber AS VARCHAR), 1, 34) AS choke,
              l_discount AS dry, l_quantity + 0.5 AS liquid
       FROM lineitem WHERE l_returnflag = 'A'),
gk AS (SELECT API, cid FROM gm EXCEPT SELECT API, cid FROM ft),
fk AS (SELECT API, cid FROM ft EXCEPT SELECT API, cid FROM gm),
d AS (
  SELECT API10 AS API, hd.cid, form, temp, tdepth, choke, dry, liquid, vol, ttime, ft.run AS frun, gm.run AS grun
  FROM hd JOIN gm ON gm.cid = hd.cid AND gm.run = 1 JOIN ft ON ft.cid = hd.cid AND ft.run = 1
  WHERE upper(rtrim(state)) = 'TEXAS' AND hd.cid <> '-1'
  UNION ALL
  SELECT gk.API, gk.cid, form, NULL, NULL, NULL, NULL, NULL, vol, NULL, NULL, gm.run
  FROM gk JOIN hd ON hd.API10 = gk.API AND hd.cid = gk.cid JOIN gm ON gm.API = gk.API AND gm.cid = gk.cid AND gm.run = 1
  UNION ALL
  SELECT fk.API, fk.cid, form, temp, tdepth, choke, dry, liquid, NULL, ttime, ft.run, NULL
  FROM fk JOIN hd ON hd.API10 = fk.API AND hd.cid = fk.cid JOIN ft ON ft.API = fk.API AND ft.cid = fk.cid AND ft.run = 1),
j AS (
  SELECT s.*, d.form, d.temp, d.tdepth, d.choke AS dchoke, d.dry, d.liquid, d.vol, d.ttime, d.frun, d.grun,
         e.api AS hapi, e.play, e.lat, e.lon, e.minDate, e.operator, e.fpd
  FROM s LEFT JOIN d ON d.API = s.API AND d.cid = s.cid LEFT JOIN eh e ON e.api = s.API
  WHERE form IS NOT NULL OR gas IS NOT NULL OR oil IS NOT NULL OR water IS NOT NULL OR grav IS NOT NULL OR fm IS NOT NULL
     OR temp IS NOT NULL OR tdepth IS NOT NULL OR d.choke IS NOT NULL OR dry IS NOT NULL OR liquid IS NOT NULL
     OR ttime IS NOT NULL OR frun IS NOT NULL OR grun IS NOT NULL)
SELECT API AS api, cid AS "completionId", play, lat AS latitude, lon AS longitude, minDate AS "firstProductionDate",
  operator AS "currentOperator", cdate AS "completionDate", purpose AS "filingPurpose",
  CASE WHEN tdate <= TIMESTAMP '1951-01-01' THEN NULL ELSE tdate END AS "testDate", state, fm AS "testFormation",
  coalesce(gas, vol) AS "24HourGas", oil AS "24HourOil", water AS "24HourWater",
  CASE WHEN gas > 0 AND oil > 0 THEN gas / oil END AS "24HourGasOilRatio",
  CASE WHEN water > 0 AND oil > 0 THEN water / oil END AS "24HourWaterOilRatio",
  coalesce(CAST(trunc(grav) AS BIGINT), CAST(trunc(liquid) AS BIGINT)) AS "oilGravity", casing AS "casingPressure",
  tubing AS "flowingTubePressue", pm AS "producingMethod",
  CASE WHEN upper(rtrim(pump)) = 'N/A' THEN NULL ELSE pump END AS "pumpType", temp AS "bottomHoleTemp",
  tdepth AS "bottomHoleTempDepth", coalesce(choke, dchoke) AS "chokeSize", dry AS "dryGasGravity", ttime AS "timeOfRun",
  frun AS "runNumberFT", grun AS "runNUmberGM",
  DENSE_RANK() OVER (PARTITION BY hapi ORDER BY fpd DESC NULLS LAST, cdate DESC NULLS LAST, tdate DESC NULLS LAST) AS "dateRank"
FROM j
""")
def well_test_job(spark, sf):
    cmp_header, esp_header = _job_headers(spark, sf)
    ip, ok_test, gm, ft = _test_inputs(spark, sf)
    return well_test.build(cmp_header, ip, ok_test, gm, ft, esp_header)[1]


def _test_inputs(spark, sf):
    """Initial tests, Oklahoma production tests, gas measurements and field tests."""
    li, col = _t(spark, sf, "lineitem"), F.col
    line, flag, status = col("l_linenumber"), col("l_returnflag"), col("l_linestatus")
    key, run = col("l_orderkey").cast("string"), F.when(col("l_linestatus") == "F", 1).otherwise(2).alias("RunNumber")
    ip = li.select(
        F.when(line == 7, "-1").otherwise(key).alias("completion_dr_id"), col("l_shipdate").alias("testDate"),
        F.when(status == "O", "24 HRS").otherwise("12").alias("Duration"),
        F.when(line == 4, None).otherwise(col("l_quantity") + 0.75).alias("OilGravity"),
        col("l_extendedprice").alias("TestOil"), (col("l_quantity") * 10).alias("TestGas"), col("l_tax").alias("TestWater"),
        F.when(flag == "R", None).otherwise(col("l_extendedprice")).alias("24HourOil"),
        F.when(line % 2 == 0, None).otherwise(col("l_quantity")).alias("24HourGas"),
        F.when(flag == "A", None).otherwise(col("l_discount")).alias("24HourWater"),
        F.when(flag == "A", None).when(line == 3, "0.0/64")
        .otherwise(F.concat(F.lit("c"), line.cast("string"))).alias("ChokeSize"),
        F.when(col("l_discount") > 0.03, col("l_discount")).alias("CasingPressure"),
        col("l_tax").alias("TestFlowingTubePressure"),
        F.when(flag == "N", "Unknown ").otherwise("flowing").alias("ProducingMethod"),
        F.when(status == "O", "N/A ").when(line == 1, "unknown").otherwise("Rod").alias("SizeAndTypeOfPump"),
        flag.alias("__flag"), line.alias("__line"))
    zero = F.lit(0.0)
    # The same tests as a second agency reports them: 0 for no rate, other case, one line's oil differs.
    ok_test = ip.where(col("completion_dr_id") != "-1").select(
        col("completion_dr_id").alias("completionID"), col("testDate").alias("TestDate"),
        col("__flag").alias("TestFormation"),
        (F.coalesce(col("24HourOil"), zero) + F.when(col("__line") == 5, 1.0).otherwise(0.0)).alias("24HourOil"),
        F.coalesce(col("24HourGas"), zero).alias("24HourGas"), col("24HourWater"),
        F.concat(F.upper(F.coalesce(col("ChokeSize"), F.lit("0"))), F.lit(" ")).alias("ChokeSize"), "OilGravity",
        "CasingPressure", "TestFlowingTubePressure")
    gm = li.where(flag == "R").select(_well("l_orderkey").alias("API"), key.alias("CompletionID"), run,
                                      col("l_extendedprice").alias("volumePerDay"))
    ft = li.where(flag == "A").select(
        _well("l_orderkey").alias("API"), key.alias("CompletionID"), run,
        F.concat(F.lit("T"), line.cast("string")).alias("TimeOfRun"), col("l_quantity").alias("BottomHoleTemp"),
        col("l_tax").alias("BottomHoleTempDepth"),
        F.concat(F.lit("choke size of the field test run, line "), line.cast("string")).alias("RunChokeSize"),
        col("l_discount").alias("GravityDryGas"), (col("l_quantity") + 0.5).alias("GravityLiquidHydrocarbon"))
    return ip.drop("__flag", "__line"), ok_test, gm, ft


# --------------------------------------------------------------------------
# The batch from end to end: the role-mapped inputs are written as the raw and
# published tables, the four jobs run on typed scans of them, the mart is read
# --------------------------------------------------------------------------

_BATCH_HEADER_SQL = """
  SELECT CASE WHEN o_orderkey % 10 = 7 THEN NULL ELSE CAST(o_orderkey // 2 AS VARCHAR) END AS api, o_orderkey AS hpdiEntityId,
         c_mktsegment AS play, c_name AS operator, c_acctbal AS lat, c_acctbal / 2 AS lon, o_totalprice AS tvd,
         n_nationkey AS stages, lower(c_mktsegment) AS alias,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 45 DAY END AS firstProductionDate,
         o_orderdate AS completionDate, n_name AS state, o_totalprice AS totalDepth, lower(c_mktsegment) AS playArea,
         CASE WHEN c_acctbal > 0 THEN c_acctbal END AS proppantLbs, CASE WHEN c_acctbal > 5000 THEN c_acctbal END AS treatmentBbls
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""

_BATCH_MART_HEADER_SQL = _MART_HEADER_SQL
for _name, _sql in (("reservoirAlias", "h.alias"), ("upperPerforation", "h.lat"), ("lowerPerforation", "h.lon"), ("tvd", "h.tvd"),
                    ("latitude27", "h.lat"), ("longitude27", "h.lon"), ("stages", "CAST(h.stages AS INTEGER)")):
    for _kind in ("VARCHAR", "DOUBLE", "INTEGER"):
        _BATCH_MART_HEADER_SQL = _BATCH_MART_HEADER_SQL.replace(f'CAST(NULL AS {_kind}) AS "{_name}"', f'{_sql} AS "{_name}"')
_BATCH_PIPING_SQL = _piping_sql(
    f"ch AS (SELECT API10 AS API, cid, purpose, state FROM ({_JOB_HEADER_SQL}) hd)",
    f"eh AS (SELECT api, play, lat, lon, operator, completionDate AS cd, firstProductionDate AS fpd FROM ({_BATCH_HEADER_SQL}) b)")


@register("batch_mart", _mart_sql(f"""hdr AS ({_BATCH_HEADER_SQL}),
frac AS ({ORACLE['frac_detail_job']}),
piping AS ({_BATCH_PIPING_SQL}),
wt AS ({ORACLE['well_test_job']})""", _BATCH_MART_HEADER_SQL))
def batch_mart(spark, sf):
    ff, cmp_header, fd, esp_header = _frac_inputs(spark, sf)
    ip, ok_test, gm, ft = _test_inputs(spark, sf)
    col = F.col
    wells = (_t(spark, sf, "orders").join(_keyed(spark, sf, "customer"), col("c_custkey") == col("o_custkey"))
             .join(_t(spark, sf, "nation"), col("n_nationkey") == col("c_nationkey")))
    header = wells.select(
        F.when(col("o_orderkey") % 10 == 7, None).otherwise(_well("o_orderkey")).alias("api"), col("o_orderkey").alias("hpdiEntityId"),
        col("c_mktsegment").alias("play"), col("c_name").alias("operator"), col("c_acctbal").alias("latitude27"),
        (col("c_acctbal") / 2).alias("longitude27"), col("c_acctbal").alias("upperPerforation"),
        (col("c_acctbal") / 2).alias("lowerPerforation"), col("o_totalprice").alias("tvd"), col("n_nationkey").alias("stages"),
        F.lower("c_mktsegment").alias("reservoirAlias"),
        F.when(col("o_orderpriority") == "5-LOW", None).otherwise(_days(45, "o_orderdate")).alias("firstProductionDate"),
        col("o_orderdate").alias("completionDate"), col("n_name").alias("state"), col("o_totalprice").alias("totalDepth"),
        F.lower("c_mktsegment").alias("playArea"), F.when(col("c_acctbal") > 0, col("c_acctbal")).alias("proppantLbs"),
        F.when(col("c_acctbal") > 5000, col("c_acctbal")).alias("treatmentBbls"))
    ensure_checkpoint_dir(spark)
    base = f"{checkpoint_root(ff)}/wellmart/batch-{uuid.uuid4().hex}"
    tables = {"cmpHeader": cmp_header, "cmpASvFactJobDetailDenormalized": ff, "cmpFracDetail_New": fd, "cmpPipe": _pipes(spark, sf),
              "cmpInitialPotentialTest": ip, "cmpOKProductionTest": ok_test, "cmpGasMeasurementTest": gm, "cmpFieldTest": ft,
              "espHeader": header}
    for name, df in tables.items():
        have = {c.lower(): c for c in df.columns}
        # The whole declared layout: columns that the benchmark tables do not have are typed NULLs.
        publish(df.select(*[(col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in schema(name)]), f"{base}/{'live' if name == 'espHeader' else 'raw'}/{name}")
    written = batch.run(spark, Catalog(raw=f"{base}/raw", live=f"{base}/live", stage=f"{base}/stage"))
    return spark.read.parquet(written["header_mart"])
