"""Shuffling rows into shards in two passes, in native expressions only.

Pass 1 scatters the rows by a seeded hash into buckets of about
``bucket_bytes``. Pass 2 orders each bucket by a Fisher-Yates permutation:
Spark's seeded ``shuffle`` draws one of the bucket's row numbers, each row
reads its new place from it. Buckets follow one another, so a row's place in
the whole is its bucket's offset plus its place inside; shard s takes the
places from ceil(s n / shards) on. Shards differ by one row at most (law
``rows``), and slots have no gaps.

A bucket is a hash of id and content, so no source, key or group of copies can
swell one. Rows equal in every column could: where a bucket is far over its
size, its rows are counted, and a row that fills a bucket by itself stands
once, with its count, and is dealt out again by the number of the copy.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import shared_table

SHARDS = 16
SEED = 29
BUCKET_BYTES = 8 << 20
#: Small inputs are scattered over so many buckets at least, so that their rows spread over tasks too.
MIN_BUCKETS = 256
#: A task takes several small buckets, up to about so much.
TASK_BYTES = 1 << 20
#: A bucket of over so many times its size is looked through for repeated rows.
HEAVY = 4
#: Buckets whose offsets one task adds up.
RANGE = 4096


def row_bytes(text):
    """UTF-8 bytes of the text (null: none) plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: ``row`` (the input row as a struct), ``size, text_crc32, shard, slot``.

    Every row, repeated ones too, has a place of its own. Null and empty texts
    have size 1; a null id hashes as null. An empty table gives no rows. The
    result depends on rows, seed and settings, not on the input's files;
    equal rows are interchangeable.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("_i"), row_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("_h"))
    total = docs.agg(F.sum(row_bytes(F.col(text_col)))).first()[0] or 0
    parts = max(1, min(math.ceil(total / max(bucket_bytes, TASK_BYTES)), 20000))
    buckets = max(MIN_BUCKETS, math.ceil(total / bucket_bytes))
    bucket = F.pmod(F.col("_h"), F.lit(buckets)).cast("int").alias("bucket")

    def count(table: DataFrame):
        found = shared_table(table.groupBy(bucket).agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "shard-buckets")
        heavy = F.col("bytes") > HEAVY * bucket_bytes
        return found, heavy, found.agg(F.sum("n").alias("n"), F.count_if(heavy).alias("heavy")).first()

    counts, heavy, sums = count(rows)
    if sums["heavy"]:
        rows = deal_repeated(rows, counts.where(heavy).select("bucket"), bucket, seed, bucket_bytes, parts)
        counts, _, sums = count(rows)
    n = sums["n"] or 0

    # Permutations: a bucket's row numbers in one row, partitioned as the rows are.
    order = bucket_offsets(counts).repartition(parts, "bucket").sortWithinPartitions("bucket").select(
        "bucket", "offset", F.shuffle(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), seed).alias("perm"))

    scattered = rows.select("*", bucket).repartition(parts, "bucket")
    inside = W.partitionBy("bucket").orderBy("_h", "_i", "text_crc32", "size")
    numbered = scattered.withColumn("_r", F.row_number().over(inside))
    placed = numbered.join(order.hint("merge"), "bucket").withColumn("_g", F.col("offset") + F.element_at("perm", F.col("_r")))
    at = F.expr(f"(_g * {shards}) div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", at.cast("int")).select(
        "row", "size", "text_crc32", "shard", (F.col("_g") - first).cast("long").alias("slot"))


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """``bucket, offset, n``: the rows in smaller buckets, added up inside ranges of buckets and over the ranges."""
    ranged = counts.select("bucket", "n", F.expr(f"bucket div {RANGE}").alias("range"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per RANGE buckets
    ranges = ranged.groupBy("range").agg(F.sum("n").alias("rows")).select(
        "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("range").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    return ranged.withColumn("upto", F.sum("n").over(inside)).join(ranges, "range").select(
        "bucket", (F.col("start") + F.col("upto") - F.col("n")).alias("offset"), "n")


def deal_repeated(rows: DataFrame, heavy: DataFrame, bucket, seed: int, bucket_bytes: int, parts: int) -> DataFrame:
    """``rows`` with the copies of each row that fills a bucket by itself hashed by their number as well.

    Rows are equal if 128 hash bits of all their columns are. Such a row is
    taken once and repeated to its count, first by pieces of a bucket's size, so
    no task holds all copies and a lost task makes the same ones again.
    """
    content = F.to_json(F.col("row"), {"ignoreNullFields": "false"})
    keyed = rows.select("*", bucket, F.xxhash64(F.lit(seed), content).alias("_a"), F.xxhash64(F.lit(~seed), content).alias("_b"))
    found = shared_table(
        keyed.join(heavy, "bucket", "left_semi").groupBy("_a", "_b").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        .where((F.col("bytes") > bucket_bytes) & (F.col("n") > 1)), "shard-repeated")
    rest = keyed.join(found, ["_a", "_b"], "left_anti").select(*rows.columns)
    once = keyed.join(found, ["_a", "_b"], "left_semi").groupBy("_a", "_b").agg(
        *[F.first(c).alias(c) for c in rows.columns if c != "_h"])
    piece = F.greatest(F.lit(1).cast("long"), F.expr(f"{bucket_bytes} div size"))
    pieces = once.join(found.select("_a", "_b", "n"), ["_a", "_b"]).withColumn("_k", piece).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div _k"))).alias("_p"))
    copies = pieces.repartition(parts, "_a", "_b", "_p").select(
        "*", F.explode(F.sequence(F.expr("_p * _k"), F.least(F.expr("(_p + 1) * _k"), F.col("n")) - 1)).alias("_c"))
    return rest.union(copies.withColumn("_h", F.xxhash64(F.lit(seed), "_a", "_b", "_c")).select(*rows.columns))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder a shard, rows by slot inside each file. A bucket falls into two shards at most, so nothing moves again."""
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def sharded_rows(docs: DataFrame, **settings) -> DataFrame:
    """The input's columns with ``shard`` and ``slot`` (a clashing input column is replaced)."""
    out = shard(docs, **settings)
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], "shard", "slot")


def shard_digest(docs: DataFrame, **settings) -> DataFrame:
    return shard(docs.select("doc_id", "text"), **settings).select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
