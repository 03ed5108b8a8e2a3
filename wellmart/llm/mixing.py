"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: every source gets its weight's share of all words, at most
   ``max_repeats`` times its own; what a full source leaves over goes to the
   others by weight (``targets``). One row a source, the size of the weight
   table a user would write.
2. Blocks: a source's rows are dealt by a seeded hash to blocks of about
   ``block_rows`` rows, ``max_blocks`` at most, so even a source with a third
   of all rows is counted by a pre-aggregated sum over its blocks.
3. Draws: whole passes over a source take every block; what remains to the
   target is taken from a last pass in permuted block order, the block at the
   border row by row (``nearest``). A row is taken whole or not.
4. Shards: the block draws of all sources are split among the output shards by
   a binary tree. At each node the children's totals are fixed, and the
   sources' counts of the left child are one multivariate-hypergeometric draw
   (seeded by the node), so every draw lands in exactly one shard and each
   shard has the mix of a random sample. The shards take disjoint ranges of
   each source's permuted blocks and order their rows by a seeded hash
   (``place``); ``mixed_rows`` and ``write_mix`` write them so.
"""

from __future__ import annotations

import math

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import shared_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SHARDS = 16
SEED = 17
BLOCK_ROWS = 256
MAX_BLOCKS = 4096
#: Block draws of all sources together; the hypergeometric draws are exact below 10 ** 9.
MAX_DRAWS = 900_000_000
#: Up to so many sources the plan's tables (one row a source) are broadcast, beyond they are joined by shuffle.
BROADCAST_SOURCES = 100_000
#: A task orders about so much of a shard at once.
SLICE_BYTES = 256 << 20


def targets(sizes: list[int], weights: list[float], max_repeats: int = MAX_REPEATS) -> list[float]:
    """Each source's words: by weight, never over ``max_repeats`` times its size; excess shared again by weight."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > max_repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(max_repeats * sizes[i])
            open_.discard(i)
        left = float(sum(sizes)) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def split_counts(counts: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Counts per shard and source: columns sum to ``counts``, rows differ by one at most."""
    out = np.zeros((shards, len(counts)), np.int64)

    def node(held: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            out[first] = held
            return
        near = n // 2
        total = int(held.sum())
        sizes = [total * (s + 1) // n - total * s // n for s in range(n)]
        rng = np.random.default_rng([seed, first, n])
        # Marginal draws are exact below MAX_DRAWS, which bounds the blocks of a source in ``plan``.
        left = rng.multivariate_hypergeometric(held, sum(sizes[:near]), method="marginals") if total else held
        node(left, first, near)
        node(held - left, first + near, n - near)

    node(np.asarray(counts, np.int64), 0, shards)
    return out


def nearest(sizes: list[int], lack: float, tail: int = 200) -> list[bool]:
    """Which rows to take, in order, so that their sizes sum to nearly ``lack``.

    All but the last ``tail`` rows are taken as long as the tail can still make
    up about half its sum; the tail's choice is the subset sum nearest to what
    is left (a bit set of reachable sums, in units of ``lack / 2 ** 16``).
    """
    cut = max(0, len(sizes) - tail)
    reserve, chosen = sum(sizes[cut:]) / 2, [False] * len(sizes)
    for i in range(cut):
        if sizes[i] <= lack - reserve:
            chosen[i] = True
            lack -= sizes[i]
    unit = max(1, int(lack) >> 16)
    want, reach = max(0, round(lack / unit)), [1]
    mask = (1 << (2 * want + 2)) - 1
    for n in sizes[cut:]:
        reach.append((reach[-1] | reach[-1] << round(n / unit)) & mask if n <= 2 * lack else reach[-1])
    low = (reach[-1] & ((1 << (want + 1)) - 1)).bit_length() - 1
    over = reach[-1] >> (want + 1)
    above = want + 1 + (over & -over).bit_length() - 1 if over else None
    at = above if above is not None and above - want < want - low else low
    for k in range(len(sizes) - cut, 0, -1):
        if not reach[k - 1] >> at & 1:
            chosen[cut + k - 1] = True
            at -= round(sizes[cut + k - 1] / unit)
    return chosen


def _key(source):
    """Null apart from every string; ordered by code point, null last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("="), source))


def _hash(seed: int, salt: int, *cols):
    return F.xxhash64(F.lit(seed), F.lit(salt), *cols)


_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_counts(column: pa.Array) -> np.ndarray:
    """Words of every text, counted in the column's bytes: a word starts where a blank or the text's start precedes it."""
    col = column.cast(pa.binary())
    off = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, 4 * col.offset) if len(col) else np.zeros(1, np.int32)
    out = np.zeros(len(col), np.int64)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        blank = _BLANK[np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]]
        starts = ~blank
        starts[1:] &= blank[:-1]
        first = off[:-1][full] - off[0]
        starts[first] = ~blank[first]
        out[full] = np.add.reduceat(starts, first, dtype=np.int64)
    return out


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, columns: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its ``columns``), source key ``_s``, row hash ``_k`` of id and text, ``size``, ``bytes`` of the text."""
    row = F.struct(*(columns or ["*"])).alias("row")
    source = docs.select(row, _key(F.col(source_col)).alias("_s"), _hash(seed, 1, F.col(id_col), F.col(text_col)).alias("_k"),
                         F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, ("row", "_s", "_k")), pa.array(word_counts(text)), pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())],
                names=["row", "_s", "_k", "size", "bytes"])

    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, _s string, _k long, size long, bytes long")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, max_repeats: int = MAX_REPEATS, shards: int = SHARDS, seed: int = SEED,
         block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS, columns: list[str] | None = None) -> DataFrame:
    """Per row: ``row`` (the input row, or its ``columns``, as a struct), ``size, source_size, target, taken, draws``.

    The texts are read twice: once to write sizes and hashes, from which all is
    planned, and once with the result.

    ``draws`` has one (pass, shard, place) per time the row is taken, ``place``
    being its seeded order inside the shard; ``taken`` is the
    row's size times their number, never over ``max_repeats`` times. A
    source's taken words miss its target by what the rows of one block cannot
    make up between them: mostly nothing, at worst half their smallest. A null text has size 0 and a null source is a source of its
    own. Rows of equal id and text are taken together. The metadata of column
    ``draws`` has the mix's ``bytes``. An empty table gives an
    empty plan; a source without words has target 0 and no draws.
    """
    spark = docs.sparkSession
    whole_rows = measured(docs, id_col, text_col, source_col, seed, columns)
    rows = shared_table(whole_rows.select("_s", "_k", "size", "bytes"), "mix-sizes")
    sizes = rows.groupBy("_s").agg(F.sum("size").alias("words"), F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).collect()
    table = pd.DataFrame([tuple(r) for r in sizes], columns=["_s", "words", "rows", "bytes"])
    # Code point order of Python strings; "=..." sorts before "n", the null source.
    table = table.sort_values("_s", ignore_index=True)
    table["words"] = table["words"].astype("int64")
    table["target"] = targets(table["words"].tolist(), [float(weights[i % len(weights)]) for i in range(len(table))], max_repeats)
    table["passes"] = [min(max_repeats, int(t // s)) if s else 0 for t, s in zip(table["target"], table["words"])]
    table["rest"] = [max(0.0, t - p * s) if s else 0.0 for t, p, s in zip(table["target"], table["passes"], table["words"])]
    most = max(1, min(max_blocks, MAX_DRAWS // ((max_repeats + 1) * max(1, len(table)))))
    table["blocks"] = [max(1, min(most, math.ceil(n / block_rows))) for n in table["rows"]]
    mix_bytes = sum(int(b * t / s) if s else 0 for b, t, s in zip(table["bytes"], table["target"], table["words"]))
    small = spark.createDataFrame(
        [tuple(r) for r in table[["_s", "words", "target", "passes", "rest", "blocks"]].itertuples(index=False)],
        "_s string, source_size long, target double, passes int, rest double, blocks int")

    bounded = F.broadcast if len(table) <= BROADCAST_SOURCES else (lambda t: t)
    known = bounded(small)
    block = F.pmod(F.col("_k"), F.col("blocks")).cast("int")
    rows = rows.join(known, "_s").withColumn("block", block)

    # Blocks of the last pass in permuted order, with the words before each: at most max_blocks rows a source.
    blocks = rows.where("rest > 0").groupBy("_s", "block", "rest").agg(F.sum("size").alias("words"))
    order = W.partitionBy("_s").orderBy(_hash(seed, 2, "_s", "block"), "block")
    blocks = blocks.withColumn("upto", F.sum("words").over(order.rowsBetween(W.unboundedPreceding, 0)))
    blocks = blocks.withColumn("lack", F.col("rest") - (F.col("upto") - F.col("words")))
    last = blocks.where("lack > 0").select("_s", "block", (F.col("words") <= F.col("lack")).alias("whole"), "lack")

    # The border block, row by row in hashed order: whatever still fits is taken.
    border = last.where("NOT whole").select("_s", "block", "lack")
    inside = rows.select("_s", "block", "_k", "size").join(border, ["_s", "block"]).groupBy("_s", "block", "lack", "_k").agg(
        F.sum("size").alias("words"))
    inside = inside.withColumn("_o", _hash(seed, 3, "_k"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_o", "_k"])
        chosen = nearest(pdf["words"].tolist(), float(pdf["lack"].iloc[0]))
        return pdf.loc[chosen, ["_s", "_k"]]

    fits = inside.groupBy("_s", "block").applyInPandas(fill, "_s string, _k long")
    fits = fits.select(F.col("_s").alias("f_s"), F.col("_k").alias("f_k"))

    # Block draws per source, split among the shards.
    taken = {r[0]: r[1] for r in last.groupBy("_s").count().collect()}
    counts = np.array([p * b + taken.get(s, 0) for s, p, b in zip(table["_s"], table["passes"], table["blocks"])], np.int64)
    ends = np.cumsum(split_counts(counts, shards, seed), axis=0)
    quota = spark.createDataFrame([(s, ends[:, i].tolist()) for i, s in enumerate(table["_s"])], "_s string, ends array<long>")

    # A source's draws: pass by pass, each in its own permuted block order; the shard follows from the rank.
    full = small.where("passes > 0").select("_s", "blocks", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("pass"))
    full = full.select("_s", "pass", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("whole"))
    extra = last.select("_s", F.lit(max_repeats).alias("pass"), "block", "whole")
    draws = full.unionByName(extra)
    rank = W.partitionBy("_s").orderBy("pass", _hash(seed, 4, "_s", "pass", "block"), "block")
    draws = draws.withColumn("rank", F.row_number().over(rank) - 1).join(bounded(quota), "_s")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank")))
    per_block = draws.groupBy("_s", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", shard.alias("shard"), "whole"))).alias("all"))  # max_repeats + 1 at most

    out = whole_rows.join(known, "_s").withColumn("block", block).join(per_block, ["_s", "block"], "left").join(
        fits, (F.col("_s") == F.col("f_s")) & (F.col("_k") == F.col("f_k")), "left")
    drawn = F.filter(F.coalesce("all", F.array().cast("array<struct<pass:int,shard:int,whole:boolean>>")),
                     lambda d: d["whole"] | F.col("f_s").isNotNull())
    drawn = F.transform(drawn, lambda d: F.struct(
        d["pass"].alias("pass"), d["shard"].alias("shard"),
        F.shiftrightunsigned(_hash(seed, 5, "_s", "_k", d["pass"]), 1).alias("place")))
    return out.select("row", "size", "source_size", "target", drawn.alias("draws")).select(
        "row", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"),
        F.col("draws").alias("draws", metadata={"bytes": mix_bytes}))


def _by_shard(planned: DataFrame, shards: int) -> DataFrame:
    """``shard, row`` per draw, every shard in slices of its seeded order: one slice a task, slices and rows in order."""
    tasks = int(planned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, math.ceil(tasks / shards), math.ceil(planned.schema["draws"].metadata["bytes"] / shards / SLICE_BYTES))
    out = planned.select("row", F.explode("draws").alias("d")).select("row", "d.shard", "d.place")
    at = F.col("shard") * slices + F.shiftright(F.shiftright("place", 32) * slices, 31)  # places are even in 63 bits
    return out.repartitionById(shards * slices, at.cast("int")).sortWithinPartitions("shard", "place").select("shard", "row")


def mixed_rows(planned: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mix itself: the input's columns, a row as often as it is drawn, shard by shard in the seeded order."""
    return _by_shard(planned, shards).select("row.*")


def write_mix(planned: DataFrame, path: str, shards: int = SHARDS) -> None:
    """One folder a shard; inside each file the rows of all sources stand in a seeded random order."""
    _by_shard(planned, shards).write.partitionBy("shard").parquet(path)


def mix_digest(docs: DataFrame, **settings) -> DataFrame:
    """Per row its sizes and words taken, and the shard and the place in it of each of its draws."""
    return plan(docs.select("doc_id", "text", "source"), columns=["doc_id"], **settings).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken",
        F.col("draws.shard").alias("shards"), F.col("draws.place").alias("places"))
