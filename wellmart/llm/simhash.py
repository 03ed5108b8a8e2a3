"""SimHash near-duplicates through vantage-point trees.

1. Every text gets a 64-bit fingerprint (``fingerprints``).
2. Equal fingerprints are one node, so copies cost nothing further.
3. The 64 bits are cut into ``segments`` masks. Two fingerprints that differ in
   at most r bits differ in at most ``r // segments`` bits of some mask. Each
   mask has its own vantage-point tree: an inner tree node holds a vantage
   point v and a radius mu, and a fingerprint x lives on the near side if its
   masked Hamming distance d(v, x) is at most mu. By the triangle inequality a
   query of radius q has to visit the near side only if d - q <= mu and the far
   side only if d + q > mu; all other branches are pruned.
4. A leaf is a shard: it gets the fingerprints that live there and those whose
   query ball overlaps it, compares the whole 64 bits, and emits a spanning
   forest of its exact links.
5. ``components`` joins the forests.

Only the *shape* of the trees comes from a sample (``sample`` fingerprints);
every fingerprint is stored in them and queries them. A leaf with more than
``block`` members is dealt out as blocks of (members x queries).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, shared_table, texts
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text; 0 for a text without words (or null)."""
    words = data.translate(LOWER).split() if data else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), SEED)  # one shingle: over half of one hash is the hash itself
    total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    grams = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle))))
    for _ in range(0, total, 1 << 16):  # bounded memory for very long texts
        h = np.array([digest(g, SEED) for g in islice(grams, 1 << 16)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in texts(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """A complete binary tree of ``levels`` levels over the bits of ``mask``; node i has children 2i+1 (near) and 2i+2."""

    def __init__(self, sample: np.ndarray, mask: int, levels: int, seed: int = 7):
        self.mask, self.levels, self.base = np.uint64(mask), levels, (1 << levels) - 1
        rng = np.random.default_rng(seed)
        self.point = rng.integers(0, 1 << 63, self.base, dtype=np.uint64) * np.uint64(2) & self.mask
        self.radius = np.full(self.base, int(mask).bit_count() // 2, np.int64)
        held = {0: sample & self.mask}
        for node in range(self.base):
            own = held.pop(node, np.zeros(0, np.uint64))
            if len(own) >= 8:  # a vantage point of the sample, the one whose distances are spread most
                tried = own[rng.integers(0, len(own), 8)]
                spread = [distance(own, p).var() for p in tried]
                self.point[node] = tried[int(np.argmax(spread))]
                d = distance(own, self.point[node]).astype(np.int64)
                cuts = np.unique(d)
                near = np.searchsorted(np.sort(d), cuts, "right")
                self.radius[node] = cuts[int(np.argmin(np.abs(near - len(d) / 2)))]
            if 2 * node + 2 < self.base:
                near = distance(own, self.point[node]).astype(np.int64) <= self.radius[node]
                held[2 * node + 1], held[2 * node + 2] = own[near], own[~near]

    def route(self, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaves that each fingerprint's ball overlaps: index into ``fp``, leaf, whether it lives there."""
        row, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
        x = fp & self.mask
        for _ in range(self.levels):
            d, mu = distance(x[row], self.point[node]).astype(np.int64), self.radius[node]
            near, far, inside = d - radius <= mu, d + radius > mu, d <= mu
            row = np.concatenate([row[near], row[far]])
            home = np.concatenate([(home & inside)[near], (home & ~inside)[far]])
            node = np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        return row, node - self.base, home


def masks(segments: int) -> list[int]:
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def forest(homes: np.ndarray, queries: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Index pairs (into homes + queries) that join all that is linked within ``max_bits``: fewer pairs than members."""
    parent = list(range(len(homes) + len(queries)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    step = max(1, (1 << 21) // max(1, len(homes)))
    for s in range(0, len(queries), step):
        q = queries[s:s + step]
        linked = distance(q[:, None], homes[None, :]) <= max_bits
        linked &= q[:, None] != homes[None, :]
        i, j = np.nonzero(linked)
        if not len(i):
            continue
        first = linked.argmax(axis=1)[i]  # all homes of a query hang on its first one
        pairs = np.unique(np.concatenate([np.stack([first, j], 1)[first != j],
                                          np.stack([np.unique(i) + s + len(homes), linked.argmax(axis=1)[np.unique(i)]], 1)]), axis=0)
        for a, b in pairs.tolist():
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[ra] = rb
                out.append((a, b))
    return out


def links(nodes: DataFrame, max_bits: int = MAX_BITS, segments: int = 2, leaf: int = 1024,
          sample: int = 16384, max_levels: int = 16, block: int = 8192) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) whose components are those of all links.

    The driver gets ``sample`` fingerprints at most and broadcasts trees of at
    most ``2 ** max_levels`` nodes (16 bytes each) per segment.
    """
    spark = nodes.sparkSession
    n = nodes.count()
    levels = min(max_levels, max(0, math.ceil(math.log2(max(n, 1) / leaf))))
    drawn = np.array([r[0] for r in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()],
                     np.int64).view(np.uint64)
    trees = [VantageTree(drawn, m, levels) for m in masks(segments)]
    held = spark.sparkContext.broadcast(trees)
    radius = max_bits // segments

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k, tree in enumerate(held.value):
                row, shard, home = tree.route(fp, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard * len(held.value) + k), pa.array(home), pa.array(fp[row].view(np.int64))],
                    names=["leaf", "home", "fp"])

    routed = shared_table(nodes.select("fp").mapInArrow(route, "leaf long, home boolean, fp long"), "simhash-routed")
    # One row a leaf, and leaves are at most segments * 2 ** max_levels: a bounded broadcast.
    size = routed.groupBy("leaf").agg(F.count("*").alias("q"), F.sum(F.col("home").cast("long")).alias("h"))
    size = size.where("h > 0").select("leaf", F.ceil(F.col("h") / block).alias("hn"), F.ceil(F.col("q") / (4 * block)).alias("qn"))
    dealt = routed.join(F.broadcast(size), "leaf")
    own_h, own_q = F.pmod(F.xxhash64("fp"), "hn"), F.pmod(F.xxhash64("fp", F.lit(1)), "qn")
    homes = dealt.where("home").select("leaf", own_h.alias("hb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("qn") - 1)).alias("qb"), F.lit(True).alias("home"), "fp")
    asked = dealt.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("hn") - 1)).alias("hb"), own_q.alias("qb"), F.lit(False).alias("home"), "fp")

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        home = pdf["home"].to_numpy(dtype=bool)
        fp = pdf["fp"].to_numpy(dtype=np.int64)
        h, q = fp[home], fp[~home]
        both = np.concatenate([h, q])
        pairs = np.array(forest(h.view(np.uint64), q.view(np.uint64), max_bits), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": both[pairs[:, 0]], "b": both[pairs[:, 1]]})

    return homes.unionByName(asked).groupBy("leaf", "hb", "qb").applyInPandas(shard, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, **tree) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per input row.

    ``component_id`` is the smallest doc_id reachable through links of at most
    ``max_bits`` differing bits. Null, empty and blank texts have fingerprint
    zero and are linked like any other. Repeated rows stay repeated; a null id
    never becomes a component id unless its component has no other. Columns
    besides id and text are ignored, so their names cannot clash.
    """
    fps = shared_table(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    joined = _rooted(fps, max_bits, **tree)
    named = joined.join(joined.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(fps: DataFrame, max_bits: int, **tree) -> DataFrame:
    """``fp, rep, root`` per fingerprint: the smallest ``doc_id`` under it and the component it belongs to."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(links(nodes, max_bits, **tree))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, **tree) -> DataFrame:
    """The input's rows and columns, exactly one row per component: one with the smallest id, null last.

    The choice is by row, not by id: a key of the id and 128 hashed bits of the
    whole row stands for it, so an id with several texts has a row in each of
    their components and null ids take part. Rows that share an id are ordered
    by hash; of rows equal in every column one stays.
    """
    # The text goes first with a null flag: the hash passes over nulls, and rows of different texts must not share a key.
    whole = [F.col(text_col).isNull(), F.col(text_col), F.struct("*").cast("string")]
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                   *(F.xxhash64(F.lit(seed), *whole).alias(f"h{seed}") for seed in (1, 2)))
    rows = docs.select(F.struct("*").alias("row"), key.alias("_key"), F.col(text_col).alias("_text"))
    fps = shared_table(fingerprints(rows, "_key", "_text", shingle), "simhash-fp")
    chosen = _rooted(fps, max_bits, **tree).groupBy("root").agg(F.min("rep").alias("_key")).select("_key")
    # Copies meet in a partial aggregate before the join, so a row repeated very often is no hot join key.
    once = rows.select("_key", "row").dropDuplicates(["_key"])
    return once.join(chosen, "_key").select("row.*")
