"""Benchmark decontamination with an FM-index per training shard.

A shard is a few MB of whole documents. Its words become symbols of the
benchmark's vocabulary; a word outside it can be in no phrase, so only runs of
vocabulary words as long as the shortest phrase are indexed, each closed by a
separator of its own. The index is a Burrows-Wheeler transform in a wavelet
matrix: all phrases are searched backward at once by rank queries, the
occurrences are located by stepping to sampled suffix positions, and their
word spans are merged.

The benchmark is split into blocks of about ``block_words`` words. A pass holds
``PASS_BLOCKS`` of them with one vocabulary, a bounded broadcast, and searches
them one after another in one index per shard. The corpus is read once: more
passes than one follow each other on the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import alnum_words, chunks, index_runs

WINDOW = 13
SAMPLE_STEP = 8
SHARD_BYTES = 8 << 20
BLOCK_WORDS = 1 << 18
PASS_BLOCKS = 16


def suffix_array(symbols: np.ndarray, runs: int) -> np.ndarray:
    """Suffix order by prefix doubling. Symbols below ``runs`` are separators, each occurring once."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, width = len(rank), 1
    order = np.argsort(rank, kind="stable")
    while n:
        second = np.full(n, -1, np.int64)
        second[:max(0, n - width)] = rank[width:]
        key = rank * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == n - 1:
            break
        width *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols of a sequence, one bit level at a time from the highest."""

    def __init__(self, seq: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.depth)):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(seq) - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the position."""
        at, begin = upto.astype(np.int64), np.zeros(len(upto), np.int64)
        for k in range(self.depth):
            one = ((symbol >> (self.depth - 1 - k)) & 1).astype(bool)
            a, b = self.ones[k][at], self.ones[k][begin]
            at = np.where(one, self.zeros[k] + a, at - a)
            begin = np.where(one, self.zeros[k] + b, begin - b)
        return at - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros(len(at), np.int64), at.astype(np.int64)
        for k in range(self.depth):
            a = self.ones[k][at]
            one = self.ones[k][at + 1] > a
            symbol = symbol * 2 + one
            at = np.where(one, self.zeros[k] + a, at - a)
        return symbol


class FMIndex:
    """Over runs of symbols >= 1; ``text`` has a 0 after each run."""

    def __init__(self, text: np.ndarray, alphabet: int, step: int = SAMPLE_STEP):
        ends = np.flatnonzero(text == 0)
        unique = text + len(ends)
        unique[ends] = np.arange(len(ends))
        sa = suffix_array(unique, len(ends))
        self.size = len(text)
        bwt = text[sa - 1]
        self.wavelet = WaveletMatrix(bwt, alphabet)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        # Sampled suffixes: every ``step`` words and each run's first word, before which no step can go.
        sampled = (sa % step == 0) | (bwt == 0)
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.position = sa[sampled]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, given padded on the left so that column -1 is the last word."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        for j in range(phrases.shape[1]):
            live = np.flatnonzero((length > j) & (lo < hi))
            c = phrases[live, phrases.shape[1] - 1 - j]
            both = self.wavelet.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live], hi[live] = self.before[c] + both[:len(live)], self.before[c] + both[len(live):]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out, at, steps = np.empty(len(rows), np.int64), rows.astype(np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            now = at[live]
            found = self.sampled[now + 1] > self.sampled[now]
            out[live[found]] = self.position[self.sampled[now[found]]] + steps[live[found]]
            live, now = live[~found], now[~found]
            c = self.wavelet.access(now)
            at[live] = self.before[c] + self.wavelet.rank(c, now)
            steps[live] += 1
        return out


class Block:
    """The windows of a block of benchmark items: distinct phrases, as places in its words, and the items that have them."""

    def __init__(self, items: list[tuple], ids: dict[bytes, int], first_item: int, window: int):
        self.window = window
        text, starts, seen = [], [], {}
        for k, (_, t) in enumerate(items):
            words = [ids.setdefault(w, len(ids) + 1) for w in alnum_words(t)]
            for s in range(max(1, len(words) - window + 1) if words else 0):
                phrase = tuple(words[s:s + window])
                held = seen.get(phrase)
                if held is None:
                    held = seen[phrase] = []
                    starts.append(len(text) + s)
                if not held or held[-1] != first_item + k:
                    held.append(first_item + k)
            text += words
        self.words, self.start = np.array(text, np.int32), np.array(starts, np.int32)
        self.length = np.array([len(p) for p in seen], np.int32)
        self.owners = np.array([k for held in seen.values() for k in held], np.int32)
        self.owner_count = np.array([len(held) for held in seen.values()], np.int32)

    def padded(self) -> np.ndarray:
        """One row a phrase, zeros on the left, so that column -1 is the last word."""
        back = np.arange(self.window - 1, -1, -1)
        at = self.start[:, None] + self.length[:, None] - 1 - back
        return np.where(back < self.length[:, None], self.words[np.maximum(at, 0)], 0)


class Phrases:
    """Blocks that share a vocabulary; ``items`` are the ids of all their items."""

    def __init__(self, blocks: list[list[tuple]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.items, self.blocks = [], []
        for items in blocks:
            self.blocks.append(Block(items, self.ids, len(self.items), window))
            self.items += [i for i, _ in items]
        self.shortest = min((int(b.length.min(initial=window)) for b in self.blocks), default=window)


def shard_hits(docs: list[bytes | None], phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[list[int]]]:
    """Per document: its number of words, merged spans of hit words, items found (places in ``phrases.items``)."""
    get = phrases.ids.get
    n_words, pieces, owner, offset = [], [], [], []
    for d, t in enumerate(docs):
        words = alnum_words(t)
        n_words.append(len(words))
        ids = np.array([get(w, 0) for w in words], np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ids > 0, [False]]).astype(np.int8))).reshape(-1, 2)
        for a, b in edge[edge[:, 1] - edge[:, 0] >= phrases.shortest].tolist():
            pieces += [ids[a:b], np.zeros(1, np.int64)]
            owner.append(d)
            offset.append(a)
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    items: list[list[int]] = [[] for _ in docs]
    if not pieces:
        return n_words, spans, items
    text = np.concatenate(pieces)
    index = FMIndex(text, len(phrases.ids) + 1)
    run_of = np.concatenate([[0], np.cumsum(text == 0)])  # run of each text position
    owner, offset = np.array(owner), np.array(offset)
    run_start = np.concatenate([[0], np.flatnonzero(text == 0)[:-1] + 1])
    edge, found = np.zeros(len(text) + 1, np.int64), []
    for block in phrases.blocks:
        lo, hi = index.search(block.padded(), block.length)
        phrase = np.repeat(np.arange(len(lo)), hi - lo)
        place = index.locate(index_runs(lo, hi - lo))
        np.add.at(edge, place, 1)
        np.add.at(edge, place + block.length[phrase], -1)
        pairs = np.unique(np.stack([owner[run_of[place]], phrase], 1), axis=0)
        each = block.owner_count[pairs[:, 1]]
        first = np.cumsum(block.owner_count) - block.owner_count
        found.append(np.stack([np.repeat(pairs[:, 0], each), block.owners[index_runs(first[pairs[:, 1]], each)]], 1))
    for d, k in np.unique(np.concatenate(found), axis=0).tolist():
        items[d].append(k)
    hit = np.concatenate([[0], (np.cumsum(edge) > 0)[:-1].astype(np.int8), [0]])
    bound = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
    for a, b in bound.tolist():  # a run's separator is never hit, so a span stays in its run
        r = run_of[a]
        spans[owner[r]].append((int(offset[r] + a - run_start[r]), int(offset[r] + b - run_start[r])))
    return n_words, spans, items


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """The benchmark's distinct rows in blocks of about ``block_words`` words (by a bound on its characters)."""
    source = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    size = source.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / block_words))
    for k in range(blocks):
        part = source if blocks == 1 else source.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r[0], r[1].encode()) for r in part.collect()]


def _passes(blocks: Iterator[list[tuple]], pass_blocks: int) -> Iterator[list[list[tuple]]]:
    while held := list(islice(blocks, pass_blocks)):
        yield held


def _search(found: DataFrame, text_at: int, phrases: Phrases) -> DataFrame:
    """``row, n_words, spans, items`` with what the phrases find in field ``text_at`` of the row added."""
    held = found.sparkSession.sparkContext.broadcast(phrases)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        for b in batches:
            data = pc.struct_field(b.column("row"), [text_at]).cast(pa.binary()).to_pylist()
            sizes = [len(t or b"") for t in data]
            for s, e in chunks(sizes, SHARD_BYTES):
                n, hits, places = shard_hits(data[s:e], p)
                before, had = b.column("spans").slice(s, e - s).to_pylist(), b.column("items").slice(s, e - s).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(s, e - s), pa.array(n, pa.int64()),
                     pa.array([o + [{"start": x, "end": y} for x, y in h] for o, h in zip(before, hits)], spans),
                     pa.array([o + [str(p.items[k]) for k in f if p.items[k] is not None] for o, f in zip(had, places)],
                              pa.list_(pa.string()))],
                    names=["row", "n_words", "spans", "items"])

    kind = found.schema["row"].dataType.simpleString()
    return found.mapInArrow(run, f"row {kind}, n_words long, spans array<struct<start:long,end:long>>, items array<string>")


def merge_spans(spans):
    """Sorted, overlapping ones joined, as a native expression."""
    def step(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                         F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (x["start"] <= last["end"]), grown).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.sort_array(spans), F.array().cast("array<struct<start:long,end:long>>"), step)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """Per row: ``row`` (the input row as a struct), ``n_words, spans, items``.

    ``spans`` are the merged word ranges inside any occurrence of a window,
    ``items`` the ids (as strings, sorted, distinct) of items with one. Null
    and empty texts have no words; an empty benchmark finds nothing. Items of
    a null id count towards spans only. Repeated rows have one result each.
    """
    text_at = [c.lower() for c in docs.columns].index(text_col.lower())
    found = docs.select(F.struct("*").alias("row"), F.lit(0).cast("long").alias("n_words"),
                        F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    passes = 0
    for blocks in _passes(item_blocks(benchmark, item_id, item_text, block_words), pass_blocks):
        found = _search(found, text_at, Phrases(blocks, window))
        passes += 1
    spans = F.col("spans") if passes == 1 else merge_spans(F.col("spans"))
    return found.select("row", "n_words", spans.alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def contaminated():
    """The contract's rule: a word is hit and the hit words are a twentieth of all or more."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def decontam_digest(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    return decontaminate(docs.select("doc_id", "text"), benchmark, **settings).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The input's rows that are not contaminated, unchanged."""
    return decontaminate(docs, benchmark, **settings).where(~contaminated()).select("row.*")
