"""Exact substring de-duplication by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the smallest hash of the
``m``-word grams in it; neighbouring windows mostly share it, and a maximal run
of windows that do travels as one packed string (a super-k-mer) to the bucket
of the minimiser. Equal windows have equal minimisers, so a bucket sees every
occurrence of its windows: it sorts them, compares the bytes of those whose
hashes meet, and knows the smallest doc_id each starts in.

Each task packs the super-k-mers of a few MB of text by bucket: a string that
occurs often there (a shared passage, copies) is packed once with the list of
its places, and the pack is compressed. Buckets are numbered so that one holds
about ``bucket_bytes`` of strings, whatever the input.

A passage that very many documents share puts all its places into one bucket.
A first pass weighs the buckets; those over ``HOT`` times the usual weight are
split by chunk into parts of usual weight. Parts count their distinct windows,
Spark joins the counts by window text, and each part marks its own places.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import blank_words, chunks, index_runs, shared_table, texts

WINDOW = 13
GRAM = 3
BUCKET_BYTES = 8 << 20
CHUNK_BYTES = 8 << 20
HOT = 16  # times bucket_bytes
PLACE_BYTES = 16
NO_ID = np.iinfo(np.int64).max  # a null id is no smaller than any other
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P
    return x ^ (x >> np.uint64(29))


def word_spans(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of lines of single-blank-parted words, and its line."""
    arr = np.frombuffer(buf, np.uint8)
    gaps = np.flatnonzero((arr == 32) | (arr == 10))
    start = np.concatenate([[0], gaps + 1])
    end = np.concatenate([gaps, [len(arr)]])
    line = np.concatenate([[0], np.cumsum(arr[gaps] == 10)])
    return start, end, line


def word_hashes(buf: bytes, start: np.ndarray, end: np.ndarray, step: int = 1 << 17) -> np.ndarray:
    """A 64-bit hash of every word, from its bytes alone."""
    arr = np.frombuffer(buf, np.uint8)
    out = np.empty(len(start), np.uint64)
    powers = np.cumprod(np.full(int((end - start).max(initial=0)) + 1, _Q))
    for s in range(0, len(start), step):
        a, n = start[s:s + step], (end - start)[s:s + step]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        value = (arr[place + np.repeat(a, n)].astype(np.uint64) + np.uint64(1)) * powers[place]
        out[s:s + step] = np.add.reduceat(value, first)
    return _mix(out)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    n = len(words) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        h = h * _Q + words[k:k + n]
    return _mix(h)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values, by doubling."""
    width = 1
    while width < size:
        step = min(width, size - width)
        x = np.minimum(x[:len(x) - step], x[step:])
        width += step
    return x


def super_kmers(docs: list[list[bytes]], k: int, m: int) -> tuple[bytes, np.ndarray]:
    """The documents' words as one buffer, and per super-k-mer: document, first word in it, byte start, byte end, minimiser."""
    buf = b"\n".join(map(b" ".join, docs))
    start, end, line = word_spans(buf)
    low = sliding_min(gram_hashes(word_hashes(buf, start, end), m), k - m + 1)
    n = len(low)
    whole = np.flatnonzero(line[:n] == line[k - 1:k - 1 + n])  # windows inside one document
    low, doc = low[whole], line[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(whole)) - 1
    zero = np.concatenate([[0], np.flatnonzero(np.diff(line)) + 1])  # first word of each line
    a, b = whole[first], whole[last] + k - 1
    return buf, np.stack([doc[first], a - zero[doc[first]], start[a], end[b], _mix(low[first]).view(np.int64)], 1)


def _thin(x: np.ndarray, kind) -> bytes:
    """Differences of neighbours, byte plane by byte plane: what a compressor likes."""
    d = np.diff(x.astype(kind), prepend=np.zeros(1, kind))
    return d.view(np.uint8).reshape(-1, d.itemsize).T.tobytes()


def _wide(raw: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    d = np.frombuffer(raw, np.uint8).reshape(size, n).T.copy().view(kind).reshape(n)
    return np.cumsum(d, dtype=kind).astype(np.int64)


_PLACE = (("doc", np.int64), ("k1", np.int64), ("k2", np.int64), ("word", np.int32))


def pack(strings: list[bytes], places: list[list[int]], doc: np.ndarray, k1: np.ndarray, k2: np.ndarray, word: np.ndarray) -> bytes:
    """Strings with the (document, row key, first word) of their places, compressed (a row key is zero but for repeated ids)."""
    flat = np.array([i for p in places for i in p], np.int64)
    count = np.array([len(p) for p in places], np.int32)
    body = b"\n".join(strings)
    head = np.array([len(strings), len(flat), len(body)], np.int64)
    cols = [_thin(x[flat], kind) for x, (_, kind) in zip((doc, k1, k2, word), _PLACE)]
    raw = b"".join([head.tobytes(), _thin(count, np.int32), *cols, body])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 6).compress(raw, asbytes=True)


def unpack(blob: bytes) -> tuple:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n, places, size = np.frombuffer(raw, np.int64, 3).tolist()
    out, at = [_wide(raw[24:24 + 4 * n], n, np.int32)], 24 + 4 * n
    for _, kind in _PLACE:
        width = np.dtype(kind).itemsize * places
        out.append(_wide(raw[at:at + width], places, kind))
        at += width
    return (raw[len(raw) - size:], *out)


class Bucket:
    """The packs of one bucket, or of one part of a hot bucket: strings, their windows and their places."""

    def __init__(self, blobs: list[bytes], k: int):
        self.k = k
        bodies, *columns = zip(*map(unpack, blobs))
        self.buf = b"\n".join(bodies)
        self.count, self.doc, self.k1, self.k2, self.word = map(np.concatenate, columns)
        self.start, self.end, self.line = word_spans(self.buf)  # a line is a super-k-mer
        self.first_place = np.cumsum(self.count) - self.count
        self.least = np.minimum.reduceat(self.doc, self.first_place)
        self.most = np.maximum.reduceat(self.doc, self.first_place)
        n = max(0, len(self.line) - k + 1)
        self.window = np.flatnonzero(self.line[:n] == self.line[k - 1:k - 1 + n])  # first words of windows

    def texts(self, window: np.ndarray) -> list[bytes]:
        return [self.buf[a:b] for a, b in zip(self.start[window].tolist(), self.end[window + self.k - 1].tolist())]

    def marks(self, own: np.ndarray, smallest: np.ndarray) -> tuple[np.ndarray, ...]:
        """Word ranges (document, two row keys, from, to) where windows ``own`` stand in documents above their ``smallest``."""
        if not len(own):
            return tuple(np.zeros((5, 0), np.int64))
        by_word = np.full(len(self.start), NO_ID)
        by_word[own] = smallest
        # Every place of a string with such windows, window by window.
        line, count = self.line, self.count
        line_first = np.searchsorted(line, np.arange(len(count)))
        windows = np.diff(np.append(line_first, len(line))) - self.k + 1
        strings = np.flatnonzero(np.bincount(line[own], minlength=len(count)))
        place = index_runs(self.first_place[strings], count[strings])
        string = np.repeat(strings, count[strings])
        out = []
        for s, e in chunks(windows[string].tolist(), 1 << 20):
            n = windows[string[s:e]]
            at = index_runs(line_first[string[s:e]], n)
            here = np.repeat(place[s:e], n)
            hit = by_word[at] < self.doc[here]
            off = at - np.repeat(line_first[string[s:e]], n)
            new = hit & ~np.concatenate([[False], hit[:-1] & (here[1:] == here[:-1])])
            over = hit & ~np.concatenate([hit[1:] & (here[1:] == here[:-1]), [False]])
            p = here[new]
            out.append((self.doc[p], self.k1[p], self.k2[p], self.word[p] + off[new], self.word[p] + off[over] + self.k))
        return tuple(np.concatenate(x) for x in zip(*out))


def repeats(blobs: list[bytes], k: int) -> tuple[np.ndarray, ...]:
    """Word ranges (document, two row keys, from, to) of one bucket that windows of smaller documents repeat."""
    b = Bucket(blobs, k)
    window = b.window
    h = gram_hashes(word_hashes(b.buf, b.start, b.end), k)[window]
    order = np.argsort(h, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    row = b.line[window[order]]
    meets = np.repeat(np.minimum.reduceat(b.least[row], cut) < np.maximum.reduceat(b.most[row], cut),
                      np.diff(np.append(cut, len(order))))
    # Windows whose hash occurs in two documents: exact from here on.
    own = window[order][meets]
    run = np.cumsum(np.isin(np.arange(len(order)), cut, assume_unique=True))[meets]
    text = b.texts(own)
    same = np.array([x == y for x, y in zip(text, text[1:])], bool)
    if not (same | (run[1:] != run[:-1])).all():  # hashes collided: sort the windows themselves
        by = sorted(range(len(own)), key=lambda i: (run[i], text[i]))
        own, run, text = own[by], run[by], [text[i] for i in by]
        same = np.array([x == y for x, y in zip(text, text[1:])], bool)
    if not len(own):
        return b.marks(own, own)
    cut = np.flatnonzero(np.concatenate([[True], ~same | (run[1:] != run[:-1])]))
    return b.marks(own, np.repeat(np.minimum.reduceat(b.least[b.line[own]], cut), np.diff(np.append(cut, len(own)))))


def window_counts(blobs: list[bytes], k: int) -> dict[bytes, tuple[int, int]]:
    """Smallest and largest document of every distinct window of a part."""
    b = Bucket(blobs, k)
    out: dict[bytes, tuple[int, int]] = {}
    string = b.line[b.window]
    for t, lo, hi in zip(b.texts(b.window), b.least[string].tolist(), b.most[string].tolist()):
        had = out.get(t)
        out[t] = (lo, hi) if had is None else (min(lo, had[0]), max(hi, had[1]))
    return out


def marked(blobs: list[bytes], known: dict[bytes, int], k: int) -> tuple[np.ndarray, ...]:
    """Word ranges of a part, whose windows' smallest documents are ``known`` where they matter."""
    b = Bucket(blobs, k)
    smallest = np.array([known.get(t, NO_ID) for t in b.texts(b.window)], np.int64)
    found = smallest < NO_ID
    return b.marks(b.window[found], smallest[found])


REPEATED_IDS = 1 << 20  # as many repeated ids are broadcast at most


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a key that tells texts of one doc_id apart: 128 bits of the text's hashes, zero where the id is alone.

    Only null and repeated ids need it. The repeated ids are counted first and
    broadcast if there are few; otherwise every row gets its hashes.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    again = rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again"))
    again = shared_table(again, "substring-ids")
    if again.count() <= REPEATED_IDS:
        rows = rows.join(F.broadcast(again), F.col("doc_id") == F.col("_again"), "left")
        shared = F.col("doc_id").isNull() | F.col("_again").isNotNull()
    else:
        shared = F.lit(True)
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", F.when(shared, F.xxhash64(text)).otherwise(0).alias("k1"),
                       F.when(shared, F.xxhash64(F.lit("second"), text)).otherwise(0).alias("k2"), "text")


RANGES = "doc_id long, k1 long, k2 long, start long, end long"


def _found(batches: Iterator[pa.RecordBatch], k: int, m: int, buckets: int) -> Iterator[tuple]:
    """Per chunk of a task's texts: words' buffer, super-k-mers, their row's ids and two keys, their buckets."""
    for b in batches:
        data = texts(b)
        ids = b.column("doc_id").fill_null(int(NO_ID)).to_numpy()
        k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
        for s, e in chunks([len(t or b"") for t in data], CHUNK_BYTES):
            words = [blank_words(t) for t in data[s:e]]
            rows = np.array([i for i, w in enumerate(words) if len(w) >= k], np.int64)
            if not len(rows):
                continue
            buf, found = super_kmers([words[i] for i in rows], k, m)
            del words
            row = rows[found[:, 0]] + s
            yield buf, found, ids[row], k1[row], k2[row], (found[:, 4].view(np.uint64) % np.uint64(buckets)).astype(np.int64)


def hot_buckets(source: DataFrame, k: int, m: int, buckets: int, bucket_bytes: int, hot: int) -> dict[int, int]:
    """Buckets of over ``hot * bucket_bytes`` and the parts to split them into.

    All buckets weigh about ``buckets * bucket_bytes``, so at most one in
    ``hot`` of them can be here, and only those of hot minimisers are.
    """
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, _, _, _, bucket in _found(batches, k, m, buckets):
            which, at = np.unique(bucket, return_inverse=True)
            weight = np.bincount(at, found[:, 3] - found[:, 2] + PLACE_BYTES).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(weight)], names=["bucket", "weight"])

    weights = source.mapInArrow(weigh, "bucket long, weight long").groupBy("bucket").agg(F.sum("weight").alias("weight"))
    return {r[0]: math.ceil(r[1] / bucket_bytes) for r in weights.where(F.col("weight") > hot * bucket_bytes).collect()}


def repeated_ranges(source: DataFrame, k: int = WINDOW, m: int = GRAM, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """``doc_id, k1, k2, start, end``: word ranges that repeat a window of a smaller doc_id (they may overlap)."""
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total * (2 * k / (k - m + 2) + 1) / bucket_bytes))
    parts = hot_buckets(source, k, m, buckets, bucket_bytes, hot)
    held = source.sparkSession.sparkContext.broadcast(parts)

    def scatter(want_hot: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split = held.value
            hot_ids = np.array(list(split), np.int64)
            chunk = TaskContext.get().partitionId() << 32
            for buf, found, ids, k1, k2, bucket in _found(batches, k, m, buckets):
                order = np.argsort(bucket, kind="stable")
                if split:
                    order = order[np.isin(bucket[order], hot_ids) == want_hot]
                if not len(order):
                    continue
                cut = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0]))
                chunk += 1
                deal = int(_mix(np.array([chunk], np.uint64))[0])
                made: tuple[list, list, list] = ([], [], [])
                for group in np.split(order, cut[1:]):
                    strings = defaultdict(list)
                    for i, x, y in zip(group.tolist(), found[group, 2].tolist(), found[group, 3].tolist()):
                        strings[buf[x:y]].append(i)
                    made[0].append(int(bucket[group[0]]))
                    made[1].append(deal % split.get(made[0][-1], 1))
                    made[2].append(pack(list(strings), list(strings.values()), ids, k1, k2, found[:, 1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[0], pa.int64()), pa.array(made[1], pa.int64()), pa.array(made[2], pa.binary())], names=["bucket", "part", "pack"])

        return source.mapInArrow(run, "bucket long, part long, pack binary")

    def ranges(found: tuple[np.ndarray, ...]) -> pa.Table:
        doc = pa.array(found[0], mask=found[0] == NO_ID)
        return pa.Table.from_arrays([doc, *map(pa.array, found[1:])], names=["doc_id", "k1", "k2", "start", "end"])

    def gather(table: pa.Table) -> pa.Table:
        return ranges(repeats(table.column("pack").to_pylist(), k))

    cold = scatter(False).select("bucket", "pack").groupBy("bucket").applyInArrow(gather, RANGES)
    if not parts:
        return cold

    def count(table: pa.Table) -> pa.Table:
        found = window_counts(table.column("pack").to_pylist(), k)
        here = table.slice(0, 1)
        bounds = np.array(list(found.values()), np.int64).reshape(-1, 2)
        return pa.Table.from_arrays(
            [pa.array(here.column(c).to_pylist() * len(found), pa.int64()) for c in ("bucket", "part")]
            + [pa.array(list(found), pa.binary()), pa.array(bounds[:, 0]), pa.array(bounds[:, 1])],
            names=["bucket", "part", "window", "least", "most"])

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return ranges(tuple(np.zeros((5, 0), np.int64)))
        known = dict(zip(right.column("window").to_pylist(), right.column("smallest").to_pylist()))
        return ranges(marked(left.column("pack").to_pylist(), known, k))

    packs = shared_table(scatter(True), "substring-hot")
    counts = shared_table(packs.groupBy("bucket", "part").applyInArrow(
        count, "bucket long, part long, window binary, least long, most long"), "substring-windows")
    smallest = counts.groupBy("window").agg(F.min("least").alias("smallest"))  # a window has one row a part at most
    known = counts.join(smallest, "window").where("smallest < most").select("bucket", "part", "window", "smallest")
    split = packs.groupBy("bucket", "part").cogroup(known.groupBy("bucket", "part")).applyInArrow(mark, RANGES)
    return cold.unionByName(split)


def kept_words(data: bytes | None, ranges: list[tuple[int, int]]) -> tuple[int, list[bytes]]:
    """Number of words and those outside the ranges, in order."""
    words = blank_words(data)
    if not ranges:
        return len(words), words
    edge = np.zeros(len(words) + 1, np.int64)
    for s, e in ranges:
        edge[s] += 1
        edge[e] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return len(words), [w for w, x in zip(words, keep.tolist()) if x]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW, m: int = GRAM,
                     bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``, one row per input row.

    ``doc_id`` is an integer; a null id counts as larger than all. Null, empty
    and short texts keep their words. Rows of equal doc_id, null ones included, do
    not remove each other's words; rows that are equal in text as well lose the same. Other columns are ignored, so their names cannot clash.
    """
    source = _source(docs, id_col, text_col)
    found = repeated_ranges(source, k, m, bucket_bytes, hot).groupBy("doc_id", "k1", "k2").agg(
        F.collect_set(F.struct("start", "end")).alias("ranges"))  # repeated rows have the same: at most one range a word
    found = found.select(F.col("doc_id").alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), "ranges")
    both = source.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, left, kept = [], [], []
            for t, r in zip(texts(b), b.column("ranges").to_pylist()):
                size, words = kept_words(t, [(x["start"], x["end"]) for x in r or ()])
                n.append(size)
                left.append(size - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(left, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return both.select("doc_id", "text", "ranges").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")


def substring_digest(docs: DataFrame, **settings) -> DataFrame:
    return dedup_substrings(docs, **settings).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
