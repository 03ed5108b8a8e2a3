"""Exact removal of repeated byte strings by two-stage suffix sorting.

A window is ``k`` consecutive bytes of one text. Its minimiser is the smallest
hash of the ``m``-byte grams in it; equal windows have equal minimisers, and a
maximal run of windows that share one travels as one string.

1. Texts are packed into compressed chunks of a few MB, written once.
2. Every chunk sends its minimisers (32 bits each, once) to buckets; those met
   once in the corpus belong to no repeated window. The rest come back as bits.
3. Chunks cut out the strings of repeated minimisers, equal ones once with all
   their places, and the smallest and largest document.
4. A bucket sorts the suffixes of its distinct strings in two stages: suffixes
   smaller than their successors directly, the others induced by scanning the
   buckets of first bytes. Neighbours with a common prefix of ``k`` bytes are
   equal windows; the smallest document of each goes back to the chunks.
5. Chunks mark the windows whose smallest document is smaller than their own,
   and those that stand earlier in the same text (found by the same sort inside
   the chunk).

A gram in the strings of very many chunks (a frequent line, a passage in a third
of all texts) is hot: Spark aggregates its strings and groups their windows, so
they never meet in one task.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import chunks, index_runs, shared_table, texts

WINDOW = 100
GRAM = 32
CHUNK_BYTES = 8 << 20
HASH_BUCKET = 2 << 20  # minimisers of a bucket
STRING_BUCKET = 8 << 20  # bytes of text for a bucket of strings
SORT_BYTES = 2 << 20  # bytes that one suffix sort takes
HOT = 20_000  # chunks' strings of one gram that a bucket may hold
NO_ID = np.iinfo(np.int64).max  # a null id is no smaller than any other
END = b"\xff"  # in no UTF-8 text
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# -- minimisers ---------------------------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` (a power of two) consecutive bytes, by doubling."""
    h, width, factor = (data.astype(np.uint64) + np.uint64(1)) * _P, 1, int(_Q)
    while width < size:
        h = h[:len(h) - width] * np.uint64(factor) + h[width:] if len(h) > width else h[:0]
        factor, width = factor * factor % 2 ** 64, width * 2
    return _mix(h)


def sliding(least: np.ufunc, x: np.ndarray, size: int) -> np.ndarray:
    """``least`` (minimum or maximum) of every ``size`` consecutive values, by doubling."""
    width = 1
    while width < size:
        step = min(width, size - width)
        x = least(x[:len(x) - step], x[step:])
        width += step
    return x


def close_grams(h: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Minimisers that stand twice in one window: grams that are the minimum of a window, by hash, at a short distance."""
    reach = len(h) - len(low)  # places of a window's grams, less one
    around = np.zeros(reach, np.uint64)
    place = np.flatnonzero(h == sliding(np.maximum, np.concatenate([around, low, around]), reach + 1))
    order = np.lexsort((place, h[place]))
    place = place[order]
    near = (h[place][1:] == h[place][:-1]) & (place[1:] - place[:-1] <= reach)
    return np.unique(h[place][1:][near])


class Runs:
    """Maximal runs of windows with one minimiser in a list of texts (cut where a long text is taken in pieces).

    ``buf``: the texts joined; ``begin``: where each starts. Per run ``text``,
    ``at`` (first window in the text), ``count`` (windows) and ``low`` (minimiser);
    with ``own``, ``twice`` tells runs that may hold a window twice.
    """

    def __init__(self, data: list[bytes], k: int, m: int, own: bool = False, piece: int = 1 << 20):
        size = np.array([len(t) for t in data], np.int64)
        self.k, self.buf, self.begin = k, b"".join(data), np.cumsum(size) - size
        arr = np.frombuffer(self.buf, np.uint8)
        found: list[tuple] = []
        for i in np.flatnonzero(size >= k).tolist():
            windows = int(size[i]) - k + 1
            for s in range(0, windows, piece):
                n = min(piece, windows - s)
                h = gram_hashes(arr[self.begin[i] + s:self.begin[i] + s + n + k - 1], m)
                low = sliding(np.minimum, h, k - m + 1)
                first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
                twice = np.isin(low[first], close_grams(h, low)) if own else np.zeros(len(first), bool)
                found.append((np.full(len(first), i), first + s, np.diff(np.append(first, n)), low[first], twice))
        if found:
            self.text, self.at, self.count, self.low, self.twice = map(np.concatenate, zip(*found))
        else:
            self.text = self.at = self.count = np.zeros(0, np.int64)
            self.low, self.twice = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.place = self.begin[self.text] + self.at  # in buf

    def strings(self, which: np.ndarray) -> list[bytes]:
        k, buf = self.k - 1, self.buf
        return [buf[p:p + n + k] for p, n in zip(self.place[which].tolist(), self.count[which].tolist())]


# -- suffix sorting -----------------------------------------------------------------------------------------------

def _words(buf: bytes, depth: int) -> np.ndarray:
    """A view with the eight bytes from every place on as one big-endian number (zeros after the end)."""
    padded = np.frombuffer(buf + bytes(depth + 16), np.uint8)
    return np.ndarray((len(padded) - 8,), ">u8", padded, 0, (1,))


def smaller_than_next(arr: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the last one is not)."""
    n = len(arr)
    last = np.flatnonzero(np.concatenate([arr[1:] != arr[:-1], [True]]))  # last place of each run of equal bytes
    rises = np.append(arr[last[:-1]] < arr[last[:-1] + 1], False)
    return np.repeat(rises, np.diff(np.concatenate([[-1], last])))[:n]


def sort_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places ``at`` ordered by the first ``depth`` bytes there (at least): eight bytes a round, tied places only."""
    key = words[at].astype(np.uint64)
    order = np.argsort(key)
    out, key = at[order], key[order]
    tied = np.arange(len(out))  # places of ``out`` still to be told apart
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))[:len(out)]
    for skip in range(8, depth, 8):
        if not len(tied):
            break
        again = np.append(False, group[1:] == group[:-1])
        again[:-1] |= again[1:]
        tied, group = tied[again], group[again]
        key = words[out[tied] + skip].astype(np.uint64)
        parts = np.zeros(int(group[-1]) + 1 if len(group) else 1, bool)  # groups that these bytes part
        parts[group[1:][(key[1:] != key[:-1]) & (group[1:] == group[:-1])]] = True
        mixed = np.flatnonzero(parts[group])
        order = mixed[np.lexsort((key[mixed], group[mixed]))]
        out[tied[mixed]] = out[tied[order]]
        key[mixed] = key[order]
        group = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (group[1:] != group[:-1])))[:len(tied)]
    return out


def suffix_order(buf: bytes, depth: int) -> np.ndarray:
    """All places of ``buf`` ordered by the first ``depth`` bytes of their suffixes; two-stage.

    Suffixes smaller than their successors are sorted directly. Going through
    the buckets of first bytes upwards, a suffix larger than its successor
    finds its place when its successor is met: buckets fill in that order.
    """
    arr = np.frombuffer(buf, np.uint8)
    n = len(arr)
    small = smaller_than_next(arr)  # not the last one
    direct = sort_directly(_words(buf, depth), np.flatnonzero(small), depth)
    bound = np.searchsorted(arr[direct], np.arange(257))
    run = np.zeros(n, np.int64)  # equal bytes that end here
    first = np.flatnonzero(np.concatenate([[True], arr[1:] != arr[:-1]]))
    run = np.arange(n) - np.repeat(first, np.diff(np.append(first, n))) + 1
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[arr[n - 1]].append(np.array([n - 1]))  # larger than the empty suffix
    out = []
    for c in range(256):
        large = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        if len(large):
            # A run of c before such a suffix: one c more is larger, so all of length 1 come first, then 2, ...
            length = run[large]
            if length.max() > 1:
                distance = index_runs(np.zeros(len(large), np.int64), length)
                order = np.argsort(distance, kind="stable")
                large = (np.repeat(large, length) - distance)[order]
        here = np.concatenate([large, direct[bound[c]:bound[c + 1]]])
        if not len(here):
            continue
        out.append(here)
        before = here - 1
        before = before[before >= 0]
        byte = arr[before]
        before = before[byte > c]
        byte = arr[before]
        if len(before):
            order = np.argsort(byte, kind="stable")
            cut = np.searchsorted(byte[order], np.arange(257))
            for b in np.unique(byte).tolist():
                induced[b].append(before[order[cut[b]:cut[b + 1]]])
    return np.concatenate(out)


def common_prefixes(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, at most ``most``."""
    out = np.full(len(a), most, np.int64)
    alive = np.arange(len(a))
    for skip in range(0, most, 8):
        x = words[a[alive] + skip].astype(np.uint64) ^ words[b[alive] + skip].astype(np.uint64)
        ended = x != 0
        if ended.any():
            equal = np.zeros(int(ended.sum()), np.int64)
            for shift in range(56, 0, -8):
                equal += (x[ended] >> np.uint64(shift)) == 0
            out[alive[ended]] = np.minimum(skip + equal, most)
            alive = alive[~ended]
    return out


def equal_windows(strings: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String and offset of every window in suffix order, and its number among the distinct windows."""
    buf = END.join(strings) + END
    size = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    order = suffix_order(buf, k)
    string = np.repeat(np.arange(len(strings)), size + 1)[order]
    offset = order - begin[string]
    inside = offset <= size[string] - k
    order, string, offset = order[inside], string[inside], offset[inside]
    lcp = common_prefixes(_words(buf, k), order[:-1], order[1:], k)
    return string, offset, np.cumsum(np.concatenate([[0], lcp < k])) if len(order) else order


def _runs_of(value: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs where ``value`` counts up by one and the others stay."""
    new = np.append(True, value[1:] != value[:-1] + 1)
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(value)) - 1


# -- repeats inside one text --------------------------------------------------------------------------------------

def window_hashes(buf: bytes, place: np.ndarray, k: int, step: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes at every place, from them alone."""
    words = _words(buf, k)
    skips = [*range(0, k - 8, 8), k - 8]
    out = np.zeros(len(place), np.uint64)
    for s in range(0, len(place), step):
        at = place[s:s + step]
        for skip in skips:
            out[s:s + step] = (out[s:s + step] ^ words[at + skip].astype(np.uint64)) * _P + (out[s:s + step] >> np.uint64(29))
    return _mix(out)


def own_repeats(runs: Runs) -> np.ndarray:
    """(text, from, to) byte ranges covered by windows that stand earlier in the same text.

    Such windows are in two runs of one minimiser, or in one that holds it
    twice. Hashes narrow these runs down, the suffix sort decides.
    """
    k = runs.k
    out = []
    order = np.lexsort((runs.low, runs.text))
    again = np.append(False, (runs.low[order][1:] == runs.low[order][:-1]) & (runs.text[order][1:] == runs.text[order][:-1]))[:len(order)]
    again[:-1] |= again[1:]
    maybe = runs.twice.copy()
    maybe[order[again]] = True
    which = np.flatnonzero(maybe)
    which = which[np.argsort(runs.low[which], kind="stable")]
    low = runs.low[which]
    starts = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(which) else np.zeros(0, np.int64)
    weight = np.add.reduceat(runs.count[which], starts) if len(which) else starts
    for s, e in chunks(weight.tolist(), SORT_BYTES):
        part = which[starts[s]:starts[e] if e < len(starts) else len(which)]
        count = runs.count[part]
        run = np.repeat(np.arange(len(part)), count)
        place = index_runs(runs.place[part], count)
        h = window_hashes(runs.buf, place, k) ^ _mix(runs.text[part][run].astype(np.uint64))
        order = np.argsort(h)
        again = np.append(False, h[order][1:] == h[order][:-1])
        again[:-1] |= again[1:]
        if not again.any():
            continue
        part = part[np.unique(run[order[again]])]
        string, offset, window = equal_windows(runs.strings(part), k)
        text, at = runs.text[part][string], runs.at[part][string] + offset
        order = np.lexsort((at, window, text))
        text, at, window = text[order], at[order], window[order]
        later = np.append(False, (text[1:] == text[:-1]) & (window[1:] == window[:-1]))
        text, at = text[later], at[later]
        order = np.lexsort((at, text))
        text, at = text[order], at[order]
        if len(at):
            first, last = _runs_of(at, text)
            out.append(np.stack([text[first], at[first], at[last] + k], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


# -- the distributed steps ----------------------------------------------------------------------------------------

CHUNK = "chunk long, bytes long, ids binary, nulls binary, sizes binary, payload binary"


def pack_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts of a few MB as one compressed row (a longer text alone); every row of ``docs`` is in one."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            data = [t or b"" for t in texts(b)]
            ids = b.column("doc_id").fill_null(int(NO_ID)).to_numpy()
            nulls = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for s, e in chunks([len(t) for t in data], CHUNK_BYTES):
                body = b"".join(data[s:e])
                sizes = np.array([len(t) for t in data[s:e]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in ((number, pa.int64()), (len(body), pa.int64()), (ids[s:e].tobytes(), pa.binary()),
                                                   (nulls[s:e].tobytes(), pa.binary()), (sizes.tobytes(), pa.binary()),
                                                   (pa.Codec("zstd", 9).compress(body, asbytes=True), pa.binary()))],
                    names=["chunk", "bytes", "ids", "nulls", "sizes", "payload"])
                number += 1

    return source.mapInArrow(pack, CHUNK)


class Chunk:
    """One row of ``pack_chunks``, unpacked."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.body = pa.Codec("zstd").decompress(row["payload"], row["bytes"], asbytes=True) if row["bytes"] else b""
        self.ids, self.sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def runs(self, k: int, m: int, own: bool = False) -> Runs:
        return Runs([self.body[a:a + n] for a, n in zip(self.begin.tolist(), self.sizes.tolist())], k, m, own)


def _cut_by_bucket(low: np.ndarray, buckets: int) -> np.ndarray:
    """Borders of the buckets in sorted minimisers: bucket i holds [out[i], out[i + 1])."""
    return np.searchsorted(((low >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))


def repeated_grams(packed: DataFrame, k: int, m: int, buckets: int) -> DataFrame:
    """``chunk, bucket, bits``: which of a chunk's distinct minimisers (sorted, by bucket) other chunks hold as well."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                low = np.unique(Chunk(row).runs(k, m).low)
                cut = _cut_by_bucket(low, buckets)
                some = np.flatnonzero(np.diff(cut))
                short = low.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(np.full(len(some), row["chunk"]), pa.int64()),
                     pa.array([short[cut[i]:cut[i + 1]].tobytes() for i in some.tolist()], pa.binary())], names=["bucket", "chunk", "grams"])

    def meet(table: pa.Table) -> pa.Table:
        each = [np.frombuffer(g, np.uint32) for g in table.column("grams").to_pylist()]
        every = np.sort(np.concatenate(each))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        bits = []
        for g in each:
            hit = np.zeros(len(g), bool)
            if len(twice):
                hit = twice[np.minimum(np.searchsorted(twice, g), len(twice) - 1)] == g
            bits.append(np.packbits(hit).tobytes() if hit.any() else None)
        some = pa.array([x is not None for x in bits])
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())}).filter(some)

    sent = packed.mapInArrow(send, "bucket long, chunk long, grams binary")
    return sent.groupBy("bucket").applyInArrow(meet, "chunk long, bucket long, bits binary")


STRINGS = "chunk long, low long, string binary, least long, most long, places binary"


def repeated_strings(packed: DataFrame, bits: DataFrame, k: int, m: int, buckets: int) -> DataFrame:
    """The chunks' distinct strings of repeated minimisers with their places (text, first window), and, where ``low`` is null,
    the ranges (text, from, to) that a text repeats of itself."""
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left.to_pylist()[0])
        runs = chunk.runs(k, m, own=True)
        low, at, times = np.unique(runs.low, return_inverse=True, return_counts=True)
        border = _cut_by_bucket(low, buckets)
        repeated = times > 1
        for i, b in zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()):
            n = int(border[i + 1] - border[i])
            repeated[border[i]:border[i + 1]] |= np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
        which = np.flatnonzero(repeated[at])
        which = which[np.argsort(runs.low[which], kind="stable")]  # like strings stand together and compress well
        own = own_repeats(runs)
        held: dict[bytes, list[int]] = defaultdict(list)
        for i, s in zip(which.tolist(), runs.strings(which)):
            held[s].append(i)
        text, first, ids, lows = runs.text.tolist(), runs.at.tolist(), chunk.ids.tolist(), runs.low.view(np.int64).tolist()
        cols: list[list] = [[], [], [], [], []]
        for s, where in held.items():
            docs = [ids[text[i]] for i in where]
            for out, x in zip(cols, (lows[where[0]], s, min(docs), max(docs),
                                     array("i", [x for i in where for x in (text[i], first[i])]).tobytes())):
                out.append(x)
        if len(own):
            for out, x in zip(cols, (None, None, None, None, own.tobytes())):
                out.append(x)
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.Table.from_arrays([pa.array([chunk.number] * len(cols[0]), pa.int64()), *map(pa.array, cols, kinds)],
                                    names=["chunk", "low", "string", "least", "most", "places"])

    return packed.groupBy("chunk").cogroup(bits.groupBy("chunk")).applyInArrow(cut, STRINGS)


RANGES = "chunk long, places binary, start long, end long, least long"


def smallest_documents(table: pa.Table, k: int) -> pa.Table:
    """Window ranges of a bucket's strings whose smallest document is below the largest of the string in that chunk."""
    key = table.column("string").combine_chunks().dictionary_encode().indices.to_numpy()
    by_key = np.argsort(key, kind="stable")
    first_row = np.flatnonzero(np.append(True, key[by_key][1:] != key[by_key][:-1]))
    rows_of = np.diff(np.append(first_row, len(key)))
    row_most = table.column("most").to_numpy()
    least = np.minimum.reduceat(table.column("least").to_numpy()[by_key], first_row)
    most = np.maximum.reduceat(row_most[by_key], first_row)
    one = by_key[first_row]  # a row of each distinct string
    order = np.argsort(table.column("low").to_numpy()[one], kind="stable")
    one, first_row, rows_of, least, most = one[order], first_row[order], rows_of[order], least[order], most[order]
    low = table.column("low").to_numpy()[one]
    strings = table.column("string").take(pa.array(one)).to_pylist()
    size = np.array([len(s) for s in strings], np.int64)
    begin = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    grams = np.diff(np.append(begin, len(low)))  # distinct strings of each gram
    lone = begin[grams == 1]  # equal to no other string, sorted or not
    lone = lone[least[lone] < most[lone]]
    found = [np.stack([lone, np.zeros_like(lone), size[lone] - k + 1, least[lone]], 1)]
    many = begin[grams > 1]
    weight = np.add.reduceat(size, begin)[grams > 1]
    grams = grams[grams > 1]
    for s, e in chunks(weight.tolist(), SORT_BYTES):
        part = index_runs(many[s:e], grams[s:e])
        string, offset, window = equal_windows([strings[i] for i in part.tolist()], k)
        cut = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
        smallest = np.repeat(np.minimum.reduceat(least[part[string]], cut), np.diff(np.append(cut, len(window))))
        use = smallest < most[part[string]]
        string, offset, smallest = string[use], offset[use], smallest[use]
        order = np.lexsort((offset, string))
        string, offset, smallest = string[order], offset[order], smallest[order]
        if len(string):
            first, last = _runs_of(offset, string, smallest)
            found.append(np.stack([part[string[first]], offset[first], offset[last] + 1, smallest[first]], 1))
    out = np.concatenate(found)
    count = rows_of[out[:, 0]]
    row = by_key[index_runs(first_row[out[:, 0]], count)]  # every chunk that has the string
    out = np.repeat(out, count, axis=0)
    use = out[:, 3] < row_most[row]
    row, out = pa.array(row[use]), out[use]
    return pa.table({"chunk": table.column("chunk").take(row), "places": table.column("places").take(row),
                     "start": out[:, 1], "end": out[:, 2], "least": out[:, 3]})


def window_ranges(strings: DataFrame, buckets: int, k: int, hot: int) -> DataFrame:
    """``chunk, places, start, end, least``: windows [start, end) of the string at ``places`` stand first in document ``least``."""
    strings = strings.where("low IS NOT NULL")
    frequent = shared_table(strings.groupBy("low").count().where(F.col("count") > hot).select("low"), "suffixes-hot")
    crowded = frequent.first() is not None
    cold = strings.join(frequent, "low", "left_anti") if crowded else strings
    found = cold.withColumn("bucket", F.pmod(F.xxhash64("low"), F.lit(buckets))).groupBy("bucket").applyInArrow(
        lambda table: smallest_documents(table, k), RANGES)
    if not crowded:
        return found
    hot_strings = strings.join(frequent, "low", "left_semi")
    windows = (hot_strings.groupBy("string").agg(F.min("least").alias("least"), F.max("most").alias("most"))
               .select("string", "least", "most", F.explode(F.sequence(F.lit(0).cast("long"), F.octet_length("string").cast("long") - k)).alias("start"))
               .select("string", "start", F.expr(f"substring(string, cast(start + 1 AS int), {k})").alias("window"), "least", "most"))
    first = windows.groupBy("window").agg(F.min("least").alias("least"))
    split = windows.drop("least").join(first, "window").where("least < most").select("string", "start", (F.col("start") + 1).alias("end"), "least")
    return found.unionByName(hot_strings.select("chunk", "string", "places").join(split, "string").drop("string"))


CUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: bigint, end: bigint>>, kept binary"


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW, m: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept``, one row per input row: bytes covered by a ``k``-byte string that starts earlier go.

    Earlier is a smaller doc_id, or an earlier place of the same row. ``spans``
    are the maximal removed runs [start, end) in bytes, ``kept`` the other
    bytes (a cut may fall inside a character). ``doc_id`` is an integer; a null
    id counts as larger than all. Rows of equal doc_id, null ones included, do
    not remove each other's bytes, each loses its own repeats. Null texts read as
    empty, texts under ``k`` bytes stay whole, an empty table gives no rows.
    Other columns are ignored, so their names cannot clash.
    """
    packed = shared_table(pack_chunks(docs, id_col, text_col), "suffixes-chunks")
    total = packed.agg(F.sum("bytes")).first()[0] or 0
    grams = max(1, math.ceil(2 * total / (k - m + 2) / HASH_BUCKET))
    strings = shared_table(repeated_strings(packed, repeated_grams(packed, k, m, grams), k, m, grams), "suffixes-strings")
    found = window_ranges(strings, max(1, math.ceil(total / STRING_BUCKET)), k, hot).unionByName(
        strings.where("low IS NULL").select("chunk", "places"), allowMissingColumns=True)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left.to_pylist()[0])
        size, begin = chunk.sizes, chunk.begin
        edge = np.zeros(len(chunk.body) + 1, np.int32)
        own = right.column("least").is_null().to_numpy()
        for b in right.column("places").filter(pa.array(own)).to_pylist():
            text, start, end = np.frombuffer(b, np.int64).reshape(-1, 3).T
            np.add.at(edge, begin[text] + start, 1)
            np.add.at(edge, begin[text] + end, -1)
        others = right.filter(pa.array(~own))
        if others.num_rows:
            each = others.column("places").to_pylist()
            count = np.array([len(b) // 8 for b in each])
            text, at = np.frombuffer(b"".join(each), np.int32).reshape(-1, 2).T.astype(np.int64)
            start, end, least = (np.repeat(others.column(c).to_numpy(), count) for c in ("start", "end", "least"))
            gone = least < chunk.ids[text]
            place = begin[text[gone]] + at[gone]
            np.add.at(edge, place + start[gone], 1)
            np.add.at(edge, place + end[gone] - 1 + k, -1)
        keep = np.cumsum(edge[:-1], dtype=np.int32) == 0
        text = np.repeat(np.arange(len(size), dtype=np.int32), size)
        removed = np.bincount(text[~keep], minlength=len(size))
        new, over = ~keep, ~keep  # first and last removed bytes
        same = text[1:] == text[:-1]
        new[1:] &= keep[:-1] | ~same
        over[:-1] &= keep[1:] | ~same
        new, over = np.flatnonzero(new), np.flatnonzero(over)
        spans = np.bincount(text[new], minlength=len(size))
        kept = np.frombuffer(chunk.body, np.uint8)[keep].tobytes()
        edges = np.append(0, np.cumsum(size - removed)).tolist()
        pairs = pa.StructArray.from_arrays([pa.array(new - begin[text[new]]), pa.array(over + 1 - begin[text[new]])], names=["start", "end"])
        return pa.Table.from_arrays(
            [pa.array(chunk.ids, mask=chunk.nulls), pa.array(size), pa.array(removed, pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(spans)), pa.int32()), pairs),
             pa.array([kept[a:b] for a, b in zip(edges, edges[1:])], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return packed.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(cut, CUT)


def suffix_digest(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return dedup_bytes(docs, **settings).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
