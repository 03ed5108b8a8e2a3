"""Divergence of sources within a language, from a quadtree over the group-term count matrix.

Rows of the matrix are the (lang, source) groups, columns the terms that the
language keeps, cells the counts. With N the kept occurrences of a group and V
the kept terms, a term has p = 1 + floor(10^9 (count + 1) / (N + V)); a group
with probabilities p diverges from q by the sum of floor((p - q)^2 / q).

The matrix is cut into tiles of at most about ``TILE_ROWS`` x ``TILE_COLUMNS``
(rows and columns dealt by hash), one task a pair of row bands and a column
band. A tile becomes a k^2-tree with k = 2: the Morton codes of its nonzero
cells, level by level, where a missing child is a quadrant of zeros. Pairs of
nodes over the same columns go down together: two zero quadrants are priced as
columns times one value, a zero quadrant against a nonzero one likewise and
then by the other's leaves alone, and only where both are nonzero the walk goes on.
Columns that hold no cell of either group in any tile are priced at the end.

Spark counts the terms (pre-aggregated per batch of texts), sums the tiles'
shares and ranks; p and f are exact integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import index_runs, shared_table, texts

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
TILE_ROWS = 32
TILE_COLUMNS = 1024
#: A-Z to a-z; every other ASCII byte that is no letter becomes a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
TALLY_TERMS = 500_000  # distinct (group, term) pairs that a task holds before it passes them on


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences of a term and documents with it; term '' stands for the group itself."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def passed() -> pa.RecordBatch:
            cols: list[list] = [[], [], [], [], []]
            for (lang, source), (n, d) in held.items():
                for out, part in zip(cols, ([lang] * len(n), [source] * len(n), list(n), list(n.values()), [d[t] for t in n])):
                    out += part
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()))],
                names=["lang", "source", "term", "n", "n_docs"])

        size = 0
        for b in batches:
            for lang, source, t in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts(b)):
                n, d = held.setdefault((lang, source), (Counter({b"": 0}), Counter()))
                before = len(n)
                words = t.translate(LETTERS).split()
                n.update(words)
                d.update(set(words))
                size += len(n) - before
                if size > TALLY_TERMS:
                    yield passed()
                    size = 0
        if held:
            yield passed()

    found = rows.mapInArrow(count, "lang string, source string, term binary, n long, n_docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), exact: integral division of decimals."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(F.lit(SCALE)) * (wide(count) + 1), wide(total) + wide(kept)) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of longs up to 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Quadtree:
    """A k^2-tree (k = 2) of a tile: per level the Morton codes (row bit above column bit) of the nonzero quadrants."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int):
        code = np.zeros(len(row), np.int64)
        for bit in range(height):
            code |= ((row >> bit & 1) << 2 * bit + 1) | ((column >> bit & 1) << 2 * bit)
        order = np.argsort(code)
        self.height = height
        self.row, self.value = row[order], value[order]
        self.levels = [code[order]]
        for _ in range(height):
            up = self.levels[-1] >> 2
            self.levels.append(up[np.concatenate([[True], up[1:] != up[:-1]])] if len(up) else up)
        self.levels.reverse()  # root first

    def has(self, level: int, code: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.levels[level], code)
        return self.levels[level][np.minimum(at, len(self.levels[level]) - 1)] == code

    def leaves(self, level: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First leaf and number of leaves below nodes."""
        shift = 2 * (self.height - level)
        first = np.searchsorted(self.levels[-1], code << shift)
        return first, np.searchsorted(self.levels[-1], (code + 1) << shift) - first


def _bits(code: np.ndarray, height: int, first: int) -> np.ndarray:
    out = np.zeros(len(code), np.int64)
    for bit in range(height):
        out |= (code >> 2 * bit + first & 1) << bit
    return out


def pair_sums(row: np.ndarray, column: np.ndarray, p: np.ndarray, zero: np.ndarray, columns: int) -> np.ndarray:
    """Sum of distances over a tile's columns for every ordered pair of its rows.

    ``row, column, p``: the nonzero cells; ``zero``: each row's p of a zero cell.
    """
    rows = len(zero)
    height = max(rows - 1, columns - 1, 1).bit_length()
    total = np.zeros((rows, rows), np.int64)
    empty = np.zeros((rows + 1, rows + 1), np.int64)  # corners of rectangles of zero columns
    if not len(row):
        return _distance(zero[:, None], zero[None, :]) * columns
    tree = Quadtree(row, column, p, height)
    a = b = np.zeros(1, np.int64)  # pairs of nonzero nodes over the same columns, row of a <= row of b
    for level in range(1, height + 1):
        size = 1 << (height - level)
        ahead_a, ahead_b = [], []
        for c in (0, 1):
            for ra in (0, 1):
                for rb in (0, 1):
                    # Of a node with itself only one of the two mixed pairs.
                    use = slice(None) if (ra, rb) != (1, 0) else a != b
                    x, y = a[use] * 4 + ra * 2 + c, b[use] * 4 + rb * 2 + c
                    in_x, in_y = tree.has(level, x), tree.has(level, y)
                    both = in_x & in_y
                    ahead_a.append(x[both])
                    ahead_b.append(y[both])
                    for one, other, mine in ((x, y, in_x & ~in_y), (y, x, in_y & ~in_x)):
                        _one_sided(tree, level, one[mine], other[mine], size, zero, total)
                    _as_zero(level, x[~both], y[~both], size, rows, columns, empty)
        a, b = np.concatenate(ahead_a), np.concatenate(ahead_b)
    # Leaves over the same column.
    first_a, first_b = np.searchsorted(tree.levels[-1], a), np.searchsorted(tree.levels[-1], b)
    ra, rb, pa_, pb = tree.row[first_a], tree.row[first_b], tree.value[first_a], tree.value[first_b]
    np.add.at(total, (ra, rb), _distance(pa_, pb))
    np.add.at(total, (rb, ra), _distance(pb, pa_))
    n = empty.cumsum(0).cumsum(1)[:rows, :rows]
    return total + (n + n.T) // 2 * _distance(zero[:, None], zero[None, :])


def _one_sided(tree: Quadtree, level: int, node: np.ndarray, other: np.ndarray, size: int, zero: np.ndarray, total: np.ndarray) -> None:
    """What the leaves below ``node`` differ by from zeros, against the rows of the zero quadrant ``other``."""
    first, n = tree.leaves(level, node)
    leaf = index_runs(first, n)
    low = np.repeat(_bits(other, level, 1) * size, n)
    rows = np.clip(len(zero) - low, 0, size)
    against = index_runs(low, rows)
    leaf = np.repeat(leaf, rows)
    mine, value = tree.row[leaf], tree.value[leaf]
    apart = mine != against
    mine, value, against = mine[apart], value[apart], against[apart]
    np.add.at(total, (mine, against), _distance(value, zero[against]) - _distance(zero[mine], zero[against]))
    np.add.at(total, (against, mine), _distance(zero[against], value) - _distance(zero[against], zero[mine]))


def _as_zero(level: int, x: np.ndarray, y: np.ndarray, size: int, rows: int, columns: int, empty: np.ndarray) -> None:
    """Add twice the width of quadrants to the rectangles of their rows, once to a square that is its own mirror image."""
    width = np.clip(columns - _bits(x, level, 0) * size, 0, size) * np.where(x == y, 1, 2)
    low_x, low_y = _bits(x, level, 1) * size, _bits(y, level, 1) * size
    use = (width > 0) & (low_x < rows) & (low_y < rows)
    width, low_x, low_y = width[use], low_x[use], low_y[use]
    high_x, high_y = np.minimum(low_x + size, rows), np.minimum(low_y + size, rows)
    for i, j, sign in ((low_x, low_y, 1), (high_x, low_y, -1), (low_x, high_y, -1), (high_x, high_y, 1)):
        np.add.at(empty, (i, j), sign * width)


class Matrix:
    """The written tables behind an audit: ``groups`` (one row a group), ``cells`` (kept, nonzero) and their totals."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, **columns):
        counts = shared_table(term_counts(docs, **columns), "divergence-counts")
        kept = (counts.where("term <> ''").groupBy("lang", "term")
                .agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("df")).where(F.col("df") >= min_docs).drop("df"))
        kept = shared_table(kept, "divergence-kept")
        cells = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
        totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = (counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                  .fillna(0, ["total", "kept", "lang_total"]))
        sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        self.groups = shared_table(groups.join(sizes, "lang").withColumn(
            "zero", F.when(F.col("kept") > 0, probability(F.lit(0), F.col("total"), F.col("kept")))), "divergence-groups")
        facts = self.groups.select("lang", "source", "total", "kept", "lang_total", "sources")
        self.cells = shared_table(cells.join(facts, ["lang", "source"]).select(
            "lang", "source", "term", "sources", "kept",
            probability(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
            probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")), "divergence-cells")


def source_pairs(matrix: Matrix, tile_rows: int = TILE_ROWS, tile_columns: int = TILE_COLUMNS) -> DataFrame:
    """``lang, source, other, value``: the distance of every source from every other of its language."""
    bands = F.ceil(F.col("sources") / tile_rows)
    strips = F.ceil(F.col("kept") / tile_columns)
    band = F.pmod(F.xxhash64("source", F.lit(7)), bands)
    # A band meets every band, itself included, once: the pair (low, high) goes to one task a strip.
    meets = F.explode(F.sequence(F.lit(0).cast("long"), bands - 1)).alias("meet")
    ends = lambda df: df.withColumn("low", F.least("band", "meet")).withColumn("high", F.greatest("band", "meet"))
    cells = ends(matrix.cells.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), strips).alias("strip"), band.alias("band"), meets))
    rows = ends(matrix.groups.where("kept > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), strips - 1)).alias("strip"), band.alias("band"), "sources")
        .select("lang", "source", "term", "p", "strip", "band", meets))
    names = ["lang", "strip", "low", "high"]

    def tile(keys: tuple, table: pa.Table) -> pa.Table:
        term = table.column("term").combine_chunks()
        is_row = term.is_null().to_numpy(zero_copy_only=False)
        names_ = table.column("source").combine_chunks().dictionary_encode()
        source = names_.indices.to_numpy()  # numbers of the tile's sources
        p = table.column("p").to_numpy()
        band_of = table.column("band").to_numpy()
        group, zero, bands_ = source[is_row], p[is_row], band_of[is_row]
        cell_term = term.filter(pa.array(~is_row)).dictionary_encode()
        columns = len(cell_term.dictionary)
        at = np.zeros(len(names_.dictionary), np.int64)
        at[group] = np.arange(len(group))
        sums = pair_sums(at[source[~is_row]], cell_term.indices.to_numpy().astype(np.int64), p[~is_row], zero, columns)
        # Each pair belongs to the task of its bands; columns without a cell are priced at the end.
        low, high = keys[2].as_py(), keys[3].as_py()
        ends_ = np.sort(np.stack(np.broadcast_arrays(bands_[:, None], bands_[None, :])), 0)
        i, j = np.nonzero((ends_[0] == low) & (ends_[1] == high) & ~np.eye(len(group), dtype=bool) & (columns > 0))
        return pa.table({"lang": pa.array([keys[0].as_py()] * len(i), pa.string()), "source": names_.dictionary.take(pa.array(group[i])),
                         "other": names_.dictionary.take(pa.array(group[j])), "value": pa.array(sums[i, j], pa.int64()),
                         "columns": pa.array(np.full(len(i), columns, np.int64))})

    shares = (cells.select(*names, "source", "term", "p", "band").unionByName(rows.select(*names, "source", "term", "p", "band"))
              .groupBy(*names).applyInArrow(tile, "lang string, source string, other string, value long, columns long"))
    shares = shares.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns"))
    left = matrix.groups.select("lang", "source", "kept", "zero")
    right = matrix.groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    pairs = left.join(right, "lang").where("source <> other").join(shares, ["lang", "source", "other"], "left")
    rest = (F.col("kept") - F.coalesce("columns", F.lit(0))) * distance(F.col("zero"), F.col("other_zero"))
    return pairs.select("lang", "source", "other", F.when(F.col("kept") == 0, 0).otherwise(
        F.coalesce("value", F.lit(0)) + rest).cast("long").alias("value"))


def typical_terms(matrix: Matrix) -> DataFrame:
    """``lang, source, term, value``: terms that a source uses more than its language does, by their distance."""
    return matrix.cells.where("p > q").select("lang", "source", "term", distance(F.col("p"), F.col("q")).alias("value"))


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, tile_rows: int = TILE_ROWS,
                     tile_columns: int = TILE_COLUMNS, **columns) -> DataFrame:
    """``lang, source, part, item, value, rank``: a group's distance from each other source (``pair``) and its ``top`` terms (``term``).

    Null text, lang and source read as ''. A language without kept terms has
    pairs of value 0; a language of one source has none. Rows are counted as
    they come, repeated ones again. Ties rank by the item's UTF-8 bytes. An
    empty table gives no rows. Other columns are ignored, so their names cannot clash.
    """
    matrix = Matrix(docs, min_docs, **columns)
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(matrix, tile_rows, tile_columns).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    terms = typical_terms(matrix).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(by)).unionByName(
        terms.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top))
