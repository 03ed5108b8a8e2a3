"""Helpers shared by the operators: text bytes, row wrapping, shared tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wellmart.session import ensure_checkpoint_dir
from wellmart.sources.sinks import cut_lineage

#: A-Z to a-z, every other byte unchanged (UTF-8 bytes of other letters are >= 0x80).
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: A-Z to a-z; every other ASCII byte that is no digit or letter becomes a blank.
ALNUM_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the session's shared checkpoint folder and read it back."""
    ensure_checkpoint_dir(df.sparkSession)
    return cut_lineage(df, name)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def blank_words(data: bytes | None) -> list[bytes]:
    """Words parted by space, \\t \\n \\v \\f \\r: exactly what bytes.split() parts at."""
    return data.split() if data else []


def alnum_words(data: bytes | None) -> list[bytes]:
    """Lower-cased words of digits, letters and non-ASCII characters."""
    return data.translate(ALNUM_LOWER).split() if data else []


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to ``limit`` at most (a larger single one stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def index_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for each start and length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)
