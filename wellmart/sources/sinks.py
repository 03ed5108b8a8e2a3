"""Full-refresh sinks and lineage cuts.

The source drops and recreates every output (schema on write), so readers find
nothing while it does. Here a refresh is a new version: ``publish`` writes a
folder of its own below the table and then swaps one small pointer file.
Readers ask ``current`` once and read that version throughout; the version
before stays until the next refresh. A run that dies leaves the old one in
place. Intermediates read more than once are cut by writing
them as a Parquet table into the shared folder the session names in
``spark.checkpoint.dir`` and reading that table back: one pass over the
input, reliable storage that survives executor loss (unlike a cache or a
local checkpoint), and later reads get column pruning and filter pushdown.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Paths of the intermediates written by this process and not yet dropped.
CUTS: list[str] = []


def overwrite(df: DataFrame, path: str, fmt: str = "parquet",
              sort_within: list[str] | None = None) -> None:
    """Replace the table at ``path`` with ``df``.

    ``sort_within`` clusters rows inside each output file (the source's
    ``ORDER BY`` into a table has no other observable effect) without a
    global sort.
    """
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    df.write.mode("overwrite").format(fmt).save(path)


#: Name of the pointer file; it holds the name of the table's current version folder.
POINTER = "_CURRENT"
VERSION = "version-"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _pointed(spark: SparkSession, path: str) -> str | None:
    """Name of the version that the table's pointer names."""
    fs, pointer = _file_system(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str:
    """The folder to read a table from: its current version, or ``path`` itself for a plain table."""
    name = _pointed(spark, path)
    return f"{path.rstrip('/')}/{name}" if name else path


def clustered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the rows of a key in few files, in its order: one shuffle, no sampling pass over ``df``.

    AQE joins small partitions and splits those over the advisory size by input
    range, so a hot key spreads over files and light keys share one. With too few
    shuffle partitions for the data, light keys spread over the pieces as well.
    """
    return df.hint("rebalance", F.col(key)).sortWithinPartitions(key)


def publish(df: DataFrame, path: str, fmt: str = "parquet", sort_within: list[str] | None = None, cluster_by: str | None = None,
            dealt: bool = False) -> str:
    """Write ``df`` as the next version of the table at ``path``, make it current and return its folder.

    The pointer is replaced by renaming a finished file over it, after all rows
    are written; until then, and if the write fails or dies, readers get the
    old version. Folders of versions other than the new one and the one before
    go afterwards, with what broken runs left. ``cluster_by`` names a key that
    readers look up: its rows are ``clustered``, and Parquet files get a Bloom
    filter on it, so a keyed read skips the files without it; with ``dealt`` the rows come
    in tasks dealt by that key and in its order (``joins.attach``) and stay there. Plain files of a table that was
    written before it had versions count as the version before. One writer at a
    time, as in the source; readers may be many. The write's shuffle files go with it.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before, name = _pointed(spark, path), f"{VERSION}{uuid.uuid4().hex}"
    if cluster_by and not dealt:
        df = clustered(df, cluster_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode("error").format(fmt)
    if cluster_by and fmt == "parquet":
        writer = writer.option(f"parquet.bloom.filter.enabled#{cluster_by}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true")  # sized by the keys a file has
    writer.save(f"{path}/{name}")
    release(spark)
    fs, table = _file_system(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fresh, pointer = hadoop.Path(f"{path}/{POINTER}-{name}"), hadoop.Path(f"{path}/{POINTER}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(table.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(fresh), fs.makeQualified(pointer), over)
    if before:  # else plain files may be in use: they go with the next refresh
        for entry in fs.listStatus(table):
            if entry.getPath().getName() not in (POINTER, name, before):
                fs.delete(entry.getPath(), True)
    return f"{path}/{name}"


def checkpoint_root(df: DataFrame) -> str:
    spark = df.sparkSession
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; call session.ensure_checkpoint_dir()")
    return root.rstrip("/")


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` under the checkpoint directory and return the table read back.

    The shuffle files of the write go with it, else they would lie beside those of the next step.
    """
    path = f"{checkpoint_root(df)}/wellmart/{name}-{uuid.uuid4().hex}"
    CUTS.append(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files whose plans nothing refers to any more go now: Spark's cleaner waits for the driver to collect them."""
    spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owner of the intermediates written inside it: they are deleted at its end, also after an error."""
    held = len(CUTS)
    try:
        yield
    finally:
        drop_cuts(spark, held)


def drop_cuts(spark: SparkSession, since: int = 0, keep_last: bool = False) -> None:
    """Delete the intermediates written after the first ``since`` (but the last one); nothing may read them any more."""
    paths = CUTS[since:len(CUTS) - keep_last]
    del CUTS[since:len(CUTS) - keep_last]
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
