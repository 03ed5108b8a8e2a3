"""Secret scan with an incremental blob ledger.

Every historical version of a file is a row (path, text). Its content is
addressed by SHA-256. The ledger is a table in shared storage: one row per
(blob, rule version) that was scanned, with its findings. A scan reads the
addresses, keeps one text per blob that the ledger lacks for this rule
version, scans those, appends them, and joins the ledger back to all paths.
Two scans at once may both enter a blob: readers take it once.
Scanning the same history again, or a history with moved or copied files,
reads no text twice; a new rule version scans each blob once more.

Copies of a blob are reduced in each task before the shuffle, so a group of
any number of copies moves one text per task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from wellmart.session import ensure_checkpoint_dir

from .common import LOWER, shared_table

RULE_VERSION = "v1"

#: All hex digits become one byte, so a long run is found by a plain search.
_HEX = bytes(104 if chr(c) in "0123456789abcdef" else 46 for c in range(256))

# Kinds in order, pattern, least length of the match or of its group 2.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones drop out
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{30,}")
SLACK = re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+")
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("github", "slack", "jwt", "pem")


def find_spans(text: str | None, data: bytes | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed. Literal searches decide which patterns run."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass") if data is None else data
    low = data.translate(LOWER)
    out = []
    if any(w in low for w in (b"passw", b"secret", b"token", b"apikey", b"api_key")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in data:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if b"h" * 16 in data.translate(_HEX):
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    for kind, mark, pattern in (("github", b"gh", GITHUB), ("slack", b"xox", SLACK), ("jwt", b"eyJ", JWT), ("pem", b"-----BEGIN", PEM)):
        if mark in data:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:long,end:long>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


#: As many unseen addresses (32 bytes each) are broadcast at most.
BROADCAST_BLOBS = 100_000


class BlobLedger:
    """Findings by blob and rule version under ``path`` (shared storage); one folder per rule version."""

    def __init__(self, spark: SparkSession, path: str, rule_version: str = RULE_VERSION,
                 rules: Callable[[str | None, bytes | None], list] = find_spans):
        self.spark, self.rules = spark, rules
        self.table = f"{path.rstrip('/')}/rules={rule_version}"

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(f"blob binary, spans {SPANS}").parquet(self.table)
        except AnalysisException:  # nothing scanned under this version yet
            return self.spark.createDataFrame([], f"blob binary, spans {SPANS}")

    def findings(self) -> DataFrame:
        """One row a blob with findings; two writers may have entered it, with the same findings."""
        return self.read().where(F.size("spans") > 0).dropDuplicates(["blob"])

    def unseen(self, versions: DataFrame) -> DataFrame:
        """One (blob, text) for each blob of ``versions`` that the ledger lacks.

        The addresses are compared first. Few unseen ones are broadcast, so the
        texts of known blobs never leave their task; with more of them one text
        a task and blob moves, and the join finds it in place.
        """
        new = shared_table(versions.select("blob").distinct().join(self.read().select("blob"), "blob", "left_anti"), "blobs-unseen")
        few = new.count() <= BROADCAST_BLOBS
        if few:
            versions = versions.join(F.broadcast(new), "blob", "left_semi")
        one = versions.groupBy("blob").agg(F.first("text").alias("text"))
        return one if few else one.join(new, "blob", "left_semi")

    def update(self, versions: DataFrame) -> None:
        """Scan the blobs of ``versions`` (blob, text) that the ledger lacks, and append them."""
        unseen = self.unseen(versions)
        rules = self.rules

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data = b.column("text").cast(pa.binary()).to_pylist()
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in rules(t, d)] for t, d in zip(b.column("text").to_pylist(), data)]
                yield pa.RecordBatch.from_arrays([b.column("blob"), pa.array(spans, _ARROW)], names=["blob", "spans"])

        unseen.mapInArrow(run, f"blob binary, spans {SPANS}").write.mode("append").parquet(self.table)


def address(text) -> F.Column:
    """SHA-256 of the content; a null text is an empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def scan(versions: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, blob, spans`` of every row; only blobs new to the ledger are read by the rules."""
    keyed = versions.select(F.col(id_col).alias("doc_id"), address(F.col(text_col)).alias("blob"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ledger.update(keyed.select("blob", "text"))
    # Most blobs have none: the join's small side. Written, so that Spark can broadcast it or split a hot blob's paths.
    found = shared_table(ledger.findings(), "blobs-findings")
    return keyed.select("doc_id", "blob").join(found, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def new_ledger(spark: SparkSession) -> BlobLedger:
    """An empty ledger in the session's shared folder."""
    return BlobLedger(spark, f"{ensure_checkpoint_dir(spark)}/wellmart/blobs-{uuid.uuid4().hex}")


def secret_digest(docs: DataFrame, ledger: BlobLedger | None = None) -> DataFrame:
    """The scan as counts, the base kinds' SHA-256 and all spans as text, one row per input row."""
    found = scan(docs, ledger or new_ledger(docs.sparkSession))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
