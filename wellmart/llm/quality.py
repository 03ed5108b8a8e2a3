"""Quality rules as a bitmask ledger, in native expressions only.

``ledger`` evaluates every rule once per row and keeps the measurements and one
long of failure bits. A policy is a named, versioned set of rules, hence a
mask: applying one (``apply_policy``), comparing versions and asking what a
rule does alone (``ablation``) read the ledger's bits, never the texts again.

Repeated windows are found inside the row (sort the windows of the text,
compare neighbours), so no word is ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")

#: Rule name, failing condition over the measurements. The place in the list is the bit; append only.
RULES = (
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("dup_lines", "10 * n_dup_lines > 7 * n_lines"),
    ("shouting", "n_letters > 0 AND 10 * n_upper > 6 * n_letters"),
)
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document is rejected when one of them failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[r] for r in set(self.rules))


BASE = Policy("base", ("too_few_words", "repeated_windows"))
V1 = Policy("v1", BASE.rules + ("many_symbols", "word_length", "dup_lines"))
V2 = Policy("v2", V1.rules + ("shouting",))


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    """Wrap each row as ``row`` and add the measurements of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.trim(F.translate(x, "\t\u000b\f\r", "    ")) != "")
    df = docs.select(F.struct("*").alias("row"), text.alias("_t"))
    df = df.select("row", "_t", F.filter(F.split("_t", SPLIT), lambda x: x != "").alias("_w"), lines.alias("_l"))
    windows = F.when(F.size("_w") < 3, F.array().cast("array<struct<g:string,i:int>>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("g"), i.alias("i"))))
    letters = F.translate("_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    n = F.length("_t")
    df = df.select(
        "row", F.sort_array(windows).alias("_g"),
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        (n - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        (n - F.length(letters)).cast("long").alias("n_upper"),
        (n - F.length(F.translate(letters, "abcdefghijklmnopqrstuvwxyz", ""))).cast("long").alias("n_letters"))
    # Starts of windows whose text stands next to itself in sorted order, in text order.
    twice = F.filter(F.transform("_g", lambda x, k: F.when(
        (F.get("_g", k - 1)["g"] == x["g"]) | (F.get("_g", k + 1)["g"] == x["g"]), x["i"])), lambda i: i.isNotNull())
    df = df.select("row", *[c for c in MEASURES if c != "n_repeat_words"], F.sort_array(twice).alias("_p"))
    # Words covered by those windows: each adds three, less what the one before covers too.
    covered = F.transform("_p", lambda p, k: F.least(F.lit(3), p - F.coalesce(F.get("_p", k - 1), F.lit(-3))))
    covered = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    # One-element explode: the optimizer moves filters and projections no further
    # down, else it would copy the expressions above into each other's lambdas.
    all_ = F.struct(*[(covered.alias(c) if c == "n_repeat_words" else F.col(c)) for c in MEASURES])
    return df.select("row", F.explode(F.array(all_)).alias("m")).select("row", "m.*")


def ledger(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """``row`` (the input row as a struct, so no name clashes), the measurements, ``fail_bits``.

    A null text measures as an empty one: no words, so ``too_few_words`` fails.
    """
    bits = F.lit(0).cast("long")
    for i, (_, failing) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(failing), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return _measured(docs, text_col).select("row", *MEASURES, bits.alias("fail_bits"))


def failed(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``policy`` (its version) and ``kept``."""
    return rows.withColumns({"policy": F.lit(policy.version), "kept": ~failed(policy)})


def kept_rows(docs: DataFrame, policy: Policy = V2, text_col: str = "text") -> DataFrame:
    """The input's rows and columns that ``policy`` keeps."""
    return apply_policy(ledger(docs, text_col), policy).where("kept").select("row.*")


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: rows that fail it, rows that fail it alone (kept if the rule were dropped)."""
    mask = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = rows.groupBy(mask.alias("bits")).agg(F.count("*").alias("n"))  # at most 2 ** rules groups
    names = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit")) for r in policy.rules])
    each = patterns.select("bits", "n", F.explode(names).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"))
