"""Column helpers that reproduce the source system's comparison rules.

The jobs were written against a case-insensitive collation where ``=`` ignores
trailing blanks, ``ISNULL`` keeps the type of its first argument and month
arithmetic counts calendar boundaries. Spark's defaults differ on each point,
so every comparison in the jobs goes through these helpers. All of them build
native Column expressions (codegen, no Python per row).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _norm(value: str) -> str:
    return value.rstrip(" ").upper()


def ci(c: Column | str) -> Column:
    """Comparison key: upper case, trailing blanks removed."""
    return F.upper(F.rtrim(_c(c)))


def eq_ci(c: Column | str, value: str) -> Column:
    """``c = 'value'`` under a case-insensitive, trailing-blank-insensitive collation."""
    return ci(c) == F.lit(_norm(value))


def ne_ci(c: Column | str, value: str) -> Column:
    """``c <> 'value'``; NULL stays unknown (three-valued logic)."""
    return ci(c) != F.lit(_norm(value))


def in_ci(c: Column | str, values: Iterable[str]) -> Column:
    return ci(c).isin([_norm(v) for v in values])


def not_in_ci(c: Column | str, values: Iterable[str]) -> Column:
    """``c NOT IN (...)``: a NULL ``c`` yields unknown, so the row is dropped by a filter."""
    return ~in_ci(c, values)


def like_ci(c: Column | str, pattern: str) -> Column:
    """Case-insensitive LIKE. Only ``%`` is used as a wildcard by the jobs.

    Trailing blanks of the value are ignored (pattern characters are not):
    a pattern that does not end in ``%`` is matched against the value with
    its trailing blanks removed; one that does end in ``%`` is unaffected by
    them. Catalyst rewrites ``'%x%'`` / ``'x%'`` / ``'%x'`` into Contains /
    StartsWith / EndsWith, so plain patterns cost one substring search.
    """
    value = _c(c) if pattern.endswith("%") else F.rtrim(_c(c))
    return F.upper(value).like(pattern.upper())


def not_like_ci(c: Column | str, pattern: str) -> Column:
    return ~like_ci(c, pattern)


def is_blank(c: Column | str) -> Column:
    """``c = ''`` with trailing blanks ignored (so ``'  '`` is blank)."""
    return F.rtrim(_c(c)) == F.lit("")


def non_empty(c: Column | str) -> Column:
    """``c IS NOT NULL AND c <> ''``."""
    return _c(c).isNotNull() & ~is_blank(c)


def null_if_ci(c: Column | str, values: Iterable[str]) -> Column:
    """``CASE WHEN c IN (values) THEN NULL ELSE c END`` (sentinel text to NULL)."""
    col = _c(c)
    return F.when(in_ci(col, values), F.lit(None)).otherwise(col)


def null_outside(c: Column | str, low=None, high=None, *, low_inclusive: bool = True,
                 high_inclusive: bool = True) -> Column:
    """Keep ``c`` only strictly inside the bounds.

    ``low_inclusive`` means ``c <= low`` is nulled (else ``c < low``);
    ``high_inclusive`` means ``c >= high`` is nulled (else ``c > high``).
    """
    col = _c(c)
    bad = None
    if low is not None:
        bad = (col <= low) if low_inclusive else (col < low)
    if high is not None:
        hi = (col >= high) if high_inclusive else (col > high)
        bad = hi if bad is None else (bad | hi)
    if bad is None:
        return col
    return F.when(bad, F.lit(None)).otherwise(col)


def typed_null(dtype: str) -> Column:
    """A NULL literal of an explicit type (a bare NULL would be void/int)."""
    return F.lit(None).cast(dtype)


def isnull(a: Column | str, b: Column | str, dtype: str) -> Column:
    """``ISNULL(a, b)``: result has the type of ``a`` (``dtype``), so ``b`` is cast to it."""
    return F.coalesce(_c(a).cast(dtype), _c(b).cast(dtype))


def varchar(c: Column | str, n: int) -> Column:
    """``CONVERT(varchar(n), c)``: string cast, truncated to ``n`` characters."""
    return F.substring(_c(c).cast("string"), 1, n)


def month_boundaries(start: Column | str, end: Column | str) -> Column:
    """``DATEDIFF(MM, start, end)``: number of month boundaries crossed (31 Jan -> 1 Feb = 1)."""
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def add_months_ts(c: Column | str, n: int) -> Column:
    """``DATEADD(MM, n, c)`` on a timestamp: clamps to month end, keeps the time of day."""
    return F.timestamp_add("MONTH", F.lit(n), _c(c))


def any_not_null(*cols: Column | str) -> Column:
    """``a IS NOT NULL OR b IS NOT NULL OR ...`` (COALESCE would need one common type)."""
    return reduce(or_, [_c(c).isNotNull() for c in cols])


def first_non_empty(*cols: Column | str, default: Column | None = None) -> Column:
    """First argument that is neither NULL nor blank, else ``default``."""
    expr = None
    for c in cols:
        expr = F.when(non_empty(c), _c(c)) if expr is None else expr.when(non_empty(c), _c(c))
    return expr if default is None else expr.otherwise(default)


def xml_escape(c: Column | str) -> Column:
    """Entity-escape ``& < >`` and the carriage return as string concatenation through an XML path does."""
    col = _c(c)
    col = F.replace(col, F.lit("&"), F.lit("&amp;"))
    col = F.replace(col, F.lit("<"), F.lit("&lt;"))
    col = F.replace(col, F.lit(">"), F.lit("&gt;"))
    return F.replace(col, F.lit("\r"), F.lit("&#x0D;"))


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """``CASE WHEN num > 0 AND den > 0 THEN num / den END`` in double precision."""
    n, d = _c(num), _c(den)
    return F.when((n > 0) & (d > 0), n.cast("double") / d.cast("double"))


def label_if_total(value: Column | str, total: Column | str, unknown: str = "UNKNOWN") -> Column:
    """Value if the total is known, ``unknown`` if only the total is known, else NULL."""
    v, t = _c(value), _c(total)
    return F.when(v.isNotNull() & t.isNotNull(), v).when(t.isNotNull(), F.lit(unknown))
