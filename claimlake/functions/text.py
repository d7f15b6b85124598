"""String helpers used across layers (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_name(c) -> Column:
    """Field-name normaliser: non-alphanumerics to blank, lower case, trimmed."""
    return F.trim(F.lower(F.regexp_replace(_col(c), "[^a-zA-Z0-9]", " ")))


def file_type(c) -> Column:
    """File type by case-insensitive suffix pattern.

    ``%.CSV%`` matches ``.csv.gz`` too; ``.xlsx``/``.xls`` are EXCEL.
    """
    u = F.upper(_col(c))
    return (F.when(u.like("%.CSV%"), F.lit("CSV"))
            .when(u.like("%.XLSX") | u.like("%.XLS"), F.lit("EXCEL"))
            .otherwise(F.lit("UNKNOWN")))


def first_segment(c) -> Column:
    """Tenant code = first path segment of a stage-relative path."""
    return F.split_part(_col(c), F.lit("/"), F.lit(1))


def basename(c) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)


def ratio(num, den) -> Column:
    """num / NULLIF(den, 0) as a double (NULL when den is 0 or NULL)."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    return F.when(d != 0, n / d)


def pct(num, den, digits: int = 1) -> Column:
    """Percentage rounded half-up (used only for counts, never for money)."""
    return F.round(ratio(num, den) * 100, digits)


def truncate(c, n: int) -> Column:
    return F.substring(_col(c), 1, n)
