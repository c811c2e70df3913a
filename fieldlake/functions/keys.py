"""K1: deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import KEY_SEPARATOR, NULL_KEY_PLACEHOLDER


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols, placeholder: str = NULL_KEY_PLACEHOLDER) -> Column:
    """md5 of the columns cast to string, NULL replaced by a placeholder,
    joined by '-'.  Key only on int/string/date/timestamp columns: double to
    string differs between engines (1.0E7 vs 10000000.0)."""
    if len(cols) == 1 and isinstance(cols[0], (list, tuple)):
        cols = tuple(cols[0])
    parts = [F.coalesce(_c(c).cast("string"), F.lit(placeholder)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
