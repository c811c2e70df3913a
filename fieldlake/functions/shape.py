"""P*/F*: typed extraction, decodes, bins, patterns, string hygiene, dates, units."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import (CUBIC_FEET_PER_ACRE_FOOT, LB_PER_TON, SECONDS_PER_DAY,
                         SQ_METERS_PER_ACRE, SQ_METERS_PER_SQ_MILE, PARAMETER_UNITS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- P1-P4: semi-structured extraction ----------------------------------
def json_path(key: str) -> str:
    """Variant path for a top-level key; keys with '/', '.', spaces are quoted."""
    if key.replace("_", "").isalnum():
        return f"$.{key}"
    return "$['" + key.replace("'", "\\'") + "']"


def variant_field(payload, key: str, dtype: str = "string") -> Column:
    """``payload:key::dtype``; missing -> NULL, impossible cast raises."""
    return F.variant_get(_c(payload), json_path(key), dtype)


def try_variant_field(payload, key: str, dtype: str = "double") -> Column:
    """Safe extraction; an unparsable value gives NULL."""
    return F.try_variant_get(_c(payload), json_path(key), dtype)


def try_double(c) -> Column:
    """P3 on a string column: '<0.5' -> NULL."""
    return _c(c).try_cast("double")


def first_present(payload, keys, dtype: str = "string") -> Column:
    """First non-null among alternative keys."""
    return F.coalesce(*[variant_field(payload, k, dtype) for k in keys])


# ---- P6: code -> label ----------------------------------------------------
def decode(c, table, default=None) -> Column:
    """CASE code WHEN .. THEN label .. ELSE default END.

    ``table`` is a list of (code, label) or a (pairs, default) tuple from constants."""
    if isinstance(table, tuple) and len(table) == 2 and isinstance(table[0], list):
        table, default = table
    col = _c(c)
    expr = None
    for code, label in table:
        expr = (F.when(col == F.lit(code), F.lit(label)) if expr is None
                else expr.when(col == F.lit(code), F.lit(label)))
    return expr.otherwise(F.lit(default).cast("string"))


# ---- P7: ordered threshold bins -------------------------------------------
def bin_below(c, bins, else_label=None, null_label=None) -> Column:
    """First ``value < bound`` wins; NULL falls to ``else`` unless null_label."""
    if isinstance(bins, tuple) and len(bins) == 2 and isinstance(bins[0], list):
        bins, else_label = bins
    col = _c(c)
    expr = F.when(col.isNull(), F.lit(null_label)) if null_label is not None else None
    for bound, label in bins:
        expr = F.when(col < bound, label) if expr is None else expr.when(col < bound, label)
    return expr.otherwise(F.lit(else_label))


def bin_at_least(c, bins, else_label=None, null_label=None) -> Column:
    """First ``value >= bound`` wins (largest bound first)."""
    if isinstance(bins, tuple) and len(bins) == 2 and isinstance(bins[0], list):
        bins, else_label = bins
    col = _c(c)
    expr = F.when(col.isNull(), F.lit(null_label)) if null_label is not None else None
    for bound, label in bins:
        expr = F.when(col >= bound, label) if expr is None else expr.when(col >= bound, label)
    return expr.otherwise(F.lit(else_label))


# ---- P8: first-match pattern classification --------------------------------
def classify_contains(c, patterns, default=None) -> Column:
    """Case-insensitive ``ILIKE '%pat%'`` chain, first match wins."""
    if isinstance(patterns, tuple) and len(patterns) == 2 and isinstance(patterns[0], list):
        patterns, default = patterns
    col = _c(c)
    expr = None
    for pat, label in patterns:
        cond = col.ilike(f"%{pat}%")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(default))


# ---- P14: sign-coded timing -------------------------------------------------
def timing_label(measured, event, after="Post-fire", before="Pre-fire", same="Same year") -> Column:
    m, e = _c(measured), _c(event)
    return F.when(m > e, after).when(m < e, before).otherwise(same)


# ---- P15/P16: coercion and string hygiene ---------------------------------
def clean_name(c) -> Column:
    return F.trim(F.upper(_c(c)))


def strip_float_suffix(c) -> Column:
    """'123.0' -> '123' (anchored; N8)."""
    return F.regexp_replace(_c(c), r"\.0$", "")


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


def nan_to_null(c) -> Column:
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def zero_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(0))


# ---- F3/F6: calendar helpers --------------------------------------------------
def water_year(d) -> Column:
    """Oct 1 - Sep 30, named for the calendar year it ends in."""
    col = _c(d)
    return (F.year(col) + F.when(F.month(col) >= 10, 1).otherwise(0)).cast("int")


def decade(y) -> Column:
    return (F.floor(_c(y) / 10) * 10).cast("int")


def days_before(ts, n: int) -> Column:
    """F4 ``dateadd(day, -n, ts)``."""
    return _c(ts) - F.make_dt_interval(F.lit(n))


# ---- F10-F12: units and ratios ----------------------------------------------
def sq_m_to_acres(c) -> Column:
    return _c(c) / SQ_METERS_PER_ACRE


def sq_m_to_sq_miles(c) -> Column:
    return _c(c) / SQ_METERS_PER_SQ_MILE


def lb_to_tons(c) -> Column:
    return _c(c) / LB_PER_TON


def cfs_days_to_acre_feet(c) -> Column:
    return _c(c) * SECONDS_PER_DAY / CUBIC_FEET_PER_ACRE_FOOT


def unit_for_parameter(c) -> Column:
    """USGS parameter code -> unit."""
    m = F.create_map(*[F.lit(x) for kv in PARAMETER_UNITS.items() for x in kv])
    return m[_c(c)]


def relative_difference(a, b) -> Column:
    """F12 ``abs(a-b)/nullif(b,0)``."""
    return F.abs(_c(a) - _c(b)) / F.nullif(_c(b), F.lit(0))


def safe_pct(num, den) -> Column:
    """``num * 100.0 / nullif(den, 0)`` in double."""
    return _c(num).cast("double") * 100.0 / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct_change(new, old) -> Column:
    """``(new - old) / nullif(old, 0) * 100``."""
    return (_c(new) - _c(old)) / F.nullif(_c(old), F.lit(0)) * 100
