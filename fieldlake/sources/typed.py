"""Typed CSV with drift-tolerant projection, seeds, CSV sink."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

log = logging.getLogger("fieldlake.sources")


def select_available(df: DataFrame, wanted, case_insensitive: bool = True) -> DataFrame:
    """Keep the wanted columns that exist (in wanted order), warn on missing."""
    have = {c.lower() if case_insensitive else c: c for c in df.columns}
    cols, missing = [], []
    for w in wanted:
        key = w.lower() if case_insensitive else w
        if key in have:
            cols.append(F.col(f"`{have[key]}`").alias(w))
        else:
            missing.append(w)
    if missing:
        log.warning("columns missing and skipped: %s", ", ".join(missing))
    return df.select(*cols)


def resolve_column(df: DataFrame, candidates) -> str | None:
    """First candidate name present in the frame (case-insensitive)."""
    lower = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c.lower() in lower:
            return lower[c.lower()]
    return None


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with up to hundreds of columns; only ``schema``'s
    columns are kept (by name, case-insensitive), cast to fixed types; empty
    fields are NULL; IDs stay strings.  Missing columns are skipped with a
    warning and the result carries only what exists.  The CSV parser prunes
    unused columns, so the other columns are never converted."""
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
           .option("nullValue", "").option("inferSchema", False).csv(path))
    kept = select_available(raw, [f.name for f in schema.fields])
    types = {f.name: f.dataType for f in schema.fields}
    return kept.select(*[F.col(c).cast(types[c]).alias(c) for c in kept.columns])


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Version-controlled CSV dimension with declared types (quote-aware:
    names containing commas stay one field)."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .schema(schema).csv(path))


def csv_sink(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header."""
    df.write.mode(mode).option("header", True).csv(path)


def filter_contains_if_present(df: DataFrame, candidates, needle: str) -> DataFrame:
    """P20: keep rows whose type-code column contains ``needle``; when no
    candidate column exists the filter is skipped (with a warning)."""
    col = resolve_column(df, candidates)
    if col is None:
        log.warning("no column among %s; substring filter skipped", list(candidates))
        return df
    return df.filter(F.col(f"`{col}`").contains(needle))
