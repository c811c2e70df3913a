"""Q1-Q11: declarative data-quality checks.

All single-column checks of one table (not_null, accepted_values,
accepted_range, expression rules) are folded into ONE aggregation pass;
``unique`` and ``relationships`` each need one shuffle.  A check passes when
it finds zero failing rows; ``failing_rows`` returns the rows themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class Check:
    kind: str                      # not_null | unique | accepted_values | accepted_range | relationships | expression
    column: str | list | None = None
    severity: str = "error"        # error | warn
    values: list | None = None     # accepted_values
    min_value: object = None       # accepted_range (inclusive)
    max_value: object = None
    to: DataFrame | None = None    # relationships parent table
    to_field: str | None = None
    predicate: Column | None = None  # expression: TRUE marks a failing row
    name: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        col = self.column if isinstance(self.column, str) else "_".join(self.column or [])
        return f"{self.kind}_{col}"


def not_null(col, severity="error"):
    return Check("not_null", col, severity)


def unique(col, severity="error"):
    return Check("unique", col, severity)


def accepted_values(col, values, severity="error"):
    return Check("accepted_values", col, severity, values=list(values))


def accepted_range(col, min_value=None, max_value=None, severity="error"):
    return Check("accepted_range", col, severity, min_value=min_value, max_value=max_value)


def relationships(col, to: DataFrame, to_field: str, severity="error"):
    return Check("relationships", col, severity, to=to, to_field=to_field)


def expression(name, failing: Column, severity="error"):
    return Check("expression", None, severity, predicate=failing, name=name)


def failing_predicate(chk: Check) -> Column | None:
    """Row-level failing condition for single-pass checks (NULL passes
    accepted_values / accepted_range, as the warehouse tests do)."""
    if chk.kind == "not_null":
        return F.col(chk.column).isNull()
    if chk.kind == "accepted_values":
        c = F.col(chk.column)
        return c.isNotNull() & ~c.isin(*chk.values)
    if chk.kind == "accepted_range":
        c = F.col(chk.column)
        bad = F.lit(False)
        if chk.min_value is not None:
            bad = bad | (c < F.lit(chk.min_value))
        if chk.max_value is not None:
            bad = bad | (c > F.lit(chk.max_value))
        return c.isNotNull() & bad
    if chk.kind == "expression":
        return F.coalesce(chk.predicate, F.lit(False))
    return None


def failing_rows(df: DataFrame, chk: Check) -> DataFrame:
    """The rows a check reports (zero rows = pass)."""
    pred = failing_predicate(chk)
    if pred is not None:
        return df.filter(pred)
    if chk.kind == "unique":
        cols = [chk.column] if isinstance(chk.column, str) else list(chk.column)
        nn = F.lit(True)
        for c in cols:
            nn = nn & F.col(c).isNotNull()
        return (df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
                  .filter(F.col("n_records") > 1))
    if chk.kind == "relationships":
        parent = chk.to.select(F.col(chk.to_field).alias("_fl_parent")).distinct()
        child = df.filter(F.col(chk.column).isNotNull())
        return child.join(parent, child[chk.column] == parent["_fl_parent"], "left_anti")
    raise ValueError(chk.kind)


def run_checks(df: DataFrame, checks: list[Check], table: str = "table") -> DataFrame:
    """One row per check: table, check_name, kind, severity, failing_rows, status."""
    single = [c for c in checks if failing_predicate(c) is not None]
    parts = []
    if single:
        agg = df.agg(*[F.count_if(failing_predicate(c)).alias(f"_q{i}") for i, c in enumerate(single)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(c.check_name).alias("check_name"), F.lit(c.kind).alias("kind"),
                     F.lit(c.severity).alias("severity"), F.col(f"_q{i}").cast("long").alias("failing_rows"))
            for i, c in enumerate(single)]))
        parts.append(agg.select(rows.alias("_r")).select("_r.*"))
    for c in checks:
        if c in single:
            continue
        fr = failing_rows(df, c)
        parts.append(fr.agg(F.count(F.lit(1)).cast("long").alias("failing_rows")).select(
            F.lit(c.check_name).alias("check_name"), F.lit(c.kind).alias("kind"),
            F.lit(c.severity).alias("severity"), "failing_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failing_rows") == 0, "pass")
               .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return out.select(F.lit(table).alias("table_name"), "check_name", "kind", "severity", "failing_rows",
                      status.alias("status"))


def freshness(df: DataFrame, ts_col: str, now, warn_after_days: int, error_after_days: int,
              source: str = "source") -> DataFrame:
    """Q10: newest load vs an injected ``now`` -> pass / warn / error."""
    now_c = F.lit(now).cast(df.schema[ts_col].dataType.simpleString()) if not isinstance(now, Column) else now
    agg = df.agg(F.max(ts_col).alias("max_loaded_at"))
    # difference of the wall-clock values themselves: no session time zone (and
    # no DST hour) enters a timestamp_ntz difference
    age_us = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now_c)
    age_days = age_us / 86400000000.0
    return agg.select(F.lit(source).alias("source"), "max_loaded_at",
                      (age_us / 3600000000.0).alias("age_hours"),
                      F.when(F.col("max_loaded_at").isNull(), "error")
                       .when(age_days > error_after_days, "error")
                       .when(age_days > warn_after_days, "warn").otherwise("pass").alias("status"))
