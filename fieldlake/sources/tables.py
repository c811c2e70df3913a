"""Load audit, clustered writes, materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_audit(df: DataFrame, year_col: str | None = None, since_year: int = 2000) -> DataFrame:
    """Row count (never trust a writer's count) and year coverage in one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if year_col:
        aggs += [F.min(year_col).alias("min_year"), F.max(year_col).alias("max_year"),
                 F.count_if(F.col(year_col) >= since_year).alias(f"n_since_{since_year}")]
    return df.agg(*aggs)


def clustered_write(df: DataFrame, path: str, cluster_cols, partition_cols=None, n_files: int | None = None,
                    mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Range-partition and sort by the clustering keys so Parquet
    min/max statistics let later filters skip row groups and files."""
    cluster_cols = [cluster_cols] if isinstance(cluster_cols, str) else list(cluster_cols)
    out = df.repartitionByRange(n_files, *cluster_cols) if n_files else df.repartitionByRange(*cluster_cols)
    out = out.sortWithinPartitions(*cluster_cols)
    w = out.write.mode(mode).format(fmt)
    if partition_cols:
        w = w.partitionBy(*([partition_cols] if isinstance(partition_cols, str) else partition_cols))
    w.save(path)


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str = "view",
                path: str | None = None) -> DataFrame:
    """``view`` -> lazy temp view (Catalyst fuses it into consumers);
    ``table`` -> written to ``path`` once and re-read, for inputs several
    consumers share."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path is None:
        raise ValueError("a table needs a path")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def bucketed_table(df: DataFrame, name: str, keys, n_buckets: int, sort: bool = True,
                   mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as a catalog table bucketed (and sorted) by ``keys``.
    Two tables bucketed the same way on their join key join -- and aggregate
    on that key -- without a shuffle, which pays off for facts that are joined
    repeatedly (e.g. trees to plots on ``plot_cn``).  Needs a catalog
    (``saveAsTable``); returns the table."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = df.write.mode(mode).format(fmt).bucketBy(n_buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(name)
    return df.sparkSession.table(name)
