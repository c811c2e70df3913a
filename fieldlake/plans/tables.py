"""Reading the driver's parquet tables (column pruning and predicate
pushdown reach the scan through Catalyst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Tables whose size is fixed by the data model (TPC-H: 5 regions, 25 nations),
# hence safe to broadcast at any scale.
FIXED_SIZE_TABLES = {"region": 5, "nation": 25}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
