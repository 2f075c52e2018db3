"""Catalog of the generated driver tables (one Parquet file each).

Reading is lazy; Catalyst prunes columns and pushes filters into each scan,
so a derivation that needs two columns of ``lineitem`` reads two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class DriverTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def register_views(self) -> None:
        """Expose every table as a temp view of the same name (SQL access)."""
        for name in DRIVER_TABLES:
            getattr(self, name).createOrReplaceTempView(name)
