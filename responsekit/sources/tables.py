"""Parquet table access for the driver's star schema.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers select what they use and nothing else is read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Expose the tables as temp views for ``spark.sql``."""
    for name in names or TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
