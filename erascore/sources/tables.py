"""Reading the parquet tables of a data folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def with_file_position(df: DataFrame, file_col: str = "_file", pos_col: str = "_row") -> DataFrame:
    """Parquet row position as a tie-break: ``(file name, row index in the file)`` from the hidden
    ``_metadata`` column, for "first occurrence wins" rules on data without a unique id."""
    return df.select("*", F.col("_metadata.file_name").alias(file_col), F.col("_metadata.row_index").alias(pos_col))
