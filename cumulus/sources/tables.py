"""Readers for the warehouse tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with an explicit schema (inference costs a full extra pass at scale)."""
    r = spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def list_columns(df: DataFrame) -> DataFrame:
    """Catalogue lookup (column name, position, type) for a DataFrame's schema.

    The schema lives on the driver already; the result is a tiny frame of
    one row per column, the shape of ``information_schema.columns``.
    """
    spark = df.sparkSession
    rows = [(f.name, i + 1, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, ordinal_position int, data_type string, is_nullable boolean")
