"""Zone maps: the range of chosen columns in every file of a written table, and reads that skip files by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def zone_map(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row a file: file, n_rows, n_bytes and per column its least and largest value and number of NULLs.

    One scan of the chosen columns, reduced on the map side to a row a file and task.
    """
    files = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("n_bytes"), *columns)
    ranges = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    return files.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.max("n_bytes").alias("n_bytes"), *ranges, *nulls)


def matching_files(zones: DataFrame, ranges: dict[str, tuple]) -> list[str]:
    """Files whose ranges meet all of ``ranges`` (column: (least, largest), None: no bound on that side).

    A file without a value of a column cannot match.  Names of matching files reach the driver, as any file listing does.
    """
    meets = F.lit(True)
    for c, (low, high) in ranges.items():
        if low is not None:
            meets = meets & F.coalesce(F.col(f"max_{c}") >= F.lit(low), F.lit(False))
        if high is not None:
            meets = meets & F.coalesce(F.col(f"min_{c}") <= F.lit(high), F.lit(False))
    return sorted(r["file"] for r in zones.where(meets).select("file").collect())


def read_matching(spark: SparkSession, path: str, zones: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Rows of the table within ``ranges``; only files that can hold one are opened."""
    files = matching_files(zones, ranges)
    whole = spark.read.parquet(path)
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
    for c, (low, high) in ranges.items():
        if low is not None:
            rows = rows.where(F.col(c) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(c) <= F.lit(high))
    return rows
