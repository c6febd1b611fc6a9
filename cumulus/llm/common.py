"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulus.session import shared_path

ASCII_SPACE = " \t\n\x0b\f\r"
MIN_LONG = -(2**63)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def carried(df: DataFrame, own: list[str]) -> list[str]:
    """Columns of ``df`` an operator passes through: all but those it returns itself."""
    names = {c.lower() for c in own}
    return [c for c in df.columns if c.lower() not in names]


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it any number of times inside ``body``.

    A name used inside a higher-order function's body may otherwise be inlined
    there and evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def quantile_bounds(df: DataFrame, key: Column, parts: int) -> list[int]:
    """Sorted distinct values of ``key``, the largest included, that cut it into about ``parts``
    equal ranges; empty without rows.  At most ``parts`` numbers reach the driver."""
    cuts = [i / parts for i in range(1, parts)]
    row = df.agg(F.max(key).alias("top"),
                 (F.percentile_approx(key, cuts) if cuts else F.lit(None)).alias("cuts")).first()
    return sorted({*(row["cuts"] or []), row["top"]}) if row["top"] is not None else []


def range_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range of ``key``: how many of the sorted ``bounds`` are smaller (binary search)."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    arr = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda lo, s: F.when((lo + s <= len(bounds)) & (F.get(arr, lo + s - 1) < key), lo + s).otherwise(lo))
