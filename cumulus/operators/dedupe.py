"""Deduplication and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# tasks that a key's rows are dealt to before the last one picks
SPREAD = 64


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                descending: bool = False) -> DataFrame:
    """Keep one row per key: the first by ``order`` (then by every other column).

    The order is total, so the choice does not depend on partitioning.  Rows
    are dealt by key and a spread first, so that a task sorts a shuffle
    partition, not all that it reads of a file.  The planner puts a partial
    WindowGroupLimit before the shuffle by key: of a key that holds a large
    share of the rows each of ``SPREAD`` tasks sends one row.
    Ascending puts NULLs first, descending puts them last.  Every column must
    be orderable (no map columns).
    """
    keys = list(keys)
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order + rest]
    return deduplicate_window(df.repartition(*keys, F.spark_partition_id() % SPREAD), keys, by or [F.lit(1)])


def deduplicate_window(df: DataFrame, keys: Sequence[str], order_cols) -> DataFrame:
    """``row_number() = 1`` form, for orders mixing directions."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE: updates replace matching rows.

    Anti-join + union.  Write the result to a new location (or a dynamic
    partition overwrite); never overwrite the path being read.
    """
    keys = list(keys)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))
