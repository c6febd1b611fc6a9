"""Day-by-day driver for the step operators.

Each day's snapshot is written under the shared checkpoint folder and read
back, so the lineage of day N never contains days 1..N-1 and a lost
executor only recomputes the current day.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from cumulus.session import shared_path


def fold_days(spark: SparkSession, step: Callable[[DataFrame, str], DataFrame], initial: DataFrame,
              days: Iterable[str], name: str, keep_all: bool = False) -> DataFrame:
    """Apply ``step(snapshot, ds)`` for each ``ds`` in order.

    Returns the last snapshot, or (``keep_all``) every day's snapshot read
    back as one frame partitioned by ``ds``.  Every run writes to a folder of
    its own, so days of an earlier run under the same name never come back.
    """
    snap = initial
    root = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    for ds in days:
        path = f"{root}/ds={ds}"
        step(snap, ds).write.mode("overwrite").parquet(path)
        snap = spark.read.parquet(path)
    return spark.read.parquet(root) if keep_all else snap
