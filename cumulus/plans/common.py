"""Shared parameters of the registered queries."""

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulus.session import shared_path

# The daily partition the day-by-day operators process (last day of the
# events table at every scale factor); the backfill forms cover all history.
DS = "2024-01-30"
PREV_DS = "2024-01-29"
MONTH_START = "2024-01-01"
# rows of a fact that one task sorts or groups, where their bytes in a shuffle say too little
ROWS_A_TASK = 1 << 18


def tasks_for(frames: Sequence[DataFrame], least: int) -> int:
    """Number of tasks for the largest of ``frames`` (counted from file footers where they are plain scans)."""
    return max(least, *(-(-df.count() // ROWS_A_TASK) for df in frames))


@contextmanager
def scratch_table(spark: SparkSession, stem: str) -> Iterator[str]:
    """Name of a catalogue table that is dropped at the end."""
    name = f"{stem}_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored(df: DataFrame, stem: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = shared_path(df.sparkSession, f"{stem}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ints_text(arr):
    """array<bigint> -> '1,0,3' (NULL elements as 'null')."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",", "null")


def dates_text(arr):
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")
