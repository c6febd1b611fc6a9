"""Exact distinct counts that merge.

The ids seen are kept as bitmaps: an id is a bit of a bucket (32,768 ids), so
a state row is (keys, bucket, bitmap) and two states merge by OR.  Counts over
any span of days, or over coarser keys, come from the daily states alone; the
raw rows are never read again.  Ids are any longs: bucket and position follow
from ``bitmap_bucket_number`` and ``bitmap_bit_position``, negative ids
included.  A bitmap has 4 KB whatever it holds, so number ids densely; for
hashed ids a row of 4 KB would hold one bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_state(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """(keys, bucket, bitmap) of the ids of each key; NULL ids are not counted.

    One Exchange; a bucket's bits are set on the map side first, so a key with
    a third of all rows sends a bitmap a bucket and input partition.
    """
    ids = df.where(F.col(id_col).isNotNull())
    return ids.groupBy(*keys, F.bitmap_bucket_number(id_col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bitmap"))


def merge_states(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of finer keys (days, hosts) as states of ``keys``."""
    return state.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_distinct(state: DataFrame, keys: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Distinct ids of ``keys``: buckets are disjoint, so their counts add up."""
    merged = merge_states(state, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
