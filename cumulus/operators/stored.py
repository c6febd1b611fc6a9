"""Changes to stored tables that read and rewrite only the partitions they touch.

A stored table is a partitioned Parquet table of the catalogue.  A change is
computed from the partitions it touches and written by dynamic partition
overwrite: files of other partitions are neither read nor written (they keep
their names).  Spark writes to a staging folder and swaps partitions when the
job commits, so the rows being replaced can be read meanwhile.  A touched
partition that ends up without rows is dropped after the write; if the job is
lost in between, running the same change again completes it.

* ``upsert_partitions``   INSERT ... ON CONFLICT (keys) DO UPDATE
* ``replace_partitions``  a day, or any other set of partitions, loaded anew
* ``create_history`` / ``merge_history`` / ``history_rows``   SCD type 2 whose
  open rows are one partition and whose closed rows are partitioned by the
  period that closed them
* ``month_of`` / ``write_by_month`` / ``between_days``   a partition column
  derived from a date, and date ranges translated to it
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cumulus.functions.columns import distinct_from
from cumulus.operators.dedupe import upsert

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
CLOSED_IN = "closed_in"  # the period that closed a row; NULL: the row is open


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def dynamic_overwrite(spark: SparkSession):
    """INSERT OVERWRITE replaces only partitions that get rows."""
    return setting(spark, OVERWRITE_MODE, "dynamic")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def in_partitions(parts: Sequence[str], values: Sequence[tuple]) -> Column:
    """Condition on the partition columns ``parts`` alone, so that only these partitions are listed and scanned."""
    head, *rest = parts
    by_head: dict = {}
    for v, *tail in values:
        by_head.setdefault(v, []).append(tuple(tail))
    if not rest:
        named = [v for v in by_head if v is not None]
        cond = F.col(head).isin(named) if named else F.lit(False)
        return cond | F.col(head).isNull() if None in by_head else cond
    each = [(F.col(head).isNull() if v is None else F.col(head) == F.lit(v)) & in_partitions(rest, tails)
            for v, tails in by_head.items()]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def drop_partitions(spark: SparkSession, table: str, parts: Sequence[str], values: Sequence[tuple]) -> None:
    """DROP PARTITION for each of ``values``; of a managed table the files go with it."""
    def text(part: str, value) -> str:
        quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"`{part}` = null" if value is None else f"`{part}` = '{quoted}'"

    for v in values:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({', '.join(map(text, parts, v))})")


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A partition number that a key never leaves (NULL keys included)."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_partitions(table: str, updates: DataFrame, keys: Sequence[str], keys_move: bool = True) -> list[tuple]:
    """Rows of ``updates`` replace the rows of ``table`` with equal ``keys``, or are added.

    Touched are the partitions that hold one of the keys and those that the
    updates go to.  The first are found by one scan of keys and partition
    columns; ``keys_move=False`` says that the partition follows from the key
    (``key_bucket``), so the updates name all of them and nothing is scanned.
    ``updates`` holds a key once; a key with a NULL matches nothing and is
    added.  Returns the touched partitions; that list, at most one entry a
    partition, is all that reaches the driver.
    """
    spark, keys = updates.sparkSession, list(keys)
    parts = partition_columns(spark, table)
    target = spark.table(table)
    goes = updates.select(*parts).distinct()
    emptied: list[tuple] = []
    touched = {tuple(r) for r in goes.collect()}
    if keys_move:
        asked = updates.select(*keys).distinct().withColumn("_asked", F.lit(True))
        only_keys = target.select(*dict.fromkeys([*keys, *parts]))
        held = only_keys.join(asked, keys, "left").groupBy(*parts).agg(
            F.count("_asked").alias("replaced"), F.count_if(F.col("_asked").isNull()).alias("kept")).where("replaced > 0")
        for *values, _, kept in held.collect():
            if not kept and tuple(values) not in touched:
                emptied.append(tuple(values))
            touched.add(tuple(values))
    if not touched:
        return []
    rows = upsert(target.where(in_partitions(parts, list(touched))), updates, keys)
    with dynamic_overwrite(spark):
        rows.select(*target.columns).write.insertInto(table, overwrite=True)
    drop_partitions(spark, table, parts, emptied)
    return sorted(touched, key=str)


def replace_partitions(table: str, rows: DataFrame, scope: Column) -> None:
    """``rows`` become the content of all partitions in ``scope`` (a condition on the partition columns):
    partitions that get rows are overwritten, the others of the scope are dropped.

    ``rows`` are computed once; how many went to each partition that was there is counted as they are written.
    """
    spark, parts = rows.sparkSession, partition_columns(rows.sparkSession, table)
    target = spark.table(table)
    old = [tuple(r) for r in target.where(scope).select(*parts).distinct().collect()]
    made = Observation()
    rows = rows.select(*target.columns).observe(
        made, F.count(F.lit(1)).alias("all"), *[F.count_if(in_partitions(parts, [p])).alias(f"p{i}") for i, p in enumerate(old)])
    with dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)
    drop_partitions(spark, table, parts, [p for i, p in enumerate(old) if not made.get[f"p{i}"]])


# --- slowly changing dimensions with open and closed partitions ---------------

def create_history(spark: SparkSession, table: str, snapshot: DataFrame, key: str, attrs: Sequence[str], period,
                   start_col: str = "start_date", end_col: str = "end_date") -> None:
    """A history table that begins with ``snapshot``: one open row a key, from ``period`` on.

    Open rows have a NULL end.  Stored columns: key, attributes, start, end, and the partition column ``closed_in``.
    """
    p = F.lit(period)
    rows = snapshot.select(key, *attrs, p.alias(start_col))
    kind = rows.schema[start_col].dataType
    null = F.lit(None).cast(kind)
    rows.select("*", null.alias(end_col), null.alias(CLOSED_IN)).write.format("parquet").partitionBy(CLOSED_IN).saveAsTable(table)


def merge_history(table: str, snapshot: DataFrame, key: str, attrs: Sequence[str], prev_period, period,
                  start_col: str = "start_date", end_col: str = "end_date", missing_closes: bool = True) -> None:
    """Merge the snapshot of ``period`` into a history that runs through ``prev_period``.

    Reads the open partition and, if the period was merged before, the one
    that it closed; writes the open partition and the period's closed one.
    History closed earlier is not read.  A changed key's row ends at
    ``prev_period`` and a new one opens; a key that is missing ends too, or
    stays open if not ``missing_closes`` (snapshots of changes alone).
    Merging the last period again replaces it: what it opened goes, what it
    closed is open again, first.  An earlier period than the last cannot be
    merged again.  Attributes compare NULL-safely; a NULL key matches no
    other, so each merge ends it and opens it anew.
    """
    spark = snapshot.sparkSession
    stored = spark.table(table)
    kind = stored.schema[CLOSED_IN].dataType
    now, before = F.lit(period).cast(kind), F.lit(prev_period).cast(kind)
    later = stored.where((F.col(CLOSED_IN) > now) | (F.col(CLOSED_IN).isNull() & (F.col(start_col) > now)))
    if not later.isEmpty():
        raise ValueError(f"{table}: a later period than {period} is merged already")
    # as of the previous period
    open_ = stored.where((F.col(CLOSED_IN).isNull() | (F.col(CLOSED_IN) == now)) & (F.col(start_col) <= before)).select(
        key, *[F.col(a).alias(f"_o_{a}") for a in attrs], F.col(start_col).alias("_o_s"), F.lit(True).alias("_old"))
    both = open_.join(snapshot.select(key, *attrs, F.lit(True).alias("_new")), key, "full_outer")
    changed = reduce(lambda a, b: a | b, [distinct_from(F.col(a), F.col(f"_o_{a}")) for a in attrs], F.lit(False))
    null = F.lit(None).cast(kind)

    def row(attr, start, end, closed) -> Column:
        return F.struct(*[F.col(attr.format(a)).alias(a) for a in attrs], start.alias(start_col), end.alias(end_col),
                        closed.alias(CLOSED_IN))

    keep, close = row("_o_{}", F.col("_o_s"), null, null), row("_o_{}", F.col("_o_s"), before, now)
    begin = row("{}", now, null, null)
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    rows = (F.when(old & new & ~changed, F.array(keep)).when(old & new, F.array(close, begin))
             .when(new, F.array(begin)).otherwise(F.array(close if missing_closes else keep)))
    made = Observation()
    merged = both.select(key, F.explode(rows).alias("_r")).select(key, "_r.*").select(*stored.columns).observe(
        made, F.count_if(F.col(CLOSED_IN).isNull()).alias("open"), F.count_if(F.col(CLOSED_IN).isNotNull()).alias("closed"))
    with dynamic_overwrite(spark):
        merged.write.insertInto(table, overwrite=True)
    empty = [v for name, v in (("open", None), ("closed", period)) if not made.get[name]]
    drop_partitions(spark, table, [CLOSED_IN], [(v,) for v in empty])


def history_rows(spark: SparkSession, table: str, period, key: str, attrs: Sequence[str],
                 start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """(key, attributes, start, end) of all rows; those still open end at ``period``, the last one merged."""
    t = spark.table(table)
    return t.select(key, *attrs, start_col, F.coalesce(end_col, F.lit(period).cast(t.schema[end_col].dataType)).alias(end_col))


# --- a partition column derived from a date -------------------------------------

def month_of(date_col: str) -> Column:
    """First day of the month, the value of the derived partition column."""
    return F.trunc(F.to_date(date_col), "MM")


def write_by_month(df: DataFrame, path: str, date_col: str, month_col: str) -> None:
    """Store ``df`` by the month of ``date_col``; a month is dealt over as many tasks as AQE finds its bytes need."""
    (df.withColumn(month_col, month_of(date_col)).repartition(month_col)
       .write.partitionBy(month_col).parquet(path))


def between_days(date_col: str, month_col: str, first, last) -> Column:
    """``date_col`` from ``first`` to ``last``, both included, with the same range of the derived column beside it:
    a condition on the date alone would open every partition."""
    a, b = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    return (F.col(date_col).between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))
            & F.col(month_col).between(F.trunc(a, "MM"), F.trunc(b, "MM")))
