"""Line deduplication over levelled sorted runs of line hashes, DataFrame functions only.

Documents are taken in batches of ascending id.  A batch's distinct line
hashes are merge-anti-joined with every sorted run so far; those not found are
new, owned by their smallest document in the batch, and written as a run of
level 0.  ``fan_in`` runs of one level are compacted into one of the next.
Runs are bucketed and sorted by hash, so the anti-joins read them without a
shuffle.  A line stays where its document owns its hash.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
A-Z lower-cased; keys under ``min_chars`` code points always stay.  A key is
identified by two 64-bit hashes.  The final join is on (hash, owner), so the
lines of a very frequent key spread over all partitions.

Defined cases: a null or empty text is one empty line; rows with a null id
take no part and stay whole; rows repeating an id count as one document, each
deduplicated by its own lines; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import (ASCII_SPACE, carried, let, quantile_bounds, range_of, scratch_path,
                                shuffle_partitions)

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, other letters left; texts of ASCII alone take the faster way."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


class LineRuns:
    """The levelled runs: tables of (h1, h2, owner), bucketed and sorted by (h1, h2), hashes disjoint."""

    def __init__(self, spark, fan_in: int = FAN_IN):
        self.spark, self.fan_in, self.levels = spark, fan_in, []
        self.buckets = shuffle_partitions(spark)

    def _write(self, df: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.format("parquet").option("path", scratch_path(self.spark, "line-run"))
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name))
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Add the hashes of ``batch`` (h1, h2, id) that no run holds, then compact full levels."""
        new = batch.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
        for run in self.runs():
            new = new.join(run.hint("merge"), ["h1", "h2"], "left_anti")
        self._push(0, self._write(new))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            merged, self.levels[level] = self.levels[level], []
            whole = merged[0]
            for other in merged[1:]:
                whole = whole.unionByName(other)
            self._push(level + 1, self._write(whole.repartition(self.buckets, "h1", "h2")))

    def owners(self) -> DataFrame:
        runs = self.runs()
        whole = runs[0]
        for run in runs[1:]:
            whole = whole.unionByName(run)
        return whole


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, row, pos, h1, h2) of every line with a key of at least ``min_chars``; input columns id, row, text."""
    lines = docs.select("id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("id", "row", "pos", F.btrim("line", F.lit(ASCII_SPACE)).alias("line"))
    lines = lines.where(F.char_length("line") >= min_chars).select("id", "row", "pos", ascii_lower(F.col("line")).alias("key"))
    return lines.select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dedup_lines(docs: DataFrame, id_col="doc_id", text_col="text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and n_lines (before) and n_dropped.

    Input columns named n_lines or n_dropped are replaced.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
    bounds = quantile_bounds(ids, F.col("id"), batches)
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(text).alias("row"), text.alias("text"))
    if bounds:
        lines = line_hashes(rows.where("id IS NOT NULL"), min_chars).withColumn("batch", range_of(F.col("id"), bounds))
        path = scratch_path(spark, "lines")
        lines.write.partitionBy("batch").parquet(path)
        lines = spark.read.schema(lines.schema).parquet(path)
        runs = LineRuns(spark, fan_in)
        for b in range(len(bounds)):
            runs.add(lines.where(F.col("batch") == b))
        owners = runs.owners().withColumnRenamed("owner", "id")
        drops = (lines.join(owners, ["h1", "h2", "id"], "left_anti")
                 .groupBy("id", "row").agg(F.collect_set("pos").alias("drops")))
        rows = rows.join(drops.hint("shuffle_hash"), ["id", "row"], "left")
    else:
        rows = rows.withColumn("drops", F.lit(None).cast("array<int>"))

    def without(ls):
        kept = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("drops"))
        return F.array_join(F.transform(kept, lambda i: F.get(ls, i)), "\n")

    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), without))
    # counted without splitting again: line breaks are one byte and one code point
    n_lines = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    keep = carried(docs, [text_col, "n_lines", "n_dropped"])
    return rows.select(*[F.col("doc")[c].alias(c) for c in keep], kept.alias(text_col),
                       n_lines.cast("long").alias("n_lines"),
                       F.coalesce(F.array_size("drops"), F.lit(0)).cast("long").alias("n_dropped"))
