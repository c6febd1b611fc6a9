"""Session windows, batch or streaming: the same ``sessionize`` runs on a
``spark.read`` frame or a ``readStream`` frame; only source and sink differ.

Sessions close when no event of the key arrives for ``gap``; an event
exactly ``gap`` after the previous one joins the session.  On a stream the
watermark bounds state: late rows beyond it are dropped, and append mode
emits a session once the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sessionize(events: DataFrame, keys: Sequence[str], time_col: str = "event_time",
               gap: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """(keys..., session_start, session_end, num_events); end = last event + gap."""
    ts = F.col(time_col).cast("timestamp")
    df = events.withColumn("_ts", ts)
    if watermark:
        df = df.withWatermark("_ts", watermark)
    g = df.groupBy(F.session_window("_ts", gap).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("num_events"))
    return g.select(*keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"),
                    "num_events")


def _seconds(ts) -> F.Column:
    """Wall-clock seconds since 1970-01-01 of a timestamp (time-zone free, monotone)."""
    return (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def sessionize_sliced(events: DataFrame, keys: Sequence[str], time_col: str = "event_time",
                      gap_seconds: int = 300, slice_seconds: int = 3600) -> DataFrame:
    """Batch sessionization that does not sort a whole key's events in one task.

    Sessions are first found inside (key, time slice) groups; a slice keeps
    the list of its sessions, at most slice_seconds / gap_seconds + 1 of them
    however many events it holds.  The first session of a slice continues the
    one before when the gap to the previous slice's last event is at most
    ``gap_seconds``, so a running count over the slices of a key numbers its
    sessions and a partial aggregation joins their parts.  What one task sees
    of a key after the first step is bounded by the time span, not by events.
    Same result as ``sessionize`` (end = last event + gap; an event exactly
    one gap later joins the session).

    Plan: one Exchange of the events on (key, slice), one of the slices on key.
    """
    keys = list(keys)
    gap = F.make_interval(secs=F.lit(gap_seconds))
    e = events.filter(F.col(time_col).isNotNull()).select(
        F.struct(*[F.col(k) for k in keys]).alias("_gk"), F.col(time_col).alias("_t"))
    e = e.withColumn("_slice", F.floor(_seconds(F.col("_t")) / F.lit(slice_seconds)))
    w = Window.partitionBy("_gk", "_slice").orderBy("_t")
    brk = (F.lag("_t").over(w).isNull() | (F.col("_t") > F.lag("_t").over(w) + gap)).cast("int")
    local = (e.withColumn("_brk", brk)
              .withColumn("_lid", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("_gk", "_slice", "_lid")
              .agg(F.min("_t").alias("_start"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_n")))
    slices = local.groupBy("_gk", "_slice").agg(
        F.sort_array(F.collect_list(F.struct("_start", "_last", "_n"))).alias("_found"))
    ws = Window.partitionBy("_gk").orderBy("_slice")
    first, last = F.col("_found")[0]["_start"], F.element_at("_found", -1)["_last"]
    slices = slices.withColumn("_joins", F.coalesce(first <= F.lag(last).over(ws) + gap, F.lit(False)).cast("int"))
    earlier = F.sum(F.size("_found") - F.col("_joins")).over(ws.rowsBetween(Window.unboundedPreceding, -1))
    parts = slices.select("_gk", (F.coalesce(earlier, F.lit(0)) - F.col("_joins")).alias("_base"),
                          F.posexplode("_found").alias("_k", "_part"))
    out = (parts.groupBy("_gk", (F.col("_base") + F.col("_k")).alias("_gid"))
                .agg(F.min("_part._start").alias("session_start"), (F.max("_part._last") + gap).alias("session_end"),
                     F.sum("_part._n").alias("num_events")))
    return out.select(*[F.col("_gk")[k].alias(k) for k in keys], "session_start", "session_end", "num_events")


def session_stats(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average events per session (optionally per group) and session count."""
    return sessions.groupBy(*by).agg(F.avg("num_events").alias("avg_events_per_session"),
                                     F.count(F.lit(1)).alias("num_sessions"))


def stream_sessions(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
                    time_col: str, checkpoint: str, sink, gap: str = "5 minutes",
                    watermark: str = "15 seconds", glob: str = "*.parquet", trigger: dict | None = None,
                    prepare=None):
    """Start a streaming sessionization from a Parquet folder.

    ``sink`` is a ``foreachBatch`` function (``sinks.epoch_sink`` writes every
    batch once, also when it is replayed).  ``prepare`` maps the raw stream to the event shape.
    Recovery comes from ``checkpoint`` (a folder on shared storage).
    """
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source_dir))
    ev = prepare(raw) if prepare else raw
    out = sessionize(ev, keys, time_col, gap, watermark)
    return (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
               .foreachBatch(sink).trigger(**(trigger or {"availableNow": True})).start())
