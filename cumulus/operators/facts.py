"""Fact building: join detail to header, deduplicate, derive flags and
measures, rename to the dim_/m_ convention; flag rates; dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.functions import constants as K
from cumulus.operators.dedupe import deduplicate


def contains_text(c, needle: str):
    """``COALESCE(POSITION(needle IN c), 0) > 0``."""
    return F.coalesce(F.instr(F.col(c), needle), F.lit(0)) > 0


def minutes_from_mmss(c):
    """'mm:ss' -> minutes as DOUBLE; malformed or missing parts give NULL."""
    mm = F.split_part(F.col(c), F.lit(":"), F.lit(1)).try_cast("double")
    ss = F.split_part(F.col(c), F.lit(":"), F.lit(2)).try_cast("double")
    return mm + ss / F.lit(60.0)


def build_game_fact(details: DataFrame, header: DataFrame, keys: Sequence[str] = ("game_id", "team_id", "player_id"),
                    order: Sequence[str] | None = None) -> DataFrame:
    """Box-score fact: one row per (game, team, player)."""
    d = deduplicate(details, list(keys), order)
    h = header.select("game_id", "game_date_est", "season", "home_team_id")
    j = d.join(h, "game_id")
    return j.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        contains_text("comment", K.DID_NOT_PLAY).alias("dim_did_not_play"),
        contains_text("comment", K.DID_NOT_DRESS).alias("dim_did_not_dress"),
        contains_text("comment", K.NOT_WITH_TEAM).alias("dim_not_with_team"),
        minutes_from_mmss("min").alias("m_minutes"),
        F.col("pts").alias("m_pts"),
        F.col("plus_minus").alias("m_plus_minus"),
        F.col("game_id").alias("dim_game_id"),
    )


def flag_rate(df: DataFrame, key: str, flag: str, name: str = "flagged") -> DataFrame:
    """Rows, flagged rows and their share per key."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("num_rows"),
                            F.count_if(F.col(flag)).alias(f"{name}_num"))
    return g.withColumn(f"{name}_pct", F.col(f"{name}_num").cast("double") / F.col("num_rows").cast("double"))


def lookup_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                     cols: Sequence[str]) -> DataFrame:
    """Fetch dimension columns for each fact row (left join).

    The planner broadcasts the dimension if its bytes are below
    ``spark.sql.autoBroadcastJoinThreshold`` (by file size, or at runtime by
    the shuffled size) and joins by shuffle otherwise.
    """
    d = dim.select(F.col(dim_key).alias("_dk"), *cols)
    return fact.join(d, F.col(fact_key) == F.col("_dk"), "left").drop("_dk")
