"""Registered queries: growth accounting, retention, funnels, grouping sets,
window analytics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cumulus.functions import constants as K
from cumulus.operators import cubes as CB
from cumulus.operators import dedupe as DD
from cumulus.operators import funnel as FN
from cumulus.operators import growth as GR
from cumulus.operators import windows as W
from cumulus.plans.common import DS, PREV_DS, dates_text, scratch_table, stored, tasks_for
from cumulus.plans.role_sql import with_roles
from cumulus.sources import roles

TARGET_URL = "/purchase"
ROLLING_MIN_TOTAL = 100  # a feature of the report (500 on real traffic; the test events are fewer)


def _ga(spark, d, end=DS, since=None):
    return GR.growth_accounting_backfill(roles.web_events(spark, d), end, since=since)


def q_growth_backfill(spark, d):
    return _ga(spark, d).withColumn("dates_active", dates_text(F.col("dates_active")))


def q_growth_step(spark, d):
    prev = _ga(spark, d, PREV_DS, since=PREV_DS)
    return GR.growth_accounting_step(prev, roles.web_events(spark, d), DS).withColumn(
        "dates_active", dates_text(F.col("dates_active")))


def q_growth_state_counts(spark, d):
    return GR.state_counts(_ga(spark, d))


def q_retention_curve(spark, d):
    return GR.retention_curve(_ga(spark, d)).withColumn("pct_active", F.round("pct_active", 6))


def q_retention_cohort(spark, d):
    return GR.retention_curve(_ga(spark, d), by_cohort=True).withColumn("pct_active", F.round("pct_active", 6))


def q_funnel_event(spark, d):
    return FN.funnel_event(roles.web_events(spark, d), TARGET_URL).withColumn(
        "pct_converted", F.round("pct_converted", 6))


def q_funnel_user(spark, d):
    return FN.funnel_user(roles.web_events(spark, d), TARGET_URL).withColumn(
        "pct_converted", F.round("pct_converted", 6))


HIT_SETS = [("os_type", "device_type", "browser_type"), ("browser_type",), ("os_type",), ("device_type",)]
HIT_LABELS = {("os_type", "device_type", "browser_type"): "os_type__device_type__browser"}


def _hits(spark, d):
    # counted per device first, so that only one row a device is joined and expanded
    dims = ["os_type", "device_type", "browser_type"]
    per_device = roles.web_events(spark, d).groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    hits = CB.fill_unknown(per_device.join(roles.devices(spark, d), "device_id").select(*dims, "n"), dims)
    return CB.grouping_sets(hits, HIT_SETS, [F.sum("n").alias("number_of_hits")], HIT_LABELS)


def q_hits_grouping_sets(spark, d):
    return _hits(spark, d)


def q_hits_slice(spark, d):
    return _hits(spark, d).filter(F.col("aggregation_level") == "device_type")


def q_hits_cube(spark, d):
    """``hits_slice`` from a stored cube: the day is loaded into a cube of the days before, one level is read back."""
    dims = ["os_type", "device_type", "browser_type"]
    per_device = roles.web_events(spark, d).groupBy("event_date", "device_id").agg(F.count(F.lit(1)).alias("number_of_hits"))
    facts = CB.fill_unknown(per_device.join(roles.devices(spark, d), "device_id").select(*dims, "event_date", "number_of_hits"), dims)
    rows = lambda df: CB.cube_rows(df, HIT_SETS, ["number_of_hits"], "event_date", HIT_LABELS)
    today = F.col("event_date").eqNullSafe(F.lit(DS).cast("date"))
    with scratch_table(spark, "hits_cube") as name:
        CB.create_cube(rows(facts.where(~today)), name)
        CB.load_cube_day(name, rows(facts.where(today)), DS)
        return stored(CB.cube_slice(spark.table(name), "device_type", dims, ["number_of_hits"]), "hits")


def q_referrer_bucket(spark, d):
    ev = roles.web_events(spark, d)
    return ev.select("event_id", "referrer", W.referrer_channel("referrer").alias("referrer_channel"))


def _rolling(spark, d, **frames):
    ev = roles.web_events(spark, d).join(roles.devices(spark, d), "device_id")
    # the channel is NULL exactly when the referrer is: drop those rows before
    # the mapping instead of after the windows
    ev = ev.filter(F.col("referrer").isNotNull())
    daily = (ev.select("url", W.referrer_channel("referrer").alias("referrer"), "event_date")
               .groupBy("referrer", "url", "event_date").agg(F.count(F.lit(1)).alias("count")))
    r = W.rolling_counts(daily, ["referrer", "url"], "event_date", "count", ROLLING_MIN_TOTAL, **frames)
    return r.select(
        "referrer", "url", "event_date", "count", "weekly_rolling_count", "previous_weekly_rolling_count",
        F.round("pct_of_month", 6).alias("pct_of_month"), F.round("pct_of_total", 6).alias("pct_of_total"))


def q_rolling_counts(spark, d):
    return _rolling(spark, d)


def q_rolling_counts_calendar(spark, d):
    """The week up to each day and the week before it, by the calendar."""
    return _rolling(spark, d, prev_frame=(-13, -7), calendar=True)


GD_KEYS = ["game_id", "team_id", "player_id"]


def _gd(spark, d):
    return DD.deduplicate(roles.game_details(spark, d), GD_KEYS)


def q_gs_entity_group_period(spark, d):
    # a task keeps three groups of each of its rows: as many tasks as the rows need, at least those of any shuffle
    # (fewer would be shuffled again for the join)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gd = _gd(spark, d).repartition(tasks_for([roles.game_details(spark, d)], least), "game_id")
    x = gd.join(roles.games(spark, d).select("game_id", "season"), "game_id")
    # a team wins a game that its players leave with a positive total; groups hold one team's rows of one game
    total = F.sum("plus_minus").over(Window.partitionBy("game_id", "team_abbreviation"))
    x = x.withColumn("game_won", F.when(F.col("team_abbreviation").isNotNull() & (total > 0), F.col("game_id")))
    sets = [("player_name", "team_abbreviation"), ("player_name", "season"), ("team_abbreviation",)]
    labels = {sets[0]: "player_team", sets[1]: "player_season", sets[2]: "team"}
    # one row per group and game first: then games and wins are plain counts, with a single Expand by three
    by_game = [(*s, "game_id") for s in sets]
    games = CB.grouping_sets(x, by_game, [F.sum("pts").alias("pts"), F.max("game_won").alias("won")],
                             {g: labels[s] for g, s in zip(by_game, sets, strict=True)}, fill=None)
    return games.groupBy("aggregation_level", "player_name", "team_abbreviation", "season").agg(
        F.sum("pts").alias("total_points"), F.count("game_id").alias("games"), F.count("won").alias("wins"))


def q_argmax_group(spark, d):
    ptp = _gd(spark, d).groupBy("player_name", "team_abbreviation").agg(F.sum("pts").alias("total_points"))
    return W.argmax_per_group(ptp, ["team_abbreviation"], "total_points")


def q_argmax_period(spark, d):
    x = _gd(spark, d).join(roles.games(spark, d).select("game_id", "season"), "game_id")
    psp = x.groupBy("player_name", "season").agg(F.sum("pts").alias("total_points"))
    return W.argmax_per_group(psp, ["season"], "total_points")


def _team_games(spark, d):
    return (_gd(spark, d).filter(F.col("team_abbreviation").isNotNull())
            .groupBy("team_abbreviation", "game_id")
            .agg((F.sum("plus_minus") > 0).cast("int").alias("won")))


def q_top_winner(spark, d):
    g = _team_games(spark, d).groupBy("team_abbreviation").agg(
        F.count(F.lit(1)).alias("games_played"), F.sum("won").cast("bigint").alias("wins"))
    return W.top_n(g, [F.col("wins").desc(), F.col("team_abbreviation").asc()], 1)


def q_best_stretch(spark, d):
    s = W.best_stretch(_team_games(spark, d), "team_abbreviation", "game_id", "won", 90)
    return W.top_n(s, [F.col("max_in_90").desc(), F.col("team_abbreviation").asc()], 1)


def q_longest_streak(spark, d):
    return W.longest_streak(_gd(spark, d), "player_name", ["game_id", "team_id"], F.col("pts") > 10)


QUERIES = {
    "growth_backfill": q_growth_backfill,
    "growth_step": q_growth_step,
    "growth_state_counts": q_growth_state_counts,
    "retention_curve": q_retention_curve,
    "retention_cohort": q_retention_cohort,
    "funnel_event": q_funnel_event,
    "funnel_user": q_funnel_user,
    "hits_grouping_sets": q_hits_grouping_sets,
    "hits_slice": q_hits_slice,
    "hits_cube": q_hits_cube,
    "referrer_bucket": q_referrer_bucket,
    "rolling_counts": q_rolling_counts,
    "rolling_counts_calendar": q_rolling_counts_calendar,
    "gs_entity_group_period": q_gs_entity_group_period,
    "argmax_group": q_argmax_group,
    "argmax_period": q_argmax_period,
    "top_winner": q_top_winner,
    "best_stretch": q_best_stretch,
    "longest_streak": q_longest_streak,
}

# ----------------------------------------------------------------------------
# Oracle SQL (DuckDB)

_GA = with_roles("web_events") + """,
days AS (SELECT DISTINCT user_id, event_date AS d FROM web_events WHERE user_id IS NOT NULL AND event_date <= DATE '2024-01-30'),
firsts AS (SELECT user_id, MIN(d) AS first_active_date FROM days GROUP BY 1),
spine AS (SELECT user_id, first_active_date,
                 CAST(unnest(generate_series(first_active_date, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date
          FROM firsts),
j AS (SELECT s.*, a.d IS NOT NULL AS active FROM spine s LEFT JOIN days a ON a.user_id = s.user_id AND a.d = s.date),
p AS (SELECT *, MAX(CASE WHEN active THEN date END) OVER (PARTITION BY user_id ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM j),
ga AS (SELECT user_id, first_active_date, CASE WHEN active THEN date ELSE prev END AS last_active_date,
              CASE WHEN date = first_active_date THEN 'New' WHEN active AND prev = date - 1 THEN 'Retained'
                   WHEN active THEN 'Resurrected' WHEN prev = date - 1 THEN 'Churned' ELSE 'Stale' END AS daily_active_state,
              CASE WHEN date = first_active_date THEN 'New' WHEN active AND prev < date - 7 THEN 'Resurrected'
                   WHEN NOT active AND prev = date - 8 THEN 'Churned' WHEN active OR prev >= date - 8 THEN 'Retained'
                   ELSE 'Stale' END AS weekly_active_state,
              string_agg(CASE WHEN active THEN CAST(date AS VARCHAR) END, ',')
                OVER (PARTITION BY user_id ORDER BY date) AS dates_active,
              date FROM p)"""

_RET = """ COUNT(*) AS n_users,
       COUNT(*) FILTER (WHERE daily_active_state IN ('Retained', 'Resurrected', 'New')) AS n_active,
       round(CAST(COUNT(*) FILTER (WHERE daily_active_state IN ('Retained', 'Resurrected', 'New')) AS DOUBLE) / COUNT(*), 6) AS pct_active
FROM ga"""

_HITS = with_roles("web_events", "devices") + """,
known AS (SELECT device_id, ifnull(os_type, 'unknown') AS os, ifnull(device_type, 'unknown') AS device,
                 ifnull(browser_type, 'unknown') AS browser FROM devices),
hits AS (
SELECT level AS aggregation_level,
       CASE WHEN level LIKE 'os_type%' THEN os ELSE '(overall)' END AS os_type,
       CASE WHEN level LIKE '%device_type%' THEN device ELSE '(overall)' END AS device_type,
       CASE WHEN level LIKE '%browser%' THEN browser ELSE '(overall)' END AS browser_type,
       COUNT(*) AS number_of_hits
FROM web_events JOIN known USING (device_id),
     (VALUES ('os_type__device_type__browser'), ('browser_type'), ('os_type'), ('device_type')) AS levels(level)
GROUP BY ALL)"""

_CHANNEL = "CASE " + " ".join(f"WHEN referrer LIKE '%{part}%' THEN '{channel}'" for part, channel in [
    *K.REFERRER_RULES, ("example.com", "On Site")]) + " ELSE referrer END"

_GD = with_roles("game_details", "games") + """,
gd AS (SELECT * EXCLUDE (rn) FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, team_id, player_id
           ORDER BY team_abbreviation NULLS FIRST, player_name NULLS FIRST, line_number NULLS FIRST,
                    start_position NULLS FIRST, comment NULLS FIRST, "min" NULLS FIRST, pts NULLS FIRST,
                    plus_minus NULLS FIRST, return_flag NULLS FIRST) AS rn
         FROM game_details) t WHERE rn = 1),
tg AS (SELECT team_abbreviation, game_id, CASE WHEN SUM(plus_minus) > 0 THEN 1 ELSE 0 END AS won
       FROM gd WHERE team_abbreviation IS NOT NULL GROUP BY 1, 2)"""

ORACLE = {
    "growth_backfill": _GA + "\nSELECT * FROM ga",
    "growth_step": _GA + "\nSELECT * FROM ga WHERE date = DATE '2024-01-30'",
    "growth_state_counts": _GA + "\nSELECT date, daily_active_state, COUNT(*) AS n_users FROM ga GROUP BY 1, 2",
    "retention_curve": _GA + """
SELECT CAST(date_diff('day', first_active_date, date) AS INTEGER) AS days_since_first_active,""" + _RET + """
GROUP BY 1""",
    "retention_cohort": _GA + """
SELECT first_active_date, CAST(date_diff('day', first_active_date, date) AS INTEGER) AS days_since_first_active,""" + _RET + """
GROUP BY 1, 2""",
    "funnel_event": with_roles("web_events") + """,
ev AS (SELECT DISTINCT user_id, event_time, url, CAST(event_time AS DATE) AS day FROM web_events
       WHERE user_id IS NOT NULL),
scored AS (SELECT a.url,
                  CASE WHEN EXISTS (SELECT 1 FROM ev b WHERE b.user_id = a.user_id AND b.day = a.day
                                    AND b.event_time > a.event_time AND b.url = '/purchase') THEN 1 ELSE 0 END AS hit
           FROM ev a
           WHERE EXISTS (SELECT 1 FROM ev b WHERE b.user_id = a.user_id AND b.day = a.day AND b.event_time > a.event_time))
SELECT url, COUNT(*) AS num_events, CAST(SUM(hit) AS BIGINT) AS num_converted,
       round(CAST(SUM(hit) AS DOUBLE) / COUNT(*), 6) AS pct_converted
FROM scored GROUP BY url HAVING SUM(hit) > 0 AND COUNT(*) > 100""",
    "funnel_user": with_roles("web_events") + """,
ev AS (SELECT DISTINCT user_id, url, event_time, CAST(event_time AS DATE) AS day FROM web_events
       WHERE user_id IS NOT NULL),
per_event AS (SELECT a.user_id, a.url,
                     (SELECT COUNT(*) FROM ev b WHERE b.user_id = a.user_id AND b.day = a.day
                                                AND b.event_time > a.event_time) AS later_n,
                     (SELECT COUNT(*) FROM ev b WHERE b.user_id = a.user_id AND b.day = a.day
                                                AND b.event_time > a.event_time AND b.url = '/purchase') AS later_target
              FROM ev a),
per_user AS (SELECT user_id, url, SUM(later_n) AS pairs, MAX(CASE WHEN later_target > 0 THEN 1 ELSE 0 END) AS conv
             FROM per_event WHERE later_n > 0 GROUP BY user_id, url)
SELECT url, CAST(SUM(pairs) AS BIGINT) AS number_of_hits, CAST(SUM(conv) AS BIGINT) AS num_converted,
       round(CAST(SUM(conv) AS DOUBLE) / SUM(pairs), 6) AS pct_converted
FROM per_user GROUP BY url HAVING SUM(pairs) > 500""",
    "hits_grouping_sets": _HITS + "\nSELECT * FROM hits",
    "hits_slice": _HITS + "\nSELECT * FROM hits WHERE aggregation_level = 'device_type'",
    "referrer_bucket": with_roles("web_events") + f"""
SELECT event_id, referrer, {_CHANNEL} AS referrer_channel FROM web_events""",
    "rolling_counts": with_roles("web_events", "devices") + f""",
tagged AS (SELECT e.url, {_CHANNEL} AS referrer, e.event_date FROM web_events e JOIN devices d ON e.device_id = d.device_id),
daily AS (SELECT referrer, url, event_date, COUNT(*) AS "count",
                 ROW_NUMBER() OVER (PARTITION BY referrer, url ORDER BY event_date) AS k
          FROM tagged GROUP BY referrer, url, event_date),
tot AS (SELECT referrer, url, SUM("count") AS total FROM daily GROUP BY referrer, url),
mon AS (SELECT referrer, url, date_trunc('month', event_date) AS m, SUM("count") AS month_total
        FROM daily GROUP BY referrer, url, date_trunc('month', event_date)),
wk AS (SELECT a.referrer, a.url, a.k,
              SUM(CASE WHEN b.k BETWEEN a.k - 6 AND a.k THEN b."count" END) AS weekly,
              SUM(CASE WHEN b.k BETWEEN a.k - 13 AND a.k - 6 THEN b."count" END) AS prev_weekly
       FROM daily a JOIN daily b ON b.referrer = a.referrer AND b.url = a.url AND b.k BETWEEN a.k - 13 AND a.k
       GROUP BY a.referrer, a.url, a.k)
SELECT d.referrer, d.url, d.event_date, d."count", CAST(w.weekly AS BIGINT) AS weekly_rolling_count,
       CAST(w.prev_weekly AS BIGINT) AS previous_weekly_rolling_count,
       round(CAST(d."count" AS DOUBLE) / m.month_total, 6) AS pct_of_month,
       round(CAST(d."count" AS DOUBLE) / t.total, 6) AS pct_of_total
FROM daily d JOIN tot t ON t.referrer = d.referrer AND t.url = d.url
JOIN mon m ON m.referrer = d.referrer AND m.url = d.url AND m.m = date_trunc('month', d.event_date)
JOIN wk w ON w.referrer = d.referrer AND w.url = d.url AND w.k = d.k
WHERE t.total > 100 AND d.referrer IS NOT NULL""",
    "gs_entity_group_period": _GD + """,
x AS (SELECT gd.player_name, gd.team_abbreviation, g.season, gd.pts, gd.game_id,
             CASE WHEN tg.won = 1 THEN gd.game_id END AS game_won
      FROM gd JOIN games g ON gd.game_id = g.game_id
      LEFT JOIN tg ON tg.game_id = gd.game_id AND tg.team_abbreviation = gd.team_abbreviation)
SELECT 'player_team' AS aggregation_level, player_name, team_abbreviation, CAST(NULL AS INTEGER) AS season,
       CAST(SUM(pts) AS BIGINT) AS total_points, COUNT(DISTINCT game_id) AS games, COUNT(DISTINCT game_won) AS wins
FROM x GROUP BY player_name, team_abbreviation
UNION ALL
SELECT 'player_season', player_name, NULL, season, CAST(SUM(pts) AS BIGINT), COUNT(DISTINCT game_id), COUNT(DISTINCT game_won)
FROM x GROUP BY player_name, season
UNION ALL
SELECT 'team', NULL, team_abbreviation, NULL, CAST(SUM(pts) AS BIGINT), COUNT(DISTINCT game_id), COUNT(DISTINCT game_won)
FROM x GROUP BY team_abbreviation""",
    "argmax_group": _GD + """,
ptp AS (SELECT player_name, team_abbreviation, CAST(SUM(pts) AS BIGINT) AS total_points FROM gd GROUP BY 1, 2)
SELECT a.team_abbreviation, a.player_name, a.total_points FROM ptp a
WHERE a.team_abbreviation IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM ptp b WHERE b.team_abbreviation = a.team_abbreviation AND b.total_points > a.total_points)""",
    "argmax_period": _GD + """,
psp AS (SELECT gd.player_name, g.season, CAST(SUM(gd.pts) AS BIGINT) AS total_points
        FROM gd JOIN games g ON gd.game_id = g.game_id GROUP BY 1, 2)
SELECT a.season, a.player_name, a.total_points FROM psp a
WHERE a.season IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM psp b WHERE b.season = a.season AND b.total_points > a.total_points)""",
    "top_winner": _GD + """,
standings AS (SELECT team_abbreviation, COUNT(*) AS games_played, CAST(SUM(won) AS BIGINT) AS wins FROM tg GROUP BY 1)
SELECT * FROM standings WHERE wins = (SELECT MAX(wins) FROM standings)
ORDER BY team_abbreviation LIMIT 1""",
    "best_stretch": _GD + """,
num AS (SELECT team_abbreviation, won, ROW_NUMBER() OVER (PARTITION BY team_abbreviation ORDER BY game_id) AS k FROM tg),
sums AS (SELECT a.team_abbreviation, a.k, SUM(b.won) AS s FROM num a JOIN num b
         ON b.team_abbreviation = a.team_abbreviation AND b.k BETWEEN a.k - 89 AND a.k GROUP BY 1, 2),
best AS (SELECT team_abbreviation, CAST(MAX(s) AS BIGINT) AS max_in_90 FROM sums GROUP BY 1)
SELECT * FROM best WHERE max_in_90 = (SELECT MAX(max_in_90) FROM best) ORDER BY team_abbreviation LIMIT 1""",
    "longest_streak": _GD + """,
t AS (SELECT player_name, pts > 10 AS ok,
             ROW_NUMBER() OVER (PARTITION BY player_name ORDER BY game_id NULLS FIRST, team_id NULLS FIRST) AS rn FROM gd),
u AS (SELECT *, MAX(CASE WHEN NOT ok THEN rn END) OVER (PARTITION BY player_name ORDER BY rn
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_miss FROM t)
SELECT player_name, MAX(rn - COALESCE(last_miss, 0)) AS longest_streak FROM u WHERE ok GROUP BY player_name""",
}

ORACLE["hits_cube"] = ORACLE["hits_slice"]
ORACLE["rolling_counts_calendar"] = with_roles("web_events", "devices") + f""",
tagged AS (SELECT e.url, {_CHANNEL} AS referrer, e.event_date FROM web_events e JOIN devices d ON e.device_id = d.device_id),
daily AS (SELECT referrer, url, event_date, COUNT(*) AS "count" FROM tagged WHERE referrer IS NOT NULL GROUP BY ALL),
w AS (SELECT a.referrer, a.url, a.event_date, a."count",
             SUM(b."count") FILTER (WHERE b.event_date BETWEEN a.event_date - 6 AND a.event_date) AS weekly,
             SUM(b."count") FILTER (WHERE b.event_date BETWEEN a.event_date - 13 AND a.event_date - 7) AS prev_weekly,
             SUM(b."count") FILTER (WHERE date_trunc('month', b.event_date) = date_trunc('month', a.event_date)) AS month_total,
             SUM(b."count") AS total
      FROM daily a JOIN daily b ON a.referrer = b.referrer AND a.url = b.url GROUP BY ALL)
SELECT referrer, url, event_date, "count", CAST(weekly AS BIGINT) AS weekly_rolling_count,
       CAST(prev_weekly AS BIGINT) AS previous_weekly_rolling_count,
       round(CAST("count" AS DOUBLE) / month_total, 6) AS pct_of_month, round(CAST("count" AS DOUBLE) / total, 6) AS pct_of_total
FROM w WHERE total > 100"""
