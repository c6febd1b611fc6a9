"""Registered queries: star joins, load validation, shared aggregates,
dimension joins and report sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

import uuid

from cumulus.operators import bi as BI
from cumulus.operators import layout as LY
from cumulus.operators import stored as ST
from cumulus.operators import warehouse as WH
from cumulus.plans.common import scratch_table, stored, tasks_for
from cumulus.plans.role_sql import with_roles
from cumulus.sources import roles
from cumulus.session import shared_path
from cumulus.sources.tables import table

MEDAL_CLASS = "ECONOMY"


def _md(details):
    """Match details at (match, player) grain."""
    return details.groupBy("match_id", "player_gamertag").agg(
        F.sum("player_total_kills").alias("kills"), F.max("did_win").alias("did_win"))


def _mmp(won, medals):
    """Medals of a (match, player), and their difficulty by the medal dimension."""
    medals = medals.select("medal_id", "difficulty")
    return (won.join(medals, "medal_id", "left")
            .groupBy("match_id", "player_gamertag")
            .agg(F.sum("count").alias("medals"), F.sum(F.col("count") * F.col("difficulty")).alias("medal_difficulty")))


def _star(details, matches, won, medals, maps):
    maps = maps.select("mapid", F.col("name").alias("map_name"))
    m = matches.select("match_id", "mapid", "playlist_id")
    j = _md(details).join(m, "match_id").join(_mmp(won, medals), ["match_id", "player_gamertag"], "left")
    j = j.join(maps, "mapid", "left")
    return j.select("match_id", "player_gamertag", "kills", "did_win", "playlist_id", "map_name",
                    F.coalesce("medals", F.lit(0).cast("bigint")).alias("medals"), "medal_difficulty")


def q_star_join(spark, d):
    return _star(roles.match_details(spark, d), roles.matches(spark, d), roles.medals_matches_players(spark, d),
                 roles.medals(spark, d), roles.maps(spark, d))


STAR_BUCKETS = 16  # the least; more as the tables grow, since one task joins a bucket
# tables that are bucketed by one of two join keys are joined in place
SUBSET_OF_KEYS = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def bucketed_star(spark, d, names):
    """Match details, matches and medals won as tables bucketed by match, and their star join: all that is
    joined or grouped by match is in place already."""
    frames = (roles.match_details(spark, d), roles.matches(spark, d), roles.medals_matches_players(spark, d))
    buckets = tasks_for(frames, STAR_BUCKETS)
    for df, name in zip(frames, names, strict=True):
        WH.bucketed_save(df.repartition(buckets, "match_id"), name, "match_id", buckets)
    details, matches, won = map(spark.table, names)
    return _star(details, matches, won, roles.medals(spark, d), roles.maps(spark, d))


def q_star_join_bucketed(spark, d):
    with scratch_table(spark, "details") as a, scratch_table(spark, "matches") as b, scratch_table(spark, "won") as c:
        with ST.setting(spark, *SUBSET_OF_KEYS):
            return stored(bucketed_star(spark, d, (a, b, c)), "star")


def q_avg_kills(spark, d):
    return _md(roles.match_details(spark, d)).groupBy("player_gamertag").agg(F.round(F.avg("kills"), 6).alias("avg_kills"))


def q_most_played_playlist(spark, d):
    return roles.matches(spark, d).groupBy("playlist_id").agg(F.count(F.lit(1)).alias("n_matches"))


def q_most_played_map(spark, d):
    maps = roles.maps(spark, d).select("mapid", F.col("name").alias("map_name"))
    g = roles.matches(spark, d).groupBy("mapid").agg(F.count(F.lit(1)).alias("n_matches"))
    return g.join(maps, "mapid", "left")


def q_medal_by_map(spark, d):
    med = roles.medals(spark, d).filter(F.col("classification") == MEDAL_CLASS).select("medal_id")
    maps = roles.maps(spark, d).select("mapid", F.col("name").alias("map_name"))
    x = (roles.medals_matches_players(spark, d).join(med, "medal_id", "left_semi")
         .groupBy("match_id").agg(F.sum("count").alias("_c"))
         .join(roles.matches(spark, d).select("match_id", "mapid"), "match_id"))
    g = x.groupBy("mapid").agg(F.sum("_c").alias("total_medals"))
    return g.join(maps, "mapid", "left").select("mapid", "map_name", "total_medals")


def q_clean_load(spark, d):
    return WH.clean_load(roles.match_details(spark, d), ["match_id", "player_gamertag"])


def _uda(spark, d):
    return WH.shared_aggregate(roles.web_events(spark, d), "user_id", "device_id", "host")


def q_user_device_agg(spark, d):
    return _uda(spark, d).select("user_id", "device_id", "n_events", F.array_join("hosts", ",").alias("hosts"))


def q_users_devices(spark, d):
    """Users joined with the shared aggregate: hits on the most used device, number of devices."""
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return users.join(_uda(spark, d), "user_id").groupBy("user_id").agg(
        F.max("n_events").alias("total_hits"), F.count(F.lit(1)).alias("n_devices"))


def q_devices_users(spark, d):
    """Devices joined with the shared aggregate: users (counted, not listed) and events of each."""
    devices = roles.devices(spark, d).select("device_id", "device_type")
    return devices.join(_uda(spark, d), "device_id").groupBy("device_id", "device_type").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("n_events").alias("n_events"))


def q_typed_join(spark, d):
    ev = roles.web_events(spark, d).filter(F.col("user_id").isNotNull())
    j = ev.join(roles.devices(spark, d), "device_id")
    return j.select("event_id", "user_id", "device_id",
                    F.upper(F.coalesce("browser_type", F.lit("unknown"))).alias("browser"))


def q_left_join_rename(spark, d):
    j = roles.web_events(spark, d).join(roles.devices(spark, d), "device_id", "left")
    j = j.withColumnsRenamed({"browser_type": "browser", "os_type": "os", "device_type": "device"})
    return j.select("event_id", "device_id", "browser", "os", "device")


def q_pruned_join(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = WH.pruned_join(li, o, "l_orderkey", "o_orderdate", "1998-01-01", "1998-12-31")
    cents = F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * 100).cast("bigint")
    return j.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(cents).alias("revenue_cents"))


def month_pruned_join(spark, d, path):
    """Lines stored by the month of their order; a date range of the orders prunes months, by the range
    translated to the derived column and, when it runs, by the months of the orders that are left."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    ST.write_by_month(li.join(o, "l_orderkey"), path, "o_orderdate", "order_month")
    header = o.withColumn("order_month", ST.month_of("o_orderdate")).where(
        ST.between_days("o_orderdate", "order_month", "1998-01-01", "1998-12-31"))
    return spark.read.parquet(path).drop("o_orderdate").join(header, ["l_orderkey", "order_month"])


def q_pruned_join_months(spark, d):
    j = month_pruned_join(spark, d, shared_path(spark, f"lines-{uuid.uuid4().hex}"))
    cents = F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * 100).cast("bigint")
    return j.groupBy(F.col("order_month").alias("month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(cents).alias("revenue_cents"))


def q_broadcast_join(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    j = li.join(p, "l_partkey")
    ds = F.split(F.col("l_shipdate").cast("string"), " ").getItem(0)
    return j.groupBy("p_type", F.substring(ds, 1, 7).alias("ship_month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("total_qty"))


def _mmp_medals(spark, d):
    return roles.medals_matches_players(spark, d).join(roles.medals(spark, d), "medal_id")


def q_bi_class_breakdown(spark, d):
    return BI.sum_by(_mmp_medals(spark, d), ["classification"], "count", "total_count")


def q_bi_top_distinct(spark, d):
    return BI.top_by(_mmp_medals(spark, d), ["medal_id", "name"], F.count_distinct("match_id"), "n_matches", 20)


def q_bi_top_sum_item(spark, d):
    return BI.top_by(_mmp_medals(spark, d), ["medal_id", "name"], F.sum("difficulty").cast("bigint"),
                     "total_difficulty", 20)


def q_bi_top_sum_entity(spark, d):
    return BI.top_by(roles.match_details(spark, d), ["player_gamertag"], F.sum("player_total_kills"),
                     "total_kills", 20)


def q_bi_monthly(spark, d):
    j = _md(roles.match_details(spark, d)).join(roles.matches(spark, d).select("match_id", "completion_date"), "match_id")
    return BI.monthly(j, "completion_date", "kills", "total_kills")


def q_bi_win_rate(spark, d):
    r = BI.avg_over_top(_md(roles.match_details(spark, d)), "player_gamertag", "did_win", "did_win", 20)
    return r.withColumn("avg_did_win", F.round("avg_did_win", 6))


def q_layout_local_sort(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return WH.local_sort(ev, "user_id", ["user_id", "ts"])


def q_layout_global_sort(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return WH.global_sort(ev, ["user_id", "ts"])


ZONE_FILES = 16
ZONE_RANGES = {"user_id": (20, 29), "ts": ("2024-01-10", "2024-01-12")}


def q_zone_map_read(spark, d):
    """Events of a few users and days, from a layout sorted by user and from one dealt at random: equal rows,
    but only the sorted one has files that need not be opened."""
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    layouts = {"sorted": ev.repartitionByRange(ZONE_FILES, "user_id", "ts").sortWithinPartitions("user_id", "ts"),
               "dealt": ev.repartition(ZONE_FILES, F.xxhash64("event_id"))}
    ranges = {"user_id": ZONE_RANGES["user_id"],
              "ts": tuple(F.lit(t).cast("timestamp_ntz") for t in ZONE_RANGES["ts"])}
    out = None
    for name, df in layouts.items():
        path = shared_path(spark, f"events-{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        zones = stored(LY.zone_map(spark, path, list(ranges)), "zones")
        opened, n_files = len(LY.matching_files(zones, ranges)), zones.count()
        rows = LY.read_matching(spark, path, zones, ranges).select(
            F.lit(name).alias("layout"), F.lit(opened < n_files).alias("skips_files"), "event_id", "user_id", "ts", "event_type")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "star_join_bucketed": q_star_join_bucketed,
    "pruned_join_months": q_pruned_join_months,
    "zone_map_read": q_zone_map_read,
    "layout_local_sort": q_layout_local_sort,
    "layout_global_sort": q_layout_global_sort,
    "star_join": q_star_join,
    "avg_kills": q_avg_kills,
    "most_played_playlist": q_most_played_playlist,
    "most_played_map": q_most_played_map,
    "medal_by_map": q_medal_by_map,
    "clean_load": q_clean_load,
    "user_device_agg": q_user_device_agg,
    "users_devices": q_users_devices,
    "devices_users": q_devices_users,
    "typed_join": q_typed_join,
    "left_join_rename": q_left_join_rename,
    "pruned_join": q_pruned_join,
    "broadcast_join": q_broadcast_join,
    "bi_class_breakdown": q_bi_class_breakdown,
    "bi_top_distinct": q_bi_top_distinct,
    "bi_top_sum_item": q_bi_top_sum_item,
    "bi_top_sum_entity": q_bi_top_sum_entity,
    "bi_monthly": q_bi_monthly,
    "bi_win_rate": q_bi_win_rate,
}

# ----------------------------------------------------------------------------
# Oracle SQL (DuckDB)

_MD = with_roles("match_details", "matches", "medals_matches_players", "medals", "maps") + """,
md AS (SELECT match_id, player_gamertag, CAST(SUM(player_total_kills) AS BIGINT) AS kills, MAX(did_win) AS did_win
       FROM match_details GROUP BY 1, 2),
mmp AS (SELECT match_id, player_gamertag, CAST(SUM("count") AS BIGINT) AS medals,
               CAST(SUM("count" * p_size) AS BIGINT) AS medal_difficulty
        FROM medals_matches_players LEFT JOIN part ON p_partkey = medal_id GROUP BY 1, 2),
mm AS (SELECT x.*, m.name, m.classification, m.difficulty FROM medals_matches_players x JOIN medals m ON x.medal_id = m.medal_id)"""

_UDA = with_roles("web_events") + """,
uda AS (SELECT user_id, device_id, COUNT(*) AS n_events, string_agg(DISTINCT host, ',' ORDER BY host) AS hosts
        FROM web_events GROUP BY 1, 2)"""

ORACLE = {
    "layout_local_sort": "SELECT event_id, user_id, ts, event_type FROM events",
    "layout_global_sort": "SELECT event_id, user_id, ts, event_type FROM events",
    "star_join": _MD + """
SELECT md.match_id, md.player_gamertag, md.kills, md.did_win, m.playlist_id, p.name AS map_name,
       COALESCE(mmp.medals, 0) AS medals, mmp.medal_difficulty
FROM md JOIN matches m ON md.match_id = m.match_id
LEFT JOIN mmp ON mmp.match_id = md.match_id AND mmp.player_gamertag = md.player_gamertag
LEFT JOIN maps p ON p.mapid = m.mapid""",
    "avg_kills": _MD + "\nSELECT player_gamertag, round(AVG(kills), 6) AS avg_kills FROM md GROUP BY 1",
    "most_played_playlist": _MD + "\nSELECT playlist_id, COUNT(*) AS n_matches FROM matches GROUP BY 1",
    "most_played_map": _MD + """
SELECT g.mapid, g.n_matches, p.name AS map_name FROM (SELECT mapid, COUNT(*) AS n_matches FROM matches GROUP BY 1) g
LEFT JOIN maps p ON p.mapid = g.mapid""",
    "medal_by_map": _MD + """
SELECT m.mapid, p.name AS map_name, CAST(SUM(x."count") AS BIGINT) AS total_medals
FROM medals_matches_players x JOIN matches m ON x.match_id = m.match_id LEFT JOIN maps p ON p.mapid = m.mapid
WHERE x.medal_id IN (SELECT medal_id FROM medals WHERE classification = 'ECONOMY')
GROUP BY m.mapid, p.name""",
    "clean_load": _MD + """
SELECT DISTINCT * FROM match_details WHERE match_id IS NOT NULL AND player_gamertag IS NOT NULL""",
    "user_device_agg": _UDA + "\nSELECT * FROM uda",
    "users_devices": _UDA + """
SELECT user_id, MAX(n_events) AS total_hits, COUNT(*) AS n_devices FROM uda
WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY user_id""",
    "devices_users": with_roles("web_events", "devices") + """
SELECT device_id, device_type, COUNT(DISTINCT user_id) AS n_users, COUNT(*) AS n_events
FROM web_events JOIN devices USING (device_id) GROUP BY ALL""",
    "typed_join": with_roles("web_events", "devices") + """
SELECT e.event_id, e.user_id, e.device_id, upper(COALESCE(d.browser_type, 'unknown')) AS browser
FROM web_events e JOIN devices d ON e.device_id = d.device_id WHERE e.user_id IS NOT NULL""",
    "left_join_rename": with_roles("web_events", "devices") + """
SELECT e.event_id, e.device_id, d.browser_type AS browser, d.os_type AS os, d.device_type AS device
FROM web_events e LEFT JOIN devices d ON e.device_id = d.device_id""",
    "pruned_join": """
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, COUNT(*) AS n_lines,
       CAST(SUM(CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
 AND o.o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
GROUP BY 1""",
    "broadcast_join": """
SELECT p.p_type, substr(split_part(CAST(l.l_shipdate AS VARCHAR), ' ', 1), 1, 7) AS ship_month,
       COUNT(*) AS n_lines, CAST(SUM(l.l_quantity) AS BIGINT) AS total_qty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2""",
    "bi_class_breakdown": _MD + "\nSELECT classification, CAST(SUM(\"count\") AS BIGINT) AS total_count FROM mm GROUP BY 1",
    "bi_top_distinct": _MD + """
SELECT medal_id, name, COUNT(DISTINCT match_id) AS n_matches FROM mm GROUP BY 1, 2
ORDER BY n_matches DESC, medal_id ASC NULLS LAST, name ASC NULLS LAST LIMIT 20""",
    "bi_top_sum_item": _MD + """
SELECT medal_id, name, CAST(SUM(difficulty) AS BIGINT) AS total_difficulty FROM mm GROUP BY 1, 2
ORDER BY total_difficulty DESC, medal_id ASC NULLS LAST, name ASC NULLS LAST LIMIT 20""",
    "bi_top_sum_entity": _MD + """
SELECT player_gamertag, CAST(SUM(player_total_kills) AS BIGINT) AS total_kills FROM match_details GROUP BY 1
ORDER BY total_kills DESC, player_gamertag ASC NULLS LAST LIMIT 20""",
    "bi_monthly": _MD + """
SELECT CAST(date_trunc('month', m.completion_date) AS DATE) AS month, CAST(SUM(md.kills) AS BIGINT) AS total_kills
FROM md JOIN matches m ON md.match_id = m.match_id GROUP BY 1""",
    "bi_win_rate": _MD + """
SELECT player_gamertag, CAST(SUM(did_win) AS BIGINT) AS total_did_win, round(AVG(did_win), 6) AS avg_did_win
FROM md GROUP BY 1 ORDER BY total_did_win DESC, player_gamertag ASC LIMIT 20""",
}

# the stored forms give the rows of the plain ones
ORACLE["star_join_bucketed"] = ORACLE["star_join"]
ORACLE["pruned_join_months"] = ORACLE["pruned_join"]
ORACLE["zone_map_read"] = """
SELECT layout, layout = 'sorted' AS skips_files, event_id, user_id, ts, event_type
FROM events CROSS JOIN (VALUES ('sorted'), ('dealt')) l(layout)
WHERE user_id BETWEEN 20 AND 29 AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'"""
