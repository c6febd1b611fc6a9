"""Role-equivalent inputs derived from the warehouse tables.

The operators are generic; these frames give them the shapes the modelling
patterns talk about (web events, devices, seasons per entity, box-score rows
with duplicates, ...).  Each one is a projection/aggregation of the base
tables, so it grows with them.  The same derivations are written in SQL in
``cumulus.plans.role_sql`` for the independent oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulus.sources.tables import table


def _case(key, pairs, default=None):
    expr = None
    for v, out in pairs:
        expr = F.when(key == v, F.lit(out)) if expr is None else expr.when(key == v, F.lit(out))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# --- fixed values: synthetic referrer per props.k % 8 (index 5 = no referrer) --
REFERRERS = [
    "https://www.linkedin.com/feed/",
    "https://t.co/x1y2",
    "https://www.google.com/search",
    "https://lnkd.in/abc",
    "https://www.example.com/blog",
    None,
    "https://news.ycombinator.com/",
    "https://www.bing.com/",
]


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    # every derived column references k once (an array lookup rather than a
    # CASE chain), so a filter pushed down to the scan parses the JSON once
    ref = F.element_at(F.array(*[F.lit(r).cast("string") for r in REFERRERS]), (F.col("k") % 8 + 1).cast("int"))
    return (e.select("event_id", "user_id", F.col("ts").alias("event_time"), "event_type", "value", k.alias("k"))
             .select("event_id", "user_id", "event_time", F.to_date("event_time").alias("event_date"),
                     "event_type", "value", "k",
                     F.concat(F.lit("/"), F.col("event_type")).alias("url"),
                     F.concat(F.lit("site"), (F.col("k") % 3).cast("string"), F.lit(".example.com")).alias("host"),
                     (F.col("k") % 10).alias("device_id"),
                     ref.alias("referrer"),
                     address(F.col("user_id")).alias("ip")))


def address(user_id):
    """A valid IPv4 address for any user id: the id spread over all four octets by an odd factor (one to one below 2**32)."""
    n = F.pmod(F.pmod(user_id, F.lit(1 << 32)) * F.lit(1640531527), F.lit(1 << 32))
    return F.concat_ws(".", *[F.shiftright(n, bits).bitwiseAND(255).cast("string") for bits in (24, 16, 8, 0)])


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device dimension: a nation's key is the id of a device (events name ids 0 to 9)."""
    d = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("device_id"))
    i = F.col("device_id")
    return d.select(
        "device_id",
        _case(i % 5, [(0, "Chrome"), (1, "Safari"), (2, "Firefox"), (3, "Edge")]).alias("browser_type"),
        F.when(i == 7, F.lit(None).cast("string")).otherwise(
            _case(i % 3, [(0, "Windows"), (1, "Mac OS X")], "Linux")).alias("os_type"),
        _case(i % 4, [(0, "Desktop"), (1, "Mobile"), (2, "Tablet")]).alias("device_type"),
    )


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (entity, season): customers' order years as 'seasons'."""
    o = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    agg = (o.groupBy("o_custkey", F.year("o_orderdate").alias("season"))
            .agg(F.count(F.lit(1)).alias("gp"),
                 (F.sum(cents).cast("double") / F.count(F.lit(1)).cast("double") / F.lit(1000000.0)).alias("pts"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("ast"),
                 F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("reb")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (agg.join(c, agg.o_custkey == c.c_custkey)
               .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
               .select(F.col("c_name").alias("player_name"), F.col("n_name").alias("country"),
                       F.col("c_mktsegment").alias("college"), "season", "gp", "pts", "ast", "reb"))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-score rows: line items as (game, player, team) with duplicate keys."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    qty = F.col("l_quantity").cast("bigint")
    ln = F.col("l_linenumber")
    comment = (F.when(ln == 7, F.lit("DNP - Coach's Decision"))
                .when((ln == 6) & (F.col("l_returnflag") == "R"), F.lit("DND - Injury/Illness"))
                .when((ln == 5) & (F.col("l_returnflag") == "A"), F.lit("NWT - Not With Team")))
    minutes = (F.when(ln == 7, F.lit(None).cast("string"))
                .when(ln == 4, F.lit(""))
                .otherwise(F.concat(qty.cast("string"), F.lit(":"),
                                    F.lpad((F.col("l_suppkey") % 60).cast("string"), 2, "0"))))
    return (li.join(p, li.l_partkey == p.p_partkey, "left")
              .select(F.col("l_orderkey").alias("game_id"),
                      F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).try_cast("bigint").alias("team_id"),
                      F.col("p_brand").alias("team_abbreviation"),
                      F.col("l_partkey").alias("player_id"),
                      F.concat(F.lit("Player#"), F.col("l_partkey").cast("string")).alias("player_name"),
                      F.col("l_linenumber").alias("line_number"),
                      _case(ln, [(1, "G"), (2, "F"), (3, "C")]).alias("start_position"),
                      comment.alias("comment"), minutes.alias("min"),
                      qty.alias("pts"), (qty - 25).alias("plus_minus"),
                      F.col("l_returnflag").alias("return_flag")))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("game_id"),
                    F.to_date("o_orderdate").alias("game_date_est"),
                    F.year("o_orderdate").alias("season"),
                    (F.col("o_custkey") % 25).alias("home_team_id"),
                    ((F.col("o_custkey") + 7) % 25).alias("visitor_team_id"),
                    F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"),
                    F.col("o_orderstatus").alias("game_status_text"))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team rows with duplicates: every supplier row re-states its nation's team."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .select(F.col("n_nationkey").cast("bigint").alias("team_id"),
                     F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("abbreviation"),
                     F.col("s_name").alias("nickname"),
                     F.col("n_name").alias("city"),
                     F.concat(F.lit("Arena "), (F.col("s_suppkey") % 3).cast("string")).alias("arena"),
                     (F.lit(1900) + F.col("s_suppkey") % 100).alias("yearfounded")))


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-film rows: customers as actors, orders as films."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .select(F.col("c_name").alias("actor"),
                     F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("actorid"),
                     F.concat(F.lit("Film#"), F.col("o_orderkey").cast("string")).alias("film"),
                     F.year("o_orderdate").alias("year"),
                     (F.col("o_totalprice").cast("bigint") % 1000).alias("votes"),
                     (F.col("o_totalprice") / F.lit(50000.0)).alias("rating"),
                     F.round(F.col("o_totalprice") * 100).cast("bigint").alias("rating_units"),
                     F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("filmid")))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("match_id"),
                    (F.col("o_custkey") % 25).cast("int").alias("mapid"),
                    F.col("o_orderpriority").alias("playlist_id"),
                    F.col("o_orderdate").alias("completion_date"),
                    (F.col("o_orderstatus") != "P").alias("is_team_game"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"),
                     F.concat(F.lit("Gamer#"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
                     F.col("l_quantity").cast("bigint").alias("player_total_kills"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("did_win"))


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"),
                     F.concat(F.lit("Gamer#"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
                     F.col("l_partkey").alias("medal_id"),
                     F.col("l_linenumber").cast("bigint").alias("count"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("medal_id"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("classification"), F.col("p_size").alias("difficulty"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name"))
