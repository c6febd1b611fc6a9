"""The role derivations of ``cumulus.sources.roles`` written in plain SQL
(DuckDB dialect) for the independent oracle."""

ROLE_CTES = {
    "web_events": """web_events AS (
  SELECT event_id, user_id, event_time, CAST(event_time AS DATE) AS event_date, event_type, value, k,
         '/' || event_type AS url,
         'site' || CAST(k % 3 AS VARCHAR) || '.example.com' AS host,
         k % 10 AS device_id,
         CASE k % 8 WHEN 0 THEN 'https://www.linkedin.com/feed/' WHEN 1 THEN 'https://t.co/x1y2'
                    WHEN 2 THEN 'https://www.google.com/search' WHEN 3 THEN 'https://lnkd.in/abc'
                    WHEN 4 THEN 'https://www.example.com/blog' WHEN 6 THEN 'https://news.ycombinator.com/'
                    WHEN 7 THEN 'https://www.bing.com/' END AS referrer,
         concat_ws('.', spread // 16777216, spread // 65536 % 256, spread // 256 % 256, spread % 256) AS ip
  FROM (SELECT event_id, user_id, ts AS event_time, event_type, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               (user_id % 4294967296) * 1640531527 % 4294967296 AS spread FROM events) e0)""",
    "devices": """devices AS (
  SELECT device_id,
         CASE device_id % 5 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Edge' END AS browser_type,
         CASE WHEN device_id = 7 THEN NULL WHEN device_id % 3 = 0 THEN 'Windows' WHEN device_id % 3 = 1 THEN 'Mac OS X' ELSE 'Linux' END AS os_type,
         CASE device_id % 4 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Tablet' END AS device_type
  FROM (SELECT CAST(n_nationkey AS BIGINT) AS device_id FROM nation) d0)""",
    "seasons": """seasons AS (
  SELECT c.c_name AS player_name, n.n_name AS country, c.c_mktsegment AS college, a.season, a.gp, a.pts, a.ast, a.reb
  FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, COUNT(*) AS gp,
               CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS pts,
               COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS ast,
               COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS reb
        FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) AS INTEGER)) a
  JOIN customer c ON a.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "game_details": """game_details AS (
  SELECT l.l_orderkey AS game_id,
         TRY_CAST(split_part(p.p_brand, '#', 2) AS BIGINT) AS team_id,
         p.p_brand AS team_abbreviation, l.l_partkey AS player_id,
         'Player#' || CAST(l.l_partkey AS VARCHAR) AS player_name,
         l.l_linenumber AS line_number,
         CASE l.l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'F' WHEN 3 THEN 'C' END AS start_position,
         CASE WHEN l.l_linenumber = 7 THEN 'DNP - Coach''s Decision'
              WHEN l.l_linenumber = 6 AND l.l_returnflag = 'R' THEN 'DND - Injury/Illness'
              WHEN l.l_linenumber = 5 AND l.l_returnflag = 'A' THEN 'NWT - Not With Team' END AS comment,
         CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_linenumber = 4 THEN ''
              ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) || ':' || lpad(CAST(l.l_suppkey % 60 AS VARCHAR), 2, '0') END AS "min",
         CAST(l.l_quantity AS BIGINT) AS pts,
         CAST(l.l_quantity AS BIGINT) - 25 AS plus_minus,
         l.l_returnflag AS return_flag
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey)""",
    "games": """games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
         CAST(year(o_orderdate) AS INTEGER) AS season,
         o_custkey % 25 AS home_team_id, (o_custkey + 7) % 25 AS visitor_team_id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins,
         o_orderstatus AS game_status_text
  FROM orders)""",
    "teams": """teams AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS team_id, 'T' || CAST(n.n_nationkey AS VARCHAR) AS abbreviation,
         s.s_name AS nickname, n.n_name AS city, 'Arena ' || CAST(s.s_suppkey % 3 AS VARCHAR) AS arena,
         1900 + s.s_suppkey % 100 AS yearfounded
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)""",
    "films": """films AS (
  SELECT c.c_name AS actor, 'A' || CAST(o.o_custkey AS VARCHAR) AS actorid,
         'Film#' || CAST(o.o_orderkey AS VARCHAR) AS film, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(o.o_totalprice AS BIGINT) % 1000 AS votes,
         o.o_totalprice / CAST(50000 AS DOUBLE) AS rating,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS rating_units,
         'F' || CAST(o.o_orderkey AS VARCHAR) AS filmid
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)""",
    "matches": """matches AS (
  SELECT o_orderkey AS match_id, CAST(o_custkey % 25 AS INTEGER) AS mapid, o_orderpriority AS playlist_id,
         o_orderdate AS completion_date, o_orderstatus <> 'P' AS is_team_game
  FROM orders)""",
    "match_details": """match_details AS (
  SELECT l_orderkey AS match_id, 'Gamer#' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
         CAST(l_quantity AS BIGINT) AS player_total_kills,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS did_win
  FROM lineitem)""",
    "medals_matches_players": """medals_matches_players AS (
  SELECT l_orderkey AS match_id, 'Gamer#' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
         l_partkey AS medal_id, CAST(l_linenumber AS BIGINT) AS "count"
  FROM lineitem)""",
    "medals": """medals AS (
  SELECT p_partkey AS medal_id, p_name AS name, p_type AS classification, p_size AS difficulty FROM part)""",
    "maps": """maps AS (SELECT n_nationkey AS mapid, n_name AS name FROM nation)""",
}

# roles that read other roles
ROLE_DEPS: dict[str, list[str]] = {}


def with_roles(*names: str) -> str:
    """``WITH`` prefix declaring the listed role CTEs (and their dependencies)."""
    order: list[str] = []

    def add(n):
        for d in ROLE_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(ROLE_CTES[n] for n in order)
