"""Registered queries: experiments, data-quality checks, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cumulus.operators import constraints as CT
from cumulus.operators import experiments as X
from cumulus.operators import quality as Q
from cumulus.plans.common import stored
from cumulus.plans.role_sql import with_roles
from cumulus.session import shared_path
from cumulus.sources import roles
from cumulus.sources.tables import table

SALT = "signup_flow_v1"
EXPOSURE = "signup"
CONVERSION = "purchase"


def _exposures(spark, d):
    ev = roles.web_events(spark, d)
    return X.first_exposure(ev, "user_id", "event_time", F.col("event_type") == EXPOSURE, SALT)


def _outcomes(spark, d):
    ev = roles.web_events(spark, d)
    return X.user_outcomes(ev, _exposures(spark, d), "user_id", "event_time",
                           F.col("event_type") == CONVERSION, "value", window_hours=24)


def q_assign_variant(spark, d):
    users = roles.web_events(spark, d).select("user_id").dropna().distinct()
    return X.assign_variant(users, "user_id", SALT)


def q_first_exposure(spark, d):
    return _exposures(spark, d)


def _r6(df, cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def q_experiment_readout(spark, d):
    return _r6(X.experiment_readout(_outcomes(spark, d)),
               ["mean_events", "var_events", "conversion_rate", "mean_revenue", "var_revenue"])


def q_experiment_conversion(spark, d):
    return _r6(X.compare_variants(X.experiment_readout(_outcomes(spark, d))),
               ["control_rate", "treatment_rate", "z", "p_value", "welch_t"])


def q_variant_filter(spark, d):
    return X.variant_row_filter(q_assign_variant(spark, d), "user_id", ["control"])


def _sales(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    cents = F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * 100).cast("bigint")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(F.col("r_name").alias("region"), F.col("p_type").alias("product"),
                      F.year("o_orderdate").alias("period"), cents.alias("profit_cents"), "l_orderkey", "o_orderdate"))


def q_report_region_product_period(spark, d):
    return Q.rollup_report(_sales(spark, d), ["region", "product", "period"],
                           [F.sum("profit_cents").alias("profit_cents"), F.count(F.lit(1)).alias("n_lines")])


def q_dq_freshness(spark, d):
    return Q.freshness(roles.web_events(spark, d), ["event_type"], "event_time", "2024-01-30 23:00:00")


def q_dq_nulls(spark, d):
    return Q.null_counts(table(spark, d, "events"), ["ts", "user_id", "event_type", "value", "props"])


def q_dq_outliers(spark, d):
    ev = table(spark, d, "events")
    stats = stored(Q.group_stats(ev, ["event_type"], "value"), "stats")
    r = Q.outliers(ev, ["event_type"], "value", 3.0, ["event_id"], stats)
    return r.withColumn("z", F.round("z", 6))


LATE_LEVELS = (1 << 12, 1 << 20)  # buckets of the arrival order: 4,096 rows, 256 of those
ALLOWED_LATE = 6 * 3600.0


def q_dq_late(spark, d):
    """Rows behind the event times that arrived before them, by day and type; events arrive by id."""
    ev = table(spark, d, "events").select("event_id", "ts", "event_type")
    levels = [F.floor(F.col("event_id") / n) for n in LATE_LEVELS]
    return Q.late_report(Q.lateness(ev, "event_id", "ts", levels), [F.to_date("ts").alias("day"), F.col("event_type")],
                         ALLOWED_LATE)


LINE_KEY = ["l_orderkey", "l_linenumber"]


def line_rules():
    """Rules of a load of order lines, some of which test rows break."""
    return {"quantity_given": CT.not_null("l_quantity"), "discount_in_range": CT.check(F.col("l_discount") < 0.1),
            "flag_known": CT.one_of("l_returnflag", ["A", "R"])}


def q_dq_constraints(spark, d):
    """Rows of a load that break each rule, and those accepted; both kinds are written in one pass."""
    lines = table(spark, d, "lineitem")
    have = table(spark, d, "orders").where("o_orderstatus = 'F'").join(
        lines.select("l_orderkey", "l_linenumber"), F.col("o_orderkey") == F.col("l_orderkey")).select(*LINE_KEY)
    judged = CT.judge(lines, line_rules(), LINE_KEY, have.where("l_linenumber = 1"))
    path = shared_path(spark, f"lines-{uuid.uuid4().hex}")
    told = CT.write_judged(judged, path, [*line_rules(), "duplicate_key", "known_key"])
    broken = CT.rule_counts(spark.read.parquet(path).where(F.col(CT.ACCEPTED) == 0))
    accepted = spark.read.parquet(path).where(F.col(CT.ACCEPTED) == 1).agg(F.count(F.lit(1)).alias("n_rows"))
    return broken.unionByName(accepted.select(F.lit("(accepted)").alias("rule"), "n_rows")).withColumn(
        "observed", F.create_map(*[F.lit(x).cast("string" if isinstance(x, str) else "long") for k, v in told.items() for x in ("(accepted)" if k == "n_accepted" else k, v)])[F.col("rule")])


def q_unit_profit(spark, d):
    li = table(spark, d, "lineitem")
    cents = F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * 100).cast("bigint")
    return li.groupBy("l_orderkey").agg(F.sum(cents).alias("revenue_cents"), F.count(F.lit(1)).alias("n_lines"))


def q_daily_growth(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    cents = F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * 100).cast("bigint")
    daily = li.join(o, "l_orderkey").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.sum(cents).alias("revenue_cents"))
    return Q.day_over_day(daily, "day", "revenue_cents").withColumn("growth", F.round("growth", 6))


QUERIES = {
    "assign_variant": q_assign_variant,
    "first_exposure": q_first_exposure,
    "experiment_readout": q_experiment_readout,
    "experiment_conversion": q_experiment_conversion,
    "variant_filter": q_variant_filter,
    "report_region_product_period": q_report_region_product_period,
    "dq_freshness": q_dq_freshness,
    "dq_nulls": q_dq_nulls,
    "dq_outliers": q_dq_outliers,
    "dq_late": q_dq_late,
    "dq_constraints": q_dq_constraints,
    "unit_profit": q_unit_profit,
    "daily_growth": q_daily_growth,
}

_VARIANT = "CASE WHEN CAST('0x' || substr(md5('signup_flow_v1' || CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 50 THEN 'control' ELSE 'treatment' END"

_EXP = with_roles("web_events") + f""",
expo AS (SELECT user_id, MIN(event_time) AS first_exposure_time, {_VARIANT} AS variant
         FROM web_events WHERE event_type = 'signup' AND user_id IS NOT NULL GROUP BY user_id),
outc AS (SELECT e.user_id, x.variant, COUNT(*) AS n_events,
                MAX(CASE WHEN e.event_type = 'purchase' AND e.event_time < x.first_exposure_time + INTERVAL 24 HOUR
                         THEN 1 ELSE 0 END) AS converted,
                SUM(CASE WHEN e.event_type = 'purchase' AND e.event_time < x.first_exposure_time + INTERVAL 24 HOUR
                         THEN e.value ELSE 0.0 END) AS revenue
         FROM web_events e JOIN expo x ON e.user_id = x.user_id
         WHERE e.event_time >= x.first_exposure_time GROUP BY e.user_id, x.variant),
ro AS (SELECT variant, COUNT(*) AS n_users, AVG(n_events) AS mean_events, var_samp(n_events) AS var_events,
              AVG(converted) AS conversion_rate, AVG(revenue) AS mean_revenue, var_samp(revenue) AS var_revenue
       FROM outc GROUP BY variant)"""


def _pval_sql(z):
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.3275911 * {x}))"
    poly = (f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))))")
    erf = f"(1.0 - {poly} * exp(-{x} * {x}))"
    return f"(2.0 * (1.0 - (1.0 + {erf}) / 2))"


_SALES = """
sales AS (SELECT r.r_name AS region, p.p_type AS product, CAST(year(o.o_orderdate) AS INTEGER) AS period,
                 CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT) AS profit_cents
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
          JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
          JOIN part p ON l.l_partkey = p.p_partkey)"""

ORACLE = {
    "assign_variant": with_roles("web_events") + f"""
SELECT user_id, {_VARIANT} AS variant FROM (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL) u""",
    "first_exposure": _EXP + "\nSELECT user_id, first_exposure_time, variant FROM expo",
    "experiment_readout": _EXP + """
SELECT variant, n_users, round(mean_events, 6) AS mean_events, round(var_events, 6) AS var_events,
       round(conversion_rate, 6) AS conversion_rate, round(mean_revenue, 6) AS mean_revenue,
       round(var_revenue, 6) AS var_revenue FROM ro""",
    "experiment_conversion": _EXP + """,
one AS (SELECT MAX(CASE WHEN variant = 'control' THEN CAST(n_users AS DOUBLE) END) AS n1,
               MAX(CASE WHEN variant = 'treatment' THEN CAST(n_users AS DOUBLE) END) AS n2,
               MAX(CASE WHEN variant = 'control' THEN conversion_rate END) AS p1,
               MAX(CASE WHEN variant = 'treatment' THEN conversion_rate END) AS p2,
               MAX(CASE WHEN variant = 'control' THEN mean_revenue END) AS m1,
               MAX(CASE WHEN variant = 'treatment' THEN mean_revenue END) AS m2,
               MAX(CASE WHEN variant = 'control' THEN var_revenue END) AS v1,
               MAX(CASE WHEN variant = 'treatment' THEN var_revenue END) AS v2 FROM ro),
zz AS (SELECT *, (p2 - p1) / NULLIF(sqrt(((p1 * n1 + p2 * n2) / (n1 + n2)) * (1.0 - (p1 * n1 + p2 * n2) / (n1 + n2))
                   * (1.0 / n1 + 1.0 / n2)), 0) AS z FROM one)
SELECT round(p1, 6) AS control_rate, round(p2, 6) AS treatment_rate, round(z, 6) AS z,
       round(""" + _pval_sql("z") + """, 6) AS p_value, round((m2 - m1) / NULLIF(sqrt(v1 / n1 + v2 / n2), 0), 6) AS welch_t FROM zz""",
    "variant_filter": with_roles("web_events") + f"""
SELECT user_id, variant FROM (SELECT user_id, {_VARIANT} AS variant
  FROM (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL) u) v
WHERE user_id % 2 = CASE WHEN variant = 'control' THEN 1 ELSE 0 END""",
    "report_region_product_period": "WITH" + _SALES + """
SELECT region, product, period, CAST(SUM(profit_cents) AS BIGINT) AS profit_cents, COUNT(*) AS n_lines,
       CAST(GROUPING(region, product, period) AS BIGINT) AS grouping_level
FROM sales GROUP BY ROLLUP (region, product, period)""",
    "dq_freshness": with_roles("web_events") + """
SELECT event_type, MAX(event_time) AS max_event_time, COUNT(*) AS n_rows,
       MAX(event_time) < TIMESTAMP '2024-01-30 23:00:00' AS is_stale FROM web_events GROUP BY 1""",
    "dq_nulls": """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE ts IS NULL) AS null_ts, COUNT(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
       COUNT(*) FILTER (WHERE event_type IS NULL) AS null_event_type, COUNT(*) FILTER (WHERE value IS NULL) AS null_value,
       COUNT(*) FILTER (WHERE props IS NULL) AS null_props FROM events""",
    "dq_outliers": """
WITH st AS (SELECT event_type, AVG(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1)
SELECT e.event_id, e.event_type, e.value, round((e.value - st.mu) / st.sd, 6) AS z
FROM events e JOIN st ON e.event_type = st.event_type WHERE abs((e.value - st.mu) / st.sd) > 3.0""",
    "dq_constraints": """
WITH have AS (SELECT DISTINCT l_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey
              WHERE o_orderstatus = 'F' AND l_linenumber = 1),
j AS (SELECT l_quantity IS NOT NULL AS a, coalesce(l_discount < 0.1, true) AS b, coalesce(l_returnflag IN ('A', 'R'), true) AS c,
             l_orderkey IS NULL OR l_linenumber IS NULL
               OR row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1 AS d,
             h.l_orderkey IS NULL AS e
      FROM lineitem LEFT JOIN have h USING (l_orderkey, l_linenumber)),
r AS (SELECT '(accepted)' AS rule, COUNT(*) FILTER (WHERE a AND b AND c AND d AND e) AS n_rows FROM j
      UNION ALL SELECT 'quantity_given', COUNT(*) FILTER (WHERE NOT a) FROM j
      UNION ALL SELECT 'discount_in_range', COUNT(*) FILTER (WHERE NOT b) FROM j
      UNION ALL SELECT 'flag_known', COUNT(*) FILTER (WHERE NOT c) FROM j
      UNION ALL SELECT 'duplicate_key', COUNT(*) FILTER (WHERE NOT d) FROM j
      UNION ALL SELECT 'known_key', COUNT(*) FILTER (WHERE NOT e) FROM j)
SELECT rule, n_rows, n_rows AS observed FROM r WHERE n_rows > 0 OR rule = '(accepted)'""",
    "dq_late": """
WITH o AS (SELECT ts, event_type, max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events),
g AS (SELECT CAST(ts AS DATE) AS day, event_type,
             CASE WHEN ts IS NOT NULL THEN greatest(coalesce((epoch_us(seen) - epoch_us(ts)) / 1e6, 0.0), 0.0) END AS late FROM o)
SELECT day, event_type, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE late > 0) AS n_late,
       COUNT(*) FILTER (WHERE late > 21600) AS n_dropped, MAX(late) AS max_late_seconds FROM g GROUP BY 1, 2""",
    "unit_profit": """
SELECT l_orderkey, CAST(SUM(CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS revenue_cents,
       COUNT(*) AS n_lines FROM lineitem GROUP BY 1""",
    "daily_growth": """
WITH daily AS (SELECT CAST(o.o_orderdate AS DATE) AS day,
                      CAST(SUM(CAST(round(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
               FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1)
SELECT d.day, d.revenue_cents, p.revenue_cents AS prev_revenue_cents,
       round(CAST(d.revenue_cents - p.revenue_cents AS DOUBLE) / CAST(p.revenue_cents AS DOUBLE), 6) AS growth
FROM daily d LEFT JOIN daily p ON p.day = d.day - 1""",
}
