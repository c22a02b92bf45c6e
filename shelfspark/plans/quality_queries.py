"""Data-quality and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import drift, quality
from shelfspark.plans.prepare_queries import RAW_COLUMNS
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import (
    RAW_SQL, SALES_SQL, SIDES_SQL, reference_current, sales, sales_raw, table,
)
from shelfspark.session import run_folder

HOLES_SQL = """
holes AS (SELECT l_orderkey, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS units,
                 CASE WHEN l_tax = 0.03 THEN NULL ELSE l_extendedprice END AS price FROM lineitem)"""


def holes(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("units"),
        F.when(F.col("l_tax") != 0.03, F.col("l_extendedprice")).alias("price"),
    )


@query(
    "missing",
    "WITH " + HOLES_SQL + ", n AS (SELECT count(*) AS n FROM holes), m AS ("
    "SELECT 'l_orderkey' AS column_name, count(*) FILTER (l_orderkey IS NULL) AS missing FROM holes "
    "UNION ALL SELECT 'units', count(*) FILTER (units IS NULL) FROM holes "
    "UNION ALL SELECT 'price', count(*) FILTER (price IS NULL) FROM holes) "
    "SELECT column_name, missing, round(missing / n, 6) AS share, missing / n > 0.1 AS exceeds FROM m, n",
)
def missing(spark, sf):
    return rounded(quality.missing_values(holes(spark, sf)), 6)


@query(
    "completeness",
    "WITH " + HOLES_SQL + " SELECT * FROM (SELECT 'units' AS column_name, "
    "round(count(*) FILTER (units IS NULL) * 100.0::DOUBLE / count(*), 4) AS percent FROM holes UNION ALL "
    "SELECT 'price', round(count(*) FILTER (price IS NULL) * 100.0::DOUBLE / count(*), 4) FROM holes) WHERE percent > 9.5",
)
def completeness(spark, sf):
    return rounded(quality.completeness(holes(spark, sf), ["units", "price"], 9.5))


DUP_SQL = RAW_SQL + ", d AS (SELECT date, sku_id, store_id, units, promo_flag FROM raw)"
DUP_COLUMNS = ["date", "sku_id", "store_id", "units", "promo_flag"]


@query(
    "duplicates",
    "WITH " + DUP_SQL + " SELECT (SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS full_duplicates, "
    "(SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT DISTINCT date, sku_id, store_id FROM d)) AS key_duplicates",
)
def duplicates(spark, sf):
    return quality.duplicate_counts(sales_raw(spark, sf).select(*DUP_COLUMNS))


@query(
    "mark_duplicates",
    "WITH " + DUP_SQL + ", m AS (SELECT *, row_number() OVER (PARTITION BY date, sku_id, store_id "
    "ORDER BY units, promo_flag) AS rn FROM d) "
    "SELECT date, sku_id, store_id, units, promo_flag, count(*) AS repeats FROM m WHERE rn > 1 GROUP BY ALL",
)
def mark_duplicates(spark, sf):
    return quality.mark_duplicates(
        sales_raw(spark, sf).select(*DUP_COLUMNS), ["date", "sku_id", "store_id"], ["units", "promo_flag"]
    )


@query(
    "date_range",
    "SELECT count(*) FILTER (o_orderdate < DATE '1996-01-01') AS before_min, "
    "count(*) FILTER (o_orderdate > DATE '2000-01-01') AS after_max, "
    "count(*) FILTER (o_orderdate > DATE '2001-01-01') AS future FROM orders",
)
def date_range(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").alias("date"))
    return quality.date_range(orders, F.lit("2001-01-01").cast("date"), "1996-01-01", "2000-01-01")


@query(
    "day_coverage",
    "WITH d AS (SELECT CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS INTEGER) AS days FROM orders) "
    "SELECT days, days < 30 AS too_short, days > 1000 AS very_long FROM d",
)
def day_coverage(spark, sf):
    return quality.day_coverage(table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date")))


@query(
    "numeric_range",
    "SELECT count(*) FILTER (c_acctbal < 0) AS negative, count(*) FILTER (c_acctbal < 100) AS below_min, "
    "count(*) FILTER (c_acctbal > 9000) AS above_max FROM customer",
)
def numeric_range(spark, sf):
    return quality.numeric_range(table(spark, sf, "customer"), "c_acctbal", 100.0, 9000.0)


@query(
    "outliers_z",
    "WITH " + SALES_SQL + ", s AS (SELECT avg(units) AS m, stddev_samp(units) AS d FROM sales) "
    "SELECT date, sku_id, store_id, units FROM sales, s WHERE abs((units - m) / d) > 2.5",
)
def outliers_z(spark, sf):
    flagged = quality.outliers_z(sales(spark, sf).select("date", "sku_id", "store_id", "units"), "units", 2.5)
    return flagged.where("is_outlier").drop("is_outlier")


def _iqr_sql(columns: list[str], rows: str) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} < 2.5 * q1 - 1.5 * q3 OR {c} > 2.5 * q3 - 1.5 * q1) AS outliers "
        f"FROM {rows}, (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {rows})"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query("outliers_iqr", _iqr_sql(["l_quantity", "l_extendedprice", "l_tax"], "lineitem"))
def outliers_iqr(spark, sf):
    return quality.outliers_iqr(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


@query(
    "iqr_fences",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(2.5 * q1 - 1.5 * q3, 4) AS low, round(2.5 * q3 - 1.5 * q1, 4) AS high, "
        f"round(q3 - q1, 4) AS iqr FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM orders)"
        for c in ["o_totalprice"]
    ),
)
def iqr_fences(spark, sf):
    return rounded(quality.iqr_fences(table(spark, sf, "orders"), ["o_totalprice"]))


@query(
    "format_check",
    "SELECT CAST(sum(n) AS BIGINT) AS invalid, array_to_string(list_sort(list(sku_id))[1:5], ',') AS examples "
    "FROM (SELECT p_brand AS sku_id, count(*) AS n FROM part GROUP BY 1)",
)
def format_check(spark, sf):
    out = quality.format_check(table(spark, sf, "part").select(F.col("p_brand").alias("sku_id")))
    return out.withColumn("examples", F.array_join("examples", ","))


@query(
    "allowed_values",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1",
)
def allowed_values(spark, sf):
    bad = quality.not_allowed(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return bad.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "orphans",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT EXISTS "
    "(SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')",
)
def orphans(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    done = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return quality.orphans(line, "l_orderkey", done, "o_orderkey")


@query(
    "referential_integrity",
    "SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) "
    "AS lines, (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS labels",
)
def referential_integrity(spark, sf):
    done = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    lines = quality.orphan_count(table(spark, sf, "lineitem"), "l_orderkey", done, "o_orderkey")
    labels = quality.orphan_count(table(spark, sf, "labels"), "doc_id", table(spark, sf, "documents"), "doc_id")
    return lines.select(F.col("orphans").alias("lines"), labels.scalar().alias("labels"))


CONTINUITY_SQL = "WITH " + SALES_SQL + """,
d AS (SELECT sku_id, store_id, date, lead(date) OVER (PARTITION BY sku_id, store_id ORDER BY date) AS nxt FROM sales)
"""


@query(
    "continuity",
    CONTINUITY_SQL + "SELECT sku_id, store_id, CAST(sum(nxt - date - 1) AS BIGINT) AS missing_dates, "
    "min(CASE WHEN nxt - date > 1 THEN date + 1 END) AS first_missing FROM d WHERE nxt - date > 1 GROUP BY 1, 2",
)
def continuity(spark, sf):
    return quality.continuity(sales(spark, sf))


@query(
    "continuity_weekly",
    "WITH d AS (SELECT DISTINCT o_orderstatus AS s, CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE date_trunc('month', o_orderdate) END AS DATE) AS date FROM orders), "
    "e AS (SELECT s, min(date) AS lo, max(date) AS hi FROM d GROUP BY s), "
    "g AS (SELECT s, CAST(lo + CAST(7 * i AS INTEGER) AS DATE) AS date FROM e, generate_series(0, 1000) t(i) WHERE lo + CAST(7 * i AS INTEGER) <= hi) "
    "SELECT g.s AS status, count(*) AS missing_dates, min(g.date) AS first_missing FROM g "
    "LEFT JOIN d x ON x.s = g.s AND x.date = g.date WHERE x.date IS NULL GROUP BY 1",
)
def continuity_weekly(spark, sf):
    """All orders, those of two statuses on the first day of their month, checked on weekly steps."""
    day = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).otherwise(F.date_trunc("month", "o_orderdate"))
    orders = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), day.cast("date").alias("date"))
    return quality.continuity(orders, ["status"], "W")


@query(
    "continuity_total",
    "WITH d AS (SELECT DISTINCT CAST(CASE WHEN event_type = 'error' AND value > 20 THEN ts ELSE date_trunc('week', ts) END AS DATE) AS date FROM events) "
    "SELECT CAST(max(date) - min(date) + 1 - count(*) AS BIGINT) AS missing_dates, max(date) - min(date) + 1 > count(*) AS has_gaps FROM d",
)
def continuity_total(spark, sf):
    """All events, most of them on the first day of their week."""
    rare = (F.col("event_type") == "error") & (F.col("value") > 20)
    day = F.when(rare, F.col("ts")).otherwise(F.date_trunc("week", "ts"))
    return quality.continuity_total(table(spark, sf, "events").select(day.cast("date").alias("date")))


@query(
    "missing_dates",
    "WITH " + SALES_SQL + """, p AS (SELECT sku_id, store_id, min(date) AS lo, max(date) AS hi FROM sales GROUP BY 1, 2),
    c AS (SELECT sku_id, store_id, CAST(d AS DATE) AS date FROM p, generate_series(lo, hi, INTERVAL 1 DAY) g(d))
    SELECT sku_id, store_id, date FROM c ANTI JOIN sales USING (sku_id, store_id, date)""",
)
def missing_dates(spark, sf):
    return quality.missing_dates(sales(spark, sf), ["sku_id", "store_id"])


@query("sku_count", "SELECT count(DISTINCT p_brand) AS skus, count(DISTINCT p_brand) >= 30 AS enough FROM part")
def sku_count(spark, sf):
    return quality.sku_count(table(spark, sf, "part").select(F.col("p_brand").alias("sku_id")), 30)


@query(
    "model_ready",
    "SELECT count(*) AS \"rows\", count(*) FILTER (l_quantity > 49) AS nulls, "
    "count(*) >= 30 AND count(*) FILTER (l_quantity > 49) = 0 AS ready FROM lineitem",
)
def model_ready(spark, sf):
    data = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_partkey").cast("string").alias("sku_id"),
        F.when(F.col("l_quantity") <= 49, F.col("l_quantity")).alias("units"),
    )
    return quality.model_ready(data)


REPORT_SQL = "WITH " + RAW_SQL + """,
q AS (SELECT date, CASE WHEN l_tax = 0.08 THEN 'bad-' || sku_id ELSE sku_id END AS sku_id, store_id,
             CASE WHEN l_discount = 0.1 THEN NULL WHEN l_linenumber = 7 THEN -units ELSE units END AS units, price FROM raw),
n AS (SELECT count(*) AS n, avg(units) AS m, stddev_samp(units) AS s, max(date) AS hi FROM q),
findings AS (
  SELECT CASE WHEN count(*) FILTER (units IS NULL) > 0.1 * count(*) THEN 'critical' ELSE 'warning' END AS severity,
         'missing' AS category, 'units' AS column_name, count(*) FILTER (units IS NULL) AS affected_rows FROM q
  UNION ALL SELECT 'warning', 'duplicates', NULL, (SELECT count(*) FROM q) - (SELECT count(*) FROM (SELECT DISTINCT * FROM q))
  UNION ALL SELECT 'critical', 'duplicates', 'date, sku_id, store_id',
    (SELECT count(*) FROM q) - (SELECT count(*) FROM (SELECT DISTINCT date, sku_id, store_id FROM q))
  UNION ALL SELECT 'warning', 'date_range', 'date', count(*) FILTER (date > DATE '2001-06-01') FROM q
  UNION ALL SELECT 'warning', 'date_range', 'date', count(*) FILTER (date < DATE '1995-06-01') FROM q
  UNION ALL SELECT 'critical', 'numeric_range', 'units', count(*) FILTER (units < 0) FROM q
  UNION ALL SELECT CASE WHEN count(*) FILTER (abs((units - m) / s) > 2) < 0.05 * count(*) THEN 'warning' ELSE 'critical' END,
    'outlier', 'units', count(*) FILTER (abs((units - m) / s) > 2) FROM q, n
  UNION ALL SELECT 'warning', 'consistency', 'sku_id', count(*) FILTER (sku_id LIKE 'bad-%') FROM q),
hits AS (SELECT * FROM findings WHERE affected_rows > 0)
"""


def report(spark, sf):
    raw = sales_raw(spark, sf).select(
        "date",
        F.when(F.col("l_tax") == 0.08, F.concat(F.lit("bad-"), "sku_id")).otherwise(F.col("sku_id")).alias("sku_id"),
        "store_id",
        F.when(F.col("l_discount") == 0.1, F.lit(None))
        .when(F.col("l_linenumber") == 7, -F.col("units")).otherwise(F.col("units")).alias("units"),
        "price",
    )
    return quality.quality_report(raw, as_of="2001-06-01", outlier_std=2.0, min_date="1995-06-01")


@query("quality_report", REPORT_SQL + "SELECT severity, category, column_name, affected_rows FROM hits")
def quality_report(spark, sf):
    return report(spark, sf).select("severity", "category", "column_name", "affected_rows")


@query(
    "quality_summary",
    REPORT_SQL + "SELECT severity, category, count(*) AS issues, CAST(sum(affected_rows) AS BIGINT) AS affected_rows, "
    "CASE WHEN severity IS NULL AND category IS NULL THEN count(*) FILTER (is_critical) = 0 END AS passed "
    "FROM (SELECT *, severity = 'critical' AS is_critical FROM hits) GROUP BY GROUPING SETS ((severity), (category), ())",
)
def quality_summary(spark, sf):
    return quality.report_summary(report(spark, sf))


@query(
    "profile",
    "WITH " + RAW_SQL + """, d AS (SELECT date, sku_id, store_id, units, l_extendedprice AS value, promo_flag FROM raw),
    u AS (""" + _iqr_sql(["units", "value"], "d") + """)
    SELECT count(*) AS "rows", 6 AS columns, count(DISTINCT sku_id) AS skus, min(date) AS min_date, max(date) AS max_date,
      CAST(max(date) - min(date) AS INTEGER) AS days,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS duplicates,
      (SELECT outliers FROM u WHERE column_name = 'units') AS outliers_units,
      (SELECT outliers FROM u WHERE column_name = 'value') AS outliers_value,
      CAST(0 AS DOUBLE) AS missing_units FROM d""",
)
def profile(spark, sf):
    data = sales_raw(spark, sf).select(
        "date", "sku_id", "store_id", "units", F.col("l_extendedprice").alias("value"), "promo_flag"
    )
    out = quality.profile(data)
    return out.select(
        "rows", "columns", "skus", "min_date", "max_date", "days", "duplicates",
        F.col("outliers")["units"].alias("outliers_units"), F.col("outliers")["value"].alias("outliers_value"),
        F.col("missing_percent")["units"].alias("missing_units"),
    )


@query(
    "file_validation",
    "WITH " + RAW_SQL + """, n AS (SELECT count(*) AS n, count(*) FILTER (date IS NULL) AS bad, max(date) - min(date) AS span,
      count(*) FILTER (units < 0) AS nu, count(*) FILTER (price < 0) AS np, count(DISTINCT sku_id) AS skus,
      count(*) - count(DISTINCT (date, sku_id, store_id)) AS rep, count(*) FILTER (sku_id IS NULL) AS ns,
      count(*) FILTER (units IS NULL) AS nn FROM raw)
    SELECT CAST(step AS INTEGER) AS step, check_name, failed, CAST(detail AS VARCHAR) AS detail FROM (
      SELECT 1 AS step, 'rows' AS check_name, n = 0 AS failed, n AS detail FROM n UNION ALL
      SELECT 2, 'dates', bad > 0, bad FROM n UNION ALL SELECT 3, 'day_coverage', span < 30, span FROM n UNION ALL
      SELECT 4, 'units_not_negative', nu > 0, nu FROM n UNION ALL SELECT 5, 'price_not_negative', np > 0, np FROM n UNION ALL
      SELECT 6, 'sku_count', skus < 1, skus FROM n UNION ALL SELECT 7, 'repeated_keys', false, rep FROM n UNION ALL
      SELECT 8, 'date_complete', bad > 0.1 * n, bad FROM n UNION ALL SELECT 9, 'sku_id_complete', ns > 0.1 * n, ns FROM n UNION ALL
      SELECT 10, 'units_complete', nn > 0.1 * n, nn FROM n)""",
)
def file_validation(spark, sf):
    """Raw lines as a new file; repeated keys are counted but do not fail it."""
    return quality.file_validation(sales_raw(spark, sf).select(*RAW_COLUMNS))


# ---- drift --------------------------------------------------------------------------------------------------------


def _stats_sql(columns: list[str], rows: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75 FROM {rows}"
        for c in columns
    )


@query("column_stats", "WITH " + SIDES_SQL + " " + _stats_sql(["units", "price"], "ref"))
def column_stats(spark, sf):
    return rounded(drift.reference_stats(reference_current(spark, sf)[0], ["units", "price"]))


def _ks_sql(c: str) -> str:
    return f"""k_{c} AS (
  SELECT max(abs(r / nr - c / nc)) AS d, max(nr) AS n_ref, max(nc) AS n_cur FROM (
    SELECT sum(is_ref) OVER w AS r, sum(1 - is_ref) OVER w AS c, sum(is_ref) OVER () AS nr, sum(1 - is_ref) OVER () AS nc
    FROM (SELECT {c} AS v, 1 AS is_ref FROM ref UNION ALL SELECT {c}, 0 FROM cur) WINDOW w AS (ORDER BY v RANGE UNBOUNDED PRECEDING)))"""


KS_SQL = "WITH " + SIDES_SQL + ", " + _ks_sql("units") + ", " + _ks_sql("price") + """,
mr AS (SELECT avg(units) AS um, stddev_samp(units) AS us, avg(price) AS pm, stddev_samp(price) AS ps FROM ref),
mc AS (SELECT avg(units) AS um, stddev_samp(units) AS us, avg(price) AS pm, stddev_samp(price) AS ps FROM cur)
"""


@query(
    "ks_drift",
    KS_SQL + "SELECT 'units' AS column_name, round(d, 6) AS ks_statistic, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, "
    "round((mc.um - mr.um) / mr.um * 100, 4) AS mean_change_pct, round((mc.us - mr.us) / mr.us * 100, 4) AS std_change_pct "
    "FROM k_units, mr, mc UNION ALL SELECT 'price', round(d, 6), CAST(n_ref AS BIGINT), CAST(n_cur AS BIGINT), "
    "round((mc.pm - mr.pm) / mr.pm * 100, 4), round((mc.ps - mr.ps) / mr.ps * 100, 4) FROM k_price, mr, mc",
)
def ks_drift(spark, sf):
    ref, cur = reference_current(spark, sf)
    out = drift.ks_drift(ref, cur, ["units", "price"])
    return out.select(
        "column_name", F.round("ks_statistic", 6).alias("ks_statistic"), "n_ref", "n_cur",
        (F.round("mean_change_pct", 4) + F.lit(0.0)).alias("mean_change_pct"),
        (F.round("std_change_pct", 4) + F.lit(0.0)).alias("std_change_pct"),
    )


def _p_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, d * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS x FROM k_{c}"""


@query(
    "ks_pvalue",
    KS_SQL + ", x AS (" + _p_sql("units") + " UNION ALL " + _p_sql("price") + "), p AS (SELECT column_name, greatest(0, least(1, "
    "CASE WHEN x > 1 THEN list_sum(list_transform(generate_series(1, 10), lambda k: 2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * k * k * x * x))) "
    "ELSE 1 - sqrt(2 * pi()) / x * list_sum(list_transform(generate_series(1, 10), lambda k: exp(-((2 * k - 1) ** 2) * pi() ** 2 / (8 * x * x)))) END)) AS p FROM x) "
    "SELECT column_name, round(p, 6) AS ks_pvalue, p < 0.05 AS has_drift FROM p",
)
def ks_pvalue(spark, sf):
    """The asymptotic p-value and the flag."""
    ref, cur = reference_current(spark, sf)
    return rounded(drift.ks_drift(ref, cur, ["units", "price"], exact_rows=0).select("column_name", "ks_pvalue", "has_drift"), 6)


# account balances of suppliers against those of customers: few enough for the exact law at the scale of the tests
EXACT_SQL = """
WITH RECURSIVE v AS (SELECT c_acctbal::DOUBLE AS v, 1 AS is_ref FROM customer UNION ALL SELECT s_acctbal::DOUBLE, 0 FROM supplier),
g AS (SELECT max(abs(r / nr - c / nc)) AS d, max(nr)::BIGINT AS m, max(nc)::BIGINT AS n FROM (
        SELECT sum(is_ref) OVER w AS r, sum(1 - is_ref) OVER w AS c, sum(is_ref) OVER () AS nr, sum(1 - is_ref) OVER () AS nc
        FROM v WINDOW w AS (ORDER BY v RANGE UNBOUNDED PRECEDING))),
w AS (SELECT d, m, n, round(d * m * n)::BIGINT AS wide FROM g),
p AS (SELECT 0::BIGINT AS k, [1.0::DOUBLE] || list_transform(range(n), lambda x: 0.0::DOUBLE) AS s FROM w
      UNION ALL
      SELECT k + 1, list_transform(range(n + 1), lambda j: CASE WHEN j > k + 1 OR k + 1 - j > m OR abs(j * m - (k + 1 - j) * n) >= wide THEN 0.0
               ELSE (CASE WHEN j > 0 THEN s[j] * j ELSE 0 END + CASE WHEN k + 1 - j > 0 THEN s[j + 1] * (k + 1 - j) ELSE 0 END) / (k + 1) END)
      FROM p, w WHERE k < m + n)
SELECT 'balance' AS column_name, round(d, 6) AS ks_statistic, m AS n_ref, n AS n_cur, 'exact' AS p_method, round(1 - s[n + 1], 9) AS ks_pvalue
FROM p, w WHERE k = m + n
"""


@query("ks_exact", EXACT_SQL)
def ks_exact(spark, sf):
    ref = table(spark, sf, "customer").select(F.col("c_acctbal").cast("double").alias("balance"))
    cur = table(spark, sf, "supplier").select(F.col("s_acctbal").cast("double").alias("balance"))
    out = drift.ks_drift(ref, cur, ["balance"], exact_rows=10**9)
    return out.select("column_name", F.round("ks_statistic", 6).alias("ks_statistic"), "n_ref", "n_cur", F.lit("exact").alias("p_method"), F.round("ks_pvalue", 9).alias("ks_pvalue"))


@query(
    "drift_profile",
    KS_SQL + ", x AS (" + _p_sql("units") + " UNION ALL " + _p_sql("price") + "), p AS (SELECT column_name, greatest(0, least(1, "
    "CASE WHEN x > 1 THEN list_sum(list_transform(generate_series(1, 10), lambda k: 2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * k * k * x * x))) "
    "ELSE 1 - sqrt(2 * pi()) / x * list_sum(list_transform(generate_series(1, 10), lambda k: exp(-((2 * k - 1) ** 2) * pi() ** 2 / (8 * x * x)))) END)) AS p FROM x) "
    "SELECT column_name, n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur, p < 0.05 AS has_drift, true AS bounded, mean_change_pct, std_change_pct FROM p JOIN ("
    "SELECT 'units' AS column_name, n_ref, n_cur, round((mc.um - mr.um) / mr.um * 100, 4) AS mean_change_pct, round((mc.us - mr.us) / mr.us * 100, 4) AS std_change_pct "
    "FROM k_units, mr, mc UNION ALL SELECT 'price', n_ref, n_cur, round((mc.pm - mr.pm) / mr.pm * 100, 4), round((mc.ps - mr.ps) / mr.ps * 100, 4) FROM k_price, mr, mc) USING (column_name)",
)
def drift_profile(spark, sf):
    """Fitted once on the reference, then checked without it; the bounds of the statistic are less than a share apart."""
    ref, cur = reference_current(spark, sf)
    path = run_folder(spark, "drift-profile")
    drift.fit_profile(ref, path, ["units", "price"])
    out = drift.detect_drift(cur, path, ["units", "price"], reference=lambda: ref, exact_rows=0)
    bounded = (F.col("ks_low") <= F.col("ks_high")) & (F.col("ks_high") - F.col("ks_low") < drift.PROFILE_SHARE)
    return out.select(
        "column_name", "n_ref", "n_cur", "has_drift", bounded.alias("bounded"),
        (F.round("mean_change_pct", 4) + F.lit(0.0)).alias("mean_change_pct"), (F.round("std_change_pct", 4) + F.lit(0.0)).alias("std_change_pct"),
    )


@query(
    "target_drift",
    KS_SQL + "SELECT 'units' AS target, round(d, 6) AS ks_statistic, round(mr.um, 4) AS ref_mean, round(mc.um, 4) AS cur_mean, "
    "CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur FROM k_units, mr, mc",
)
def target_drift(spark, sf):
    ref, cur = reference_current(spark, sf)
    out = drift.target_drift(ref, cur)
    return out.select(
        "target", F.round("ks_statistic", 6).alias("ks_statistic"), F.round("ref_mean", 4).alias("ref_mean"),
        F.round("cur_mean", 4).alias("cur_mean"), "n_ref", "n_cur",
    )


def _psi_sql(c: str) -> str:
    marks = ", ".join(str(i / 10) for i in range(11))
    return f"""
e_{c} AS (SELECT list_sort(list_distinct(quantile_cont({c}::DOUBLE, [{marks}]))) AS e FROM ref),
b_{c} AS (SELECT unnest(generate_series(1, len(e) - 1)) AS i, e FROM e_{c}),
s_{c} AS (SELECT i,
   (SELECT count(*) FROM ref WHERE {c} >= e[i] AND ({c} < e[i + 1] OR (i = len(e) - 1 AND {c} = e[i + 1]))) / (SELECT count(*) FROM ref) AS r,
   (SELECT count(*) FROM cur WHERE {c} >= e[i] AND ({c} < e[i + 1] OR (i = len(e) - 1 AND {c} = e[i + 1]))) / (SELECT count(*) FROM cur) AS k
   FROM b_{c}),
p_{c} AS (SELECT CASE WHEN r = 0 THEN 0.0001 ELSE r END AS r, CASE WHEN k = 0 THEN 0.0001 ELSE k END AS k FROM s_{c})"""


@query(
    "psi",
    "WITH " + SIDES_SQL + "," + _psi_sql("units") + "," + _psi_sql("price")
    + " SELECT 'units' AS column_name, round(sum((k - r) * ln(k / r)), 6) AS psi FROM p_units "
    "UNION ALL SELECT 'price', round(sum((k - r) * ln(k / r)), 6) FROM p_price",
)
def psi(spark, sf):
    ref, cur = reference_current(spark, sf)
    return rounded(drift.psi(ref, cur, ["units", "price"]), 6)

