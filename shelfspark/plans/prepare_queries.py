"""Preparation queries: columns, filters, cleaning, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import scalars
from shelfspark.operators import clean, columns, features, prepare, summary
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import RAW_ORDER, RAW_SQL, SALES_SQL, sales, sales_raw, table
from shelfspark.session import run_folder

SALES_COLUMNS = ["date", "sku_id", "store_id", "category", "units", "price", "promo_flag"]
RAW_COLUMNS = [*SALES_COLUMNS, *RAW_ORDER]


def raw_sales(spark, sf):
    """Raw lines with the columns of a sales table and those that fix their order."""
    return sales_raw(spark, sf).select(*RAW_COLUMNS)


@query(
    "normalize_headers",
    "SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS sku_id, l_quantity AS units FROM lineitem",
)
def normalize_headers(spark, sf):
    line = table(spark, sf, "lineitem")
    messy = line.select(
        F.col("l_shipdate").cast("date").alias(" Date"), F.col("l_partkey").alias("SKU_ID "),
        F.col("l_quantity").alias("Qty"),
    )
    return columns.normalize_headers(messy)


@query(
    "ensure_columns",
    "SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_partkey AS VARCHAR) AS sku_id, l_quantity AS units, "
    "'S01' AS store_id, CAST(0 AS DOUBLE) AS price, 0 AS promo_flag FROM lineitem",
)
def ensure_columns(spark, sf):
    line = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("l_quantity").alias("units"),
    )
    return columns.ensure_columns(line)


@query(
    "zero_fill",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN 0.0::DOUBLE ELSE l_quantity END AS units, "
    "CASE WHEN l_tax = 0.02 THEN 0.0::DOUBLE ELSE l_extendedprice END AS price FROM lineitem",
)
def zero_fill(spark, sf):
    holes = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(~(F.col("l_discount") > 0.05), F.col("l_quantity")).alias("units"),
        F.when(F.col("l_tax") != 0.02, F.col("l_extendedprice")).alias("price"),
    )
    return columns.zero_fill(holes)


@query(
    "ensure_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date FROM orders",
)
def ensure_date(spark, sf):
    """Order dates written in three spellings, with some text that is no date."""
    orders, day, spelling = table(spark, sf, "orders"), F.col("o_orderdate"), F.col("o_orderkey") % 7
    text = (
        F.when(spelling == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(spelling == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(spelling == 3, "not-a-date")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return columns.ensure_date(orders.select("o_orderkey", text.alias("date")), strict=False)


@query(
    "coerce_numeric",
    "SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '4%' THEN 0.0::DOUBLE ELSE o_totalprice END AS price FROM orders",
)
def coerce_numeric(spark, sf):
    text = F.when(F.col("o_orderpriority").startswith("4"), "n/a").otherwise(F.col("o_totalprice").cast("string"))
    return columns.coerce_numeric(table(spark, sf, "orders").select("o_orderkey", text.alias("price")), ["price"])


@query(
    "numeric_issues",
    "SELECT 'c_acctbal' AS column_name, CAST(0 AS BIGINT) AS rescued, count(*) FILTER (c_acctbal IS NULL) AS missing, "
    "count(*) FILTER (c_acctbal < 0) AS below_min FROM customer UNION ALL SELECT 'c_name', "
    "count(*) FILTER (try_cast(c_name AS DOUBLE) IS NULL), count(*) FILTER (c_name IS NULL), 0 FROM customer",
)
def numeric_issues(spark, sf):
    return columns.numeric_issues(table(spark, sf, "customer"), ["c_acctbal", "c_name"])


@query(
    "normalize_sku",
    "SELECT spelling, CASE WHEN length(d) < 3 THEN 'SKU' || lpad(d, 3, '0') ELSE 'SKU' || d END AS sku_id, n FROM ("
    "SELECT CASE p_partkey % 4 WHEN 0 THEN ' sku_' || p_partkey WHEN 1 THEN 'SKU-' || p_partkey "
    "WHEN 2 THEN CAST(p_partkey AS VARCHAR) ELSE p_brand || '  ' END AS spelling, "
    "regexp_replace(CASE WHEN p_partkey % 4 = 3 THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END, '[^0-9]', '', 'g') AS d, "
    "count(*) AS n FROM part GROUP BY ALL)",
)
def normalize_sku(spark, sf):
    kind = F.col("p_partkey") % 4
    spelling = (
        F.when(kind == 0, F.concat(F.lit(" sku_"), "p_partkey"))
        .when(kind == 1, F.concat(F.lit("SKU-"), "p_partkey"))
        .when(kind == 2, F.col("p_partkey").cast("string"))
        .otherwise(F.concat("p_brand", F.lit("  ")))
    )
    spelled = table(spark, sf, "part").groupBy(spelling.alias("spelling")).agg(F.count("*").alias("n"))
    return spelled.withColumn("sku_id", scalars.normalize_sku("spelling"))


@query(
    "filter_in",
    "WITH " + SALES_SQL + " SELECT date, sku_id, store_id, units FROM sales "
    "WHERE sku_id IN ('SKU003', 'SKU011') AND store_id IN ('S02', 'S05') ORDER BY date, sku_id, store_id LIMIT 100",
)
def filter_in(spark, sf):
    chosen = columns.filter_in(sales(spark, sf), ["SKU003", "SKU011"], ["S02", "S05"])
    return chosen.select("date", "sku_id", "store_id", "units").orderBy("date", "sku_id", "store_id").limit(100)


@query(
    "prune_columns",
    "WITH " + SALES_SQL + " SELECT sku_id, date AS ds, units AS y FROM sales",
)
def prune_columns(spark, sf):
    return columns.training_columns(sales(spark, sf))


@query(
    "finite_target",
    "SELECT l_orderkey, l_linenumber, l_quantity AS units FROM lineitem WHERE l_discount >= 0.02 AND l_tax > 0.01",
)
def finite_target(spark, sf):
    """Some targets are made infinite or missing first."""
    y = (
        F.when(F.col("l_discount") < 0.02, F.lit(float("inf")))
        .when(F.col("l_tax") > 0.01, F.col("l_quantity"))
        .otherwise(F.lit(None))
    )
    return columns.finite_target(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", y.alias("units"))
    )


@query(
    "dedup",
    "WITH " + RAW_SQL + " SELECT date, sku_id, store_id, units, round(price, 4) AS price, promo_flag FROM raw "
    "QUALIFY row_number() OVER (PARTITION BY date, sku_id, store_id ORDER BY l_orderkey, l_linenumber, "
    "l_extendedprice, l_quantity, l_discount, l_tax) = 1",
)
def dedup(spark, sf):
    first = clean.dedup(raw_sales(spark, sf), RAW_ORDER)
    return rounded(first.select("date", "sku_id", "store_id", "units", "price", "promo_flag"))


SPAN_SQL = ", span AS (SELECT min(date) AS lo, max(date) AS hi FROM sales)"
CALENDAR_SQL = (
    SALES_SQL + SPAN_SQL + """,
pairs AS (SELECT DISTINCT sku_id, store_id FROM sales),
cal AS (SELECT CAST(d AS DATE) AS date, sku_id, store_id FROM pairs, span, generate_series(lo, hi, INTERVAL 1 DAY) g(d))"""
)


@query("calendar_cross", "WITH " + CALENDAR_SQL + " SELECT date, sku_id, store_id FROM cal")
def calendar_cross(spark, sf):
    return clean.calendar(sales(spark, sf))


@query(
    "calendar_join",
    "WITH " + CALENDAR_SQL + " SELECT date, sku_id, store_id, units, price, promo_flag "
    "FROM cal LEFT JOIN sales USING (date, sku_id, store_id)",
)
def calendar_join(spark, sf):
    return clean.calendar_join(sales(spark, sf)).select("date", "sku_id", "store_id", "units", "price", "promo_flag")


FILL_SQL = """,
marked AS (SELECT c.date, c.sku_id, c.store_id, f.category, f.units, f.price, f.promo_flag,
                  count(f.units) OVER (PARTITION BY c.sku_id, c.store_id ORDER BY c.date) AS block
           FROM cal c LEFT JOIN {facts} f USING (date, sku_id, store_id)),
filled AS (
  SELECT date, sku_id, store_id,
         coalesce(first_value(category) OVER b, first_value(category IGNORE NULLS) OVER s) AS category,
         CAST(trunc(coalesce(first_value(units) OVER b, first_value(units IGNORE NULLS) OVER s)) AS DOUBLE) AS units,
         coalesce(first_value(price) OVER b, first_value(price IGNORE NULLS) OVER s) AS price,
         coalesce(first_value(promo_flag) OVER b, first_value(promo_flag IGNORE NULLS) OVER s) AS promo_flag
  FROM marked
  WINDOW b AS (PARTITION BY sku_id, store_id, block ORDER BY date ROWS UNBOUNDED PRECEDING),
         s AS (PARTITION BY sku_id, store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


@query("fill_series", "WITH " + CALENDAR_SQL + FILL_SQL.format(facts="sales") + " SELECT * FROM filled")
def fill_series(spark, sf):
    return clean.fill_date_gaps(sales(spark, sf))


CAP_SQL = """,
fence AS (SELECT sku_id, store_id, quantile_cont(units, 0.25) AS q1, quantile_cont(units, 0.75) AS q3
          FROM {rows} GROUP BY sku_id, store_id),
bound AS (SELECT sku_id, store_id, greatest(q1 - 1.5 * (q3 - q1), 0) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM fence),
capped AS (SELECT f.* EXCLUDE (units), least(greatest(units, least(lo, hi)), greatest(lo, hi)) AS units
           FROM {rows} f JOIN bound USING (sku_id, store_id))"""


@query("cap", "WITH " + SALES_SQL + CAP_SQL.format(rows="sales") + " SELECT date, sku_id, store_id, units FROM capped")
def cap(spark, sf):
    return clean.cap_iqr(sales(spark, sf)).select("date", "sku_id", "store_id", "units")


@query(
    "cap_wide",
    "WITH " + RAW_SQL + ", q AS (SELECT category, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 "
    "FROM raw GROUP BY category), b AS (SELECT category, greatest(2.5 * q1 - 1.5 * q3, 0) AS lo, 2.5 * q3 - 1.5 * q1 AS hi FROM q) "
    "SELECT category, count(*) AS n, round(sum(least(greatest(price, least(lo, hi)), greatest(lo, hi))), 3) AS price "
    "FROM raw JOIN b USING (category) GROUP BY category",
)
def cap_wide(spark, sf):
    """Price caps per category: a category may hold any share of the rows."""
    capped = clean.cap_iqr_wide(sales_raw(spark, sf).select("category", "price"), "price", ["category"])
    return rounded(capped.groupBy("category").agg(F.count("*").alias("n"), F.sum("price").alias("price")), 3)


def cleaned(spark, sf):
    """The cleaned daily table out of raw lines, as every later step reads it."""
    return clean.clean_sales(raw_sales(spark, sf), order=RAW_ORDER, drop=RAW_ORDER)


CLEAN_SQL = (
    RAW_SQL + """,
sales AS (SELECT date, sku_id, store_id, category, units, price, promo_flag FROM raw
          QUALIFY row_number() OVER (PARTITION BY date, sku_id, store_id ORDER BY l_orderkey, l_linenumber,
                                     l_extendedprice, l_quantity, l_discount, l_tax) = 1)"""
    + SPAN_SQL + """,
pairs AS (SELECT DISTINCT sku_id, store_id FROM sales),
cal AS (SELECT CAST(d AS DATE) AS date, sku_id, store_id FROM pairs, span, generate_series(lo, hi, INTERVAL 1 DAY) g(d))"""
    + FILL_SQL.format(facts="sales") + CAP_SQL.format(rows="filled")
)


@query(
    "clean_sales",
    "WITH " + CLEAN_SQL + " SELECT date, sku_id, store_id, category, units, round(price, 4) AS price, promo_flag FROM capped",
)
def clean_sales(spark, sf):
    return rounded(cleaned(spark, sf))


CALENDAR_COLUMNS_SQL = """CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(week(date) AS INTEGER) AS week,
  CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
  CAST(strftime(date, '%m-%d') IN ('01-01','01-02','01-03','01-04','01-05','01-06','01-07','01-08','02-23','03-08',
       '05-01','05-09','06-12','11-04') AS INTEGER) AS is_holiday,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(quarter(date) AS INTEGER) AS quarter"""


@query("calendar_features", "WITH " + SALES_SQL + " SELECT date, sku_id, store_id, " + CALENDAR_COLUMNS_SQL + " FROM sales")
def calendar_features(spark, sf):
    return features.add_calendar(sales(spark, sf).select("date", "sku_id", "store_id"))


@query(
    "is_holiday",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%m-%d') IN ('01-01','01-02','01-03','01-04','01-05','01-06','01-07',"
    "'01-08','02-23','03-08','05-01','05-09','06-12','11-04') AS INTEGER) AS is_holiday, "
    "CAST(strftime(o_orderdate, '%m-%d') IN ('12-25') AS INTEGER) AS is_own FROM orders",
)
def is_holiday(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", scalars.is_holiday("o_orderdate").alias("is_holiday"),
        scalars.is_holiday("o_orderdate", ["12-25"]).alias("is_own"),
    )


SERIES_SQL = "OVER (PARTITION BY sku_id, store_id ORDER BY date"


def _rolling_sql(rows: str) -> str:
    return "WITH " + SALES_SQL + f""" SELECT date, sku_id, store_id,
      round(avg(units) {SERIES_SQL} ROWS BETWEEN {rows.format(7, 6)}), 4) AS units_ma_7,
      round(avg(units) {SERIES_SQL} ROWS BETWEEN {rows.format(28, 27)}), 4) AS units_ma_28 FROM sales"""


@query(
    "lags",
    "WITH " + SALES_SQL + f""" SELECT date, sku_id, store_id, lag(units, 1) {SERIES_SQL}) AS units_lag_1,
      lag(units, 7) {SERIES_SQL}) AS units_lag_7, lag(units, 14) {SERIES_SQL}) AS units_lag_14 FROM sales""",
)
def lags(spark, sf):
    return features.add_lags(sales(spark, sf).select("date", "sku_id", "store_id", "units")).drop("units")


@query("rolling_mean", _rolling_sql("{1} PRECEDING AND CURRENT ROW"))
def rolling_mean(spark, sf):
    out = features.add_rolling(sales(spark, sf).select("date", "sku_id", "store_id", "units"))
    return rounded(out.drop("units"))


@query("rolling_mean_past", _rolling_sql("{0} PRECEDING AND 1 PRECEDING"))
def rolling_mean_past(spark, sf):
    """The forecaster's variant: the current day is left out."""
    out = features.add_rolling(sales(spark, sf).select("date", "sku_id", "store_id", "units"), exclude_current=True)
    return rounded(out.drop("units"))


@query(
    "moving_average",
    "WITH " + SALES_SQL + """ SELECT date, sku_id, store_id,
      round(avg(units) OVER (PARTITION BY sku_id ORDER BY date, store_id ROWS 6 PRECEDING), 4) AS rolling_7,
      round(avg(units) OVER (PARTITION BY sku_id ORDER BY date, store_id ROWS 29 PRECEDING), 4) AS rolling_30 FROM sales""",
)
def moving_average(spark, sf):
    return rounded(features.moving_average(sales(spark, sf).select("date", "sku_id", "store_id", "units")).drop("units"))


def features_sql(rows: str) -> str:
    return f"""SELECT date, sku_id, store_id, category, units, round(price, 4) AS price, promo_flag, {CALENDAR_COLUMNS_SQL},
  coalesce(lag(units, 1) {SERIES_SQL}), 0) AS units_lag_1, coalesce(lag(units, 7) {SERIES_SQL}), 0) AS units_lag_7,
  coalesce(lag(units, 14) {SERIES_SQL}), 0) AS units_lag_14,
  round(avg(units) {SERIES_SQL} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS units_ma_7,
  round(avg(units) {SERIES_SQL} ROWS BETWEEN 27 PRECEDING AND CURRENT ROW), 4) AS units_ma_28 FROM {rows}"""


@query("build_features", "WITH " + SALES_SQL + " " + features_sql("sales"))
def build_features(spark, sf):
    return rounded(features.build_features(sales(spark, sf)))


CLASSES_SQL = """,
s AS (SELECT sku_id, sum(units) AS units_sum, avg(units) AS mean, stddev_samp(units) AS std FROM {rows} GROUP BY sku_id),
c AS (SELECT *, sum(units_sum) OVER (ORDER BY units_sum DESC, sku_id ROWS UNBOUNDED PRECEDING) / sum(units_sum) OVER () AS share,
             coalesce(std / nullif(mean, 0), 'infinity'::DOUBLE) AS cv FROM s)
SELECT sku_id, round(units_sum, 4) AS units_sum, round(cv, 4) AS cv,
       CASE WHEN share <= 0.8 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END
       || CASE WHEN cv < 0.1 THEN 'X' WHEN cv < 0.25 THEN 'Y' ELSE 'Z' END AS "ABCXYZ" FROM c"""


def _prepared(spark, sf):
    """Raw lines as a CSV folder, through the whole preparation."""
    source, target = run_folder(spark, "raw-lines"), run_folder(spark, "prepared")
    raw_sales(spark, sf).write.option("header", True).csv(source)
    order = [F.col(c).cast("double") for c in RAW_ORDER]
    return prepare.prepare_dataset(spark, source, target, order=order, drop=RAW_ORDER)


@query("prepare_dataset", "WITH " + CLEAN_SQL + " " + features_sql("capped"))
def prepare_dataset(spark, sf):
    """A file of raw lines to written features. Gap fill, caps, lags and rolling means all run on one shuffle of the series."""
    return rounded(_prepared(spark, sf)[0])


@query("prepare_classes", "WITH " + CLEAN_SQL + CLASSES_SQL.format(rows="capped"))
def prepare_classes(spark, sf):
    return rounded(_prepared(spark, sf)[1].select("sku_id", "units_sum", "cv", "ABCXYZ"))


@query(
    "sku_day_rollup",
    "WITH " + RAW_SQL + " SELECT date, sku_id, sum(units) AS units, round(sum(units * price), 2) AS revenue, "
    "round(avg(price) + 1e-7, 3) AS price, max(promo_flag) AS promo_flag FROM raw GROUP BY date, sku_id",
)
def sku_day_rollup(spark, sf):
    out = summary.sku_day_rollup(sales_raw(spark, sf))
    return out.withColumn("revenue", F.round("revenue", 2)).withColumn("price", F.round(F.col("price") + 1e-7, 3))

