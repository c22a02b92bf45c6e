"""Views over the given tables that play the package's own tables, each with its SQL text for the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfspark.functions.scalars import normalize_sku


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def price(value: Column, units: Column) -> Column:
    """Unit price to four digits. The tiny addend moves exact ties off the edge, where engines round differently."""
    return F.round(value / units + 1e-8, 4)


def sales_raw(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """One row per order line. Dimensions carry no hint: Spark broadcasts each one only below its size limit.

    They are joined one after the other, because the size of a join of two dimensions is estimated as their product.

    ``lines`` may be a stream of the line table instead.
    """
    line = (table(spark, sf, "lineitem") if lines is None else lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", F.col("l_shipdate").cast("date").alias("date"),
    )
    part = table(spark, sf, "part").select("p_partkey", "p_type", normalize_sku("p_brand").alias("sku_id"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf, "nation").select(
        "n_nationkey", F.concat(F.lit("S0"), F.col("n_regionkey") + 1).alias("store_id")
    )
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(
            "date", "sku_id", "store_id",
            F.col("p_type").alias("category"),
            F.col("l_quantity").alias("units"),
            price(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
            (F.col("l_discount") >= 0.08).cast("int").alias("promo_flag"),
            "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        )
    )


RAW_SQL = """
raw AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         'SKU' || lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 3, '0') AS sku_id,
         'S0' || (n_regionkey + 1) AS store_id, p_type AS category, l_quantity AS units,
         round(l_extendedprice / l_quantity + 1e-8, 4) AS price, CAST(l_discount >= 0.08 AS INTEGER) AS promo_flag,
         l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

# total order of the raw rows, needed wherever the first row of a key is kept
RAW_ORDER = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Daily facts, one row per (date, sku_id, store_id)."""
    return (
        sales_raw(spark, sf)
        .groupBy("date", "sku_id", "store_id")
        .agg(
            F.min("category").alias("category"),
            F.sum("units").alias("units"),
            price(F.sum("l_extendedprice"), F.sum("l_quantity")).alias("price"),
            F.max("promo_flag").alias("promo_flag"),
        )
    )


SALES_SQL = (
    RAW_SQL
    + """,
sales AS (
  SELECT date, sku_id, store_id, min(category) AS category, sum(units) AS units,
         round(sum(l_extendedprice) / sum(l_quantity) + 1e-8, 4) AS price, max(promo_flag) AS promo_flag
  FROM raw GROUP BY date, sku_id, store_id
)"""
)


def sales_sku(spark: SparkSession, sf: str) -> DataFrame:
    """Daily units per SKU, stores summed. Built from the lines in one aggregation."""
    return sales_raw(spark, sf).groupBy("date", "sku_id").agg(F.sum("units").alias("units"))


SKU_SQL = SALES_SQL + ", sku AS (SELECT date, sku_id, sum(units) AS units FROM raw GROUP BY date, sku_id)"


def reference_current(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Facts before and from the middle of 1998: the two sides of a drift check."""
    facts, cut = sales(spark, sf), F.lit("1998-07-01").cast("date")
    return facts.where(F.col("date") < cut), facts.where(F.col("date") >= cut)


SIDES_SQL = SALES_SQL + """,
ref AS (SELECT * FROM sales WHERE date < DATE '1998-07-01'),
cur AS (SELECT * FROM sales WHERE date >= DATE '1998-07-01')"""


def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as the audit log; ``as_of`` of every report is its newest time."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.when(kind == "error", "login_failed").otherwise(kind).alias("event_type"),
        "user_id",
        F.concat(F.lit("User"), F.col("user_id"), F.lit("@shop.example")).alias("user_email"),
        F.col("user_id").cast("string").alias("ip_address"),
        F.col("props").alias("details"),
        F.when(kind == "error", "critical").when(kind.isin("purchase", "signup"), "warning").otherwise("info")
        .alias("severity"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


AUDIT_SQL = """
audit AS (
  SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 'login_failed' ELSE event_type END AS event_type,
         user_id, 'User' || user_id || '@shop.example' AS user_email, CAST(user_id AS VARCHAR) AS ip_address,
         props AS details,
         CASE WHEN event_type = 'error' THEN 'critical' WHEN event_type IN ('purchase', 'signup') THEN 'warning'
              ELSE 'info' END AS severity,
         ts AS created_at
  FROM events
), newest AS (SELECT max(created_at) AS as_of FROM audit)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as a request log."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("endpoint"),
        F.lit("GET").alias("method"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.col("value").alias("duration"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("id"),
    )


REQUESTS_SQL = """
requests AS (
  SELECT event_type AS endpoint, 'GET' AS method, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value AS duration, ts, event_id AS id
  FROM events
)"""


def sku_dim(spark: SparkSession, sf: str) -> DataFrame:
    """One row per normalized brand that is in the part table; a SKU is active unless its number divides by five."""
    part = table(spark, sf, "part").select(normalize_sku("p_brand").alias("sku_id"), "p_type", "p_size")
    return part.groupBy("sku_id").agg(
        F.min("p_type").alias("category"),
        F.concat(F.lit("S0"), (F.max("p_size") % 5 + 1)).alias("store_id"),
        (F.max(F.substring("sku_id", 4, 9).cast("int")) % 5 != 0).alias("is_active"),
    )


DIM_SQL = """
dim AS (
  SELECT 'SKU' || lpad(regexp_replace(p_brand, '[^0-9]', '', 'g'), 3, '0') AS sku_id, min(p_type) AS category,
         'S0' || (max(p_size) % 5 + 1) AS store_id,
         max(CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER)) % 5 <> 0 AS is_active
  FROM part GROUP BY 1
)"""

# Fixed values of the stand-in runs: three forecast origins, fourteen days each.
RUN_IDS, HORIZON = (1, 2, 3), 14


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as forecast runs: F is completed, O is running, P has failed."""
    status = F.col("o_orderstatus")
    started = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.when(status == "F", "completed").when(status == "O", "running").otherwise("failed").alias("status"),
        started.alias("started_at"),
        F.when(status != "O", F.timestamp_add("MINUTE", F.pmod("o_orderkey", F.lit(1440)).cast("int"), started))
        .alias("completed_at"),
    )


RUNS_SQL = """
runs AS (
  SELECT o_orderkey AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_minutes(o_orderkey % 1440) END AS completed_at
  FROM orders
)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Simple forecasts per SKU from three origins two weeks apart; run 3 is the newest and starts after the last day."""
    daily = sales_sku(spark, sf)
    last = daily.agg(F.max("date")).scalar()
    origins = F.explode(F.array(*[F.lit(r) for r in RUN_IDS])).alias("run_id")
    seen = daily.select("sku_id", "date", "units", origins).withColumn(
        "origin", F.date_sub(last, (F.lit(max(RUN_IDS)) - F.col("run_id")) * HORIZON)
    )
    state = (
        seen.where(F.col("date") <= F.col("origin"))
        .groupBy("run_id", "sku_id", "origin")
        .agg(F.avg("units").alias("prophet"), F.max_by("units", "date").alias("xgb"))
        .withColumn("lgbm", F.when(F.col("xgb") <= F.col("prophet"), F.greatest("xgb", F.lit(1.0))))
    )
    parts = F.array("prophet", "xgb", "lgbm")
    known = F.filter(parts, lambda c: c.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda a, c: a + c) / F.size(known)
    return (
        state.withColumn("ensemble", mean)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(HORIZON))))
        .select(
            F.col("run_id").cast("bigint").alias("run_id"), "sku_id",
            F.date_add("origin", F.col("step")).alias("date"),
            "prophet", "xgb", "lgbm", "ensemble",
            (F.col("ensemble") * 0.8).alias("p_low"), (F.col("ensemble") * 1.2).alias("p_high"),
        )
    )


PREDICTIONS_SQL = SKU_SQL + """,
origins AS (SELECT r AS run_id, (SELECT max(date) FROM sku) - CAST((3 - r) * 14 AS INTEGER) AS origin
            FROM (VALUES (1), (2), (3)) t(r)),
pstate AS (
  SELECT run_id, sku_id, origin, avg(units) AS prophet, max_by(units, date) AS xgb
  FROM sku JOIN origins ON date <= origin GROUP BY run_id, sku_id, origin
), pmodels AS (SELECT *, CASE WHEN xgb <= prophet THEN greatest(xgb, 1.0) END AS lgbm FROM pstate),
pens AS (SELECT *, (prophet + xgb + coalesce(lgbm, 0)) / (CASE WHEN lgbm IS NULL THEN 2 ELSE 3 END) AS ensemble FROM pmodels),
pred AS (
  SELECT CAST(run_id AS BIGINT) AS run_id, sku_id, CAST(origin + CAST(s AS INTEGER) AS DATE) AS date, prophet, xgb, lgbm, ensemble,
         ensemble * 0.8 AS p_low, ensemble * 1.2 AS p_high
  FROM pens, generate_series(1, 14) g(s)
)"""
