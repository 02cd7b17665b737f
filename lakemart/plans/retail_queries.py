"""Catalogue of the retail queries; each name has a Spark plan and, where SQL can say it, its ANSI twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.functions import scalars as S
from lakemart.operators import dedup, reconcile, scd, slices
from lakemart.sources import lake
from lakemart.sources import tables as T
from lakemart.workspace import durable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

REPORT_MONTHS = ("1998-03", "1998-10")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# --- shared pieces of the ANSI twins -------------------------------------------------------------------

RAW_SQL = """
typed AS (
  SELECT *, CASE WHEN l_returnflag = 'A' THEN 'SALE'
                 WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'RETURN'
                 WHEN l_returnflag = 'R' THEN 'VOID'
                 WHEN l_linestatus = 'F' THEN 'DISCOUNT' ELSE 'TENDER' END AS line_type
  FROM lineitem),
raw AS (
  SELECT l_orderkey AS bill_no, l_linenumber AS line_no, l_suppkey AS store_id,
         CASE WHEN line_type <> 'DISCOUNT' THEN l_partkey END AS product_code,
         CAST(CASE WHEN line_type IN ('RETURN', 'VOID') THEN -l_quantity ELSE l_quantity END AS INTEGER) AS qty,
         CAST(CASE WHEN line_type = 'DISCOUNT' THEN -l_extendedprice ELSE l_extendedprice END
              AS DECIMAL(12,2)) AS unit_price,
         line_type, CAST(l_shipdate AS DATE) AS business_date
  FROM typed)"""

KEPT_SQL = RAW_SQL + """,
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY bill_no, line_no
      ORDER BY business_date, store_id, line_type, product_code NULLS FIRST, qty, unit_price) AS rn FROM raw)
  WHERE rn = 1)"""

NET_SQL = KEPT_SQL + """,
net AS (
  SELECT *, CAST(qty AS DECIMAL(10,0)) * unit_price AS revenue, strftime(business_date, '%Y-%m') AS month
  FROM kept WHERE line_type IN ('SALE', 'RETURN', 'DISCOUNT', 'VOID')),
sales AS (SELECT * FROM net WHERE line_type = 'SALE')"""

PRODUCTS_SQL = """
products AS (
  SELECT p_partkey * 2 AS product_sk, p_partkey AS product_code, p_name AS product_name, p_brand AS department,
         p_type AS category, DATE '1990-01-01' AS valid_from,
         CASE WHEN p_partkey % 50 = 0 THEN DATE '1998-06-30' ELSE DATE '9999-12-31' END AS valid_to, p_retailprice
  FROM part
  UNION ALL
  SELECT p_partkey * 2 + 1, p_partkey, p_name, p_brand,
         CASE p_type WHEN 'ECONOMY' THEN 'LARGE' WHEN 'LARGE' THEN 'MEDIUM' WHEN 'MEDIUM' THEN 'PROMO'
                     WHEN 'PROMO' THEN 'SMALL' WHEN 'SMALL' THEN 'STANDARD' ELSE 'ECONOMY' END,
         DATE '1998-07-01', DATE '9999-12-31', p_retailprice
  FROM part WHERE p_partkey % 50 = 0)"""

PRICES_SQL = """
prices AS (
  SELECT product_sk, product_code,
         CAST((CAST(round(p_retailprice * 100) AS BIGINT) * (100 + 5 * i) // 100) / 100.0 AS DECIMAL(12,2)) AS list_price,
         DATE '1994-01-01' + CAST(i * 700 + product_code % 300 AS INTEGER) AS effective_from,
         CASE WHEN i < 3 THEN DATE '1994-01-01' + CAST(i * 700 + product_code % 300 + 699 AS INTEGER)
              ELSE DATE '9999-12-31' END AS effective_to
  FROM products, range(0, 4) AS steps(i)),
starts AS (
  SELECT product_code, list_price, effective_from,
         coalesce(lead(effective_from) OVER (PARTITION BY product_code ORDER BY effective_from),
                  DATE '9999-12-31') AS valid_until
  FROM prices WHERE product_sk % 2 = 0)"""


# --- de-duplication ------------------------------------------------------------------------------------

@query(f"""
WITH {KEPT_SQL}
SELECT bill_no, line_no, store_id, product_code, qty, CAST(unit_price AS DOUBLE) AS unit_price, line_type, business_date
FROM kept""")
def dedup_lines(spark: SparkSession, folder: str) -> DataFrame:
    return T.kept_lines(spark, folder).withColumn("unit_price", S.as_double(F.col("unit_price")))


@query("""
SELECT count(*) AS raw_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS kept_rows,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed_rows
FROM lineitem""")
def dedup_counts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup_counts(T.raw_lines(spark, folder), T.LINE_KEYS)


@query("""
SELECT user_id, event_type, minute, event_id AS first_event_id, value FROM (
  SELECT *, date_trunc('minute', ts) AS minute,
         row_number() OVER (PARTITION BY user_id, event_type, date_trunc('minute', ts) ORDER BY ts, event_id) AS rn
  FROM events)
WHERE rn = 1""")
def dedup_ap_key(spark: SparkSession, folder: str) -> DataFrame:
    events = T.table(spark, folder, "events").withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    kept = dedup.keep_first(events, ["user_id", "event_type", "minute"], ["ts", "event_id"])
    return kept.select("user_id", "event_type", "minute", F.col("event_id").alias("first_event_id"), "value")


CHECKSUM_COLUMNS = ("bill_no", "line_no", "store_id", "product_code", "qty", "unit_price", "line_type", "business_date")

_SERIAL_SQL = " || chr(1) || ".join(
    f"coalesce('=' || CAST({c} AS VARCHAR), '-')" for c in CHECKSUM_COLUMNS
)


_CHECKSUM_SQL = f"""
hashed AS (SELECT sha256({_SERIAL_SQL}) AS d FROM kept),
sums AS (
  SELECT count(*) AS row_count,
    CAST(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS VARCHAR) AS slice_0,
    CAST(sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) AS VARCHAR) AS slice_1,
    CAST(sum(CAST('0x' || substr(d, 31, 15) AS BIGINT)) AS VARCHAR) AS slice_2,
    CAST(sum(CAST('0x' || substr(d, 46, 15) AS BIGINT)) AS VARCHAR) AS slice_3
  FROM hashed)"""


@query(f"""
WITH {KEPT_SQL}, {_CHECKSUM_SQL}
SELECT *, sha256(slice_0 || '|' || slice_1 || '|' || slice_2 || '|' || slice_3) AS checksum FROM sums""")
def dataset_checksum(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dataset_checksum(T.kept_lines(spark, folder), CHECKSUM_COLUMNS)


@query(f"""
WITH {KEPT_SQL}, {_CHECKSUM_SQL},
counts AS (SELECT (SELECT count(*) FROM raw) AS raw_rows, row_count AS kept_rows,
                  sha256(slice_0 || '|' || slice_1 || '|' || slice_2 || '|' || slice_3) AS checksum FROM sums)
SELECT CAST(run AS INTEGER) AS run, raw_rows, kept_rows, raw_rows - kept_rows AS removed_rows, checksum
FROM counts, range(1, 4) AS runs(run)""")
def idempotency_report(spark: SparkSession, folder: str) -> DataFrame:
    """The same files loaded three times into one table; what is read back must not differ."""
    return dedup.repeated_loads(T.raw_lines(spark, folder), T.LINE_KEYS, CHECKSUM_COLUMNS, T.LINE_ORDER)


# --- slices --------------------------------------------------------------------------------------------

@query(f"""
WITH {NET_SQL}
SELECT month, CAST(extract(year FROM min(business_date)) AS INTEGER) AS sale_year,
       CAST(extract(month FROM min(business_date)) AS INTEGER) AS sale_month,
       count(DISTINCT bill_no) AS bills, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM net GROUP BY month""")
def revenue_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Net revenue by month, each line counted once."""
    return by_month(T.revenue_lines(spark, folder))


def by_month(lines: DataFrame) -> DataFrame:
    months = slices.revenue_by(lines, [S.month_key(F.col("business_date")).alias("month")])
    return months.select(
        "month", F.substring("month", 1, 4).cast("int").alias("sale_year"),
        F.substring("month", 6, 2).cast("int").alias("sale_month"),
        "bills", S.as_double(F.col("revenue")).alias("revenue"),
    ).orderBy("month")


@query(f"""
WITH {NET_SQL},
days AS (SELECT * FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'),
                               (6, 'Saturday'), (7, 'Sunday')) AS v(iso_day, day_name)),
agg AS (SELECT isodow(business_date) AS iso_day, count(DISTINCT bill_no) AS bills, CAST(sum(revenue) AS DOUBLE) AS revenue,
               round(CAST(sum(revenue) AS DOUBLE) / count(*), 2) AS avg_line
        FROM net GROUP BY 1)
SELECT CAST(days.iso_day AS INTEGER) AS iso_day, day_name, bills, revenue, avg_line
FROM days LEFT JOIN agg ON days.iso_day = agg.iso_day""")
def revenue_by_weekday(spark: SparkSession, folder: str) -> DataFrame:
    return slices.revenue_by_weekday(T.revenue_lines(spark, folder))


@query(f"""
WITH {NET_SQL}
SELECT store_id, s_name AS store_name, n_name AS city, count(DISTINCT bill_no) AS bills,
       CAST(sum(revenue) AS DOUBLE) AS revenue
FROM net JOIN supplier ON store_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL""")
def revenue_by_store(spark: SparkSession, folder: str) -> DataFrame:
    by_store = slices.revenue_by(T.revenue_lines(spark, folder), ["store_id"])
    return (
        by_store.join(T.stores(spark, folder), "store_id")
        .select("store_id", "store_name", "city", "bills", S.as_double(F.col("revenue")).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "store_id")
    )


def _daily(spark: SparkSession, folder: str, line_types: tuple[str, ...] = S.NET_LINE_TYPES) -> DataFrame:
    return scd.daily_rollup(T.revenue_lines(spark, folder, line_types), ["product_code", "business_date"])


def _with_product(daily: DataFrame, spark: SparkSession, folder: str, how: str, closed: bool = True) -> DataFrame:
    versions = T.products(spark, folder).drop("p_retailprice")
    return scd.as_of_join(
        daily, versions, on="product_code", date_col="business_date", start="valid_from", end="valid_to",
        how=how, end_inclusive=closed,
    )


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL},
joined AS (SELECT revenue, category FROM net LEFT JOIN products p ON net.product_code = p.product_code
           AND business_date BETWEEN valid_from AND valid_to)
SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue,
       round(CAST(sum(revenue) AS DOUBLE) * 100.0 / (SELECT CAST(sum(revenue) AS DOUBLE) FROM joined), 2) AS pct_share
FROM joined WHERE category IS NOT NULL GROUP BY category""")
def revenue_by_category_share(spark: SparkSession, folder: str) -> DataFrame:
    """The share is of all revenue, lines without a category included, so it need not add up to 100."""
    by_category = (
        _with_product(_daily(spark, folder), spark, folder, "left")
        .groupBy("category").agg(F.sum("revenue").alias("revenue"))
    )
    return (
        slices.with_share(by_category).where(F.col("category").isNotNull())
        .select("category", S.as_double(F.col("revenue")).alias("revenue"), "pct_share")
        .orderBy(F.col("revenue").desc(), "category")
    )


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL},
joined AS (SELECT revenue, product_sk FROM net LEFT JOIN products p ON net.product_code = p.product_code
           AND business_date BETWEEN valid_from AND valid_to)
SELECT 'left' AS join_kind, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue FROM joined
UNION ALL
SELECT 'inner', count(*), CAST(sum(revenue) AS DOUBLE) FROM joined WHERE product_sk IS NOT NULL""")
def category_inner_vs_left(spark: SparkSession, folder: str) -> DataFrame:
    """What an inner product join loses: one pass, both answers."""
    joined = _with_product(_daily(spark, folder), spark, folder, "left")
    kinds = F.explode(
        F.when(F.col("product_sk").isNull(), F.array(F.lit("left"))).otherwise(F.array(F.lit("left"), F.lit("inner")))
    )
    return joined.select(kinds.alias("join_kind"), "lines", "revenue").groupBy("join_kind").agg(
        F.sum("lines").alias("lines"), S.as_double(F.sum("revenue")).alias("revenue")
    )


@query(f"""
WITH {NET_SQL}
SELECT 'net' AS definition, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue FROM net
UNION ALL SELECT 'sale only', count(*), CAST(sum(revenue) AS DOUBLE) FROM sales""")
def sale_only_vs_net(spark: SparkSession, folder: str) -> DataFrame:
    kinds = F.explode(
        F.when(F.col("line_type") == "SALE", F.array(F.lit("net"), F.lit("sale only"))).otherwise(F.array(F.lit("net")))
    )
    by_type = T.revenue_lines(spark, folder).groupBy("line_type").agg(
        F.count("*").alias("lines"), F.sum("revenue").alias("revenue")
    )
    return by_type.select(kinds.alias("definition"), "lines", "revenue").groupBy("definition").agg(
        F.sum("lines").alias("lines"), S.as_double(F.sum("revenue")).alias("revenue")
    )


@query(f"""
WITH {NET_SQL}
SELECT count(DISTINCT bill_no) AS bills, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM net WHERE NOT EXISTS (SELECT 1 FROM kept v WHERE v.bill_no = net.bill_no AND v.line_type = 'VOID')""")
def drop_void_bills(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup.without_voided_bills(T.revenue_lines(spark, folder))
    return kept.agg(
        F.countDistinct("bill_no").alias("bills"), F.count("*").alias("lines"),
        S.as_double(F.sum("revenue")).alias("revenue"),
    )


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL},
joined AS (SELECT bill_no, revenue, store_id, month, isodow(business_date) AS iso_day, coalesce(category, 'UNASSIGNED') AS category
           FROM net LEFT JOIN products p ON net.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to),
every AS (
  SELECT 'all' AS kind, NULL AS slice, bill_no, revenue FROM joined
  UNION ALL SELECT 'store', CAST(store_id AS VARCHAR), bill_no, revenue FROM joined
  UNION ALL SELECT 'month', month, bill_no, revenue FROM joined
  UNION ALL SELECT 'weekday', CAST(iso_day AS VARCHAR), bill_no, revenue FROM joined
  UNION ALL SELECT 'category', category, bill_no, revenue FROM joined),
sums AS (SELECT kind, slice, count(DISTINCT bill_no) AS bills, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue
         FROM every GROUP BY kind, slice)
SELECT *, revenue / greatest(bills, 1) AS avg_basket,
       round(revenue * 100.0 / (SELECT revenue FROM sums WHERE kind = 'all'), 2) AS pct_share,
       CASE WHEN kind = 'all' THEN (SELECT count(*) FROM sums WHERE kind = 'store') END AS active_stores
FROM sums""")
def dashboard_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard in one pass over the lines: the KPI row and the slices by store, month, weekday and category."""
    words = slices.bill_words(T.revenue_lines(spark, folder), ["store_id", "product_code", "business_date"])
    dated = _with_product(words, spark, folder, "left").select(
        "store_id", S.month_key(F.col("business_date")).alias("month"), S.weekday_iso(F.col("business_date")).alias("iso_day"),
        F.coalesce("category", F.lit("UNASSIGNED")).alias("category"), "word", "bills", "lines", "revenue",
    )
    found = slices.slices_of(dated, {"store": "store_id", "month": "month", "weekday": "iso_day", "category": "category"})
    finished = found.select("kind", "slice", "bills", "lines", S.as_double(F.col("revenue")).alias("revenue"))
    whole, every = W.partitionBy(), F.col("kind") == "all"  # over finished slices, one row each
    return finished.select(
        "*", (F.col("revenue") / F.greatest("bills", F.lit(1))).alias("avg_basket"),
        F.round(F.col("revenue") * 100.0 / F.max(F.when(every, F.col("revenue"))).over(whole), 2).alias("pct_share"),
        F.when(every, F.count_if((F.col("kind") == "store") & F.col("slice").isNotNull()).over(whole)).alias("active_stores"),
    )


@query(f"""
WITH {NET_SQL}
SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(DISTINCT bill_no) AS bills,
       CAST(sum(revenue) AS DOUBLE) / greatest(count(DISTINCT bill_no), 1) AS avg_basket,
       count(DISTINCT store_id) AS active_stores
FROM net""")
def kpi_row(spark: SparkSession, folder: str) -> DataFrame:
    return slices.kpi_row(T.revenue_lines(spark, folder))


@query(f"""
WITH {NET_SQL}
SELECT CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue, count(DISTINCT bill_no) AS bills,
       count(DISTINCT store_id) AS active_stores, count(DISTINCT product_code) AS products_sold
FROM sales""")
def kpi_row_ap(spark: SparkSession, folder: str) -> DataFrame:
    return slices.kpi_row_products(T.revenue_lines(spark, folder, S.SALE_ONLY))


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL},
fact AS (SELECT net.*, category FROM net JOIN products p ON net.product_code = p.product_code
         AND business_date BETWEEN valid_from AND valid_to)
SELECT CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue, count(DISTINCT bill_no) AS bills,
       CAST(coalesce(sum(revenue), 0) AS DOUBLE) / greatest(count(DISTINCT bill_no), 1) AS avg_basket,
       count(DISTINCT store_id) AS active_stores
FROM fact WHERE month = '1998-10' AND category = 'PROMO'""")
def kpi_row_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's KPI row under a month and a category filter, inner product join as there."""
    from lakemart.plans.mart import build_fact

    month = slices.report_filter(month="1998-10")
    fact = build_fact(T.kept_lines(spark, folder).where(month), T.products(spark, folder), how="inner")
    return slices.kpi_row(fact.where(slices.report_filter(category="PROMO")))


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL}
SELECT store_id, coalesce(category, 'UNASSIGNED') AS category, business_date, count(*) AS lines,
       CAST(sum(revenue) AS DOUBLE) AS revenue
FROM net LEFT JOIN products p ON net.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to
GROUP BY ALL""")
def dashboard_mart(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.plans.mart import build_fact
    from lakemart.plans.mart import dashboard_mart as mart

    fact = build_fact(T.kept_lines(spark, folder), T.products(spark, folder))
    return mart(fact).select(
        "store_id", "category", "business_date", "lines", S.as_double(F.col("revenue")).alias("revenue")
    )


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL}, {PRICES_SQL}
SELECT bill_no, line_no, store_name, city, product_sk, category,
       CAST(unit_price AS DOUBLE) AS billed_price, CAST(list_price AS DOUBLE) AS historical_price,
       CAST(CAST(qty AS DECIMAL(10,0)) * list_price AS DOUBLE) AS revenue,
       CAST(extract(dow FROM business_date) AS INTEGER) AS day_of_week_num, dayname(business_date) AS day_of_week
FROM sales LEFT JOIN products p ON sales.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to
LEFT JOIN starts ON sales.product_code = starts.product_code AND business_date >= effective_from AND business_date < valid_until
LEFT JOIN (SELECT s_suppkey, s_name AS store_name, n_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey)
  ON store_id = s_suppkey""")
def wide_fact(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.plans.mart import build_wide_fact

    fact = build_wide_fact(
        T.kept_lines(spark, folder), T.products(spark, folder), T.price_starts(spark, folder), T.stores(spark, folder)
    )
    return fact.select(
        "bill_no", "line_no", "store_name", "city", "product_sk", "category",
        S.as_double(F.col("billed_price")).alias("billed_price"),
        S.as_double(F.col("historical_price")).alias("historical_price"),
        S.as_double(F.col("revenue")).alias("revenue"), "day_of_week_num", "day_of_week",
    )


# --- point-in-time products and prices -----------------------------------------------------------------

def _pit_sql(end: str) -> str:
    return f"""
WITH {NET_SQL}, {PRODUCTS_SQL}
SELECT CAST(product_sk % 2 AS INTEGER) AS version, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM net LEFT JOIN products p ON net.product_code = p.product_code
  AND business_date >= valid_from AND business_date {end} valid_to
GROUP BY 1"""


def _pit(spark: SparkSession, folder: str, closed: bool) -> DataFrame:
    joined = _with_product(_daily(spark, folder), spark, folder, "left", closed)
    return joined.groupBy((F.col("product_sk") % 2).cast("int").alias("version")).agg(
        F.sum("lines").alias("lines"), S.as_double(F.sum("revenue")).alias("revenue")
    )


@query(_pit_sql("<="))
def pit_product_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Inclusive ends, as the masters store them."""
    return _pit(spark, folder, True)


@query(_pit_sql("<"))
def pit_product_halfopen(spark: SparkSession, folder: str) -> DataFrame:
    """Exclusive ends lose the last day of every version."""
    return _pit(spark, folder, False)


def _priced(spark: SparkSession, folder: str) -> DataFrame:
    versioned = _with_product(_daily(spark, folder), spark, folder, "inner").select(
        "product_sk", "product_code", "business_date", "lines", "qty", "price_sum"
    )
    revisions = T.price_revisions(spark, folder).drop("product_code")
    priced = scd.as_of_join(
        versioned, revisions, on="product_sk", date_col="business_date", start="effective_from",
        end="effective_to", how="inner",
    )
    return priced.withColumn("period", S.month_key(F.col("business_date")))


_PRICED_SQL = f"""
WITH {NET_SQL}, {PRODUCTS_SQL}, {PRICES_SQL},
report AS (
  SELECT month AS period, net.product_code, CAST(pr.list_price AS DOUBLE) AS list_price,
         CAST(sum(unit_price) AS DOUBLE) / count(*) AS avg_printed_price, CAST(sum(qty) AS BIGINT) AS total_qty,
         CAST(sum(CAST(qty AS DECIMAL(10,0)) * pr.list_price) AS DOUBLE) AS revenue_at_list_price
  FROM net JOIN products p ON net.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to
  JOIN prices pr ON p.product_sk = pr.product_sk AND business_date BETWEEN effective_from AND effective_to
  GROUP BY month, net.product_code, pr.list_price)"""


def _price_report(spark: SparkSession, folder: str, wanted: Column | None = None) -> DataFrame:
    priced = _priced(spark, folder)
    return slices.price_report(priced if wanted is None else priced.where(wanted), ["period", "product_code", "list_price"]).withColumn(
        "list_price", S.as_double(F.col("list_price"))
    )


@query(f"{_PRICED_SQL} SELECT * FROM report")
def price_interval_report(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue at the price list of the day, for every period."""
    return _price_report(spark, folder)


@query(f"""{_PRICED_SQL}
SELECT b.product_code, b.list_price AS price_before, a.list_price AS price_after,
       round(a.list_price - b.list_price, 2) AS price_change,
       round((a.list_price - b.list_price) / b.list_price * 100.0, 1) AS pct_change
FROM report b JOIN report a ON a.product_code = b.product_code
WHERE b.period = '{REPORT_MONTHS[0]}' AND a.period = '{REPORT_MONTHS[1]}'""")
def price_compare_periods(spark: SparkSession, folder: str) -> DataFrame:
    return slices.compare_periods(_price_report(spark, folder), *REPORT_MONTHS).drop("pct_text")


_PERIOD_QUERY = """
SELECT period, product_code, sum(lines) AS lines, CAST(sum(qty * list_price) AS DOUBLE) AS revenue_at_list_price
FROM {priced} WHERE period IN (:first, :second) GROUP BY period, product_code"""


@query(f"""{_PRICED_SQL},
counted AS (
  SELECT month AS period, net.product_code, count(*) AS lines,
         CAST(sum(CAST(qty AS DECIMAL(10,0)) * pr.list_price) AS DOUBLE) AS revenue_at_list_price
  FROM net JOIN products p ON net.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to
  JOIN prices pr ON p.product_sk = pr.product_sk AND business_date BETWEEN effective_from AND effective_to
  GROUP BY 1, 2)
SELECT * FROM counted WHERE period IN {REPORT_MONTHS}""")
def period_param_report(spark: SparkSession, folder: str) -> DataFrame:
    """One SQL text with the periods as parameters; both are computed in one pass."""
    return spark.sql(_PERIOD_QUERY, args=dict(zip(("first", "second"), REPORT_MONTHS)), priced=_priced(spark, folder))


PRODUCT_SUBSET = (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)


@query(f"""{_PRICED_SQL}
SELECT period, product_code, list_price, total_qty, revenue_at_list_price FROM report WHERE product_code IN {PRODUCT_SUBSET}""")
def product_subset_report(spark: SparkSession, folder: str) -> DataFrame:
    """The price report for a chosen list of products."""
    subset = slices.report_filter(products=PRODUCT_SUBSET)
    report = _price_report(spark, folder, subset)
    return report.select("period", "product_code", "list_price", "total_qty", "revenue_at_list_price")


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL}, {PRICES_SQL}
SELECT CAST(extract(year FROM business_date) AS INTEGER) AS sale_year,
       CAST(extract(month FROM business_date) AS INTEGER) AS sale_month, sales.product_code,
       CAST(sum(list_price) AS DOUBLE) / count(list_price) AS avg_hist_price,
       CAST(sum(unit_price) AS DOUBLE) / count(*) AS avg_billed_price,
       CAST(sum(CAST(qty AS DECIMAL(10,0)) * list_price) AS DOUBLE) AS total_revenue
FROM sales LEFT JOIN starts ON sales.product_code = starts.product_code
  AND business_date >= effective_from AND business_date < valid_until
GROUP BY ALL""")
def price_asof_lead(spark: SparkSession, folder: str) -> DataFrame:
    """Prices known by start date only: each is in force until the next one of its code."""
    starts = scd.intervals_from_starts(T.price_starts(spark, folder), "product_code", "effective_from")
    priced = scd.as_of_join(
        _daily(spark, folder, S.SALE_ONLY), starts, on="product_code", date_col="business_date",
        start="effective_from", end="valid_until", end_inclusive=False,
    )
    known = F.when(F.col("list_price").isNotNull(), F.col("lines"))
    return priced.groupBy(
        F.year("business_date").alias("sale_year"), F.month("business_date").alias("sale_month"), "product_code"
    ).agg(
        (S.as_double(F.sum(F.col("list_price") * F.col("lines"))) / F.sum(known)).alias("avg_hist_price"),
        (S.as_double(F.sum("price_sum")) / F.sum("lines")).alias("avg_billed_price"),
        S.as_double(F.sum(F.col("qty") * F.col("list_price"))).alias("total_revenue"),
    )


@query(f"""
WITH {PRODUCTS_SQL}, {PRICES_SQL}
SELECT product_code, count(DISTINCT list_price) AS n_prices FROM prices
GROUP BY product_code HAVING count(DISTINCT list_price) >= 2""")
def multi_price_products(spark: SparkSession, folder: str) -> DataFrame:
    return slices.repriced_products(T.price_revisions(spark, folder))


# --- federation ----------------------------------------------------------------------------------------

_FEDERATED = """
SELECT store_name, category, department, count(DISTINCT s.bill_no) AS bills,
       CAST(sum(s.revenue) AS DOUBLE) AS category_revenue
FROM {sales} s
JOIN {stores} st ON st.store_id = s.store_id
JOIN {products} p ON s.product_code = p.product_code AND s.business_date BETWEEN p.valid_from AND p.valid_to
GROUP BY store_name, category, department
ORDER BY category_revenue DESC, store_name, category, department
LIMIT :rows"""


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL}
SELECT s_name AS store_name, category, department, count(DISTINCT bill_no) AS bills,
       CAST(sum(revenue) AS DOUBLE) AS category_revenue
FROM sales JOIN supplier ON store_id = s_suppkey
JOIN products p ON sales.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to
GROUP BY ALL ORDER BY category_revenue DESC, store_name, category, department LIMIT 8""")
def federated_category_top(spark: SparkSession, folder: str) -> DataFrame:
    """Sales files joined with master tables in one SQL statement; top 8 is the report."""
    return spark.sql(
        _FEDERATED, args={"rows": 8}, sales=T.revenue_lines(spark, folder, S.SALE_ONLY),
        stores=T.stores(spark, folder), products=T.products(spark, folder),
    )


# --- reconciliation ------------------------------------------------------------------------------------

def _finance(spark: SparkSession, folder: str) -> DataFrame:
    orders = T.table(spark, folder, "orders")
    return orders.groupBy(S.month_key(F.col("o_orderdate")).alias("month")).agg(
        F.sum(F.col("o_totalprice").cast(S.MONEY)).cast(S.TOTAL).alias("finance_revenue")
    )


_FINANCE_SQL = """
finance AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS finance_revenue
            FROM orders GROUP BY 1)"""


@query(f"""
WITH {NET_SQL}, {_FINANCE_SQL},
pipe AS (SELECT month, sum(revenue) AS pipeline_revenue FROM net GROUP BY 1)
SELECT coalesce(pipe.month, finance.month) AS month, CAST(pipeline_revenue AS DOUBLE) AS pipeline_revenue,
       CAST(finance_revenue AS DOUBLE) AS finance_revenue, CAST(finance_revenue - pipeline_revenue AS DOUBLE) AS variance,
       round(CAST(finance_revenue - pipeline_revenue AS DOUBLE) / nullif(CAST(pipeline_revenue AS DOUBLE), 0) * 100.0, 4) AS pct_diff,
       CASE WHEN abs(finance_revenue - pipeline_revenue) < 0.01 THEN 'EXACT MATCH' ELSE 'VARIANCE' END AS status,
       CASE WHEN pipeline_revenue IS NULL THEN 'MISSING IN PIPELINE' WHEN finance_revenue IS NULL THEN 'MISSING IN FINANCE'
            ELSE 'BOTH' END AS coverage
FROM pipe FULL JOIN finance ON pipe.month = finance.month""")
def reconcile_q1(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.reconcile(
        reconcile.monthly_revenue(T.revenue_lines(spark, folder)), _finance(spark, folder)
    ).orderBy("month")


@query(f"""
WITH {NET_SQL}, {_FINANCE_SQL},
pipe AS (SELECT month, sum(revenue) AS pipeline_revenue FROM sales GROUP BY 1)
SELECT CAST(substr(coalesce(pipe.month, finance.month), 1, 4) AS INTEGER) AS sale_year,
       CAST(substr(coalesce(pipe.month, finance.month), 6, 2) AS INTEGER) AS sale_month,
       CAST(pipeline_revenue AS DOUBLE) AS pipeline_revenue, CAST(finance_revenue AS DOUBLE) AS finance_revenue,
       CAST(pipeline_revenue - finance_revenue AS DOUBLE) AS diff,
       round(CAST(pipeline_revenue - finance_revenue AS DOUBLE) / nullif(CAST(finance_revenue AS DOUBLE), 0) * 100.0, 2) AS diff_pct
FROM pipe FULL JOIN finance ON pipe.month = finance.month""")
def reconcile_ap(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.reconcile_by_finance(
        reconcile.monthly_revenue(T.revenue_lines(spark, folder, S.SALE_ONLY)), _finance(spark, folder)
    )


_ROUNDED_SQL = """
bills AS (SELECT month, bill_no, sum(revenue) AS bill_total FROM net GROUP BY 1, 2),
totals AS (SELECT month, count(*) AS bills, CAST(sum(bill_total) AS DECIMAL(28,2)) AS exact_revenue,
                  CAST(sum(round(bill_total, 0)) AS DECIMAL(28,2)) AS rounded_revenue
           FROM bills GROUP BY 1)"""


@query(f"""
WITH {NET_SQL}, {_ROUNDED_SQL}
SELECT month, bills, CAST(exact_revenue AS DOUBLE) AS exact_revenue, CAST(rounded_revenue AS DOUBLE) AS rounded_revenue,
       CAST(rounded_revenue - exact_revenue AS DOUBLE) AS drift
FROM totals""")
def bill_rounded_revenue(spark: SparkSession, folder: str) -> DataFrame:
    totals = reconcile.bill_rounded_revenue(T.revenue_lines(spark, folder))
    return totals.select(
        "month", "bills", S.as_double(F.col("exact_revenue")).alias("exact_revenue"),
        S.as_double(F.col("rounded_revenue")).alias("rounded_revenue"),
        S.as_double(F.col("rounded_revenue") - F.col("exact_revenue")).alias("drift"),
    )


_CALENDAR_SQL = """
calendar AS (SELECT store_id, CAST(day AS DATE) AS day
             FROM (SELECT DISTINCT store_id FROM kept),
                  (SELECT unnest(generate_series(min(business_date), max(business_date), INTERVAL 1 DAY)) AS day FROM kept)),
gone AS (SELECT * FROM calendar ANTI JOIN (SELECT DISTINCT store_id, business_date AS day FROM kept) USING (store_id, day))"""


@query(f"""
WITH {KEPT_SQL}, {_CALENDAR_SQL}
SELECT store_id, count(*) AS n_missing, min(day) AS first_missing FROM gone GROUP BY store_id""")
def missing_store_days(spark: SparkSession, folder: str) -> DataFrame:
    days = durable(T.kept_lines(spark, folder).select("store_id", "business_date").distinct(), "store-days")
    return dedup.store_day_gaps(dedup.missing_store_days(days))


def _bill_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Till bills (``lineitem``) against what was booked (``orders``)."""
    revenue = S.line_revenue(F.col("qty"), F.col("unit_price"))
    raw, kept = (lines(spark, folder).withColumn("revenue", revenue) for lines in (T.raw_lines, T.kept_lines))
    booked = T.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("bill_no"), S.month_key(F.col("o_orderdate")).alias("month"), F.col("o_totalprice").cast(S.MONEY).alias("amount")
    )
    return reconcile.bill_differences(raw, kept, booked)


_BILL_DIFF_SQL = """
counted AS (
  SELECT bill_no, strftime(business_date, '%Y-%m') AS month, line_type <> 'TENDER' AS is_counted,
         CAST(CASE WHEN line_type <> 'TENDER' THEN CAST(qty AS DECIMAL(10,0)) * unit_price ELSE 0 END AS DECIMAL(28,2)) AS revenue,
         CAST(CASE WHEN line_type = 'SALE' THEN CAST(qty AS DECIMAL(10,0)) * unit_price ELSE 0 END AS DECIMAL(28,2)) AS sale FROM kept),
sent AS (SELECT bill_no, sum(CASE WHEN line_type <> 'TENDER' THEN CAST(qty AS DECIMAL(10,0)) * unit_price ELSE 0 END) AS sent_total FROM raw GROUP BY 1),
till AS (SELECT bill_no, count(*) FILTER (is_counted) AS n_counted, sum(revenue) AS till_total, sum(sale) AS sales_total,
                min(month) FILTER (is_counted) AS first_month, max(month) FILTER (is_counted) AS last_month FROM counted GROUP BY 1),
booked AS (SELECT o_orderkey AS bill_no, min(strftime(o_orderdate, '%Y-%m')) AS booked_month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS booked_total FROM orders GROUP BY 1),
diff AS (
  SELECT coalesce(till.bill_no, booked.bill_no) AS bill_no, booked_month, booked_total, till_total, till.n_counted IS NOT NULL AS in_till,
    CASE WHEN booked_total IS NULL THEN 'not booked' WHEN till.n_counted IS NULL THEN 'no till record' WHEN n_counted = 0 THEN 'no counted line'
         WHEN till_total = booked_total AND first_month = booked_month AND last_month = booked_month THEN 'none' WHEN till_total = booked_total THEN 'period'
         WHEN booked_total = round(till_total, 0) THEN 'rounding' WHEN booked_total = sent_total THEN 'counted twice'
         WHEN booked_total = sales_total THEN 'definition' ELSE 'value' END AS cause
  FROM till LEFT JOIN sent ON till.bill_no = sent.bill_no FULL JOIN booked ON till.bill_no = booked.bill_no)"""


@query(f"""
WITH {KEPT_SQL}, {_BILL_DIFF_SQL},
entries AS (
  SELECT month, cause, sum(revenue) AS till, NULL AS booked FROM counted JOIN diff USING (bill_no) WHERE is_counted GROUP BY bill_no, month, cause
  UNION ALL SELECT booked_month, cause, NULL, booked_total FROM diff WHERE booked_total IS NOT NULL)
SELECT month, cause, count(till) AS till_bills, count(booked) AS booked_bills, CAST(coalesce(sum(till), 0) AS DOUBLE) AS pipeline_revenue,
       CAST(coalesce(sum(booked), 0) AS DOUBLE) AS finance_revenue, CAST(coalesce(sum(booked), 0) - coalesce(sum(till), 0) AS DOUBLE) AS variance
FROM entries GROUP BY month, cause""")
def variance_cause(spark: SparkSession, folder: str) -> DataFrame:
    """What each cause, found bill by bill, adds to the variance of each month."""
    parts = reconcile.variance_by_cause(_bill_differences(spark, folder))
    amounts = ("pipeline_revenue", "finance_revenue", "variance")
    return parts.withColumns({c: S.as_double(F.col(c)) for c in amounts})


@query(f"""
WITH {KEPT_SQL}, {_BILL_DIFF_SQL},
accounts AS (
  SELECT o_custkey AS account, booked_month AS month, bill_no, booked_total, coalesce(till_total, 0) AS till_total, cause
  FROM diff JOIN (SELECT DISTINCT o_orderkey, o_custkey FROM orders) o ON o_orderkey = bill_no),
variances AS (SELECT account, month, sum(booked_total - till_total) AS variance FROM accounts GROUP BY ALL HAVING sum(booked_total - till_total) <> 0),
listed AS (SELECT account, month, bill_no AS item, booked_total AS amount FROM accounts WHERE cause IN ('no till record', 'no counted line')),
one AS (SELECT DISTINCT account, month FROM variances JOIN listed USING (account, month) WHERE amount = variance),
two AS (SELECT DISTINCT v.account, v.month FROM variances v JOIN listed a ON a.account = v.account AND a.month = v.month
        JOIN listed b ON b.account = v.account AND b.month = v.month AND b.item > a.item WHERE a.amount + b.amount = variance)
SELECT v.account, v.month, CAST(variance AS DOUBLE) AS variance,
       CASE WHEN one.account IS NOT NULL THEN 1 WHEN two.account IS NOT NULL THEN 2 ELSE 0 END AS n_listed
FROM variances v LEFT JOIN one ON one.account = v.account AND one.month = v.month LEFT JOIN two ON two.account = v.account AND two.month = v.month""")
def variance_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Each account's variance of a month, and whether one or two orders that no till recorded explain it to the cent."""
    orders = T.table(spark, folder, "orders").select(F.col("o_orderkey").alias("bill_no"), F.col("o_custkey").alias("account")).distinct()
    bills = _bill_differences(spark, folder).join(orders, "bill_no").select(
        "account", F.col("booked_month").alias("month"), F.col("bill_no").alias("item"), F.col("booked_total").alias("amount"),
        F.coalesce("till_total", F.lit(0)).cast(S.TOTAL).alias("till_total"), "cause",
    )
    bills = durable(bills, "account-bills")
    variances = bills.groupBy("account", "month").agg(F.sum(F.col("amount") - F.col("till_total")).cast(S.TOTAL).alias("variance")).where("variance <> 0")
    listed = bills.where(F.col("cause").isin("no till record", "no counted line")).select("account", "month", "item", "amount")
    matched = reconcile.match_listed(variances, listed, ["account", "month"])
    return matched.select("account", "month", S.as_double(F.col("variance")).alias("variance"), "n_listed")


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL}, {PRICES_SQL}
SELECT month, store_id, count(*) AS lines, count(list_price) AS priced_lines,
       CAST(sum(CAST(qty AS DECIMAL(10,0)) * list_price) AS DOUBLE) AS revenue_at_list_price
FROM net LEFT JOIN starts ON net.product_code = starts.product_code AND business_date >= effective_from AND business_date < valid_until
GROUP BY month, store_id""")
def price_carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    """Every line at the last list price known on its day, by merging lines and price changes instead of a range join."""
    priced = scd.carry_forward(
        T.revenue_lines(spark, folder), T.price_starts(spark, folder), on="product_code", date_col="business_date", start="effective_from"
    )
    return priced.groupBy(S.month_key(F.col("business_date")).alias("month"), "store_id").agg(
        F.count("*").alias("lines"), F.count("list_price").alias("priced_lines"),
        S.as_double(F.sum(F.col("qty") * F.col("list_price"))).alias("revenue_at_list_price"),
    )


@query(f"""{_PRICED_SQL},
change AS (
  SELECT b.product_code, b.list_price AS price_before, a.list_price AS price_after,
         round((a.list_price - b.list_price) / b.list_price * 100.0, 1) AS pct
  FROM report b JOIN report a ON a.product_code = b.product_code
  WHERE b.period = '{REPORT_MONTHS[0]}' AND a.period = '{REPORT_MONTHS[1]}')
SELECT product_code, price_before, price_after, printf('%.1f%%', pct) AS pct_text FROM change""")
def price_change_text(spark: SparkSession, folder: str) -> DataFrame:
    """The price comparison with its change as text."""
    compared = slices.compare_periods(_price_report(spark, folder), *REPORT_MONTHS)
    return compared.select("product_code", "price_before", "price_after", "pct_text")


@query(f"""
WITH {KEPT_SQL},
days AS (SELECT CAST(day AS DATE) AS date FROM (SELECT unnest(generate_series(min(business_date), max(business_date), INTERVAL 1 DAY)) AS day FROM kept))
SELECT date, CAST(extract(year FROM date) AS INTEGER) AS sale_year, CAST(extract(month FROM date) AS INTEGER) AS sale_month,
       strftime(date, '%Y-%m') AS sale_year_month, CAST(extract(dow FROM date) AS INTEGER) AS day_of_week_num,
       dayname(date) AS day_of_week, strftime(date, '%b') AS month_name
FROM days""")
def date_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The star's calendar, from the first to the last day with a line."""
    from lakemart.plans.mart import dim_date

    ends = T.kept_lines(spark, folder).agg(F.min("business_date").alias("first"), F.max("business_date").alias("last")).first()
    days = dim_date(spark, ends["first"], ends["last"])
    return days.withColumn("month_name", S.month_abbreviation(F.col("sale_month")))


@query(f"""
WITH {NET_SQL}, {PRODUCTS_SQL}
SELECT store_id, coalesce(category, 'UNASSIGNED') AS category, business_date, bill_no, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM net LEFT JOIN products p ON net.product_code = p.product_code AND business_date BETWEEN valid_from AND valid_to
GROUP BY ALL""")
def dashboard_bills(spark: SparkSession, folder: str) -> DataFrame:
    """The mart from which the dashboard counts distinct bills."""
    from lakemart.plans.mart import build_fact
    from lakemart.plans.mart import dashboard_bills as bills

    fact = build_fact(T.kept_lines(spark, folder), T.products(spark, folder))
    return bills(fact).withColumn("revenue", S.as_double(F.col("revenue")))


# --- lake ----------------------------------------------------------------------------------------------

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@query("\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLE_NAMES))
def lake_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return lake.table_counts({t: T.table(spark, folder, t) for t in TABLE_NAMES})


@query("SELECT count(*) AS notices, count(DISTINCT source) AS portals FROM documents")
def lake_scan_counts(spark: SparkSession, folder: str) -> DataFrame:
    return lake.scan_counts(T.table(spark, folder, "documents"), "source", names=("notices", "portals"))


@query()
def partition_prune_report(spark: SparkSession, folder: str) -> DataFrame:
    """Lines landed by year, month and store region; what one region's month opens against the whole layout."""
    from lakemart.workspace import new_path

    path = new_path(spark, "landed-lines")
    regions = T.stores(spark, folder).select("store_id", "region")
    lines = lake.with_month_keys(T.kept_lines(spark, folder).join(regions, "store_id"))
    lake.land(lines.withColumn("store", F.col("region")).drop("region"), path)
    landed = spark.read.parquet(path)
    one_month = landed.where((F.col("year") == 1998) & (F.col("month") == 10) & (F.col("store") == "ASIA"))
    return lake.pruning_report(landed, one_month)
