"""The star schema and the pre-aggregated marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import scalars as S
from lakemart.operators.scd import as_of_join, daily_rollup, intervals_from_starts

UNASSIGNED = "UNASSIGNED"


def dim_date(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))).alias("date")
    )
    return days.select("date", *calendar_columns("date"))


def calendar_columns(day: str) -> list:
    d = F.col(day)
    return [
        F.year(d).alias("sale_year"), F.month(d).alias("sale_month"),
        S.month_key(d).alias("sale_year_month"),
        S.weekday_sunday0(d).alias("day_of_week_num"), S.weekday_name(d).alias("day_of_week"),
    ]


def build_fact(
    lines: DataFrame,
    products: DataFrame,
    *,
    line_types: tuple[str, ...] = S.NET_LINE_TYPES,
    how: str = "left",
    end_inclusive: bool = True,
) -> DataFrame:
    """The sales fact: revenue lines with the product version of their day and calendar columns.

    ``lines`` are de-duplicated; a left join keeps discount lines, which carry no product.
    """
    wanted = lines.where(F.col("line_type").isin(*line_types))
    versions = products.select("product_sk", "product_code", "category", "valid_from", "valid_to")
    joined = as_of_join(
        wanted, versions, on="product_code", date_col="business_date", start="valid_from", end="valid_to",
        how=how, end_inclusive=end_inclusive,
    )
    return joined.select(
        "bill_no", "line_no", "store_id", "product_code", "product_sk",
        F.coalesce("category", F.lit(UNASSIGNED)).alias("category"),
        "business_date", "line_type", "qty", "unit_price",
        S.line_revenue(F.col("qty"), F.col("unit_price")).alias("revenue"),
        *calendar_columns("business_date"),
    )


def build_wide_fact(
    lines: DataFrame, products: DataFrame, price_starts: DataFrame, stores: DataFrame,
    line_types: tuple[str, ...] = S.SALE_ONLY,
) -> DataFrame:
    """The wide fact: sales with store attributes, product version and the price that was in force.

    Price intervals end where the next one starts; revenue is quantity times that list price. Lines
    without product, store or price are kept.
    """
    wanted = lines.where(F.col("line_type").isin(*line_types)).withColumnRenamed("unit_price", "billed_price")
    versions = products.select(
        "product_sk", "product_code", "product_name", "category", "valid_from",
        F.date_add(F.nullif("valid_to", F.lit("9999-12-31").cast("date")), 1).alias("valid_to"),
    )
    with_product = as_of_join(
        wanted, versions, on="product_code", date_col="business_date", start="valid_from", end="valid_to",
        end_inclusive=False,
    ).drop("valid_from", "valid_to")
    prices = intervals_from_starts(price_starts, "product_code", "effective_from").withColumnRenamed(
        "list_price", "historical_price"
    )
    priced = as_of_join(
        with_product, prices, on="product_code", date_col="business_date", start="effective_from",
        end="valid_until", end_inclusive=False,
    ).drop("effective_from", "valid_until")
    return priced.join(stores, "store_id", "left").select(
        "*",
        (F.col("qty").cast("decimal(10,0)") * F.col("historical_price")).cast(S.MONEY).alias("revenue"),
        *calendar_columns("business_date"),
    )


def dashboard_mart(fact: DataFrame) -> DataFrame:
    """Store x category x day sums that every revenue slice of the dashboard can be read from."""
    return daily_rollup(fact, ["store_id", "category", "business_date"])


def dashboard_bills(fact: DataFrame) -> DataFrame:
    """One row per bill and slice: distinct bills cannot be added up, so they have a mart of their own."""
    return fact.groupBy("store_id", "category", "business_date", "bill_no").agg(F.sum("revenue").alias("revenue"))
