"""Tables given as Parquet, seen as the mart's lines, products and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import scalars as S
from lakemart.operators.dedup import keep_first
from lakemart.operators.scd import OPEN_END
from lakemart.workspace import spread

LINE_KEYS = ("bill_no", "line_no")
LINE_ORDER = ("business_date", "store_id", "line_type", "product_code", "qty", "unit_price")

# The categories in the order in which a reissued code moves to the next one.
CATEGORY_ORDER = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_lines(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` rows as till lines: one bill per order, one store per supplier."""
    flags = F.concat("l_returnflag", "l_linestatus")
    line_type = (
        F.when(flags.isin("AF", "AO"), "SALE").when(flags == "RF", "RETURN").when(flags == "RO", "VOID")
        .when(flags == "NF", "DISCOUNT").otherwise("TENDER")
    )
    qty, price = F.col("l_quantity").cast("int"), F.col("l_extendedprice").cast("decimal(12,2)")
    return lineitem.select(
        F.col("l_orderkey").alias("bill_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("store_id"),
        F.when(flags != "NF", F.col("l_partkey")).alias("product_code"),
        F.when(flags.isin("RF", "RO"), -qty).otherwise(qty).alias("qty"),
        F.when(flags == "NF", -price).otherwise(price).alias("unit_price"),
        line_type.alias("line_type"),
        F.col("l_shipdate").cast("date").alias("business_date"),
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    return as_lines(spread(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber"))


def kept_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Till lines counted once."""
    return keep_first(raw_lines(spark, folder), LINE_KEYS, LINE_ORDER)


def with_revenue(lines: DataFrame, line_types: tuple[str, ...] = S.NET_LINE_TYPES) -> DataFrame:
    """Lines of the given types with their revenue at the printed price."""
    wanted = lines.where(F.col("line_type").isin(*line_types))
    return wanted.withColumn("revenue", S.line_revenue(F.col("qty"), F.col("unit_price")))


def revenue_lines(spark: SparkSession, folder: str, line_types: tuple[str, ...] = S.NET_LINE_TYPES) -> DataFrame:
    return with_revenue(kept_lines(spark, folder), line_types)


def products(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` as product versions: every fiftieth code was reissued on 1998-07-01 in the next category.

    Ends are inclusive, as in the masters.
    """
    order = F.array(*[F.lit(c) for c in CATEGORY_ORDER])
    next_category = F.element_at(
        order, (F.array_position(order, F.col("p_type")) % len(CATEGORY_ORDER) + 1).cast("int")
    )
    reissued = F.col("p_partkey") % 50 == 0
    first = F.struct(
        F.lit(0).alias("version"), F.col("p_type").alias("category"),
        F.lit("1990-01-01").cast("date").alias("valid_from"),
        F.when(reissued, F.lit("1998-06-30")).otherwise(F.lit(OPEN_END)).cast("date").alias("valid_to"),
    )
    second = F.struct(
        F.lit(1).alias("version"), next_category.alias("category"),
        F.lit("1998-07-01").cast("date").alias("valid_from"), F.lit(OPEN_END).cast("date").alias("valid_to"),
    )
    versions = F.explode(F.when(reissued, F.array(first, second)).otherwise(F.array(first)))
    return (
        table(spark, folder, "part")
        .select("p_partkey", "p_name", "p_brand", "p_retailprice", versions.alias("v"))
        .select(
            (F.col("p_partkey") * 2 + F.col("v.version")).alias("product_sk"),
            F.col("p_partkey").alias("product_code"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("department"),
            "v.category", "v.valid_from", "v.valid_to", "p_retailprice",
        )
    )


def _revisions(products: DataFrame) -> DataFrame:
    start = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("i") * 700 + F.col("product_code") % 300).cast("int"))
    following = F.date_add(start, 699)
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint") * (100 + 5 * F.col("i"))
    return products.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        "product_sk", "product_code",
        (F.floor(cents / 100).cast("decimal(18,2)") / 100).cast("decimal(12,2)").alias("list_price"),
        start.alias("effective_from"),
        F.when(F.col("i") < 3, following).otherwise(F.lit(OPEN_END).cast("date")).alias("effective_to"),
    )


def price_revisions(spark: SparkSession, folder: str) -> DataFrame:
    """Four prices per product version with inclusive ends."""
    return _revisions(products(spark, folder))


def price_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Four prices per product code with start dates only."""
    first = products(spark, folder).where(F.col("product_sk") % 2 == 0)
    return _revisions(first).select("product_code", "list_price", "effective_from")


def stores(spark: SparkSession, folder: str) -> DataFrame:
    """``supplier`` with nation and region as the store dimension."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"), F.col("r_name").alias("region"),
        )
    )
