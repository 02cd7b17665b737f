"""Revenue slices, KPI rows and price reports over mart lines.

Distinct bills are counted on (slice, bill) sums: lines shrink to one row per bill before they shuffle. Where several slices are
wanted at once, bills are bits of 64-bit words instead, which merge exactly, so that one pass over the lines serves all slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import scalars as S


def report_filter(
    *, month: str | None = None, store: object | None = None, category: str | None = None, products: Sequence | None = None,
) -> Column:
    """Optional report filters; None means all."""
    condition = F.lit(True)
    if month is not None:
        condition = condition & (S.month_key(F.col("business_date")) == month)
    if store is not None:
        condition = condition & (F.col("store_id") == store)
    if category is not None:
        condition = condition & (F.col("category") == category)
    if products is not None:
        condition = condition & F.col("product_code").isin(*products)
    return condition


def revenue_by(lines: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Distinct bills, lines and revenue per slice."""
    named = lines.select(*keys, "bill_no", "revenue")
    names = [c for c in named.columns if c not in ("bill_no", "revenue")]
    per_bill = named.groupBy(*names, "bill_no").agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("lines")
    )
    return per_bill.groupBy(*names).agg(
        F.count("*").alias("bills"),
        F.sum("lines").alias("lines"),
        F.sum("revenue").cast(S.TOTAL).alias("revenue"),
    )


def weekday_calendar(spark: SparkSession) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in S.WEEKDAYS for x in pair])
    return spark.range(1, 8, 1, 1).select(
        F.col("id").cast("int").alias("iso_day"), names[F.col("id").cast("int")].alias("day_name")
    )


def revenue_by_weekday(lines: DataFrame) -> DataFrame:
    """Every weekday in calendar order, those without lines included."""
    slices = revenue_by(lines, [S.weekday_iso(F.col("business_date")).alias("iso_day")])
    return (
        weekday_calendar(lines.sparkSession)
        .join(slices, "iso_day", "left")
        .select(
            "iso_day", "day_name", "bills",
            S.as_double(F.col("revenue")).alias("revenue"),
            F.round(S.as_double(F.col("revenue")) / F.col("lines"), 2).alias("avg_line"),
        )
        .orderBy("iso_day")
    )


def with_share(slices: DataFrame, measure: str = "revenue") -> DataFrame:
    """Percent of the grand total; the total covers every slice given, named or not.

    The window runs over finished slices, one row each, not over lines.
    """
    total = S.as_double(F.sum(measure).over(W.partitionBy()))
    return slices.withColumn("pct_share", F.round(S.as_double(F.col(measure)) * 100.0 / total, 2))


def bill_word(lines: DataFrame, bill: str = "bill_no") -> tuple[Column, Column]:
    """The word that a bill belongs to and its bit there: 64 consecutive numbers are one word, and no two bills share a bit.

    Whole numbers are taken as they are. Of text the digits at its end are the number, and what stands before them, with the
    count of digits, is part of the word; text that ends otherwise is a word of its own. A NULL bill has no bit.
    """
    if isinstance(lines.schema[bill].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = F.col(bill).cast("bigint")
        return F.shiftright(number, 6), _bit(number)
    text = F.col(bill).cast("string")
    digits = F.regexp_extract(text, "([0-9]{1,9})$", 1)
    number = F.coalesce(F.nullif(digits, F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))
    head = F.substring(text, F.lit(1), F.char_length(text) - F.char_length(digits))
    word = F.when(text.isNotNull(), F.struct(
        head.alias("head"), F.char_length(digits).alias("digits"), F.shiftright(number, 6).alias("high"),
    ))
    return word, F.when(text.isNotNull(), _bit(number))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))


def bill_words(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines as sums by ``keys`` and word of bills: ``word, bills`` (bits), ``lines, revenue``. Words merge by bitwise or."""
    word, bit = bill_word(lines)
    return lines.select(*keys, "revenue", word.alias("word"), bit.alias("bit")).groupBy(*keys, "word").agg(
        F.bit_or("bit").alias("bills"), F.count("*").alias("lines"), F.sum("revenue").alias("revenue")
    )


def slices_of(words: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Every slice of every kind at once: ``kind, slice`` (text), distinct ``bills``, ``lines`` and ``revenue``.

    ``words`` come from ``bill_words``, ``kinds`` names a column of theirs for each kind; kind ``all`` is one slice of everything.
    All rows of a word are brought together once. Then each slice's bits are merged in place, and only counts move on. A bill's
    rows are already sums, so a bill on very many lines is no more than its slices.
    """
    labels = [F.struct(F.lit("all").alias("kind"), F.lit(None).cast("string").alias("slice"))] + [
        F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("slice")) for kind, column in kinds.items()
    ]
    each = words.repartition("word").select("word", "bills", "lines", "revenue", F.explode(F.array(*labels)).alias("of"))
    merged = each.groupBy("of.kind", "of.slice", "word").agg(
        F.bit_or("bills").alias("bills"), F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue")
    )
    return merged.groupBy("kind", "slice").agg(
        F.coalesce(F.sum(F.bit_count("bills")), F.lit(0)).cast("bigint").alias("bills"),
        F.sum("lines").alias("lines"), F.sum("revenue").cast(S.TOTAL).alias("revenue"),
    )


def _kpis(lines: DataFrame, counted: Mapping[str, str]) -> DataFrame:
    """One row of totals: ``counted`` names a column for each number of distinct values that is wanted beside the bills."""
    found = slices_of(bill_words(lines, list(counted.values())), counted)
    every = F.col("kind") == "all"
    return found.agg(
        S.as_double(F.coalesce(F.sum(F.when(every, F.col("revenue"))), F.lit(0))).alias("total_revenue"),
        F.coalesce(F.sum(F.when(every, F.col("bills"))), F.lit(0)).cast("bigint").alias("bills"),
        *[F.count_if((F.col("kind") == kind) & F.col("slice").isNotNull()).alias(kind) for kind in counted],
    )


def kpi_row(lines: DataFrame) -> DataFrame:
    """Total revenue, distinct bills, average basket and active stores."""
    return _kpis(lines, {"active_stores": "store_id"}).select(
        "total_revenue", "bills",
        (F.col("total_revenue") / F.greatest("bills", F.lit(1))).alias("avg_basket"),
        "active_stores",
    )


def kpi_row_products(lines: DataFrame) -> DataFrame:
    """Total revenue, distinct bills, stores and products."""
    return _kpis(lines, {"active_stores": "store_id", "products_sold": "product_code"})


def price_report(priced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quantity, average printed price and revenue at list price.

    ``priced`` holds daily rollups (``lines, qty, price_sum``) with the ``list_price`` of the day.
    """
    return priced.groupBy(*keys).agg(
        (S.as_double(F.sum("price_sum")) / F.sum("lines")).alias("avg_printed_price"),
        F.sum("qty").cast("bigint").alias("total_qty"),
        S.as_double(F.sum(F.col("qty") * F.col("list_price"))).alias("revenue_at_list_price"),
    )


def compare_periods(report: DataFrame, before: str, after: str) -> DataFrame:
    """Prices of two periods side by side; several prices in a period give every combination."""
    prices = lambda period: F.collect_list(F.when(F.col("period") == period, F.col("list_price")))
    both = report.where(F.col("period").isin(before, after)).groupBy("product_code").agg(
        prices(before).alias("old"), prices(after).alias("new")
    )
    both = both.select("product_code", F.explode("old").alias("price_before"), "new")
    both = both.select("product_code", "price_before", F.explode("new").alias("price_after"))
    change = F.round(F.col("price_after") - F.col("price_before"), 2)
    pct = F.round(S.percent_change(F.col("price_before"), F.col("price_after")), 1)
    return both.select(
        "product_code", "price_before", "price_after",
        change.alias("price_change"), pct.alias("pct_change"), S.percent_text(pct).alias("pct_text"),
    )


def repriced_products(prices: DataFrame, minimum: int = 2) -> DataFrame:
    """Product codes that had at least ``minimum`` different prices."""
    return (
        prices.groupBy("product_code").agg(F.countDistinct("list_price").alias("n_prices"))
        .where(F.col("n_prices") >= minimum)
    )


def top(slices: DataFrame, n: int, measure: str, tie_break: Sequence[str]) -> DataFrame:
    """The n largest slices; ties are ordered by ``tie_break``."""
    return slices.orderBy(F.col(measure).desc(), *tie_break).limit(n)
