"""Monthly totals against finance, and why they differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import scalars as S


def monthly_revenue(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy(S.month_key(F.col("business_date")).alias("month"))
        .agg(F.sum("revenue").cast(S.TOTAL).alias("pipeline_revenue"))
    )


def reconcile(pipeline: DataFrame, finance: DataFrame) -> DataFrame:
    """Finance minus pipeline, in percent of the pipeline; either side may lack a month."""
    both = pipeline.join(finance, "month", "full_outer")
    variance = F.col("finance_revenue") - F.col("pipeline_revenue")
    pct = S.as_double(variance) / F.nullif(S.as_double(F.col("pipeline_revenue")), F.lit(0.0)) * 100.0
    return both.select(
        "month",
        S.as_double(F.col("pipeline_revenue")).alias("pipeline_revenue"),
        S.as_double(F.col("finance_revenue")).alias("finance_revenue"),
        S.as_double(variance).alias("variance"),
        F.round(pct, 4).alias("pct_diff"),
        S.variance_status(variance).alias("status"),
        F.when(F.col("pipeline_revenue").isNull(), "MISSING IN PIPELINE")
        .when(F.col("finance_revenue").isNull(), "MISSING IN FINANCE")
        .otherwise("BOTH").alias("coverage"),
    )


def reconcile_by_finance(pipeline: DataFrame, finance: DataFrame) -> DataFrame:
    """Pipeline minus finance, in percent of finance, keyed by year and month number."""
    keyed = [
        side.withColumn("sale_year", F.substring("month", 1, 4).cast("int"))
        .withColumn("sale_month", F.substring("month", 6, 2).cast("int"))
        .drop("month")
        for side in (pipeline, finance)
    ]
    both = keyed[0].join(keyed[1], ["sale_year", "sale_month"], "full_outer")
    diff = F.col("pipeline_revenue") - F.col("finance_revenue")
    pct = S.as_double(diff) / F.nullif(S.as_double(F.col("finance_revenue")), F.lit(0.0)) * 100.0
    return both.select(
        "sale_year", "sale_month",
        S.as_double(F.col("pipeline_revenue")).alias("pipeline_revenue"),
        S.as_double(F.col("finance_revenue")).alias("finance_revenue"),
        S.as_double(diff).alias("diff"),
        F.round(pct, 2).alias("diff_pct"),
    )


def bill_rounded_revenue(lines: DataFrame) -> DataFrame:
    """Monthly revenue exact and with every bill rounded to the rupee (half away from zero)."""
    per_bill = (
        lines.groupBy(S.month_key(F.col("business_date")).alias("month"), "bill_no")
        .agg(F.sum("revenue").alias("bill_total"))
    )
    return per_bill.groupBy("month").agg(
        F.count("*").alias("bills"),
        F.sum("bill_total").cast(S.TOTAL).alias("exact_revenue"),
        F.sum(F.round("bill_total", 0)).cast(S.TOTAL).alias("rounded_revenue"),
    )


def variance_causes(
    totals: DataFrame, finance: DataFrame, missing_days: DataFrame, adjustments: DataFrame
) -> DataFrame:
    """Classify each month's variance.

    ``totals(month, exact_revenue, rounded_revenue)``, ``finance(month, finance_revenue)``,
    ``missing_days(month, n_missing)`` and ``adjustments(month, amount)``. Checked in this order: none,
    missing side, scope (a listed amount explains it), rounding (finance rounds bills), source (days are
    missing), pipeline (nothing else explains it).
    """
    both = (
        totals.join(finance, "month", "full_outer")
        .join(missing_days, "month", "left")
        .join(adjustments, "month", "left")
    )
    variance = F.col("finance_revenue") - F.col("exact_revenue")
    cause = (
        F.when(variance.isNull(), "missing side")
        .when(F.abs(variance) < 0.01, "none")
        .when(F.abs(variance - F.col("amount")) < 0.01, "scope")
        .when(F.abs(F.col("finance_revenue") - F.col("rounded_revenue")) < 0.01, "rounding")
        .when(F.col("n_missing") > 0, "source")
        .otherwise("pipeline")
    )
    return both.select(
        "month", S.as_double(variance).alias("variance"), cause.alias("cause"),
        F.coalesce("n_missing", F.lit(0)).alias("n_missing"),
    )


def bill_differences(raw: DataFrame, kept: DataFrame, booked: DataFrame) -> DataFrame:
    """Every bill of the tills or of finance, once, with the reason why the two differ.

    ``raw`` and ``kept`` are till lines (``bill_no, line_no, line_type, business_date, revenue``) before and after re-sends are
    removed; ``booked(bill_no, month, amount)`` is what finance has. Both sides are added up by bill before they meet, so no
    bill is more than a row of either. ``by_month`` holds a bill's counted revenue by month of its lines.

    ``cause``, the first that holds: ``not booked``, ``no till record``, ``no counted line`` (tender only), ``none`` and ``period``
    (equal totals, in the booked month or not), ``rounding`` (finance rounds the bill), ``counted twice`` (equal with re-sent
    lines), ``definition`` (equal to its sales alone), ``value`` (nothing else explains it). Bills without number are one bill,
    which no booking meets.
    """
    counted = F.col("line_type").isin(*S.NET_LINE_TYPES)
    money = lambda when: F.coalesce(F.sum(F.when(when, F.col("revenue"))), F.lit(0)).cast(S.TOTAL)
    monthly = kept.groupBy("bill_no", S.month_key(F.col("business_date")).alias("month")).agg(
        F.count(F.when(counted, 1)).alias("counted"), money(counted).alias("revenue"), money(F.col("line_type") == "SALE").alias("sales")
    )
    till = monthly.groupBy("bill_no").agg(
        F.sum("counted").alias("counted"), F.sum("revenue").cast(S.TOTAL).alias("till_total"), F.sum("sales").cast(S.TOTAL).alias("sales_total"),
        F.collect_list(F.when(F.col("counted") > 0, F.struct("month", "revenue"))).alias("by_month"),
    )
    sent = raw.groupBy("bill_no").agg(money(counted).alias("sent_total"))
    till = till.join(sent.withColumnRenamed("bill_no", "sent_no"), F.col("bill_no").eqNullSafe(F.col("sent_no")), "left").drop("sent_no")
    finance = booked.groupBy("bill_no").agg(F.min("month").alias("booked_month"), F.sum("amount").cast(S.TOTAL).alias("booked_total"))
    both = till.withColumn("__till", F.lit(True)).join(finance.withColumn("__booked", F.lit(True)), "bill_no", "full_outer")
    total, amount = F.col("till_total"), F.col("booked_total")
    there = F.forall("by_month", lambda m: m["month"] == F.col("booked_month"))
    cause = (
        F.when(F.col("__booked").isNull(), "not booked").when(F.col("__till").isNull(), "no till record")
        .when(F.col("counted") == 0, "no counted line")
        .when((total == amount) & there, "none").when(total == amount, "period")
        .when(amount == F.round(total, 0), "rounding").when(amount == F.col("sent_total"), "counted twice")
        .when(amount == F.col("sales_total"), "definition").otherwise("value")
    )
    return both.select("bill_no", "booked_month", "booked_total", "till_total", "by_month", cause.alias("cause"))


def variance_by_cause(differences: DataFrame) -> DataFrame:
    """``(month, cause, till_bills, booked_bills, pipeline_revenue, finance_revenue, variance)`` from ``bill_differences``.

    A bill's bookings and lines count in their own months under the bill's cause, so the parts of a month add up to its variance.
    """
    zero = F.lit(0).cast(S.TOTAL)
    lines = F.transform(F.coalesce("by_month", F.array()), lambda m: F.struct(m["month"].alias("month"), m["revenue"].alias("till"), F.lit(None).cast(S.TOTAL).alias("booked")))
    booking = F.struct(F.col("booked_month").alias("month"), F.lit(None).cast(S.TOTAL).alias("till"), F.col("booked_total").alias("booked"))
    bookings = F.when(F.col("booked_total").isNotNull(), F.array(booking)).otherwise(F.array().cast("array<struct<month:string,till:decimal(28,2),booked:decimal(28,2)>>"))
    entries = differences.select("cause", F.explode(F.concat(lines, bookings)).alias("e"))
    parts = entries.groupBy("e.month", "cause").agg(
        F.count("e.till").alias("till_bills"), F.count("e.booked").alias("booked_bills"),
        F.coalesce(F.sum("e.till"), zero).cast(S.TOTAL).alias("pipeline_revenue"), F.coalesce(F.sum("e.booked"), zero).cast(S.TOTAL).alias("finance_revenue"),
    )
    return parts.withColumn("variance", F.col("finance_revenue") - F.col("pipeline_revenue"))


def match_listed(variances: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """``variances(*keys, variance)`` with ``n_listed``: by how many amounts of ``listed(*keys, item, amount)`` each is explained.

    One amount equal to the variance, else two that add up to it, else 0. The second amount is looked up as what the first
    leaves, so both steps are equality joins and no pairs are made. Items are distinct within their keys.
    """
    one = variances.join(listed.withColumnRenamed("amount", "variance"), [*keys, "variance"]).select(*keys, "variance").distinct()
    first = variances.join(listed.select(*keys, F.col("item").alias("first_item"), F.col("amount").alias("first_amount")), keys)
    first = first.withColumn("amount", (F.col("variance") - F.col("first_amount")).cast(listed.schema["amount"].dataType))
    two = first.join(listed, [*keys, "amount"]).where("item > first_item").select(*keys, "variance").distinct()
    known = one.withColumn("n", F.lit(1)).unionByName(two.withColumn("n", F.lit(2))).groupBy(*keys, "variance").agg(F.min("n").alias("n_listed"))
    return variances.join(known, [*keys, "variance"], "left").withColumn("n_listed", F.coalesce("n_listed", F.lit(0)))
