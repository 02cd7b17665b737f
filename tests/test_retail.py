"""De-duplication, point-in-time joins, slices, marts and reconciliation."""

import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions import scalars as S
from lakemart.operators import dedup, reconcile, scd, slices
from lakemart.plans import mart

D = dt.date
LINES = "bill_no string, line_no int, store_id string, product_code string, qty int, unit_price decimal(12,2), line_type string, business_date date"


@pytest.fixture(scope="module")
def lines(spark):
    d = Decimal
    return spark.createDataFrame([
        ("b1", 1, "S1", "P1", 2, d("10.00"), "SALE", D(2024, 5, 31)),
        ("b1", 2, "S1", "DISC", 1, d("-1.50"), "DISCOUNT", D(2024, 5, 31)),
        ("b1", 3, "S1", "TAX", 1, d("2.00"), "TAX", D(2024, 5, 31)),
        ("b1", 4, "S1", "TENDER", 1, d("20.50"), "TENDER", D(2024, 5, 31)),
        ("b2", 1, "S1", "P1", 1, d("11.00"), "SALE", D(2024, 6, 1)),
        ("b2", 2, "S1", "P1", -1, d("11.00"), "VOID", D(2024, 6, 1)),
        ("b3", 1, "S2", "P1", -1, d("10.00"), "RETURN", D(2024, 6, 2)),
    ], LINES)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        (1, "P1", "old", "C06", D(2019, 4, 1), D(2024, 5, 31)),
        (2, "P1", "new", "C13", D(2024, 6, 1), D(9999, 12, 31)),
    ], "product_sk bigint, product_code string, product_name string, category string, valid_from date, valid_to date")


def revenue(lines, types=S.NET_LINE_TYPES):
    return lines.where(F.col("line_type").isin(*types)).withColumn("revenue", S.line_revenue(F.col("qty"), F.col("unit_price")))


def test_tender_and_tax_are_no_revenue(lines):
    total = revenue(lines).agg(S.as_double(F.sum("revenue"))).first()[0]
    assert total == 20.0 - 1.5 + 11 - 11 - 10


def test_closed_interval_keeps_the_last_day_halfopen_loses_it(lines, products, rows):
    def versions(closed):
        joined = scd.as_of_join(
            lines.where("product_code = 'P1'"), products, on="product_code", date_col="business_date", start="valid_from",
            end="valid_to", end_inclusive=closed,
        )
        return rows(joined, "bill_no", "line_no", "category")

    assert versions(True) == [("b1", 1, "C06"), ("b2", 1, "C13"), ("b2", 2, "C13"), ("b3", 1, "C13")]
    assert versions(False)[0] == ("b1", 1, None)


def test_left_join_keeps_facts_without_key_and_inner_drops_them(spark, products, rows):
    facts = spark.createDataFrame([(1, None, D(2024, 1, 1)), (2, "P1", D(2024, 1, 1)), (3, "P9", D(2024, 1, 1))],
                                  "id int, product_code string, day date")
    options = dict(on="product_code", date_col="day", start="valid_from", end="valid_to")
    assert rows(scd.as_of_join(facts, products, **options), "id", "product_sk") == [(1, None), (2, 1), (3, None)]
    assert rows(scd.as_of_join(facts, products, how="inner", **options), "id") == [(2,)]


def test_open_end_may_be_null(spark, rows):
    facts = spark.createDataFrame([("P1", D(2030, 1, 1))], "product_code string, day date")
    dim = spark.createDataFrame([("P1", D(2020, 1, 1), None)], "product_code string, valid_from date, valid_to date")
    joined = scd.as_of_join(facts, dim, on="product_code", date_col="day", start="valid_from", end="valid_to", end_inclusive=False)
    assert rows(joined, "valid_from") == [(D(2020, 1, 1),)]


def test_prices_by_start_date(spark, rows):
    starts = spark.createDataFrame([("P1", 28, D(2024, 1, 1)), ("P1", 30, D(2024, 3, 1))], "product_code string, price int, since date")
    facts = spark.createDataFrame([("P1", D(2023, 12, 31)), ("P1", D(2024, 2, 29)), ("P1", D(2024, 3, 1))], "product_code string, day date")
    joined = scd.as_of_join(
        facts, scd.intervals_from_starts(starts, "product_code", "since"), on="product_code", date_col="day", start="since",
        end="valid_until", end_inclusive=False,
    )
    assert rows(joined, "day", "price") == [(D(2023, 12, 31), None), (D(2024, 2, 29), 28), (D(2024, 3, 1), 30)]


def test_voided_bills_either_net_to_zero_or_go(lines, rows):
    kept = dedup.without_voided_bills(lines)
    assert {r.bill_no for r in kept.collect()} == {"b1", "b3"}
    assert revenue(lines.where("bill_no = 'b2'")).agg(S.as_double(F.sum("revenue"))).first()[0] == 0.0


def test_fact_and_dashboard(lines, products, rows):
    fact = mart.build_fact(lines, products)
    assert rows(fact.groupBy("category").agg(S.as_double(F.sum("revenue")))) == [("C06", 20.0), ("C13", -10.0), ("UNASSIGNED", -1.5)]
    inner = mart.build_fact(lines, products, how="inner")
    assert inner.where("category = 'UNASSIGNED'").count() == 0
    day = mart.dashboard_mart(fact).where("category = 'C13'")
    assert rows(day, "store_id", "lines", S.as_double(F.col("revenue"))) == [("S1", 2, 0.0), ("S2", 1, -10.0)]
    assert mart.dashboard_bills(fact).select("bill_no").distinct().count() == 3


def test_wide_fact_prices_sales_at_list(spark, lines, products, rows):
    starts = spark.createDataFrame([("P1", Decimal("9.00"), D(2024, 1, 1))], "product_code string, list_price decimal(12,2), effective_from date")
    stores = spark.createDataFrame([("S1", "One", "Pune", "W")], "store_id string, store_name string, city string, region string")
    fact = mart.build_wide_fact(lines, products, starts, stores)
    assert rows(fact, "bill_no", "store_name", "category", S.as_double(F.col("revenue")), "day_of_week") == [
        ("b1", "One", "C06", 18.0, "Friday"), ("b2", "One", "C13", 9.0, "Saturday")
    ]


def test_dim_date(spark, rows):
    got = rows(mart.dim_date(spark, "2024-02-28", "2024-03-01"))
    assert got[1] == (D(2024, 2, 29), 2024, 2, "2024-02", 4, "Thursday") and len(got) == 3


def test_weekdays_in_order_with_missing_ones(lines):
    got = [tuple(r) for r in slices.revenue_by_weekday(revenue(lines)).collect()]
    assert [r[1] for r in got] == [name for _, name in S.WEEKDAYS]
    assert got[0][2:] == (None, None, None) and got[4][2:] == (1, 18.5, 9.25)


def test_share_is_of_all_revenue(spark, rows):
    df = spark.createDataFrame([("a", Decimal("60.00")), (None, Decimal("40.00"))], "category string, revenue decimal(18,2)")
    assert rows(slices.with_share(df), "category", "pct_share") == [("a", 60.0), (None, 40.0)]


def test_kpis_of_nothing(lines):
    nothing = revenue(lines).where("false")
    assert tuple(slices.kpi_row(nothing).first()) == (0.0, 0, 0.0, 0)
    assert tuple(slices.kpi_row(revenue(lines)).first()) == (8.5, 3, 8.5 / 3, 2)


def test_slices_at_once_equal_slices_one_by_one(spark):
    rng = random.Random(5)
    bills = [None, "b1", "b01", "b", "", "S1/20240101/00063", "S1/20240101/00064", "S1/20240102/00063"]
    for kind, choose in (("string", lambda: rng.choice(bills)), ("bigint", lambda: rng.choice([None, -1, -64, 0, 63, 64, 2**40]))):
        data = [(choose(), rng.choice(["S1", "S2", None]), rng.choice([1, 2]), Decimal(rng.randint(-500, 500)) / 100) for _ in range(300)]
        df = spark.createDataFrame(data, f"bill_no {kind}, store_id string, iso_day int, revenue decimal(18,2)")
        found = slices.slices_of(slices.bill_words(df, ["store_id", "iso_day"]), {"store": "store_id", "weekday": "iso_day"})
        want = {}
        for bill, store, day, revenue in data:
            for key in (("all", None), ("store", store), ("weekday", str(day))):
                seen, lines, total = want.get(key, (set(), 0, Decimal(0)))
                want[key] = seen | ({bill} - {None}), lines + 1, total + revenue
        got = {(r["kind"], r["slice"]): (r["bills"], r["lines"], r["revenue"]) for r in found.collect()}
        assert got == {key: (len(seen), lines, total) for key, (seen, lines, total) in want.items()}


def test_slices_of_nothing(lines):
    nothing = revenue(lines).where("false")
    assert slices.slices_of(slices.bill_words(nothing, ["store_id"]), {"store": "store_id"}).collect() == []
    assert tuple(slices.kpi_row_products(nothing).first()) == (0.0, 0, 0, 0)


def test_report_filter(lines):
    assert lines.where(slices.report_filter()).count() == 7
    assert lines.where(slices.report_filter(month="2024-06", store="S2")).count() == 1


def test_period_comparison_and_percent_text(spark, rows):
    report = spark.createDataFrame([("m1", "P1", 10.0), ("m2", "P1", 11.0), ("m2", "P1", 12.0), ("m2", "P2", 1.0)],
                                   "period string, product_code string, list_price double")
    assert rows(slices.compare_periods(report, "m1", "m2"), "price_after", "pct_change", "pct_text") == [
        (11.0, 10.0, "10.0%"), (12.0, 20.0, "20.0%")
    ]


def test_repriced_products(spark, rows):
    prices = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], "product_code string, list_price int")
    assert rows(slices.repriced_products(prices)) == [("a", 2)]


def test_month_abbreviation_and_weekday_numbers(spark):
    row = spark.range(1).select(
        S.month_abbreviation(F.lit(3)), S.weekday_sunday0(F.lit("2024-03-03").cast("date")), S.weekday_iso(F.lit("2024-03-03").cast("date"))
    ).first()
    assert tuple(row) == ("Mar", 0, 7)


def test_checksum_ignores_order_and_sees_every_change(spark, lines):
    columns = lines.columns
    base = dedup.dataset_checksum(lines, columns).first()
    assert dedup.dataset_checksum(lines.repartition(3, "line_no").orderBy(F.desc("bill_no")), columns).first() == base
    changed = lines.withColumn("qty", F.when(F.col("bill_no") == "b3", 5).otherwise(F.col("qty")))
    assert dedup.dataset_checksum(changed, columns).first().checksum != base.checksum
    a = spark.createDataFrame([(None, "")], "x string, y string")
    b = spark.createDataFrame([("", None)], "x string, y string")
    assert dedup.dataset_checksum(a, ["x", "y"]).first() != dedup.dataset_checksum(b, ["x", "y"]).first()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 9)), min_size=1, max_size=30))
def test_keep_first_is_idempotent_and_minimal(spark, data):
    df = spark.createDataFrame(data, "bill int, line int, v int")
    once = dedup.keep_first(df, ["bill", "line"], ["v"])
    want = {}
    for bill, line, v in data:
        want[bill, line] = min(v, want.get((bill, line), v))
    assert {(r.bill, r.line): r.v for r in once.collect()} == want
    assert sorted(map(tuple, dedup.keep_first(once.union(df), ["bill", "line"], ["v"]).collect())) == sorted(map(tuple, once.collect()))


def test_idempotency_report(lines):
    doubled = lines.unionByName(lines)
    report = dedup.idempotency_report([lines, doubled, doubled], ["bill_no", "line_no"], lines.columns, lines.columns[2:])
    assert dedup.is_idempotent(report).first() == (3, True)
    assert [r.removed_rows for r in report.orderBy("run").collect()] == [0, 7, 7]


def test_repeated_loads_write_only_what_changes(spark, lines, monkeypatch):
    written, write = [], dedup.durable

    def watched(df, label):
        table = write(df, label)
        written.append(table.count())
        return table

    monkeypatch.setattr(dedup, "durable", watched)
    report = dedup.repeated_loads(lines.unionByName(lines), ["bill_no", "line_no"], lines.columns, lines.columns[2:])
    assert dedup.is_idempotent(report).first() == (3, True) and {r.removed_rows for r in report.collect()} == {7}
    assert written == [lines.count(), 0, 0]


def test_merging_a_load_is_keep_first_over_both(spark):
    kinds = "bill int, line int, day date, v int"
    stored = spark.createDataFrame([(1, 1, D(2024, 1, 2), 5), (1, None, None, 3), (None, 2, D(2024, 1, 1), 1), (4, 4, None, None)], kinds)
    raw = spark.createDataFrame([
        (1, 1, D(2024, 1, 1), 9), (1, 1, D(2024, 1, 2), 4), (1, None, None, 3), (None, 2, None, 7), (4, 4, None, 0), (None, None, None, 2),
        (None, None, None, 1), (6, 1, D(2024, 1, 3), 2),
    ], kinds)
    got, want = dedup.merge_first(stored, raw, ["bill", "line"], ["day", "v"]), dedup.keep_first(stored.union(raw), ["bill", "line"], ["day", "v"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_checksum_adds_up_the_slices_of_the_digests(spark):
    """Over more rows than a batch holds, and over none."""
    rows = spark.range(25_000, numPartitions=2).select("id")
    got = dedup.dataset_checksum(rows, ["id"]).first()
    digests = [hashlib.sha256(f"={i}".encode()).hexdigest() for i in range(25_000)]
    sums = [str(sum(int(d[15 * k : 15 * k + 15], 16) for d in digests)) for k in range(4)]
    assert tuple(got) == (25_000, *sums, hashlib.sha256("|".join(sums).encode()).hexdigest())
    assert tuple(dedup.dataset_checksum(rows.where("id < 0"), ["id"]).first()) == (0, None, None, None, None, hashlib.sha256(b"").hexdigest())


def test_missing_days(spark, rows):
    df = spark.createDataFrame(
        [("S1", D(2024, 7, 2)), ("S1", D(2024, 7, 2)), ("S1", D(2024, 7, 6)), ("S2", D(2024, 6, 1)), ("S3", D(2024, 7, 1)),
         ("S3", D(2024, 8, 9)), ("S4", D(2024, 7, 8))], "store_id string, business_date date")
    gaps = dedup.missing_store_days(df, "2024-07-01", "2024-07-08")
    assert rows(gaps) == [
        ("S1", D(2024, 7, 1), D(2024, 7, 1), 1), ("S1", D(2024, 7, 3), D(2024, 7, 5), 3), ("S1", D(2024, 7, 7), D(2024, 7, 8), 2),
        ("S2", D(2024, 7, 1), D(2024, 7, 8), 8), ("S3", D(2024, 7, 2), D(2024, 7, 8), 7), ("S4", D(2024, 7, 1), D(2024, 7, 7), 7),
    ]
    assert rows(dedup.store_day_gaps(gaps), "store_id", "n_missing")[0] == ("S1", 6)


MONEY2 = "month string, {} decimal(28,2)"


def test_reconciliation_signs_and_missing_sides(spark, rows):
    d = Decimal
    pipeline = spark.createDataFrame([("2024-01", d("100.00")), ("2024-02", d("50.00")), ("2024-03", d("7.00"))], MONEY2.format("pipeline_revenue"))
    finance = spark.createDataFrame([("2024-01", d("100.00")), ("2024-02", d("60.00")), ("2024-04", d("1.00"))], MONEY2.format("finance_revenue"))
    assert rows(reconcile.reconcile(pipeline, finance), "month", "variance", "pct_diff", "status", "coverage") == [
        ("2024-01", 0.0, 0.0, "EXACT MATCH", "BOTH"), ("2024-02", 10.0, 20.0, "VARIANCE", "BOTH"),
        ("2024-03", None, None, "VARIANCE", "MISSING IN FINANCE"), ("2024-04", None, None, "VARIANCE", "MISSING IN PIPELINE"),
    ]
    assert rows(reconcile.reconcile_by_finance(pipeline, finance), "sale_month", "diff", "diff_pct")[1] == (2, -10.0, -16.67)


def test_causes(spark, rows):
    d = Decimal
    totals = spark.createDataFrame(
        [(f"2024-0{m}", d("1000.40"), d("1000.00")) for m in range(1, 7)], "month string, exact_revenue decimal(28,2), rounded_revenue decimal(28,2)")
    finance = spark.createDataFrame([
        ("2024-01", d("1000.40")), ("2024-02", d("1000.00")), ("2024-03", d("487250.40")), ("2024-04", d("1200.00")), ("2024-05", d("1200.00")),
    ], MONEY2.format("finance_revenue"))
    lost = spark.createDataFrame([("2024-04", 3)], "month string, n_missing int")
    adjustments = spark.createDataFrame([("2024-03", d("486250.00"))], "month string, amount decimal(18,2)")
    got = rows(reconcile.variance_causes(totals, finance, lost, adjustments), "month", "cause")
    assert [c for _, c in got] == ["none", "rounding", "scope", "source", "pipeline", "missing side"]


def test_bill_rounding(spark, rows):
    df = spark.createDataFrame([("b1", D(2024, 12, 1), Decimal("1.25")), ("b1", D(2024, 12, 1), Decimal("1.25")), ("b2", D(2024, 12, 2), Decimal("-0.40"))],
                               "bill_no string, business_date date, revenue decimal(18,2)")
    assert rows(reconcile.bill_rounded_revenue(df), "month", "bills", S.as_double(F.col("exact_revenue")), S.as_double(F.col("rounded_revenue"))) == [
        ("2024-12", 2, 2.1, 3.0)
    ]


def test_hot_key_sends_one_row_per_map_task(lines):
    plan = dedup.keep_first(lines.repartition(4), ["bill_no", "line_no"], ["qty"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_bills_differ_for_reasons_found_in_the_data(spark, rows):
    def line(bill, line_no, kind, day, revenue):
        return bill, line_no, kind, day, Decimal(str(revenue))

    may, june = D(2024, 5, 30), D(2024, 6, 1)
    kept = [
        line(1, 1, "SALE", may, "10.40"), line(2, 1, "SALE", may, "5.00"), line(2, 2, "SALE", june, "6.00"), line(3, 1, "SALE", may, "10.40"),
        line(4, 1, "SALE", may, "7.10"), line(5, 1, "SALE", may, "20.20"), line(5, 2, "DISCOUNT", may, "-2.00"), line(6, 1, "TENDER", may, "9.00"),
        line(7, 1, "SALE", may, "3.00"), line(8, 1, "SALE", june, "4.00"), line(None, 1, "SALE", may, "1.00"),
    ]
    booked = [(1, "2024-05", "10.40"), (2, "2024-05", "11.00"), (3, "2024-05", "10.00"), (4, "2024-05", "14.20"), (5, "2024-05", "20.20"),
              (6, "2024-05", "9.00"), (8, "2024-05", "400.00"), (9, "2024-06", "50.00"), (None, "2024-06", "2.00")]
    schema = "bill_no int, line_no int, line_type string, business_date date, revenue decimal(18,2)"
    kept_df = spark.createDataFrame(kept, schema)
    raw_df = spark.createDataFrame(kept + [kept[4]], schema)
    booked_df = spark.createDataFrame([(b, m, Decimal(a)) for b, m, a in booked], "bill_no int, month string, amount decimal(18,2)")
    diff = reconcile.bill_differences(raw_df, kept_df, booked_df)
    assert rows(diff, "bill_no", "cause") == sorted([
        (1, "none"), (2, "period"), (3, "rounding"), (4, "counted twice"), (5, "definition"), (6, "no counted line"), (7, "not booked"),
        (8, "value"), (9, "no till record"), (None, "not booked"), (None, "no till record")], key=str)
    parts = {(r.month, r.cause): r for r in reconcile.variance_by_cause(diff).collect()}
    assert float(parts["2024-05", "period"].variance) == 6 and float(parts["2024-06", "period"].variance) == -6
    assert float(parts["2024-05", "rounding"].variance) == -0.4 and float(parts["2024-06", "value"].variance) == -4
    till = sum(float(r[4]) for r in kept if r[2] != "TENDER")
    assert sum(float(p.variance) for p in parts.values()) == pytest.approx(sum(float(a) for _, _, a in booked) - till)
    empty = reconcile.variance_by_cause(reconcile.bill_differences(raw_df.limit(0), kept_df.limit(0), booked_df.limit(0)))
    assert empty.count() == 0


def test_variances_meet_listed_amounts(spark, rows):
    variances = spark.createDataFrame([("a", Decimal("30.00")), ("b", Decimal("30.00")), ("c", Decimal("30.00")), ("d", Decimal("8.00")), ("e", Decimal("1.00"))], "k string, variance decimal(28,2)")
    listed = [("a", 1, "30.00"), ("a", 2, "10.00"), ("a", 3, "20.00"), ("b", 1, "10.00"), ("b", 2, "20.00"), ("b", 3, "20.00"), ("c", 1, "15.00"), ("d", 1, "4.00"), ("d", 2, "4.00")]
    table = spark.createDataFrame([(k, i, Decimal(a)) for k, i, a in listed], "k string, item int, amount decimal(28,2)")
    got = reconcile.match_listed(variances, table, ["k"])
    assert rows(got, "k", "n_listed") == [("a", 1), ("b", 2), ("c", 0), ("d", 2), ("e", 0)]


@pytest.mark.parametrize("days", [1, 30, 5000])
def test_carried_prices_equal_the_range_join(spark, rows, days):
    from datetime import timedelta

    # Half of all lines sell one product; some have no product, no day, or a product without price.
    first = D(2020, 1, 1)
    facts = [(i, "hot" if i % 2 else f"P{i % 7}", first + timedelta(i * 37 % 900)) for i in range(400)]
    facts += [(900, None, first), (901, "hot", None), (902, "none", first)]
    starts = [(p, i * 10 + n, first + timedelta(i * 131 - 200 + n), None) for n, p in enumerate(("hot", "P0", "P2", "P4")) for i in range(6)]
    starts += [("P6", 1, D(2020, 3, 1), D(2020, 4, 1)), ("P6", 2, D(2020, 6, 1), D(2020, 8, 1)), (None, 7, first, None), ("P0", 8, None, None)]
    fact_df = spark.createDataFrame(facts, "id int, product string, day date").repartition(5)
    dim = spark.createDataFrame(starts, "product string, price int, since date, until date")
    got = scd.carry_forward(fact_df, dim, on="product", date_col="day", start="since", end="until", days=days)

    def price(product, day):
        own = [r for r in starts if r[0] == product and None not in (r[0], r[2], day) and r[2] <= day]
        last = max(own, key=lambda r: r[2], default=None)
        return last[1] if last and (last[3] is None or day <= last[3]) else None

    assert rows(got, "id", "price") == sorted(((i, price(p, d)) for i, p, d in facts), key=str)
    assert got.columns == ["id", "product", "day", "price", "since", "until"]
    assert scd.carry_forward(fact_df.limit(0), dim, on="product", date_col="day", start="since").count() == 0
    assert rows(scd.carry_forward(fact_df, dim.limit(0), on="product", date_col="day", start="since"), "price") == [(None,)] * len(facts)
