"""Till files, masters, finance totals and the lake."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators import dedup
from lakemart.sources import lake, masters, pos

A_HEADER = "bill_no,line_no,product_code,qty,unit_price,line_type,ts"
B_HEADER = "bill_no;line_no;item_code;quantity;rate;type;txn_time"
C_HEADER = "ts,bill_no,line_no,line_type,product_code,unit_price,qty"

A_LINES = [
    "S03/20250314/00001,1,P555001,2,20.50,SALE,2025-03-14T11:25:40",
    "S03/20250314/00001,2,DISC,1,-1.25,DISCOUNT,2025-03-14T11:25:40",
    "S03/20250314/00001,3,TAX,1,3.40,TAX,2025-03-14T11:25:40",
    "S03/20250314/00001,4,TENDER,1,43.15,TENDER,2025-03-14T11:25:40",
    "S03/20250314/00002,1,P555001,1,20.50,SALE,2025-03-15T00:10:00",
]


@pytest.fixture
def till(tmp_path):
    folder = tmp_path / "sales"
    folder.mkdir()

    def put(name, lines, encoding="utf-8"):
        (folder / name).write_text("\n".join(lines) + "\n", encoding=encoding)

    put("SALES_S03_20250314.csv", [A_HEADER, *A_LINES])
    put("SALES_S03_20250314__R1.csv", [A_HEADER, *A_LINES])
    put("SALES_S03_20250314__R2.csv", [A_HEADER, *A_LINES[4:]])
    put("SALES_S07_20250611.csv", [
        B_HEADER, "S07/20250611/00001;1;P555002;2;7.75;SALE;11-06-2025 09:15:30",
        "S07/20250611/00001;2;P555002;-2;7.75;VOID;11-06-2025 09:15:30",
        "S07/20250611/00002;1;P555002;-1;7.75;RETURN;11-06-2025 10:00:00",
    ])
    put("SALES_S11_20250902.csv", [C_HEADER, "1756814400,S11/20250902/00001,1,SALE,P555003,12.60,4"], "utf-8-sig")
    put("notes.csv", ["not,a,till,file", "1,2,3,4"])
    return folder


def test_three_dialects_become_one_table(spark, rows, till):
    lines = pos.read_lines(spark, str(till))
    got = rows(lines.where("store_id <> 'S03'"), "store_id", "bill_no", "line_no", "product_code", "qty", "line_type", "ts")
    assert got == [
        ("S07", "S07/20250611/00001", 1, "P555002", 2, "SALE", dt.datetime(2025, 6, 11, 9, 15, 30)),
        ("S07", "S07/20250611/00001", 2, "P555002", -2, "VOID", dt.datetime(2025, 6, 11, 9, 15, 30)),
        ("S07", "S07/20250611/00002", 1, "P555002", -1, "RETURN", dt.datetime(2025, 6, 11, 10, 0)),
        ("S11", "S11/20250902/00001", 1, "P555003", 4, "SALE", dt.datetime(2025, 9, 2, 17, 30)),
    ]


def test_business_date_is_the_files(spark, rows, till):
    late = pos.read_lines(spark, str(till)).where(F.to_date("ts") != F.col("business_date"))
    assert {tuple(r) for r in late.select("bill_no", "business_date").collect()} == {
        ("S03/20250314/00002", dt.date(2025, 3, 14))
    }


def test_unplaced_files_are_listed(spark, rows, till):
    assert rows(pos.unplaced_files(spark, str(till))) == [("notes.csv",)]


def test_resends_count_once_and_partial_ones_lose_nothing(spark, rows, till):
    lines = pos.read_lines(spark, str(till))
    kept = dedup.keep_first(lines, pos.LINE_KEYS, pos.LINE_ORDER)
    assert lines.where("store_id = 'S03'").count() == 11
    assert kept.where("store_id = 'S03'").count() == 5
    assert {r.resend_no for r in kept.collect()} == {0}
    assert rows(dedup.dedup_counts(lines, pos.LINE_KEYS)) == [(15, 9, 6)]


def test_parquet_days_are_read_with_csv_days(spark, rows, till):
    spark.createDataFrame(
        [("S07/20240501/00001", 1, "P1", 3, 10.5, "SALE", "01-05-2024 10:00:00")],
        "bill_no string, line_no int, item_code string, quantity int, rate double, type string, txn_time string",
    ).coalesce(1).write.parquet(str(till / "tmp"))
    part = next((till / "tmp").glob("*.parquet"))
    (till / "SALES_S07_20240501.parquet").write_bytes(part.read_bytes())
    got = pos.read_lines(spark, str(till)).where("store_id = 'S07'")
    assert rows(got, "bill_no", "qty", F.col("unit_price").cast("double"), "business_date") == [
        ("S07/20240501/00001", 3, 10.5, dt.date(2024, 5, 1))
    ]


def test_unreadable_timestamp_is_null(spark):
    df = spark.createDataFrame([("2024-13-01T00:00:00",), ("x",), ("31-12-2024 23:59:59",)], "ts string")
    got = [r[0] for r in df.select(pos.local_timestamp(F.col("ts"))).collect()]
    assert got == [None, None, dt.datetime(2024, 12, 31, 23, 59, 59)]


def test_short_file_names(spark, rows, tmp_path):
    folder = tmp_path / "short"
    folder.mkdir()
    header = "bill_number,store_code,product_code,quantity,unit_price,line_type,timestamp,sale_date"
    line = "B1,S01,P001,2,28.00,SALE,2024-10-15 10:00:00,2024-10-15"
    (folder / "S01_20241015.csv").write_text(f"{header}\n{line}\n")
    (folder / "S01_20241015_resend.csv").write_text(f"{header}\n{line}\n{line.replace('P001', 'P002')}\n")
    lines = pos.read_short_lines(spark, str(folder))
    kept = dedup.keep_first(lines, pos.SHORT_KEYS, pos.SHORT_ORDER)
    assert rows(kept, "product_code", "resend_no") == [("P001", 0), ("P002", 1)]
    names = spark.createDataFrame([("S01_20241015_resend.csv",), ("S02_20240101.parquet",)], "n string")
    contract = pos.short_file_contract(F.col("n"))
    assert rows(names, *[c.alias(n) for n, c in contract.items()]) == [
        ("S01", dt.date(2024, 10, 15), 1), ("S02", dt.date(2024, 1, 1), 0)
    ]


@pytest.mark.parametrize("preamble", ["", '"""\nfinance_monthly.csv - signed-off totals\nUsed for reconciliation.\n"""\n'])
def test_finance_with_and_without_preamble(spark, rows, tmp_path, preamble):
    path = tmp_path / "finance.csv"
    path.write_text(preamble + "month,revenue_inr\n2024-01,1000200.30\n2024-02,1000400.60\n")
    got = rows(pos.read_finance(spark, str(path)), "month", F.col("finance_revenue").cast("string"))
    assert got == [("2024-01", "1000200.30"), ("2024-02", "1000400.60")]


def test_finance_with_sign_off(spark, rows, tmp_path):
    path = tmp_path / "finance.csv"
    path.write_text("month,closed_on,revenue_inr,signed_off_by\n2024-01,2024-02-20,2000500.75,N. N. (Audit)\n")
    got = rows(pos.read_finance(spark, str(path)), "month", "closed_on", F.col("finance_revenue").cast("string"), "signed_off_by")
    assert got == [("2024-01", dt.date(2024, 2, 20), "2000500.75", "N. N. (Audit)")]


def test_landing_twice_changes_nothing_and_prunes(spark, rows, till, tmp_path):
    lines = dedup.keep_first(pos.read_lines(spark, str(till)), pos.LINE_KEYS, pos.LINE_ORDER)
    target = str(tmp_path / "lake")
    for _ in range(2):
        lake.land(lake.with_month_keys(lines), target)
    landed = spark.read.parquet(target)
    assert landed.count() == 9
    wanted = landed.where((F.col("year") == 2025) & (F.col("month") == 3) & (F.col("store") == "S03"))
    report = lake.pruning_report(landed, wanted).first()
    assert report.all_files > report.pruned_files == 1
    assert report.file_ratio == report.all_files
    assert "PartitionFilters: [isnotnull" in wanted._jdf.queryExecution().toString()


def test_landing_one_month_leaves_the_others(spark, till, tmp_path):
    lines = dedup.keep_first(pos.read_lines(spark, str(till)), pos.LINE_KEYS, pos.LINE_ORDER)
    target = str(tmp_path / "lake")
    lake.land(lake.with_month_keys(lines), target)
    lake.land(lake.with_month_keys(lines.where("store_id = 'S11'")), target)
    assert spark.read.parquet(target).count() == 9


def test_days_landed_one_after_the_other(spark, rows, till, tmp_path):
    lines = lake.with_month_keys(pos.read_lines(spark, str(till)))
    target = str(tmp_path / "lake")
    days = sorted(r[0] for r in lines.select("business_date").distinct().collect())
    for day in [*days, days[0]]:
        lake.land_days(lines.where(F.col("business_date") == day), target)
    want = dedup.keep_first(lines, pos.LINE_KEYS, pos.LINE_ORDER)
    columns = ("bill_no", "line_no", "business_date", "store_id")
    assert rows(spark.read.parquet(target), *columns) == rows(want, *columns)


def test_stores_beyond_the_list_are_read(spark, rows, tmp_path):
    folder = tmp_path / "more"
    folder.mkdir()
    header = "bill_no,line_no,product_code,qty,unit_price,line_type,ts"
    for store, bill in (("S01", "B1"), ("S13", "B2"), ("X9", "B3")):
        (folder / f"SALES_{store}_20240101.csv").write_text(f"{header}\n{bill},1,P1,2,10.00,SALE,2024-01-01 10:00:00\n")
    (folder / "SALES_S06_20240101.csv").write_text("bill_no;line_no;item_code;quantity;rate;type;txn_time\nB4;1;P1;2;10.00;SALE;01-01-2024 10:00:00\n")
    assert rows(pos.read_lines(spark, str(folder)), "bill_no", "store_id") == [("B1", "S01"), ("B2", "S13"), ("B3", "X9"), ("B4", "S06")]


def test_another_column_order_is_refused(spark, tmp_path):
    folder = tmp_path / "swapped"
    folder.mkdir()
    (folder / "SALES_S01_20240101.csv").write_text("line_no,bill_no,product_code,qty,unit_price,line_type,ts\n1,B1,P1,2,10.00,SALE,2024-01-01 10:00:00\n")
    with pytest.raises(Exception, match="(?i)header"):
        pos.read_lines(spark, str(folder)).collect()


def test_quoted_sign_off(spark, rows, tmp_path):
    path = tmp_path / "finance.csv"
    path.write_text('month,closed_on,revenue,signed_off_by\n2024-01,2024-02-20,100.50,"Doe, Jo"\n')
    assert rows(pos.read_finance(spark, str(path)), "signed_off_by") == [("Doe, Jo",)]


def test_notice_conversion_skips_known_parts(spark, rows, tmp_path):
    source = tmp_path / "notices"
    source.mkdir()
    target = str(tmp_path / "parquet")
    (source / "p1.csv").write_text('notice_id,portal_id,body\nN1,P001,"two\nlines, ""quoted"""\n')
    lake.convert_notices(spark, str(source), target)
    (source / "p2.csv").write_text("notice_id,portal_id,body\nN2,P001,one\n")
    for _ in range(2):
        lake.convert_notices(spark, str(source), target)
    done = spark.read.parquet(target)
    assert rows(done, "notice_id", "body", "part") == [("N1", 'two\nlines, "quoted"', "p1"), ("N2", "one", "p2")]
    assert rows(lake.scan_counts(done, "portal_id")) == [(2, 1)]


def test_object_inventory(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.bin").write_bytes(b"123")
    assert tuple(lake.object_inventory(spark, str(tmp_path)).first()) == (2, 8)


def test_catalog_counts(spark, rows):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert ("three_rows", 3) in rows(lake.catalog_counts(spark))
    spark.catalog.dropTempView("three_rows")


def test_masters_from_files_and_sql_across_sources(spark, rows, tmp_path):
    (tmp_path / "product_categories.csv").write_text(
        "category_id,category_name,department,gst_rate\nC06,Snacks,Food,0.120\nC13,Soap,Care,0.180\n"
    )
    categories = masters.read_master(spark, "product_categories", folder=str(tmp_path), columns=["category_id", "category_name"])
    masters.register({"cats": categories, "sold": spark.createDataFrame([("C06", 5)], "category_id string, qty int")})
    assert rows(spark.sql("SELECT category_name, qty FROM sold JOIN cats USING (category_id)")) == [("Snacks", 5)]


def test_band_layout_finds_a_bucket_in_one_file(spark, rows):
    bands = spark.range(4000).select(
        (F.col("id") % 4).cast("int").alias("band_id"), F.floor(F.col("id") / 8).alias("bucket_hash"), F.col("id").alias("doc_id")
    )
    report = {r.layout: r for r in lake.lookup_report(bands, {"band_id": 1, "bucket_hash": 100}).collect()}
    assert report["by bucket"].rows_found == report["unordered"].rows_found == 2
    assert report["by bucket"].files == 1
    assert rows(lake.lookup(bands, 1, 100, exclude=801), "doc_id") == [(805,)]
