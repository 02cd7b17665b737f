"""Lines held in state by day, from till files as they arrive."""

import datetime as dt
import random

from pyspark.sql import functions as F

from lakemart.operators.dedup import keep_first
from lakemart.sources import pos
from lakemart.streaming import keyed as K
from lakemart.streaming import lines as L

DIALECTS = (
    pos.Dialect("one", ("X01",), ",", ("bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "ts")),
    pos.Dialect("two", ("X02",), ";", ("bill_no", "line_no", "item_code", "quantity", "rate", "type", "txn_time")),
)


def write(folder, store, day, bills, resend=0):
    one = store == "X01"
    header = ",".join(DIALECTS[0].columns) if one else ";".join(DIALECTS[1].columns)
    stamp = f"{day:%Y-%m-%d} 10:00:00" if one else f"{day:%d-%m-%Y} 10:00:00"
    rows = [(f"{store}-{day:%m%d}-{b}", n, f"P{(b + n) % 7}", n + 1, "2.50", "SALE", stamp) for b in bills for n in range(1, 3)]
    name = f"SALES_{store}_{day:%Y%m%d}" + (f"__R{resend}" if resend else "") + ".csv"
    (folder / name).write_text("\n".join([header, *[("," if one else ";").join(map(str, r)) for r in rows]]) + "\n")


def lines_of(spark, folder, path, table, schema):
    return sorted(map(tuple, K.read(spark, path, table, schema).collect()), key=str)


def test_days_close_once_and_late_files_are_reported(spark, tmp_path):
    inbox, path = tmp_path / "inbox", str(tmp_path / "out")
    inbox.mkdir()
    days = [dt.date(2024, 3, d) for d in range(1, 11)]
    files = [(s, d, range(3), 0) for s in ("X01", "X02") for d in days[:6]] + [("X01", d, range(5), 1) for d in days[1:5:2]]
    random.Random(5).shuffle(files)

    def run():
        stream = pos.stream_lines(spark, str(inbox), DIALECTS)
        K.run(K.first_lines(stream, pos.LINE_KEYS, pos.LINE_ORDER, "business_date", 3, lanes=2), path, str(tmp_path / "progress"))
        return stream.schema

    for part in (files[:7], files[7:]):
        for file in part:
            write(inbox, *file[:3], file[3])
        schema = run()
    # The last six days are still within three days of each other in part: what is out is what has closed.
    out = K.read(spark, path, "lines", schema)
    assert out.agg({"business_date": "max"}).first()[0] <= days[5] - dt.timedelta(days=3)
    write(inbox, "X01", days[9], range(1))
    write(inbox, "X02", days[9] + dt.timedelta(days=30), range(1))
    run()
    late_before = K.read(spark, path, "late", schema).count()
    in_time = keep_first(pos.read_lines(spark, str(inbox), DIALECTS), pos.LINE_KEYS, pos.LINE_ORDER).where("business_date <= '2024-03-10'")
    late_keys = {(r.bill_no, r.line_no) for r in K.read(spark, path, "late", schema).collect()}
    got = {(r.bill_no, r.line_no): tuple(r) for r in K.read(spark, path, "lines", schema).collect()}
    want = {(r.bill_no, r.line_no): tuple(r) for r in in_time.select(*schema.names).collect()}
    assert set(got) | late_keys == set(want) and all(got[k] == want[k] for k in got if k not in late_keys)
    assert K.read(spark, path, "lines", schema).count() == len(got)

    write(inbox, "X02", days[2], range(9), resend=2)  # a file for a day long closed
    run()
    late = K.read(spark, path, "late", schema).collect()
    assert len(late) - late_before == 18 and {r.file_name for r in late} >= {"SALES_X02_20240303__R2.csv"}
    assert {(r.bill_no, r.line_no): tuple(r) for r in K.read(spark, path, "lines", schema).collect()} == got


def test_same_rows_as_a_batch_where_nothing_is_late(spark, tmp_path):
    inbox, path = tmp_path / "inbox", str(tmp_path / "out")
    inbox.mkdir()
    days = [dt.date(2024, 5, d) for d in range(1, 9)]
    files = [(s, d, range(4), r) for s in ("X01", "X02") for d in days for r in (0, 1)]
    random.Random(1).shuffle(files)
    for file in files:
        write(inbox, *file)
    write(inbox, "X01", dt.date(2024, 9, 1), range(1))
    stream = pos.stream_lines(spark, str(inbox), DIALECTS)
    K.run(K.first_lines(stream, pos.LINE_KEYS, pos.LINE_ORDER, "business_date", 30), path, str(tmp_path / "progress"))
    want = keep_first(pos.read_lines(spark, str(inbox), DIALECTS), pos.LINE_KEYS, pos.LINE_ORDER).where("business_date < '2024-09-01'")
    assert lines_of(spark, inbox, path, "lines", stream.schema) == sorted(map(tuple, want.select(*stream.schema.names).collect()), key=str)
    assert K.read(spark, path, "late", stream.schema).count() == 0


def test_open_days_wait_on_disk_and_each_keeps_its_own_lines(spark, rows, tmp_path):
    """Many days in one task, lines that come in several forms, null keys; then a line of a closed day sent three times."""
    inbox, path, progress = (str(tmp_path / n) for n in ("inbox", "out", "progress"))
    start = dt.date(2020, 1, 1)
    sent = spark.range(9000).select(
        F.when(F.col("id") % 500 != 0, F.col("id") % 3000).alias("bill"), F.lit("a").alias("line"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"),
        F.expr("timestamp_seconds(id)").alias("at"), F.date_add(F.lit(start), (F.col("id") % 500).cast("int")).alias("day"),
    )
    sent.coalesce(1).write.parquet(f"{inbox}/first")
    schema = spark.read.parquet(f"{inbox}/first").schema

    def run():
        stream = L.file_stream(spark, inbox, schema)
        K.run(K.first_lines(stream.unionByName(L.file_stream(spark, inbox, schema)), ["bill", "line"], ["v", "at"], "day", 30, lanes=1), path, progress)

    run()
    state = {p.suffix for p in (tmp_path / "progress" / "state").rglob("*") if p.is_file()}
    assert ".sst" in state and ".delta" not in state  # not in the executors' heaps
    assert not [k for k in K.SETTINGS if spark.conf.get(k, None) is not None]
    spark.createDataFrame([(1, "z", 0, dt.datetime(2023, 1, 1), dt.date(2023, 1, 1))], schema).write.parquet(f"{inbox}/second")
    run()
    assert rows(K.read(spark, path, "lines", schema)) == rows(keep_first(sent, ["bill", "line"], ["v", "at"]))
    assert rows(K.read(spark, path, "late", schema)) == []
    late = (7, "y", None, None, start)
    spark.createDataFrame([late, late, late], schema).coalesce(1).write.parquet(f"{inbox}/third")
    run()
    assert rows(K.read(spark, path, "late", schema)) == [late] * 6  # each comes by two streams
