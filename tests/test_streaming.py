"""Incremental runs against their batch results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators import cards
from lakemart.streaming import lines as L
from lakemart.streaming import notices as Z

EVENTS = "bill int, line int, v int, at timestamp, part int"


def send(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_state_keeps_the_first_of_a_key_across_runs(spark, rows, tmp_path):
    inbox, table, progress = (str(tmp_path / n) for n in ("inbox", "table", "progress"))
    day = dt.datetime(2024, 1, 1)

    def run():
        stream = L.file_stream(spark, inbox, EVENTS)
        L.run_to_table(L.dedup_within(stream, ["bill", "line"], "at", "3 days"), table, progress)

    send(spark, inbox, [(1, 1, 5, day, 0), (1, 1, 5, day, 0), (1, 2, 6, day, 0)])
    run()
    send(spark, inbox, [(1, 1, 5, day, 0), (2, 1, 7, day + dt.timedelta(days=1), 0)])
    run()
    assert rows(spark.read.parquet(table), "bill", "line") == [(1, 1), (1, 2), (2, 1)]


def test_merged_lines_survive_late_resends_and_replays(spark, rows, tmp_path):
    inbox, table, progress = (str(tmp_path / n) for n in ("inbox", "table", "progress"))
    day = dt.datetime(2024, 1, 1)

    def run(checkpoint):
        stream = L.file_stream(spark, inbox, EVENTS)
        L.land_lines(stream, table, checkpoint, keys=["bill", "line"], order=["v"], partition="part")

    send(spark, inbox, [(1, 1, 5, day, 0), (2, 1, 9, day, 1)])
    run(progress)
    send(spark, inbox, [(1, 1, 5, day, 0), (1, 2, 8, day, 0)])
    run(progress)
    want = [(1, 1, 5, 0), (1, 2, 8, 0), (2, 1, 9, 1)]
    assert rows(spark.read.parquet(table), "bill", "line", "v", "part") == want
    run(progress + "-again")  # everything once more
    assert rows(spark.read.parquet(table), "bill", "line", "v", "part") == want


@pytest.mark.parametrize("cap", [50, 1])
def test_notice_deltas(spark, tmp_path, monkeypatch, cap):
    from lakemart.operators import lsh

    monkeypatch.setattr(Z.delta_pairs, "__defaults__", (cap,))
    inbox, progress = str(tmp_path / "inbox"), str(tmp_path / "progress")
    schema = "doc_id bigint, text string"
    store = Z.NoticeStore(spark, str(tmp_path / "store"))
    body = " ".join(f"word{i}" for i in range(80))
    nights = [
        [(4, body), (5, body + " x"), (9, "something else entirely here")],
        [(6, body), (7, body + " y"), (4, body), (1, "a notice of its own kind")],
        [(8, "Something ELSE, entirely here!"), (2, body + " x y")],
    ]
    for night in nights:
        spark.createDataFrame(night, schema).coalesce(1).write.mode("append").parquet(inbox)
        Z.run(L.file_stream(spark, inbox, schema), store, progress, 80, lambda n: f"2024-01-{n + 1:02d} 00:00:00")
    assert Z.last_batch(store) == 2
    state = store.card_state(2)
    got = {r.notice_id: r.card_id for r in state.mapping.collect()}
    assert got == {**dict.fromkeys((2, 4, 5, 6, 7), "CARD-4"), 9: "CARD-9", 8: "CARD-9", 1: "CARD-1"}
    again = spark.createDataFrame(nights[2], schema)
    Z.process_batch(store, again, 2, 80, "2024-01-03 00:00:00")  # a replayed batch
    assert {r.notice_id: r.card_id for r in store.card_state(2).mapping.collect()} == got
    assert isinstance(state, cards.CardState) and lsh.BUCKET_CAP == 50


@pytest.mark.parametrize("files", [1, 5])
def test_stream_queries_lose_nothing(spark, rows, tmp_path, monkeypatch, files):
    """Tables as one file and as part files in random order of time, one file a batch."""
    from lakemart.plans import stream_queries as Q
    from oracle_check import compare, connect

    for name in ("events", "lineitem"):
        source = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        target = tmp_path / f"{name}.parquet"
        parts = source.orderBy(F.rand(3)).repartition(files)
        parts.write.parquet(str(target if files > 1 else tmp_path / name))
        if files == 1:
            next((tmp_path / name).glob("*.parquet")).rename(target)
    monkeypatch.setattr(Q._resent, "__defaults__", (1,))
    con = connect("/root/testdata/sf0.001")
    for name in ("stream_dedup", "stream_revenue_by_month"):
        verdict, *_ = compare(spark, con, str(tmp_path), name, Q.QUERIES[name], Q.ORACLES[name])
        assert verdict == "ok", (name, verdict)
