from datetime import date

from flowloom.operators import ledger as lg
from flowloom.plans import jobs
from flowloom.sources import readers as rd
from flowloom.sources import sinks as sn
from flowloom.session import work_path
from pyspark.sql import functions as F

ROW = "collecttype string, engine string, dt date, filedt string, n int"
D1, D2 = date(2016, 5, 1), date(2016, 5, 2)


def ledger(spark, entries):
    return spark.createDataFrame(entries, lg.LEDGER_SCHEMA)


def test_earliest_file_wins(spark, rows, join_path):
    known = ledger(spark, [("connection", lg.ENCODE, "device", "e1", D1, "f2"), ("connection", lg.ENCODE, "device", "e1", D1, "f3"),
                           ("execution", lg.ENCODE, "device", "e1", D2, "f0")])
    data = spark.createDataFrame([("device", "e1", D1, "f1", 1), ("device", "e1", D1, "f2", 2), ("device", "e1", D1, "f4", 3),
                                  ("device", "e1", D2, "f9", 4), ("server", "e1", D1, "f9", 5)], ROW)
    assert rows(lg.new_rows(data, known, "connection").select("n")) == [(1,), (4,), (5,)]


def test_pending_needs_webrequests(spark, rows, join_path):
    entries = [("connection", lg.ENCODE, "device", e, D1, "f1") for e in ("e1", "e2", "e3")]
    entries += [("webrequest", lg.ENCODE, "device", "e1", D1, "f1"), ("webrequest", lg.ENCODE, "device", "e3", D1, "f1"),
                ("connection", lg.RESOLVE, "device", "e3", D1, "f1")]
    assert rows(lg.pending_connections(ledger(spark, entries)).select("engine")) == [("e1",)]
    assert rows(lg.pending_aggregates(ledger(spark, entries)).select("engine")) == [("e3",)]


def test_complete_days_on_the_boundary(spark, rows, join_path):
    def unit(engine, hours):
        return [("device", engine, D1, "f", h) for h in hours]

    data = spark.createDataFrame(unit("late", [4, 23]) + unit("edge", [3, 23]) + unit("short", [0, 22]), ROW)
    assert rows(lg.complete_rows(data, F.col("n")).select("engine").distinct()) == [("edge",)]


def test_socket_deltas(spark, rows):
    known = spark.createDataFrame([("lsof", lg.ENCODE_SOCKETS, "s1", "t1"), ("ps", lg.ENCODE_SOCKETS, "s1", "t2")], lg.SOCKET_SCHEMA)
    data = spark.createDataFrame([("s1", "t1"), ("s1", "t2"), ("s2", "t1")], "server_ip string, dt string")
    assert rows(lg.new_snapshots(data, known, "lsof")) == [("s1", "t2"), ("s2", "t1")]


def test_units_are_written_once(spark, rows):
    path = work_path(spark, "units")
    first = spark.createDataFrame([("device", "e1", D1, "f1", 1), ("device", "e2", D1, "f1", 2), ("device", "e1", D2, "f1", 3)], ROW)
    again = spark.createDataFrame([("device", "e2", D1, "f1", 2), ("device", "e3", D1, "f1", 4)], ROW)
    for part in (first, again, again, first):
        sn.write_units(part, path, ["engine", "dt", "filedt"], ["dt"])
    assert [r[0] for r in rows(spark.read.parquet(path).select("n"))] == [1, 2, 3, 4]


def test_ledger_append_is_repeatable(spark, rows):
    path = work_path(spark, "meta")
    entries = ledger(spark, [("connection", lg.ENCODE, "device", "e1", D1, "f1")] * 2)
    for _ in range(3):
        sn.append_ledger(entries, path)
    assert rd.read_or_empty(spark, path, lg.LEDGER_SCHEMA).count() == 1


def test_encode_job_holds_back_incomplete_days(spark, rows):
    from flowloom.operators.projections import CONNECTION

    def raw(engine, hour, filedt):
        row = {c: "1" for c in CONNECTION}
        row.update(engine=engine, filedt=filedt, NX_con_end_time=f"2016-05-01T{hour:02d}:00:00", NX_con_duration="NA", NX_con_destination_ip="10.0.0.1")
        return row

    ctx = jobs.scratch(spark, "job", server_engines=("srv",))
    day = spark.createDataFrame([raw("e1", 2, "f2"), raw("e1", 23, "f2"), raw("srv", 9, "f2")])
    jobs.encode(spark, ctx, {"connection": day})
    jobs.encode(spark, ctx, {"connection": day})
    assert spark.read.parquet(ctx.path("connection")).count() == 2
    # A later delivery is ignored, an earlier one is taken as well.
    later = spark.createDataFrame([raw("e1", 1, "f3"), raw("e1", 23, "f3")])
    earlier = spark.createDataFrame([raw("e1", 1, "f1"), raw("e1", 23, "f1"), raw("srv", 0, "f1"), raw("srv", 23, "f1")])
    jobs.encode(spark, ctx, {"connection": later})
    jobs.encode(spark, ctx, {"connection": earlier})
    stored = spark.read.parquet(ctx.path("connection"))
    assert rows(stored.groupBy("collecttype", "filedt").count()) == [("device", "f1", 2), ("device", "f2", 2), ("server", "f1", 2)]
    assert rows(stored.select("con_duration").distinct()) == [(-1,)]


def test_backfill_windows_do_not_overlap():
    assert list(jobs.backfill_windows("2016-01-01", "2016-01-11", 4)) == [
        ("2016-01-01", "2016-01-04"), ("2016-01-05", "2016-01-08"), ("2016-01-09", "2016-01-10")]
