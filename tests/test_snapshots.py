"""A new snapshot or delivery touches the files of its own day and server alone, and jobs read only the pending days."""

import os

from pyspark.sql import functions as F

from flowloom.operators import ledger as lg
from flowloom.plans import jobs
from flowloom.session import work_path
from flowloom.sources import deliveries as dl

LSOF = "server_ip string, dt string, command string, pid string, user string, node string, name string, status string"


def files_of(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


ROW = ("cmd", "7", "u", "TCP", "10.1.1.1:80->10.2.2.2:90", "(ESTABLISHED)")


def snapshot(spark, *units):
    return {"lsof": spark.createDataFrame([(s, t, *ROW) for s, t in units], LSOF)}


def test_a_snapshot_writes_only_its_own_files(spark):
    ctx = jobs.scratch(spark, "snapshots")
    jobs.encode_sockets(spark, ctx, snapshot(spark, *[(s, f"2016-05-0{d}T00:05") for s in ("10.1.1.1", "10.1.1.2") for d in (1, 2)]))
    folder = ctx.path("lsof").removeprefix("file://")
    before = files_of(folder)
    jobs.encode_sockets(spark, ctx, snapshot(spark, ("10.1.1.1", "2016-05-02T00:10"), ("10.1.1.1", "2016-05-02T00:05")))
    after = files_of(folder)
    assert all(after.get(f) == t for f, t in before.items())
    new = set(after) - set(before)
    assert len(new) == 1 and "day=2016-05-02" in next(iter(new))
    stored = spark.read.parquet(ctx.path("lsof"))
    assert stored.count() == 5
    jobs.encode_sockets(spark, ctx, snapshot(spark, ("10.1.1.1", "2016-05-02T00:10")))
    assert files_of(folder) == after
    units = spark.createDataFrame([("10.1.1.1", "2016-05-01T00:05")], "server_ip string, dt string")
    plan = lg.in_snapshot_days(stored, units)
    text = next(x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    assert "2016-05-01" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert plan.count() == 2 and lg.in_snapshot_days(stored, units.limit(0)).count() == 0


def test_a_killed_write_loses_and_adds_nothing(spark):
    """Files of a run that died before its ledger entry are not seen; the next run stores the snapshot again."""
    ctx = jobs.scratch(spark, "killed")
    jobs.encode_sockets(spark, ctx, snapshot(spark, ("10.1.1.1", "2016-05-02T00:05")))
    late = spark.read.parquet(ctx.path("lsof")).drop(dl.DELIVERY).withColumn("dt", F.lit("2016-05-02T00:10"))
    dl.deliver(late, ctx.path("lsof"), jobs.SNAPSHOT_PARTITIONS, dl.new_delivery())
    units = spark.createDataFrame([("10.1.1.1", f"2016-05-02T00:{m}") for m in ("05", "10")], "server_ip string, dt string")
    assert [r.dt for r in jobs._snapshots(spark, ctx, "lsof", units).collect()] == ["2016-05-02T00:05"]
    jobs.encode_sockets(spark, ctx, snapshot(spark, ("10.1.1.1", "2016-05-02T00:10")))
    assert sorted(r.dt for r in jobs._snapshots(spark, ctx, "lsof", units).collect()) == ["2016-05-02T00:05", "2016-05-02T00:10"]
    assert spark.read.parquet(ctx.path("lsof")).count() == 3


def test_closed_days_become_one_delivery(spark):
    ctx = jobs.scratch(spark, "compact")
    times = [f"2016-05-0{d}T00:{m:02}" for d in (1, 2) for m in (5, 10, 15)]
    for t in times:
        jobs.encode_sockets(spark, ctx, snapshot(spark, ("10.1.1.1", t), ("10.1.1.2", t)))
    units = spark.createDataFrame([(s, t) for s in ("10.1.1.1", "10.1.1.2") for t in times], "server_ip string, dt string")
    want = sorted(map(tuple, units.collect()))
    read = lambda: sorted((r.server_ip, r.dt) for r in jobs._snapshots(spark, ctx, "lsof", units).collect())
    per_day = lambda: [len(os.listdir(f"{ctx.path('lsof').removeprefix('file://')}/month=2016-05/day=2016-05-0{d}")) for d in (1, 2)]
    stage = {"stage": lg.ENCODE_SOCKETS, "filetype": "lsof"}
    how = (ctx.path("lsof"), ctx.path("meta_sockets"), jobs.SNAPSHOT)
    assert read() == want and per_day() == [3, 3]
    name = dl.compact(spark, *how, jobs.SNAPSHOT_PARTITIONS, "day", ["2016-05-01"], stage)
    assert name and read() == want and per_day() == [4, 3]
    assert dl.compact(spark, *how, jobs.SNAPSHOT_PARTITIONS, "day", ["2016-05-01"], stage) is None
    assert dl.clear(spark, *how, "day", ["2016-05-01"], stage) == 3
    assert read() == want and per_day() == [1, 3]
    jobs.encode_sockets(spark, ctx, snapshot(spark, ("10.1.1.1", times[0])))  # still known
    assert per_day() == [1, 3]


USAGE = "date bigint, server string, name string, value double, `table` string"


def test_the_last_delivery_of_a_sample_counts(spark):
    ctx = jobs.scratch(spark, "usage")
    day = 86_400_000
    first = [(0, "s", "cpu_percent", 10.0, "sysstat"), (day, "s", "cpu_percent", 20.0, "sysstat"), (0, None, "cpu_percent", 5.0, "sysstat"), (0, "s", "used_mb", 1.0, "iostat:mount=/d")]
    jobs.encode_usage(spark, ctx, spark.createDataFrame(first, USAGE))
    folder = ctx.path("sysstat").removeprefix("file://")
    before = files_of(folder)
    jobs.encode_usage(spark, ctx, spark.createDataFrame([(day, "s", "cpu_percent", 30.0, "sysstat"), (day, "t", "cpu_percent", 40.0, "sysstat")], USAGE))
    assert all(files_of(folder).get(f) == t for f, t in before.items())
    got = jobs.usage_samples(spark, ctx, "sysstat").select("server", F.col("date").cast("string"), "cpu_percent").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("s", "1970-01-01 00:00:00", 10.0), (None, "1970-01-01 00:00:00", 5.0), ("s", "1970-01-02 00:00:00", 30.0), ("t", "1970-01-02 00:00:00", 40.0)], key=repr)


def test_a_log_without_connections_is_taken(spark, tmp_path):
    good = tmp_path / "listener_HostA_1.log"
    good.write_text("04-MAY-2016 10:00:00 * (CONNECT_DATA=(SID=Db)(CID=(PROGRAM=P.exe)(HOST=PC)(USER=U))) * (ADDRESS=(PROTOCOL=tcp)(HOST=10.1.1.1)(PORT=5)) * establish * Inst * 0\n"
                    "05-MAY-2016 10:00:00 * (CONNECT_DATA=(CID=)) * establish broken\n")
    (tmp_path / "listener_HostB_1.log").write_text("nothing here\n")
    ctx = jobs.scratch(spark, "logs", folders={"listener": work_path(spark, "listener")})
    for _ in range(2):
        jobs.ingest_listener(spark, ctx, [str(good), str(tmp_path / "listener_HostB_1.log")], "2016-05-06")
    rows = spark.read.parquet(ctx.path("listener")).collect()
    assert [(r.host_name, r.host_sid, r.host_port, r.file_first_date, r.file_last_date) for r in rows] == [("hosta", "db", "5", "04-MAY-2016", "05-MAY-2016")]
    assert rows[0].source_filedate is not None and set(rows[0].asDict()) == set(jobs.LISTENER_COLUMNS)
    assert spark.read.parquet(ctx.path("listener_trash")).select("source_filename").collect() == [("listener_HostA_1.log",)]
    report = spark.read.parquet(ctx.path("listener_report")).select(F.col("date_min").cast("string"), "host_instance").collect()
    assert len(report) == 1 and report[0][1] == "inst"
