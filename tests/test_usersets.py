"""Bitmap sets against Python sets, and flow tables kept up to date month by month."""

import os
import random

from flowloom.operators import aggregates as ag
from flowloom.operators import ledger as lg
from flowloom.operators import usersets as us
from flowloom.plans import jobs
from flowloom.sources import sinks as sn
from pyspark.sql import functions as F


def test_numbers_are_dense_and_stay(spark):
    names = spark.createDataFrame([(f"u{i % 500}",) for i in range(2000)] + [(None,), ("",)], "name string")
    first = us.number_names(names, "name")
    known = {r.name: r.number for r in first.collect()}
    assert sorted(known.values()) == list(range(500))
    frozen = spark.createDataFrame(list(known.items()), us.DICTIONARY)
    more = us.number_names(names.unionByName(spark.createDataFrame([("x",), ("y",), ("u3",)], "name string")), "name", frozen)
    assert {r.name for r in more.collect()} == {"x", "y"} and sorted(r.number for r in more.collect()) == [500, 501]
    assert us.number_names(names.limit(0), "name").collect() == []


def test_sets_unite_and_count_like_python_sets(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaab"), rng.randint(0, 3), rng.choice([None, rng.randint(0, 300), 63, 64, 2**40]), 1) for _ in range(600)] + [("none", 0, None, 5)]
    users = spark.createDataFrame(rows, "k string, day int, number bigint, n int").withColumn("s", us.single(F.col("number")))
    daily = us.gather(users, ["k", "day"], "s", {"n": F.col("n")}, "users", "count")
    both = us.gather(daily, ["k"], "users", {"n": F.col("n")}, "users", "count")
    for frame, key in ((daily, lambda r: r[:2]), (both, lambda r: r[:1])):
        got = {key(tuple(r)): (r.n, r["count"], r.numbers) for r in frame.withColumn("numbers", us.numbers_of(F.col("users"))).collect()}
        want = {}
        for r in rows:
            total, seen = want.get(key(r), (0, set()))
            want[key(r)] = (total + r[3], seen | ({r[2]} - {None}))
        assert got == {k: (n, len(s), sorted(s)) for k, (n, s) in want.items()}


def test_names_come_back(spark):
    dictionary = spark.createDataFrame([("ann", 0), ("bob", 70), ("cid", 64)], us.DICTIONARY)
    rows = spark.createDataFrame([(1, "cid"), (1, "ann"), (1, "bob"), (2, None), (2, "unknown"), (1, "ann")], "k int, I_ID_U string")
    sets = us.gather(us.numbered(rows, "I_ID_U", dictionary).withColumn("s", us.single(F.col("_number"))), ["k"], "s", {"n": F.lit(1)}, "users")
    assert sorted(map(tuple, us.with_names(sets, "users", dictionary, "names").collect())) == [(1, 4, "ann,bob,cid"), (2, 2, "")]


def daily_rows(spark, ctx, month, users, number=1):
    """One device flow a day and user, one server flow, and no sockets, in a month."""
    base = {k: F.lit("x") for k in dict.fromkeys([*ag.DEVICE_DAY_KEYS, *ag.SERVER_DAY_KEYS])}
    base |= {"dt": F.lit(f"{month}-03").cast("date"), "month": F.lit(month), "con_status": F.lit("closed"), "dest_port": F.lit(80)}
    rows = spark.createDataFrame([(u, number) for u in users], "I_ID_U string, n int").select("I_ID_U", *[c.alias(k) for k, c in base.items()], F.col("n").alias("con_number"),
        F.lit(10).cast("bigint").alias("con_traffic_in"), F.lit(1).cast("bigint").alias("con_traffic_out"), F.lit(1).alias("con_duration"))
    sn.write_partitioned(ag.device_day_sets(rows, jobs.number_users(spark, ctx, rows)), ctx.path("agg/device"), ["month"])
    sn.write_partitioned(ag.agg_server_day(rows), ctx.path("agg/server"), ["month"])
    sn.write_partitioned(ag.agg_server_day(rows).withColumn("dest_ip", F.lit("y")), ctx.path("agg/serversockets"), ["month"])


def recorded(spark, ctx, month, filedt):
    row = ("connection", lg.AGGREGATE, "device", "x", f"{month}-03", filedt)
    entries = spark.createDataFrame([row], "filetype string, stage string, collecttype string, engine string, dt string, filedt string")
    sn.append_ledger(entries.withColumn("dt", F.col("dt").cast("date")), ctx.path("meta"))


def files_of(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder.removeprefix("file://")) for f in names if f.startswith("part-")}


def test_untouched_months_are_not_read(spark):
    ctx = jobs.scratch(spark, "months")
    for month, users in (("2016-04", "ab"), ("2016-05", "bc")):
        daily_rows(spark, ctx, month, users)
        recorded(spark, ctx, month, "20160601")
    assert jobs.build_flow_tables(spark, ctx) == ["2016-04", "2016-05"]
    assert jobs.build_flow_tables(spark, ctx) == []
    tables = ("agg/flow_detail_day", "agg/flow_parts", "agg/flow_month")
    before = {t: files_of(ctx.path(t)) for t in tables}
    daily_rows(spark, ctx, "2016-05", "bcd", 2)
    recorded(spark, ctx, "2016-05", "20160501")  # an earlier file replaced the day
    for path in files_of(f"{ctx.path('agg/device')}/month=2016-04"):
        with open(path, "r+b") as file:  # whoever reads rows of the other month fails
            file.seek(4)
            file.write(bytes(200))
    assert jobs.build_flow_tables(spark, ctx) == ["2016-05"]
    for t in tables:
        old = {f: m for f, m in before[t].items() if "2016-04" in f}
        assert old and {f: m for f, m in files_of(ctx.path(t)).items() if "2016-04" in f} == old
    device = F.col("collecttype") == "nxdevice"
    months = spark.read.parquet(ctx.path("agg/flow_month")).filter(device).select(F.col("month").cast("string"), "distinct_client_user", "con_number").collect()
    assert sorted(map(tuple, months)) == [("2016-04", 2, 2), ("2016-05", 3, 6)]
    total = spark.read.parquet(ctx.path("agg/flow")).filter(device).select("distinct_client_user", "con_number").collect()
    assert list(map(tuple, total)) == [(4, 8)]
