"""Streams without growing state, filter lists of any size, unique lookups."""

import os
import random
import re

import pytest
from flowloom.operators import filters as fl
from flowloom.operators import lookups as lk
from flowloom.session import work_path
from flowloom.sources import logs
from flowloom.streaming import ingest as st
from pyspark.sql import functions as F


def files_of(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder.removeprefix("file://")) for f in names if f.startswith("part-")}


def test_open_days_are_merged_and_leave_the_state(spark):
    source, target, checkpoint = (work_path(spark, x) for x in ("days", "totals", "checkpoint"))
    schema, state = "ts timestamp, k string, v bigint", []

    def arrive(rows):
        spark.createDataFrame(rows, "ts string, k string, v bigint").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        totals = st.daily_totals(spark.readStream.schema(schema).parquet(source), "ts", ["k"], {"total": F.col("v")}, delay="1 day")
        query = st.open_days_to_table(totals, target, ["k"], checkpoint)
        query.awaitTermination()
        state.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        return sorted((str(r.dt), r.k, r.n, r.total) for r in spark.read.schema("dt date, k string, n bigint, total bigint").parquet(target).collect())

    assert arrive([("2016-05-01 10:00:00", "a", 1), ("2016-05-01 11:00:00", "b", 2)]) == [("2016-05-01", "a", 1, 1), ("2016-05-01", "b", 1, 2)]
    assert arrive([("2016-05-01 12:00:00", "a", 4)]) == [("2016-05-01", "a", 2, 5), ("2016-05-01", "b", 1, 2)]
    for day in range(2, 12):
        before = files_of(target)
        got = arrive([(f"2016-05-{day:02} 10:00:00", "a", day)])
        assert len(got) == day + 1 and {f: t for f, t in files_of(target).items() if f in before} == before
    assert got[:2] == [("2016-05-01", "a", 2, 5), ("2016-05-01", "b", 1, 2)] and max(state) <= 5


def test_redelivery_is_found_without_state(spark):
    source, target, checkpoint = (work_path(spark, x) for x in ("again", "first", "checkpoint"))
    schema = "u string, dt date, n int"

    def arrive(rows):
        spark.createDataFrame(rows, "u string, dt string, n int").withColumn("dt", F.col("dt").cast("date")).write.mode("append").parquet(source)
        query = st.first_arrivals(spark.readStream.schema(schema).parquet(source), target, ["u", "dt"], "dt", checkpoint)
        query.awaitTermination()
        assert not any(p["stateOperators"] for p in query.recentProgress)
        return sorted((r.u or "", str(r.dt), r.n) for r in spark.read.schema(schema).parquet(target).collect())

    first = arrive([("a", "2016-05-01", 7), ("a", "2016-05-01", 3), ("b", "2016-05-01", 1), (None, "2016-05-02", 1)])
    assert first == [("", "2016-05-02", 1), ("a", "2016-05-01", 3), ("b", "2016-05-01", 1)]
    assert arrive([("c", "2019-01-01", 1)]) == sorted([*first, ("c", "2019-01-01", 1)])
    again = arrive([("a", "2016-05-01", 0), (None, "2016-05-02", 0), ("a", "2016-05-02", 5)])  # years later
    assert again == sorted([*first, ("c", "2019-01-01", 1), ("a", "2016-05-02", 5)])


def test_lists_of_any_size(spark, join_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("ab.c") for _ in range(rng.randint(1, 6)))
    values = [word() for _ in range(200)] + [None, ""]
    patterns = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 4))) for _ in range(25)]
    patterns = [rng.choice(["", "", "^"]) + p + rng.choice(["", "", "$"]) for p in patterns] + ["a\\.b", "^c+$", "b|^$", None, ""]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, i int")
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    hit = [i for i, v in enumerate(values) if v is not None and any(re.search(p, v) for p in patterns if p)]
    assert sorted(r.i for r in fl.filter_by_list(rows, "v", table).collect()) == hit and 20 < len(hit) < 190
    assert sorted(r.i for r in fl.filter_by_list(rows, "v", table, "exclude").collect()) == sorted(set(range(len(values))) - set(hit))
    assert fl.filter_by_list(rows, "v", table.limit(0)).count() == 0
    many = spark.range(2000).select(F.concat(F.lit("(x"), "id", F.lit(")")).alias("pattern"))
    with pytest.raises(ValueError):
        fl.filter_by_list(rows, "v", many)


def test_repeated_lookup_rows_do_not_repeat_flows(spark):
    flows = spark.createDataFrame([("u1", 1), ("u2", 2), (None, 3)], "I_ID_U string, n int")
    people = spark.createDataFrame([("u1", "A", "S1", "T"), ("u1", "B", "S2", "T"), ("u1", None, None, None), (None, "C", "S3", "T")], "I_ID string, Sector string, SiteCode string, TerangaCode string")
    assert sorted(((r.I_ID_U, r.n, r.source_sector) for r in lk.resolve_users(flows, people).collect()), key=repr) == [("u1", 1, "B"), ("u2", 2, None), (None, 3, None)]


def test_listener_lines_by_their_parts(spark):
    head = "03-JAN-2016 10:11:12 * (CONNECT_DATA="
    client, tail = "(CID=(PROGRAM=C:\\Program Files (x86)\\p.exe)(HOST=PC1)(USER=Ann))", " * establish * INST * 0"
    address = " * (ADDRESS=(PROTOCOL=tcp)(HOST=10.0.0.5)(PORT=1521))"
    good = {
        head + "(SID=)" + client + ")" + address + tail: ("", "10.0.0.5", "1521", "inst"),
        head + "(SID=A)" + client + "(sid=b))" + address.replace("1521", "") + tail: ("a", "10.0.0.5", "", "inst"),
        head + client + "(sid=B))" + address.replace("1521", "") + tail: ("b", "inst", "unknown", "unknown"),
        head + "(SID=A)" + client + "(SERVICE_NAME=B))" + tail: ("b", "inst", "unknown", "unknown"),
        head + "(SID=A)" + client + "(SERVICE_NAME=))" + tail: ("a", "inst", "unknown", "unknown"),
    }
    bad = [head + "(sid=A)" + client + ")" + address + tail, head + "(SID=A)(CID=(HOST=PC1)(PROGRAM=p)(USER=u)))" + tail, head + "(SID=A)" + client + ")" + address + " * establish * INST",
           "10:11:12 * (CONNECT_DATA=(SID=A)" + client + ")" + tail, head + client + "(sid=))" + address + tail]
    lines = spark.createDataFrame([(x,) for x in [*good, *bad]], "value string")
    got = sorted((r.host_sid, r.source_host_ip, r.host_port, r.host_instance) for r in logs.parse_listener(lines).collect())
    assert got == sorted(good.values())
    assert all(r.source_program == "c:\\program files (x86" for r in logs.parse_listener(lines).collect())
    assert sorted(r.value for r in logs.quarantine(lines).collect()) == sorted(bad)


def test_values_are_cut_only_where_a_pattern_may_begin(spark, monkeypatch):
    import re

    values = [f"job-{i}-{i % 7}-F" for i in range(60)] + ["", None, "j", "-", "q-1", "äö-12-x"]
    patterns = ["^job-1", "-12-", "-F$", "^j$", "q", "-3-3-F$", "ö-", "^-$", "", None]
    rows, listed = spark.createDataFrame(list(enumerate(values)), "id int, v string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    wanted = {i for i, v in enumerate(values) if v is not None and any(p and re.search(p, v) for p in patterns)}
    for most in (fl.MOST_HEADS, 1):  # the second is fewer than the patterns have
        monkeypatch.setattr(fl, "MOST_HEADS", most)
        assert {r.id for r in fl.filter_by_list(rows, "v", listed).collect()} == wanted
        assert {r.id for r in fl.filter_by_list(rows, "v", listed, "exclude").collect()} == set(range(len(values))) - wanted
    monkeypatch.undo()
    plain = spark.createDataFrame([("job-1", True, False), ("-12-", False, False), ("-7-F", False, True)], "_body string, _first boolean, _last boolean")
    pieces = fl._pieces(spark.createDataFrame([("job-12-7-F",), ("",)], "_value string"), plain)
    # before: 13 pieces, all of 4 and 5 characters
    assert sorted(r._body for r in pieces.collect()) == ["-12-", "-7-F", "job-", "job-1"]
