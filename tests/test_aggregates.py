import pytest
from flowloom.operators import aggregates as ag
from flowloom.operators import usage as us
from pyspark.sql import functions as F


def test_key_counts():
    assert len(ag.SERVER_DAY_KEYS) == len(ag.DEVICE_DAY_KEYS) == 38
    assert [len(ag.cube_keys(*k)) for k in (("device", "detail"), ("device", "nodetail"), ("server", "detail"), ("server", "nodetail"))] == [33, 29, 34, 28]


def test_member_lists(spark, rows):
    df = spark.createDataFrame([("k", "b,a", 1), ("k", "", 2), ("k", None, 4), ("k", "a", 8), ("k", "c,c", 16), ("m", None, 32)], "k string, u string, n int")
    found = ag.with_members(df, ["k"], "u", {"n": F.col("n")}, "users", "count")
    assert rows(found) == [("k", 31, "a,b,c", 3), ("m", 32, "", 0)]


def test_member_lists_can_be_aggregated_again(spark, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"),
                                  (F.col("id") % 5).alias("part"), F.concat(F.lit("u"), (F.col("id") % 40).cast("string")).alias("u"), F.col("id").alias("n"))
    once = ag.with_members(df, ["k"], "u", {"n": F.col("n")}, "u", "c", is_list=False)
    parts = ag.with_members(df, ["k", "part"], "u", {"n": F.col("n")}, "u")
    assert rows(ag.with_members(parts, ["k"], "u", {"n": F.col("n")}, "u", "c")) == rows(once)


def test_small_cube_from_detail(spark, rows):
    keys = ag.cube_keys("device", "detail")
    base = spark.range(200).select(
        *[(F.col("id") % (2 if i % 5 else 3)).cast("string").alias(k) for i, k in enumerate(keys)], F.col("id").alias("con_number"),
        F.col("id").alias("con_traffic_in"), F.lit(1).cast("bigint").alias("con_traffic_out"), F.concat(F.lit("u"), (F.col("id") % 9).cast("string")).alias("I_ID_U"))
    direct = ag.cube(base, "device", "nodetail")
    assert rows(ag.cube_without_detail(ag.cube(base, "device", "detail"), "device")) == rows(direct)


def test_socket_numbers_stay_unknown(spark, rows):
    base = {k: "x" for k in ag.SERVER_DAY_KEYS}
    row = {**base, "collecttype": "linux", "con_number": 1, "con_traffic_in": None, "con_traffic_out": None, "con_duration": None}
    schema = ", ".join(f"{k} string" for k in [*base, "collecttype"]) + ", con_number int, con_traffic_in bigint, con_traffic_out bigint, con_duration int"
    found = ag.agg_socket_day(spark.createDataFrame([row, row, {**row, "collecttype": "device"}], schema))
    assert rows(found.select("con_number", "con_traffic_in", "con_duration")) == [(2, None, None)]


def test_unknown_duration_option(spark, rows):
    base = {k: "x" for k in ag.SERVER_DAY_KEYS}
    data = spark.createDataFrame([{**base, "con_number": 1, "con_traffic_in": 1, "con_traffic_out": 1, "con_duration": d} for d in (-1, 5)])
    assert rows(ag.agg_server_day(data).select("con_duration")) == [(2.0,)]
    assert rows(ag.agg_server_day(data, ignore_unknown_duration=True).select("con_duration")) == [(5.0,)]


def test_date_ranges_without_days(spark):
    days = spark.createDataFrame([], "dt date, engine_count bigint")
    assert ag.date_ranges(days, "2015-11-02").filter("date_range = 'Full' and firstDate is null").count() == 1


DISK = "date bigint, server string, name string, value double, `table` string"


@pytest.mark.parametrize("used,percent,avail,expected", [
    (0.0, 50.0, 100.0, (100.0, 0.5, 100.0, 200.0)),
    (30.0, 0.0, 70.0, (30.0, 0.3, 70.0, 70.0)),
    (30.0, None, 70.0, (30.0, 0.3, 70.0, None)),
    (30.0, 100.0, 0.0, (30.0, 1.0, 0.0, None)),
])
def test_disk_derivation(spark, rows, used, percent, avail, expected):
    data = [(0, "S", n, v, "iostat:mount=/d") for n, v in (("used_mb", used), ("used_percent", percent), ("avail_mb", avail)) if v is not None]
    found = us.derive_disk(us.pivot_metrics(spark.createDataFrame(data, DISK), "iostat"))
    assert rows(found.select("used_mb", "used_percent", "avail_mb", "total_mb")) == [expected]


def test_grains_equal_separate_aggregates(spark, rows):
    df = spark.range(2000).select((F.col("id") % 3).cast("string").alias("server"), F.lit("ip").alias("server_ip"),
                                  F.expr("timestamp_ntz'2016-01-01 00:00:00' + make_interval(0, 0, 0, id % 45)").alias("date"),
                                  (F.col("id") * 7 % 101).cast("double").alias("cpu_percent"), F.lit("f").alias("aip_server_function"),
                                  F.lit("a").alias("aip_app_name"), F.lit("s").alias("aip_app_sector"))
    df = df.withColumns({"dt": F.col("date").cast("date"), "month": F.date_format("date", "yyyy-MM")})
    profile = us.profile_cpu(df)
    for grain, keys in (("day", ["dt", "month"]), ("month", ["month"]), ("all", [])):
        own = df.groupBy("server", *keys).agg(F.count_distinct("date").alias("n"), F.percentile_approx("cpu_percent", 0.5).alias("q"))
        got = profile.filter(F.col("grain") == grain).select("server", *keys, "count_date", "q50_cpu_percent")
        assert rows(got) == rows(own)
