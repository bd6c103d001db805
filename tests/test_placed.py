"""Wide rows that are shuffled once, however often they are summed up."""

import os

from pyspark.sql import functions as F

from flowloom.operators import aggregates as ag
from flowloom.operators import usersets as us
from flowloom.operators.joining import PLACE, partition_places, placed
from flowloom.plans.derived import DERIVED, SPARK_FORM, Inputs
from flowloom.sources import sinks as sn

MEASURES = ["con_number", "con_traffic_in", "con_traffic_out", "con_duration"]


def resolved_rows(spark):
    """Flows of few keys, some of them null, with repeated and missing users."""
    rows = spark.range(240).withColumns({c: F.lit("x") for c in dict.fromkeys([*ag.DEVICE_DAY_KEYS, *ag.SERVER_DAY_KEYS])})
    few = {"url": F.when(F.col("id") % 3 == 0, F.lit("NA")).when(F.col("id") % 3 == 1, F.lit("u")), "dest_port": (F.col("id") % 2).cast("int"),
           "dt": F.date_add(F.lit("2016-05-01").cast("date"), (F.col("id") % 4).cast("int")), "con_status": F.lit("closed"),
           "source_app_exec": F.when(F.col("id") % 5 > 0, F.lit("e")), "dest_ip": F.when(F.col("id") % 7 > 0, F.lit("10.0.0.1")),
           "I_ID_U": F.when(F.col("id") % 11 > 0, F.concat(F.lit("U"), F.col("id") % 13)), "month": F.lit("2016-05")}
    return rows.withColumns(few).withColumns({c: F.col("id") % (5 + i) for i, c in enumerate(MEASURES)})


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_daily_devices_and_what_is_made_of_them_take_one_shuffle(spark, rows):
    flows = resolved_rows(spark)
    daily = ag.agg_device_day(flows)
    assert shuffles(daily) == 1 and daily.columns == [*ag.DEVICE_DAY_KEYS, *MEASURES, "I_ID_U", "distinct_I_ID_U"]
    seen = flows.groupBy(*ag.DEVICE_DAY_KEYS).agg(F.sum("con_number"), F.sum("con_traffic_in"), F.sum("con_traffic_out"), F.avg("con_duration"),
                                                  F.array_join(F.array_sort(F.collect_set("I_ID_U")), ","), F.size(F.collect_set("I_ID_U")))
    assert rows(daily) == rows(seen)
    for level, resolution in (("detail", "IDM"), ("nodetail", "Device")):
        together = ag.published_keys(flows, ag.cube_keys("device", level, resolution))
        once = ag.cube(ag.published_input(ag.agg_device_day(flows, together=together)), "device", level, resolution)
        assert shuffles(once) == 1 and rows(once) == rows(ag.cube(ag.published_input(daily), "device", level, resolution))


def test_flow_rows_of_placed_days_are_not_shuffled_again(spark, rows):
    flows = resolved_rows(spark)
    server, sockets = placed(flows, ag.SERVER_PLACE), placed(flows.withColumn("collecttype", F.lit("linux")), ag.SERVER_PLACE)
    once = ag.flow_detail(ag.agg_device_day(flows, together=ag.DEVICE_PLACE), ag.agg_server_day(server), ag.agg_socket_day(sockets))
    plain = ag.flow_detail(ag.agg_device_day(flows), ag.agg_server_day(server.drop(PLACE)), ag.agg_socket_day(sockets.drop(PLACE)))
    assert shuffles(once) == 3 and rows(once) == rows(plain)


def test_sets_take_one_shuffle_and_partitions_few_files(spark, rows, tmp_path):
    flows = resolved_rows(spark)
    dictionary = us.number_names(flows, "I_ID_U")
    together = partition_places(["month", "dt"], ag.DEVICE_DAY_KEYS)
    stored = ag.device_day_sets(flows, dictionary, together=together)
    assert shuffles(stored) - shuffles(us.numbered(flows, "I_ID_U", dictionary)) == 1
    path = str(tmp_path / "daily")
    sn.write_units(stored, path, ["dt", "engine"], ["month", "dt"])
    files = [sum(f.startswith("part-") for f in names) for _, _, names in os.walk(path)]
    assert max(files) <= 4 and sum(n > 0 for n in files) == 4
    back = spark.read.parquet(path)
    assert PLACE not in back.columns
    named = us.with_names(back.withColumn("month", F.col("month").cast("string")), "users", dictionary, "I_ID_U")
    want = ag.agg_device_day(flows)
    assert rows(named.select(*want.columns)) == rows(want)
    before = rows(back)
    sn.write_units(stored, path, ["dt", "engine"], ["month", "dt"])  # the same units again
    assert rows(spark.read.parquet(path).select(back.columns)) == before


def test_parts_hold_only_what_counts(spark, rows):
    columns = ", ".join(f"{c} string" for c in ag.FLOW_KEYS)
    flows = spark.createDataFrame([(*["k"] * 8, ip, program, 1, 2, None if ip else [(0, 3)]) for ip in ("a", "b", None) for program in ("p", None)],
                                  f"{columns}, remote_ip string, remote_app_exec string, con_traffic bigint, con_number bigint, client_users {us.SET}")
    parts = ag.flow_parts(flows, [])
    assert sorted((r.kind, r.value or "") for r in parts.collect()) == [(0, ""), (0, "a"), (0, "b"), (1, "p"), (2, "")]
    assert rows(ag.count_parts(parts, by_month=False)) == [(*["k"] * 8, 2, 1, 6, 12, 2)]


def test_flows_join_customers_to_orders_and_have_the_same_rows(spark, tmp_path):
    none, twice = None, 2  # keys may be missing or come twice
    tables = {
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "a", 2, 1.0, "BUILDING"), (none, "b", 3, 1.0, "X"), (4, "c", none, 1.0, none)] * twice),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 1, 1.0), (2, "t", 2, 1.0)]),
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(1, "p q", "B", "T", 1, 1.0), (1, "r", none, "T", 2, 1.0)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", [(k, c, s, 1.0, none, "1") for k, c, s in ((1, 1, "P"), (2, 4, "O"), (3, none, "F"), (none, 1, "O"), (1, 4, none))]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     [(o, p, s, 1, 2.0, 10.5, 0.1, 0.0, "R", "O", none) for o in (1, 2, 3, 5, none) for p in (1, 2, none) for s in (1, 2, none)])}
    for name, (schema, values) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Inputs(spark, str(tmp_path))
    assert "JOIN customer ON o_custkey" in SPARK_FORM["d_flows"]
    plain = t.sql(DERIVED["d_flows"])
    assert t.d_flows.columns == plain.columns and t.d_flows.exceptAll(plain).isEmpty() and plain.exceptAll(t.d_flows).isEmpty() and plain.count() == 24
