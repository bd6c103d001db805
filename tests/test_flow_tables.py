"""Flow tables by month and over all time: rows lie together by flow key from the daily tables on, and only texts that are read are shuffled."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flowloom.operators import aggregates as ag
from flowloom.operators import usersets as us
from flowloom.operators.joining import PLACE
from flowloom.plans import queries_aggregates as qa
from test_placed import resolved_rows


@pytest.fixture
def given(spark):
    """Flows of devices and servers with missing values, as a query reads them."""
    unknown = {c: F.when(F.col("id") % n > 0, F.col(c)) for c, n in (("con_traffic_in", 9), ("con_traffic_out", 10), ("source_ip", 4), ("source_aip_app_name", 6))}
    kind = F.when(F.col("id") % 3 == 1, F.lit("server")).otherwise(F.lit("device"))
    status = F.when(F.col("id") % 8 > 0, F.lit("closed")).otherwise(F.lit("rejected"))
    month = F.when(F.col("id") % 2 > 0, F.lit("2016-05")).otherwise(F.lit("2016-06"))
    rows = resolved_rows(spark).withColumns(unknown | {"collecttype": kind, "con_status": status, "month": month, "engine": F.concat(F.lit("e"), F.col("id") % 4)})
    return SimpleNamespace(d_resolved=rows, orders=spark.range(13).withColumnRenamed("id", "o_custkey"))


@pytest.mark.parametrize("by_month", [True, False])
def test_flow_tables_equal_those_of_whole_daily_tables(given, rows, by_month):
    detail = ag.flow_detail_sets(qa.device_day_sets(given), qa.server_day(given), qa.socket_day(given))
    plain = ag.count_parts(ag.flow_parts(detail, ["month"] if by_month else []), by_month)
    found = ag.flow_summary(qa.flow_rows(given, by_month), by_month)
    assert found.columns == plain.columns and rows(found) == rows(plain) and found.count() >= 10
    unplaced = ag.flow_rows(qa.device_day_sets(given), qa.server_day(given), qa.socket_day(given), by_month)
    assert rows(ag.flow_summary(unplaced, by_month)) == rows(plain)


def test_flow_rows_are_shuffled_once_by_their_key(given):
    kinds = qa.flow_rows(given, True)
    sent = [ag.flow_summary([k], True)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for k in kinds]
    assert sent == [1, 1, 2, 1, 2]  # devices; clients and servers, from flows and from sockets
    for k in kinds:
        assert PLACE in k.columns and not {"source_teranga", "url", "engine", "filedt", "dest_port"} & set(k.columns)


def test_daily_rows_stay_apart_though_their_texts_are_hashed(spark, given, rows):
    flows = given.d_resolved
    dictionary = us.number_names(flows, "I_ID_U")
    sums = ["con_number", "con_traffic_in", "con_traffic_out", "con_duration"]
    for shown, whole, short in ((ag.SERVER_READ, ag.agg_server_day(flows), ag.agg_server_day(flows, shown=ag.SERVER_READ)),
                                (ag.DEVICE_READ, ag.device_day_sets(flows, dictionary), ag.device_day_sets(flows, dictionary, shown=ag.DEVICE_READ))):
        assert rows(short.select(*shown, *sums)) == rows(whole.select(*shown, *sums)) and ag.REST in short.columns
    swapped = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("a", "a"), ("a", None)], "x string, y string")
    hashed, keys = ag.hashed_rest(swapped, ["x", "y"], [])
    assert hashed.groupBy(*keys).count().count() == 4
    assert ag.hashed_rest(swapped, ["x", "y"], None) == (swapped, ["x", "y"])


def test_flow_tables_take_one_shuffle_and_months_few_files(spark, tmp_path, monkeypatch, rows):
    from test_placed import resolved_rows, shuffles

    from flowloom.operators.joining import partition_places
    from flowloom.plans import jobs
    from flowloom.plans.context import JobContext
    from flowloom.sources import sinks as sn

    flows = resolved_rows(spark).withColumn("month", F.concat(F.lit("2016-0"), 1 + F.col("id") % 3))
    ctx = JobContext(root=str(tmp_path), partitions=("month",))
    dictionary = us.number_names(flows, "I_ID_U")
    device, server, sockets = ag.device_day_sets(flows, dictionary), ag.agg_server_day(flows), ag.agg_socket_day(flows.withColumn("collecttype", F.lit("linux")))
    for name, daily in (("device", device), ("server", server), ("serversockets", sockets)):
        sn.write_table(daily, ctx.path(f"agg/{name}"), ["month"])
    plans, table, part = {}, sn.write_table, sn.write_partitioned

    def seen(write):
        def write_and_count(df, path, *more, **named):
            plans.setdefault(path.rsplit("/", 1)[1], []).append((shuffles(df), named.get("together", False)))
            write(df, path, *more, **named)
        return write_and_count

    monkeypatch.setattr(sn, "write_table", seen(table))
    monkeypatch.setattr(sn, "write_partitioned", seen(part))
    jobs.build_flow_tables(spark, ctx)
    assert [plans[n][0][0] for n in ("flow_detail_day", "flow_parts", "flow_month", "flow")] == [3, 1, 1, 1]  # the last one took two
    for name in ("flow_detail_day", "flow_parts", "flow_month"):
        assert max(len(list(m.glob("*.parquet"))) for m in (tmp_path / "agg" / name).glob("month=*")) <= (3 * 4 if name == "flow_detail_day" else 4)
        assert ag.PLACE not in spark.read.parquet(ctx.path(f"agg/{name}")).columns
    whole = {n: rows(spark.read.parquet(ctx.path(f"agg/{n}"))) for n in ("flow_month", "flow")}
    detail = ag.flow_detail_sets(*[spark.read.parquet(ctx.path(f"agg/{n}")) for n in ("device", "server", "serversockets")])
    for name, by_month in (("flow_month", True), ("flow", False)):
        want = ag.count_parts(ag.flow_parts(detail, ["month"] if by_month else []), by_month)
        assert want.count() > 3 and whole[name] == rows(want.select(spark.read.parquet(ctx.path(f"agg/{name}")).columns))
    # with a ledger the months are replaced one by one, and nothing is shuffled for the files
    entries = spark.createDataFrame([("connection", "pipe4to5", "device", "e", "2016-01-05", "f"), ("connection", "pipe4to5", "device", "e", "2016-03-05", "f")],
                                    "filetype string, stage string, collecttype string, engine string, dt string, filedt string").withColumn("dt", F.col("dt").cast("date"))
    sn.append_ledger(entries, ctx.path("meta"))
    assert jobs.build_flow_tables(spark, ctx) == ["2016-01", "2016-03"]
    assert plans["flow_detail_day"][-1] == (3, True) and plans["flow_parts"][-1] == plans["flow_month"][-1] == (1, True)
    assert whole == {n: rows(spark.read.parquet(ctx.path(f"agg/{n}"))) for n in whole}
