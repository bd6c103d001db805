"""Jobs with nothing to do, and steps whose work has to stay near the size of their input."""

import re

from pyspark.sql import functions as F

from flowloom.operators import filters as fl
from flowloom.operators import ledger as lg
from flowloom.operators import lookups as lk
from flowloom.operators import usersets as us
from flowloom.plans import jobs
from flowloom.sources import sinks as sn


def test_resolve_with_nothing_pending_stores_an_empty_table(spark):
    ctx = jobs.scratch(spark, "nothing")
    day, unit = F.to_date(F.lit("2016-05-01")), "collecttype string, engine string, filedt string"
    keys = "I_ID_D string, source_app_name string, dest_ip string, dest_port int, month string"
    flows = spark.createDataFrame([("device", "e1", "1", "d", "a", "10.0.0.2", 80, "2016-05", "10.0.0.1", "u")], f"{unit}, {keys}, source_ip string, I_ID_U string").withColumn("dt", day)
    requests = spark.createDataFrame([("device", "e2", "9", "d", "a", "10.0.0.2", 80, "2016-05", "x")], f"{unit}, {keys}, url string").withColumn("dt", day)
    for name, rows in (("connection", flows), ("webrequest", requests)):
        sn.write_partitioned(rows, ctx.path(name), ["month"])
        sn.append_ledger(lg.ledger_entries(rows, name, lg.ENCODE), ctx.path("meta"))
    ranges = spark.createDataFrame([("S", 1, 9)], "mdm_loc_code string, mdm_ip_start_int bigint, mdm_ip_end_int bigint")
    people = spark.createDataFrame([("u", "A", "S1", "T")], "I_ID string, Sector string, SiteCode string, TerangaCode string")
    assets = spark.createDataFrame([("10.0.0.2", "S", *["x"] * len(lk.AIP_FLOW_COLUMNS))], ", ".join(f"{c} string" for c in ["aip_server_ip", "aip_server_site", *lk.AIP_FLOW_COLUMNS]))
    for _ in range(2):
        stored = jobs.resolve(spark, ctx, ranges, people, assets)
        assert stored.select("url", "dest_site", "dest_aip_app_name").count() == 0
    jobs.aggregate(spark, ctx)
    sn.append_ledger(lg.ledger_entries(flows, "webrequest", lg.ENCODE), ctx.path("meta"))
    assert [(r.engine, r.dest_site, r.url) for r in jobs.resolve(spark, ctx, ranges, people, assets).collect()] == [("e1", "S", None)]


def test_pieces_without_the_shape_of_a_pattern_are_not_shuffled(spark, join_path):
    rows = spark.range(300).select(F.concat(F.lit("job-"), F.col("id") + 1000, F.lit("-x")).alias("v"), "id")
    patterns = ["^job-10", "-x$", "b-12", "zz", "q-1299-", "1299-x$", "^ob"]
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    for kept in (patterns, patterns[2:]):
        listed = table.filter(F.col("pattern").isin(kept))
        wanted = {i for i in range(300) if any(re.search(p, f"job-{1000 + i}-x") for p in kept)}
        assert {r.id for r in fl.filter_by_list(rows, "v", listed).collect()} == wanted
    plain = spark.createDataFrame([("b-12", False, False), ("x", False, True), ("j", True, False)], "_body string, _first boolean, _last boolean")
    pieces = spark.createDataFrame([("v", "b-12", False, False), ("v", "b-x2", False, False), ("v", "a-12", False, False), ("v", "x", False, True), ("v", "x", True, False),
                                    ("v", "j", True, False), ("v", "j", False, True)], "_value string, _body string, _begins boolean, _ends boolean")
    kept = 7 if join_path == "shuffle" else 3  # no shape is broadcast there
    assert fl._with_shape_of(pieces, plain).count() == kept


def test_single_users_are_named_without_a_join_by_row(spark, join_path):
    numbers = {0: "a", 62: "b", 63: "c", 64: "d", 127: "e", 70000: "f"}
    dictionary = spark.createDataFrame([(n, i) for i, n in numbers.items()], us.DICTIONARY)
    sets = [[i] for i in numbers] + [[], [0, 63], [63, 127, 70000], [5]]
    rows = spark.createDataFrame([(k, i) for k, s in enumerate(sets) for i in (s or [None])], "k int, number bigint").withColumn("s", us.single(F.col("number")))
    daily = us.gather(rows, ["k"], "s", {"n": F.lit(1)}, "users").unionByName(
        spark.createDataFrame([(99, 1, None), (98, 1, [(7, 0)]), (97, 1, [(3, 0), (1, 1)])], f"k int, n bigint, users {us.SET}"))
    named = us.with_names(daily, "users", dictionary, "names")
    want = {k: ",".join(sorted(numbers[i] for i in s if i in numbers)) for k, s in enumerate(sets)} | {99: "", 98: "", 97: "d"}
    assert {r.k: r.names for r in named.collect()} == want and named.columns == ["k", "n", "names"]
    plan = us.with_names(daily.filter("k < 6"), "users", dictionary, "names")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and "_size" in plan
