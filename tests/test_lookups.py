import random

from flowloom.functions import ip_to_int
from flowloom.operators import lookups as lk
from pyspark.sql import functions as F


def address(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def brute(ranges, n):
    sites = sorted({site for site, lo, hi in ranges if lo < n < hi})
    return "_".join(sites) or "nf"


def mdm(spark, ranges):
    return spark.createDataFrame(ranges, "mdm_loc_code string, mdm_ip_start_int bigint, mdm_ip_end_int bigint")


def test_range_join_equals_brute_force(spark, join_path):
    rng, base = random.Random(4), 10 << 24
    ranges = [("A", base, base + 65535), ("B", base + 256, base + 511), ("C", base + 300, base + 301), ("D", base + 300, base + 300)]
    for i in range(60):
        lo = base + rng.randrange(3000)
        ranges.append((f"R{i % 9}", lo, lo + rng.choice([0, 1, 2, 15, 255, 700])))
    numbers = sorted({base + rng.randrange(4000) for _ in range(600)} | {n + d for _, lo, hi in ranges for n in (lo, hi) for d in (-1, 0, 1)})
    flows = spark.createDataFrame([(address(n), address(n + 1)) for n in numbers] + [(None, "bad")], "source_ip string, dest_ip string")
    found = lk.resolve_sites(flows, lk.site_segments(mdm(spark, ranges)), {"source_ip": "s", "dest_ip": "d"}).collect()
    assert len(found) == len(numbers) + 1
    expected = {address(n): brute(ranges, n) for m in numbers for n in (m, m + 1)}
    for row in found:
        assert row["s"] == expected.get(row["source_ip"], "nf") and row["d"] == expected.get(row["dest_ip"], "nf")


def test_exploded_table_equals_segments(spark, rows):
    ranges = [("A", 100, 900), ("B", 250, 260), ("A", 250, 258), ("C", 899, 901), ("D", 5, 6)]
    table = dict(rows(lk.explode_ranges(mdm(spark, ranges)).select("mdm_ip", "site")))
    assert table == {n: brute(ranges, n) for n in range(0, 1000) if brute(ranges, n) != "nf"}


def test_hot_address_keeps_every_row(spark, join_path):
    flows = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "10.0.0.5").otherwise(
        F.concat(F.lit("10.0.1."), (F.col("id") % 250).cast("string"))).alias("source_ip"))
    found = lk.resolve_sites(flows, lk.site_segments(mdm(spark, [("A", 10 << 24, (10 << 24) + 255)])), {"source_ip": "site"})
    assert dict(found.groupBy("site").count().collect()) == {"A": 6667, "nf": 13333}


def test_users_and_assets(spark, rows, join_path):
    flows = spark.createDataFrame([("u1", "10.0.0.1", "10.0.0.2", "nf", "S1"), ("u9", "10.0.0.9", "10.0.0.1", "nf", "nf")],
                                  "I_ID_U string, source_ip string, dest_ip string, source_site string, dest_site string")
    users = spark.createDataFrame([("u1", "Sec", "", "T")], "I_ID string, Sector string, SiteCode string, TerangaCode string")
    assert rows(lk.resolve_users(flows, users).select("I_ID_U", "source_sector", "source_I_ID_site")) == [("u1", "Sec", "nf"), ("u9", None, "nf")]
    asset = {c: "v" for c in lk.AIP_FLOW_COLUMNS}
    assets = spark.createDataFrame([{"aip_server_ip": "10.0.0.1", "aip_server_site": "AX", **asset}, {"aip_server_ip": "10.0.0.2", "aip_server_site": "", **asset}])
    found = lk.resolve_assets(flows, assets)
    assert rows(found.select("source_site", "dest_site", "source_aip_app_name")) == [("AX", "S1", "v"), ("nf", "AX", None)]
    plain = lk.resolve_assets(flows, assets, site_fallback=False)
    assert rows(plain.select("source_site", "dest_site")) == [("nf", "S1"), ("nf", "nf")]


def test_asset_star_without_instance_and_null_status(spark, rows):
    server = {c: "x" for c in lk.SERVER_COLUMNS if c not in ("aip_server_adminby", "aip_server_owner_org_id")}
    servers = spark.createDataFrame([
        {**server, "aip_server_hostname": "a", "aip_server_ip": "10.0.0.1", "aip_server_status": "Live", "filedate": "d"},
        {**server, "aip_server_hostname": "b", "aip_server_ip": "10.0.0.1", "aip_server_status": "Live", "filedate": "d"},
        {**server, "aip_server_hostname": "c", "aip_server_ip": "10.0.0.3", "aip_server_status": None, "filedate": "d"}],
        ", ".join(f"{c} string" for c in [*server, "filedate"]))
    instances = spark.createDataFrame([("App2", "1", "P", "b", "", "", "R"), ("App1", "2", "", "b", "", "", "R")],
                                      "aip_appinstance_name string, aip_appinstance_shared_unique_id string, aip_appinstance_type string, aip_appinstance_hostname string, aip_appinstance_ip string, aip_appinstance_sector string, aip_appinstance_state string")
    names = ["aip_app_name", "aip_app_shared_unique_id", "aip_app_type", "aip_app_validation", "aip_app_state", "aip_app_sensitive",
             "aip_app_criticality", "aip_app_sector", "aip_app_it_owner", "aip_app_is_owner"]
    applications = spark.createDataFrame([], ", ".join(f"{c} string" for c in names))
    grid = spark.createDataFrame([], "aip_appgf_shared_unique_id string, aip_appgf_grid_app_name string, aip_appgf_billing_code string")
    star = lk.asset_star(servers, instances, applications, grid)
    assert rows(lk.asset_rollup(star).select("aip_server_hostname", "aip_app_name", "aip_appinstance_type")) == [("a", "", ""), ("b", "App1||App2", "P")]
    assert rows(lk.assets_by_ip(star).select("aip_server_ip", "aip_server_hostname")) == [("10.0.0.1", "b")]
    plan = lk.assets_by_ip(star)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_ip_expression_is_native(spark):
    plan = spark.range(1).select(ip_to_int(F.lit("10.0.0.1")))._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan
