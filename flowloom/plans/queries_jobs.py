"""Registered queries that run whole jobs in a new work folder and return what they stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import aggregates as ag
from flowloom.operators import ledger as lg
from flowloom.operators import matrix as mx
from flowloom.operators import projections as pj
from flowloom.operators.aggregates import cube_keys
from flowloom.operators.joining import partition_places, semi_join, union_by_name
from flowloom.plans import jobs
from flowloom.plans import queries_aggregates as qa
from flowloom.plans.queries_io import KEY, dictionary
from flowloom.plans.queries_tables import (
    ADDRESS_SITES, DIRECTED_SQL, IP_NUMBER, PENDING_SQL, ROLLUP_SHOWN, ROLLUP_SQL, SERVER_ENGINES, URLS_SQL,
)
from flowloom.plans.registry import query
from flowloom.session import cut_lineage, work_path
from flowloom.sources import sinks as sn

OPTIONS = {"server_engines": tuple(SERVER_ENGINES), "partitions": ("month",)}
UNIT = "collecttype, engine, dt, filedt"
NO_EXTRACT = ("c_mktsegment", "c_nationkey", "s_nationkey", "l_suppkey", "l_orderkey", "o_custkey", "o_orderpriority")  # columns of the flows that no extract has


def _units_of(spark, ctx, filetype: str):
    stored = spark.read.parquet(ctx.path(filetype)).groupBy(*lg.UNIT, "filedt").agg(F.count("*").alias("n"))
    recorded = jobs.event_ledger(spark, ctx).filter(F.col("filetype") == filetype)
    times = recorded.groupBy(*lg.UNIT, "filedt").agg(F.count("*").alias("recorded"))
    return stored.join(times, [*lg.UNIT, "filedt"], "full").withColumn("filetype", F.lit(filetype))


@query("job_encode", f"""
WITH hours AS (SELECT {UNIT}, CAST(substr(con_end, 12, 2) AS INTEGER) AS h FROM d_flows),
whole AS (SELECT {UNIT}, count(*) AS n FROM hours GROUP BY ALL HAVING min(h) <= 3 AND max(h) >= 23)
SELECT 'connection' AS filetype, *, CAST(1 AS BIGINT) AS recorded FROM whole UNION ALL SELECT 'execution', *, 1 FROM whole
UNION ALL SELECT 'webrequest', {UNIT}, count(*), 1 FROM d_webrequest GROUP BY ALL""")
def _(t):
    ctx = jobs.scratch(t.spark, "encode", **OPTIONS)
    t.flows_by_month(without=NO_EXTRACT)
    inputs = {"connection": t.d_raw_connection, "webrequest": t.d_raw_webrequest, "execution": t.d_raw_execution.drop("l_returnflag")}
    jobs.encode(t.spark, ctx, inputs)
    jobs.encode(t.spark, ctx, {"connection": t.d_raw_connection})  # the same delivery again changes nothing
    return union_by_name([_units_of(t.spark, ctx, kind) for kind in inputs])


def _encoded(t, ctx):
    """Encoded tables and the ledger of everything that has been encoded and partly resolved."""
    t.flows_by_month(without=NO_EXTRACT)
    together = sn.lie_together(t.d_flows, ["month"])
    executions = pj.project_execution(t.d_raw_execution, SERVER_ENGINES)
    for name, rows in (("connection", t.d_connection), ("webrequest", t.d_webrequest), ("execution", executions)):
        sn.write_partitioned(rows, ctx.path(name), ["month"], together)
    sn.append_ledger(t.stored("d_ledger").filter(F.col("stage") != lg.AGGREGATE), ctx.path("meta"))


NEXT_UNITS = f"""SELECT * FROM ({PENDING_SQL.format('pipe2to3', 'connection', 'pipe3to4')}) x WHERE (engine, min_filedt) IN
  (SELECT (engine, min_filedt) FROM (SELECT engine, min(filedt) AS min_filedt FROM d_ledger
   WHERE stage = 'pipe2to3' AND filetype = 'webrequest' GROUP BY collecttype, engine, dt) y)"""


def _or_nf(value: str) -> str:
    return f"CASE WHEN coalesce({value}, '') = '' THEN 'nf' ELSE {value} END"


def _site_sql(site: str, asset: str) -> str:
    return f"CASE WHEN {site} IS NULL THEN {_or_nf(asset)} ELSE {site} END"


RESOLVED_SHOWN = ["I_ID_U", "engine", "dt", "filedt", "con_end", "dest_ip", "dest_port", "source_site", "dest_site", "source_sector",
                  "source_I_ID_site", "source_teranga", "dest_aip_server_hostname", "dest_aip_app_name", "source_aip_app_name", "url"]


@query("job_resolve", f"""
WITH {ADDRESS_SITES},
u AS ({NEXT_UNITS}), w AS ({URLS_SQL}),
c AS (SELECT c.* FROM d_connection c JOIN u ON c.collecttype = u.collecttype AND c.engine = u.engine AND c.dt = u.dt AND c.filedt = u.min_filedt)
SELECT c.I_ID_U, c.engine, c.dt, c.filedt, c.con_end, c.dest_ip, c.dest_port, {_site_sql('a.site', 's.aip_server_site')} AS source_site,
  {_site_sql('b.site', 'd.aip_server_site')} AS dest_site, i.Sector AS source_sector, {_or_nf('i.SiteCode')} AS source_I_ID_site,
  i.TerangaCode AS source_teranga, d.aip_server_hostname AS dest_aip_server_hostname, d.aip_app_name AS dest_aip_app_name,
  s.aip_app_name AS source_aip_app_name, w.url
FROM c LEFT JOIN address_site a ON c.source_ip = a.ip LEFT JOIN address_site b ON c.dest_ip = b.ip LEFT JOIN d_users i ON c.I_ID_U = i.I_ID
LEFT JOIN d_aip d ON c.dest_ip = d.aip_server_ip LEFT JOIN d_aip s ON c.source_ip = s.aip_server_ip
LEFT JOIN w ON c.collecttype = w.collecttype AND c.dt = w.dt AND c.engine = w.engine AND c.filedt = w.filedt AND c.I_ID_D = w.I_ID_D
  AND c.source_app_name = w.source_app_name AND c.dest_ip = w.dest_ip AND c.dest_port = w.dest_port""")
def _(t):
    ctx = jobs.scratch(t.spark, "resolve", **OPTIONS)
    _encoded(t, ctx)
    for _ in range(2):  # the second run finds nothing left
        resolved = jobs.resolve(t.spark, ctx, t.d_mdm, t.d_users, t.d_aip)
    return resolved.select(*RESOLVED_SHOWN)


@query("job_resolve_execution", f"""
WITH {ADDRESS_SITES}, u AS ({PENDING_SQL.format('pipe2to3', 'execution', 'pipe3to4_Exec')})
SELECT f.I_ID_U, f.engine, f.dt, f.filedt, f.con_end AS "end", {_site_sql('a.site', 's.aip_server_site')} AS source_site,
  i.Sector AS source_sector, s.aip_app_name AS source_aip_app_name
FROM d_flows f JOIN u ON f.collecttype = u.collecttype AND f.engine = u.engine AND f.dt = u.dt AND f.filedt = u.min_filedt
LEFT JOIN address_site a ON f.source_ip = a.ip LEFT JOIN d_users i ON f.I_ID_U = i.I_ID LEFT JOIN d_aip s ON f.source_ip = s.aip_server_ip""")
def _(t):
    ctx = jobs.scratch(t.spark, "resolve", **OPTIONS)
    _encoded(t, ctx)
    return jobs.resolve_executions(t.spark, ctx, t.d_mdm, t.d_users, t.d_aip).select(
        "I_ID_U", "engine", "dt", "filedt", "end", "source_site", "source_sector", "source_aip_app_name")


AGGREGATE_UNITS = PENDING_SQL.format("pipe3to4", "connection", "pipe4to5")
DAY_SHOWN = ["source_site", "source_app_exec", "dest_ip", "dest_port", "con_protocol", "con_status", "dt", "engine", "filedt", "con_number", "con_duration"]


def _day_sql(day_sql: str, kind: str, users: str) -> str:
    return f"""SELECT '{kind}' AS collecttype, {', '.join(DAY_SHOWN)}, {users} AS I_ID_U FROM ({day_sql}) d
WHERE (engine, dt, filedt) IN (SELECT (engine, dt, min_filedt) FROM ({AGGREGATE_UNITS}) u)"""


@query("job_aggregate", _day_sql(qa.DEVICE_DAY_SQL, "device", "I_ID_U") + "\nUNION ALL\n" + _day_sql(qa.SERVER_DAY_SQL, "server", "NULL"))
def _(t):
    spark, ctx = t.spark, jobs.scratch(t.spark, "aggregate", **OPTIONS)
    t.flows_by_month(written=False)
    sn.write_partitioned(t.d_resolved, ctx.path("resolved"), ["month"], together=True)
    sn.append_ledger(t.stored("d_ledger"), ctx.path("meta"))
    for first, last in (("1990-01-01", "1998-01-15"), ("1998-01-10", "2010-01-01")):  # windows may overlap
        jobs.aggregate(spark, ctx, first, last)
    device = jobs.daily_devices(spark, ctx).select(*DAY_SHOWN, "I_ID_U", F.lit("device").alias("collecttype"))
    server = spark.read.parquet(ctx.path("agg/server")).select(*DAY_SHOWN, F.lit(None).cast("string").alias("I_ID_U"), F.lit("server").alias("collecttype"))
    return device.unionByName(server)


@query("late_earlier_file", """
SELECT r.collecttype, r.engine, r.dt, r.filedt, CAST(sum(r.con_number) AS BIGINT) AS con_number FROM d_resolved r
JOIN (SELECT collecttype, engine, dt, min(filedt) AS filedt FROM d_resolved GROUP BY ALL) u USING (collecttype, engine, dt, filedt)
GROUP BY ALL""")
def _(t):
    """A later file is aggregated before the earliest one arrives: what is stored must be the earliest file's alone."""
    spark, ctx = t.spark, jobs.scratch(t.spark, "late", **OPTIONS)
    t.flows_by_month(written=False)
    resolved = t.stored("d_resolved")
    later = resolved.withColumn("filedt", F.concat(F.lit("9"), "filedt")).withColumn("con_number", F.col("con_number") * 2)
    for rows in (later, resolved):
        entries = lg.ledger_entries(rows, "connection", lg.RESOLVE)
        sn.write_units(rows, ctx.path("resolved"), lg.UNIT, list(ctx.partitions), staged=True)
        sn.append_ledger(entries, ctx.path("meta"))
        jobs.aggregate(spark, ctx)
    stored = union_by_name([spark.read.parquet(ctx.path(f"agg/{kind}")).select("engine", "dt", "filedt", "con_number", F.lit(kind).alias("collecttype"))
                            for kind in ("device", "server")])
    return stored.groupBy(*lg.UNIT, "filedt").agg(F.sum("con_number").alias("con_number"))


SOCKET_ADDRESSES = f"""address_site AS (
  SELECT ip, string_agg(DISTINCT mdm_loc_code, '_' ORDER BY mdm_loc_code) AS site
  FROM (SELECT DISTINCT ip, {IP_NUMBER.format('ip')} AS num FROM (SELECT source_ip AS ip FROM directed UNION SELECT dest_ip FROM directed) z) a
  JOIN d_mdm ON num > mdm_ip_start_int AND num < mdm_ip_end_int GROUP BY ip)"""


@query("job_sockets", f"""
WITH directed AS (SELECT * FROM ({DIRECTED_SQL}) x WHERE status <> '(BOUND)'), {SOCKET_ADDRESSES}
SELECT f.server_ip AS engine, CAST(substr(f.dt, 1, 10) AS DATE) AS dt, f.source_ip, f.dest_ip, CAST(f.dest_port AS INTEGER) AS dest_port,
  f.node AS con_protocol, CASE status WHEN '(SYN-SENT)' THEN 'SYN-SENT' WHEN '(SYN-RECEIVED)' THEN 'RECEIVED' ELSE 'closed' END AS con_status,
  f.source_app_exec, coalesce(a.site, 'nf') AS source_site, coalesce(b.site, 'nf') AS dest_site, d.aip_app_name AS dest_aip_app_name, count(*) AS con_number
FROM directed f LEFT JOIN address_site a ON f.source_ip = a.ip LEFT JOIN address_site b ON f.dest_ip = b.ip LEFT JOIN d_aip d ON f.dest_ip = d.aip_server_ip
GROUP BY ALL""")
def _(t):
    spark, ctx = t.spark, jobs.scratch(t.spark, "sockets", **OPTIONS)
    lsof = t.d_lsof.select("server_ip", "dt", "command", "pid", "user", "node", "name", "status")
    for _ in range(2):  # the second run finds nothing left
        jobs.encode_sockets(spark, ctx, {"lsof": lsof, "ps": t.d_ps})
        jobs.resolve_sockets(spark, ctx, t.d_mdm, t.d_aip)
        jobs.aggregate_sockets(spark, ctx)
    return spark.read.parquet(ctx.path("agg/serversockets")).select(
        "engine", "dt", "source_ip", "dest_ip", "dest_port", "con_protocol", "con_status", "source_app_exec", "source_site", "dest_site",
        "dest_aip_app_name", "con_number")


@query("job_usage", f"""
SELECT 'disk' AS kind, grain, server, device, month, dt, count_date, q50_avail_mb AS q50, max_total_mb AS top FROM ({{0}}) a
UNION ALL SELECT 'cpu', grain, server, NULL, month, dt, count_date, q50_cpu_percent, avg_cpu_percent FROM ({{1}}) b""".format(
    qa._profile_sql("server, server_ip, device", f"count(DISTINCT date) AS count_date, max(total_mb) AS max_total_mb, {qa._quantiles('avail_mb')}", qa.CAPACITY_SQL),
    qa._profile_sql("server, server_ip", f"count(DISTINCT date) AS count_date, round(avg(cpu_percent), 2) AS avg_cpu_percent, {qa._quantiles('cpu_percent')}", qa.CPU_SQL)))
def _(t):
    spark, ctx = t.spark, jobs.scratch(t.spark, "usage", **OPTIONS)
    for _ in range(2):  # the same samples again change nothing
        jobs.encode_usage(spark, ctx, t.d_usage)
    jobs.profile_usage(spark, ctx, qa.storage(t), t.d_aip)
    common = ["grain", "server", "month", "dt", "count_date"]
    disk = spark.read.parquet(ctx.path("agg/iostat")).select(
        F.lit("disk").alias("kind"), *common, "device", F.col("q50_avail_mb").alias("q50"), F.col("max_total_mb").alias("top"))
    cpu = spark.read.parquet(ctx.path("agg/sysstat")).select(
        F.lit("cpu").alias("kind"), *common, F.lit(None).cast("string").alias("device"), F.col("q50_cpu_percent").alias("q50"),
        F.col("avg_cpu_percent").alias("top"))
    return disk.unionByName(cpu)


def _raw_of(rows, columns: dict):
    """Repository rows under the headers of their file."""
    headers = {}
    for name, source in columns.items():
        headers.setdefault(source[0] if isinstance(source, tuple) else source, name)
    return rows.select(*[(F.col(n) if n in rows.columns else F.lit("")).alias(h) for h, n in headers.items()])


@query("job_repository", f"""
SELECT * REPLACE (CAST('2016-05-01' AS DATE) AS filedate) FROM ({ROLLUP_SQL}) r WHERE aip_server_ip LIKE '10.%'
QUALIFY row_number() OVER (PARTITION BY aip_server_ip ORDER BY aip_app_name DESC, aip_server_hostname DESC) = 1""")
def _(t):
    spark, ctx = t.spark, jobs.scratch(t.spark, "repository", **OPTIONS)
    files = {"AIP-Server": _raw_of(t.d_server, pj.SERVER), "AIP-SoftInstance": _raw_of(t.d_instance, pj.SOFT_INSTANCE),
             "AIP-Application": _raw_of(t.d_application, pj.APPLICATION), "AIP-AppGFtoApp": _raw_of(t.d_gridfusion, pj.GRID_FUSION)}
    for name, raw in files.items():
        jobs.ingest_repository(spark, ctx, name, "2016-05-01", raw)
    jobs.build_assets(spark, ctx)
    return spark.read.parquet(ctx.path("repo/AIP")).select(*ROLLUP_SHOWN)


def _daily_tables(t, ctx):
    t.stored("d_flows")  # joined once for the users and the three tables
    users = jobs.number_users(t.spark, ctx, t.d_flows)
    by_device, by_server = (partition_places(["month"], keys) for keys in (ag.DEVICE_DAY_KEYS, ag.SERVER_DAY_KEYS))
    for name, rows in (("agg/device", qa.device_day_sets(t, users, by_device)), ("agg/server", qa.server_day(t, by_server)),
                       ("agg/serversockets", qa.socket_day(t, by_server))):
        sn.write_partitioned(rows, ctx.path(name), ["month"])


@query("job_flow", "SELECT 'month' AS grain, x.* FROM ({0}) x UNION ALL SELECT 'all', NULL, y.* FROM ({1}) y".format(
    qa._summary_sql("month, "), qa._summary_sql("")))
def _(t):
    spark, ctx = t.spark, jobs.scratch(t.spark, "flow", **OPTIONS)
    _daily_tables(t, ctx)
    jobs.build_flow_tables(spark, ctx)
    month = spark.read.parquet(ctx.path("agg/flow_month")).withColumns({"grain": F.lit("month")})
    total = spark.read.parquet(ctx.path("agg/flow")).withColumns({"grain": F.lit("all"), "month": F.lit(None).cast("string")})
    return month.withColumn("month", F.col("month").cast("string")).unionByName(total)


EARLIEST = """(SELECT r.* FROM d_resolved r JOIN (SELECT collecttype, engine, dt, min(filedt) AS filedt FROM d_resolved GROUP BY ALL) u
  USING (collecttype, engine, dt, filedt))"""


def _served(t, ctx, rows):
    """One delivery of resolved rows, aggregated, then the flow tables; returns the months made again."""
    entries = lg.ledger_entries(rows, "connection", lg.RESOLVE)
    sn.write_units(rows, ctx.path("resolved"), lg.UNIT, list(ctx.partitions), staged=True)
    sn.append_ledger(entries, ctx.path("meta"))
    jobs.aggregate(t.spark, ctx)
    return jobs.build_flow_tables(t.spark, ctx)


@query("flow_increment", "SELECT 'month' AS grain, x.* FROM ({0}) x UNION ALL SELECT 'all', NULL, y.* FROM ({1}) y".format(
    *[qa._summary_sql(month).replace("FROM d_resolved", f"FROM {EARLIEST} d") for month in ("month, ", "")]))
def _(t):
    """Flow tables kept up to date: some months first, from a file that later proves not to be the earliest, then the others, then the
    earliest files. What is stored must be what a single run over the earliest files gives."""
    spark, ctx = t.spark, jobs.scratch(t.spark, "increment", **OPTIONS)
    t.flows_by_month(written=False)
    resolved = t.stored("d_resolved")
    earliest = cut_lineage(resolved.groupBy("engine", "dt").agg(F.min("filedt").alias("filedt")), "earliest")
    sockets = qa.socket_day(t, partition_places(["month"], ag.SERVER_DAY_KEYS))
    sn.write_partitioned(semi_join(sockets, earliest, ["engine", "dt", "filedt"]), ctx.path("agg/serversockets"), ["month"])
    early, later = F.col("month") < "1998-07", F.concat(F.lit("9"), "filedt")
    wrong = resolved.withColumns({"filedt": later, "con_number": F.col("con_number") * 2})
    for rows in (wrong.filter(early & (F.col("month") >= "1998-01")), resolved.filter(~early), resolved.filter(early)):
        _served(t, ctx, rows)
    month = spark.read.parquet(ctx.path("agg/flow_month")).withColumns({"grain": F.lit("month")})
    total = spark.read.parquet(ctx.path("agg/flow")).withColumns({"grain": F.lit("all"), "month": F.lit(None).cast("string")})
    return month.withColumn("month", F.col("month").cast("string")).unionByName(total)


RANGE_STARTS = {"Full": "(SELECT min(dt) FROM {0}_days)", "6Weeks": "(SELECT max(dt) - 42 FROM {0}_days)",
                "LastWeek": "(SELECT max(dt) - 7 FROM {0}_days)", "DayOne": "DATE '1998-11-02'"}


def _publish_sql() -> str:
    parts = []
    for kind, resolutions in jobs.RESOLUTIONS.items():
        for resolution in resolutions:
            for level in ("detail", "nodetail"):
                for name, start in RANGE_STARTS.items():
                    keys = ", ".join(f"coalesce({k}, 'NA') AS {k}" if k != "dest_port" else k for k in cube_keys(kind, level, resolution))
                    parts.append(f"""SELECT '{jobs.cube_name(kind, level, resolution, name)}' AS cube, count(*) AS n,
  CAST(sum(cn) AS BIGINT) AS con_number, CAST(sum(ct) AS BIGINT) AS con_times_traffic
FROM (SELECT {keys}, sum(con_number) AS cn, sum((con_traffic_in + con_traffic_out) * con_number) AS ct FROM {kind}_day
  WHERE dt IN (SELECT dt FROM {kind}_days) AND dt >= {start.format(kind)} GROUP BY ALL) x""")
    device, server = (qa.DAYS_SQL.format(k, n) for k, n in (("device", 4), ("server", 3)))
    return (f"WITH device_day AS ({qa.DEVICE_DAY_SQL}), server_day AS ({qa.SERVER_DAY_SQL}), device_days AS ({device}), server_days AS ({server})\n"
            + "\nUNION ALL\n".join(parts))


@query("job_publish", _publish_sql())
def _(t):
    spark = t.spark
    ctx = jobs.scratch(spark, "publish", min_device_engines=4, min_server_engines=3, first_day="1998-11-02", **OPTIONS)
    _daily_tables(t, ctx)
    recorded = t.stored("d_ledger").filter((F.col("stage") == lg.ENCODE) & (F.col("filetype") == "connection"))
    sn.append_ledger(recorded.withColumn("stage", F.lit(lg.AGGREGATE)), ctx.path("meta"))
    written = jobs.publish(spark, ctx, "20160501-000000", t.d_users, t.d_application, t.d_mdm)
    return union_by_name([spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.sum("con_number").alias("con_number"), F.sum("con_times_traffic").alias("con_times_traffic"))
        .withColumn("cube", F.lit(name)) for name, path in written.items() if name.startswith("Stat")])


SITEMAP_LIMIT = 20
SITEMAP_EDGES = """SELECT concat(c.SiteCode_Source, '-', coalesce(a.CountryCode, 'NA')) AS SiteCode_Source,
  concat(c.SiteCode_Destination, '-', coalesce(b.CountryCode, 'NA')) AS SiteCode_Destination, CAST(sum(con_traffic) AS DOUBLE) AS Traffic
FROM d_cube c LEFT JOIN d_sites a ON c.SiteCode_Source = a.SiteCode LEFT JOIN d_sites b ON c.SiteCode_Destination = b.SiteCode
WHERE con_status = 'closed' AND source_sector IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND c.SiteCode_Source <> c.SiteCode_Destination
  AND c.SiteCode_Source NOT IN ('S4') AND coalesce(a.CountryCode, '') <> 'C9' AND con_protocol = 'tcp' AND dest_port BETWEEN 1 AND 900
  AND source_aip_app_name SIMILAR TO '.*App [0-4].*' AND con_traffic <> 0 GROUP BY ALL"""


def _scaled(value: str) -> str:
    """Three divisions by 1000 at most, each one while the largest value is a million or more."""
    steps = [value]
    for _ in range(3):
        steps.append(f"round_even({steps[-1]} / 1000, 0)")
    tops = [s.replace(value, "(SELECT max(Traffic) FROM e)") for s in steps]
    cases = " ".join(f"WHEN {top} < 1000000 THEN {step}" for top, step in zip(tops, steps))
    return f"CASE {cases} END"


def _unit() -> str:
    value = "(SELECT max(Traffic) FROM e)"
    cases, step = [], value
    for i in range(4):
        cases.append(f"WHEN {step} < 1000000 THEN {3 * i}")
        step = f"round_even({step} / 1000, 0)"
    return f"CAST(CASE {' '.join(cases)} END AS INTEGER)"


@query("job_sitemap", f"""
WITH e AS ({SITEMAP_EDGES}), s AS (SELECT SiteCode_Source, SiteCode_Destination, {_scaled('Traffic')} AS Traffic, {_unit()} AS unit FROM e),
totals AS (SELECT Site, sum(w) AS total, max(o) + max(i) AS roles FROM (SELECT SiteCode_Source AS Site, Traffic AS w, 1 AS o, 0 AS i FROM s
  UNION ALL SELECT SiteCode_Destination, Traffic, 0, 1 FROM s) x GROUP BY Site),
kept AS (SELECT Site FROM (SELECT *, sum(roles) OVER (ORDER BY total DESC, Site) + 1 AS size, row_number() OVER (ORDER BY total DESC, Site) AS rn
  FROM totals) r WHERE size <= {SITEMAP_LIMIT} AND rn <= {SITEMAP_LIMIT})
SELECT * FROM s WHERE SiteCode_Source IN (SELECT Site FROM kept) AND SiteCode_Destination IN (SELECT Site FROM kept)""")
def _(t):
    result = jobs.sitemap(
        t.d_cube, t.d_sites, t.d_categories, "SumData", SITEMAP_LIMIT, detailed=True, shown=jobs.MapFilter(
            sectors=jobs.Ends(("BUILDING", "MACHINERY", "HOUSEHOLD")), within_sites=False, without_sites=jobs.Ends(("S4",)),
            without_countries=jobs.Ends(("C9",)), ports="tcp/1-900", applications={"source": {"AIPAppName": ["App [0-4]"]}}))
    return result["edges"].withColumn("unit", F.lit(result["unit"]))


# Variants of the published cubes: device by identity and by address, server.
PUBLISHED = [("device", "IDM", "source_I_ID_site"), ("device", "Device", "source_site"), ("server", "IDM", "source_site")]


def _published_map_sql() -> str:
    parts = []
    for kind, resolution, site in PUBLISHED:
        first = RANGE_STARTS["6Weeks"].format(kind)
        code = "coalesce(nullif(coalesce({0}, 'NA'), ''), 'nf')"
        e = f"""SELECT concat({code.format(site)}, '-', coalesce(a.CountryCode, 'NA')) AS SiteCode_Source,
  concat({code.format('dest_site')}, '-', coalesce(b.CountryCode, 'NA')) AS SiteCode_Destination, CAST(sum(con_traffic_in + con_traffic_out) AS DOUBLE) AS Traffic
FROM {kind}_day c LEFT JOIN d_sites a ON {code.format(site)} = a.SiteCode LEFT JOIN d_sites b ON {code.format('dest_site')} = b.SiteCode
WHERE con_status = 'closed' AND dt IN (SELECT dt FROM {kind}_days) AND dt >= {first} GROUP BY ALL HAVING sum(con_traffic_in + con_traffic_out) <> 0"""
        parts.append(f"""SELECT '{kind} {resolution}' AS cube, * FROM (WITH e AS ({e}) SELECT SiteCode_Source, SiteCode_Destination, {_scaled('Traffic')} AS Traffic, {_unit()} AS unit FROM e) y""")
    device, server = (qa.DAYS_SQL.format(k, n) for k, n in (("device", 4), ("server", 3)))
    return (f"WITH device_day AS ({qa.DEVICE_DAY_SQL}), server_day AS ({qa.SERVER_DAY_SQL}), device_days AS ({device}), server_days AS ({server})\n"
            + "\nUNION ALL\n".join(parts))


@query("job_sitemap_published", _published_map_sql())
def _(t):
    spark = t.spark
    ctx = jobs.scratch(spark, "published-map", min_device_engines=4, min_server_engines=3, first_day="1998-11-02", **OPTIONS)
    _daily_tables(t, ctx)
    recorded = t.stored("d_ledger").filter((F.col("stage") == lg.ENCODE) & (F.col("filetype") == "connection"))
    sn.append_ledger(recorded.withColumn("stage", F.lit(lg.AGGREGATE)), ctx.path("meta"))
    written = jobs.publish(spark, ctx, "20160501-000000", t.d_users, t.d_application, t.d_mdm, exports=False, date_ranges=("6Weeks",))
    folder, maps = next(iter(written.values())).rsplit("/", 1)[0], []
    for kind, resolution, _ in PUBLISHED:
        cube = jobs.published_cube(spark, folder, kind, resolution, date_range="6Weeks")
        found = jobs.sitemap(cube, t.d_sites, t.d_categories, "SumData", 100, source=kind)
        maps.append(found["edges"].withColumns({"unit": F.lit(found["unit"]), "cube": F.lit(f"{kind} {resolution}")}))
    return union_by_name(maps)


GRAPH_NODES = 10
GRAPH_SIZES = ", ".join(f"({a}, {s})" for a in range(1, 10 * GRAPH_NODES + 1) for s in mx.trim_sizes(a))


@query("job_graph", f"""
WITH e AS (SELECT concat(p_name, ' (', p_type, ')') AS source, concat('srv|', CAST(l_suppkey % 12 AS VARCHAR)) AS destination,
    CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS DOUBLE) AS Traffic FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_returnflag <> 'A' GROUP BY ALL),
s AS (SELECT source, destination, {_scaled('Traffic')} AS traffic, {_unit()} AS unit FROM e),
r AS (SELECT *, row_number() OVER (ORDER BY traffic DESC, source, destination) AS rn FROM s QUALIFY rn <= {10 * GRAPH_NODES}),
seen AS (SELECT node, min(rn) AS rn FROM (SELECT source AS node, rn FROM r UNION ALL SELECT destination, rn FROM r) x GROUP BY node),
c AS (SELECT r.rn, (SELECT count(*) FROM seen WHERE seen.rn <= r.rn) AS nodes FROM r),
sizes(start_size, size) AS (VALUES {GRAPH_SIZES}),
best AS (SELECT coalesce(max(c.rn), 0) AS n FROM c JOIN sizes ON size = c.rn AND start_size = (SELECT count(*) FROM r) WHERE nodes <= {GRAPH_NODES})
SELECT replace(replace(replace(source, ' ', '_'), '(', '-'), ')', '') AS source, replace(destination, '|', '&') AS destination, traffic, unit
FROM r WHERE rn <= (SELECT n FROM best)""")
def _(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    named = F.when(F.col("l_returnflag") != "A", F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).otherwise("")
    edges = rows.groupBy(named.alias("source"), F.concat(F.lit("srv|"), (F.col("l_suppkey") % 12).cast("string")).alias("destination")).agg(
        F.sum(F.floor("l_extendedprice").cast("bigint")).alias("traffic"))
    graph, unit = jobs.weighted_graph(edges, GRAPH_NODES)
    return graph.withColumn("unit", F.lit(unit))


FEED_SQL = """SELECT con_end AS "NX_con_end_time", dest_ip AS "NX_con_destination_ip", concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0'),
  CASE WHEN l_returnflag = 'A' THEN '.CORP.example' ELSE '' END) AS "NX_user_name", concat('PC-', CAST(o_custkey % 40 AS STRING)) AS "NX_device_name",
  o_custkey FROM d_flows"""


@query("job_pseudonymize", f"""
SELECT 'row' AS kind, NX_con_end_time, NX_con_destination_ip, CASE WHEN c_acctbal > 0 THEN concat('id-', CAST(c_custkey AS VARCHAR))
    ELSE sha256(concat('{KEY}:', lower(c_name))) END AS I_ID_U, sha256(concat('{KEY}:', lower(NX_device_name))) AS I_ID_D
FROM ({FEED_SQL}) f JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT DISTINCT 'entry', NULL, lower(c_name), sha256(concat('{KEY}:', lower(c_name))), NULL FROM ({FEED_SQL}) f JOIN customer ON o_custkey = c_custkey
  WHERE NOT c_acctbal > 0
UNION ALL SELECT DISTINCT 'entry', NULL, lower(NX_device_name), sha256(concat('{KEY}:', lower(NX_device_name))), NULL FROM ({FEED_SQL}) f""")
def _(t):
    spark, ctx = t.spark, jobs.scratch(t.spark, "pseudonyms", key=KEY, **OPTIONS)
    feed = cut_lineage(t.sql(FEED_SQL).drop("o_custkey"), "feed")
    rows, entries = jobs.pseudonymize_feed(feed, "connection", dictionary(t), ctx)
    for _ in range(2):  # the same entries again change nothing
        jobs.store_dictionary(spark, ctx, entries)
    stored = spark.read.parquet(ctx.path("dictionary"))
    none = F.lit(None).cast("string")
    return rows.select(F.lit("row").alias("kind"), "NX_con_end_time", "NX_con_destination_ip", "I_ID_U", "I_ID_D").unionByName(
        stored.select(F.lit("entry").alias("kind"), none.alias("NX_con_end_time"), F.col("name").alias("NX_con_destination_ip"),
                      F.col("I_ID").alias("I_ID_U"), none.alias("I_ID_D")))


def _raw_feed(rows, kind: str) -> str:
    """A raw feed as the collectors deliver it; returns its folder."""
    path = work_path(rows.sparkSession, f"{kind}_e1_20160501")
    user, device, other = F.col("NX_user_name"), F.col("NX_device_name"), F.lit("x")
    if kind == "listener":
        named = {"source_user": user, "source_host_name": device}
        rows.select(*[named.get(c, other).alias(c) for c in jobs.LISTENER_COLUMNS]).write.options(header=True, sep=";").csv(path)
        return path
    columns = {"execution": [*[other] * 13, user, device, other], "webrequest": [*[other] * 16, device, *[other] * 8],
               "bigfix": [device, *[other] * 17]}[kind]
    rows.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).write.options(sep="\t").csv(path)
    return path


_USER_ID = f"""CASE WHEN c_acctbal > 0 THEN concat('id-', CAST(c_custkey AS VARCHAR)) ELSE sha256(concat('{KEY}:', lower(c_name))) END"""
_DEVICE_ID = f"sha256(concat('{KEY}:', lower(NX_device_name)))"
FEEDS = {"execution": True, "webrequest": False, "bigfix": False, "listener": True}  # whether a feed names users


@query("job_pseudonymize_feeds", "\nUNION ALL\n".join(
    f"SELECT '{kind}' AS feed, {_USER_ID if users else 'NULL'} AS I_ID_U, {_DEVICE_ID} AS I_ID_D, count(*) AS n FROM ({FEED_SQL}) f JOIN customer ON o_custkey = c_custkey GROUP BY ALL"
    for kind, users in FEEDS.items()))
def _(t):
    """All other feeds from their raw files, with one dictionary that grows from feed to feed."""
    spark, ctx = t.spark, jobs.scratch(t.spark, "feeds", key=KEY, **OPTIONS)
    jobs.store_dictionary(spark, ctx, dictionary(t).select("name", "I_ID"))
    delivered, frames = cut_lineage(t.sql(FEED_SQL).select("NX_user_name", "NX_device_name"), "delivered"), []
    for kind, users in FEEDS.items():
        feed = jobs.read_feed(spark, _raw_feed(delivered, kind), kind)
        rows, entries = jobs.pseudonymize_feed(feed, kind, cut_lineage(spark.read.parquet(ctx.path("dictionary")), "dictionary"), ctx)
        jobs.store_dictionary(spark, ctx, entries)
        user = F.col("I_ID_U") if users else F.lit(None).cast("string")
        frames.append(rows.select(F.lit(kind).alias("feed"), user.alias("I_ID_U"), "I_ID_D").groupBy("feed", "I_ID_U", "I_ID_D").agg(F.count("*").alias("n")))
    return union_by_name(frames)
