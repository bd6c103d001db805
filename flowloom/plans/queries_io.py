"""Registered queries for sources, sinks, log parsing, pseudonyms and streams.

Queries that need files write rows derived from the given tables to the shared
folder first and then run the operator on those files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.functions import is_internal_ip
from flowloom.operators import ledger as lg
from flowloom.operators import privacy as pv
from flowloom.operators import projections as pj
from flowloom.operators.filters import between_days
from flowloom.operators.joining import union_by_name
from flowloom.plans import jobs
from flowloom.plans.queries_tables import PENDING_SQL, SERVER_ENGINES
from flowloom.plans.registry import query
from flowloom.session import COMPRESSION, cut_lineage, work_path
from flowloom.sources import logs
from flowloom.sources import readers as rd
from flowloom.sources import sinks as sn
from flowloom.streaming import ingest as st

# -- sources -------------------------------------------------------------------------------------------------------


@query("scan_csv_header", "SELECT * FROM d_raw_webrequest")
def _(t):
    path = work_path(t.spark, "webrequest")
    t.d_raw_webrequest.write.options(header=True, sep=";", compression="gzip").csv(path)
    return rd.read_extract(t.spark, path, list(pj.WEBREQUEST))


@query("scan_csv_schema", """
SELECT server_ip, dt, command, pid, "user", node, name, CASE WHEN status = '' THEN NULL ELSE status END AS status FROM d_lsof""")
def _(t):
    path = work_path(t.spark, "lsof")
    t.d_lsof.select(*rd.SNAPSHOT_COLUMNS["lsof"]).write.options(sep=";", emptyValue="").csv(path)
    return rd.read_snapshot(t.spark, path, "lsof")


@query("scan_csv_encoding", """
SELECT concat('Besançon ', n_name) AS "Location Name", CAST(n_nationkey AS VARCHAR) AS Status, concat('é', CAST(n_regionkey AS VARCHAR)) AS Mask FROM nation
UNION ALL SELECT concat('Zürich € ', s_name), CAST(s_suppkey AS VARCHAR), concat('é', CAST(s_nationkey AS VARCHAR)) FROM supplier""")
def _(t):
    path = work_path(t.spark, "repository")
    rows = t.nation.select(F.concat(F.lit("Besançon "), "n_name").alias("Location Name"), F.col("n_nationkey").cast("string").alias("Status"),
                           F.concat(F.lit("é"), F.col("n_regionkey").cast("string")).alias("Mask")).unionByName(
        t.supplier.select(F.concat(F.lit("Zürich € "), "s_name").alias("Location Name"), F.col("s_suppkey").cast("string").alias("Status"),
                          F.concat(F.lit("é"), F.col("s_nationkey").cast("string")).alias("Mask")))
    # The euro sign is 0x80 in windows-1252; written as Latin-1 text it is that very byte.
    written = rows.withColumn("Location Name", F.translate("Location Name", "€", "\x80"))
    written.write.options(header=True, sep=";", encoding="iso-8859-1").csv(path)
    return rd.read_repository(t.spark, path)


@query("scan_json", """SELECT date, server, name, value, "table" FROM d_usage WHERE "table" <> 'app'""")
def _(t):
    path = work_path(t.spark, "usage")
    t.d_usage.write.json(path)
    return rd.read_usage(t.spark, path).drop("stream", "importdt")


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    return t.orders.filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey", "o_totalprice")


def _supplier_snapshots(t) -> str:
    """Three dated snapshots of the supplier table; the last one has gained a column."""
    path = work_path(t.spark, "snapshots")
    old = t.supplier.select("s_suppkey", "s_name")
    for day, rows in (("2016-05-01", old), ("2016-06-01", old.filter(F.col("s_acctbal") > 0)),
                      ("2016-07-01", t.supplier.select("s_suppkey", "s_name", "s_nationkey"))):
        sn.write_snapshot(rows.withColumn("filedate", F.lit(day)), path)
    return path


@query("scan_merge_schema", """
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey, DATE '2016-05-01' AS filedate FROM supplier
UNION ALL SELECT s_suppkey, s_name, NULL, DATE '2016-06-01' FROM supplier WHERE s_acctbal > 0
UNION ALL SELECT s_suppkey, s_name, s_nationkey, DATE '2016-07-01' FROM supplier""")
def _(t):
    return rd.read_merged(t.spark, _supplier_snapshots(t))


@query("asof_snapshot", """
SELECT 'june' AS asked, s_suppkey, s_name, DATE '2016-06-01' AS filedate FROM supplier WHERE s_acctbal > 0
UNION ALL SELECT 'newest', s_suppkey, s_name, DATE '2016-07-01' FROM supplier""")
def _(t):
    stored = rd.read_merged(t.spark, _supplier_snapshots(t)).drop("s_nationkey")
    return rd.as_of(stored, "2016-06-20").withColumn("asked", F.lit("june")).unionByName(
        rd.as_of(stored).withColumn("asked", F.lit("newest")))


@query("sink_snapshot", """
SELECT s_suppkey, s_name, DATE '2016-05-01' AS filedate FROM supplier
UNION ALL SELECT s_suppkey, s_name, DATE '2016-06-01' FROM supplier WHERE s_acctbal > 1000""")
def _(t):
    path, rows = work_path(t.spark, "snapshot"), t.supplier.select("s_suppkey", "s_name")
    sn.write_snapshot(rows.withColumn("filedate", F.lit("2016-05-01")), path)
    sn.write_snapshot(rows.withColumn("filedate", F.lit("2016-06-01")), path)
    # A second delivery of a date replaces that date alone.
    sn.write_snapshot(t.supplier.filter(F.col("s_acctbal") > 1000).select("s_suppkey", "s_name", F.lit("2016-06-01").alias("filedate")), path)
    return t.spark.read.parquet(path)


@query("scan_or_empty", """
SELECT 'stored' AS source, count(*) AS n FROM orders UNION ALL SELECT 'missing', 0""")
def _(t):
    path = work_path(t.spark, "stored")
    t.orders.select("o_orderkey").write.parquet(path)
    frames = [rd.read_or_empty(t.spark, p, "o_orderkey bigint").agg(F.count("*").alias("n")).withColumn("source", F.lit(label))
              for label, p in (("stored", path), ("missing", path + "-missing"))]
    return union_by_name(frames)


@query("scan_multi_file", """
SELECT ex_end_time, ex_app_name, engine, CASE WHEN l_returnflag = 'A' THEN ex_app_bin_hash END AS ex_app_bin_hash,
  CASE WHEN l_returnflag <> 'R' THEN ex_device_ip END AS ex_device_ip FROM d_raw_execution""")
def _(t):
    raw = t.d_raw_execution
    drops = {"A": [], "N": ["ex_app_bin_hash"], "R": ["ex_app_bin_hash", "ex_device_ip"]}
    paths = []
    for flag, gone in drops.items():
        paths.append(work_path(t.spark, f"x/execution_{flag}"))
        raw.filter(F.col("l_returnflag") == flag).drop("l_returnflag", *gone).write.options(header=True, sep=";").csv(paths[-1])
    files = rd.group_by_type(paths)["execution"]
    return rd.read_evolving(t.spark, files, "I_ID_D").select("ex_end_time", "ex_app_name", "engine", "ex_app_bin_hash", "ex_device_ip")


@query("filter_file_size", "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem")
def _(t):
    # The regions fit a file far below the limit; the line items do not.
    path = work_path(t.spark, "sizes")
    t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber").hint("rebalance").write.json(path)
    t.region.select(F.col("r_regionkey").cast("bigint").alias("l_orderkey")).coalesce(1).write.mode("append").json(path)
    scan = t.spark.read.schema("l_orderkey bigint, l_partkey bigint, l_linenumber int").json(path)
    return scan.filter(rd.large_enough())


@query("star_extract", """
SELECT l_orderkey, l_linenumber, l_partkey, c_name, s_name, p_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
WHERE c_mktsegment <> 'MACHINERY' AND s_nationkey < 20""")
def _(t):
    connections = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    network = F.when(F.col("s_nationkey") < 20, 10).otherwise(192)
    address = F.concat(network.cast("string"), F.lit(".1.2."), F.col("s_nationkey").cast("string"))
    rows = connections.select("l_orderkey", "l_linenumber", "l_partkey", address.alias("dest_ip"), F.col("o_custkey").alias("user_id"),
                              F.col("l_suppkey").alias("device_id"), F.col("l_partkey").alias("binary_id"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name",
                              F.when(F.col("c_mktsegment") == "MACHINERY", "system").otherwise("person").alias("user_type"))
    devices = t.supplier.select(F.col("s_suppkey").alias("device_id"), "s_name")
    binaries = t.part.select(F.col("p_partkey").alias("binary_id"), "p_name")
    return rd.extract_connections(rows, users, devices, binaries, "user_type", is_internal_ip(F.col("dest_ip"))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "c_name", "s_name", "p_name")


# -- sinks ---------------------------------------------------------------------------------------------------------


@query("sink_partitioned", "SELECT I_ID_U, engine, dt, month, filedt, con_end, con_number FROM d_connection")
def _(t):
    path = work_path(t.spark, "connection")
    rows = t.d_connection.select("I_ID_U", "engine", "dt", "month", "filedt", "con_end", "con_number")
    early = rows.filter(between_days("dt", "1990-01-01", "1998-06-15"))
    late = rows.filter(F.col("dt") > F.lit("1998-06-15").cast("date"))
    for part in (early, late, late):  # the repeated delivery must change nothing; June 1998 is in both parts
        sn.write_units(part, path, ["engine", "dt", "filedt"], ["month"])
    return t.spark.read.parquet(path).withColumn("month", F.date_format("dt", "yyyy-MM")).select(*rows.columns)


@query("sink_single_csv", """
SELECT concat('S', CAST(n_nationkey AS VARCHAR)) AS "SiteCode", count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def _(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("SiteCode")).agg(F.count("*").alias("n"))
    root = work_path(t.spark, "export")
    path = sn.export_csv(rows, root, "SiteCode.csv.gz", single=True, allowed_root=root)
    return rd.read_extract(t.spark, path).withColumn("n", F.col("n").cast("bigint"))


@query("sink_single_json", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY ALL")
def _(t):
    rows = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    path = sn.export_json(rows, work_path(t.spark, "export"), "segments.json.gz", single=True)
    return t.spark.read.schema("c_mktsegment string, n bigint").json(path)


@query("sink_records", """SELECT date, server, name, value, "table", kind FROM (SELECT *, 'a' AS kind FROM d_usage UNION ALL SELECT *, NULL FROM d_usage) x""")
def _(t):
    path = work_path(t.spark, "records")
    sn.write_records([t.d_usage.withColumn("kind", F.lit("a")), t.d_usage], path)
    return t.spark.read.schema("date bigint, server string, name string, value double, `table` string, kind string").json(path)


@query("ledger_append", "SELECT DISTINCT 'connection' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt, filedt FROM d_connection")
def _(t):
    path = work_path(t.spark, "meta")
    for _ in range(2):  # the second run adds nothing
        sn.append_ledger(lg.ledger_entries(t.d_connection, "connection", lg.ENCODE), path)
    return t.spark.read.parquet(path)


@query("compact_files", "SELECT I_ID_D, wr_url, engine, filedt FROM d_raw_webrequest")
def _(t):
    small, large = work_path(t.spark, "small"), work_path(t.spark, "large")
    rows = t.d_raw_webrequest.select("I_ID_D", "wr_url", "engine", "filedt")
    rows.repartition(40).write.options(header=True, sep=";", compression="gzip").csv(small)
    sn.compact_csv(t.spark, small, large, rows_per_file=200_000)
    return rd.read_extract(t.spark, large, rows.columns)


# -- logs ----------------------------------------------------------------------------------------------------------

# Listener lines: four layouts by order priority, the fifth with a broken date; lines of failed orders are of another kind.


def listener_lines(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    stamp = F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss")
    sid = F.concat(F.lit("(SID=Db"), (F.col("o_custkey") % 7).cast("string"), F.lit(")"))
    client = F.concat(F.lit("(CID=(PROGRAM=Prog"), (F.col("o_custkey") % 11).cast("string"), F.lit(".exe)(HOST=PC"), cust,
                      F.lit(")(USER=U"), cust, F.lit("))"))
    address = F.concat(F.lit("(ADDRESS=(PROTOCOL=tcp)(HOST=10.1.2."), (F.col("o_custkey") % 250).cast("string"), F.lit(")(PORT="), key, F.lit("))"))
    tail = F.lit(" * establish * Inst1 * 0")
    first = F.concat(stamp, F.lit(" * (CONNECT_DATA="), sid, client, F.lit(") * "))
    last = F.concat(stamp, F.lit(" * (CONNECT_DATA="), client, sid, F.lit(") * "))
    kind = F.col("o_orderpriority")
    line = (F.when(F.col("o_orderstatus") == "F", F.concat(stamp, F.lit(" * service_update * x * 0")))
            .when(kind == "1-URGENT", F.concat(F.lit("<txt>"), first, address, tail))
            .when(kind == "2-HIGH", F.concat(last, address, tail))
            .when(kind == "3-MEDIUM", F.concat(last, F.lit("(ADDRESS=(PROTOCOL=beq))"), tail))
            .when(kind == "5-LOW", F.concat(first, F.lit("(ADDRESS=(PROTOCOL=beq))"), tail))
            .otherwise(F.concat(stamp, F.lit(" * (CONNECT_DATA=(CID=)) * establish broken"))))
    return rows.select("o_orderkey", line.alias("value"))


PARSED_SQL = """SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS date, strftime(o_orderdate, '%H:%M:%S') AS time,
  concat('db', CAST(o_custkey % 7 AS VARCHAR)) AS host_sid, concat('prog', CAST(o_custkey % 11 AS VARCHAR), '.exe') AS source_program,
  concat('pc', CAST(o_custkey AS VARCHAR)) AS source_host_name, concat('u', CAST(o_custkey AS VARCHAR)) AS source_user,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN concat('10.1.2.', CAST(o_custkey % 250 AS VARCHAR)) ELSE 'inst1' END AS source_host_ip,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderkey AS VARCHAR) ELSE 'unknown' END AS host_port,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'inst1' ELSE 'unknown' END AS host_instance, CAST(o_orderdate AS DATE) AS day
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F' AND o_orderpriority <> '4-NOT SPECIFIED'"""


@query("scan_log_text", """
SELECT o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F' GROUP BY ALL""")
def _(t):
    path = work_path(t.spark, "listener")
    lines = listener_lines(t).join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    lines.select("o_orderpriority", "value").write.partitionBy("o_orderpriority").text(path)
    return logs.candidate_lines(t.spark.read.text(path)).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("parse_listener_log", f"SELECT * EXCLUDE (day) FROM ({PARSED_SQL}) x")
def _(t):
    return logs.parse_listener(listener_lines(t))


@query("log_quarantine", """
SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F' AND o_orderpriority = '4-NOT SPECIFIED'""")
def _(t):
    path = work_path(t.spark, "quarantine")
    logs.quarantine(listener_lines(t)).write.parquet(path)
    return t.spark.read.parquet(path).select("o_orderkey")


@query("log_coverage", f"""
SELECT 'h' AS host_name, host_instance, source_program, min(day) AS date_min, max(day) AS date_max FROM ({PARSED_SQL}) x GROUP BY ALL""")
def _(t):
    parsed = logs.parse_listener(listener_lines(t)).withColumn("host_name", F.lit("h"))
    return logs.log_coverage(parsed, ["source_program"])


@query("log_file_dates", """
SELECT concat('f', CAST(o_custkey AS VARCHAR)) AS file, strftime(arg_min(o_orderdate, o_orderkey), '%d-%m-%Y') AS file_first_date,
  strftime(arg_max(o_orderdate, o_orderkey), '%d-%m-%Y') AS file_last_date FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""")
def _(t):
    lines = listener_lines(t).join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    named = lines.withColumn("file", F.concat(F.lit("f"), F.col("o_custkey").cast("string")))
    return logs.file_dates(named, "file", "o_orderkey")


def ingested_logs(t):
    """The lines dealt to the logs of three hosts and taken in twice, which changes nothing."""
    spark, ctx = t.spark, jobs.scratch(t.spark, "listener")
    lines = listener_lines(t).join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    lines = cut_lineage(lines.select("value", "o_orderkey", "o_custkey"), "lines")
    paths = [work_path(spark, f"logs/listener_Host{i}_a") for i in range(3)]
    for i, path in enumerate(paths):
        lines.filter(F.col("o_custkey") % 3 == i).orderBy("o_orderkey").select("value").write.text(path)
    for _ in range(2):
        jobs.ingest_listener(spark, ctx, paths, "2016-05-04", in_pieces=True)
    return ctx


LOG_FILES_SQL = """SELECT o_custkey % 3 AS h, strftime(arg_min(o_orderdate, o_orderkey), '%d-%m-%Y') AS file_first_date,
  strftime(arg_max(o_orderdate, o_orderkey), '%d-%m-%Y') AS file_last_date FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""
LOGGED_SQL = f"""SELECT p.* EXCLUDE (o_orderkey), concat('host', CAST(h AS VARCHAR)) AS host_name, DATE '2016-05-04' AS integration_date, file_first_date, file_last_date
FROM ({PARSED_SQL}) p JOIN (SELECT o_orderkey, o_custkey % 3 AS h FROM orders) o USING (o_orderkey) JOIN ({LOG_FILES_SQL}) f USING (h)"""


@query("job_listener", f"SELECT * EXCLUDE (day) FROM ({LOGGED_SQL}) x")
def _(t):
    return t.spark.read.parquet(ingested_logs(t).path("listener")).drop("source_filename", "source_filedate")


@query("job_listener_report", f"""
SELECT host_name, host_instance, min(day) AS date_min, max(day) AS date_max, 0 AS n_trash FROM ({LOGGED_SQL}) x GROUP BY ALL
UNION ALL SELECT concat('host', CAST(o_custkey % 3 AS VARCHAR)), NULL, NULL, NULL, CAST(count(*) AS INTEGER) FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus <> 'F' AND o_orderpriority = '4-NOT SPECIFIED' GROUP BY ALL""")
def _(t):
    ctx = ingested_logs(t)
    trash = t.spark.read.parquet(ctx.path("listener_trash")).groupBy(F.lower(F.get(F.split("source_filename", "_"), F.lit(1))).alias("host_name")).agg(F.count("*").cast("int").alias("n_trash"))
    report = t.spark.read.parquet(ctx.path("listener_report")).select("host_name", "host_instance", "date_min", "date_max", F.lit(0).alias("n_trash"))
    return report.unionByName(trash, allowMissingColumns=True)


@query("parse_socket_lines", """
SELECT 'lsof' AS tool, command, pid, "user", node, name, status, count(*) AS n FROM d_lsof GROUP BY ALL
UNION ALL SELECT 'ps', concat('/bin/', command, ' -x 1'), pid, "user", '', '', '', count(*) FROM d_lsof GROUP BY ALL
UNION ALL SELECT 'netstat', concat(pid, '/', command), '', '', lower(node), name, 'LISTEN', count(*) FROM d_lsof WHERE node = 'TCP' GROUP BY ALL""")
def _(t):
    rows = t.d_lsof
    # A regular file carries a size column before the protocol, a deleted one does not.
    lsof = F.concat_ws(" ", "command", F.lit(" "), "pid", "user", F.lit("45u IPv4 0xabc"),
                       F.when(F.col("node") == "TCP", "0t0"), "node", "name", "status")
    ps = F.concat_ws("  ", "user", "pid", F.lit("1"), F.lit("0 Jan01 ?"), F.lit("00:00:07"), F.concat(F.lit("/bin/"), "command", F.lit(" -x 1")))
    netstat = F.concat_ws(" ", F.lower("node"), F.lit("0 0"), "name", F.lit("0.0.0.0:*"), F.lit("LISTEN"),
                          F.when(F.col("node") == "TCP", F.concat_ws("/", "pid", "command")))
    no = F.lit("")
    found = union_by_name([
        logs.parse_lsof(rows.select(lsof.alias("value"))).select(F.lit("lsof").alias("tool"), "command", "pid", "user", "node", "name", "status"),
        logs.parse_ps(rows.select(ps.alias("value"))).select(F.lit("ps").alias("tool"), "command", "pid", "user", no.alias("node"), no.alias("name"), no.alias("status")),
        logs.parse_netstat(rows.select(netstat.alias("value"))).select(
            F.lit("netstat").alias("tool"), "command", no.alias("pid"), no.alias("user"), "node", F.col("local").alias("name"), "status")])
    return found.groupBy(*found.columns).agg(F.count("*").alias("n"))


# -- pseudonyms ----------------------------------------------------------------------------------------------------

KEY = "a secret"
# Customers with a positive balance are in the dictionary already, under an identifier of the old kind.
DICTIONARY_SQL = "SELECT lower(c_name) AS name, concat('id-', CAST(c_custkey AS VARCHAR)) AS I_ID FROM customer WHERE c_acctbal > 0"
ORDER_USERS = "SELECT o_orderkey, upper(c_name) AS c_name FROM orders JOIN customer ON o_custkey = c_custkey"


def dictionary(t):
    return t.customer.filter(F.col("c_acctbal") > 0).select(
        F.lower("c_name").alias("name"), F.concat(F.lit("id-"), F.col("c_custkey").cast("string")).alias("I_ID"))


@query("pseudonymize", f"""
SELECT 'row' AS kind, CAST(o_orderkey AS VARCHAR) AS key, coalesce(d.I_ID, sha256(concat('{KEY}:', lower(u.c_name)))) AS I_ID
FROM ({ORDER_USERS}) u LEFT JOIN ({DICTIONARY_SQL}) d ON lower(u.c_name) = d.name
UNION ALL SELECT DISTINCT 'entry', lower(c_name), sha256(concat('{KEY}:', lower(c_name))) FROM ({ORDER_USERS}) u
WHERE lower(c_name) NOT IN (SELECT name FROM ({DICTIONARY_SQL}) d)""")
def _(t):
    feed = t.sql(ORDER_USERS)
    rows = pv.pseudonymize(feed, {"c_name": "I_ID"}, dictionary(t), KEY)
    entries = pv.new_dictionary_entries(feed.select(F.col("c_name").alias("name")), dictionary(t), KEY)
    return rows.select(F.lit("row").alias("kind"), F.col("o_orderkey").cast("string").alias("key"), "I_ID").unionByName(
        entries.select(F.lit("entry").alias("kind"), F.col("name").alias("key"), "I_ID"))


def identity_files(t):
    """Two ordered identity files; the first knows the customers of two segments, the second everybody."""
    def file(rows, domain: str, tag: str):
        return rows.select(
            F.concat(F.lit("User"), F.col("c_custkey").cast("string")).alias("ADLogin"), F.lit(domain).alias("ADDomain"),
            F.when(F.col("c_acctbal") < 0, "LEFT").otherwise("ACTIVE").alias("Status"), F.col("c_mktsegment").alias("Sector"),
            F.lit(tag).alias("SubSector"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("SiteCode"),
            F.lit("site").alias("SiteName"), F.lit("CC").alias("CountryCode"), F.lit(tag).alias("TerangaCode"))

    first = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return [file(first, "DOM1", "one"), file(t.customer, "DOM2", "")]


@query("enrich_login_priority", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN concat('user', CAST(o_custkey AS VARCHAR), '@own') WHEN c_acctbal < 0 THEN concat('user', CAST(o_custkey AS VARCHAR))
  WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN concat('user', CAST(o_custkey AS VARCHAR), '@dom1') ELSE concat('user', CAST(o_custkey AS VARCHAR), '@dom2') END AS source_user
FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    user = F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderstatus") == "P", "@own").otherwise(""))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", user.alias("source_user"))
    return pv.enrich_login(rows, "source_user", identity_files(t))


@query("resolve_identity", """
SELECT concat('id', CAST(c_custkey AS VARCHAR)) AS I_ID,
  CASE WHEN c_custkey % 2 = 0 THEN 'known' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN concat(c_mktsegment, '/one') ELSE c_mktsegment END AS Sector,
  CASE WHEN c_custkey % 2 = 0 THEN 'K' ELSE concat('S', CAST(c_nationkey AS VARCHAR)) END AS SiteCode,
  CASE WHEN c_custkey % 2 = 0 THEN 'k' ELSE 'site' END AS SiteName, 'CC' AS CountryCode,
  CASE WHEN c_custkey % 2 = 0 THEN 'T' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'one' ELSE '' END AS TerangaCode
FROM customer WHERE c_custkey % 2 = 0 OR c_acctbal >= 0""")
def _(t):
    # The login of a customer has the domain of the first file that knows it; even customers were resolved before.
    domain = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "@dom1").otherwise("@dom2")
    ids = F.concat(F.lit("id"), F.col("c_custkey").cast("string"))
    names = t.customer.select(ids.alias("I_ID"), F.concat(F.lit("user"), F.col("c_custkey").cast("string"), domain).alias("name"))
    known = t.customer.filter(F.col("c_custkey") % 2 == 0).select(
        ids.alias("I_ID"), F.lit("known").alias("Sector"), F.lit("K").alias("SiteCode"), F.lit("k").alias("SiteName"),
        F.lit("CC").alias("CountryCode"), F.lit("T").alias("TerangaCode"))
    return pv.resolve_identity(names, identity_files(t), known)


@query("pseudonymize_fallback", f"""
SELECT o_orderkey, coalesce(d.I_ID, concat('unknown device -', sha256(concat('{KEY}:', lower(u.c_name))))) AS I_ID_D
FROM ({ORDER_USERS}) u LEFT JOIN ({DICTIONARY_SQL}) d ON lower(u.c_name) = d.name""")
def _(t):
    return pv.pseudonymize_inventory(t.sql(ORDER_USERS), "c_name", dictionary(t), KEY)


# -- streams and back-fill -----------------------------------------------------------------------------------------


@query("stream_ingest", "SELECT I_ID_U, engine, dt, filedt, con_end, con_number FROM d_connection")
def _(t):
    spark = t.spark
    source, target, ledger = (work_path(spark, n) for n in ("arrived", "stored", "meta"))
    t.flows_by_month(written=False)
    rows = t.d_raw_connection
    rows.write.option("compression", COMPRESSION).parquet(source)
    checkpoint = work_path(spark, "checkpoint")
    for _ in range(2):  # nothing new the second time
        st.ingest(spark, source, rows.schema, target, ledger, partitions=("month",), checkpoint=checkpoint,
                  prepare=lambda batch: pj.project_connection(batch, SERVER_ENGINES)).awaitTermination()
    return spark.read.parquet(target).select("I_ID_U", "engine", "dt", "filedt", "con_end", "con_number")


@query("stream_daily", """
SELECT CAST(ts AS DATE) AS dt, event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total FROM events
GROUP BY ALL""")
def _(t):
    spark = t.spark
    source, target = work_path(spark, "events"), work_path(spark, "daily")
    rows = t.events.select(F.to_timestamp_ltz(F.col("ts").cast("string")).alias("ts"), "event_type", "value")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    totals = st.daily_totals(stream, "ts", ["event_type"], {"total": F.floor("value").cast("bigint")})
    st.open_days_to_table(totals, target, ["event_type"], work_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema("dt date, event_type string, n bigint, total bigint").parquet(target)


@query("stream_dedup", "SELECT DISTINCT I_ID_U, engine, dt FROM d_connection")
def _(t):
    spark = t.spark
    source, target = work_path(spark, "redelivered"), work_path(spark, "distinct")
    rows, checkpoint = t.d_connection.select("I_ID_U", "engine", "dt", "month"), work_path(spark, "checkpoint")
    for _ in range(2):  # all of it is delivered again years later
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        st.first_arrivals(stream, target, ["I_ID_U", "engine", "dt", "month"], "month", checkpoint).awaitTermination()
    return spark.read.schema("I_ID_U string, engine string, dt date, month string").parquet(target).drop("month")


@query("backfill_windows", f"""
SELECT window_no, count(*) AS n, min(dt) AS first_day, max(dt) AS last_day FROM (
  SELECT CAST((c.dt - DATE '1997-01-01') // 100 AS INTEGER) AS window_no, c.dt FROM d_connection c
  JOIN ({PENDING_SQL.format('pipe3to4', 'connection', 'pipe4to5')}) u
    ON c.collecttype = u.collecttype AND c.engine = u.engine AND c.dt = u.dt AND c.filedt = u.min_filedt
  WHERE c.dt >= DATE '1997-01-01' AND c.dt < DATE '1998-04-01') x GROUP BY ALL""")
def _(t):
    windows = list(jobs.backfill_windows("1997-01-01", "1998-04-01", 100))
    rows = lg.rows_of_units(t.d_connection.select(*lg.UNIT, "filedt"), lg.pending_aggregates(t.stored("d_ledger")), windows[0][0], windows[-1][1])
    number = F.coalesce(*[F.when(between_days("dt", first, last), i) for i, (first, last) in enumerate(windows)])
    return rows.groupBy(number.alias("window_no")).agg(
        F.count("*").alias("n"), F.min("dt").alias("first_day"), F.max("dt").alias("last_day"))
