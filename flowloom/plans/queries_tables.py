"""Registered queries for projections, filters, ledger and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

import flowloom.functions as fn
from flowloom.operators import filters as fl
from flowloom.operators import ledger as lg
from flowloom.operators import lookups as lk
from flowloom.operators import projections as pj
from flowloom.operators import sockets as sk
from flowloom.operators.joining import union_by_name
from flowloom.plans.jobs import site_lookup
from flowloom.plans.registry import query

SERVER_ENGINES = ["srv-engine-1", "srv-engine-2", "srv-engine-3"]

# -- projections ---------------------------------------------------------------------------------------------------


@query("project_connection", "SELECT * FROM d_connection")
def _(t):
    return pj.project_connection(t.d_raw_connection, SERVER_ENGINES)


@query("project_webrequest", "SELECT * FROM d_webrequest")
def _(t):
    return pj.project_webrequest(t.d_raw_webrequest, SERVER_ENGINES)


def _widths(t):
    raw = t.d_raw_execution
    full = raw.filter(F.col("l_returnflag") == "A").drop("l_returnflag")
    middle = raw.filter(F.col("l_returnflag") == "N").drop("l_returnflag", "ex_app_bin_hash")
    narrow = raw.filter(F.col("l_returnflag") == "R").drop("l_returnflag", "ex_app_bin_hash", "ex_device_ip")
    return [full, middle, narrow]


@query("project_evolving", """
SELECT I_ID_D, I_ID_U, ex_start_time AS "start", ex_end_time AS "end", ex_bin_path AS bin_path, ex_cardinality AS cardinality,
  ex_duration AS duration, ex_status AS status, ex_app_category AS app_category, ex_app_company AS app_company,
  ex_app_name AS app_name, ex_app_bin_exec_name AS app_bin_exec_name, ex_app_bin_paths AS app_bin_paths,
  ex_app_bin_version AS app_bin_version, CASE WHEN l_returnflag = 'A' THEN ex_app_bin_hash END AS app_bin_hash,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE ex_device_ip END AS source_ip, engine, filedt,
  CASE WHEN engine LIKE 'srv%' THEN 'server' ELSE 'device' END AS collecttype,
  CAST(substr(ex_end_time, 1, 10) AS DATE) AS dt, substr(ex_end_time, 1, 7) AS month
FROM d_raw_execution""")
def _(t):
    return pj.project_execution(union_by_name(_widths(t)), SERVER_ENGINES)


@query("union_by_name", """
SELECT ex_end_time, ex_app_name, engine, CASE WHEN l_returnflag = 'A' THEN ex_app_bin_hash END AS ex_app_bin_hash,
  CASE WHEN l_returnflag <> 'R' THEN ex_device_ip END AS ex_device_ip FROM d_raw_execution""")
def _(t):
    return union_by_name(_widths(t)).select("ex_end_time", "ex_app_name", "engine", "ex_app_bin_hash", "ex_device_ip")


@query("project_ip_ranges", """
SELECT mdm_loc_code, mdm_loc_name, mdm_loc_country, mdm_ip_start, mdm_ip_range, '2016-05-01' AS filedate,
  mdm_ip_start_int, mdm_ip_end_int, true AS has_id FROM d_mdm""")
def _(t):
    raw = t.d_mdm_raw.toDF("Status", "Active / Inactive", "Location Code", "Location Name", "Country Code", "IP Address", "Mask")
    return pj.project_ip_ranges(raw, "2016-05-01").select("*", F.col("mdm_id").isNotNull().alias("has_id")).drop("mdm_id")


@query("project_servers", "SELECT * FROM d_server")
def _(t):
    spelled = {n: (s[0] if isinstance(s, tuple) else s) for n, s in pj.SERVER.items() if n != "aip_server_owner"}
    raw = t.d_server.select(*[F.upper(n).alias(h) if n == "aip_server_hostname" else F.col(n).alias(h) for n, h in spelled.items()])
    return pj.project_repository(raw, "AIP-Server", "2016-05-01")


@query("project_header_variants", """
SELECT concat('App', CAST(p_partkey AS VARCHAR)) AS aip_app_name,
  CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS aip_app_shared_unique_id, p_type AS aip_app_type,
  'ok' AS aip_app_validation, p_brand AS aip_app_state, 'N' AS aip_app_sensitive, p_name AS aip_app_criticality,
  p_brand AS aip_app_sector, 'it' AS aip_app_it_owner, 'is' AS aip_app_is_owner, '2016-05-01' AS filedate FROM part
UNION ALL
SELECT concat('App', CAST(p_partkey AS VARCHAR)), CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END, p_type,
  'ok', p_brand, 'N', p_brand, p_brand, 'it', 'is', '2016-05-02' FROM part""")
def _(t):
    def raw(header: str, source: str):
        return t.part.select(
            F.concat(F.lit("App"), F.col("p_partkey").cast("string")).alias("Application Name"),
            F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("Shared Unique ID"), F.col("p_type").alias("Type"),
            F.lit("ok").alias("Validation"), F.col("p_brand").alias("Current State"), F.lit("N").alias("Sensitive Application"),
            F.col(source).alias(header), F.col("p_brand").alias("Sector"), F.lit("it").alias("IT Owner"), F.lit("is").alias("IS Owner"))

    return union_by_name([pj.project_applications(raw("Group Criticality", "p_name"), "2016-05-01"),
                          pj.project_applications(raw("Criticality", "p_brand"), "2016-05-02")])


@query("project_storage", """
SELECT concat('srv', CAST(l_suppkey AS VARCHAR)) AS server, concat('/m', CAST(l_linenumber AS VARCHAR)) AS mount,
  CASE l_returnflag WHEN 'R' THEN 'NAS' ELSE 'Unknown' END AS type,
  CAST(floor(l_quantity) AS BIGINT) * 1000 + 500 AS charged_used_mb, CAST(0 AS BIGINT) AS charged_total_mb,
  '2016-05-01' AS filedate FROM lineitem WHERE l_linestatus = 'O'""")
def _(t):
    raw = t.lineitem.select(
        F.concat(F.lit("SRV"), F.col("l_suppkey").cast("string")).alias("sServerName"),
        F.concat(F.lit("/M"), F.col("l_linenumber").cast("string")).alias("sPartition"),
        F.when(F.col("l_returnflag") == "R", "Tier 3").otherwise("tape").alias("StorageTier"),
        F.when(F.col("l_linestatus") == "O", "Yes").otherwise("No").alias("ServerBillableForStorage"),
        F.concat(F.floor("l_quantity").cast("string"), F.lit(",5")).alias("UsedMeassureGb"), F.lit("n/a").alias("TotalMeassureGb"))
    return pj.project_repository(raw, "Storage-Master-Report", "2016-05-01")


@query("project_identity", """
SELECT I_ID, SiteCode, SiteName, CountryCode, Sector, TerangaCode, '2016-05-01' AS filedate FROM d_users""")
def _(t):
    return pj.project_repository(t.d_users, "I-ID", "2016-05-01")


DEPLOYMENT = {"Application Name": "p_name", "Shared Unique ID": "lpad(CAST(p_partkey AS STRING), 8, '0')", "Org unit UID": "p_brand", "Org unit Name": "upper(p_name)",
              "Org unit Teranga code": "CAST(p_size AS STRING)", "Org unit Type": "p_type", "Expected number of users": "CAST(p_size * 10 AS STRING)"}
SOFTWARE = {"Application": "p_name", "Unique ID": "lpad(CAST(p_partkey AS STRING), 8, '0')", "GAPM ID": "p_brand", "ADC Support": "p_type",
            "Application Based on": "lower(p_brand)", "Main Product ?": "CASE WHEN p_size > 25 THEN 'Yes' ELSE 'No' END", "Editor": "p_brand", "Product Name": "upper(p_name)",
            "Product Type": "lower(p_type)", "Product Version": "CAST(p_size AS STRING)", "Product Edition": "concat(p_type, ' edition')"}


def _renamed_sql(columns: dict, names: list[str], identifier: str) -> str:
    shown = [f"ltrim({v}, '0') AS {n}" if c == identifier else f"{v} AS {n}" for (c, v), n in zip(columns.items(), names)]
    return f"SELECT {', '.join(shown)}, '2016-05-01' AS filedate FROM part"


@query("project_org_deployment", _renamed_sql(DEPLOYMENT, list(pj.ORG_DEPLOY), "Shared Unique ID"))
def _(t):
    return pj.project_repository(t.part.selectExpr(*[f"{v} AS `{c}`" for c, v in DEPLOYMENT.items()]), "AIP-OrgDeploy", "2016-05-01")


@query("project_software", _renamed_sql(SOFTWARE, list(pj.SOFTWARE), "Unique ID"))
def _(t):
    return pj.project_repository(t.part.selectExpr(*[f"{v} AS `{c}`" for c, v in SOFTWARE.items()]), "AIP-Software", "2016-05-01")


@query("project_instances", """
SELECT aip_appinstance_name, CASE aip_appinstance_shared_unique_id WHEN '0' THEN '' ELSE aip_appinstance_shared_unique_id END AS aip_appinstance_shared_unique_id,
  aip_appinstance_type, aip_appinstance_hostname, aip_appinstance_ip, aip_appinstance_sector, aip_appinstance_state,
  '2016-05-01' AS filedate FROM d_instance""")
def _(t):
    raw = t.d_instance.select(
        F.col("aip_appinstance_name").alias("Application name"),
        F.concat(F.lit("000"), "aip_appinstance_shared_unique_id").alias("Shared Unique ID"),
        F.col("aip_appinstance_type").alias("Type"), F.upper("aip_appinstance_hostname").alias("Host name"),
        F.col("aip_appinstance_ip").alias("IP address"), F.col("aip_appinstance_sector").alias("Application Sector"),
        F.col("aip_appinstance_state").alias("Application current state"))
    return pj.project_repository(raw, "AIP-SoftInstance", "2016-05-01")


@query("project_positional", """
SELECT con_end AS wr_start_time, con_end AS wr_end_time, source_app_exec AS wr_url, I_ID_D AS wr_device_name,
  CAST(dest_port AS VARCHAR) AS wr_destination_port, dest_ip AS wr_destination_ip, source_app_name AS wr_application_name
FROM d_flows""")
def _(t):
    filler = {2: "con_end", 3: "con_end", 11: "source_app_exec", 17: "I_ID_D", 20: "dest_port", 21: "dest_ip", 24: "source_app_name"}
    raw = t.d_flows.select(*[(F.col(filler[i]).cast("string") if i in filler else F.lit("x")).alias(f"_c{i}") for i in range(1, 25)])
    return pj.pick_positions(raw, pj.RAW_WEBREQUEST)


@query("fill_missing", """
SELECT I_ID_U, source_ip, dt, CAST(dest_port AS INTEGER) AS dest_port, coalesce(source_sector, 'NA') AS source_sector, coalesce(url, 'NA') AS url,
  CAST(con_number AS BIGINT) AS con_number, con_traffic_in, CASE WHEN con_status = 'closed' THEN con_traffic_out ELSE 0 END AS con_traffic_out
FROM d_resolved""")
def _(t):
    from flowloom.operators.aggregates import published_input

    partial = F.when(F.col("con_status") == "closed", F.col("con_traffic_out"))
    return published_input(t.d_resolved.withColumn("con_traffic_out", partial)).select(
        "I_ID_U", "source_ip", "dt", "dest_port", "source_sector", "url", "con_number", "con_traffic_in", "con_traffic_out")


@query("rename_presentation", """
SELECT SiteCode_Source AS "Source.Site", SiteCode_Destination AS "Dest.Site", dest_ip AS "Dest.IP", dest_port AS "Dest.Port",
  con_protocol AS "Dest.Protocol", sum(con_number)::BIGINT AS con_number FROM d_cube GROUP BY ALL""")
def _(t):
    from flowloom.operators.matrix import rename_presentation

    keys = ["SiteCode_Source", "SiteCode_Destination", "dest_ip", "dest_port", "con_protocol"]
    return rename_presentation(t.d_cube.groupBy(*keys).agg(F.sum("con_number").alias("con_number")))


# -- filters -------------------------------------------------------------------------------------------------------


@query("filter_internal_ip", """
SELECT address, count(*) AS n, regexp_matches(address, '10\\.([0-9]+\\.)+[0-9]+') AS loose,
  (regexp_full_match(address, '10\\.[0-9]+\\.[0-9]+\\.[0-9]+')) AS strict
FROM (SELECT CASE WHEN l_returnflag = 'R' THEN concat('1', source_ip) WHEN l_linenumber = 1 THEN '10.1.2' ELSE source_ip END AS address
      FROM d_flows) x GROUP BY ALL""")
def _(t):
    address = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("1"), "source_ip")).when(
        F.col("l_linenumber") == 1, "10.1.2").otherwise(F.col("source_ip"))
    rows = t.d_flows.select(address.alias("address"))
    return rows.groupBy("address", fn.is_internal_ip(F.col("address"), False).alias("loose"),
                        fn.is_internal_ip(F.col("address")).alias("strict")).agg(F.count("*").alias("n"))


@query("filter_status_exclude", "SELECT aip_server_hostname, aip_server_status FROM d_server WHERE aip_server_status = 'Live'")
def _(t):
    return t.d_server.filter(fl.status_allowed("aip_server_status")).select("aip_server_hostname", "aip_server_status")


@query("filter_date_range", """
SELECT dt, month, engine, count(*) AS n FROM d_connection WHERE dt BETWEEN DATE '1997-03-10' AND DATE '1998-02-20' GROUP BY ALL""")
def _(t):
    rows = fl.in_day_window(t.d_connection, "1997-03-10", "1998-02-20")
    return rows.groupBy("dt", "month", "engine").agg(F.count("*").alias("n"))


@query("filter_closed", """
SELECT source_ip, dest_ip, dest_port, con_number, dt FROM d_connection WHERE con_status = 'closed'""")
def _(t):
    return t.d_connection.filter(fl.closed_only()).select("source_ip", "dest_ip", "dest_port", "con_number", "dt")


@query("filter_self_loop", """
SELECT server_ip, dt, name, status, count(*) AS n FROM d_lsof
WHERE status IN ('(ESTABLISHED)', '(TIME-WAIT)', '(SYN-SENT)', '(SYN-RECEIVED)')
  AND split_part(name, ':', 1) <> split_part(split_part(name, '->', 2), ':', 1) GROUP BY ALL""")
def _(t):
    ends = fn.socket_endpoints(F.col("name"))
    rows = t.d_lsof.withColumns({"source_ip": ends["con_local_ip"], "dest_ip": ends["con_foreign_ip"],
                                 "con_status": fn.map_tcp_state(F.col("status"))})
    return rows.filter(fl.usable_flow()).groupBy("server_ip", "dt", "name", "status").agg(F.count("*").alias("n"))


def _by_site(rows):
    return rows.groupBy("SiteCode_Source", "SiteCode_Destination").agg(
        F.count("*").alias("n"), F.sum("con_number").alias("con_number"))


SITE_SQL = """SELECT SiteCode_Source, SiteCode_Destination, count(*) AS n, CAST(sum(con_number) AS BIGINT) AS con_number
FROM {0} WHERE {1} GROUP BY ALL"""


@query("filter_sector", """
SELECT 'device' AS source, source_sector, dest_aip_app_sector, count(*) AS n FROM d_cube
WHERE source_sector IN ('BUILDING', 'MACHINERY') AND dest_aip_app_sector SIMILAR TO '.*(sector1|sector4).*' GROUP BY ALL
UNION ALL
SELECT 'server' AS source, source_aip_app_sector, dest_aip_app_sector, count(*) AS n FROM d_cube
WHERE source_aip_app_sector SIMILAR TO '.*(or2|or3).*' AND dest_aip_app_sector IS NOT NULL GROUP BY ALL""")
def _(t):
    device = t.d_cube.filter(fl.sector_filter("device", ["BUILDING", "MACHINERY"], False, ["sector1", "sector4"]))
    server = t.d_cube.filter(fl.sector_filter("server", ["or2", "or3"], True, (), False))
    return device.groupBy(F.lit("device").alias("source"), "source_sector", "dest_aip_app_sector").agg(F.count("*").alias("n")).unionByName(
        server.groupBy(F.lit("server").alias("source"), F.col("source_aip_app_sector").alias("source_sector"), "dest_aip_app_sector")
        .agg(F.count("*").alias("n")))


@query("filter_site_include", f"""
SELECT 'or' AS operand, x.* FROM ({SITE_SQL.format('d_cube', "SiteCode_Source IN ('S1', 'S2') OR SiteCode_Destination IN ('S3', 'nf')")}) x
UNION ALL
SELECT 'and' AS operand, x.* FROM ({SITE_SQL.format('d_cube', "SiteCode_Source IN ('S1', 'S2') AND SiteCode_Destination IN ('S3', 'nf')")}) x""")
def _(t):
    frames = []
    for operand in ("OR", "AND"):
        test = fl.include_ends("SiteCode_Source", "SiteCode_Destination", ["S1", "S2"], ["S3", "nf"], operand)
        frames.append(_by_site(t.d_cube.filter(test)).withColumn("operand", F.lit(operand.lower())))
    return union_by_name(frames)


@query("filter_site_exclude", SITE_SQL.format("d_cube", "SiteCode_Source NOT IN ('S1', 'S2') AND SiteCode_Destination NOT IN ('S3', 'nf')"))
def _(t):
    return _by_site(t.d_cube.filter(fl.exclude_ends("SiteCode_Source", "SiteCode_Destination", ["S1", "S2"], ["S3", "nf"], "OR")))


COUNTRY_SQL = """SELECT c.SiteCode_Source, c.SiteCode_Destination, count(*) AS n, CAST(sum(con_number) AS BIGINT) AS con_number
FROM d_cube c LEFT JOIN d_sites a ON c.SiteCode_Source = a.SiteCode LEFT JOIN d_sites b ON c.SiteCode_Destination = b.SiteCode
WHERE {0} GROUP BY ALL"""


@query("filter_country_include", COUNTRY_SQL.format("a.CountryCode = 'C1' AND b.CountryCode IN ('C2', 'C3')"))
def _(t):
    rows = lk.lookup_sites_info(t.d_cube, t.d_sites)
    return _by_site(rows.filter(fl.include_ends("CountryCode_Source", "CountryCode_Destination", ["C1"], ["C2", "C3"], "AND")))


@query("filter_country_exclude", COUNTRY_SQL.format(
    "coalesce(a.CountryCode, '') <> 'C1' AND coalesce(b.CountryCode, '') NOT IN ('C2', 'C3')"))
def _(t):
    rows = lk.lookup_sites_info(t.d_cube, t.d_sites)
    return _by_site(rows.filter(fl.exclude_ends("CountryCode_Source", "CountryCode_Destination", ["C1"], ["C2", "C3"])))


@query("filter_inter_intra", f"""
SELECT 'inter' AS kind, x.* FROM ({SITE_SQL.format('d_cube', 'SiteCode_Source <> SiteCode_Destination')}) x
UNION ALL SELECT 'intra' AS kind, x.* FROM ({SITE_SQL.format('d_cube', 'SiteCode_Source = SiteCode_Destination')}) x""")
def _(t):
    inter = _by_site(t.d_cube.filter(fl.inter_intra(True, False))).withColumn("kind", F.lit("inter"))
    return inter.unionByName(_by_site(t.d_cube.filter(fl.inter_intra(False, True))).withColumn("kind", F.lit("intra")))


CATEGORY_IN = "SELECT SiteCode FROM d_categories WHERE SiteScenario = '{0}'"


@query("filter_site_category", f"""
SELECT 'or' AS operand, x.* FROM ({SITE_SQL.format('d_cube',
  f"SiteCode_Source IN ({CATEGORY_IN.format('AFRICA')}) OR SiteCode_Destination IN ({CATEGORY_IN.format('EUROPE')})")}) x
UNION ALL SELECT 'and' AS operand, x.* FROM ({SITE_SQL.format('d_cube',
  f"SiteCode_Source IN ({CATEGORY_IN.format('AFRICA')}) AND SiteCode_Destination IN ({CATEGORY_IN.format('EUROPE')})")}) x""")
def _(t):
    frames = []
    for operand in ("OR", "AND"):
        rows = fl.category_filter(t.d_cube, t.d_categories, ["AFRICA"], ["EUROPE"], operand)
        frames.append(_by_site(rows).withColumn("operand", F.lit(operand.lower())))
    return union_by_name(frames)


@query("filter_ports", """
SELECT 'include' AS mode, con_protocol, dest_port, count(*) AS n FROM d_cube
WHERE (con_protocol = 'tcp' AND dest_port BETWEEN 100 AND 300) OR (con_protocol = 'udp' AND dest_port = 53) GROUP BY ALL
UNION ALL
SELECT 'exclude' AS mode, con_protocol, dest_port, count(*) AS n FROM d_cube
WHERE NOT ((con_protocol = 'tcp' AND dest_port BETWEEN 100 AND 300) OR (con_protocol = 'udp' AND dest_port = 53)) GROUP BY ALL""")
def _(t):
    frames = []
    for mode in ("include", "exclude"):
        rows = t.d_cube.filter(fl.port_filter("tcp/100-300|udp/53|icmp/1", mode))
        frames.append(rows.groupBy(F.lit(mode).alias("mode"), "con_protocol", "dest_port").agg(F.count("*").alias("n")))
    return union_by_name(frames)


@query("filter_application_list", """
SELECT 'include' AS mode, source_aip_app_name, source_app_exec, dest_aip_app_name, count(*) AS n FROM d_cube
WHERE (source_aip_app_name SIMILAR TO '.*(App 1|App 3).*' OR source_app_exec LIKE 'red%') AND dest_aip_app_name LIKE '%App 2%' GROUP BY ALL
UNION ALL
SELECT 'exclude' AS mode, source_aip_app_name, source_app_exec, dest_aip_app_name, count(*) AS n FROM d_cube
WHERE NOT (source_aip_app_name SIMILAR TO '.*(App 1|App 3).*' AND source_app_exec LIKE 'red%') GROUP BY ALL""")
def _(t):
    cube = t.d_cube
    source = {"AIPAppName": ["App 1", "App 3", None], "NX_bin_exec_name": ["^red"], "no_such_column": ["x"]}
    include = fl.application_list_filter(cube.columns, source, "include", "OR", {"aip_app_name": ["App 2"]})
    exclude = fl.application_list_filter(cube.columns, source, "exclude", "OR")
    frames = [cube.filter(test).groupBy(F.lit(mode).alias("mode"), "source_aip_app_name", "source_app_exec", "dest_aip_app_name")
              .agg(F.count("*").alias("n")) for mode, test in (("include", include), ("exclude", exclude))]
    return union_by_name(frames)


@query("having_engine_count", """
SELECT collecttype, dt, count(DISTINCT engine) AS engine_count FROM d_ledger WHERE stage = 'pipe4to5' AND collecttype = 'device'
GROUP BY ALL HAVING count(DISTINCT engine) >= 4""")
def _(t):
    from flowloom.operators.aggregates import valid_days

    units = lg.earliest_files(t.stored("d_ledger"), lg.AGGREGATE)
    return valid_days(units, "device", 4).select(F.lit("device").alias("collecttype"), "dt", "engine_count")


# The day and event type of an event are the unit; its hour is the hour of delivery.
UNITS_SQL = """SELECT event_type AS engine, CAST(ts AS DATE) AS dt, 'device' AS collecttype, 'f1' AS filedt,
  CAST(extract(hour FROM ts) AS INTEGER) AS hour, event_id FROM events
  WHERE NOT (event_type = 'signup' AND extract(hour FROM ts) >= 22)"""


@query("hour_coverage", f"""
SELECT collecttype, engine, dt, filedt, min(hour) AS min_hour, max(hour) AS max_hour FROM ({UNITS_SQL}) x GROUP BY ALL""")
def _(t):
    return lg.hour_coverage(t.sql(UNITS_SQL), F.col("hour"))


@query("filter_complete_days", f"""
SELECT collecttype, engine, dt, filedt, min(hour) AS min_hour, max(hour) AS max_hour FROM ({UNITS_SQL}) x GROUP BY ALL
HAVING min(hour) <= 3 AND max(hour) >= 23""")
def _(t):
    return lg.complete_units(lg.hour_coverage(t.sql(UNITS_SQL), F.col("hour")))


@query("semi_complete_days", f"""
SELECT * FROM ({UNITS_SQL}) x WHERE (engine, dt) IN
  (SELECT (engine, dt) FROM ({UNITS_SQL}) y GROUP BY engine, dt HAVING min(hour) <= 3 AND max(hour) >= 23)""")
def _(t):
    return lg.complete_rows(t.sql(UNITS_SQL), F.col("hour")).select("engine", "dt", "collecttype", "filedt", "hour", "event_id")


# -- ledger --------------------------------------------------------------------------------------------------------


@query("ledger_min_file", """
SELECT filetype, collecttype, engine, dt, min(filedt) AS min_filedt FROM d_ledger WHERE stage = 'pipe2to3' GROUP BY ALL""")
def _(t):
    return lg.earliest_files(t.stored("d_ledger"), lg.ENCODE)


@query("delta_earliest_file", """
SELECT c.I_ID_U, c.engine, c.dt, c.filedt, c.con_end, c.con_number FROM d_connection c
LEFT JOIN d_ledger_before b ON c.engine = b.engine AND c.dt = b.dt AND c.collecttype = b.collecttype
WHERE b.filedt IS NULL OR b.filedt > c.filedt""")
def _(t):
    return lg.new_rows(t.d_connection, t.stored("d_ledger_before"), "connection").select(
        "I_ID_U", "engine", "dt", "filedt", "con_end", "con_number")


PENDING_SQL = """
SELECT filetype, collecttype, engine, dt, min(filedt) AS min_filedt FROM d_ledger
WHERE stage = '{0}' AND filetype = '{1}' GROUP BY ALL
EXCEPT SELECT filetype, collecttype, engine, dt, min(filedt) FROM d_ledger WHERE stage = '{2}' GROUP BY ALL"""


@query("ledger_delta_connection", PENDING_SQL.format("pipe2to3", "connection", "pipe3to4"))
def _(t):
    return lg.pending(t.stored("d_ledger"), lg.ENCODE, lg.RESOLVE, "connection")


@query("ledger_semi_webrequest", f"""
SELECT * FROM ({PENDING_SQL.format('pipe2to3', 'connection', 'pipe3to4')}) x WHERE (engine, min_filedt) IN
  (SELECT (engine, min_filedt) FROM (SELECT engine, min(filedt) AS min_filedt FROM d_ledger
   WHERE stage = 'pipe2to3' AND filetype = 'webrequest' GROUP BY collecttype, engine, dt) y)""")
def _(t):
    return lg.pending_connections(t.stored("d_ledger"))


@query("ledger_delta_execution", PENDING_SQL.format("pipe2to3", "execution", "pipe3to4_Exec"))
def _(t):
    return lg.pending_executions(t.stored("d_ledger"))


@query("ledger_delta_aggregate", PENDING_SQL.format("pipe3to4", "connection", "pipe4to5"))
def _(t):
    return lg.pending_aggregates(t.stored("d_ledger"))


@query("select_by_ledger", f"""
SELECT c.I_ID_U, c.engine, c.dt, c.filedt, c.con_end, c.con_number FROM d_connection c
JOIN ({PENDING_SQL.format('pipe3to4', 'connection', 'pipe4to5')}) u
  ON c.collecttype = u.collecttype AND c.engine = u.engine AND c.dt = u.dt AND c.filedt = u.min_filedt
WHERE c.dt BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""")
def _(t):
    units = lg.pending_aggregates(t.stored("d_ledger"))
    return lg.rows_of_units(t.d_connection, units, "1997-01-01", "1998-12-31").select(
        "I_ID_U", "engine", "dt", "filedt", "con_end", "con_number")


SOCKET_PENDING_SQL = """SELECT filetype, server_ip, dt FROM d_socket_ledger WHERE stage = '{0}'
EXCEPT SELECT filetype, server_ip, dt FROM d_socket_ledger WHERE stage = '{1}'"""


@query("ledger_delta_sockets", f"""
SELECT 'resolve' AS step, x.* FROM ({SOCKET_PENDING_SQL.format('encodesockets', 'resolvesockets')}) x
UNION ALL SELECT 'aggregate' AS step, x.* FROM ({SOCKET_PENDING_SQL.format('resolvesockets', 'aggregatesockets')}) x""")
def _(t):
    resolve = lg.pending_sockets(t.stored("d_socket_ledger"))
    aggregate = lg.pending_sockets(t.stored("d_socket_ledger"), lg.RESOLVE_SOCKETS, lg.AGGREGATE_SOCKETS)
    return union_by_name([resolve.withColumn("step", F.lit("resolve")), aggregate.withColumn("step", F.lit("aggregate"))])


@query("delta_sockets", """
SELECT server_ip, dt, pid, name, status FROM d_lsof WHERE dt >= '1998-06-01'""")
def _(t):
    before = t.stored("d_socket_ledger").filter((F.col("stage") == lg.RESOLVE_SOCKETS)).withColumn("stage", F.lit(lg.ENCODE_SOCKETS))
    return lg.new_snapshots(t.d_lsof, before, "lsof").select("server_ip", "dt", "pid", "name", "status")


@query("distinct_units", """
SELECT DISTINCT 'connection' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt, filedt FROM d_connection""")
def _(t):
    return lg.ledger_entries(t.d_connection, "connection", lg.ENCODE)


@query("ledger_rebuild", """
SELECT DISTINCT 'connection' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt, filedt FROM d_connection
UNION ALL SELECT DISTINCT 'webrequest', 'pipe2to3', collecttype, engine, dt, filedt FROM d_webrequest
UNION ALL SELECT DISTINCT 'execution', 'pipe3to4_Exec', collecttype, engine, dt, filedt FROM d_connection
UNION ALL SELECT DISTINCT 'connection', 'pipe4to5', collecttype, engine, dt, filedt FROM d_resolved""")
def _(t):
    return lg.rebuild([
        (t.d_connection, "connection", lg.ENCODE), (t.d_webrequest, "webrequest", lg.ENCODE),
        (t.d_connection, "execution", lg.RESOLVE_EXECUTION), (t.d_resolved, "connection", lg.AGGREGATE)])


@query("ledger_rebuild_sockets", """
SELECT DISTINCT 'lsof' AS filetype, 'encodesockets' AS stage, server_ip, dt FROM d_lsof
UNION ALL SELECT DISTINCT 'ps', 'resolvesockets', server_ip, dt FROM d_ps""")
def _(t):
    return lg.rebuild_sockets([(t.d_lsof, "lsof", lg.ENCODE_SOCKETS), (t.d_ps, "ps", lg.RESOLVE_SOCKETS)])


# -- lookups -------------------------------------------------------------------------------------------------------

IP_NUMBER = """(CAST(split_part({0}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({0}, '.', 2) AS BIGINT) * 65536
 + CAST(split_part({0}, '.', 3) AS BIGINT) * 256 + CAST(split_part({0}, '.', 4) AS BIGINT))"""

# Site of every address that occurs, by plain range comparison over the distinct addresses.
ADDRESS_SITES = f"""address_site AS (
  SELECT ip, string_agg(DISTINCT mdm_loc_code, '_' ORDER BY mdm_loc_code) AS site
  FROM (SELECT DISTINCT source_ip AS ip, {IP_NUMBER.format('source_ip')} AS num FROM d_flows
        UNION SELECT DISTINCT dest_ip, {IP_NUMBER.format('dest_ip')} FROM d_flows) a
  JOIN d_mdm ON num > mdm_ip_start_int AND num < mdm_ip_end_int GROUP BY ip)"""


@query("ip_range_join", f"""
WITH {ADDRESS_SITES}
SELECT f.I_ID_U, f.source_ip, f.dest_ip, f.con_end, f.con_number, coalesce(a.site, 'nf') AS source_site, coalesce(b.site, 'nf') AS dest_site
FROM d_connection f LEFT JOIN address_site a ON f.source_ip = a.ip LEFT JOIN address_site b ON f.dest_ip = b.ip""")
def _(t):
    rows = t.d_connection.select("I_ID_U", "source_ip", "dest_ip", "con_end", "con_number")
    return lk.resolve_sites(rows, site_lookup(t.d_mdm), {"source_ip": "source_site", "dest_ip": "dest_site"})


@query("ip_explode_lookup", """
SELECT site, count(*) AS addresses, min(ip) AS first_ip, max(ip) AS last_ip, CAST(sum(ip) AS BIGINT) AS ip_sum FROM (
  SELECT ip, string_agg(DISTINCT mdm_loc_code, '_' ORDER BY mdm_loc_code) AS site
  FROM (SELECT mdm_loc_code, unnest(range(mdm_ip_start_int + 1, mdm_ip_end_int)) AS ip FROM d_mdm) x GROUP BY ip) y GROUP BY site""")
def _(t):
    # One row per address is the operator; the result is summed up per site to keep it short.
    ip = F.col("mdm_ip")
    return lk.explode_ranges(t.d_mdm).groupBy("site").agg(
        F.count("*").alias("addresses"), F.min(ip).alias("first_ip"), F.max(ip).alias("last_ip"), F.sum(ip).alias("ip_sum"))


@query("lookup_user", """
SELECT c.I_ID_U, c.con_end, c.con_number, u.Sector AS source_sector, CASE WHEN coalesce(u.SiteCode, '') = '' THEN 'nf' ELSE u.SiteCode END AS source_I_ID_site,
  u.TerangaCode AS source_teranga FROM d_connection c LEFT JOIN d_users u ON c.I_ID_U = u.I_ID""")
def _(t):
    return lk.resolve_users(t.d_connection.select("I_ID_U", "con_end", "con_number"), t.d_users)


@query("lookup_asset", """
SELECT f.source_ip, f.dest_ip, f.con_end, f.con_number,
  CASE WHEN dest_site = 'nf' THEN CASE WHEN coalesce(d.aip_server_site, '') = '' THEN 'nf' ELSE d.aip_server_site END ELSE dest_site END AS dest_site,
  source_site, d.aip_server_hostname AS dest_aip_server_hostname, d.aip_app_name AS dest_aip_app_name, d.aip_app_sector AS dest_aip_app_sector,
  d.aip_app_shared_unique_id AS dest_aip_app_shared_unique_id, s.aip_server_hostname AS source_aip_server_hostname, s.aip_app_name AS source_aip_app_name
FROM (SELECT *, CASE WHEN s_nationkey >= 10 THEN 'nf' ELSE 'S1' END AS dest_site, 'S2' AS source_site FROM d_flows) f
LEFT JOIN d_aip d ON f.dest_ip = d.aip_server_ip LEFT JOIN d_aip s ON f.source_ip = s.aip_server_ip""")
def _(t):
    rows = t.d_flows.select("source_ip", "dest_ip", "con_end", "con_number",
                            F.when(F.col("s_nationkey") >= 10, "nf").otherwise("S1").alias("dest_site"), F.lit("S2").alias("source_site"))
    return lk.resolve_assets(rows, t.d_aip).select(
        "source_ip", "dest_ip", "con_end", "con_number", "dest_site", "source_site", "dest_aip_server_hostname", "dest_aip_app_name",
        "dest_aip_app_sector", "dest_aip_app_shared_unique_id", "source_aip_server_hostname", "source_aip_app_name")


URLS_SQL = """SELECT collecttype, dt, engine, filedt, I_ID_D, source_app_name, dest_ip, dest_port,
  string_agg(DISTINCT url, '|' ORDER BY url) AS url FROM d_webrequest GROUP BY ALL"""


@query("agg_concat_distinct", URLS_SQL)
def _(t):
    return lk.urls_by_connection(t.d_webrequest)


@query("join_urls", f"""
SELECT c.I_ID_U, c.I_ID_D, c.engine, c.dt, c.filedt, c.dest_ip, c.dest_port, c.con_end, c.con_number, w.url
FROM d_connection c LEFT JOIN ({URLS_SQL}) w USING (collecttype, dt, engine, filedt, I_ID_D, source_app_name, dest_ip, dest_port)""")
def _(t):
    return lk.join_urls(t.d_connection, t.d_webrequest).select(
        "I_ID_U", "I_ID_D", "engine", "dt", "filedt", "dest_ip", "dest_port", "con_end", "con_number", "url")


@query("lookup_asset_site", """
SELECT f.dest_ip, count(*) AS n, a.site FROM d_flows f
LEFT JOIN (SELECT aip_server_ip, min(aip_server_site) AS site FROM d_server WHERE aip_server_site <> '' GROUP BY ALL) a
  ON f.dest_ip = a.aip_server_ip GROUP BY ALL""")
def _(t):
    return lk.lookup_asset_site(t.d_flows.select("dest_ip"), t.d_server, "dest_ip").groupBy("dest_ip", "site").agg(F.count("*").alias("n"))


@query("lookup_country", """
SELECT c.SiteCode_Source, c.SiteCode_Destination, a.CountryCode AS CountryCode_Source, a.SiteName AS SiteName_Source,
  b.CountryCode AS CountryCode_Destination, b.SiteName AS SiteName_Destination, count(*) AS n
FROM d_cube c LEFT JOIN d_sites a ON c.SiteCode_Source = a.SiteCode LEFT JOIN d_sites b ON c.SiteCode_Destination = b.SiteCode GROUP BY ALL""")
def _(t):
    rows = lk.lookup_sites_info(t.d_cube.select("SiteCode_Source", "SiteCode_Destination"), t.d_sites)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query("lookup_category", """
SELECT c.SiteCode_Source, c.SiteCode_Destination, a.SiteScenario AS SiteCategory_Source, b.SiteScenario AS SiteCategory_Destination, count(*) AS n
FROM d_cube c LEFT JOIN d_categories a ON c.SiteCode_Source = a.SiteCode LEFT JOIN d_categories b ON c.SiteCode_Destination = b.SiteCode GROUP BY ALL""")
def _(t):
    rows = lk.lookup_categories(t.d_cube.select("SiteCode_Source", "SiteCode_Destination"), t.d_categories)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


FUSED_SQL = """SELECT aip_appgf_shared_unique_id, string_agg(DISTINCT aip_appgf_grid_app_name, ',' ORDER BY aip_appgf_grid_app_name) AS aip_appgf_grid_app_name,
  string_agg(DISTINCT aip_appgf_billing_code, ',' ORDER BY aip_appgf_billing_code) AS aip_appgf_billing_code FROM d_gridfusion GROUP BY ALL"""
STAR_SQL = f"""SELECT s.*, i.*, a.*, g.* FROM (SELECT * FROM d_server WHERE aip_server_status NOT IN ('Disposed', 'Standby', 'Stock', 'Disposal')) s
LEFT JOIN d_instance i ON s.aip_server_hostname = i.aip_appinstance_hostname
LEFT JOIN d_application a ON i.aip_appinstance_shared_unique_id = a.aip_app_shared_unique_id
LEFT JOIN ({FUSED_SQL}) g ON a.aip_app_shared_unique_id = g.aip_appgf_shared_unique_id"""


@query("asset_star", f"""
SELECT aip_server_hostname, aip_server_ip, aip_appinstance_name, aip_appinstance_sector, aip_app_name, aip_app_type,
  aip_appgf_grid_app_name, aip_appgf_billing_code FROM ({STAR_SQL}) x""")
def _(t):
    star = lk.asset_star(t.d_server, t.d_instance, t.d_application, t.d_gridfusion)
    # The application name of the star is that of the instance; both repositories use the same one here.
    return star.select("aip_server_hostname", "aip_server_ip", F.col("v_aip_app_name").alias("aip_appinstance_name"),
                       F.col("v_aip_appinstance_sector").alias("aip_appinstance_sector"),
                       F.when(F.col("v_aip_app_type").isNotNull(), F.col("v_aip_app_name")).alias("aip_app_name"),
                       F.col("v_aip_app_type").alias("aip_app_type"),
                       F.col("v_aip_appgf_grid_app_name").alias("aip_appgf_grid_app_name"),
                       F.col("v_aip_appgf_billing_code").alias("aip_appgf_billing_code"))


def _concat_all(source: str, name: str) -> str:
    return f"coalesce(string_agg(nullif({source}, ''), '||' ORDER BY nullif({source}, '')), '') AS {name}"


ROLLUP_COLUMNS = {"aip_app_name": "aip_appinstance_name", "aip_app_type": "aip_app_type", "aip_app_sector": "aip_app_sector",
                  "aip_appinstance_sector": "aip_appinstance_sector", "aip_appgf_billing_code": "aip_appgf_billing_code",
                  "aip_app_shared_unique_id": "aip_appinstance_shared_unique_id"}
ROLLUP_SQL = f"""SELECT aip_server_ip, aip_server_hostname, aip_server_site, {', '.join(_concat_all(s, n) for n, s in ROLLUP_COLUMNS.items())},
  max(filedate) AS filedate FROM ({STAR_SQL}) x GROUP BY aip_server_ip, aip_server_hostname, aip_server_site"""
ROLLUP_SHOWN = ["aip_server_ip", "aip_server_hostname", "aip_server_site", *ROLLUP_COLUMNS, "filedate"]


@query("asset_rollup", ROLLUP_SQL)
def _(t):
    return lk.asset_rollup(lk.asset_star(t.d_server, t.d_instance, t.d_application, t.d_gridfusion)).select(*ROLLUP_SHOWN)


@query("agg_concat_all", f"""
SELECT s_nationkey, {_concat_all('function', 'functions')}, count(*) AS n
FROM (SELECT s_nationkey, CASE WHEN s_acctbal < 0 THEN '' WHEN s_acctbal > 9000 THEN NULL ELSE concat('f', CAST(s_suppkey % 3 AS VARCHAR)) END AS function
      FROM supplier) x GROUP BY ALL""")
def _(t):
    function = F.when(F.col("s_acctbal") < 0, "").when(F.col("s_acctbal") <= 9000, F.concat(F.lit("f"), (F.col("s_suppkey") % 3).cast("string")))
    return t.supplier.groupBy("s_nationkey").agg(lk.concat_all(function).alias("functions"), F.count("*").alias("n"))


@query("dedupe_best_row", f"""
SELECT * FROM ({ROLLUP_SQL}) r WHERE aip_server_ip LIKE '10.%'
QUALIFY row_number() OVER (PARTITION BY aip_server_ip ORDER BY aip_app_name DESC, aip_server_hostname DESC) = 1""")
def _(t):
    return lk.assets_by_ip(lk.asset_star(t.d_server, t.d_instance, t.d_application, t.d_gridfusion)).select(*ROLLUP_SHOWN)


@query("dedupe_best_row_multi", f"""
SELECT aip_server_ip, aip_appinstance_name AS aip_app_name, max(aip_server_hostname) AS aip_server_hostname
FROM ({STAR_SQL}) x WHERE aip_server_ip LIKE '10.%' GROUP BY ALL""")
def _(t):
    star = lk.asset_star(t.d_server, t.d_instance, t.d_application, t.d_gridfusion)
    return lk.assets_by_ip_and_app(star).select("aip_server_ip", "aip_app_name", "aip_server_hostname")


# -- sockets -------------------------------------------------------------------------------------------------------

PS_SQL = "SELECT dt, server_ip, pid, min(command) AS command_detail FROM d_ps GROUP BY ALL"
JOINED_SQL = f"SELECT l.*, p.command_detail FROM d_lsof l LEFT JOIN ({PS_SQL}) p USING (dt, server_ip, pid)"
ENDS_SQL = f"""SELECT *, split_part(name, ':', 1) AS lip, split_part(split_part(name, '->', 1), ':', 2) AS lport,
  split_part(split_part(name, '->', 2), ':', 1) AS fip, split_part(split_part(name, '->', 2), ':', 2) AS fport
FROM ({JOINED_SQL}) j WHERE status NOT IN ('(LISTEN)', '')"""
LISTEN_SQL = "SELECT DISTINCT dt, server_ip, split_part(name, ':', 2) AS lport, true AS serves FROM d_lsof WHERE status = '(LISTEN)'"
DIRECTED_SQL = f"""SELECT * FROM (SELECT e.dt, e.server_ip, e.pid, e.status, e.node, CASE WHEN serves THEN fip ELSE lip END AS source_ip,
  CASE WHEN serves THEN lip ELSE fip END AS dest_ip, CASE WHEN serves THEN e.lport ELSE fport END AS dest_port,
  CASE WHEN serves THEN NULL ELSE command END AS source_app_exec, CASE WHEN serves THEN NULL ELSE command_detail END AS source_app_paths
FROM ({ENDS_SQL}) e LEFT JOIN ({LISTEN_SQL}) l ON e.dt = l.dt AND e.server_ip = l.server_ip AND e.lport = l.lport) d
WHERE source_ip <> dest_ip"""


@query("join_socket_process", JOINED_SQL)
def _(t):
    return sk.join_process(t.d_lsof, t.d_ps)


@query("infer_direction", DIRECTED_SQL)
def _(t):
    return sk.infer_direction(sk.join_process(t.d_lsof, t.d_ps)).select(
        "dt", "server_ip", "pid", "status", "node", "source_ip", "dest_ip", "dest_port", "source_app_exec", "source_app_paths")


@query("project_socket_flow", f"""
SELECT 'NA' AS I_ID_U, 'NA' AS I_ID_D, 'NA' AS con_start, dt AS con_end, CAST(NULL AS INTEGER) AS con_duration, 1 AS con_number, dest_ip,
  CAST(NULL AS BIGINT) AS con_traffic_out, CAST(NULL AS BIGINT) AS con_traffic_in, node AS con_protocol,
  CASE status WHEN '(SYN-SENT)' THEN 'SYN-SENT' WHEN '(SYN-RECEIVED)' THEN 'RECEIVED' ELSE 'closed' END AS con_status,
  CAST(dest_port AS INTEGER) AS dest_port, 'NA' AS source_app_category, 'NA' AS source_app_company, 'NA' AS source_app_name,
  source_app_exec, source_app_paths, 'NA' AS source_app_version, source_ip, server_ip AS engine, 'NA' AS filedt, 'linux' AS collecttype,
  CAST(substr(dt, 1, 10) AS DATE) AS dt, 'NA' AS source_sector, 'NA' AS source_I_ID_site, 'NA' AS url, substr(dt, 1, 7) AS month,
  dt AS snapshot FROM ({DIRECTED_SQL}) x WHERE status <> '(BOUND)'""")
def _(t):
    return sk.socket_flows(sk.infer_direction(sk.join_process(t.d_lsof, t.d_ps)))


SERVICE_SQL = """
WITH lis AS (SELECT DISTINCT dt, server_ip, pid, command, lower(node) AS protocol, split_part(name, ':', 1) AS address,
    CAST(split_part(name, ':', 2) AS INTEGER) AS port FROM d_lsof WHERE status = '(LISTEN)'),
par AS (SELECT dt, server_ip, pid, arg_max(ppid, command || '|' || ppid) AS ppid, min(command) AS cmd FROM d_ps GROUP BY ALL),
own AS (SELECT l.*, p.ppid, p.cmd FROM lis l LEFT JOIN par p USING (dt, server_ip, pid)),
fold AS (SELECT o.*, EXISTS (SELECT 1 FROM lis h WHERE h.dt = o.dt AND h.server_ip = o.server_ip AND h.protocol = o.protocol
    AND h.port = o.port AND h.pid = o.ppid) AS child FROM own o),
kids AS (SELECT dt, server_ip, ppid AS pid, string_agg(DISTINCT pid, ',' ORDER BY pid) AS children FROM fold WHERE child
    GROUP BY dt, server_ip, ppid),
hosts AS (SELECT DISTINCT concat('10.200.', CAST(s_nationkey AS VARCHAR), '.', CAST(1 + s_suppkey % 250 AS VARCHAR)) AS server_ip FROM supplier),
svc AS (SELECT f.dt, f.server_ip, pid, min(lpad(CAST(port AS VARCHAR), 6, '0') || '|' || protocol || '|' || command) AS best, min(cmd) AS cmd,
    string_agg(DISTINCT concat(server_ip, ':', CAST(port AS VARCHAR), '_', protocol), ',' ORDER BY concat(server_ip, ':', CAST(port AS VARCHAR), '_', protocol)) AS ports
  FROM fold f JOIN hosts USING (server_ip) WHERE NOT child GROUP BY ALL)
SELECT s.dt, s.server_ip, s.pid, concat(split_part(best, '|', 3), '-', CAST(CAST(split_part(best, '|', 1) AS INTEGER) AS VARCHAR), '_', split_part(best, '|', 2)) AS service,
  CAST(split_part(best, '|', 1) AS INTEGER) AS port, cmd, ports, coalesce(children, '') AS children
FROM svc s LEFT JOIN kids k USING (dt, server_ip, pid)"""


@query("service_inventory", SERVICE_SQL)
def _(t):
    hosts = t.d_lsof.select("server_ip", F.col("server_ip").alias("host_ip")).distinct()
    return sk.service_inventory(t.d_lsof, t.d_ps, hosts)


@query("filter_list_large", """
WITH l AS (SELECT l_quantity, coalesce((l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R'), false)
  OR l_linenumber = 1 OR l_linestatus = 'F' AS hit FROM lineitem)
SELECT CASE WHEN hit THEN 'include' ELSE 'exclude' END AS mode, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM l GROUP BY 1""")
def _(t):
    """A list with a pattern for every order and every returned line, inside, at the start or at the end of the value, and one expression."""
    line = F.concat("l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"))
    rows = t.lineitem.select(F.concat(F.lit("job-"), line, "l_linestatus").alias("job"), "l_quantity")
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.concat(F.lit("-"), line).alias("pattern"))
    firsts = t.lineitem.select(F.concat(F.lit("^job-"), "l_orderkey", F.lit("-1-")).alias("pattern"))
    absent = t.lineitem.select(F.concat(F.lit("-none"), line, F.lit("$")).alias("pattern"))
    one = t.spark.createDataFrame([("-(F|NONE)$",), (None,), ("",)], "pattern string")
    patterns = returned.unionByName(firsts).unionByName(absent).unionByName(one)
    return union_by_name([fl.filter_by_list(rows, "job", patterns, mode).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))
                          .withColumn("mode", F.lit(mode)) for mode in ("include", "exclude")])


@query("project_pass_through", "SELECT * FROM customer")
def _(t):
    """An event type without a projection of its own is stored as it comes."""
    return pj.project_event(t.customer, "inventory", [])


CONNECTION_SQL = f"""SELECT * FROM (
WITH RECURSIVE svc AS (SELECT dt, server_ip, pid, service FROM ({SERVICE_SQL}) x),
par AS (SELECT dt, server_ip, pid, arg_max(ppid, command || '|' || ppid) AS ppid FROM d_ps GROUP BY ALL),
up AS (SELECT dt, server_ip, pid, pid AS reached, 0 AS n FROM (SELECT dt, server_ip, pid FROM par UNION SELECT dt, server_ip, pid FROM svc) b
  UNION ALL SELECT u.dt, u.server_ip, u.pid, p.ppid, n + 1 FROM up u JOIN par p ON p.dt = u.dt AND p.server_ip = u.server_ip AND p.pid = u.reached
  WHERE n < 60 AND NOT EXISTS (SELECT 1 FROM svc s WHERE s.dt = u.dt AND s.server_ip = u.server_ip AND s.pid = u.reached)),
owner AS (SELECT u.dt, u.server_ip, u.pid, s.service FROM up u JOIN svc s ON s.dt = u.dt AND s.server_ip = u.server_ip AND s.pid = u.reached),
port AS (SELECT dt, server_ip, protocol, port, concat(command, '-', CAST(port AS VARCHAR), '_', protocol) AS service FROM (
  SELECT dt, server_ip, lower(node) AS protocol, CAST(split_part(name, ':', 2) AS INTEGER) AS port, min(command) AS command
  FROM d_lsof WHERE status = '(LISTEN)' GROUP BY ALL) q),
ends AS (SELECT dt, server_ip, pid, lower(node) AS protocol, split_part(split_part(name, '->', 1), ':', 1) AS lip,
    CAST(split_part(split_part(name, '->', 1), ':', 2) AS INTEGER) AS lport, split_part(split_part(name, '->', 2), ':', 1) AS fip,
    CAST(split_part(split_part(name, '->', 2), ':', 2) AS INTEGER) AS fport FROM d_lsof WHERE strpos(name, '->') > 0),
joined AS (SELECT e.*, l.service AS ls, CASE WHEN e.lip = e.fip THEN f.service END AS fs, o.service AS os FROM ends e
  LEFT JOIN port l ON l.dt = e.dt AND l.server_ip = e.server_ip AND l.protocol = e.protocol AND l.port = e.lport AND e.lip = e.server_ip
  LEFT JOIN port f ON f.dt = e.dt AND f.server_ip = e.server_ip AND f.protocol = e.protocol AND f.port = e.fport AND e.fip = e.server_ip
  LEFT JOIN owner o ON o.dt = e.dt AND o.server_ip = e.server_ip AND o.pid = e.pid)
SELECT dt, server_ip, CASE WHEN ls IS NULL THEN lip ELSE fip END AS from_ip, CASE WHEN ls IS NULL THEN fip ELSE lip END AS to_ip,
  CASE WHEN ls IS NULL THEN fport ELSE lport END AS to_port, min(CASE WHEN ls IS NULL THEN fs ELSE ls END) AS to_service,
  min(CASE WHEN ls IS NULL THEN os ELSE fs END) AS from_service
FROM joined GROUP BY 1, 2, 3, 4, 5) z"""


@query("service_connections", CONNECTION_SQL)
def _(t):
    sockets = t.stored("d_lsof")
    hosts = sockets.select("server_ip", F.col("server_ip").alias("host_ip")).distinct()
    return sk.service_connections(sockets, t.stored("d_ps"), hosts)
