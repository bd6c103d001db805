"""Domain-shaped inputs derived from the given tables.

Each text is plain SQL that Spark and DuckDB both run, so a query and its
check start from the same rows. Names start with ``d_``; a text may read
other derived names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from flowloom.session import cut_lineage

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

STORED = {"d_units"}  # derived tables that several parts of a query read: written once

DERIVED: dict[str, str] = {}

# One row per line item, seen as a connection from a customer device to a supplier server.
DERIVED["d_flows"] = """
SELECT
  concat('U', CAST(o.o_custkey AS STRING)) AS I_ID_U,
  concat('D', CAST(o.o_custkey % 997 AS STRING)) AS I_ID_D,
  concat('10.', CAST(c.c_nationkey AS STRING), '.', CAST(o.o_custkey % 250 AS STRING), '.',
         CAST(1 + o.o_custkey % 250 AS STRING)) AS source_ip,
  concat('10.200.', CAST(s.s_nationkey AS STRING), '.', CAST(1 + l.l_suppkey % 250 AS STRING)) AS dest_ip,
  CAST(l.l_partkey % 1024 AS INT) AS dest_port,
  CASE WHEN l.l_linenumber = 4 THEN 'udp' ELSE 'tcp' END AS con_protocol,
  CASE WHEN l.l_returnflag = 'R' THEN 'rejected' ELSE 'closed' END AS con_status,
  CAST(l.l_quantity AS INT) AS con_number,
  CAST(floor(l.l_extendedprice) AS BIGINT) AS con_traffic_in,
  CAST(floor(l.l_extendedprice * l.l_discount) AS BIGINT) AS con_traffic_out,
  CAST(l.l_partkey % 600 AS INT) AS con_duration,
  CASE WHEN o.o_orderstatus = 'P' THEN concat('srv-engine-', CAST(1 + o.o_custkey % 3 AS STRING))
       ELSE concat('dev-engine-', CAST(o.o_custkey % 5 AS STRING)) END AS engine,
  CASE WHEN o.o_orderstatus = 'P' THEN 'server' ELSE 'device' END AS collecttype,
  CAST(l.l_shipdate AS DATE) AS dt,
  substr(CAST(CAST(l.l_shipdate AS DATE) AS STRING), 1, 7) AS month,
  concat(replace(CAST(CAST(l.l_shipdate AS DATE) AS STRING), '-', ''),
         CASE WHEN l.l_linestatus = 'O' THEN '-b' ELSE '-a' END) AS filedt,
  concat(CAST(CAST(l.l_shipdate AS DATE) AS STRING), 'T',
         lpad(CAST((l.l_orderkey + l.l_linenumber * 5) % 24 AS STRING), 2, '0'), ':',
         lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0'), ':00') AS con_end,
  p.p_brand AS source_app_name, p.p_type AS source_app_category,
  concat(replace(p.p_name, ' ', '-'), '.exe') AS source_app_exec,
  c.c_mktsegment, c.c_nationkey, s.s_nationkey, l.l_suppkey, l.l_partkey, l.l_orderkey, l.l_linenumber,
  l.l_returnflag, l.l_linestatus, o.o_custkey, o.o_orderpriority, p.p_size
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

# The raw connection extract: every column text.
DERIVED["d_raw_connection"] = """
SELECT I_ID_D, I_ID_U, con_end AS NX_con_start_time, con_end AS NX_con_end_time,
  CASE WHEN con_duration = 0 THEN 'unknown' ELSE CAST(con_duration AS STRING) END AS NX_con_duration,
  CAST(con_number AS STRING) AS NX_con_cardinality, dest_ip AS NX_con_destination_ip,
  CAST(con_traffic_out AS STRING) AS NX_con_out_traffic, CAST(con_traffic_in AS STRING) AS NX_con_in_traffic,
  con_protocol AS NX_con_type, con_status AS NX_con_status, CAST(dest_port AS STRING) AS NX_con_port,
  source_app_category AS NX_bin_app_category, 'maker' AS NX_bin_app_company, source_app_name AS NX_bin_app_name,
  source_app_exec AS NX_bin_exec_name, concat('/opt/', source_app_exec) AS NX_bin_paths,
  CAST(p_size AS STRING) AS NX_bin_version, source_ip AS NX_device_last_ip, engine, filedt
FROM d_flows
"""

DERIVED["d_connection"] = """
SELECT I_ID_D, I_ID_U, con_end AS con_start, con_end,
  CASE WHEN con_duration = 0 THEN -1 ELSE con_duration END AS con_duration, con_number, dest_ip,
  con_traffic_out, con_traffic_in, con_protocol, con_status, dest_port, source_app_category,
  'maker' AS source_app_company, source_app_name, source_app_exec, concat('/opt/', source_app_exec) AS source_app_paths,
  CAST(p_size AS STRING) AS source_app_version, source_ip, engine, filedt, collecttype, dt, month
FROM d_flows
"""

# Web requests: one URL for every connection of an open line, so some connections have several and some none.
DERIVED["d_raw_webrequest"] = """
SELECT I_ID_D, con_end AS wr_start_time, con_end AS wr_end_time,
  concat('http://', source_app_name, '/', CAST(l_linenumber AS STRING)) AS wr_url,
  CAST(dest_port AS STRING) AS wr_destination_port, dest_ip AS wr_destination_ip,
  source_app_name AS wr_application_name, engine, filedt
FROM d_flows WHERE l_linestatus = 'O'
"""

DERIVED["d_webrequest"] = """
SELECT I_ID_D, con_end AS "start", con_end AS "end",
  concat('http://', source_app_name, '/', CAST(l_linenumber AS STRING)) AS url, dest_port, dest_ip,
  source_app_name, engine, filedt, collecttype, dt, month
FROM d_flows WHERE l_linestatus = 'O'
"""

# Program executions; the return flag decides which of the three extract widths a row arrives in.
DERIVED["d_raw_execution"] = """
SELECT I_ID_D, I_ID_U, con_end AS ex_start_time, con_end AS ex_end_time, concat('/opt/', source_app_exec) AS ex_bin_path,
  CAST(con_number AS STRING) AS ex_cardinality, CAST(con_duration AS STRING) AS ex_duration, con_status AS ex_status,
  source_app_category AS ex_app_category, 'maker' AS ex_app_company, source_app_name AS ex_app_name,
  source_app_exec AS ex_app_bin_exec_name, concat('/opt/', source_app_exec) AS ex_app_bin_paths,
  CAST(p_size AS STRING) AS ex_app_bin_version, concat('h', CAST(l_partkey AS STRING)) AS ex_app_bin_hash,
  source_ip AS ex_device_ip, engine, filedt, l_returnflag
FROM d_flows
"""

# Units that were delivered, with the status of their lines: the base of the ledgers.
DERIVED["d_units"] = """
SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN 'server' ELSE 'device' END AS collecttype,
  CASE WHEN o_orderstatus = 'P' THEN concat('srv-engine-', CAST(1 + o_custkey % 3 AS STRING))
       ELSE concat('dev-engine-', CAST(o_custkey % 5 AS STRING)) END AS engine,
  CAST(l_shipdate AS DATE) AS dt,
  concat(replace(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', ''),
         CASE WHEN l_linestatus = 'O' THEN '-b' ELSE '-a' END) AS filedt, l_linestatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# Ledger: what each stage has recorded. Encoding is complete, later stages stop at a date.
DERIVED["d_ledger"] = """
SELECT 'connection' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt, filedt FROM d_units
UNION ALL
SELECT 'execution' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt, filedt FROM d_units
UNION ALL
SELECT 'webrequest' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt, filedt
FROM d_units WHERE l_linestatus = 'O'
UNION ALL
SELECT 'connection' AS filetype, 'pipe3to4' AS stage, collecttype, engine, dt, min(filedt) AS filedt
FROM d_units WHERE dt < DATE '1998-06-01' GROUP BY collecttype, engine, dt
UNION ALL
SELECT 'execution' AS filetype, 'pipe3to4_Exec' AS stage, collecttype, engine, dt, min(filedt) AS filedt
FROM d_units WHERE dt < DATE '1997-06-01' GROUP BY collecttype, engine, dt
UNION ALL
SELECT 'connection' AS filetype, 'pipe4to5' AS stage, collecttype, engine, dt, min(filedt) AS filedt
FROM d_units WHERE dt < DATE '1996-06-01' GROUP BY collecttype, engine, dt
"""

# What an earlier run had recorded before the present delivery: later file names for half of the days.
DERIVED["d_ledger_before"] = """
SELECT DISTINCT 'connection' AS filetype, 'pipe2to3' AS stage, collecttype, engine, dt,
  concat(replace(CAST(dt AS STRING), '-', ''), CASE WHEN engine < 'dev-engine-3' THEN '-b' ELSE '-a' END) AS filedt
FROM d_units WHERE dt < DATE '1998-06-01'
"""

# IP-range repository rows: a /16 per nation, a /24 and overlapping /28 blocks on the server side, /31 and /32 rows.
DERIVED["d_mdm_raw"] = """
SELECT 'Live' AS status, 'ON' AS active, concat('S', CAST(n_nationkey AS STRING)) AS loc_code, n_name AS loc_name,
  concat('C', CAST(n_regionkey AS STRING)) AS country, concat(' 10.', CAST(n_nationkey AS STRING), '.0.0 ') AS ip_address,
  '/16' AS mask FROM nation
UNION ALL
SELECT CASE WHEN n_nationkey < 20 THEN 'New' ELSE 'Retired' END AS status, 'ON' AS active,
  concat('S', CAST(n_nationkey AS STRING)) AS loc_code, n_name AS loc_name,
  concat('C', CAST(n_regionkey AS STRING)) AS country, concat('10.200.', CAST(n_nationkey AS STRING), '.0') AS ip_address,
  '/24' AS mask FROM nation
UNION ALL
SELECT 'Live' AS status, CASE WHEN s_acctbal < 0 THEN 'OFF' ELSE 'ON' END AS active,
  concat('X', CAST(s_suppkey % 7 AS STRING)) AS loc_code, 'Annex' AS loc_name,
  concat('C', CAST(s_nationkey % 5 AS STRING)) AS country,
  concat('10.200.', CAST(s_nationkey AS STRING), '.', CAST(16 * (s_suppkey % 15) AS STRING)) AS ip_address,
  CASE WHEN s_suppkey % 11 = 0 THEN '/31' WHEN s_suppkey % 11 = 1 THEN '0' ELSE '/28' END AS mask FROM supplier
"""

DERIVED["d_mdm"] = """
SELECT loc_code AS mdm_loc_code, loc_name AS mdm_loc_name, country AS mdm_loc_country, ip AS mdm_ip_start,
  bits AS mdm_ip_range, first_ip AS mdm_ip_start_int,
  first_ip + CASE bits WHEN 16 THEN 65536 WHEN 24 THEN 256 WHEN 28 THEN 16 ELSE 2 END - 1 AS mdm_ip_end_int
FROM (
  SELECT loc_code, loc_name, country, trim(ip_address) AS ip, CAST(replace(mask, '/', '') AS INT) AS bits,
    CAST(split_part(trim(ip_address), '.', 1) AS BIGINT) * 16777216
    + CAST(split_part(trim(ip_address), '.', 2) AS BIGINT) * 65536
    + CAST(split_part(trim(ip_address), '.', 3) AS BIGINT) * 256
    + CAST(split_part(trim(ip_address), '.', 4) AS BIGINT) AS first_ip
  FROM d_mdm_raw WHERE status IN ('Live', 'New') AND active = 'ON'
) x WHERE bits > 0
"""

DERIVED["d_users"] = """
SELECT concat('U', CAST(c_custkey AS STRING)) AS I_ID,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE r_name END AS Sector,
  CASE WHEN c_acctbal < 0 THEN '' ELSE concat('S', CAST(n_nationkey AS STRING)) END AS SiteCode,
  n_name AS SiteName, concat('C', CAST(n_regionkey AS STRING)) AS CountryCode,
  concat('T', CAST(n_nationkey AS STRING)) AS TerangaCode
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

# Asset repositories.
DERIVED["d_server"] = """
SELECT concat('srv', CAST(s_suppkey AS STRING)) AS aip_server_hostname,
  concat('phys', CAST(s_suppkey % 40 AS STRING)) AS aip_server_phys_host, 'M' AS aip_server_size,
  CASE WHEN s_suppkey % 3 = 0 THEN 'DB' ELSE 'WEB' END AS aip_server_function, 'Virtual' AS aip_server_type,
  concat('sub', CAST(s_suppkey % 4 AS STRING)) AS aip_server_subfunction,
  CASE WHEN s_suppkey % 13 = 5 THEN '192.168.0.9'
       ELSE concat('10.200.', CAST(s_nationkey AS STRING), '.', CAST(1 + s_suppkey % 250 AS STRING)) END AS aip_server_ip,
  '' AS aip_server_vmw_host,
  CASE s_suppkey % 17 WHEN 1 THEN 'Disposed' WHEN 2 THEN 'Standby' WHEN 3 THEN 'Stock' WHEN 4 THEN 'Disposal'
       WHEN 5 THEN NULL ELSE 'Live' END AS aip_server_status,
  CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE concat('A', CAST(s_nationkey AS STRING)) END AS aip_server_site,
  concat('Site ', CAST(s_nationkey AS STRING)) AS aip_server_site_name, 'owned' AS aip_server_ownership,
  'cpu' AS aip_server_cpu_type, '2' AS aip_server_cpu_num, '8' AS aip_server_cpu_cores, 'owned' AS aip_server_owner,
  'vendor' AS aip_server_vendor, 'model' AS aip_server_model, 'prod' AS aip_server_role, 'cmdb' AS aip_server_source,
  'linux' AS aip_server_os_name, '2016-05-01' AS filedate
FROM supplier
"""

DERIVED["d_instance"] = """
SELECT concat('App ', CAST(p_size AS STRING)) AS aip_appinstance_name,
  CAST(p_size AS STRING) AS aip_appinstance_shared_unique_id, p_type AS aip_appinstance_type,
  concat('srv', CAST(s_suppkey AS STRING)) AS aip_appinstance_hostname, 'ip' AS aip_appinstance_ip,
  CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END AS aip_appinstance_sector, 'Run' AS aip_appinstance_state
FROM part JOIN supplier ON p_partkey = s_suppkey * 7
UNION ALL
SELECT concat('App ', CAST(s_nationkey + 1 AS STRING)) AS aip_appinstance_name,
  CAST(s_nationkey + 1 AS STRING) AS aip_appinstance_shared_unique_id, 'PROD' AS aip_appinstance_type,
  concat('srv', CAST(s_suppkey AS STRING)) AS aip_appinstance_hostname, 'ip' AS aip_appinstance_ip,
  'Shared' AS aip_appinstance_sector, 'Run' AS aip_appinstance_state
FROM supplier WHERE s_acctbal > 0
"""

DERIVED["d_application"] = """
SELECT DISTINCT concat('App ', CAST(p_size AS STRING)) AS aip_app_name, CAST(p_size AS STRING) AS aip_app_shared_unique_id,
  concat('kind', CAST(p_size % 3 AS STRING)) AS aip_app_type, 'Validated' AS aip_app_validation, 'Active' AS aip_app_state,
  CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS aip_app_sensitive,
  concat('crit', CAST(p_size % 4 AS STRING)) AS aip_app_criticality,
  concat('sector', CAST(p_size % 5 AS STRING)) AS aip_app_sector, 'it' AS aip_app_it_owner, 'is' AS aip_app_is_owner
FROM part
"""

DERIVED["d_gridfusion"] = """
SELECT CAST(p_size AS STRING) AS aip_appgf_shared_unique_id, p_type AS aip_appgf_grid_app_name,
  p_brand AS aip_appgf_billing_code
FROM part
"""

# One asset row per server address, as the resolve stages read it.
DERIVED["d_aip"] = """
SELECT concat('10.200.', CAST(s_nationkey AS STRING), '.', CAST(1 + s_suppkey % 250 AS STRING)) AS aip_server_ip,
  min(concat('srv', CAST(s_suppkey AS STRING))) AS aip_server_hostname,
  min(CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE concat('A', CAST(s_nationkey AS STRING)) END) AS aip_server_site,
  min(concat('adm', CAST(s_suppkey % 3 AS STRING))) AS aip_server_adminby,
  min(CASE WHEN s_suppkey % 3 = 0 THEN 'DB' ELSE 'WEB' END) AS aip_server_function,
  min(concat('sub', CAST(s_suppkey % 4 AS STRING))) AS aip_server_subfunction,
  min(concat('App ', CAST(s_suppkey % 50 AS STRING))) AS aip_app_name,
  min(concat('kind', CAST(s_suppkey % 3 AS STRING))) AS aip_app_type, min('PROD') AS aip_appinstance_type,
  min('Active') AS aip_app_state, min('Y') AS aip_app_sensitive,
  min(concat('crit', CAST(s_suppkey % 4 AS STRING))) AS aip_app_criticality,
  min(concat('sector', CAST(s_suppkey % 5 AS STRING))) AS aip_app_sector, min('Shared') AS aip_appinstance_sector,
  min('Run') AS aip_appinstance_state, min(CAST(s_suppkey % 50 AS STRING)) AS aip_app_shared_unique_id
FROM supplier GROUP BY s_nationkey, 1 + s_suppkey % 250
"""

# Flows with every attribute the aggregates group by.
DERIVED["d_resolved"] = """
SELECT I_ID_U, dest_ip, dest_port, con_protocol, con_status, con_number, con_traffic_in, con_traffic_out, con_duration,
  source_ip, engine, filedt, collecttype, dt, month, source_app_name, source_app_category, source_app_exec,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END AS source_sector,
  concat('S', CAST(c_nationkey AS STRING)) AS "source_I_ID_site",
  CASE WHEN c_nationkey >= 20 THEN 'nf' ELSE concat('S', CAST(c_nationkey AS STRING)) END AS source_site,
  concat('T', CAST(c_nationkey AS STRING)) AS source_teranga,
  CASE WHEN l_linestatus = 'O' THEN concat('http://', source_app_name) ELSE NULL END AS url,
  concat('dev', CAST(o_custkey % 50 AS STRING)) AS source_aip_server_hostname,
  concat('App ', CAST(c_nationkey % 6 AS STRING)) AS source_aip_app_name, 'WEB' AS source_aip_server_function,
  'front' AS source_aip_server_subfunction, 'crit1' AS source_aip_app_criticality, 'kind1' AS source_aip_app_type,
  concat('sector', CAST(c_nationkey % 4 AS STRING)) AS source_aip_app_sector,
  CAST(c_nationkey % 6 AS STRING) AS source_aip_app_shared_unique_id, 'adm' AS source_aip_server_adminby,
  'Active' AS source_aip_app_state, 'PROD' AS source_aip_appinstance_type,
  CASE WHEN s_nationkey >= 20 THEN 'nf' ELSE concat('S', CAST(s_nationkey AS STRING)) END AS dest_site,
  concat('srv', CAST(l_suppkey AS STRING)) AS dest_aip_server_hostname,
  concat('App ', CAST(l_suppkey % 9 AS STRING)) AS dest_aip_app_name, 'DB' AS dest_aip_server_function,
  'back' AS dest_aip_server_subfunction, 'crit2' AS dest_aip_app_criticality, 'kind2' AS dest_aip_app_type,
  CASE WHEN s_nationkey = 3 THEN NULL ELSE concat('sector', CAST(l_suppkey % 5 AS STRING)) END AS dest_aip_app_sector,
  CAST(l_suppkey % 9 AS STRING) AS dest_aip_app_shared_unique_id, 'adm' AS dest_aip_server_adminby,
  'Active' AS dest_aip_app_state, 'PROD' AS dest_aip_appinstance_type
FROM d_flows
"""

# The published cube as the site-map query reads it.
DERIVED["d_cube"] = """
SELECT source_site AS "SiteCode_Source", dest_site AS "SiteCode_Destination", source_sector, source_teranga,
  source_app_name, source_app_exec, url, source_ip, source_aip_app_name, source_aip_app_sector,
  source_aip_app_shared_unique_id, dest_ip, dest_port, con_protocol, con_status, dest_aip_server_hostname,
  dest_aip_app_name, dest_aip_server_function, dest_aip_server_subfunction, dest_aip_app_criticality, dest_aip_app_type,
  dest_aip_app_sector, dest_aip_app_shared_unique_id, dest_aip_appinstance_type, dest_aip_server_adminby, I_ID_U, dt,
  CAST(con_number AS BIGINT) AS con_number, con_traffic_in + con_traffic_out AS con_traffic,
  (con_traffic_in + con_traffic_out) * con_number AS con_times_traffic, 1 AS distinct_I_ID_U
FROM d_resolved
"""

DERIVED["d_sites"] = """
SELECT concat('S', CAST(n_nationkey AS STRING)) AS SiteCode, n_name AS SiteName,
  concat('C', CAST(n_regionkey AS STRING)) AS CountryCode FROM nation
"""

DERIVED["d_categories"] = """
SELECT concat('S', CAST(n_nationkey AS STRING)) AS SiteCode, r_name AS SiteScenario
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'
"""

# Socket snapshots: one snapshot per server and month.
DERIVED["d_lsof"] = """
SELECT server_ip, dt, concat('cmd', CAST(l_partkey % 20 AS STRING)) AS command, CAST(l_orderkey AS STRING) AS pid,
  concat('u', CAST(l_partkey % 9 AS STRING)) AS "user", CASE WHEN l_linenumber = 4 THEN 'UDP' ELSE 'TCP' END AS node,
  CASE WHEN l_returnflag = 'R' THEN concat('*:', CAST(8000 + l_partkey % 12 AS STRING))
       WHEN l_linenumber = 7 THEN concat(server_ip, ':', CAST(8000 + l_partkey % 12 AS STRING), '->', server_ip, ':9000')
       ELSE concat(server_ip, ':', CAST(8000 + l_partkey % 12 AS STRING), '->10.', CAST(l_partkey % 30 AS STRING), '.1.',
                   CAST(l_partkey % 250 AS STRING), ':', CAST(7000 + l_partkey % 300 AS STRING)) END AS name,
  CASE WHEN l_returnflag = 'R' THEN '(LISTEN)' WHEN l_linenumber = 4 THEN ''
       WHEN l_linenumber = 1 THEN '(SYN-SENT)' WHEN l_linenumber = 2 THEN '(TIME-WAIT)'
       WHEN l_linenumber = 3 THEN '(BOUND)' WHEN l_linenumber = 5 THEN '(SYN-RECEIVED)' ELSE '(ESTABLISHED)' END AS status,
  l_partkey, l_orderkey
FROM (
  SELECT l.*, concat('10.200.', CAST(s_nationkey AS STRING), '.', CAST(1 + s_suppkey % 250 AS STRING)) AS server_ip,
    concat(substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7), '-01T00:05') AS dt
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
) x
"""

DERIVED["d_ps"] = """
SELECT server_ip, dt, "user", pid, CAST(CAST(floor(l_orderkey / 2) AS BIGINT) AS STRING) AS ppid, '00:00:01' AS time,
  concat('/bin/', command, ' --port ', CAST(l_partkey % 12 AS STRING)) AS command
FROM d_lsof WHERE node = 'TCP'
"""

DERIVED["d_socket_ledger"] = """
SELECT DISTINCT 'lsof' AS filetype, 'encodesockets' AS stage, server_ip, dt FROM d_lsof
UNION ALL
SELECT DISTINCT 'lsof' AS filetype, 'resolvesockets' AS stage, server_ip, dt FROM d_lsof WHERE dt < '1998-06-01'
UNION ALL
SELECT DISTINCT 'lsof' AS filetype, 'aggregatesockets' AS stage, server_ip, dt FROM d_lsof WHERE dt < '1997-06-01'
"""

# Metric records: six-hourly samples, one record per event.
DERIVED["d_usage"] = """
SELECT (19723 + (y - 2024) * 366 + doy - 1) * 86400000 + CAST(floor(h / 6) AS BIGINT) * 21600000 AS date,
  concat('SRV', CAST(user_id % 20 AS STRING)) AS server,
  CASE event_type WHEN 'click' THEN 'used_mb' WHEN 'view' THEN 'used_percent' WHEN 'error' THEN 'avail_mb'
       WHEN 'signup' THEN 'processor utilization - overall cpu' ELSE 'memphysusage_percent' END AS name,
  CAST(CASE event_type WHEN 'click' THEN CASE WHEN value < 5 THEN 0 ELSE floor(value) END
       WHEN 'view' THEN CASE WHEN value >= 100 THEN 100 WHEN value < 3 THEN 0 ELSE floor(value) END
       ELSE floor(value * 10) END AS DOUBLE) AS value,
  CASE WHEN event_type IN ('click', 'view', 'error')
       THEN CASE WHEN user_id % 2 = 0 THEN 'iostat:mount=/data,device=/dev/sd1' ELSE 'iostat:mount=C:' END
       WHEN event_type = 'signup' THEN 'sysstat' WHEN value < 1 THEN 'app' ELSE 'sysstat' END AS "table"
FROM (
  SELECT user_id, event_type, value, CAST(extract(year FROM ts) AS BIGINT) AS y,
    CAST(extract(doy FROM ts) AS BIGINT) AS doy, CAST(extract(hour FROM ts) AS BIGINT) AS h
  FROM events
) x
"""

# The same rows for Spark, which joins in the written order: orders meet their customers first, as they are fewer and narrower than the line items.
SPARK_FORM = {"d_flows": DERIVED["d_flows"].replace("""JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
""", """JOIN (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey) o ON l.l_orderkey = o.o_orderkey
""").replace("c.c_", "o.c_")}


def _by_month() -> str:
    """``d_flows`` with the rows of a month brought together before the texts are made, while the rows are still narrow."""
    made, joined = SPARK_FORM["d_flows"].split("FROM lineitem l", 1)
    bare = re.sub(r"\b[losp]\.(?=[locsp]_)", "", made)
    used = ", ".join(sorted(set(re.findall(r"\b[locsp]_[a-z]+\b", bare))))
    month = "substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS l_month"
    return f"{bare}FROM (SELECT /*+ REBALANCE(l_month) */ * FROM (SELECT {used}, {month} FROM lineitem l{joined}) y) x"


FLOWS_BY_MONTH = _by_month()

_NAME = re.compile(r"\b(FROM|JOIN)\s+([a-z_]+)\b", re.IGNORECASE)


def names_in(sql: str) -> list[str]:
    """Given and derived tables a text reads, in order of first use."""
    found = [m.group(2) for m in _NAME.finditer(sql)]
    return [n for n in dict.fromkeys(found) if n in DERIVED or n in BASE_TABLES]


class Inputs:
    """Access to the given and the derived tables of one folder: ``t.orders``, ``t.d_flows``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in DERIVED:
                self._frames[name] = self.sql(SPARK_FORM.get(name, DERIVED[name]))
                if name in STORED:
                    self._frames[name] = cut_lineage(self._frames[name], name)
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def stored(self, name: str) -> DataFrame:
        """A derived table written once, for inputs that are stored tables in practice, such as the ledger. Later uses of it read the copy."""
        key = f"stored {name}"
        if key not in self._frames:
            self._frames[key] = self._frames[name] = cut_lineage(getattr(self, name), name)
        return self._frames[key]

    def flows_by_month(self, written: bool = True, without: tuple[str, ...] = ()) -> None:
        """From now on the rows of a month stand together in the flows, as in extracts that come by day.

        ``written``: for a query that reads the flows several times they are joined once and stored, ``without`` the columns it never reads.
        """
        flows = self.sql(FLOWS_BY_MONTH).drop(*without)
        self._frames["d_flows"] = cut_lineage(flows, "d_flows") if written else flows

    def sql(self, text: str) -> DataFrame:
        frames = {n: getattr(self, n) for n in names_in(text)}
        marked = _NAME.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}" if m.group(2) in frames else m.group(0), text)
        return self.spark.sql(marked.replace('"', "`"), **frames)


def with_inputs(sql: str) -> str:
    """``sql`` for DuckDB, with every derived table it reads put in front as a CTE."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in names_in(text):
            if name in DERIVED and name not in ordered:
                visit(DERIVED[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({DERIVED[n].strip()})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
