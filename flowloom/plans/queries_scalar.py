"""Registered queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

import flowloom.functions as fn
from flowloom.plans.registry import query

IP_SQL = """(CAST(split_part({0}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({0}, '.', 2) AS BIGINT) * 65536
 + CAST(split_part({0}, '.', 3) AS BIGINT) * 256 + CAST(split_part({0}, '.', 4) AS BIGINT))"""


@query("ip_to_int", f"""
SELECT source_ip, CASE WHEN c_nationkey > 20 THEN NULL ELSE {IP_SQL.format('source_ip')} END AS ip_number, count(*) AS n
FROM d_flows GROUP BY ALL""")
def _(t):
    # Nations above 20 get a malformed address, which must give NULL.
    shown = F.when(F.col("c_nationkey") > 20, F.concat("source_ip", F.lit(".7"))).otherwise(F.col("source_ip"))
    return t.d_flows.groupBy("source_ip", fn.ip_to_int(shown).alias("ip_number")).agg(F.count("*").alias("n"))


@query("int_to_ip", """
SELECT l_orderkey, l_partkey, l_linenumber,
  concat(CAST((l_orderkey * 7919 + l_partkey) // 16777216 % 256 AS VARCHAR), '.',
         CAST((l_orderkey * 7919 + l_partkey) // 65536 % 256 AS VARCHAR), '.',
         CAST((l_orderkey * 7919 + l_partkey) // 256 % 256 AS VARCHAR), '.',
         CAST((l_orderkey * 7919 + l_partkey) % 256 AS VARCHAR)) AS ip
FROM lineitem""")
def _(t):
    number = F.col("l_orderkey") * 7919 + F.col("l_partkey")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", fn.int_to_ip(number).alias("ip"))


@query("cidr_end", """
SELECT o_orderkey, 167772160 + o_orderkey * 256 + CAST(power(2, 32 - (8 + o_custkey % 25)) AS BIGINT) - 1 AS last_ip
FROM orders""")
def _(t):
    start, prefix = F.lit(167772160) + F.col("o_orderkey") * 256, 8 + F.col("o_custkey") % 25
    return t.orders.select("o_orderkey", fn.cidr_end(start, prefix).alias("last_ip"))


@query("open_sequence", """
SELECT p_partkey, CAST(greatest(p_size % 6 - 2, 0) AS INTEGER) AS n,
  CAST(CASE WHEN p_size % 6 > 2 THEN p_partkey + 1 END AS BIGINT) AS first_value
FROM part""")
def _(t):
    # The stop lies -1 to 4 above the start; a backward or empty range must give nothing.
    inside = fn.open_sequence(F.col("p_partkey"), F.col("p_partkey") + F.col("p_size") % 6 - 1)
    return t.part.select("p_partkey", F.size(inside).alias("n"), F.try_element_at(inside, F.lit(1)).alias("first_value"))


@query("basename", "SELECT c_custkey, concat(replace(c_name, '#', '_'), '.csv') AS base FROM customer")
def _(t):
    path = F.concat(F.lit("/data/in/"), F.replace("c_name", F.lit("#"), F.lit("_")), F.lit(".csv"),
                    F.when(F.col("c_acctbal") < 0, "/").otherwise(""))
    return t.customer.select("c_custkey", fn.basename(path).alias("base"))


@query("safe_int", """
SELECT NX_con_duration, NX_bin_app_name, CASE WHEN NX_con_duration = 'unknown' THEN -1 ELSE CAST(NX_con_duration AS INTEGER) END AS duration,
  -1 AS not_a_number, CAST(count(*) AS BIGINT) AS n
FROM d_raw_connection GROUP BY ALL""")
def _(t):
    return t.d_raw_connection.groupBy(
        "NX_con_duration", "NX_bin_app_name", fn.safe_int(F.col("NX_con_duration")).alias("duration"),
        fn.safe_int(F.col("NX_bin_app_name")).alias("not_a_number"),
    ).agg(F.count("*").alias("n"))


@query("classify_engine", """
SELECT engine, CASE WHEN engine LIKE 'srv-%' THEN 'server' ELSE 'device' END AS collecttype, count(*) AS n
FROM d_flows GROUP BY ALL""")
def _(t):
    kind = fn.classify_engine(F.col("engine"), ["srv-engine-1", "srv-engine-2", "srv-engine-3"])
    return t.d_flows.groupBy("engine", kind.alias("collecttype")).agg(F.count("*").alias("n"))


@query("default_site", """
SELECT I_ID, CASE WHEN SiteCode = '' THEN 'nf' ELSE SiteCode END AS site,
  CASE WHEN Sector IS NULL THEN 'nf' ELSE Sector END AS sector FROM d_users""")
def _(t):
    return t.d_users.select("I_ID", fn.default_site(F.col("SiteCode")).alias("site"),
                            fn.default_site(F.col("Sector")).alias("sector"))


@query("regex_first", """
SELECT l_orderkey, l_linenumber, l_partkey, substr(con_end, 1, 10) AS day_text, substr(con_end, 12, 8) AS time_text, '' AS none
FROM d_flows""")
def _(t):
    end = F.col("con_end")
    return t.d_flows.select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.regex_first(end, fn.DAY_PATTERN).alias("day_text"),
        fn.regex_first(end, fn.TIME_PATTERN).alias("time_text"), fn.regex_first(end, "[a-z]+").alias("none"))


@query("list_size", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 3 END AS n FROM orders""")
def _(t):
    text = (F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", "a,")
            .otherwise(F.concat(F.lit("a,b,"), F.col("o_orderpriority"), F.lit(",,"))))
    return t.orders.select("o_orderkey", fn.list_size(text).alias("n"))


@query("gb_to_mb", """
SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 0
  ELSE CAST(floor(CAST(CAST(s_acctbal AS VARCHAR) AS DOUBLE) * 1000 + 0.5) AS BIGINT) END AS mb FROM supplier""")
def _(t):
    text = F.when(F.col("s_acctbal") < 0, "n/a").otherwise(
        F.replace(F.col("s_acctbal").cast("string"), F.lit("."), F.lit(",")))
    return t.supplier.select("s_suppkey", fn.gb_to_mb(text).alias("mb"))


@query("map_tier", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'SAN replicated DR' WHEN 'SMALL' THEN 'SAN' WHEN 'MEDIUM' THEN 'NAS'
  WHEN 'LARGE' THEN 'DAS' WHEN 'PROMO' THEN 'Local' ELSE 'Unknown' END AS tier FROM part""")
def _(t):
    raw = (F.when(F.col("p_type") == "ECONOMY", "Tier 1").when(F.col("p_type") == "SMALL", "Tier 2")
           .when(F.col("p_type") == "MEDIUM", "Tier 3").when(F.col("p_type") == "LARGE", "DAS")
           .when(F.col("p_type") == "PROMO", "Local"))
    return t.part.select("p_partkey", fn.map_tier(raw).alias("tier"))


@query("map_tcp_state", """
SELECT status, CASE WHEN status IN ('(ESTABLISHED)', '(TIME-WAIT)') THEN 'closed' WHEN status = '(SYN-SENT)' THEN 'SYN-SENT'
  WHEN status = '(SYN-RECEIVED)' THEN 'RECEIVED' END AS con_status, count(*) AS n FROM d_lsof GROUP BY ALL""")
def _(t):
    return t.d_lsof.groupBy("status", fn.map_tcp_state(F.col("status")).alias("con_status")).agg(F.count("*").alias("n"))


@query("tag_get", """
SELECT "table", CASE WHEN "table" LIKE 'iostat%' THEN 'iostat' ELSE "table" END AS table_name,
  CASE WHEN "table" LIKE '%/data%' THEN '/data' WHEN "table" LIKE '%C:' THEN 'C:' ELSE '' END AS mount,
  CASE WHEN "table" LIKE '%device%' THEN '/dev/sd1' ELSE '' END AS device,
  CASE WHEN name LIKE 'processor%' THEN 'cpu_percent' ELSE name END AS metric, count(*) AS n
FROM d_usage GROUP BY ALL""")
def _(t):
    tags = fn.metric_tags(F.col("table"))
    return t.d_usage.groupBy(
        "table", fn.metric_table(F.col("table")).alias("table_name"), fn.tag_get(tags, "mount").alias("mount"),
        fn.tag_get(tags, "device").alias("device"), fn.fix_metric_name(F.col("name")).alias("metric"),
    ).agg(F.count("*").alias("n"))


@query("parse_compact_ts", """
SELECT o_orderkey, concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'T', lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0'), ':30') AS iso,
  CAST(o_orderdate AS DATE) AS dt, CAST(o_custkey % 24 AS INTEGER) AS hour, true AS junk_is_null
FROM orders""")
def _(t):
    stamp = F.concat(F.date_format("o_orderdate", "yyyyMMdd-"), F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit("30"))
    parsed = fn.parse_compact_ts(stamp)
    return t.orders.select(
        "o_orderkey", fn.compact_to_iso(stamp).alias("iso"), parsed.cast("date").alias("dt"), F.hour(parsed).alias("hour"),
        fn.parse_compact_ts(F.col("o_orderpriority")).isNull().alias("junk_is_null"))


@query("split_endpoint", """
SELECT name, status, CASE WHEN status <> '(LISTEN)' THEN split_part(split_part(name, '->', 1), ':', 1) END AS con_local_ip,
  CASE WHEN status <> '(LISTEN)' THEN split_part(split_part(name, '->', 1), ':', 2) END AS con_local_port,
  CASE WHEN status <> '(LISTEN)' THEN split_part(split_part(name, '->', 2), ':', 1) END AS con_foreign_ip,
  CASE WHEN status <> '(LISTEN)' THEN split_part(split_part(name, '->', 2), ':', 2) END AS con_foreign_port,
  CASE WHEN status = '(LISTEN)' THEN split_part(name, ':', 2) END AS port_listen, count(*) AS n
FROM d_lsof GROUP BY ALL""")
def _(t):
    parts = fn.socket_endpoints(F.col("name"))
    listen = F.when(F.col("status") == "(LISTEN)", fn.listen_port(F.col("name")))
    return t.d_lsof.groupBy("name", "status", *[c.alias(k) for k, c in parts.items()], listen.alias("port_listen")).agg(
        F.count("*").alias("n"))


@query("strip_chars", """
SELECT c_custkey, concat('10.', CAST(c_nationkey AS VARCHAR), '.0.0') AS address, CAST(c_custkey AS VARCHAR) AS digits,
  c_mktsegment AS unquoted, CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer""")
def _(t):
    key = F.col("c_custkey").cast("string")
    return t.customer.select(
        "c_custkey", fn.address_chars_only(F.concat(F.lit(" 10."), F.col("c_nationkey").cast("string"), F.lit(".0.0 /x"))).alias("address"),
        fn.digits_only(F.concat(F.lit("/"), key, F.lit(" bits"))).alias("digits"),
        fn.strip_trailing_quote(F.concat("c_mktsegment", F.lit('"'))).alias("unquoted"),
        fn.strip_leading_zeros(F.lpad(key, 12, "0")).alias("id"))


@query("date_parts", """
SELECT con_end, CAST(substr(con_end, 1, 10) AS DATE) AS dt, substr(con_end, 1, 7) AS month,
  CAST(substr(con_end, 12, 2) AS INTEGER) AS hour, true AS junk_is_null, CAST(substr(con_end, 1, 10) AS DATE) - 42 AS dt_minus_42,
  count(*) AS n
FROM d_flows GROUP BY ALL""")
def _(t):
    end = F.col("con_end")
    return t.d_flows.groupBy(
        "con_end", fn.day_of(end).alias("dt"), fn.month_of(end).alias("month"), fn.hour_of(end).alias("hour"),
        fn.day_of(F.col("engine")).isNull().alias("junk_is_null"), F.date_sub(fn.day_of(end), 42).alias("dt_minus_42"),
    ).agg(F.count("*").alias("n"))


@query("epoch_days", """
SELECT date, DATE '1970-01-01' + CAST(date // 86400000 AS INTEGER) AS dt, CAST(date // 3600000 % 24 AS INTEGER) AS hour, count(*) AS n
FROM d_usage GROUP BY ALL""")
def _(t):
    ts = fn.epoch_ms_to_ts(F.col("date"))
    return t.d_usage.groupBy("date", ts.cast("date").alias("dt"), F.hour(ts).alias("hour")).agg(F.count("*").alias("n"))


@query("sanitize_label", """
SELECT p_partkey, replace(concat(p_name, '_&-', p_type), ' ', '_') AS label, concat(p_brand, p_type) AS unquoted,
  concat(p_brand, '-', CASE WHEN p_size > 25 THEN 'NA' ELSE p_type END) AS site FROM part""")
def _(t):
    country = F.when(F.col("p_size") <= 25, F.col("p_type"))
    return t.part.select(
        "p_partkey", fn.sanitize_label(F.concat("p_name", F.lit(" |("), "p_type", F.lit(")"))).alias("label"),
        fn.strip_quotes(F.concat("p_brand", F.lit('"\\'), "p_type")).alias("unquoted"),
        fn.site_label(F.col("p_brand"), country).alias("site"))


@query("parse_metric_stream", """
SELECT user_id, event_type,
  CASE event_type WHEN 'click' THEN concat('iostat:mount=:/vol', CAST(user_id AS VARCHAR), ',device=/dev/sda')
    WHEN 'view' THEN 'iostat:mount=D:' WHEN 'error' THEN 'iostat:' WHEN 'signup' THEN 'sysstat' ELSE 'app' END AS table_name,
  CASE event_type WHEN 'click' THEN 'used_mb' WHEN 'view' THEN 'diskq_count' WHEN 'error' THEN 'ldisk plain'
    WHEN 'signup' THEN 'processor utilization - overall cpu' ELSE concat('probe ', CAST(user_id AS VARCHAR)) END AS metric,
  count(*) AS n
FROM events GROUP BY user_id, event_type""")
def _(t):
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    display = (F.when(kind == "click", F.concat(F.lit("Ldsk:/vol"), user, F.lit(" (/dev/sda):Used^^MB")))
               .when(kind == "view", F.lit("Ldiskq (D:)^^#"))
               .when(kind == "error", F.lit("Ldisk plain"))
               .when(kind == "signup", F.lit("PROCESSOR Utilization - Overall CPU"))
               .otherwise(F.concat(F.lit("Probe "), user)))
    return t.events.groupBy("user_id", "event_type", fn.stream_table(display).alias("table_name"),
                            fn.stream_metric(display).alias("metric")).agg(F.count("*").alias("n"))


@query("normalize_date", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS dt FROM orders""")
def _(t):
    # Two spellings by status; the third carries an impossible day.
    text = (F.when(F.col("o_orderstatus") == "O", F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")))
            .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd-MM-yyyy"))
            .otherwise(F.date_format("o_orderdate", "99-MM-yyyy")))
    return t.orders.select("o_orderkey", fn.normalize_date(text).alias("dt"))


@query("normalize_login", """
SELECT c_custkey, concat('user', CAST(c_custkey AS VARCHAR), '@dom1') AS user_name,
  concat('user', CAST(c_custkey AS VARCHAR), '@', lower(c_mktsegment)) AS login,
  CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE concat(c_mktsegment, '/sub') END AS sector FROM customer""")
def _(t):
    user = F.concat(F.lit("User"), F.col("c_custkey").cast("string"))
    subsector = F.when(F.col("c_acctbal") < 0, "").otherwise("sub")
    return t.customer.select(
        "c_custkey", fn.normalize_user(F.concat(user, F.lit("@DOM1.corp.example")), ".corp.example").alias("user_name"),
        fn.login_of(user, F.col("c_mktsegment")).alias("login"), fn.sector_path(F.col("c_mktsegment"), subsector).alias("sector"))


@query("decode_port", """
SELECT port, CASE substr(port, 1, 1) WHEN '2' THEN 'back' ELSE 'front' END AS zone,
  CASE substr(port, 2, 1) WHEN '0' THEN 'ECC' WHEN '1' THEN 'UM' WHEN '2' THEN 'ECF' WHEN '4' THEN 'ECM' ELSE '' END AS env,
  CASE substr(port, 3, 2) WHEN '01' THEN 'HTTPS' ELSE 'HTTP' END AS protocol,
  CASE WHEN substr(port, 5, 1) IN ('', '0') THEN 'n' ELSE concat('n+', substr(port, 5, 1)) END AS version, count(*) AS n
FROM (SELECT CAST(9000 + (l_orderkey * 31 + l_partkey * 7) % 25000 AS VARCHAR) AS port FROM lineitem) x GROUP BY ALL""")
def _(t):
    ports = t.lineitem.select((9000 + (F.col("l_orderkey") * 31 + F.col("l_partkey") * 7) % 25000).cast("string").alias("port"))
    return ports.groupBy("port", *[c.alias(k) for k, c in fn.decode_port(F.col("port")).items()]).agg(F.count("*").alias("n"))


@query("filename_metadata", """
SELECT o_orderkey, 'connection' AS filetype, concat('eng', CAST(o_custkey % 5 AS VARCHAR)) AS engine,
  replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS filedt, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filedate
FROM orders""")
def _(t):
    name = F.concat(F.lit("/in/connection_eng"), (F.col("o_custkey") % 5).cast("string"), F.lit("_"),
                    F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".tgz.csv.gz"))
    return t.orders.select("o_orderkey", *[c.alias(k) for k, c in fn.file_parts(name).items()])
