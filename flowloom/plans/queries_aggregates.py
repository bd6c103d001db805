"""Registered queries for aggregates, flow tables, cubes, usage and dimension lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import aggregates as ag
from flowloom.operators import ledger as lg
from flowloom.operators import usage as us
from flowloom.operators import usersets
from flowloom.operators.joining import placed
from flowloom.operators.matrix import with_measure
from flowloom.plans.registry import query
from flowloom.session import cut_lineage


def _list(keys: list[str]) -> str:
    return ", ".join(keys)


SUMS_SQL = """CAST(sum(con_number) AS BIGINT) AS con_number, CAST(sum(con_traffic_in) AS BIGINT) AS con_traffic_in,
  CAST(sum(con_traffic_out) AS BIGINT) AS con_traffic_out, avg(con_duration) AS con_duration"""
USERS_SQL = "string_agg(DISTINCT I_ID_U, ',' ORDER BY I_ID_U) AS I_ID_U, CAST(count(DISTINCT I_ID_U) AS INTEGER) AS distinct_I_ID_U"

SERVER_DAY_SQL = f"SELECT {_list(ag.SERVER_DAY_KEYS)}, {SUMS_SQL} FROM d_resolved WHERE collecttype = 'server' GROUP BY ALL"
DEVICE_DAY_SQL = f"SELECT {_list(ag.DEVICE_DAY_KEYS)}, {SUMS_SQL}, {USERS_SQL} FROM d_resolved WHERE collecttype = 'device' GROUP BY ALL"
SOCKET_DAY_SQL = f"""SELECT {_list(ag.SERVER_DAY_KEYS)}, CAST(sum(con_number) AS BIGINT) AS con_number, CAST(NULL AS BIGINT) AS con_traffic_in,
  CAST(NULL AS BIGINT) AS con_traffic_out, CAST(NULL AS DOUBLE) AS con_duration FROM d_resolved WHERE collecttype = 'server' GROUP BY ALL"""


def device_day(t, together=None):
    return ag.agg_device_day(t.d_resolved.filter(F.col("collecttype") == "device"), together=together)


def published_devices(t, level: str, resolution: str):
    """The daily device table as it is published, placed by the keys of the cube that is made of it."""
    return ag.published_input(device_day(t, ag.published_keys(t.d_resolved, ag.cube_keys("device", level, resolution))))


def user_dictionary(t):
    """Numbers of all users, as the jobs keep them; the flows have the customers of the orders as users."""
    users = t.orders.select(F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("I_ID_U"))
    return cut_lineage(usersets.number_names(users, "I_ID_U"), "users")


def device_day_sets(t, dictionary=None, together=None, shown=None):
    rows = t.d_resolved.filter(F.col("collecttype") == "device")
    return ag.device_day_sets(rows, dictionary if dictionary is not None else user_dictionary(t), together=together, shown=shown)


def _server_rows(t, together):
    rows = t.d_resolved.filter(F.col("collecttype") == "server")
    return placed(rows, together) if together else rows


def server_day(t, together=None):
    return ag.agg_server_day(_server_rows(t, together))


def socket_day(t, together=None):
    """The server flows as sockets report them: one connection each, traffic and duration unknown."""
    unknown = {c: F.lit(None).cast("bigint") for c in ("con_traffic_in", "con_traffic_out", "con_duration")}
    rows = _server_rows(t, together).withColumn("collecttype", F.lit("linux"))
    return ag.agg_socket_day(rows.withColumns(unknown))


def server_and_socket_day(t, together, shown):
    """``server_day`` and ``socket_day`` with the keys ``shown``, from rows that are shuffled once for both."""
    rows, _ = ag.hashed_rest(t.d_resolved.filter(F.col("collecttype") == "server"), ag.SERVER_DAY_KEYS, shown)
    both = placed(rows, together).withColumn("collecttype", F.explode(F.array(F.lit("server"), F.lit("linux"))))
    known = {c: F.when(F.col("collecttype") == "server", F.col(c)) for c in ("con_traffic_in", "con_traffic_out", "con_duration")}
    both = both.withColumns(known)
    return ag.agg_server_day(both.filter(F.col("collecttype") == "server"), shown=shown), ag.agg_socket_day(both, shown)


@query("agg_server_day", SERVER_DAY_SQL)
def _(t):
    return server_day(t)


@query("agg_device_day", DEVICE_DAY_SQL)
def _(t):
    return device_day(t)


@query("agg_socket_day", SOCKET_DAY_SQL)
def _(t):
    return socket_day(t)


@query("agg_union_lists", f"""
SELECT month, source_site, CAST(sum(con_number) AS BIGINT) AS con_number, string_agg(DISTINCT I_ID_U, ',' ORDER BY I_ID_U) AS users,
  CAST(count(DISTINCT I_ID_U) AS INTEGER) AS n_users FROM d_resolved WHERE collecttype = 'device' GROUP BY ALL""")
def _(t):
    # Union of the lists of the daily table, which is the set over its rows.
    return ag.with_members(device_day(t), ["month", "source_site"], "I_ID_U", {"con_number": F.col("con_number")}, "users", "n_users")


DEVICE_ROLE = {"server_ip": "dest_ip", "server_site": "dest_site", "server_aip_app_name": "dest_aip_app_name", "server_sector": "dest_aip_app_sector",
               "remote_sector": "source_sector", "remote_site": "source_I_ID_site", "remote_ip": "CAST(NULL AS VARCHAR)",
               "remote_app_exec": "source_app_exec", "remote_aip_app_name": "CAST(NULL AS VARCHAR)"}
CLIENT_ROLE = {"server_ip": "dest_ip", "server_site": "dest_site", "server_aip_app_name": "dest_aip_app_name", "server_sector": "dest_aip_app_sector",
               "remote_sector": "source_aip_app_sector", "remote_site": "source_site", "remote_ip": "source_ip",
               "remote_app_exec": "source_app_exec", "remote_aip_app_name": "source_aip_app_name"}
SERVER_ROLE = {"server_ip": "source_ip", "server_site": "source_site", "server_aip_app_name": "source_aip_app_name", "server_sector": "source_aip_app_sector",
               "remote_sector": "dest_aip_app_sector", "remote_site": "dest_site", "remote_ip": "dest_ip",
               "remote_app_exec": "CAST(NULL AS VARCHAR)", "remote_aip_app_name": "dest_aip_app_name"}


def _role_sql(role: dict[str, str], collecttype: str, remote: str) -> str:
    source = "device" if collecttype == "nxdevice" else "server"
    known = collecttype != "linuxserver"
    traffic = "CAST(sum(con_traffic_in + con_traffic_out) AS BIGINT)" if known else "CAST(NULL AS BIGINT)"
    users = ("string_agg(DISTINCT I_ID_U, ',' ORDER BY I_ID_U) AS client_user, CAST(count(DISTINCT I_ID_U) AS INTEGER) AS distinct_client_user"
             if source == "device" else "CAST(NULL AS VARCHAR) AS client_user, CAST(NULL AS INTEGER) AS distinct_client_user")
    keys = ", ".join(f"{s} AS {n}" for n, s in role.items())
    return f"""SELECT dt, month, {keys}, dest_port AS server_port, con_protocol, CAST(sum(con_number) AS BIGINT) AS con_number,
  {traffic} AS con_traffic, {users}, '{collecttype}' AS collecttype, '{remote}' AS remote_type
FROM d_resolved WHERE collecttype = '{source}' AND con_status = 'closed' GROUP BY ALL"""


DETAIL_SQL = "\nUNION ALL\n".join([
    _role_sql(DEVICE_ROLE, "nxdevice", "client"), _role_sql(CLIENT_ROLE, "nxserver", "client"), _role_sql(SERVER_ROLE, "nxserver", "server"),
    _role_sql(CLIENT_ROLE, "linuxserver", "client"), _role_sql(SERVER_ROLE, "linuxserver", "server")])


def flow_detail(t):
    return ag.flow_detail(device_day(t, ag.DEVICE_PLACE), server_day(t, ag.SERVER_PLACE), socket_day(t, ag.SERVER_PLACE))


@query("flow_detail", DETAIL_SQL)
def _(t):
    return flow_detail(t)


def _summary_sql(month: str) -> str:
    keys = month + _list(ag.FLOW_KEYS)
    return f"""WITH detail AS ({DETAIL_SQL}),
u AS (SELECT {keys}, count(DISTINCT usr) AS n FROM (SELECT {keys}, unnest(string_split(client_user, ',')) AS usr FROM detail) x GROUP BY ALL)
SELECT d.*, CAST(coalesce(u.n, 0) AS INTEGER) AS distinct_client_user FROM (
  SELECT {keys}, count(DISTINCT remote_ip) AS count_distinct_remote_ip, count(DISTINCT remote_app_exec) AS count_distinct_remote_app_exec,
    CAST(sum(con_traffic) AS BIGINT) AS con_traffic, CAST(sum(con_number) AS BIGINT) AS con_number FROM detail GROUP BY ALL) d
LEFT JOIN u ON {' AND '.join(f'd.{k} IS NOT DISTINCT FROM u.{k}' for k in keys.split(', '))}"""


def flow_rows(t, by_month):
    """Rows of the daily tables, of whose keys only those are shown that the flow tables read; they lie together by flow key from the start."""
    also = ["month"] if by_month else []
    device = device_day_sets(t, together=[*also, *ag.DEVICE_FLOW], shown=[*also, *ag.DEVICE_READ])
    return ag.flow_rows(device, *server_and_socket_day(t, [*also, *ag.CLIENT_FLOW], [*also, *ag.SERVER_READ]), by_month)


@query("flow_month", _summary_sql("month, "))
def _(t):
    return ag.flow_summary(flow_rows(t, True), by_month=True)


@query("flow_total", _summary_sql(""))
def _(t):
    return ag.flow_summary(flow_rows(t, False), by_month=False)


@query("user_sets", DEVICE_DAY_SQL)
def _(t):
    """The daily table as it is stored, with bitmaps, and its users as text as it is exported."""
    dictionary = user_dictionary(t)
    return usersets.with_names(device_day_sets(t, dictionary), "users", dictionary, "I_ID_U")


# The product is taken from the daily rows, as the cubes are built from the daily tables.
def _cube_sql(collecttype: str, level: str, resolution: str) -> str:
    keys = ag.cube_keys(collecttype, level, resolution)
    shown = ", ".join(f"coalesce({k}, 'NA') AS {k}" if k not in ("dest_port",) else k for k in keys)
    day = DEVICE_DAY_SQL if collecttype == "device" else SERVER_DAY_SQL
    sums = """CAST(sum(con_number) AS BIGINT) AS con_number, CAST(sum(con_traffic_in + con_traffic_out) AS BIGINT) AS con_traffic,
  CAST(sum((con_traffic_in + con_traffic_out) * con_number) AS BIGINT) AS con_times_traffic"""
    base = f"SELECT {shown}, {sums} FROM ({day}) d GROUP BY ALL"
    if collecttype == "server":
        return base
    members = f"""SELECT {shown}, string_agg(DISTINCT I_ID_U, ',' ORDER BY I_ID_U) AS I_ID_U,
  CAST(count(DISTINCT I_ID_U) AS INTEGER) AS distinct_I_ID_U FROM d_resolved WHERE collecttype = 'device' GROUP BY ALL"""
    return f"SELECT * FROM ({base}) a JOIN ({members}) b USING ({_list(keys)})"


@query("cube_device", _cube_sql("device", "detail", "IDM"))
def _(t):
    return ag.cube(published_devices(t, "detail", "IDM"), "device", "detail", "IDM")


@query("cube_device_by_site", _cube_sql("device", "nodetail", "Device"))
def _(t):
    return ag.cube(published_devices(t, "nodetail", "Device"), "device", "nodetail", "Device")


@query("cube_server", _cube_sql("server", "detail", "IDM"))
def _(t):
    return ag.cube(ag.published_input(server_day(t)), "server", "detail")


@query("cube_server_by_site", _cube_sql("server", "nodetail", "IDM"))
def _(t):
    return ag.cube(ag.published_input(server_day(t)), "server", "nodetail")


DAYS_SQL = """SELECT dt, count(DISTINCT engine) AS engine_count FROM d_flows WHERE collecttype = '{0}' GROUP BY dt HAVING count(DISTINCT engine) >= {1}"""


@query("valid_days", f"""
SELECT 'device' AS collecttype, count(*) AS days, min(dt) AS first_day, max(dt) AS last_day FROM ({DAYS_SQL.format('device', 4)}) x
UNION ALL SELECT 'server', count(*), min(dt), max(dt) FROM ({DAYS_SQL.format('server', 3)}) x""")
def _(t):
    units = lg.earliest_files(t.stored("d_ledger"), lg.ENCODE)
    frames = [ag.valid_days(units, kind, least).agg(F.count("*").alias("days"), F.min("dt").alias("first_day"), F.max("dt").alias("last_day"))
              .withColumn("collecttype", F.lit(kind)) for kind, least in (("device", 4), ("server", 3))]
    return frames[0].unionByName(frames[1])


@query("date_ranges", f"""
WITH v AS (SELECT min(dt) AS f, max(dt) AS l FROM ({DAYS_SQL.format('device', 4)}) x)
SELECT 'Full' AS date_range, f AS firstDate, l AS lastDate FROM v UNION ALL SELECT '6Weeks', l - 42, l FROM v
UNION ALL SELECT 'LastWeek', l - 7, l FROM v UNION ALL SELECT 'DayOne', DATE '1998-11-02', l FROM v""")
def _(t):
    units = lg.earliest_files(t.stored("d_ledger"), lg.ENCODE)
    return ag.date_ranges(ag.valid_days(units, "device", 4), "1998-11-02")


@query("dim_sectors", """
SELECT 'identity' AS source, Sector FROM (SELECT DISTINCT Sector FROM d_users WHERE Sector <> '') x
UNION ALL SELECT 'application', aip_app_sector FROM (SELECT DISTINCT aip_app_sector FROM d_application WHERE aip_app_sector <> '') x""")
def _(t):
    return ag.dim_sectors(t.d_users, "Sector").select(F.lit("identity").alias("source"), "Sector").unionByName(
        ag.dim_sectors(t.d_application, "aip_app_sector").select(F.lit("application").alias("source"), "Sector"))


@query("dim_sites", """
SELECT SiteCode, SiteName, CountryCode FROM (
  SELECT DISTINCT SiteCode, SiteName, CountryCode, 0 AS r FROM d_users UNION SELECT mdm_loc_code, mdm_loc_name, mdm_loc_country, 1 FROM d_mdm) x
QUALIFY row_number() OVER (PARTITION BY SiteCode ORDER BY r, SiteName, CountryCode) = 1""")
def _(t):
    return ag.dim_sites(t.d_users, t.d_mdm)


# -- usage ---------------------------------------------------------------------------------------------------------

TAGS = "CASE WHEN strpos(\"table\", ':') > 0 THEN substr(\"table\", strpos(\"table\", ':') + 1) END AS tags"


def _pivot_sql(table: str) -> str:
    metric = "CASE WHEN name LIKE 'processor utilization%' THEN 'cpu_percent' ELSE name END"
    columns = ", ".join(f"avg(CASE WHEN {metric} = '{m}' THEN value END) AS {m}" for m in us.METRICS[table])
    return f"""SELECT date, server, {TAGS}, {columns} FROM d_usage WHERE "table" LIKE '{table}%' GROUP BY ALL"""


DISK_SQL = f"""
SELECT TIMESTAMP '1970-01-01' + to_milliseconds(date) AS date, server, CASE WHEN tags LIKE '%/data%' THEN '/data' ELSE 'C:' END AS mount,
  CASE WHEN tags LIKE '%device%' THEN '/dev/sd1' ELSE '' END AS device,
  ceil(CASE WHEN u = 0 THEN CASE WHEN p = 1 THEN NULL ELSE a * p / (1 - p) END ELSE u END) AS used_mb,
  round(100 * CASE WHEN p = 0 OR p IS NULL THEN CASE WHEN u + a = 0 THEN NULL ELSE u / (u + a) END ELSE p END) / 100 AS used_percent,
  ceil(a) AS avail_mb, ceil(CASE WHEN t = 0 THEN u + a ELSE t END) AS total_mb, diskq_count, disktime_msec
FROM (SELECT date, server, tags, ceil(sum(used_mb)) AS u, sum(used_percent) / 100 AS p, sum(avail_mb) AS a,
  CASE WHEN sum(used_percent) / 100 = 1 THEN NULL ELSE ceil(sum(avail_mb) / (1 - sum(used_percent) / 100)) END AS t,
  sum(diskq_count) AS diskq_count, sum(disktime_msec) AS disktime_msec FROM ({_pivot_sql('iostat')}) x GROUP BY ALL) y"""
SYSTEM_SQL = f"""SELECT TIMESTAMP '1970-01-01' + to_milliseconds(date) AS date, server, tags, sum(cpu_percent) AS cpu_percent,
  sum(memvirtualusage_percent) AS memvirtualusage_percent, sum(swapusage_percent) AS swapusage_percent,
  sum(memphysusage_percent) AS memphysusage_percent FROM ({_pivot_sql('sysstat')}) x GROUP BY ALL"""
STORAGE_SQL = """SELECT concat('srv', CAST(s_suppkey AS VARCHAR)) AS server, '/dev/sd1' AS mount, 'SAN' AS type,
  s_suppkey * 10 AS charged_used_mb, s_suppkey * 20 AS charged_total_mb FROM supplier"""


def disk(t):
    return us.derive_disk(us.pivot_metrics(t.d_usage, "iostat"))


def system(t):
    return us.derive_system(us.pivot_metrics(t.d_usage, "sysstat"))


def storage(t):
    return t.supplier.select(
        F.concat(F.lit("srv"), F.col("s_suppkey").cast("string")).alias("server"), F.lit("/dev/sd1").alias("mount"), F.lit("SAN").alias("type"),
        (F.col("s_suppkey") * 10).alias("charged_used_mb"), (F.col("s_suppkey") * 20).alias("charged_total_mb"))


@query("pivot_metrics", _pivot_sql("iostat"))
def _(t):
    return us.pivot_metrics(t.d_usage, "iostat")


@query("derive_disk", DISK_SQL)
def _(t):
    return disk(t)


@query("derive_system", SYSTEM_SQL)
def _(t):
    return system(t)


ASSET_SQL = "SELECT aip_server_hostname, aip_server_ip, aip_server_function, aip_app_name, aip_app_sector FROM d_aip"
CAPACITY_SQL = f"""SELECT lower(d.server) AS server, lower(CASE WHEN d.device = '' THEN d.mount ELSE d.device END) AS device, d.date,
  CAST(d.date AS DATE) AS dt, strftime(d.date, '%Y-%m') AS month, d.avail_mb, d.total_mb, coalesce(s.type, 'notFound') AS type,
  s.charged_used_mb, s.charged_total_mb, a.aip_server_ip AS server_ip, a.aip_server_function, a.aip_app_name, a.aip_app_sector,
  CASE WHEN d.total_mb = 0 THEN NULL ELSE round(d.avail_mb / d.total_mb, 2) END AS percent_avail
FROM ({DISK_SQL}) d LEFT JOIN ({STORAGE_SQL}) s ON lower(d.server) = s.server AND lower(CASE WHEN d.device = '' THEN d.mount ELSE d.device END) = s.mount
LEFT JOIN ({ASSET_SQL}) a ON lower(d.server) = a.aip_server_hostname WHERE d.total_mb IS NOT NULL"""


def capacity(t):
    return us.join_capacity(disk(t), storage(t), t.d_aip)


@query("join_capacity", CAPACITY_SQL)
def _(t):
    return capacity(t).select("server", "device", "date", "dt", "month", "avail_mb", "total_mb", "type", "charged_used_mb", "charged_total_mb",
                              "server_ip", "aip_server_function", "aip_app_name", "aip_app_sector", "percent_avail")


def _quantiles(column: str) -> str:
    inner = ", ".join(f"round(quantile_disc({column}, {q}), 2) AS {n}_{column}" for n, q in us.QUANTILES.items())
    return f"min({column}) AS q0_{column}, {inner}, max({column}) AS q100_{column}"


def _profile_sql(entity: str, body: str, source: str) -> str:
    return f"""SELECT CASE WHEN grouping(dt) = 0 THEN 'day' WHEN grouping(month) = 0 THEN 'month' ELSE 'all' END AS grain, {entity}, month, dt, {body}
FROM ({source}) c GROUP BY GROUPING SETS (({entity}, month, dt), ({entity}, month), ({entity}))"""


@query("profile_disk", _profile_sql("server, server_ip, device", f"""count(DISTINCT date) AS count_date, min(type) AS type,
  min(aip_server_function) AS aip_server_function, min(aip_app_name) AS aip_app_name, min(aip_app_sector) AS aip_app_sector,
  min(charged_used_mb) AS charged_used_mb, min(charged_total_mb) AS charged_total_mb, max(total_mb) AS max_total_mb,
  {_quantiles('avail_mb')}, {_quantiles('percent_avail')}""", CAPACITY_SQL))
def _(t):
    return us.profile_disk(capacity(t))


CPU_SQL = f"""SELECT lower(s.server) AS server, s.date, CAST(s.date AS DATE) AS dt, strftime(s.date, '%Y-%m') AS month, s.cpu_percent,
  a.aip_server_ip AS server_ip, a.aip_server_function, a.aip_app_name, a.aip_app_sector
FROM ({SYSTEM_SQL}) s LEFT JOIN ({ASSET_SQL}) a ON lower(s.server) = a.aip_server_hostname WHERE s.cpu_percent IS NOT NULL"""


@query("profile_cpu", _profile_sql("server, server_ip", f"""count(DISTINCT date) AS count_date, min(aip_server_function) AS aip_server_function,
  min(aip_app_name) AS aip_app_name, min(aip_app_sector) AS aip_app_sector, round(avg(cpu_percent), 2) AS avg_cpu_percent,
  {_quantiles('cpu_percent')}""", CPU_SQL))
def _(t):
    return us.profile_cpu(us.join_cpu(system(t), t.d_aip))


@query("approx_distinct", """
SELECT server, count(DISTINCT date) AS exact, true AS within_bound FROM d_usage GROUP BY server""")
def _(t):
    approx = us.approx_samples(t.d_usage, ["server"])
    exact = t.d_usage.groupBy("server").agg(F.count_distinct("date").alias("exact"))
    near = F.abs(F.col("count_date") - F.col("exact")) <= 1 + 0.1 * F.col("exact")
    return exact.join(approx, "server").select("server", "exact", near.alias("within_bound"))


# -- site-map aggregates -------------------------------------------------------------------------------------------

ENDS_SQL = """(SELECT c.*, a.SiteName AS SiteName_Source, b.SiteName AS SiteName_Destination, x.SiteScenario AS SiteCategory_Source,
  y.SiteScenario AS SiteCategory_Destination FROM d_cube c LEFT JOIN d_sites a ON c.SiteCode_Source = a.SiteCode
  LEFT JOIN d_sites b ON c.SiteCode_Destination = b.SiteCode LEFT JOIN d_categories x ON c.SiteCode_Source = x.SiteCode
  LEFT JOIN d_categories y ON c.SiteCode_Destination = y.SiteCode) z"""


def with_ends(t):
    from flowloom.operators.lookups import lookup_categories, lookup_sites_info

    return lookup_categories(lookup_sites_info(t.d_cube, t.d_sites), t.d_categories)


@query("traffic_detail", f"""SELECT {_list(ag.detail_keys('device', False))}, CAST(sum(con_traffic) AS DOUBLE) AS Traffic FROM {ENDS_SQL} WHERE con_traffic <> 0 GROUP BY ALL""")
def _(t):
    return ag.traffic_detail(with_measure(with_ends(t), "SumData"), "device", False)


@query("traffic_detail_users", f"""SELECT {_list(ag.detail_keys('device', True))}, CAST(sum(con_number) AS DOUBLE) AS Traffic,
  string_agg(DISTINCT I_ID_U, ',' ORDER BY I_ID_U) AS I_ID FROM {ENDS_SQL} WHERE con_number <> 0 GROUP BY ALL""")
def _(t):
    return ag.traffic_detail(with_measure(with_ends(t), "SumConnect"), "device", True)
