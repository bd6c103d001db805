"""Daily aggregates, flow tables, published cubes and dimension lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions import list_items
from flowloom.operators import usersets as us
from flowloom.operators.filters import closed_only
from flowloom.operators.joining import PLACE, place_of, placed, semi_join, union_by_name

AIP_AGG = [
    "aip_app_name", "aip_server_function", "aip_server_subfunction", "aip_app_criticality", "aip_app_type",
    "aip_app_sector", "aip_app_shared_unique_id", "aip_server_adminby", "aip_app_state", "aip_appinstance_type",
]
SOURCE_AIP = [f"source_{c}" for c in AIP_AGG]
DEST_AIP = [f"dest_{c}" for c in AIP_AGG]
APP = ["source_app_name", "source_app_category", "source_app_exec", "url"]
DEST = ["dest_ip", "dest_site", "dest_port", "con_protocol", "con_status", "dest_aip_server_hostname"]
UNIT = ["dt", "month", "engine", "filedt"]

SERVER_DAY_KEYS = ["source_sector", "source_ip", "source_aip_server_hostname", "source_site", *APP, *SOURCE_AIP,
                   *DEST, *DEST_AIP, *UNIT]
DEVICE_DAY_KEYS = ["source_sector", "source_I_ID_site", "source_site", "source_teranga", *APP, *SOURCE_AIP,
                   *DEST, *DEST_AIP, *UNIT]

FLOW_KEYS = ["server_ip", "server_site", "server_aip_app_name", "server_sector", "remote_type", "collecttype",
             "remote_site", "remote_sector"]

MEASURES = {  # site-map measure → cube column
    "SumConnect": "con_number",
    "SumData": "con_traffic",
    "ConnectTimesData": "con_times_traffic",
    "CountSumUniqueLogin": "distinct_I_ID_U",
}


def cube_keys(collecttype: str, level: str, resolution: str = "IDM") -> list[str]:
    """Group keys of a published cube: 33 / 29 for devices, 34 / 28 for servers."""
    detail = level == "detail"
    ends = ["con_status", "dest_site"]
    if detail:
        ends = ["dest_ip", "dest_aip_server_hostname", "dest_port", "con_protocol", "dest_site", "con_status"]
    if collecttype == "device":
        site = "source_I_ID_site" if resolution == "IDM" else "source_site"
        first = ["source_sector", site, "source_teranga"]
    elif detail:
        first = ["source_sector", "source_ip", "source_aip_server_hostname", "source_site"]
    else:
        first = ["source_sector", "source_site"]
    return [*first, *APP, *SOURCE_AIP, *ends, *DEST_AIP]


REST = "_rest"


def hashed_rest(rows: DataFrame, keys: list[str], shown: list[str] | None) -> tuple[DataFrame, list[str]]:
    """``rows`` with those of the ``keys`` that are not ``shown`` as one hash, and what to group by instead of ``keys``.

    The groups are the same (two of N share a hash of 64 bits with a chance of N² / 2⁶⁵), but texts that no reader of a table
    wants are not shuffled. Null is told apart from every value. Without ``shown``, or for rows that have the hash, nothing changes.
    """
    if shown is None:
        return rows, keys
    if REST in rows.columns:
        return rows, [*shown, REST]
    rest = [k for k in keys if k not in shown]
    told = [c for k in rest for c in (F.col(k), F.col(k).isNull())]
    return rows.withColumn(REST, F.xxhash64(*told)), [*shown, REST]


def agg_server_day(resolved: DataFrame, ignore_unknown_duration: bool = False, shown: list[str] | None = None) -> DataFrame:
    """Daily server flows. ``ignore_unknown_duration`` leaves the -1 placeholder out of the mean. Placed rows stay placed.

    ``shown`` are the only keys that a table made of it reads (``hashed_rest``).
    """
    duration = F.nullif(F.col("con_duration"), F.lit(-1)) if ignore_unknown_duration else F.col("con_duration")
    rows, keys = hashed_rest(resolved, SERVER_DAY_KEYS, shown)
    return rows.groupBy(*place_of(rows), *keys).agg(
        F.sum("con_number").alias("con_number"), F.sum("con_traffic_in").alias("con_traffic_in"),
        F.sum("con_traffic_out").alias("con_traffic_out"), F.avg(duration).alias("con_duration"))


def with_members(df: DataFrame, keys: list, members: str, sums: dict[str, Column], as_name: str,
                 count_name: str | None = None, is_list: bool = True, separator: str = ",") -> DataFrame:
    """Sums per key and the set of members seen, as sorted text.

    Two steps: first one row per key and member, so a hot key is spread over
    its members and repeats vanish before any list is built; then one row per
    key. A list column is exploded with its position, and only the first
    position carries the measures.

    Rows that are ``placed`` by columns the keys determine are summed up where
    they are, in one step, and stay placed.
    """
    if is_list:
        names = df.select("*", F.posexplode_outer(list_items(F.col(members), separator)).alias("_pos", "_member"))
        first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
        partial = {n: F.sum(F.when(first, c)) for n, c in sums.items()}
    else:
        names = df.withColumn("_member", F.nullif(F.col(members), F.lit("")))
        partial = {n: F.sum(c) for n, c in sums.items()}
    if place_of(df):
        found = names.groupBy(PLACE, *keys).agg(*[c.alias(n) for n, c in partial.items()], F.array_sort(F.collect_set("_member")).alias("_members"))
        return _as_text(found, found.columns[:1 + len(keys)], sums, as_name, count_name, separator)
    step = names.groupBy(*keys, "_member").agg(*[c.alias(n) for n, c in partial.items()])
    key_names = [k if isinstance(k, str) else step.columns[i] for i, k in enumerate(keys)]
    result = step.groupBy(*key_names).agg(
        *[F.sum(n).alias(n) for n in sums], F.array_sort(F.collect_list("_member")).alias("_members"))
    return _as_text(result, key_names, sums, as_name, count_name, separator)


def _as_text(found: DataFrame, key_names: list[str], sums: dict[str, Column], as_name: str, count_name: str | None, separator: str) -> DataFrame:
    extra = [F.array_join("_members", separator).alias(as_name)]
    if count_name:
        extra.append(F.size("_members").alias(count_name))
    return found.select(*key_names, *sums, *extra)


def agg_device_day(resolved: DataFrame, ignore_unknown_duration: bool = False, together: list | None = None) -> DataFrame:
    """Daily device flows with the distinct users and their number.

    The rows are shuffled once. ``together`` are expressions of the daily keys by which the result stays ``placed``, for a table made of it.
    """
    duration = F.nullif(F.col("con_duration"), F.lit(-1)) if ignore_unknown_duration else F.col("con_duration")
    sums = {
        "con_number": F.col("con_number"), "con_traffic_in": F.col("con_traffic_in"),
        "con_traffic_out": F.col("con_traffic_out"), "_dur": duration,
        "_durs": F.when(duration.isNotNull(), F.lit(1).cast("bigint")),
    }
    rows = with_members(placed(resolved, together or DEVICE_DAY_KEYS), DEVICE_DAY_KEYS, "I_ID_U", sums, "I_ID_U", "distinct_I_ID_U", is_list=False)
    return rows.select(*([PLACE] if together else []), *DEVICE_DAY_KEYS, "con_number", "con_traffic_in", "con_traffic_out",
                       F.try_divide(F.col("_dur").cast("double"), F.col("_durs")).alias("con_duration"),
                       "I_ID_U", "distinct_I_ID_U")


def device_day_sets(resolved: DataFrame, dictionary: DataFrame, ignore_unknown_duration: bool = False, together: list | None = None,
                    shown: list[str] | None = None) -> DataFrame:
    """Daily device flows with the set of their users as a bitmap (``users``) and its size; what the jobs store.

    The rows are shuffled once. ``together`` as in ``agg_device_day``, ``shown`` as in ``agg_server_day``.
    """
    duration = F.nullif(F.col("con_duration"), F.lit(-1)) if ignore_unknown_duration else F.col("con_duration")
    sums = {
        "con_number": F.col("con_number"), "con_traffic_in": F.col("con_traffic_in"),
        "con_traffic_out": F.col("con_traffic_out"), "_dur": duration,
        "_durs": F.when(duration.isNotNull(), F.lit(1).cast("bigint")),
    }
    rows, keys = hashed_rest(resolved, DEVICE_DAY_KEYS, shown)
    rows = placed(us.numbered(rows, "I_ID_U", dictionary), together or keys).withColumn("_user", us.single(F.col("_number")))
    found = us.gather(rows, keys, "_user", sums, "users", "distinct_I_ID_U")
    return found.select(*([PLACE] if together else []), *keys, "con_number", "con_traffic_in", "con_traffic_out",
                        F.try_divide(F.col("_dur").cast("double"), F.col("_durs")).alias("con_duration"), "users", "distinct_I_ID_U")


def agg_socket_day(resolved: DataFrame, shown: list[str] | None = None) -> DataFrame:
    """Daily socket flows; the traffic of sockets is unknown and stays NULL."""
    return agg_server_day(resolved.filter(F.col("collecttype") == "linux"), shown=shown)


# Columns a flow row takes from each side of an aggregate row.
def _server_side(end: str) -> dict[str, str]:
    return {"server_ip": f"{end}_ip", "server_site": f"{end}_site", "server_aip_app_name": f"{end}_aip_app_name",
            "server_sector": f"{end}_aip_app_sector"}


def _remote_side(end: str) -> dict[str, str | None]:
    return {"remote_sector": f"{end}_aip_app_sector", "remote_site": f"{end}_site", "remote_ip": f"{end}_ip",
            "remote_app_exec": "source_app_exec" if end == "source" else None,
            "remote_aip_app_name": f"{end}_aip_app_name"}


# What every role of a flow determines: daily rows placed by these columns give roles that need no shuffle.
SERVER_PLACE = ["dt", "source_ip", "dest_ip", "dest_port", "con_protocol"]
DEVICE_PLACE = ["dt", "month", "dest_ip", "dest_site", "dest_aip_app_name", "dest_aip_app_sector", "source_sector", "source_I_ID_site",
                "source_app_exec", "dest_port", "con_protocol"]
DEVICE_REMOTE = {"remote_sector": "source_sector", "remote_site": "source_I_ID_site", "remote_ip": None,
                 "remote_app_exec": "source_app_exec", "remote_aip_app_name": None}


def _role(mapping: dict[str, str | None], remote_type: str) -> Column:
    """The columns one end contributes, as a struct."""
    ends = [(F.lit(None).cast("string") if c is None else F.col(c)).alias(n) for n, c in mapping.items()]
    return F.struct(F.lit(remote_type).alias("remote_type"), *ends)


FLOW_ROW = ["collecttype", "remote_type", "dt", "month", "server_ip", "server_site", "server_aip_app_name", "server_sector",
            "remote_sector", "remote_site", "remote_ip", "remote_app_exec", "remote_aip_app_name", "server_port", "con_protocol"]


def _roles(daily: DataFrame, collecttype: str, roles: list[Column], keep: list[str] = [], row: list[str] = FLOW_ROW) -> DataFrame:
    """Closed flows, once per role of their server: one scan serves all roles. Placed rows stay placed."""
    keep = [*place_of(daily), *keep]
    own = {"collecttype": F.lit(collecttype), "dt": F.col("dt"), "month": F.col("month"), "server_port": F.col("dest_port"), "con_protocol": F.col("con_protocol")}
    seen = daily.filter(closed_only()).select(
        *[c.alias(n) for n, c in own.items() if n in row], F.explode(F.array(*roles)).alias("r"), "con_number",
        (F.col("con_traffic_in") + F.col("con_traffic_out")).alias("con_traffic"), *keep)
    return seen.select(*[F.col(c) if c in own else F.col(f"r.{c}").alias(c) for c in row], "con_number", "con_traffic", *keep)


def _server_roles(server: DataFrame, sockets: DataFrame, together: list | None = None) -> DataFrame:
    """Flows of servers, summed: a server flow counts twice, its destination has a client and its source talks to a server. Placed if ``together`` is given."""
    both = [_role({**_server_side("dest"), **_remote_side("source")}, "client"),
            _role({**_server_side("source"), **_remote_side("dest")}, "server")]
    kinds = [_roles(server, "nxserver", both), _roles(sockets, "linuxserver", both)]  # their rows never have equal keys
    if together:
        kinds = [placed(rows, together) for rows in kinds]
    summed = [rows.groupBy(*place_of(rows), *FLOW_ROW).agg(F.sum("con_number").alias("con_number"), F.sum("con_traffic").alias("con_traffic")).drop(PLACE) for rows in kinds]
    return summed[0].unionByName(summed[1])


def _device_roles(device: DataFrame, members: str, row: list[str] = FLOW_ROW) -> DataFrame:
    """Device flows: each is a client of its destination."""
    return _roles(device, "nxdevice", [_role({**_server_side("dest"), **DEVICE_REMOTE}, "client")], [members], row)


def flow_detail(device: DataFrame, server: DataFrame, sockets: DataFrame) -> DataFrame:
    """Daily flows of every server from all roles, with the users of device flows as text."""
    counted = _server_roles(server, sockets).withColumns(
        {"client_user": F.lit(None).cast("string"), "distinct_client_user": F.lit(None).cast("int")})
    sums = {"con_number": F.col("con_number"), "con_traffic": F.col("con_traffic")}
    with_users = with_members(_device_roles(device, "I_ID_U"), FLOW_ROW, "I_ID_U", sums, "client_user", "distinct_client_user")
    return with_users.drop(PLACE).unionByName(counted)


def flow_detail_sets(device: DataFrame, server: DataFrame, sockets: DataFrame, together: list | None = None) -> DataFrame:
    """Daily flows of every server from all roles, with the users of device flows as a bitmap (``client_users``).

    ``device`` is a table of ``device_day_sets``. ``together`` are expressions of the keys of a flow row by which its rows are brought together.
    """
    counted = _server_roles(server, sockets, together).withColumns(
        {"client_users": F.lit(None).cast(us.SET), "distinct_client_user": F.lit(None).cast("int")})
    sums = {"con_number": F.col("con_number"), "con_traffic": F.col("con_traffic")}
    with_users = us.gather(placed(_device_roles(device, "users"), together or FLOW_ROW), FLOW_ROW, "users", sums, "client_users", "distinct_client_user")
    return with_users.drop(PLACE).unionByName(counted)


# Daily keys that make a flow key of a client of the destination, and all that the flow tables by month and over all time read besides the month.
DEVICE_FLOW = ["dest_ip", "dest_site", "dest_aip_app_name", "dest_aip_app_sector", "source_I_ID_site", "source_sector"]
CLIENT_FLOW = ["dest_ip", "dest_site", "dest_aip_app_name", "dest_aip_app_sector", "source_site", "source_aip_app_sector"]
DEVICE_READ = [*DEVICE_FLOW, "source_app_exec", "con_status"]
SERVER_READ = [*CLIENT_FLOW, "source_ip", "source_aip_app_name", "source_app_exec", "con_status"]


def flow_rows(device: DataFrame, server: DataFrame, sockets: DataFrame, by_month: bool) -> list[DataFrame]:
    """The rows that ``flow_detail_sets`` sums up, as they are: enough for ``flow_parts``, which sums up anyway.

    One frame per collect type and role, so that no two hold the same flow key, with the rows of a flow key (and month) ``placed`` together.
    Daily rows are not placed, or by ``DEVICE_FLOW`` and ``CLIENT_FLOW`` (and the month); then only the flows of servers as clients are shuffled
    again. The rows of one key meet in one task, whose aggregates spill; no list is held for a flow key.
    """
    keys = [*(["month"] if by_month else []), *FLOW_KEYS]
    row = [*keys, "remote_ip", "remote_app_exec"]
    client = _role({**_server_side("dest"), **_remote_side("source")}, "client")
    served = _role({**_server_side("source"), **_remote_side("dest")}, "server")
    kinds = [_device_roles(device, "users", row).withColumnRenamed("users", "client_users")]
    for daily, kind in ((server, "nxserver"), (sockets, "linuxserver")):
        kinds += [_roles(daily, kind, [client], row=row), _roles(daily, kind, [served], row=row).drop(PLACE)]
    return [rows if place_of(rows) else placed(rows, keys) for rows in kinds]


ADDRESS, PROGRAM, USERS = 0, 1, 2  # what a part counts


def flow_parts(flows: DataFrame, also: list[str], members: str = "client_users") -> DataFrame:
    """Mergeable parts of the flow tables: per flow key (and the columns ``also``) one row for each remote address, program and bucket of users.

    Parts of different days and months unite by adding measures and joining words, so a month is made once. The measures stand on the
    rows of addresses, for flows without one on their program; a program that is not known has no part. ``flows`` are rows of ``flow_detail_sets``, or any rows with its keys, measures and a set
    (none: no users). Rows placed by their flow keys are not shuffled, and their parts stay placed.
    """
    none = F.lit(None).cast("bigint")

    def part(kind, value, bucket, word, traffic=none, number=none):
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), bucket.alias("bucket"), word.alias("word"),
                        traffic.cast("bigint").alias("con_traffic"), number.cast("bigint").alias("con_number"))

    address, program, measures = F.col("remote_ip"), F.col("remote_app_exec"), [F.col("con_traffic"), F.col("con_number")]
    ends = (F.when(program.isNull(), F.array(part(ADDRESS, address, none, none, *measures)))
            .when(address.isNull(), F.array(part(PROGRAM, program, none, none, *measures)))
            .otherwise(F.array(part(ADDRESS, address, none, none, *measures), part(PROGRAM, program, none, none))))
    held = F.coalesce(F.col(members), F.array().cast(us.SET)) if members in flows.columns else F.array().cast(us.SET)
    users = F.transform(held, lambda w: part(USERS, F.lit(None), w["bucket"], w["word"]))
    keys = [*place_of(flows), *also, *FLOW_KEYS]
    return merge_parts(flows.select(*keys, F.explode(F.concat(ends, users)).alias("p")).select(*keys, "p.*"), also)


def merge_parts(parts: DataFrame, also: list[str]) -> DataFrame:
    """Parts of equal keys as one. Placed parts stay placed."""
    return parts.groupBy(*place_of(parts), *also, *FLOW_KEYS, "kind", "value", "bucket").agg(
        F.sum("con_traffic").alias("con_traffic"), F.sum("con_number").alias("con_number"), F.bit_or("word").alias("word"))


def count_parts(parts: DataFrame, by_month: bool) -> DataFrame:
    """The flow table of merged parts: distinct remote addresses, programs and users, and the measures."""
    def held(kind):
        return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())

    return parts.groupBy(*place_of(parts), *(["month"] if by_month else []), *FLOW_KEYS).agg(
        held(ADDRESS).alias("count_distinct_remote_ip"), held(PROGRAM).alias("count_distinct_remote_app_exec"),
        F.sum("con_traffic").alias("con_traffic"), F.sum("con_number").alias("con_number"),
        F.coalesce(F.sum(F.bit_count("word")), F.lit(0)).cast("int").alias("distinct_client_user")).drop(PLACE)


def flow_summary(kinds: list[DataFrame], by_month: bool) -> DataFrame:
    """Flows per month or over all time, with distinct remote addresses, programs and users, from frames that share no flow key, as those of ``flow_rows``."""
    return union_by_name([count_parts(flow_parts(rows, ["month"] if by_month else []), by_month) for rows in kinds])


def published_input(daily: DataFrame) -> DataFrame:
    """Whole-number measures, text NULLs as ``NA`` and number NULLs as 0."""
    measures = {c: F.col(c).try_cast("bigint") for c in ("con_number", "con_traffic_in", "con_traffic_out")}
    shown = [c for c in daily.columns if c != PLACE]
    return daily.withColumns(measures).fillna("NA", shown).fillna(0, shown)


def published_keys(daily: DataFrame, keys: list[str]) -> list[Column]:
    """``keys`` as ``published_input`` shows them."""
    return [F.coalesce(F.col(k), F.lit("NA") if daily.schema[k].dataType == T.StringType() else F.lit(0)) for k in keys]


def cube(daily: DataFrame, collecttype: str, level: str, resolution: str = "IDM") -> DataFrame:
    """Published cube: connection count, traffic, their product and, for devices, the users.

    Daily rows that are ``placed`` by the keys of the cube are not shuffled again.
    """
    traffic = F.col("con_traffic_in") + F.col("con_traffic_out")
    sums = {"con_number": F.col("con_number"), "con_traffic": traffic, "con_times_traffic": traffic * F.col("con_number")}
    keys = cube_keys(collecttype, level, resolution)
    if collecttype == "device":
        return with_members(daily, keys, "I_ID_U", sums, "I_ID_U", "distinct_I_ID_U").drop(PLACE)
    return daily.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def cube_of(daily: DataFrame, keys: list[str], collecttype: str) -> DataFrame:
    """Cube measures of daily rows over any keys; for devices from ``device_day_sets``, with their users as a bitmap."""
    traffic = F.col("con_traffic_in") + F.col("con_traffic_out")
    rows = daily.withColumns({"con_traffic": traffic, "con_times_traffic": traffic * F.col("con_number")})
    return merge_cubes(rows, keys, collecttype)


def merge_cubes(rows: DataFrame, keys: list[str], collecttype: str) -> DataFrame:
    """Cube rows of equal keys as one: measures add up, bitmaps unite. Placed rows stay placed."""
    sums = {c: F.col(c) for c in ("con_number", "con_traffic", "con_times_traffic")}
    if collecttype == "device":
        return us.gather(rows, keys, "users", sums, "users", "distinct_I_ID_U")
    return rows.groupBy(*place_of(rows), *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def cube_without_detail(detail: DataFrame, collecttype: str, resolution: str = "IDM") -> DataFrame:
    """The small cube from the detailed one of the same days: its measures add up and its user lists unite."""
    keys = cube_keys(collecttype, "nodetail", resolution)
    sums = {c: F.col(c) for c in ("con_number", "con_traffic", "con_times_traffic")}
    if collecttype == "device":
        return with_members(detail, keys, "I_ID_U", sums, "I_ID_U", "distinct_I_ID_U")
    return detail.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def valid_days(ledger_units: DataFrame, collecttype: str, min_engines: int) -> DataFrame:
    """Days on which at least ``min_engines`` engines delivered."""
    return (ledger_units.filter(F.col("collecttype") == collecttype).groupBy("dt")
            .agg(F.count_distinct("engine").alias("engine_count")).filter(F.col("engine_count") >= min_engines))


def date_ranges(days: DataFrame, fixed_start: str) -> DataFrame:
    """First and last day of the four named ranges."""
    last, first = F.max("dt"), F.min("dt")
    one = days.agg(first.alias("first"), last.alias("last"))
    starts = F.array(
        F.struct(F.lit("Full").alias("name"), F.col("first").alias("d")),
        F.struct(F.lit("6Weeks").alias("name"), F.date_sub("last", 42).alias("d")),
        F.struct(F.lit("LastWeek").alias("name"), F.date_sub("last", 7).alias("d")),
        F.struct(F.lit("DayOne").alias("name"), F.lit(fixed_start).cast("date").alias("d")))
    return one.select(F.explode(starts).alias("r"), "last").select(
        F.col("r.name").alias("date_range"), F.col("r.d").alias("firstDate"), F.col("last").alias("lastDate"))


def in_valid_days(daily: DataFrame, days: DataFrame, first) -> DataFrame:
    return semi_join(daily, days.filter(F.col("dt") >= F.lit(first).cast("date")).select("dt"), ["dt"])


def dim_sectors(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty sectors in order."""
    return (df.select(F.col(column).alias("Sector")).filter(F.coalesce(F.col("Sector"), F.lit("")) != "")
            .distinct().orderBy("Sector"))


def dim_sites(identities: DataFrame, ranges: DataFrame) -> DataFrame:
    """One row per site: the identity repository wins over the network repository, then the least name."""
    from_users = identities.select("SiteCode", "SiteName", "CountryCode", F.lit(0).alias("_rank")).distinct()
    from_ranges = ranges.select(F.col("mdm_loc_code").alias("SiteCode"), F.col("mdm_loc_name").alias("SiteName"),
                                F.col("mdm_loc_country").alias("CountryCode"), F.lit(1).alias("_rank")).distinct()
    best = F.min(F.struct("_rank", "SiteName", "CountryCode")).alias("b")
    return from_users.unionByName(from_ranges).groupBy("SiteCode").agg(best).select(
        "SiteCode", F.col("b.SiteName").alias("SiteName"), F.col("b.CountryCode").alias("CountryCode"))


DETAIL_DEST = ["dest_aip_app_name", "dest_aip_server_function", "dest_aip_server_subfunction", "dest_aip_app_criticality",
               "dest_aip_app_type", "dest_aip_app_sector", "dest_aip_app_shared_unique_id", "dest_aip_appinstance_type",
               "dest_aip_server_adminby"]


def detail_keys(source: str, detailed: bool) -> list[str]:
    """Keys of the result table of the site-map query."""
    ends = [f"{c}_{e}" for e in ("Source", "Destination") for c in ("SiteCode", "SiteName", "SiteCategory")]
    flow = ["dest_ip", "dest_aip_server_hostname", "dest_port", "con_protocol"]
    if source == "server":
        own = ["source_aip_app_name", "source_aip_server_function", "source_aip_server_subfunction",
               "source_aip_app_criticality", "source_aip_app_type", "source_aip_app_sector",
               "source_aip_app_shared_unique_id", "source_aip_appinstance_type", "source_aip_server_adminby"]
        return ["source_ip", "source_aip_server_hostname", "source_app_name", "source_app_exec", "url", *own, *flow,
                *DETAIL_DEST, *ends]
    return [*ends, "source_sector", "source_teranga", "source_app_name", "source_app_exec", "url",
            *(flow if detailed else []), *DETAIL_DEST]


def traffic_detail(flows: DataFrame, source: str = "device", detailed: bool = False) -> DataFrame:
    """Traffic per result row, rounded half to even; detailed device rows list their users and are shuffled once for sums and lists."""
    keys = detail_keys(source, detailed)
    moving = flows.filter(F.col("Traffic") != 0)
    if source == "device" and detailed:
        rows = with_members(placed(moving, keys), keys, "I_ID_U", {"Traffic": F.col("Traffic")}, "I_ID").drop(PLACE)
        return rows.withColumn("Traffic", F.bround(F.col("Traffic").cast("double"), 0))
    return moving.groupBy(*keys).agg(F.bround(F.sum("Traffic").cast("double"), 0).alias("Traffic"))


