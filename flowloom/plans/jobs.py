"""The jobs: compositions of the operators, each a plain function.

Every job writes its data first and its ledger entries last, and both writes
change nothing when they are repeated, so a job that died is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import day_of, hour_of, strip_quotes
from flowloom.operators import aggregates as ag
from flowloom.operators import filters as fl
from flowloom.operators import ledger as lg
from flowloom.operators import lookups as lk
from flowloom.operators import matrix as mx
from flowloom.operators import privacy as pv
from flowloom.operators import projections as pj
from flowloom.operators import sockets as sk
from flowloom.operators import usage as us
from flowloom.operators import usersets
from flowloom.operators.clustering import kmeans_clusters, markov_clusters
from flowloom.operators.joining import PLACE, lookup_join, partition_places, placed, semi_join
from flowloom.plans.context import JobContext
from flowloom.session import COMPRESSION, cut_lineage, work_path
from flowloom.sources import deliveries as dl
from flowloom.sources import logs
from flowloom.sources import readers as rd
from flowloom.sources import sinks as sn

# Names that other systems read — columns of the listener table, resolutions and names of the published cubes.
LISTENER_COLUMNS = ["date", "time", "host_name", "host_sid", "source_program", "source_host_name", "source_host_ip", "source_user",
                    "host_port", "host_instance", "source_filename", "source_filedate", "integration_date", "file_first_date", "file_last_date"]
RESOLUTIONS = {"device": ["IDM", "Device"], "server": ["IDM"]}
CUBE_STEMS = {("device", "nodetail"): "AppliSite", ("device", "detail"): "AppliSiteServer", ("server", "nodetail"): "AppliServer2Server", ("server", "detail"): "AppliDetailServer2Server"}


def event_ledger(spark: SparkSession, ctx: JobContext) -> DataFrame:
    return rd.read_or_empty(spark, ctx.path("meta"), lg.LEDGER_SCHEMA)


def socket_ledger(spark: SparkSession, ctx: JobContext) -> DataFrame:
    return rd.read_or_empty(spark, ctx.path("meta_sockets"), f"{lg.SOCKET_SCHEMA}, {dl.DELIVERY} string")


def _store(rows: DataFrame, ctx: JobContext, folder: str, units: list[str],
           entries: DataFrame, ledger: str, staged: bool = False) -> None:
    """Data, then ledger; a failure in between leaves units that the next run stores again."""
    sn.write_units(rows, ctx.path(folder), units, list(ctx.partitions), staged)
    sn.append_ledger(entries, ctx.path(ledger))


# -- events --------------------------------------------------------------------------------------------------------


def encode_rows(spark: SparkSession, ctx: JobContext, filetype: str, raw: DataFrame) -> DataFrame:
    """Typed rows of one delivery that the ledger does not cover; whole days only for connections and executions."""
    typed = pj.project_event(raw, filetype, list(ctx.server_engines))
    fresh = lg.new_rows(typed, event_ledger(spark, ctx), filetype)
    if filetype not in pj.END_TIME or filetype == "webrequest":  # an unknown type passes as it is
        return fresh
    return lg.complete_rows(fresh, hour_of(F.col(pj.END_TIME[filetype])))


def encode(spark: SparkSession, ctx: JobContext, inputs: dict[str, DataFrame]) -> None:
    """Encode raw extracts, given by file type."""
    for filetype, raw in inputs.items():
        # Encoded rows are kept by file; the jobs after this one take the earliest file of a unit and replace what they stored from a later one.
        # One pass over the extract: the new whole days are written apart, then stored and recorded.
        rows = cut_lineage(encode_rows(spark, ctx, filetype, raw), f"encode-{filetype}")
        _store(rows, ctx, filetype, [*lg.UNIT, "filedt"], lg.ledger_entries(rows, filetype, lg.ENCODE), "meta", staged=True)


def encode_files(spark: SparkSession, ctx: JobContext, paths: list[str]) -> None:
    """Encode extract files; executions may come in several widths."""
    inputs = {}
    for filetype, files in rd.group_by_type(paths).items():
        columns = {"connection": pj.CONNECTION, "webrequest": pj.WEBREQUEST}.get(filetype)
        if filetype == "execution":
            inputs[filetype] = rd.read_evolving(spark, files, "I_ID_D")
        else:
            inputs[filetype] = rd.read_extract(spark, files, list(columns) if columns else None)
    encode(spark, ctx, inputs)


def _stored_rows(spark: SparkSession, ctx: JobContext, folder: str, units: DataFrame) -> DataFrame:
    """Stored rows of the units, from the partitions of their days alone."""
    return lg.rows_of_units(lg.in_days_of(spark.read.parquet(ctx.path(folder)), units), units)


def _recorded(units: DataFrame, stage: str) -> DataFrame:
    return units.select("filetype", F.lit(stage).alias("stage"), *lg.UNIT, F.col("min_filedt").alias("filedt")).distinct()


def _window(units: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first is not None:
        units = units.filter(F.col("dt") >= F.lit(str(first)).cast("date"))
    if last is not None:
        units = units.filter(F.col("dt") <= F.lit(str(last)).cast("date"))
    return units


def site_lookup(ranges: DataFrame) -> DataFrame:
    """The pieces of the address ranges, written apart once because both ends of every flow use them."""
    return cut_lineage(lk.site_segments(ranges), "segments")


def resolve_connections(connections: DataFrame, webrequests: DataFrame, ranges: DataFrame, identities: DataFrame,
                        assets: DataFrame) -> DataFrame:
    """Connections with sites, user, assets and URLs."""
    sited = lk.resolve_sites(connections, site_lookup(ranges), {"source_ip": "source_site", "dest_ip": "dest_site"})
    return lk.join_urls(lk.resolve_assets(lk.resolve_users(sited, identities), assets), webrequests)


def resolve(spark: SparkSession, ctx: JobContext, ranges: DataFrame, identities: DataFrame, assets: DataFrame,
            first: str | None = None, last: str | None = None) -> DataFrame:
    """Resolve the encoded connections whose web requests have arrived too; returns all that is stored, which may be nothing yet."""
    units = cut_lineage(_window(lg.pending_connections(event_ledger(spark, ctx)), first, last), "units")
    connections = _stored_rows(spark, ctx, "connection", units)
    webrequests = _stored_rows(spark, ctx, "webrequest", units)
    rows = resolve_connections(connections, webrequests, ranges, identities, assets)
    _store(rows, ctx, "resolved", lg.UNIT, _recorded(units, lg.RESOLVE), "meta")
    return sn.read_stored(rows, ctx.path("resolved"))


def resolve_execution_rows(executions: DataFrame, ranges: DataFrame, identities: DataFrame, assets: DataFrame) -> DataFrame:
    sited = lk.resolve_sites(executions, site_lookup(ranges), {"source_ip": "source_site"})
    return lk.resolve_assets(lk.resolve_users(sited, identities), assets, ends=("source",))


def resolve_executions(spark: SparkSession, ctx: JobContext, ranges: DataFrame, identities: DataFrame, assets: DataFrame,
                       first: str | None = None, last: str | None = None) -> DataFrame:
    """Resolve the encoded executions; returns all that is stored."""
    units = cut_lineage(_window(lg.pending_executions(event_ledger(spark, ctx)), first, last), "units")
    executions = _stored_rows(spark, ctx, "execution", units)
    rows = resolve_execution_rows(executions, ranges, identities, assets)
    _store(rows, ctx, "resolved_execution", lg.UNIT, _recorded(units, lg.RESOLVE_EXECUTION), "meta")
    return sn.read_stored(rows, ctx.path("resolved_execution"))


def known_users(spark: SparkSession, ctx: JobContext) -> DataFrame:
    return rd.read_or_empty(spark, ctx.path("users"), usersets.DICTIONARY)


def number_users(spark: SparkSession, ctx: JobContext, rows: DataFrame) -> DataFrame:
    """The dictionary of user numbers, after the users of ``rows`` that it lacked were added. Numbers never change."""
    fresh = cut_lineage(usersets.number_names(rows, "I_ID_U", known_users(spark, ctx)), "new-users")
    if not fresh.isEmpty():
        fresh.write.mode("append").option("compression", COMPRESSION).parquet(ctx.path("users"))
    return known_users(spark, ctx)


def daily_devices(spark: SparkSession, ctx: JobContext) -> DataFrame:
    """The stored daily device flows with their users as text, as they are exported."""
    return usersets.with_names(spark.read.parquet(ctx.path("agg/device")), "users", known_users(spark, ctx), "I_ID_U")


def aggregate(spark: SparkSession, ctx: JobContext, first: str | None = None, last: str | None = None) -> None:
    """Daily aggregates of the resolved connections."""
    units = cut_lineage(_window(lg.pending_aggregates(event_ledger(spark, ctx)), first, last), "units")
    if units.isEmpty():  # the folder of resolved rows may hold no file yet
        return
    rows = _stored_rows(spark, ctx, "resolved", units)
    devices = rows.filter(F.col("collecttype") == "device")
    # The rows of a partition are brought together once, for the sums and for the files.
    by_server, by_device = (partition_places(list(ctx.partitions), keys) for keys in (ag.SERVER_DAY_KEYS, ag.DEVICE_DAY_KEYS))
    server = ag.agg_server_day(placed(rows.filter(F.col("collecttype") == "server"), by_server))
    device = ag.device_day_sets(devices, number_users(spark, ctx, devices), together=by_device)
    for folder, daily in (("agg/server", server), ("agg/device", device)):
        sn.write_units(daily, ctx.path(folder), ["dt", "engine"], list(ctx.partitions))
    sn.append_ledger(_recorded(units, lg.AGGREGATE), ctx.path("meta"))


# -- sockets -------------------------------------------------------------------------------------------------------


# Snapshots and usage samples are stored by delivery (sources/deliveries.py): a run adds files and touches no others.
SNAPSHOT, SNAPSHOT_PARTITIONS = ["server_ip", "dt"], ["month", "day"]
RESOLVED_SNAPSHOT, RESOLVED_PARTITIONS = ["engine", "snapshot"], ["month", "dt"]


def encode_sockets(spark: SparkSession, ctx: JobContext, inputs: dict[str, DataFrame]) -> None:
    """Encode socket, process and netstat snapshots, given by kind."""
    ledger = socket_ledger(spark, ctx)
    for kind, raw in inputs.items():
        name = dl.new_delivery()
        rows = cut_lineage(lg.new_snapshots(pj.project_snapshot(raw), ledger, kind).withColumn("day", day_of(F.col("dt"))), f"encode-{kind}")
        if rows.isEmpty():
            continue
        dl.deliver(rows, ctx.path(kind), SNAPSHOT_PARTITIONS, name)
        sn.append_ledger(lg.socket_entries(rows, kind, lg.ENCODE_SOCKETS).withColumn(dl.DELIVERY, F.lit(name)), ctx.path("meta_sockets"))


def _snapshots(spark: SparkSession, ctx: JobContext, kind: str, units: DataFrame) -> DataFrame:
    """Stored rows of the snapshots ``units``, from the deliveries that count."""
    entries = semi_join(lg.deliveries_of(socket_ledger(spark, ctx), lg.ENCODE_SOCKETS, kind), units, SNAPSHOT)
    return dl.delivered(lg.in_snapshot_days(spark.read.parquet(ctx.path(kind)), units), cut_lineage(entries, "entries"), SNAPSHOT).drop("day", dl.DELIVERY)


def resolve_socket_rows(sockets: DataFrame, processes: DataFrame, ranges: DataFrame, assets: DataFrame,
                        strict_ip: bool = False) -> DataFrame:
    """Directed socket flows with assets and sites; an asset never replaces a site here."""
    flows = sk.socket_flows(sk.directed_sockets(sockets, processes), strict_ip)
    with_assets = lk.resolve_assets(flows, assets, site_fallback=False)
    return lk.resolve_sites(with_assets, site_lookup(ranges), {"source_ip": "source_site", "dest_ip": "dest_site"})


def resolve_sockets(spark: SparkSession, ctx: JobContext, ranges: DataFrame, assets: DataFrame) -> None:
    units = cut_lineage(lg.pending_sockets(socket_ledger(spark, ctx)), "units")
    if units.isEmpty():
        return
    wanted, name = units.select(*SNAPSHOT).distinct(), dl.new_delivery()
    sockets, processes = (_snapshots(spark, ctx, kind, wanted) for kind in ("lsof", "ps"))
    dl.deliver(resolve_socket_rows(sockets, processes, ranges, assets, ctx.strict_ip), ctx.path("resolved_sockets"), RESOLVED_PARTITIONS, name)
    entries = units.withColumns({"stage": F.lit(lg.RESOLVE_SOCKETS), dl.DELIVERY: F.lit(name)}).select(*lg.SOCKET_COLUMNS, dl.DELIVERY)
    sn.append_ledger(entries, ctx.path("meta_sockets"))


def aggregate_sockets(spark: SparkSession, ctx: JobContext) -> None:
    """Daily socket flows of the days that gained snapshots; the whole day is aggregated anew."""
    ledger = socket_ledger(spark, ctx)
    units = cut_lineage(lg.pending_sockets(ledger, lg.RESOLVE_SOCKETS, lg.AGGREGATE_SOCKETS), "units")
    if units.isEmpty():
        return
    days = units.select(F.col("server_ip").alias("engine"), day_of(F.col("dt")).alias("dt")).distinct()
    counting = lg.deliveries_of(ledger, lg.RESOLVE_SOCKETS, "lsof").select(F.col("server_ip").alias("engine"), F.col("dt").alias("snapshot"), dl.DELIVERY)
    counting = semi_join(counting.withColumn("dt", day_of(F.col("snapshot"))), days, ["engine", "dt"])
    rows = dl.delivered(lg.in_days_of(spark.read.parquet(ctx.path("resolved_sockets")), days), cut_lineage(counting, "entries"), RESOLVED_SNAPSHOT)
    sn.write_units(ag.agg_socket_day(rows.drop(dl.DELIVERY)), ctx.path("agg/serversockets"), ["dt", "engine"], list(ctx.partitions))
    entries = units.withColumns({"stage": F.lit(lg.AGGREGATE_SOCKETS), dl.DELIVERY: F.lit("")}).select(*lg.SOCKET_COLUMNS, dl.DELIVERY)
    sn.append_ledger(entries, ctx.path("meta_sockets"))


def compact_sockets(spark: SparkSession, ctx: JobContext, days: list, remove: bool = False) -> None:
    """Bring closed days of stored snapshots into one delivery per table. ``remove`` clears what no longer counts, when nothing else runs."""
    for kind in ("lsof", "ps"):
        stage = {"stage": lg.ENCODE_SOCKETS, "filetype": kind}
        dl.compact(spark, ctx.path(kind), ctx.path("meta_sockets"), SNAPSHOT, SNAPSHOT_PARTITIONS, "day", days, stage)
        if remove:
            dl.clear(spark, ctx.path(kind), ctx.path("meta_sockets"), SNAPSHOT, "day", days, stage)


# -- usage, repositories, flow tables ------------------------------------------------------------------------------


USAGE_LEDGER = "filetype string, server string, date timestamp_ntz, delivery string"
SAMPLE = ["server", "date"]


def encode_usage(spark: SparkSession, ctx: JobContext, usage: DataFrame) -> None:
    """Derived disk and system samples, partitioned by day and delivery; of a sample that is delivered again the last delivery counts."""
    name = dl.new_delivery()
    for kind, rows in (("iostat", us.derive_disk(us.pivot_metrics(usage, "iostat"))),
                       ("sysstat", us.derive_system(us.pivot_metrics(usage, "sysstat")))):
        dated = cut_lineage(rows.withColumns({"sample_month": F.date_format("date", "yyyy-MM"), "sample_day": F.to_date("date")}), f"encode-{kind}")
        if dated.isEmpty():
            continue
        dl.deliver(dated, ctx.path(kind), ["sample_month", "sample_day"], name)
        entries = dated.select(F.lit(kind).alias("filetype"), *SAMPLE).distinct().withColumn(dl.DELIVERY, F.lit(name))
        sn.append_ledger(entries, ctx.path("meta_usage"), files=None)


def usage_samples(spark: SparkSession, ctx: JobContext, kind: str) -> DataFrame:
    """Stored samples that count."""
    named = dl.current(rd.read_or_empty(spark, ctx.path("meta_usage"), USAGE_LEDGER).filter(F.col("filetype") == kind), SAMPLE)
    return dl.counting(spark.read.parquet(ctx.path(kind)), named, SAMPLE).drop("sample_month", "sample_day", dl.DELIVERY)


def profile_usage(spark: SparkSession, ctx: JobContext, storage: DataFrame, assets: DataFrame) -> None:
    """Capacity profiles of all stored samples, one table with the three grains as partitions."""
    disk = us.join_capacity(usage_samples(spark, ctx, "iostat"), storage, assets)
    cpu = us.join_cpu(usage_samples(spark, ctx, "sysstat"), assets)
    sn.write_table(us.profile_disk(disk), ctx.path("agg/iostat"), ["grain"])
    sn.write_table(us.profile_cpu(cpu), ctx.path("agg/sysstat"), ["grain"])


def ingest_repository(spark: SparkSession, ctx: JobContext, name: str, filedate: str, raw: DataFrame) -> None:
    """Store one dated snapshot of a repository."""
    sn.write_snapshot(pj.project_repository(raw, name, filedate), ctx.path(f"repo/{name}"))


def ingest_repository_files(spark: SparkSession, ctx: JobContext, paths: list[str]) -> None:
    for path in paths:
        name, filedate = pj.repository_of(path)
        ingest_repository(spark, ctx, name, filedate, rd.read_repository(spark, path))


def repository(spark: SparkSession, ctx: JobContext, name: str, day: str | None = None) -> DataFrame:
    return rd.as_of(rd.read_merged(spark, ctx.path(f"repo/{name}")), day)


def build_assets(spark: SparkSession, ctx: JobContext, day: str | None = None) -> None:
    """Asset tables from the newest repositories: one row per address, and one per address and application."""
    star = lk.asset_star(repository(spark, ctx, "AIP-Server", day), repository(spark, ctx, "AIP-SoftInstance", day),
                         repository(spark, ctx, "AIP-Application", day), repository(spark, ctx, "AIP-AppGFtoApp", day))
    star = cut_lineage(star, "star")
    sn.write_table(lk.assets_by_ip(star, ctx.strict_ip), ctx.path("repo/AIP"))
    sn.write_table(lk.assets_by_ip_and_app(star, ctx.strict_ip), ctx.path("repo/AIPExplode"))


FLOW_STATE = "month string, n bigint, state decimal(38,0)"


def flow_state(spark: SparkSession, ctx: JobContext) -> DataFrame:
    """What the daily tables of each month are made of: number and digest of the aggregated units and their files."""
    files = lg.earliest_files(event_ledger(spark, ctx), lg.AGGREGATE).select(
        F.date_format("dt", "yyyy-MM").alias("month"), F.xxhash64("filetype", *lg.UNIT, "min_filedt").alias("mark"))
    snapshots = lg.stage_units(socket_ledger(spark, ctx), lg.AGGREGATE_SOCKETS).select(
        F.substring("dt", 1, 7).alias("month"), F.xxhash64("filetype", "server_ip", "dt").alias("mark"))
    return files.unionByName(snapshots).groupBy("month").agg(F.count("*").alias("n"), F.sum(F.col("mark").cast("decimal(38,0)")).cast("decimal(38,0)").alias("state"))


def build_flow_tables(spark: SparkSession, ctx: JobContext) -> list[str] | None:
    """Daily, monthly and all-time flow tables; returns the months that were made again, None for all.

    Only months whose aggregated units differ from those the stored tables were made of are read and written: their daily rows, their
    mergeable parts, and the monthly table counted from these. The all-time table is merged from the parts of all months. Daily tables without
    a ledger are taken whole. The state is recorded last, so a run that died is simply run again.
    """
    now = cut_lineage(flow_state(spark, ctx), "flow-state")
    known = rd.read_or_empty(spark, ctx.path("meta_flow"), FLOW_STATE)
    months = None
    if not now.isEmpty():
        months = [r["month"] for r in now.join(known, ["month", "n", "state"], "left_anti").orderBy("month").collect()]  # calendar months
        if not months:
            return months

    def daily(name):
        rows = spark.read.parquet(ctx.path(name))
        return rows if months is None else rows.filter(F.col("month").cast("string").isin(months))

    def write(rows, name):  # the rows of a month lie together, as they are placed by it
        if months is None:
            sn.write_table(rows.drop(PLACE), ctx.path(name), ["month"])
        else:
            sn.write_partitioned(rows, ctx.path(name), ["month"], together=True)

    by_row, by_flow = (partition_places(["month"], keys) for keys in (ag.FLOW_ROW, ag.FLOW_KEYS))
    write(ag.flow_detail_sets(daily("agg/device"), daily("agg/server"), daily("agg/serversockets"), by_row), "agg/flow_detail_day")
    write(ag.flow_parts(placed(daily("agg/flow_detail_day"), by_flow), ["month"]), "agg/flow_parts")
    write(ag.count_parts(placed(daily("agg/flow_parts"), by_flow), by_month=True), "agg/flow_month")
    parts = placed(spark.read.parquet(ctx.path("agg/flow_parts")), ag.FLOW_KEYS)
    sn.write_table(ag.count_parts(ag.merge_parts(parts, []), by_month=False), ctx.path("agg/flow"))
    if months is not None:
        sn.write_table(now.coalesce(1), ctx.path("meta_flow"))
    return months


# -- publishing ----------------------------------------------------------------------------------------------------



def cube_name(collecttype: str, level: str, resolution: str, date_range: str) -> str:
    return "".join(["Stat", resolution if collecttype == "device" else "", CUBE_STEMS[collecttype, level], "" if date_range == "Full" else date_range])


def cube_path(folder: str, name: str) -> str:
    return f"{folder}/cube={name}"


def tagged_rows(daily: DataFrame, collecttype: str, days: DataFrame, starts: list[tuple[str, str]]) -> DataFrame:
    """Daily rows of the valid days with the ranges they lie in, summed up per set of ranges: ``starts`` are (range, first day)."""
    inside = F.filter(F.array(*[F.when(F.col("dt") >= F.lit(first).cast("date"), F.lit(name)) for name, first in starts]), lambda x: x.isNotNull())
    rows = ag.in_valid_days(daily, days, min(first for _, first in starts)).withColumn("date_ranges", inside)
    sites = [c for c in ("source_I_ID_site",) if collecttype == "device"]
    keys = ["date_ranges", *sites, *ag.cube_keys(collecttype, "detail", "Device")]
    # Bitmaps unite in two steps, which placed rows take without a shuffle between them; sums aggregate before theirs.
    return ag.cube_of(placed(rows, keys) if collecttype == "device" else rows, keys, collecttype).drop(PLACE)


def publish(spark: SparkSession, ctx: JobContext, stamp: str, identities: DataFrame, applications: DataFrame,
            ranges: DataFrame, exports: bool = True, date_ranges: tuple[str, ...] | None = None) -> dict[str, str]:
    """Cubes per date range as tables, and the date ranges and dimension lists as one CSV each.

    The daily rows of a collect type are read once: they are summed up with the set of ranges they lie in, and the cubes of all ranges and
    resolutions come from these sums. Cubes without detail come from the detailed ones. The cubes stay Parquet, so the site-map query can
    prune and push its filters down; only here users become text. ``date_ranges`` names the ranges that get cubes; all do when it is not given. Returns name → path.
    """
    target, written = f"{ctx.path('publish')}/data_{stamp}", {}
    units = lg.earliest_files(event_ledger(spark, ctx), lg.AGGREGATE)
    for collecttype, least in (("device", ctx.min_device_engines), ("server", ctx.min_server_engines)):
        days = cut_lineage(ag.valid_days(units, collecttype, least), "days")
        ranges_of_days = ag.date_ranges(days, ctx.first_day)
        starts = [(r["date_range"], str(r["firstDate"])) for r in ranges_of_days.collect()  # four rows
                  if r["firstDate"] is not None and (date_ranges is None or r["date_range"] in date_ranges)]
        if starts:
            daily = ag.published_input(spark.read.parquet(ctx.path(f"agg/{collecttype}")))
            tagged = cut_lineage(tagged_rows(daily, collecttype, days, starts), "tagged")
            for level in ("detail", "nodetail"):
                names = {(n, r): cube_name(collecttype, level, r, n) for n, _ in starts for r in RESOLUTIONS[collecttype]}
                # The cubes are few, and what is written is read from a written copy in pieces of its size, so no cube gets small files from many tasks.
                sn.write_partitioned(_cubes(spark, ctx, tagged, collecttype, level, names), target, ["cube"], together=True)
                written |= {name: cube_path(target, name) for name in names.values()}
        if exports:
            prefix = "DateRangeServer" if collecttype == "server" else "DateRange"
            written[prefix] = sn.export_csv(ranges_of_days, target, f"{prefix}.csv.gz", single=True, allowed_root=ctx.export_root)
    if exports:
        lists = {"SectorCode": ag.dim_sectors(identities, "Sector"),
                 "SectorCodeServer": ag.dim_sectors(applications, "aip_app_sector"),
                 "SiteCode": ag.dim_sites(identities, ranges)}
        for name, rows in lists.items():
            written[name] = sn.export_csv(rows, target, f"{name}.csv.gz", single=True, allowed_root=ctx.export_root)
    return written


def cube_sums(tagged: DataFrame, collecttype: str, level: str, names: dict[tuple[str, str], str]) -> DataFrame:
    """All cubes of one level from the tagged sums, with their names in ``cube``; both resolutions in one aggregate.

    The rows are shuffled once, before they are repeated per cube: they are placed by the keys that are the same in every cube.
    """
    site, keys = F.col("source_site"), ag.cube_keys(collecttype, level, "Device")
    variants = F.array(*[F.struct(F.lit(n).alias("range"), F.lit(name).alias("cube"), (F.col("source_I_ID_site") if collecttype == "device" and r == "IDM" else site).alias("_site"))
                         for (n, r), name in names.items()])
    mine = F.filter(variants, lambda v: F.array_contains("date_ranges", v["range"]))
    together = placed(tagged, [k for k in keys if k != "source_site"] if collecttype == "device" else keys)
    rows = together.withColumn("_v", F.explode(mine)).withColumns({"cube": F.col("_v.cube"), "source_site": F.col("_v._site")})
    return ag.merge_cubes(rows, ["cube", *keys], collecttype).drop(PLACE)


def _cubes(spark: SparkSession, ctx: JobContext, tagged: DataFrame, collecttype: str, level: str, names: dict[tuple[str, str], str]) -> DataFrame:
    """The cubes of one level as they are published, read from a written copy."""
    found = cube_sums(tagged, collecttype, level, names)
    if collecttype != "device":
        return cut_lineage(found, "cubes")
    named = usersets.with_names(found, "users", known_users(spark, ctx), "I_ID_U")
    by_identity = F.col("cube").isin([name for (_, r), name in names.items() if r == "IDM"])
    return named.withColumns({"source_I_ID_site": F.when(by_identity, F.col("source_site")), "source_site": F.when(~by_identity, F.col("source_site"))})


# -- listener logs -------------------------------------------------------------------------------------------------



def ingest_listener(spark: SparkSession, ctx: JobContext, paths: list[str], integration_date: str, in_pieces: bool = False) -> None:
    """Listener logs named ``<type>_<host>_…``: parsed connections with the attributes of their file, the lines that no layout
    fits, and the days covered by each file, host and instance.

    Each of the three tables is partitioned by integration day and file, so a file that is taken again replaces itself.
    ``in_pieces``: each path is a folder that holds the pieces of one log, in the order of their names.
    """
    def name_of(path):
        return F.element_at(F.split(path, "/"), -2 if in_pieces else -1)

    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(paths).select("value", name_of(F.col("_metadata.file_path")).alias("source_filename"), place.alias("place"))
    stamps = spark.read.format("binaryFile").load(paths).groupBy(name_of(F.col("path")).alias("source_filename")).agg(
        F.max(F.col("modificationTime").cast("date")).alias("source_filedate"))
    files = cut_lineage(stamps.join(logs.file_dates(lines, "source_filename", "place"), "source_filename", "left"), "log-files")
    # The patterns run once over the lines; both tables are taken from what they found.
    read, keys = cut_lineage(logs.read_lines(lines.drop("place")), "read-lines"), ["integration_date", "source_filename"]
    stamped = F.lit(integration_date).cast("date")
    rows = lookup_join(logs.parsed_lines(read), files, ["source_filename"]).withColumns(
        {"host_name": F.lower(F.get(F.split("source_filename", "_"), F.lit(1))), "integration_date": stamped})
    rows = cut_lineage(rows.select(*LISTENER_COLUMNS), "listener")
    sn.write_units(rows, ctx.path("listener"), keys, keys, staged=True)
    sn.write_units(logs.broken_lines(read).withColumn("integration_date", stamped), ctx.path("listener_trash"), keys, keys, staged=True)
    sn.write_units(logs.log_coverage(rows, LISTENER_COLUMNS[10:]), ctx.path("listener_report"), keys, keys)


# -- site map ------------------------------------------------------------------------------------------------------


def published_cube(spark: SparkSession, folder: str, source: str = "device", resolution: str = "IDM", detailed: bool = False,
                   date_range: str = "Full") -> DataFrame:
    """A cube that ``publish`` wrote, under the names the site-map query reads; servers always have the detailed one."""
    level = "detail" if detailed or source == "server" else "nodetail"
    cube = spark.read.parquet(cube_path(folder, cube_name(source, level, resolution, date_range)))
    site = "source_I_ID_site" if source == "device" and resolution == "IDM" else "source_site"
    other = ({"source_I_ID_site", "source_site"} - {site}) & set(cube.columns)  # the site of the other resolution is empty
    return cube.drop(*other).withColumnsRenamed({site: mx.SRC, "dest_site": mx.DST}).withColumn("source_app_name", strip_quotes(F.col("source_app_name")))


@dataclass(frozen=True)
class Ends:
    """Values for the two ends of a flow; ``operand`` joins the tests of both."""

    source: tuple[str, ...] = ()
    dest: tuple[str, ...] = ()
    operand: str = "AND"


@dataclass(frozen=True)
class MapFilter:
    """Which flows a site map shows; what is left empty does not restrict."""

    sectors: Ends = Ends()
    unknown_sectors: tuple[bool, bool] = (True, True)  # whether flows without a sector stay, by end
    sites: Ends = Ends(operand="OR")
    without_sites: Ends = Ends()
    countries: Ends = Ends()
    without_countries: Ends = Ends()
    categories: Ends = Ends()
    between_sites: bool = True
    within_sites: bool = True
    applications: dict = field(default_factory=dict)
    ports: str = ""
    ports_mode: str = "include"


def sitemap_rows(cube: DataFrame, sites: DataFrame, categories: DataFrame, source: str = "device", shown: MapFilter = MapFilter(),
                 detailed: bool = False) -> DataFrame:
    """The filters of the site-map query, in one plan, then country, name and category of both ends."""
    def keep(ends, wanted):
        return fl.include_ends(*ends, wanted.source, wanted.dest, wanted.operand)

    def leave(ends, unwanted):
        return fl.exclude_ends(*ends, unwanted.source, unwanted.dest, unwanted.operand)

    codes, countries = (mx.SRC, mx.DST), ("CountryCode_Source", "CountryCode_Destination")
    rows = cube.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("nf")) for c in codes})
    rows = rows.filter(fl.application_list_filter(cube.columns, **shown.applications) & fl.closed_only())
    rows = rows.filter(fl.sector_filter(source, shown.sectors.source, shown.unknown_sectors[0], shown.sectors.dest, shown.unknown_sectors[1]))
    rows = rows.filter(keep(codes, shown.sites) & leave(codes, shown.without_sites))
    rows = lk.lookup_sites_info(rows, sites)
    rows = rows.filter(keep(countries, shown.countries) & leave(countries, shown.without_countries))
    rows = rows.filter(fl.inter_intra(shown.between_sites, shown.within_sites))
    rows = fl.category_filter(rows, categories, shown.categories.source, shown.categories.dest, shown.categories.operand)
    if detailed:
        rows = rows.filter(fl.port_filter(shown.ports, shown.ports_mode))
    return lk.lookup_categories(rows, categories)


def sitemap(cube: DataFrame, sites: DataFrame, categories: DataFrame, measure: str = "ConnectTimesData", limit: int = 50,
            source: str = "device", detailed: bool = False, clustering: str | None = None, inflation: float = 1.5,
            expansion: int = 4, clusters: int = 100, directed: bool = False, shown: MapFilter = MapFilter()) -> dict:
    """Site-to-site matrix of a published cube.

    Returns the bounded ``edges``, the ``unit`` as a power of ten, the ``detail``
    table and, when asked for, the ``clusters``.
    """
    rows = sitemap_rows(cube, sites, categories, source, shown, detailed)
    rows = mx.label_sites(mx.with_measure(rows, measure))
    detail = ag.traffic_detail(rows, source, detailed)
    # The pairs of sites are few; written apart, the reductions below do not scan the cube again.
    scaled, unit = mx.rescale(cut_lineage(mx.traffic_edges(rows), "edges"))
    edges = mx.shrink_matrix(scaled, limit)
    found = None
    if clustering:
        edges = cut_lineage(edges, "matrix")
        if clustering == "mcl":
            found = markov_clusters(edges, inflation, expansion, directed)
        elif clustering == "kmeans":
            found = kmeans_clusters(edges, clusters, directed=directed)
        else:
            raise ValueError(f"unknown clustering {clustering!r}")
        found = cut_lineage(found, "clusters")
        edges, detail = mx.apply_clusters(edges, found), mx.apply_clusters(detail, found)
    return {"edges": edges, "unit": unit, "detail": detail, "clusters": found}


def weighted_graph(edges: DataFrame, max_nodes: int = 100, ceiling: float = 1_000_000) -> tuple[DataFrame, int]:
    """Bounded graph of a three-column input with readable labels, and its unit as a power of ten."""
    scaled, unit = mx.rescale(cut_lineage(mx.clean_edges(edges), "edges"), "traffic", ceiling)
    return mx.label_edges(mx.shrink_edges(scaled, max_nodes)), unit


# -- pseudonyms ----------------------------------------------------------------------------------------------------

def read_feed(spark: SparkSession, paths, kind: str) -> DataFrame:
    """A raw tab-separated extract of one width with its columns named, and engine and file date from its file name.

    Listener feeds are the tables of ``ingest_listener`` as files with a header; their attributes are in their columns.
    """
    if kind == "listener":
        return spark.read.options(header=True, sep=";").csv(paths).select(*LISTENER_COLUMNS)
    raw = spark.read.options(sep="\t", header=False).csv(paths)
    origin = ["engine", "filedt"]
    tagged = rd.with_file_metadata(raw).select(*raw.columns, *origin)
    if kind == "webrequest":
        return pj.pick_positions(tagged, {**pj.RAW_WEBREQUEST, len(raw.columns) + 1: "engine", len(raw.columns) + 2: "filedt"})
    if kind == "connection":
        return pj.name_columns(tagged, [*pj.RAW_CONNECTION, *origin], [*pj.RAW_CONNECTION_KEEP, *origin])
    if kind == "execution":
        return pj.name_columns(tagged, [*pj.raw_execution_names(len(raw.columns)), *origin])
    if kind == "bigfix":
        kept = [c for c in pj.RAW_INVENTORY if c not in pj.INVENTORY_PERSONAL]
        return pj.name_columns(tagged, [*pj.RAW_INVENTORY, *origin], kept)
    raise ValueError(f"unknown feed {kind!r}")


# Name columns of each feed → identifier columns; those in USER_NAMES are cleaned of the domain suffix.
FEED_NAMES = {
    "connection": {"NX_user_name": "I_ID_U", "NX_device_name": "I_ID_D"},
    "webrequest": {"wr_device_name": "I_ID_D"},
    "execution": {"ex_user_name": "I_ID_U", "ex_device_name": "I_ID_D"},
    "bigfix": {"bf_device_name": "I_ID_D"},
    "listener": {"source_user": "I_ID_U", "source_host_name": "I_ID_D"},
}
USER_NAMES = {"connection": "NX_user_name", "execution": "ex_user_name", "listener": "source_user"}


def pseudonymize_feed(feed: DataFrame, kind: str, dictionary: DataFrame, ctx: JobContext,
                      identity_files: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """A feed without names, and the dictionary entries it adds."""
    if kind not in FEED_NAMES:
        raise ValueError(f"unknown feed {kind!r}")
    names, rows = FEED_NAMES[kind], feed
    if kind in USER_NAMES:
        rows = pv.clean_user(rows, USER_NAMES[kind], ctx.domain_suffix)
    if kind == "listener" and identity_files:
        rows = pv.enrich_login(rows, "source_user", identity_files)
    seen = None
    for column in names:
        part = rows.select(F.col(column).alias("name"))
        seen = part if seen is None else seen.unionByName(part)
    return pv.pseudonymize(rows, names, dictionary, ctx.key), pv.new_dictionary_entries(seen, dictionary, ctx.key)


def store_dictionary(spark: SparkSession, ctx: JobContext, entries: DataFrame) -> None:
    """Append new entries; names already stored are left out, so a repeated run adds nothing."""
    sn.append_ledger(entries, ctx.path("dictionary"), files=None)


# -- back-fill -----------------------------------------------------------------------------------------------------


def backfill_windows(first: date | str, end: date | str, days: int) -> Iterator[tuple[str, str]]:
    """Half-open windows ``[first, end)`` of at most ``days`` days as (first day, last day)."""
    if days < 1:
        raise ValueError("a window has at least one day")
    start, stop = date.fromisoformat(str(first)), date.fromisoformat(str(end))
    while start < stop:
        after = min(start + timedelta(days=days), stop)
        yield str(start), str(after - timedelta(days=1))
        start = after


def scratch(spark: SparkSession, label: str, **options) -> JobContext:
    """A context in a new folder of the shared work area."""
    return JobContext(root=work_path(spark, label), **options)
