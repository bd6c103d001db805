"""Server metrics: pivot, derivation and capacity profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import (
    device_or_mount, epoch_ms_to_ts, fix_metric_name, metric_tags, tag_get, tier_or_default,
)
from flowloom.operators.joining import lookup_join

# Metric names of each table.
METRICS = {
    "iostat": ["used_mb", "used_percent", "avail_mb", "diskq_count", "disktime_msec"],
    "sysstat": ["cpu_percent", "memvirtualusage_percent", "swapusage_percent", "memphysusage_percent"],
}
QUANTILES = {"q10": 0.10, "q25": 0.25, "q50": 0.50, "q75": 0.75, "q90": 0.90}
GRAINS = {"day": ["dt", "month"], "month": ["month"], "all": []}


def pivot_metrics(usage: DataFrame, table: str, names: list[str] | None = None) -> DataFrame:
    """Mean of each metric in a column of its own: ``names``, else those of ``METRICS``.

    A metric of the table that is not among them is an error; ``metric_names`` finds all.
    """
    rows = usage.filter(F.col("table").startswith(table) & (F.col("table") != "app")).select(
        "date", "server", fix_metric_name(F.col("name")).alias("name"), "value", metric_tags(F.col("table")).alias("tags"))
    names = names or METRICS[table]
    other = sorted(r["name"] for r in rows.filter(~F.col("name").isin(names)).select("name").distinct().limit(20).collect())
    if other:
        raise ValueError(f"metrics of {table} that are not asked for: {other}")
    return rows.groupBy("date", "server", "tags").pivot("name", names).agg(F.avg("value"))


def metric_names(usage: DataFrame, table: str) -> list[str]:
    """All metrics that occur in the table, sorted; a short list, as they become columns."""
    rows = usage.filter(F.col("table").startswith(table) & (F.col("table") != "app"))
    return sorted(r[0] for r in rows.select(fix_metric_name(F.col("name"))).distinct().dropna().collect())


def _whole(value: Column) -> Column:
    return F.ceil(value).cast("double")


def derive_disk(pivoted: DataFrame) -> DataFrame:
    """Used, free and total space and the used share, each rebuilt from the others where it is zero or missing."""
    share = F.sum("used_percent") / 100
    sums = pivoted.groupBy("date", "server", "tags").agg(
        _whole(F.sum("used_mb")).alias("u"), share.alias("p"), F.sum("avail_mb").alias("a"),
        _whole(F.try_divide(F.sum("avail_mb"), 1 - share)).alias("t"),
        F.sum("diskq_count").alias("diskq_count"), F.sum("disktime_msec").alias("disktime_msec"))
    u, p, a, t = (F.col(c) for c in "upat")
    shown_share = F.when((p == 0) | p.isNull(), F.try_divide(u, u + a)).otherwise(p)
    return sums.select(
        epoch_ms_to_ts(F.col("date")).alias("date"), "server",
        tag_get(F.col("tags"), "mount").alias("mount"), tag_get(F.col("tags"), "device").alias("device"),
        _whole(F.when(u == 0, F.try_divide(a * p, 1 - p)).otherwise(u)).alias("used_mb"),
        (F.round(100 * shown_share) / 100).alias("used_percent"), _whole(a).alias("avail_mb"),
        _whole(F.when(t == 0, u + a).otherwise(t)).alias("total_mb"), "diskq_count", "disktime_msec")


def derive_system(pivoted: DataFrame) -> DataFrame:
    return pivoted.groupBy("date", "server", "tags").agg(
        *[F.sum(m).alias(m) for m in METRICS["sysstat"]]).withColumn("date", epoch_ms_to_ts(F.col("date")))


def _calendar(df: DataFrame) -> DataFrame:
    day = F.col("date").cast("date")
    return df.withColumns({"dt": day, "month": F.date_format(day, "yyyy-MM"), "server": F.lower("server")})


def _asset_by_host(assets: DataFrame) -> DataFrame:
    return assets.select(
        F.lower("aip_server_hostname").alias("server"), F.col("aip_server_ip").alias("server_ip"), "aip_server_function",
        "aip_app_name", "aip_app_sector")


def join_capacity(disk: DataFrame, storage: DataFrame, assets: DataFrame) -> DataFrame:
    """Disk samples with their storage contract (by server and device) and asset (by host name)."""
    samples = _calendar(disk.filter(F.col("total_mb").isNotNull())).withColumn(
        "device", F.lower(device_or_mount(F.col("device"), F.col("mount"))))
    contract = storage.select("server", F.col("mount").alias("device"), "type", "charged_used_mb", "charged_total_mb")
    joined = lookup_join(samples, contract, ["server", "device"])
    joined = lookup_join(joined, _asset_by_host(assets), "server")
    return joined.withColumns({
        "type": tier_or_default(F.col("type")),
        "percent_avail": F.round(F.try_divide(F.col("avail_mb"), F.col("total_mb")), 2)})


def join_cpu(system: DataFrame, assets: DataFrame) -> DataFrame:
    return lookup_join(_calendar(system.filter(F.col("cpu_percent").isNotNull())), _asset_by_host(assets), "server")


def spread(column: str) -> list[Column]:
    """Least, five quantiles from one sketch, and greatest value; quantiles are values that occur."""
    return [F.min(column).alias(f"q0_{column}"),
            F.percentile_approx(column, list(QUANTILES.values())).alias(f"_q_{column}"),
            F.max(column).alias(f"q100_{column}")]


def _quantile_columns(column: str) -> list[Column]:
    picked = [F.round(F.col(f"_q_{column}")[i], 2).alias(f"{q}_{column}") for i, q in enumerate(QUANTILES)]
    return [F.col(f"q0_{column}"), *picked, F.col(f"q100_{column}")]


def _profile(df: DataFrame, entity: list[str], aggregates: list[Column], outputs: list[Column]) -> DataFrame:
    """One pass for the day, month and all-time grains; ``grain`` names the level of a row."""
    sets = [[*entity, *grain] for grain in GRAINS.values()]
    level = F.grouping_id()
    rows = df.groupingSets(sets, *entity, "month", "dt").agg(*aggregates, level.alias("_level"))
    # grouping_id bits: month, dt — 0 = both kept, 1 = dt rolled up, 3 = both rolled up.
    grain = F.when(F.col("_level") == 0, "day").when(F.col("_level") == 1, "month").otherwise("all")
    return rows.select(grain.alias("grain"), *entity, "month", "dt", *outputs)


def profile_disk(capacity: DataFrame) -> DataFrame:
    """Capacity profile of every disk at three grains; attributes are constant per disk, the least is shown."""
    constant = ["type", "aip_server_function", "aip_app_name", "aip_app_sector"]
    charged = ["charged_used_mb", "charged_total_mb"]
    aggregates = [F.count_distinct("date").alias("count_date"), *[F.min(c).alias(c) for c in constant + charged],
                  F.max("total_mb").alias("max_total_mb"), *spread("avail_mb"), *spread("percent_avail")]
    outputs = ["count_date", *constant, *charged, "max_total_mb", *_quantile_columns("avail_mb"),
               *_quantile_columns("percent_avail")]
    return _profile(capacity, ["server", "server_ip", "device"], aggregates, outputs)


def profile_cpu(system: DataFrame) -> DataFrame:
    constant = ["aip_server_function", "aip_app_name", "aip_app_sector"]
    aggregates = [F.count_distinct("date").alias("count_date"), *[F.min(c).alias(c) for c in constant],
                  F.round(F.avg("cpu_percent"), 2).alias("avg_cpu_percent"), *spread("cpu_percent")]
    return _profile(system, ["server", "server_ip"], aggregates,
                    ["count_date", *constant, "avg_cpu_percent", *_quantile_columns("cpu_percent")])


def approx_samples(df: DataFrame, keys: list[str], column: str = "date", error: float = 0.02) -> DataFrame:
    """Approximate number of distinct sample times, for tables where the exact count is too costly."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(column, error).alias("count_date"))
