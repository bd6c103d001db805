"""Resolution of flows against the reference repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowloom.functions import default_site, ip_to_int, is_internal_ip
from flowloom.operators.filters import status_allowed
from flowloom.operators.joining import bounded_broadcast, lookup_join, prefixed

BLOCK_BITS = 8  # lookup blocks of 256 addresses

AIP_FLOW_COLUMNS = [
    "aip_server_adminby", "aip_server_hostname", "aip_server_function", "aip_server_subfunction", "aip_app_name",
    "aip_app_type", "aip_appinstance_type", "aip_app_state", "aip_app_sensitive", "aip_app_criticality",
    "aip_app_sector", "aip_appinstance_sector", "aip_appinstance_state", "aip_app_shared_unique_id",
]

SERVER_COLUMNS = [
    "aip_server_ip", "aip_server_hostname", "aip_server_adminby", "aip_server_function", "aip_server_subfunction",
    "aip_server_phys_host", "aip_server_size", "aip_server_type", "aip_server_vmw_host", "aip_server_status",
    "aip_server_site", "aip_server_site_name", "aip_server_ownership", "aip_server_cpu_type", "aip_server_cpu_num",
    "aip_server_cpu_cores", "aip_server_owner", "aip_server_owner_org_id", "aip_server_vendor", "aip_server_model",
    "aip_server_role", "aip_server_source", "aip_server_os_name",
]

# Application attributes of an asset: output name → column of the joined repositories.
ASSET_VALUES = {
    "aip_app_name": "aip_appinstance_name",
    "aip_appinstance_type": "aip_appinstance_type",
    "aip_app_type": "aip_app_type",
    "aip_app_state": "aip_app_state",
    "aip_app_validation": "aip_app_validation",
    "aip_app_it_owner": "aip_app_it_owner",
    "aip_app_is_owner": "aip_app_is_owner",
    "aip_appinstance_state": "aip_appinstance_state",
    "aip_app_sensitive": "aip_app_sensitive",
    "aip_app_criticality": "aip_app_criticality",
    "aip_app_sector": "aip_app_sector",
    "aip_appinstance_sector": "aip_appinstance_sector",
    "aip_app_shared_unique_id": "aip_appinstance_shared_unique_id",
    "aip_appgf_grid_app_name": "aip_appgf_grid_app_name",
    "aip_appgf_billing_code": "aip_appgf_billing_code",
}


def site_segments(ranges: DataFrame) -> DataFrame:
    """Disjoint pieces ``(block, seg_lo, seg_hi, site)`` of the ranges, cut at blocks of 256 addresses.

    The first and the last address of a range do not belong to it. Overlapping
    ranges give the sorted site names joined by ``_``. A block has at most 256
    pieces whatever the number of ranges, because equal ranges are merged first.
    """
    top = (1 << BLOCK_BITS) - 1
    block_lo = F.shiftleft(F.col("block"), BLOCK_BITS)
    cut = (
        ranges.select(F.col("mdm_loc_code").alias("site"), (F.col("mdm_ip_start_int") + 1).alias("lo"),
                      (F.col("mdm_ip_end_int") - 1).alias("hi"))
        .filter(F.col("lo") <= F.col("hi")).distinct()
        .withColumn("block", F.explode(F.sequence(F.shiftright("lo", BLOCK_BITS), F.shiftright("hi", BLOCK_BITS))))
        .withColumns({"lo": F.greatest("lo", block_lo), "hi": F.least("hi", block_lo + top)})
        .groupBy("block", "lo", "hi").agg(F.collect_set("site").alias("sites"))
    )
    starts = cut.select("block", F.col("lo").alias("seg_lo")).unionByName(
        cut.select("block", (F.col("hi") + 1).alias("seg_lo")).filter(F.col("seg_lo") <= block_lo + top)).distinct()
    following = F.lead("seg_lo").over(W.partitionBy("block").orderBy("seg_lo"))
    pieces = starts.withColumn("seg_hi", F.coalesce(following - 1, block_lo + top))
    covered = pieces.join(cut, "block").filter((F.col("lo") <= F.col("seg_lo")) & (F.col("hi") >= F.col("seg_hi")))
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_set("sites"))))
    return covered.groupBy("block", "seg_lo", "seg_hi").agg(F.array_join(names, "_").alias("site"))


def explode_ranges(ranges: DataFrame) -> DataFrame:
    """Every address strictly inside a range with its sites joined by ``_``: one row per address.

    The pieces are disjoint, so each address appears once without grouping by address.
    """
    return site_segments(ranges).select(F.explode(F.sequence("seg_lo", "seg_hi")).alias("mdm_ip"), "site")


def resolve_sites(flows: DataFrame, segments: DataFrame, ends: dict[str, str]) -> DataFrame:
    """Add a site column per address column (``{'source_ip': 'source_site'}``); ``nf`` when no range holds it.

    The pieces are disjoint, so the equality join on the block with a range
    check finds at most one piece and never repeats a flow.
    """
    lookup = bounded_broadcast(segments)
    result = flows
    for ip_column, site_column in ends.items():
        number = ip_to_int(F.col(ip_column))
        side = result.withColumns({"_ip": number, "_block": F.shiftright(number, BLOCK_BITS)})
        piece = lookup.withColumnsRenamed({"site": "_site"})
        hit = (F.col("_block") == F.col("block")) & F.col("_ip").between(F.col("seg_lo"), F.col("seg_hi"))
        kept = [c for c in result.columns if c != site_column]
        result = side.join(piece, hit, "left").select(*kept, default_site(F.col("_site")).alias(site_column))
    return result


def resolve_users(flows: DataFrame, identities: DataFrame) -> DataFrame:
    """Sector, site and team of the user; of several rows of an ``I_ID`` the greatest counts, so no flow is repeated."""
    lookup = identities.select(
        F.col("I_ID").alias("I_ID_U"), F.col("Sector").alias("source_sector"),
        F.col("SiteCode").alias("_site"), F.col("TerangaCode").alias("source_teranga"))
    return lookup_join(flows, best_row(lookup, ["I_ID_U"], ["source_sector"]), "I_ID_U").select(
        *flows.columns, "source_sector", default_site(F.col("_site")).alias("source_I_ID_site"), "source_teranga")


def resolve_assets(flows: DataFrame, assets: DataFrame, ends: tuple[str, ...] = ("dest", "source"),
                   site_fallback: bool = True) -> DataFrame:
    """Asset columns of each end by address; a site still ``nf`` takes the site of the asset.

    Of several assets of an address that with the greatest application name counts, as in ``assets_by_ip``, so no flow is repeated.
    """
    lookup = bounded_broadcast(best_row(assets.select("aip_server_ip", "aip_server_site", *AIP_FLOW_COLUMNS), ["aip_server_ip"], ["aip_app_name", "aip_server_adminby"]))
    result = flows
    for end in ends:
        side = prefixed(lookup, f"{end}_")
        result = result.join(side, F.col(f"{end}_ip") == F.col(f"{end}_aip_server_ip"), "left")
        if site_fallback:
            site = F.col(f"{end}_site")
            result = result.withColumn(
                f"{end}_site", F.when(site == "nf", default_site(F.col(f"{end}_aip_server_site"))).otherwise(site))
        result = result.drop(f"{end}_aip_server_ip", f"{end}_aip_server_site")
    return result


URL_KEYS = ["collecttype", "dt", "engine", "filedt", "I_ID_D", "source_app_name", "dest_ip", "dest_port"]


def urls_by_connection(webrequests: DataFrame) -> DataFrame:
    """Distinct URLs of each connection key, sorted and joined by ``|``.

    The distinct step removes repeated requests before URLs meet in one row.
    """
    distinct = webrequests.select(*URL_KEYS, "url").distinct()
    return distinct.groupBy(*URL_KEYS).agg(F.array_join(F.array_sort(F.collect_list("url")), "|").alias("url"))


def join_urls(connections: DataFrame, webrequests: DataFrame) -> DataFrame:
    return connections.join(urls_by_connection(webrequests), URL_KEYS, "left").select(*connections.columns, "url")


def lookup_asset_site(flows: DataFrame, assets: DataFrame, ip_column: str, site_column: str = "site") -> DataFrame:
    """Site of the asset with the given address, where the asset has one."""
    sites = (assets.filter(F.coalesce(F.col("aip_server_site"), F.lit("")) != "")
             .groupBy(F.col("aip_server_ip").alias(ip_column)).agg(F.min("aip_server_site").alias(site_column)))
    return lookup_join(flows, sites, ip_column).select(*flows.columns, site_column)


def lookup_sites_info(flows: DataFrame, sites: DataFrame) -> DataFrame:
    """Country and site name of both ends."""
    result = flows
    for end in ("Source", "Destination"):
        side = sites.select(F.col("SiteCode").alias(f"SiteCode_{end}"), F.col("CountryCode").alias(f"CountryCode_{end}"),
                            F.col("SiteName").alias(f"SiteName_{end}"))
        result = lookup_join(result, side, f"SiteCode_{end}")
    return result.select(*flows.columns, "CountryCode_Source", "SiteName_Source", "CountryCode_Destination",
                         "SiteName_Destination")


def lookup_categories(flows: DataFrame, categories: DataFrame) -> DataFrame:
    result = flows
    for end in ("Source", "Destination"):
        side = categories.select(F.col("SiteCode").alias(f"SiteCode_{end}"),
                                 F.col("SiteScenario").alias(f"SiteCategory_{end}"))
        result = lookup_join(result, side, f"SiteCode_{end}")
    return result.select(*flows.columns, "SiteCategory_Source", "SiteCategory_Destination")


def fused_billing(gridfusion: DataFrame) -> DataFrame:
    """Distinct fused names and billing codes per application."""
    def joined(name: str):
        return F.array_join(F.array_sort(F.collect_set(name)), ",").alias(name)

    distinct = gridfusion.select("aip_appgf_shared_unique_id", "aip_appgf_grid_app_name", "aip_appgf_billing_code").distinct()
    return distinct.groupBy("aip_appgf_shared_unique_id").agg(
        joined("aip_appgf_grid_app_name"), joined("aip_appgf_billing_code"))


def asset_star(servers: DataFrame, instances: DataFrame, applications: DataFrame, gridfusion: DataFrame) -> DataFrame:
    """Live servers with their software instances, applications and fused billing codes."""
    live = servers.filter(status_allowed("aip_server_status")).withColumns(
        {"aip_server_adminby": F.lit("NA"), "aip_server_owner_org_id": F.lit("NA")})
    fused = fused_billing(gridfusion)
    return (
        live.join(instances, live["aip_server_hostname"] == instances["aip_appinstance_hostname"], "left")
        .join(applications.drop("filedate"),
              F.col("aip_appinstance_shared_unique_id") == F.col("aip_app_shared_unique_id"), "left")
        .join(fused, F.col("aip_app_shared_unique_id") == F.col("aip_appgf_shared_unique_id"), "left")
        .select(*SERVER_COLUMNS, *[F.col(source).alias(f"v_{name}") for name, source in ASSET_VALUES.items()],
                live["filedate"].alias("filedate"))
    )


def concat_all(column: Column, separator: str = "||") -> Column:
    """Aggregate: all values with repeats, sorted and joined; null and empty ones are skipped."""
    return F.array_join(F.array_sort(F.collect_list(F.nullif(column, F.lit("")))), separator)


def asset_rollup(star: DataFrame, separator: str = "||") -> DataFrame:
    """One row per server; its application attributes joined with repeats, sorted, empties skipped."""
    joined = [concat_all(F.col(f"v_{n}"), separator).alias(n) for n in ASSET_VALUES]
    return star.groupBy(*SERVER_COLUMNS).agg(*joined, F.max("filedate").alias("filedate"))


def best_row(df: DataFrame, keys: list[str], prefer: list[str]) -> DataFrame:
    """One row per key: the greatest by ``prefer``, then by the remaining columns, so the choice is repeatable.

    ``row_number() = 1`` lets Spark cut each group before the shuffle.
    """
    order = prefer + [c for c in df.columns if c not in prefer and c not in keys]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order]))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def assets_by_ip(star: DataFrame, strict_ip: bool = False) -> DataFrame:
    """One asset row per internal address, the one with the greatest application name."""
    rows = asset_rollup(star).filter(is_internal_ip(F.col("aip_server_ip"), strict_ip))
    return best_row(rows, ["aip_server_ip"], ["aip_app_name", "aip_server_adminby"])


def assets_by_ip_and_app(star: DataFrame, strict_ip: bool = False) -> DataFrame:
    """One asset row per internal address and application."""
    rows = star.select(*SERVER_COLUMNS, *[F.col(f"v_{n}").alias(n) for n in ASSET_VALUES])
    rows = rows.filter(is_internal_ip(F.col("aip_server_ip"), strict_ip))
    return best_row(rows, ["aip_server_ip", "aip_app_name"], ["aip_server_adminby"])
