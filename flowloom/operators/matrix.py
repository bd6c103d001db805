"""Site-to-site traffic: edges, top-N reduction, matrix form and relabelling.

The reductions order at most ``limit`` rows (or ten times as many edges) in one
window; they do so after a distributed top-N, so that window has a fixed bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowloom.functions import sanitize_label, site_label
from flowloom.operators.aggregates import MEASURES
from flowloom.operators.joining import lookup_join, semi_join
from flowloom.session import cut_lineage

SRC, DST, TRAFFIC = "SiteCode_Source", "SiteCode_Destination", "Traffic"
UNCLUSTERED = 999

# Names shown to the reader.
PRESENTATION_NAMES = {
    "SiteCode_Source": "Source.Site",
    "source_sector": "Source.Sector",
    "source_teranga": "Source.Teranga",
    "SiteName_Source": "Source.SiteName",
    "SiteCategory_Source": "Source.SiteCategory",
    "SiteCode_Destination": "Dest.Site",
    "SiteName_Destination": "Dest.SiteName",
    "SiteCategory_Destination": "Dest.SiteCategory",
    "source_app_name": "Source.App.Name",
    "source_app_exec": "Source.App.Exec.Name",
    "url": "Source.Wr.Url",
    "dest_ip": "Dest.IP",
    "dest_aip_server_hostname": "Dest.Hostname",
    "dest_port": "Dest.Port",
    "con_protocol": "Dest.Protocol",
    "dest_aip_app_name": "Dest.AIP.App.Name",
    "dest_aip_server_function": "Dest.AIP.Function",
    "dest_aip_server_subfunction": "Dest.AIP.SubFunction",
    "dest_aip_app_criticality": "Dest.AIP.Criticality",
    "dest_aip_app_type": "Dest.AIP.App.Type",
    "dest_aip_app_sector": "Dest.AIP.Sector",
    "dest_aip_app_shared_unique_id": "Dest.AIP.Shared.Unique.ID",
    "dest_aip_appinstance_type": "Dest.AIP.Type.Env",
    "source_ip": "Source.IP",
    "source_aip_server_hostname": "Source.Hostname",
    "source_app_category": "Source.App.Category",
    "source_site": "Source.Site",
    "source_app_company": "Source.App.Company",
    "con_status": "Dest.Con.Status",
    "dest_site": "Dest.Site",
}


def rename_presentation(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in PRESENTATION_NAMES.items() if k in df.columns})


def with_measure(flows: DataFrame, measure: str = "SumConnect") -> DataFrame:
    """Add the chosen measure as ``Traffic``."""
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}; choose one of {', '.join(MEASURES)}")
    return flows.withColumn(TRAFFIC, F.col(MEASURES[measure]))


def label_sites(flows: DataFrame) -> DataFrame:
    """Site codes with their country."""
    return flows.withColumns({SRC: site_label(F.col(SRC), F.col("CountryCode_Source")),
                              DST: site_label(F.col(DST), F.col("CountryCode_Destination"))})


def traffic_edges(flows: DataFrame) -> DataFrame:
    """Traffic between each pair of sites, rounded half to even."""
    return (flows.filter(F.col(TRAFFIC) != 0).groupBy(SRC, DST)
            .agg(F.bround(F.sum(TRAFFIC).cast("double"), 0).alias(TRAFFIC)))


def traffic_edges_by_measure(flows: DataFrame, measures: dict[str, str] | None = None) -> DataFrame:
    """The edges of several measures from one pass: ``measure`` names each, and a pair without traffic of a measure has no edge for it."""
    measures = measures or MEASURES
    sums = flows.groupBy(SRC, DST).agg(*[F.bround(F.sum(F.when(F.col(c) != 0, F.col(c))).cast("double"), 0).alias(n) for n, c in measures.items()])
    return sums.unpivot([SRC, DST], list(measures), "measure", TRAFFIC).filter(F.col(TRAFFIC).isNotNull())


def rescale(edges: DataFrame, column: str = TRAFFIC, ceiling: float = 1_000_000) -> tuple[DataFrame, int]:
    """Divide by 1000 until every value is below ``ceiling``; also the power of ten of the unit.

    Rounding keeps order, so the largest value alone decides the number of steps.
    """
    largest = edges.agg(F.max(column).alias("m")).first()["m"]
    steps = 0
    while largest is not None and largest >= ceiling:
        largest = float(round(largest / 1000))
        steps += 1
    value = F.col(column).cast("double")
    for _ in range(steps):
        value = F.bround(value / 1000, 0)
    return edges.withColumn(column, value), 3 * steps


def site_totals(edges: DataFrame) -> DataFrame:
    """Incoming plus outgoing traffic of each site, and which roles it plays."""
    ends = F.array(F.struct(F.col(SRC).alias("Site"), F.lit(1).alias("out"), F.lit(0).alias("inn")),
                   F.struct(F.col(DST).alias("Site"), F.lit(0).alias("out"), F.lit(1).alias("inn")))
    return (edges.select(F.explode(ends).alias("e"), TRAFFIC).groupBy(F.col("e.Site").alias("Site"))
            .agg(F.sum(TRAFFIC).alias("Sum"), F.max("e.out").alias("is_source"), F.max("e.inn").alias("is_destination")))


def top_sites(edges: DataFrame, limit: int) -> DataFrame:
    return site_totals(edges).orderBy(F.col("Sum").desc(), "Site").limit(limit)


def fitting_sites(edges: DataFrame, limit: int) -> DataFrame:
    """Largest leading part of the top sites whose matrix (rows, columns and the label column) fits the limit."""
    ranked = W.orderBy(F.col("Sum").desc(), "Site").rowsBetween(W.unboundedPreceding, W.currentRow)
    size = F.sum(F.col("is_source") + F.col("is_destination")).over(ranked) + 1
    return top_sites(edges, limit).withColumn("_size", size).filter(F.col("_size") <= limit).select("Site")


def shrink_matrix(edges: DataFrame, limit: int) -> DataFrame:
    kept = cut_lineage(fitting_sites(edges, limit), "kept")
    inside = semi_join(edges, kept.withColumnRenamed("Site", SRC), [SRC])
    return semi_join(inside, kept.withColumnRenamed("Site", DST), [DST])


def trim_sizes(start: int) -> list[int]:
    """Edge counts tried by the trimming: a tenth less each time, then one by one once that stands still."""
    sizes, n = [], start
    while n > 0:
        sizes.append(n)
        smaller = round(n - n / 10)
        n = smaller if smaller < n else n - 1
    return sizes


def shrink_edges(edges: DataFrame, max_nodes: int, source: str = "source", dest: str = "destination",
                 weight: str = "traffic") -> DataFrame:
    """The heaviest edges, at most ``10 * max_nodes``, cut further until their nodes fit ``max_nodes``."""
    order = [F.col(weight).desc(), F.col(source), F.col(dest)]
    ranked = cut_lineage(edges.orderBy(*order).limit(10 * max_nodes)
                         .withColumn("_rank", F.row_number().over(W.orderBy(*order))), "heaviest")
    first_seen = (ranked.select(F.explode(F.array(source, dest)).alias("node"), "_rank")
                  .groupBy("node").agg(F.min("_rank").alias("_rank"))
                  .groupBy("_rank").agg(F.count("*").alias("_new")))
    running = W.orderBy("_rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = (ranked.select("_rank").join(first_seen, "_rank", "left")
               .withColumn("_nodes", F.sum(F.coalesce("_new", F.lit(0))).over(running)))
    total = ranked.agg(F.count("*").alias("n")).first()["n"]
    fits = counted.filter(F.col("_rank").isin(trim_sizes(total)) & (F.col("_nodes") <= max_nodes))
    size = fits.agg(F.coalesce(F.max("_rank"), F.lit(0)).alias("n")).first()["n"]
    return ranked.filter(F.col("_rank") <= size).select(*edges.columns)


def spread(edges: DataFrame, limit: int, names: list[str] | None = None, source: str = SRC, dest: str = DST,
           weight: str = TRAFFIC) -> DataFrame:
    """Matrix with one row per source and one column per destination; missing pairs are 0.

    The destination names become columns, so there must be at most ``limit`` of
    them; giving the names saves the job that finds them.
    """
    if names is None:
        names = [r[0] for r in edges.select(dest).distinct().orderBy(dest).limit(limit + 1).collect()]
    elif not edges.filter(~F.col(dest).isin(names) | F.col(dest).isNull()).isEmpty():
        raise ValueError("the edges have destinations that are not among the names")
    if len(names) > limit:
        raise ValueError(f"more than {limit} destinations; shrink the edges before spreading them")
    return edges.groupBy(source).pivot(dest, names).agg(F.sum(weight)).fillna(0)


def gather(matrix: DataFrame, source: str = SRC, dest: str = DST, weight: str = TRAFFIC) -> DataFrame:
    columns = [c for c in matrix.columns if c != source]
    return matrix.unpivot([source], columns, dest, weight)


def symmetrize(edges: DataFrame) -> DataFrame:
    """Undirected weights: both directions are summed, the diagonal counts once."""
    back = edges.filter(F.col(SRC) != F.col(DST)).select(F.col(DST).alias(SRC), F.col(SRC).alias(DST), TRAFFIC)
    return edges.select(SRC, DST, TRAFFIC).unionByName(back).groupBy(SRC, DST).agg(F.sum(TRAFFIC).alias(TRAFFIC))


def relabel_clusters(clusters: DataFrame) -> DataFrame:
    """Cluster ids 1..n in order of the old ids; clusters of one site, and sites without an id, become 999.

    Only the distinct ids are ordered, and there are no more of them than sites in the bounded matrix.
    """
    real = clusters.groupBy("Cluster").agg(F.count("*").alias("_n")).filter(
        (F.col("_n") > 1) & F.col("Cluster").isNotNull())
    numbered = real.select("Cluster", F.row_number().over(W.orderBy("Cluster")).alias("_new"))
    return lookup_join(clusters, numbered, "Cluster").select(
        "Site", F.coalesce("_new", F.lit(UNCLUSTERED)).alias("Cluster"))


def apply_clusters(flows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Prefix both sites with their cluster; rows with a site outside the clusters are dropped."""
    named = clusters.select("Site", F.concat_ws("-", F.col("Cluster").cast("string"), "Site").alias("_name"))
    result = flows
    for end in (SRC, DST):
        side = named.select(F.col("Site").alias(end), F.col("_name").alias(f"_{end}"))
        result = lookup_join(result, side, end, "inner").drop(end).withColumnRenamed(f"_{end}", end)
    return result.select(*flows.columns)


def subcluster_zoom(flows: DataFrame, clusters: DataFrame, chosen: list[int]) -> DataFrame:
    """Flows whose both ends lie in the chosen clusters; the country suffix of the labels is ignored."""
    sites = clusters.filter(F.col("Cluster").isin(chosen)).select(F.regexp_replace("Site", "-..$", "").alias("Site")).distinct()
    inside = semi_join(flows, sites.withColumnRenamed("Site", SRC), [SRC])
    return semi_join(inside, sites.withColumnRenamed("Site", DST), [DST])


def traffic_by_app(detail: DataFrame, app: str = "source_app_name") -> DataFrame:
    return detail.groupBy(app).agg(F.sum(TRAFFIC).alias(TRAFFIC))


def drilldown_server(server_flows: DataFrame, result: DataFrame) -> DataFrame:
    """Server flows that start at a destination of the present result."""
    servers = cut_lineage(result.select(F.col("dest_ip").alias("source_ip")).distinct(), "servers")
    return semi_join(server_flows, servers, ["source_ip"])


def clean_edges(edges: DataFrame, source: str = "source", dest: str = "destination", weight: str = "traffic") -> DataFrame:
    """Edges with two named ends and whole weights."""
    return edges.select(source, dest, F.col(weight).try_cast("bigint").cast("double").alias(weight)).filter(
        (F.col(source) != "") & (F.col(dest) != ""))


def label_edges(edges: DataFrame, source: str = "source", dest: str = "destination") -> DataFrame:
    return edges.withColumns({source: sanitize_label(F.col(source)), dest: sanitize_label(F.col(dest))})
