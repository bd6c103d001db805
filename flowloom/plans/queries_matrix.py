"""Registered queries for the traffic matrix, its reduction and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import clustering as cl
from flowloom.operators import filters as fl
from flowloom.operators import lookups as lk
from flowloom.operators import matrix as mx
from flowloom.operators.aggregates import MEASURES
from flowloom.plans.queries_tables import ADDRESS_SITES
from flowloom.plans.jobs import site_lookup
from flowloom.plans.registry import query
from flowloom.session import cut_lineage

LIMIT = 24  # matrix limit of the example queries: rows, columns and the label column


def edges(t, measure: str = "SumData"):
    """Closed traffic between sites."""
    return mx.traffic_edges(mx.with_measure(t.d_cube.filter(fl.closed_only()), measure))


def written_edges(t):
    """The same, written once: the reductions read the few pairs of sites several times."""
    return cut_lineage(edges(t), "edges")


EDGES_SQL = """SELECT SiteCode_Source, SiteCode_Destination, CAST(sum(con_traffic) AS DOUBLE) AS Traffic
FROM d_cube WHERE con_status = 'closed' AND con_traffic <> 0 GROUP BY ALL"""


@query("traffic_matrix_edges", "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS measure, SiteCode_Source, SiteCode_Destination, CAST(sum({column}) AS DOUBLE) AS Traffic
FROM d_cube WHERE con_status = 'closed' AND {column} <> 0 GROUP BY ALL""" for name, column in MEASURES.items()))
def _(t):
    return mx.traffic_edges_by_measure(t.d_cube.filter(fl.closed_only()), MEASURES)


@query("topn_sites", f"""
WITH {ADDRESS_SITES},
e AS (SELECT coalesce(a.site, 'nf') AS src, coalesce(b.site, 'nf') AS dst, CAST(sum(con_traffic_in + con_traffic_out) AS DOUBLE) AS w
  FROM d_flows f LEFT JOIN address_site a ON f.source_ip = a.ip LEFT JOIN address_site b ON f.dest_ip = b.ip
  WHERE con_status = 'closed' GROUP BY ALL)
SELECT Site, sum(w) AS Sum, max(o) AS is_source, max(i) AS is_destination
FROM (SELECT src AS Site, w, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, w, 0, 1 FROM e) x
GROUP BY Site ORDER BY Sum DESC, Site LIMIT {LIMIT}""")
def _(t):
    flows = t.d_flows.filter(fl.closed_only()).select(
        "source_ip", "dest_ip", (F.col("con_traffic_in") + F.col("con_traffic_out")).alias(mx.TRAFFIC))
    sites = lk.resolve_sites(flows, site_lookup(t.d_mdm), {"source_ip": mx.SRC, "dest_ip": mx.DST})
    return mx.top_sites(mx.traffic_edges(sites), LIMIT)


TOTALS_SQL = f"""SELECT Site, sum(w) AS total, max(o) + max(i) AS roles FROM (
  SELECT SiteCode_Source AS Site, Traffic AS w, 1 AS o, 0 AS i FROM ({EDGES_SQL}) e
  UNION ALL SELECT SiteCode_Destination, Traffic, 0, 1 FROM ({EDGES_SQL}) e) x GROUP BY Site"""
KEPT_SQL = f"""SELECT Site FROM (SELECT *, sum(roles) OVER (ORDER BY total DESC, Site) + 1 AS size, row_number() OVER (ORDER BY total DESC, Site) AS rn
  FROM ({TOTALS_SQL}) t) r WHERE size <= {LIMIT} AND rn <= {LIMIT}"""
SHRUNK_SQL = f"SELECT * FROM ({EDGES_SQL}) e WHERE SiteCode_Source IN ({KEPT_SQL}) AND SiteCode_Destination IN ({KEPT_SQL})"


@query("shrink_matrix", SHRUNK_SQL)
def _(t):
    return mx.shrink_matrix(written_edges(t), LIMIT)


RESCALE_STEPS = """(SELECT CASE WHEN max(Traffic) < 1e6 THEN 0 WHEN round_even(max(Traffic) / 1000, 0) < 1e6 THEN 1
  WHEN round_even(round_even(max(Traffic) / 1000, 0) / 1000, 0) < 1e6 THEN 2 ELSE 3 END FROM e)"""


def _rescaled(value: str) -> str:
    one = f"round_even({value} / 1000, 0)"
    two = f"round_even({one} / 1000, 0)"
    return f"CASE {RESCALE_STEPS} WHEN 0 THEN {value} WHEN 1 THEN {one} WHEN 2 THEN {two} ELSE round_even({two} / 1000, 0) END"


@query("rescale_units", f"""
WITH e AS ({EDGES_SQL}) SELECT SiteCode_Source, SiteCode_Destination, {_rescaled('Traffic')} AS Traffic,
  CAST(3 * {RESCALE_STEPS} AS INTEGER) AS unit FROM e""")
def _(t):
    scaled, unit = mx.rescale(written_edges(t))
    return scaled.withColumn("unit", F.lit(unit))


APP_EDGES_SQL = """SELECT source_app_name AS source, dest_aip_app_name AS destination, CAST(sum(con_traffic) AS DOUBLE) AS traffic
FROM d_cube GROUP BY ALL"""
NODE_LIMIT = 12


def app_edges(t):
    return t.d_cube.groupBy(F.col("source_app_name").alias("source"), F.col("dest_aip_app_name").alias("destination")).agg(
        F.sum("con_traffic").cast("double").alias("traffic"))


# Every size of the trimming sequence, worked out beforehand; the start is ten edges per node or all edges.
SIZES_SQL = ", ".join(f"({a}, {s})" for a in range(1, 10 * NODE_LIMIT + 1) for s in mx.trim_sizes(a))
SHRINK_EDGES_SQL = f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY traffic DESC, source, destination) AS rn FROM ({APP_EDGES_SQL}) e
           QUALIFY rn <= {10 * NODE_LIMIT}),
seen AS (SELECT node, min(rn) AS rn FROM (SELECT source AS node, rn FROM r UNION ALL SELECT destination, rn FROM r) x GROUP BY node),
c AS (SELECT r.rn, (SELECT count(*) FROM seen WHERE seen.rn <= r.rn) AS nodes FROM r),
sizes(start_size, size) AS (VALUES {SIZES_SQL}),
best AS (SELECT coalesce(max(c.rn), 0) AS n FROM c JOIN sizes ON size = c.rn AND start_size = (SELECT count(*) FROM r) WHERE nodes <= {NODE_LIMIT})
SELECT source, destination, traffic FROM r WHERE rn <= (SELECT n FROM best)"""


@query("shrink_edges", SHRINK_EDGES_SQL)
def _(t):
    return mx.shrink_edges(app_edges(t), NODE_LIMIT)


MATRIX_SITES = ["nf", *[f"S{i}" for i in range(25)]]  # the sites of the nation table


def _cell(site: str) -> str:
    return f"coalesce(sum(CASE WHEN SiteCode_Destination = '{site}' THEN Traffic END), 0) AS {site}"


@query("matrix_spread", f"""SELECT SiteCode_Source, {', '.join(_cell(s) for s in MATRIX_SITES)} FROM ({EDGES_SQL}) e GROUP BY ALL""")
def _(t):
    return mx.spread(edges(t), 100, MATRIX_SITES)


@query("matrix_gather", f"""
SELECT s.SiteCode_Source, d.SiteCode_Destination, coalesce(e.Traffic, 0) AS Traffic
FROM (SELECT DISTINCT SiteCode_Source FROM ({SHRUNK_SQL}) a) s CROSS JOIN (SELECT DISTINCT SiteCode_Destination FROM ({SHRUNK_SQL}) b) d
LEFT JOIN ({SHRUNK_SQL}) e ON e.SiteCode_Source = s.SiteCode_Source AND e.SiteCode_Destination = d.SiteCode_Destination""")
def _(t):
    return mx.gather(mx.spread(mx.shrink_matrix(written_edges(t), LIMIT), LIMIT))


@query("graph_symmetrize", f"""
SELECT SiteCode_Source, SiteCode_Destination, sum(Traffic) AS Traffic FROM (SELECT * FROM ({EDGES_SQL}) a UNION ALL
  SELECT SiteCode_Destination, SiteCode_Source, Traffic FROM ({EDGES_SQL}) b WHERE SiteCode_Source <> SiteCode_Destination) x GROUP BY ALL""")
def _(t):
    return mx.symmetrize(edges(t))


# Clusters given by region: sites of one region belong together.
CLUSTERS_SQL = """SELECT concat('S', CAST(n_nationkey AS VARCHAR)) AS Site,
  CASE WHEN n_regionkey = 4 THEN 900 + n_nationkey ELSE 10 * n_regionkey + 1 END AS Cluster FROM nation"""
RELABEL_SQL = f"""SELECT Site, CAST(coalesce(n, 999) AS INTEGER) AS Cluster FROM ({CLUSTERS_SQL}) c
LEFT JOIN (SELECT Cluster AS k, row_number() OVER (ORDER BY Cluster) AS n FROM ({CLUSTERS_SQL}) x GROUP BY Cluster HAVING count(*) > 1) y ON c.Cluster = y.k"""


def clusters(t):
    old = F.when(F.col("n_regionkey") == 4, 900 + F.col("n_nationkey")).otherwise(10 * F.col("n_regionkey") + 1)
    named = t.nation.select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("Site"), old.alias("Cluster"))
    return mx.relabel_clusters(named)


@query("relabel_clusters", RELABEL_SQL)
def _(t):
    return clusters(t)


@query("apply_clusters", f"""
SELECT concat(CAST(a.Cluster AS VARCHAR), '-', a.Site) AS SiteCode_Source, concat(CAST(b.Cluster AS VARCHAR), '-', b.Site) AS SiteCode_Destination, Traffic
FROM ({EDGES_SQL}) e JOIN ({RELABEL_SQL}) a ON e.SiteCode_Source = a.Site JOIN ({RELABEL_SQL}) b ON e.SiteCode_Destination = b.Site""")
def _(t):
    return mx.apply_clusters(edges(t), clusters(t))


@query("subcluster_zoom", f"""
SELECT SiteCode_Source, SiteCode_Destination, count(*) AS n FROM d_cube
WHERE SiteCode_Source IN (SELECT Site FROM ({RELABEL_SQL}) a WHERE Cluster IN (1, 3))
  AND SiteCode_Destination IN (SELECT Site FROM ({RELABEL_SQL}) a WHERE Cluster IN (1, 3)) GROUP BY ALL""")
def _(t):
    labelled = clusters(t).withColumn("Site", F.concat("Site", F.lit("-CC")))
    return mx.subcluster_zoom(t.d_cube, labelled, [1, 3]).groupBy(mx.SRC, mx.DST).agg(F.count("*").alias("n"))


@query("traffic_by_app", "SELECT source_app_name, CAST(sum(con_number) AS BIGINT) AS Traffic FROM d_cube GROUP BY ALL")
def _(t):
    return mx.traffic_by_app(mx.with_measure(t.d_cube, "SumConnect"))


@query("drilldown_server", """
SELECT source_ip, dest_ip, dest_port, count(*) AS n FROM (SELECT dest_ip AS source_ip, source_ip AS dest_ip, dest_port FROM d_flows) x
WHERE source_ip IN (SELECT dest_ip FROM d_cube WHERE SiteCode_Source = 'S1' AND dest_port < 100) GROUP BY ALL""")
def _(t):
    # Flows of the servers themselves: the server side of every connection as the source.
    own = t.d_flows.select(F.col("dest_ip").alias("source_ip"), F.col("source_ip").alias("dest_ip"), "dest_port")
    result = t.d_cube.filter((F.col(mx.SRC) == "S1") & (F.col("dest_port") < 100))
    return mx.drilldown_server(own, result).groupBy("source_ip", "dest_ip", "dest_port").agg(F.count("*").alias("n"))


# Groups that are known beforehand: nations of one region trade with each other alone, by the customers of the region.
# A site's own traffic counts twice, as every other pair does in both directions, so sites of a region look alike.
def planted(t):
    sites = t.nation.select("n_regionkey", F.col("n_nationkey"), F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("site"))
    sizes = t.customer.join(sites, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(F.count("*").cast("double").alias("n"))
    ends = sites.select("n_regionkey", F.col("site").alias(mx.SRC)).join(sites.select("n_regionkey", F.col("site").alias(mx.DST)), "n_regionkey")
    return ends.join(sizes, "n_regionkey").select(mx.SRC, mx.DST, (F.col("n") * F.when(F.col(mx.SRC) == F.col(mx.DST), 2).otherwise(1)).alias(mx.TRAFFIC))


def named_by_first(found):
    first = found.groupBy("Cluster").agg(F.min("Site").alias("first_site"))
    return found.join(first, "Cluster").select("Site", "first_site")


PLANTED_SQL = """
SELECT Site, min(Site) OVER (PARTITION BY n_regionkey) AS first_site FROM (
  SELECT concat('S', CAST(n_nationkey AS VARCHAR)) AS Site, n_regionkey FROM nation
  WHERE n_regionkey IN (SELECT n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)) x"""


@query("cluster_mcl_planted", PLANTED_SQL)
def _(t):
    return named_by_first(cl.markov_clusters(planted(t)))


@query("cluster_kmeans_planted", PLANTED_SQL)
def _(t):
    return named_by_first(cl.kmeans_clusters(planted(t), 5))


@query("cluster_mcl")
def _(t):
    return cl.markov_clusters(mx.shrink_matrix(written_edges(t), LIMIT))


@query("cluster_kmeans")
def _(t):
    return cl.kmeans_clusters(mx.shrink_matrix(written_edges(t), LIMIT), 4)
