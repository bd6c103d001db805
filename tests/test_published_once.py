"""Published cubes come from rows that are shuffled once, and stored tables are written small."""

import datetime as dt
import glob

from pyspark.sql import functions as F
from test_placed import resolved_rows, shuffles

from flowloom.operators import aggregates as ag
from flowloom.operators import usersets as us
from flowloom.plans import jobs
from flowloom.session import cut_lineage
from flowloom.sources import sinks as sn

STARTS = [("Full", "2016-05-01"), ("Late", "2016-05-03")]


def _daily(spark, collecttype):
    flows = resolved_rows(spark).withColumns({"source_site": F.concat(F.lit("S"), F.col("id") % 3), "source_I_ID_site": F.when(F.col("id") % 4 > 0, F.concat(F.lit("I"), F.col("id") % 2))})
    if collecttype == "server":
        return ag.published_input(ag.agg_server_day(flows))
    return ag.published_input(ag.device_day_sets(flows, us.number_names(flows, "I_ID_U")))


def test_cubes_of_all_ranges_take_one_shuffle(spark, rows):
    valid = spark.createDataFrame([(dt.date(2016, 5, d),) for d in (1, 2, 4)], "dt date")
    for kind in ("device", "server"):
        daily = cut_lineage(_daily(spark, kind))
        found = jobs.tagged_rows(daily, kind, valid, STARTS)
        plan = ag.in_valid_days(daily, valid, "2016-05-01")
        assert shuffles(found) - shuffles(plan) == 1  # two for devices, before
        tagged = cut_lineage(found)
        for level in ("detail", "nodetail"):
            names = {(n, r): jobs.cube_name(kind, level, r, n) for n, _ in STARTS for r in jobs.RESOLUTIONS[kind]}
            cubes = jobs.cube_sums(tagged, kind, level, names)
            assert shuffles(cubes) == 1  # two for devices, before, and of rows repeated per cube
            cubes = cut_lineage(cubes)
            for (n, r), name in names.items():
                site = "source_I_ID_site" if kind == "device" and r == "IDM" else "source_site"
                inside = daily.join(valid, "dt", "left_semi").filter(F.col("dt") >= F.lit(dict(STARTS)[n])).withColumn("source_site", F.col(site))
                want = ag.cube_of(inside, ag.cube_keys(kind, level, "Device"), kind)
                assert want.count() > 1 and rows(cubes.filter(F.col("cube") == name).select(want.columns)) == rows(want)


def test_stored_tables_are_compressed_like_work_copies(spark, tmp_path):
    some = spark.range(8).withColumn("month", F.lit("m"))
    sn.write_partitioned(some, f"{tmp_path}/a", ["month"])
    sn.write_units(some, f"{tmp_path}/b", ["month"], ["month"])
    sn.write_table(some, f"{tmp_path}/c")
    found = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    assert len({f.split("/")[-2 if "month" not in f else -3] for f in found}) == 3 and all(".zstd." in f for f in found)
