"""Detailed rows of the site map are shuffled once, and a batch is stored as small as the other tables."""

import glob

from pyspark.sql import functions as F
from test_placed import shuffles

from flowloom.operators import aggregates as ag
from flowloom.operators.joining import PLACE
from flowloom.session import work_path
from flowloom.streaming import ingest as st


def test_users_of_detail_rows_take_one_shuffle(spark, rows):
    keys = ag.detail_keys("device", True)
    flows = spark.range(120).withColumns({k: F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 3)) for k in keys}).withColumns(
        {"dest_port": (F.col("id") % 2).cast("int"), "Traffic": (F.col("id") % 4).cast("double"),
         "I_ID_U": F.when(F.col("id") % 7 == 0, F.lit("")).when(F.col("id") % 7 == 1, F.lit("U1,U2,")).when(F.col("id") % 7 > 2, F.concat(F.lit("U"), F.col("id") % 13))})
    found = ag.traffic_detail(flows, "device", True)
    assert shuffles(found) == 1 and PLACE not in found.columns  # two before
    one = flows.filter("Traffic <> 0").withColumn("u", F.explode(F.split(F.coalesce("I_ID_U", F.lit("")), ",")))
    users = one.groupBy(*keys).agg(F.array_join(F.array_sort(F.array_remove(F.collect_set("u"), "")), ",").alias("I_ID"))
    sums = flows.filter("Traffic <> 0").groupBy(*keys).agg(F.sum("Traffic").alias("Traffic"))
    assert rows(found.select(*keys, "I_ID")) == rows(users) and rows(found.select(*keys, "Traffic")) == rows(sums) and found.count() > 3


def test_a_batch_is_copied_and_stored_compressed(spark, tmp_path):
    some = spark.range(20).select(F.lit("device").alias("collecttype"), F.lit("e").alias("engine"), F.lit("2016-05-01").cast("date").alias("dt"),
                                  F.lit("20160501-a").alias("filedt"), F.lit("2016-05").alias("month"), "id")
    source, target, ledger = (f"{tmp_path}/{n}" for n in ("arrived", "stored", "meta"))
    some.write.parquet(source)
    before = set(glob.glob(f"{work_path(spark, 'x').rsplit('/', 1)[0]}/batch-*"))
    for _ in range(2):  # nothing new the second time
        st.ingest(spark, source, some.schema, target, ledger, partitions=("month",), checkpoint=f"{tmp_path}/checkpoint").awaitTermination()
    made = set(glob.glob(f"{work_path(spark, 'x').rsplit('/', 1)[0]}/batch-*")) - before
    files = [f for folder in [target, *made] for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
    assert made and all(".zstd." in f for f in files) and spark.read.parquet(target).count() == 20 and spark.read.parquet(ledger).count() == 1
