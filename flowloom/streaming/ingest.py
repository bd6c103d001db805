"""Incremental ingest and daily totals as streams.

The ledger stays the reference answer: arrival order is not file order, so
``ingest`` runs the batch rule on every micro-batch.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import ledger as lg
from flowloom.session import cut_lineage
from flowloom.sources import readers as rd
from flowloom.sources import sinks as sn


def ingest(spark: SparkSession, source: str, schema, target: str, ledger: str, filetype: str = "connection",
           partitions: tuple[str, ...] = ("month", "dt", "engine"), *, checkpoint: str, prepare=None):
    """Store the new rows of every file that has arrived, then stop. ``checkpoint`` is kept between calls.

    A micro-batch that is replayed after a failure writes the same units again,
    which changes neither the data nor the ledger.
    """
    incoming = spark.readStream.schema(schema).parquet(source)

    def store(batch: DataFrame, _: int) -> None:
        rows = prepare(batch) if prepare else batch
        known = rd.read_or_empty(spark, ledger, lg.LEDGER_SCHEMA)
        fresh = lg.new_rows(rows, known, filetype)
        written = cut_lineage(fresh, "batch")
        sn.write_units(written, target, [*lg.UNIT, "filedt"], list(partitions), staged=True)
        sn.append_ledger(lg.ledger_entries(written, filetype, lg.ENCODE), ledger)

    return (incoming.writeStream.foreachBatch(store).trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start())


def without_redelivery(stream: DataFrame, keys: list[str], event_time: str, delay: str = "7 days") -> DataFrame:
    """First arrival of each key; later copies within the delay are dropped.

    Unlike the ledger this keeps the file that arrived first, not the one with the earliest name.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def daily_totals(stream: DataFrame, event_time: str, keys: list[str], sums: dict[str, Column], delay: str = "1 day") -> DataFrame:
    """Totals per day and key. In append mode a day is written once the watermark has passed it; in complete mode every day is."""
    window = F.window(event_time, "1 day").alias("w")
    return (stream.withWatermark(event_time, delay).groupBy(window, *keys)
            .agg(F.count("*").alias("n"), *[F.sum(c).alias(n) for n, c in sums.items()])
            .select(F.col("w.start").cast("date").alias("dt"), *keys, "n", *sums))


def first_arrivals(stream: DataFrame, path: str, keys: list[str], day: str, checkpoint: str):
    """Store the first arrival of each key in a table partitioned by ``day``, one of the keys (a day or a month), until all arrived files are taken.

    No state is kept between batches: the keys of a batch are compared with the stored ones of the same days, whose partitions alone are
    read. So a re-delivery is found however late it comes, and a batch that is replayed adds nothing. Of equal keys in one batch
    the row with the least other columns counts; nulls in keys are values like any other.
    """
    spark = stream.sparkSession
    others = [c for c in stream.columns if c not in keys]

    def store(batch: DataFrame, _: int) -> None:
        once = batch.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_rest")).select(*keys, "_rest.*") if others else batch.distinct()
        rows = cut_lineage(once.select(*batch.columns), "batch")
        days = [r[day] for r in rows.select(day).distinct().collect()]  # calendar days
        stored = rd.read_or_empty(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields))
        known = stored.filter(F.col(day).isin([d for d in days if d is not None]) | F.col(day).isNull()).select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        fresh = cut_lineage(rows.join(known, same, "left_anti"), "fresh")
        if not fresh.isEmpty():
            fresh.hint("rebalance", day).write.mode("append").partitionBy(day).parquet(path)

    return (stream.writeStream.foreachBatch(store).trigger(availableNow=True).option("checkpointLocation", checkpoint).start())


def open_days_to_table(totals: DataFrame, path: str, keys: list[str], checkpoint: str, day: str = "dt"):
    """Keep a table of ``daily_totals`` up to date, open days included, until all arrived files are taken.

    A batch brings only the groups that it changed, and only the partitions of their days are replaced; days that the watermark has passed leave
    the state and stay as they are. The table is partitioned by ``day``.
    """

    def merge(batch: DataFrame, _: int) -> None:
        sn.write_units(cut_lineage(batch, "batch"), path, [day, *keys], [day], staged=True)

    return (totals.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(merge).start())


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Write a stream to a Parquet folder until all arrived files are taken.

    Mode ``complete`` replaces the folder by the whole result of each batch, so groups that are still open are in it.
    """
    if mode == "complete":
        return (stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
                .foreachBatch(lambda batch, _: sn.write_table(batch, path)).start())
    return (stream.writeStream.format("parquet").outputMode(mode).trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start(path))
