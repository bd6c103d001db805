"""The ledger of processed units, and what is still to do.

An event unit is (filetype, collecttype, engine, dt) with the file that
delivered it; a socket unit is (filetype, server_ip, dt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions import day_of
from flowloom.operators.joining import anti_join, lookup_join, semi_join, union_by_name
from flowloom.session import cut_lineage

# One stage name per job.
ENCODE, RESOLVE, RESOLVE_EXECUTION, AGGREGATE = "pipe2to3", "pipe3to4", "pipe3to4_Exec", "pipe4to5"
ENCODE_SOCKETS, RESOLVE_SOCKETS, AGGREGATE_SOCKETS = "encodesockets", "resolvesockets", "aggregatesockets"

UNIT = ["collecttype", "engine", "dt"]
LEDGER_COLUMNS = ["filetype", "stage", "collecttype", "engine", "dt", "filedt"]
LEDGER_SCHEMA = "filetype string, stage string, collecttype string, engine string, dt date, filedt string"
SOCKET_COLUMNS = ["filetype", "stage", "server_ip", "dt"]
SOCKET_SCHEMA = "filetype string, stage string, server_ip string, dt string"


def earliest_files(ledger: DataFrame, stage: str) -> DataFrame:
    """First file recorded for each unit of one stage."""
    return (ledger.filter(F.col("stage") == stage).groupBy("filetype", *UNIT)
            .agg(F.min("filedt").alias("min_filedt")))


def stage_units(ledger: DataFrame, stage: str) -> DataFrame:
    """Socket units of one stage."""
    return ledger.filter(F.col("stage") == stage).select("filetype", "server_ip", "dt").distinct()


def deliveries_of(ledger: DataFrame, stage: str, filetype: str) -> DataFrame:
    """The delivery that counts for each socket unit of one stage, the last one."""
    mine = ledger.filter((F.col("stage") == stage) & (F.col("filetype") == filetype))
    return mine.groupBy("server_ip", "dt").agg(F.max("delivery").alias("delivery"))


def new_rows(rows: DataFrame, ledger: DataFrame, filetype: str, stage: str = ENCODE) -> DataFrame:
    """Rows of a new unit, or of a file earlier than the one recorded for the unit."""
    known = earliest_files(ledger, stage).filter(F.col("filetype") == filetype).drop("filetype")
    joined = lookup_join(rows, known, UNIT, "left")
    return joined.filter(F.col("min_filedt").isNull() | (F.col("min_filedt") > F.col("filedt"))).select(*rows.columns)


def pending(ledger: DataFrame, done_stage: str, next_stage: str, filetype: str) -> DataFrame:
    """Units finished by one stage that the next stage has not taken with the same file."""
    done = earliest_files(ledger, done_stage).filter(F.col("filetype") == filetype)
    taken = earliest_files(ledger, next_stage)
    return anti_join(done, taken, ["filetype", *UNIT, "min_filedt"])


def with_webrequests(units: DataFrame, ledger: DataFrame) -> DataFrame:
    """Units whose engine and file also delivered web requests."""
    requests = (earliest_files(ledger, ENCODE).filter(F.col("filetype") == "webrequest")
                .select("engine", "min_filedt").distinct())
    return semi_join(units, requests, ["engine", "min_filedt"])


def pending_connections(ledger: DataFrame) -> DataFrame:
    return with_webrequests(pending(ledger, ENCODE, RESOLVE, "connection"), ledger)


def pending_executions(ledger: DataFrame) -> DataFrame:
    return pending(ledger, ENCODE, RESOLVE_EXECUTION, "execution")


def pending_aggregates(ledger: DataFrame) -> DataFrame:
    return pending(ledger, RESOLVE, AGGREGATE, "connection")


def pending_sockets(ledger: DataFrame, done_stage: str = ENCODE_SOCKETS, next_stage: str = RESOLVE_SOCKETS,
                    filetype: str = "lsof") -> DataFrame:
    done = stage_units(ledger, done_stage).filter(F.col("filetype") == filetype)
    return anti_join(done, stage_units(ledger, next_stage), ["filetype", "server_ip", "dt"])


def new_snapshots(rows: DataFrame, ledger: DataFrame, filetype: str) -> DataFrame:
    """Socket rows of snapshots that were not encoded yet."""
    known = stage_units(ledger, ENCODE_SOCKETS).filter(F.col("filetype") == filetype).drop("filetype")
    return anti_join(rows, known, ["server_ip", "dt"])


def rows_of_units(rows: DataFrame, units: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the given units, optionally only for a window of days."""
    if first is not None:
        units = units.filter(F.col("dt") >= F.lit(str(first)).cast("date"))
    if last is not None:
        units = units.filter(F.col("dt") <= F.lit(str(last)).cast("date"))
    wanted = units.select(*UNIT, F.col("min_filedt").alias("filedt")).distinct()
    return semi_join(rows, wanted, [*UNIT, "filedt"])


def in_days_of(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Rows on the days of the units. The days, at most one value per calendar day, become literals, so only
    their partitions of a stored table are read. ``units`` should be a written table."""
    days = [r["dt"] for r in units.select("dt").distinct().orderBy("dt").collect()]
    return rows.filter(F.col("dt").isin(days) if days else F.lit(False))


def in_snapshot_days(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Stored snapshots on the days of the socket units, which become literals like those of ``in_days_of``."""
    days = [r["day"] for r in units.select(day_of(F.col("dt")).alias("day")).distinct().orderBy("day").collect()]
    return rows.filter(F.col("day").isin(days) if days else F.lit(False))


def hour_coverage(rows: DataFrame, end_hour) -> DataFrame:
    """First and last hour seen per unit and file."""
    return rows.groupBy(*UNIT, "filedt").agg(F.min(end_hour).alias("min_hour"), F.max(end_hour).alias("max_hour"))


def complete_units(coverage: DataFrame, first_hour: int = 3, last_hour: int = 23) -> DataFrame:
    return coverage.filter((F.col("min_hour") <= first_hour) & (F.col("max_hour") >= last_hour))


def complete_rows(rows: DataFrame, end_hour) -> DataFrame:
    """Rows of days that were delivered from the first to the last hours."""
    # Found in one narrow pass and written, so that measuring and joining the units does not repeat it.
    units = cut_lineage(complete_units(hour_coverage(rows, end_hour)).select(*UNIT, "filedt"), "whole-days")
    return semi_join(rows, units, [*UNIT, "filedt"])


def ledger_entries(rows: DataFrame, filetype: str, stage: str) -> DataFrame:
    """Distinct units of ``rows`` as ledger rows."""
    return rows.select(F.lit(filetype).alias("filetype"), F.lit(stage).alias("stage"), "collecttype", "engine",
                       "dt", "filedt").distinct()


def socket_entries(rows: DataFrame, filetype: str, stage: str) -> DataFrame:
    return rows.select(F.lit(filetype).alias("filetype"), F.lit(stage).alias("stage"), "server_ip", "dt").distinct()


def rebuild(datasets: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Ledger from stored data: (rows, filetype, stage) for every dataset."""
    return union_by_name([ledger_entries(rows, filetype, stage) for rows, filetype, stage in datasets])


def rebuild_sockets(datasets: list[tuple[DataFrame, str, str]]) -> DataFrame:
    return union_by_name([socket_entries(rows, filetype, stage) for rows, filetype, stage in datasets])
