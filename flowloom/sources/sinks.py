"""Writers for stored tables, exports and compacted files."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from contextlib import nullcontext

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.joining import PARTITION_TASKS, PLACE, anti_join, place_of, semi_join, union_by_name
from flowloom.session import COMPRESSION, cut_lineage, reading_by, work_path
from flowloom.sources.readers import read_or_empty

FILE_ROWS = 1_000_000
SORTED_BYTES = 32 << 20  # of a written table, read by a task that stores it by partition


def lie_together(written: DataFrame, partitions: list[str]) -> bool:
    """Whether the files of a written table hold few partitions each: a partition would get at most ``PARTITION_TASKS`` files and one
    more for every ``FILE_ROWS`` rows, if the rows were stored from where they are. Counted in one pass over the partition columns."""
    pairs = written.groupBy(F.col("_metadata.file_path").alias("_file"), *partitions).agg(F.count("*").alias("n"))
    each = pairs.groupBy(*partitions).agg(F.count("*").alias("files"), F.sum("n").alias("n"))
    few = F.col("files") <= PARTITION_TASKS + F.col("n") / FILE_ROWS
    return each.filter(~few).isEmpty()


def write_partitioned(df: DataFrame, path: str, partitions: list[str], together: bool = False) -> None:
    """Replace the partitions ``df`` touches and leave the others alone.

    The rebalance hint gives each partition few files and splits a partition
    that holds a large share of the rows. Rows that are placed by
    ``partition_places``, or that lie ``together`` in their files, have few
    files per partition as they are.
    """
    rows = df.drop(PLACE) if together or place_of(df) else df.hint("rebalance", *partitions)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION).partitionBy(*partitions)
    with reading_by(df.sparkSession, SORTED_BYTES) if together else nullcontext():  # the writer sorts the rows of a task by partition, so a task takes few of them
        writer.parquet(path)


def write_units(df: DataFrame, path: str, units: list[str], partitions: list[str], staged: bool = False) -> None:
    """Store ``df`` so that writing the same units again changes nothing.

    Partitions that already hold other units keep them: their rows are carried
    over before the touched partitions are replaced. ``df`` is computed once:
    the first write goes straight to the folder, a later one through a written
    copy, unless ``staged`` says that ``df`` is a written table already, or
    columns of one. Rows of a written table that lie together by partition are
    not shuffled.
    """
    if not _exists(df.sparkSession, path):
        write_partitioned(df, path, partitions, staged and lie_together(df, partitions))
        return
    df = df.drop(PLACE)
    stored = read_or_empty(df.sparkSession, path, _ddl(df))
    rows = df if staged else cut_lineage(df, "units")
    written = cut_lineage(rows.select(*dict.fromkeys([*partitions, *units])).distinct(), "touched")
    touched = written.select(*partitions).distinct()
    ends = written.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in partitions for f in (F.min, F.max)]).first()
    for c in partitions:  # as literals, so that only touched partitions are read
        if ends[f"min_{c}"] is not None:
            stored = stored.filter(F.col(c).between(F.lit(ends[f"min_{c}"]), F.lit(ends[f"max_{c}"])) | F.col(c).isNull())
    others = anti_join(semi_join(stored, touched, partitions), written.select(*units).distinct(), units)
    if others.agg(F.count("*").alias("n")).first()["n"] == 0:  # whole partitions are replaced
        write_partitioned(rows, path, partitions, lie_together(rows, partitions))
        return
    write_partitioned(rows.unionByName(others.select(*rows.columns)), path, partitions)


def read_stored(like: DataFrame, path: str) -> DataFrame:
    """The table stored at ``path`` in the layout of ``like``; a folder without files, where nothing was to be stored yet, is an empty table."""
    return read_or_empty(like.sparkSession, path, _ddl(like))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_snapshot(df: DataFrame, path: str, column: str = "filedate") -> None:
    """Store one dated snapshot; other dates stay."""
    write_partitioned(df, path, [column])


def write_table(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Replace a derived table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", COMPRESSION)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def append_ledger(entries: DataFrame, path: str, files: int | None = 1) -> None:
    """Add new units to the ledger, in ``files`` files (None: as many as there are tasks); units already there are not repeated,
    and nothing new writes nothing."""
    spark = entries.sparkSession
    stored = read_or_empty(spark, path, _ddl(entries))
    fresh = anti_join(entries.distinct(), stored, entries.columns)
    if not _exists(spark, path):
        (fresh.coalesce(files) if files else fresh).write.mode("append").parquet(path)
        return
    fresh = cut_lineage(fresh, "fresh")
    if not fresh.isEmpty():
        (fresh.coalesce(files) if files else fresh).write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    goal = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return goal.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(goal)


def _publish(spark: SparkSession, folder: str, target: str) -> str:
    """Move the only part file of ``folder`` to ``target``, replacing it."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(folder)
    system = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in system.listStatus(source) if s.getPath().getName().startswith("part-")]
    goal = jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(goal.getParent())
    system.delete(goal, True)
    if not system.rename(parts[0], goal):
        raise OSError(f"could not move {parts[0]} to {target}")
    system.delete(source, True)
    return target


def _check_target(folder: str, name: str, allowed_root: str | None) -> None:
    if not name:
        raise ValueError("the file name cannot be empty")
    inside = allowed_root is None or folder == allowed_root or folder.startswith(allowed_root.rstrip("/") + "/")
    if not inside or ".." in folder.split("/"):
        raise ValueError(f"{folder} lies outside {allowed_root}")


def export_csv(df: DataFrame, folder: str, name: str, gz: bool = True, separator: str = ";",
               allowed_root: str | None = None, single: bool = False, file_rows: int = FILE_ROWS) -> str:
    """Header CSV under one name: a folder of files of at most ``file_rows`` rows, each with the header.

    ``single`` asks for one file, which one task writes; it is meant for lists of a known small size.
    """
    _check_target(folder, name, allowed_root)
    spark, target = df.sparkSession, f"{folder.rstrip('/')}/{name}"
    options = {"header": True, "sep": separator, "compression": "gzip" if gz else "none"}
    if not single:
        df.write.mode("overwrite").options(maxRecordsPerFile=file_rows, **options).csv(target)
        return target
    staging = f"{folder.rstrip('/')}/.staging-{name}-{work_path(spark, 'x')[-12:]}"
    df.coalesce(1).write.mode("overwrite").options(**options).csv(staging)
    return _publish(spark, staging, target)


def export_json(df: DataFrame, folder: str, name: str, gz: bool = True, allowed_root: str | None = None,
                single: bool = False, file_rows: int = FILE_ROWS) -> str:
    """JSON lines under one name; as ``export_csv``."""
    _check_target(folder, name, allowed_root)
    spark, target = df.sparkSession, f"{folder.rstrip('/')}/{name}"
    compression = "gzip" if gz else "none"
    if not single:
        df.write.mode("overwrite").options(maxRecordsPerFile=file_rows, compression=compression).json(target)
        return target
    staging = f"{folder.rstrip('/')}/.staging-{name}-{work_path(spark, 'x')[-12:]}"
    df.coalesce(1).write.mode("overwrite").option("compression", compression).json(staging)
    return _publish(spark, staging, target)


def write_records(frames: list[DataFrame], path: str) -> None:
    """Frames united by name, as JSON records."""
    union_by_name(frames).write.mode("overwrite").option("compression", "gzip").json(path)


def _readable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        flags = []
        for content in batch["content"]:
            try:
                with gzip.open(io.BytesIO(content)) as stream:
                    while stream.read(1 << 20):
                        pass
                flags.append(True)
            except (OSError, EOFError):
                flags.append(False)
        yield pd.DataFrame({"path": batch["path"], "ok": flags})


def check_gzip(spark: SparkSession, paths) -> DataFrame:
    """Whether each gzip file can be read to its end: ``path, ok``. Meant for the small files of a collector."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(_readable, "path string, ok boolean")


def compact_csv(spark: SparkSession, paths, target: str, rows_per_file: int = 2_500_000, separator: str = ";") -> list[str]:
    """Merge small gzip CSV files of one type into few large ones that keep the header; returns the corrupt files left out.

    Rows are rebalanced by size, and a file never exceeds ``rows_per_file`` rows.
    """
    state = {r["path"]: r["ok"] for r in check_gzip(spark, paths).collect()}  # one short row per input file
    good, bad = sorted(p for p, ok in state.items() if ok), sorted(p for p, ok in state.items() if not ok)
    if good:
        merged = spark.read.options(header=True, sep=separator).csv(good)
        (merged.hint("rebalance").write.mode("overwrite")
         .options(header=True, sep=separator, compression="gzip", maxRecordsPerFile=rows_per_file).csv(target))
    return bad
