"""Readers for extracts, snapshots, repositories and stored tables."""

from __future__ import annotations

from collections import defaultdict
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions import file_parts
from flowloom.operators.joining import lookup_join, union_by_name

SNAPSHOT_COLUMNS = {
    "lsof": ["server_ip", "dt", "command", "pid", "user", "node", "name", "status"],
    "ps": ["server_ip", "dt", "user", "pid", "ppid", "time", "command"],
    "netstat": ["server_ip", "dt", "node", "local", "foreign", "status", "command"],
}
USAGE_SCHEMA = "date bigint, server string, name string, value double, `table` string, stream string, importdt string"
SMALLEST_FILE = 6 * 1024


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_extract(spark: SparkSession, paths, columns: list[str] | None = None, separator: str = ";") -> DataFrame:
    """Header CSV with text columns; malformed lines are dropped. Columns are those given, else those of the header."""
    reader = spark.read.options(header=True, sep=separator, mode="DROPMALFORMED", enforceSchema=False)
    if columns:
        reader = reader.schema(text_schema(columns))
    return reader.csv(paths)


def headers_of(spark: SparkSession, paths, first_column: str) -> dict[str, list[str]]:
    """Files by header line. Only the distinct (header, file) pairs reach the driver, one per file."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    found = lines.filter(F.col("value").rlike(f'^"?{first_column}"?;')).distinct().collect()
    groups: dict[str, list[str]] = defaultdict(list)
    for row in found:
        groups[row["value"]].append(row["path"])
    return dict(groups)


def read_evolving(spark: SparkSession, paths, first_column: str, separator: str = ";") -> DataFrame:
    """CSV files of several widths in one batch: one scan per distinct header, united by column name."""
    frames, groups = [], headers_of(spark, paths, first_column)
    read = {unquote(f).split("://")[-1].lstrip("/").removeprefix("file:").lstrip("/") for files in groups.values() for f in files}
    given = {f: unquote(f).split("://")[-1].lstrip("/").removeprefix("file:").lstrip("/") for f in spark.read.text(paths).inputFiles()}
    left_out = sorted(f for f, plain in given.items() if plain not in read)
    if left_out:
        raise ValueError(f"files that do not start with the column {first_column}: {left_out}")
    for header, files in sorted(groups.items()):
        columns = [c.strip('"') for c in header.split(separator)]
        frames.append(read_extract(spark, sorted(files), columns, separator))
    if not frames:
        raise ValueError(f"no file starts with the column {first_column}")
    return union_by_name(frames)


def read_snapshot(spark: SparkSession, paths, kind: str) -> DataFrame:
    """Headerless socket or process snapshot with its fixed text columns."""
    return spark.read.schema(text_schema(SNAPSHOT_COLUMNS[kind])).options(sep=";", mode="DROPMALFORMED").csv(paths)


def _high_characters(encoding: str) -> tuple[str, str]:
    """The characters 0x80-0x9f as Latin-1 reads them, and what ``encoding`` means by them."""
    pairs = []
    for code in range(0x80, 0xA0):
        meant = bytes([code]).decode(encoding, errors="ignore")
        if meant:
            pairs.append((chr(code), meant))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def read_repository(spark: SparkSession, paths, encoding: str = "windows-1252") -> DataFrame:
    """Repository CSV as text columns; the projections cast what they need.

    Spark reads no windows-1252, but it reads Latin-1, which differs in 32
    characters only; those are put right in the headers and in the values.
    """
    if encoding.lower() not in ("windows-1252", "cp1252"):
        return spark.read.options(header=True, sep=";", mode="DROPMALFORMED", encoding=encoding).csv(paths)
    raw = spark.read.options(header=True, sep=";", mode="DROPMALFORMED", encoding="iso-8859-1").csv(paths)
    read, meant = _high_characters("cp1252")
    table = str.maketrans(read, meant)
    return raw.select(*[F.translate(F.col(f"`{c}`"), read, meant).alias(c.translate(table)) for c in raw.columns])


def read_usage(spark: SparkSession, paths) -> DataFrame:
    return spark.read.schema(USAGE_SCHEMA).json(paths).filter(F.col("table") != "app")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot table whose dates may differ in columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored table, or an empty one with the schema when nothing is stored yet; other errors surface."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition() or error):
            raise
        return spark.createDataFrame([], schema)


def as_of(snapshots: DataFrame, day: str | None = None, column: str = "filedate") -> DataFrame:
    """Rows of the newest snapshot not after ``day``; of the newest one when no day is given.

    The date is found first and becomes a literal, so only its folder is read.
    """
    stamp = F.col(column).cast("date")
    dated = snapshots if day is None else snapshots.filter(stamp <= F.lit(day).cast("date"))
    newest = dated.agg(F.max(stamp).alias("d")).first()["d"]
    return snapshots.filter(F.lit(False)) if newest is None else snapshots.filter(stamp == F.lit(newest))


def group_by_type(paths: list[str]) -> dict[str, list[str]]:
    """Input files by the type before the first ``_`` of their name."""
    groups: dict[str, list[str]] = defaultdict(list)
    for path in paths:
        groups[path.rstrip("/").rsplit("/", 1)[-1].split("_", 1)[0]].append(path)
    return dict(groups)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Columns of a file scan plus the type, engine and dates its file name carries."""
    return df.select("*", *[c.alias(k) for k, c in file_parts(F.col("_metadata.file_name")).items()])


def large_enough(smallest: int = SMALLEST_FILE) -> Column:
    """Rows of files of at least ``smallest`` bytes."""
    return F.col("_metadata.file_size") >= smallest


def undersized_files(scan: DataFrame, smallest: int = SMALLEST_FILE) -> DataFrame:
    return scan.filter(~large_enough(smallest)).select(F.col("_metadata.file_path").alias("path")).distinct()


def read_filter_table(spark: SparkSession, path: str) -> DataFrame:
    """An uploaded application list of any size as a table, one column per header, for ``filters.filter_by_list``."""
    return spark.read.options(header=True, sep=";").csv(path)


def read_filter_list(spark: SparkSession, path: str, most_rows: int = 10_000) -> dict[str, list[str]]:
    """An uploaded application list: header → patterns. Without ``;`` in the header it is a single column.

    The list becomes part of a filter expression, so it has to be short; ``read_filter_table`` takes longer ones.
    """
    rows = spark.read.options(header=True, sep=";").csv(path).limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"a filter list may have {most_rows} rows")
    return {c: [r[c] for r in rows if r[c]] for c in rows[0].asDict()} if rows else {}


def extract_connections(connections: DataFrame, users: DataFrame, devices: DataFrame, binaries: DataFrame,
                        user_type: str, keep: Column) -> DataFrame:
    """Connections with user, device and binary attributes, without those of system users, where ``keep`` holds."""
    people = users.filter(F.col(user_type) != "system").drop(user_type)
    rows = connections.filter(keep)
    rows = lookup_join(rows, people, "user_id", "inner")
    rows = lookup_join(rows, devices, "device_id", "inner")
    return lookup_join(rows, binaries, "binary_id", "inner")
