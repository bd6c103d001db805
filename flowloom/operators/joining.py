"""Joins with lookup tables whose size is measured before they are broadcast.

A lookup below the bound is broadcast, so the flow side is not shuffled. A
larger one takes Spark's shuffled join, where adaptive execution splits the
partitions of hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BYTES = 48 << 20
MAX_BYTES_SETTING = "flowloom.broadcast.maxBytes"


def broadcast_limit(spark) -> int:
    return int(spark.conf.get(MAX_BYTES_SETTING, str(DEFAULT_MAX_BYTES)))


def measured_bytes(df: DataFrame) -> int:
    """Unsafe-row size of all rows, computed by one distributed aggregate."""
    width = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast when its measured size is inside the bound, else unchanged."""
    limit = broadcast_limit(df.sparkSession)
    if limit > 0 and measured_bytes(df) <= limit:
        return F.broadcast(df)
    return df


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "left") -> DataFrame:
    return df.join(bounded_broadcast(lookup), on, how)


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return lookup_join(df, keys, on, "left_semi").select(*df.columns)


def anti_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return lookup_join(df, keys, on, "left_anti").select(*df.columns)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


PLACE = "_place"
PLACED_TASKS = 3  # times spark.sql.shuffle.partitions, so that the wide groups of a task stay in memory


def placed(df: DataFrame, keys: list) -> DataFrame:
    """``df`` with the rows of equal ``keys`` together, and a hash of these keys in the column ``_place``.

    Sums over ``_place`` and any keys that determine ``keys`` follow without another shuffle, so wide rows are sent once however
    often they are summed up. The rows of one value of ``keys`` meet in one task: for keys as fine as a daily flow, not for a site or a month.
    """
    tasks = PLACED_TASKS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(PLACE, F.xxhash64(*keys)).repartition(tasks, PLACE)


PARTITION_TASKS = 4


def partition_places(partitions: list[str], keys: list[str]) -> list:
    """What to place rows by that are summed up by ``keys`` and then stored: a partition is written by at most 4 tasks."""
    return [*partitions, F.pmod(F.xxhash64(*keys), F.lit(PARTITION_TASKS))]


def place_of(df: DataFrame) -> list[str]:
    """The column to group by besides the keys, if ``df`` comes from ``placed``."""
    return [c for c in df.columns if c == PLACE]


def prefixed(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in (columns or df.columns)])
