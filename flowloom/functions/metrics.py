"""Names, tags and rounding of server metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "fix_metric_name", "metric_table", "metric_tags", "tag_get", "device_or_mount", "tier_or_default",
    "stream_table", "stream_metric",
]

# Display-name prefixes of the system and the disk metrics.
SYSTEM_PREFIXES = ["PROCESSOR Utilization", "MemPhysUsage", "MemVirtualUsage", "SwapUsage"]
DISK_PREFIXES = ["Ldsk:", "Ldisk"]


def fix_metric_name(name: Column) -> Column:
    return F.when(name == "processor utilization - overall cpu", "cpu_percent").otherwise(name)


def metric_table(table: Column) -> Column:
    """``iostat`` of ``iostat:mount=…``; the whole text when there is no colon."""
    return F.substring_index(table, ":", 1)


def metric_tags(table: Column) -> Column:
    """Text after the colon; NULL when there is none."""
    position = F.locate(":", table)
    return F.when(position > 0, table.substr(position + 1, F.length(table)))


def tag_get(tags: Column, name: str) -> Column:
    """Value of one ``k=v`` tag, or an empty string."""
    return F.coalesce(F.regexp_extract(tags, rf"(?:^|,){name}=([^,=]*)", 1), F.lit(""))


def device_or_mount(device: Column, mount: Column) -> Column:
    return F.coalesce(F.nullif(device, F.lit("")), mount)


def tier_or_default(tier: Column) -> Column:
    return F.coalesce(tier, F.lit("notFound"))


def _starts_with_any(text: Column, prefixes: list[str]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | text.startswith(prefix)
    return test


def stream_table(display: Column) -> Column:
    """Table and tags of a metric display string: ``sysstat``, ``iostat:mount=…,device=…`` or ``app``."""
    body = F.substring(display, 5, 100000)
    pair = r"([^ ]+) ?\((.+)\):"
    letter = r"\(?([A-Z]:)\)?"
    tags = (
        F.when(body.rlike(pair),
               F.concat(F.lit("mount="), F.regexp_extract(body, pair, 1),
                        F.lit(",device="), F.regexp_extract(body, pair, 2)))
        .when(body.rlike(letter), F.concat(F.lit("mount="), F.regexp_extract(body, letter, 1)))
        .otherwise("")
    )
    return (
        F.when(_starts_with_any(display, SYSTEM_PREFIXES), "sysstat")
        .when(_starts_with_any(display, DISK_PREFIXES), F.concat(F.lit("iostat:"), tags))
        .otherwise("app")
    )


def stream_metric(display: Column) -> Column:
    """Metric name of a display string: object and counter joined by ``_``, ``%`` and ``#`` spelled out."""
    disk, other = r"^L(disk[^ ]+).*\^\^(.*)", r":?([^: ]+)\^\^(.*)"

    def joined(pattern: str) -> Column:
        counter = F.replace(F.replace(F.regexp_extract(display, pattern, 2), F.lit("%"), F.lit("percent")),
                            F.lit("#"), F.lit("count"))
        return F.lower(F.concat(F.regexp_extract(display, pattern, 1), F.lit("_"), counter))

    return (
        F.when(display.rlike(disk), joined(disk)).when(display.rlike(other), joined(other)).otherwise(F.lower(display))
    )
