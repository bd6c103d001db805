"""Date and time expressions; unreadable input is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["parse_compact_ts", "compact_to_iso", "day_of", "month_of", "hour_of", "epoch_ms_to_ts", "normalize_date"]

# The date spellings of the listener logs.
MIXED_DATE_FORMATS = ["dd-MMM-yyyy", "dd-MMM-yy", "dd-MM-yyyy", "dd-MM-yy"]


def compact_to_iso(text: Column) -> Column:
    """``YYYYMMDD-HHMM`` to ``YYYY-MM-DDTHH:MM``; other text is unchanged."""
    return F.regexp_replace(text, r"(\d{4})(\d\d)(\d\d)-(\d\d)(\d\d)", r"$1-$2-$3T$4:$5")


def parse_compact_ts(text: Column) -> Column:
    return compact_to_iso(text).try_cast("timestamp_ntz")


def day_of(text: Column) -> Column:
    """Day of an ISO date or timestamp, given as text or as a time type."""
    return text.try_cast("date")


def month_of(text: Column) -> Column:
    return F.date_format(day_of(text), "yyyy-MM")


def hour_of(text: Column) -> Column:
    return F.hour(text.try_cast("timestamp_ntz"))


def epoch_ms_to_ts(millis: Column) -> Column:
    """Epoch milliseconds as a zone-free timestamp, so the session zone cannot shift days."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=(millis / F.lit(1000)).cast("decimal(18,6)"))


def normalize_date(text: Column) -> Column:
    """``dd-MON-yy(yy)`` or ``dd-mm-yy(yy)`` to a date; month names in any case."""
    month = F.initcap(F.lower(F.split_part(text, F.lit("-"), F.lit(2))))
    day, year = F.split_part(text, F.lit("-"), F.lit(1)), F.split_part(text, F.lit("-"), F.lit(3))
    tidy = F.when(text.rlike(r"^\d\d-[^-]+-(\d\d|\d{4})$"), F.concat_ws("-", day, month, year))
    attempts = []
    for fmt in MIXED_DATE_FORMATS:
        width = 4 if fmt.endswith("yyyy") else 2
        named = "MMM" in fmt
        shape = rf"^\d\d-{'[A-Za-z]{3}' if named else '[0-9]{2}'}-\d{{{width}}}$"
        attempts.append(F.when(tidy.rlike(shape), F.try_to_date(tidy, fmt)))
    return F.coalesce(*attempts)
