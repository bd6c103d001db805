"""Parsers for listener logs and for the raw output of socket tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import normalize_date

FIELDS = ["date", "time", "host_sid", "source_program", "source_host_name", "source_host_ip", "source_user",
          "host_port", "host_instance"]
AS_WRITTEN = {"date", "time"}

# Fixed values of the log format: parts of a line are separated by a star, and a description is a list of (KEY=value).
_BETWEEN_PARTS = r"\s\*\s"
_STAMP = r"(\S+)\s(\d\d:\d\d:\d\d)$"
_PAIR = r"([A-Za-z_]+)=(?!\()([^)]*)\)"
_DESCRIPTION, _EVENT = "(CONNECT_DATA=", "establish"
_SERVICE, _SERVICE_LAST = ["SID", "SERVICE_NAME"], ["SID", "SERVICE_NAME", "sid"]


def candidate_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that report an established connection."""
    return lines.filter(F.col(column).contains("CONNECT_DATA") & F.col(column).contains("establish"))


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is computed once, however many fields are taken from it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _with_parts(lines: DataFrame, column: str) -> DataFrame:
    """Add ``_found``: the fields of the line, NULL where it is no complete report of a connection.

    The description names program, host and user of the client in this order, and the service before the program or, not empty, behind the user.
    With the address of the client in a part of its own, the service before the program is preferred, without it the one behind the user, and
    the instance, which is the part after the event, stands in the place of the address; port and instance are unknown then.
    """
    rows = _once(candidate_lines(lines, column), F.split(F.regexp_replace(column, "<txt>", ""), _BETWEEN_PARTS), "_at")
    at, text = F.col("_at"), F.get("_at", F.lit(1))
    keys, values = (F.regexp_extract_all(text, F.lit(_PAIR), F.lit(i)) for i in (1, 2))
    rows = _once(rows, F.struct(keys.alias("keys"), values.alias("values"), F.array_position(at, _EVENT).cast("int").alias("event")), "_said")
    keys, values, event = F.col("_said.keys"), F.col("_said.values"), F.col("_said.event")
    program, host, user = (F.array_position(keys, k).cast("int") for k in ("PROGRAM", "HOST", "USER"))
    entries = F.transform(keys, lambda k, i: F.struct(k.alias("key"), F.get(values, i).alias("value"), (i + 1).alias("place")))
    before = F.try_element_at(F.filter(entries, lambda e: e["key"].isin(_SERVICE) & (e["place"] < program)), F.lit(-1))["value"]
    behind = F.try_element_at(F.filter(entries, lambda e: e["key"].isin(_SERVICE_LAST) & (e["place"] > user) & (e["value"] != "")), F.lit(-1))["value"]
    behind = F.when(F.get(values, host - 1) != "", behind)
    client = F.when(event == 4, F.get(at, F.lit(2)))
    address, port = F.regexp_extract(client, r"HOST=([^)]*)\)", 1), F.regexp_extract(client, r"\(PORT=(\d*)", 1)
    placed = client.rlike(r"HOST=[^)]*\).*\(PORT=")
    instance = F.regexp_extract(F.get(at, event), r"^(\S+)", 1)
    whole = (text.startswith(_DESCRIPTION) & F.get(at, F.lit(0)).rlike(_STAMP) & (program > 0) & (host > program) & (user > host)
             & (event > 2) & (F.size(at) > event + 1) & (instance != ""))
    with_address = F.coalesce(placed & (before.isNotNull() | (behind.isNotNull() & (port != ""))), F.lit(False))
    service = F.when(with_address, F.coalesce(before, behind)).otherwise(F.coalesce(behind, before))
    known = {
        "date": F.regexp_extract(F.get(at, F.lit(0)), _STAMP, 1), "time": F.regexp_extract(F.get(at, F.lit(0)), _STAMP, 2), "host_sid": service,
        "source_program": F.get(values, program - 1), "source_host_name": F.get(values, host - 1),
        "source_host_ip": F.when(with_address, address).otherwise(instance), "source_user": F.get(values, user - 1),
        "host_port": F.when(with_address, port).otherwise("unknown"), "host_instance": F.when(with_address, instance).otherwise("unknown"),
    }
    fields = F.struct(*[(known[f] if f in AS_WRITTEN else F.lower(known[f])).alias(f) for f in FIELDS])
    return _once(rows, F.when(whole & service.isNotNull(), fields), "_found").select(*lines.columns, "_found")


def parse_listener(lines: DataFrame, column: str = "value") -> DataFrame:
    """Fields of every line that reports a connection completely; other columns are kept."""
    return parsed_lines(read_lines(lines, column), column)


def quarantine(lines: DataFrame, column: str = "value") -> DataFrame:
    """Connection lines that are no complete report."""
    return broken_lines(read_lines(lines, column))


def read_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Connection lines with their fields in ``_found``, which both tables of a log are made of; the text is kept where no layout fits."""
    found = _with_parts(lines, column)
    return found.withColumn(column, F.when(F.col("_found").isNull(), F.col(column)))


def parsed_lines(read: DataFrame, column: str = "value") -> DataFrame:
    found = read.filter(F.col("_found").isNotNull())
    return found.select(*[c for c in read.columns if c not in (column, "_found")], *[F.col(f"_found.{f}").alias(f) for f in FIELDS])


def broken_lines(read: DataFrame) -> DataFrame:
    return read.filter(F.col("_found").isNull()).drop("_found")


def log_coverage(parsed: DataFrame, file_columns: list[str]) -> DataFrame:
    """First and last day per host and instance, with the attributes of the file."""
    day = normalize_date(F.upper("date"))
    return parsed.groupBy("host_name", "host_instance", *file_columns).agg(
        F.min(day).alias("date_min"), F.max(day).alias("date_max"))


def file_dates(lines: DataFrame, file: str, position: str, column: str = "value") -> DataFrame:
    """Date on the first and on the last dated line of each file."""
    pattern = r"(\d\d)-([^ |.]+).*?-(\d{2,4})\s(\d\d:\d\d:\d\d)"
    dated = lines.filter(F.col(column).rlike(pattern)).withColumn(
        "_d", F.concat_ws("-", *[F.regexp_extract(column, pattern, i) for i in (1, 2, 3)]))
    return dated.groupBy(file).agg(F.min_by("_d", position).alias("file_first_date"),
                                   F.max_by("_d", position).alias("file_last_date"))


def parse_lsof(lines: DataFrame, column: str = "value") -> DataFrame:
    """Socket rows of ``lsof -nPi``; the protocol stands in column 8, or in 7 when a column is missing."""
    token = F.split(F.trim(F.col(column)), r"\s+")

    def at(position: Column) -> Column:
        return F.coalesce(F.try_element_at(token, position), F.lit(""))

    eighth, seventh = at(F.lit(8)).rlike("UDP|TCP"), at(F.lit(7)).rlike("UDP|TCP")
    start = F.when(eighth, 8).when(seventh, 7)
    kept = [c for c in lines.columns if c != column]
    return lines.withColumn("_s", start).filter(F.col("_s").isNotNull()).select(
        *kept, at(F.lit(1)).alias("command"), at(F.lit(2)).alias("pid"), at(F.lit(3)).alias("user"),
        at(F.col("_s")).alias("node"), at(F.col("_s") + 1).alias("name"), at(F.col("_s") + 2).alias("status"))


def parse_ps(lines: DataFrame, column: str = "value") -> DataFrame:
    """Process rows of ``ps -ef``: user, pid, ppid, time and the whole command line."""
    pattern = r"^(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S.*)$"
    kept = [c for c in lines.columns if c != column]
    parts = {"user": 1, "pid": 2, "ppid": 3, "time": 7, "command": 8}
    return lines.filter(F.col(column).rlike(pattern)).select(
        *kept, *[F.regexp_extract(column, pattern, i).alias(n) for n, i in parts.items()])


def parse_netstat(lines: DataFrame, column: str = "value") -> DataFrame:
    """Socket rows of ``netstat -anp`` that name a program."""
    token = F.split(F.trim(F.col(column)), r"\s+")
    at = [F.coalesce(F.try_element_at(token, F.lit(i)), F.lit("")) for i in range(1, 8)]
    kept = [c for c in lines.columns if c != column]
    return lines.filter(at[0].rlike("(?i)udp|tcp") & (at[6] != "")).select(
        *kept, at[0].alias("node"), at[3].alias("local"), at[4].alias("foreign"), at[5].alias("status"), at[6].alias("command"))
