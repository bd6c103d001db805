"""Row predicates. Each returns a boolean ``Column``; NULL never passes.

The site, country and category filters take an empty list for "no filter".
"""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import is_internal_ip
from flowloom.operators.joining import anti_join, broadcast_limit, lookup_join, measured_bytes, semi_join
from flowloom.session import cut_lineage, reading_by

EXCLUDED_STATUS = ["Disposed", "Standby", "Stock", "Disposal"]  # fixed values

# Header spellings of an uploaded application list, per side.
SOURCE_ALIASES = {
    "source_aip_app_shared_unique_id": "source_aip_app_shared_unique_id",
    "AIP.Shared.Unique.ID": "source_aip_app_shared_unique_id",
    "AIPSharedUniqueId": "source_aip_app_shared_unique_id",
    "source_aip_app_name": "source_aip_app_name",
    "aip_app_name": "source_aip_app_name",
    "AIPAppName": "source_aip_app_name",
    "AIPip": "source_ip",
    "NX_bin_exec_name": "source_app_exec",
}
DEST_ALIASES = {
    "dest_aip_app_shared_unique_id": "dest_aip_app_shared_unique_id",
    "AIP.Shared.Unique.ID": "dest_aip_app_shared_unique_id",
    "AIPSharedUniqueId": "dest_aip_app_shared_unique_id",
    "dest_aip_app_name": "dest_aip_app_name",
    "aip_app_name": "dest_aip_app_name",
    "AIPAppName": "dest_aip_app_name",
    "AIPip": "dest_ip",
    "NX_bin_exec_name": "dest_app_exec",
}


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def internal_both(source: str = "source_ip", dest: str = "dest_ip", strict: bool = True) -> Column:
    return is_internal_ip(F.col(source), strict) & is_internal_ip(F.col(dest), strict)


def status_allowed(column: str, excluded: list[str] = EXCLUDED_STATUS) -> Column:
    return _sure(~F.col(column).isin(excluded))


def live_ranges(status: str, active: str) -> Column:
    return F.col(status).isin("Live", "New") & (F.col(active) == "ON")


def between_days(column: str, first: date | str, last: date | str) -> Column:
    """Inclusive day window."""
    return F.col(column).between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))


def in_day_window(df: DataFrame, first: date | str, last: date | str, day: str = "dt", month: str = "month") -> DataFrame:
    """Day window plus the months it touches, so month-partitioned folders are pruned."""
    return df.filter(F.col(month).between(str(first)[:7], str(last)[:7]) & between_days(day, first, last))


def closed_only(column: str = "con_status") -> Column:
    return F.col(column) == "closed"


def usable_flow(source: str = "source_ip", dest: str = "dest_ip", status: str = "con_status") -> Column:
    """A mapped state and two different ends."""
    return F.col(status).isNotNull() & (F.col(source) != F.col(dest))


def _wanted(values) -> list[str]:
    values = [values] if isinstance(values, str) else list(values or [])
    return [] if not values or values[0] in ("", "All", None) else values


def _any_of(values: list[str]) -> str:
    return "(" + "|".join(values) + ")"


def sector_filter(source: str = "device", sectors=(), keep_null: bool = True, dest_sectors=(),
                  keep_null_dest: bool = True) -> Column:
    """Exact sectors on the device side, text match in the multi-valued application sectors elsewhere."""
    source_column = F.col("source_sector" if source == "device" else "source_aip_app_sector")
    test = F.lit(True)
    if not keep_null:
        test = test & source_column.isNotNull()
    if _wanted(sectors):
        wanted = _wanted(sectors)
        test = test & _sure(source_column.isin(wanted) if source == "device" else source_column.rlike(_any_of(wanted)))
    if not keep_null_dest:
        test = test & F.col("dest_aip_app_sector").isNotNull()
    if _wanted(dest_sectors):
        test = test & _sure(F.col("dest_aip_app_sector").rlike(_any_of(_wanted(dest_sectors))))
    return test


def include_ends(source_col: str, dest_col: str, sources=(), dests=(), operand: str = "OR") -> Column:
    """Keep rows whose ends are listed. With both lists the operand joins them; with one list only that end counts."""
    if operand not in ("AND", "OR"):
        raise ValueError(f"operand must be AND or OR, not {operand!r}")
    tests = []
    if _wanted(sources):
        tests.append(_sure(F.col(source_col).isin(_wanted(sources))))
    if _wanted(dests):
        tests.append(_sure(F.col(dest_col).isin(_wanted(dests))))
    if not tests:
        return F.lit(True)
    return reduce((lambda a, b: a & b) if operand == "AND" else (lambda a, b: a | b), tests)


def exclude_ends(source_col: str, dest_col: str, sources=(), dests=(), operand: str = "AND") -> Column:
    """Drop rows with a listed source or a listed destination; both operands mean the same here."""
    if operand not in ("AND", "OR"):
        raise ValueError(f"operand must be AND or OR, not {operand!r}")
    test = F.lit(True)
    if _wanted(sources):
        test = test & ~_sure(F.col(source_col).isin(_wanted(sources)))
    if _wanted(dests):
        test = test & ~_sure(F.col(dest_col).isin(_wanted(dests)))
    return test


def inter_intra(inter: bool = True, intra: bool = True, source_col: str = "SiteCode_Source",
                dest_col: str = "SiteCode_Destination") -> Column:
    if not inter and not intra:
        raise ValueError("at least one of inter-site and intra-site traffic must be kept")
    if inter and intra:
        return F.lit(True)
    same = F.col(source_col) == F.col(dest_col)
    return ~same if inter else same


def category_filter(df: DataFrame, categories: DataFrame, sources=(), dests=(), operand: str = "AND",
                    source_col: str = "SiteCode_Source", dest_col: str = "SiteCode_Destination") -> DataFrame:
    """Keep flows whose ends lie in sites of the given categories (``SiteCode, SiteScenario``)."""
    def sites_of(wanted: list[str], name: str) -> DataFrame:
        return categories.filter(F.col("SiteScenario").isin(wanted)).select(F.col("SiteCode").alias(name)).distinct()

    source_list, dest_list = _wanted(sources), _wanted(dests)
    if source_list and dest_list and operand == "OR":
        # One left join on each end; the sites are distinct, so no row is repeated.
        hit_source = sites_of(source_list, source_col).withColumn("_s", F.lit(True))
        hit_dest = sites_of(dest_list, dest_col).withColumn("_d", F.lit(True))
        joined = lookup_join(lookup_join(df, hit_source, source_col), hit_dest, dest_col)
        return joined.filter(F.col("_s") | F.col("_d")).select(*df.columns)
    if source_list:
        df = semi_join(df, sites_of(source_list, source_col), [source_col])
    if dest_list:
        df = semi_join(df, sites_of(dest_list, dest_col), [dest_col])
    return df


def parse_port_spec(spec: str) -> list[tuple[str, int, int]]:
    """``tcp/80|udp/1-100`` to (protocol, low, high); parts of any other shape are ignored."""
    found = []
    for part in spec.split("|"):
        match = re.fullmatch(r"(tcp|udp)/(\d+)(?:-(\d+))?", part)
        if match:
            ends = sorted((int(match[2]), int(match[3] or match[2])))
            found.append((match[1], *ends))
    return found


def port_filter(spec: str, mode: str = "include", protocol: str = "con_protocol", port: str = "dest_port") -> Column:
    """Port ranges become range comparisons, so no list of ports is ever built."""
    if mode not in ("include", "exclude"):
        raise ValueError(f"mode must be include or exclude, not {mode!r}")
    if not spec:
        return F.lit(True)
    hit = reduce(lambda a, b: a | b,
                 [(F.col(protocol) == p) & F.col(port).between(lo, hi) for p, lo, hi in parse_port_spec(spec)], F.lit(False))
    return _sure(hit) if mode == "include" else ~_sure(hit)


def application_filter(columns: list[str], filters: dict[str, list[str | None]] | None, side: str = "source",
                       mode: str = "include", operand: str = "OR") -> Column | None:
    """Test for one uploaded list: header → patterns. None when there is nothing to test.

    Include joins the columns by ``operand``; exclude drops the rows that match
    all of them. Headers that name no column of the data are skipped.
    """
    if mode == "none" or not filters:
        return None
    aliases = SOURCE_ALIASES if side == "source" else DEST_ALIASES
    tests = []
    for header, patterns in filters.items():
        column = aliases.get(header, header)
        patterns = [p for p in patterns if p]
        if column in columns and patterns:
            tests.append(_sure(F.col(column).rlike("|".join(patterns))))
    if not tests:
        return None
    every = mode == "exclude" or operand == "AND"
    test = reduce((lambda a, b: a & b) if every else (lambda a, b: a | b), tests)
    return ~test if mode == "exclude" else test


def application_list_filter(columns: list[str], source: dict | None = None, source_mode: str = "include",
                            source_operand: str = "OR", dest: dict | None = None, dest_mode: str = "include",
                            dest_operand: str = "OR", between: str = "AND") -> Column:
    """Source and destination lists joined by ``between``; a side without a list does not restrict."""
    tests = [
        application_filter(columns, source, "source", source_mode, source_operand),
        application_filter(columns, dest, "dest", dest_mode, dest_operand),
    ]
    tests = [x for x in tests if x is not None]
    if not tests:
        return F.lit(True)
    return reduce((lambda a, b: a & b) if between == "AND" else (lambda a, b: a | b), tests)


MOST_EXPRESSIONS = 1000
MOST_HEADS = 1000  # first two characters of the patterns, tested in the plan
PIECE_BYTES = 8 << 20  # of written values, cut into pieces by one task
_SPECIAL = r"[\\.^$|?*+()\[\]{}]"  # a pattern without these is plain text, but for ^ at its start and $ at its end


def _shape() -> list[Column]:
    body = F.col("_body")
    return [F.length(body).alias("_n"), F.substring(body, 1, 2).alias("_head"), F.right(body, F.lit(2)).alias("_tail")]


def _with_shape_of(pieces: DataFrame, plain: DataFrame) -> DataFrame:
    """Pieces that have the place, length, first and last two characters of some pattern; all others match none and are not shuffled.

    The shapes are far fewer than the patterns. If they are too many to be broadcast, all pieces stay.
    """
    shapes = cut_lineage(plain.select(*[c.alias(f"_s{i}") for i, c in enumerate(_shape())], F.col("_first").alias("_sf"), F.col("_last").alias("_sl")).distinct(), "shapes")
    if measured_bytes(shapes) > broadcast_limit(pieces.sparkSession):
        return pieces
    n, head, tail = _shape()
    like = (n == F.col("_s0")) & (head == F.col("_s1")) & (tail == F.col("_s2"))
    placed = (~F.col("_sf") | F.col("_begins")) & (~F.col("_sl") | F.col("_ends"))
    return pieces.join(F.broadcast(shapes), like & placed, "left_semi")


def _pieces(distinct: DataFrame, plain: DataFrame) -> DataFrame:
    """Pieces of the values that are as long as a pattern and stand where one of this length may: anywhere, or at an end if all of them are anchored.

    They are cut where a value has the first two characters of a pattern. If these are more than ``MOST_HEADS``, they are cut everywhere.
    """
    free, first, last = ~F.col("_first") & ~F.col("_last"), F.col("_first"), F.col("_last")
    found = plain.groupBy(F.length("_body").alias("n")).agg(F.bool_or(free).alias("free"), F.bool_or(first).alias("first"), F.bool_or(last).alias("last"))
    lengths = found.orderBy("n").collect()  # as many as a pattern has characters at most
    heads = [r["h"] for r in plain.select(F.substring("_body", 1, 2).alias("h")).distinct().limit(MOST_HEADS + 1).collect()]
    at, n = F.col("_at"), F.col("_l.n")
    places = distinct.filter(F.length("_value") > 0).withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_value"))))
    if len(heads) <= MOST_HEADS:
        starts = F.substring("_value", at, F.lit(2)).isin(heads)
        places = places.filter(starts | F.substring("_value", at, F.lit(1)).isin([h for h in heads if len(h) == 1]) if any(len(h) == 1 for h in heads) else starts)
    kinds = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("n", "free", "first", "last")]) for r in lengths]).cast("array<struct<n:int,free:boolean,first:boolean,last:boolean>>")
    begins, ends = at == 1, at + n - 1 == F.length("_value")
    cut = places.withColumn("_l", F.explode(kinds)).filter((at + n - 1 <= F.length("_value")) & (F.col("_l.free") | (F.col("_l.first") & begins) | (F.col("_l.last") & ends)))
    return cut.select("_value", F.substring("_value", at, n).alias("_body"), begins.alias("_begins"), ends.alias("_ends"))


def values_in_list(values: DataFrame, column: str, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Distinct values of ``column`` that hold one of the patterns; the list may be of any size and stays a table.

    Plain patterns, which may be anchored by ^ and $, meet the pieces of the values that are as long as one of them in an equality join: a value of n characters
    has at most n pieces for each length that occurs, and only those of the shape of a pattern are shuffled. Other patterns are regular expressions, tested on the distinct values as one
    expression. They become part of the plan, so there may be ``MOST_EXPRESSIONS`` of them. Null and empty patterns match nothing.
    """
    texts = patterns.select(F.col(pattern).alias("_p")).filter(F.coalesce(F.col("_p"), F.lit("")) != "").distinct()
    first, last = F.col("_p").startswith("^"), F.col("_p").endswith("$")
    body = F.substring(F.col("_p"), F.when(first, 2).otherwise(1), F.length("_p") - first.cast("int") - last.cast("int"))
    split = cut_lineage(texts.select("_p", body.alias("_body"), first.alias("_first"), last.alias("_last")).withColumn("_plain", ~F.col("_body").rlike(_SPECIAL) & (F.col("_body") != "")), "patterns")
    plain = split.filter("_plain").select("_body", "_first", "_last")  # distinct, as the patterns are
    distinct = cut_lineage(values.select(F.col(column).alias("_value")).filter(F.col("_value").isNotNull()).distinct(), "values")
    pieces = _with_shape_of(_pieces(distinct, plain), plain)
    placed = (~F.col("_first") | F.col("_begins")) & (~F.col("_last") | F.col("_ends"))
    hits = lookup_join(pieces, plain, "_body", "inner").filter(placed).select("_value")
    rest = [r["_p"] for r in split.filter("not _plain").select("_p").limit(MOST_EXPRESSIONS + 1).collect()]
    if len(rest) > MOST_EXPRESSIONS:
        raise ValueError(f"a filter list may have {MOST_EXPRESSIONS} regular expressions besides any number of plain patterns")
    if rest:
        hits = hits.unionByName(distinct.filter(F.col("_value").rlike("|".join(f"(?:{p})" for p in rest))))
    return hits.distinct().select(F.col("_value").alias(column))


def filter_by_list(rows: DataFrame, column: str, patterns: DataFrame, mode: str = "include", pattern: str = "pattern") -> DataFrame:
    """Rows whose ``column`` holds a pattern of the list, or those that hold none; a null value holds none."""
    if mode not in ("include", "exclude"):
        raise ValueError(f"mode must be include or exclude, not {mode!r}")
    listed = values_in_list(rows, column, patterns, pattern)
    with reading_by(rows.sparkSession, PIECE_BYTES):
        found = cut_lineage(listed, "listed")
    return (semi_join if mode == "include" else anti_join)(rows, found, [column])
