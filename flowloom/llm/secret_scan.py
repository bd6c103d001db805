"""Secret scan with linking of multipart credentials, in native expressions only.

Strong spans (assignments, access identifiers, long hexadecimal strings) are always reported. Weak parts are identifiers,
secret-like strings and endpoints; a weak part is reported only if a complementary part stands in
the same scope at most ``reach`` code points away, which an interval join over bins of that width finds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.session import cut_lineage

SECRET, IDENTIFIER, ENDPOINT = "secret", "identifier", "endpoint"
REACH = 200

# a name may follow "_" (DB_USER) but no letter or digit
_START = "(?<![A-Za-z0-9])"
_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap test that a text must pass to hold a match; ``least`` the shortest ``group`` that counts."""

    name: str
    role: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 0
    weak: bool = False


# The three strong kinds, in their order.
STRONG = (
    Kind("assign", SECRET, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"(?i)password|passwd|secret|token|api_?key", group=2, least=6),
    Kind("access", IDENTIFIER, "AKIA[A-Z0-9]+", "AKIA", least=20),
    Kind("hex", SECRET, "[0-9a-f]{24,}", "[0-9a-f]{24}"),
)
WEAK = (
    Kind("ident", IDENTIFIER, _START + r"(?i:(?:(?<!secret_)access[_-]?key(?:[_-]?id)?|client[_-]?id|user(?:name)?|login|account(?:[_-]?id)?))" + _ASSIGNED + "[A-Za-z0-9@._+-]{3,}",
         "(?i)access|client|user|login|account", weak=True),
    Kind("key", SECRET, r"(?<![A-Za-z0-9+/])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
         "|" + _START + "(?i:pwd|passphrase|private[_-]?key|credential)" + _ASSIGNED + "[A-Za-z0-9+/_.=-]{6,}",
         "(?i)[a-z0-9+/]{40}|pwd|passphrase|private|credential", weak=True),
    Kind("url", ENDPOINT, r"""(?i:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|ftp|s3)://[^\s"'<>]+|""" + _START + r"""(?i:host(?:name)?|endpoint|server)"""
         + _ASSIGNED + "[A-Za-z0-9.-]{4,}", "(?i)://|host|endpoint|server", weak=True),
)
KINDS = STRONG + WEAK
BREAK = Kind("break", "break", r"\n[\x20\t\r]*\n", "\n[\x20\t\r]*\n")
COMPLEMENTS = {SECRET: (IDENTIFIER, ENDPOINT), IDENTIFIER: (SECRET,), ENDPOINT: (SECRET,)}


def _parts(text: Column, kind: Kind, number: int) -> Column:
    """Matches from left to right: kind, number, length of the gap before, length, whether the match counts.

    The gaps are what splitting at the same pattern leaves, so positions need no search.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else found
    zipped = F.filter(F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), found.alias("all"), counted.alias("value")), lambda x: x["all"].isNotNull())
    made = F.transform(zipped, lambda x, i: F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(x["gap"]).cast("long").alias("gap"),
                                                     F.length(x["all"]).cast("long").alias("size"), (F.length(x["value"]) >= kind.least).alias("counts")))
    return F.when(text.rlike(kind.hint), made).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:bigint,size:bigint,counts:boolean>>"))


def parts_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, parts): a number for each row of ``docs`` and its raw matches; written once, so numbers stay."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), whole.alias("text"))
    for number, kind in enumerate((*KINDS, BREAK)):
        rows = rows.withColumn(f"parts{number}", _parts(F.col("text"), kind, number))
    weak = sum((F.size(f"parts{n}") for n, k in enumerate(KINDS) if k.weak), F.lit(0))
    all_parts = [*[f"parts{n}" for n in range(len(KINDS))], F.when(weak > 0, F.col(f"parts{len(KINDS)}")).otherwise(F.array())]
    return cut_lineage(rows.select("row", "doc_id", F.concat(*all_parts).alias("parts")), "secrets")


def _placed(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, scope): counting matches with their places; the scope is the number of blank lines before."""
    parts = found.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size"))
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scoped = ends.withColumn("scope", F.sum((F.col("kind") == len(KINDS)).cast("int")).over(before))
    return scoped.filter((F.col("kind") < len(KINDS)) & F.col("counts")).select("row", "kind", "start", "end", "scope")


def _binned(spans: DataFrame, margin: int, width: int) -> DataFrame:
    first, last = F.floor((F.col("start") - margin) / width), F.floor((F.col("end") - 1 + margin) / width)
    return spans.withColumn("bin", F.explode(F.sequence(first, last)))


def _one_of(numbers: list[int]) -> Column:
    return F.col("kind").isin(numbers)


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak spans that do not overlap a strong one and have a complementary part within reach in their scope."""
    strong = [n for n, k in enumerate(KINDS) if not k.weak]
    weak, firm = spans.filter(~_one_of(strong)), spans.filter(_one_of(strong))
    a, b = _binned(weak, 0, reach).alias("a"), _binned(firm, 0, reach).alias("b")
    overlaps = (F.col("a.row") == F.col("b.row")) & (F.col("a.bin") == F.col("b.bin")) & (F.col("b.start") < F.col("a.end")) & (F.col("b.end") > F.col("a.start"))
    hidden = a.join(b, overlaps, "left_semi").drop("bin").distinct()
    free = weak.join(hidden, ["row", "kind", "start", "end"], "left_anti").select(*spans.columns)
    parts = firm.unionByName(free)
    out = None
    for role, needed in COMPLEMENTS.items():
        mine = free.filter(_one_of([n for n, k in enumerate(KINDS) if k.weak and k.role == role]))
        theirs = parts.filter(_one_of([n for n, k in enumerate(KINDS) if k.role in needed]))
        a, b = _binned(mine, reach, reach).alias("a"), _binned(theirs, 0, reach).alias("b")
        near = ((F.col("a.row") == F.col("b.row")) & (F.col("a.scope") == F.col("b.scope")) & (F.col("a.bin") == F.col("b.bin"))
                & (F.col("b.start") <= F.col("a.end") + reach) & (F.col("b.end") >= F.col("a.start") - reach))
        found = a.join(b, near, "left_semi").drop("bin").distinct()
        out = found if out is None else out.unionByName(found)
    return out


def _of_kind(number: int):
    """A test of one argument: Spark gives a second one the position of the element."""
    return lambda span: span["kind"] == number


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), s["kind"] + 1), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, reach: int = REACH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, the number of spans of each strong kind, n_linked, and ``spans`` sorted by start and kind.

    A span is (start, kind, end) in code points, kind being its place in ``KINDS``. Matches of a kind are leftmost and do not overlap; a match that
    is too short is passed over. A scope ends at a blank line. Null and empty texts have no spans. Null ids and repeated
    rows stay, each with its own result. Other columns are ignored.
    """
    rows = parts_of(docs, doc_id, text)
    spans = cut_lineage(_placed(rows.filter(F.size("parts") > 0)), "spans")
    strong = spans.filter(_one_of([n for n, k in enumerate(KINDS) if not k.weak]))
    reported = strong.unionByName(linked(spans, reach))
    per_row = reported.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = rows.select("row", "doc_id").join(per_row, "row", "left").withColumn("spans", F.coalesce("spans", empty))
    counts = [F.size(F.filter("spans", _of_kind(n))).cast("long").alias(f"n_{k.name}") for n, k in enumerate(STRONG)]
    return out.select("doc_id", *counts, F.size(F.filter("spans", lambda s: s["kind"] >= len(STRONG))).cast("long").alias("n_linked"), "spans")


def digest(found: DataFrame) -> DataFrame:
    """The spans as text, the strong ones as a digest."""
    strong = F.filter("spans", lambda s: s["kind"] < len(STRONG))
    return found.select("doc_id", *[f"n_{k.name}" for k in STRONG], F.sha2(_written(strong), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"), "n_linked")
