"""Dedup of content-defined chunks of lines, in native expressions only.

A hash over the hashes of the last ``WINDOW`` lines decides whether a chunk ends after a line, so inserted or missing lines move only
the boundaries next to them. Chunks of several lines that occur more than once in the corpus are removed except for the
first occurrence, after their bytes have been compared with it. Such chunks lose short passages, so the query and the pipeline take
``passage_dedup``: each line that is not blank is a boundary, and chunks are any two neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators.joining import bounded_broadcast
from flowloom.session import cut_lineage

WINDOW = 2
MEAN_LINES = 3
LEAST_LINES = 2
BLANKS = " \t\r\x0b\f"
NEXT_LINE = r"\n(?=[\x20\t\r\x0b\f]*[^\x20\t\r\x0b\f\n])"


def _span(lines: Column, first: Column, last: Column) -> Column:
    return F.slice(lines, first + 1, last - first + 1)


def chunks_of(docs: DataFrame, doc_id: str, text: str, window: int, mean_lines: int, least_lines: int) -> DataFrame:
    """(id, mark, first, last, body): chunks with enough lines that are not blank; ``mark`` tells texts of one id apart."""
    rows = docs.filter(F.col(text).contains("\n")).select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("mark"), F.split(F.col(text), "\n", -1).alias("lines"))
    rows = rows.withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
    ends = F.filter(F.transform("lines", lambda x, i: F.when(
        (i == F.size("lines") - 1) | (F.pmod(F.xxhash64(*[F.get("hashes", i - k) for k in range(window - 1, -1, -1)]), F.lit(mean_lines)) == 0), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("ends", ends).drop("hashes")
    bounds = F.transform("ends", lambda e, i: F.struct(F.when(i == 0, 0).otherwise(F.get("ends", i - 1) + 1).alias("first"), e.alias("last")))
    several = F.filter(bounds, lambda c: c["last"] - c["first"] + 1 >= least_lines)
    one = rows.select("id", "mark", "lines", F.explode(several).alias("c")).select("id", "mark", "c.*", _span(F.col("lines"), F.col("c.first"), F.col("c.last")).alias("own"))
    full = one.filter(F.size(F.filter("own", lambda x: F.trim(x) != "")) >= least_lines)
    return full.select("id", "mark", "first", "last", F.array_join("own", "\n").alias("body"))


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, mean_lines: int = MEAN_LINES, least_lines: int = LEAST_LINES) -> DataFrame:
    """(id, mark, first, last): chunks whose bytes stand in an earlier chunk, earlier by (id, mark, first); rows equal in id and text are one."""
    chunks = chunks_of(docs, doc_id, text, window, mean_lines, least_lines)
    # an id and text given several times is one place: it counts once
    key = F.xxhash64("body").alias("key")
    place = F.struct("id", "mark", "first").alias("place")
    twice = chunks.select(key, place).groupBy("key").agg(F.min("place").alias("least"), F.max("place").alias("most")).filter(F.col("least") != F.col("most")).select("key", "least")
    twice = cut_lineage(twice, "chunks")
    own = chunks.select(key, place, "last", "body").join(bounded_broadcast(twice), "key")
    own = cut_lineage(own.withColumn("is_first", F.col("place") == F.col("least")), "bodies")
    firsts = own.filter("is_first").groupBy("key").agg(F.min("body").alias("original"))
    same = own.filter(~F.col("is_first")).join(bounded_broadcast(firsts), "key").filter(F.col("body") == F.col("original"))
    return same.select("place.id", "place.mark", "place.first", "last").distinct()


def _without_lines(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` without the lines of ``gone`` (id, mark, first, last), whose stretches share no line, and ``removed_chunks``."""
    per_text = cut_lineage(gone.groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("found")), "removed")
    spans = per_text.select(F.struct("id", "mark", "found").alias("__gone"), F.xxhash64("id", "mark").alias("__key"))
    mark = F.xxhash64(F.col(text))
    old = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(doc_id).alias("__id"), mark.alias("__mark"), F.col(text).alias("__text"))
    old = old.withColumn("__key", F.xxhash64("__id", "__mark"))
    met = old.join(bounded_broadcast(spans), (old["__key"] == spans["__key"]) & F.col("__id").eqNullSafe(F.col("__gone.id")) & (F.col("__mark") == F.col("__gone.mark")), "left")
    found = F.col("__gone.found")
    # a column of its own, so that a text is split once and not once per stretch
    met = met.withColumn("__lines", F.when(found.isNotNull(), F.split("__text", "\n", -1)))
    lines = F.col("__lines")
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda r: r["last"] + 1))
    ends = F.concat(F.transform(found, lambda r: r["first"] - 1), F.array(F.size(lines) - 1))
    kept = F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), lambda x: x["e"] >= x["s"])
    rest = F.array_join(F.flatten(F.transform(kept, lambda x: _span(lines, x["s"], x["e"]))), "\n")
    cut = F.when(found.isNotNull() & F.col("__text").isNotNull(), rest).otherwise(F.col("__text"))
    none = F.array().cast("array<struct<first:int,last:int>>")
    columns = [(cut if c == text else F.col("__row").getField(c)).alias(c) for c in docs.columns if c != "removed_chunks"]
    return met.select(*columns, F.coalesce(found, none).alias("removed_chunks"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, mean_lines: int = MEAN_LINES, least_lines: int = LEAST_LINES) -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and ``removed_chunks``: (first, last) line of each, counted from 0 in the old text.

    Lines end at line feeds. The first occurrence stays: that of the smallest (id, hash of the text, line), null ids first. A chunk
    whose hash is that of another text's chunk but whose bytes differ stays. Null texts stay null, texts
    without a line feed as they are. Rows equal in id and text are one document and get one result. All columns of ``docs`` are kept;
    one named ``removed_chunks`` is replaced.
    """
    return _without_lines(docs, repeated_chunks(docs, doc_id, text, window, mean_lines, least_lines), doc_id, text)


def windows_of(docs: DataFrame, doc_id: str, text: str, bodies: bool) -> DataFrame:
    """(id, mark, first, last, key): every two lines that are not blank and follow one another, with the blank lines between them;
    ``bodies`` adds their text. No lambda refers to an array of the row, so the work grows with the text only."""
    rows = docs.filter(F.col(text).contains("\n")).select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    numbers = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.when(F.trim(x, F.lit(BLANKS)) != "", i)), lambda i: i.isNotNull())
    # a line that is not blank with the blank lines after it; blank lines at the start of the text are dropped
    pieces = F.filter(F.split("text", NEXT_LINE, -1), lambda p: F.trim(p, F.lit(BLANKS + "\n")) != "")
    rows = rows.select("id", "mark", F.arrays_zip(numbers.alias("n"), pieces.alias("p")).alias("z"))

    def window(a: Column, b: Column) -> Column:
        end = F.substring_index(b["p"], "\n", 1)
        body = [F.concat(a["p"], F.lit("\n"), end).alias("body")] if bodies else []
        return F.struct(a["n"].alias("first"), b["n"].alias("last"), F.xxhash64(a["p"], end).alias("key"), *body)

    pairs = rows.select("id", "mark", F.explode(F.zip_with("z", F.slice("z", 2, F.greatest(F.size("z"), F.lit(1))), window)).alias("w"))
    return pairs.select("id", "mark", "w.*").filter(F.col("last").isNotNull())


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, mark, first, last): stretches of windows whose bytes stand in an earlier window that shares no line with them."""
    keys = windows_of(docs, doc_id, text, False).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    keys = cut_lineage(keys, "windows")
    own = cut_lineage(windows_of(docs, doc_id, text, True).join(bounded_broadcast(keys), "key"), "bodies")
    place = F.struct("id", "mark", "first", "last")
    least = own.groupBy("key").agg(F.min(place).alias("least"), F.max(place).alias("most")).filter(F.col("least") != F.col("most")).drop("most")
    met = own.join(bounded_broadcast(cut_lineage(least, "least")), "key").withColumn("is_first", place == F.col("least"))
    same_text = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("mark") == F.col("least.mark"))
    # the bytes are shuffled once at any size, and no group is formed by them
    firsts = met.filter("is_first").select("key", "body")
    later = met.filter(~F.col("is_first") & (~same_text | (F.col("first") > F.col("least.last")))).select("id", "mark", "first", "last", "key", "body")
    gone = later.join(firsts, ["key", "body"], "left_semi")
    # a window goes on in the next one where its last line is the first line of that one
    each = gone.groupBy("id", "mark").agg(F.collect_set("first").alias("firsts"), F.collect_set("last").alias("lasts"))
    starts, ends = F.sort_array(F.array_except("firsts", "lasts")), F.sort_array(F.array_except("lasts", "firsts"))
    runs = each.select("id", "mark", F.explode(F.arrays_zip(starts.alias("first"), ends.alias("last"))).alias("run"))
    return runs.select("id", "mark", "run.first", "run.last")


def passage_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated passages of two or more lines, and ``removed_chunks`` as in ``line_dedup``.

    Every two neighbouring lines that are not blank are compared, so no passage is missed for where it begins or how short it is.
    The first occurrence of two lines stays, that of the smallest (id, hash of the text, line), unless one of them ends an earlier passage;
    the first occurrence of every single line always stays. Two lines that share a line with their first occurrence are
    none. Blank lines at either end of a passage stay. Two lines whose hash is that of others but whose bytes differ stay. Nulls, ids, repeated rows and
    other columns are as in ``line_dedup``.
    """
    return _without_lines(docs, repeated_passages(docs, doc_id, text), doc_id, text)
