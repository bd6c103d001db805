"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are one edit apart (a code point inserted, deleted or replaced) exactly if their common prefix and common suffix
together reach the longer length minus one. Words are laid out as padded code-point matrices, once aligned left and once aligned
right, and blocks of rows are compared column by column. Which blocks meet follows from the same rule: cut the longer length
into segments, then one edit lies in one segment, so both words agree before it and after it. Every word therefore stands
in one block per segment and possible longer length; a block with very many words is cut into tiles, and pairs of tiles are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators.joining import bounded_broadcast
from flowloom.session import cut_lineage

SEGMENTS = 3
TILE = 1024
PAIRS_AT_ONCE = 1 << 17
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(docs: DataFrame, least: int = 7, often: int = 2, lossy: int = 31, letters: str = LETTERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of ``letters`` with A-Z lower-cased, of at least ``least`` code points and ``often`` occurrences.

    Where ``lossy`` divides the CRC32 of "<doc_id>:<run>", one code point of the run is lost, that at the checksum modulo the length
    (a null id is written as nothing). Null and empty texts have no words. Runs shorter than ``least`` are never cut out.
    """
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"[{letters}]{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    rows = rows.select("id", F.translate("run", _UPPER, _LOWER).alias("run")).withColumn("sum", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("sum") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("sum") % lossy == 0, short).otherwise(F.col("run"))
    return rows.select(word.alias("word")).filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= often)


def _blocks(segments: int) -> Column:
    """The blocks of a word: for each longer length and segment a hash of what both words of a pair must share."""
    out = []
    for more in (0, 1):
        longer = F.length("word") + more
        for i in range(segments):
            before, until = F.floor(longer * i / segments).cast("int"), F.floor(longer * (i + 1) / segments).cast("int")
            shared = [F.substring("word", F.lit(1), before), F.right(F.col("word"), longer - until)]
            out.append(F.struct(F.xxhash64(longer, F.lit(i), *shared).alias("block"), longer.alias("longer"), F.lit(i).alias("segment")))
    return F.array(*out)


class Matrix:
    """Words as rows of code points, aligned left and right; zero is padding."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.width = int(self.length.max(initial=0))
        kind = np.uint8 if points.max(initial=0) < 256 else np.uint32
        self.left, self.right = (np.zeros((len(words), self.width), kind) for _ in range(2))
        row = np.repeat(np.arange(len(words)), self.length)
        at = np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.left[row, at] = points
        self.right[row, np.repeat(self.length, self.length) - 1 - at] = points

    def near(self, a: np.ndarray, b: np.ndarray, longer: np.ndarray, segment: np.ndarray, segments: int) -> np.ndarray:
        """Which of the row pairs are one edit apart and belong to this longer length and segment, so each pair counts once."""
        short, long = np.minimum(self.length[a], self.length[b]), np.maximum(self.length[a], self.length[b])
        prefix, suffix = (np.minimum(_leading(m[a] == m[b]), short) for m in (self.left, self.right))
        near = (long == longer) & (long - short <= 1) & (prefix + suffix >= long - 1) & (prefix < long)
        # the last segment that begins inside the common prefix
        place = np.zeros(len(a), np.int64)
        for i in range(1, segments):
            place += long * i // segments <= prefix
        return near & (place == segment)


def _leading(equal: np.ndarray) -> np.ndarray:
    """Number of leading columns that are True."""
    return np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1)) if equal.shape[1] else np.zeros(len(equal), np.int64)


def _found(words: pa.Array, n: pa.Array, a: list, b: list) -> pa.RecordBatch:
    a, b = (pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (a, b))
    return pa.RecordBatch.from_arrays([words.take(a), words.take(b), n.take(a), n.take(b)], names=["word", "near", "n", "near_n"])


def _compare_sorted(segments: int):
    """Rows sorted by block: each row with the following ones of its block, all blocks of a batch at once."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        block = table.column("block").to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
        end = np.repeat(edge[1:], np.diff(edge))
        words, n = (table.column(x).combine_chunks() for x in ("word", "n"))
        matrix, longer, segment = Matrix(words.to_pylist()), table.column("longer").to_numpy(), table.column("segment").to_numpy()
        at, step, a, b = np.arange(len(block)), 1, [], []
        while len(at := at[at + step < end[at]]):
            near = at[matrix.near(at, at + step, longer[at], segment[at], segments)]
            a.append(near)
            b.append(near + step)
            step += 1
        return _found(words, n, a, b)

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            block = table.column("block").to_numpy()
            cut = int(np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))[-1])  # the last block may go on
            if cut:
                yield compared(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None:
            yield compared(rest)

    return run


def _compare_tiles(segments: int):
    """One pair of tiles, or a tile with itself."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        words, n = (table.column(x).combine_chunks() for x in ("word", "n"))
        tile, longer, segment = (table.column(x).to_numpy() for x in ("tile", "longer", "segment"))
        matrix, a, b = Matrix(words.to_pylist()), [], []
        first, second = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        rows = max(1, PAIRS_AT_ONCE // max(len(second), 1))
        for start in range(0, len(first), rows):
            i, j = (x.reshape(-1) for x in np.meshgrid(first[start:start + rows], second, indexing="ij"))
            if low == high:
                i, j = i[i < j], j[i < j]
            near = matrix.near(i, j, longer[i], segment[i], segments)
            a.append(i[near])
            b.append(j[near])
        return pa.Table.from_batches([_found(words, n, a, b)])

    return run


def near_words(words: DataFrame, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(word, near, n, near_n): each pair of words one edit apart once, in either order. ``words``: (word, n), no repeats."""
    result = "word string, near string, n long, near_n long"
    rows = words.select("word", F.col("n").cast("long").alias("n"), F.explode(_blocks(segments)).alias("b")).select("b.*", "word", "n")
    large = cut_lineage(rows.groupBy("block").agg(F.count("*").alias("members")).filter(F.col("members") > tile), "large-blocks")
    known = bounded_broadcast(large)
    small = rows.join(known, "block", "left_anti").repartition("block").sortWithinPartitions("block")
    out = small.mapInArrow(_compare_sorted(segments), result)
    tiles = F.ceil(F.col("members") / tile)
    mine = rows.join(known, "block").withColumn("tile", F.pmod(F.xxhash64("word"), tiles))
    met = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    met = met.select("block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "longer", "segment", "word", "n")
    return out.unionByName(met.groupBy("block", "low", "high").applyInArrow(_compare_tiles(segments), result))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the way from word to form, by doubling. ``forms``: (word, form), acyclic."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = now.join(bounded_broadcast(ahead), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        stepped = cut_lineage(stepped, "roots")
        now = stepped.select("word", "root")
        if not stepped.filter("moved").limit(1).count():
            return now


def spelling_variants(words: DataFrame, ratio: int = 10, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    ``words``: (word, n); rows with a null word or count and empty words are left out, repeated words are summed. A word's form is the near word of largest
    n (ties: smallest in code-point order), if that n is at least ``ratio`` times its own, else null. The root is where following forms ends,
    the word itself if it has none. ``ratio`` must exceed 1, so that ways end. Other columns are ignored.
    """
    if ratio <= 1:
        raise ValueError("ratio must exceed 1")
    counted = words.filter("word is not null and n is not null and word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    counted = cut_lineage(counted, "words")
    pairs = near_words(counted, segments, tile)
    ways = F.array(F.struct("word", F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form")).alias("best")),
                   F.struct(F.col("near").alias("word"), F.struct((-F.col("n")).alias("rank"), F.col("word").alias("form")).alias("best")))
    best = pairs.select(F.explode(ways).alias("w")).select("w.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    joined = counted.join(bounded_broadcast(cut_lineage(best, "near")), "word", "left").withColumn("form_n", -F.col("best.rank"))
    has = F.col("form_n") >= ratio * F.col("n")
    named = cut_lineage(joined.select("word", F.when(has, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                      F.when(has, F.col("form_n")).alias("form_n")), "forms")
    ends = roots(named.filter("form is not null"))
    return named.join(bounded_broadcast(ends), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
