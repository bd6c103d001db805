"""SimHash near-dedup: fingerprints of word shingles, linked at few differing bits.

Distinct fingerprints are dealt by the bits in which a link must agree: of ``radius + 2`` blocks of bits at least two are
equal, so every pair of blocks is a key. Inside a key, tiles are compared exactly with exclusive-or and bit counts.
A key with more fingerprints than a tile is cut by population count and hash; tile pairs whose counts differ by more than
the radius are not formed. Tasks return trees of links, which alternating stars join into components.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.session import cut_lineage

TILE = 2048
HASHES_AT_ONCE = 1 << 17


def _shingle_hashes(text: bytes, size: int, seed: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, seed)]
    ends = list(accumulate(len(w) + 1 for w in words))
    return [xxhash.xxh64_intdigest(line[a:b - 1], seed) for a, b in zip([0, *ends], ends[size - 1:])]


def _majority(hashes: list[int], counts: list[int]) -> np.ndarray:
    """One fingerprint per document from the hashes of all, in order."""
    out = np.zeros(len(counts), np.uint64)
    sizes = np.array(counts, np.int64)
    some = sizes > 0
    if some.any():
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > sizes[some, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def _fingerprint(size: int, seed: int):
    def run(batches):
        for batch in batches:
            ids, hashes, counts, first = batch.column(0), [], [], 0
            for i, text in enumerate(batch.column(1)):
                mine = _shingle_hashes(text.as_py() or b"", size, seed)
                hashes += mine
                counts.append(len(mine))
                if len(hashes) >= HASHES_AT_ONCE or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([ids.slice(first, i + 1 - first), pa.array(_majority(hashes, counts).view(np.int64))], names=["doc_id", "fp"])
                    hashes, counts, first = [], [], i + 1

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): bit i is 1 if more than half of the XXH64 hashes of the lower-cased word shingles have it.

    Fewer words than a shingle: the whole sequence. No word or a null text: 0.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprint(shingle, seed), "doc_id long, fp long")


def _keys(radius: int) -> F.Column:
    """The keys of a fingerprint: for each pair of blocks the number of the pair and the bits of both."""
    width = 64 // (radius + 2)
    blocks = [F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << (width if i < radius + 1 else 64 - i * width)) - 1)) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(n).alias("pair"), a.alias("a"), b.alias("b")) for n, (a, b) in enumerate(combinations(blocks, 2))])


def components_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of ``n`` nodes."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        label = label[label]
        if (before == label).all() and (label[a] == label[b]).all():
            break
    return label


def _tree(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    root = components_of(len(fp), a, b)
    mine = np.flatnonzero(root != np.arange(len(fp)))
    return pa.RecordBatch.from_arrays([pa.array(fp[mine]), pa.array(fp[root[mine]])], names=["a", "b"])


def _pairs_of_runs(fp: np.ndarray, end: np.ndarray, radius: int):
    """Index pairs within ``radius`` inside runs; ``end`` is where the run of each entry ends."""
    bits, left, right = fp.view(np.uint64), [], []
    at, step = np.arange(len(fp)), 1
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(bits[at] ^ bits[at + step]) <= radius]
        left.append(near)
        right.append(near + step)
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _compare_sorted(radius: int):
    """Partitions sorted by key: links inside each key. A run that goes on in the next batch is kept for it."""

    def run(batches):
        rest = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.concatenate((rest, np.column_stack([batch.column(i).to_numpy() for i in range(4)])))
            if len(rows):
                last = (rows[:, 1:] == rows[-1, 1:]).all(axis=1)
                rest = rows[last]
                yield _links(rows[~last], radius)
        yield _links(rest, radius)

    return run


def _links(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    """``rows``: fingerprint and the three parts of the key, sorted by key."""
    fp, key = np.ascontiguousarray(rows[:, 0]), rows[:, 1:]
    if len(fp) < 2:
        return _tree(fp[:0], np.zeros(0, np.int64), np.zeros(0, np.int64))
    edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1), [True])))
    return _tree(fp, *_pairs_of_runs(fp, np.repeat(edge[1:], np.diff(edge)), radius))


def _compare_tiles(radius: int):
    """One pair of tiles: all members against all."""

    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy()
        bits, left, right = fp.view(np.uint64), [], []
        for i in range(0, len(fp), 256):
            a, b = np.nonzero(np.bitwise_count(bits[i:i + 256, None] ^ bits[None, i:]) <= radius)
            left.append(a + i)
            right.append(b + i)
        return pa.Table.from_batches([_tree(fp, np.concatenate(left), np.concatenate(right))])

    return run


def links(distinct: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(a, b): trees of links whose components are those of all pairs within ``radius`` bits. ``distinct``: column fp, no repeats."""
    keyed = distinct.select("fp", F.explode(_keys(radius)).alias("k")).select("fp", "k.pair", "k.a", "k.b")
    key = ["pair", "a", "b"]
    sizes = keyed.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    sized = keyed.join(sizes, key)
    small = sized.filter(F.col("n") <= tile).select("fp", *[F.col(k).cast("long") for k in key])
    near = small.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compare_sorted(radius), "a long, b long")
    ones = F.bit_count("fp")
    large = sized.filter(F.col("n") > tile).withColumn("ones", ones)
    counts = large.groupBy(*key, "ones").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    mine = large.join(counts, [*key, "ones"]).withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles"))
    other = counts.select(*key, F.col("ones").alias("ones2"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile2"))
    met = mine.join(other, key).filter(F.abs(F.col("ones") - F.col("ones2")) <= radius)
    one, two = F.struct("ones", "tile"), F.struct(F.col("ones2").alias("ones"), F.col("tile2").alias("tile"))
    tiles = met.select("fp", *key, F.least(one, two).alias("low"), F.greatest(one, two).alias("high"))
    far = tiles.groupBy(*key, "low", "high").applyInArrow(_compare_tiles(radius), "a long, b long")
    return near.unionByName(far).filter("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node of its component, for every node of ``edges`` (a, b).

    Large and small stars in turn, each written to the shared folder, until nothing changes.
    """
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "stars")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("least"))
        large = both.join(least, "v").filter("m > v").select(F.col("m").alias("v"), F.col("least").alias("m")).distinct()
        low = large.groupBy("v").agg(F.min("m").alias("least"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct(F.col("v"), F.col("least").alias("m")),
                                                              F.struct(F.col("m").alias("v"), F.col("least").alias("m")))).alias("e"))
        edges = cut_lineage(small.select("e.v", "e.m").filter("v <> m").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(
                edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct())
        state = now


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, tile: int = TILE,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fp and component_id, the smallest doc_id that links reach.

    Fingerprints link at ``radius`` or fewer differing bits, zero like any other; equal fingerprints are one node, however
    many documents share it. A null id is larger than any (component null if nothing else is reached). Repeated rows
    stay. Other columns are ignored.
    """
    marked = cut_lineage(fingerprints(docs, shingle, seed, doc_id, text), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected(links(distinct.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is that of their component; rows with a null id stay only if no id is reached."""
    chosen = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(chosen.withColumnRenamed("doc_id", "__kept"), F.col(doc_id).eqNullSafe(F.col("__kept")), "left_semi")
