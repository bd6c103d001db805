"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

One hash per shingle serves all bins: a document's set is dealt into ``bands * rows`` bins and each keeps its least hash.
An empty bin borrows from the first filled one in an order of its own, the same for all documents, so that any two bins of two
documents agree with the probability of their similarity. The bins of a band form the key of a bucket. Inside a bucket
every member is a candidate of one member only, the centre, so a bucket of m members gives m - 1 edges. The edges join
documents to clusters, and each link lies inside one: the chance that two documents at similarity s share no bucket is
(1 - s ** rows) ** bands, 1.3e-10 at 0.85 for 6 rows and 48 bands. Full sets are then compared inside clusters, in tiles of bounded
size, by products of membership tables over the shingles that two members share; only trees of links leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm import textbytes as B
from flowloom.llm.simhash import components_of, connected
from flowloom.operators.joining import bounded_broadcast
from flowloom.session import cut_lineage

BANDS, ROWS = 48, 6
TILE_DOCUMENTS = 512
TILE_SHINGLES = 250_000
VOCABULARY_AT_ONCE = 4096
SALTS = 8


def shingle_sets(texts, size: int):
    """Per batch of texts: (owner, hash) of each distinct shingle, sorted, and the number of texts."""
    for _, _, parts in B.batches(texts):
        data, offsets = B.joined(parts)
        data = B.LOWER[data]
        start, end = B.word_edges(data)
        words, owner = B.stretch_hash(B.prefix_hash(data), start, end), np.searchsorted(offsets, start, "right") - 1
        count = np.bincount(owner, minlength=len(parts))
        who, hashes = [], []
        for width in range(1, size + 1):
            found = B.window_hash(words, width)
            first = owner[:len(found)]
            inside = first == owner[width - 1:] if len(found) else np.zeros(0, bool)
            inside &= (count[first] >= size) if width == size else (count[first] == width)
            who.append(first[inside])
            hashes.append(found[inside])
        who, hashes = np.concatenate(who), np.concatenate(hashes)
        order = np.lexsort((hashes, who))
        who, hashes = who[order], hashes[order]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (hashes[1:] != hashes[:-1])
        yield who[new], hashes[new], len(parts)


def probing_order(bins: int) -> np.ndarray:
    """For each bin the order in which it asks the others for a value."""
    at = np.arange(bins * bins, dtype=np.uint64) + np.uint64(0x51ED2701)
    return np.argsort(B.mix(at).reshape(bins, bins), axis=1, kind="stable")


def one_permutation(who: np.ndarray, hashes: np.ndarray, n: int, order: np.ndarray) -> np.ndarray:
    """(n, bins): least hash of each bin, empty ones filled by the probing order. Texts without a shingle keep zeros."""
    bins = len(order)
    sketch, filled = np.zeros((n, bins), np.uint64), np.zeros((n, bins), bool)
    at = (hashes % np.uint64(bins)).astype(np.int64)
    sketch[who[::-1], at[::-1]] = hashes[::-1]  # hashes rise, so the last one written is the least
    filled[who, at] = True
    left = np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1))
    values, known, empty = sketch[left], filled[left], ~filled[left]
    for asked in order.T:
        took = empty & known[:, asked]
        sketch[left] = np.where(took, values[:, asked], sketch[left])
        empty &= ~took
        more = empty.any(axis=1)
        if not more.all():
            left, values, known, empty = left[more], values[more], known[more], empty[more]
        if not len(left):
            break
    return sketch


def _digests(who: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit sums of each set, which tell sets apart."""
    sizes = np.bincount(who, minlength=n)
    sums = []
    for seed in (0x2545F4914F6CDD1D, 0x9E6C63D0676A9A99):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(B.mix(hashes ^ np.uint64(seed)), dtype=np.uint64)))
        ends = np.cumsum(sizes)
        sums.append((total[ends] - total[ends - sizes]).view(np.int64))
    return sizes, sums[0], sums[1]


def _sketch(size: int, bands: int, rows: int):
    def run(batches):
        order = probing_order(bands * rows)
        weight = B.mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            at = 0
            for who, hashes, n in shingle_sets((x.as_py() for x in batch.column(2)), size):
                sizes, one, two = _digests(who, hashes, n)
                keys = B.mix((one_permutation(who, hashes, n, order) * weight).reshape(n, bands, rows).sum(axis=2, dtype=np.uint64)).view(np.int64)
                some = np.where(sizes > 0, bands, 0)
                offsets = np.concatenate(([0], np.cumsum(some))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(sizes), pa.array(one), pa.array(two), lists],
                                                 names=["doc_id", "row", "n", "one", "two", "buckets"])
                at += n

    return run


def sketches(docs: DataFrame, shingle: int = 3, bands: int = BANDS, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n, one, two, buckets) per row of ``docs``: a hash of the row, size and digests of its set, keys of its buckets."""
    return _rows(docs, doc_id, text).mapInArrow(_sketch(shingle, bands, rows), "doc_id long, row long, n long, one long, two long, buckets array<long>")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(doc_id).cast("long"), F.col(text)).alias("row"), F.col(text).cast("binary").alias("text"))


def _sets(size: int):
    def run(batches):
        for batch in batches:
            for who, hashes, n in shingle_sets((x.as_py() for x in batch.column(2)), size):
                sizes, one, two = _digests(who, hashes, n)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array([hashes[a:b].tobytes() for a, b in zip(ends - sizes, ends)], pa.binary())], names=["one", "two", "shingles"])

    return run


def star_edges(members: DataFrame) -> DataFrame:
    """(a, b) without repeats: each member of a bucket with the bucket's least one. ``members``: (bucket, node)."""
    centres = cut_lineage(members.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last").select("bucket", "b"), "centres")
    return members.join(bounded_broadcast(centres), "bucket").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def _compare(percent: int):
    """One tile, or two: trees of the links between its members."""

    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
        sizes = np.array([len(x) for x in sets], np.int64)
        _, order, first, counts = B.unique_sorted(np.concatenate(sets))
        shared = counts > 1
        who = np.repeat(np.arange(len(sets)), sizes)[order][np.repeat(shared, counts)]
        number = np.repeat(np.arange(shared.sum()), counts[shared])
        common = np.zeros((len(sets), len(sets)), np.float32)
        for low in range(0, int(shared.sum()), VOCABULARY_AT_ONCE):
            a, b = np.searchsorted(number, (low, low + VOCABULARY_AT_ONCE))
            held = np.zeros((len(sets), VOCABULARY_AT_ONCE), np.float32)
            held[who[a:b], number[a:b] - low] = 1
            common += held @ held.T
        i, j = np.nonzero(np.triu((100 + percent) * common.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :]), 1))
        root = components_of(len(sets), i, j)
        mine = np.flatnonzero(root != np.arange(len(sets)))
        return pa.table({"a": pa.array(nodes[mine], pa.int64()), "b": pa.array(nodes[root[mine]], pa.int64())})

    return run


def tiled(members: DataFrame, percent: int, documents: int = TILE_DOCUMENTS, shingles: int = TILE_SHINGLES) -> DataFrame:
    """(node, cluster, low, high): the tiles in which each member is compared. ``members``: (node, cluster, n).

    A cluster that fits into one tile is one. A larger one is cut by size class and hash; two tiles meet only if their classes
    are the same or neighbours, since linked sets differ in size by less than a class.
    """
    small = (F.col("members") <= documents) & (F.col("total") <= shingles)
    sizes = members.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("n").alias("total")).filter("members > 1")
    sized = members.join(sizes, "cluster")
    whole = sized.filter(small).select("node", "cluster", F.lit("").alias("low"), F.lit("").alias("high"))
    width = math.log(100 / percent) * 1.001
    large = sized.filter(~small).select("node", "cluster", F.floor(F.log(F.col("n").cast("double")) / width).alias("class"), "n")
    needed = F.ceil(F.greatest(F.count("*") / documents, F.sum("n") / shingles))
    cut = large.groupBy("cluster", "class").agg(needed.alias("tiles"))
    name = F.format_string("%06d-%09d", "class", "tile")
    mine = large.join(cut, ["cluster", "class"]).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles")).select("node", "cluster", "class", name.alias("own"))
    every = cut.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select("cluster", F.col("class").alias("near"), name.alias("other"))
    reached = mine.withColumn("near", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
    pairs = reached.join(every, ["cluster", "near"]).select("node", "cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return whole.unionByName(pairs)


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, bands: int = BANDS, rows: int = ROWS, documents: int = TILE_DOCUMENTS,
                    shingles: int = TILE_SHINGLES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id that links reach.

    Two documents are linked if ``100 * common >= percent * together`` for their sets of ``shingle``-word shingles (A-Z lower-cased;
    fewer words: the whole sequence). Equal sets are one node, however many documents have them. Null texts and texts without
    words have an empty set and are linked with nothing. A null id is larger than any (component null if nothing else is
    reached). Repeated rows stay. Other columns are ignored. Shingles are compared as 64-bit hashes, equal sets as
    128-bit digests with their size.
    """
    marked = cut_lineage(sketches(docs, shingle, bands, rows, doc_id, text), "sketches")
    same = ["n", "one", "two"]
    distinct = marked.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.count("*").alias("copies"))
    nodes = cut_lineage(distinct.withColumn("node", F.monotonically_increasing_id()), "sets")
    chosen = marked.select("row", *same, "buckets").join(bounded_broadcast(nodes.select("node", "row", *same)), ["row", *same]).select("node", F.explode("buckets").alias("bucket")).distinct()
    clusters = connected(star_edges(cut_lineage(chosen, "buckets"))).withColumnRenamed("root", "cluster")
    members = cut_lineage(clusters.join(nodes, "node"), "members")
    whole = _rows(docs, doc_id, text).join(bounded_broadcast(members.select("row").distinct()), "row", "left_semi")
    sets = whole.mapInArrow(_sets(shingle), "one long, two long, shingles binary").join(bounded_broadcast(members.select("one", "two", "node")), ["one", "two"])
    sets = cut_lineage(sets.select("node", "shingles").dropDuplicates(["node"]), "shingles")
    met = tiled(members.select("node", "cluster", "n"), percent, documents, shingles).join(sets, "node")
    trees = met.groupBy("cluster", "low", "high").applyInArrow(_compare(percent), "a long, b long").distinct()
    rooted = nodes.join(connected(trees), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut_lineage(rooted, "rooted")
    named = rooted.join(bounded_broadcast(rooted.groupBy("root").agg(F.min("least").alias("component_id"))), "root")
    # a set that is neither shared nor linked has its own id, so only the others are looked up, hot ones from several places
    known = named.filter("copies > 1 or not (component_id <=> least)").select(*same, "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("known"))
    salted = marked.drop("buckets").withColumn("salt", F.pmod(F.xxhash64("doc_id", "row"), F.lit(SALTS)).cast("int"))
    out = salted.join(bounded_broadcast(cut_lineage(known, "components")), [*same, "salt"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
