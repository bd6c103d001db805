"""Benchmark decontamination with the q-gram lemma.

Benchmark items are cut into overlapping segments. A text within ``e`` edits of a segment of ``m`` characters shares at least
``m - q + 1 - q * e`` of its q-grams, and their diagonals (place in the text less place in the segment) differ by at most
``e``. Hits are counted in overlapping diagonal bands; bands that reach the bound are verified by a
banded alignment of the segment with the text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.textbytes import covered

Q = 8
SEGMENT = 80
EDIT_RATE = 0.08
BLOCK_BYTES = 8 << 20
BATCH_CHARS = 1 << 19
RESULT = "doc_id long, item_id long, segment int, start int, end int, edits int"

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def normal(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with A-Z lowered and each run of white space one space, and where each stood."""
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes[space] = 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    at = np.flatnonzero(keep)
    return codes[at], at


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int, powers: tuple) -> np.ndarray:
    """A hash per q-gram; its leading bits are the good ones."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(0x1F35)) * np.uint64(0xBF58476D1CE4E5B9) * powers[0][:len(codes)], out=prefix[1:])
    return (prefix[q:] - prefix[:-q]) * powers[1][:len(codes) - q + 1]


class Index:
    """Segments of a block of items and their q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int, segment: int, edit_rate: float):
        self.q = q
        powers = _powers(max([len(t) for _, t in items] + [1]) + 1)
        texts, grams, place, size, edits, owner, begin, ids = [], [], [], [], [], [], [], []
        base = 0
        for item, text in items:
            codes, _ = normal(_codes(text.strip()))
            m = min(len(codes), segment)
            if m < q:
                continue
            e = min(math.floor(edit_rate * m), (m - q) // q)
            # at most as far apart as a segment may have edits, so a passage of m characters comes within them of one
            starts = np.unique(np.append(np.arange(0, len(codes) - m + 1, max(1, e)), len(codes) - m))
            found = _grams(codes, q, powers)
            texts.append(codes)
            grams.append(found)
            place.append(base + np.arange(len(found)))
            owner.append(np.full(len(starts), len(size)))
            begin.append(base + starts)
            size.append(m)
            edits.append(e)
            ids.append(item)
            base += len(codes)
        none = np.zeros(0, np.int64)
        self.text = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.base = np.cumsum(lengths) - lengths
        self.size, self.step = np.array(size, np.int64), np.maximum(np.array(edits, np.int64), 1)
        self.need = self.size - q + 1 - q * np.array(edits, np.int64)
        # segments in the order of their places
        own = np.concatenate(owner) if owner else none
        self.begin = np.concatenate(begin) if begin else none
        self.length, self.edits = self.size[own], np.array(edits, np.int64)[own]
        self.items = pa.array(ids, pa.int64()).take(pa.array(own, pa.int64()))
        self.offset = self.begin - self.base[own]  # place of a segment in its item
        self.first_segment = np.searchsorted(own, np.arange(len(size) + 1))
        self.longest = int((self.length + self.edits).max(initial=0))
        self.gap = int(self.edits.max(initial=0)) + 1
        grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.place = np.concatenate(place)[order] if len(grams) else none
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.bits = max(16, min(24, int(len(grams)).bit_length() + 4))
        self.map = np.zeros(1 << self.bits, bool)
        self.map[self.grams >> np.uint64(64 - self.bits)] = True

    @property
    def codes(self) -> list[np.ndarray]:
        return [self.text[b:b + m] for b, m in zip(self.begin, self.length)]

    def candidates(self, codes: np.ndarray, powers: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(segment, diagonal) with enough shared q-grams; a band starts at the diagonal and is two steps wide."""
        none = np.zeros(0, np.int64)
        hashes = _grams(codes, self.q, powers)
        hits = self.map[hashes >> np.uint64(64 - self.bits)]
        if not len(self.grams) or not hits.any():
            return none, none
        # a stretch of text that can hold a segment has as many hits as the weakest bound asks for
        before = np.concatenate(([0], np.cumsum(hits)))
        ends = np.minimum(np.arange(len(hits)) + self.longest, len(hits))
        dense = np.flatnonzero(before[ends] - before[:-1] >= self.need.min())
        at = np.flatnonzero(hits & covered(dense, self.longest, len(hits)))
        place = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        real = self.grams[place] == hashes[at]
        at, place = at[real], place[real]
        if not len(at):
            return none, none
        times = self.count[place]
        ends = np.cumsum(times)
        hit = np.repeat(self.first[place] - ends + times, times) + np.arange(ends[-1])
        where = self.place[hit]  # in the text of all items
        item = np.searchsorted(self.base, where, "right") - 1
        band = (np.repeat(at, times) - (where - self.base[item])) // self.step[item]
        # a band holds its own step and the next one, so each hit stands in two
        item, where, band = np.tile(item, 2), np.tile(where, 2), np.concatenate((band, band - 1))
        order = np.lexsort((where, band, item))
        item, where, band = item[order], where[order], band[order]
        # as many hits as needed, from one on, no further apart than a segment's first and last q-gram
        last = np.arange(len(where)) + self.need[item] - 1
        inside = np.minimum(last, len(where) - 1)
        room = self.size[item] - self.q
        good = np.flatnonzero((last < len(where)) & (item[inside] == item) & (band[inside] == band) & (where[inside] - where <= room))
        # segments that begin at the first of them or before and reach the last
        low = np.maximum(np.searchsorted(self.begin, where[inside][good] - room[good]), self.first_segment[item[good]])
        high = np.minimum(np.searchsorted(self.begin, where[good], "right"), self.first_segment[item[good] + 1])
        n = np.maximum(high - low, 0)
        segment = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, band = np.repeat(item[good], n), np.repeat(band[good], n)
        found = np.unique(np.stack((segment, band * self.step[item] + self.begin[segment] - self.base[item])), axis=1) if len(segment) else np.zeros((2, 0), np.int64)
        return found[0], found[1]

    def aligned(self, codes: np.ndarray, segment: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edits, start, end) of the best alignment of each segment whose path stays in its band, widened by the edits."""
        n = len(segment)
        edits, start, end = np.full(n, 1 << 20), np.zeros(n, np.int64), np.zeros(n, np.int64)
        sizes = self.length[segment]
        for m in np.unique(sizes):
            for e in np.unique(self.edits[segment[sizes == m]]):
                mine = np.flatnonzero((sizes == m) & (self.edits[segment] == e))
                for part in np.array_split(mine, max(1, len(mine) // 4096)):
                    edits[part], start[part], end[part] = self._align(codes, segment[part], diagonal[part], int(m), int(e))
        return edits, start, end

    def _align(self, codes: np.ndarray, segment: np.ndarray, first: np.ndarray, m: int, e: int):
        width = 2 * max(e, 1) + 2 * e + 1
        left = first - e
        wanted = self.text[self.begin[segment][:, None] + np.arange(m)[None, :]]
        # cost[k]: row i of the segment against text place left + i + k; a path may begin anywhere in the band
        cost = np.zeros((len(segment), width), np.int64)
        origin = left[:, None] + np.arange(width)[None, :]
        far = 1 << 20
        for i in range(m):
            at = left[:, None] + i + np.arange(width)[None, :]
            inside = (at >= 0) & (at < len(codes))
            same = np.where(inside, codes[np.clip(at, 0, len(codes) - 1)], np.uint32(0xFFFFFFFF)) == wanted[:, i:i + 1]
            straight = np.where(inside, cost + ~same, far)
            down = np.full_like(cost, far)
            down[:, :-1] = cost[:, 1:] + 1
            best = np.minimum(straight, down)
            come = origin.copy()
            take = down < straight
            come[:, :-1] = np.where(take[:, :-1], origin[:, 1:], origin[:, :-1])
            ramp = np.arange(width)[None, :]
            slid = np.minimum.accumulate((best - ramp) * 64 + 0, axis=1) // 64 + ramp
            source = np.maximum.accumulate(np.where(best <= slid, ramp, 0), axis=1)
            cost, origin = slid, np.take_along_axis(come, source, axis=1)
        best = cost.argmin(axis=1)
        row = np.arange(len(segment))
        return cost[row, best], origin[row, best], left + m + best


def _find(index: Index):
    def run(batches):
        powers = _powers(BATCH_CHARS + 1)
        for batch in batches:
            texts, first, size = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                size += len(texts[-1]) + index.gap
                if size >= BATCH_CHARS or i + 1 == batch.num_rows:
                    if size >= len(powers[0]):
                        powers = _powers(size + 1)
                    yield _found(index, batch.column(0).slice(first, len(texts)), texts, powers)
                    texts, first, size = [], i + 1, 0

    return run


def _found(index: Index, ids: pa.Array, texts: list[str], powers: tuple) -> pa.RecordBatch:
    # more characters between two texts than any segment may have edits, so no match lies across them
    raw = _codes("".join(t + "\0" * index.gap for t in texts))
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + index.gap) - sizes - index.gap
    codes, at = normal(raw)
    segment, diagonal = index.candidates(codes, powers)
    edits, start, end = index.aligned(codes, segment, diagonal)
    good = edits <= index.edits[segment]
    segment, edits, start, end = segment[good], edits[good], start[good], end[good]
    start, last = at[np.clip(start, 0, len(at) - 1)], at[np.clip(end - 1, 0, len(at) - 1)]
    # edits at either end may reach into the gap; the middle stands in the text
    owner = np.searchsorted(starts, (start + last) // 2, "right") - 1
    start, last = np.maximum(start - starts[owner], 0), np.minimum(last - starts[owner], sizes[owner] - 1)
    # the best place of each segment in each text
    order = np.lexsort((start, edits, segment, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (segment[order][1:] != segment[order][:-1])
    best = order[new]
    numbers = [index.offset[segment[best]], start[best], last[best] + 1, edits[best]]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(owner[best], pa.int64())), index.items.take(pa.array(segment[best], pa.int64())), *[pa.array(x.astype(np.int32)) for x in numbers]],
                                      names=["doc_id", "item_id", "segment", "start", "end", "edits"])


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, segment: int = SEGMENT, edit_rate: float = EDIT_RATE, doc_id: str = "doc_id",
          text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, segment, start, end, edits): segments of benchmark items found in documents, the best place of each.

    A segment is named by its place in the item (letters lower-cased, white space joined), so its name does not depend on the other items. Places
    are code points of the document's own text. Letters A-Z and runs of white space count as equal to their lower case and to
    one space. Segments begin at most as many characters apart as they may have edits, so an exact part of an item as long as a segment is
    found wherever it begins. Items shorter than a segment are searched whole, items of fewer than ``q`` characters and null ones not at
    all. Null and empty documents hold nothing. A null id, of a document or of an item, stays null; equal items count once. The benchmark is passed to the tasks in blocks of at most ``block_bytes``
    bytes, each in its own pass, so nothing unbounded is broadcast. Other columns are ignored.
    """
    if segment < q:
        raise ValueError("a segment has q characters or more")
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).dropna(subset=["text"]).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(2 * total / block_bytes)) if total > block_bytes else 1
    found = None
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        part = plain.mapInArrow(_find(Index([(r.item_id, r.text) for r in mine], q, segment, edit_rate)), RESULT)
        found = part if found is None else found.unionByName(part)
    return found
