"""Byte-level BPE by monoid tree reduction.

A text is cut by a pattern; each piece is encoded on its own. A long piece is encoded in halves, recursively, and
neighbours are joined by encoding a growing window around the boundary again. The join is final when the tokens at both edges of the window
and the next ones outside are such that encoding them as a pair gives the pair: a sequence whose
neighbouring pairs all have this property is the encoding of its bytes. Decoding concatenates up the tree.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF = 48
SHORT = 24
NO_RANK = 1 << 40
SPELT_AT_ONCE = 1 << 17
CACHED_PIECES = 300_000
BATCH_CHARS = 1 << 21


class Tokenizer:
    """Encoder and decoder of one file of ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}  # encodings of recent pieces as 32-bit numbers
        sizes = np.zeros(max(self.tokens) + 1, np.int64)
        sizes[list(self.tokens)] = [len(x) for x in self.tokens.values()]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.spelt = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(len(sizes))), np.uint8)
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Merge the neighbours of least rank, leftmost first, until none is a token."""
        if len(piece) > SHORT:
            return self.merged_by_heap(piece)
        get = self.ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        costs = [get(piece[i:i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while costs:
            least = min(costs)
            if least == NO_RANK:
                break
            i = costs.index(least)
            parts[i] += parts.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = get(parts[i] + parts[i + 1], NO_RANK)
            if i:
                costs[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
        return [self.ranks[x] for x in parts]

    def merged_by_heap(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = after[:]  # end of the part that starts here; 0: gone
        heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not end[i] or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                rank = ranks.get(piece[i:end[after[j]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[after[j]]))
            if before[i] >= 0:
                rank = ranks.get(piece[before[i]:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, before[i], stop))
        return [ranks[piece[i:end[i]]] for i in range(n) if end[i]]

    def stable(self, a: int, b: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= CACHED_PIECES:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return found

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of both, each an encoding itself."""
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merged(self.decode(left[len(left) - i:] + right[:j]))
            good_left = i == len(left) or self.stable(left[-i - 1], window[0])
            good_right = j == len(right) or self.stable(window[-1], right[j])
            if good_left and good_right:
                return left[:len(left) - i] + window + right[j:]
            i, j = i if good_left else 2 * i, j if good_right else 2 * j

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.merged(piece)
        middle = len(piece) // 2
        return self.joined(self.tree(piece[:middle]), self.tree(piece[middle:]))

    def piece(self, text: str) -> bytes:
        raw = text.encode("utf-8")
        rank = self.ranks.get(raw)
        found = np.array((rank,) if rank is not None else self.tree(raw), np.int32).tobytes()
        if len(raw) <= LEAF:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            self.known[text] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        known, piece = self.known.get, self.piece
        return np.frombuffer(b"".join([known(x) or piece(x) for x in self.pieces(text)]), np.int32)

    def spell(self, ids: np.ndarray) -> bytes:
        """Bytes of many ids; halves are spelt on their own and concatenated."""
        if len(ids) > SPELT_AT_ONCE:
            middle = len(ids) // 2
            return self.spell(ids[:middle]) + self.spell(ids[middle:])
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.spelt[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)].tobytes()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(path, pattern)


def _columns(ids: list, encoded: list, decoded: list) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in encoded]))).astype(np.int32)
    values = np.concatenate(encoded) if encoded else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())),
                                       pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])


def _run(path: str, pattern: str):
    def run(batches):
        own = tokenizer(path, pattern)
        for batch in batches:
            ids, encoded, decoded, chars = [], [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                tokens = own.encode(text)
                ids.append(doc_id)
                encoded.append(tokens)
                decoded.append(own.spell(tokens))
                chars += len(text)
                if chars >= BATCH_CHARS:
                    yield _columns(ids, encoded, decoded)
                    ids, encoded, decoded, chars = [], [], [], 0
            if ids:
                yield _columns(ids, encoded, decoded)

    return run


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, the token ids of the whole text, and the bytes these ids decode to.

    ``ranks_path`` names a file of ranks on every executor, ``pattern`` the expression whose matches are encoded each on its own.
    Special tokens are ordinary text. Null and empty texts have no ids and decode to no bytes. Repeated rows and null ids
    stay. Other columns are ignored.
    """
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_run(ranks_path, pattern), RESULT)
