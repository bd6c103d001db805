"""Look up what a whole corpus knows about the keys of each chunk of documents.

A chunk is a hash group of documents of bounded size. Its keys (64-bit hashes) are made
unique and sorted inside the task, cut into buckets by their leading bits, and sent
to the bucket's task as one packed row per chunk and bucket. The bucket combines equal
keys and answers every chunk in the order it asked. However often a key occurs, it costs its bucket one
entry per chunk, so a passage found in a third of the corpus is no hot key. Both numbers, chunks
and buckets, follow from the size of the input.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
PACKED = "bucket int, chunk int, n long, keys binary, data binary"
ANSWER = "chunk int, bucket int, n long, data binary"


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; an empty table has none."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text)).cast("long")), F.lit(0)).alias("n")).first()["n"]


def in_chunks(docs: DataFrame, doc_id: str, text: str, total: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, doc_id, text as bytes). The chunk depends on the row alone, so a repeated task finds the same chunks."""
    chunks = max(1, math.ceil(total / chunk_bytes))
    return docs.select(F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(chunks)).cast("int").alias("chunk"),
                       F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))


def buckets_for(total: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(1, math.ceil(total / bucket_bytes))


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as byte planes, compressed: the planes of small numbers vanish."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T)
    used = int(np.flatnonzero(planes.any(axis=1))[-1]) + 1 if len(values) and planes.any() else 0
    parts = [zlib.compress(planes[i].tobytes(), 1) for i in range(used)]
    parts = [p if len(p) < len(values) else planes[i].tobytes() for i, p in enumerate(parts)]
    return b"".join(len(p).to_bytes(4, "little") for p in [*parts, *[b""] * (8 - used)]) + b"".join(parts)


def unpack(blob: bytes, n: int, kind=np.int64) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    at = 32
    for i in range(8):
        size = int.from_bytes(blob[4 * i:4 * i + 4], "little")
        if size:
            part = blob[at:at + size]
            planes[i] = np.frombuffer(part if size == n else zlib.decompress(part), np.uint8)
            at += size
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def questions(chunk: int, keys: np.ndarray, data: np.ndarray, buckets: int) -> pd.DataFrame:
    """Rows for the buckets of one chunk; ``keys`` sorted, ``data`` one or more 64-bit columns beside them.

    The work follows the keys, not the number of buckets: a bucket without a key costs nothing.
    """
    columns = data.reshape(len(keys), -1) if len(keys) else data.reshape(0, 1)
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, np.int64)
    rows = []
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        steps = np.diff(keys[lo:hi], prepend=np.uint64(0))
        rows.append((int(bucket[lo]), chunk, hi - lo, pack(steps), b"".join(_framed(pack(c)) for c in columns[lo:hi].T)))
    return pd.DataFrame(rows, columns=["bucket", "chunk", "n", "keys", "data"])


def _framed(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + blob


def _frames(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 8], "little")
        out.append(blob[at + 8:at + 8 + size])
        at += 8 + size
    return out


def reducer(combine):
    """For ``applyInPandas`` by bucket: ``combine(keys, columns, sizes)`` gives one 64-bit answer per entry."""

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["n"].to_numpy()
        keys = np.concatenate([np.cumsum(unpack(k, n, np.uint64)) for k, n in zip(pdf["keys"], sizes)])
        asked = [[unpack(x, n) for x in _frames(d)] for d, n in zip(pdf["data"], sizes)]
        columns = [np.concatenate(c) for c in zip(*asked)]
        del asked
        answers = np.split(combine(keys, columns), np.cumsum(sizes)[:-1])
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "n": sizes, "data": [pack(a) for a in answers]})

    return reduce


def answers_of(pdf: pd.DataFrame) -> np.ndarray:
    """The answers of one chunk, in the order of its sorted keys."""
    pdf = pdf.sort_values("bucket")
    parts = [unpack(d, n) for d, n in zip(pdf["data"], pdf["n"])]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def ask(chunks: DataFrame, make, combine) -> DataFrame:
    """``make(pdf)`` gives the questions of a chunk, ``combine`` the answers of a bucket."""
    return chunks.groupBy("chunk").applyInPandas(make, PACKED).groupBy("bucket").applyInPandas(reducer(combine), ANSWER)


def ask_again(chunks: DataFrame, answers: DataFrame, make, combine) -> DataFrame:
    """A further round whose questions depend on earlier answers: ``make(pdf, answers)``."""
    asked = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(make, PACKED)
    return asked.groupBy("bucket").applyInPandas(reducer(combine), ANSWER)
