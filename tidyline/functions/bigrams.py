"""Pairs of neighbouring code points, counted within each text.

A text has far fewer distinct pairs than characters, so jobs that count or look up
pairs move one row per distinct pair of a text, not one per character.  The
kernels work on a bounded slice of an Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT_BITS = 21
LOW = (1 << POINT_BITS) - 1
#: Bytes of text that one numpy pass takes at most (a longer text is a pass of its own).
PASS = 1 << 18


def slices(t: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of bounded size, in order."""
    sizes = pc.fill_null(pc.binary_length(t), 0).to_numpy(zero_copy_only=False).tolist()
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and (size + n > PASS or i - start >= PASS):
            yield t.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(t) > start:
        yield t.slice(start)


def _count(texts: list[str]) -> pa.Array:
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    keys = (row[:-1] << 2 * POINT_BITS) | (codes[:-1] << POINT_BITS) | codes[1:]
    keys, n = np.unique(keys[row[1:] == row[:-1]], return_counts=True)
    pairs, at = np.unique(keys & ((1 << 2 * POINT_BITS) - 1), return_inverse=True)
    names = pa.array([chr(p >> POINT_BITS) + chr(p & LOW) for p in pairs.tolist()], pa.string())
    each = pa.StructArray.from_arrays([names.take(pa.array(at)), pa.array(n, pa.int64())], ["g", "n"])
    ends = np.cumsum(np.bincount(keys >> 2 * POINT_BITS, minlength=len(texts)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), each)


def counted_bigrams(text: Column) -> Column:
    """array<struct<g, n>>: the distinct pairs of neighbouring code points of a text, with their counts (null: none)."""
    kind = pa.list_(pa.struct([("g", pa.string()), ("n", pa.int64())]))
    parts, count = slices, _count

    @F.arrow_udf("array<struct<g:string,n:long>>")
    def kernel(t: pa.Array) -> pa.Array:
        made = [count([x or "" for x in part.to_pylist()]) for part in parts(t)]
        return pa.concat_arrays(made) if made else pa.array([], kind)

    # deterministic calls below an ``inline`` would run twice, the first time for a filter on empty arrays
    return kernel.asNondeterministic()(text.cast("string"))


def counted_chars(df: DataFrame, text: str) -> DataFrame:
    """(ch, n): the characters of each slice of texts with their counts, to be added up (null: none)."""
    parts = slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in parts(b.column(0))):
            joined = "".join(x or "" for x in part.to_pylist())
            codes, n = np.unique(np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(map(chr, codes.tolist())), pa.string()), pa.array(n, pa.int64())], ["ch", "n"])

    return df.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "ch string, n long")


def murmur3(data: bytes, seed: int = 42) -> int:
    """The 32-bit hash that ``pyspark.ml.feature.HashingTF`` takes of a term."""
    h, whole = seed, len(data) & ~3
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h ^= ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
        if i < whole:
            h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def hashed_bigrams(text: Column, size: int, known: int = 1 << 20) -> Column:
    """The sparse vector that ``NGram(n=2)`` over the code points and ``HashingTF(numFeatures=size)`` give (null: none).
    A task hashes each distinct pair once and keeps ``known`` of them at most."""
    digest: Callable[[bytes], int] = murmur3
    buckets: dict[int, int] = {}

    def bucket(p: int) -> int:
        b = buckets.get(p)
        if b is None:
            if len(buckets) >= known:
                buckets.clear()
            b = buckets[p] = digest(f"{chr(p >> POINT_BITS)} {chr(p & LOW)}".encode()) % size
        return b

    @F.udf(VectorUDT())
    def kernel(t):
        codes = np.frombuffer((t or "").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        pairs, n = np.unique((codes[:-1] << POINT_BITS) | codes[1:], return_counts=True)
        at, of = np.unique(np.fromiter(map(bucket, pairs.tolist()), np.int64, len(pairs)), return_inverse=True)
        return SparseVector(size, at, np.bincount(of, n, len(at)))

    return kernel(text.cast("string"))
