"""Repeated substrings across documents, by enhanced suffix arrays.

A suffix array of a whole corpus fits no task, so its suffixes are dealt into
buckets in which equal ones meet.  The 50 bytes from a position on (a window) hold
31 substrings of 20 bytes; the one with the least hash is the window's anchor.
Equal windows have equal anchors, and consecutive windows with one anchor share a
slice of text (50 to 80 bytes).  So:

1. Texts are shuffled once, into chunks that are ranges of doc_id.  Every chunk
   sends its distinct slices' and anchors' hashes, dealt by hash.  A slice that an
   earlier chunk or document holds is a repeat as a whole.  An anchor matters if
   it has two different slices.
2. Of those anchors, every different slice goes, with its first holder, to its
   anchor's bucket.  There the suffixes at the window starts are sorted, common
   prefixes of neighbours are measured, and one scan with a stack gives the
   intervals of common prefix 50 or more.  Those preceded by different bytes are
   the maximal repeats among these slices, each with all its occurrences; the
   occurrences in later documents than the first are marked at full length.  (An
   anchor with very many slices, counted over all chunks, sends its windows one by
   one, dealt by their own hash, so no bucket grows with one anchor.)
3. Chunks cover the repeated slices and the marked windows.

``repeat_groups`` returns the maximal repeats of whole tables, each with all its
occurrences.  Chunks learn which of their windows occur again, and which of those
have different bytes before them: there, and only there, a maximal repeat begins.
Such places go to their window's bucket with the text up to where the repeated
windows end.  ``interval_tree`` scans the common prefixes of the different ones
with a stack, and the intervals whose occurrences are preceded by different bytes
stay.  (A text of one short period has very many maximal repeats, all of them given.)

Defined cases: a null text counts as empty; texts under 50 bytes lose nothing;
rows of one doc_id are one document and take nothing from each other; rows
without doc_id neither lose bytes nor take any; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import id_ranges, shuffle_parts, written

WINDOW = 50
GRAM = 20
SPAN = WINDOW - GRAM + 1
#: Bytes of text in a chunk, and hashes in a bucket, on average.
CHUNK_BYTES = 4 << 20
BUCKET_HASHES = 500_000
#: Bytes hashed at once in a task.
BLOCK = 1 << 20
#: An anchor with so many different slices sends single windows.
MANY = 5000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _C[0])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def slices_of(buf: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slices of a buffer: first window's start, number of windows, hash of the
    anchor, hash of the slice.  ``limit`` is the end of the text at each byte."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = _BYTE[buf]
    runs = {1: h}
    for k, c in zip((1, 2, 4, 8, 16), _C, strict=False):
        h = mix(h[:len(h) - k] * c + h[k:]) if k == 16 else h[:len(h) - k] * c + h[k:]
        runs[2 * k] = h
    gram = runs[16][:n - GRAM + 1] * _C[4] + runs[4][16:16 + n - GRAM + 1]
    gram = mix(gram)
    at = _least((gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64), SPAN)
    at = (at & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(n - WINDOW + 1)
    ok = start + WINDOW <= limit[:len(start)]
    start, at = start[ok], at[ok]
    if not len(start):
        return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    lo, count, at = start[first], np.diff(np.append(first, len(start))), at[first]
    return lo, count, gram[at], _hash(runs[32], lo, count + WINDOW - 1, at - lo)


def _hash(run32: np.ndarray, lo: np.ndarray, size: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hash of the ``size`` (50 to 80) bytes from ``lo`` on: three overlapping runs of 32."""
    tail = size - 32
    h = mix(run32[lo] * _C[1] + run32[lo + np.minimum(24, tail)])
    return mix(h * _C[2] + run32[lo + tail] + size.astype(np.uint64) * _C[3] + salt.astype(np.uint64) * _C[5])


class Chunk:
    """The documents of one chunk, in the order of doc_id, and their slices."""

    def __init__(self, table: pa.Table):
        rows = list(zip(table.column("doc_id").to_pylist(), table.column("bytes").to_pylist(), strict=True))
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] or b""))
        self.ids = [r[0] for r in rows]
        self.sizes = np.array([len(r[1] or b"") for r in rows], dtype=np.int64)
        self.buf = np.frombuffer(b"".join(r[1] or b"" for r in rows), np.uint8)
        self.ends = np.cumsum(self.sizes)
        # equal ids have one rank; rows without an id hold no windows
        rank = np.cumsum([0, *[int(a != b) for a, b in zip(self.ids[1:], self.ids[:-1], strict=True)]][: len(rows)])
        parts = []
        named = np.array([i is not None for i in self.ids], dtype=bool)
        limit_of = np.where(named, self.ends, 0)
        a = 0
        total = len(self.buf)
        while a < total:  # blocks share 49 bytes, so that every window is whole in one of them
            b = min(total, a + BLOCK + WINDOW - 1)
            doc = np.searchsorted(self.ends, np.arange(a, b), side="right")
            lo, count, anchor, fp = slices_of(self.buf[a:b], limit_of[doc] - a)
            parts.append((lo + a, count, anchor, fp, rank[doc[lo]] if len(lo) else lo))
            a += BLOCK
        cols = list(zip(*parts, strict=True)) if parts else [[]] * 5
        self.lo, self.count, self.anchor, self.fp, self.rank = (
            np.concatenate(c) if len(c) else np.zeros(0, t) for c, t in zip(cols, (np.int64, np.int64, np.uint64, np.uint64, np.int64), strict=True))
        self.rank = self.rank.astype(np.int64)
        # distinct slices (self.some: their first places), and to which each slice belongs
        _, self.some, self.which = np.unique(self.fp, return_index=True, return_inverse=True)
        self.later = self.rank > self.rank[self.some][self.which]

    def sent(self, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(kind, bucket, values, places): the hashes of the distinct slices (kind 0),
        and of the distinct anchors with at most two slices each (kind 1); for these ``numbers``
        has how many slices the chunk has, at the first of them."""
        fp = self.fp[self.some]  # ascending
        edge = np.searchsorted(fp, [(b << 64) // buckets for b in range(1, buckets)]) if buckets > 1 else []
        for b, (s, e) in enumerate(zip([0, *edge], [*edge, len(fp)], strict=True)):
            if e > s:
                yield 0, b, fp[s:e], np.arange(s, e)
        pairs = (self.anchor[self.some] << np.uint64(32)) | (fp & np.uint64(0xFFFFFFFF))
        order = np.lexsort((pairs, mix(self.anchor[self.some]) % np.uint64(buckets)))
        bucket = (mix(self.anchor[self.some]) % np.uint64(buckets)).astype(np.int64)[order]
        key = pairs[order] >> np.uint64(32)
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1]))) if len(key) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        nth = np.arange(len(key)) - np.flatnonzero(new)[group] if len(key) else group
        two = nth < 2
        edge = np.searchsorted(bucket[two], np.arange(1, buckets)).tolist()
        values, places = pairs[order][two], group[two]
        self.numbers = np.where(nth == 0, np.bincount(group, minlength=1)[group], 0)[two].astype("<u4") if len(key) else np.zeros(0, "<u4")
        self.anchor_group = np.empty(len(self.some), np.int64)
        self.anchor_group[order] = group
        self.anchor_groups = int(group[-1]) + 1 if len(group) else 0
        for b, (s, e) in enumerate(zip([0, *edge], [*edge, len(values)], strict=True)):
            if e > s:
                yield 1, b, values[s:e], places[s:e]
        self.edges = [0, *edge, len(values)]

    def learn(self, replies: pa.Table, buckets: int) -> None:
        """Take the answers on slices and anchors."""
        said = {(k, b): v for k, b, v in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "bits")), strict=True) if k < 2}
        self.known = np.zeros(len(self.some), bool)  # an earlier chunk holds the slice
        parts = list(self.sent(buckets))
        state = np.zeros(self.anchor_groups, np.int64)  # 0: one slice only, 1: several, 2: very many
        for kind, b, values, places in parts:
            bits = np.unpackbits(np.frombuffer(said[kind, b], np.uint8))
            if kind == 0:
                self.known[places] = bits[: len(values)].astype(bool)
            else:
                np.maximum.at(state, places, bits[: len(values)] + bits[len(values): 2 * len(values)].astype(np.int64))
        self.state = state[self.anchor_group] if len(self.some) else state

    def asked(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(bucket, first windows' starts, numbers of windows, ranks): the slices to compare."""
        use = ~self.known & (self.state == 1)
        at = self.some[use]
        lo, count, rank = self.lo[at], self.count[at], self.rank[at]
        bucket = (mix(self.anchor[at] + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        at = self.some[~self.known & (self.state == 2)]
        if len(at):  # single windows, each content once
            n = self.count[at]
            one = np.repeat(self.lo[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            h = np.zeros(len(one), np.uint64)
            for k in range(WINDOW):
                h = h * _C[0] + _BYTE[self.buf[one + k]]
            h = mix(h)
            lo, count = np.concatenate([lo, one]), np.concatenate([count, np.ones(len(one), np.int64)])
            rank, bucket = np.concatenate([rank, np.repeat(self.rank[at], n)]), np.concatenate([bucket, (h % np.uint64(buckets)).astype(np.int64)])
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            if edge[b + 1] > edge[b]:
                o = order[edge[b]:edge[b + 1]]
                yield b, lo[o], count[o], rank[o]

    def covered(self, replies: pa.Table, buckets: int) -> np.ndarray:
        """True for each byte to remove."""
        said = {b: v for k, b, v in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "bits")), strict=True) if k == 2}
        step = np.zeros(len(self.buf) + 1, np.int32)
        whole = self.later | (self.known[self.which] if len(self.which) else self.later)
        np.add.at(step, self.lo[whole], 1)
        np.add.at(step, self.lo[whole] + self.count[whole] + WINDOW - 1, -1)
        marked = np.zeros(len(self.buf) + 1, bool)
        for b, lo, count, _ in self.asked(buckets):
            if b in said:
                starts = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                marked[starts[np.unpackbits(np.frombuffer(said[b], np.uint8))[: len(starts)].astype(bool)]] = True
        # the first place of a slice answers for its other places in the same document
        again = ~whole
        again[self.some] = False
        for i in np.flatnonzero(again).tolist():
            f = self.some[self.which[i]]
            marked[self.lo[i]:self.lo[i] + self.count[i]] |= marked[self.lo[f]:self.lo[f] + self.count[f]]
        starts = np.flatnonzero(marked)
        np.add.at(step, starts, 1)
        np.add.at(step, starts + WINDOW, -1)
        return np.cumsum(step[:-1]) > 0


# --- the enhanced suffix array -------------------------------------------------


def suffix_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[start:end], and the common prefix of each with the one before it."""
    width = int((ends - starts).max()) if len(starts) else 0
    words = -(-width // 8)
    padded = np.concatenate([data, np.zeros(8 * words + 8, np.uint8)])
    keys = []
    for k in range(words):
        left = np.clip(ends - starts - 8 * k, 0, 8)
        word = np.zeros(len(starts), np.uint64)
        for j in range(8):
            word = (word << np.uint64(8)) | np.where(j < left, padded[starts + np.minimum(8 * k + j, width)], 0).astype(np.uint64)
        keys.append(word)
    order = np.lexsort([ends - starts, *keys[::-1]]) if len(starts) else np.zeros(0, np.int64)
    lcp, equal = np.zeros(len(order), np.int64), np.ones(max(0, len(order) - 1), bool)
    for word in keys:
        w = word[order]
        diff = w[1:] ^ w[:-1]
        top = np.full(len(diff), 8)
        for j in range(7, -1, -1):
            top[diff >= np.uint64(1) << np.uint64(8 * (7 - j))] = np.minimum(top[diff >= np.uint64(1) << np.uint64(8 * (7 - j))], j)
        lcp[1:] += np.where(equal, top, 0)
        equal &= diff == 0
    size = (ends - starts)[order]
    lcp[1:] = np.minimum(lcp[1:], np.minimum(size[1:], size[:-1]))
    return order, lcp


def interval_tree(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the suffix array whose
    common prefix is ``least`` or more, inner ones first; one scan with a stack."""
    stack: list[tuple[int, int]] = []
    for i, here in enumerate([*lcp[1:].tolist(), 0], 1):
        left = i - 1
        while stack and stack[-1][0] > here:
            depth, left = stack.pop()
            yield depth, left, i - 1
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, left))


def _over(f: np.ufunc, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """``f`` over values[first:last + 1] of each interval."""
    if not len(first):
        return values[:0]
    return f.reduceat(np.append(values, values[-1:]), np.column_stack([first, last + 1]).ravel())[::2]


def maximal_repeats(lcp: np.ndarray, before: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(common prefix, first, last) of the intervals whose occurrences are preceded by different bytes
    (``before``, -1 where the text or the slice begins), in the order of the suffixes.  Only runs of common
    prefixes of ``least`` or more are scanned."""
    inside = np.concatenate((lcp[1:] >= least, [False])) if len(lcp) else np.zeros(0, bool)
    turn = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))).reshape(-1, 2)
    found = [np.zeros((0, 3), np.int64)]
    two = turn[:, 1] - turn[:, 0] == 1  # pairs are intervals as they are
    a = turn[two, 0]
    found.append(np.column_stack([lcp[a + 1], a, a + 1]))
    for a, b in turn[~two].tolist():
        found.append(np.array([(n, x + a, y + a) for n, x, y in interval_tree(np.concatenate(([0], lcp[a + 1:b + 1])), least)]))
    depth, first, last = np.concatenate(found).astype(np.int64).T
    low, high = _over(np.minimum, before, first, last), _over(np.maximum, before, first, last)
    diverse = (low < 0) | (low < high)
    return depth[diverse], first[diverse], last[diverse]


def left_diverse(before: np.ndarray) -> bool:
    """Whether the bytes before the occurrences differ (-1: the text begins, or the slice does)."""
    return bool((before < 0).any() or (before != before[0]).any())


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of slices joined in one buffer: slice, start and end of each window's suffix."""
    ends = np.cumsum(sizes)
    n = sizes - WINDOW + 1
    which = np.repeat(np.arange(len(sizes)), n)
    return which, (ends - sizes)[which] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), ends[which]


# --- the three steps in Spark --------------------------------------------------

REPLY = "chunk long, kind int, bucket int, bits binary"


def _reply(rows: list) -> pa.Table:
    chunk, kind, bucket, bits = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table([pa.array(chunk, pa.int64()), pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(bits, pa.binary())],
                    names=["chunk", "kind", "bucket", "bits"])


def _chunks(docs: DataFrame, chunk_bytes: int, bucket_hashes: int) -> tuple[DataFrame, int]:
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("bytes"))
    size = d.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    chunk = id_ranges(d, max(1, math.ceil(size / chunk_bytes)))
    parts = max(shuffle_parts(docs.sparkSession), 8)
    return d.withColumn("chunk", chunk).repartition(parts, "chunk"), max(8, math.ceil(size / (SPAN / 2) / bucket_hashes))


def _answers(chunks: DataFrame, buckets: int) -> DataFrame:
    """Step 1: which slices an earlier chunk holds, which anchors have several slices."""

    def send(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        c = Chunk(table)
        parts = list(c.sent(buckets))
        numbers = lambda b: c.numbers[c.edges[b]:c.edges[b + 1]].tobytes()
        return _reply([(chunk, k, b, v.tobytes() + (numbers(b) if k else b"")) for k, b, v, _ in parts])

    def answer(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        chunk = table.column("chunk").to_numpy()
        sent = [v.as_py() for v in table.column("bits")]
        sizes = np.array([len(v) // (12 if kind else 8) for v in sent])
        values = [np.frombuffer(v, np.uint64, n) for v, n in zip(sent, sizes, strict=True)]
        owner, x = np.repeat(chunk, sizes), np.concatenate(values)
        if kind == 0:
            order = np.lexsort((owner, x))
            new = np.concatenate(([True], x[order][1:] != x[order][:-1]))
            seen = np.empty(len(x), bool)
            seen[order] = ~new
            bits = [seen]
        else:
            u, back = np.unique(x, return_inverse=True)  # pairs of anchor and slice
            anchor, group, n = np.unique(u >> np.uint64(32), return_inverse=True, return_counts=True)
            numbers = np.concatenate([np.frombuffer(v, "<u4", n, 8 * n) for v, n in zip(sent, sizes, strict=True)])
            every = np.bincount(group[back], numbers, minlength=len(n))  # slices of all chunks
            bits = [n[group][back] >= 2, every[group][back] >= MANY]
        edges = np.concatenate(([0], np.cumsum(sizes)))
        return _reply([(int(c), kind, bucket, np.packbits(np.concatenate([b[s:e] for b in bits])).tobytes())
                       for c, s, e in zip(chunk, edges[:-1], edges[1:], strict=True)])

    sent = chunks.groupBy("chunk").applyInArrow(send, REPLY)
    return sent.groupBy("kind", "bucket").applyInArrow(answer, REPLY)


SLICES = "chunk long, bucket int, sizes binary, ranks binary, data binary"


def _slices(chunks: DataFrame, replies: DataFrame, buckets: int) -> DataFrame:
    """Step 2, first half: the slices to compare, by bucket."""

    def send(table: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            c = Chunk(table)
            c.learn(said, buckets)
            chunk = table.column("chunk")[0].as_py()
            for b, lo, count, rank in c.asked(buckets):
                sizes = count + WINDOW - 1
                at = np.repeat(lo - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                rows.append((chunk, b, sizes.astype("<u2").tobytes(), rank.astype("<u4").tobytes(), c.buf[at].tobytes()))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["chunk", "bucket", "sizes", "ranks", "data"])

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(send, SLICES)


def _joined(table: pa.Table):
    """The slices of a bucket: windows' slice, start, end; owner of each slice; the data; windows of each row."""
    sizes = [np.frombuffer(v.as_py(), "<u2").astype(np.int64) for v in table.column("sizes")]
    ranks = [np.frombuffer(v.as_py(), "<u4").astype(np.int64) for v in table.column("ranks")]
    chunk = table.column("chunk").to_numpy()
    owner = np.concatenate([(c << 32) + r for c, r in zip(chunk, ranks, strict=True)])
    data = np.frombuffer(b"".join(v.as_py() for v in table.column("data")), np.uint8)
    return (*_windows(np.concatenate(sizes)), owner, data, chunk, np.array([int((s - WINDOW + 1).sum()) for s in sizes]))


def _marks(slices: DataFrame) -> DataFrame:
    """Step 2, second half: the windows that an earlier document holds."""

    def mark(table: pa.Table) -> pa.Table:
        which, start, end, owner, data, chunk, n = _joined(table)
        order, lcp = suffix_array(data, start, end)
        begins = np.concatenate(([True], which[1:] != which[:-1])) if len(which) else np.zeros(0, bool)
        before = np.where(begins, -1, data[start - 1].astype(np.int64))[order]
        own, at = owner[which][order], start[order]
        depth, first, last = maximal_repeats(lcp, before, WINDOW)
        least = _over(np.minimum, own, first, last)
        size = last - first + 1
        each = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        later = own[each] > np.repeat(least, size)
        step = np.zeros(len(data) + 1, np.int64)  # the windows of each later occurrence, at its full length
        np.add.at(step, at[each][later], 1)
        np.add.at(step, (at[each] + np.repeat(depth, size) - WINDOW + 1)[later], -1)
        marked = np.cumsum(step)[start] > 0
        bucket = table.column("bucket")[0].as_py()
        edges = np.concatenate(([0], np.cumsum(n)))
        return _reply([(int(c), 2, bucket, np.packbits(marked[s:e]).tobytes()) for c, s, e in zip(chunk, edges[:-1], edges[1:], strict=True)])

    return slices.groupBy("bucket").applyInArrow(mark, REPLY)


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """doc_id, n_bytes, the bytes kept, and the removed spans (start, end in bytes)."""
    chunks, buckets = _chunks(docs, chunk_bytes, bucket_hashes)
    first = _answers(chunks, buckets)
    second = _marks(_slices(chunks, first, buckets))

    def cut(table: pa.Table, said: pa.Table) -> pa.Table:
        ids, n, kept, spans = [], [], [], []
        if table.num_rows:
            c = Chunk(table)
            c.learn(said, buckets)
            gone = c.covered(said, buckets)
            ids, n = c.ids, c.sizes.tolist()
            for e, size in zip(c.ends.tolist(), n, strict=True):
                g = gone[e - size:e]
                kept.append(c.buf[e - size:e][~g].tobytes())
                turn = np.flatnonzero(np.diff(np.concatenate(([False], g, [False])).astype(np.int8)))
                spans.append([{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
                        names=["doc_id", "n_bytes", "kept", "spans"])

    replies = first.unionByName(second)
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        cut, "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")


def _window_hash(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        h = h * _C[0] + _BYTE[buf[at + k]]
    return mix(h)


def _starts(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The windows' starts of slices."""
    return np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _before(c: Chunk, at: np.ndarray) -> np.ndarray:
    """The byte before each place, -1 where a text begins."""
    if not len(at):
        return np.zeros(0, np.int64)
    doc = np.searchsorted(c.ends, at, side="right")
    return np.where(at == (c.ends - c.sizes)[doc], -1, c.buf[at - 1].astype(np.int64))


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) if differ.any() else n


def _suffixes(docs: DataFrame, chunk_bytes: int, bucket_hashes: int) -> DataFrame:
    """One row per place where a maximal repeat may begin: the window's hash, the
    document and byte offset, the byte before, and the text up to where the
    repeated windows that follow each other end; no repeat reaches further."""
    chunks, _ = _chunks(docs, chunk_bytes, bucket_hashes)
    said, counted = "chunk long, key long", "chunk long, key long, n long, low int, high int"

    def anchors(table: pa.Table) -> pa.Table:
        key, n = np.unique(Chunk(table).anchor, return_counts=True)
        return pa.table([pa.array(np.full(len(key), table.column("chunk")[0].as_py())), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["chunk", "key", "n"])

    sent = chunks.groupBy("chunk").applyInArrow(anchors, said + ", n long")
    several = sent.join(sent.groupBy("key").agg(F.sum("n").alias("all")).filter("all > 1"), "key").select("chunk", "key")

    def windows(table: pa.Table, found: pa.Table) -> pa.Table:
        cols: tuple = ([], [], [], [], [])
        if table.num_rows and found.num_rows:
            c = Chunk(table)
            use = np.isin(c.anchor, found.column("key").to_numpy().view(np.uint64))
            at = _starts(c.lo[use], c.count[use])
            key, which, n = np.unique(_window_hash(c.buf, at), return_inverse=True, return_counts=True)
            before = _before(c, at)
            low, high = np.full(len(key), 256), np.full(len(key), -1)
            np.minimum.at(low, which, before)
            np.maximum.at(high, which, before)
            cols = (np.full(len(key), table.column("chunk")[0].as_py()), key.view(np.int64), n, low, high)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["chunk", "key", "n", "low", "high"])

    sent = written(chunks.groupBy("chunk").cogroup(several.groupBy("chunk")).applyInArrow(windows, counted), "repeat-windows")
    facts = sent.groupBy("key").agg(F.sum("n").alias("all"), F.min("low").alias("l"), F.max("high").alias("h")).filter("all > 1")
    again = sent.join(facts, "key").select("chunk", "key", ((F.col("l") < 0) | (F.col("l") < F.col("h"))).alias("diverse"))

    def suffixes(table: pa.Table, found: pa.Table) -> pa.Table:
        cols: tuple = ([], [], [], [], [])
        if table.num_rows and found.num_rows:
            c = Chunk(table)
            at = np.sort(_starts(c.lo, c.count))
            key, h = found.column("key").to_numpy().view(np.uint64), _window_hash(c.buf, at)
            held = np.isin(h, key)
            at, h = at[held], h[held]
            last = np.append(at[1:] != at[:-1] + 1, True)  # of windows that follow each other
            end = at[last][np.cumsum(last) - last] + WINDOW
            begins = np.isin(h, key[np.asarray(found.column("diverse").to_pylist(), bool)])
            at, h, end = at[begins], h[begins], end[begins]
            doc = np.searchsorted(c.ends, at, side="right")
            cols = (h.view(np.int64), [c.ids[d] for d in doc.tolist()], at - (c.ends - c.sizes)[doc], _before(c, at),
                    [c.buf[a:e].tobytes() for a, e in zip(at.tolist(), end.tolist(), strict=True)])
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.large_binary())
        return pa.table([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["key", "doc_id", "start", "before", "suffix"]).cast(
            pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("before", pa.int32()), ("suffix", pa.binary())]))

    return chunks.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(
        suffixes, "key long, doc_id long, start long, before int, suffix binary")


def repeat_groups(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """The maximal repeats of 50 bytes or more: ``text`` and, one row each, all its
    occurrences (doc_id, start and end in bytes of the document)."""
    places = written(_suffixes(docs, chunk_bytes, bucket_hashes).withColumn("id", F.md5("suffix")), "repeat-suffixes")
    different = places.groupBy("key", "id").agg(
        F.first("suffix").alias("suffix"), F.count("*").alias("n"), F.min("before").alias("low"), F.max("before").alias("high"))

    def groups(table: pa.Table) -> pa.Table:
        suffix, ids = table.column("suffix").to_pylist(), table.column("id").to_pylist()
        order = sorted(range(len(suffix)), key=suffix.__getitem__)
        n, low, high = (table.column(c).to_numpy()[order] for c in ("n", "low", "high"))
        lcp = np.array([0, *[_common(suffix[i], suffix[j]) for i, j in zip(order, order[1:], strict=False)]])
        # a suffix that occurs several times is an interval, too, unless it is the beginning of the next one
        nearest = np.maximum(lcp, np.append(lcp[1:], 0))
        alone = [(len(suffix[i]), k, k) for k, i in enumerate(order) if n[k] > 1 and len(suffix[i]) > nearest[k]]
        text, of = [], []
        for depth, a, b in [*alone, *interval_tree(lcp, WINDOW)]:
            if left_diverse(np.concatenate([low[a:b + 1], high[a:b + 1]])):
                text += [suffix[order[a]][:depth]] * (b + 1 - a)
                of += [ids[i] for i in order[a:b + 1]]
        return pa.table([pa.array([table.column("key")[0].as_py()] * len(of), pa.int64()), pa.array(of, pa.string()), pa.array(text, pa.binary())],
                        names=["key", "id", "text"])

    found = different.groupBy("key").applyInArrow(groups, "key long, id string, text binary")
    return found.join(places.select("key", "id", "doc_id", "start"), ["key", "id"]).select(
        "text", "doc_id", "start", (F.col("start") + F.octet_length("text")).alias("end"))


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
