"""Near-duplicate documents by SuperMinHash signatures.

A document's set holds its distinct word shingles.  Equal sets form a class, and
only one of each class goes on.  In a SuperMinHash signature every element gives
each register a different rank, in the order of a random permutation, and a
register keeps the least (rank, fraction); ranks are dealt one after the other,
and a document is done as soon as all its registers are below the next rank.
Signatures are cut into bands; documents that share a band are candidates.

Groups of candidates are not paired in full.  Each member is first held against
the least member of its bucket; verified links give components; members of other
components are held against another member of the bucket, a few times over; only
members that still differ in component are then compared, and of those only pairs
that share an element of what tells them from the bucket's first member (see
``differences``; no linked pair fails that).  All links are confirmed on the full sets, and those
between members of one component need no test, so the components are the same as
if all candidates had been tested.

A pair of similarity 0.8 shares at least one of 32 bands of 5 registers with
probability 1 - 3e-6 (0.85: 1 - 1e-8).

Defined cases: a null or empty text, or one without words, has no shingles and is
linked with nothing; rows of one doc_id count as one document that is linked if
any of them is, and stay or go together; rows without doc_id are linked with
nothing and stay; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import join_counted, nested, written
from tidyline.llm.links import components

ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
SIMILARITY_PCT = 80
SHINGLE = 5
#: Pairs that agree in fewer registers are not verified: at similarity 0.8 that is nearly five deviations below the mean.
LEAST_AGREE = int(REGISTERS * 0.65)
#: Times that each bucket's members are held against one of them before the rest is compared.
TURNS = 1
#: Bytes of text and elements handled at once in a task.
TEXT_BYTES, ELEMENTS = 4 << 20, 1 << 18

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte buffer."""
    solid = ~_SPACE[buf]
    starts = np.flatnonzero(solid & np.concatenate(([True], ~solid[:-1])))
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    at = np.arange(len(buf)) - starts[np.maximum(np.cumsum(np.bincount(starts, minlength=len(buf))) - 1, 0)]
    at = np.where(solid, at, 0)
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(at.max()), _ODD))))
    values = np.where(solid, _BYTE[buf] * powers[at], np.uint64(0))
    sizes = np.add.reduceat(solid.astype(np.uint64), starts)
    return starts, mix(np.add.reduceat(values, starts) + sizes * _GOLD)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle."""
    joined = b"\n".join([*texts, b""]).lower()
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, words = word_hashes(np.frombuffer(joined, np.uint8))
    edge = np.concatenate(([0], np.searchsorted(starts, ends)))
    long = words[: max(0, len(words) - size + 1)].copy()
    for k in range(1, size):
        long = mix(long * _ODD + words[k:k + len(long)])
    long = mix(long + np.uint64(size))
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(long[a:b - size + 1]))
        elif b > a:
            h = words[a:a + 1].copy()
            for k in range(a + 1, b):
                h = mix(h * _ODD + words[k:k + 1])
            out.append(mix(h + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def super_minhash(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """One row of ``m`` registers for each set, (rank << 32) + fraction; an empty set has only ones."""
    sizes = np.array([len(s) for s in sets])
    sig = np.full(len(sets) * m, ~np.uint64(0))
    x = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(sets)), sizes)
    order = None  # the permutation of each element that is still at work
    for j in range(m):
        if not len(x):
            break
        h = mix(x + np.uint64((2 * j + 1) * int(_GOLD) & (2**64 - 1)))
        k = j + ((h >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            reg = k
        else:
            rows = np.arange(len(x))
            reg = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        np.minimum.at(sig, doc * m + reg, (np.uint64(j) << np.uint64(32)) + (h & np.uint64(0xFFFFFFFF)))
        done = sig.reshape(-1, m).max(1) < np.uint64(j + 1) << np.uint64(32)
        on = ~done[doc]
        if j == 0:
            x, doc, k = x[on], doc[on], k[on]
            order = np.tile(np.arange(m, dtype=np.uint16), (len(x), 1))
            order[np.arange(len(x)), k] = 0
        elif not on.all():
            x, doc, order = x[on], doc[on], order[on]
    return sig.reshape(-1, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key for each band of a signature; the band's number is part of it."""
    b = sig.reshape(len(sig), -1, ROWS)
    h = np.arange(1, b.shape[1] + 1, dtype=np.uint64)[None, :] * _GOLD
    for k in range(ROWS):
        h = mix(h * _ODD + b[:, :, k])
    return h.view(np.int64)


def _lots(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Parts of a batch of bounded bytes: the first row and its texts."""
    first, lot, size = 0, [], 0
    for i, t in enumerate(batch.column(1)):
        b = (t.as_py() or "").encode("utf-8", "replace")
        if lot and size + len(b) > TEXT_BYTES:
            yield first, lot
            first, lot, size = i, [], 0
        lot.append(b)
        size += len(b)
    if lot:
        yield first, lot


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, band keys, and a byte of each register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, lot in _lots(batch):
                sets = shingle_sets(lot, size)
                n = np.array([len(s) for s in sets])
                sig = np.empty((len(sets), REGISTERS), np.uint64)
                a = 0
                while a < len(sets):  # by bounded numbers of elements
                    b = a + 1
                    total = n[a]
                    while b < len(sets) and total + n[b] <= ELEMENTS:
                        total += n[b]
                        b += 1
                    sig[a:b] = super_minhash(sets[a:b])
                    a = b
                one = [int(s.sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
                two = [int(mix(s ^ _ODD).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
                keys = band_keys(sig)
                small = mix(sig.reshape(-1)).astype(np.uint8).reshape(sig.shape)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(lot)), pa.array(n, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)),
                     pa.array(np.array(two, np.uint64).view(np.int64)), pa.array([k.tolist() if c else [] for k, c in zip(keys, n, strict=True)], pa.list_(pa.int64())),
                     pa.array([s.tobytes() for s in small], pa.binary())], names=["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch binary")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """id and the shingle hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, lot in _lots(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(lot)), pa.array([s.tobytes() for s in shingle_sets(lot, size)], pa.binary())],
                                                 names=["id", "set"])

    return docs.mapInArrow(run, "id long, set binary")


def agree(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, REGISTERS) for i in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= LEAST_AGREE))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for u, v in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(u.as_py(), np.uint64), np.frombuffer(v.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def differences(pairs: DataFrame, percent: int) -> DataFrame:
    """For members a of a leader b: the elements by which a linked pair of members must meet.

    Let D(x) be the elements that only one of x and the leader has.  Two members
    differ in exactly the elements that only one of D(x) and D(y) has, so x and y
    are linked if those are at most c (|x| + |y|), c = (1 - p) / (1 + p).  Members
    within that of the leader (light) are linked to it and to one component.  Of
    any other pair one member, y, is heavy, and the two must share at least
    (|D(x)| + |D(y)| - c (|x| + |y|)) / 2 elements of D.  In any one order of all
    elements they then meet in the first

    * p1 = |D(x)| - (|D(x)| + c (|leader| - |x|)) / 2 + 1 of x, as y is heavy;
    * p2 = c (|x| + |y|) + 1 of y if x is light, by the triangle inequality, |x| being at most |y| / p."""
    c = (100 - percent) / (100 + percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            for a, b, u, v in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                x, y = np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64)
                d = np.setxor1d(x, y, assume_unique=True)
                heavy = (100 + percent) * len(d) > (100 - percent) * (len(x) + len(y))
                one = int((len(d) + c * (len(x) - len(y))) / 2 + 1e-9) + 1
                most = c * len(x) * (1 + 100 / percent)
                # beyond that no light member is near enough
                two = int(most + 1e-9) + 1 if heavy and len(d) <= most + c * (len(y) + len(x) * 100 / percent) + 1e-9 else 0
                for o, value in zip(out, (a, b, len(x), len(d), heavy, max(one, 0), two, d.view(np.int64).tolist()), strict=True):
                    o.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names=["a", "b", "n", "nd", "heavy", "p1", "p2", "terms"])

    return pairs.mapInArrow(run, "a long, b long, n long, nd long, heavy boolean, p1 int, p2 int, terms array<long>")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY_PCT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    sig = written(signatures(docs, size), "signatures")
    named = sig.filter("doc_id is not null and n_shingles > 0")
    # equal sets: the least doc_id stands for all
    classes = written(named.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    n_named = named.count()
    member = written(join_counted(named.select("doc_id", "n_shingles", "d1", "d2"), classes, ["n_shingles", "d1", "d2"], n_named).select("doc_id", "rep", "n_shingles"), "members")
    reps = written(named.join(classes.select(F.col("rep").alias("doc_id"), "n_shingles", "d1", "d2"), ["doc_id", "n_shingles", "d1", "d2"])
                   .select(F.col("doc_id").alias("rep"), "n_shingles", "bands", "sketch").dropDuplicates(["rep", "n_shingles", "bands"]), "representatives")
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("other"), F.count("*").alias("n")).filter("leader < other").select("key", "leader", "n")
    buckets = written(buckets, "bucket-leaders")
    crowded = written(join_counted(keyed, buckets, ["key"], keyed.count()), "buckets")
    buckets = buckets.drop("n")
    sketches = reps.select(F.col("rep").alias("id"), "sketch", "n_shingles")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    sets = written(full_sets(texts.join(crowded.select(F.col("rep").alias("id")).distinct(), "id"), size), "sets")

    def both_sets(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("xa")), "a")
                .join(sets.select(F.col("id").alias("b"), F.col("set").alias("xb")), "b"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """pairs (a, b), a > b, each once"""
        x = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na")), "a")
        x = x.join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb")), "b")
        x = agree(x.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).distinct()
        return written(confirm(both_sets(x), percent).distinct(), name)

    star = crowded.filter("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    roots = components(verified(star, "links"))

    def open_buckets(roots: DataFrame) -> DataFrame:
        """Members of the buckets that still hold several components."""
        label = crowded.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select("key", "rep", F.coalesce("root", "rep").alias("root"))
        mixed = label.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
        return label.join(mixed, "key")

    # each bucket has another member, drawn by a hash, that those of other components are held against
    for turn in range(TURNS):
        left = written(open_buckets(roots), "open-buckets")
        lead = left.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep", "key", F.lit(turn)), F.col("rep"), F.col("root"))).alias("l")).select(
            "key", F.col("l.rep").alias("leader"), F.col("l.root").alias("leader_root"))
        x = left.join(lead, "key").filter("root <> leader_root")
        x = x.select(F.greatest("rep", "leader").alias("a"), F.least("rep", "leader").alias("b")).distinct()
        roots = components(verified(x, f"links-{turn}").unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    # what is left: members of one bucket and different components, compared by what tells them from the bucket's leader
    left = open_buckets(roots).select("key", "rep").join(buckets, "key").filter("rep <> leader").select(
        F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    told = written(both_sets(left).select("a", "b", "xa", "xb").transform(lambda d: differences(d, percent)), "differences")
    # elements in the order of how many members of the leader they tell from it: most belong to one member only
    flat = told.select("a", "b", F.explode("terms").alias("e"))
    flat = flat.join(flat.groupBy("b", "e").agg(F.count("*").alias("df")), ["b", "e"])
    sorted_terms = flat.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("terms"))
    named_root = roots.select(F.col("id").alias("a"), F.col("root").alias("_root"))
    told = told.drop("terms").join(sorted_terms, ["a", "b"]).join(named_root, "a", "left")
    told = written(told.withColumn("root", F.coalesce("_root", "a")).drop("_root"), "ordered-differences")

    def side(kind: int, length: str, x: str) -> DataFrame:
        rows = told.filter(F.col("heavy") == (kind > 0)).select("a", "b", "n", "nd", "root", F.posexplode(F.slice("terms", F.lit(1), F.col(length))).alias("i", "t"))
        rows = rows.filter("t.df > 1")  # an element of one member only meets no other
        return rows.select("b", F.col("t.e").alias("e"), F.lit(kind).alias("kind"), *[F.col(c).alias(c + x) for c in ("a", "n", "nd", "root", "i")])

    one = side(0, "p1", "x").unionByName(side(1, "p1", "x"))
    two = side(1, "p1", "y").unionByName(side(2, "p2", "y")).withColumnRenamed("kind", "other")
    # both must still have as many elements from here on as the pair must share
    share = (100 + percent) * (F.col("ndx") + F.col("ndy")) - (100 - percent) * (F.col("nx") + F.col("ny"))
    enough = 2 * (100 + percent) * F.least(F.col("ndx") - F.col("ix"), F.col("ndy") - F.col("iy")) >= share
    near = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    rest = one.join(two, ["b", "e"]).filter(F.expr("(kind = 0 and other = 2) or (kind = 1 and other = 1 and ax < ay)")
                                             & (F.col("rootx") != F.col("rooty")) & enough & near).select(
        F.greatest("ax", "ay").alias("a"), F.least("ax", "ay").alias("b")).distinct()
    roots = components(verified(rest, "more-links").unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    by_doc = (member.join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").groupBy("doc_id")
              .agg(F.min(F.coalesce("root", "rep")).alias("component_id"), F.max("n_shingles").alias("n_set")))
    out = sig.select("doc_id", "n_shingles").join(by_doc.select(F.col("doc_id").alias("_d"), "component_id"), F.col("doc_id") == F.col("_d"), "left").drop("_d")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def kept_rows(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILARITY_PCT) -> DataFrame:
    """The rows of ``docs`` whose document stays."""
    gone = near_duplicates(docs, size, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return nested(docs).join(written(gone, "gone").withColumnRenamed("doc_id", "_gone"), F.col("_row.doc_id") == F.col("_gone"), "left_anti").select("_row.*")
