"""Spelling variants of the words of a corpus, by permuterm rotations.

A word is marked with a terminator, and each of its rotations is a key.  For a
word ``acb`` the rotation that ends in ``c`` is ``b$ac``: all words that have
another character in that place share its prefix ``b$a``, and a word without the
character has ``b$a`` as a whole rotation.  Rotations are sorted by that prefix,
the edited character skipped; one scan over the sorted groups gives every pair of
words that differ by one replaced, inserted or deleted code point, and each pair
only once: of equal neighbouring characters only the first counts as inserted.
A group holds at most one word per character of the alphabet and one without it,
and each member gives one row (its number of neighbours there and the best one),
so that nothing grows with the square of a group.

A word's ``form`` is its most frequent near word (ties: the smallest), if that is
at least ``ratio`` times as frequent; ``root`` is the end of the chain of forms.
Forms grow by ``ratio`` at each step, so chains are short and have no circles.

Defined cases: a null text has no words and a null doc_id counts as an empty
one; whole texts of any length are read; repeated rows count each; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import written

LETTERS = r"[A-Za-zÀ-ÿ]"
END = "$"
MIN_LENGTH, MIN_COUNT, RATIO, ONE_IN = 7, 2, 10, 31
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Words that a task holds before it sends their counts on.
HELD = 300_000


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """word, n: runs of letters, A-Z lowered, at least ``min_length`` long; one in
    ``one_in`` (by a checksum of doc_id and run) loses a letter first.  A task adds
    up counts before the shuffle."""
    runs = re.compile(LETTERS + f"{{{min_length},}}")  # a shorter run gives no word that is long enough

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                before = zlib.crc32(f"{'' if d is None else d}:".encode())
                for w, n in Counter(runs.findall(t.as_py() or "")).items():
                    w = w.lower() if w.isascii() else w.translate(LOWER)
                    h = zlib.crc32(w.encode(), before)
                    if h % one_in == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1:]
                        if len(w) < min_length:
                            continue
                    held[w] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    words = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """key, edited, n: for each place of a word, the rotation up to that place
    with the character there skipped (``edited``), and for each gap the whole
    rotation (``edited`` empty).  The word is what the key says, cut at the
    terminator, with ``edited`` between its parts."""
    w, n = F.col("word"), F.length("word")

    def key(after: Column, before: Column) -> Column:
        # the rest of the word, the terminator, and its beginning
        return F.concat(F.substr(w, after + 1), F.lit(END), F.substr(w, F.lit(1), before))

    places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(key(i + 1, i).alias("key"), F.substr(w, i + 1, F.lit(1)).alias("edited")))
    gaps = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(key(i, i).alias("key"), F.lit("").alias("edited")))
    return words.select(F.explode(F.concat(places, gaps)).alias("r"), "n").select("r.key", "r.edited", "n")


def scan_group(key: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, neighbours, count of the best one, the best one) of the words of one
    key.  ``members`` are (edited, n), at most one of them with nothing edited."""
    after, before = key.split(END)
    ranked = sorted((-n, before + c + after, c) for c, n in members if c)
    whole = next((n for c, n in members if not c), None)
    plain = before + after
    for n, word, c in ranked:
        other = next((r for r in ranked[:2] if r[1] != word), None)
        near, best = len(ranked) - 1, other[:2] if other else None
        if whole is not None and before[-1:] != c:
            near += 1
            best = min(best, (-whole, plain)) if best else (-whole, plain)
        if best:
            yield word, near, -best[0], best[1]
    if whole is not None:
        longer = [r for r in ranked if r[2] != before[-1:]]
        if longer:
            yield plain, len(longer), -longer[0][0], longer[0][1]


def scan(rows: DataFrame) -> DataFrame:
    """word, n_near, near_n, near: one row per word and key with neighbours.
    ``rows`` come sorted by key within their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None  # the last group may go on in the next batch; it holds one row a character
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([carry, t]) if carry is not None else t
            keys = t.column("key").combine_chunks()
            n = len(keys)
            if n < 2:
                carry = t
                continue
            same = pc.equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            ends = (~same).nonzero()[0]  # the last row of each group but the last
            cut = int(ends[-1]) + 1 if len(ends) else 0
            carry = t.slice(cut)
            if cut:
                yield groups(t.slice(0, cut), same[:cut - 1])
        if carry is not None and len(carry) > 1:
            yield groups(carry, None)

    def groups(t: pa.Table, same) -> pa.RecordBatch:
        """Scan whole groups; ``same`` tells for each row whether the next one has its key (None: all have)."""
        out: tuple[list, ...] = ([], [], [], [])
        if same is None:
            spans = [(0, len(t))]
        else:
            joined = same.nonzero()[0]
            starts = [int(i) for i in joined if i == 0 or not same[i - 1]]
            spans = []
            for s in starts:
                e = s + 1
                while e < len(t) and same[e - 1]:
                    e += 1
                spans.append((s, e))
        index = pa.array([i for s, e in spans for i in range(s, e)], pa.int64())
        part = t.take(index)
        keys, edited, n = (part.column(c).to_pylist() for c in ("key", "edited", "n"))
        at = 0
        for s, e in spans:
            size = e - s
            for row in scan_group(keys[at], list(zip(edited[at:at + size], n[at:at + size], strict=True))):
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            at += size
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["word", "n_near", "near_n", "near"])

    return rows.mapInArrow(run, "word string, n_near long, near_n long, near string")


def nearest(words: DataFrame) -> DataFrame:
    """word, n, n_near (near words) and the best of them, ``near`` with ``near_n``
    (null where there is none).  ``words`` holds each word once."""
    found = scan(rotations(words).repartition("key").sortWithinPartitions("key"))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of a table (word, form) without circles: each round doubles the
    length of the chains that are followed."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if on.join(at, "root", "left_semi").isEmpty():
            return at
        at = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, one_in: int = ONE_IN) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = written(count_words(docs, min_length, min_count, one_in), "spelling-words")
    wins = F.col("near_n") >= ratio * F.col("n")
    near = written(nearest(words).select("word", "n", "n_near", F.when(wins, F.col("near")).alias("form"), F.when(wins, F.col("near_n")).alias("form_n")), "spelling-near")
    ends = roots(near.filter("form is not null"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
