"""Repeated lines and paragraphs across all documents.

Units are normalised (ASCII letters lowered, white space runs as one blank) and
their 128-bit digests are counted globally; of equal units the earliest, by
doc_id and place, stays and the rest go.  Lines are held against lines and
paragraphs (cut at empty lines) against paragraphs, so a paragraph that was
wrapped anew is found too.  Every unit with at least one word counts.  Offsets are
those of the input, in code points.

Units are cut and hashed once and written.  A digest's first holder is found by an
aggregation that combines before the shuffle; only digests with several holders
are joined back to their units, frequent ones by sending them to all tasks
(:func:`tidyline.llm.common.join_counted`).  Texts meet only the places to remove.

Defined cases: a null text counts as empty; rows with a null doc_id come after
all others and lose to them; rows of one doc_id are told apart and ranked by the
digest of their text; of equal rows one keeps what is the earliest and the others
lose all their units; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyline.llm.common import join_counted, row_digest, written

MIN_WORDS = 1
SEPARATORS = {"line": "\n", "paragraph": "\n\n"}
BOTH = ("line", "paragraph")


def units_of(text: str, kinds: tuple[str, ...], min_words: int) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(kind, number, start, end, digest) of the units of enough words."""
    for kind in kinds:
        sep, at = SEPARATORS[kind], 0
        for k, part in enumerate(text.split(sep)):
            words = part.encode("utf-8", "replace").lower().split()
            if len(words) >= min_words:
                yield kind, k, at, at + len(part), hashlib.md5(kind[0].encode() + b" ".join(words)).digest()
            at += len(part) + len(sep)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, a digest of both: rows differ in it unless they are equal."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row_digest().alias("row"))


def unit_rows(docs: DataFrame, kinds: tuple[str, ...] = BOTH, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit of enough words: doc_id, row, kind, its number, start, end, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [], [])
            for d, t, r in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                for one in units_of(t.as_py() or "", kinds, min_words):
                    for c, v in zip(cols, (d, r, *one), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["doc_id", "row", "kind", "place", "start", "end", "digest"])

    return keyed(docs).mapInArrow(run, "doc_id long, row binary, kind string, place int, start int, end int, digest binary")


def repeated_units(docs: DataFrame, kinds: tuple[str, ...] = BOTH, min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: every occurrence but the earliest, with that one's
    doc_id.  Equal rows count as one here."""
    units = written(unit_rows(docs, kinds, min_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "place")
    first = written(units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1"), "unit-firsts")
    out = join_counted(units, first, ["digest"], units.count())
    same = (F.col("row") == F.col("first.row")) & (F.col("place") == F.col("first.place"))
    return out.filter(~same).select("doc_id", "row", "kind", "place", "start", "end", F.col("first.doc_id").alias("first_doc_id"))


def remove_repeats(docs: DataFrame, kinds: tuple[str, ...] = BOTH, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, the cleaned text, the units removed (kind, start and end in the input), the number of lines and of
    characters removed.  The separator after a unit goes with it."""
    gone = repeated_units(docs, kinds, min_words).groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("removed"))
    again = F.row_number().over(Window.partitionBy("row").orderBy("doc_id")) > 1  # a row equal to one before it
    both = keyed(docs).join(gone, "row", "left").select("doc_id", "text", "removed", again.alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, spans, sizes = [], [], [], []
            for t, removed, copy in zip(batch.column(1), *(batch.column(c).to_pylist() for c in (2, 3)), strict=True):
                s = t.as_py() or ""
                if copy:
                    removed = sorted(({"start": a, "end": b, "kind": k} for k, _, a, b, _ in units_of(s, kinds, min_words)),
                                     key=lambda r: (r["start"], r["end"], r["kind"])) or None
                out, at = [], 0
                for r in removed or ():  # in order of their starts
                    end = min(r["end"] + len(SEPARATORS[r["kind"]]), len(s))
                    if r["start"] > at:
                        out.append(s[at:r["start"]])
                    at = max(at, end)
                kept.append("".join([*out, s[at:]]))
                sizes.append(len(s) - len(kept[-1]))
                counts.append(s.count("\n") + 1 if s else 0)
                spans.append(removed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(spans, batch.schema.field(2).type), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["doc_id", "kept_text", "removed", "n_lines", "n_removed_chars"])

    return both.mapInArrow(run, "doc_id long, kept_text string, removed array<struct<start: int, end: int, kind: string>>, n_lines long, n_removed_chars long")


def digest(docs: DataFrame) -> DataFrame:
    n = F.coalesce(F.size("removed"), F.lit(0))
    said = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["kind"], r["start"], r["end"])), ",")
    return remove_repeats(docs).select(
        "doc_id", F.col("n_lines").alias("n_units"), F.when(n > 0, n).otherwise(0).cast("long").alias("n_removed"), "n_removed_chars",
        F.coalesce(said, F.lit("")).alias("removed_spans"), F.sha2("kept_text", 256).alias("kept_sha256"), "kept_text")


def _units_sql(kind: str, sep: str, size: int) -> str:
    """Units of a kind: text, number, start and words."""
    return rf"""
SELECT doc_id, '{kind}' AS kind, i, n, unit, start, length(unit) AS len, regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
FROM (SELECT *, coalesce(sum(length(unit) + {size}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM (SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS i, len(u) AS n FROM (SELECT doc_id, string_split(coalesce(text, ''), {sep}) AS u FROM documents)))"""


ORACLE = f"""
WITH u AS ({_units_sql('line', 'chr(10)', 1)} UNION ALL {_units_sql('paragraph', 'chr(10) || chr(10)', 2)}),
r AS (
  SELECT *, len(words) >= {MIN_WORDS} AND row_number() OVER (PARTITION BY kind, array_to_string(words, ' ') ORDER BY doc_id, i) > 1 AS gone FROM u),
p AS (SELECT doc_id, start, start + len + 2 AS upto FROM r WHERE gone AND kind = 'paragraph'),
l AS (  -- a line goes by itself or with a paragraph that it begins in
  SELECT r.doc_id, r.i, r.n, unit || CASE WHEN r.i < r.n THEN chr(10) ELSE '' END AS piece,
    gone OR EXISTS (SELECT 1 FROM p WHERE p.doc_id = r.doc_id AND p.start <= r.start AND r.start < p.upto) AS gone FROM r WHERE kind = 'line'),
t AS (
  SELECT doc_id, any_value(n) AS n, coalesce(string_agg(piece, '' ORDER BY i) FILTER (NOT gone), '') AS kept_text,
    sum(CASE WHEN gone THEN length(piece) ELSE 0 END)::BIGINT AS n_removed_chars, sum(length(piece)) AS n_chars FROM l GROUP BY doc_id),
s AS (
  SELECT doc_id, count(*) FILTER (gone)::BIGINT AS n_removed,
    coalesce(string_agg(kind || ':' || start || ':' || (start + len), ',' ORDER BY start, start + len, kind) FILTER (gone), '') AS removed_spans FROM r GROUP BY doc_id)
SELECT doc_id, CASE WHEN n_chars = 0 THEN 0 ELSE n END::BIGINT AS n_units, n_removed, n_removed_chars, removed_spans, sha256(kept_text) AS kept_sha256, kept_text
FROM t JOIN s USING (doc_id)"""
