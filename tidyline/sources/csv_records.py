"""CSV records with quoted newlines, read by byte ranges (A1–A4).

Spark's ``multiLine`` reader takes a whole file in one task.  Here a file is read
as lines by as many tasks as it has ranges.  Whether a line begins a record
depends on all quotes before it; but a line only maps the state before it
(outside or inside of quotes) to the state after it, and such maps can be
composed in any grouping.  So:

1. each range composes the maps of its lines (only lines with a quote matter)
   into one map, a single row;
2. the maps of a file's ranges are composed in order (a row a range), which gives
   the state at the start of each range;
3. each range is read again with its state known: records inside a range are
   whole, and at most two pieces of a range belong to records that cross its
   ends; only these pieces are shuffled and joined.

The text itself is never shuffled.  Both passes run at once and under the same
range size, so that their ranges are the same; a range that the first pass did
not see fails the read.

As in RFC 4180 a quote is doubled inside quotes; a quote inside an unquoted field
is a plain character.  Records end in ``\\n`` or ``\\r\\n``; empty ones are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidyline.session import sized

# Whole fields, each with its comma; then an opening quote whose field does not end.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
OPENS = rf'(?s)^{_FIELDS}"{_QUOTED}$'
STAYS = rf"(?s)^{_QUOTED}$"
REOPENS = rf'(?s)^{_QUOTED}"[^,]*+,{_FIELDS}"{_QUOTED}$'

#: What a line without a quote does, and the others: the states after it, from outside and from inside.
KEEP, CLOSE, OPEN, SWAP = 0, 1, 2, 3
#: Pieces of records: whole, open at the range's end, the end of an earlier one, a whole range within one.
WHOLE, TAIL, HEAD, MIDDLE = 0, 1, 2, 3


@contextmanager
def _ranges(spark: SparkSession, least: int | None):
    """Within it, files are cut into about ``least`` ranges or more."""
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n, None) for n in names}
    try:
        if least:
            for n, v in zip(names, (least, 1), strict=True):
                spark.conf.set(n, str(v))
        yield
    finally:
        for n, v in old.items():
            spark.conf.set(n, v) if v else spark.conf.unset(n)


def line_effect(line: Column) -> Column:
    """How a line changes the state: KEEP, CLOSE (outside after it), OPEN (inside), SWAP."""
    out_opens = line.rlike(OPENS)
    in_stays = line.rlike(STAYS) | line.rlike(REOPENS)
    effect = (F.when(out_opens & in_stays, OPEN).when(out_opens, SWAP).when(in_stays, KEEP).otherwise(CLOSE))
    return F.when(F.contains(line, F.lit('"')), effect).otherwise(KEEP).cast("tinyint")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of their range: file, block (the range's first byte), line, effect."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.col("value").alias("line"), line_effect(F.col("value")).alias("effect"))


def _blocks_of(batch: pa.RecordBatch) -> list[tuple[tuple[str, int], int, int]]:
    """((file, block), first row, end) of the runs of one range within a batch."""
    n = batch.num_rows
    if not n:
        return []
    file, block = batch.column("file"), batch.column("block")
    new = np.zeros(n, bool)
    new[0] = True
    if n > 1:
        for c in (file, block):
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    return [((file[int(s)].as_py(), block[int(s)].as_py()), int(s), int(e)) for s, e in zip(starts, ends, strict=True)]


def _after(effects: np.ndarray, before: int) -> np.ndarray:
    """The state (0 outside, 1 inside) after each line."""
    n = len(effects)
    fixed = np.where((effects == CLOSE) | (effects == OPEN), np.arange(n), -1)
    last = np.maximum.accumulate(fixed)  # the last line that sets the state
    swaps = np.cumsum(effects == SWAP)
    base = np.where(last >= 0, (effects[last] == OPEN).astype(np.int64), before)
    return (base + swaps - np.where(last >= 0, swaps[last], 0)) % 2


def _range_effects(lines: DataFrame) -> DataFrame:
    """One row per range: from_out and from_in, the states that its lines lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends = None, [0, 1]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([ends[0]], pa.int8()), pa.array([ends[1]], pa.int8())],
                                              names=["file", "block", "from_out", "from_in"])

        for batch in batches:
            for key, s, e in _blocks_of(batch):
                if key != at:
                    if at is not None:
                        yield out()
                    at, ends = key, [0, 1]
                effects = batch.column("effect").slice(s, e - s).to_numpy(zero_copy_only=False)
                ends = [int(_after(effects, b)[-1]) for b in ends]
        if at is not None:
            yield out()

    return lines.select("file", "block", "effect").mapInArrow(run, "file string, block long, from_out byte, from_in byte")


def _range_starts(ranges: DataFrame) -> DataFrame:
    """file, block, inside: the state at the start of each range, by composing the
    maps of the earlier ranges of its file (a row a range)."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("from_out") == F.col("from_in")
    # the last range that sets the state, and the swaps after it
    marked = ranges.withColumns({"_set": F.when(constant, F.struct("block", F.col("from_out").alias("state"))),
                                 "_swap": (~constant & (F.col("from_out") == 1)).cast("int")})
    seen = marked.withColumns({"_last": F.last("_set", ignorenulls=True).over(earlier), "_swaps": F.coalesce(F.sum("_swap").over(earlier), F.lit(0))})
    at_last = F.coalesce(F.last(F.when(constant, F.col("_upto")), ignorenulls=True).over(earlier), F.lit(0))
    upto = seen.withColumn("_upto", F.sum("_swap").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
    state = (F.coalesce(F.col("_last.state"), F.lit(0)) + F.col("_swaps") - F.col("_at")) % 2
    return upto.withColumn("_at", at_last).select("file", "block", (state == 1).alias("inside"))


def _pieces(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """file, block, kind, first, piece: whole records and the pieces at the ends of
    ranges.  ``first`` marks what begins with the first line of a file."""
    known = starts.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "inside")
    # the order within a range is kept where Spark sends the small side to all tasks, and restored where it shuffles
    seen = lines.withColumn("nth", F.monotonically_increasing_id()).join(
        known, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")), "left")
    inside = F.coalesce("inside", F.raise_error(F.lit("the ranges of the files changed while they were read")).cast("boolean"))
    seen = seen.select("file", "block", "line", "effect", "nth", inside.cast("byte").alias("inside")).sortWithinPartitions("file", "block", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, held, kind, first = None, 0, [], WHOLE, False
        cols: tuple[list, ...] = ([], [], [], [], [])

        def add(kind: int, piece: str) -> None:
            for c, v in zip(cols, (*at, kind, first, piece), strict=True):
                c.append(v)

        def end() -> None:
            if held:  # the range ends within a record
                add(MIDDLE if kind == HEAD else TAIL, "\n".join(held))

        def out() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int8(), pa.bool_(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["file", "block", "kind", "first", "piece"])
            for c in cols:
                c.clear()
            return made

        def plain(key: tuple[str, int], lines: pa.Array) -> pa.RecordBatch:
            n = len(lines)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array([WHOLE] * n, pa.int8()),
                                               pa.array([False] * n), lines], names=["file", "block", "kind", "first", "piece"])

        for batch in batches:
            for key, s, e in _blocks_of(batch):
                if key != at:
                    if at is not None:
                        end()
                    at, state, held = key, batch.column("inside")[s].as_py(), []
                    kind, first = (HEAD if state else WHOLE), key[1] == 0
                effects = batch.column("effect").slice(s, e - s).to_numpy(zero_copy_only=False)
                if not (effects.any() or state or first):  # each line is a record
                    yield plain(key, batch.column("line").slice(s, e - s))
                    continue
                after = _after(effects, state)
                for line, inside_after in zip(batch.column("line").slice(s, e - s).to_pylist(), after.tolist(), strict=True):
                    held.append(line)
                    if not inside_after:
                        add(kind, "\n".join(held) if len(held) > 1 else line)
                        held, kind, first = [], WHOLE, False
                state = int(after[-1])
            if cols[0]:
                yield out()
        if at is not None:
            end()
        if cols[0]:
            yield out()

    return seen.drop("nth").mapInArrow(run, "file string, block long, kind byte, first boolean, piece string")


def _stitched(pieces: DataFrame) -> DataFrame:
    """first, record of the records that cross ranges: a tail, the ranges within
    the record, and the head that ends it.  A file has two pieces a range at most."""
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("kind") == TAIL, 1).otherwise(0))
    parts = pieces.filter(F.col("kind") != WHOLE).withColumn("_record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "piece"))), lambda p: p["piece"]), "\n")
    return parts.groupBy("file", "_record").agg(F.max("first").alias("first"), joined.alias("record")).select("first", "record")


def read_records(spark: SparkSession, path: str, ranges: int | None = None) -> DataFrame:
    """first, record: the records of the CSV files at ``path``, as text; ``first``
    marks each file's first one.  The files are read twice (quotes, then records),
    at once, and the records are kept in the shared folder.  Files are cut as the
    session's settings say, or into ``ranges`` ranges at least."""
    with _ranges(spark, ranges):
        starts = _range_starts(sized(_range_effects(_lines(spark, path))))
        pieces = sized(_pieces(_lines(spark, path), starts))
    whole = pieces.filter(F.col("kind") == WHOLE).select("first", F.col("piece").alias("record"))
    records = whole.unionByName(_stitched(pieces))
    bare = F.regexp_replace(F.when(F.col("first"), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record")), "\r$", "")
    return records.select("first", bare.alias("record")).filter(F.col("record") != "")
