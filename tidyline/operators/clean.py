"""Rare-character denoising (C15, I11), re-aimed from subword-model training.

The reference trains a subword model on clean text with character coverage
0.9995 and round-trips noisy text through it; the visible effect is that
characters outside the covered set become `` ⁇ `` and whitespace is
normalised.  Here: character counts over the clean rows (counted within the
tasks), a cumulative share over the small distinct-character table, and one
pass that replaces every character outside the kept set."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyline.functions.bigrams import counted_chars
from tidyline.functions import text as T

UNKNOWN = " ⁇ "


def char_counts(df: DataFrame, text: str) -> DataFrame:
    """(ch, n) over every character of ``text``."""
    return counted_chars(df, text).groupBy("ch").agg(F.sum("n").cast("long").alias("n"))


def covered_chars(df: DataFrame, text: str, coverage: tuple[int, int] = (9995, 10000)) -> DataFrame:
    """Characters by count (desc, then character) kept while the share
    before them is below ``coverage``; (ch, n, keep)."""
    c = char_counts(df, text)
    w = Window.orderBy(F.desc("n"), F.col("ch"))  # one partition, but over distinct characters only
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return c.withColumn("keep", before * coverage[1] < total * coverage[0])


def kept_chars(covered: DataFrame) -> DataFrame:
    """One row ``_kept``: the kept characters as one string."""
    return covered.filter("keep").agg(F.array_join(F.array_sort(F.collect_list("ch")), "").alias("_kept"))


def mark_rare(text: Column, kept: Column) -> Column:
    """Characters of ``text`` outside ``kept`` -> `` ⁇ ``.  A row's rare characters all become its first one, which is
    then replaced, so no regex class of the kept set is tested at each character; ``translate`` cannot write U+0000,
    which goes last."""
    translate = partial(F.call_function, "translate")
    rare = translate(text, F.concat(kept, F.lit("\0")), F.lit(""))
    first = F.substring(rare, 1, 1)
    one = F.replace(translate(text, rare, F.call_function("repeat", first, F.length(rare))), first, F.lit(UNKNOWN))
    marked = F.when(F.length(rare) == 0, text).otherwise(one)
    return F.when(F.instr(kept, "\0") > 0, marked).otherwise(F.replace(marked, F.lit("\0"), F.lit(UNKNOWN)))


def rare_char_denoise(df: DataFrame, text: str, clean: DataFrame, clean_text: str | None = None,
                      coverage: tuple[int, int] = (9995, 10000)) -> DataFrame:
    """Characters not covered by the clean rows -> `` ⁇ ``, then
    whitespace normalised.  The kept-set row is broadcast (bounded by the
    number of distinct characters)."""
    j = df.crossJoin(F.broadcast(kept_chars(covered_chars(clean, clean_text or text, coverage))))
    marked = mark_rare(F.col(text), F.col("_kept"))
    return j.withColumn(text, T.collapse_ws(F.when(F.col("_kept") == "", F.col(text)).otherwise(marked))).drop("_kept")
