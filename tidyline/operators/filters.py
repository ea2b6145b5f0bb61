"""Filters and predicates (D1–D8) as columns and DataFrame splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T


def by_flag(df: DataFrame, flag: str, value: int = 1, keep_nulls: bool = False) -> DataFrame:
    """``flag == value``; with ``keep_nulls`` the "!= 1" form that keeps
    NULL flags (``NOT (flag <=> 1)``)."""
    if keep_nulls:
        return df.filter(~F.col(flag).eqNullSafe(value))
    return df.filter(F.col(flag) == value)


def split_by_flag(df: DataFrame, flag: str):
    """(flag = 1 rows, the rest incl. NULL flags)."""
    return by_flag(df, flag, 1), by_flag(df, flag, 1, keep_nulls=True)


def ratio_threshold(text, cls: str = "upper_ko", num_den=P.RATIO_THRESHOLD) -> Column:
    """round(ratio, 4) >= .09, exactly (integers)."""
    return T.ratio_at_least(T.class_count(text, cls), F.length(T.col(text)), *num_den)


def special_or_lower(text) -> Column:
    """A special character was removed, or the lower-case ratio >= .1."""
    t = T.col(text)
    return (T.removed_length(t) != 0) | T.ratio_at_least(T.class_count(t, "lower"), F.length(t), *P.LOWER_THRESHOLD)


def special_or_any_lower(text, legacy: bool = True) -> Column:
    """After the tag strip (C1), a special character was removed (older
    set with ＋), or any lower-case letter is left."""
    s = T.strip_tags(text, legacy=True)
    return (T.removed_length(s, legacy=legacy) != 0) | (F.coalesce(T.class_count(T.remove_special(s, legacy), "lower"), F.lit(0)) > 0)


def bad_output(out, src, min_len: int = 8, sentinel: str = P.MISSING_TITLE) -> Column:
    """Model output of at most ``min_len`` characters, or a source text
    equal to the sentinel."""
    return (T.text_length(out) <= min_len) | F.coalesce(T.col(src) == sentinel, F.lit(False))


def split_bad_output(df: DataFrame, out: str, src: str, min_len: int = 8, sentinel: str = P.MISSING_TITLE):
    """(kept rows, bad rows)."""
    flagged = df.withColumn("_bad", bad_output(out, src, min_len, sentinel))
    return flagged.filter(~F.col("_bad")).drop("_bad"), flagged.filter(F.col("_bad")).drop("_bad")
