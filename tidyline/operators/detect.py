"""The noise-detection cascade (F1–F6) and character frequencies.

The reference runs six rules one after the other, each on the rows the
earlier ones left.  Here the cascade is one projection: a ``CASE WHEN`` in
rule order gives the same "first rule that fires" stage per row, in a single
map-only pass.  The only data-dependent input, the set of frequent special
characters, is one global aggregate whose result is a single row and is
broadcast back (no collect to the driver).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.operators.filters import special_or_lower

HANJA_RE = P.PROFILES["hanja"]


def char_frequency(df: DataFrame, text: str, cls: str = "special_ko", min_count: int = 0) -> DataFrame:
    """E5: (ch, n) for every character of a class over all texts.

    The class is extracted per row before exploding, so only matching
    characters are shuffled, and the count is partially aggregated map-side."""
    if cls in P.RANGES and P.RANGES[cls][0]:
        # delete the allowed characters; what is left is the class
        left = F.translate(F.col(text), P.range_chars(P.RANGES[cls][1]), "")
        chars = F.filter(F.split(left, ""), lambda ch: ch != "")
    else:
        chars = F.regexp_extract_all(F.col(text), F.lit(f"({P.profile(cls)})"), F.lit(1))
    out = df.select(F.explode(chars).alias("ch")).groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
    if min_count:
        out = out.filter(F.col("n") >= min_count)
    return out


def char_set(freq: DataFrame) -> DataFrame:
    """One row ``chars``: the characters of a frequency table, sorted, as one
    string.  Its size is bounded by the number of distinct characters."""
    return freq.agg(F.array_join(F.array_sort(F.collect_list("ch")), "").alias("chars"))


def without_hanja(c) -> Column:
    """Remove every Hanja.  The reference removes "all Hanja seen in the
    data", which on the same data is every Hanja."""
    return F.translate(T.col(c), P.range_chars(P.RANGES["hanja"][1]), "")


def frequent_specials(df: DataFrame, text: str, cls: str = "special_ko",
                      min_count: int = P.FREQUENT_MIN_COUNT) -> DataFrame:
    """The one-row set of special characters seen at least ``min_count``
    times after Hanja removal (freeze it as a table to score new data)."""
    base = df.select(without_hanja(text).alias("_t"))
    return char_set(char_frequency(base, "_t", cls, min_count))


def remove_frequent(df: DataFrame, text: str, chars: DataFrame, out: str = "filtered_text") -> DataFrame:
    """Delete a data-derived character set.  ``chars`` has one row, so
    the broadcast nested-loop join is a per-row constant, not a cross product."""
    return (df.crossJoin(F.broadcast(chars.select(F.col("chars").alias("_chars"))))
              .withColumn(out, T.remove_chars(text, F.col("_chars"))).drop("_chars"))


def rule_columns(text: str, filtered: str, folded: str | None = None) -> dict[str, Column]:
    """The six rule predicates of F1 (NULL text fires none).  ``folded`` names
    a column that holds ``T.fold_scripts(filtered)`` already."""
    f = F.col(filtered)
    raw = F.col(text)
    n_f = F.length(f)
    fold = F.col(folded) if folded else None
    return {
        "morph_v1": T.tag_rule_v1_text(f, fold),
        "morph_v2": T.tag_rule_v2_text(f, folded=fold),
        "sandwich": T.has_sandwich_text(f),
        "ratio": T.ratio_at_least(T.class_count(f, "upper_ko"), n_f, *P.RATIO_THRESHOLD),
        "consecutive": T.has_special_run(T.remove_trend_marks(raw)),
        "special": special_or_lower(raw),
    }


def stage_column(text: str, filtered: str, folded: str | None = None) -> Column:
    rules = rule_columns(text, filtered, folded)
    expr = None
    for name in P.STAGES[:-1]:
        cond = F.coalesce(rules[name], F.lit(False))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("not_noise")


def detect_noise(df: DataFrame, text: str = "text", cls: str = "special_ko",
                 frequent: DataFrame | None = None, min_count: int = P.FREQUENT_MIN_COUNT,
                 keep_filtered: bool = False) -> DataFrame:
    """add ``stage`` (first rule that fires, or ``not_noise``) and
    ``is_noise``.  ``frequent`` is a one-row ``chars`` frame; by default it is
    computed from ``df`` itself (one extra aggregate job)."""
    if frequent is None:
        frequent = frequent_specials(df, text, cls, min_count)
    with_f = df.withColumn("_h", without_hanja(text))
    with_f = remove_frequent(with_f, "_h", frequent, "filtered_text").drop("_h")
    # the folded text is a column of its own, so that the tag rules compute it once
    out = with_f.withColumn("_fold", T.fold_scripts("filtered_text")) \
                .withColumn("stage", stage_column(text, "filtered_text", "_fold")).drop("_fold") \
                .withColumn("is_noise", (F.col("stage") != "not_noise").cast("int"))
    return out if keep_filtered else out.drop("filtered_text")


def rule_hits(flagged: DataFrame) -> DataFrame:
    """the rows some rule took."""
    return flagged.filter(F.col("stage") != "not_noise")


def stage_counts(flagged: DataFrame) -> DataFrame:
    """rows per stage."""
    return flagged.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


def prediction_summary(flagged: DataFrame, flag: str = "is_noise") -> DataFrame:
    """total, noise, normal."""
    return flagged.agg(F.count(F.lit(1)).alias("total"),
                       F.sum(F.when(F.col(flag) == 1, 1).otherwise(0)).alias("noise"),
                       F.sum(F.when(F.col(flag) == 1, 0).otherwise(1)).alias("normal"))


def assemble_flag(flagged: DataFrame, model_hits: DataFrame, key: str, flag: str = "is_noise") -> DataFrame:
    """rule hits and model hits -> ``flag`` 1, the rest 0; adds ``model_hit``."""
    hits = model_hits.select(key).distinct().withColumn("model_hit", F.lit(1))
    return (flagged.join(hits, key, "left").withColumn("model_hit", F.coalesce("model_hit", F.lit(0)))
                   .withColumn(flag, F.when((F.col(flag) == 1) | (F.col("model_hit") == 1), 1).otherwise(0)))
