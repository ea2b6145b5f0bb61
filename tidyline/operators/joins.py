"""Keyed joins and set operations.

The reference aligns frames by row position in several places; here every
operator joins on an explicit key column.  Spark picks broadcast or
sort-merge per join from sizes (AQE re-plans at runtime)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_by_key(upd: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row per key; a duplicated key fails the job (in plan, no collect).
    The aggregate is partitioned by ``key``, which the following join reuses."""
    aggs = [F.count(F.lit(1)).alias("_dup")] + [F.first(c, ignorenulls=False).alias(c) for c in cols]
    g = upd.groupBy(key).agg(*aggs)
    # one CASE in the filter, so the check cannot be pruned or reordered away
    check = F.when(F.col("_dup") > 1, F.raise_error(F.concat(F.lit("duplicate key in update: "),
                                                             F.col(key).cast("string"))).cast("boolean")
                   ).otherwise(F.lit(True))
    return g.filter(check).drop("_dup")


def update_by_key(base: DataFrame, upd: DataFrame, key: str, column: str) -> DataFrame:
    """G1: rows whose key is in ``upd`` take its value, even NULL; others keep."""
    u = unique_by_key(upd.select(key, column), key, [column]).select(
        key, F.col(column).alias("_new"), F.lit(True).alias("_matched"))
    j = base.join(u, key, "left")
    return (j.withColumn(column, F.when(F.col("_matched"), F.col("_new")).otherwise(F.col(column)))
             .drop("_new", "_matched"))


def recover_labels(base: DataFrame, upd: DataFrame, key: str, column: str) -> DataFrame:
    """Left join; a NULL update keeps the old value; duplicates fan out."""
    u = upd.select(key, F.col(column).alias("_new"))
    return (base.join(u, key, "left")
                .withColumn(column, F.coalesce(F.col("_new"), F.col(column))).drop("_new"))


def label_diff(before: DataFrame, after: DataFrame, key: str, text: str, column: str) -> DataFrame:
    """Inner join on (key, text) with NULL-safe text equality; rows whose
    value differs (NULL on either side counts as different)."""
    a = before.select(key, text, F.col(column).alias(f"{column}_before"))
    b = after.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(column).alias(f"{column}_after"))
    j = a.join(b, (F.col(key) == F.col("_k")) & F.col(text).eqNullSafe(F.col("_t")), "inner").drop("_k", "_t")
    same = F.col(f"{column}_before") == F.col(f"{column}_after")
    return j.filter(~F.coalesce(same, F.lit(False)))


def compare_labels(new: DataFrame, old: DataFrame, key: str, prev: str = "target",
                   cur: str = "target") -> DataFrame:
    """``new`` plus ``prev_target`` and ``is_changed`` (NULLs count as
    changed); the count of changes is ``changed_count``."""
    o = unique_by_key(old.select(key, prev), key, [prev]).select(key, F.col(prev).alias("prev_target"))
    j = new.join(o, key, "left")
    same = F.coalesce(F.col(cur) == F.col("prev_target"), F.lit(False))
    return j.withColumn("is_changed", F.when(same, 0).otherwise(1))


def changed_count(flags: DataFrame) -> DataFrame:
    """E10."""
    return flags.agg(F.coalesce(F.sum("is_changed"), F.lit(0)).alias("changed"))


def having_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Semi join."""
    return df.join(keys.select(key), key, "left_semi")


def without_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Anti join (drop a bad set, or skip rows already done)."""
    return df.join(keys.select(key), key, "left_anti")


def attach(df: DataFrame, preds: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Predictions carry the key; attach by join, never by position."""
    return df.join(preds.select(key, *cols), key, "left")


def union_all(*dfs: DataFrame) -> DataFrame:
    """K1: stack frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_missing(*dfs: DataFrame) -> DataFrame:
    """K2: stack frames; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def replace_or_add(base: DataFrame, new: DataFrame, key: str, column: str, replace: bool) -> DataFrame:
    """K3: replace ``column`` by key (G1) or append the new rows (K2)."""
    return update_by_key(base, new, key, column) if replace else union_missing(base, new)


def recombine(clean: DataFrame, fixed: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """K5: clean rows plus fixed noisy rows, whitespace normalised, 3 columns."""
    from tidyline.functions.text import collapse_ws
    return (union_all(clean.select(key, text, label), fixed.select(key, text, label))
            .withColumn(text, collapse_ws(text)))
