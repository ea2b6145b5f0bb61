"""Splits, samples, orders.

Exact per-label ranks without a window over a whole label: a window
partitioned by the label alone puts each class in one task, and a class can
hold a third of all rows.  Instead each row gets a 32-bit hash draw; rows are
counted per (label, high 16 bits of the draw), the small count table gives
each bucket its offset inside the label, and the exact rank is that offset
plus a row number inside the (label, bucket) partition.  The rank equals
``row_number() OVER (PARTITION BY label ORDER BY draw, key) - 1``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyline.functions.draws import hash32
from tidyline.session import sized

BUCKET_BITS = 16


def with_draw(df: DataFrame, key: str, seed: int, name: str = "_h") -> DataFrame:
    return df.withColumn(name, hash32(key, seed))


def label_rank(df: DataFrame, key: str, label: str | None, seed: int,
               bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Adds ``_h`` (draw), ``_rank`` (0-based exact rank in the label by
    (draw, key)) and ``_n`` (label size).  ``key`` names each row once; rows
    whose label is NULL are ranked as one more label."""
    lab = F.col(label) if label else F.lit(0)
    # only keys and labels are ranked; other columns meet the rank by key
    d = with_draw(df.select(F.col(key).alias("_key"), lab.alias("_lab")), "_key", seed) \
        .withColumn("_b", F.shiftright(F.col("_h"), 32 - bucket_bits))
    counts = d.groupBy("_lab", "_b").agg(F.count(F.lit(1)).alias("_c"))
    wl = Window.partitionBy("_lab").orderBy("_b")
    offs = (counts.withColumn("_off", F.coalesce(F.sum("_c").over(
                wl.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                  .withColumn("_n", F.sum("_c").over(Window.partitionBy("_lab")))
                  .drop("_c"))
    # a NULL label is a group of its own
    offs = offs.withColumnsRenamed({"_lab": "_lab2", "_b": "_b2"})
    j = d.join(offs, F.col("_lab").eqNullSafe(F.col("_lab2")) & F.col("_b").eqNullSafe(F.col("_b2")), "inner")
    wb = Window.partitionBy("_lab", "_b").orderBy("_h", "_key")
    ranked = j.withColumn("_rank", F.col("_off") + F.row_number().over(wb) - 1)
    if set(df.columns) <= {key, label}:
        return ranked.select(*[F.col("_key" if c == key else "_lab").alias(c) for c in df.columns], "_h", "_rank", "_n")
    ranked = ranked.select("_key", "_h", "_rank", "_n")
    return df.join(ranked, F.col(key).eqNullSafe(F.col("_key")), "inner").drop("_key")


def quota(n, frac: float, den: int = 10000):
    """round(n * frac) half up, in integers."""
    num = int(round(frac * den))
    return F.floor((n * (2 * num) + den) / (2 * den)).cast("bigint")


def split_flag(df: DataFrame, key: str, frac: float, seed: int, by: str | None = None,
               name: str = "is_valid") -> DataFrame:
    """``is_valid`` = 1 for round(n·frac) rows per label (or overall), by draw."""
    r = label_rank(df, key, by, seed)
    return (r.withColumn(name, (F.col("_rank") < quota(F.col("_n"), frac)).cast("int"))
             .drop("_h", "_rank", "_n"))


def split(df: DataFrame, key: str, frac: float, seed: int, by: str | None = None):
    """(train, valid)."""
    f = split_flag(df, key, frac, seed, by)
    return f.filter("is_valid = 0").drop("is_valid"), f.filter("is_valid = 1").drop("is_valid")


def kfold(df: DataFrame, key: str, k: int, seed: int, by: str | None = None) -> DataFrame:
    """Stratified fold = exact rank in the label mod k."""
    r = label_rank(df, key, by, seed)
    return r.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_h", "_rank", "_n")


def halves(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``half`` 0/1 by draw parity (map-only)."""
    return df.withColumn("half", (hash32(key, seed) % 2).cast("int"))


def sample_per_class(df: DataFrame, key: str, label: str, n: int, seed: int) -> DataFrame:
    """Up to n rows per label, without replacement, by draw.  The
    ``row_number() <= n`` filter is planned as a per-partition group limit
    before the shuffle, so only n rows per label and partition move."""
    w = Window.partitionBy(label).orderBy("_h", key)
    return (with_draw(df, key, seed).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n).drop("_h", "_rn"))


def top_k_longest(df: DataFrame, text: str, key: str, k: int) -> DataFrame:
    """Longest first (ties by key), k rows; k = 0 keeps all."""
    o = df.orderBy(F.desc(F.length(text)), F.col(key))
    return o.limit(k) if k else o


def head_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows by key."""
    return df.orderBy(key).limit(n)


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """I8: a seeded shuffle, for sinks."""
    return df.orderBy(hash32(key, seed), F.col(key))


def with_position(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """Adds the 0-based place of each row in the total order ``order`` (Columns that name each row once), as a
    sorted sink would give it.  Rows are dealt by ranges of the order and written with the number of their range; a row's
    place is the rows of the earlier ranges plus its number within its own, so no task holds the whole order."""
    dealt = sized(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = dealt.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    offsets = sized(sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before")))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (dealt.withColumn("_nth", nth).join(offsets, F.col("_part") == F.col("_p"))
                 .withColumn(name, F.col("_before") + F.col("_nth") - 1).drop("_part", "_p", "_nth", "_before"))


def number_within(df: DataFrame, key: str, label: str, seed: int = 0, name: str = "rn") -> DataFrame:
    """0-based running number within the label (exact, no global window)."""
    return label_rank(df, key, label, seed).withColumnRenamed("_rank", name).drop("_h", "_n")
