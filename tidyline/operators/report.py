"""Reports (E1–E11): distributions, noise buckets, transitions, metrics.

Every report is an aggregate whose output is small (labels, buckets, stages);
the big input is only scanned and partially aggregated map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.session import sized

# The constant reference distribution of the report (7 classes,
# share .1428 of 15,000 rows, i.e. 2,142 each).
REFERENCE_CLASSES = 7
REFERENCE_SHARE = 0.1428
REFERENCE_ROWS = 15000


def class_counts(df: DataFrame, label: str = "target") -> DataFrame:
    """Rows per label, with the total on every row."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))


def distribution_report(df: DataFrame, label: str = "target") -> DataFrame:
    """Count and share (4 digits) per label, number of classes, total, and
    the constant reference distribution.  Use :func:`json_report` for A7."""
    w = Window.partitionBy(F.lit(1))
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    ref_n = int(REFERENCE_SHARE * REFERENCE_ROWS)
    return (g.withColumn("total", F.sum("n").over(w))
             .withColumn("n_classes", F.count(F.lit(1)).over(w))
             .withColumn("share", F.round(F.col("n").cast("decimal(38,0)") / F.col("total"), 4).cast("decimal(10,4)"))
             .withColumn("ref_n", F.when(F.col(label).between(0, REFERENCE_CLASSES - 1), F.lit(ref_n)))
             .withColumn("ref_share", F.when(F.col(label).between(0, REFERENCE_CLASSES - 1),
                                             F.lit(REFERENCE_SHARE).cast("decimal(10,4)"))))


def json_report(df: DataFrame, label: str = "target") -> DataFrame:
    """A7 of E2: one JSON document: counts, shares, class count, total."""
    r = distribution_report(df, label)
    return r.agg(
        F.to_json(F.struct(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(label).cast("string").alias("key"), F.col("n").alias("value"))))).alias("counts"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(label).cast("string").alias("key"), F.col("share").cast("double").alias("value"))))).alias("shares"),
            F.max("n_classes").alias("n_classes"), F.max("total").alias("total"),
        )).alias("json"))


def with_bucket(df: DataFrame, text: str, cls: str = "special_ko",
                high_from: tuple[int, int] = P.BUCKET_NORM) -> DataFrame:
    """B1 + B4 as columns: ``noise_count``, ``n_chars``, ``bucket``."""
    return (df.withColumn("noise_count", F.coalesce(T.class_count(text, cls), F.lit(0)))
              .withColumn("n_chars", T.text_length(text))
              .withColumn("bucket", T.noise_bucket("noise_count", "n_chars", high_from)))


def noise_buckets(df: DataFrame, text: str, cls: str = "special_ko", by: str | None = None,
                  high_from: tuple[int, int] = P.BUCKET_NORM) -> DataFrame:
    """E3a (``by=None``) / E3b (per label): rows in low / norm / high."""
    b = with_bucket(df, text, cls, high_from)
    aggs = [F.count_if(F.col("bucket") == k).alias(k) for k in ("low", "norm", "high")]
    return b.groupBy(by).agg(*aggs) if by else b.agg(*aggs)


def bucket_rows(df: DataFrame, text: str, bucket: str | None, cls: str = "special_ko",
                label: str | None = None, value=None, key: str | None = None,
                high_from: tuple[int, int] = P.BUCKET_HIGH_LEGACY) -> DataFrame:
    """D3: rows of one bucket (or all), optionally one label, sorted by ratio."""
    b = with_bucket(df, text, cls, high_from).withColumn("ratio", T.char_ratio(text, cls))
    if bucket:
        b = b.filter(F.col("bucket") == bucket)
    if label is not None and value is not None:
        b = b.filter(F.col(label) == value)
    return b.orderBy("ratio", *( [key] if key else []))


def label_transitions(df: DataFrame, old: str = "target", new: str = "new_label") -> DataFrame:
    """(old, new, n) over changed rows."""
    return (df.filter(~F.col(old).eqNullSafe(F.col(new)))
              .groupBy(old, new).agg(F.count(F.lit(1)).alias("n")))


def class_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class (over the union of true and predicted classes): support,
    tp, fp, fn, precision, recall (= accuracy within the true class), f1;
    undefined ratios are 0."""
    t = df.select(F.col(label).alias("y"), F.col(pred).alias("p"))
    true_side = t.groupBy(F.col("y").alias("cls")).agg(
        F.count(F.lit(1)).alias("support"), F.count_if(F.col("y") == F.col("p")).alias("tp"))
    pred_side = t.groupBy(F.col("p").alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    m = true_side.join(pred_side, "cls", "full").na.fill(0, ["support", "tp", "n_pred"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    return (m.withColumn("fp", F.col("n_pred") - F.col("tp"))
              .withColumn("fn", F.col("support") - F.col("tp"))
              .withColumn("precision", prec).withColumn("recall", rec)
              .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                       2 * F.col("tp") / (F.col("support") + F.col("n_pred"))).otherwise(0.0))
              .drop("n_pred"))


def overall_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy and macro F1 (one row)."""
    acc = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))
    f1 = class_metrics(df, label, pred).agg(F.avg("f1").alias("macro_f1"))
    return acc.crossJoin(f1)


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def value_counts(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """(by, _v, _c, _b): how often each value occurs, NULL among them, in ranges of (label, value) with the number of the
    range, so that a hot label is split; written, so that all that reads it reads the table ``df`` once."""
    g = [by] if by else []
    counts = df.select(*g, F.col(value).cast("double").alias("_v")).groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return sized(counts.repartitionByRange(*g, "_v").withColumn("_b", F.spark_partition_id()))


def quantiles(df: DataFrame, value: str, by: str | None = None, probs: dict[str, float] = QUARTILES) -> DataFrame:
    """Exact quantiles by linear interpolation, one column per name."""
    return _quantiles(value_counts(df, value, by), by, probs)


def _quantiles(counts: DataFrame, by: str | None, probs: dict[str, float] = QUARTILES) -> DataFrame:
    """The sums of the ranges give each range its offset; only the values at the sought ranks take part in the last
    aggregation."""
    g = [by] if by else []
    d = counts.filter(F.col("_v").isNotNull())
    per = d.groupBy(*g, "_b").agg(F.sum("_c").alias("_s"))
    w = Window.partitionBy(*g)  # one row per label and range
    offs = per.select(*[F.col(c).alias("_g") for c in g], F.col("_b").alias("_b2"),
                      (F.sum("_s").over(w.orderBy("_b")) - F.col("_s")).alias("_off"), F.sum("_s").over(w).alias("_n"))
    on = F.col("_b") == F.col("_b2")
    j = d.join(offs, on & F.col(by).eqNullSafe(F.col("_g")) if by else on)
    # a value holds the ranks from _from up to _to
    j = j.withColumn("_to", F.col("_off") + F.sum("_c").over(Window.partitionBy(*g, "_b").orderBy("_v"))) \
         .withColumn("_from", F.col("_to") - F.col("_c"))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))

    place = {n: (F.col("_n") - 1) * q for n, q in probs.items()}
    found = j.groupBy(*g).agg(*[e for n, p in place.items() for e in (
        at(F.floor(p)).alias(f"{n}_lo"), at(F.ceil(p)).alias(f"{n}_hi"), F.max(p - F.floor(p)).alias(f"{n}_part"))])
    return found.select(*g, *[F.when(F.col(f"{n}_lo") == F.col(f"{n}_hi"), F.col(f"{n}_lo")).otherwise(
        (1 - F.col(f"{n}_part")) * F.col(f"{n}_lo") + F.col(f"{n}_part") * F.col(f"{n}_hi")).alias(n) for n in probs])


def describe(df: DataFrame, value: str, by: str | None = None, exact: bool = True) -> DataFrame:
    """Count, nulls, mean, std, min, quartiles, max (pandas ``describe``); all from the counts of
    values, so ``df`` is read once; or approximate quartiles in one aggregation."""
    v = F.col(value).cast("double")
    g = [by] if by else []
    names = ["count", "nulls", "mean", "std", "min", *QUARTILES, "max"]
    if not exact:
        qs = [F.percentile_approx(v, q, 10000).alias(n) for n, q in QUARTILES.items()]
        return df.groupBy(*g).agg(F.count(v).alias("count"), F.count_if(v.isNull()).alias("nulls"), F.avg(v).alias("mean"),
                                  F.stddev_samp(v).alias("std"), F.min(v).alias("min"), *qs, F.max(v).alias("max")).select(*g, *names)
    d = value_counts(df, value, by)
    some = F.col("_v").isNotNull()
    n = F.coalesce(F.sum(F.when(some, F.col("_c"))), F.lit(0)).alias("count")
    out = d.groupBy(*g).agg(n, F.coalesce(F.sum(F.when(~some, F.col("_c"))), F.lit(0)).alias("nulls"),
                            (F.sum(F.col("_v") * F.col("_c")) / F.nullif(F.sum(F.when(some, F.col("_c"))), F.lit(0))).alias("mean"),
                            F.min("_v").alias("min"), F.max("_v").alias("max"))
    # squares about the mean, from the same table of counts
    mean = out.select(*[F.col(c).alias("_g") for c in g], F.col("mean").alias("_m"))
    near = d.join(mean, F.col(by).eqNullSafe(F.col("_g"))) if by else d.crossJoin(F.broadcast(mean))  # one row
    far = near.groupBy(*g).agg(F.sum((F.col("_v") - F.col("_m")) * (F.col("_v") - F.col("_m")) * F.col("_c")).alias("_far"))
    q = _quantiles(d, by)
    if by:
        far, q = far.withColumnRenamed(by, "_g1"), q.withColumnRenamed(by, "_g2")
        out = out.join(far, F.col(by).eqNullSafe(F.col("_g1")), "left").join(q, F.col(by).eqNullSafe(F.col("_g2")), "left")
    else:
        out = out.crossJoin(far).crossJoin(q)
    return out.withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.col("_far") / (F.col("count") - 1)))).select(*g, *names)


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max (max in the last bin).  The
    min/max row is one global aggregate, joined back as a constant."""
    mm = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = F.col(value)
    span = F.col("_hi") - F.col("_lo")
    raw = F.when(span > 0, F.floor((x - F.col("_lo")) * bins / span)).otherwise(F.lit(0))
    b = (df.select(value).filter(x.isNotNull()).crossJoin(F.broadcast(mm))
           .withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("int")))
    return (b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
             .withColumn("lo", F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins)
             .withColumn("hi", F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins)
             .drop("_lo", "_hi"))


def distinct_labels(df: DataFrame, label: str = "target") -> DataFrame:
    """E11."""
    return df.select(label).distinct().orderBy(label)


def ratio_columns(df: DataFrame, text: str) -> DataFrame:
    """B1a–B1f counts and ratios of every named profile (integers exact)."""
    out = df
    for name in ("special_ko", "special_ko_hanja", "upper_ko", "special_syllable", "lower", "letter"):
        out = out.withColumn(f"n_{name}", F.coalesce(T.class_count(text, name), F.lit(0)))
    return out.withColumn("n_chars", T.text_length(text))
