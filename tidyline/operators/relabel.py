"""Relabelling: out-of-fold scores and confident learning.

``find_label_issues`` follows "Confident Learning" (Northcutt, Jiang, Chuang,
JAIR 2021): per-class thresholds, the confident joint, calibration to the
class sizes, then for every off-diagonal cell (i, j) the rows of class i with
the largest margin p[j] - p[i], as many as the calibrated cell; rows whose
arg-max is their given label are dropped.

Scale notes.  Thresholds, the joint and the quotas are K or K*K rows, joined
back as broadcast constants.  The top-quota selection per (i, j) would put
all rows of class i in one window partition; instead the exact rank by
(margin desc, key) is computed from a count table of ranges (see
:func:`exact_top`), and rows in ranges past the quota never reach a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyline.functions import text as T
from tidyline.session import sized

EPS = 1e-6
DIGITS = 9


# ---------------------------------------------------------------------------
# Nearest-centroid out-of-fold probabilities
# ---------------------------------------------------------------------------

def centroid_oof_probs(df: DataFrame, key: str, vec: str, label: str, fold: str, k: int,
                       temperature: float = 1.0) -> DataFrame:
    """For each row, softmax over classes of -||x - c||² / temperature, where
    c is the class centroid computed *without* the row's fold.  Adds ``prob``
    (array<double>, rounded to 9 digits) and ``pred`` (arg-max).

    Work: one explode of rows x dims for the sums (partially aggregated), then
    a (fold, label, dim) table of k*K*D numbers, gathered per fold into one
    array row and broadcast."""
    # sums of decimals do not depend on the order of the tasks
    x = df.select(label, fold, F.posexplode(vec).alias("dim", "x")) \
          .withColumn("x", F.col("x").cast("double").cast("decimal(38,12)"))
    # one pass over rows x dims: sum and count per (fold, label, dim)
    sums = x.groupBy(fold, label, "dim").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("c"))
    tot = sums.groupBy(label, "dim").agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    grid = (tot.withColumn(fold, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
               .join(sums, [fold, label, "dim"], "left"))
    # a class that only the row's own fold holds has no centroid there: its probability is 0
    left = F.col("tc") - F.coalesce("c", F.lit(0))
    cen = grid.withColumn("v", F.when(left > 0, (F.col("ts") - F.coalesce(F.col("s"), F.lit(0).cast("decimal(38,12)"))).cast("double") / left)).filter("v is not null")
    per_label = cen.groupBy(fold, label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "v"))), lambda s: s["v"]).alias("cv"))
    # k rows of at most K x D numbers
    per_fold = per_label.groupBy(fold).agg(
        F.array_sort(F.collect_list(F.struct(F.col(label).cast("int").alias("l"), "cv"))).alias("_cents"))
    per_fold = per_fold.join(F.broadcast(tot.agg(F.max(label).cast("int").alias("_top"))))
    xv = F.transform(F.col(vec), lambda a: a.cast("double"))
    scored = df.join(sized(per_fold), fold).withColumn(
        "_z", F.transform("_cents", lambda c: -F.aggregate(
            F.zip_with(xv, c["cv"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, y: acc + y) / temperature))
    # the position in ``prob`` is the label itself; labels without a centroid have 0
    by_label = F.map_from_arrays(F.transform("_cents", lambda c: c["l"]), T.softmax("_z"))
    dense = F.get(F.transform(F.array(by_label), lambda m: F.transform(
        F.sequence(F.lit(0), F.col("_top")), lambda i: F.round(F.coalesce(F.try_element_at(m, i), F.lit(0.0)), DIGITS))), F.lit(0))
    return scored.withColumn("prob", dense).withColumn("pred", T.argmax("prob")).drop("_cents", "_z", "_top")


# ---------------------------------------------------------------------------
# Exact top-n per group without one window per group
# ---------------------------------------------------------------------------

def exact_top(df: DataFrame, groups: list[str], order_cols: list, quota: str) -> DataFrame:
    """Rows whose rank in ``groups`` by ``order_cols`` (which name each row
    once) is below ``quota``.

    Rows are dealt by ranges of (groups, order), so neither a hot group nor
    tied rows meet in one task, and written with the number of their range.  A
    range's offset is the count of the group's rows in earlier ranges; ranges
    whose offset reaches the quota are dropped before any window, and the rank
    inside the remaining ones is a row number over (group, range)."""
    d = sized(df.repartitionByRange(*groups, *order_cols).withColumn("_b", F.spark_partition_id()))
    counts = d.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*groups).orderBy("_b")
    offs = counts.withColumn("_off", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0))).drop("_c")
    kept = d.join(offs, [*groups, "_b"]).filter(F.col("_off") < F.col(quota))
    wb = Window.partitionBy(*groups, "_b").orderBy(*order_cols)
    return (kept.withColumn("_rank", F.col("_off") + F.row_number().over(wb) - 1)
                .filter(F.col("_rank") < F.col(quota)).drop("_b", "_off", "_rank"))


# ---------------------------------------------------------------------------
# H2: find_label_issues
# ---------------------------------------------------------------------------

def class_thresholds(df: DataFrame, label: str, prob: str) -> DataFrame:
    """t_k = mean p[k] over rows given label k; one row ``_t`` array
    (index = class), NULL for a class that is never given."""
    per = df.groupBy(label).agg(F.avg(F.coalesce(F.try_element_at(prob, (F.col(label) + 1).cast("int")), F.lit(0.0))).alias("t"))
    k = df.select(F.size(prob).alias("_k")).agg(F.max("_k").alias("_k"))
    arr = per.agg(F.map_from_entries(F.collect_list(F.struct(label, "t"))).alias("_m"))
    return arr.crossJoin(k).select(F.transform(F.sequence(F.lit(0), F.col("_k") - 1),
                                               lambda i: F.try_element_at(F.col("_m"), i)).alias("_t"))


def with_confident_guess(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Adds ``guess``: arg-max of p over the confident set {k: p[k] >= t_k - eps},
    NULL when the set is empty."""
    t = class_thresholds(df, label, prob)
    masked = F.transform(F.col(prob), lambda x, i: F.when(x >= F.get("_t", i) - EPS, x).otherwise(-1.0))
    return (df.crossJoin(F.broadcast(t)).withColumn("_mk", masked)
              .withColumn("guess", F.when(F.array_max("_mk") >= 0, T.argmax("_mk")))
              .drop("_mk", "_t"))


def confident_joint(guessed: DataFrame, label: str) -> DataFrame:
    """(given, guess, n) over rows with a guess."""
    return (guessed.filter(F.col("guess").isNotNull())
                   .groupBy(F.col(label).alias("given"), "guess").agg(F.count(F.lit(1)).alias("n")))


def prune_quotas(guessed: DataFrame, label: str) -> DataFrame:
    """(given, other, quota): the calibrated off-diagonal counts, rounded
    half up: joint[i][j] * n_i / rowsum_i, the diagonal counted as >= 1."""
    joint = confident_joint(guessed, label)
    sizes = guessed.groupBy(F.col(label).alias("given")).agg(F.count(F.lit(1)).alias("n_i"))
    rows = joint.groupBy("given").agg(
        F.sum("n").alias("_s"), F.sum(F.when(F.col("guess") == F.col("given"), F.col("n")).otherwise(0)).alias("_d"))
    rows = rows.withColumn("rowsum", F.col("_s") + F.when(F.col("_d") < 1, 1).otherwise(0)).drop("_s", "_d")
    q = (joint.filter(F.col("guess") != F.col("given")).join(rows, "given").join(sizes, "given")
              .withColumn("quota", F.floor((2 * F.col("n") * F.col("n_i") + F.col("rowsum")) / (2 * F.col("rowsum")))))
    return q.select("given", F.col("guess").alias("other"), "quota").filter(F.col("quota") > 0)


def quota_margins(guessed: DataFrame, key: str, label: str, prob: str) -> DataFrame:
    """(key, _g, _o, quota, margin): p[_o] - p[_g] of each row for the other classes
    that have a quota with its label _g, not for every class."""
    q = sized(prune_quotas(guessed, label).groupBy(F.col("given").alias("_g")).agg(F.collect_list(F.struct("other", "quota")).alias("_q")))
    given = F.coalesce(F.try_element_at(prob, (F.col(label) + 1).cast("int")), F.lit(0.0))
    pairs = guessed.join(q, F.col(label) == F.col("_g")).withColumn("_p", given)
    each = F.transform("_q", lambda x: F.struct(x["other"].alias("_o"), x["quota"].alias("quota"), (F.get(F.col(prob), x["other"]) - F.col("_p")).alias("margin")))
    return pairs.select(key, "_g", F.explode(each).alias("_x")).select(key, "_g", "_x.*")


def find_label_issues(df: DataFrame, key: str, label: str, prob: str) -> DataFrame:
    """H2: rows that are label issues, with ``suggested`` (arg-max of p) and
    ``self_confidence`` (p[given]); sort by self_confidence at the sink."""
    # one narrow frame, written once, that the joint, the quotas and the margins read
    guessed = sized(with_confident_guess(df.select(key, label, prob), label, prob))
    top = exact_top(quota_margins(guessed, key, label, prob), ["_g", "_o"], [F.desc("margin"), F.col(key)], "quota")
    cands = top.select(key).distinct()
    issues = df.join(cands, key, "left_semi").withColumn("suggested", T.argmax(prob)) \
               .filter(F.col("suggested") != F.col(label))
    return issues.withColumn("self_confidence", F.coalesce(F.try_element_at(prob, (F.col(label) + 1).cast("int")), F.lit(0.0)))


def apply_relabel(df: DataFrame, issues: DataFrame, key: str, label: str, prob: str,
                  out: str = "new_label") -> DataFrame:
    """H3: ``new_label`` = arg-max of p for issues, the given label otherwise."""
    flagged = issues.select(key, F.lit(True).alias("_issue"))
    return (df.join(flagged, key, "left")
              .withColumn(out, F.when(F.col("_issue"), T.argmax(prob)).otherwise(F.col(label)))
              .drop("_issue"))


def save_modified(df: DataFrame, key: str, text: str | None, new_label: str = "new_label",
                  target: str = "target") -> DataFrame:
    """H5: key, text, new label renamed to target."""
    cols = [key] + ([text] if text else []) + [F.col(new_label).alias(target)]
    return df.select(*cols)


def most_confident_unchanged(df: DataFrame, key: str, label: str, prob: str, n: int = 200) -> DataFrame:
    """H8: among rows whose arg-max equals the label, the n most confident."""
    return (df.filter(T.argmax(prob) == F.col(label))
              .withColumn("confidence", F.coalesce(F.try_element_at(prob, (F.col(label) + 1).cast("int")), F.lit(0.0)))
              .orderBy(F.desc("confidence"), F.col(key)).limit(n))
