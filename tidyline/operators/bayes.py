"""A counted text classifier.

Multinomial naive Bayes over character bigrams.  A model is a table of counts
(label, bigram, fold): fitting is one aggregation, and the model without a fold is
the total less the fold's own counts, so k-fold models cost one pass, not k.  A
row's score for a label is a keyed sum of logarithms held as whole billionths, so it
does not depend on the order of the tasks, and SQL gives the same numbers with
decimals.

With one added to each count, ``ln P(g | c) = ln(n(c, g) + 1) - ln(n(c) + v)`` (v distinct
bigrams), and a bigram that a label has never seen adds nothing but the second
part.  So only seen (label, bigram) pairs are stored and joined, and the second part
is the length of the row times one number.

Labels are integers from 0.  The table of logarithms has a row per distinct bigram (and
fold), an array by label; Spark sends it to all tasks while it is below the broadcast
threshold and shuffles otherwise.  A text's bigrams are counted within the text, so what
is counted and joined is a row per distinct bigram of a text; a row's sums are one per
label, added up before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyline.functions.bigrams import counted_bigrams
from tidyline.operators import detect as D
from tidyline.operators import joins as J
from tidyline.operators import relabel as RL
from tidyline.operators import report as R
from tidyline.operators import split as SP
from tidyline.session import sized, spread

DIGITS = 9


def log_of(n: Column) -> Column:
    """The logarithm in billionths."""
    return (F.round(F.ln(n.cast("double")), DIGITS).cast(f"decimal(18,{DIGITS})") * 10 ** DIGITS).cast("long")


@dataclass
class Bayes:
    """grams: label, g, n, own (counts by fold); sizes: label, docs, own_docs; both written."""
    grams: DataFrame
    sizes: DataFrame
    folds: int


def fit(df: DataFrame, text: str, label: str, fold: str | None = None, folds: int = 1) -> Bayes:
    """Count the rows of ``df``.  With ``fold`` (0 to ``folds`` - 1; other values belong to no
    fold) the model of each fold leaves its rows out."""
    f = F.col(fold) if fold else F.lit(-1)
    rows = df.select(F.col(label).cast("int").alias("label"), f.cast("int").alias("fold"), text)

    def by_fold(counts: DataFrame, group: list[str], n: str, own: str) -> DataFrame:
        return counts.groupBy(*group).agg(F.sum("n").cast("long").alias(n), F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias(own))

    pairs = rows.select("label", "fold", counted_bigrams(F.col(text)).alias("_c")).select(
        "label", "fold", F.inline("_c")).groupBy("label", "fold", "g").agg(F.sum("n").alias("n"))
    docs = rows.groupBy("label", "fold").agg(F.count("*").alias("n"))
    return Bayes(sized(by_fold(pairs, ["label", "g"], "n", "own")), sized(by_fold(docs, ["label"], "docs", "own_docs")), folds if fold else 1)


def _without_own(df: DataFrame, folds: int, total: str, own: str, name: str) -> DataFrame:
    """A row per fold with what the other folds hold."""
    each = df.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    return each.withColumn(name, F.col(total) - F.coalesce(F.try_element_at(own, F.col("fold")), F.lit(0))).filter(F.col(name) > 0)


def logarithms(model: Bayes, top: int) -> tuple[DataFrame, DataFrame]:
    """(fold, g, w) with an array by label (0 to ``top``) of the seen pairs' logarithms, and one row per fold:
    ``base``, an array of (label, prior, den)."""
    seen = sized(_without_own(model.grams, model.folds, "n", "own", "_n").select("fold", "g", "label", "_n"))
    by_label = F.map_from_entries(F.collect_list(F.struct("label", log_of(F.col("_n") + 1))))
    w = seen.groupBy("fold", "g").agg(by_label.alias("_m")).select(
        "fold", "g", F.transform(F.sequence(F.lit(0), F.lit(top)), lambda c: F.coalesce(F.try_element_at("_m", c), F.lit(0).cast("long"))).alias("w"))
    v = seen.select("fold", "g").distinct().groupBy("fold").agg(F.count("*").alias("_v"))
    n = seen.groupBy("fold", "label").agg(F.sum("_n").alias("_nc"))
    d = _without_own(model.sizes, model.folds, "docs", "own_docs", "_d").select("fold", "label", "_d")
    total = d.groupBy("fold").agg(F.sum("_d").alias("_all"))
    base = (d.join(total, "fold").join(n, ["fold", "label"], "left").join(v, "fold", "left")
             .withColumn("prior", log_of(F.col("_d") / F.col("_all")))
             .withColumn("den", log_of(F.greatest(F.coalesce("_nc", F.lit(0)) + F.coalesce("_v", F.lit(0)), F.lit(1)))))
    return sized(w), base.groupBy("fold").agg(F.array_sort(F.collect_list(F.struct("label", "prior", "den"))).alias("base"))


def predict(model: Bayes, df: DataFrame, text: str, key: str, fold: str | None = None) -> DataFrame:
    """key, pred, prob (array by label, 0 for labels that the model lacks): each row by the model
    without its fold.  Ties go to the least label.  ``key`` names each row once."""
    top = model.sizes.agg(F.max("label")).first()[0] or 0
    w, base = logarithms(model, top)
    f = (F.col(fold) if fold else F.lit(0)).cast("int")
    rows = df.select(key, f.alias("fold"), F.col(text).alias("_text"))
    hits = rows.select(key, "fold", counted_bigrams(F.col("_text")).alias("_c")).select(key, "fold", F.inline("_c")).join(w, ["fold", "g"])
    sums = hits.groupBy(key).agg(*[F.sum(F.get("w", F.lit(c)) * F.col("n")).alias(f"_s{c}") for c in range(top + 1)])
    sums = sums.select(key, F.array(*[f"_s{c}" for c in range(top + 1)]).alias("_sums"))
    length = F.greatest(F.length(F.coalesce("_text", F.lit(""))) - 1, F.lit(0)).cast("long")
    joined = (rows.select(key, "fold", length.alias("_len")).join(sums, key, "left").join(base, "fold")
              .withColumn("_s", F.transform("base", lambda b: F.struct(b["label"].alias("label"), (
                  b["prior"] - F.col("_len") * b["den"] + F.coalesce(F.get("_sums", b["label"]), F.lit(0))).alias("s")))))
    best = F.array_max(F.transform("_s", lambda x: x["s"]))
    e = (joined.withColumn("_best", best)
               .withColumn("pred", F.array_min(F.transform(F.filter("_s", lambda x: x["s"] == F.col("_best")), lambda x: x["label"])))
               .withColumn("_e", F.transform("_s", lambda x: F.struct(x["label"].alias("label"), F.exp((x["s"] - F.col("_best")).cast("double") / 1e9).alias("e"))))
               .withColumn("_sum", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x["e"]))
               .withColumn("_by", F.map_from_entries("_e")))
    prob = F.transform(F.sequence(F.lit(0), F.lit(top)), lambda i: F.round(F.coalesce(F.try_element_at("_by", i), F.lit(0.0)) / F.col("_sum"), DIGITS))
    return e.select(key, "pred", prob.alias("prob"))


def crossfit_noise(df: DataFrame, key: str, text: str, flag: str, seed: int) -> DataFrame:
    """F3 + F4: the rows that no rule flagged are dealt into two halves; the
    flagged rows and one half are counted to judge the other, and the reverse;
    rows judged noise are flagged.  Adds ``model_hit``."""
    rest = SP.halves(df.filter(~F.col(flag).eqNullSafe(1)), key, seed)
    rows = rest.select(key, text, F.lit(0).alias("_y"), "half").unionByName(
        df.filter(F.col(flag) == 1).select(key, text, F.lit(1).alias("_y"), F.lit(-1).alias("half")))
    model = fit(rows, text, "_y", "half", 2)
    hits = predict(model, rest, text, key, "half").filter(F.col("pred") == 1).select(key)
    return D.assemble_flag(df, hits, key, flag)


def oof_probs(df: DataFrame, key: str, text: str, label: str, k: int, seed: int) -> DataFrame:
    """H1: key, label, fold, pred, prob with stratified folds; every row by the counts of the other folds."""
    f = spread(sized(SP.kfold(df.select(key, text, label), key, k, seed, by=label)), key)
    p = predict(fit(f, text, label, "fold", k), f, text, key, "fold")
    return f.select(key, label, "fold").join(p, key)


def noise_split_relabel(df: DataFrame, key: str, text: str, label: str, flag: str) -> DataFrame:
    """H4: count the noisy rows, score the clean ones, find the label issues among them (H2), relabel (H3)."""
    clean = df.filter(F.col(flag) == 0)
    p = predict(fit(df.filter(F.col(flag) == 1), text, label), clean, text, key)
    scored = sized(clean.select(key, label).join(p, key))
    return RL.apply_relabel(scored, RL.find_label_issues(scored, key, label, "prob"), key, label, "prob")


def classify_overwrite(df: DataFrame, key: str, text: str, label: str, flag: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """H6: 70 % of the noisy rows are counted and 30 % validate; the clean rows take the predicted label.  Returns the
    relabelled rows with ``prev_target`` and ``is_changed``, and the validation metrics."""
    noisy = spread(sized(SP.split_flag(df.filter(F.col(flag) == 1).select(key, text, label), key, 0.3, seed, by=label)), key)
    model = fit(noisy.filter("is_valid = 0"), text, label)
    valid = noisy.filter("is_valid = 1")
    checked = valid.select(key, label).join(predict(model, valid, text, key), key)
    clean = df.filter(F.col(flag) == 0)
    new = clean.drop(label).join(predict(model, clean, text, key).select(key, F.col("pred").alias(label)), key)
    return J.compare_labels(new, clean, key, label, label), R.overall_metrics(checked, label, "pred")


@dataclass
class Run:
    """What one run of H7 gives: metrics over all classes and by class, and the test table with predictions."""
    overall: DataFrame
    per_class: DataFrame
    predictions: DataFrame


def train_evaluate_predict(train: DataFrame, test: DataFrame, key: str, text: str, label: str, seed: int = 456, frac: float = 0.3) -> Run:
    """H7: a stratified split, one fit, metrics of the validation part (E6, E7) and predictions for the test table, attached
    by key (G8)."""
    rows = spread(sized(SP.split_flag(train.select(key, text, label), key, frac, seed, by=label)), key)
    model = fit(rows.filter("is_valid = 0"), text, label)
    valid = rows.filter("is_valid = 1")
    checked = sized(valid.select(key, label).join(predict(model, valid, text, key), key).select(key, label, "pred"))
    pred = predict(model, test, text, key).select(key, F.col("pred").alias(label))
    return Run(R.overall_metrics(checked, label, "pred"), R.class_metrics(checked, label, "pred"), J.attach(test, pred, key, [label]))
