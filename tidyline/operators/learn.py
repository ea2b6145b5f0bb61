"""Model-based steps on ``pyspark.ml``.

The reference fine-tunes a transformer on a GPU; that engine is not rebuilt.
Its place is taken by a distributed text classifier: character bigrams,
hashed term frequencies and a (multinomial) logistic regression, fitted by
Spark ML.  Splits and folds come from the exact hash-based splits of
:mod:`tidyline.operators.split`, so every fit is reproducible."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.functions.bigrams import hashed_bigrams
from tidyline.operators import detect as D
from tidyline.operators import joins as J
from tidyline.operators import relabel as RL
from tidyline.operators import report as R
from tidyline.operators import split as SP
from tidyline.session import scratch_path, sized, spread

NUM_FEATURES = 1 << 16


def with_features(df: DataFrame, text: str) -> DataFrame:
    """``_features`` in the text's place, written once: every fit and prediction reads the vectors, not the texts."""
    return sized(df.withColumn("_features", hashed_bigrams(F.col(text), NUM_FEATURES)).drop(text))


def classifier(label: str, max_iter: int = 30, reg: float = 0.01) -> LogisticRegression:
    return LogisticRegression(featuresCol="_features", labelCol=label, predictionCol="_pred",
                              probabilityCol="_prob", rawPredictionCol="_raw", maxIter=max_iter, regParam=reg)


def fit(df: DataFrame, label: str) -> LogisticRegressionModel:
    """A model of rows with ``_features``, written and read back: without its training summary, which holds the session
    and so cannot go to the tasks once the session has observed a metric."""
    path = scratch_path(df.sparkSession, "model")
    classifier(label).fit(df.select("_features", F.col(label).cast("double"))).write().save(path)
    return LogisticRegressionModel.load(path)


def predict(model: LogisticRegressionModel, df: DataFrame, key: str) -> DataFrame:
    """(key, pred int, prob array<double>) of rows with ``_features``."""
    p = model.transform(df)
    return p.select(key, F.col("_pred").cast("int").alias("pred"), vector_to_array("_prob").alias("prob"))


def crossfit_noise(df: DataFrame, key: str, text: str, flag: str, seed: int) -> DataFrame:
    """F3 + F4: the rows no rule flagged are split in two halves by draw;
    train on the flagged rows + one half, predict the other, and the
    reverse; model hits become noise.  Adds ``model_hit``."""
    f = with_features(df.select(key, text, flag), text)
    noise = f.filter(F.col(flag) == 1)
    rest = SP.halves(f.filter(~F.col(flag).eqNullSafe(1)), key, seed)
    hits = []
    for h in (0, 1):
        train = noise.unionByName(rest.filter(F.col("half") == h).drop("half"))
        m = fit(train.withColumn("_y", F.col(flag).cast("int")), "_y")
        hits.append(predict(m, rest.filter(F.col("half") != h), key).filter(F.col("pred") == 1).select(key))
    return D.assemble_flag(df, hits[0].unionByName(hits[1]), key, flag)


def oof_probs(df: DataFrame, key: str, text: str, label: str, k: int, seed: int) -> DataFrame:
    """H1: stratified k folds; a fresh model per fold is fitted on the other
    folds and predicts this one.  (key, label, fold, pred, prob)."""
    f = spread(with_features(SP.kfold(df.select(key, text, label), key, k, seed, by=label), text), key)
    parts = []
    for i in range(k):
        m = fit(f.filter(F.col("fold") != i), label)
        parts.append(predict(m, f.filter(F.col("fold") == i), key))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    return f.select(key, label, "fold").join(preds, key)


def noise_split_relabel(df: DataFrame, key: str, text: str, label: str, flag: str) -> DataFrame:
    """H4: fit on the noisy rows, score the clean rows, find label issues
    among them (H2) and relabel (H3)."""
    f = with_features(df.select(key, text, label, flag), text)
    m = fit(f.filter(F.col(flag) == 1), label)
    clean = f.filter(F.col(flag) == 0)
    scored = sized(clean.select(key, label).join(predict(m, clean, key), key))
    issues = RL.find_label_issues(scored, key, label, "prob")
    return RL.apply_relabel(scored, issues, key, label, "prob")


def classify_overwrite(df: DataFrame, key: str, text: str, label: str, flag: str, seed: int = 42):
    """H6: fit on the noisy rows (70 % of them; 30 % validate), predict the
    clean rows and overwrite their label.  Returns (relabelled rows with
    ``prev_target``/``is_changed``, validation metrics)."""
    f = with_features(df.select(key, text, label, flag), text)
    noisy = sized(SP.split_flag(f.filter(F.col(flag) == 1), key, 0.3, seed, by=label))
    m = fit(noisy.filter("is_valid = 0"), label)
    valid = noisy.filter("is_valid = 1")
    val = sized(valid.select(key, label).join(predict(m, valid, key), key).select(key, label, "pred"))
    clean = df.filter(F.col(flag) == 0)
    pred = predict(m, f.filter(F.col(flag) == 0), key).select(key, F.col("pred").alias(label))
    new = clean.drop(label).join(pred, key)
    return J.compare_labels(new, clean, key, label, label), R.overall_metrics(val, label, "pred")


def train_evaluate_predict(train: DataFrame, test: DataFrame, key: str, text: str, label: str,
                           seed: int = 456, frac: float = 0.3):
    """H7: stratified split, fit, metrics on the validation part (E6, E7),
    predictions for the test table attached by key (G8)."""
    rows = sized(SP.split_flag(with_features(train.select(key, text, label), text), key, frac, seed, by=label))
    m = fit(rows.filter("is_valid = 0"), label)
    va = rows.filter("is_valid = 1")
    val = sized(va.select(key, label).join(predict(m, va, key), key).select(key, label, "pred"))
    out = J.attach(test, predict(m, with_features(test.select(key, text), text), key).select(key, F.col("pred").alias(label)), key, [label])
    return R.overall_metrics(val, label, "pred"), R.class_metrics(val, label, "pred"), out
