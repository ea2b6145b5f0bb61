"""Cases that the test tables do not reach: NULL labels, label gaps, failing models, odd prompts."""

import pytest
from pyspark.sql import functions as F

from tidyline.functions import text as T
from tidyline.operators import filters as FI
from tidyline.operators import infer, joins, prompts, relabel, split


def test_null_labels_stay(spark):
    d = spark.range(40).select(F.col("id"), F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("lab"), F.lit("t").alias("text"))
    for df in (split.split_flag(d, "id", 0.3, 1, "lab"), split.kfold(d, "id", 3, 1, "lab"), split.number_within(d, "id", "lab")):
        assert df.count() == 40
    n = {r["rn"] for r in split.number_within(d, "id", "lab").filter("lab is null").collect()}
    assert n == set(range(10))


def test_texts_are_not_ranked(spark):
    d = spark.range(9).select("id", F.lit(1).alias("lab"), F.lit("t").alias("text"))
    plan = split.kfold(d, "id", 3, 1, "lab")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window ["):]
    assert "text" not in below


def test_label_gaps_and_single_rows(spark):
    rows = [(i, i % 3, [float(lab), 0.0], lab) for i, lab in enumerate([0] * 9 + [1] * 9 + [3] * 9 + [7])]
    d = spark.createDataFrame(rows, "id int, fold int, v array<double>, lab int")
    out = {r["id"]: r for r in relabel.centroid_oof_probs(d, "id", "v", "lab", "fold", 3, 0.01).collect()}
    assert len(out) == 28
    assert all(out[i]["pred"] == rows[i][3] for i in range(27))
    assert all(len(r["prob"]) == 8 and r["prob"][2] == 0 for r in out.values())
    assert out[27]["prob"][7] == 0  # its own fold holds the whole class


def test_failed_rows_keep_their_text(spark):
    def bad():
        def fn(texts):
            if "x" in texts:
                raise ValueError("no")
            return [t * 2 for t in texts]
        return fn
    d = spark.createDataFrame([(1, "a"), (2, "x")], "id int, t string")
    got = {r["id"]: (r["back_translation"], r["error"]) for r in infer.two_step(d, "id", "t", bad, bad).collect()}
    assert got == {1: ("aaaa", None), 2: ("x", "ValueError: no")}


def test_prompts_read_no_placeholder_in_a_text(spark):
    t = prompts.templates(spark, [("p", 1, "<{text}|{target}>", None), ("p", 2, "a", None), ("p", 2, "b", None)])
    d = spark.createDataFrame([("a {target} b", 7), (None, None)], "text string, target int")
    got = [r["prompt"] for r in prompts.render_prompt(d, t, "p", 1, "text", target="target").collect()]
    assert got == ["<a {target} b|7>", "<|>"]
    with pytest.raises(Exception, match="duplicate template"):
        prompts.render_prompt(d, t, "p", 2, "text").collect()


def test_duplicate_old_keys_fail(spark):
    new, old = spark.createDataFrame([(1, 2)], "id int, target int"), spark.createDataFrame([(1, 2), (1, 3)], "id int, target int")
    with pytest.raises(Exception, match="duplicate key"):
        joins.compare_labels(new, old, "id").collect()


def test_ratios_of_long_texts(spark):
    """Counts of long texts times the denominator are beyond 32 bits."""
    df = spark.createDataFrame([(1, "A" * 300_000), (2, "%" * 300_000)], "id long, text string")
    assert [r["id"] for r in df.filter(FI.ratio_threshold("text")).collect()] == [2]
    n = F.lit(1 << 30).cast("int")
    assert df.limit(1).select(T.ratio_at_least(n, n, 9, 100).alias("x"), T.noise_bucket(n, n).alias("b")).first() == (True, "high")
