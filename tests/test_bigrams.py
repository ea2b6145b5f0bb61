"""Bigrams counted within texts, hashed features and noise kernels, against plain code and Spark's own stages."""

import collections

import pyarrow as pa
from pyspark.ml.feature import HashingTF, NGram
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidyline.functions import bigrams as B
from tidyline.operators import charnoise as CN
from tidyline.operators import learn as L

TEXTS = ["", None, "a", "ab", "abab\n ab", "é가나 😀😀😀", "x" * 300_000, "\x00\x01￿", "日本 語"]


def test_counts_are_those_of_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    got = {r["id"]: {x["g"]: x["n"] for x in r["c"]} for r in df.select("id", B.counted_bigrams(F.col("text")).alias("c")).collect()}
    assert got == {i: dict(collections.Counter(a + b for a, b in zip(t or "", (t or "")[1:]))) for i, t in enumerate(TEXTS)}


def test_features_are_those_of_the_spark_stages(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    chars = df.select("id", F.split(F.coalesce("text", F.lit("")), "").alias("c"), B.hashed_bigrams(F.col("text"), 1 << 16, 3).alias("mine"))
    for r in HashingTF(numFeatures=1 << 16, inputCol="g", outputCol="v").transform(NGram(n=2, inputCol="c", outputCol="g").transform(chars)).collect():
        assert r["mine"] == r["v"], TEXTS[r["id"]]


def test_slices_are_whole_and_bounded():
    t = pa.array(["y" * 100_000] * 9 + [None, "", "z" * 400_000, "w"])
    parts = list(B.slices(t))
    assert pa.concat_arrays(parts).equals(t) and len(parts) >= 5
    assert all(len(p) == 1 or sum(len(x or "") for x in p.to_pylist()) <= B.PASS for p in parts)
    assert list(B.slices(t.slice(0, 0))) == []


def test_noise_kernels_hold_one_pass_of_texts():
    """A batch far beyond one pass never becomes Python strings as a whole."""
    seen = []
    t = pa.array(["q" * 50_000, None, ""] * 40)
    out = CN._by_passes(t, lambda j, at: seen.append((len(j.codes), at.tolist())) or j.texts(j.codes, j.sizes))
    assert out.equals(t) and max(n for n, _ in seen) <= B.PASS and [i for _, at in seen for i in at] == list(range(0, 120, 3))


def test_models_go_to_tasks_after_an_observation(spark):
    """An observed metric makes the session, and with it a model's training summary, unfit for tasks."""
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get == {"n": 5}
    df = spark.createDataFrame([(k, ("qxz#" if k % 4 == 0 else "aeiou") * 3, int(k % 4 == 0)) for k in range(40)], "id long, text string, is_noise int")
    out = L.crossfit_noise(df, "id", "text", "is_noise", 3)
    assert [r["model_hit"] for r in out.collect()] == [0] * 40


def test_a_text_is_counted_once(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, text string")
    out = df.select("id", B.counted_bigrams(F.col("text")).alias("c")).select("id", F.inline("c"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1 and out.count() == 2
