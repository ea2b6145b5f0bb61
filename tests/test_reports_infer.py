"""Reports, the centroid scorer, prompts, the model hook and the resumable run."""

import numpy as np
from pyspark.sql import functions as F

from tidyline.operators import infer as I
from tidyline.operators import prompts as PR
from tidyline.operators import relabel as RL
from tidyline.operators import report as R
from tidyline.streaming.resume import pending, resumable_generate


def test_class_metrics_union_of_classes(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 3)]  # class 3 only predicted, 2 only true
    df = spark.createDataFrame(rows, "y int, p int")
    m = {r["cls"]: r for r in R.class_metrics(df, "y", "p").collect()}
    assert set(m) == {0, 1, 2, 3}
    assert m[3]["support"] == 0 and m[3]["f1"] == 0.0 and m[2]["recall"] == 0.0
    assert abs(m[1]["f1"] - 0.8) < 1e-12  # tp 2, support 2, predicted 3
    o = R.overall_metrics(df, "y", "p").first()
    assert abs(o["accuracy"] - 0.6) < 1e-12
    assert abs(o["macro_f1"] - (2 / 3 + 0.8) / 4) < 1e-12


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 2, 29, 30]], "v int")
    h = {r["bin"]: r["n"] for r in R.histogram(df, "v", 30).collect()}
    assert h == {0: 1, 1: 1, 2: 1, 29: 2}


def test_noise_buckets_legacy_gap(spark):
    df = spark.createDataFrame([("#" * 5 + "a" * 15,)], "t string")  # ratio .25
    assert R.noise_buckets(df, "t", "special_ko", high_from=(3, 10)).first().asDict() == {"low": 0, "norm": 0, "high": 0}
    assert R.noise_buckets(df, "t", "special_ko").first()["high"] == 1


def test_centroid_probs_match_numpy(spark):
    rng = np.random.default_rng(0)
    n, d, k = 60, 5, 3
    x = rng.normal(size=(n, d)).astype(np.float32)
    y = np.arange(n) % 3
    fold = (np.arange(n) // 3) % 2
    df = spark.createDataFrame([(int(i), x[i].tolist(), int(y[i]), int(fold[i])) for i in range(n)],
                               "id long, v array<float>, y int, fold int")
    got = {r["id"]: r["prob"] for r in RL.centroid_oof_probs(df, "id", "v", "y", "fold", 2).collect()}
    xd = x.astype(np.float64)
    for i in range(n):
        other = fold != fold[i]
        cents = np.stack([xd[other & (y == c)].mean(axis=0) for c in range(k)])
        z = -((xd[i] - cents) ** 2).sum(axis=1)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(got[i], p, atol=2e-9)


def test_render_prompt_and_messages(spark):
    df = spark.createDataFrame([(1, "제목")], "id long, text string")
    tm = PR.templates(spark)
    r = PR.render_prompt(df, tm, "denoise", 1, "text").first()
    assert r["prompt"].endswith("노이즈 있는 제목: 제목\n    복원된 제목:")
    assert PR.render_prompt(df, tm, "denoise", 7, "text").first()["prompt"] is None
    m = PR.render_prompt(df, tm, "denoise", 1, "text").select(
        PR.chat_messages("prompt_system", "prompt").alias("m")).first()["m"]
    assert [x["role"] for x in m] == ["system", "user"]


def test_batch_generate_isolates_failures(spark):
    # defined inside the test so the workers receive it by value
    def failing_model():
        def fn(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("boom")
            return [t.upper() for t in texts]
        return fn

    df = spark.createDataFrame([(i, "bad" if i == 3 else f"ok{i}") for i in range(10)], "id long, t string")
    out = {r["id"]: (r["g"], r["error"]) for r in I.batch_generate(df, "id", "t", failing_model, "g", 4).collect()}
    assert out[3][0] == "" and "boom" in out[3][1]
    assert out[2] == ("OK2", None) and len(out) == 10


def test_resumable_run_and_pending(spark, tmp_path):
    def upper_model():
        return lambda texts: [t.upper() for t in texts]

    src = str(tmp_path / "src")
    spark.createDataFrame([(i, f"t{i}") for i in range(6)], "id long, t string").write.parquet(src)
    out = str(tmp_path / "out")
    res = resumable_generate(spark, src, out, "id", "t", upper_model, files_per_trigger=1)
    assert sorted(r["generated"] for r in res.collect()) == [f"T{i}" for i in range(6)]
    # a second run into the same folder reads only the new file
    spark.createDataFrame([(6, "t6")], "id long, t string").write.mode("append").parquet(src)
    res2 = resumable_generate(spark, src, out, "id", "t", upper_model, files_per_trigger=1)
    assert res2.count() == 7
    done = res2.filter(F.col("id") != 2)
    todo = pending(spark.read.parquet(src), done, "id")
    assert [r["id"] for r in todo.collect()] == [2]


def test_restart_redoes_failed_rows(spark, tmp_path):
    def model(bad):
        def make():
            return lambda prompts: ["" if p in bad else p.upper() for p in prompts]
        return make

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(i, f"t{i}") for i in range(4)], "id long, t string").write.parquet(src)
    for bad, want in ((("t1", "t2"), ["T0", "", "", "T3"]), (("t2",), ["T0", "T1", "", "T3"]), ((), ["T0", "T1", "T2", "T3"]), (("t0",), ["T0", "T1", "T2", "T3"])):
        got = resumable_generate(spark, src, out, "id", "t", model(bad), files_per_trigger=1).orderBy("id").collect()
        assert [(r["id"], r["generated"] or "") for r in got] == list(enumerate(want))


def test_describe_equals_percentile_with_null_label_and_ties(spark):
    from pyspark.sql import functions as F

    from tidyline.operators import report as R
    rows = [(None if i % 4 == 0 else i % 3, None if i % 11 == 0 else (i * 37) % 23 if i % 2 else 5) for i in range(500)]
    df = spark.createDataFrame(rows, "lab int, v int").repartition(7)
    qs = [F.percentile("v", q).alias(n) for n, q in R.QUARTILES.items()]
    got = {r["lab"]: (r["q25"], r["q50"], r["q75"], r["count"]) for r in R.describe(df, "v", "lab").collect()}
    want = {r["lab"]: (r["q25"], r["q50"], r["q75"], r["n"]) for r in df.groupBy("lab").agg(*qs, F.count("v").alias("n")).collect()}
    assert got == want and len(got) == 4
    one = R.describe(df, "v").first()
    assert (one["q25"], one["q50"], one["q75"]) == tuple(df.agg(*qs).first())
    assert R.describe(df.filter("false"), "v").first()["q50"] is None
