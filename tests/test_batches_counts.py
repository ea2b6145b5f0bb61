"""Batches of like length, and counts taken in the pass that writes."""

import random

from pyspark.sql import functions as F

from tidyline.operators import detect as D
from tidyline.operators import infer as I
from tidyline.operators import joins as J
from tidyline.operators import observed as O
from tidyline.operators import report as R


def texts(n=500, seed=1):
    r = random.Random(seed)
    return [(k, None if k == 7 else "x" * (5 if r.random() < 0.4 else r.randint(0, 400))) for k in range(n)]


def test_batches_stay_within_the_padded_size(spark):
    """Each batch that the model sees is within the bound or a single text; equal lengths may be split."""
    def model():
        return lambda batch: [f"{len(batch)}:{max(map(len, batch))}:{len(t)}" for t in batch]

    data = texts()
    df = spark.createDataFrame(data, "id long, t string").repartition(3)
    rows = I.batch_generate_by_length(df, "id", "t", model, padded_chars=2000, parts=4).collect()
    assert sorted(r["id"] for r in rows) == list(range(500)) and all(r["error"] is None for r in rows)
    for r in rows:
        n, longest, own = map(int, r["generated"].split(":"))
        assert own == len(dict(data)[r["id"]] or "") <= longest == r["padded"] and (n * longest <= 2000 or n == 1)
    alone = I.batch_generate_by_length(df, "id", "t", model, padded_chars=1, parts=4).filter("padded > 0")
    assert all(r["generated"].startswith("1:") for r in alone.collect())


def test_same_rows_as_fixed_batches(spark):
    def model():
        def fn(batch):
            if any(len(t) % 7 == 3 for t in batch):
                raise ValueError("no")
            return [t.upper() for t in batch]
        return fn

    df = spark.createDataFrame(texts(seed=2), "id long, t string")
    a = I.batch_generate(df, "id", "t", model)
    b = I.batch_generate_by_length(df, "id", "t", model, padded_chars=3000)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select("id", "generated", "error").collect()))
    one = I.padding_share(b, df, "id", "t").first()["padding"]
    assert 0 <= one < 0.2
    none = df.filter("id < 0")
    assert I.padding_share(I.batch_generate_by_length(none, "id", "t", model), none, "id", "t").first()["padding"] == 0


def test_counts_of_the_write(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(["가나 3·가!·a", "plain text", "가·나", None, "ABC·12, x", "가 나 다"] * 20)]
    df = spark.createDataFrame(rows, "id long, text string")
    flagged = D.detect_noise(df, "text", frequent=spark.createDataFrame([("·",)], "chars string"))
    seen = O.write_counted(flagged, str(tmp_path / "out"), {**O.stage_metrics(), **O.prediction_metrics()})
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {k: v for k, v in seen.items() if k in D.P.STAGES and v} == {r["stage"]: r["n"] for r in D.stage_counts(back).collect()}
    assert [seen[k] for k in ("total", "noise", "normal")] == list(D.prediction_summary(back).first())
    new = back.select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("target"))
    old = back.select("id", F.lit(0).alias("target"))
    compared = J.compare_labels(new, old, "id")
    seen = O.write_counted(compared, str(tmp_path / "cmp"), O.change_metrics())
    assert seen["changed"] == J.changed_count(compared).first()["changed"] == 40
    assert R.class_counts(spark.read.parquet(str(tmp_path / "cmp")), "is_changed").count() == 2


def test_one_scan(spark, tmp_path):
    """The plan with the counts reads its input once."""
    spark.createDataFrame([(1, "a"), (2, "b·")], "id long, text string").write.parquet(str(tmp_path / "in"))
    flagged = D.detect_noise(spark.read.parquet(str(tmp_path / "in")), "text", frequent=spark.createDataFrame([("·",)], "chars string"))
    counted, _ = O.observe_into(flagged, {**O.stage_metrics(), **O.prediction_metrics()})
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "CollectMetrics" in plan
