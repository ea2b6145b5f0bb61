"""Keyed joins, set operations and exact hash splits."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidyline.functions.draws import hash32
from tidyline.operators import joins as J
from tidyline.operators import split as SP


def test_update_by_key_null_and_missing(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "ID string, target int")
    upd = spark.createDataFrame([("a", None), ("b", 5), ("z", 9)], "ID string, target int")
    got = {r["ID"]: r["target"] for r in J.update_by_key(base, upd, "ID", "target").collect()}
    assert got == {"a": None, "b": 5, "c": 3}
    rec = {r["ID"]: r["target"] for r in J.recover_labels(base, upd, "ID", "target").collect()}
    assert rec == {"a": 1, "b": 5, "c": 3}


def test_update_by_key_duplicate_fails(spark):
    base = spark.createDataFrame([("a", 1)], "ID string, target int")
    upd = spark.createDataFrame([("a", 2), ("a", 3)], "ID string, target int")
    with pytest.raises(Exception, match="duplicate key"):
        J.update_by_key(base, upd, "ID", "target").collect()


def test_label_diff_and_compare(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", None, 2), ("c", "z", None)], "ID string, text string, target int")
    new = spark.createDataFrame([("a", "x", 1), ("b", None, 3), ("c", "z", None)], "ID string, text string, target int")
    diff = {r["ID"] for r in J.label_diff(old, new, "ID", "text", "target").collect()}
    assert diff == {"b", "c"}  # NULL vs NULL counts as changed
    flags = J.compare_labels(new, old, "ID")
    assert J.changed_count(flags).first()["changed"] == 2


def test_union_missing(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "q")], "x int, y string")
    assert sorted(map(tuple, J.union_missing(a, b).collect())) == [(1, None), (2, "q")]


def test_label_rank_equals_window(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("lab"))
    got = SP.label_rank(df, "k", "lab", 9, bucket_bits=4).select("k", "_rank")
    w = Window.partitionBy("lab").orderBy(hash32("k", 9), "k")
    ref = df.select("k", (F.row_number().over(w) - 1).alias("_rank"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_split_independent_of_partitioning(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 4).alias("lab"))
    a = SP.split_flag(df, "k", 0.3, 456, by="lab")
    b = SP.split_flag(df.repartition(7), "k", 0.3, 456, by="lab")
    assert a.exceptAll(b).count() == 0
    per = {r["lab"]: r["n"] for r in a.groupBy("lab").agg(F.sum("is_valid").alias("n")).collect()}
    assert per == {0: 38, 1: 38, 2: 38, 3: 38}  # round(125 * .3) = 38 (37.5 rounds up)


def test_kfold_balanced(spark):
    df = spark.range(90).select(F.col("id").alias("k"), (F.col("id") % 3).alias("lab"))
    f = SP.kfold(df, "k", 3, 1, by="lab")
    counts = {(r["lab"], r["fold"]): r["n"] for r in f.groupBy("lab", "fold").agg(F.count("*").alias("n")).collect()}
    assert set(counts.values()) == {10}


def test_sample_and_topk(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 2).alias("lab"),
                                 F.repeat(F.lit("a"), (F.col("id") % 17).cast("int")).alias("t"))
    s = SP.sample_per_class(df, "k", "lab", 5, 3)
    assert s.groupBy("lab").count().filter("count = 5").count() == 2
    top = SP.top_k_longest(df, "t", "k", 3).collect()
    assert [len(r["t"]) for r in top] == [16, 16, 16]


def test_exact_top_equals_window_with_ties(spark):
    from tidyline.operators.relabel import exact_top
    rows = [(i, i % 3, float((i * 7) % 5) / 4 - 0.5, 1 + (i % 3) * 4) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, g int, margin double, quota long")
    got = exact_top(df, ["g"], [F.desc("margin"), F.col("k")], "quota").select("k")
    w = Window.partitionBy("g").orderBy(F.desc("margin"), "k")
    ref = df.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= F.col("quota")).select("k")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_exact_top_splits_one_tied_group(spark):
    from tidyline.operators.relabel import exact_top
    df = spark.range(20000).select(F.col("id").alias("k"), F.lit(0).alias("g"), F.lit(1.0).alias("margin"), F.lit(15000).alias("quota"))
    got = exact_top(df, ["g"], [F.desc("margin"), F.col("k")], "quota")
    assert got.agg(F.count("*"), F.max("k")).first()[:] == (15000, 14999)
    dealt = df.repartitionByRange(8, "g", F.desc("margin"), "k").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 6000
