"""Sources and sinks (A1–A8) on files written by the test itself."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidyline.operators import report as R
from tidyline.sources import io as IO


def test_csv_roundtrip_typed(spark, tmp_path):
    df = spark.createDataFrame([("ynat_00001", 'say "hi",\nthen go', 3), ("ynat_00002", None, 6)], IO.CORE_SCHEMA)
    p = str(tmp_path / "core.csv")
    IO.write_table(df, p, fmt="csv")
    back = IO.read_table(spark, p, IO.CORE_SCHEMA, fmt="csv", mode="FAILFAST", multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_failfast_and_permissive(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("ID,text,target\na,x,1\nb,y,notanumber\nc,z,2\n")
    with pytest.raises(Exception):
        IO.read_table(spark, str(p), IO.CORE_SCHEMA, fmt="csv", mode="FAILFAST").collect()
    good, bad = IO.read_with_bad_rows(spark, str(p), IO.CORE_SCHEMA)
    assert sorted(r["ID"] for r in good.collect()) == ["a", "c"]
    assert bad.count() == 1


def test_positional_read(spark, tmp_path):
    p = tmp_path / "pos.csv"
    p.write_text("idx,title,label\n0,first,1\n1,second,2\n")
    df = IO.read_positional(spark, str(p), ["text", "target"], [1, 2])
    assert [tuple(r) for r in df.orderBy("text").collect()] == [("first", "1"), ("second", "2")]


def test_split_write_by_flag(spark, tmp_path):
    df = spark.createDataFrame([("a", "t", 1, 1), ("b", "u", 2, 0), ("c", "v", 3, 1)], IO.NOISE_SCHEMA)
    p = str(tmp_path / "split")
    IO.write_split_by_flag(df, p)
    assert {"is_noise=0", "is_noise=1"} <= set(os.listdir(p))
    noisy = spark.read.parquet(p).filter(F.col("is_noise") == 1)
    assert sorted(r["ID"] for r in noisy.collect()) == ["a", "c"]


def test_json_report(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 7) for i in range(70)], "ID int, target int")
    doc = json.loads(R.json_report(df).first()["json"])
    assert doc["n_classes"] == 7 and doc["total"] == 70 and doc["counts"]["6"] == 10
    assert abs(doc["shares"]["0"] - 0.1429) < 1e-9
    p = str(tmp_path / "report")
    IO.write_json_report(R.distribution_report(df), p)
    lines = [json.loads(x) for f in os.listdir(p) if f.startswith("part-") for x in open(os.path.join(p, f))]
    assert len(lines) == 7


def test_min_fields_read(spark, tmp_path):
    p = tmp_path / "syn.csv"
    p.write_text('ID,text,target\na,"x, y",1\nb,short\n\nc,,2\nd,z,\n')
    df = IO.read_min_fields(spark, str(p), ["ID", "text", "target"])
    assert sorted(map(tuple, df.collect())) == [("a", "x, y", "1"), ("c", None, "2"), ("d", "z", None)]
    q = tmp_path / "wide.csv"
    q.write_text("ID,text,target\na,x,1,extra\n")
    with pytest.raises(Exception, match="too many fields"):
        IO.read_min_fields(spark, str(q), ["ID", "text", "target"]).collect()
