"""Places in a total order, and every prompt version."""

import random

import pytest
from pyspark.sql import functions as F

from tidyline.operators import prompts as PR
from tidyline.operators import split as SP


@pytest.mark.parametrize("parts", [1, 5])
def test_positions_are_those_of_a_sort(spark, parts):
    r = random.Random(1)
    rows = [(k, r.choice([None, 1, 2, 2, 2, 9]), "x" * r.randint(0, 3)) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, n int, t string").repartition(parts)
    got = {x["id"]: x["position"] for x in SP.with_position(df, [F.desc_nulls_last("n"), F.col("id")]).collect()}
    want = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    assert [got[x[0]] for x in want] == list(range(300))
    assert SP.with_position(df.filter("id < 0"), [F.col("id")]).collect() == []


def test_every_version_in_one_pass(spark, tmp_path):
    rows = [(1, "{target} a", 3), (2, None, None), (3, "", 0)]
    df = spark.createDataFrame(rows, "id long, text string, target int")
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    out = PR.render_versions(df, PR.templates(spark), {"{text}": F.col("text"), "{target}": F.col("target"), "{examples}": F.lit("{text}")})
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    got = {(r["id"], r["name"], r["version"]): (r["prompt"], r["prompt_system"]) for r in out.collect()}
    assert len(got) == 3 * len(PR.BUILTIN)
    for i, text, target in rows:
        for name, version, body, system in PR.BUILTIN:
            # what is filled in is not read as a placeholder
            want = body.replace("{target}", "\0").replace("{examples}", "\1").replace("{text}", text or "")
            assert got[(i, name, version)] == (want.replace("\0", "" if target is None else str(target)).replace("\1", "{text}"), system)
    one = PR.render_prompt(df, PR.templates(spark), "relabel", 1, "text", target="target").filter("id = 1").first()["prompt"]
    assert one == got[(1, "relabel", 1)][0] and "{target} a [주제]: 3" in one


def test_versions_differ():
    bodies = [b for _, _, b, _ in PR.BUILTIN]
    assert len(set(bodies)) == len(bodies) and all("{text}" in b for b in bodies)
    assert {(n, v) for n, v, _, _ in PR.BUILTIN} >= {("denoise", k) for k in range(1, 7)} | {("relabel", 1), ("augment", 1), ("synonyms", 1)}
