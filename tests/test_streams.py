"""Runs that stop and go on; versions of the frequent set on a stream."""

import collections
import os

from pyspark.sql import functions as F

from tidyline.operators import detect as D
from tidyline.streaming import frequent as FR
from tidyline.streaming.resume import resumable_generate


def model():
    def upper_model():  # a local function, which goes to the workers by value
        return lambda texts: [t.upper() for t in texts]
    return upper_model


def epochs(out):
    return sorted(int(x.split("=")[1]) for x in os.listdir(out) if x.startswith("epoch="))


def test_stop_goes_on_where_it_was(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id long, t string").repartition(8, "id").write.parquet(src)
    first = resumable_generate(spark, src, out, "id", "t", model(), bytes_per_trigger=1, max_batches=3)
    n = first.count()
    assert 0 < n < 40 and epochs(out) == [0, 1, 2]
    stamps = {e: os.stat(os.path.join(out, f"epoch={e}")).st_mtime_ns for e in (0, 1, 2)}
    rest = resumable_generate(spark, src, out, "id", "t", model(), bytes_per_trigger=1 << 30)
    assert sorted(r["generated"] for r in rest.collect()) == sorted(f"T{i}" for i in range(40))
    # the interrupted batch is done as it was planned, the rest in one batch; what was done is not done again
    assert epochs(out)[:4] == [0, 1, 2, 3] and {e: os.stat(os.path.join(out, f"epoch={e}")).st_mtime_ns for e in (0, 1, 2)} == stamps


def test_micro_batches_by_bytes(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id long, t string").repartition(8, "id").write.parquet(src)
    size = sum(os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".parquet"))
    for share, low, high in ((size * 2, 1, 1), (size // 3, 3, 5)):
        out = str(tmp_path / f"out{share}")
        assert resumable_generate(spark, src, out, "id", "t", model(), bytes_per_trigger=share).count() == 40
        assert low <= len(epochs(out)) <= high


def test_glob_names_a_folder(spark, tmp_path):
    """A table may be a folder of part files with names of their own; its neighbours are not read."""
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id long, t string").repartition(4, "id")
    rows.write.parquet(str(tmp_path / "src" / "docs.parquet"))
    rows.withColumn("t", F.lit("other")).write.parquet(str(tmp_path / "src" / "pages.parquet"))
    for _ in range(2):  # the second run finds all done
        out = resumable_generate(spark, str(tmp_path / "src"), str(tmp_path / "out"), "id", "t", model(), glob="docs.parquet")
        assert sorted(r["generated"] for r in out.collect()) == sorted(f"T{i}" for i in range(20))


def test_versions_equal_batch_sets(spark, tmp_path):
    src, sets, out = (str(tmp_path / n) for n in ("src", "sets", "out"))
    parts = [[(1, "가…가…·나", 0)], [(2, "…·다·", 1), (3, None, 1)], [(4, "plain", 2), (5, "％·…％", 2)]]
    schema, seen = "id long, text string, part int", []
    for k, rows in enumerate(parts):
        seen += rows
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        version = FR.publish_frequent(spark, src, sets, min_count=3)
        counts = collections.Counter("".join(c for _, t, _ in seen for c in t or "" if c in "…·％"))
        assert FR.frozen(spark, sets, version).first()["chars"] == "".join(sorted(c for c, n in counts.items() if n >= 3))
        scored = FR.detect_stream(spark, src, sets, out)
        assert scored.count() == len(seen) and scored.filter(F.col("part") == k).select("version").distinct().collect()[0][0] == version
    # scored again later against its own version, a row has the same stage
    for v in [r["version"] for r in scored.select("version").distinct().collect()]:
        rows = scored.filter(F.col("version") == v)
        again = D.detect_noise(rows.select("id", "text"), "text", frequent=FR.frozen(spark, sets, v))
        assert {(r["id"], r["stage"]) for r in rows.collect()} == {(r["id"], r["stage"]) for r in again.collect()}
    # nothing new: no new version, nothing scored twice
    assert FR.publish_frequent(spark, src, sets, min_count=3) == version
    assert FR.detect_stream(spark, src, sets, out).count() == len(seen)
