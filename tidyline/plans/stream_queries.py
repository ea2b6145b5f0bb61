"""Registered queries: runs that stop and go on, and the cascade on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.plans import common as C
from tidyline.plans import sqlfrag as S
from tidyline.plans.learn_queries import normalise_model
from tidyline.plans.registry import register
from tidyline.session import scratch_path
from tidyline.streaming import frequent as FR
from tidyline.streaming.resume import resumable_generate


def flaky_model():
    """A stand-in model that fails on texts of even length, else normalises."""
    normalise = normalise_model()

    def fn(texts):
        if any(len(t) % 2 == 0 for t in texts):
            raise ValueError("even length")
        return normalise(texts)
    return fn


@register("stop_and_resume_docs", f"""
SELECT doc_id, {S.collapse_ws('text')} AS generated, NULL::VARCHAR AS error,
  true AS stopped_early, true AS had_failures FROM documents
""")
def stop_and_resume_docs(spark, sf_dir):
    """A run over a folder of files is stopped after some micro-batches, and its
    model fails on texts of even length; the restart redoes these rows, then
    reads the other files."""
    src, out = scratch_path(spark, "stop-src"), scratch_path(spark, "stop-out")
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    d.repartition(4 * spark.sparkContext.defaultParallelism, "doc_id").write.parquet(src)
    # bytes of a sixth of the folder, but one file at least, to a batch
    sizes = spark.read.parquet(src).select("_metadata.file_path", "_metadata.file_size").distinct()
    share = max(1, (sizes.agg(F.sum("file_size")).first()[0] or 0) // 6)
    done = resumable_generate(spark, src, out, "doc_id", "text", flaky_model, bytes_per_trigger=share, max_batches=2)
    seen = done.agg(F.count("*").alias("n"), F.count("error").alias("failed")).first()
    result = resumable_generate(spark, src, out, "doc_id", "text", normalise_model, bytes_per_trigger=share)
    return result.withColumns({"stopped_early": F.lit(seen["n"] < result.count()), "had_failures": F.lit(seen["failed"] > 0)})


_PARTS = 3


def _versions_sql() -> str:
    ctes = ", ".join(f"d{v} AS (SELECT * FROM d WHERE doc_id % {_PARTS} <= {v}), fq{v} AS ({S.frequent_chars_cte(f'd{v}', 'text')})" for v in range(_PARTS))
    fq = " UNION ALL ".join(f"SELECT {v} AS part, chars FROM fq{v}" for v in range(_PARTS))
    return f"""
WITH d AS ({C.HANGUL_DOCS_SQL}), {ctes}, fq AS ({fq}),
f AS (SELECT d.*, fq.chars, translate({S.without_hanja('d.text')}, fq.chars, '') AS filtered_text FROM d JOIN fq ON fq.part = d.doc_id % {_PARTS})
"""


@register("stream_stages_docs", _versions_sql() + f"""
SELECT doc_id, {S.stage('text', 'filtered_text')} AS stage, chars FROM f
""")
def stream_stages_docs(spark, sf_dir):
    """Documents arrive in three parts.  After each the counts go on
    from their state and a new frequent set is published; the part is scored
    with it.  Each row shows the set that it was scored with."""
    src, sets, out = (scratch_path(spark, f"stream-{n}") for n in ("src", "sets", "out"))
    d = C.hangul_docs(spark, sf_dir).select("doc_id", "text")
    for part in range(_PARTS):
        d.filter(F.col("doc_id") % _PARTS == part).write.mode("append").parquet(src)
        FR.publish_frequent(spark, src, sets)
        scored = FR.detect_stream(spark, src, sets, out)
    chars = FR.versions(spark, sets).withColumnRenamed("version", "_v")  # a row a version
    return scored.join(chars, F.col("version") == F.col("_v")).select("doc_id", "stage", "chars")
