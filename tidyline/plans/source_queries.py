"""Registered queries: files written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyline.plans import common as C
from tidyline.plans.registry import register
from tidyline.session import scratch_path
from tidyline.sources import io as IO
from tidyline.sources.sink import write_committed

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long"


def many(spark: SparkSession) -> int:
    """Ranges that a folder is cut into at least: several per core."""
    return 4 * spark.sparkContext.defaultParallelism


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")


@register("csv_quoted_newlines_docs", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_quoted_newlines_docs(spark, sf_dir):
    """A1, A2, A5: whole documents, with their newlines and quotes, as CSV; read
    back typed, each file by many byte ranges."""
    path = scratch_path(spark, "csv-docs")
    IO.write_table(docs(spark, sf_dir), path, fmt="csv")
    return IO.read_table(spark, path, DOCS_DDL, fmt="csv", mode="FAILFAST", ranges=many(spark))


def quoted(c) -> F.Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def write_lines(df: DataFrame, header: str, record: F.Column, path: str) -> None:
    """Records as text, with the header before each file's first one."""
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # of its partition, thus of its file
    line = F.when(first, F.concat(F.lit(header + "\n"), record)).otherwise(record)
    df.select(line.alias("value")).write.text(path)


@register("csv_bad_rows_docs", """
SELECT doc_id, CASE WHEN doc_id % 9 = 4 THEN 'bad' ELSE 'good' END AS kind, CASE WHEN doc_id % 9 = 4 THEN NULL ELSE text END AS text FROM documents
""")
def csv_bad_rows_docs(spark, sf_dir):
    """A3: documents of which some have a word for a number; good rows typed, bad ones as raw text."""
    d, path = docs(spark, sf_dir), scratch_path(spark, "csv-bad")
    n = F.when(F.col("doc_id") % 9 == 4, "many").otherwise(F.col("n_chars").cast("string"))
    write_lines(d, "doc_id,text,n_chars", F.concat_ws(",", "doc_id", quoted("text"), n), path)
    schema = spark.createDataFrame([], "doc_id long, text string, n_chars long").schema
    good, bad = IO.read_with_bad_rows(spark, path, schema, ranges=many(spark))
    raw = bad.select(F.regexp_extract("_corrupt", "^([0-9]+),", 1).cast("long").alias("doc_id"), F.lit("bad").alias("kind"), F.lit(None).cast("string").alias("text"))
    return good.select("doc_id", F.lit("good").alias("kind"), "text").unionByName(raw)


@register("csv_short_rows_docs", """
SELECT CAST(doc_id AS VARCHAR) AS "ID", text, lang AS target FROM documents WHERE doc_id % 5 <> 2
""")
def csv_short_rows_docs(spark, sf_dir):
    """A3: rows with fewer than three fields are skipped."""
    d, path = docs(spark, sf_dir), scratch_path(spark, "csv-short")
    record = F.when(F.col("doc_id") % 5 == 2, F.concat_ws(",", "doc_id", quoted("text"))).otherwise(F.concat_ws(",", "doc_id", quoted("text"), "lang"))
    write_lines(d, "ID,text,target", record, path)
    return IO.read_min_fields(spark, path, ["ID", "text", "target"], ranges=many(spark))


@register("csv_by_position_docs", "SELECT text, CAST(n_chars AS VARCHAR) AS target FROM documents")
def csv_by_position_docs(spark, sf_dir):
    """A4: columns by their place, the header skipped."""
    path = scratch_path(spark, "csv-position")
    IO.write_table(docs(spark, sf_dir), path, fmt="csv")
    return IO.read_positional(spark, path, ["text", "target"], [1, 4], ranges=many(spark))


@register("csv_committed_by_flag_docs", """
SELECT doc_id, text, n_chars, CAST(CASE WHEN n_chars < 1000 THEN 1 ELSE 0 END AS INTEGER) AS is_noise FROM documents
""")
def csv_committed_by_flag_docs(spark, sf_dir):
    """One folder a flag, with byte-order marks, published at once; each folder read back."""
    path = scratch_path(spark, "csv-committed")
    flagged = docs(spark, sf_dir).select("doc_id", "text", "n_chars", (F.col("n_chars") < 1000).cast("int").alias("is_noise"))
    write_committed(flagged, path, by="is_noise", bom=True)
    parts = [IO.read_table(spark, f"{path}/is_noise={v}", "doc_id long, text string, n_chars long", fmt="csv", mode="FAILFAST", ranges=many(spark))
             .withColumn("is_noise", F.lit(v)) for v in (0, 1)]
    return parts[0].unionByName(parts[1])
