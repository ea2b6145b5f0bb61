"""Sources and sinks.

Reads always pass an explicit schema (never ``inferSchema``); CSV is read the
way the reference's files are written: header, comma, quotes doubled inside of
quotes, newlines allowed there.  Files with quoted newlines are read by byte
ranges (:mod:`tidyline.sources.csv_records`), so that a large file is no single
task; ``multi_line=False`` takes each line as a record, in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyline.session import sized
from tidyline.sources import csv_records

# The core row and its common extensions.
CORE_SCHEMA = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("target", T.IntegerType()),
])
NOISE_SCHEMA = T.StructType(CORE_SCHEMA.fields + [T.StructField("is_noise", T.IntegerType())])

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _csv(spark: SparkSession, path: str, schema: T.StructType | str, mode: str, multi_line: bool, ranges: int | None,
         corrupt: str | None = None) -> DataFrame:
    """The rows of CSV files with a header, parsed by ``schema``."""
    named = {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
    if not multi_line:
        return spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", mode).options(**named).csv(path)
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    row = F.from_csv("record", ddl, {"escape": '"', "mode": mode, "multiLine": "true", **named})
    return csv_records.read_records(spark, path, ranges).filter(~F.col("first")).select(row.alias("row")).select("row.*")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str | None = None,
               mode: str = "PERMISSIVE", multi_line: bool = True, ranges: int | None = None) -> DataFrame:
    """A1/A2: CSV or Parquet by extension; ``mode='FAILFAST'`` for typed reads."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "parquet":
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    if schema is None:
        raise ValueError("CSV reads need an explicit schema")
    return _csv(spark, path, schema, mode, multi_line, ranges)


def read_with_bad_rows(spark: SparkSession, path: str, schema: T.StructType, corrupt: str = "_corrupt",
                       multi_line: bool = True, ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A3: PERMISSIVE read; returns (good rows, malformed rows with raw text)."""
    s = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    # parsed once, with all columns: Spark finds malformed fields only in columns that it reads
    df = sized(_csv(spark, path, s, "PERMISSIVE", multi_line, ranges, corrupt))
    good = df.filter(F.col(corrupt).isNull()).drop(corrupt)
    bad = df.filter(F.col(corrupt).isNotNull()).select(corrupt)
    return good, bad


def read_min_fields(spark: SparkSession, path: str, names: list[str], min_fields: int = 3,
                    multi_line: bool = True, ranges: int | None = None) -> DataFrame:
    """A3: rows with fewer than ``min_fields`` fields are skipped; a row with
    more fields than ``names`` fails the job (in plan).

    The schema carries one extra column: a row with too many fields fills it;
    every other row is then short of the schema, so Spark keeps its raw text
    in ``_corrupt``, whose fields are counted outside quotes."""
    cols = [T.StructField(n, T.StringType()) for n in names]
    schema = T.StructType(cols + [T.StructField("_extra", T.StringType()),
                                  T.StructField("_corrupt", T.StringType())])
    raw = sized(_csv(spark, path, schema, "PERMISSIVE", multi_line, ranges, "_corrupt"))
    unquoted = F.regexp_replace(F.col("_corrupt"), '"(?:[^"]|"")*+"', "")
    n_fields = F.regexp_count(unquoted, F.lit(",")) + 1
    keep = F.col("_corrupt").isNotNull() & (n_fields >= min_fields) & (n_fields <= len(names))
    # one CASE, so the check cannot be reordered behind the row filter
    cond = F.when(F.col("_extra").isNotNull(),
                  F.raise_error(F.lit("row with too many fields")).cast("boolean")).otherwise(keep)
    return raw.filter(cond).drop("_extra", "_corrupt")


def read_positional(spark: SparkSession, path: str, names: list[str], positions: list[int],
                    multi_line: bool = True, ranges: int | None = None) -> DataFrame:
    """A4: skip the header, keep columns by position (0-based), rename."""
    n = max(positions) + 1
    # one more column takes what follows; rows may have more fields than are asked for
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(n + 1)])
    raw = _csv(spark, path, schema, "PERMISSIVE", multi_line, ranges)
    return raw.select(*[F.col(f"c{p}").alias(name) for p, name in zip(positions, names, strict=True)])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write Parquet or CSV (header, no index).  Splitting by a flag is
    one ``partitionBy`` write, not two filtered passes."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def write_split_by_flag(df: DataFrame, path: str, flag: str = "is_noise", fmt: str = "parquet") -> None:
    """One write, one folder per flag value."""
    write_table(df, path, fmt=fmt, partition_by=[flag])


def json_report(report: DataFrame) -> DataFrame:
    """One JSON string per row of a report frame (``to_json(struct(*))``)."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("json"))


def write_json_report(report: DataFrame, path: str) -> None:
    json_report(report).coalesce(1).write.mode("overwrite").text(path)
