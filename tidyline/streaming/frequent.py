"""The cascade on a stream: character counts as state, frozen sets by version.

The frequent set that the cascade removes depends on all data seen so far.  One
streaming query keeps the count of every character as state and publishes the
set after each micro-batch as a new version, a one-row table.  Versions never
change, so rows are scored against a named version: :func:`detect_stream` scores
each new file with the newest version at its start and writes that version with
the rows, and the same rows can be scored again later with the same result.

The state holds one row per distinct character of a class, so it is bounded by
Unicode, not by the stream.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyline.functions import profiles as P
from tidyline.operators import detect as D
from tidyline.streaming.resume import BATCH_BYTES

VERSION_SCHEMA = "chars string, version long"


def _run(stream: DataFrame, mode: str, each, checkpoint: str) -> None:
    """What is there now, then stop."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _files(spark: SparkSession, src: str, schema: T.StructType, bytes_per_trigger: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(src)


def publish_frequent(spark: SparkSession, src: str, sets: str, text: str = "text", cls: str = "special_ko",
                     min_count: int = P.FREQUENT_MIN_COUNT, bytes_per_trigger: int = BATCH_BYTES) -> int | None:
    """Count the files in ``src`` that are new since the last run and publish the
    frequent set of everything counted so far, a version per micro-batch, into
    ``sets``.  Returns the newest version.  A batch that is run again after a
    failure replaces its own version."""
    files = _files(spark, src, spark.read.parquet(src).schema, bytes_per_trigger)
    counts = D.char_frequency(files.select(D.without_hanja(text).alias("_t")), "_t", cls)

    def each(batch: DataFrame, epoch: int) -> None:
        D.char_set(batch.filter(F.col("n") >= min_count)).write.mode("overwrite").parquet(os.path.join(sets, f"version={epoch}"))

    _run(counts, "complete", each, os.path.join(sets, "_checkpoint"))
    return newest(spark, sets)


def versions(spark: SparkSession, sets: str) -> DataFrame:
    """version, chars of every published set."""
    return spark.read.schema(VERSION_SCHEMA).parquet(sets)


def newest(spark: SparkSession, sets: str) -> int | None:
    return versions(spark, sets).agg(F.max("version")).first()[0]


def frozen(spark: SparkSession, sets: str, version: int) -> DataFrame:
    """The one-row set of a version, as :func:`tidyline.operators.detect.detect_noise` takes it."""
    return versions(spark, sets).filter(F.col("version") == version).select("chars")


def detect_stream(spark: SparkSession, src: str, sets: str, out: str, text: str = "text", cls: str = "special_ko",
                  bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """Score the files in ``src`` that are new since the last run with the newest
    frozen set; returns all rows scored so far with ``stage``, ``is_noise`` and the
    ``version`` of the set."""
    schema, version = spark.read.parquet(src).schema, newest(spark, sets)

    def each(batch: DataFrame, epoch: int) -> None:
        scored = D.detect_noise(batch, text, cls, frequent=frozen(spark, sets, version)).withColumn("version", F.lit(version).cast("long"))
        scored.write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch}"))

    _run(_files(spark, src, schema, bytes_per_trigger), "append", each, os.path.join(out, "_checkpoint"))
    return spark.read.parquet(out).drop("epoch")
