"""L1: an incremental, resumable model run.

The reference writes its result every 100 rows and, on restart, continues
after the last valid index.  Here the input folder is a file stream source;
each micro-batch goes through the batch hook (J10) and is written to its own
``epoch=N`` folder with overwrite, so a retried epoch replaces its own output
(exactly-once at the sink).  Progress lives in the streaming checkpoint inside
the output folder, so a restarted job continues where it stopped, and an output
never meets another run's progress.
``trigger(availableNow=True)`` processes what is there and stops.

A micro-batch takes files up to a number of bytes, so that a large folder is no
single batch, and a stop loses one batch at most.

Rule operators (C*, B*, F1 with a frozen frequent set) are row-local, so they
can be applied to the streaming DataFrame before the hook as well."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidyline.operators.infer import batch_generate
from tidyline.operators.joins import without_key


#: Bytes of files that a micro-batch takes at most (one file at least).
BATCH_BYTES = 64 << 30
STOPPED = "the run was stopped after its last micro-batch"


def resumable_generate(spark: SparkSession, src: str, out: str, key: str, prompt: str, make_fn,
                       files_per_trigger: int | None = None, bytes_per_trigger: int = BATCH_BYTES,
                       batch_size: int = 32, prepare=None, glob: str | None = None, max_batches: int | None = None) -> DataFrame:
    """Run the hook over every row of the Parquet files in folder ``src``
    (optionally only files, or else folders, matching ``glob``) that has not been done yet;
    returns the full result read back from ``out``.  A micro-batch holds
    ``files_per_trigger`` files, or else files of ``bytes_per_trigger`` bytes.  On a
    restart, rows that failed are redone first (into ``epoch=-1``, ``-2``, ...) and
    the newest redo of a key wins; ``key`` names each row once.  ``max_batches``
    ends the run after so many micro-batches with the next one begun, as the loss
    of the driver would; a restart goes on there."""
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    try:
        schema = r.parquet(src).schema
    except AnalysisException:
        if not glob:
            raise
        # ``glob`` names folders (tables of many files), whose files have other names
        src, glob, r = os.path.join(src, glob), None, spark.read
        schema = r.parquet(src).schema
    rs = spark.readStream.schema(schema)
    rs = rs.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else rs.option("maxBytesPerTrigger", bytes_per_trigger)
    if glob:
        rs = rs.option("pathGlobFilter", glob)
    stream = rs.parquet(src)
    if prepare is not None:
        stream = prepare(stream)
    try:
        done = spark.read.parquet(out)
    except AnalysisException:  # a first run
        done = None
    redo = 0  # the last redo, as an epoch
    if done is not None:
        redo = min(0, done.agg(F.min("epoch")).first()[0] or 0)
        rows = r.parquet(src)
        done = _newest(done, key, redo)
        failed = pending((prepare(rows) if prepare else rows).join(done.select(key).distinct(), key, "left_semi"), done, key)
        if not failed.isEmpty():
            redo -= 1
            res = batch_generate(failed, key, prompt, make_fn, "generated", batch_size)
            res.write.mode("overwrite").parquet(os.path.join(out, f"epoch={redo}"))
    ckpt = os.path.join(out, "_checkpoint")  # readers of ``out`` skip names with an underscore

    n_done = 0

    def each(batch: DataFrame, epoch: int) -> None:
        nonlocal n_done
        if max_batches is not None and n_done == max_batches:
            raise RuntimeError(STOPPED)
        n_done += 1
        res = batch_generate(batch, key, prompt, make_fn, "generated", batch_size)
        res.write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch}"))

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except StreamingQueryException as e:
        if STOPPED not in str(e):
            raise
    return _newest(spark.read.parquet(out), key, redo).drop("epoch")


def _newest(results: DataFrame, key: str, redo: int) -> DataFrame:
    """Of keys that were redone, the rows of the newest redo only."""
    if not redo:
        return results
    again = results.filter("epoch < 0").withColumn("_nth", F.rank().over(Window.partitionBy(key).orderBy("epoch"))).filter("_nth = 1").drop("_nth")
    return without_key(results.filter("epoch >= 0"), again, key).unionByName(again)


def pending(df: DataFrame, done: DataFrame, key: str, out: str = "generated") -> DataFrame:
    """Batch form (G7): rows not done yet, plus rows whose output failed
    (empty or with an error), which are redone."""
    ok = done.filter((F.col("error").isNull()) & (F.coalesce(F.length(out), F.lit(0)) > 0))
    return without_key(df, ok, key)
