"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyline.session import scratch_path

#: The white space of the contracts: blank and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: the lineage
    is cut, lost executors cost nothing, and Spark knows its size, so that it
    broadcasts the frame only if it is below the threshold."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plain_words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def row_digest(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of a row's doc_id and text: rows differ in it unless they are equal."""
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.unhex(F.md5(key))


def nested(docs: DataFrame) -> DataFrame:
    """The rows as one column ``_row``, so that no name of theirs meets one that is added."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


#: A key is hot if it holds more than this part of all rows.
HOT = 2000


def join_counted(rows: DataFrame, table: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has for each key, once, the number ``n`` of its rows (and is left without
    it).  Keys that hold more than a ``HOT``-th of the ``total`` rows go to all tasks instead of meeting in one; there are
    fewer than ``HOT`` of them whatever the input, so that side is bounded."""
    bound = total // HOT
    hot, cold = table.filter(F.col("n") > bound).drop("n"), table.filter(F.col("n") <= bound).drop("n")
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


def process_state(name: str, make):
    """A value that a Python worker process keeps between tasks (a tokenizer and
    its memo, for example); it holds nothing that results depend on."""
    home = sys.modules.setdefault("_tidyline_state", types.ModuleType("_tidyline_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once.  Within a lambda an outer
    expression would be computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Bounds of ranges that a plan holds as literals at most; finer ranges divide those evenly.
MAX_BOUNDS = 2000


def id_ranges(docs: DataFrame, parts: int, key: str = "doc_id") -> Column:
    """The number of the range in which ``key`` (a long) lies, about ``parts`` in
    all, ascending with the key; 0 for null.  Bounds are approximate percentiles."""
    n = min(parts, MAX_BOUNDS)
    at = [k / n for k in range(n + 1)]
    bounds = docs.agg(F.percentile_approx(key, at, 10 * MAX_BOUNDS)).first()[0] or [0]
    cut = sorted(set(bounds))
    if len(cut) < 2:
        return F.when(F.col(key).isNotNull(), F.when(F.col(key) <= int(cut[0]), 0).otherwise(1)).otherwise(0).cast("long")
    ends = F.array(*[F.lit(int(b)) for b in cut]).cast("array<bigint>")
    part = F.size(F.filter(ends, lambda b: b < F.col(key)))  # 0: up to the least bound
    if parts <= n:
        return F.when(F.col(key).isNotNull(), part).otherwise(0).cast("long")
    fine = -(-parts // n)

    def inside(p: Column) -> Column:
        lo, hi = F.get(ends, p - 1), F.get(ends, p)
        at = F.floor((F.col(key) - lo - 1).cast("double") / (hi - lo).cast("double") * fine)
        return p.cast("long") * fine + F.coalesce(F.greatest(F.lit(0), F.least(F.lit(fine - 1), at)), F.lit(0))

    return F.when(F.col(key).isNotNull(), let(part, inside)).otherwise(0).cast("long")
