"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """id, root: for every id of the links (a, b) that is not the least of its
    component, that least id.

    Alternating stars: each id links its greater neighbours to the least of all its
    neighbours, then itself and its lesser neighbours to the least of those; stars
    are left when nothing changes.  Each step is an aggregation and a join, and its
    result is written, so that the plan does not grow."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = written(small.select("u", F.col("m").alias("v")).unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == (now["n"], now["h"]):
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        state = (now["n"], now["h"])
