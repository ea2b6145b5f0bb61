"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

The terms of a text are its lower-cased words, by their 64-bit hashes; their
weights are their counts.  Sample k has for each term two Gamma(2, 1) variables r
and c and a uniform b, computed in the row from hashes of (term, k).  A weight S
falls into step t = floor(ln S / r + b), and the term with the least
a = c exp(-r (t - b + 1)) is drawn.  Two texts draw the same (term, t) with a
probability equal to their generalised Jaccard similarity.  The drawn value a
itself stands for (term, t): it is a function of both, and is kept as 32 bits of
its hash.

r and b come from two uniforms: with e1 = -ln v and e2 = -ln u, r = e1 + e2 is
Gamma(2, 1) and b = e1 / r is uniform and independent of it.  So
t = floor((ln S + e1) / r) and a = c u exp(-r t), which is c u for words that
occur once.

Texts are shuffled once, into ranges of doc_id that also give each document its
successor; terms, counts and samples stay in that partitioning.

Defined cases: a null text counts as empty; a text without words has a
fingerprint of its own, equal (1.0) to that of other such texts and to no other
(0.0); rows of equal doc_id follow each other by their text; null doc_ids come
last; an only document is its own successor; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyline.llm.common import id_ranges, plain_words

SAMPLES = 64
#: Samples that one row computes; more make generated code that is not compiled.
AT_ONCE = 8
SEED = 11
#: Documents in a range of doc_id, and ranges at most (a row of each is broadcast).
RANGE_DOCS = 500
MAX_RANGES = 20_000


def drawn_value(term: Column, s: Column, group: Column, k: int, seed: int = SEED) -> Column:
    """a of sample k of a group, at ln S = s (null: no word)."""
    one, two = (F.xxhash64(term, group, F.lit(2 * k + which), F.lit(seed)) for which in (0, 1))

    def uniform(h: Column, shift: int, bits: int) -> Column:
        return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1)) + 0.5) * (0.5 ** bits)

    u, c = uniform(one, 0, 22), -F.log(uniform(one, 22, 21) * uniform(one, 43, 21))
    e1 = -F.log(uniform(two, 0, 40))
    r = e1 - F.log(u)
    return c * u * F.when(s == 0, 1.0).when(s > 0, F.exp(-r * F.floor((s + e1) / r)))


def term_counts(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, term (its hash), n: the weighted terms; a text without words has one row of nulls."""
    term = F.explode_outer(plain_words(F.lower(F.col(text))))
    rows = texts.select(*keys, term.alias("word")).select(*keys, F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"))
    return rows.groupBy(*keys, "term").agg(F.count("*").alias("n"))


def sample(counts: DataFrame, keys: list[str], samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """keys and ``draws``: the least a of each sample (null without words)."""
    width = min(AT_ONCE, samples)
    rows = counts.select(*keys, "term", F.when(F.col("term").isNotNull(), F.log("n")).alias("s"),
                         F.explode(F.sequence(F.lit(0), F.lit(-(-samples // width) - 1))).alias("group"))

    drawn = rows.groupBy(*keys, "group").agg(*[
        F.min(drawn_value(F.col("term"), F.col("s"), F.col("group"), k, seed)).alias(f"d{k}") for k in range(width)])
    bits = [F.xxhash64(F.col(f"d{k}")).bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(width)]
    drawn = drawn.select(*keys, F.when(F.col("d0").isNotNull(), F.struct("group", F.array(*bits).alias("bits"))).alias("one"))
    of = drawn.groupBy(*keys).agg(F.sort_array(F.collect_list("one")).alias("all"))  # nulls are left out
    return of.select(*keys, F.when(F.size("all") > 0, F.slice(F.flatten("all.bits"), 1, samples)).alias("draws"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / samples
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(same)


def said(draws: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(draws, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""), F.lit(""))


def fingerprint(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and fingerprint of each row.  ``keys`` must name each row once."""
    return sample(term_counts(docs, keys, text), keys).select(*keys, said(F.col("draws")).alias("fingerprint"))


def ranged(docs: DataFrame) -> DataFrame:
    """doc_id, text and the range (part) of doc_id; each range also has, marked
    ``guest``, the first document of the range that follows in descending order."""
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = d.filter("doc_id is not null").count()
    part = id_ranges(d, min(MAX_RANGES, max(1, math.ceil(n / RANGE_DOCS)))) if n else F.lit(0).cast("long")
    part = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(part).cast("int").alias("part")
    d = d.select("doc_id", "text", part)
    # of each range (a row each, at most MAX_RANGES): its greatest id, and the range above it
    tops = d.groupBy("part").agg(F.max("doc_id").alias("_top"))
    up = Window.orderBy("part")
    tops = tops.select(F.col("part").alias("_from"), "_top", F.coalesce(F.lead("part").over(up), F.first("part").over(
        up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"))
    guests = d.join(F.broadcast(tops), (F.col("part") == F.col("_from")) & F.col("doc_id").eqNullSafe(F.col("_top"))).select(
        "doc_id", "text", F.col("_to").alias("part"), F.lit(True).alias("guest"))
    return d.withColumn("guest", F.lit(False)).unionByName(guests)


def with_edits(docs: DataFrame) -> DataFrame:
    """The contract's rows: each document's fingerprint, that of its edited text,
    and their likeness and the next document's."""
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = (ranged(docs).withColumns({"row": F.row_number().over(order), "next": F.lead("text").over(order)})
            .withColumns({"n_chars": F.length("text").cast("long"),
                          "edited": F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"),
                                             F.when(half > 0, F.substring(F.col("next"), F.lit(1), half)).otherwise(""))}))
    both = rows.select("part", "row", "doc_id", "guest", "n_chars", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("t"))
    both = both.select("part", "row", "doc_id", "guest", "n_chars", "t.side", "t.text").filter(~(F.col("guest") & (F.col("side") == 1)))
    keys = ["part", "row", "side"]
    counts = term_counts(both, keys)
    drawn = sample(counts, keys).groupBy("part", "row").agg(
        F.first(F.when(F.col("side") == 0, F.col("draws")), True).alias("own"), F.first(F.when(F.col("side") == 1, F.col("draws")), True).alias("edit"))
    facts = rows.select("part", "row", "doc_id", "guest", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    follow = Window.partitionBy("part").orderBy("row")
    out = facts.join(drawn, ["part", "row"]).withColumn("following", F.lead("own").over(follow))
    return out.filter(~F.col("guest")).select(
        "doc_id", "n_chars", "edited_sha256", said(F.col("own")).alias("fingerprint"), said(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))
