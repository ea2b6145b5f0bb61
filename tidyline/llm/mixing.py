"""Mixing sources to target weights, in DataFrame functions only.

Documents are leaves' members in a tree domain - language - source.  The budget
goes down the tree: at each node it is shared among the children by weight, no
child gets more than it can supply (its tokens times ``max_epochs``), and what
one cannot take goes to its siblings in proportion to their weights; only what
all of them cannot take stays with the ancestor, whose own siblings take it.
(This water level is found in closed form from cumulative sums over the children
in the order of supply per weight.)  A leaf then takes whole epochs of its
documents and, of the epoch after them, the longest prefix of a seeded order
whose tokens fit its allotment.

Weights are the square root of the tokens of each child unless a table of
weights is given, which pulls small sources up; the domain is the source without
its last digit unless a column is named.

A leaf may hold a third of all rows, so the prefix is cut in two steps: documents
fall into 4096 slots of the seeded order, slot sums are cumulated, and only within
one slot of one leaf are documents cumulated.

Defined cases: null source, language or domain are values of their own; a null
text, or one without words, has no tokens and follows its place in the order;
repeated rows are separate documents in the order of their texts; an empty table
gives no rows; columns of the input are not looked at but for those named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyline.llm.common import WORD, nested, written

SEED = 20
MAX_EPOCHS = 2
#: Tokens of the mixture, as a share of all tokens.
SHARE = 0.8
LEVELS = ("domain", "lang", "source")
NONE = "?"


def default_domain() -> Column:
    return F.regexp_replace("source", "[0-9]$", "")


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def share_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Give each child its part of the parent's ``budget``.

    ``children``: the parent's columns, the child's, ``budget`` (of the parent),
    ``supply`` and ``weight``.  A child is full if its supply is at most its part
    of what is left after the full ones before it."""
    w = Window.partitionBy(*parent).orderBy(F.col("supply") / F.col("weight"), child)
    all_of = Window.partitionBy(*parent)
    before = lambda c: F.sum(c).over(w) - F.col(c)
    part = (F.col("budget") - F.col("_s")) * F.col("weight") / (F.col("_all") - F.col("_w"))
    full = F.col("supply") <= part
    out = children.withColumns({"_s": before("supply"), "_w": before("weight"), "_all": F.sum("weight").over(all_of)}).withColumn("_full", full)
    held = out.withColumns({"_fs": F.sum(F.when(F.col("_full"), F.col("supply")).otherwise(0.0)).over(all_of),
                            "_fw": F.sum(F.when(F.col("_full"), F.col("weight")).otherwise(0.0)).over(all_of)})
    level = (F.col("budget") - F.col("_fs")) * F.col("weight") / (F.col("_all") - F.col("_fw"))
    return held.withColumn("budget", F.when(F.col("_full"), F.col("supply")).otherwise(F.least(F.col("supply"), F.floor(level).cast("double"))))


def _checked(weights: DataFrame) -> DataFrame:
    """The weights as one row a node."""
    one = weights.groupBy("level", "name").agg(F.count("*").alias("_n"), F.first("weight").cast("double").alias("weight"))
    sound = (F.col("_n") == 1) & F.coalesce(F.col("weight") > 0, F.lit(False)) & F.coalesce(F.col("level").isin(*LEVELS), F.lit(False)) & F.col("name").isNotNull()
    bad = one.filter(~sound).first()
    if bad:
        raise ValueError(f"weights name a node twice, none of a level, or have no weight above 0: {bad['level']} {bad['name']}")
    return one.select("level", "name", "weight")


def allot(leaves: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, weights: DataFrame | None = None) -> DataFrame:
    """The allotment of each leaf.  ``leaves``: domain, lang, source, n_docs, n_tokens.
    ``weights``: level (domain, lang or source), name and weight.  A name stands for the nodes of that name
    under every parent; a path such as ``web/en/web3`` stands for one node and goes before.  Nodes not named weigh the
    root of their tokens.  A node named twice, a name or level that is not there, or a weight that is
    not above 0 is an error."""
    spec = leaves.select(*LEVELS, "n_docs", "n_tokens")
    weights = None if weights is None else _checked(weights)
    # the root's budget: one row of the total for all leaves (a table of leaves, not of documents)
    out = spec.join(F.broadcast(spec.agg(F.floor(F.sum("n_tokens") * F.lit(share)).cast("double").alias("budget"))))
    for k, level in enumerate(LEVELS):
        node, parent = list(LEVELS[: k + 1]), list(LEVELS[:k])
        at = out.groupBy(*node).agg(F.first("budget").alias("budget"), (F.sum("n_tokens") * F.lit(max_epochs)).cast("double").alias("supply"),
                                    F.greatest(F.sqrt(F.sum("n_tokens").cast("double")), F.lit(1.0)).alias("weight"))
        if weights is not None:
            own = weights.filter(F.col("level") == level).select(F.col("name").alias("_name"), F.col("weight").alias("_own"))
            by_path = own.select(F.col("_name").alias("_path"), F.col("_own").alias("_by_path"))
            at = (at.join(own, F.col(level) == F.col("_name"), "left").join(by_path, F.concat_ws("/", *node) == F.col("_path"), "left")
                  .withColumn("weight", F.coalesce("_by_path", "_own", "weight")).drop("_name", "_own", "_path", "_by_path"))
        at = share_out(at, parent or [F.lit(0)], level).select(*node, F.col("budget").alias("_b"))
        out = out.join(at, node).withColumn("budget", F.col("_b")).drop("_b")
    return out.withColumn("allotment", F.col("budget").cast("long")).drop("budget")


def plan(docs: DataFrame, domain: Column | None = None, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
         weights: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, leaf, n_tokens, the leaf's allotment and ``copies``: how often the
    document is taken (0: not at all)."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    d = written(docs.select("doc_id", name(domain if domain is not None else default_domain()).alias("domain"), name(F.col("lang")).alias("lang"),
                            name(F.col("source")).alias("source"), tokens(F.col("text")).alias("n_tokens"), F.xxhash64("doc_id", "text").alias("_key")), "mix")
    leaves = d.groupBy(*LEVELS).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    alloted = written(allot(leaves, share, max_epochs, weights), "mix-leaves").select(
        *LEVELS, "allotment", F.when(F.col("n_tokens") > 0, F.floor(F.col("allotment") / F.col("n_tokens"))).otherwise(0).cast("long").alias("epochs"),
        F.col("n_tokens").alias("_leaf"))
    alloted = alloted.withColumn("rest", F.col("allotment") - F.col("epochs") * F.col("_leaf")).drop("_leaf")
    # the epoch after the whole ones has an order of its own
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(NONE))).cast("binary"))
    dealt = d.join(alloted, list(LEVELS)).withColumn("_o", order).withColumn("_slot", F.substring("_o", 1, 3))
    slots = dealt.groupBy(*LEVELS, "_slot").agg(F.sum("n_tokens").alias("_n"))
    # at most 4096 rows for each leaf
    start = slots.withColumn("_before", F.sum("_n").over(Window.partitionBy(*LEVELS).orderBy("_slot")) - F.col("_n")).drop("_n")
    inside = Window.partitionBy(*LEVELS, "_slot").orderBy("_o", "doc_id", "_key").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum("n_tokens").over(inside)
    return (dealt.join(start, [*LEVELS, "_slot"]).withColumn("copies", (F.col("epochs") + (upto <= F.col("rest")).cast("long")))
            .select("doc_id", *LEVELS, "n_tokens", "allotment", "copies", "_key"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, each as often as it is taken."""
    chosen = plan(docs, **how).groupBy("_key").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_n")).filter("_copies > 0")
    # equal rows (doc_id and text) share their copies
    alike = Window.partitionBy("_key").orderBy(F.lit(0))
    rows = nested(docs).withColumn("_key", F.xxhash64("_row.doc_id", "_row.text")).withColumn("_i", F.row_number().over(alike))
    take = F.floor(F.col("_copies") / F.col("_n")) + (F.col("_i") <= F.col("_copies") % F.col("_n")).cast("int")
    both = rows.join(chosen, "_key").withColumn("_take", take.cast("int")).filter("_take > 0")
    return both.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_take")))).select("_row.*")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_replace(source, '[0-9]$', ''), '?') AS domain, coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS n_tokens FROM d GROUP BY ALL),
d1 AS (SELECT domain, (SELECT floor(sum(n_tokens) * {SHARE}) FROM leaf)::DOUBLE AS budget, (sum(n_tokens) * {MAX_EPOCHS})::DOUBLE AS supply,
              greatest(sqrt(sum(n_tokens)::DOUBLE), 1.0) AS weight FROM leaf GROUP BY domain),
a1 AS (SELECT *, supply <= (budget - s) * weight / (al - w) AS fl FROM (
  SELECT *, sum(supply) OVER x - supply AS s, sum(weight) OVER x - weight AS w, sum(weight) OVER () AS al FROM d1 WINDOW x AS (ORDER BY supply / weight, domain))),
b1 AS (SELECT domain, CASE WHEN fl THEN supply ELSE least(supply, floor((budget - fs) * weight / (al - fw))) END AS budget FROM (
  SELECT *, sum(CASE WHEN fl THEN supply ELSE 0 END) OVER () AS fs, sum(CASE WHEN fl THEN weight ELSE 0 END) OVER () AS fw FROM a1)),
d2 AS (SELECT domain, lang, any_value(budget) AS budget, (sum(n_tokens) * {MAX_EPOCHS})::DOUBLE AS supply,
              greatest(sqrt(sum(n_tokens)::DOUBLE), 1.0) AS weight FROM leaf JOIN b1 USING (domain) GROUP BY domain, lang),
a2 AS (SELECT *, supply <= (budget - s) * weight / (al - w) AS fl FROM (
  SELECT *, sum(supply) OVER x - supply AS s, sum(weight) OVER x - weight AS w, sum(weight) OVER (PARTITION BY domain) AS al FROM d2
  WINDOW x AS (PARTITION BY domain ORDER BY supply / weight, lang))),
b2 AS (SELECT domain, lang, CASE WHEN fl THEN supply ELSE least(supply, floor((budget - fs) * weight / (al - fw))) END AS budget FROM (
  SELECT *, sum(CASE WHEN fl THEN supply ELSE 0 END) OVER y AS fs, sum(CASE WHEN fl THEN weight ELSE 0 END) OVER y AS fw FROM a2 WINDOW y AS (PARTITION BY domain))),
d3 AS (SELECT domain, lang, source, budget, (n_tokens * {MAX_EPOCHS})::DOUBLE AS supply, greatest(sqrt(n_tokens::DOUBLE), 1.0) AS weight, n_tokens
       FROM leaf JOIN b2 USING (domain, lang)),
a3 AS (SELECT *, supply <= (budget - s) * weight / (al - w) AS fl FROM (
  SELECT *, sum(supply) OVER x - supply AS s, sum(weight) OVER x - weight AS w, sum(weight) OVER (PARTITION BY domain, lang) AS al FROM d3
  WINDOW x AS (PARTITION BY domain, lang ORDER BY supply / weight, source))),
b3 AS (SELECT domain, lang, source, n_tokens AS leaf_tokens, CASE WHEN fl THEN supply ELSE least(supply, floor((budget - fs) * weight / (al - fw))) END::BIGINT AS allotment FROM (
  SELECT *, sum(CASE WHEN fl THEN supply ELSE 0 END) OVER y AS fs, sum(CASE WHEN fl THEN weight ELSE 0 END) OVER y AS fw FROM a3 WINDOW y AS (PARTITION BY domain, lang))),
e AS (SELECT *, CASE WHEN leaf_tokens > 0 THEN allotment // leaf_tokens ELSE 0 END AS epochs FROM b3),
o AS (SELECT d.*, allotment, epochs, allotment - epochs * leaf_tokens AS rest,
             md5('{SEED}' || ':' || epochs || ':' || coalesce(doc_id::VARCHAR, '?')) AS o FROM d JOIN e USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, allotment,
       (epochs + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM o"""
