"""Host-level quality rules, in DataFrame functions only.

Each text gets counts and a rule failure; failures are summed by host (the
``source`` column), the host's failure rate is shrunk towards an empirical beta
prior, and the host's verdict is joined back to its documents.

Defined cases: a null text counts as empty and fails (no words); documents whose
host is null share one host of that name; a host with few documents is drawn to
the mean of all hosts; repeated rows count each; an empty table gives no rows;
other columns pass through, and columns of the same names as those added here
are replaced in ``judge`` and left alone in ``kept_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import SPACES, let, nested, plain_words, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A host is rejected if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: The prior weighs at most so many documents (hosts that hardly differ would give an endless weight).
MAX_PRIOR_WEIGHT = 1000.0
#: Up to so many different repeated windows a text looks them up one by one, beyond it sorts.
FEW = 64


def _equal_next(s: Column) -> Column:
    """Values of a sorted array that equal the one before them."""
    n = F.greatest(F.size(s) - 1, F.lit(0))
    return F.filter(F.zip_with(F.slice(s, 1, n), F.slice(s, 2, n), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())


def _starts(h: Column) -> Column:
    """Positions (from 0) of the windows that occur twice or more, ascending.
    ``h`` holds a hash of each window."""
    said = lambda x: x.isNotNull()
    few = lambda dup: F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(dup, x), i)), said)

    def many() -> Column:
        # sort (hash, position), keep those that equal a neighbour
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        n = F.size(h)
        return let(pairs, lambda p: F.array_sort(F.filter(F.zip_with(
            F.zip_with(p, F.slice(p, 2, n), lambda a, b: F.struct(a["i"].alias("i"), a["x"].alias("x"), b["x"].alias("up"))),
            F.concat(F.array(F.lit(None).cast("struct<x: bigint, i: int>")), F.slice(p, 1, n - 1)),
            lambda a, b: F.when((a["x"] == a["up"]) | (a["x"] == b["x"]), a["i"])), said)))

    dups = let(F.array_sort(h), lambda s: F.array_distinct(_equal_next(s)))
    none = F.array().cast("array<int>")
    return let(dups, lambda dup: F.when(F.size(dup) == 0, none).when(F.size(dup) <= FEW, few(dup)).otherwise(many()))


def _covered(d: Column) -> Column:
    """Words in windows of three that start at the ascending positions ``d``."""
    n = F.size(d)
    gaps = F.aggregate(F.zip_with(F.slice(d, 1, n - 1), F.slice(d, 2, n - 1), lambda a, b: F.least(F.lit(3), b - a)),
                       F.lit(3).cast("long"), lambda s, x: s + x.cast("long"))
    return F.when(n > 0, gaps).otherwise(F.lit(0).cast("long"))


def count_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    keep = docs.withColumns({
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "_l": F.transform(lines, lambda x: F.xxhash64(x)),
        "_w": plain_words(F.col(text)),
    })
    w = F.col("_w")
    n = F.size(w)
    at = lambda k: F.slice(w, k, n - 2)
    windows = F.zip_with(F.zip_with(at(1), at(2), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), at(3),
                         lambda p, c: F.xxhash64(p["a"], p["b"], c))
    repeats = let(windows, lambda h: let(_starts(h), _covered))
    return (keep
            .withColumns({"n_words": n.cast("long"), "n_repeat_words": F.when(n >= 3, repeats).otherwise(F.lit(0).cast("long")),
                          "n_dup_lines": let(F.col("_l"), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")})
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
            .drop("_l", "_w"))


def host_verdicts(counted: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, failures, rate shrunk by the beta prior, verdict.

    The prior comes from the moments of the host rates, weighed by documents: m is
    the share of all documents that fail, v the spread of the rates about it less
    what chance alone gives (m(1-m)/n for a host of n documents).  They give the
    weight m(1-m)/v - 1, held between 0 and ``MAX_PRIOR_WEIGHT``; without any spread
    beyond chance it is the latter."""
    hosts = counted.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    mean = hosts.agg((F.sum("n_failed") / F.sum("n_docs")).alias("m"), F.sum("n_docs").alias("_docs"), F.count("*").alias("_hosts"))
    # the mean and the prior are one row each
    spread = hosts.join(F.broadcast(mean)).agg(F.first("m").alias("m"), (
        (F.sum(F.col("n_docs") * (rate - F.col("m")) * (rate - F.col("m"))) - F.first("_hosts") * F.first("m") * (1 - F.first("m"))) / F.first("_docs")).alias("v"))
    weight = F.when(F.col("v") > 0, F.greatest(F.lit(0.0), F.least(F.lit(MAX_PRIOR_WEIGHT), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))).otherwise(F.lit(MAX_PRIOR_WEIGHT))
    prior = spread.select("m", weight.alias("weight"))
    return (hosts.join(F.broadcast(prior))
            .withColumn("host_rate", (F.col("n_failed") + F.col("m") * F.col("weight")) / (F.col("n_docs") + F.col("weight")))
            .withColumn("host_ok", F.col("host_rate") <= max_rate)
            .select("host", "n_docs", "n_failed", "host_rate", "host_ok"))


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "host_ok", "kept")


def _judged(counted: DataFrame, host: str, max_rate: float) -> DataFrame:
    # the table of hosts is written first: Spark broadcasts it if its size is below the threshold, else shuffles
    hosts = written(host_verdicts(counted, host, max_rate), "hosts").select(F.col("host").alias("_host"), "host_rate", "host_ok")
    return (counted.join(hosts, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_ok"), F.lit(True))))


def judge(docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``docs`` with the counts, base_failed, the host's rate and kept."""
    docs = docs.drop(*[c for c in ADDED if c not in (host, text)])
    return _judged(count_rules(nested(docs), f"_row.`{text}`"), f"_row.`{host}`", max_rate).select("_row.*", *ADDED)


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, counts and verdict of every document; texts are read once."""
    counted = written(count_rules(docs.select("doc_id", "source", "text")).drop("text"), "counted")
    return _judged(counted, "source", MAX_HOST_RATE).select(
        "doc_id", *ADDED[:6], "kept", F.round("host_rate", 6).alias("host_rate"))


def kept_rows(docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows that pass, with the columns of ``docs`` only.  The rules are counted once: rows are written with
    their own verdict, from which the hosts' verdicts and the result are read."""
    rows = written(count_rules(nested(docs), f"_row.`{text}`").select("_row", "base_failed"), "judged-rows")
    hosts = written(host_verdicts(rows, f"_row.`{host}`", max_rate).filter(~F.col("host_ok")), "bad-hosts")
    passed = rows.filter(~F.col("base_failed"))
    return passed.join(hosts.select(F.col("host").alias("_host")), F.col(f"_row.`{host}`").eqNullSafe(F.col("_host")), "left_anti").select("_row.*")


ORACLE = rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g),
p AS (SELECT doc_id, count(DISTINCT p) AS n_repeat FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM d WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
c AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat, 0)::BIGINT AS n_repeat_words FROM t JOIN l USING (doc_id) LEFT JOIN p USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f GROUP BY source),
m AS (SELECT sum(k) / sum(n) AS m, sum(n) AS docs, count(*) AS hosts FROM h),
v AS (SELECT any_value(m) AS m, (sum(n * (k / n - m) * (k / n - m)) - any_value(hosts) * any_value(m) * (1 - any_value(m))) / any_value(docs) AS v FROM h, m),
b AS (SELECT m, CASE WHEN v > 0 THEN greatest(0, least({MAX_PRIOR_WEIGHT}, m * (1 - m) / v - 1)) ELSE {MAX_PRIOR_WEIGHT} END AS s FROM v),
r AS (SELECT source, (k + m * s) / (n + s) AS rate FROM h, b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= {MAX_HOST_RATE} AS kept, round(rate, 6) AS host_rate
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source"""
