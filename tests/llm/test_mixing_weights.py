"""Target weights down the tree against plain water levels; tables whose columns have the operators' own names."""

import collections

import pytest
from pyspark.sql import functions as F

from tidyline.llm import mixing, near_dedup, quality_rules

DOCS = [(k, "w " * (5 + k % 7), ("en", "de", "fr")[k % 3], f"{'web' if k % 4 else 'book'}{k % 5}") for k in range(400)]
W = "level string, name string, weight double"


def level_of(budget, children):
    """Shares by weight; who is full leaves the rest to the others.  children: name -> (supply, weight)."""
    out, open_ = {}, dict(children)
    while open_:
        total = sum(w for _, w in open_.values())
        left = budget - sum(out.values())
        full = [c for c, (s, w) in open_.items() if s <= left * w / total]
        if not full:
            return out | {c: min(s, int(left * w / total + 1e-9)) for c, (s, w) in open_.items()}
        for c in sorted(full, key=lambda c: open_[c][0] / open_[c][1])[:1]:
            out[c] = open_.pop(c)[0]
    return out


def plain(weights, share=0.8, epochs=2):
    leaf = collections.Counter()
    for _, t, lang, source in DOCS:
        leaf[source[:-1], lang, source] += len(t.split())
    budget = {(): float(int(sum(leaf.values()) * share))}
    for depth, level in enumerate(("domain", "lang", "source"), 1):
        nodes = collections.Counter()
        for path, n in leaf.items():
            nodes[path[:depth]] += n
        for parent in list(budget):
            if len(parent) == depth - 1:
                kids = {p: (n * epochs, weights.get((level, "/".join(p)), weights.get((level, p[-1]), n ** 0.5))) for p, n in nodes.items() if p[:-1] == parent}
                budget |= level_of(budget[parent], kids)
    return {p: int(b) for p, b in budget.items() if len(p) == 3}


@pytest.mark.parametrize("weights", [{}, {("domain", "web"): 9.0, ("domain", "book"): 1.0}, {("lang", "de"): 300.0, ("source", "web3"): 0.5},
                                     {("lang", "en"): 5.0, ("lang", "web/en"): 200.0, ("source", "book/fr/book0"): 1000.0}])
def test_weights_against_plain_levels(spark, weights):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    table = spark.createDataFrame([(k, n, w) for (k, n), w in weights.items()], W) if weights else None
    rows = mixing.plan(docs, weights=table).collect()
    assert len(rows) == len(DOCS)
    want = plain(weights)
    got = {(r["domain"], r["lang"], r["source"]): r["allotment"] for r in rows}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) <= 1 for p in want)
    taken = collections.Counter()
    for r in rows:
        taken[r["domain"], r["lang"], r["source"]] += r["copies"] * r["n_tokens"]
    assert all(want[p] - 12 <= taken[p] <= want[p] + 1 for p in want)


@pytest.mark.parametrize("bad", [[("lang", "de", 1.0), ("lang", "de", 1.0)], [("lang", "de", 0.0)], [("lang", "de", None)], [("host", "de", 1.0)], [("lang", None, 1.0)]])
def test_unsound_weights_fail(spark, bad):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    with pytest.raises(Exception, match="weights name a node twice"):
        mixing.plan(docs, weights=spark.createDataFrame(bad, W)).collect()


def test_columns_with_the_operators_names(spark):
    names = ["_n", "_key", "_copies", "_i", "_take", "_again", "_gone", "_host", "_w", "_l", "_row", "_src", "_txt", "host", "n", "row"]
    docs = spark.createDataFrame(DOCS[:40], "doc_id long, text string, lang string, source string").select("*", *[F.lit(c).alias(c) for c in names])
    for f in (lambda d: mixing.mix(d, share=1.0, max_epochs=1), near_dedup.kept_rows, quality_rules.kept_rows, quality_rules.judge):
        got = f(docs)
        assert got.columns[: len(docs.columns)] == docs.columns
        assert all(r[c] == c for r in got.collect() for c in names)
    assert 38 <= mixing.mix(docs, share=1.0, max_epochs=1).count() <= 40  # budgets are whole tokens
