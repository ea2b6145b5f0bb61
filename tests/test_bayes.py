"""The counted classifier against plain Python."""

import collections
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidyline.operators import bayes as B


def grams(t):
    return [t[i:i + 2] for i in range(len(t or "") - 1)]


def plain(train, text, top):
    """pred and prob of ``text`` after counting ``train``, pairs of text and label."""
    counts, docs = collections.defaultdict(collections.Counter), collections.Counter()
    for t, y in train:
        docs[y] += 1
        counts[y].update(grams(t))
    v = len({g for c in counts.values() for g in c})
    log = lambda x: Decimal(f"{math.log(x):.9f}")
    s = {}
    for y in docs:
        n = sum(counts[y].values())
        s[y] = log(docs[y] / sum(docs.values())) - max(len(text or "") - 1, 0) * log(max(n + v, 1)) + sum((log(counts[y][g] + 1) for g in grams(text) if counts[y][g]), Decimal(0))
    best = max(s.values())
    e = {y: math.exp(float(x - best)) for y, x in s.items()}
    return min(y for y, x in s.items() if x == best), [round(e.get(y, 0.0) / sum(e.values()), 9) for y in range(top + 1)]


def rows(seed, n=60):
    r = random.Random(seed)
    alphabets = ("abc", "bcd", "xyé가나", "a b")
    out = []
    for k in range(n):
        y = r.choice((0, 1, 2, 4))
        out.append((k, "".join(r.choice(alphabets[y % 4]) for _ in range(r.randint(0, 9))) if k % 17 else None, y, k % 3))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_folds_by_subtraction(spark, seed):
    """The model of a fold is the one that counting the other folds gives."""
    data = rows(seed)
    df = spark.createDataFrame(data, "id long, text string, target int, fold int")
    got = {r["id"]: (r["pred"], r["prob"]) for r in B.predict(B.fit(df, "text", "target", "fold", 3), df, "text", "id", "fold").collect()}
    for k, t, _, f in data:
        pred, prob = plain([(x, y) for _, x, y, g in data if g != f], t, 4)
        assert got[k][0] == pred and got[k][1] == pytest.approx(prob, abs=2e-9)
    assert len(got) == len(data)


def test_no_fold_ties_and_new_characters(spark):
    data = rows(3)
    df = spark.createDataFrame(data, "id long, text string, target int, fold int")
    ask = [(1, "ααββ"), (2, ""), (3, None), (4, "abab"), (5, "가나가")]
    model = B.fit(df, "text", "target")
    got = {r["id"]: (r["pred"], r["prob"]) for r in B.predict(model, spark.createDataFrame(ask, "id long, text string"), "text", "id").collect()}
    for k, t in ask:
        pred, prob = plain([(x, y) for _, x, y, _ in data], t, 4)
        assert got[k][0] == pred and got[k][1] == pytest.approx(prob, abs=2e-9)
    tie = spark.createDataFrame([(0, "ab", 3), (1, "ab", 1)], "id long, text string, target int")
    assert [r["pred"] for r in B.predict(B.fit(tie, "text", "target"), tie, "text", "id").collect()] == [1, 1]


def test_order_of_rows_does_not_matter(spark):
    df = spark.createDataFrame(rows(4, 200), "id long, text string, target int, fold int")
    a, b = (sorted(map(str, B.oof_probs(d, "id", "text", "target", 3, 7).collect())) for d in (df.repartition(1), df.repartition(7, F.col("text"))))
    assert a == b


def test_crossfit_finds_planted_noise(spark):
    """Half of the rows like the flagged ones carry no flag; each is judged without its own half."""
    r = random.Random(5)
    data = [(k, "".join(r.choice("qxz#" if k % 4 < 2 else "aeiou") for _ in range(30)), 1 if k % 4 == 0 else 0) for k in range(200)]
    df = spark.createDataFrame(data, "id long, text string, is_noise int")
    out = {x["id"]: x for x in B.crossfit_noise(df, "id", "text", "is_noise", 3).collect()}
    hit = {k for k in out if out[k]["model_hit"]}
    # the unflagged copies teach "clean" too, so only the direction is fixed: no clean row is hit
    assert hit <= {k for k in range(200) if k % 4 == 1}
    assert all(out[k]["is_noise"] == (1 if k % 4 == 0 or k in hit else 0) for k in out)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string, target int")
    assert B.predict(B.fit(df, "text", "target"), df, "text", "id").collect() == []
