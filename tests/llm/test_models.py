"""The two models against plain versions, and their training rows under odd doc_ids."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyline.llm import language_id, quality_model
from tidyline.llm.common import read_documents

SF = "/root/testdata/sf0.01"


def plain_em(patterns, steps):
    """Expectation maximisation written out: P(good), P(vote | class) with one added to each count."""
    good = {k: 0.1 if "-" in k else 0.9 for k in patterns}
    for _ in range(steps):
        theta, mass = {}, {0: 0.0, 1: 0.0}
        for c in (0, 1):
            for j in range(len(next(iter(patterns)))):
                seen = {v: 1.0 for v in "+0-"}
                for k, n in patterns.items():
                    seen[k[j]] += n * (good[k] if c == 0 else 1 - good[k])
                total = sum(seen.values())
                theta[c, j] = {v: x / total for v, x in seen.items()}
        for k, n in patterns.items():
            mass[0] += n * good[k]
            mass[1] += n * (1 - good[k])
        everything = sum(patterns.values()) + 2
        for k in patterns:
            like = [(mass[c] + 1) / everything * math.prod(theta[c, j][v] for j, v in enumerate(k)) for c in (0, 1)]
            good[k] = like[0] / sum(like)
    return good


@pytest.mark.parametrize("steps", [1, 7, 60])
def test_estimate_equals_plain_em(steps):
    r, counts = random.Random(steps), collections.Counter()
    for _ in range(500):
        good = r.random() < 0.7
        counts["".join(r.choices("+0-", (5, 3, 2) if good else (2, 3, 5))[0] for _ in range(4))] += 1
    got, want = quality_model.estimate(dict(counts), steps)[0], plain_em(counts, steps)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_scorer_equals_plain_steps():
    r = random.Random(1)
    x = [[r.random() for _ in range(5)] for _ in range(30)]
    y, n = [r.random() for _ in range(30)], [r.randint(1, 4) for _ in range(30)]
    up, down = sum(a * b for a, b in zip(n, y, strict=True)), sum(a * (1 - b) for a, b in zip(n, y, strict=True))
    w, b, vw, vb = [0.0] * 5, 0.0, [0.0] * 5, 0.0
    for _ in range(20):
        g = [(1 / (1 + math.exp(-(sum(p * q for p, q in zip(row, w, strict=True)) + b))) - t) * m * (t / up + (1 - t) / down) / 2 for row, t, m in zip(x, y, n, strict=True)]
        grad = [sum(g[i] * x[i][j] for i in range(30)) + 1e-3 * w[j] for j in range(5)]
        vw = [0.9 * v - 8.0 * d for v, d in zip(vw, grad, strict=True)]
        vb = 0.9 * vb - 8.0 * sum(g)
        w, b = [p + v for p, v in zip(w, vw, strict=True)], b + vb
    got_w, got_b = quality_model.fit_scorer(np.array(x, np.float32), np.array(y, np.float32), np.array(n, np.float32), steps=20)
    assert np.allclose(got_w, w, atol=1e-3) and abs(got_b - b) < 1e-3


def test_rows_that_stand_for_many():
    """A row of weight three fits as three equal rows do."""
    rng = np.random.default_rng(2)
    x, y = rng.random((20, 6)).astype(np.float32), rng.random(20).astype(np.float32)
    n = np.ones(20, np.float32)
    n[4] = 3
    a = quality_model.fit_scorer(x, y, n)
    b = quality_model.fit_scorer(np.vstack([x, x[[4, 4]]]), np.concatenate([y, y[[4, 4]]]), np.ones(22, np.float32))
    assert np.allclose(a[0], b[0], atol=1e-4)


def grams(text):
    """Presences without hashing: letter n-grams of one to three, blanks at word ends."""
    t = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    out = {("1", c) for c in t if c != " "} | {("2", t[i:i + 2]) for i in range(len(t) - 2)}
    return out | {("3", t[i:i + 3]) for i in range(len(t) - 2) if t[i + 1] != " "}


def test_kernel_equals_plain_presences():
    r = random.Random(3)
    texts = ["".join(r.choice("abcdeé  ,1") for _ in range(r.randint(5, 80))) for _ in range(25)]
    k = language_id.kernel(language_id.presences(texts), language_id.presences(texts))
    sets = [grams(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            want = len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))
            assert abs(k[i, j] - want) < 0.06  # 8,192 places, so two n-grams seldom share one


def test_ridge_equals_its_dual_form():
    """With every row a landmark the map is exact: f = K (K + l / w)^-1 y with K the kernel and a constant."""
    rng = np.random.default_rng(4)
    x = (rng.random((24, 200)) < 0.2).astype(np.float32)
    x[:, :8] = np.eye(3, 8, dtype=np.float32)[np.arange(24) % 3]
    lang, n = np.array(["b", "a", "c"])[np.arange(24) % 3], rng.integers(1, 4, 24).astype(float)
    langs, land, weights = language_id.fit_ridge(x, lang, n)
    got = language_id.kernel(x, land.astype(np.float32)) @ weights[:-1] + weights[-1]
    k = language_id.kernel(x, x).astype(float) + 1
    y = (lang[:, None] == np.array(langs)[None, :]).astype(float)
    w = n * np.array([n.sum() / 3 / n[lang == v].sum() for v in lang])
    want = k @ np.linalg.solve(k + language_id.RIDGE * n.sum() / 3 * np.diag(1 / w), y)
    assert np.allclose(got, want, atol=2e-3) and langs == ["a", "b", "c"]


def test_training_rows_are_capped_and_drawn_by_row(spark):
    docs = read_documents(spark, SF).select("doc_id", "text", "lang")
    labelled = quality_model.label(docs)
    assert len(quality_model.training_rows(labelled, 50)) == 50
    alike = quality_model.label(docs.limit(30).crossJoin(spark.range(4)).select("doc_id", "text"))
    assert {r[3] for r in quality_model.training_rows(alike, 10)} == {4}
    rows = language_id.training_rows(docs, sample=20, total=60)
    assert collections.Counter(r[0] for r in rows) == {v: 15 for v in ("de", "en", "es", "fr")}
    assert language_id.training_rows(docs.filter("doc_id is null")) == [] and quality_model.training_rows(quality_model.label(docs.filter("doc_id is null"))) == []


@pytest.mark.parametrize("doc_id", [None, 14])
def test_verdicts_do_not_need_doc_ids(spark, doc_id):
    """Equal or missing doc_ids: nearly all texts get the verdict that distinct ones give."""
    docs = read_documents(spark, SF).select("doc_id", "text", "lang")
    same = docs.select(F.lit(doc_id).cast("long").alias("doc_id"), "text", "lang")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = collections.Counter((texts[r["doc_id"]], r["kept"]) for r in quality_model.classify(docs).collect())
    got = quality_model.classify(same.withColumn("doc_id", F.lit(doc_id).cast("long")))
    kept = got.filter("kept").count()
    assert abs(kept - sum(n for (_, k), n in want.items() if k)) < 0.04 * len(texts) and 0 < kept < len(texts)
    if doc_id is None or doc_id % 5:  # rows to learn from
        preds = collections.Counter(r["lang_pred"] for r in language_id.identify(same).collect())
        truth = collections.Counter(r["lang"] for r in docs.collect())
        held = language_id.fold(F.lit(doc_id))
        if spark.range(1).select(held).first()[0]:
            assert all(abs(preds[v] - truth[v]) < 0.04 * len(texts) for v in truth)
