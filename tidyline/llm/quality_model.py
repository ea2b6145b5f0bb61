"""Quality of texts from weak labels.

Eight heuristic labellers vote good, bad or nothing on every text.  Expectation
maximisation over the counts of all vote patterns (at most 3**8, over all
documents) estimates how each labeller votes on good and on bad texts.  The
posterior of a text's pattern is its label; on a bounded sample of labelled texts a
logistic scorer over hashed character shapes is fitted, which scores every text.
The sample holds ``SAMPLE`` different rows at most, drawn by a digest of doc_id and
text; equal rows are one of them, which weighs as many.

Defined cases: a null text, or one without words, has posterior and score 0 and
is not kept; repeated rows count each; doc_ids may be null or repeat; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import row_digest, written

DIMS = 4096
SAMPLE = 8000
LABELLERS = ("signs", "letters", "bars", "endings", "repeats", "variety", "capitals", "bangs")
STEPS = 60

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")
_CLASS[9:14] = 32
#: Last bytes of ordinary words.
_ENDS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;:!?") | frozenset(range(128, 256))


def vote(good: bool, bad: bool) -> str:
    return "-" if bad else "+" if good else "0"


def votes(text: bytes, c: np.ndarray) -> str | None:
    """One character for each labeller; None without words.  Defects are seen by
    two labellers or more each, and a labeller that sees none abstains."""
    words = text.split()
    if not words:
        return None
    n, w = np.bincount(c, minlength=256), len(words)
    letters, solid = int(n[ord("A")] + n[ord("a")]), max(1, len(text) - int(n[32]))
    signs = sum(int(n[ord(x)]) for x in "#*$%&<>@^~|=_{}[]") / w
    ends = sum(x[-1] in _ENDS for x in words) / w
    fresh = len(set(zip(words, words[1:], strict=False))) / max(1, w - 1)
    # distinct words of each hundred, so that long texts compare with short ones
    runs = [words[i:i + 100] for i in range(0, w, 100)]
    variety = sum(len(set(r)) for r in runs) / w
    upper = int(n[ord("A")]) / max(1, letters)
    return "".join((
        vote(False, signs > 0.3), vote(letters > 0.93 * solid, w >= 8 and letters < 0.85 * solid), vote(False, n[ord("|")] > 0.2 * w),
        vote(ends > 0.9, ends < 0.7), vote(False, w >= 8 and fresh < 0.5), vote(w >= 20 and variety > 0.6, w >= 8 and variety < 0.35),
        vote(False, upper > 0.5), vote(False, n[ord("!")] > 0.2 * w)))


def shapes(text: bytes, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the hashed shape pairs and triples of a text, and of
    the tenth in which its share of distinct words and word pairs lies."""
    words = text.split()
    w = max(1, len(words))
    tenths = [int(9.99 * len(set(zip(words, words[1:], strict=False))) / w), 16 + int(9.99 * sum(len(set(words[i:i + 100])) for i in range(0, w, 100)) / w)]
    a = c.astype(np.uint32)
    two = (a[:-1] << 8) | a[1:]
    three = (two[:-1] << 8) | a[2:]
    ids, n = np.unique(np.concatenate([two, three]), return_counts=True)
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = (h >> np.uint64(52)).astype(np.int64) % DIMS
    value = np.log1p(n * (1000.0 / max(1, len(c))))
    dense = np.bincount(at, value, minlength=DIMS)
    dense /= max(1e-9, np.sqrt((dense ** 2).sum()))
    dense[[(x * 0x9E3779B1 >> 7) % DIMS for x in tenths]] += 0.5
    where = np.flatnonzero(dense)
    return where.astype("<u2"), dense[where].astype("<f4")


def label(docs: DataFrame) -> DataFrame:
    """doc_id, row (a digest of doc_id and text), votes, and the hashed shapes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, at, value = [], [], []
            for t in batch.column(1):
                b = (t.as_py() or "").encode("utf-8", "replace")
                c = _CLASS[np.frombuffer(b, np.uint8)]
                said.append(votes(b, c))
                i, v = shapes(b, c) if said[-1] is not None else (np.zeros(0, "<u2"), np.zeros(0, "<f4"))
                at.append(i.tobytes())
                value.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(said, pa.string()), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
                                             names=["doc_id", "row", "votes", "at", "value"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row_digest().alias("row")).mapInArrow(
        run, "doc_id long, row binary, votes string, at binary, value binary")


def estimate(patterns: dict[str, int], steps: int = STEPS) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of good for each pattern, and P(vote | class) of each labeller
    (class good first; votes in the order +, 0, -)."""
    keys = sorted(patterns)
    if not keys:
        return {}, np.zeros((0, 2, 3))
    v = np.array([["+0-".index(x) for x in k] for k in keys])
    n = np.array([patterns[k] for k in keys], dtype=float)
    one = np.eye(3)[v]
    # begin: a text is bad if any labeller sees a defect
    p = np.array([0.1 if "-" in k else 0.9 for k in keys])
    for _ in range(steps):
        post = np.stack([p, 1 - p])
        theta = np.einsum("cp,p,pjv->jcv", post, n, one) + 1.0
        theta /= theta.sum(2, keepdims=True)
        prior = (post @ n + 1) / (n.sum() + 2)
        logs = np.log(prior)[:, None] + np.einsum("jcv,pjv->cp", np.log(theta), one)
        p = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
    return dict(zip(keys, p.tolist(), strict=True)), theta


def fit_scorer(x: np.ndarray, y: np.ndarray, n: np.ndarray, decay: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels of rows that stand for ``n`` each, by
    gradient steps with momentum; both classes weigh the same."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    vw, vb = np.zeros_like(w), 0.0
    weight = n * (y / max((n * y).sum(), 1e-9) + (1 - y) / max((n * (1 - y)).sum(), 1e-9)) / 2
    for _ in range(steps):
        g = (1 / (1 + np.exp(-(x @ w + b))) - y) * weight
        vw = 0.9 * vw - 8.0 * (x.T @ g + decay * w).astype(np.float32)
        vb = 0.9 * vb - 8.0 * float(g.sum())
        w, b = w + vw, b + vb
    return w, b


def training_rows(labelled: DataFrame, size: int = SAMPLE) -> list[tuple[str, bytes, bytes, int]]:
    """(votes, at, value, how many rows it stands for) of ``size`` different rows at
    most, those of the least draws; in the same order in every run."""
    each = labelled.filter("votes is not null").groupBy("row").agg(F.count("*").alias("n"))
    chosen = each.orderBy(F.xxhash64("row", F.lit("scorer")), "row").limit(size)  # a bounded top-k
    alike = labelled.join(F.broadcast(chosen), "row").groupBy("row").agg(*[F.first(c).alias(c) for c in ("votes", "at", "value", "n")])
    return sorted((r["votes"], bytes(r["at"]), bytes(r["value"]), r["n"]) for r in alike.collect())


def classify(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, votes, posterior, score and kept of every document."""
    labelled = written(label(docs), "weak-labels")
    counts = {r["votes"]: r["n"] for r in labelled.filter("votes is not null").groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _ = estimate(counts)
    rows = training_rows(labelled)
    x = np.zeros((len(rows), DIMS), dtype=np.float32)
    for k, (_, at, value, _) in enumerate(rows):
        x[k, np.frombuffer(at, "<u2")] = np.frombuffer(value, "<f4")
    # without a text with words there is nothing to fit, and no text is scored
    y, n = (np.array([f(r) for r in rows], dtype=np.float32) for f in (lambda r: posterior[r[0]], lambda r: r[3]))
    w, b = fit_scorer(x, y, n) if rows else (np.zeros(DIMS, np.float32), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = batch.column(2).to_pylist()
            score = [1 / (1 + np.exp(-(float(w[np.frombuffer(i, "<u2")] @ np.frombuffer(v, "<f4")) + b))) if s is not None else 0.0
                     for s, i, v in zip(said, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([posterior[s] if s is not None else 0.0 for s in said], pa.float64()),
                 pa.array(score, pa.float64()), pa.array([s >= threshold for s in score], pa.bool_())],
                names=["doc_id", "votes", "posterior", "score", "kept"])

    return labelled.mapInArrow(run, "doc_id long, votes string, posterior double, score double, kept boolean")
