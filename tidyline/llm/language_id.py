"""Language of texts by string kernels.

The kernel of two texts is the number of letter n-grams (one to three letters,
blanks at word ends count as letters) that both hold, over the geometric mean of
their own numbers: a blended spectrum of presences, hashed to ``DIMS`` places.
A Nystroem map on ``LANDMARKS`` training texts makes it linear, one-versus-rest
ridge regression on the map gives a score for each language, and texts are
scored in batches by two matrix products.

The model is fitted on at most ``SAMPLE`` different rows of each language and
``TOTAL`` in all, one of each language at least (the documented bounds); they are
drawn by a digest of doc_id and text, and equal rows are one that weighs as many.
Only their presences, one bit per place, reach the driver.  Prediction reads the
text alone.

Defined cases: a null text or one without letters is ``und`` with score 0;
without any labelled text every text is ``und``; equal texts get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyline.llm.common import process_state, row_digest, written

DIMS = 8192
LANDMARKS = 256
SAMPLE = 800
TOTAL = 6400
RIDGE = 1e-2
FOLDS = 5
#: Texts scored in one matrix product.
BATCH = 256


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def presences(texts: list[str]) -> np.ndarray:
    """One row of zeros and ones per text; a row without letters is all zero."""
    letters = process_state("letters", _letters)
    x = np.zeros((len(texts), DIMS), dtype=np.float32)
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text)), 1 << 20):  # very long texts: memory stays bounded
            part = text[max(0, at - 2):at + (1 << 20)].lower()
            c = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
            c = np.where(letters[c], c, 32).astype(np.uint32)
            c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
            if len(c) < 3:
                continue
            a, b, d = c[:-2], c[1:-1], c[2:]
            two = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA6B)
            for h, ok in ((b * np.uint32(0xC2B2AE35) + np.uint32(1), b != 32), (two + np.uint32(2), (a != 32) | (b != 32)),
                          (two * np.uint32(0x27D4EB2F) + d * np.uint32(0x165667B1) + np.uint32(3), b != 32)):
                h = h[ok]
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                h ^= h >> np.uint32(13)
                x[k, h % np.uint32(DIMS)] = 1
    return x


def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    nx, ny = np.sqrt(np.maximum(x.sum(1), 1)), np.sqrt(np.maximum(y.sum(1), 1))
    return (x @ y.T) / nx[:, None] / ny[None, :]


def fit_ridge(x: np.ndarray, lang: np.ndarray, n: np.ndarray, seed: int = 7) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, landmark rows, and the weights of the landmark kernels (a row
    more for the constant).  Row i stands for ``n[i]`` texts.  Landmarks: as many texts of
    each language."""
    langs = sorted(set(lang.tolist()))
    rng = np.random.default_rng(seed)
    marks = np.concatenate([rng.permutation(np.flatnonzero(lang == v))[: max(1, LANDMARKS // len(langs))] for v in langs])
    land = x[marks]
    values, vectors = np.linalg.eigh(kernel(land, land).astype(np.float64))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([kernel(x, land) @ root, np.ones((len(x), 1))])
    y = (lang[:, None] == np.array(langs)[None, :]).astype(np.float64)
    # each language weighs the same
    w = n * (n.sum() / len(langs) / (n[:, None] * y).sum(0))[y.argmax(1)]
    beta = np.linalg.solve((phi * w[:, None]).T @ phi + RIDGE * n.sum() / len(langs) * np.eye(phi.shape[1]), (phi * w[:, None]).T @ y)
    return langs, land.astype(np.uint8), np.vstack([root @ beta[:-1], beta[-1:]]).astype(np.float32)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def training_rows(docs: DataFrame, sample: int = SAMPLE, total: int = TOTAL) -> list[tuple[str, bytes, int]]:
    """(lang, presences as bits, how many rows it stands for) of the rows to learn from;
    in the same order in every run."""
    train = docs.select("text", "lang", "doc_id").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0)) \
                .select("lang", "text", row_digest().alias("row"))
    each = written(train.groupBy("lang", "row").agg(F.count("*").alias("n")).withColumn("_draw", F.xxhash64("row", F.lit("sample"))), "language-rows")
    counts = written(each.groupBy("lang").agg(F.count("*").alias("_rows")), "language-counts")  # a row a language
    langs = counts.count()
    if not langs:
        return []
    # the least draws of each language; those beyond some eight times the wanted share cannot be among them
    size = max(1, min(sample, total // langs))
    bound = F.lit(-(2.0 ** 63)) + F.lit(2.0 ** 64) * F.lit(8.0 * max(size, 8)) / F.col("_rows")
    few = each.join(counts, "lang").filter(F.col("_draw").cast("double") <= bound).drop("_rows")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "row"))
    chosen = few.withColumn("_nth", nth).filter(F.col("_nth") <= size).drop("_nth", "_draw")
    chosen = written(chosen, "language-sample")  # Spark sends it to all tasks while it is small

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                b = batch.slice(at, BATCH)
                x = np.packbits(presences(b.column(3).to_pylist()).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "row", "n", "x"])

    rows = train.join(chosen, ["lang", "row"]).select("lang", "row", "n", "text").mapInArrow(bits, "lang string, row binary, n long, x binary")
    alike = rows.groupBy("lang", "row").agg(F.first("n").alias("n"), F.first("x").alias("x"))
    return sorted((r["lang"], bytes(r["x"]), r["n"]) for r in alike.collect())


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    rows = training_rows(docs)
    if not rows:
        return None
    x = np.unpackbits(np.array([np.frombuffer(r[1], np.uint8) for r in rows]), axis=1).astype(np.float32)
    some = x.sum(1) > 0
    lang, n = np.array([r[0] for r in rows], dtype=object)[some].astype(str), np.array([r[2] for r in rows], dtype=np.float64)[some]
    return fit_ridge(x[some], lang, n) if some.any() else None


def predict(docs: DataFrame, model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred and score."""
    if model is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    langs, land, weights = model
    packed, shape = np.packbits(land.astype(bool)).tobytes(), land.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*langs, "und"], dtype=object)
        marks = np.unpackbits(np.frombuffer(packed, np.uint8))[: shape[0] * shape[1]].reshape(shape).astype(np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                b = batch.slice(at, BATCH)
                x = presences([t or "" for t in b.column(b.num_columns - 1).to_pylist()])
                raw = np.clip(kernel(x, marks) @ weights[:-1] + weights[-1], 1e-6, None)
                best, some = raw.argmax(1), x.any(1)
                score = np.where(some, raw.max(1) / raw.sum(1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], pa.array(names[np.where(some, best, len(langs))], pa.string()), pa.array(score.astype(np.float64))],
                    names=[*keep, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def identify(docs: DataFrame) -> DataFrame:
    out = predict(docs, fit(docs))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
