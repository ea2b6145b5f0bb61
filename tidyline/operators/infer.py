"""Batch inference hook (J10), two-step maps (J11), the denoise job.

The model is a caller-supplied Python function over a list of strings, built
once per partition; rows reach it in Arrow batches through ``mapInPandas``.
This is the one Python path of the engine (a model cannot run in the JVM)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.functions import text as T
from tidyline.operators import joins as J
from tidyline.operators import prompts as PR

GenerateFn = Callable[[list[str]], list[str]]


def batch_generate(df: DataFrame, key: str, prompt: str, make_fn: Callable[[], GenerateFn],
                   out: str = "generated", batch_size: int = 32) -> DataFrame:
    """(key, out, error).  ``make_fn()`` is called once per partition and
    returns a function from a list of prompts to a list of outputs.  A batch
    that raises is retried row by row; a row that still raises gets "" and
    its error message (the run goes on)."""
    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, {out} string, error string"

    def run(it):
        fn = make_fn()
        for pdf in it:
            keys, texts = pdf[key].tolist(), pdf[prompt].tolist()
            outs: list[str] = []
            errs: list[str | None] = []
            for s in range(0, len(texts), batch_size):
                for one, to in zip(_answers(fn, texts[s:s + batch_size]), (outs, errs), strict=True):
                    to += one
            yield pd.DataFrame({key: keys, out: outs, "error": errs})

    return df.select(key, prompt).mapInPandas(run, schema)


def _answers(fn: GenerateFn, texts: list) -> tuple[list[str], list[str | None]]:
    """The outputs of one batch and its errors; a batch that raises goes row by row."""
    chunk = ["" if t is None else t for t in texts]
    try:
        res = list(fn(chunk))
        if len(res) != len(chunk):
            raise ValueError("model returned a different number of outputs")
        return [str(r) for r in res], [None] * len(chunk)
    except Exception:  # noqa: BLE001 - fall back to one row at a time
        outs, errs = [], []
        for t in chunk:
            try:
                outs.append(str(fn([t])[0]))
                errs.append(None)
            except Exception as e:  # noqa: BLE001
                outs.append("")
                errs.append(f"{type(e).__name__}: {e}")
        return outs, errs


#: Characters of a batch at most, each text counted as long as the longest of its batch.
PADDED_CHARS = 1 << 18


def batch_generate_by_length(df: DataFrame, key: str, prompt: str, make_fn: Callable[[], GenerateFn], out: str = "generated",
                             padded_chars: int = PADDED_CHARS, parts: int | None = None) -> DataFrame:
    """J10 with batches of texts of like length: (key, out, error, padded).

    A model pads the texts of a batch to the longest one.  Rows are dealt by ranges of
    length (equal lengths by key, so that a frequent length is split), sorted within
    them, and cut into batches whose rows times longest text stay within
    ``padded_chars``; a longer text is a batch of its own.  Outputs are those of
    :func:`batch_generate`; ``padded`` is what a row's text was padded to, so
    ``1 - sum(length) / sum(padded)`` is the share of padding."""
    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, {out} string, error string, padded long"
    length = F.coalesce(F.length(prompt), F.lit(0))
    rows = df.select(key, prompt).withColumn("_n", length)
    rows = rows.repartitionByRange(parts, "_n", key) if parts else rows.repartitionByRange("_n", key)

    def run(it):
        fn = make_fn()
        keys, texts, longest = [], [], 0

        def flush() -> pd.DataFrame:
            outs, errs = _answers(fn, texts)
            made = pd.DataFrame({key: keys, out: outs, "error": errs, "padded": [longest] * len(keys)})
            keys.clear()
            texts.clear()
            return made

        for pdf in it:
            for k, t, n in zip(pdf[key].tolist(), pdf[prompt].tolist(), pdf["_n"].tolist(), strict=True):
                if texts and n * (len(texts) + 1) > padded_chars:  # rows come in order of length
                    yield flush()
                keys.append(k)
                texts.append(t)
                longest = n
        if texts:
            yield flush()

    return rows.sortWithinPartitions("_n", key).mapInPandas(run, schema)


def padding_share(generated: DataFrame, texts: DataFrame, key: str, prompt: str) -> DataFrame:
    """One row ``padding``: the share of padded characters that no text fills."""
    n = texts.agg(F.sum(F.coalesce(F.length(prompt), F.lit(0))).alias("_n"))
    padded = generated.agg(F.sum("padded").alias("_p"))
    return padded.crossJoin(n).select(F.coalesce(1 - F.try_divide(F.col("_n"), F.col("_p")), F.lit(0.0)).alias("padding"))


def two_step(df: DataFrame, key: str, text: str, make_f, make_g, out: str = "back_translation",
             batch_size: int = 32) -> DataFrame:
    """g(f(text)) through the hook twice, joined back by key, with the
    ``error`` of a step that failed; such a row keeps its text."""
    a = batch_generate(df, key, text, make_f, "_mid", batch_size).withColumnRenamed("error", "_first")
    b = batch_generate(a.filter("_first is null"), key, "_mid", make_g, out, batch_size)
    b = b.unionByName(a.filter("_first is not null").select(key, F.lit("").alias(out), F.col("_first").alias("error")))
    # a row that failed in either step keeps its text
    return df.join(b, key, "left").withColumn(out, F.when(F.col("error").isNull(), F.col(out)).otherwise(F.col(text)))


def denoise_job(df: DataFrame, key: str, text: str, label: str, flag: str, make_fn,
                templates: DataFrame, version: int = 1, batch_size: int = 16) -> DataFrame:
    """Noisy rows -> prompt -> model -> answer extraction (C10); clean rows
    pass; both recombined (K5) with whitespace normalised, and ``error``: a row
    whose generation failed keeps its text."""
    noisy = df.filter(F.col(flag) == 1)
    clean = df.filter(~F.col(flag).eqNullSafe(1))
    p = PR.render_prompt(noisy, templates, "denoise", version, text)
    g = batch_generate(p, key, "prompt", make_fn, "_gen", batch_size)
    answer = F.when(F.col("error").isNull(), T.extract_answer("_gen")).otherwise(F.col(text)).alias(text)
    fixed = noisy.join(g, key).select(key, answer, label, "error")
    done = J.recombine(clean, fixed, key, text, label)
    return done.join(fixed.select(key, "error"), key, "left")
