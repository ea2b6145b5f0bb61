"""Synonym replacement (J6) and its table against plain versions, and their plans."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.functions.draws import GOLDEN, M32, MIX
from tidyline.operators import augment as A

SEED = 13


def draw(key, slot, i):
    x = (int(hashlib.md5(f"{key}:{SEED}".encode()).hexdigest()[8 * slot:8 * slot + 8], 16) + i * GOLDEN) % M32
    for _ in range(2):
        x = ((x ^ (x >> 16)) * MIX) % M32
    return x ^ (x >> 16)


def brute(key, text, syn, ratio=0.3):
    if text is None:
        return None
    return " ".join(syn[w][draw(key, 1, i) % len(syn[w])] if key is not None and w in syn and draw(key, 0, i) < A.threshold(ratio) else w
                    for i, w in enumerate(text.split()))


def random_rows(n=200):
    r = random.Random(5)
    gaps = [" ", "  ", "\n", "\t", " ", "　", "\x1c", "  "]
    words = ["a", "bb", "ccc", "가", "é", "𝒳", ","]
    text = lambda: r.choice(["", " ", "\n"]) + "".join(r.choice(words) + r.choice(gaps) for _ in range(r.randint(0, 60)))
    return [(k, text()) for k in range(n)] + [(n, None), (n + 1, ""), (n + 2, " \n"), (None, "a a a a a a a a"), (7001, "a b" * 40), (7002, "bb ccc " * 3000)]


def test_against_plain_version(spark):
    syn = {"a": ["x", "y z", "w"], "bb": ["", "q"], "가": ["나"], "absent": ["no"]}
    rows = random_rows()
    table = spark.createDataFrame(list(syn.items()), "word string, synonyms array<string>")
    twice = [*rows, *rows[:20]]  # equal rows are changed alike
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(twice)], "id long, t string, n int").repartition(5, "n")
    out = {r["n"]: r for r in A.replace_synonyms(df, "id", "t", table, SEED).collect()}
    assert len(out) == len(twice)
    for i, (k, t) in enumerate(twice):
        assert (out[i]["id"], out[i]["t"]) == (k, brute(k, t, syn))
    assert sum(out[i]["t"] != " ".join((t or "").split()) for i, (_, t) in enumerate(twice)) > 100


def test_different_texts_of_one_key_fail(spark):
    table = spark.createDataFrame([("a", ["x"]), ("b", ["y"])], "word string, synonyms array<string>")
    df = spark.createDataFrame([(1, "a " * 50), (1, "b " * 50)], "id long, t string")
    with pytest.raises(Exception, match="one key"):
        A.replace_synonyms(df, "id", "t", table, SEED).collect()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_lambda_per_word(spark):
    """Words are drawn, and texts put together, without a lambda call per word, and split once a row before they are drawn."""
    table = spark.createDataFrame([("a", ["x"])], "word string, synonyms array<string>")
    df = spark.createDataFrame([(1, "a b")], "id long, t string")
    said = plan(A.replace_synonyms(df, "id", "t", table, SEED))
    assert "lambda" not in said and said.count("split(") == 1


def test_synonyms_parsed_once_a_word(spark):
    """Answers are parsed after the aggregation; those that give nothing are told by scans."""
    r = random.Random(6)
    bits = [*":,\n ", "a", "　", "\x1f", "b:", "가"]
    rows = [(i % 30, i, "".join(r.choice(bits) for _ in range(r.randint(0, 8)))) for i in range(2000)] + [(1, 9000, None)]
    df = spark.createDataFrame(rows, "word int, n int, answer string")
    assert df.filter(F.coalesce(T.has_synonyms("answer"), F.lit(False)) != (F.size(T.parse_synonyms("answer")) > 0)).count() == 0
    assert df.filter(T.has_synonyms("answer")).count() > 100
    out = A.synonym_table(df, "word", "answer", ["n"])
    want = {}
    for w, _, items in sorted((x["word"], x["n"], x["s"]) for x in df.select("word", "n", T.parse_synonyms("answer").alias("s")).collect()):
        if items:
            want.setdefault(w, items)
    assert {x["word"]: x["synonyms"] for x in out.collect()} == want
    said = plan(out)
    assert said.index("lambda") < said.index("SortAggregate")


def test_python_whitespace_is_that_of_the_profile():
    assert {chr(c) for c in range(0x110000) if chr(c).isspace()} == {chr(c) for lo, hi in P.WS_RANGES for c in range(lo, hi + 1)}
