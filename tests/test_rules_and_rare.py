"""The scans of the cascade and of the rare characters against their regex forms, on odd texts."""

import random
import re

from pyspark.sql import functions as F

from tidyline.functions import text as T
from tidyline.operators import clean as CL

PIECES = ["a", "Z", "7", "가", "ㅎ", " ", "\t", "\n", "%", "…", "\x00", "\x01", "\x02", "\x03", "漢", "😀", ">", "ㆍ", "-", "→", "　"]


def texts(seed, n=400):
    r = random.Random(seed)
    return [None, "", *("".join(r.choice(PIECES) for _ in range(r.randint(1, 14))) for _ in range(n))]


def test_rules_equal_their_plain_forms(spark):
    df = spark.createDataFrame(list(enumerate(texts(3))), "id long, t string")
    pairs = {"v1": (T.tag_rule_v1_text("t"), T.tag_rule_v1(T.tag_words(T.words("t")))),
             "v2": (T.tag_rule_v2_text("t"), T.tag_run_count("t") >= 6),
             "sandwich": (T.has_sandwich_text("t"), F.col("t").rlike(T.SANDWICH_RE))}
    for r in df.select("t", *[F.struct(*x).alias(k) for k, x in pairs.items()]).collect():
        for k in pairs:
            assert r[k][0] == r[k][1], (k, r["t"])


def test_long_rows_do_not_overflow_the_stack(spark):
    df = spark.createDataFrame([("가" * 300_000,), ("a1% " * 100_000,), ("가 1a" + "b" * 300_000,)], "t string")
    got = df.select(T.tag_rule_v1_text("t").alias("a"), T.tag_rule_v2_text("t").alias("b"), T.has_sandwich_text("t").alias("c")).collect()
    assert [tuple(r) for r in got] == [(False, False, False), (True, True, False), (False, False, False)]


def test_rare_characters(spark):
    clean = ["aab b" * 400, None, "[^-&]\\" * 400, "\x02c", "😀"]
    kept = set("ab [^-&]\\\x02")  # and the first of those seen once
    ask = [t for t in texts(4) if t] + ["", None, "\x00", "a\x00漢⁇b", "⁇", "a-b", "😀a😀"]
    c = spark.createDataFrame([(t,) for t in clean], "t string")
    n = {r["ch"]: r["n"] for r in CL.char_counts(c.repartition(3), "t").collect()}
    assert n == {ch: sum((t or "").count(ch) for t in clean) for ch in set("".join(t or "" for t in clean))}
    out = CL.rare_char_denoise(spark.createDataFrame(list(enumerate(ask)), "id long, t string"), "t", c).collect()
    for r in out:
        t = ask[r["id"]]
        marked = "".join(x if x in kept else " ⁇ " for x in t or "")
        plain = None if t is None else " ".join(re.split("[" + re.escape(T.P.range_chars(T.P.WS_RANGES)) + "]+", marked)).strip(" ")
        assert r["t"] == plain, t


def test_nothing_kept(spark):
    empty = spark.createDataFrame([], "t string")
    assert CL.rare_char_denoise(spark.createDataFrame([("a  b",)], "t string"), "t", empty).first()["t"] == "a b"
