"""Spelling variants against all edits of each word."""

import collections
import random
import re
import zlib

from tidyline.llm import queries as Q
from tidyline.llm import spelling as S

from .conftest import SCHEMA, SF


def brute_words(docs):
    n = collections.Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words):
    out, form = {}, {}
    letters = sorted(set("".join(words)))
    for w, n in words.items():
        tried = {w[:k] + w[k + 1:] for k in range(len(w))} | {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in letters}
        tried |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        near = [x for x in tried if x in words and x != w]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
        out[w] = (form[w], n, len(near), words[form[w]] if form[w] else None)
    rows = set()
    for w, (f, n, near, fn) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, f, root, n, near, fn))
    return rows


def rows_of(df):
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query(spark, texts):
    want = brute(brute_words(texts.items()))
    assert len(want) > 500 and any(r[1] for r in want)
    assert rows_of(Q.QUERIES["op12_spelling"](spark, SF)) == want


def test_dense_words_and_chains(spark):
    """Words over two letters, many edits apart, doubled letters, and chains of forms."""
    r, docs = random.Random(4), []
    for d in range(400):
        docs.append((d, " ".join("".join(r.choice("aé") for _ in range(r.randint(6, 9))) for _ in range(6))))
    docs += [(1000, "Abcdefgh " * 5000), (1001, "abcdefgx " * 400), (1002, "abcdefyx " * 30), (1003, "abcdezyx " * 3), (None, "bbbbbbb bbbbbbbb " * 40),
             (1004, "ÄÖÜäöüß " * 2), (1004, "Äöüäöüß " * 2), (1005, None), (1006, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(brute_words(docs))
    assert any(r[0] == "abcdezyx" and r[2] == "abcdefgh" for r in want)
    assert rows_of(S.variants(df)) == want
    assert rows_of(S.variants(df.repartition(7))) == want


def test_odd_rows(spark, odd, empty):
    assert S.variants(empty).collect() == []
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(S.variants(odd)) == brute(brute_words(docs))
    assert set(SCHEMA.names) >= {"kept"}


def test_groups_cross_batches(spark):
    """A group that goes on in the next Arrow batch is scanned whole."""
    words = {f"aaaa{c}aaaa": i + 2 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {"aaaaaaaa": 500}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        got = {r["word"]: (r["n_near"], r["near"], r["near_n"]) for r in S.nearest(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x))
        assert got[w] == (len(near), best, words[best])
