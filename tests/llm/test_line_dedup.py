"""Repeated lines and paragraphs against a plain version."""

import collections
import random

import pytest

from tidyline.llm import common, line_dedup

from .conftest import words


def brute(docs, kinds=("line", "paragraph"), min_words=1):
    """doc_id -> (removed units, kept text) of rows with different doc_ids."""
    seen, out = set(), {}
    for d in sorted(docs):
        text, gone, removed = docs[d] or "", [False] * len(docs[d] or ""), []
        for kind in kinds:
            sep, at = {"line": "\n", "paragraph": "\n\n"}[kind], 0
            for part in text.split(sep):
                w = tuple("".join(c.lower() if c.isascii() else c for c in part).split(" "))
                w = tuple(x for x in "".join(c if c not in "\t\n\r\x0b\x0c" else " " for c in " ".join(w)).split(" ") if x)
                if len(w) >= min_words:
                    if (kind, w) in seen:
                        removed.append((kind, at, at + len(part)))
                        for i in range(at, min(at + len(part) + len(sep), len(text))):
                            gone[i] = True
                    seen.add((kind, w))
                at += len(part) + len(sep)
        out[d] = (sorted(removed), "".join(c for c, g in zip(text, gone, strict=True) if not g))
    return out


def random_docs(seed):
    r = random.Random(seed)
    lines = ["a b c", "A  b\tC", "one", "ONE ", "", "  ", "x y", words(1, 12), "é a", "b c a"]
    return {d: r.choice(["\n", "\n\n", "\n\n\n"]).join("\n".join(r.choice(lines) for _ in range(r.randint(0, 3))) for _ in range(r.randint(0, 5))) for d in range(60)}


@pytest.mark.parametrize("seed, hot", [(1, 2000), (2, 3), (3, 1)])
def test_against_plain_version(spark, monkeypatch, seed, hot):
    """Any share of hot digests gives the same result."""
    monkeypatch.setattr(common, "HOT", hot)
    docs = random_docs(seed) | {100: None, 101: "one", 102: "a b\nc"}
    rows = line_dedup.remove_repeats(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    want = brute(docs)
    for r in rows:
        removed, kept = want[r["doc_id"]]
        assert r["kept_text"] == kept and sorted((x["kind"], x["start"], x["end"]) for x in r["removed"] or ()) == removed
        assert r["n_removed_chars"] == len(docs[r["doc_id"]] or "") - len(kept)
    assert len(rows) == len(docs)


def test_wrapped_anew(spark):
    """A paragraph that is wrapped otherwise goes as a whole, its lines do not."""
    a, b = "one two three\nfour five six", "one two\nthree four five six"
    docs = [(1, a), (2, "first\n\n" + b + "\n\nlast")]
    got = {r["doc_id"]: r for r in line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1]["removed"] is None and got[2]["kept_text"] == "first\n\nlast" and [x["kind"] for x in got[2]["removed"]] == ["paragraph"]
    only = line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), kinds=("line",)).collect()
    assert all(r["removed"] is None for r in only)


def test_short_units_and_counts(spark):
    docs = [(k, f"the end\n{words(k, 5)}") for k in range(50)]
    got = line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert collections.Counter(len(r["removed"] or ()) for r in got) == {1: 49, 0: 1}
    assert collections.Counter(len(r["removed"] or ()) for r in line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), min_words=3).collect()) == {0: 50}
