"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest

from tidyline.llm import (
    fingerprints, language_id, line_dedup, mixing, near_dedup, packing, quality_model, quality_rules, repeats, secrets,
)

from .conftest import odd_rows, words

OPERATORS = {
    "quality_model": quality_model.classify, "near_dedup": near_dedup.near_duplicates, "language_id": language_id.identify,
    "packing": packing.pieces, "mixing": mixing.plan, "repeats": repeats.digest, "line_dedup": line_dedup.digest,
    "fingerprints": fingerprints.with_edits, "secrets": secrets.digest, "quality_rules": quality_rules.judge,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_each(name, odd):
    rows = OPERATORS[name](odd).collect()
    ids = sorted((r["doc_id"] for r in rows), key=str)
    if name == "packing":
        assert set(ids) == {r[0] for r in odd_rows()}
    else:
        assert ids == sorted((r[0] for r in odd_rows()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, empty):
    assert OPERATORS[name](empty).collect() == []


def test_stages_keep_columns(odd, empty):
    for f in (quality_rules.kept_rows, near_dedup.kept_rows, secrets.redact, mixing.mix):
        assert f(odd).columns == odd.columns
        assert f(empty).collect() == []
        f(odd).collect()


def test_defined_results(odd):
    near = {r["doc_id"]: r for r in near_dedup.near_duplicates(odd, 2).filter("doc_id is not null").collect()}
    assert near[2]["n_shingles"] == near[3]["n_shingles"] == near[4]["n_shingles"] == 0 and near[2]["kept"]
    assert near[5]["component_id"] == 1 and near[8]["component_id"] == 1 and near[9]["n_shingles"] == 1
    assert near[7]["component_id"] == (6 if near[7]["n_shingles"] > 0.8 * near[6]["n_shingles"] else 7)
    lang = {r["doc_id"]: r for r in language_id.identify(odd).collect()}
    assert lang[2]["lang_pred"] == lang[3]["lang_pred"] == lang[10]["lang_pred"] == "und" and lang[10]["score"] == 0
    found = {r["doc_id"]: r for r in secrets.digest(odd).collect()}
    assert (found[11]["n_assign"], found[11]["n_access"], found[2]["spans"]) == (1, 1, "")
    rep = {r["doc_id"]: r for r in repeats.digest(odd.filter("doc_id is not null")).collect()}
    assert rep[1]["n_removed"] == 0 and rep[5]["n_removed"] == len(odd_rows()[0][1]) and rep[2]["n_bytes"] == 0
    print_ = {r["doc_id"]: r for r in fingerprints.with_edits(odd).collect()}
    assert print_[2]["fingerprint"] == print_[3]["fingerprint"] == "" and print_[3]["near_next"] == 1.0
    lines = {r["doc_id"]: r for r in line_dedup.digest(odd).collect()}
    assert lines[1]["n_removed"] == 0 and lines[5]["kept_text"] == "" and lines[12]["n_removed"] == 2


def test_mix_shares_copies_of_equal_rows(odd):
    plan = mixing.plan(odd, share=1.0).collect()
    want = sum(r["copies"] for r in plan)
    assert mixing.mix(odd, share=1.0).count() == want


def test_line_dedup_tells_rows_apart(spark):
    """Rows without doc_id, or of one doc_id, lose their own lines only; of equal rows one stays."""
    a, b, c, d = (words(k, 9) for k in range(4))
    texts = {"one": f"{a}\n{b}", "two": f"{c}\n{a}"}
    for doc_id in (None, 7):
        rows = [(doc_id, t) for t in texts.values()] + [(8 if doc_id else None, d)] * 2
        got = [(r["doc_id"], r["kept_text"]) for r in line_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        kept = sorted(t for _, t in got)
        assert kept in (sorted(["", d, texts["one"], f"{c}\n"]), sorted(["", d, b, texts["two"]]))
