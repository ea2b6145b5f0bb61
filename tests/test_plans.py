"""Plan shape: what the optimizer should see for the main operators."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_cascade_is_jvm_only_and_broadcasts_one_row(spark):
    p = plan(spark, "noise_cascade_docs")
    assert "EvalPython" not in p
    assert "BroadcastNestedLoopJoin" in p
    # column pruning reaches the scan: only the columns the cascade reads
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("source" not in s and "n_chars" not in s for s in scans)


def test_update_checks_duplicates_in_plan(spark):
    p = plan(spark, "update_by_key_docs")
    assert "raise_error" in p and "EvalPython" not in p


def test_half_mixing_moves_keys_not_texts(spark):
    p = plan(spark, "mix_halves_docs")
    assert "BroadcastExchange" in p
    # the ranking shuffles carry (key, label) only
    rank_scans = [line for line in p.splitlines() if "FileScan parquet" in line and "text" not in line]
    assert rank_scans


def test_label_rank_window_is_bucketed(spark):
    p = plan(spark, "stratified_split_docs")
    assert "row_number()" in p
    for line in p.splitlines():
        if "row_number()" in line:
            assert "_b#" in line  # partitioned by (label, bucket), not by label alone
