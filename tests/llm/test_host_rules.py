"""Hosts whose documents fail: rates shrunk by the prior, and what goes with them."""

import random

import pytest

from tidyline.llm import quality_rules

from .conftest import words


def plain(hosts):
    """host -> shrunk rate, of host -> (documents, failures)."""
    docs, failed = sum(n for n, _ in hosts.values()), sum(k for _, k in hosts.values())
    m = failed / docs
    v = sum(n * (k / n - m) ** 2 for n, k in hosts.values()) / docs - sum(n * m * (1 - m) / n for n, _ in hosts.values()) / docs
    w = min(1000.0, max(0.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
    return {h: (k + m * w) / (n + w) for h, (n, k) in hosts.items()}


def table(hosts, seed=1):
    r, rows = random.Random(seed), []
    for h, (n, k) in hosts.items():
        rows += [(len(rows) + i, "short text" if i < k else words(len(rows) + i, 60), h) for i in range(n)]
    r.shuffle(rows)
    return rows


HOSTS = [
    {"good": (60, 3), "bad": (50, 44), "new": (1, 1), None: (20, 2)},
    {"a": (40, 8), "b": (40, 9), "c": (3, 2)},  # no spread beyond chance
    {"one": (30, 30)},
    {"x": (5, 0), "y": (7, 0)},
]


@pytest.mark.parametrize("hosts", HOSTS)
def test_rates_against_plain_prior(spark, hosts):
    rows = table(hosts)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = plain(hosts)
    got = quality_rules.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r["host_rate"] - want[r["source"]]) < 1e-9
        assert r["base_failed"] == (r["text"] == "short text") and r["kept"] == (not r["base_failed"] and want[r["source"]] <= 0.5)
    kept = {r["doc_id"] for r in quality_rules.kept_rows(df).collect()}
    assert kept == {r["doc_id"] for r in got if r["kept"]}


def test_a_bad_host_takes_its_good_documents_with_it(spark):
    df = spark.createDataFrame(table(HOSTS[0]), "doc_id long, text string, source string")
    got = quality_rules.judge(df).collect()
    assert sum(r["source"] == "bad" and not r["base_failed"] and not r["kept"] for r in got) == 6
    # a host of one failed document is drawn towards the others
    assert next(r["host_rate"] for r in got if r["source"] == "new") < 0.9
