"""The Merkle manifest against a plain one, and against its SQL."""

import hashlib
import zlib

import duckdb
import pytest

from tidyline.llm import manifest as M
from tidyline.llm import queries as Q

from .conftest import SF


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(leaves, f):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + f]) for i in range(0, len(levels[-1]), f)])
    return levels


def proof(levels, at, f):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // f * f:at // f * f + f]
        out.append((run[:at % f], run[at % f + 1:]))
        at //= f
    return out


def brute(rows, f=2):
    """doc_id, leaf, subroot, root, proof, folded root, verified of (doc_id, text, lang, source, n_chars)."""
    def leaf(r, more=0):
        return h(*[said(x) for x in (r[0], r[3], r[2], r[4] if r[4] is None else r[4] + more, r[1])])
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], f) for g in groups}
    top = levels_of([trees[g][-1][0] for g in order], f)
    out = []
    for k, g in enumerate(order):
        for i, (_, _, digest, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = proof(trees[g], i, f) + proof(top, k, f)
            at = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else digest
            for left, right in path:
                at = h(*left, at, *right)
            out.append((r[0], digest, trees[g][-1][0], top[-1][0], h(*[x for a, b in path for x in a + b]), at, at == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def table(path):
    return duckdb.connect().execute(f"SELECT doc_id, text, lang, source, n_chars FROM '{path}/documents.parquet'").fetchall()


def test_query(spark):
    want = brute(table(SF))
    assert any(not r[-1] for r in want)
    assert rows_of(Q.QUERIES["op13_manifest"](spark, SF)) == want


def test_sql():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(Q.ORACLES["op13_manifest"])
    assert sorted((tuple(r) for r in cur.fetchall()), key=str) == brute(table(SF)) and [c[0] for c in cur.description] == list(COLUMNS)


@pytest.mark.parametrize("sizes", [{"a": 64, None: 65, "é": 1, "z": 4097, "b": 127}, {f"g{k}": 1 + k % 3 for k in range(70)}, {"a": 1}])
def test_tree_shapes(spark, sizes):
    """Single leaves, whole and broken blocks, several tiers, many groups."""
    rows = [(100 * k + 1_000_000 * i, f"t{k}", g, "s", k if k % 5 else None) for i, (g, n) in enumerate(sizes.items()) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(M.tampered_proofs(df)) == brute(rows)


def test_other_fan_out(spark):
    fanout = 3
    rows = [(k, f"t{k}", "ab"[k % 7 == 0], None, k) for k in range(600)]
    got = M.manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), fanout=fanout).collect()
    want = {r[0]: r for r in brute(rows, fanout)}
    for r in got:
        said_ = h(*[p["left"] + p["right"] for p in r["path"]])
        assert (r["leaf"], r["subroot"], r["root"], said_) == want[r["doc_id"]][1:5]
    assert len(got) == len(rows)


def test_odd_rows(spark, odd, empty):
    assert M.tampered_proofs(empty).collect() == []
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in odd.collect()]
    assert rows_of(M.tampered_proofs(odd)) == brute(rows)
