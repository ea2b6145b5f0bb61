"""Registered queries: keyed joins and set operations (G*, K*, D1, A6 shape)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.operators import detect as D
from tidyline.operators import joins as J
from tidyline.plans import common as C
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register
from tidyline.functions import text as T

_BASE_SQL = f"SELECT doc_id, text, {C.LANG_LABEL} AS target FROM documents"
_UPD_SQL = "SELECT doc_id, CASE WHEN toxic = 1 THEN NULL ELSE quality END AS target FROM labels"


def _base(spark, sf_dir):
    return C.table(spark, sf_dir, "documents").select("doc_id", "text", C.lang_label().alias("target"))


def _upd(spark, sf_dir):
    lab = C.table(spark, sf_dir, "labels")
    return lab.select("doc_id", F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.col("quality")).alias("target"))


@register("update_by_key_docs", f"""
WITH b AS ({_BASE_SQL}), u AS ({_UPD_SQL})
SELECT b.doc_id, CASE WHEN u.doc_id IS NOT NULL THEN u.target ELSE b.target END AS target
FROM b LEFT JOIN u ON b.doc_id = u.doc_id
""")
def update_by_key_docs(spark, sf_dir):
    """G1: labels overwrite the language label by key, NULL included."""
    return J.update_by_key(_base(spark, sf_dir), _upd(spark, sf_dir), "doc_id", "target").select("doc_id", "target")


@register("recover_labels_docs", f"""
WITH b AS ({_BASE_SQL}), u AS ({_UPD_SQL})
SELECT b.doc_id, coalesce(u.target, b.target) AS target FROM b LEFT JOIN u ON b.doc_id = u.doc_id
""")
def recover_labels_docs(spark, sf_dir):
    """A NULL update keeps the old label."""
    return J.recover_labels(_base(spark, sf_dir), _upd(spark, sf_dir), "doc_id", "target").select("doc_id", "target")


@register("recover_labels_duplicates_docs", f"""
WITH b AS ({_BASE_SQL}), u AS ({_UPD_SQL}), u2 AS (SELECT * FROM u UNION ALL SELECT doc_id, CAST(7 AS INTEGER) FROM u WHERE doc_id % 3 = 0)
SELECT b.doc_id, coalesce(u2.target, b.target) AS target FROM b LEFT JOIN u2 ON b.doc_id = u2.doc_id
""")
def recover_labels_duplicates_docs(spark, sf_dir):
    """G2 where keys are updated twice: such rows fan out."""
    u = _upd(spark, sf_dir)
    twice = u.unionByName(u.filter(F.col("doc_id") % 3 == 0).select("doc_id", F.lit(7).alias("target")))
    return J.recover_labels(_base(spark, sf_dir), twice, "doc_id", "target").select("doc_id", "target")


@register("label_diff_docs", f"""
WITH b AS ({_BASE_SQL}), u AS ({_UPD_SQL}),
a AS (SELECT b.doc_id, b.text, CASE WHEN u.doc_id IS NOT NULL THEN u.target ELSE b.target END AS target
      FROM b LEFT JOIN u ON b.doc_id = u.doc_id)
SELECT b.doc_id, b.text, b.target AS target_before, a.target AS target_after
FROM b JOIN a ON b.doc_id = a.doc_id AND b.text IS NOT DISTINCT FROM a.text
WHERE NOT coalesce(b.target = a.target, false)
""")
def label_diff_docs(spark, sf_dir):
    """(key, text) join, rows whose label changed."""
    base = _base(spark, sf_dir)
    after = J.update_by_key(base, _upd(spark, sf_dir), "doc_id", "target")
    return J.label_diff(base, after, "doc_id", "text", "target")


_CMP_SQL = f"""
WITH b AS ({_BASE_SQL}), u AS ({_UPD_SQL}),
a AS (SELECT b.doc_id, CASE WHEN u.doc_id IS NOT NULL THEN u.target ELSE b.target END AS target
      FROM b LEFT JOIN u ON b.doc_id = u.doc_id),
c AS (SELECT a.doc_id, a.target, b.target AS prev_target,
      CASE WHEN coalesce(a.target = b.target, false) THEN 0 ELSE 1 END AS is_changed
      FROM a LEFT JOIN b ON a.doc_id = b.doc_id)
"""


def _compare(spark, sf_dir):
    base = _base(spark, sf_dir)
    after = J.update_by_key(base, _upd(spark, sf_dir), "doc_id", "target").select("doc_id", "target")
    return J.compare_labels(after, base, "doc_id", "target", "target")


@register("compare_labels_docs", _CMP_SQL + "SELECT doc_id, target, prev_target, is_changed FROM c")
def compare_labels_docs(spark, sf_dir):
    """G4."""
    return _compare(spark, sf_dir).select("doc_id", "target", "prev_target", "is_changed")


@register("changed_count_docs", _CMP_SQL + "SELECT coalesce(sum(is_changed), 0) :: BIGINT AS changed FROM c")
def changed_count_docs(spark, sf_dir):
    """E10."""
    return J.changed_count(_compare(spark, sf_dir))


@register("labelled_docs_semi", """
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
""")
def labelled_docs_semi(spark, sf_dir):
    """G5."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return J.having_key(d, C.table(spark, sf_dir, "labels"), "doc_id")


@register("unlabelled_docs_anti", """
SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def unlabelled_docs_anti(spark, sf_dir):
    """G6/G7."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return J.without_key(d, C.table(spark, sf_dir, "labels"), "doc_id")


@register("union_missing_columns", f"""
SELECT doc_id, target, NULL::INTEGER AS toxic FROM ({_BASE_SQL})
UNION ALL SELECT doc_id, quality AS target, toxic FROM labels
""")
def union_missing_columns(spark, sf_dir):
    """K1/K2: stack by name, absent columns NULL."""
    a = _base(spark, sf_dir).select("doc_id", "target")
    b = C.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"), "toxic")
    return J.union_missing(a, b)


@register("recombine_denoised_titles", f"""
WITH d AS ({C.HANGUL_TITLES_SQL}),
fq AS ({S.frequent_chars_cte('d', 'text')}),
f AS (SELECT d.*, translate({S.without_hanja('d.text')}, fq.chars, '') AS filtered_text FROM d, fq),
s AS (SELECT page_id, text, {S.stage('text', 'filtered_text')} AS stage FROM f)
SELECT page_id, {S.collapse_ws("CASE WHEN stage <> 'not_noise' THEN regexp_replace(text, " + S.q(T.KEEP_ONLY_RE) + ", '', 'g') ELSE text END")} AS text,
  CASE WHEN stage <> 'not_noise' THEN 1 ELSE 0 END AS target
FROM s
""")
def recombine_denoised_titles(spark, sf_dir):
    """D1 split by flag, C3 on the noisy part, K5 recombination."""
    d = D.detect_noise(C.hangul_titles(spark, sf_dir), "text").withColumn("target", F.col("is_noise"))
    noisy = d.filter(F.col("is_noise") == 1).withColumn("text", T.keep_only("text"))
    clean = d.filter(~F.col("is_noise").eqNullSafe(1))
    return J.recombine(clean, noisy, "page_id", "text", "target")


@register("replace_or_add_append", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, target FROM ({_BASE_SQL})
UNION ALL SELECT CAST(doc_id AS VARCHAR) || '_new' AS doc_id, NULL::VARCHAR AS text, quality AS target FROM labels
""")
def replace_or_add_append(spark, sf_dir):
    """K3 (append mode): extra rows added with missing columns NULL."""
    base = _base(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string"))
    new = C.table(spark, sf_dir, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit("_new")).alias("doc_id"),
                                                  F.col("quality").alias("target"))
    return J.replace_or_add(base, new, "doc_id", "target", replace=False)


@register("replace_or_add_replace", f"""
WITH b AS ({_BASE_SQL}), u AS (SELECT doc_id, quality AS target FROM labels)
SELECT b.doc_id, CASE WHEN u.doc_id IS NOT NULL THEN u.target ELSE b.target END AS target
FROM b LEFT JOIN u ON b.doc_id = u.doc_id
""")
def replace_or_add_replace(spark, sf_dir):
    """K3 (replace mode): values replaced by key."""
    new = C.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    return J.replace_or_add(_base(spark, sf_dir), new, "doc_id", "target", replace=True).select("doc_id", "target")
