"""Registered queries: splits, samples and orders (I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions.draws import sql_hash32, sql_key
from tidyline.operators import split as SP
from tidyline.plans import common as C
from tidyline.plans.registry import register

_H = sql_hash32(sql_key("doc_id", "456"))
_RANKED = f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_H}, doc_id) - 1 AS rk,
                  count(*) OVER (PARTITION BY lang) AS n FROM documents)
"""


@register("stratified_split_docs", _RANKED + """
SELECT doc_id, lang, CAST(CASE WHEN rk < floor((n * 6000 + 10000) / 20000) THEN 1 ELSE 0 END AS INTEGER) AS is_valid
FROM r
""")
def stratified_split_docs(spark, sf_dir):
    """30 % validation per language, seed 456."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SP.split_flag(d, "doc_id", 0.3, 456, by="lang")


@register("running_number_docs", _RANKED + "SELECT doc_id, lang, rk AS rn FROM r")
def running_number_docs(spark, sf_dir):
    """Exact running number within the label."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SP.number_within(d, "doc_id", "lang", 456)


@register("kfold_embeddings", f"""
SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {sql_hash32(sql_key('vec_id', '42'))}, vec_id) - 1) % 3
  AS INTEGER) AS fold FROM embeddings
""")
def kfold_embeddings(spark, sf_dir):
    """Stratified 3-fold, seed 42."""
    e = C.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return SP.kfold(e, "vec_id", 3, 42, by="label")


@register("halves_docs", f"SELECT doc_id, CAST({sql_hash32(sql_key('doc_id', '7'))} % 2 AS INTEGER) AS half FROM documents")
def halves_docs(spark, sf_dir):
    """I3."""
    return SP.halves(C.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7)


@register("sample_per_class_docs", f"""
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY
  {sql_hash32(sql_key('doc_id', '11'))}, doc_id) AS rn FROM documents) WHERE rn <= 10
""")
def sample_per_class_docs(spark, sf_dir):
    """10 rows per language."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SP.sample_per_class(d, "doc_id", "lang", 10, 11)


@register("top_k_longest_docs", """
SELECT doc_id, length(text) AS n_chars FROM documents ORDER BY length(text) DESC, doc_id LIMIT 600
""")
def top_k_longest_docs(spark, sf_dir):
    """The 600 longest texts (a top-k report)."""
    d = C.table(spark, sf_dir, "documents")
    return SP.top_k_longest(d, "text", "doc_id", 600).select("doc_id", F.length("text").cast("bigint").alias("n_chars"))


@register("head_n_docs", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 1602")
def head_n_docs(spark, sf_dir):
    """The first 1,602 rows by key."""
    return SP.head_n(C.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 1602)


@register("head_100_docs", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def head_100_docs(spark, sf_dir):
    """I7 where the limit cuts."""
    return SP.head_n(C.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 100)


@register("sorted_by_id_docs", "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id DESC) - 1 AS position FROM documents")
def sorted_by_id_docs(spark, sf_dir):
    """I4: the place of each row in the order of the key (descending)."""
    return SP.with_position(C.table(spark, sf_dir, "documents").select("doc_id", "lang"), [F.desc("doc_id")])


@register("sorted_by_length_docs", """
SELECT doc_id, length(text) AS n, row_number() OVER (ORDER BY length(text) DESC, doc_id) - 1 AS position FROM documents
""")
def sorted_by_length_docs(spark, sf_dir):
    """The place of each row in the order of a measure."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("bigint").alias("n"))
    return SP.with_position(d, [F.desc("n"), F.asc("doc_id")])


@register("shuffle_order_docs", f"""
SELECT doc_id, row_number() OVER (ORDER BY {sql_hash32(sql_key('doc_id', '99'))}, doc_id) - 1 AS position FROM documents
""")
def shuffle_order_docs(spark, sf_dir):
    """I8: the place of each row in a seeded shuffle."""
    from tidyline.functions.draws import hash32
    d = C.table(spark, sf_dir, "documents").select("doc_id", hash32("doc_id", 99).alias("_d"))
    return SP.with_position(d, [F.col("_d"), F.col("doc_id")]).drop("_d")


@register("docs_by_label", "SELECT doc_id, n_chars FROM documents WHERE lang = 'fr'")
def docs_by_label(spark, sf_dir):
    """Rows of one label."""
    d = C.table(spark, sf_dir, "documents")
    return d.filter(F.col("lang") == "fr").select("doc_id", "n_chars")


@register("shuffled_docs", f"""
SELECT doc_id, {sql_hash32(sql_key('doc_id', '99'))} AS draw FROM documents ORDER BY draw, doc_id
""")
def shuffled_docs(spark, sf_dir):
    """I8 / I4: a seeded shuffle, as the sink order."""
    from tidyline.functions.draws import hash32
    d = C.table(spark, sf_dir, "documents").select("doc_id", hash32("doc_id", 99).alias("draw"))
    return SP.shuffled(d, "doc_id", 99)


_QUALITY = f"""
WITH q AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_H}, doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY quality) AS n FROM q)
"""


def _quality(spark, sf_dir):
    """Documents with their quality label; most have none."""
    d = C.table(spark, sf_dir, "documents").select("doc_id")
    return d.join(C.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


@register("split_missing_labels_docs", _QUALITY + """
SELECT doc_id, quality, CAST(CASE WHEN rk < floor((n * 6000 + 10000) / 20000) THEN 1 ELSE 0 END AS INTEGER) AS is_valid FROM r
""")
def split_missing_labels_docs(spark, sf_dir):
    """I1 where most labels are NULL: those rows are one more label."""
    return SP.split_flag(_quality(spark, sf_dir), "doc_id", 0.3, 456, by="quality")


@register("kfold_missing_labels_docs", _QUALITY + "SELECT doc_id, quality, CAST(rk % 3 AS INTEGER) AS fold FROM r")
def kfold_missing_labels_docs(spark, sf_dir):
    """I2 where most labels are NULL."""
    return SP.kfold(_quality(spark, sf_dir), "doc_id", 3, 456, by="quality")


@register("running_number_missing_labels_docs", _QUALITY + "SELECT doc_id, quality, rk AS rn FROM r")
def running_number_missing_labels_docs(spark, sf_dir):
    """I10 where most labels are NULL."""
    return SP.number_within(_quality(spark, sf_dir), "doc_id", "quality", 456)
