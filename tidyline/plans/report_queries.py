"""Registered queries: reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.operators import report as R
from tidyline.operators import split as SP
from tidyline.plans import common as C
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register

_BUCKETED = f"""
WITH b AS (SELECT lang, {S.bucket(S.count('text', 'special_ko'), S.length('text'))} AS bucket FROM documents)
"""


@register("noise_buckets_by_lang", _BUCKETED + """
SELECT lang, count(*) FILTER (WHERE bucket = 'low') AS low, count(*) FILTER (WHERE bucket = 'norm') AS norm,
  count(*) FILTER (WHERE bucket = 'high') AS high FROM b GROUP BY lang
""")
def noise_buckets_by_lang(spark, sf_dir):
    """E3b (minimum slice): special-character buckets per language."""
    d = C.table(spark, sf_dir, "documents")
    return R.noise_buckets(d, "text", "special_ko", by="lang")


@register("noise_bucket_totals", _BUCKETED + """
SELECT count(*) FILTER (WHERE bucket = 'low') AS low, count(*) FILTER (WHERE bucket = 'norm') AS norm,
  count(*) FILTER (WHERE bucket = 'high') AS high FROM b
""")
def noise_bucket_totals(spark, sf_dir):
    """E3a."""
    return R.noise_buckets(C.table(spark, sf_dir, "documents"), "text", "special_ko")


@register("noise_buckets_legacy_by_lang", f"""
WITH b AS (SELECT lang, {S.bucket(S.count('text', 'special_latin'), S.length('text'), P.BUCKET_HIGH_LEGACY)} AS bucket
           FROM documents)
SELECT lang, count(*) FILTER (WHERE bucket = 'low') AS low, count(*) FILTER (WHERE bucket = 'norm') AS norm,
  count(*) FILTER (WHERE bucket = 'high') AS high FROM b GROUP BY lang
""")
def noise_buckets_legacy_by_lang(spark, sf_dir):
    """E3b with the legacy "high above .3" edge, Latin profile."""
    d = C.table(spark, sf_dir, "documents")
    return R.noise_buckets(d, "text", "special_latin", by="lang", high_from=P.BUCKET_HIGH_LEGACY)


@register("bucket_rows_high_titles", f"""
WITH d AS ({C.HANGUL_TITLES_SQL})
SELECT page_id, text FROM d
WHERE {S.bucket(S.count('text', 'special_ko'), S.length('text'), P.BUCKET_HIGH_LEGACY)} = 'high'
""")
def bucket_rows_high_titles(spark, sf_dir):
    """D3: rows of the "high" bucket (legacy edge), sorted by ratio."""
    d = C.hangul_titles(spark, sf_dir)
    return R.bucket_rows(d, "text", "high", key="page_id").select("page_id", "text")


@register("bucket_order_docs", f"""
WITH b AS (SELECT doc_id, {S.count('text', 'special_latin')} AS c, length(text) AS n,
  {S.bucket(S.count('text', 'special_latin'), S.length('text'), P.BUCKET_HIGH_LEGACY)} AS bucket FROM documents)
SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN n > 0 THEN c / n ELSE 0 END, doc_id) - 1 AS position FROM b WHERE bucket = 'norm'
""")
def bucket_order_docs(spark, sf_dir):
    """D3 on whole documents: the rows of a bucket with their place in the order of the ratio."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = R.bucket_rows(d, "text", "norm", cls="special_latin", key="doc_id").select("doc_id", "ratio")
    return SP.with_position(rows, [F.col("ratio"), F.col("doc_id")]).select("doc_id", "position")


@register("class_counts_lang", """
SELECT lang, count(*) AS n, sum(count(*)) OVER () :: BIGINT AS total FROM documents GROUP BY lang
""")
def class_counts_lang(spark, sf_dir):
    """E1."""
    return R.class_counts(C.table(spark, sf_dir, "documents"), "lang")


@register("distribution_report_lang", f"""
WITH g AS (SELECT {C.LANG_LABEL} AS target, count(*) AS n FROM documents GROUP BY 1)
SELECT target, n, sum(n) OVER () :: BIGINT AS total, count(*) OVER () AS n_classes,
  CAST(round(n / sum(n) OVER (), 4) AS DECIMAL(10,4)) AS share,
  CASE WHEN target BETWEEN 0 AND 6 THEN 2142 END AS ref_n,
  CASE WHEN target BETWEEN 0 AND 6 THEN CAST(0.1428 AS DECIMAL(10,4)) END AS ref_share
FROM g
""")
def distribution_report_lang(spark, sf_dir):
    """E2 (label = language as 0..4)."""
    d = C.table(spark, sf_dir, "documents").withColumn("target", C.lang_label())
    return R.distribution_report(d, "target")


@register("char_frequency_docs", f"""
SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {S.q('(' + P.PROFILES['special_ko'] + ')')}, 1))
  AS ch FROM documents) GROUP BY ch
""")
def char_frequency_docs(spark, sf_dir):
    """E5 on raw documents (every special character and its count)."""
    from tidyline.operators.detect import char_frequency
    return char_frequency(C.table(spark, sf_dir, "documents"), "text", "special_ko")


@register("describe_length_by_lang", """
SELECT lang, count(n_chars) AS count, count(*) FILTER (WHERE n_chars IS NULL) AS nulls,
  round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std, CAST(min(n_chars) AS DOUBLE) AS min,
  round(quantile_cont(n_chars, 0.25), 6) AS q25, round(quantile_cont(n_chars, 0.5), 6) AS q50,
  round(quantile_cont(n_chars, 0.75), 6) AS q75, CAST(max(n_chars) AS DOUBLE) AS max
FROM documents GROUP BY lang
""")
def describe_length_by_lang(spark, sf_dir):
    """E8."""
    d = C.table(spark, sf_dir, "documents")
    return C.round_doubles(R.describe(d, "n_chars", by="lang"))


@register("histogram_text_length", """
WITH x AS (SELECT length(text) AS v FROM documents),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT CAST(least(CASE WHEN hi > lo THEN floor((v - lo) * 30 / (hi - lo)) ELSE 0 END, 29) AS INTEGER) AS bin,
             lo, hi FROM x, mm)
SELECT bin, count(*) AS n, round(lo + bin * (hi - lo) / 30, 6) AS lo, round(lo + (bin + 1) * (hi - lo) / 30, 6) AS hi
FROM b GROUP BY bin, lo, hi
""")
def histogram_text_length(spark, sf_dir):
    """30 bins of text length."""
    d = C.table(spark, sf_dir, "documents").select(F.length("text").alias("v"))
    return C.round_doubles(R.histogram(d, "v", 30))


@register("distinct_langs", "SELECT DISTINCT lang FROM documents")
def distinct_langs(spark, sf_dir):
    """E11."""
    return R.distinct_labels(C.table(spark, sf_dir, "documents"), "lang")


@register("labels_report_quality", """
SELECT quality, count(*) AS n, sum(count(*)) OVER () :: BIGINT AS total FROM labels GROUP BY quality
""")
def labels_report_quality(spark, sf_dir):
    """E1 on the labels table."""
    return R.class_counts(C.table(spark, sf_dir, "labels"), "quality")


@register("ratio_threshold_docs", f"""
SELECT doc_id, {S.count('text', 'upper_ko')} AS n FROM ({C.CAPITAL_DOCS_SQL}) WHERE {S.ratio_at_least(S.count('text', 'upper_ko'), 'length(text)', *P.RATIO_THRESHOLD)}
""")
def ratio_threshold_docs(spark, sf_dir):
    """D6 on whole documents in capitals, of which some have many signs."""
    from tidyline.operators.filters import ratio_threshold
    d = C.capital_docs(spark, sf_dir)
    return d.filter(ratio_threshold("text")).select("doc_id", T.class_count("text", "upper_ko").cast("bigint").alias("n"))


@register("ratio_threshold_titles", f"""
WITH d AS ({C.HANGUL_TITLES_SQL})
SELECT page_id, text FROM d WHERE {S.ratio_at_least(S.count('text', 'upper_ko'), 'length(text)', *P.RATIO_THRESHOLD)}
""")
def ratio_threshold_titles(spark, sf_dir):
    """Titles whose rounded upper-case-profile ratio is at least .09."""
    from tidyline.operators.filters import ratio_threshold
    d = C.hangul_titles(spark, sf_dir)
    return d.filter(ratio_threshold("text"))


def _sql_strip_tags_legacy(e: str) -> str:
    e = f"regexp_replace({e}, {S.q('^(' + '|'.join(P.TAG_PREFIX_1) + ')')}, '')"
    e = f"regexp_replace({e}, {S.q('^(' + '|'.join(P.TAG_PREFIX_2) + ')')}, '')"
    return f"regexp_replace({e}, {S.q('(' + '|'.join(P.TAG_SUFFIX_LEGACY) + ')(' + chr(92) + 'n?)' + chr(92) + 'z')}, '\\2')"


@register("special_or_any_lower_titles", f"""
WITH d AS ({C.HANGUL_TITLES_SQL}), s AS (SELECT page_id, {_sql_strip_tags_legacy('text')} AS t FROM d)
SELECT page_id, CAST(CASE WHEN {S.length('t')} - {S.length(S.remove_special('t', True))} <> 0
  OR {S.count(S.remove_special('t', True), 'lower')} > 0 THEN 1 ELSE 0 END AS INTEGER) AS is_noise FROM s
""")
def special_or_any_lower_titles(spark, sf_dir):
    """The special-or-any-lower rule writing ``is_noise``."""
    from tidyline.operators.filters import special_or_any_lower
    d = C.hangul_titles(spark, sf_dir)
    return d.select("page_id", special_or_any_lower("text").cast("int").alias("is_noise"))


@register("special_or_any_lower_docs", f"""
WITH d AS ({C.CAPITAL_DOCS_SQL}), s AS (SELECT doc_id, {_sql_strip_tags_legacy('text')} AS t FROM d)
SELECT doc_id, CAST(CASE WHEN {S.length('t')} - {S.length(S.remove_special('t', True))} <> 0
  OR {S.count(S.remove_special('t', True), 'lower')} > 0 THEN 1 ELSE 0 END AS INTEGER) AS is_noise FROM s
""")
def special_or_any_lower_docs(spark, sf_dir):
    """D8 on whole documents in capitals."""
    from tidyline.operators.filters import special_or_any_lower
    return C.capital_docs(spark, sf_dir).select("doc_id", special_or_any_lower("text").cast("int").alias("is_noise"))


@register("bad_output_split_conversations", """
SELECT conv_id, turn, CASE WHEN length(text) <= 8 OR coalesce(role = 'missing title', false) THEN 'bad' ELSE 'kept' END AS part
FROM conversations
""")
def bad_output_split_conversations(spark, sf_dir):
    """Model-output rows split into kept and bad parts."""
    from tidyline.operators.filters import split_bad_output
    c = C.table(spark, sf_dir, "conversations")
    kept, bad = split_bad_output(c, "text", "role")
    return (kept.select("conv_id", "turn", F.lit("kept").alias("part"))
            .unionByName(bad.select("conv_id", "turn", F.lit("bad").alias("part"))))


@register("buckets_changed_labels", f"""
WITH b AS (SELECT doc_id, text, {C.LANG_LABEL} AS target FROM documents),
u AS (SELECT doc_id, quality AS new_label FROM labels),
c AS (SELECT b.text FROM b JOIN u USING (doc_id) WHERE b.target <> u.new_label),
k AS (SELECT {S.bucket(S.count('text', 'special_ko'), S.length('text'))} AS bucket FROM c)
SELECT count(*) FILTER (WHERE bucket = 'low') AS low, count(*) FILTER (WHERE bucket = 'norm') AS norm,
  count(*) FILTER (WHERE bucket = 'high') AS high FROM k
""")
def buckets_changed_labels(spark, sf_dir):
    """Noise buckets among rows whose label changes."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", C.lang_label().alias("target"))
    u = C.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("new_label"))
    ch = d.join(u, "doc_id").filter(F.col("target") != F.col("new_label"))
    return R.noise_buckets(ch, "text", "special_ko")


@register("json_report_lang", f"""
WITH g AS (SELECT CAST({C.LANG_LABEL} AS VARCHAR) AS target, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT *, sum(n) OVER () :: BIGINT AS total, CAST(round(n / sum(n) OVER (), 4) AS DOUBLE) AS share FROM g)
SELECT concat('{{"counts":{{', string_agg('"' || target || '":' || n, ',' ORDER BY target), '}},"shares":{{',
  string_agg('"' || target || '":' || share, ',' ORDER BY target), '}},"n_classes":', count(*), ',"total":', max(total), '}}') AS json FROM r
""")
def json_report_lang(spark, sf_dir):
    """E2 + A7: the distribution report as one JSON document."""
    d = C.table(spark, sf_dir, "documents").withColumn("target", C.lang_label())
    return R.json_report(d, "target")


@register("bad_output_split_docs", f"""
WITH d AS ({C.DECORATED_DOCS_SQL})
SELECT doc_id, CASE WHEN length(output) <= 8 OR coalesce(source_text = {S.q(P.MISSING_TITLE)}, false) THEN 'bad' ELSE 'kept' END AS part FROM d
""")
def bad_output_split_docs(spark, sf_dir):
    """D5 on outputs of which some are short and some have no source text."""
    from tidyline.operators.filters import split_bad_output
    kept, bad = split_bad_output(C.decorated_docs(spark, sf_dir), "output", "source_text")
    return (kept.select("doc_id", F.lit("kept").alias("part")).unionByName(bad.select("doc_id", F.lit("bad").alias("part"))))
