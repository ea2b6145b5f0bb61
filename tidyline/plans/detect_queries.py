"""Registered queries: the detection cascade."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.operators import detect as D
from tidyline.operators import joins as J
from tidyline.operators import observed as O
from tidyline.plans import common as C
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register
from tidyline.session import scratch_path

_CASCADE_DOCS_SQL = f"""
WITH d AS ({C.HANGUL_DOCS_SQL}),
fq AS ({S.frequent_chars_cte('d', 'text')}),
f AS (SELECT d.*, translate({S.without_hanja('d.text')}, fq.chars, '') AS filtered_text FROM d, fq),
s AS (SELECT doc_id, lang, {S.stage('text', 'filtered_text')} AS stage FROM f)
"""


def cascade_docs(spark, sf_dir):
    return D.detect_noise(C.hangul_docs(spark, sf_dir), "text")


@register("noise_cascade_docs", _CASCADE_DOCS_SQL + """
SELECT doc_id, lang, stage, CAST(CASE WHEN stage <> 'not_noise' THEN 1 ELSE 0 END AS INTEGER) AS is_noise FROM s
""")
def noise_cascade_docs(spark, sf_dir):
    return cascade_docs(spark, sf_dir).select("doc_id", "lang", "stage", "is_noise")


@register("noise_stage_counts", _CASCADE_DOCS_SQL + """
SELECT stage, count(*) AS n FROM s GROUP BY stage
""")
def noise_stage_counts(spark, sf_dir):
    return D.stage_counts(cascade_docs(spark, sf_dir))


@register("noise_prediction_summary", _CASCADE_DOCS_SQL + """
SELECT count(*) AS total, CAST(sum(CASE WHEN stage <> 'not_noise' THEN 1 ELSE 0 END) AS BIGINT) AS noise,
       CAST(sum(CASE WHEN stage <> 'not_noise' THEN 0 ELSE 1 END) AS BIGINT) AS normal FROM s
""")
def noise_prediction_summary(spark, sf_dir):
    return D.prediction_summary(cascade_docs(spark, sf_dir))


CASCADE_TITLES_SQL = f"""
WITH d AS ({C.HANGUL_TITLES_SQL}),
fq AS ({S.frequent_chars_cte('d', 'text')}),
f AS (SELECT d.*, translate({S.without_hanja('d.text')}, fq.chars, '') AS filtered_text FROM d, fq),
s AS (SELECT page_id, text, {S.stage('text', 'filtered_text')} AS stage FROM f)
"""


@register("noise_cascade_titles", CASCADE_TITLES_SQL + """
SELECT page_id, stage, CAST(CASE WHEN stage <> 'not_noise' THEN 1 ELSE 0 END AS INTEGER) AS is_noise FROM s
""")
def noise_cascade_titles(spark, sf_dir):
    out = D.detect_noise(C.hangul_titles(spark, sf_dir), "text")
    return out.select("page_id", "stage", "is_noise")


@register("rule_hits_titles", CASCADE_TITLES_SQL + """
SELECT page_id, text, stage FROM s WHERE stage <> 'not_noise'
""")
def rule_hits_titles(spark, sf_dir):
    out = D.detect_noise(C.hangul_titles(spark, sf_dir), "text")
    return D.rule_hits(out).select("page_id", "text", "stage")


@register("frequent_specials_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL})
SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all({S.without_hanja('text')},
  {S.q('(' + D.P.PROFILES['special_ko'] + ')')}, 1)) AS ch FROM d) GROUP BY ch HAVING count(*) >= 100
""")
def frequent_specials_docs(spark, sf_dir):
    d = C.hangul_docs(spark, sf_dir).select(D.without_hanja("text").alias("text"))
    return D.char_frequency(d, "text", "special_ko", 100)


@register("filtered_text_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL}),
fq AS ({S.frequent_chars_cte('d', 'text')})
SELECT doc_id, translate({S.without_hanja('d.text')}, fq.chars, '') AS filtered_text FROM d, fq
""")
def filtered_text_docs(spark, sf_dir):
    """Hanja and the frequent specials removed."""
    d = C.hangul_docs(spark, sf_dir)
    out = D.detect_noise(d, "text", keep_filtered=True)
    return out.select("doc_id", "filtered_text")


@register("rule_flags_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL}),
fq AS ({S.frequent_chars_cte('d', 'text')}),
f AS (SELECT d.*, translate({S.without_hanja('d.text')}, fq.chars, '') AS ft FROM d, fq)
SELECT doc_id,
  coalesce({S.v1('ft')}, false) AS v1, coalesce({S.v2('ft')}, false) AS v2,
  coalesce({S.sandwich('ft')}, false) AS sandwich,
  coalesce({S.special_run(S.replace_steps('text', D.P.TREND_STEPS))}, false) AS consecutive,
  coalesce({S.ratio_at_least(S.count('ft', 'upper_ko'), 'length(ft)', *D.P.RATIO_THRESHOLD)}, false) AS ratio,
  coalesce({S.removed_length('text')} <> 0 OR {S.ratio_at_least(S.count('text', 'lower'), 'length(text)', *D.P.LOWER_THRESHOLD)}, false) AS special
FROM f
""")
def rule_flags_docs(spark, sf_dir):
    """Every rule on every row (not first-match), for auditing the cascade."""
    d = C.hangul_docs(spark, sf_dir)
    out = D.detect_noise(d, "text", keep_filtered=True)
    rules = D.rule_columns("text", "filtered_text")
    return out.select("doc_id", *[F.coalesce(rules[k], F.lit(False)).alias(a) for k, a in (
        ("morph_v1", "v1"), ("morph_v2", "v2"), ("sandwich", "sandwich"), ("consecutive", "consecutive"),
        ("ratio", "ratio"), ("special", "special"))])


@register("observed_counts_docs", _CASCADE_DOCS_SQL + f""",
o AS (SELECT doc_id, {C.LANG_LABEL} AS old, CASE WHEN stage = 'not_noise' THEN {C.LANG_LABEL} ELSE 0 END AS new FROM s)
SELECT stage AS name, count(*) AS n FROM s GROUP BY stage
UNION ALL SELECT 'total', count(*) FROM s UNION ALL SELECT 'noise', count(*) FILTER (WHERE stage <> 'not_noise') FROM s
UNION ALL SELECT 'normal', count(*) FILTER (WHERE stage = 'not_noise') FROM s
UNION ALL SELECT 'changed', count(*) FILTER (WHERE old <> new) FROM o
""")
def observed_counts_docs(spark, sf_dir):
    """The counts that the writes themselves report: of the flagged rows, and of labels
    compared with their earlier ones."""
    path = scratch_path(spark, "observed-flagged")
    seen = O.write_counted(cascade_docs(spark, sf_dir), path, {**O.stage_metrics(), **O.prediction_metrics()})
    flagged = spark.read.parquet(path).select("doc_id", C.lang_label().alias("target"), "is_noise")
    new = flagged.select("doc_id", F.when(F.col("is_noise") == 1, 0).otherwise(F.col("target")).alias("target"))
    compared = J.compare_labels(new, flagged, "doc_id")
    seen |= O.write_counted(compared, scratch_path(spark, "observed-compared"), O.change_metrics())
    return spark.createDataFrame([(k, v) for k, v in seen.items() if v or k not in D.P.STAGES], "name string, n long")
