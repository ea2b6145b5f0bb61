"""Registered queries: text measures and cleaning (B*, C*, A8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.operators import detect as D
from tidyline.operators import report as R
from tidyline.plans import common as C
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register
from tidyline.session import sized

_PROFILES = ("special_ko", "special_ko_hanja", "upper_ko", "special_syllable", "lower", "letter")


@register("char_ratio_profiles", f"""
WITH d AS ({C.HANGUL_DOCS_SQL})
SELECT doc_id, {', '.join(f"{S.count('text', p)} AS n_{p}" for p in _PROFILES)},
  {S.length('text')} AS n_chars, {S.removed_length('text')} AS removed_length,
  len(regexp_extract_all(text, {S.q('[^' + P.WS + ']+')})) AS n_words
FROM d
""")
def char_ratio_profiles(spark, sf_dir):
    """B1a–B1f counts, B2 length, B3 removed length, B6 word count."""
    d = C.hangul_docs(spark, sf_dir)
    out = R.ratio_columns(d, "text").withColumn("removed_length", T.removed_length("text")) \
        .withColumn("n_words", T.word_count("text"))
    return out.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in
                                  [f"n_{p}" for p in _PROFILES] + ["n_chars", "removed_length", "n_words"]])


def _rounded_sql(source: str, key: str) -> str:
    return f"""
WITH d AS ({source})
SELECT {key}, round(CASE WHEN length(text) > 0 THEN {S.count('text', 'upper_ko')} / length(text) ELSE 0 END, 4)
  AS upper_ratio, {S.rlike('text', P.PROFILES['hanja'])} AS has_hanja,
  array_to_string(regexp_extract_all(text, {S.q('(' + P.PROFILES['special_ko'] + ')')}, 1), '') AS specials
FROM d
"""


@register("char_ratio_rounded_titles", _rounded_sql(C.HANGUL_TITLES_SQL, "page_id"))
def char_ratio_rounded_titles(spark, sf_dir):
    """B1c rounded ratio, B9 contains-Hanja, B5 extracted specials."""
    return _rounded(C.hangul_titles(spark, sf_dir), "page_id")


@register("char_ratio_rounded_docs", _rounded_sql(C.HANGUL_DOCS_SQL, "doc_id"))
def char_ratio_rounded_docs(spark, sf_dir):
    """B1c, B9 and B5 on whole documents."""
    return _rounded(C.hangul_docs(spark, sf_dir), "doc_id")


def _rounded(d, key):
    return d.select(key, T.char_ratio("text", "upper_ko", 4).alias("upper_ratio"),
                    T.has_class("text", "hanja").alias("has_hanja"),
                    T.extract_class("text", "special_ko").alias("specials"))


def _sql_words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {S.q('[' + P.WS + ']+')}), lambda w: w <> '')"


def _sql_tag(t: str) -> str:
    return (f"CASE WHEN regexp_matches({t}, '^[A-Za-z]') THEN 'Alpha' WHEN regexp_matches({t}, '^[0-9]') "
            f"THEN 'Number' WHEN regexp_matches({t}, {S.q('^[' + P.HANGUL + P.JAMO + ']')}) THEN 'Hangul' "
            f"ELSE 'Punctuation' END")


_SQL_TOKENS = f"list_transform({_sql_words('text')}, lambda w: regexp_extract_all(w, {S.q(P.TOKEN_RE)}, 1))"


def _tags_sql(source: str, key: str) -> str:
    return f"""
WITH d AS ({source}),
t AS (SELECT {key}, text, {_SQL_TOKENS} AS toks FROM d)
SELECT {key},
  array_to_string(list_transform(flatten(toks), lambda x: '<' || x || '>'), ' ') AS display,
  array_to_string(list_transform(flatten(toks), lambda x: {_sql_tag('x')}), ',') AS tags,
  {S.v1('text')} AS rule_v1, {S.v2('text')} AS rule_v2
FROM t
"""


@register("script_tags_titles", _tags_sql(C.HANGUL_TITLES_SQL, "page_id"))
def script_tags_titles(spark, sf_dir):
    """B10 display, B11 tags, B12/B13 on tag arrays (the oracle uses the
    regex forms, so this also checks that both forms agree)."""
    return _tags(C.hangul_titles(spark, sf_dir), "page_id")


@register("script_tags_docs", _tags_sql(C.HANGUL_DOCS_SQL, "doc_id"))
def script_tags_docs(spark, sf_dir):
    """B10, B11, B12 and B13 on whole documents."""
    return _tags(C.hangul_docs(spark, sf_dir), "doc_id")


def _tags(d, key):
    d = d.withColumn("tags", T.tag_words(T.words("text")))
    flat = F.flatten("tags")
    return d.select(key,
                    T.token_display(F.transform(flat, lambda x: x["tok"])).alias("display"),
                    F.array_join(F.transform(flat, lambda x: x["tag"]), ",").alias("tags"),
                    T.tag_rule_v1("tags").alias("rule_v1"), T.tag_rule_v2("tags").alias("rule_v2"))


@register("drop_latin_tokens_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL})
SELECT doc_id, {S.collapse_ws(
    "array_to_string(list_transform(" + _SQL_TOKENS + ", lambda w: array_to_string(list_filter(w, lambda x: "
    "NOT regexp_matches(x, '^[A-Za-z0-9]')), '')), ' ')")} AS text
FROM d
""")
def drop_latin_tokens_docs(spark, sf_dir):
    """B14 on whole documents (the oracle uses the tag-array form)."""
    d = C.hangul_docs(spark, sf_dir)
    return d.select("doc_id", T.drop_latin_tokens("text").alias("text"))


def _sql_strip_tags(e: str) -> str:
    e = f"regexp_replace({e}, {S.q('^(' + '|'.join(P.TAG_PREFIX_1) + ')')}, '')"
    e = f"regexp_replace({e}, {S.q('^(' + '|'.join(P.TAG_PREFIX_2) + ')')}, '')"
    return f"regexp_replace({e}, {S.q('(' + '|'.join(P.TAG_SUFFIX) + ')(' + chr(92) + 'n?)' + chr(92) + 'z')}, '\\2')"


@register("clean_text_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL})
SELECT doc_id, {S.collapse_ws(S.remove_special(S.replace_steps(_sql_strip_tags('text'), P.ELLIPSIS_STEPS)))} AS cleaned,
  replace(text, chr(10), '') AS no_newlines
FROM d
""")
def clean_text_docs(spark, sf_dir):
    """C1 tags, C4a ellipsis, C2 specials, C6 whitespace; C9 newlines."""
    d = C.hangul_docs(spark, sf_dir)
    cleaned = T.collapse_ws(T.remove_special(T.remove_ellipsis(T.strip_tags("text"))))
    return d.select("doc_id", cleaned.alias("cleaned"), T.drop_newlines("text").alias("no_newlines"))


def _keep_only_sql(source: str, key: str) -> str:
    return f"""
WITH d AS ({source}),
fq AS ({S.frequent_chars_cte('d', 'text')}),
f AS (SELECT d.*, translate({S.without_hanja('d.text')}, fq.chars, '') AS filtered_text FROM d, fq),
s AS (SELECT {key}, text, {S.stage('text', 'filtered_text')} AS stage FROM f)
SELECT {key}, CASE WHEN stage <> 'not_noise'
  THEN regexp_replace(text, {S.q(T.KEEP_ONLY_RE)}, '', 'g') ELSE text END AS text FROM s
"""


@register("keep_only_noisy_titles", _keep_only_sql(C.HANGUL_TITLES_SQL, "page_id"))
def keep_only_noisy_titles(spark, sf_dir):
    """C3 on rows the cascade flags."""
    d = D.detect_noise(C.hangul_titles(spark, sf_dir), "text")
    return d.select("page_id", T.keep_only_flagged("text", "is_noise").alias("text"))


@register("keep_only_noisy_docs", _keep_only_sql(C.HANGUL_DOCS_SQL, "doc_id"))
def keep_only_noisy_docs(spark, sf_dir):
    """C3 on whole documents that the cascade flags."""
    d = D.detect_noise(C.hangul_docs(spark, sf_dir), "text")
    return d.select("doc_id", T.keep_only_flagged("text", "is_noise").alias("text"))


def _sql_annotate(e: str) -> str:
    for ch, reading, *_ in P.HANJA_READINGS:
        e = f"replace({e}, {S.q(ch)}, {S.q(ch + '(' + reading + ')')})"
    return e


@register("annotate_hanja_conversations", f"""
SELECT conv_id, turn, {_sql_annotate('text')} AS text FROM conversations
""")
def annotate_hanja_conversations(spark, sf_dir):
    """C7 (the oracle applies the 49 replacements one after the other)."""
    c = C.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.annotate("text").alias("text"))


@register("first_line_docs", """
SELECT doc_id, split_part(text, chr(10), 1) AS first_line FROM documents
""")
def first_line_docs(spark, sf_dir):
    """C8."""
    d = C.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.first_line("text").alias("first_line"))


_ANS = (f"regexp_replace(CASE WHEN strpos(text, {S.q(P.ANSWER_MARKER)}) > 0 THEN "
        f"{S.py_strip('split_part(text, ' + S.q(P.ANSWER_MARKER) + ', -1)')} ELSE text END, "
        f"{S.q('^' + P.ANSWER_PREFIX + '[' + P.WS + ']*')}, '')")
_ANSWER = S.py_strip(_ANS)


@register("answers_conversations", f"""
SELECT conv_id, turn, {_ANSWER} AS answer,
  {S.py_strip(f"coalesce(regexp_split_to_array({_ANSWER}, {S.q(T.LINE_BREAK_RE)})[1], '')")} AS answer_line
FROM conversations
""")
def answers_conversations(spark, sf_dir):
    """C10 and C11 on model-style turns."""
    c = C.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.extract_answer("text").alias("answer"),
                    T.extract_answer_line("text").alias("answer_line"))


_SYN_SEG = f"regexp_extract(text, {S.q(':[' + P.WS + ']*([^' + chr(92) + 'n]*)')}, 1)"
_SYN = (f"CASE WHEN strpos(text, ':') > 0 THEN list_filter(list_transform(string_split({_SYN_SEG}, ','), "
        f"lambda x: {S.py_strip('x')}), lambda x: x <> '') ELSE [] END")


@register("synonym_answers_conversations", f"""
SELECT conv_id, turn, array_to_string({_SYN}, '|') AS synonyms, len({_SYN}) AS n_synonyms
FROM conversations
""")
def synonym_answers_conversations(spark, sf_dir):
    """C14 on every turn."""
    c = C.table(spark, sf_dir, "conversations").withColumn("s", T.parse_synonyms("text"))
    return c.select("conv_id", "turn", F.array_join("s", "|").alias("synonyms"),
                    F.size("s").cast("bigint").alias("n_synonyms"))


_TITLE = S.py_strip(f"split_part(text, {S.q(P.TITLE_MARKER)}, -1)")
_CLEAN_TITLE = S.collapse_ws(
    f"regexp_replace(regexp_replace({_TITLE}, {S.q('^\"|\"(' + chr(92) + 'n?)' + chr(92) + 'z')}, '\\1', 'g'), "
    f"{S.q('[' + P.WS + ']*이[' + P.WS + ']*제목은[^' + chr(92) + 'n]*(' + chr(92) + 'n?)' + chr(92) + 'z')}, '\\1')")


@register("generated_titles_conversations", f"""
SELECT conv_id, turn, {_CLEAN_TITLE} AS title FROM conversations WHERE role = 'assistant'
""")
def generated_titles_conversations(spark, sf_dir):
    """C12 title extraction and C13 title clean-up on assistant turns."""
    c = C.table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return c.select("conv_id", "turn", T.clean_title(T.extract_title("text")).alias("title"))


@register("vector_text_roundtrip", """
WITH s AS (SELECT vec_id, '[' || array_to_string(list_transform(embedding,
    lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)), ' ') || ']' AS v FROM embeddings)
SELECT vec_id, len(string_split(trim(translate(v, '[]', '')), ' ')) AS n,
  CAST(list_sum(list_transform(string_split(trim(translate(v, '[]', '')), ' '), lambda x: CAST(x AS DOUBLE))) AS BIGINT) AS total
FROM s
""")
def vector_text_roundtrip(spark, sf_dir):
    """A vector written as text (micro-units) and parsed back."""
    e = C.table(spark, sf_dir, "embeddings")
    s = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 1000000)
                                                       .cast("bigint").cast("string")), " "), F.lit("]"))
    p = T.parse_vector(s)
    return e.select("vec_id", F.size(p).cast("bigint").alias("n"),
                    F.aggregate(p, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("total"))


_LOW = f"{S.bucket(S.count('text', 'special_ko'), S.length('text'))} = 'low'"


@register("rare_char_denoise_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL}),
cnt AS (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM d WHERE {_LOW}) WHERE ch <> ''
        GROUP BY ch),
cov AS (SELECT ch, n, coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          * 10000 < sum(n) OVER () * 9995 AS keep FROM cnt),
cls AS (SELECT '[^' || coalesce(string_agg(CASE WHEN ch IN ('\\', '[', ']', '^', '-', '&') THEN '\\' || ch ELSE ch END,
          '' ORDER BY CASE WHEN ch IN ('\\', '[', ']', '^', '-', '&') THEN '\\' || ch ELSE ch END), '') || ']' AS c
        FROM cov WHERE keep)
SELECT doc_id, {S.collapse_ws("CASE WHEN cls.c = '[^]' THEN text ELSE regexp_replace(text, cls.c, ' ⁇ ', 'g') END")} AS text
FROM d, cls WHERE NOT ({_LOW})
""")
def rare_char_denoise_docs(spark, sf_dir):
    """C15 + I11: coverage set from low-noise documents, applied to the rest."""
    from tidyline.operators.clean import rare_char_denoise
    # written once: a filter on the bucket would map and count the text again in each of its branches
    d = sized(R.with_bucket(C.hangul_docs(spark, sf_dir), "text", "special_ko").select("doc_id", "text", "bucket"))
    clean = d.filter(F.col("bucket") == "low")
    noisy = d.filter(F.col("bucket") != "low").select("doc_id", "text")
    return rare_char_denoise(noisy, "text", clean)


@register("truncated_tokens_titles", f"""
WITH d AS ({C.HANGUL_TITLES_SQL}),
t AS (SELECT page_id, flatten({_SQL_TOKENS}) AS toks FROM d)
SELECT page_id, array_to_string(list_slice(toks, 1, 30), ' ') AS tokens, len(toks) AS n_tokens FROM t
""")
def truncated_tokens_titles(spark, sf_dir):
    """Tokens cut to the first 30 (max_length)."""
    d = C.hangul_titles(spark, sf_dir)
    toks = F.transform(F.flatten(T.tag_words(T.words("text"))), lambda x: x["tok"])
    return d.select("page_id", F.array_join(T.truncate_tokens(toks, 30), " ").alias("tokens"),
                    F.size(toks).cast("bigint").alias("n_tokens"))


@register("clean_decorated_docs", f"""
WITH d AS ({C.DECORATED_DOCS_SQL})
SELECT doc_id, {S.collapse_ws(S.remove_special(S.replace_steps(_sql_strip_tags('text'), P.ELLIPSIS_STEPS)))} AS cleaned,
  {S.replace_steps('text', P.TREND_STEPS)} AS without_trends, {_sql_annotate('text')} AS annotated,
  {S.rlike('text', P.PROFILES['hanja'])} AS has_hanja
FROM d
""")
def clean_decorated_docs(spark, sf_dir):
    """C1, C4a, C2, C6; C4b; C7; B9 on whole documents that have what they act on."""
    d = C.decorated_docs(spark, sf_dir)
    cleaned = T.collapse_ws(T.remove_special(T.remove_ellipsis(T.strip_tags("text"))))
    return d.select("doc_id", cleaned.alias("cleaned"), T.remove_trend_marks("text").alias("without_trends"),
                    T.annotate("text").alias("annotated"), T.has_class("text", "hanja").alias("has_hanja"))


@register("extract_decorated_docs", f"""
WITH d AS ({C.DECORATED_DOCS_SQL})
SELECT doc_id, {_ANSWER} AS answer,
  {S.py_strip(f"coalesce(regexp_split_to_array({_ANSWER}, {S.q(T.LINE_BREAK_RE)})[1], '')")} AS answer_line,
  {_CLEAN_TITLE} AS title, array_to_string({_SYN}, '|') AS synonyms
FROM d
""")
def extract_decorated_docs(spark, sf_dir):
    """C10, C11, C12, C13 and C14 on whole documents with markers, quotes, remarks and lists."""
    d = C.decorated_docs(spark, sf_dir)
    return d.select("doc_id", T.extract_answer("text").alias("answer"), T.extract_answer_line("text").alias("answer_line"),
                    T.clean_title(T.extract_title("text")).alias("title"), F.array_join(T.parse_synonyms("text"), "|").alias("synonyms"))


@register("truncated_tokens_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL}),
t AS (SELECT doc_id, flatten({_SQL_TOKENS}) AS toks FROM d)
SELECT doc_id, array_to_string(list_slice(toks, 1, 30), ' ') AS tokens, len(toks) AS n_tokens FROM t
""")
def truncated_tokens_docs(spark, sf_dir):
    """B18 on whole documents."""
    d = C.hangul_docs(spark, sf_dir)
    toks = d.select("doc_id", F.transform(F.flatten(T.tag_words(T.words("text"))), lambda x: x["tok"]).alias("toks"))
    return toks.select("doc_id", F.array_join(T.truncate_tokens("toks", 30), " ").alias("tokens"), F.size("toks").cast("bigint").alias("n_tokens"))
