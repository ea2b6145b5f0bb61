"""Registered queries: augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.functions.draws import sql_hash32, sql_key, sql_position_draw
from tidyline.operators import augment as A
from tidyline.operators.charnoise import drop_class_vectorized, inject_noise_vectorized
from tidyline.operators import report as R
from tidyline.plans import common as C
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register

NOISE_SEED, DROP_SEED, MIX_SEED, SHOT_SEED, SYN_SEED = 2024, 7, 5, 17, 13


def _sql_seed(key: str, seed: int, slot: int = 0) -> str:
    return sql_hash32(f"concat_ws(':', CAST({key} AS VARCHAR), '{seed}')", slot)


def _sql_noise(text: str, key: str, seed: int, level=0.5, ascii_ratio=0.93) -> str:
    h = [sql_position_draw(_sql_seed(key, seed, s), "i - 1") for s in range(3)]
    pick = (f"CASE WHEN {h[0]} < {A.threshold(level)} THEN CASE WHEN {h[1]} < {A.threshold(ascii_ratio)} "
            f"THEN chr(CAST(33 + {h[2]} % 94 AS INTEGER)) ELSE chr(CAST(19968 + {h[2]} % 20992 AS INTEGER)) END ELSE c END")
    return (f"CASE WHEN length({text}) = 0 THEN {text} ELSE "
            f"array_to_string(list_transform(string_split({text}, ''), lambda c, i: {pick}), '') END")


@register("inject_noise_titles", f"""
SELECT page_id, {_sql_noise('title', 'page_id', NOISE_SEED)} AS noisy FROM ({C.TITLES_SQL})
""")
def inject_noise_titles(spark, sf_dir):
    """J1 on page titles."""
    t = C.titles(spark, sf_dir)
    return t.select("page_id", A.inject_noise("title", "page_id", NOISE_SEED).alias("noisy"))


@register("inject_noise_docs", f"""
SELECT doc_id, {_sql_noise('text', 'doc_id', NOISE_SEED)} AS noisy FROM documents
""")
def inject_noise_docs(spark, sf_dir):
    """J1 on whole documents."""
    d = C.table(spark, sf_dir, "documents")
    return d.select("doc_id", inject_noise_vectorized("text", "doc_id", NOISE_SEED).alias("noisy"))


def _sql_drop(text: str, key: str, seed: int, replace: bool = False) -> str:
    h = sql_position_draw(_sql_seed(key, seed), "i - 1")
    tg = f"list_transform(string_split({text}, ''), lambda c, i: {{'h': {h}, 'i': i - 1, 'c': c}})"
    hits = f"list_filter(tg, lambda s: regexp_matches(s.c, {S.q('^' + P.PROFILES['hangul'] + '$')}))"
    pool = A.replacement_chars()
    repl = ("['" + "', '".join(c.replace("'", "''") for c in pool) + f"'][(s.h % {len(pool)}) + 1]") if replace else "''"
    cls = S.q('^' + P.PROFILES['hangul'] + '$')
    return f"""(SELECT CASE WHEN len(hits) = 0 THEN {text} ELSE array_to_string(list_transform(tg, lambda s:
  CASE WHEN regexp_matches(s.c, {cls}) AND (s.h < cut.h OR (s.h = cut.h AND s.i <= cut.i)) THEN {repl} ELSE s.c END), '') END
  FROM (SELECT tg, hits, list_sort(hits)[greatest(1, (len(hits) * 2) // 10)] AS cut
        FROM (SELECT tg, {hits} AS hits FROM (SELECT {tg} AS tg))))"""


@register("drop_hangul_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL})
SELECT doc_id, {_sql_drop('text', 'doc_id', DROP_SEED)} AS noised_text FROM d
""")
def drop_hangul_docs(spark, sf_dir):
    """J2 (drop mode) on whole hangulised documents."""
    d = C.hangul_docs(spark, sf_dir)
    return d.select("doc_id", drop_class_vectorized("text", "doc_id", DROP_SEED).alias("noised_text"))


@register("noised_pairs_titles", f"""
WITH d AS ({C.HANGUL_TITLES_SQL})
SELECT page_id, text, {_sql_drop('text', 'page_id', DROP_SEED, replace=True)} AS noised_text FROM d
""")
def noised_pairs_titles(spark, sf_dir):
    """J2 (replace mode) + J2b training pairs on hangulised titles."""
    d = C.hangul_titles(spark, sf_dir)
    return A.noised_pairs(d, "page_id", "text", DROP_SEED, mode="replace")


@register("noised_pairs_docs", f"""
WITH d AS ({C.HANGUL_DOCS_SQL})
SELECT doc_id, text, {_sql_drop('text', 'doc_id', DROP_SEED, replace=True)} AS noised_text FROM d
""")
def noised_pairs_docs(spark, sf_dir):
    """J2 (replace mode) + J2b on whole documents."""
    d = C.hangul_docs(spark, sf_dir)
    return d.select("doc_id", "text", drop_class_vectorized("text", "doc_id", DROP_SEED, mode="replace").alias("noised_text"))


def _sql_words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {S.q('[' + P.WS + ']+')}), lambda w: w <> '')"


def _sql_mix(n: int, reverse: bool) -> str:
    prefix = "augr" if reverse else "aug"
    ha = sql_hash32(f"concat_ws(':', lang, CAST(i AS VARCHAR), '{MIX_SEED}', 'a')")
    hb = sql_hash32(f"concat_ws(':', lang, CAST(i AS VARCHAR), '{MIX_SEED}', 'b')")
    first = "array_to_string(list_slice(wa, 1, len(wa) // 2), ' ')"
    second = "array_to_string(list_slice(wb, len(wb) // 2 + 1, len(wb)), ' ')"
    body = f"{second} || ' ' || {first}" if reverse else f"{first} || ' ' || {second}"
    return f"""
WITH pool AS (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY {sql_hash32(sql_key('doc_id', str(MIX_SEED)))},
                doc_id) - 1 AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents),
sizes AS (SELECT lang, max(n) AS n FROM pool GROUP BY lang),
dd AS (SELECT lang, i, {ha} % n AS a, {hb} % n AS b FROM (SELECT lang, n, unnest(range({n})) AS i FROM sizes)),
j AS (SELECT dd.lang, dd.i, {_sql_words('pa.text')} AS wa, {_sql_words('pb.text')} AS wb
      FROM dd JOIN pool pa ON pa.lang = dd.lang AND pa.rn = dd.a JOIN pool pb ON pb.lang = dd.lang AND pb.rn = dd.b)
SELECT format('{prefix}_{{}}_{{}}', lang, i) AS doc_id, {body} AS text, lang FROM j
"""


@register("mix_halves_docs", _sql_mix(800, False))
def mix_halves_docs(spark, sf_dir):
    """800 same-language half mixes per language."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return A.mix_halves(d, "doc_id", "text", "lang", 800, MIX_SEED)


@register("mix_halves_reversed_docs", _sql_mix(200, True))
def mix_halves_reversed_docs(spark, sf_dir):
    """200 reversed half mixes per language."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return A.mix_halves(d, "doc_id", "text", "lang", 200, MIX_SEED, reverse=True)


_URL_LANG = "regexp_extract(url, '/([a-z]{2})/', 1)"


def labelled_titles(spark, sf_dir):
    p = C.table(spark, sf_dir, "pages")
    t = p.select("page_id", F.regexp_extract("html", C.TITLE_RE, 1).alias("title"),
                 F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))
    return R.with_bucket(t, "title", "special_ko")


def few_shot_sql(k: int = 3) -> str:
    hs = [sql_hash32(f"concat_ws(':', CAST(page_id AS VARCHAR), '{j}', '{SHOT_SEED}', 'shot')") for j in range(k)]
    assert k == 3
    x0 = f"CASE WHEN n > 0 THEN {hs[0]} % n END"
    x1r = f"CASE WHEN n > 1 THEN {hs[1]} % (n - 1) END"
    x2r = f"CASE WHEN n > 2 THEN {hs[2]} % (n - 2) END"
    pair = ("'입력된 제목: ' || " + _sql_noise('orig', "concat_ws(':', CAST(page_id AS VARCHAR), CAST(j AS VARCHAR))",
                                              SHOT_SEED) + " || chr(10) || '복원된 제목: ' || orig || chr(10) || chr(10)")
    return f"""
WITH t AS (SELECT page_id, regexp_extract(html, {S.q(C.TITLE_RE)}, 1) AS title, {_URL_LANG} AS lang FROM pages),
b AS (SELECT *, {S.bucket(S.count('title', 'special_ko'), S.length('title'))} AS bucket FROM t),
pool AS (SELECT lang, title AS orig, row_number() OVER (PARTITION BY lang ORDER BY
           {sql_hash32(sql_key('page_id', str(SHOT_SEED)))}, page_id) - 1 AS rk, count(*) OVER (PARTITION BY lang) AS n
         FROM b WHERE bucket = 'low'),
sizes AS (SELECT lang, max(n) AS n FROM pool GROUP BY lang),
tg AS (SELECT b.page_id, b.lang, sizes.n FROM b LEFT JOIN sizes USING (lang) WHERE b.bucket <> 'low'),
p0 AS (SELECT page_id, lang, n, {x0} AS x0, {x1r} AS x1r, {x2r} AS x2r FROM tg),
p1 AS (SELECT *, CASE WHEN x1r >= x0 THEN x1r + 1 ELSE x1r END AS x1 FROM p0),
p2 AS (SELECT *, CASE WHEN x2r IS NULL THEN NULL ELSE
         (CASE WHEN (CASE WHEN x2r >= least(x0, x1) THEN x2r + 1 ELSE x2r END) >= greatest(x0, x1)
               THEN (CASE WHEN x2r >= least(x0, x1) THEN x2r + 1 ELSE x2r END) + 1
               ELSE (CASE WHEN x2r >= least(x0, x1) THEN x2r + 1 ELSE x2r END) END) END AS x2 FROM p1),
ex AS (SELECT page_id, lang, 0 AS j, x0 AS rk FROM p2 WHERE x0 IS NOT NULL
       UNION ALL SELECT page_id, lang, 1, x1 FROM p2 WHERE x1 IS NOT NULL
       UNION ALL SELECT page_id, lang, 2, x2 FROM p2 WHERE x2 IS NOT NULL),
ej AS (SELECT ex.page_id, ex.j, pool.orig FROM ex JOIN pool ON ex.lang = pool.lang AND ex.rk = pool.rk),
blk AS (SELECT page_id, '예시: ' || chr(10) || string_agg({pair}, '' ORDER BY j) AS examples FROM ej GROUP BY page_id)
SELECT tg.page_id, tg.lang, coalesce(blk.examples, '예시: ' || chr(10)) AS examples FROM tg LEFT JOIN blk USING (page_id)
"""


@register("few_shot_titles", few_shot_sql(3))
def few_shot_titles(spark, sf_dir):
    """Three noised same-language clean titles per noisy title."""
    b = labelled_titles(spark, sf_dir)
    pool = b.filter(F.col("bucket") == "low").select("page_id", "title", "lang")
    targets = b.filter(F.col("bucket") != "low").select("page_id", "lang")
    return A.few_shot(targets, pool, "page_id", "title", "lang", SHOT_SEED).select("page_id", "lang", "examples")


def synonyms_from_conversations(spark, sf_dir):
    """(word, synonyms): every word of a user turn, answered by a line of the
    next assistant turn (its lines in turn) read as "word: a, b, c" (C14)."""
    c = C.table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", T.words("text").alias("words"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.split("text", "\n").alias("lines"))
    line = F.get("lines", F.col("pos") % F.size("lines"))
    qa = u.join(a, ["conv_id", "turn"]).select("conv_id", "turn", "lines", F.posexplode("words").alias("pos", "word"))
    qa = qa.select("conv_id", "turn", "pos", "word", F.concat("word", F.lit(": "), line).alias("answer"))
    return A.synonym_table(qa, "word", "answer", ["conv_id", "turn", "pos"])


_SYN_SEG = f"regexp_extract(answer, {S.q(':[' + P.WS + ']*([^' + chr(92) + 'n]*)')}, 1)"
_SYN_SQL = f"""
u AS (SELECT conv_id, turn, unnest(range(len(ws))) AS pos, unnest(ws) AS word
      FROM (SELECT conv_id, turn, {_sql_words('text')} AS ws FROM conversations WHERE role = 'user')),
a AS (SELECT conv_id, turn - 1 AS turn, string_split(text, chr(10)) AS lines FROM conversations WHERE role = 'assistant'),
qa AS (SELECT u.conv_id, u.turn, pos, word, word || ': ' || lines[pos % len(lines) + 1] AS answer FROM u JOIN a USING (conv_id, turn)),
qs AS (SELECT conv_id, turn, pos, word, list_filter(list_transform(string_split({_SYN_SEG}, ','),
       lambda x: {S.py_strip('x')}), lambda x: x <> '') AS syns FROM qa),
syn AS (SELECT word, syns FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY conv_id, turn, pos) AS r
        FROM qs WHERE len(syns) > 0) WHERE r = 1)
"""


@register("synonym_table_conversations", f"WITH {_SYN_SQL} SELECT word, array_to_string(syns, '|') AS synonyms FROM syn")
def synonym_table_conversations(spark, sf_dir):
    """The synonym table (C14 over answers), one row per word."""
    s = synonyms_from_conversations(spark, sf_dir)
    return s.select("word", F.array_join("synonyms", "|").alias("synonyms"))


@register("synonym_augmented_docs", f"""
WITH {_SYN_SQL},
w AS (SELECT doc_id, text, {_sql_words('text')} AS ws FROM documents),
cand AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM w),
c2 AS (SELECT * FROM cand WHERE {sql_position_draw(_sql_seed('doc_id', SYN_SEED, 0), 'pos')} < {A.threshold(0.3)}),
rep AS (SELECT c2.doc_id, c2.pos, syn.syns[{sql_position_draw(_sql_seed('c2.doc_id', SYN_SEED, 1), 'c2.pos')} % len(syn.syns) + 1] AS new
        FROM c2 JOIN syn USING (word)),
mp AS (SELECT doc_id, map_from_entries(list({{'k': pos, 'v': new}})) AS m FROM rep GROUP BY doc_id),
aug AS (SELECT CAST(w.doc_id AS VARCHAR) || '_aug' AS doc_id, w.ws, mp.m, text FROM w LEFT JOIN mp USING (doc_id))
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents
UNION ALL
SELECT doc_id, array_to_string(list_transform(ws, lambda x, i: coalesce(map_extract_value(m, i - 1), x)), ' ') FROM aug
""")
def synonym_augmented_docs(spark, sf_dir):
    """J6 + K1: original documents plus ``_aug`` rows with synonyms replaced."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return A.with_augmented(d, "doc_id", "text", synonyms_from_conversations(spark, sf_dir), SYN_SEED)
