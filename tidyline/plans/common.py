"""Shared inputs of the registered queries: test tables and derived views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyline.functions import text as T
from tidyline.plans import sqlfrag as S
from tidyline.session import spread

TITLE_RE = "(?s)<title>(.*?)</title>"


KEYS = {"documents": "doc_id", "pages": "page_id", "embeddings": "vec_id", "conversations": "conv_id",
        "labels": "doc_id", "benchmark": "item_id", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df, KEYS.get(name))


def hangul_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with 20 Latin letters mapped to Hangul, so the Korean rule
    profiles have something to act on (whole texts)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", T.hangulise("text").alias("text"))


HANGUL_DOCS_SQL = f"SELECT doc_id, lang, {S.hangulise('text')} AS text FROM documents"


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page titles: the headline-like texts of the test data."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", TITLE_RE, 1).alias("title"))


TITLES_SQL = f"SELECT page_id, regexp_extract(html, {S.q(TITLE_RE)}, 1) AS title FROM pages"


def hangul_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = titles(spark, sf_dir)
    return t.select("page_id", T.hangulise("title").alias("text"))


HANGUL_TITLES_SQL = f"SELECT page_id, {S.hangulise('title')} AS text FROM ({TITLES_SQL})"

# Documents with marks that the plain tables lack, dealt by doc_id (whole texts): (before, after)
DECORATIONS = (
    ("그래픽종합", "종합2보"),
    ("…美 北核 3%↑ ", " 中.. 끝...%↓"),
    ("복원된 제목: 하나 복원된 제목: 답변: ", ""),
    ('새로운 제목: "', '" 이 제목은 예시입니다'),
    ("낱말: 가, 나 , ,다\n", ""),
    ("게시판1보", "1보\n"),
    ("", ""),
)


def decorated_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the whole text with a decoration, an output that is short for some, and a source text that is missing for some."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    sides = [F.element_at(F.array(*[F.lit(x[k]) for x in DECORATIONS]), (F.col("doc_id") % len(DECORATIONS) + 1).cast("int")) for k in (0, 1)]
    short = F.when(F.col("doc_id") % 9 == 4, F.substring("text", 1, 8)).otherwise(F.col("text"))
    source = F.when(F.col("doc_id") % 10 == 5, "missing title").otherwise(F.col("text"))
    return d.select("doc_id", F.concat(sides[0], F.col("text"), sides[1]).alias("text"), short.alias("output"), source.alias("source_text"))


DECORATED_DOCS_SQL = (
    "SELECT doc_id, concat(before, text, after) AS text, short AS output, source_text FROM (SELECT doc_id, text, "
    + ", ".join(f"CASE doc_id % {len(DECORATIONS)} " + " ".join(f"WHEN {i} THEN {S.q(x[k])}" for i, x in enumerate(DECORATIONS)) + f" END AS {n}"
                for k, n in ((0, "before"), (1, "after")))
    + ", CASE WHEN doc_id % 9 = 4 THEN substr(text, 1, 8) ELSE text END AS short"
    + ", CASE WHEN doc_id % 10 = 5 THEN 'missing title' ELSE text END AS source_text FROM documents)")


def capital_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in capitals (ASCII letters only), so that the profiles that take lower case for noise tell them
    apart by their other characters."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.translate("text", LOWER, LOWER.upper()).alias("text"))


LOWER = "abcdefghijklmnopqrstuvwxyz"
CAPITAL_DOCS_SQL = f"SELECT doc_id, translate(text, '{LOWER}', '{LOWER.upper()}') AS text FROM documents"

LANG_LABEL = "CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 ELSE 4 END"


def lang_label() -> F.Column:
    """documents.lang as an integer label 0..4."""
    return (F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1)
             .when(F.col("lang") == "de", 2).when(F.col("lang") == "es", 3).otherwise(4))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle hashes compare values exactly)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])
