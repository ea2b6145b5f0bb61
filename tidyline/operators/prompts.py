"""Prompt templates as a table (J8) and chat messages.

A template is a row (name, version, body, system); ``{text}`` and
``{target}`` in the body are filled per row.  Rendering is a join with the
one template's row; the body is cut at its placeholders and joined again, so
an unknown (name, version) gives a NULL prompt and a text that looks like a
placeholder stays as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The short prompt templates and system messages, written out
# with the indentation the reference's triple-quoted strings carry.
DENOISE_V1 = (
    "다음은 노이즈가 있는 한국어 뉴스 기사 제목입니다.\n"
    "    이를 원래의 정확한 한국어 제목으로 복원해주세요.\n"
    "    특수문자는 포함하지 마세요.\n"
    "    복원된 제목만 대답하세요.\n"
    "\n"
    "    노이즈 있는 제목: {text}\n"
    "    복원된 제목:"
)
TITLE_TO_ARTICLE_V1 = (
    "다음 기사 제목에 대한 내용을 작성해주세요.\n"
    "    주제는 똑같지만 기사 내용은 창의적이어도 좋습니다.\n"
    "    : {text}\n"
    "\n"
    "    기사 내용:"
)
TITLE_TO_ARTICLE_END = "기사 내용:"
ARTICLE_TO_TITLE_V1 = (
    "다음 기사 내용을 바탕으로 새로운 제목을 생성해주세요.\n"
    "    절대 기사 내용에 들어간 단어는 쓰지 마세요.:\n"
    "    \n\n{text}\n\n새로운 제목:"
)
SYSTEM_DENOISE_V1 = "You are EXAONE model from LG AI Research, a helpful assistant."
FEW_SHOT_DENOISE = (
    "다음은 아스키코드가 치환되는 방식으로 많은 노이즈가 있는 한국어 뉴스 기사 제목입니다.\n"
    "    노이즈가 들어가지 않은 한글부분을 참고하여 원래의 정확한 한국어 제목으로 복원해주세요.\n"
    "    앞뒤에 설명 붙이지 말고, 반드시 복원된 제목만 대답하세요.\n"
    "    아래의 예시는 동일한 주제의 복원된 뉴스기사 제목입니다.\n"
    "    예시를 참고하여 예시와 반드시 동일한 주제로 복원하세요.\n"
    "    입력된 제목보다 짧지 않도록 생성하세요.\n"
    "    {examples}\n"
    "    입력된 제목: {text}\n"
    "    복원된 제목:"
)

# The further versions, in words of our own.  What differs between them is what they tell the model: 2 what was done to the
# title, in one sentence; 3 with the range of the signs and examples; 4 with rules on whole words; 5 with examples of the
# same topic; 6 with sections for instructions, input, output and examples, and a system message.
DENOISE_V2 = "아래 제목에는 영문자, 숫자, 기호가 끼어들어 있습니다. 끼어든 글자를 걷어 내고 본래 제목 한 줄만 적어 주세요. {text}"
DENOISE_V3 = (
    "아래 제목의 일부 글자가 코드 32에서 126 사이의 기호로 바뀌었습니다. 한글은 그대로이니 기호만 고쳐 주세요.\n\n"
    "노이즈 있는 제목: 비 온 뒤 하#이 맑%다\n복원된 제목: 비 온 뒤 하늘이 맑다\n\n"
    "노이즈 있는 제목: {text}\n복원된 제목:"
)
DENOISE_V4 = (
    "손상된 제목을 되돌리는 규칙입니다.\n"
    "1. 온전한 한글 낱말은 바꾸지 않습니다.\n"
    "2. 손상된 낱말은 온전한 낱말에서 뜻을 짐작해 채웁니다.\n"
    "3. 짐작할 수 없으면 ?? 만 적습니다.\n\n"
    "노이즈 있는 제목 : {text}\n복원된 제목:"
)
DENOISE_V5 = "같은 주제의 보기를 참고해 제목을 되돌려 주세요. 제목만 적습니다.\n{examples}입력된 제목: {text}\n복원된 제목:"
DENOISE_V6 = (
    "# 할 일\n손상된 기사 제목을 되돌립니다. 한자는 손상이 아니므로 남깁니다.\n"
    "# 입력\n[입력]: 다음에 제목이 옵니다.\n"
    "# 출력\n되돌린 제목만 적고, 되돌릴 수 없으면 비워 둡니다.\n"
    "# 보기\n[입력]: 봄#이 왔%다\n[출력]: 봄이 왔다\n"
    "[입력]: {text}\n[출력]:"
)
SYSTEM_DENOISE_V6 = "정해진 형식으로만 답하는 복원 도구입니다."
RELABEL_V1 = (
    "# 할 일\n기사 제목의 주제 번호(0에서 6)가 맞는지 살펴, 맞으면 그대로, 틀리면 알맞은 번호를 적습니다.\n"
    "# 출력\n숫자 하나만 적습니다.\n"
    "[기사 제목]: {text} [주제]: {target}\n[출력]:"
)
SYSTEM_RELABEL_V1 = "주제 번호만 답하는 검수 도구입니다."
AUGMENT_V1 = (
    "# 할 일\n같은 주제의 새 기사 제목을 다섯 개 짓습니다. 낱말과 고유명사는 겹치지 않게 합니다.\n"
    "# 출력\n['하나', '둘', '셋', '넷', '다섯'] 꼴로만 적습니다.\n"
    "[입력]: {text}\n[출력]:"
)
SYSTEM_AUGMENT_V1 = "목록만 답하는 도구입니다."
SYNONYMS_V1 = "이 낱말과 뜻이 비슷한 낱말 다섯 개를 쉼표로 이어 적어 주세요: {text}"

BUILTIN = [
    ("denoise", 1, DENOISE_V1, SYSTEM_DENOISE_V1),
    ("denoise", 2, DENOISE_V2, None),
    ("denoise", 3, DENOISE_V3, None),
    ("denoise", 4, DENOISE_V4, None),
    ("denoise", 5, DENOISE_V5, None),
    ("denoise", 6, DENOISE_V6, SYSTEM_DENOISE_V6),
    ("relabel", 1, RELABEL_V1, SYSTEM_RELABEL_V1),
    ("augment", 1, AUGMENT_V1, SYSTEM_AUGMENT_V1),
    ("synonyms", 1, SYNONYMS_V1, None),
    ("denoise_few_shot", 1, FEW_SHOT_DENOISE, None),
    ("title_to_article", 1, TITLE_TO_ARTICLE_V1, None),
    ("article_to_title", 1, ARTICLE_TO_TITLE_V1, None),
]

SCHEMA = "name string, version int, body string, system string"


def templates(spark: SparkSession, extra: list[tuple] | None = None) -> DataFrame:
    """The template table: the built-in templates plus user rows (the longer
    few-shot templates are supplied this way, e.g. read from a file)."""
    return spark.createDataFrame(BUILTIN + list(extra or []), SCHEMA)


def load_templates(spark: SparkSession, path: str) -> DataFrame:
    """Templates from a JSON-lines file with the same four fields."""
    return spark.read.schema(SCHEMA).json(path)


def render_prompt(df: DataFrame, tmpl: DataFrame, name: str, version: int, text: str,
                  target: str | None = None, examples: str | None = None, out: str = "prompt") -> DataFrame:
    """``out`` = the template body with ``{text}`` (and ``{target}``,
    ``{examples}``) filled in; NULL when (name, version) is unknown."""
    # one row: a template given twice fails the job, an unknown one is NULL
    n = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"duplicate template: {name} {version}")).cast("string"))
    t = F.broadcast(tmpl.filter((F.col("name") == name) & (F.col("version") == version))
                    .agg(F.coalesce(n, F.first("body")).alias("_body"), F.first("system").alias("_system")))
    fill = {"{text}": F.col(text)} | ({"{target}": F.col(target)} if target else {}) | ({"{examples}": F.col(examples)} if examples else {})
    j = df.join(t, how="left")
    return j.withColumn(out, _filled(F.col("_body"), fill)).withColumnRenamed("_system", f"{out}_system").drop("_body")


def _filled(body: F.Column, fill: dict[str, F.Column]) -> F.Column:
    """The body is cut at its placeholders, so that what is filled in is never read as one."""
    names = "|".join(k.strip("{}") for k in fill)
    parts = F.split(body, rf"(?=\{{(?:{names})\}})|(?<=\{{(?:{names})\}})")

    def put(part):
        got = part
        for k, v in fill.items():
            got = F.when(part == k, F.coalesce(v.cast("string"), F.lit(""))).otherwise(got)
        return got

    return F.array_join(F.transform(parts, put), "")


def render_versions(df: DataFrame, tmpl: DataFrame, fill: dict[str, F.Column], out: str = "prompt") -> DataFrame:
    """Every template of ``tmpl`` on every row, in one pass over ``df``: adds name, version, ``out`` and its system
    message.  ``fill`` names what stands for each placeholder, e.g. ``{"{text}": F.col("title")}``."""
    all_of = F.broadcast(tmpl.agg(F.collect_list(F.struct("name", "version", "body", "system")).alias("_t")))  # one row
    j = df.join(all_of).withColumn("_t", F.explode("_t")).select(*df.columns, "_t.*")
    return j.withColumn(out, _filled(F.col("body"), fill)).withColumnRenamed("system", f"{out}_system").drop("body")


def chat_messages(system, user) -> F.Column:
    """[{role: system, content}, {role: user, content}]."""
    s = F.col(system) if isinstance(system, str) else system
    u = F.col(user) if isinstance(user, str) else user
    return F.array(F.struct(F.lit("system").alias("role"), s.alias("content")),
                   F.struct(F.lit("user").alias("role"), u.alias("content")))
