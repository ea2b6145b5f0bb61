"""Registered queries: prompts, the batch hook, the resumable run and the
``pyspark.ml`` steps (J8–J12, L1, F3, H1, H4, H6, H7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.operators import augment as A
from tidyline.operators import detect as D
from tidyline.operators import infer as I
from tidyline.operators import joins as J
from tidyline.operators import learn as L
from tidyline.operators import prompts as PR
from tidyline.plans import augment_queries as AQ
from tidyline.plans import common as C
from tidyline.plans import detect_queries as DQ
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register
from tidyline.session import scratch_path, sized
from tidyline.streaming.resume import resumable_generate


def normalise_model():
    """A deterministic stand-in model: whitespace-normalised input."""
    return lambda texts: [" ".join(t.split()) for t in texts]


def echo_answer_model():
    """A deterministic stand-in model answering in the reference's format."""
    def fn(prompts):
        out = []
        for p in prompts:
            line = p.split("노이즈 있는 제목:")[-1].split("\n")[0]
            out.append("복원된 제목: 답변: " + "".join(ch for ch in line if ch.isalnum() or ch.isspace()))
        return out
    return fn


@register("render_prompt_titles", f"""
SELECT page_id, replace({S.q(PR.DENOISE_V1)}, '{{text}}', title) AS prompt, {S.q(PR.SYSTEM_DENOISE_V1)} AS prompt_system
FROM ({C.TITLES_SQL})
""")
def render_prompt_titles(spark, sf_dir):
    """The denoise v1 prompt per title."""
    t = C.titles(spark, sf_dir)
    return PR.render_prompt(t, PR.templates(spark), "denoise", 1, "title").select("page_id", "prompt", "prompt_system")


def _versions_sql() -> str:
    bodies = " UNION ALL ".join(
        f"SELECT {S.q(n)} AS name, {v} AS version, {S.q(b)} AS body, {S.q(m) if m else 'NULL::VARCHAR'} AS system" for n, v, b, m in PR.BUILTIN)
    # placeholders in the order in which no filled-in text can be read as one: the test texts have no braces
    filled = "replace(replace(replace(body, '{target}', CAST(target AS VARCHAR)), '{examples}', lang || chr(10)), '{text}', text)"
    return f"""
WITH t AS ({bodies}), d AS (SELECT doc_id, lang, text, {C.LANG_LABEL} AS target FROM documents)
SELECT doc_id, name, version, sha256({filled}) AS prompt_sha256, length({filled}) AS n_chars, system FROM d, t"""


@register("render_versions_docs", _versions_sql())
def render_versions_docs(spark, sf_dir):
    """Every template and version on whole documents, with text, target and examples filled in."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "lang", "text", C.lang_label().alias("target"))
    p = PR.render_versions(d, PR.templates(spark), {"{text}": F.col("text"), "{target}": F.col("target"), "{examples}": F.concat("lang", F.lit("\n"))})
    return p.select("doc_id", "name", "version", F.sha2("prompt", 256).alias("prompt_sha256"), F.length("prompt").cast("bigint").alias("n_chars"),
                    F.col("prompt_system").alias("system"))


@register("unknown_template_titles", f"SELECT page_id, NULL::VARCHAR AS prompt FROM ({C.TITLES_SQL})")
def unknown_template_titles(spark, sf_dir):
    """An unknown version renders NULL."""
    t = C.titles(spark, sf_dir)
    return PR.render_prompt(t, PR.templates(spark), "denoise", 9, "title").select("page_id", "prompt")


@register("chat_messages_titles", f"""
SELECT page_id, 'system' AS role_0, {S.q(PR.SYSTEM_DENOISE_V1)} AS content_0, 'user' AS role_1,
  replace({S.q(PR.DENOISE_V1)}, '{{text}}', title) AS content_1 FROM ({C.TITLES_SQL})
""")
def chat_messages_titles(spark, sf_dir):
    """System + user messages."""
    t = PR.render_prompt(C.titles(spark, sf_dir), PR.templates(spark), "denoise", 1, "title")
    m = t.select("page_id", PR.chat_messages("prompt_system", "prompt").alias("m"))
    return m.select("page_id", F.col("m")[0]["role"].alias("role_0"), F.col("m")[0]["content"].alias("content_0"),
                    F.col("m")[1]["role"].alias("role_1"), F.col("m")[1]["content"].alias("content_1"))


@register("batch_generate_docs", f"""
SELECT doc_id, {S.collapse_ws('text')} AS generated, NULL::VARCHAR AS error FROM documents
""")
def batch_generate_docs(spark, sf_dir):
    """The hook over whole documents (Arrow batches, model built once per partition)."""
    d = C.table(spark, sf_dir, "documents")
    return I.batch_generate(d, "doc_id", "text", normalise_model, "generated", 32)


@register("length_batches_docs", f"""
SELECT doc_id, {S.collapse_ws('text')} AS generated, NULL::VARCHAR AS error, true AS padded_enough, true AS less_padding FROM documents
""")
def length_batches_docs(spark, sf_dir):
    """J10 by batches of like length.  Each text is padded to its own length at least, and the padding is
    less than that of batches of 32 rows in order of the key."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    g = sized(I.batch_generate_by_length(d, "doc_id", "text", normalise_model))
    n = F.coalesce(F.length("text"), F.lit(0))
    rows = d.select("doc_id", n.alias("_n"))
    by_key = rows.groupBy((F.col("doc_id") / 32).cast("long").alias("_b")).agg((F.max("_n") * F.count("*")).alias("_p")).agg(F.sum("_p").alias("_of_32"))
    share = I.padding_share(g, d, "doc_id", "text").crossJoin(by_key).crossJoin(rows.agg(F.sum("_n").alias("_all")))  # one row
    less = share.select((F.col("padding") <= 1 - F.try_divide(F.col("_all"), F.col("_of_32"))).alias("less_padding"))
    return (g.join(rows, "doc_id").crossJoin(F.broadcast(less))
             .select("doc_id", "generated", "error", (F.col("padded") >= F.col("_n")).alias("padded_enough"), F.coalesce("less_padding", F.lit(True)).alias("less_padding")))


@register("two_step_titles", f"""
SELECT page_id, title, {S.collapse_ws('title')} AS back_translation FROM ({C.TITLES_SQL})
""")
def two_step_titles(spark, sf_dir):
    """F then g through the hook."""
    return I.two_step(C.titles(spark, sf_dir), "page_id", "title", normalise_model, normalise_model).drop("error")


def failing_model():
    """A stand-in model that fails on texts of even length."""
    def fn(texts):
        if any(len(t) % 2 == 0 for t in texts):
            raise ValueError("even length")
        return [t + "!" for t in texts]
    return fn


@register("two_step_failing_docs", """
SELECT doc_id, CASE WHEN length(text) % 2 = 0 THEN text ELSE text || '!' END AS back_translation,
  CASE WHEN length(text) % 2 = 0 THEN 'ValueError: even length' END AS error FROM documents
""")
def two_step_failing_docs(spark, sf_dir):
    """J11 where the model fails for some rows: they keep their text and say why."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return I.two_step(d, "doc_id", "text", failing_model, lambda: (lambda texts: list(texts))).drop("text")


@register("denoise_job_titles", f"""
{DQ.CASCADE_TITLES_SQL}
SELECT page_id, {S.collapse_ws("CASE WHEN stage <> 'not_noise' THEN regexp_replace(text, '[^" + chr(92) + "p{L}" + chr(92) + "p{N}" + P.WS + "]', '', 'g') ELSE text END")} AS text,
  0 AS target, NULL::VARCHAR AS error FROM s
""")
def denoise_job_titles(spark, sf_dir):
    """Flagged titles through prompt, model and answer extraction; the
    rest pass; recombined."""
    t = D.detect_noise(C.hangul_titles(spark, sf_dir), "text").withColumn("target", F.lit(0))
    return I.denoise_job(t, "page_id", "text", "target", "is_noise", echo_answer_model, PR.templates(spark))


@register("resumable_generate_docs", f"""
SELECT doc_id, {S.collapse_ws('text')} AS generated, NULL::VARCHAR AS error FROM documents
""")
def resumable_generate_docs(spark, sf_dir):
    """L1: a resumable streaming run of the hook over the documents files."""
    out = scratch_path(spark, "resume-out")
    return resumable_generate(spark, sf_dir, out, "doc_id", "text", normalise_model, glob="documents.parquet")


def few_shot_model():
    """A stand-in model that echoes the prompt, then answers with its length
    and the title, and adds a remark on a line of its own."""
    def fn(prompts):
        out = []
        for p in prompts:
            title = p.split("입력된 제목: ")[-1].split("\n")[0]
            out.append(f"{p} 답변: {len(p)} {title}\n설명")
        return out
    return fn


@register("few_shot_denoise_titles", f"""
WITH t AS ({C.TITLES_SQL}), fs AS ({AQ.few_shot_sql(3)}),
p AS (SELECT page_id, replace(replace({S.q(PR.FEW_SHOT_DENOISE)}, '{{examples}}', examples), '{{text}}', title) AS prompt
      FROM t JOIN fs USING (page_id))
SELECT page_id, CASE WHEN prompt IS NULL THEN title ELSE {S.py_strip("length(prompt) || ' ' || title")} END AS title
FROM t LEFT JOIN p USING (page_id)
""")
def few_shot_denoise_titles(spark, sf_dir):
    """Noisy titles with noised examples of their own
    language go through the few-shot prompt and the model; the first line of
    the answer takes the title's place, a failed row keeps its title."""
    b = AQ.labelled_titles(spark, sf_dir)
    noisy = b.filter(F.col("bucket") != "low").select("page_id", "title", "lang")
    pool = b.filter(F.col("bucket") == "low").select("page_id", "title", "lang")
    shots = A.few_shot(noisy, pool, "page_id", "title", "lang", AQ.SHOT_SEED)
    p = PR.render_prompt(shots, PR.templates(spark), "denoise_few_shot", 1, "title", examples="examples")
    g = I.batch_generate(p, "page_id", "prompt", few_shot_model, "_gen").filter("error is null")
    new = g.select("page_id", T.extract_answer_line("_gen").alias("title"))
    return J.replace_or_add(b.select("page_id", "title"), new, "page_id", "title", replace=True)


def _flagged_docs(spark, sf_dir):
    """The cascade's result, kept: each fit and prediction reads it again."""
    d = C.hangul_docs(spark, sf_dir)
    return sized(D.detect_noise(d, "text").withColumn("target", C.lang_label()))


@register("crossfit_noise_titles")
def crossfit_noise_titles(spark, sf_dir):
    """F3 + F4: the cross-fitted classifier over the rows the rules left."""
    t = sized(D.detect_noise(C.hangul_titles(spark, sf_dir), "text"))
    return L.crossfit_noise(t, "page_id", "text", "is_noise", 3).select("page_id", "stage", "model_hit", "is_noise")


@register("oof_probs_ml_docs")
def oof_probs_ml_docs(spark, sf_dir):
    """H1: out-of-fold probabilities from a fresh classifier per fold."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", C.lang_label().alias("target"))
    p = L.oof_probs(d, "doc_id", "text", "target", 3, 42)
    return p.select("doc_id", "target", "fold", "pred", F.round(F.array_max("prob"), 6).alias("p_max"))


@register("noise_split_relabel_docs")
def noise_split_relabel_docs(spark, sf_dir):
    """H4: fit on noisy rows, relabel clean rows by confident learning."""
    r = L.noise_split_relabel(_flagged_docs(spark, sf_dir), "doc_id", "text", "target", "is_noise")
    return r.select("doc_id", "target", "new_label")


@register("classify_overwrite_docs")
def classify_overwrite_docs(spark, sf_dir):
    """H6: predict the clean rows' labels, with the changes and the model's validation metrics."""
    flags, metrics = L.classify_overwrite(_flagged_docs(spark, sf_dir), "doc_id", "text", "target", "is_noise")
    return flags.select("doc_id", "target", "prev_target", "is_changed").crossJoin(F.broadcast(C.round_doubles(metrics)))  # one row


@register("train_evaluate_docs")
def train_evaluate_docs(spark, sf_dir):
    """H7: validation metrics of the language classifier."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", C.lang_label().alias("target"))
    test = C.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    overall, per_class, _ = L.train_evaluate_predict(d, test, "doc_id", "text", "target")
    return C.round_doubles(per_class.crossJoin(overall))


@register("predict_benchmark")
def predict_benchmark(spark, sf_dir):
    """H7 + G8: predictions for a test table, attached by key."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", C.lang_label().alias("target"))
    test = C.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    _, _, out = L.train_evaluate_predict(d, test, "doc_id", "text", "target")
    return out.select("doc_id", "target")





def _title_article_model():
    """Deterministic stand-in generator: echoes the prompt with an answer."""
    def fn(prompts):
        out = []
        for p in prompts:
            if p.rstrip().endswith(PR.TITLE_TO_ARTICLE_END):
                out.append(p + " 기사 본문 " + p.split(": ", 1)[-1].split("\n")[0])
            else:
                out.append(p + " \"생성 제목 " + str(len(p)) + "\" 이 제목은 예시입니다")
        return out
    return fn


@register("title_article_title", f"""
WITH t AS (SELECT page_id, title FROM ({C.TITLES_SQL}) ORDER BY length(title) DESC, page_id LIMIT 600),
a AS (SELECT page_id, {S.py_strip("'기사 본문 ' || title")} AS article FROM t)
SELECT page_id, '생성 제목 ' || length(replace({S.q(PR.ARTICLE_TO_TITLE_V1)}, '{{text}}', article)) || '"' AS text,
  printf('ynat-v1_train_%05d', row_number() OVER (ORDER BY page_id) - 1) AS "ID" FROM a
""")
def title_article_title(spark, sf_dir):
    """The 600 longest titles -> article prompt -> model -> article
    -> title prompt -> model -> title (C12, C13) with new ids (B17)."""
    from pyspark.sql import Window
    from tidyline.operators.split import top_k_longest
    t = top_k_longest(C.titles(spark, sf_dir), "title", "page_id", 600)
    tm = PR.templates(spark)
    a = PR.render_prompt(t, tm, "title_to_article", 1, "title", out="p1")
    g1 = I.batch_generate(a, "page_id", "p1", _title_article_model, "gen1")
    art = g1.select("page_id", T.extract_article("gen1", PR.TITLE_TO_ARTICLE_END).alias("article"))
    b = PR.render_prompt(art, tm, "article_to_title", 1, "article", out="p2")
    g2 = I.batch_generate(b, "page_id", "p2", _title_article_model, "gen2")
    titles = g2.select("page_id", T.clean_title(T.extract_title("gen2")).alias("text"))
    w = Window.orderBy("page_id")  # over at most 600 rows (the top-k result)
    return titles.withColumn("ID", T.format_id("ynat-v1_train_%05d", F.row_number().over(w) - 1))
