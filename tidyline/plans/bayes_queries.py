"""Registered queries: the counted classifier in its seven uses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions.draws import sql_hash32, sql_key
from tidyline.operators import bayes as B
from tidyline.operators import detect as D
from tidyline.plans import common as C
from tidyline.plans import relabel_queries as RQ
from tidyline.plans import sqlfrag as S
from tidyline.plans.registry import register
from tidyline.session import sized, spread


def bayes_ctes(rows: str) -> str:
    """CTEs that end in PR (id, label, s, p, pred): ``rows`` selects id, text, label, fold, train, score.  The model of a fold
    holds the rows to train on that are not in it."""
    return f"""
rw AS ({rows}),
ch AS (SELECT *, string_split(coalesce(text, ''), '') AS c FROM rw),
oc AS (SELECT * FROM (SELECT id, label, fold, train, score, unnest(list_transform(list_zip(c, c[2:]), lambda x: x[1] || x[2])) AS g FROM ch) WHERE g IS NOT NULL),
fo AS (SELECT DISTINCT fold FROM rw WHERE score),
gr AS (SELECT fold, label, g, count(*) AS n FROM oc WHERE train GROUP BY fold, label, g),
mg AS (SELECT fo.fold, label, g, CAST(sum(n) AS BIGINT) AS n FROM gr JOIN fo ON gr.fold <> fo.fold GROUP BY fo.fold, label, g),
vo AS (SELECT fold, count(DISTINCT g) AS v FROM mg GROUP BY fold),
gl AS (SELECT fold, label, CAST(sum(n) AS BIGINT) AS n FROM mg GROUP BY fold, label),
dl AS (SELECT fo.fold, label, count(*) AS d FROM rw JOIN fo ON rw.fold <> fo.fold WHERE train GROUP BY fo.fold, label),
al AS (SELECT fold, CAST(sum(d) AS BIGINT) AS d FROM dl GROUP BY fold),
ba AS (SELECT fold, dl.label, CAST(round(ln(dl.d / al.d), 9) AS DECIMAL(18,9)) AS prior,
         CAST(round(ln(CAST(greatest(coalesce(gl.n, 0) + coalesce(vo.v, 0), 1) AS DOUBLE)), 9) AS DECIMAL(18,9)) AS den
       FROM dl JOIN al USING (fold) LEFT JOIN gl USING (fold, label) LEFT JOIN vo USING (fold)),
wt AS (SELECT fold, label, g, CAST(round(ln(CAST(n + 1 AS DOUBLE)), 9) AS DECIMAL(18,9)) AS w FROM mg),
su AS (SELECT oc.id, wt.label, sum(w) AS s FROM oc JOIN wt ON oc.fold = wt.fold AND oc.g = wt.g WHERE oc.score GROUP BY oc.id, wt.label),
sc AS (SELECT rw.id, ba.label, ba.prior - CAST(greatest(coalesce(length(rw.text), 0) - 1, 0) AS DECIMAL(10,0)) * ba.den + coalesce(su.s, 0) AS s
       FROM rw JOIN ba USING (fold) LEFT JOIN su ON su.id = rw.id AND su.label = ba.label WHERE rw.score),
ex AS (SELECT id, label, s, exp(CAST(s - max(s) OVER (PARTITION BY id) AS DOUBLE)) AS e,
         first_value(label) OVER (PARTITION BY id ORDER BY s DESC, label) AS pred FROM sc),
PR AS (SELECT id, label, s, round(e / sum(e) OVER (PARTITION BY id), 9) AS p, pred FROM ex),
PD AS (SELECT DISTINCT id, pred FROM PR)"""


def labelled_docs(spark, sf_dir):
    return C.table(spark, sf_dir, "documents").select("doc_id", "text", C.lang_label().alias("target"))


def first_rule_docs(spark, sf_dir):
    """Documents with the cascade's first rule as the flag, so that both sides are large; kept, as fits and predictions read it."""
    d = D.detect_noise(C.hangul_docs(spark, sf_dir), "text")
    return spread(sized(d.select("doc_id", "text", C.lang_label().alias("target"), (F.col("stage") == "morph_v1").cast("int").alias("is_noise"))), "doc_id")


_FLAGGED = f"""
d AS ({C.HANGUL_DOCS_SQL}),
fq AS ({S.frequent_chars_cte('d', 'text')}),
fl AS (SELECT doc_id, text, {C.LANG_LABEL} AS target,
         CASE WHEN coalesce({S.v1(f"translate({S.without_hanja('d.text')}, fq.chars, '')")}, false) THEN 1 ELSE 0 END AS is_noise FROM d, fq)"""

_HALF = f"{sql_hash32(sql_key('doc_id', '3'))} % 2"
_CROSSFIT = f"WITH {_FLAGGED}," + bayes_ctes(f"""
SELECT doc_id AS id, text, is_noise AS label, CASE WHEN is_noise = 1 THEN -1 ELSE {_HALF} END AS fold, true AS train, is_noise = 0 AS score FROM fl""")


def crossfit(spark, sf_dir):
    return B.crossfit_noise(first_rule_docs(spark, sf_dir), "doc_id", "text", "is_noise", 3)


@register("crossfit_noise_bayes_docs", _CROSSFIT + "SELECT id AS doc_id FROM PD WHERE pred = 1")
def crossfit_noise_bayes_docs(spark, sf_dir):
    """rows that the cross-fitted model judges noise."""
    return crossfit(spark, sf_dir).filter("model_hit = 1").select("doc_id")


@register("assembled_flag_bayes_docs", _CROSSFIT + """
SELECT fl.doc_id, target, CAST(coalesce(PD.pred, 0) AS INTEGER) AS model_hit, CAST(greatest(is_noise, coalesce(PD.pred, 0)) AS INTEGER) AS is_noise
FROM fl LEFT JOIN PD ON PD.id = fl.doc_id""")
def assembled_flag_bayes_docs(spark, sf_dir):
    """the rules' and the model's hits as one flag."""
    return crossfit(spark, sf_dir).select("doc_id", "target", "model_hit", "is_noise")


_FOLDED = f"""
SELECT doc_id AS id, text, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {sql_hash32(sql_key('doc_id', '42'))}, doc_id) - 1) % 3 AS INTEGER) AS fold,
  true AS train, true AS score FROM (SELECT doc_id, text, {C.LANG_LABEL} AS label FROM documents)"""


@register("oof_probs_bayes_docs", "WITH " + bayes_ctes(_FOLDED) + """
SELECT rw.id AS doc_id, rw.label AS target, rw.fold, PR.pred, round(max(p), 6) AS p_max, round(max(p) FILTER (WHERE PR.label = rw.label), 6) AS p_given
FROM rw JOIN PR ON PR.id = rw.id GROUP BY ALL""")
def oof_probs_bayes_docs(spark, sf_dir):
    """H1: out-of-fold probabilities; a fold's counts are taken off the totals."""
    p = B.oof_probs(labelled_docs(spark, sf_dir), "doc_id", "text", "target", 3, 42)
    return p.select("doc_id", "target", "fold", "pred", F.round(F.array_max("prob"), 6).alias("p_max"),
                    F.round(F.element_at("prob", F.col("target") + 1), 6).alias("p_given"))


@register("noise_split_relabel_bayes_docs", f"WITH {_FLAGGED}," + bayes_ctes("""
SELECT doc_id AS id, text, target AS label, CASE WHEN is_noise = 1 THEN -1 ELSE 0 END AS fold, is_noise = 1 AS train, is_noise = 0 AS score FROM fl""") + f""",
DN AS (SELECT rw.id, k, coalesce(p, 0.0) AS p FROM (SELECT id, unnest(range((SELECT max(label) FROM dl) + 1)) AS k FROM rw WHERE score) rw
       LEFT JOIN PR ON PR.id = rw.id AND PR.label = k),
P AS (SELECT rw.id AS vec_id, rw.label, list(DN.p ORDER BY k) AS prob, list_position(list(DN.p ORDER BY k), max(DN.p)) - 1 AS pred
      FROM rw JOIN DN USING (id) WHERE rw.score GROUP BY rw.id, rw.label)
{RQ.ISSUES_TAIL_SQL}
SELECT vec_id AS doc_id, target, new_label FROM NL""")
def noise_split_relabel_bayes_docs(spark, sf_dir):
    """H4: counted on noisy rows; clean rows relabelled by confident learning."""
    r = B.noise_split_relabel(first_rule_docs(spark, sf_dir), "doc_id", "text", "target", "is_noise")
    return r.select("doc_id", "target", "new_label")


def metrics_ctes(pairs: str) -> str:
    """CTEs CM (by class) and OV (accuracy, macro_f1) over ``pairs``, which selects y, p."""
    return f""",
yp AS ({pairs}),
TS AS (SELECT y AS cls, count(*) AS support, count(*) FILTER (WHERE y = p) AS tp FROM yp GROUP BY y),
PS AS (SELECT p AS cls, count(*) AS n_pred FROM yp GROUP BY p),
CM AS (SELECT coalesce(TS.cls, PS.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) - coalesce(tp, 0) AS fp,
  coalesce(support, 0) - coalesce(tp, 0) AS fn, CASE WHEN n_pred > 0 THEN coalesce(tp, 0) / n_pred ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN coalesce(tp, 0) / support ELSE 0.0 END AS recall,
  CASE WHEN tp > 0 THEN 2 * tp / (support + n_pred) ELSE 0.0 END AS f1 FROM TS FULL JOIN PS ON TS.cls = PS.cls),
OV AS (SELECT (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FROM yp) AS accuracy, avg(f1) AS macro_f1 FROM CM)"""


def split_sql(seed: int, where: str) -> str:
    """30 % of each class of ``where``'s rows, by draw, as is_valid."""
    rank = f"row_number() OVER (PARTITION BY label ORDER BY {sql_hash32(sql_key('doc_id', str(seed)))}, doc_id) - 1"
    return (f"SELECT *, CASE WHEN {rank} < floor((count(*) OVER (PARTITION BY label) * 6000 + 10000) / 20000) THEN 1 ELSE 0 END AS is_valid FROM ({where})")


@register("classify_overwrite_bayes_docs", f"WITH {_FLAGGED}, sp AS ({split_sql(42, 'SELECT doc_id, text, target AS label FROM fl WHERE is_noise = 1')})," + bayes_ctes("""
SELECT doc_id AS id, text, label, CASE WHEN is_valid = 0 THEN -1 ELSE 0 END AS fold, is_valid = 0 AS train, is_valid = 1 AS score FROM sp
UNION ALL SELECT doc_id, text, target, 0, false, true FROM fl WHERE is_noise = 0""") + metrics_ctes(
    "SELECT sp.label AS y, PD.pred AS p FROM sp JOIN PD ON PD.id = sp.doc_id WHERE is_valid = 1") + """
SELECT doc_id, PD.pred AS target, fl.target AS prev_target, CAST(CASE WHEN PD.pred = fl.target THEN 0 ELSE 1 END AS INTEGER) AS is_changed,
  round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM fl JOIN PD ON PD.id = fl.doc_id, OV WHERE is_noise = 0""")
def classify_overwrite_bayes_docs(spark, sf_dir):
    """H6: the clean rows' labels as predicted, with the changes and the validation metrics of the model."""
    flags, metrics = B.classify_overwrite(first_rule_docs(spark, sf_dir), "doc_id", "text", "target", "is_noise")
    return C.round_doubles(flags.select("doc_id", "target", "prev_target", "is_changed").crossJoin(F.broadcast(metrics)))  # one row


_TRAIN = f"sp AS ({split_sql(456, f'SELECT doc_id, text, {C.LANG_LABEL} AS label FROM documents')})"
_RUN = f"WITH {_TRAIN}," + bayes_ctes("""
SELECT doc_id AS id, text, label, CASE WHEN is_valid = 0 THEN -1 ELSE 0 END AS fold, is_valid = 0 AS train, is_valid = 1 AS score FROM sp
UNION ALL SELECT -1 - item_id, text, NULL, 0, false, true FROM benchmark""") + metrics_ctes(
    "SELECT sp.label AS y, PD.pred AS p FROM sp JOIN PD ON PD.id = sp.doc_id WHERE is_valid = 1")


def run(spark, sf_dir) -> B.Run:
    test = C.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return B.train_evaluate_predict(labelled_docs(spark, sf_dir), test, "doc_id", "text", "target")


@register("train_run_bayes_docs", _RUN + """
SELECT 'class' AS part, CAST(cls AS BIGINT) AS id, support, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, NULL::INTEGER AS target FROM CM
UNION ALL SELECT 'overall', NULL, NULL, NULL, NULL, NULL, round(accuracy, 6), NULL, round(macro_f1, 6), NULL FROM OV
UNION ALL SELECT 'test', item_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, PD.pred FROM benchmark JOIN PD ON PD.id = -1 - item_id""")
def train_run_bayes_docs(spark, sf_dir):
    """H7: one fit gives the metrics by class, the overall ones (accuracy as ``precision``, macro F1 as ``f1``) and the
    predictions for the test table."""
    r = run(spark, sf_dir)
    parts = [r.per_class.select(F.lit("class").alias("part"), F.col("cls").cast("long").alias("id"), "support", "tp", "fp", "fn", "precision", "recall", "f1"),
             r.overall.select(F.lit("overall").alias("part"), F.col("accuracy").alias("precision"), F.col("macro_f1").alias("f1")),
             r.predictions.select(F.lit("test").alias("part"), F.col("doc_id").alias("id"), "target")]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return C.round_doubles(out)


@register("predict_benchmark_bayes", _RUN + "SELECT item_id AS doc_id, benchmark.text, PD.pred AS target FROM benchmark JOIN PD ON PD.id = -1 - item_id")
def predict_benchmark_bayes(spark, sf_dir):
    """Predictions attached to the rows of the test table by key."""
    return run(spark, sf_dir).predictions.select("doc_id", "text", "target")
