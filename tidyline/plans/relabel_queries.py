"""Registered queries: out-of-fold scores, confident learning, relabelling,
transitions and metrics (H1b, H2, H3, H5, H8, E4, E6, E7, E12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyline.functions.draws import sql_hash32, sql_key
from tidyline.operators import relabel as RL
from tidyline.operators import report as R
from tidyline.operators import split as SP
from tidyline.plans import common as C
from tidyline.plans.registry import register
from tidyline.session import sized, spread

K_FOLDS, SEED = 3, 42

_PROBS_SQL = f"""
WITH f AS (SELECT vec_id, label, embedding, CAST((row_number() OVER (PARTITION BY label ORDER BY
             {sql_hash32(sql_key('vec_id', str(SEED)))}, vec_id) - 1) % {K_FOLDS} AS INTEGER) AS fold FROM embeddings),
x AS (SELECT vec_id, fold, label, unnest(range(len(embedding))) AS dim, CAST(CAST(unnest(embedding) AS DOUBLE) AS DECIMAL(38,12)) AS x FROM f),
s AS (SELECT fold, label, dim, sum(x) AS s FROM x GROUP BY fold, label, dim),
c AS (SELECT fold, label, count(*) AS c FROM f GROUP BY fold, label),
t AS (SELECT label, dim, sum(s) AS ts FROM s GROUP BY label, dim),
tc AS (SELECT label, sum(c) AS tc FROM c GROUP BY label),
g AS (SELECT ff.fold, t.label, t.dim, t.ts, tc.tc FROM t JOIN tc USING (label)
      CROSS JOIN (SELECT unnest(range({K_FOLDS})) AS fold) ff),
cen AS (SELECT g.fold, g.label, g.dim, CAST(g.ts - coalesce(s.s, 0) AS DOUBLE) / (g.tc - coalesce(c.c, 0)) AS v
        FROM g LEFT JOIN s USING (fold, label, dim) LEFT JOIN c USING (fold, label)),
z AS (SELECT e.vec_id, cen.label AS cls, -sum((e.x - cen.v) * (e.x - cen.v)) AS z
      FROM (SELECT vec_id, fold, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM f) e
      JOIN cen ON e.fold = cen.fold AND e.dim = cen.dim GROUP BY e.vec_id, cen.label),
zm AS (SELECT vec_id, cls, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z),
pr AS (SELECT vec_id, cls, round(e / sum(e) OVER (PARTITION BY vec_id), 9) AS p FROM zm),
pa AS (SELECT vec_id, list(p ORDER BY cls) AS prob FROM pr GROUP BY vec_id),
P AS (SELECT f.vec_id, f.label, f.fold, pa.prob, list_position(pa.prob, list_max(pa.prob)) - 1 AS pred
      FROM f JOIN pa USING (vec_id))
"""

ISSUES_TAIL_SQL = """,
TT AS (SELECT label AS k, avg(prob[label + 1]) AS t FROM P GROUP BY label),
PX AS (SELECT vec_id, label, unnest(range(len(prob))) AS k, unnest(prob) AS pk FROM P),
M AS (SELECT PX.*, CASE WHEN pk >= TT.t - 1e-6 THEN pk ELSE -1.0 END AS mk FROM PX LEFT JOIN TT USING (k)),
MM AS (SELECT *, max(mk) OVER (PARTITION BY vec_id) AS mx FROM M),
GS AS (SELECT vec_id, label, CASE WHEN max(mx) >= 0 THEN min(k) FILTER (WHERE mk = mx) END AS guess
      FROM MM GROUP BY vec_id, label),
J AS (SELECT label AS given, CAST(guess AS INTEGER) AS guess, count(*) AS n FROM GS WHERE guess IS NOT NULL
      GROUP BY label, guess),
NI AS (SELECT label AS given, count(*) AS n_i FROM P GROUP BY label),
RS AS (SELECT given, sum(n) + CASE WHEN coalesce(sum(n) FILTER (WHERE guess = given), 0) < 1 THEN 1 ELSE 0 END AS rowsum
       FROM J GROUP BY given),
Q AS (SELECT J.given, J.guess AS other, CAST(floor((2 * J.n * NI.n_i + RS.rowsum) / (2 * RS.rowsum)) AS BIGINT) AS quota
      FROM J JOIN RS USING (given) JOIN NI USING (given) WHERE J.guess <> J.given),
E AS (SELECT PX.vec_id, PX.label, PX.k AS other, PX.pk - P.prob[P.label + 1] AS margin
      FROM PX JOIN P USING (vec_id) WHERE PX.k <> PX.label),
RK AS (SELECT E.*, Q.quota, row_number() OVER (PARTITION BY E.label, E.other ORDER BY margin DESC, vec_id) - 1 AS rk
       FROM E JOIN Q ON E.label = Q.given AND E.other = Q.other WHERE Q.quota > 0),
CA AS (SELECT DISTINCT vec_id FROM RK WHERE rk < quota),
I AS (SELECT P.vec_id, P.label, P.pred AS suggested, P.prob[P.label + 1] AS self_confidence
      FROM P JOIN CA USING (vec_id) WHERE P.pred <> P.label),
NL AS (SELECT P.vec_id, P.label AS target, CASE WHEN I.vec_id IS NOT NULL THEN P.pred ELSE P.label END AS new_label
       FROM P LEFT JOIN I USING (vec_id))
"""
_ISSUES_SQL = _PROBS_SQL + ISSUES_TAIL_SQL


def probs(spark, sf_dir):
    e = C.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    f = spread(sized(SP.kfold(e, "vec_id", K_FOLDS, SEED, by="label")), "vec_id")
    return spread(sized(RL.centroid_oof_probs(f, "vec_id", "embedding", "label", "fold", K_FOLDS)), "vec_id")


@register("oof_centroid_probs", _PROBS_SQL + """
SELECT vec_id, label, fold, pred, round(prob[label + 1], 6) AS p_given, round(list_max(prob), 6) AS p_max FROM P
""")
def oof_centroid_probs(spark, sf_dir):
    """Out-of-fold nearest-centroid probabilities on embeddings."""
    p = probs(spark, sf_dir)
    return p.select("vec_id", "label", "fold", "pred",
                    F.round(F.element_at("prob", F.col("label") + 1), 6).alias("p_given"),
                    F.round(F.array_max("prob"), 6).alias("p_max"))


@register("class_thresholds_centroid", _ISSUES_SQL + "SELECT k, round(t, 6) AS t FROM TT")
def class_thresholds_centroid(spark, sf_dir):
    """Per-class thresholds."""
    t = RL.class_thresholds(probs(spark, sf_dir), "label", "prob")
    return t.select(F.posexplode("_t").alias("k", "t")).filter(F.col("t").isNotNull()) \
            .select("k", F.round("t", 6).alias("t"))


@register("confident_joint_centroid", _ISSUES_SQL + "SELECT given, guess, n FROM J")
def confident_joint_centroid(spark, sf_dir):
    """The confident joint."""
    g = RL.with_confident_guess(probs(spark, sf_dir), "label", "prob")
    return RL.confident_joint(g, "label")


@register("prune_quotas_centroid", _ISSUES_SQL + "SELECT given, other, quota FROM Q WHERE quota > 0")
def prune_quotas_centroid(spark, sf_dir):
    """Calibrated off-diagonal counts."""
    g = RL.with_confident_guess(probs(spark, sf_dir), "label", "prob")
    return RL.prune_quotas(g, "label")


def issues(spark, sf_dir):
    p = probs(spark, sf_dir)
    return p, RL.find_label_issues(p, "vec_id", "label", "prob")


@register("label_issues_centroid", _ISSUES_SQL + """
SELECT vec_id, label, suggested, round(self_confidence, 6) AS self_confidence FROM I
""")
def label_issues_centroid(spark, sf_dir):
    """H2: find_label_issues over out-of-fold probabilities."""
    _, i = issues(spark, sf_dir)
    return i.select("vec_id", "label", "suggested", F.round("self_confidence", 6).alias("self_confidence"))


def relabelled(spark, sf_dir):
    p, i = issues(spark, sf_dir)
    return RL.apply_relabel(p, i, "vec_id", "label", "prob").withColumnRenamed("label", "target")


@register("relabel_centroid", _ISSUES_SQL + "SELECT vec_id, new_label AS target FROM NL")
def relabel_centroid(spark, sf_dir):
    """H3 + H5: new labels, saved as (key, target)."""
    return RL.save_modified(relabelled(spark, sf_dir), "vec_id", None)


@register("label_transitions_centroid", _ISSUES_SQL + """
SELECT target, new_label, count(*) AS n FROM NL WHERE target <> new_label GROUP BY target, new_label
""")
def label_transitions_centroid(spark, sf_dir):
    """(old, new) counts among changed rows."""
    return R.label_transitions(relabelled(spark, sf_dir), "target", "new_label")


@register("changed_rows_centroid", _ISSUES_SQL + """
SELECT vec_id, target, new_label FROM NL WHERE target <> new_label
""")
def changed_rows_centroid(spark, sf_dir):
    """Changed-label rows without the probability column."""
    r = relabelled(spark, sf_dir)
    return r.filter(F.col("target") != F.col("new_label")).select("vec_id", "target", "new_label")


_METRICS_SQL = _PROBS_SQL + """,
TS AS (SELECT label AS cls, count(*) AS support, count(*) FILTER (WHERE label = pred) AS tp FROM P GROUP BY label),
PS AS (SELECT pred AS cls, count(*) AS n_pred FROM P GROUP BY pred),
CM AS (SELECT coalesce(TS.cls, PS.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
              coalesce(n_pred, 0) AS n_pred FROM TS FULL JOIN PS ON TS.cls = PS.cls),
CM2 AS (SELECT cls, support, tp, n_pred - tp AS fp, support - tp AS fn,
   CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
   CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
   CASE WHEN tp > 0 THEN 2 * tp / (support + n_pred) ELSE 0.0 END AS f1 FROM CM)
"""


@register("class_metrics_centroid", _METRICS_SQL + """
SELECT cls, support, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM CM2
""")
def class_metrics_centroid(spark, sf_dir):
    """Per-class precision, recall (accuracy within class) and F1."""
    return C.round_doubles(R.class_metrics(probs(spark, sf_dir), "label", "pred"))


@register("overall_metrics_centroid", _METRICS_SQL + """
SELECT round((SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM P), 6) AS accuracy,
       round(avg(f1), 6) AS macro_f1 FROM CM2
""")
def overall_metrics_centroid(spark, sf_dir):
    """Accuracy and macro F1."""
    return C.round_doubles(R.overall_metrics(probs(spark, sf_dir), "label", "pred"))


@register("most_confident_unchanged", _PROBS_SQL + """
SELECT vec_id, label, round(prob[label + 1], 6) AS confidence FROM P WHERE pred = label
ORDER BY prob[label + 1] DESC, vec_id LIMIT 200
""")
def most_confident_unchanged(spark, sf_dir):
    """H8: the 200 most confident rows whose prediction equals the label."""
    m = RL.most_confident_unchanged(probs(spark, sf_dir), "vec_id", "label", "prob", 200)
    return m.select("vec_id", "label", F.round("confidence", 6).alias("confidence"))


@register("most_confident_20", _PROBS_SQL + """
SELECT vec_id, label, round(prob[label + 1], 6) AS confidence FROM P WHERE pred = label
ORDER BY prob[label + 1] DESC, vec_id LIMIT 20
""")
def most_confident_20(spark, sf_dir):
    """H8 where the limit cuts."""
    m = RL.most_confident_unchanged(probs(spark, sf_dir), "vec_id", "label", "prob", 20)
    return m.select("vec_id", "label", F.round("confidence", 6).alias("confidence"))

