"""Metrics over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.functions.scalars import sigmoid
from fraudlens.operators import metrics as m
from fraudlens.operators.graph import reconstruction_mse
from fraudlens.queries.base import query


def _curve(score: str, name: str = "c") -> str:
    return f"""g_{name} AS (SELECT {score} AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q FROM scored GROUP BY 1),
         {name} AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(q) OVER (ORDER BY s DESC) AS fp,
                           sum(p) OVER () AS pos, sum(q) OVER () AS neg FROM g_{name})"""


def _f1(name: str = "c") -> str:
    return f"""f_{name} AS (SELECT *, tp / (tp + fp) AS pr, tp / pos AS rc,
                 2 * (tp / (tp + fp)) * (tp / pos) / (tp / (tp + fp) + tp / pos + 1e-8) AS f1 FROM {name}),
         b_{name} AS (SELECT * FROM f_{name} ORDER BY f1 DESC, s LIMIT 1)"""


_AUC = "(SELECT sum(p * (neg - fp + q / 2)) / (max(pos) * max(neg)) FROM {c})"
_AP = "(SELECT sum(p / pos * tp / (tp + fp)) FROM {c})"


@query("a13_confusion", """
    SELECT count(*) FILTER (WHERE score_a < 50 AND label = 0) AS tn, count(*) FILTER (WHERE score_a >= 50 AND label = 0) AS fp,
           count(*) FILTER (WHERE score_a < 50 AND label = 1) AS fn, count(*) FILTER (WHERE score_a >= 50 AND label = 1) AS tp FROM scored""")
def a13(spark, d):
    return m.confusion(b.scored(spark, d), 50.0, "label", "score_a")


@query("a14_point_metrics", """
    WITH c AS (SELECT count(*) FILTER (WHERE score_b < 50 AND label = 0) AS tn, count(*) FILTER (WHERE score_b >= 50 AND label = 0) AS fp,
           count(*) FILTER (WHERE score_b < 50 AND label = 1) AS fn, count(*) FILTER (WHERE score_b >= 50 AND label = 1) AS tp FROM scored)
    SELECT tn, fp, fn, tp, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
           round(tn / CAST(tn + fp AS DOUBLE), 6) AS specificity, round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy,
           round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1 FROM c""")
def a14(spark, d):
    rates = ("precision", "recall", "specificity", "accuracy", "f1")
    return m.point_metrics(m.confusion(b.scored(spark, d), 50.0, "label", "score_b")).withColumns(
        {r: F.round(r, 6) for r in rates}
    )


@query("a16_reconstruction_mse", """
    SELECT round(avg(list_sum(list_transform(list_zip(CAST(embedding[33:64] AS DOUBLE[]), CAST(embedding[1:32] AS DOUBLE[])),
           lambda z: (z[1] - z[2]) * (z[1] - z[2])))) / 32, 6) AS reconstruction_mse FROM embeddings""")
def a16(spark, d):
    whole = F.col("embedding").cast("array<double>")
    rows = b.table(spark, d, "embeddings").select(whole.alias("feat"), F.slice(whole, 33, 32).alias("emb"))
    return _rounded(reconstruction_mse(rows, "emb", "feat", 32), "reconstruction_mse")


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("a17_roc_auc", f"WITH {_curve('score_b')} SELECT round({_AUC.format(c='c')}, 6) AS auc")
def a17(spark, d):
    return _rounded(m.roc_auc(b.scored(spark, d), "label", "score_b"), "auc")


@query("a18_average_precision", f"WITH {_curve('score_a')} SELECT round({_AP.format(c='c')}, 6) AS average_precision")
def a18(spark, d):
    return _rounded(m.average_precision(b.scored(spark, d), "label", "score_a"), "average_precision")


@query("a18_average_precision_by", """
    WITH g AS (SELECT e.user_id % 8 AS grp, score_a AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q
               FROM scored JOIN events e ON e.event_id = id GROUP BY 1, 2),
         c AS (SELECT *, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER (PARTITION BY grp) AS pos FROM g
               WINDOW w AS (PARTITION BY grp ORDER BY s DESC))
    SELECT grp, round(sum(p / pos * tp / (tp + fp)), 6) AS average_precision FROM c GROUP BY grp""")
def a18_by(spark, d):
    rows = b.table(spark, d, "events").select(
        (F.col("user_id") % 8).alias("grp"), (F.col("event_type") == "error").cast("int").alias("label"), F.col("value").alias("score")
    )
    return _rounded(m.average_precision_by(rows, "grp"), "average_precision")


_RANKS = """ra AS (SELECT score_a AS v, sum(n) OVER (ORDER BY score_a) - (n - 1) / 2.0::DOUBLE AS r FROM (SELECT score_a, count(*) AS n FROM scored GROUP BY 1)),
         rb AS (SELECT score_b AS v, sum(n) OVER (ORDER BY score_b) - (n - 1) / 2.0::DOUBLE AS r FROM (SELECT score_b, count(*) AS n FROM scored GROUP BY 1))"""
_RHO = "(SELECT corr(ra.r, rb.r) FROM scored JOIN ra ON ra.v = score_a JOIN rb ON rb.v = score_b)"


@query("a19_spearman", f"WITH {_RANKS} SELECT round({_RHO}, 6) AS spearman")
def a19(spark, d):
    return _rounded(m.spearman(b.scored(spark, d), "score_a", "score_b"), "spearman")


@query("a20_log_loss", """
    WITH p AS (SELECT label, least(greatest(1 / (1 + exp(-(score_a - 50) / 25)), 1e-7::DOUBLE), 1 - 1e-7::DOUBLE) AS p FROM scored)
    SELECT round(avg(-(4.0::DOUBLE * label * ln(p) + (1 - label) * ln(1 - p))), 6) AS log_loss FROM p""")
def a20(spark, d):
    rows = b.scored(spark, d).withColumn("prob", sigmoid((F.col("score_a") - 50) / 25))
    return _rounded(m.bce(rows, "label", "prob", pos_weight=4.0), "log_loss")


@query("w08_pr_curve", f"""
    WITH {_curve('score_a')}
    SELECT s AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / pos, 6) AS recall FROM c UNION ALL SELECT NULL, 1.0, 0.0""")
def w08(spark, d):
    return _rounded(m.pr_curve(b.scored(spark, d), "label", "score_a"), "precision", "recall")


@query("w09_roc_curve", f"""
    WITH {_curve('score_b')}
    SELECT s AS threshold, round(fp / neg, 6) AS fpr, round(tp / pos, 6) AS tpr FROM c UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def w09(spark, d):
    return _rounded(m.roc_curve(b.scored(spark, d), "label", "score_b"), "fpr", "tpr")


@query("w10_best_f1", f"""
    WITH {_curve('score_a')}, {_f1()} SELECT round(f1, 6) AS best_f1_score, s AS best_threshold FROM b_c""")
def w10(spark, d):
    return _rounded(m.best_f1(b.scored(spark, d), "label", "score_a"), "best_f1_score")


_EVALUATE = """
    SELECT round({auc}, 6) AS auc, round({ap}, 6) AS average_precision, round(f1, 6) AS best_f1_score, s AS best_threshold,
           round(pr, 6) AS precision, round(rc, 6) AS recall, round((neg - fp) / neg, 6) AS specificity,
           CAST(neg - fp AS BIGINT) AS true_negatives, CAST(fp AS BIGINT) AS false_positives,
           CAST(pos - tp AS BIGINT) AS false_negatives, CAST(tp AS BIGINT) AS true_positives FROM b_c"""


def _evaluated(rows, score):
    rates = ("auc", "average_precision", "best_f1_score", "precision", "recall", "specificity")
    return _rounded(m.evaluate(rows, "label", score), *rates)


@query("m06_evaluate", f"WITH {_curve('score_a')}, {_f1()} {_EVALUATE.format(auc=_AUC.format(c='c'), ap=_AP.format(c='c'))}")
def m06(spark, d):
    return _evaluated(b.scored(spark, d), "score_a")


@query("m06_evaluate_tied", f"WITH {_curve('score_b')}, {_f1()} {_EVALUATE.format(auc=_AUC.format(c='c'), ap=_AP.format(c='c'))}")
def m06_tied(spark, d):
    return _evaluated(b.scored(spark, d), "score_b")


@query("m07_compare", f"""
    WITH {_curve('score_a')}, {_f1()}, {_curve('score_b', 'k')}, {_f1('k')}, {_RANKS},
         v AS (SELECT 'auc' AS metric, {_AUC.format(c='c')} AS a, {_AUC.format(c='k')} AS z
               UNION ALL SELECT 'average_precision', {_AP.format(c='c')}, {_AP.format(c='k')}
               UNION ALL SELECT 'best_f1_score', (SELECT f1 FROM b_c), (SELECT f1 FROM b_k))
    SELECT metric, round(a, 6) AS first, round(z, 6) AS second, round(z - a, 6) AS difference, round((z / a - 1) * 100, 4) AS percent FROM v
    UNION ALL SELECT 'spearman', round({_RHO}, 6), round({_RHO}, 6), NULL, NULL
    UNION ALL SELECT 'prevalence', round(avg(label), 6), round(avg(label), 6), NULL, NULL FROM scored""")
def m07(spark, d):
    out = m.compare(b.scored(spark, d), "score_a", "score_b")
    return _rounded(out, "first", "second", "difference").withColumn("percent", F.round("percent", 4))
