"""Exact ranking metrics over a scored table.

Rows first collapse to one row per distinct score (a hub score is combined map-side). Running counts
over the descending scores then give every curve and metric; they are formed block by block, never in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.functions.scalars import percent_change, ratio
from fraudlens.operators.joins import lookup
from fraudlens.operators.ordering import running
from fraudlens.session import settle

# Fixed values of the best-F1 rule: smoothing of the denominator, threshold of the closing point.
F1_EPSILON = 1e-8
CLOSING_THRESHOLD = 0.5


def score_groups(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, n_pos, n_neg), one row per distinct score."""
    return (
        scored.groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"))
    )


@dataclass
class Curve:
    """Cumulative true and false positives at each distinct threshold, highest first."""

    points: DataFrame  # score, n_pos, n_neg, tp, fp
    positives: int
    negatives: int


def curve(scored: DataFrame, label: str = "label", score: str = "score") -> Curve:
    groups = score_groups(scored, label, score)
    points, totals = running(groups, [F.desc("score")], {"tp": ("sum", "n_pos"), "fp": ("sum", "n_neg")})
    return Curve(points, totals["tp"], totals["fp"])


def _share(part: Column, whole: int) -> Column:
    return part / F.lit(float(whole)) if whole else F.lit(0.0)


def _auc_term(neg: Column | int, fp="fp", n_pos="n_pos", n_neg="n_neg") -> Column:
    """Pairs ordered rightly by one score group, ties counting half."""
    below = neg - F.col(fp)
    return F.col(n_pos).cast("double") * (below + F.col(n_neg) / 2)


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by rank sums; null when a class is absent."""
    c = curve(scored, label, score)
    pairs = F.lit(float(c.positives) * float(c.negatives))
    return c.points.agg(F.try_divide(F.sum(_auc_term(F.lit(c.negatives))), pairs).alias("auc"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Sum of recall steps times precision, ties in one step."""
    c = curve(scored, label, score)
    step = _share(F.col("n_pos"), c.positives)
    return c.points.agg(F.coalesce(F.sum(step * _precision()), F.lit(0.0)).alias("average_precision"))


def _positive_steps(points: DataFrame) -> DataFrame:
    return points.filter("n_pos + n_neg > 0")


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the closing point (null, 1, 0)."""
    c = curve(scored, label, score)
    body = _positive_steps(c.points).select(
        F.col("score").alias("threshold"), _precision().alias("precision"), _share(F.col("tp"), c.positives).alias("recall")
    )
    closing = [(None, 1.0, 0.0)]
    return body.unionByName(
        scored.sparkSession.createDataFrame(closing, "threshold double, precision double, recall double")
    )


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the starting point (infinity, 0, 0)."""
    c = curve(scored, label, score)
    body = _positive_steps(c.points).select(
        F.col("score").alias("threshold"),
        _share(F.col("fp"), c.negatives).alias("fpr"),
        _share(F.col("tp"), c.positives).alias("tpr"),
    )
    start = [(float("inf"), 0.0, 0.0)]
    return body.unionByName(scored.sparkSession.createDataFrame(start, "threshold double, fpr double, tpr double"))


def _f1(positives: int) -> Column:
    recall = _share(F.col("tp"), positives)
    return 2 * _precision() * recall / (_precision() + recall + F.lit(F1_EPSILON))


def _best(positives: int) -> Column:
    """Largest F1, lowest threshold among equals, with its counts; an aggregate, so no sort is needed."""
    return F.max(F.struct(_f1(positives).alias("f1"), (-F.col("score")).alias("neg"), "tp", "fp"))


def best_f1(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c = curve(scored, label, score)
    best = c.points.agg(_best(c.positives).alias("b"))
    return best.select(
        F.coalesce("b.f1", F.lit(0.0)).alias("best_f1_score"),
        F.coalesce(-F.col("b.neg"), F.lit(CLOSING_THRESHOLD)).alias("best_threshold"),
    )


def confusion(scored: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """tn, fp, fn, tp when scores from ``threshold`` upwards count as positive."""
    hit, pos = F.col(score) >= F.lit(threshold), F.col(label) == 1
    return scored.agg(
        F.count_if(~hit & ~pos).alias("tn"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(hit & pos).alias("tp"),
    )


def point_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, specificity, accuracy and F1 from tn, fp, fn, tp; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "specificity": ratio(tn, tn + fp),
            "accuracy": ratio(tp + tn, tn + fp + fn + tp),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def evaluate(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: AUC, average precision, best F1 and threshold, and the confusion counts there.

    All of it comes from a single aggregation over the curve points.
    """
    c = curve(scored, label, score)
    step = _share(F.col("n_pos"), c.positives)
    one = c.points.agg(
        F.try_divide(
            F.sum(_auc_term(F.lit(c.negatives))), F.lit(float(c.positives) * float(c.negatives))
        ).alias("auc"),
        F.coalesce(F.sum(step * _precision()), F.lit(0.0)).alias("average_precision"),
        _best(c.positives).alias("b"),
    )
    tp, fp = F.col("b.tp"), F.col("b.fp")
    fn, tn = F.lit(c.positives) - tp, F.lit(c.negatives) - fp
    return one.select(
        "auc",
        "average_precision",
        F.col("b.f1").alias("best_f1_score"),
        (-F.col("b.neg")).alias("best_threshold"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tn, tn + fp).alias("specificity"),
        tn.alias("true_negatives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        tp.alias("true_positives"),
    )


def average_precision_by(scored: DataFrame, by: str, label: str = "label", score: str = "score") -> DataFrame:
    """Average precision of every group in one job, e.g. of each boosting round.

    Groups are few (rounds, models); the running counts go over all groups and each group's start is
    taken off.
    """
    groups = scored.groupBy(by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg")
    )
    points, _ = running(groups, [by, F.desc("score")], {"tp": ("sum", "n_pos"), "fp": ("sum", "n_neg")})
    starts = points.groupBy(by).agg(
        F.min(F.col("tp") - F.col("n_pos")).alias("_tp0"),
        F.min(F.col("fp") - F.col("n_neg")).alias("_fp0"),
        F.sum("n_pos").alias("_pos"),
    )
    rel = lookup(points, starts, by, "inner").withColumns(
        {"tp": F.col("tp") - F.col("_tp0"), "fp": F.col("fp") - F.col("_fp0")}
    )
    step = ratio(F.col("n_pos"), F.col("_pos"))
    return rel.groupBy(by).agg(F.sum(step * _precision()).alias("average_precision"))


def _rank_table(df: DataFrame, col: str, rank: str, weight: str) -> tuple[DataFrame, int]:
    """(value, average rank) of each distinct value, and the number of rows."""
    groups = df.groupBy(col).agg(F.sum(weight).alias("_n"))
    cum, totals = running(groups, [col], {"_upto": ("sum", "_n")})
    return cum.select(col, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(rank)), totals["_upto"]


def avg_rank(df: DataFrame, col: str, rank: str = "rank", **tuning) -> DataFrame:
    """Rank of each row from 1; equal values share the mean of their ranks. Missing values get no rank."""
    ranks, _ = _rank_table(df.filter(F.col(col).isNotNull()).withColumn("_w", F.lit(1)), col, rank, "_w")
    return lookup(df, ranks, col, "left", **tuning)


def spearman(df: DataFrame, a: str, b: str, **tuning) -> DataFrame:
    """Rank correlation of two columns, ties averaged, from one row per distinct pair of values."""
    pairs = settle(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("_w")))
    rank_a, n = _rank_table(pairs, a, "_ra", "_w")
    rank_b, _ = _rank_table(pairs, b, "_rb", "_w")
    ranked = lookup(lookup(pairs, rank_a, a, "inner", **tuning), rank_b, b, "inner", **tuning)
    mid = F.lit((n + 1) / 2)  # mean rank, exact: deviations stay small
    da, db, w = F.col("_ra") - mid, F.col("_rb") - mid, F.col("_w")
    return ranked.agg(
        F.try_divide(F.sum(w * da * db), F.sqrt(F.sum(w * da * da)) * F.sqrt(F.sum(w * db * db))).alias("spearman")
    )


def bce(
    scored: DataFrame, label: str = "label", prob: str = "score", pos_weight: float = 1.0, clip: float = 1e-7
) -> DataFrame:
    """Mean log loss of probabilities, positives weighted by ``pos_weight``."""
    p = F.least(F.greatest(F.col(prob), F.lit(clip)), F.lit(1 - clip))
    y = F.col(label)
    loss = -(F.lit(float(pos_weight)) * y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return scored.agg(F.avg(loss).alias("log_loss"))


def prevalence(scored: DataFrame, label: str = "label") -> DataFrame:
    """Share of positives: the average precision of a random ranking."""
    return scored.agg(F.avg(F.col(label).cast("double")).alias("prevalence"))


COMPARED = ("auc", "average_precision", "best_f1_score")


def compare(
    df: DataFrame, first: str, second: str, label: str = "label", metrics: Sequence[str] = COMPARED
) -> DataFrame:
    """(metric, first, second, difference, percent) for two score columns of the same rows,
    with their rank correlation and the label's prevalence as further rows."""
    a, b = evaluate(df, label, first), evaluate(df, label, second)
    other = b.select(F.struct(*metrics)).scalar()
    both = a.select(*[F.col(m).alias(f"a_{m}") for m in metrics], other.alias("_b"))
    lines = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(f"a_{m}").alias("first"), F.col(f"_b.{m}").alias("second")) for m in metrics]
    )
    table = (
        both.select(F.explode(lines).alias("_l"))
        .select("_l.*")
        .withColumns(
            {
                "difference": F.col("second") - F.col("first"),
                "percent": percent_change(F.col("second"), F.col("first")),
            }
        )
    )
    none = F.lit(None).cast("double")
    single = lambda name, one, col: one.select(
        F.lit(name).alias("metric"), F.col(col).alias("first"), F.col(col).alias("second"),
        none.alias("difference"), none.alias("percent"),
    )
    return (
        table.unionByName(single("spearman", spearman(df, first, second), "spearman"))
        .unionByName(single("prevalence", prevalence(df, label), "prevalence"))
    )
