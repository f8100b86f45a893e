"""Histogram boosting (M2, M4, M5, M8): bins, splits, scores, the stop and importances, each against SQL.

The SQL repeats the training step by step: quantile bins, gradients in fixed point, one aggregation per
level, the best split of each node, leaf values, margins, and the average precision of every round.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens.operators.boosting import BoostParams, FeatureBins, best_splits, gradients, histograms, train_boosting
from fraudlens.operators.encode import LabelEncoder
from fraudlens.operators.ordering import stratified_split
from fraudlens.queries.base import VIEWS, clean_txn, query
from fraudlens.queries import model_q  # noqa: F401  (the stratified split as SQL)
from fraudlens.session import settle

COLS = ["priority", "TransactionAmt", "C1", "D1"]
PARAMS = BoostParams(rounds=6, learning_rate=0.3, max_depth=2, subsample=1.0, colsample=1.0, gamma=0.0, patience=2, max_bins=16)
ROUNDS = 2  # of the queries that score
ACCURACY = 1_000_000  # ranks are exact up to so many rows, as they are in SQL
SCALE = 1 << 40

VIEWS["priorities"] = "SELECT ProductCD, row_number() OVER (ORDER BY ProductCD) - 1 AS code FROM (SELECT DISTINCT ProductCD FROM txn)"
VIEWS["boost_in"] = """
    SELECT TransactionID AS id, txn.isFraud AS y, split, CASE WHEN TransactionAmt IS NOT NULL THEN CAST(code AS DOUBLE) END AS priority,
           CAST(TransactionAmt AS DOUBLE) AS amt, CAST(C1 AS DOUBLE) AS c1, CAST(D1 AS DOUBLE) AS d1
    FROM txn JOIN priorities USING (ProductCD) JOIN strata USING (TransactionID)"""
VIEWS["boost_long"] = """
    SELECT id, unnest([0, 1, 2, 3]) AS feature, unnest([priority, amt, c1, d1]) AS v FROM boost_in"""
VIEWS["boost_cuts"] = """
    SELECT DISTINCT feature, c FROM (
      SELECT feature, unnest(quantile_disc(v, [CAST(i AS DOUBLE) / 16 FOR i IN range(1, 16)])) AS c
      FROM boost_long JOIN boost_in USING (id) WHERE split = 'train' GROUP BY feature)"""
VIEWS["boost_bins"] = """
    SELECT id, boost_long.feature AS feature, CASE WHEN any_value(v) IS NULL THEN -1 ELSE count(c) END AS bin
    FROM boost_long LEFT JOIN boost_cuts ON boost_long.feature = boost_cuts.feature AND c <= v GROUP BY id, boost_long.feature"""
VIEWS["margin_0"] = "SELECT id, CAST(0 AS DOUBLE) AS margin FROM boost_in"


def _splits(nodes: str, grads: str, level: int) -> str:
    """Best split of every node of a level."""
    first, last = 2**level - 1, 2**(level + 1) - 2
    return f"""
    SELECT node, feature, bin, default_left, gain, g, h, gl, hl FROM (
      SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, default_left DESC) AS rn FROM (
        SELECT *, gl * gl / (hl + 1.0::DOUBLE) + (g - gl) * (g - gl) / ((h - hl) + 1.0::DOUBLE) - g * g / (h + 1.0::DOUBLE) AS gain FROM (
          SELECT node, feature, bin, g, h, default_left, kg + CASE WHEN default_left THEN mg ELSE 0 END AS gl, kh + CASE WHEN default_left THEN mh ELSE 0 END AS hl
          FROM (
            SELECT node, feature, bin, sum(g) OVER w / {SCALE}.0::DOUBLE AS g, sum(h) OVER w / {SCALE}.0::DOUBLE AS h,
                   sum(CASE WHEN bin >= 0 THEN g ELSE 0 END) OVER u / {SCALE}.0::DOUBLE AS kg, sum(CASE WHEN bin >= 0 THEN h ELSE 0 END) OVER u / {SCALE}.0::DOUBLE AS kh,
                   sum(CASE WHEN bin < 0 THEN g ELSE 0 END) OVER w / {SCALE}.0::DOUBLE AS mg, sum(CASE WHEN bin < 0 THEN h ELSE 0 END) OVER w / {SCALE}.0::DOUBLE AS mh
            FROM (
              SELECT node, feature, bin, sum(g) AS g, sum(h) AS h
              FROM {nodes} JOIN {grads} USING (id) JOIN boost_bins USING (id)
              WHERE node BETWEEN {first} AND {last} GROUP BY node, feature, bin)
            WINDOW w AS (PARTITION BY node, feature), u AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)),
          (SELECT unnest([true, false]) AS default_left) WHERE bin >= 0))
      WHERE gain > 0 AND hl >= 1 AND h - hl >= 1)
    WHERE rn = 1"""


def _round(r: int) -> None:
    """Views of round ``r``: gradients of the training rows, nodes and splits by level, margins behind it."""
    VIEWS[f"grads_{r}"] = f"""
    SELECT id, CAST(floor((p - y) * {SCALE}.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS g, CAST(floor(p * (1 - p) * {SCALE}.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS h
    FROM (SELECT id, CAST(y AS DOUBLE) AS y, 1 / (1 + exp(-margin)) AS p FROM boost_in JOIN margin_{r - 1} USING (id) WHERE split = 'train')"""
    VIEWS[f"nodes_{r}_0"] = "SELECT id, 0 AS node FROM boost_in"
    for level in range(PARAMS.max_depth):
        VIEWS[f"splits_{r}_{level}"] = _splits(f"nodes_{r}_{level}", f"grads_{r}", level)
        VIEWS[f"nodes_{r}_{level + 1}"] = f"""
    SELECT n.id, CASE WHEN s.node IS NULL THEN n.node WHEN CASE WHEN b.bin < 0 THEN default_left ELSE b.bin <= s.bin END THEN 2 * n.node + 1
                      ELSE 2 * n.node + 2 END AS node
    FROM nodes_{r}_{level} n LEFT JOIN splits_{r}_{level} s ON n.node = s.node LEFT JOIN boost_bins b ON b.id = n.id AND b.feature = s.feature"""
    end = f"nodes_{r}_{PARAMS.max_depth}"
    VIEWS[f"leaves_{r}"] = f"""
    SELECT node, -{PARAMS.learning_rate}::DOUBLE * (sum(g) / {SCALE}.0::DOUBLE) / (sum(h) / {SCALE}.0::DOUBLE + 1.0::DOUBLE) AS leaf
    FROM {end} JOIN grads_{r} USING (id) GROUP BY node"""
    VIEWS[f"margin_{r}"] = f"""
    SELECT id, margin + leaf AS margin FROM margin_{r - 1} JOIN {end} USING (id) JOIN leaves_{r} USING (node)"""
    VIEWS[f"ap_{r}"] = f"""
    SELECT {r} AS round, sum(pos / total * tp / (tp + fp)) AS ap FROM (
      SELECT pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS total FROM (
        SELECT margin, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg
        FROM boost_in JOIN margin_{r} USING (id) WHERE split = 'test' GROUP BY margin)
      WINDOW w AS (ORDER BY margin DESC ROWS UNBOUNDED PRECEDING))"""


for _r in range(1, PARAMS.rounds + 1):
    _round(_r)


def boost_rows(spark, d):
    """Transactions with the stratified split and the numbers the trees look at; a missing amount hides the priority."""
    rows = settle(stratified_split(settle(clean_txn(spark, d), "rows"), "isFraud", "TransactionID", 0.2), "split")
    coded = LabelEncoder(("ProductCD",)).fit(rows).transform(rows, suffix="_code")
    return coded.select(
        "TransactionID", "isFraud", "split", F.when(F.col("TransactionAmt").isNotNull(), F.col("ProductCD_code")).cast("double").alias("priority"), *COLS[1:]
    )


def boosted(spark, d, rounds, stop=False):
    rows = settle(boost_rows(spark, d), "boost")
    params = BoostParams(**{**PARAMS.__dict__, "rounds": rounds})
    train, valid = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    return train_boosting(train, COLS, params, "isFraud", valid=valid if stop else None, accuracy=ACCURACY), rows


@query("m02_feature_bins", "SELECT feature, CAST(count(*) AS BIGINT) AS n_cuts, round(min(c), 6) AS least, round(max(c), 6) AS largest FROM boost_cuts GROUP BY feature")
def m02_bins(spark, d):
    rows = boost_rows(spark, d).filter("split = 'train'")
    cuts = FeatureBins.fit(rows, COLS, PARAMS.max_bins, ACCURACY).cuts
    found = [(i, len(c), min(c), max(c)) for i, c in enumerate(cuts.values())]  # one row a column
    return spark.createDataFrame(found, "feature int, n_cuts long, least double, largest double").select(
        "feature", "n_cuts", F.round("least", 6).alias("least"), F.round("largest", 6).alias("largest")
    )


@query("m02_first_split", """
    SELECT feature, CAST(bin AS INTEGER) AS bin, default_left, round(gain, 6) AS gain, round(gl, 6) AS gl, round(hl, 6) AS hl FROM splits_1_0""")
def m02_first(spark, d):
    """The first split, its gain, and where it sends missing values."""
    rows = settle(boost_rows(spark, d).filter("split = 'train'"), "boost")
    binned = FeatureBins.fit(rows, COLS, PARAMS.max_bins, ACCURACY).transform(rows)
    binned = binned.select("bins", F.col("isFraud").alias("label"), F.lit(1.0).alias("weight"), F.lit(0.0).alias("margin"))
    g, h = gradients()
    found = best_splits(histograms(binned, F.lit(0), g, h, range(len(COLS))), PARAMS, SCALE)
    return found.select("feature", "bin", "default_left", *[F.round(c, 6).alias(c) for c in ("gain", "gl", "hl")])


@query("m05_boosted_scores", f"SELECT id AS TransactionID, split, round(1 / (1 + exp(-margin)), 6) AS score FROM boost_in JOIN margin_{ROUNDS} USING (id)")
def m05_boosted(spark, d):
    """Probabilities after two trees with a branch for missing values."""
    model, rows = boosted(spark, d, ROUNDS)
    return model.score(rows).select("TransactionID", "split", F.round("score", 6).alias("score"))


_HISTORY = " UNION ALL ".join(f"SELECT round, ap FROM ap_{r}" for r in range(1, PARAMS.rounds + 1))


@query("m04_stop_training", f"""
    WITH h AS ({_HISTORY}),
    b AS (SELECT round, ap, max(ap) OVER (ORDER BY round ROWS UNBOUNDED PRECEDING) AS best FROM h),
    w AS (SELECT a.round, a.ap, (SELECT min(c.round) FROM h c WHERE c.ap = a.best) AS best_round FROM b a),
    e AS (SELECT coalesce(min(round), {PARAMS.rounds}) AS last FROM w WHERE round - best_round >= {PARAMS.patience})
    SELECT round, round(ap, 6) AS average_precision, best_round FROM w, e WHERE round <= last""")
def m04_stop(spark, d):
    """Average precision of every tree that was grown: training ends ``patience`` rounds after the best one."""
    model, _ = boosted(spark, d, PARAMS.rounds, stop=True)
    best, rows = (-1.0, 0), []
    for round_, ap in model.history:  # one row a round
        best = (ap, round_) if ap > best[0] else best
        rows.append((round_, ap, best[1]))
    found = spark.createDataFrame(rows, "round int, average_precision double, best_round int")
    return found.select("round", F.round("average_precision", 6).alias("average_precision"), "best_round")


_GAINS = " UNION ALL ".join(f"SELECT feature, gain FROM splits_{r}_{level}" for r in range(1, ROUNDS + 1) for level in range(PARAMS.max_depth))


@query("m08_gain_importances", f"""
    WITH s AS ({_GAINS}), f AS (SELECT unnest([0, 1, 2, 3]) AS feature, unnest({COLS!r}) AS name)
    SELECT name AS feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM s), 6) AS importance FROM f LEFT JOIN s USING (feature) GROUP BY name""")
def m08_gains(spark, d):
    model, _ = boosted(spark, d, ROUNDS)
    return model.importances(spark).select("feature", F.round("importance", 6).alias("importance"))
