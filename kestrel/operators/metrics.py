"""Metrics and evaluation.

Confusion counts, errors and losses are single aggregates. ROC AUC is exact with
tied scores given mid-ranks: scores are first aggregated to (score, positives,
negatives) and the running count of negatives below each score comes from a
distributed running sum. The F1-best threshold sweep buckets each score to its
grid index once, so the work is one pass plus a 1000-row cumulative table, not
1000 passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import global_running_sum


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def confusion_counts(df: DataFrame, label, pred) -> DataFrame:
    """tp, fp, fn, tn in one aggregate."""
    y, p = _c(label), _c(pred)
    return df.agg(F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
                  F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
                  F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
                  F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))


def binary_metrics(df: DataFrame, label, score, t: float) -> DataFrame:
    """Precision, recall, accuracy, F1 of ``score >= t``; 0 where undefined (M1, M5)."""
    pred = (_c(score) >= F.lit(t)).cast("int")
    cc = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    safe = lambda num, den: F.when(den > 0, num / den).otherwise(F.lit(0.0))
    return cc.select("tp", "fp", "fn", "tn",
                     safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"),
                     safe(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                     safe(2 * tp, 2 * tp + fp + fn).alias("f1"))


def roc_auc(df: DataFrame, label, score) -> DataFrame:
    """Exact ROC AUC = P(score_pos > score_neg) + 0.5 P(tie) (M2).

    Per distinct score: positives p(s), negatives n(s); negatives strictly below s
    come from a running sum; U = sum_s p(s) * (neg_below(s) + n(s)/2). NULL with one class.
    """
    y = _c(label)
    per = df.groupBy(_c(score).alias("s")).agg(F.sum((y == 1).cast("long")).alias("p"),
                                               F.sum((y == 0).cast("long")).alias("n"))
    cum = global_running_sum(per, ["s"], ["n"])
    u = cum.select((F.col("p") * (F.col("n_cum") - F.col("n") + F.col("n") / 2.0)).alias("u"), "p", "n")
    tot = u.agg(F.sum("u").alias("u"), F.sum("p").alias("np"), F.sum("n").alias("nn"))
    return tot.select((F.col("u") / F.nullif(F.col("np") * F.col("nn"), F.lit(0))).alias("auc"), F.col("np").alias("n_pos"),
                      F.col("nn").alias("n_neg"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Cross-count of label x prediction, zeros filled (M3)."""
    return df.groupBy(label).pivot(pred, [0, 1]).agg(F.count(F.lit(1))).fillna(0, subset=["0", "1"])


def exact_match_accuracy(df: DataFrame, truth, pred) -> DataFrame:
    """Share of rows whose prediction vector equals the truth vector, as a rounded %
    (M4, F33)."""
    return df.agg(F.round(F.avg((_c(truth) == _c(pred)).cast("double")) * 100).cast("long").alias("accuracy_pct"))


def best_f1_threshold(df: DataFrame, label, score, step: float = 0.001, points: int = 1000) -> DataFrame:
    """F1-best threshold over t_k = k * step, k = 0..points-1, predicting score >= t_k;
    the first (smallest) best wins; threshold 0 when F1 is never above 0 (M6).

    Each score maps to K = the largest k with k*step <= score, so the row is predicted
    positive exactly for k <= K. Counting positives and negatives per K (<= points
    rows) and summing from the top gives tp(k), fp(k) for all k at once.
    """
    s = _c(score)
    k0 = F.floor(s / F.lit(step)).cast("long")
    # correct the float floor so that k*step <= score < (k+1)*step in double arithmetic
    k1 = F.when(k0.cast("double") * F.lit(step) > s, k0 - 1).otherwise(k0)
    k2 = F.when((k1 + 1).cast("double") * F.lit(step) <= s, k1 + 1).otherwise(k1)
    # scores below the grid (or NULL) are never predicted positive: bucket -1
    kk = F.coalesce(F.greatest(F.least(k2, F.lit(points - 1)), F.lit(-1)), F.lit(-1))
    y = _c(label)
    per = (df.select(kk.alias("kb"), (y == 1).cast("long").alias("pos"))
           .groupBy("kb").agg(F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg")))
    grid = df.sparkSession.range(-1, points).select(F.col("id").alias("k"))
    joined = grid.join(per, grid.k == per.kb, "left").fillna(0, subset=["pos", "neg"])
    from_top = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)  # <= points+1 rows
    cum = joined.select("k", F.sum("pos").over(from_top).alias("tp"), F.sum("neg").over(from_top).alias("fp"))
    # every row sits in some bucket >= -1, so tp at k = -1 is the number of positives P
    cum = cum.withColumn("P", F.max("tp").over(Window.partitionBy())).filter(F.col("k") >= 0)
    den = 2 * F.col("tp") + F.col("fp") + (F.col("P") - F.col("tp"))
    f1 = F.when(den > 0, 2 * F.col("tp") / den).otherwise(0.0)
    best = cum.select("k", f1.alias("f1")).orderBy(F.col("f1").desc(), F.col("k").asc()).limit(1)
    return best.select(F.when(F.col("f1") > 0, F.col("k").cast("double") * F.lit(step)).otherwise(F.lit(0.0))
                       .alias("threshold"), F.col("f1").alias("f1"))


def mape(df: DataFrame, y, p, by: str | None = None) -> DataFrame:
    """Mean absolute percentage error, %, rounded to int; y = 0 rows skipped (M7). With ``by`` one
    row per value of that column, in one aggregate."""
    err = F.abs((_c(y) - _c(p)) / F.nullif(_c(y), F.lit(0)))
    return (df.groupBy(by) if by else df).agg(F.round(F.avg(err) * 100).cast("long").alias("mape_pct"), F.avg(err).alias("mape"))


def mae_mse(df: DataFrame, y, p) -> DataFrame:
    """Mean absolute and mean squared error (M8)."""
    d = _c(y) - _c(p)
    return df.agg(F.avg(F.abs(d)).alias("mae"), F.avg(d * d).alias("mse"))


def log_loss(df: DataFrame, label, prob, eps: float = 1e-15) -> DataFrame:
    """Binary cross-entropy with probabilities clipped to [eps, 1 - eps] (M9)."""
    pr = F.least(F.greatest(_c(prob), F.lit(eps)), F.lit(1 - eps))
    y = _c(label).cast("double")
    return df.agg(F.avg(-(y * F.ln(pr) + (1 - y) * F.ln(1 - pr))).alias("log_loss"))


def compare_scores(a: DataFrame, b: DataFrame, key: str, col_a: str, col_b: str) -> DataFrame:
    """Identical / different counts of two score lists joined on a key."""
    j = a.select(key, F.col(col_a).alias("_a")).join(b.select(key, F.col(col_b).alias("_b")), key)
    return j.agg(F.count_if(F.col("_a") == F.col("_b")).alias("n_identical"),
                 F.count_if(F.col("_a") != F.col("_b")).alias("n_different"))


def best_trial(trials: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """Best row of a trial table by a metric (M11): ``max_by``/``min_by`` over a struct,
    ties to the smallest trial id."""
    others = [c for c in trials.columns]
    key = F.struct(F.col(metric) if maximize else -F.col(metric), -F.col("trial_id"))
    return trials.agg(F.max_by(F.struct(*others), key).alias("b")).select("b.*")


TRIAL_STRUCT = ("struct<trialId: string, hyperparameters: map<string, string>, "
                "finalMetric: struct<trainingStep: bigint, objectiveValue: double>>")


def trial_table(df: DataFrame, json_col: str, params: list[str], trials_path: str | None = None) -> DataFrame:
    """Trial records (id, hyper-parameter map, final metric) from JSON text to a table
    (M11, S12, F28). With ``trials_path`` (e.g. 'trials') each document holds an array
    of trials, exploded to one row per trial; otherwise one trial per document."""
    if trials_path:
        doc = F.from_json(F.col(json_col), f"struct<{trials_path}: array<{TRIAL_STRUCT}>>")
        parsed = df.select(F.explode(doc[trials_path]).alias("t"))
    else:
        parsed = df.select(F.from_json(F.col(json_col), TRIAL_STRUCT).alias("t"))
    return parsed.select(F.col("t.trialId").cast("bigint").alias("trial_id"),
                         *[F.col("t.hyperparameters")[p].alias(p) for p in params],
                         F.col("t.finalMetric.trainingStep").alias("step"),
                         F.col("t.finalMetric.objectiveValue").alias("objective"))
