"""Model-quality and business metrics (K1-K17), each one Spark aggregate
over (label, score / prediction).

Ranking metrics (ROC-AUC, average precision, PR curve) group rows by
distinct score first and then run the skew-safe ordered scan over the
distinct scores - exact, with sklearn's tie handling, and never a
single-partition window over all rows. Threshold sweeps histogram the
scores into the 1001 threshold buckets in one pass and accumulate over
the 1001-row grid (not 1001 scans, not a range join).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import ratio
from tessera.operators.ordered import with_rank

__all__ = ["regression_metrics", "mape", "pricing_risk", "confusion", "classification_report",
           "binary_scores", "roc_auc", "average_precision", "pr_curve", "log_loss_brier", "calibration_curve",
           "ece_mce", "approval_sweep", "choose_approval_threshold", "revenue_sweep", "best_revenue_threshold",
           "approval_at", "business_effect", "cv_summary", "incremental_revenue", "Economics"]


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """K1 RMSE, MAE, MSE and R^2 (1 - SS_res / SS_tot) in one pass."""
    e = F.col(pred).cast("double") - F.col(y).cast("double")
    yy = F.col(y).cast("double")
    out = df.groupBy(*by).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("_ssr"),
                              (F.var_pop(yy) * F.count(yy)).alias("_sst"))
    return (out.withColumn("rmse", F.sqrt("mse")).withColumn("r2", F.lit(1.0) - ratio("_ssr", "_sst"))
            .drop("_ssr", "_sst"))


def mape(df: DataFrame, y: str, pred: str) -> DataFrame:
    """K2 mean absolute percentage error over non-zero actuals (percent)."""
    yy = F.col(y).cast("double")
    return df.agg((F.avg(F.when(yy != 0, F.abs((yy - F.col(pred).cast("double")) / yy))) * 100).alias("mape"))


def pricing_risk(df: DataFrame, y: str, pred: str, band: float = 0.2) -> DataFrame:
    """K3 over-pricing rate (pred > y(1+band)), under-pricing rate
    (pred < y(1-band)) and the loss on under-priced rows (sum y - pred)."""
    yy, pp = F.col(y).cast("double"), F.col(pred).cast("double")
    under = pp < yy * (1 - band)
    return df.agg(F.avg((pp > yy * (1 + band)).cast("double")).alias("overpricing_rate"),
                  F.avg(under.cast("double")).alias("underpricing_rate"),
                  F.coalesce(F.sum(F.when(under, yy - pp)), F.lit(0.0)).alias("underpricing_loss"))


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """K4 tn, fp, fn, tp in one pass (labels 0/1)."""
    yy, pp = F.col(y), F.col(pred)
    return df.agg(F.count_if((yy == 0) & (pp == 0)).alias("tn"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
                  F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 1) & (pp == 1)).alias("tp"))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """K5 per-class precision, recall, F1 and support from one (label, pred)
    count table; macro averages are the mean of the class rows."""
    cells = df.groupBy(F.col(y).alias("_y"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    classes = cells.select(F.col("_y").alias("cls")).union(cells.select(F.col("_p").alias("cls"))).distinct()
    tp = cells.where(F.col("_y") == F.col("_p")).select(F.col("_y").alias("cls"), F.col("n").alias("tp"))
    sup = cells.groupBy(F.col("_y").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = cells.groupBy(F.col("_p").alias("cls")).agg(F.sum("n").alias("predicted"))
    out = (classes.join(tp, "cls", "left").join(sup, "cls", "left").join(predicted, "cls", "left")
           .fillna(0, subset=["tp", "support", "predicted"]))
    prec = F.coalesce(ratio("tp", "predicted"), F.lit(0.0))
    rec = F.coalesce(ratio("tp", "support"), F.lit(0.0))
    return (out.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", F.coalesce(ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
            .select("cls", "precision", "recall", "f1", "support"))


def binary_scores(df: DataFrame, y: str, pred: str) -> DataFrame:
    """K5 accuracy, precision, recall, F1 (positive class 1) and macro F1."""
    c = confusion(df, y, pred)
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))
    p1, r1 = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)), F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    p0, r0 = F.coalesce(F.try_divide(tn, tn + fn), F.lit(0.0)), F.coalesce(F.try_divide(tn, tn + fp), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p1 * r1, p1 + r1), F.lit(0.0))
    f0 = F.coalesce(F.try_divide(2 * p0 * r0, p0 + r0), F.lit(0.0))
    return c.select((F.try_divide(tp + tn, tp + tn + fp + fn)).alias("accuracy"), p1.alias("precision"),
                    r1.alias("recall"), f1.alias("f1"), ((f1 + f0) / 2).alias("macro_f1"))


def _score_table(df: DataFrame, y: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """K6 exact ROC-AUC = P(score_pos > score_neg) + 0.5 P(tie): per distinct
    score, positives x (negatives with lower score + half the tied ones)."""
    t = with_rank(_score_table(df, y, score), [], [F.col("s")], sums=["neg"])
    below = F.col("_cum_neg") - F.col("neg")
    return t.agg((F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))) /
                  (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("roc_auc"))


def _pr_table(df: DataFrame, y: str, score: str) -> DataFrame:
    """Distinct scores descending with cumulative tp/fp (sklearn thresholds)."""
    t = with_rank(_score_table(df, y, score), [], [F.col("s").desc()], sums=["pos", "neg"])
    return t.select("s", "pos", F.col("_cum_pos").alias("tp"), F.col("_cum_neg").alias("fp")).withColumn(
        "total_pos", df.agg(F.count_if(F.col(y) == 1)).scalar())


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """K7 step-wise average precision: sum over thresholds of
    (R_n - R_{n-1}) * P_n (sklearn's definition, no interpolation)."""
    t = _pr_table(df, y, score)
    return t.agg(F.sum(F.col("pos") / F.col("total_pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("average_precision"))


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """K8 precision and recall at every distinct score threshold."""
    t = _pr_table(df, y, score)
    return t.select(F.col("s").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    (F.col("tp") / F.col("total_pos")).alias("recall"))


def log_loss_brier(df: DataFrame, y: str, p: str, eps: float = 1e-15) -> DataFrame:
    """K9 log loss (probabilities clipped to [eps, 1-eps]) and Brier score."""
    pp = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return df.agg(F.avg(-(yy * F.log(pp) + (1 - yy) * F.log(1 - pp))).alias("log_loss"),
                  F.avg(F.pow(F.col(p).cast("double") - yy, 2)).alias("brier"))


def calibration_curve(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """K10 uniform-bin reliability curve (bins (lo, hi], first bin closed):
    mean predicted probability and observed positive rate per bin."""
    b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.ceil(F.col(p) * bins) - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.avg(F.col(p).cast("double")).alias("prob_pred"),
                                          F.avg(F.col(y).cast("double")).alias("prob_true"),
                                          F.count(F.lit(1)).alias("n"))


def ece_mce(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """K11 expected / maximum calibration error over bins [lo, hi), last bin
    closed: ECE = sum n_b/N |conf_b - acc_b|, MCE = max |conf_b - acc_b|."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    per = df.groupBy(b.alias("bin")).agg(F.avg(F.col(p).cast("double")).alias("conf"),
                                         F.avg(F.col(y).cast("double")).alias("acc"), F.count(F.lit(1)).alias("n"))
    gap = F.abs(F.col("conf") - F.col("acc"))
    return per.agg((F.sum(F.col("n") * gap) / F.sum("n")).alias("ece"), F.max(gap).alias("mce"))


def _grid(spark, steps: int) -> DataFrame:
    return spark.range(steps + 1).select(F.col("id").alias("k"), (F.col("id") / F.lit(float(steps))).alias("threshold"))


def _first_k_at_or_above(p: Column, steps: int) -> Column:
    """Smallest k with p <= k/steps (exact double comparisons)."""
    k0 = F.ceil(p * steps)
    k1 = F.when((k0 - 1) / F.lit(float(steps)) >= p, k0 - 1).otherwise(k0)
    return F.when(k1 / F.lit(float(steps)) < p, k1 + 1).otherwise(k1)


def _last_k_at_or_below(p: Column, steps: int) -> Column:
    """Largest k with k/steps <= p (exact double comparisons)."""
    k0 = F.floor(p * steps)
    k1 = F.when((k0 + 1) / F.lit(float(steps)) <= p, k0 + 1).otherwise(k0)
    return F.when(k1 / F.lit(float(steps)) > p, k1 - 1).otherwise(k1)


def approval_sweep(df: DataFrame, y: str, p: str, steps: int = 1000) -> DataFrame:
    """K12 for thresholds t = k/steps: approved = p <= t; approval rate,
    default rate among approved (0 when none), missed-default rate =
    approved defaulters / all defaulters. One histogram pass + cumulative
    sums over the (steps+1)-row grid."""
    pp = F.col(p).cast("double")
    b = F.greatest(F.lit(0), F.least(_first_k_at_or_above(pp, steps), F.lit(steps + 1))).cast("bigint")
    hist = df.groupBy(b.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(y) == 1).alias("d"))
    totals = df.agg(F.count(F.lit(1)).alias("N"), F.count_if(F.col(y) == 1).alias("D"))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)   # over steps+1 grid rows only
    g = (_grid(df.sparkSession, steps).join(hist, "k", "left").fillna(0, subset=["n", "d"])
         .withColumn("approved", F.sum("n").over(w)).withColumn("approved_defaults", F.sum("d").over(w)))
    N, D = totals.select("N").scalar(), totals.select("D").scalar()
    return g.select("threshold", (F.col("approved") / N).alias("approval_rate"),
                    F.coalesce(ratio("approved_defaults", "approved"), F.lit(0.0)).alias("default_rate"),
                    F.coalesce(ratio(F.col("approved_defaults"), D), F.lit(0.0)).alias("missed_default_rate"))


def choose_approval_threshold(sweep: DataFrame, min_approval: float = 0.65, max_default: float = 0.02,
                              max_missed: float = 0.04) -> DataFrame:
    """K12 the threshold with the highest approval rate meeting the limits
    (smallest threshold on ties); empty when none qualifies."""
    ok = sweep.where((F.col("approval_rate") >= min_approval) & (F.col("default_rate") <= max_default)
                     & (F.col("missed_default_rate") <= max_missed))
    return ok.orderBy(F.col("approval_rate").desc(), F.col("threshold").asc()).limit(1)


@dataclass(frozen=True)
class Economics:
    """Worth of each outcome. Fixed values as defaults: the booking-cancellation case
    (revenue per room, compensation for a false alarm, revenue lost to a cancellation, value of a rebooking)."""

    avg_rev: float = 64_500
    cost_fp: float = 7_000
    lost_rev: float = 64_500
    per_rebooking: float = 45_000


def incremental_revenue(tn: Column, fp: Column, fn: Column, tp: Column, worth: Economics = Economics()) -> tuple[Column, Column, Column]:
    """K13 (ir, relative ir %, ir_before) from confusion counts."""
    ir0 = (tn + fp) * worth.avg_rev - (tp + fn) * worth.lost_rev
    ir1 = tp * worth.per_rebooking + tn * worth.avg_rev - fp * worth.cost_fp - fn * worth.lost_rev
    return ir1 - ir0, F.try_divide((ir1 - ir0).cast("double"), ir0.cast("double")) * 100, ir0


def revenue_sweep(df: DataFrame, y: str, p: str, steps: int = 1000, worth: Economics = Economics()) -> DataFrame:
    """K13/K14 confusion counts and incremental revenue for every threshold
    t = k/steps with positive = p >= t (one histogram pass)."""
    pp = F.col(p).cast("double")
    b = F.greatest(F.lit(-1), F.least(_last_k_at_or_below(pp, steps), F.lit(steps))).cast("bigint")
    hist = df.groupBy(b.alias("k")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    P = df.agg(F.count_if(F.col(y) == 1)).scalar()
    Nn = df.agg(F.count_if(F.col(y) == 0)).scalar()
    w = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    g = (_grid(df.sparkSession, steps).join(hist, "k", "left").fillna(0, subset=["pos", "neg"])
         .withColumn("tp", F.sum("pos").over(w)).withColumn("fp", F.sum("neg").over(w)))
    g = g.withColumn("fn", P - F.col("tp")).withColumn("tn", Nn - F.col("fp"))
    ir, rel, _ = incremental_revenue(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"), worth)
    return g.select("threshold", "tn", "fp", "fn", "tp", ir.alias("incremental_revenue"), rel.alias("relative_ir"))


def best_revenue_threshold(sweep: DataFrame) -> DataFrame:
    """K14 threshold with the highest incremental revenue (first on ties)."""
    return sweep.orderBy(F.col("incremental_revenue").desc(), F.col("threshold").asc()).limit(1)


def approval_at(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """K15 approval, default and missed-default rates at one threshold."""
    appr = F.col(p) <= threshold
    out = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(appr).alias("a"), F.count_if(appr & (F.col(y) == 1)).alias("ad"),
                 F.count_if(F.col(y) == 1).alias("d"))
    return out.select(ratio("a", "n").alias("approval_rate"), F.coalesce(ratio("ad", "a"), F.lit(0.0)).alias("default_rate"),
                      F.coalesce(ratio("ad", "d"), F.lit(0.0)).alias("missed_default_rate"))


def business_effect(df: DataFrame, y: str, p: str, threshold: float, worth: Economics = Economics()) -> DataFrame:
    """K16 cancel rate before/after, occupancy change % and relative IR of acting on scores above a threshold."""
    pred = (F.col(p) > threshold).cast("int")
    c = df.withColumn("_pred", pred)
    conf = confusion(c, y, "_pred")
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    _, rel, _ = incremental_revenue(tn, fp, fn, tp, worth)
    return conf.select(((fn + tp) / n).alias("cancel_rate_before"), (fn / n).alias("cancel_rate_after"),
                       (((tn) - (tn + fp)) / (tn + fp) * 100).alias("occupancy_change_pct"), rel.alias("relative_ir"))


def cv_summary(per_fold: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """K17 mean and population std of each metric across folds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.agg(*aggs)
