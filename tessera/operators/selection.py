"""Model selection by exact scorers.

Validation scores of all candidates and folds are one stacked frame
(candidate, fold, y, score). A scorer is an exact aggregate of it by candidate
and fold, so every candidate is judged in the same pass, by average precision,
ROC-AUC, revenue or the rate of missed defaults alike, with no binned curve in between.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import linear
from tessera.operators.metrics import Economics, incremental_revenue
from tessera.operators.ordered import with_rank
from tessera.operators.windows import dense_rank_values
from tessera.session import checkpoint_dir

__all__ = ["grouped_time_folds", "stack_scores", "ranking_scores", "threshold_scores", "summarise", "search", "backward_select"]


def grouped_time_folds(df: DataFrame, date: str, test_periods: int = 3, n_splits: int = 3) -> DataFrame:
    """M8 expanding folds over dates: in fold f the ``test_periods`` dates before the
    last ``(n_splits - f - 1) * test_periods`` validate, all earlier ones train.
    One row for each row and fold it takes part in, with ``fold`` and ``role``."""
    ranked = dense_rank_values(df, date, "_period")
    ranked = ranked.withColumn("_last", ranked.agg(F.max("_period")).scalar())
    folds = F.array(*[F.lit(f) for f in range(n_splits)])
    end = lambda f: F.col("_last") - (F.lit(n_splits) - f) * test_periods
    mine = F.transform(F.filter(folds, lambda f: F.col("_period") <= end(f) + test_periods), lambda f: F.struct(
        f.alias("fold"), F.when(F.col("_period") <= end(f), "train").otherwise("validation").alias("role")))
    return ranked.withColumn("_f", F.explode(mine)).select(*df.columns, "_f.fold", "_f.role")


def stack_scores(candidates: Mapping[str, object], folds: Sequence[tuple[DataFrame, DataFrame]], label: str) -> DataFrame:
    """Fits each candidate on each fold's training rows -> (candidate, fold, y, score) of the validation rows."""
    out = None
    for i, (train, validation) in enumerate(folds):
        for name, estimator in candidates.items():
            scored = estimator.fit(train).transform(validation)
            score = vector_to_array("probability")[1] if "probability" in scored.columns else \
                vector_to_array("rawPrediction")[1] if "rawPrediction" in scored.columns else F.col("prediction").cast("double")
            one = scored.select(F.lit(name).alias("candidate"), F.lit(i).alias("fold"), F.col(label).cast("int").alias("y"), score.alias("score"))
            out = one if out is None else out.unionByName(one)
    return out


_BY = ["candidate", "fold"]


def ranking_scores(stacked: DataFrame) -> DataFrame:
    """(candidate, fold, average_precision, roc_auc), ties as one threshold. One ordered
    scan over the distinct scores of all candidates."""
    table = stacked.groupBy(*_BY, "score").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    t = with_rank(table, _BY, [F.col("score").desc()], sums=["pos", "neg"], totals=True)
    share = F.try_divide("pos", "_tot_pos") * F.try_divide("_cum_pos", F.col("_cum_pos") + F.col("_cum_neg"))
    above = F.col("_cum_pos") - F.col("pos") + 0.5 * F.col("pos")  # positives ranked before a negative of this score
    return t.groupBy(*_BY).agg(F.sum(share).alias("average_precision"),
                               F.try_divide(F.sum(F.col("neg") * above), F.max(F.col("_tot_pos").cast("double") * F.col("_tot_neg"))).alias("roc_auc"))


def threshold_scores(stacked: DataFrame, threshold: float = 0.5, worth: Economics = Economics()) -> DataFrame:
    """(candidate, fold, missed_rate, revenue, revenue_percent): the share of positives below
    the threshold, and the revenue that acting on the others brings, absolute and relative."""
    hit = F.col("score") > threshold
    c = stacked.groupBy(*_BY).agg(*[F.count_if(cond).alias(n) for n, cond in
                                    (("tn", ~hit & (F.col("y") == 0)), ("fp", hit & (F.col("y") == 0)), ("fn", ~hit & (F.col("y") == 1)), ("tp", hit & (F.col("y") == 1)))])
    gain, percent, _ = incremental_revenue(*[F.col(x) for x in ("tn", "fp", "fn", "tp")], worth)
    return c.select(*_BY, F.try_divide(F.col("fn").cast("double"), F.col("fn") + F.col("tp")).alias("missed_rate"), gain.cast("double").alias("revenue"), percent.alias("revenue_percent"))


def summarise(scores: DataFrame, metric: str, larger_better: bool = True) -> DataFrame:
    """(candidate, mean_score, std_score, place): the candidates by their mean over folds, place 1 the best (ties by name)."""
    mean = scores.groupBy("candidate").agg(F.avg(metric).alias("mean_score"), F.stddev_pop(metric).alias("std_score"))
    best = F.col("mean_score").desc_nulls_last() if larger_better else F.col("mean_score").asc_nulls_last()
    return with_rank(mean, [], [best, F.col("candidate")]).select("candidate", "mean_score", "std_score", (F.col("_rank") + 1).cast("int").alias("place"))


def search(candidates: Mapping[str, object], folds: Sequence[tuple[DataFrame, DataFrame]], label: str, metric: str = "average_precision",
           larger_better: bool = True, threshold: float = 0.5) -> DataFrame:
    """Grid or random search by an exact scorer, over any folds: one fixed validation pair
    (M9), grouped time folds (M8) or k folds."""
    stacked = stack_scores(candidates, folds, label)
    checkpoint_dir(stacked.sparkSession)
    stacked = stacked.checkpoint()
    scores = ranking_scores(stacked) if metric in ("average_precision", "roc_auc") else threshold_scores(stacked, threshold)
    return summarise(scores, metric, larger_better)


def backward_select(df: DataFrame, features: Sequence[str], label: str, fold: str, keep: int = 15, alpha: float = 1.0) -> DataFrame:
    """M16 backward elimination to ``keep`` columns. A round drops the column without
    which the mean cross-validated average precision is highest (of equal ones the
    last named). All candidates of a round are ridge fits from the same moments of
    each fold, and their validation scores are judged in one pass. -> (step,
    dropped, left, score), step 0 with all columns."""
    checkpoint_dir(df.sparkSession)
    data = df.select(*features, label, fold).dropna().checkpoint()
    folds = sorted(r[0] for r in data.select(fold).distinct().collect())
    # Moments of the rows outside a fold, for all folds in one aggregate.
    rest = data.withColumn("_out", F.explode(F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: f != F.col(fold))))
    m = linear.moments(rest, features, label, by="_out")
    left, steps = list(range(len(features))), []

    def judged(sets: Sequence[tuple[str, list[int]]]) -> dict[str, float]:
        score = F.lit(None).cast("array<double>")
        for f in folds:
            fits = [(linear.ridge(m[f].only(s), alpha), s) for _, s in sets]
            score = F.when(F.col(fold) == f, F.array(*[x.prediction([features[i] for i in s]) for x, s in fits])).otherwise(score)
        stacked = data.select(F.col(fold).alias("fold"), F.col(label).cast("int").alias("y"), F.posexplode(score).alias("candidate", "score"))
        return {sets[r.candidate][0]: r.s for r in ranking_scores(stacked).groupBy("candidate").agg(F.avg("average_precision").alias("s")).collect()}

    steps.append((0, None, ",".join(features), judged([("", left)])[""]))
    while len(left) > max(keep, 1):
        scores = judged([(features[i], [j for j in left if j != i]) for i in left])
        worst = max(left, key=lambda i: (scores[features[i]], i))
        left = [i for i in left if i != worst]
        steps.append((len(steps), features[worst], ",".join(features[i] for i in left), scores[features[worst]]))
    return df.sparkSession.createDataFrame(steps, "step int, dropped string, left string, score double")
