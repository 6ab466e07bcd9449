"""Splits, folds and resampling.

Random assignment uses a seeded MD5 of a key, so it is stable across
partitionings, re-runs and engines (unlike ``randomSplit``). Stratified
splits and folds need exact class shares: rows are ranked by hash inside
their class with the skew-safe ordered scan (a class *is* a hot key - a
window partitioned by the label would put half the data in one task).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import join_stats, quantiles, with_rank
from tessera.operators.windows import dense_rank_values

__all__ = ["hash_rank", "hash_unit", "hash_split", "stratified_split", "time_split", "time_fraction_split", "group_split",
           "stratified_kfold_column", "expanding_time_folds",
           "resample_ratio", "balanced_weights"]


def hash_rank(cols: Sequence[str], seed: int = 42) -> Column:
    """Deterministic number below 2^60 from the key columns, the same in every engine: the first
    15 digits of the MD5 of seed and values, joined by ``|`` (nulls are skipped)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c) for c in cols])), 1, 15), 16, 10).cast("bigint")


def hash_unit(cols: Sequence[str], seed: int = 42) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from the key columns."""
    return hash_rank(cols, seed) / F.lit(float(1 << 60))


def hash_split(df: DataFrame, key: Sequence[str], fractions: Sequence[float], names: Sequence[str],
               seed: int = 42, col: str = "split") -> DataFrame:
    """M1/M5 reproducible random split by key (a group key gives a group
    split: no entity lands in two sets)."""
    u = hash_unit(key, seed)
    edges, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        edges.append(acc)
    expr = None
    for e, n in zip(edges, names):
        expr = F.when(u < e, F.lit(n)) if expr is None else expr.when(u < e, F.lit(n))
    return df.withColumn(col, expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1]))


group_split = hash_split


def stratified_split(df: DataFrame, label: str, key: Sequence[str], test_frac: float, seed: int = 42,
                     col: str = "split") -> DataFrame:
    """M2 exact stratified split: within each class, the first
    ceil(test_frac * n_class) rows in hash order are 'test'."""
    r = with_rank(df.withColumn("_h", hash_rank(key, seed)), [label],
                  [F.col("_h"), *[F.col(c) for c in key]])
    return r.withColumn(col, F.when(F.col("_rank") < F.ceil(F.col("_n") * test_frac), F.lit("test"))
                        .otherwise(F.lit("train"))).drop("_rank", "_n", "_h")


def time_split(df: DataFrame, date: str, cuts: Sequence[str], names: Sequence[str], col: str = "split") -> DataFrame:
    """M3 split on date cut points: names[i] for cuts[i-1] <= date < cuts[i]."""
    d = F.col(date)
    expr = None
    for c, n in zip(cuts, names):
        cond = d < F.lit(c).cast(df.schema[date].dataType)
        expr = F.when(cond, F.lit(n)) if expr is None else expr.when(cond, F.lit(n))
    return df.withColumn(col, expr.otherwise(F.lit(names[-1])))


def time_fraction_split(df: DataFrame, ts: str, fractions: Sequence[float], names: Sequence[str],
                        col: str = "split") -> DataFrame:
    """M4 time-ordered split by row fractions (e.g. 60/20/20): cut times are
    exact quantiles of the time column; equal times stay together."""
    probs, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        probs.append(acc)
    e = F.unix_micros(F.col(ts).cast("timestamp")).cast("double")
    q = quantiles(df.withColumn("_e", e), "_e", probs, names=[f"c{i}" for i in range(len(probs))])
    expr = None
    for i, n in enumerate(names[:-1]):
        cond = e < q.select(f"c{i}").scalar()
        expr = F.when(cond, F.lit(n)) if expr is None else expr.when(cond, F.lit(n))
    return df.withColumn(col, expr.otherwise(F.lit(names[-1])))


def stratified_kfold_column(df: DataFrame, label: str, key: Sequence[str], k: int, seed: int = 42,
                            col: str = "fold") -> DataFrame:
    """M6 stratified folds: rank in hash order within the class, fold = rank mod k."""
    r = with_rank(df.withColumn("_h", hash_rank(key, seed)), [label],
                  [F.col("_h"), *[F.col(c) for c in key]])
    return r.withColumn(col, (F.col("_rank") % k).cast("int")).drop("_rank", "_n", "_h")


def expanding_time_folds(df: DataFrame, date: str, n_splits: int) -> list[tuple[DataFrame, DataFrame]]:
    """M7 expanding-window time-series folds on distinct dates (sklearn
    TimeSeriesSplit on periods): fold i trains on periods < cut_i and tests
    on the next block. Periods are dense-ranked (W8) without a global window."""
    ranked = dense_rank_values(df, date, "_period")
    n = ranked.agg(F.max("_period")).first()[0]        # one scalar parameterises the fold plan
    test_size = n // (n_splits + 1)
    folds = []
    for i in range(n_splits):
        end_train = n - (n_splits - i) * test_size
        tr = ranked.where(F.col("_period") <= end_train).drop("_period")
        te = ranked.where((F.col("_period") > end_train) & (F.col("_period") <= end_train + test_size)).drop("_period")
        folds.append((tr, te))
    return folds


def resample_ratio(df: DataFrame, label: str, key: Sequence[str], over_ratio: float = 0.3, under_ratio: float = 0.6,
                   seed: int = 42, minority: int = 1) -> DataFrame:
    """M10 random over-sampling of the minority class to ``over_ratio`` of
    the majority, then random under-sampling of the majority so that
    minority / majority = ``under_ratio`` (imblearn semantics). Replicas
    come from ``explode(sequence)`` and the majority rows kept are the
    first ones in hash order (skew-safe rank): no row is sampled by
    chance, the output size is exact. Without minority rows there is nothing
    to replicate: every other row stays."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    n_min = counts.where(F.col(label) == minority).select("n").scalar()
    n_maj = counts.where(F.col(label) != minority).select("n").scalar()
    target_min = F.greatest(n_min, F.floor(F.lit(over_ratio) * n_maj))
    keep_maj = F.least(n_maj, F.floor(target_min / F.lit(under_ratio)))
    h = hash_rank(key, seed)
    mino = with_rank(df.where(F.col(label) == minority).withColumn("_h", h), [], [F.col("_h"), *[F.col(c) for c in key]])
    reps = F.floor(target_min / n_min) + F.when(F.col("_rank") < F.try_mod(target_min.cast("bigint"), n_min), 1).otherwise(0)
    mino = mino.withColumn("_copy", F.explode(F.sequence(F.lit(1), reps.cast("int")))).drop("_copy", "_rank", "_n", "_h")
    maj = with_rank(df.where(F.col(label) != minority).withColumn("_h", h), [], [F.col("_h"), *[F.col(c) for c in key]])
    maj = maj.where((F.col("_rank") < keep_maj) | n_min.isNull()).drop("_rank", "_n", "_h")
    return mino.unionByName(maj)


def balanced_weights(df: DataFrame, label: str, col: str = "weight") -> DataFrame:
    """M11 class weight n / (k * n_c) (sklearn 'balanced') via a grouped count."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.agg(F.count(F.lit(1))).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return join_stats(df, counts, [label]).withColumn(col, n / (k * F.col("_nc"))).drop("_nc")
