"""Window features over ordered groups (W1-W9), skew-safe.

Per-entity lags, rolling and expanding means run on ``ordered.with_rank``:
native window functions over (key, range partition), with the few rows
before a partition carried into it, and prefix sums carried the same way.
However hot a group is, its rows stay spread over many tasks, and no row is
joined with another. Whole-partition aggregates (W9) are plain grouped
aggregates joined back.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import join_stats, with_rank

__all__ = ["lags", "expanding_mean_before", "rolling_mean_before", "gap_days", "dense_rank_values",
           "group_total", "time_series_features"]


def lags(df: DataFrame, keys: Sequence[str], order: Sequence, col: str, ks: Sequence[int] = (1,),
         names: Sequence[str] | None = None) -> DataFrame:
    """``col`` from the row ``k`` places earlier in the group (NULL
    when there is none), all offsets in one window."""
    names = list(names or [f"{col}_lag_{k}" for k in ks])
    local = {n: (lambda w, k=k: F.lag(col, k).over(w)) for n, k in zip(names, ks)}
    return with_rank(df, keys, order, rank=False, local=local, halo=max(ks))


def expanding_mean_before(df: DataFrame, keys: Sequence[str], order: Sequence, col: str,
                          name: str | None = None) -> DataFrame:
    """Mean of the non-null values of strictly earlier rows (NULL when
    there are none). No join needed: subtract the row itself from the
    inclusive running sum and count."""
    name = name or f"{col}_expanding_mean"
    r = with_rank(df, keys, order, sums=[col])
    own = F.when(F.col(col).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    s = F.col(f"_cum_{col}") - F.coalesce(F.col(col), F.lit(0))
    k = F.col(f"_cnt_{col}") - own
    return (r.withColumn(name, F.try_divide(s.cast("double"), k.cast("double")))
            .drop("_rank", "_n", f"_cum_{col}", f"_cnt_{col}"))


def _rolling(col: str, n: int):
    """Mean of the ``n`` rows just before, NULL unless all ``n`` exist and are non-null."""
    def over(w):
        before = w.rowsBetween(-n, -1)
        return F.when(F.count(col).over(before) == n, F.sum(col).over(before).cast("double") / F.lit(float(n)))
    return over


def rolling_mean_before(df: DataFrame, keys: Sequence[str], order: Sequence, col: str,
                        windows: Sequence[int] = (2, 4), names: Sequence[str] | None = None) -> DataFrame:
    """Mean of the ``n`` rows just before, NULL unless all ``n`` exist
    and are non-null."""
    names = list(names or [f"{col}_rolling_{n}" for n in windows])
    return with_rank(df, keys, order, rank=False, local={name: _rolling(col, n) for n, name in zip(windows, names)}, halo=max(windows))


def gap_days(df: DataFrame, keys: Sequence[str], order: Sequence, date_col: str, name: str = "days_since_prev") -> DataFrame:
    """Days since the previous row of the group (NULL for the first)."""
    out = lags(df, keys, order, date_col, ks=(1,), names=["_prev_date"])
    return out.withColumn(name, F.datediff(F.col(date_col).cast("date"), F.col("_prev_date").cast("date"))).drop("_prev_date")


def dense_rank_values(df: DataFrame, col: str, name: str = "dense_rank") -> DataFrame:
    """Dense rank (1-based) of the distinct values of ``col``, joined back.
    Ranking runs on the distinct values only, through the ordered scan (no
    single-partition window)."""
    distinct = df.select(col).distinct().where(F.col(col).isNotNull())
    ranked = with_rank(distinct, [], [F.col(col)]).select(col, (F.col("_rank") + 1).alias(name))
    return join_stats(df, ranked, [col])


def group_total(df: DataFrame, keys: Sequence[str], col: str, name: str | None = None) -> DataFrame:
    """Partition total joined back (``transform('sum')``). Computed
    as a partial aggregate + join rather than a window, so a hot key is
    pre-aggregated map-side instead of landing in one task."""
    name = name or f"{col}_group_total"
    tot = df.groupBy(*keys).agg(F.sum(col).alias(name))
    return join_stats(df, tot, keys)


def time_series_features(df: DataFrame, keys: Sequence[str], date_col: str, col: str) -> DataFrame:
    """SPRE feature block: calendar parts, expanding mean of earlier rows,
    lags 1/2/4, rolling means of 2 and 4 earlier rows. Lags count rows, not
    weeks (a missing week is skipped), as in the reference.

    One ordered scan and one window serve every feature."""
    local = {f"sales_{k}week_ago": (lambda w, k=k: F.lag(col, k).over(w)) for k in (1, 2, 4)}
    local |= {f"mean_sales_{n}week": _rolling(col, n) for n in (2, 4)}
    r = with_rank(df, list(keys), [F.col(date_col)], sums=[col], local=local, halo=4)
    own = F.when(F.col(col).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    out = (r.withColumn("month", F.month(date_col)).withColumn("quarter", F.quarter(date_col))
           .withColumn("year", F.year(date_col))
           .withColumn("avg_sales_before", F.try_divide((F.col(f"_cum_{col}") - F.coalesce(F.col(col), F.lit(0))).cast("double"),
                                                        (F.col(f"_cnt_{col}") - own).cast("double"))))
    return out.drop("_rank", "_n", f"_cum_{col}", f"_cnt_{col}")
