"""Profiling and data-quality operators (Q1-Q14).

Column-wise statistics are computed in one aggregate pass and then
unpivoted; per-column distinct counts go through a single (column, value)
distinct instead of one Expand copy per column.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import ratio
from tessera.operators.ordered import quantiles

__all__ = ["profile", "profile_ranges", "describe", "null_share", "null_share_by", "dup_count", "cardinality", "date_span",
           "value_counts", "split_leakage", "load_report", "removal_report", "over_limit_by"]


def _unpivot(one_row: DataFrame, cols: Sequence[str], names: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One-row frame with columns ``<stat>__<i>`` -> one row per column."""
    rows = [F.struct(F.lit(n).alias("column_name"), *[F.col(f"{s}__{i}").alias(s) for s in stats])
            for i, n in enumerate(names)]
    return one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3 nulls per column: count and share of all rows (one pass)."""
    cols = list(cols or df.columns)
    n = F.count(F.lit(1))
    aggs = []
    for i, c in enumerate(cols):
        nulls = F.count_if(F.col(f"`{c}`").isNull())
        aggs += [nulls.alias(f"null_count__{i}"), ratio(nulls, n).alias(f"null_share__{i}")]
    return _unpivot(df.agg(*aggs), cols, cols, ["null_count", "null_share"])


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1 rows, non-null values and nulls per column (one pass)."""
    cols = list(cols or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(F.lit(1)).alias(f"rows__{i}"), F.count(F.col(f"`{c}`")).alias(f"non_null__{i}"),
                 F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls__{i}")]
    return _unpivot(df.agg(*aggs), cols, cols, ["rows", "non_null", "nulls"])


def profile_ranges(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1 type, smallest and largest value (as text) of each column, with its counts (one pass)."""
    cols = list(cols or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.lit(df.schema[c].dataType.simpleString()).alias(f"type__{i}"), F.count(x).alias(f"non_null__{i}"),
                 F.min(x).cast("string").alias(f"min_value__{i}"), F.max(x).cast("string").alias(f"max_value__{i}")]
    return _unpivot(df.agg(*aggs), cols, cols, ["type", "non_null", "min_value", "max_value"])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2 count, mean, sample std, min, quartiles (exact, interpolated), max
    per numeric column. The columns are stacked into (column, value) so one
    aggregate and one skew-safe quantile scan serve all of them."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])).alias("s")
    ).select("s.*")
    base = stacked.groupBy("column_name").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = quantiles(stacked, "v", [0.25, 0.5, 0.75], keys=["column_name"], names=["q25", "q50", "q75"])
    return base.join(q, "column_name", "left")


def null_share_by(df: DataFrame, col: str, key: str) -> DataFrame:
    """Q4 per group: rows, nulls of ``col`` and their share; groups without
    nulls are dropped (pandas inner semantics). Null group keys dropped (D1)."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(col).isNull()).alias("nulls")))
    return out.where(F.col("nulls") > 0).withColumn("null_share", ratio("nulls", "rows"))


def dup_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Q5 rows beyond the first per key (whole row when ``keys`` is None),
    and how many keys are duplicated."""
    keys = list(keys or df.columns)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
                 F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
                 F.count(F.lit(1)).alias("distinct_keys"))


def cardinality(df: DataFrame, cols: Sequence[str] | None = None, n: int = 300) -> DataFrame:
    """Q6 distinct values per column and whether it is above ``n`` (high
    cardinality). One stacked (column, value) distinct for all columns."""
    cols = list(cols or df.columns)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in cols])).alias("s")
    ).select("s.*").where(F.col("v").isNotNull())
    out = stacked.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    return out.withColumn("high_cardinality", (F.col("distinct_values") > n).cast("int"))


def date_span(df: DataFrame, col: str) -> DataFrame:
    """Q7 first and last date and the span in days."""
    d = F.col(col).cast("date")
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  F.datediff(F.max(d), F.min(d)).alias("span_days"))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Q8 count and share per value (share of non-null rows when dropna)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    counted = src.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    total = src.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("share", ratio("cnt", total))


def split_leakage(splits: dict[str, DataFrame], key: str) -> DataFrame:
    """Q10 keys shared by each pair of splits (should all be 0)."""
    names = list(splits)
    keysets = {n: splits[n].select(key).distinct() for n in names}
    rows = None
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            shared = keysets[a].join(keysets[b], key, "left_semi").agg(F.count(F.lit(1)).alias("shared_keys"))
            shared = shared.select(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), "shared_keys")
            rows = shared if rows is None else rows.unionByName(shared)
    return rows


def load_report(df: DataFrame, date_col: str, plan_flag: str | None = None) -> DataFrame:
    """Q12 loaded rows, first/last date and the first date of plan rows."""
    d = F.col(date_col).cast("date")
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(d).alias("min_date"), F.max(d).alias("max_date")]
    if plan_flag:
        aggs.append(F.min(F.when(F.col(plan_flag), d)).alias("first_plan_date"))
    return df.agg(*aggs)


def removal_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q13 rows before and after a cleaning step, removed rows and share."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    return (b.withColumn("rows_after", after.agg(F.count(F.lit(1))).scalar())
            .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
            .withColumn("removed_share", ratio("removed", "rows_before")))


def over_limit_by(df: DataFrame, col: str, limit: float, by: str) -> DataFrame:
    """Q14 rows with ``col`` over ``limit`` (or equal to 0 when limit is None) counted per group."""
    cond = F.col(col) > limit if limit is not None else F.col(col) == 0
    return df.where(cond).groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
