"""Projection, filtering, cleaning and date operators.

Every function is a native column expression or a grouped aggregate; no
Python UDFs. Statistics used to fill or trim (mean, max, exact quantiles)
are scalar subqueries or small grouped aggregates joined back, never a
window over a whole key.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import band, col_of, ratio, snake_case
from tessera.operators.ordered import join_stats, quantiles

__all__ = [
    "snake_case_columns", "to_numeric", "sentinel_to_null", "cast_columns", "fill_const", "fill_max",
    "fill_group_mean", "fill_mean", "fill_median_from", "recode", "normalize_text", "dedup_first", "drop_null",
    "trim_percentile", "iqr_bounds", "iqr_outliers", "row_share", "currency_convert",
    "calendar_parts", "parse_packed_hour", "localize", "relative_window", "grade",
]


def snake_case_columns(df: DataFrame) -> DataFrame:
    """P1 all column names to snake_case."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def to_numeric(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """P2 text to number; anything unparsable ('unknown') becomes NULL."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS {dtype})").alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def sentinel_to_null(df: DataFrame, col: str, sentinels: Sequence[str]) -> DataFrame:
    """P3 sentinel text ('tbd') to NULL."""
    return df.withColumn(col, F.when(F.col(col).isin(*sentinels), F.lit(None)).otherwise(F.col(col)))


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = True) -> DataFrame:
    """P4 explicit casts (try_cast when ``safe``)."""
    fn = (lambda c, t: F.expr(f"try_cast(`{c}` AS {t})")) if safe else (lambda c, t: F.col(c).cast(t))
    return df.select(*[fn(c, types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P5 constant fill per column."""
    return df.fillna(dict(values))


def fill_max(df: DataFrame, col: str) -> DataFrame:
    """P6 fill with the column maximum (scalar subquery)."""
    return df.withColumn(col, F.coalesce(F.col(col), df.agg(F.max(col)).scalar()))


def fill_group_mean(df: DataFrame, col: str, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """P7 fill with the mean of the row's own group; all-null groups stay
    null. Group means are a partial aggregate joined back (null-safe keys):
    a hot group is combined map-side, and its rows are not shuffled to it."""
    name = name or col
    means = df.groupBy(*keys).agg(F.avg(col).alias("_gmean"))
    return join_stats(df, means, keys).withColumn(name, F.coalesce(F.col(col), F.col("_gmean"))).drop("_gmean")


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P8 fill each listed column with its own mean (scalar subqueries,
    merged by the optimizer into one aggregate)."""
    out = df
    for c in cols:
        mean = df.agg(ratio(F.sum(c), F.count(c))).scalar()     # exact sum / count, as a float mean
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), mean))
    return out


def fill_median_from(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str]) -> list[DataFrame]:
    """P9 fill with the *training* median (exact) on train and every other split."""
    meds = {c: quantiles(train, c, [0.5], names=["m"]).select("m").scalar() for c in cols}
    out = []
    for d in [train, *others]:
        for c in cols:
            d = d.withColumn(c, F.coalesce(F.col(c).cast("double"), meds[c]))
        out.append(d)
    return out


def recode(df: DataFrame, col: str, mapping: Mapping[object, object], name: str | None = None) -> DataFrame:
    """P10 value recode; unmapped values kept."""
    expr = None
    for k, v in mapping.items():
        cond = F.col(col).isNull() if k is None else (F.col(col) == F.lit(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return df.withColumn(name or col, expr.otherwise(F.col(col)) if expr is not None else F.col(col))


def normalize_text(c, replace: Mapping[str, str] | None = None) -> Column:
    """P12 lower-case, trim both sides, literal substring replacements."""
    x = F.lower(F.trim(col_of(c)))
    for a, b in (replace or {}).items():
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """P14 keep the first row per key in the stated order (unique tiebreak
    expected). ``min_by`` over a struct of the row is a partial aggregate,
    so even a key holding a third of the rows is reduced map-side."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def drop_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P15 drop rows with a null in any / the listed columns."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def trim_percentile(df: DataFrame, col: str, p: float) -> DataFrame:
    """P18 keep rows at or below the exact p-quantile of ``col``."""
    cut = quantiles(df, col, [p], names=["q"]).select("q").scalar()
    return df.where(F.col(col) <= cut)


def iqr_bounds(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Quartiles and Tukey fences (Q1 - 1.5 IQR, Q3 + 1.5 IQR) per group."""
    q = quantiles(df, col, [0.25, 0.5, 0.75], keys=keys, names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("lower", F.col("q1") - 1.5 * iqr).withColumn("upper", F.col("q3") + 1.5 * iqr)


def iqr_outliers(df: DataFrame, col: str) -> DataFrame:
    """P20 fences and the number of rows outside them (one row)."""
    b = iqr_bounds(df, col)
    lo, hi = b.select("lower").scalar(), b.select("upper").scalar()
    x = F.col(col)
    return (b.select("q1", "median", "q3", "lower", "upper")
            .withColumn("outliers_low", df.where(x < lo).agg(F.count(F.lit(1))).scalar())
            .withColumn("outliers_high", df.where(x > hi).agg(F.count(F.lit(1))).scalar()))


def row_share(df: DataFrame, cols: Sequence[str], suffix: str = "_share") -> DataFrame:
    """P30 each column as a share of the row sum of the group of columns."""
    total = None
    for c in cols:
        total = F.coalesce(F.col(c), F.lit(0)) if total is None else total + F.coalesce(F.col(c), F.lit(0))
    out = df
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", ratio(F.col(c), total))
    return out


def currency_convert(df: DataFrame, rates: DataFrame, date_col: str, amount_col: str, currency_col: str,
                     foreign: str, rate_date: str = "data", nominal: str = "nominal", curs: str = "curs",
                     name: str = "revenue_rub") -> DataFrame:
    """P27/J8 convert foreign-currency amounts by the same-day rate
    (amount / nominal * curs); home-currency rows unchanged; a missing rate
    day gives NULL."""
    r = rates.select(F.col(rate_date).alias("_rd"), F.col(nominal).alias("_nom"), F.col(curs).alias("_curs"))
    out = df.join(r, F.col(date_col) == F.col("_rd"), "left")
    conv = F.when(F.col(currency_col) == foreign, F.col(amount_col) / F.col("_nom") * F.col("_curs")).otherwise(F.col(amount_col))
    return out.withColumn(name, conv).drop("_rd", "_nom", "_curs")


def calendar_parts(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """T1/T2/T3 month, quarter, year, weekday (Mon=0), weekday name, hour, month start."""
    c = F.col(col)
    return (df.withColumn(f"{prefix}month", F.month(c)).withColumn(f"{prefix}quarter", F.quarter(c))
            .withColumn(f"{prefix}year", F.year(c)).withColumn(f"{prefix}weekday", F.weekday(c))
            .withColumn(f"{prefix}weekday_name", F.date_format(c, "EEEE")).withColumn(f"{prefix}hour", F.hour(c))
            .withColumn(f"{prefix}month_start", F.trunc(c.cast("date"), "month")))


def parse_packed_hour(df: DataFrame, col: str, fmt: str = "yyMMddHH") -> DataFrame:
    """T4 packed ``yyMMddHH`` text to timestamp, date and hour (bad text -> NULL).
    Two-digit years follow the POSIX/pandas pivot: 69-99 -> 19xx, 00-68 -> 20xx
    (Java's ``yy`` would read 95 as 2095)."""
    raw = F.try_to_timestamp(F.col(col), F.lit(fmt))
    ts = F.when(F.year(raw) >= 2069, raw - F.make_ym_interval(F.lit(100), F.lit(0))).otherwise(raw) if "yyyy" not in fmt else raw
    return df.withColumn(f"{col}_ts", ts).withColumn(f"{col}_date", ts.cast("date")).withColumn(f"{col}_hour", F.hour(ts))


def localize(df: DataFrame, col: str, zone: str) -> DataFrame:
    """T5 read naive wall-clock time as time in ``zone`` (stored as UTC instant)."""
    return df.withColumn(col, F.to_utc_timestamp(F.col(col).cast("timestamp"), zone))


def relative_window(col, run_date, days: int) -> Column:
    """T7 condition ``run_date - days <= col < run_date``."""
    rd = F.lit(run_date).cast("timestamp") if isinstance(run_date, str) else run_date
    c = col_of(col).cast("timestamp")
    return (c >= rd - F.make_dt_interval(F.lit(days))) & (c < rd)


def grade(df: DataFrame, col: str, bands, name: str, default: str | None = None) -> DataFrame:
    """P24 half-open threshold grades."""
    return df.withColumn(name, band(col, bands, default))
