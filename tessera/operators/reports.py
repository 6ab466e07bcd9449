"""Grouped reports (A16-A48 that are not marts or experiments).

All of them are grouped aggregates (partial aggregation, so hot groups are
combined map-side); medians and box statistics use the exact skew-safe
quantile scan; shares of a total use scalar subqueries or a join to the
small per-group total instead of windows over the detail rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import band, ratio
from tessera.operators.joins import first_event_attrs
from tessera.session import checkpoint_dir
from tessera.operators.ordered import join_stats, null_safe_join, quantiles, with_rank

__all__ = ["monthly_total", "mean_median_by", "user_profile", "kpi_sheet", "return_split", "return_share_by",
           "return_by_segment", "return_by_weekday", "histogram", "box_stats", "counts_by", "flag_share_by",
           "top_groups", "grade_counts", "grades_side_by_side", "monthly_mean_min_count", "top_share_mean",
           "cluster_profile", "error_profile", "yearly_mean", "yearly_totals", "period_totals", "median_by", "positioned"]


def monthly_total(df: DataFrame, date: str, value: str) -> DataFrame:
    """A21 total per calendar month."""
    return df.groupBy(F.trunc(F.col(date).cast("date"), "month").alias("month")).agg(F.sum(value).alias("total"))


def mean_median_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A22/A32 count, mean and exact median of a measure per group."""
    keys = list(keys)
    base = df.groupBy(*keys).agg(F.count(value).alias("n"), ratio(F.sum(value), F.count(value)).alias("mean"))
    med = quantiles(df, value, [0.5], keys=keys, names=["median"])
    return null_safe_join(base, med, keys, "left")


# Ticket-count segments of the return analysis (lower inclusive, upper exclusive).
TICKET_SEGMENTS = [(1, 2, "1-2"), (2, 3, "2-3"), (3, 5, "3-5"), (5, 100, "5-100")]


def user_profile(purchases: DataFrame, *, user: str = "user_id", order: str = "order_id", ts: str = "created_ts",
                 date: str = "created_dt", revenue: str = "revenue", tickets: str = "tickets_count",
                 attrs: Sequence[str] = ("device_type", "region_name", "service_name", "event_type")) -> DataFrame:
    """A23 per user: first/last order, distinct orders, mean revenue, mean
    tickets, mean days since the previous order, mean revenue per ticket,
    attributes of the first order (J10) and the return flags."""
    p = (purchases.withColumn("rev_per_ticket", F.try_divide(F.col(revenue).cast("double"), F.col(tickets).cast("double"))
                     .cast("decimal(25,10)")))
    # The gaps between successive orders add up to the time from the first to the last.
    place = F.struct(ts, order)
    span = F.datediff(F.max_by(date, place).cast("date"), F.min_by(date, place).cast("date"))
    agg = p.groupBy(user).agg(
        F.min(ts).alias("first_order"), F.max(ts).alias("last_order"), F.count_distinct(order).alias("total_orders"),
        ratio(F.sum(revenue), F.count(revenue)).alias("avg_order_rev"),
        F.avg(tickets).alias("avg_tickets_count"), F.try_divide(span.cast("double"), F.count(date) - 1).alias("avg_days_since_prev"),
        ratio(F.sum("rev_per_ticket"), F.count("rev_per_ticket")).alias("avg_revenue_per_ticket"))
    first = first_event_attrs(purchases, user, [ts, order], list(attrs), prefix="first_")
    return (agg.join(first, user)
            .withColumn("is_two", (F.col("total_orders") >= 2).cast("int"))
            .withColumn("is_five", (F.col("total_orders") >= 5).cast("int")))


def kpi_sheet(profile: DataFrame) -> DataFrame:
    """A24 one aggregate over the profile, unpivoted to (metric, value)."""
    checkpoint_dir(profile.sparkSession)
    profile = profile.checkpoint()     # read by the aggregate and the median scan
    stacked = profile.select(F.explode(F.array(
        F.struct(F.lit("median_order_revenue").alias("m"), F.col("avg_order_rev").cast("double").alias("v")),
        F.struct(F.lit("median_tickets").alias("m"), F.col("avg_tickets_count").cast("double").alias("v")))).alias("s")).select("s.*")
    meds = quantiles(stacked, "v", [0.5], keys=["m"], names=["q"])
    med_rev = meds.where(F.col("m") == "median_order_revenue").select("q").scalar()
    med_tk = meds.where(F.col("m") == "median_tickets").select("q").scalar()
    row = profile.agg(
        F.count(F.lit(1)).cast("double").alias("users"), F.avg("avg_order_rev").alias("mean_order_revenue"),
        (F.avg("is_two") * 100).alias("share_two_plus_pct"), (F.avg("is_five") * 100).alias("share_five_plus_pct"),
        F.sum("total_orders").cast("double").alias("orders"), F.avg("avg_tickets_count").alias("mean_tickets"),
        F.avg("avg_days_since_prev").alias("mean_days_between"))
    row = row.withColumn("median_order_revenue", med_rev).withColumn("median_tickets", med_tk)
    names = [c for c in row.columns]
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
                                          for n in names])).alias("r")).select("r.*")


def return_split(profile: DataFrame, dim: str, flag: str = "is_two") -> DataFrame:
    """A25 users per (returned, dimension value): count and share of all users."""
    total = profile.agg(F.count(F.lit(1))).scalar()
    return (profile.groupBy(flag, dim).agg(F.count(F.lit(1)).alias("users"))
            .withColumn("share_of_all", ratio("users", total)))


def return_share_by(profile: DataFrame, dim: str, flag: str = "is_two") -> DataFrame:
    """A26 per dimension value: users and the share who returned."""
    return profile.groupBy(dim).agg(F.count(F.lit(1)).alias("users"), F.avg(F.col(flag).cast("double")).alias("return_share"))


def return_by_segment(profile: DataFrame, col: str = "avg_tickets_count", flag: str = "is_two") -> DataFrame:
    """A27 return share per ticket segment [1,2), [2,3), [3,5), [5,100)."""
    seg = band(col, TICKET_SEGMENTS)
    return (profile.withColumn("segment", seg).where(F.col("segment").isNotNull())
            .groupBy("segment").agg(F.count(F.lit(1)).alias("users"), F.avg(F.col(flag).cast("double")).alias("return_share")))


def return_by_weekday(profile: DataFrame, ts: str = "first_order", flag: str = "is_two") -> DataFrame:
    """A28 return share by weekday of the first order, Monday first (weekday_no 0..6)."""
    return (profile.groupBy(F.weekday(ts).alias("weekday_no"), F.date_format(ts, "EEEE").alias("weekday"))
            .agg(F.count(F.lit(1)).alias("users"), F.avg(F.col(flag).cast("double")).alias("return_share")))


def histogram(df: DataFrame, col: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """A45 equal-width histogram on the global min/max (last bin closed on
    the right), counts per group and bin with bin edges."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    w = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((x - lo) / w), F.lit(bins - 1))).cast("int")
    out = df.where(F.col(col).isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("bin_lo", lo + F.col("bin") * w).withColumn("bin_hi", lo + (F.col("bin") + 1) * w)


def box_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """A46 per group: quartiles (exact), Tukey fences, whisker ends (most
    extreme values inside the fences) and outlier count."""
    by = list(by)
    q = quantiles(df, col, [0.25, 0.5, 0.75], keys=by, names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("lower_fence", F.col("q1") - 1.5 * iqr).withColumn("upper_fence", F.col("q3") + 1.5 * iqr)
    x = F.col(col).cast("double")
    j = join_stats(df.select(*by, col), q, by, "inner")
    inside = (x >= F.col("lower_fence")) & (x <= F.col("upper_fence"))
    w = j.groupBy(*by).agg(F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
                           F.count_if(~inside).alias("outliers"))
    return null_safe_join(q, w, by, "left")


def counts_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """A29 row counts per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def flag_share_by(df: DataFrame, key: str, flag: str) -> DataFrame:
    """A30 per group: rows, flagged rows and their share."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(flag)).cast("bigint").alias("flagged"))
            .withColumn("share", ratio("flagged", "n")))


def top_groups(df: DataFrame, key: str, k: int, mean_col: str | None = None) -> DataFrame:
    """A31/A34/L2 top-k groups by row count (ties by key) with an optional
    mean and a 1..k rank computed after the cut."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if mean_col:
        aggs.append(F.avg(mean_col).alias(f"mean_{mean_col}"))
    top = df.groupBy(key).agg(*aggs).orderBy(F.col("n").desc(), F.col(key).asc()).limit(k)
    from pyspark.sql import Window
    return top.withColumn("rank_no", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col(key).asc())))


def grade_counts(df: DataFrame, col: str, bands, name: str) -> DataFrame:
    """Counts and shares per grade of one grading system (null values excluded)."""
    g = df.select(band(col, bands).alias("grade")).where(F.col("grade").isNotNull())
    total = g.agg(F.count(F.lit(1))).scalar()
    return g.groupBy("grade").agg(F.count(F.lit(1)).alias(f"{name}_count")).withColumn(f"{name}_share", ratio(f"{name}_count", total))


def grades_side_by_side(df: DataFrame, a_col: str, a_bands, b_col: str, b_bands, a: str = "critic", b: str = "user") -> DataFrame:
    """A33 two grade systems joined on the grade label."""
    return grade_counts(df, a_col, a_bands, a).join(grade_counts(df, b_col, b_bands, b), "grade", "full_outer")


def monthly_mean_min_count(df: DataFrame, date: str, value: str, min_count: int = 10) -> DataFrame:
    """A42 mean per month, keeping months with at least ``min_count`` rows."""
    return (df.groupBy(F.trunc(F.col(date).cast("date"), "month").alias("month"))
            .agg(F.count(value).alias("n"), F.avg(F.col(value).cast("double")).alias("mean_value"))
            .where(F.col("n") >= min_count))


def yearly_mean(df: DataFrame, date: str, value: str) -> DataFrame:
    """A43 mean per calendar year."""
    return df.groupBy(F.year(date).alias("year")).agg(F.avg(F.col(value).cast("double")).alias("mean_value"),
                                                      F.count(value).alias("n"))


def yearly_totals(df: DataFrame, date: str, cols: Sequence[str], total: str = "total") -> DataFrame:
    """A43 per calendar year: the sum of each column and of all of them together."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]
    out = df.groupBy(F.year(date).alias("year")).agg(*sums)
    return out.withColumn(total, sum((F.col(c) for c in cols[1:]), F.col(cols[0])))


def period_totals(df: DataFrame, date: str, value: str) -> DataFrame:
    """A44 total per date."""
    return df.groupBy(date).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))


def median_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """A44 exact median per group."""
    return quantiles(df, value, [0.5], keys=by, names=["median"])


def positioned(report: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """L1 a report in its order: rows numbered from 1 by ``order``, which the sink
    may sort by. The numbers come from the ordered scan, not from one task."""
    return with_rank(report, [], list(order)).withColumn(name, F.col("_rank") + 1).drop("_rank", "_n")


def top_share_mean(df: DataFrame, value: str, by: Sequence[str], p: float = 0.99) -> DataFrame:
    """A44/P19 rows above the exact global p-quantile, mean per group."""
    cut = quantiles(df, value, [p], names=["q"]).select("q").scalar()
    return (df.where(F.col(value).cast("double") > cut).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n"), ratio(F.sum(value), F.count(value)).alias("mean_value")))


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """A47 mean of each input per cluster. The inputs are stacked, so that any
    number of them is one small aggregate, combined map-side."""
    stacked = df.select(F.col(cluster), F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("_at", "_v"))
    means = stacked.groupBy(cluster, "_at").agg(F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_mean"))
    out = means.groupBy(cluster).agg(F.max("_n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_at", "_mean"))).alias("_m"))
    return out.select(cluster, "n", *[F.col("_m")[i].alias(f"mean_{c}") for i, c in enumerate(cols)])


def error_profile(df: DataFrame, y: str, pred: str, by: Sequence[str]) -> DataFrame:
    """A48 per group: mean relative error (pred - y) / y and shares below / above 0."""
    rel = F.try_divide(F.col(pred).cast("double") - F.col(y).cast("double"), F.col(y).cast("double"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(rel).alias("mean_rel_error"),
                               F.avg((rel < 0).cast("double")).alias("share_under"),
                               F.avg((rel > 0).cast("double")).alias("share_over"))
