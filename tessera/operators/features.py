"""Point-in-time batch features (A35-A41, E3 core).

Each fact table is aggregated on its own key in ONE pass that computes the
7- and 30-day variants together with conditional aggregates, then the
results are left-joined onto the customer list. (The reference joins orders
x events x sessions before aggregating, so amounts and session counts
depend on the fan-out; aggregating each fact separately fixes that.)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import epoch_seconds, ratio
from tessera.operators.windows import lags

__all__ = ["event_features", "order_features", "session_features", "recency", "batch_features",
           "pivot_counts", "sessions_per_active_day", "daypart", "DAYPARTS"]


def _in_window(ts: str, run_date: Column, days: int) -> Column:
    t = F.col(ts).cast("timestamp")
    return (t >= run_date - F.make_dt_interval(F.lit(days))) & (t < run_date)


def _rd(run_date: str) -> Column:
    return F.lit(run_date).cast("timestamp")


def event_features(events: DataFrame, key: str, ts: str, type_col: str, product_col: str, run_date: str,
                   windows: Sequence[int] = (7, 30), view: str = "page_view", cart: str = "add_to_cart",
                   buy: str = "purchase") -> DataFrame:
    """A35 per key and window: counts per event type, distinct products and
    two guarded conversion ratios (0 when the denominator is 0)."""
    rd = _rd(run_date)
    aggs = []
    for d in windows:
        w = _in_window(ts, rd, d)
        aggs += [F.count_if(w & (F.col(type_col) == view)).alias(f"page_view_counter_{d}"),
                 F.count_if(w & (F.col(type_col) == cart)).alias(f"add_to_cart_counter_{d}"),
                 F.count_if(w & (F.col(type_col) == buy)).alias(f"purchase_counter_{d}"),
                 F.count_distinct(F.when(w, F.col(product_col))).alias(f"unique_product_in_{d}")]
    longest = max(windows)
    out = events.where(_in_window(ts, rd, longest)).groupBy(key).agg(*aggs)
    for d in windows:
        out = (out.withColumn(f"conversion_add_to_cart_div_page_view_{d}",
                              F.coalesce(ratio(f"add_to_cart_counter_{d}", f"page_view_counter_{d}"), F.lit(0.0)))
               .withColumn(f"conversion_purchase_div_add_to_cart_{d}",
                           F.coalesce(ratio(f"purchase_counter_{d}", f"add_to_cart_counter_{d}"), F.lit(0.0))))
    return out


def order_features(orders: DataFrame, key: str, ts: str, amount: str, run_date: str, days: int = 30) -> DataFrame:
    """A36 mean and total order amount in the window (exact decimal sums)."""
    rd = _rd(run_date)
    o = orders.where(_in_window(ts, rd, days))
    return o.groupBy(key).agg(ratio(F.sum(amount), F.count(amount)).alias(f"mean_amount_{days}"),
                              F.sum(amount).alias(f"total_amount_{days}"))


def session_features(sessions: DataFrame, key: str, session_key: str, start_col: str, end_col: str, run_date: str,
                     windows: Sequence[int] = (7, 30)) -> DataFrame:
    """A37 sessions started in the window and their mean duration in seconds.
    ``sessions`` has one row per session (already reduced from events)."""
    rd = _rd(run_date)
    dur = epoch_seconds(F.col(end_col)) - epoch_seconds(F.col(start_col))
    aggs = []
    for d in windows:
        w = _in_window(start_col, rd, d)
        aggs += [F.count_if(w).alias(f"session_counter_{d}"), F.avg(F.when(w, dur)).alias(f"session_duration_in_{d}")]
    return sessions.where(_in_window(start_col, rd, max(windows))).groupBy(key).agg(*aggs)


def recency(orders: DataFrame, key: str, ts: str, run_date: str, name: str = "days_since_last_purchase") -> DataFrame:
    """A38 whole days between run date and the last earlier order (floor)."""
    rd = _rd(run_date)
    last = orders.where(F.col(ts).cast("timestamp") < rd).groupBy(key).agg(F.max(F.col(ts).cast("timestamp")).alias("_last"))
    days = F.floor((epoch_seconds(rd) - epoch_seconds(F.col("_last"))) / 86400).cast("bigint")
    return last.select(key, days.alias(name))


def batch_features(customers: DataFrame, key: str, events: DataFrame, sessions: DataFrame, orders: DataFrame, *,
                   run_date: str, ev_ts: str, ev_type: str, ev_product: str, session_key: str, s_start: str,
                   s_end: str, o_ts: str, o_amount: str) -> DataFrame:
    """A39 one row per customer: event (7/30), order (30), session (7/30)
    features and recency; missing activity -> 0, no earlier order -> -1."""
    ef = event_features(events, key, ev_ts, ev_type, ev_product, run_date)
    of = order_features(orders, key, o_ts, o_amount, run_date)
    sf = session_features(sessions, key, session_key, s_start, s_end, run_date)
    rf = recency(orders, key, o_ts, run_date)
    out = (customers.select(key).distinct()
           .join(ef, key, "left").join(of, key, "left").join(sf, key, "left").join(rf, key, "left"))
    zero_cols = [c for c in out.columns if c not in (key, "days_since_last_purchase")]
    out = out.select(key, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero_cols],
                     F.coalesce(F.col("days_since_last_purchase"), F.lit(-1)).alias("days_since_last_purchase"))
    return out.withColumn("run_date", F.lit(run_date).cast("date"))


def pivot_counts(df: DataFrame, key: str, pivot_col: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """A40 key x category counts as columns, explicit value list (no extra
    pass to discover values), missing -> 0."""
    out = df.groupBy(key).pivot(pivot_col, list(values)).count().fillna(0)
    return out.select(key, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


def sessions_per_active_day(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str] = (), idle_minutes: int = 30) -> DataFrame:
    """A41 mean number of sessions on the days a key is active. A session ends
    after ``idle_minutes`` without an event and counts on every day it
    touches. A row begins a session on its day when the key's row before it
    is that long ago or on another day, so one lag over the ordered scan is
    all that is needed: a hot key stays spread over many tasks."""
    out = lags(df.select(key, F.col(ts).cast("timestamp").alias("_ts"), *tiebreak), [key], [F.col("_ts"), *tiebreak], "_ts", names=["_before"])
    new = F.col("_before").isNull() | (F.unix_micros("_ts") - F.unix_micros("_before") >= idle_minutes * 60_000_000) | (F.to_date("_ts") != F.to_date("_before"))
    return out.groupBy(key).agg(ratio(F.count_if(new), F.count_distinct(F.to_date("_ts"))).alias("sessions_per_day"))


def daypart(ts: Column) -> Column:
    """night (0-5), morning (6-11), day (12-17) or evening (18-23 h)."""
    h = F.hour(ts)
    return F.when(h < 6, "night").when(h < 12, "morning").when(h < 18, "day").when(h < 24, "evening")


DAYPARTS = ("night", "morning", "day", "evening")
