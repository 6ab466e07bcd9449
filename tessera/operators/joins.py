"""Joins (J1-J13): as-of, interval label, first-event attributes, shares,
top-k semi-joins, suffixed joins.

Plain equi-joins are ordinary ``DataFrame.join`` calls; Spark/AQE picks
broadcast only when the measured side is small and splits skewed partitions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.ordered import with_rank

__all__ = ["asof_join", "interval_label", "first_event_attrs", "semi_top_k",
           "join_suffixed", "key_overlap_join"]


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
              right_cols: Sequence[str], strict: bool = True, suffix: str = "_right",
              right_tiebreak: Sequence[str] = ()) -> DataFrame:
    """J6 backward as-of join: every left row gets the latest right row of the
    same ``by`` key with ``right_on`` before ``left_on`` (strictly before when
    ``strict``, i.e. pandas ``allow_exact_matches=False``). NULL keys never
    match. Right rows at the same time are ordered by ``right_tiebreak``
    (default: the carried columns); the last one wins.

    Both sides are unioned and scanned in (by, time) order with the skew-safe
    ordered scan, and each left row takes the last right row at or before it:
    a native window inside each range partition, into which the last right
    row before the partition is carried. No row is joined with another, and
    no key lands in a single task. Left rows without a key stay outside the scan."""
    by = list(by)
    right_cols = [c for c in right_cols if c not in by]
    carried = [right_on] + [c for c in right_cols if c != right_on]
    l_struct = F.struct(*[F.col(c) for c in left.columns])
    r_struct = F.struct(*[F.col(c).alias(f"{c}{suffix}" if c in left.columns else c) for c in carried])
    l_type: StructType = left.select(l_struct.alias("s")).schema["s"].dataType
    r_type: StructType = right.select(r_struct.alias("s")).schema["s"].dataType
    left_side, right_side = (0, 1) if strict else (1, 0)
    known = F.lit(True)
    for k in by:
        known = known & F.col(k).isNotNull()
    lu = left.where(known).select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], F.col(left_on).cast("timestamp").alias("_t"),
                                  F.lit(left_side).alias("_side"), F.lit(False).alias("_isr"),
                                  l_struct.alias("_l"), F.lit(None).cast(r_type).alias("_r"))
    ru = right.where(known).select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], F.col(right_on).cast("timestamp").alias("_t"),
                                   F.lit(right_side).alias("_side"), F.lit(True).alias("_isr"),
                                   F.lit(None).cast(l_type).alias("_l"), r_struct.alias("_r"))
    ru = ru.where(F.col("_t").isNotNull())
    tiebreak = [F.col(f"_r.{f.name}") for f in r_type.fields
                if not right_tiebreak or f.name in right_tiebreak or f.name.removesuffix(suffix) in right_tiebreak]
    local = {"_m": lambda w: F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))}
    out = with_rank(lu.unionByName(ru), [f"_by{i}" for i in range(len(by))], [F.col("_t"), F.col("_side"), *tiebreak],
                    rank=False, local=local, halo=1, halo_of="_isr")
    out = out.where(~F.col("_isr")).select("_l.*", "_m.*")
    keyless = left.where(~known).select(*left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in r_type.fields])
    return out.unionByName(keyless)


def interval_label(cohort: DataFrame, events: DataFrame, key: str, t_col: str, event_ts: str, value_col: str,
                   threshold: float = 90, horizon_days: int = 365, label: str = "target") -> DataFrame:
    """J7 forward interval label. For each cohort row (key, t):

    * the key's *first* episode is its earliest event with value >= threshold;
    * rows whose first episode is before t are dropped (already defaulted);
    * rows with t later than (last event date - horizon) are dropped (label
      window not fully observed);
    * label = 1 when the first episode falls in [t, t + horizon days).

    One grouped ``min`` per key (partial-aggregated, skew-safe) and one
    equi-join - no cohort x event pairs are ever formed."""
    first = (events.where(F.col(value_col) >= threshold)
             .groupBy(key).agg(F.min(F.col(event_ts).cast("date")).alias("_first")))
    last = events.agg(F.max(F.col(event_ts).cast("date"))).scalar()   # scalar subquery
    t = F.col(t_col).cast("date")
    out = (cohort.join(first, key, "left")
           .where(F.col("_first").isNull() | (F.col("_first") >= t))
           .where(t <= F.date_sub(last, horizon_days)))
    lab = F.when(F.col("_first").isNotNull() & (F.col("_first") < F.date_add(t, horizon_days)), F.lit(1)).otherwise(F.lit(0))
    return out.withColumn(label, lab).drop("_first")


def first_event_attrs(df: DataFrame, key: str, order: Sequence[str], attrs: Sequence[str],
                      prefix: str = "first_") -> DataFrame:
    """J10 attributes of each key's first event (ties broken by the later
    order columns). ``min_by`` is a partial aggregate: skew-safe."""
    best = F.min_by(F.struct(*[F.col(a) for a in attrs]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(key).agg(best.alias("_f")).select(key, *[F.col(f"_f.{a}").alias(f"{prefix}{a}") for a in attrs])


def semi_top_k(df: DataFrame, ranked_keys: DataFrame, key: str) -> DataFrame:
    """J5 keep rows whose key is in a top-k list (at most k rows -> broadcast)."""
    return df.join(F.broadcast(ranked_keys.select(key)), key, "left_semi")


def join_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """J12 join renaming colliding non-key columns with suffixes."""
    on = list(on)
    common = (set(left.columns) & set(right.columns)) - set(on)
    l = left.select(*[F.col(c).alias(c + suffixes[0]) if c in common else F.col(c) for c in left.columns])
    r = right.select(*[F.col(c).alias(c + suffixes[1]) if c in common else F.col(c) for c in right.columns])
    return l.join(r, on, how)


def key_overlap_join(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Q9/U3 one row: distinct keys in a, in b, and in both."""
    ka = a.select(key).distinct()
    kb = b.select(key).distinct()
    both = ka.join(kb, key, "inner")
    return (ka.agg(F.count(F.lit(1)).alias("keys_a"))
            .withColumn("keys_b", kb.agg(F.count(F.lit(1))).scalar())
            .withColumn("keys_both", both.agg(F.count(F.lit(1))).scalar()))
