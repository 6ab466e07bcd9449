"""A/B-test reports and statistics.

Every statistic is one Spark aggregate followed by column arithmetic on the
(one-row or per-arm) result; normal quantiles are plan-time constants and
Phi is a closed-form column expression (no scipy, no collect).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import flag, normal_cdf, ratio, z_quantile

__all__ = ["sessions_per_user", "top_user_sessions", "daily_users", "first_sessions", "page_distribution",
           "daily_success", "avg_daily_users", "ab_plan", "arm_sizes_day_one", "users_in_both_arms",
           "arm_balance", "metric_per_arm", "prop_ztest", "psi", "cramers_v", "weak_features"]


def sessions_per_user(sessions: DataFrame, user: str, session: str) -> DataFrame:
    """A16 distinct sessions per user."""
    return sessions.groupBy(user).agg(F.count_distinct(session).alias("sessions"))


def top_user_sessions(sessions: DataFrame, user: str, session: str) -> DataFrame:
    """A16 rows of the user with most sessions (ties: smallest id). The top
    user is a one-row result used as a scalar filter."""
    per = sessions_per_user(sessions, user, session)
    top = per.orderBy(F.col("sessions").desc(), F.col(user).asc()).limit(1).select(user).scalar()
    return sessions.where(F.col(user) == top)


def daily_users(sessions: DataFrame, date: str, user: str, reg_flag: str) -> DataFrame:
    """A17 per day: distinct users, distinct registered users, share."""
    out = sessions.groupBy(date).agg(F.count_distinct(user).alias("users"),
                                     F.count_distinct(F.when(F.col(reg_flag) == 1, F.col(user))).alias("registered_users"))
    return out.withColumn("registration_share", ratio("registered_users", "users"))


def first_sessions(sessions: DataFrame, user: str, order: Sequence[str]) -> DataFrame:
    """First session of each user (min_by of the row: partial aggregate)."""
    rest = [c for c in sessions.columns if c != user]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(o) for o in order]))
    return sessions.groupBy(user).agg(best.alias("_r")).select(user, "_r.*")


def page_distribution(first: DataFrame, pages: str) -> DataFrame:
    """A18 number of first sessions per page count."""
    return first.groupBy(pages).agg(F.count(F.lit(1)).alias("sessions"))


def daily_success(first: DataFrame, date: str, pages: str, min_pages: int = 4) -> DataFrame:
    """A19 per day: first sessions, successful ones (>= min_pages) and share."""
    return (first.groupBy(date).agg(F.count(F.lit(1)).alias("sessions"),
                                    F.count_if(F.col(pages) >= min_pages).alias("successes"))
            .withColumn("success_share", ratio("successes", "sessions")))


def avg_daily_users(sessions: DataFrame, date: str, user: str) -> DataFrame:
    """A20 mean of distinct users per day."""
    return sessions.groupBy(date).agg(F.count_distinct(user).alias("u")).agg(F.avg("u").alias("avg_daily_users"))


def ab_plan(first: DataFrame, sessions: DataFrame, *, date: str, user: str, pages: str, min_pages: int = 4,
            alpha: float = 0.05, power: float = 0.8, rel_mde: float = 0.03, base: float | None = None) -> DataFrame:
    """X1 sample size per arm (two proportions, Cohen's h, two-sided, equal
    arms: n = 2 ((z_{1-a/2} + z_power) / h)^2, the normal-power solution) and test days.
    base share = mean daily success share of first sessions (A19) unless
    given; days = ceil(2 n / mean daily users) (A20)."""
    ds = daily_success(first, date, pages, min_pages).agg(F.avg("success_share").alias("base_share"))
    out = ds if base is None else ds.withColumn("base_share", F.lit(float(base)))
    out = out.withColumn("avg_daily_users", avg_daily_users(sessions, date, user).scalar())
    p1 = F.col("base_share")
    p2 = p1 * (1 + rel_mde)
    h = F.abs(2 * F.asin(F.sqrt(p2)) - 2 * F.asin(F.sqrt(p1)))
    za, zb = z_quantile(1 - alpha / 2), z_quantile(power)
    n = F.ceil(2 * F.pow(F.lit(za + zb) / h, 2))       # per group, two independent samples of equal size
    return (out.withColumn("effect_size_h", h).withColumn("sample_size_per_arm", n)
            .withColumn("test_days", F.ceil(2 * n / F.col("avg_daily_users"))))


def arm_sizes_day_one(sessions: DataFrame, date: str, arm: str, user: str, a: str = "A", b: str = "B") -> DataFrame:
    """X3 distinct users per arm on the first test day and 100*|A-B|/A."""
    day1 = sessions.where(F.col(date) == sessions.agg(F.min(date)).scalar())
    out = day1.agg(F.count_distinct(F.when(F.col(arm) == a, F.col(user))).alias("users_a"),
                   F.count_distinct(F.when(F.col(arm) == b, F.col(user))).alias("users_b"))
    return out.withColumn("diff_pct", ratio(F.abs(F.col("users_a") - F.col("users_b")) * 100, "users_a"))


def users_in_both_arms(sessions: DataFrame, user: str, arm: str) -> DataFrame:
    """X4 users seen in more than one arm."""
    return sessions.groupBy(user).agg(F.count_distinct(arm).alias("arms")).where(F.col("arms") > 1)


def arm_balance(first: DataFrame, arm: str, dim: str, a: str = "A", b: str = "B") -> DataFrame:
    """X5 share of each dimension value within each arm (first sessions),
    side by side, and the gap in percentage points."""
    counted = first.groupBy(dim).agg(F.count_if(F.col(arm) == a).alias("n_a"), F.count_if(F.col(arm) == b).alias("n_b"))
    tot_a = first.where(F.col(arm) == a).agg(F.count(F.lit(1))).scalar()
    tot_b = first.where(F.col(arm) == b).agg(F.count(F.lit(1))).scalar()
    return (counted.withColumn("share_a", ratio("n_a", tot_a)).withColumn("share_b", ratio("n_b", tot_b))
            .withColumn("gap_pp", F.abs(F.col("share_a") - F.col("share_b")) * 100))


def metric_per_arm(df: DataFrame, arm: str, success: str) -> DataFrame:
    """X6 successes, users and success share per arm."""
    return (df.groupBy(arm).agg(F.sum(success).cast("bigint").alias("successes"), F.count(F.lit(1)).alias("users"))
            .withColumn("share", ratio("successes", "users")))


def prop_ztest(df: DataFrame, arm: str, success: str, a: str = "A", b: str = "B",
               alternative: str = "smaller") -> DataFrame:
    """X7 two-proportion z-test with pooled variance, one row: shares, lift,
    z and p. ``alternative='smaller'`` tests share_a < share_b (p = Phi(z)),
    'larger' p = 1 - Phi(z), 'two-sided' p = 2(1 - Phi(|z|))."""
    g = df.agg(F.sum(F.when(F.col(arm) == a, F.col(success))).cast("bigint").alias("x_a"),
               F.count_if(F.col(arm) == a).alias("n_a"),
               F.sum(F.when(F.col(arm) == b, F.col(success))).cast("bigint").alias("x_b"),
               F.count_if(F.col(arm) == b).alias("n_b"))
    pa = F.col("x_a") / F.col("n_a")
    pb = F.col("x_b") / F.col("n_b")
    pool = (F.col("x_a") + F.col("x_b")) / (F.col("n_a") + F.col("n_b"))
    se = F.sqrt(pool * (1 - pool) * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
    z = (pa - pb) / se
    if alternative == "smaller":
        p = normal_cdf(z)
    elif alternative == "larger":
        p = F.lit(1.0) - normal_cdf(z)
    else:
        p = 2 * (F.lit(1.0) - normal_cdf(F.abs(z)))
    return (g.withColumn("share_a", pa).withColumn("share_b", pb).withColumn("lift", ratio(pb - pa, pa))
            .withColumn("z_stat", z).withColumn("p_value", p))


def psi(train: DataFrame, val: DataFrame, cols: Sequence[str], bins: int = 10, eps: float = 1e-10,
        threshold: float = 0.2) -> DataFrame:
    """X8 population stability index per column: 10 equal-width bins on the
    joint min/max of train and val, shares per bin, sum (a-e) ln(a/e) with
    eps for empty bins; ``drifting`` when >= threshold. Both frames are
    stacked to (column, value, side) and binned in one aggregate."""
    def stack(df, side):
        return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                                             for c in cols])).alias("s")).select("s.*", F.lit(side).alias("side"))
    both = stack(train, 0).unionByName(stack(val, 1)).where(F.col("v").isNotNull())
    rng = both.groupBy("column_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    binned = both.join(F.broadcast(rng), "column_name")  # one row a column
    binned = binned.withColumn("bin", b)
    counts = binned.groupBy("column_name", "bin").agg(F.count_if(F.col("side") == 0).alias("n_e"),
                                                      F.count_if(F.col("side") == 1).alias("n_a"))
    totals = binned.groupBy("column_name").agg(F.count_if(F.col("side") == 0).alias("t_e"),
                                               F.count_if(F.col("side") == 1).alias("t_a"))
    grid = rng.select("column_name", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = (grid.join(counts, ["column_name", "bin"], "left").join(totals, "column_name")
            .fillna(0, subset=["n_e", "n_a"]))
    e = F.greatest(F.col("n_e") / F.col("t_e"), F.lit(eps))
    a = F.greatest(F.col("n_a") / F.col("t_a"), F.lit(eps))
    out = full.groupBy("column_name").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    return out.withColumn("drifting", (F.col("psi") >= threshold).cast("int"))


def cramers_v(df: DataFrame, cols: Sequence[str], numeric: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """X9 pairwise association (bias-corrected Cramer's V) for mixed columns.
    Numerics are cut into equal-width bins; all pair contingency tables come
    from ONE exploded (pair, a, b) aggregate; chi-square per pair is summed
    from expected counts. Output one row per ordered column pair."""
    cols = list(cols)
    work = df
    for c in numeric:
        lo, hi = df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar()
        w = (hi - lo) / bins
        work = work.withColumn(c, F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col(c) - lo) / w), F.lit(bins - 1))))
    work = work.select(*[F.col(c).cast("string").alias(c) for c in cols]).na.drop()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    exploded = work.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(a).alias("va"), F.col(b).alias("vb"))
        for a, b in pairs])).alias("p")).select("p.*")
    cell = exploded.groupBy("col_a", "col_b", "va", "vb").agg(F.count(F.lit(1)).alias("o"))
    ra = cell.groupBy("col_a", "col_b", "va").agg(F.sum("o").alias("ra"))
    rb = cell.groupBy("col_a", "col_b", "vb").agg(F.sum("o").alias("rb"))
    n = cell.groupBy("col_a", "col_b").agg(F.sum("o").alias("n"), F.count_distinct("va").alias("r"),
                                           F.count_distinct("vb").alias("k"))
    # chi2 = sum over observed cells of o^2/e  - n  (cells with o = 0 contribute e - 2o + o^2/e -> e, summing to n)
    chi = (cell.join(ra, ["col_a", "col_b", "va"]).join(rb, ["col_a", "col_b", "vb"]).join(n, ["col_a", "col_b"])
           .withColumn("e", F.col("ra") * F.col("rb") / F.col("n"))
           .groupBy("col_a", "col_b", "n", "r", "k").agg((F.sum(F.col("o") * F.col("o") / F.col("e"))).alias("s")))
    phi2 = F.greatest(F.lit(0.0), (F.col("s") - F.col("n")) / F.col("n") - (F.col("k") - 1) * (F.col("r") - 1) / (F.col("n") - 1))
    kc = F.col("k") - F.pow(F.col("k") - 1, 2) / (F.col("n") - 1)
    rc = F.col("r") - F.pow(F.col("r") - 1, 2) / (F.col("n") - 1)
    v = F.sqrt(F.try_divide(phi2, F.least(kc - 1, rc - 1)))
    return chi.select("col_a", "col_b", (F.col("s") - F.col("n")).alias("chi2"), F.coalesce(v, F.lit(0.0)).alias("cramers_v"))


def weak_features(assoc: DataFrame, target: str, threshold: float = 0.05) -> DataFrame:
    """X10 features whose association with the target is <= threshold."""
    a = assoc.where(F.col("col_a") == target).select(F.col("col_b").alias("feature"), "cramers_v")
    b = assoc.where(F.col("col_b") == target).select(F.col("col_a").alias("feature"), "cramers_v")
    return a.unionByName(b).where(F.col("cramers_v") <= threshold)
