"""Skew-safe ordered scan: ranks, running sums, lags, rolling/expanding
means, as-of join and quantiles against pandas / numpy on fixtures where
one key holds a third of the rows, with ties and null keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import joins, windows
from tessera.operators.ordered import quantiles, with_rank


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    keys = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))      # key 0 holds a third of the rows
    pdf = pd.DataFrame({"k": keys.astype("int64"), "t": rng.permutation(n).astype("int64"),
                        "v": np.round(rng.normal(100, 20, n), 2)})
    pdf.loc[rng.choice(n, 50, replace=False), "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))


def test_rank_and_running_sum(spark, skewed):
    pdf, df = skewed
    got = with_rank(df, ["k"], [F.col("t")], sums=["v"], partitions=7).toPandas().sort_values(["k", "t"])
    exp = pdf.sort_values(["k", "t"]).copy()
    exp["rank"] = exp.groupby("k").cumcount()
    exp["cum"] = exp.groupby("k")["v"].transform(lambda s: s.fillna(0).cumsum())
    exp["cnt"] = exp.groupby("k")["v"].transform(lambda s: s.notna().cumsum())
    assert (got["_rank"].to_numpy() == exp["rank"].to_numpy()).all()
    assert np.allclose(got["_cum_v"].astype(float).to_numpy(), exp["cum"].to_numpy())
    assert (got["_cnt_v"].to_numpy() == exp["cnt"].to_numpy()).all()
    assert (got.groupby("k")["_n"].first() == exp.groupby("k").size()).all()


def test_lags_rolling_expanding(spark, skewed):
    pdf, df = skewed
    out = windows.lags(df, ["k"], [F.col("t")], "v", ks=(1, 2), names=["l1", "l2"])
    out = windows.expanding_mean_before(out, ["k"], [F.col("t")], "v", "em")
    out = windows.rolling_mean_before(out, ["k"], [F.col("t")], "v", (3,), ["r3"])
    got = out.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    e = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    g = e.groupby("k")["v"]
    e["l1"], e["l2"] = g.shift(1), g.shift(2)
    e["em"] = g.transform(lambda s: s.expanding().mean().shift(1))
    e["r3"] = g.transform(lambda s: s.rolling(3, min_periods=3).mean().shift(1))
    for c in ["l1", "l2", "em", "r3"]:
        a, b = got[c].astype(float).to_numpy(), e[c].to_numpy()
        assert np.array_equal(np.isnan(a), np.isnan(b)), c
        assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)]), c


def test_asof_strict_ties_and_null_keys(spark):
    left = pd.DataFrame({"id": [1, 2, 3, 4, 5, 6], "k": [1, 1, 1, 2, None, 2], "t": [10, 20, 30, 10, 10, 5]})
    right = pd.DataFrame({"k": [1, 1, 1, 2, None], "rt": [10, 10, 25, 9, 1], "val": [1.0, 2.0, 3.0, 4.0, 5.0]})
    l = spark.createDataFrame(left.astype({"k": "float"})).withColumn("k", F.col("k").cast("bigint")) \
        .withColumn("t", F.timestamp_seconds("t"))
    r = spark.createDataFrame(right.astype({"k": "float"})).withColumn("k", F.col("k").cast("bigint")) \
        .withColumn("rt", F.timestamp_seconds("rt"))
    got = {row["id"]: row["val"] for row in joins.asof_join(l, r, ["k"], "t", "rt", ["val"], strict=True).collect()}
    # id1: t=10, right rows at exactly 10 are excluded (strict) -> none; id2: latest before 20 is t=10, last tie (val 2)
    assert got == {1: None, 2: 2.0, 3: 3.0, 4: 4.0, 5: None, 6: None}
    got2 = {row["id"]: row["val"] for row in joins.asof_join(l, r, ["k"], "t", "rt", ["val"], strict=False).collect()}
    assert got2[1] == 2.0 and got2[4] == 4.0 and got2[5] is None


def test_quantiles_match_numpy(spark, skewed):
    pdf, df = skewed
    got = quantiles(df, "v", [0.1, 0.5, 0.99], keys=["k"], names=["a", "b", "c"]).toPandas().set_index("k").sort_index()
    for k, grp in pdf.dropna().groupby("k"):
        exp = np.percentile(grp["v"], [10, 50, 99])
        assert np.allclose(got.loc[k, ["a", "b", "c"]].astype(float).to_numpy(), exp)
    glob = quantiles(df, "v", [0.25], names=["q"]).collect()[0]["q"]
    assert np.isclose(glob, np.percentile(pdf["v"].dropna(), 25))


def test_quantiles_with_ties(spark):
    """Nine rows of ten hold one value: it is a single row of the ranked frame."""
    v = [7.0] * 900 + list(range(100)) + [None] * 5
    df = spark.createDataFrame([(x if x is None else float(x),) for x in v], "v double").repartition(8)
    probs = [0.0, 0.04, 0.5, 0.95, 0.997, 1.0]
    got = list(quantiles(df, "v", probs, names=list("abcdef"), partitions=8).collect()[0])
    assert np.allclose(got, np.percentile([x for x in v if x is not None], [100 * p for p in probs]))


def test_interval_label_rules(spark):
    cohort = spark.createDataFrame([(1, "2020-01-01"), (1, "2021-06-01"), (2, "2020-01-01"), (3, "2020-03-01"), (3, "2023-06-01")],
                                   "id long, t string").withColumn("t", F.to_date("t"))
    ev = spark.createDataFrame([(1, "2020-12-30", 95), (1, "2021-03-01", 120), (2, "2021-01-01", 90), (3, "2020-02-01", 10),
                                (3, "2024-01-01", 0)], "id long, d string, od int").withColumn("d", F.to_date("d"))
    got = {(r["id"], str(r["t"])): r["target"] for r in joins.interval_label(cohort, ev, "id", "t", "d", "od").collect()}
    # (1, 2021-06-01) dropped: first episode 2020-12-30 precedes it; (2, 2020-01-01): default on day 366 -> 0;
    # (3, 2023-06-01) dropped: later than last event - 365 d.
    assert got == {(1, "2020-01-01"): 1, (2, "2020-01-01"): 0, (3, "2020-03-01"): 0}


def test_null_keys_stay_distinct_from_defaults(spark):
    """NULL keys and the surrogate's stand-in values ('' / 0 / 1970-01-01) are separate groups."""
    import datetime as dt
    rows = [(None, None, None, 1, 1.0), (None, None, None, 2, 2.0), ("", 0, dt.date(1970, 1, 1), 3, 4.0),
            ("", 0, dt.date(1970, 1, 1), 4, 8.0), ("a", 1, dt.date(2020, 1, 1), 5, 16.0)]
    df = spark.createDataFrame(rows, "s string, i int, d date, t int, v double")
    for key in ["s", "i", "d"]:
        got = {r["t"]: (r["_rank"], r["_n"], r["_cum_v"]) for r in with_rank(df, [key], [F.col("t")], sums=["v"]).collect()}
        assert got == {1: (0, 2, 1.0), 2: (1, 2, 3.0), 3: (0, 2, 4.0), 4: (1, 2, 12.0), 5: (0, 1, 16.0)}, key


def test_lags_over_partitions_shorter_than_the_lag(spark, skewed):
    """Range partitions of a few rows: what a row looks back to lies several partitions before it."""
    pdf, df = skewed
    small, part = pdf.head(60), df.limit(60)
    for partitions in (3, 40):
        local = {"l9": lambda w: F.lag("v", 9).over(w), "r9": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-9, -1))}
        got = with_rank(part.withColumn("one", F.lit(1)), ["one"], [F.col("t")], sums=["v"], partitions=partitions, local=local, halo=9).toPandas().sort_values("t")
        e = part.toPandas().sort_values("t")
        want = e["v"].astype(float).shift(9).to_numpy()
        have = got["l9"].astype(float).to_numpy()
        assert np.array_equal(np.isnan(have), np.isnan(want)) and np.allclose(have[~np.isnan(have)], want[~np.isnan(want)])
        assert list(got["r9"]) == [min(i, 9) for i in range(60)] and list(got["_rank"]) == list(range(60))
        assert np.allclose(got["_cum_v"].astype(float), e["v"].astype(float).fillna(0).cumsum())
    assert len(small) == 60


def test_asof_with_a_hot_key_over_many_partitions(spark):
    """One key with a third of the rows, whose last right row lies many partitions before most left rows."""
    rng = np.random.default_rng(8)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = pd.DataFrame({"id": np.arange(400), "k": np.where(np.arange(400) < 250, 1, rng.integers(2, 9, 400)), "t": rng.integers(0, 1000, 400)})
        right = pd.DataFrame({"k": [1, 1, 1, *rng.integers(2, 12, 40)], "rt": [2, 300, 301, *rng.integers(0, 1000, 40)], "val": np.arange(43)})
        l, r = (spark.createDataFrame(x).withColumn(c, F.timestamp_seconds(c)) for x, c in ((left, "t"), (right, "rt")))
        got = {x["id"]: x["val"] for x in joins.asof_join(l, r, ["k"], "t", "rt", ["val"], strict=True).collect()}
        for x in left.itertuples():
            before = right[(right["k"] == x.k) & (right["rt"] < x.t)].sort_values(["rt", "val"])
            assert got[x.id] == (before["val"].iloc[-1] if len(before) else None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sessions_touching_two_days(spark):
    from tessera.operators.features import sessions_per_active_day
    ev = [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:29:59"), (1, "2024-01-01 10:59:59"), (1, "2024-01-01 23:50:00"), (1, "2024-01-02 00:10:00"),
          (1, "2024-01-02 00:39:00"), (2, "2024-01-05 00:00:00")]
    df = spark.createDataFrame(ev, "u long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r["u"]: r["sessions_per_day"] for r in sessions_per_active_day(df, "u", "ts").collect()}
    assert got == {1: (3 + 1) / 2, 2: 1.0}   # the second gap is exactly 30 minutes; one session lasts over midnight
