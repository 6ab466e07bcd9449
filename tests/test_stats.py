"""Metrics, experiment statistics and cleaning helpers against brute force."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.functions.columns import normal_cdf, sig_round
from tessera.operators import clean, experiments as X, metrics as K


def test_normal_cdf_close_to_exact(spark):
    zs = [-4.0, -1.96, -0.5, 0.0, 0.3, 1.0, 2.5]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(normal_cdf("z")).collect()]
    for z, g in zip(zs, got):
        assert abs(g - NormalDist().cdf(z)) < 1e-6


def test_auc_ap_against_pairs(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400) * 0.5 + y * 0.2, 2)             # rounded -> many ties
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    auc = K.roc_auc(df, "y", "p").collect()[0][0]
    pos, neg = p[y == 1], p[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(auc, brute, rel_tol=1e-12)
    ap = K.average_precision(df, "y", "p").collect()[0][0]
    order = np.argsort(-p, kind="stable")
    thr = np.unique(p)[::-1]
    prev_r, exp = 0.0, 0.0
    for t in thr:
        sel = p >= t
        tp = (y[sel] == 1).sum()
        prec, rec = tp / sel.sum(), tp / (y == 1).sum()
        exp += (rec - prev_r) * prec
        prev_r = rec
    assert math.isclose(ap, exp, rel_tol=1e-12)


def test_threshold_sweep_matches_rescans(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 3)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    sw = K.approval_sweep(df, "y", "p").toPandas().set_index("threshold")
    for k in [0, 1, 250, 500, 999, 1000]:
        t = k / 1000.0
        appr = p <= t
        assert math.isclose(sw.loc[t, "approval_rate"], appr.mean())
        exp_d = (y[appr] == 1).sum() / appr.sum() if appr.sum() else 0.0
        assert math.isclose(sw.loc[t, "default_rate"], exp_d)


def test_psi_identical_is_zero(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"))
    assert abs(X.psi(df, df, ["x"]).collect()[0]["psi"]) < 1e-12


def test_prop_ztest_symmetry(spark):
    rows = [("A", 1)] * 30 + [("A", 0)] * 70 + [("B", 1)] * 40 + [("B", 0)] * 60
    df = spark.createDataFrame(rows, "arm string, s int")
    r = X.prop_ztest(df, "arm", "s", alternative="smaller").collect()[0]
    pa, pb, pool = 0.3, 0.4, 0.35
    z = (pa - pb) / math.sqrt(pool * (1 - pool) * (2 / 100))
    assert math.isclose(r["z_stat"], z, rel_tol=1e-12)
    assert abs(r["p_value"] - NormalDist().cdf(z)) < 1e-6


def test_packed_hour_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("95010203",), ("14123123",), ("bad",)], "h string")
    got = [(str(r["h_date"]), r["h_hour"]) for r in clean.parse_packed_hour(df, "h").collect()]
    assert got == [("1995-01-02", 3), ("2014-12-31", 23), ("None", None)]


def test_dedup_first_keeps_first_in_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "x")], "k int, o int, v string")
    got = sorted((r["k"], r["v"]) for r in clean.dedup_first(df, ["k"], ["o"]).collect())
    assert got == [(1, "a"), (2, "x")]


def test_sig_round_is_stable(spark):
    df = spark.createDataFrame([(0.1 + 0.2,), (0.3,), (123456.78901234567,), (0.0,), (None,)], "x double")
    got = [r[0] for r in df.select(sig_round("x")).collect()]
    assert got[0] == got[1] and got[3] == 0.0 and got[4] is None


def test_ab_plan_matches_published_sample_size(spark):
    """BASELINE: 82 082 users for p = 0.3, relative MDE 3 %, alpha .05, power .8."""
    import datetime as dt
    rows = [(u, dt.date(2024, 1, 1 + u % 3), 1 + u % 6) for u in range(60)]
    s = spark.createDataFrame(rows, "user_id int, session_date date, page_counter int")
    plan = X.ab_plan(s, s, date="session_date", user="user_id", pages="page_counter", base=0.3).first()
    assert plan["sample_size_per_arm"] * 2 == 82082
