"""Registered queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (whole tables, no row caps) through the
role views of ``tessera.plans.domains`` and finishes with ``finish`` so that
doubles are rounded, integers widened and times rendered as text - the same
normalisation the oracle SQL applies.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import round_doubles
from tessera.plans import domains as D
from tessera.operators import clean, experiments as X, features, joins, marts, metrics as K, linear, models as G, neighbors, prep, profile, reports as R, selection, splits as M, windows

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = 12) -> DataFrame:
    """Render dates as yyyy-MM-dd, timestamps as yyyy-MM-dd HH:mm:ss, round doubles
    to significant digits, widen integers."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if t == "date":
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        elif t.startswith("timestamp"):
            cols.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(c)
    return round_doubles(df.select(*cols), digits)


# ------------------------------------------------------------------ marketplace mart

@query("customer_mart")
def q_customer_mart(spark, base):
    return finish(D.market_mart(D.Tables(spark, base)))


@query("order_segments")
def q_order_segments(spark, base):
    return finish(marts.order_segments(D.market_mart(D.Tables(spark, base))))


@query("top_customers")
def q_top_customers(spark, base):
    return finish(marts.top_customers(D.market_mart(D.Tables(spark, base)), k=15, min_orders=3))


@query("region_report")
def q_region_report(spark, base):
    return finish(marts.region_report(D.market_mart(D.Tables(spark, base))))


@query("first_month_cohort")
def q_first_month_cohort(spark, base):
    return finish(marts.first_month_cohort(D.market_mart(D.Tables(spark, base)), year=1995))


# ------------------------------------------------------------------ game database

@query("payer_share")
def q_payer_share(spark, base):
    return finish(marts.payer_share(D.game_users(D.Tables(spark, base))))


@query("payer_share_by_race")
def q_payer_share_by_race(spark, base):
    t = D.Tables(spark, base)
    return finish(marts.payer_share_by(D.game_users(t), D.game_race(t), "race_id", "race"))


@query("global_stats")
def q_global_stats(spark, base):
    return finish(marts.global_stats(D.game_events(D.Tables(spark, base)), "amount"))


@query("zero_share")
def q_zero_share(spark, base):
    return finish(marts.zero_share(D.game_events(D.Tables(spark, base)), "amount"))


@query("item_popularity")
def q_item_popularity(spark, base):
    t = D.Tables(spark, base)
    return finish(marts.item_popularity(D.game_events(t), D.game_items(t), "item_code", "game_items", "id", "amount"))


@query("group_activity")
def q_group_activity(spark, base):
    t = D.Tables(spark, base)
    return finish(marts.group_activity(D.game_users(t), D.game_events(t), D.game_race(t), user_key="id",
                                       group_key="race_id", group_name="race", amount_col="amount"))


# ------------------------------------------------------------------ time-aware core

@query("ts_lags")
def q_ts_lags(spark, base):
    p = D.weekly_panel(D.Tables(spark, base))
    return finish(windows.lags(p, ["store", "dept"], [F.col("date")], "weekly_sales", ks=(1, 2, 4),
                               names=["sales_1week_ago", "sales_2week_ago", "sales_4week_ago"]))


@query("ts_expanding_mean")
def q_ts_expanding(spark, base):
    p = D.weekly_panel(D.Tables(spark, base))
    return finish(windows.expanding_mean_before(p, ["store", "dept"], [F.col("date")], "weekly_sales", "avg_sales_before"))


@query("ts_rolling_mean")
def q_ts_rolling(spark, base):
    p = D.weekly_panel(D.Tables(spark, base))
    return finish(windows.rolling_mean_before(p, ["store", "dept"], [F.col("date")], "weekly_sales", (2, 4),
                                              ["mean_sales_2week", "mean_sales_4week"]))


@query("ts_features")
def q_ts_features(spark, base):
    p = D.weekly_panel(D.Tables(spark, base))
    return finish(windows.time_series_features(p, ["store", "dept"], "date", "weekly_sales"))


@query("lag_gap_days")
def q_lag_gap_days(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_dt"))
    return finish(windows.gap_days(o, ["o_custkey"], [F.col("order_dt"), F.col("o_orderkey")], "order_dt"))


@query("asof_join")
def q_asof_join(spark, base):
    t = D.Tables(spark, base)
    left = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    right = D.shipments(t).select("o_custkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    out = joins.asof_join(left, right, by=["o_custkey"], left_on="o_orderdate", right_on="l_shipdate",
                          right_cols=["l_orderkey", "l_linenumber", "l_extendedprice"], strict=True)
    return finish(out)


@query("interval_label")
def q_interval_label(spark, base):
    t = D.Tables(spark, base)
    cohort = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("score_date"))
    events = D.shipments(t).select("o_custkey", "l_shipdate", "overdue_days")
    return finish(joins.interval_label(cohort, events, "o_custkey", "score_date", "l_shipdate", "overdue_days",
                                       threshold=90, horizon_days=365))


# ------------------------------------------------------------------ profiling and data quality

@query("null_share")
def q_null_share(spark, base):
    return finish(profile.null_share(D.customer_activity(D.Tables(spark, base))))


@query("profile_counts")
def q_profile_counts(spark, base):
    return finish(profile.profile(D.customer_activity(D.Tables(spark, base))))


@query("describe_numeric")
def q_describe(spark, base):
    li = D.Tables(spark, base).lineitem
    return finish(profile.describe(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("null_share_by")
def q_null_share_by(spark, base):
    return finish(profile.null_share_by(D.customer_activity(D.Tables(spark, base)), "n_events", "c_mktsegment"))


@query("dup_count_key")
def q_dup_count_key(spark, base):
    return finish(profile.dup_count(D.Tables(spark, base).lineitem, ["l_orderkey", "l_linenumber"]))


@query("dup_count_rows")
def q_dup_count_rows(spark, base):
    return finish(profile.dup_count(D.Tables(spark, base).lineitem))


@query("cardinality")
def q_cardinality(spark, base):
    return finish(profile.cardinality(D.Tables(spark, base).orders, n=300))


@query("date_span")
def q_date_span(spark, base):
    return finish(profile.date_span(D.Tables(spark, base).orders, "o_orderdate"))


@query("value_counts")
def q_value_counts(spark, base):
    return finish(profile.value_counts(D.Tables(spark, base).orders, "o_orderpriority"))


@query("key_overlap")
def q_key_overlap(spark, base):
    t = D.Tables(spark, base)
    return finish(joins.key_overlap_join(t.orders.select(F.col("o_custkey").alias("k")),
                                         t.events.select(F.col("user_id").alias("k")), "k"))


@query("removal_report")
def q_removal_report(spark, base):
    o = D.Tables(spark, base).orders
    after = clean.trim_percentile(o, "o_totalprice", 0.99).where(F.col("o_totalprice") > 0)
    return finish(profile.removal_report(o, after))


# ------------------------------------------------------------------ cleaning

@query("fill_group_mean")
def q_fill_group_mean(spark, base):
    ca = D.customer_activity(D.Tables(spark, base))
    out = clean.fill_group_mean(ca, "n_events", ["c_mktsegment"], name="n_events_filled")
    return finish(out.select("c_custkey", "c_mktsegment", "n_events", "n_events_filled"))


@query("dedup_first")
def q_dedup_first(spark, base):
    ev = D.Tables(spark, base).events
    return finish(clean.dedup_first(ev, ["user_id"], ["ts", "event_id"]))


@query("trim_percentile")
def q_trim_percentile(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", "o_totalprice")
    return finish(clean.trim_percentile(o, "o_totalprice", 0.99))


@query("iqr_outliers")
def q_iqr_outliers(spark, base):
    return finish(clean.iqr_outliers(D.Tables(spark, base).lineitem, "l_extendedprice"))


@query("calendar_parts")
def q_calendar_parts(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", "o_orderdate")
    return finish(clean.calendar_parts(o, "o_orderdate"))


@query("packed_time")
def q_packed_time(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", F.date_format("o_orderdate", "yyMMddHH").alias("hour_code"))
    return finish(clean.parse_packed_hour(o, "hour_code"))


@query("currency_convert")
def q_currency_convert(spark, base):
    t = D.Tables(spark, base)
    p = D.purchases(t).select("order_id", "created_dt", "currency_code", "revenue")
    return finish(clean.currency_convert(p, D.daily_rates(t), "created_dt", "revenue", "currency_code", D.FOREIGN))


# ------------------------------------------------------------------ point-in-time batch features

@query("batch_features")
def q_batch_features(spark, base):
    t = D.Tables(spark, base)
    cust = t.customer.select(F.col("c_custkey").alias("customer_id"))
    out = features.batch_features(cust, "customer_id", D.web_events(t), D.web_sessions(t), D.web_orders(t),
                                  run_date=D.RUN_DATE, ev_ts="timestamp", ev_type="event_type", ev_product="product_id",
                                  session_key="session_id", s_start="start_time", s_end="end_time",
                                  o_ts="order_time", o_amount="total_usd")
    return finish(out)


@query("pivot_counts")
def q_pivot_counts(spark, base):
    ev = D.Tables(spark, base).events
    types = ["view", "click", "purchase", "signup", "error"]
    return finish(clean.row_share(features.pivot_counts(ev, "user_id", "event_type", types, prefix="n_"),
                                  [f"n_{v}" for v in types]))


# ------------------------------------------------------------------ A/B test

def _first(t):
    return X.first_sessions(D.ab_sessions(t), "user_id", ["session_start_ts", "session_id"])


@query("top_user_sessions")
def q_top_user_sessions(spark, base):
    return finish(X.top_user_sessions(D.ab_sessions(D.Tables(spark, base)), "user_id", "session_id"))


@query("daily_users")
def q_daily_users(spark, base):
    return finish(X.daily_users(D.ab_sessions(D.Tables(spark, base)), "session_date", "user_id", "registration_flag"))


@query("page_distribution")
def q_page_distribution(spark, base):
    return finish(X.page_distribution(_first(D.Tables(spark, base)), "page_counter"))


@query("daily_success")
def q_daily_success(spark, base):
    return finish(X.daily_success(_first(D.Tables(spark, base)), "session_date", "page_counter", 4))


@query("ab_plan")
def q_ab_plan(spark, base):
    t = D.Tables(spark, base)
    return finish(X.ab_plan(_first(t), D.ab_sessions(t), date="session_date", user="user_id", pages="page_counter"))


@query("arm_sizes")
def q_arm_sizes(spark, base):
    return finish(X.arm_sizes_day_one(D.ab_sessions(D.Tables(spark, base)), "session_date", "test_group", "user_id"))


@query("arm_balance")
def q_arm_balance(spark, base):
    return finish(X.arm_balance(_first(D.Tables(spark, base)), "test_group", "device"))


@query("metric_per_arm")
def q_metric_per_arm(spark, base):
    f = _first(D.Tables(spark, base)).withColumn("success", (F.col("page_counter") >= 4).cast("int"))
    return finish(X.metric_per_arm(f, "test_group", "success"))


@query("prop_ztest")
def q_prop_ztest(spark, base):
    f = _first(D.Tables(spark, base)).withColumn("success", (F.col("page_counter") >= 4).cast("int"))
    return finish(X.prop_ztest(f, "test_group", "success", alternative="smaller"))


@query("psi")
def q_psi(spark, base):
    li = D.Tables(spark, base).lineitem
    cut = F.lit("1998-01-01").cast("timestamp")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return finish(X.psi(li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut), cols))


@query("cramers_v")
def q_cramers_v(spark, base):
    c = D.Tables(spark, base).customer
    return finish(X.cramers_v(c, ["c_mktsegment", "c_nationkey", "c_acctbal"], numeric=["c_acctbal"]))


# ------------------------------------------------------------------ metrics

def _scored(spark, base):
    return D.scored_orders(D.Tables(spark, base))


def _priced(spark, base):
    return D.priced_orders(D.Tables(spark, base))


@query("regression_metrics")
def q_regression_metrics(spark, base):
    return finish(K.regression_metrics(_priced(spark, base), "y", "pred"))


@query("mape")
def q_mape(spark, base):
    return finish(K.mape(_priced(spark, base), "y", "pred"))


@query("pricing_risk")
def q_pricing_risk(spark, base):
    return finish(K.pricing_risk(_priced(spark, base), "y", "pred", band=0.2))


@query("cv_summary")
def q_cv_summary(spark, base):
    per_fold = K.regression_metrics(_priced(spark, base), "y", "pred", by=["fold"])
    return finish(K.cv_summary(per_fold, ["rmse", "mae", "r2"]))


@query("confusion")
def q_confusion(spark, base):
    s = _scored(spark, base).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return finish(K.confusion(s, "y", "pred"))


@query("binary_scores")
def q_binary_scores(spark, base):
    s = _scored(spark, base).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return finish(K.binary_scores(s, "y", "pred"))


@query("classification_report")
def q_classification_report(spark, base):
    s = _scored(spark, base).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    return finish(K.classification_report(s, "y", "pred"))


@query("roc_auc")
def q_roc_auc(spark, base):
    return finish(K.roc_auc(_scored(spark, base), "y", "p"))


@query("average_precision")
def q_average_precision(spark, base):
    return finish(K.average_precision(_scored(spark, base), "y", "p"))


@query("pr_curve")
def q_pr_curve(spark, base):
    return finish(K.pr_curve(_scored(spark, base), "y", "p"))


@query("log_loss_brier")
def q_log_loss_brier(spark, base):
    return finish(K.log_loss_brier(_scored(spark, base), "y", "p"))


@query("calibration_curve")
def q_calibration_curve(spark, base):
    return finish(K.calibration_curve(_scored(spark, base), "y", "p"))


@query("ece_mce")
def q_ece_mce(spark, base):
    return finish(K.ece_mce(_scored(spark, base), "y", "p"))


@query("threshold_sweep")
def q_threshold_sweep(spark, base):
    return finish(K.approval_sweep(_scored(spark, base), "y", "p"))


@query("approval_threshold")
def q_approval_threshold(spark, base):
    sweep = K.approval_sweep(_scored(spark, base), "y", "p")
    return finish(K.choose_approval_threshold(sweep, min_approval=0.3, max_default=0.35, max_missed=0.5))


@query("revenue_sweep")
def q_revenue_sweep(spark, base):
    return finish(K.revenue_sweep(_scored(spark, base), "y", "p"))


@query("best_revenue_threshold")
def q_best_revenue_threshold(spark, base):
    return finish(K.best_revenue_threshold(K.revenue_sweep(_scored(spark, base), "y", "p")))


@query("approval_at")
def q_approval_at(spark, base):
    return finish(K.approval_at(_scored(spark, base), "y", "p", 0.5))


@query("business_effect")
def q_business_effect(spark, base):
    return finish(K.business_effect(_scored(spark, base), "y", "p", 0.415))


# ------------------------------------------------------------------ ticket purchases (AFI)

def _profile(spark, base):
    return R.user_profile(D.purchases(D.Tables(spark, base)))


@query("monthly_revenue")
def q_monthly_revenue(spark, base):
    return finish(R.monthly_total(D.purchases(D.Tables(spark, base)), "created_dt", "revenue"))


@query("revenue_by_device")
def q_revenue_by_device(spark, base):
    return finish(R.mean_median_by(D.purchases(D.Tables(spark, base)), ["device_type"], "revenue"))


@query("user_profile")
def q_user_profile(spark, base):
    return finish(_profile(spark, base))


@query("kpi_sheet")
def q_kpi_sheet(spark, base):
    return finish(R.kpi_sheet(_profile(spark, base)))


@query("return_split")
def q_return_split(spark, base):
    return finish(R.return_split(_profile(spark, base), "first_device_type"))


@query("return_share")
def q_return_share(spark, base):
    return finish(R.return_share_by(_profile(spark, base), "first_region_name"))


@query("return_by_segment")
def q_return_by_segment(spark, base):
    return finish(R.return_by_segment(_profile(spark, base)))


@query("weekday_return")
def q_weekday_return(spark, base):
    return finish(R.return_by_weekday(_profile(spark, base)))


@query("histogram")
def q_histogram(spark, base):
    return finish(R.histogram(D.purchases(D.Tables(spark, base)), "revenue", 10, by=["device_type"]))


@query("box_stats")
def q_box_stats(spark, base):
    return finish(R.box_stats(D.purchases(D.Tables(spark, base)), "revenue", ["service_name"]))


# ------------------------------------------------------------------ places and games

@query("category_counts")
def q_category_counts(spark, base):
    return finish(R.counts_by(D.places(D.Tables(spark, base)), ["district", "category"]))


@query("chain_share")
def q_chain_share(spark, base):
    return finish(R.flag_share_by(D.places(D.Tables(spark, base)), "category", "chain"))


@query("topk_groups")
def q_topk_groups(spark, base):
    return finish(R.top_groups(D.places(D.Tables(spark, base)), "name", 15, "rating"))


@query("bill_by_district")
def q_bill_by_district(spark, base):
    return finish(R.mean_median_by(D.places(D.Tables(spark, base)), ["district"], "avg_bill"))


@query("grade_shares")
def q_grade_shares(spark, base):
    g = D.games(D.Tables(spark, base))
    return finish(R.grades_side_by_side(g, "critic_score", D.CRITIC_BANDS, "user_score", D.USER_BANDS))


@query("top_platforms")
def q_top_platforms(spark, base):
    return finish(R.top_groups(D.games(D.Tables(spark, base)), "platform", 7))


# ------------------------------------------------------------------ other grouped reports

@query("monthly_rating")
def q_monthly_rating(spark, base):
    li = D.Tables(spark, base).lineitem.select("l_shipdate", (F.col("l_quantity") / 10.0).alias("rating"))
    return finish(R.monthly_mean_min_count(li, "l_shipdate", "rating", 10))


@query("yearly_overdue")
def q_yearly_overdue(spark, base):
    return finish(R.yearly_mean(D.shipments(D.Tables(spark, base)), "l_shipdate", "overdue_days"))


@query("top_sales_mean")
def q_top_sales_mean(spark, base):
    return finish(R.top_share_mean(D.weekly_panel(D.Tables(spark, base)), "weekly_sales", ["store"], 0.99))


@query("cluster_profile")
def q_cluster_profile(spark, base):
    e = D.Tables(spark, base).embeddings.select("label", *[F.col("embedding").getItem(i).alias(f"e{i}") for i in range(64)])
    return finish(R.cluster_profile(e, "label", [f"e{i}" for i in range(64)]))


@query("error_profile")
def q_error_profile(spark, base):
    t = D.Tables(spark, base)
    reg = D.customer_region(t).select(F.col("c_custkey").alias("o_custkey"), "r_name")
    pr = D.priced_orders(t).join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").join(reg, "o_custkey")
    return finish(R.error_profile(pr, "y", "pred", ["r_name"]))


# ------------------------------------------------------------------ splits and preparation

@query("stratified_split")
def q_stratified_split(spark, base):
    d = D.doc_features(D.Tables(spark, base))
    s = M.stratified_split(d, "quality", ["doc_id"], 0.2)
    return finish(s.groupBy("split", "quality").agg(F.count(F.lit(1)).alias("n")))


@query("stratified_folds")
def q_stratified_folds(spark, base):
    d = D.doc_features(D.Tables(spark, base))
    s = M.stratified_kfold_column(d, "quality", ["doc_id"], 5)
    return finish(s.groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("n")))


@query("hash_split")
def q_hash_split(spark, base):
    o = D.Tables(spark, base).orders
    return finish(M.hash_split(o, ["o_orderkey"], [0.6, 0.2, 0.2], ["train", "val", "test"])
                  .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


@query("group_split_leakage")
def q_group_split_leakage(spark, base):
    o = M.group_split(D.Tables(spark, base).orders, ["o_custkey"], [0.8, 0.2], ["train", "test"])
    return finish(profile.split_leakage({"train": o.where("split = 'train'"), "test": o.where("split = 'test'")}, "o_custkey"))


@query("hash_split_rows")
def q_hash_split_rows(spark, base):
    return finish(M.hash_split(D.Tables(spark, base).orders, ["o_orderkey"], [0.6, 0.2, 0.2], ["train", "val", "test"]).select("o_orderkey", "split"))


@query("stratified_split_rows")
def q_stratified_split_rows(spark, base):
    return finish(M.stratified_split(D.labelled(D.Tables(spark, base)), "quality", ["doc_id"], 0.2).select("doc_id", "quality", "split"))


@query("stratified_fold_rows")
def q_stratified_fold_rows(spark, base):
    return finish(M.stratified_kfold_column(D.labelled(D.Tables(spark, base)), "quality", ["doc_id"], 5).select("doc_id", "quality", "fold"))


@query("resample_rows")
def q_resample_rows(spark, base):
    r = M.resample_ratio(D.labelled(D.Tables(spark, base)), "toxic", ["doc_id"], over_ratio=0.3, under_ratio=0.6, minority=1)
    return finish(r.groupBy("doc_id", "toxic").agg(F.count(F.lit(1)).alias("copies")))


@query("row_split_leakage")
def q_row_split_leakage(spark, base):
    """A split by order, which parts a customer's orders: the leakage that a split by customer avoids."""
    o = M.hash_split(D.Tables(spark, base).orders, ["o_orderkey"], [0.8, 0.1, 0.1], ["train", "val", "test"])
    return finish(profile.split_leakage({n: o.where(F.col("split") == n) for n in ("train", "val", "test")}, "o_custkey"))


@query("time_split")
def q_time_split(spark, base):
    o = D.Tables(spark, base).orders.withColumn("d", F.col("o_orderdate").cast("date"))
    s = M.time_split(o, "d", ["1999-08-01", "2000-08-01"], ["train", "calib", "test"])
    return finish(s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first_date"), F.max("d").alias("last_date")))


@query("time_fraction_split")
def q_time_fraction_split(spark, base):
    o = D.Tables(spark, base).orders
    s = M.time_fraction_split(o, "o_orderdate", [0.6, 0.2, 0.2], ["train", "val", "test"])
    return finish(s.groupBy("split").agg(F.count(F.lit(1)).alias("n")))


@query("time_folds")
def q_time_folds(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    rows = None
    for i, (tr, te) in enumerate(M.expanding_time_folds(o, "d", 3)):
        r = tr.agg(F.count(F.lit(1)).alias("train_rows")).withColumn("test_rows", te.agg(F.count(F.lit(1))).scalar()) \
              .withColumn("fold", F.lit(i))
        rows = r if rows is None else rows.unionByName(r)
    return finish(rows)


@query("resample")
def q_resample(spark, base):
    d = D.doc_features(D.Tables(spark, base))
    r = M.resample_ratio(d, "toxic", ["doc_id"], over_ratio=0.3, under_ratio=0.6, minority=1)
    return finish(r.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")))


@query("class_weights")
def q_class_weights(spark, base):
    d = D.doc_features(D.Tables(spark, base))
    return finish(M.balanced_weights(d, "quality").select("doc_id", "quality", "weight"))


@query("target_encoding")
def q_target_encoding(spark, base):
    s = D.scored_orders(D.Tables(spark, base)).join(D.Tables(spark, base).orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    train = s.where(F.col("fold") != 0).withColumn("split", F.lit("train"))
    test = s.where(F.col("fold") == 0).withColumn("split", F.lit("test"))
    tr, te = prep.target_encode(train, [test], ["o_orderpriority"], "y", smoothing=10.0)
    return finish(tr.unionByName(te).select("o_orderkey", "split", "o_orderpriority", "o_orderpriority_te"))


@query("tfidf_terms")
def q_tfidf_terms(spark, base):
    d = prep.text_tokens(D.Tables(spark, base).documents.select("doc_id", "text"), "text")
    (out,) = prep.tfidf_top_terms(d, [], "tokens", vocab=5)
    from pyspark.ml.functions import vector_to_array
    return finish(out.select("doc_id", vector_to_array("tfidf").alias("tfidf")))


# ------------------------------------------------------------------ model jobs (rows-only checks)

def _doc_split(spark, base):
    d = D.doc_features(D.Tables(spark, base)).persist()   # whole-text features: range sampling + shuffle read it twice
    s = M.stratified_split(d, "quality", ["doc_id"], 0.25)
    pipe = prep.column_routing(s, numeric=D.DOC_NUMERIC, onehot=["lang"])
    model = pipe.fit(s.where("split = 'train'"))
    data = model.transform(s).checkpoint()       # cut the text-parsing lineage before iterative fits
    d.unpersist()
    return data.where("split = 'train'"), data.where("split = 'test'")


def _clf_metrics(pred: DataFrame, label: str = "quality", score: str = "p1") -> DataFrame:
    auc = K.roc_auc(pred, label, score).withColumnRenamed("roc_auc", "roc_auc")
    ap = K.average_precision(pred, label, score)
    f1 = K.binary_scores(pred.withColumn("_yp", F.col("prediction").cast("int")).withColumn("_y", F.col(label).cast("int")), "_y", "_yp")
    return auc.withColumn("average_precision", ap.select("average_precision").scalar()) \
              .withColumn("f1", f1.select("f1").scalar()).withColumn("accuracy", f1.select("accuracy").scalar())


def _p1(df):
    from pyspark.ml.functions import vector_to_array
    return df.withColumn("p1", vector_to_array("probability")[1])


@query("doc_quality_models")
def q_doc_quality_models(spark, base):
    train, test = _doc_split(spark, base)
    train = M.balanced_weights(train, "quality")
    rows = {}
    for name, est in [("logistic", G.logistic(label="quality", reg=0.01, weight="weight", maxIter=30)),
                      ("random_forest", G.random_forest(label="quality", trees=10, depth=5, weight="weight")),
                      ("gbt", G.gbt_classifier(label="quality", iters=5, depth=3))]:
        rows[name] = _clf_metrics(_p1(est.fit(train).transform(test)))
    svc = G.linear_svc(label="quality", weight="weight").setMaxIter(30).fit(train)
    rows["linear_svc"] = _clf_metrics(G.score(test, svc, out="p1"))
    base_pred = G.baseline(train, [test], "quality", kind="mode")[1]
    rows["majority"] = _clf_metrics(base_pred.withColumn("p1", F.col("prediction").cast("double")))
    return finish(G.comparison_table(rows))


@query("grid_search")
def q_grid_search(spark, base):
    train, _ = _doc_split(spark, base)
    train = M.stratified_kfold_column(train, "quality", ["doc_id"], 3)
    lr = G.logistic(label="quality", maxIter=30)
    from pyspark.ml.tuning import ParamGridBuilder
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 1.0]).build()
    ev = G.BinaryClassificationEvaluator(labelCol="quality", metricName="areaUnderROC")
    _, res = G.grid_search(lr, grid, ev, train, fold_col="fold", parallelism=4)
    return finish(res)


@query("calibration")
def q_calibration(spark, base):
    train, test = _doc_split(spark, base)
    m = G.random_forest(label="quality", trees=20, depth=5).fit(train)
    scored = _p1(m.transform(test))
    halves = M.hash_split(scored, ["doc_id"], [0.5, 0.5], ["calib", "held"], seed=7)
    calib, held = halves.where("split = 'calib'"), halves.where("split = 'held'")
    _, cal = G.isotonic_calibrate(calib, [held], "p1", "quality")
    before = K.ece_mce(held, "quality", "p1").select(F.lit("raw").alias("scores"), "*")
    after = K.ece_mce(cal, "quality", "calibrated").select(F.lit("isotonic").alias("scores"), "*")
    return finish(before.unionByName(after))


@query("kmeans_elbow")
def q_kmeans_elbow(spark, base):
    from pyspark.ml.functions import array_to_vector
    e = D.Tables(spark, base).embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    table, _ = G.kmeans_elbow(e, "features", [2, 4, 6, 8, 10])
    return finish(table)


@query("cluster_feature")
def q_cluster_feature(spark, base):
    from pyspark.ml.functions import array_to_vector
    e = D.Tables(spark, base).embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    e = M.hash_split(e, ["vec_id"], [0.8, 0.2], ["train", "test"])
    tr, te = G.cluster_feature(e.where("split = 'train'"), [e.where("split = 'test'")], "features", k=10)
    both = tr.unionByName(te)
    return finish(R.cluster_profile(both.withColumn("label_d", F.col("label").cast("double")), "cluster", ["label_d"]))


def _neighbours(spark, base, weights, metric):
    e = M.hash_split(D.Tables(spark, base).embeddings, ["vec_id"], [0.8, 0.2], ["train", "test"])
    pred = neighbors.knn_regress(e.where("split = 'train'"), e.where("split = 'test'"), "embedding", "label", "vec_id", k=5, weights=weights, metric=metric)
    return finish(pred.join(e.select("vec_id", F.col("label").cast("double").alias("y")), "vec_id"), digits=9)


@query("knn_regression")
def q_knn_regression(spark, base):
    return _neighbours(spark, base, "distance", "euclidean")


@query("knn_manhattan")
def q_knn_manhattan(spark, base):
    return _neighbours(spark, base, "uniform", "manhattan")


@query("multiclass_ovo")
def q_multiclass_ovo(spark, base):
    t = D.Tables(spark, base)
    d = t.documents.select("doc_id", "lang", F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
                           F.try_divide(F.length(F.regexp_replace("text", "[^\\p{IsLatin}]", "")).cast("double"), F.col("n_chars").cast("double")).alias("latin_share"),
                           F.try_divide(F.length(F.regexp_replace("text", "[^éèêàçùâîôûëïü]", "")).cast("double"), F.col("n_chars").cast("double")).alias("accent_share"))
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    d = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(d).transform(d)
    d = VectorAssembler(inputCols=["log_chars", "latin_share", "accent_share"], outputCol="features", handleInvalid="keep").transform(d)
    d = M.hash_split(d, ["doc_id"], [0.75, 0.25], ["train", "test"]).checkpoint()
    classes = [r[0] for r in d.select("label").distinct().orderBy("label").collect()]
    from pyspark.ml.classification import LinearSVC
    pred = G.one_vs_one(d.where("split = 'train'"), d.where("split = 'test'"), classes, make=lambda: LinearSVC(maxIter=10))
    return finish(K.classification_report(pred, "label", "prediction"))


@query("regression_models")
def q_regression_models(spark, base):
    t = D.Tables(spark, base)
    li = (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
          .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size"), "l_partkey"))
    li = M.hash_split(li, ["l_orderkey", "l_linenumber", "l_partkey"], [0.8, 0.2], ["train", "test"])
    from pyspark.ml.feature import VectorAssembler
    feats = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
    li = G.dealt(li.select(*feats, "l_extendedprice", "split"))
    li = VectorAssembler(inputCols=feats, outputCol="features").transform(li).select("features", "l_extendedprice", "split").checkpoint()
    tr, te = li.where("split = 'train'"), li.where("split = 'test'")
    rows = {}
    for name, est in [("ols", G.LinearRegression(labelCol="l_extendedprice")),
                      ("ridge", G.LinearRegression(labelCol="l_extendedprice", regParam=1.0, elasticNetParam=0.0)),
                      ("lasso", G.LinearRegression(labelCol="l_extendedprice", regParam=1.0, elasticNetParam=1.0)),
                      ("huber", G.huber(label="l_extendedprice")),
                      ("tree", G.decision_tree(label="l_extendedprice", depth=6)),
                      ("gbt", G.gbt_regressor(label="l_extendedprice", iters=8, depth=4))]:
        rows[name] = K.regression_metrics(est.fit(tr).transform(te), "l_extendedprice", "prediction")
    (bp,) = G.baseline(tr, [te], "l_extendedprice")[1:]
    rows["mean_baseline"] = K.regression_metrics(bp, "l_extendedprice", "prediction")
    return finish(G.comparison_table(rows))


@query("alpha_grid")
def q_alpha_grid(spark, base):
    li = D.Tables(spark, base).lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_extendedprice")
    li = M.hash_split(li, ["l_orderkey"], [0.8, 0.2], ["train", "test"])
    feats = ["l_quantity", "l_discount"]
    fits = linear.alpha_grid(li.where("split = 'train'"), feats, "l_extendedprice", (0.1, 10.0, 1000.0, 100000.0))
    out = linear.alpha_grid_scores(fits, li.where("split = 'test'"), feats, "l_extendedprice")
    return finish(out.select("model", "alpha", "intercept", F.col("weights")[0].alias("w_quantity"), F.col("weights")[1].alias("w_discount"), "mae", "mse", "r2"), digits=7)


def _stacked(spark, base):
    """Two candidate scores of the cancelled orders, over grouped time folds."""
    t = D.Tables(spark, base)
    o = D.scored_orders(t).drop("fold").join(t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice"), "o_orderkey")
    o = selection.grouped_time_folds(o, "d", test_periods=100, n_splits=3).where("role = 'validation'")
    both = F.array(F.struct(F.lit("logistic").alias("candidate"), F.col("p").alias("score")),
                   F.struct(F.lit("price_digits").alias("candidate"), (F.pmod(F.floor("o_totalprice"), F.lit(100)) / 100).alias("score")))
    return o.select("fold", "y", F.inline(both))


@query("fold_ranking_scores")
def q_fold_ranking_scores(spark, base):
    return finish(selection.ranking_scores(_stacked(spark, base)), digits=10)


@query("fold_threshold_scores")
def q_fold_threshold_scores(spark, base):
    return finish(selection.threshold_scores(_stacked(spark, base), 0.4), digits=10)


@query("scorer_ranking")
def q_scorer_ranking(spark, base):
    return finish(selection.summarise(selection.threshold_scores(_stacked(spark, base), 0.4), "missed_rate", larger_better=False), digits=10)


@query("grouped_time_folds")
def q_grouped_time_folds(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return finish(selection.grouped_time_folds(o, "d", test_periods=100, n_splits=3).select("o_orderkey", "fold", "role"))


@query("fixed_validation_search")
def q_fixed_validation_search(spark, base):
    pair = _doc_split(spark, base)
    grid = {f"reg={r}, l1={e}": G.logistic(label="quality", reg=r, elastic=e, maxIter=30) for r in (0.01, 0.1) for e in (0.0, 1.0)}
    return finish(selection.search(grid, [pair], "quality", "average_precision"))


@query("backward_selection")
def q_backward_selection(spark, base):
    d = D.doc_features(D.Tables(spark, base))
    noise = [f"noise_{i}" for i in range(4)]
    d = d.select("*", *[M.hash_unit(["doc_id"], seed=100 + i).alias(c) for i, c in enumerate(noise)])
    d = M.stratified_kfold_column(d, "quality", ["doc_id"], 2)
    return finish(selection.backward_select(d, [*D.DOC_NUMERIC, *noise], "quality", "fold", keep=4))


@query("feature_importance")
def q_feature_importance(spark, base):
    t = D.Tables(spark, base)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size"), "l_partkey")
    from pyspark.ml.feature import VectorAssembler
    feats = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
    li = G.dealt(li.select(*feats, "l_extendedprice"))
    li = VectorAssembler(inputCols=feats, outputCol="features").transform(li).select("features", "l_extendedprice").checkpoint()
    m = G.gbt_regressor(label="l_extendedprice", iters=8, depth=4).fit(li)
    return finish(G.importances(m, feats, spark))


@query("permutation_importance")
def q_permutation_importance(spark, base):
    t = D.Tables(spark, base)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice") \
        .withColumn("row_key", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax"))
    feats = ["l_quantity", "l_discount", "l_tax"]
    li = li.select("row_key", *feats, "l_extendedprice")
    from pyspark.ml.feature import VectorAssembler
    asm = VectorAssembler(inputCols=feats, outputCol="features")
    m = G.decision_tree(label="l_extendedprice", depth=5).fit(asm.transform(li))
    rmse = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("l_extendedprice"), 2)))
    return finish(G.permutation_importance(m, li, feats, "row_key", -rmse, asm.transform, repeats=10))


@query("forecast_scoring")
def q_forecast_scoring(spark, base):
    from tessera.plans.jobs import forecast_scoring
    return finish(forecast_scoring(D.Tables(spark, base)))


@query("written_batch_features")
def q_written_batch_features(spark, base):
    from tessera.plans.jobs import batch_features_job
    return finish(batch_features_job(D.Tables(spark, base)))


@query("credit_observations")
def q_credit_observations(spark, base):
    from tessera.plans.jobs import credit_observations
    return finish(credit_observations(D.Tables(spark, base)))


@query("booking_table")
def q_booking_table(spark, base):
    from tessera.plans.jobs import booking_table
    return finish(booking_table(D.Tables(spark, base)))


@query("visitor_features")
def q_visitor_features(spark, base):
    from tessera.plans.jobs import visitor_features
    return finish(visitor_features(D.Tables(spark, base)))


# ------------------------------------------------------------------ cleaning chains (P*, T*)

@query("games_cleaning")
def q_games_cleaning(spark, base):
    g = D.dirty_games(D.Tables(spark, base))
    g = clean.snake_case_columns(g)
    g = g.withColumn("name", clean.normalize_text("name", {"  ": " "}))
    g = clean.to_numeric(g, ["year_of_release"], "int")
    g = clean.sentinel_to_null(g, "user_score", ["tbd"])
    g = clean.cast_columns(g, {"user_score": "double"})
    g = clean.recode(g, "rating", {"K-A": "E"})
    g = clean.fill_group_mean(g, "critic_score", ["platform"])
    g = clean.fill_const(g, {"user_score": -1.0})
    g = clean.drop_null(g, ["year_of_release"])
    g = g.where(F.col("year_of_release").between(1995, 2030))
    g = g.distinct()
    return finish(clean.grade(g, "critic_score", D.CRITIC_BANDS, "critic_grade", "none"))


@query("derived_columns")
def q_derived_columns(spark, base):
    from tessera.functions import columns as C
    t = D.Tables(spark, base)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"),
                                                                           F.max("l_quantity").alias("max_qty"))
    o = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
         .join(lines, "o_orderkey", "left")
         .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal"), "o_custkey"))
    o = clean.localize(o, "o_orderdate", "Europe/Moscow")
    return finish(o.select(
        "o_orderkey",
        C.season(F.month(F.from_utc_timestamp("o_orderdate", "Europe/Moscow"))).alias("season"),
        F.col("o_orderdate").alias("order_ts_utc"),
        (F.coalesce(F.col("n_lines"), F.lit(0)) >= 5).cast("int").alias("many_lines"),
        C.ratio("o_totalprice", "n_lines").alias("value_per_line"),
        F.log1p("o_totalprice").alias("log_value"), F.sqrt("o_totalprice").alias("sqrt_value"),
        (F.col("o_totalprice") / (F.coalesce(F.col("n_lines"), F.lit(0)) + 1)).alias("stability"),
        C.rescale_over("max_qty", 45, 10).alias("qty_rescaled"),
        C.out_of_domain_null("c_acctbal", min_value=0.0).alias("acctbal_valid"),
        C.clip_low(F.col("c_acctbal"), 0.0).alias("acctbal_clipped"),
        C.pct_text("n_lines", F.lit(7)).alias("line_fill_pct"),
        C.presence_flag("n_lines").alias("has_lines"),
        clean.relative_window("o_orderdate", "1998-01-01 00:00:00", 365).cast("int").alias("in_last_year")))


@query("text_flags")
def q_text_flags(spark, base):
    from tessera.functions import columns as C
    d = D.Tables(spark, base).documents
    return finish(d.select("doc_id", "lang", C.word_pair_flag("text", "the", "and").alias("has_the_and"),
                           F.length(clean.normalize_text("text")).alias("norm_len")))


# ------------------------------------------------------------------ remaining profiling / cleaning / join operators

@query("load_report")
def q_load_report(spark, base):
    from tessera.plans.jobs import plan_panel
    return finish(profile.load_report(plan_panel(D.Tables(spark, base)), "date", plan_flag="is_plan"))


@query("anomaly_counts")
def q_anomaly_counts(spark, base):
    li = D.Tables(spark, base).lineitem
    over = profile.over_limit_by(li, "l_quantity", 45, "l_returnflag").withColumn("check", F.lit("quantity_over_45"))
    zero = profile.over_limit_by(li, "l_discount", None, "l_returnflag").withColumn("check", F.lit("zero_discount"))
    return finish(over.unionByName(zero))


@query("fills")
def q_fills(spark, base):
    ca = D.customer_activity(D.Tables(spark, base)).withColumn("n_events", F.col("n_events").cast("double"))
    train, test = ca.where(F.col("c_nationkey") < 15), ca.where(F.col("c_nationkey") >= 15)
    train, test = clean.fill_median_from(train, [test], ["n_events"])
    both = clean.fill_max(train.unionByName(test), "first_event_ts")
    both = clean.fill_mean(both.withColumn("value_sum", F.col("value_sum").cast("decimal(15,2)")), ["value_sum"])
    return finish(both.select("c_custkey", "n_events", "first_event_ts", "value_sum"))


@query("suffixed_join")
def q_suffixed_join(spark, base):
    t = D.Tables(spark, base)
    a = t.orders.groupBy(F.col("o_custkey").alias("cust")).agg(F.count(F.lit(1)).alias("n"),
                                                               F.sum(D.money(F.col("o_totalprice"))).alias("total"))
    b = (t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
         .groupBy(F.col("o_custkey").alias("cust")).agg(F.count(F.lit(1)).alias("n"),
                                                         F.sum(D.money(F.col("l_extendedprice"))).alias("total")))
    return finish(joins.join_suffixed(a, b, ["cust"], "left", ("_orders", "_lines")))


@query("group_share")
def q_group_share(spark, base):
    o = D.Tables(spark, base).orders.select("o_orderkey", "o_custkey", D.money(F.col("o_totalprice")).alias("price"))
    out = windows.group_total(o, ["o_custkey"], "price", "customer_total")
    return finish(out.withColumn("share_of_customer", F.col("price").cast("double") / F.col("customer_total").cast("double")))


@query("weak_features")
def q_weak_features(spark, base):
    c = D.Tables(spark, base).customer
    assoc = X.cramers_v(c, ["c_mktsegment", "c_nationkey", "c_acctbal"], numeric=["c_acctbal"])
    return finish(X.weak_features(assoc, "c_mktsegment", 0.1))


@query("ovr_multiclass")
def q_ovr_multiclass(spark, base):
    from pyspark.ml.functions import array_to_vector
    e = D.Tables(spark, base).embeddings.select("vec_id", F.col("label").cast("double").alias("label"),
                                                array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    e = M.hash_split(e, ["vec_id"], [0.8, 0.2], ["train", "test"]).checkpoint()
    m = G.one_vs_rest(G.LogisticRegression(maxIter=20)).fit(e.where("split = 'train'"))
    pred = m.transform(e.where("split = 'test'"))
    mm = G.multinomial().setMaxIter(20).fit(e.where("split = 'train'")).transform(e.where("split = 'test'"))
    rep = K.classification_report(pred, "label", "prediction").withColumn("model", F.lit("one_vs_rest"))
    rep2 = K.classification_report(mm, "label", "prediction").withColumn("model", F.lit("multinomial"))
    return finish(rep.unionByName(rep2))


@query("random_search")
def q_random_search(spark, base):
    train, _ = _doc_split(spark, base)
    train = M.stratified_kfold_column(train, "quality", ["doc_id"], 3)
    lr = G.logistic(label="quality", maxIter=20)
    maps = G.random_param_maps(lr, {"regParam": ("log", 1e-3, 1.0), "elasticNetParam": ("float", 0.0, 1.0)}, n_trials=3)
    ev = G.BinaryClassificationEvaluator(labelCol="quality", metricName="areaUnderPR")
    _, res = G.grid_search(lr, maps, ev, train, fold_col="fold", parallelism=3)
    return finish(res)


@query("scaled_features")
def q_scaled_features(spark, base):
    li = D.Tables(spark, base).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_discount", "l_tax")
    cut = F.lit("1998-01-01").cast("timestamp")
    tr, te = li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)
    tr, te = prep.standardize(tr, [te], ["l_quantity", "l_discount"])
    tr, te = prep.minmax(tr, [te], ["l_tax"])
    from pyspark.ml.feature import VectorAssembler
    asm = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features")
    sel = prep.variance_filter("features", 0.0).fit(asm.transform(tr))
    out = sel.transform(asm.transform(te))
    from pyspark.ml.functions import vector_to_array
    return finish(out.select("l_orderkey", "l_linenumber", vector_to_array("selected").alias("selected")))



@query("top_names_categories")
def q_top_names_categories(spark, base):
    pl = D.places(D.Tables(spark, base))
    top = R.top_groups(pl, "name", 15).select("name")
    return finish(joins.semi_top_k(pl, top, "name").select("name", "category").distinct())


@query("linear_formula_check")
def q_linear_formula_check(spark, base):
    from pyspark.ml.feature import VectorAssembler
    li = D.Tables(spark, base).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    feats = ["l_quantity", "l_discount", "l_tax"]
    tr, = prep.standardize(li, [], feats)
    tr = VectorAssembler(inputCols=feats, outputCol="features").transform(tr).checkpoint()
    m = G.LinearRegression(labelCol="l_extendedprice").fit(tr)
    coefs = dict(zip(feats, m.coefficients.toArray().tolist()))
    out = G.linear_formula(m.transform(tr), coefs, m.intercept)
    return finish(out.agg(F.max(F.abs(F.col("prediction") - F.col("formula_prediction"))).alias("max_abs_diff"),
                          F.count(F.lit(1)).alias("rows")))



@query("sql_region_report")
def q_sql_region_report(spark, base):
    """SQL string -> registered mart view -> ad-hoc report."""
    from tessera.sources import io
    mart = io.scratch_table(D.market_mart(D.Tables(spark, base)), "product_user_features")
    io.register_mart(mart, "product_user_features")
    sql = """
        SELECT region, used_installments, count(*) AS buyers, sum(total_orders) AS orders, max(total_orders) AS most_orders,
               sum(num_orders_with_rating) AS rated,
               try_divide(sum(avg_order_rating * num_orders_with_rating), sum(num_orders_with_rating)) AS mean_rating
        FROM product_user_features GROUP BY region, used_installments"""
    return finish(io.read_query(spark, sql))



@query("lagged_label")
def q_lagged_label(spark, base):
    """W7 / Q-5: the previous cohort row's target of the same customer as the
    label (label_lag = 1); rows without a previous target are dropped."""
    t = D.Tables(spark, base)
    cohort = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("score_date"))
    lab = joins.interval_label(cohort, D.shipments(t).select("o_custkey", "l_shipdate", "overdue_days"), "o_custkey",
                               "score_date", "l_shipdate", "overdue_days")
    out = windows.lags(lab, ["o_custkey"], [F.col("score_date"), F.col("o_orderkey")], "target", ks=(1,), names=["lag_1_target"])
    return finish(out.where(F.col("lag_1_target").isNotNull()).drop("target"))



@query("stream_daily_users")
def q_stream_daily_users(spark, base):
    """R2: daily unique / registered users from the events file read as a stream."""
    from tessera.streaming.jobs import run_daily_users
    path = f"{base.rstrip('/')}/events.parque[t]"      # the file source takes a directory or a glob
    return finish(run_daily_users(spark, path))


@query("stream_run_date_features")
def q_stream_run_date_features(spark, base):
    """Features of every (run date, user), kept up to date by a stream over
    the events written as many files, so that a run date arrives in several batches."""
    from tessera.streaming.jobs import event_stream, run_date_feature_stream, scratch
    events = D.Tables(spark, base).events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    arriving, out = scratch(spark, "arriving"), scratch(spark, "run-dates")
    events.repartition(8, "event_id").write.parquet(arriving)
    stream = event_stream(spark, arriving, events.schema, max_files=3)

    def per_user(rows):
        return (rows.groupBy("run_date", "user_id")
                .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_type").alias("n_types"),
                     F.max("value").alias("max_value"), F.count(F.when(F.col("event_type") == "signup", 1)).alias("n_signups")))

    run_date_feature_stream(stream, lambda: spark.read.schema(events.schema).parquet(arriving), out, scratch(spark, "stream"),
                            per_user, F.col("ts").cast("date")).awaitTermination()
    return finish(spark.read.parquet(out).withColumn("run_date", F.col("run_date").cast("date")))


# ------------------------------------------------------------------ round trips, text branch and reports in order

def _folder(spark, name):
    import uuid
    from tessera.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


@query("csv_round_trip")
def q_csv_round_trip(spark, base):
    from tessera.sources import io
    p = D.Tables(spark, base).part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    path = _folder(spark, "part-csv")
    p.write.option("header", True).option("quoteAll", True).csv(path)
    return finish(io.read_csv(spark, path, p.schema))


@query("tsv_decimal_comma")
def q_tsv_decimal_comma(spark, base):
    from tessera.sources import io
    c = D.Tables(spark, base).customer.select("c_custkey", "c_name", "c_acctbal")
    path = _folder(spark, "customer-tsv")
    c.withColumn("c_acctbal", F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.", ",")).write.option("header", True).option("sep", "\t").csv(path)
    return finish(io.read_tsv_decimal_comma(spark, path, c.schema, ["c_acctbal"]))


@query("model_round_trip")
def q_model_round_trip(spark, base):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from tessera.sources import io
    li = D.Tables(spark, base).lineitem.select("l_quantity", "l_discount", "l_extendedprice")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"), G.LinearRegression(labelCol="l_extendedprice")]).fit(li)
    path = _folder(spark, "model")
    io.save_model(pipe, path)
    both = io.load_model(path).transform(pipe.transform(li).withColumnRenamed("prediction", "before").drop("features"))
    return finish(both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") != F.col("prediction")).alias("different")))


@query("dropped_columns")
def q_dropped_columns(spark, base):
    return finish(prep.drop_columns(D.Tables(spark, base).supplier, ["s_name", "s_acctbal"]))


@query("column_ranges")
def q_column_ranges(spark, base):
    return finish(profile.profile_ranges(D.Tables(spark, base).part, ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]))


@query("users_in_both_arms")
def q_users_in_both_arms(spark, base):
    s = D.ab_sessions(D.Tables(spark, base)).withColumn("test_group", F.when(F.col("page_counter") >= 3, "A").otherwise("B"))
    return finish(X.users_in_both_arms(s, "user_id", "test_group"))


@query("yearly_spend")
def q_yearly_spend(spark, base):
    li = D.Tables(spark, base).lineitem
    flags = ["A", "N", "R"]
    li = li.select("l_shipdate", *[F.when(F.col("l_returnflag") == f, D.money(F.col("l_extendedprice"))).alias(f"spend_{f}") for f in flags])
    return finish(R.yearly_totals(li, "l_shipdate", [f"spend_{f}" for f in flags]))


@query("weekly_totals")
def q_weekly_totals(spark, base):
    return finish(R.period_totals(D.weekly_panel(D.Tables(spark, base)), "date", "weekly_sales"))


@query("median_by_holiday")
def q_median_by_holiday(spark, base):
    p = D.weekly_panel(D.Tables(spark, base)).withColumn("is_holiday", F.month(F.date_add("date", 6)) == 12)
    return finish(R.median_by(p, ["is_holiday"], "weekly_sales"))


@query("region_report_in_order")
def q_region_report_in_order(spark, base):
    r = marts.region_report(D.market_mart(D.Tables(spark, base)))
    return finish(R.positioned(r.select("region", "total_users", "total_orders"), [F.col("total_orders").desc(), F.col("region")]))


@query("tfidf_features")
def q_tfidf_features(spark, base):
    d = prep.text_tokens(D.Tables(spark, base).documents.select("doc_id", "text"), "text")
    train = d.where(F.col("doc_id") % 4 != 0)
    terms = prep.tfidf_vocabulary(train, "tokens", vocab=5)
    return finish(prep.tfidf(d, "tokens", terms).select("doc_id", *[F.col("tfidf")[i].alias(f"w{i}") for i in range(5)]), digits=9)


@query("booking_text_features")
def q_booking_text_features(spark, base):
    """Bookings with the review text of their number, TF-IDF fitted on the bookings before 2000; without a text all weights are 0."""
    from pyspark.ml.functions import vector_to_array
    t = D.Tables(spark, base)
    b = t.orders.select("o_orderkey", "o_orderdate").join(t.documents.select(F.col("doc_id").alias("o_orderkey"), F.col("text").alias("review_text")), "o_orderkey", "left")
    cut = F.lit("2000-01-01").cast("timestamp")
    train, test = prep.route_text(b.where(F.col("o_orderdate") < cut), [b.where(F.col("o_orderdate") >= cut)], ["review_text"], vocab=5)
    w = vector_to_array("review_text_tfidf")
    return finish(train.unionByName(test).select("o_orderkey", *[w[i].alias(f"w{i}") for i in range(5)]), digits=9)
