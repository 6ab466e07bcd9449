"""End-to-end jobs (E1-E6) composed from the operator library.

Each job is one Spark application over the driver tables: no hand-offs
through files or the driver between steps. Jobs that persist results write
under the cluster's shared checkpoint folder (or a given path) and verify
what they wrote.
"""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import clip_low, ratio, season
from tessera.operators import clean, experiments, features, joins, models, windows
from tessera.plans import domains as D
from tessera.session import checkpoint_dir
from tessera.sources import io

# The drifting-feature exclusion applied before training and scoring.
PSI_THRESHOLD = 0.2


def plan_panel(t: D.Tables, plan_weeks: int = 8) -> DataFrame:
    """History (before the first plan week) UNION ALL plan rows whose
    target is unknown (typed NULL), flagged with ``is_plan``."""
    p = D.weekly_panel(t)
    first_plan = p.agg(F.date_sub(F.max("date"), 7 * (plan_weeks - 1))).scalar()
    hist = p.where(F.col("date") < first_plan).withColumn("is_plan", F.lit(False))
    plan = p.where(F.col("date") >= first_plan).select("store", "dept", "date", F.lit(True).alias("is_plan"))
    return hist.unionByName(plan, allowMissingColumns=True)


def drifting_columns(train: DataFrame, val: DataFrame, cols) -> list[str]:
    """E2 columns whose PSI between train and validation is >= threshold."""
    psi = experiments.psi(train, val, cols, threshold=PSI_THRESHOLD)
    return [r["column_name"] for r in psi.where("drifting = 1").select("column_name").collect()]


def forecast_scoring(t: D.Tables, plan_weeks: int = 8, out_path: str | None = None) -> DataFrame:
    """Panel -> time-series features (one ordered scan) -> store attributes
    and the week's factors joined (one row a store, one a week) -> train boosted
    trees on history -> score plan rows (lags of unknown weeks -> 0) -> clip
    at 0 -> stamped predictions keyed by (store, dept, date)."""
    panel = windows.time_series_features(plan_panel(t, plan_weeks), ["store", "dept"], "date", "weekly_sales")
    outside = ["store_type", "store_size", "factor_discount", "factor_tax", "factor_quantity"]
    feats = ["store", "dept", "month", "quarter", "year", "avg_sales_before", "sales_1week_ago", "sales_2week_ago",
             "sales_4week_ago", "mean_sales_2week", "mean_sales_4week", *outside]
    panel = panel.join(D.store_attributes(t), "store", "left").join(D.weekly_factors(t), "date", "left")
    panel = panel.select("store", "dept", "date", "is_plan", F.col("weekly_sales").cast("double").alias("weekly_sales"),
                         *[F.col(c).cast("double").alias(c) for c in feats if c not in ("store", "dept")])
    panel = panel.checkpoint()                       # one materialised panel for drift check, fit and scoring
    hist = panel.where(~F.col("is_plan")).dropna()
    plan = panel.where(F.col("is_plan")).fillna(0.0, subset=[c for c in feats if c not in ("store", "dept")])      # lags of weeks not yet known
    val_start = hist.agg(F.date_sub(F.max("date"), 7 * 26)).scalar()
    drift = drifting_columns(hist.where(F.col("date") < val_start), hist.where(F.col("date") >= val_start), feats[5:])
    use = [c for c in feats if c not in drift]
    asm = VectorAssembler(inputCols=use, outputCol="features", handleInvalid="keep")
    model = models.gbt_regressor(label="weekly_sales", iters=30, depth=5).fit(asm.transform(hist))
    pred = model.transform(asm.transform(plan)).select(
        "date", "store", "dept", clip_low("prediction", 0.0).alias("predicted_weekly_sales"))
    out = out_path or f"{checkpoint_dir(t.spark).rstrip('/')}/predictions-{uuid.uuid4().hex[:8]}"
    io.write_predictions(pred, out, ["store", "dept", "date"])        # S7: key check, stamp, replace
    return t.spark.read.parquet(out)


def batch_features_job(t: D.Tables, run_date: str = D.RUN_DATE, out_path: str | None = None) -> DataFrame:
    """Point-in-time customer features -> staging write -> checks (not
    empty, unique key) -> published as the run-date partition -> read back
    and check. The features are computed once. Returns the stored partition."""
    spark = t.spark
    out = out_path or f"{checkpoint_dir(spark).rstrip('/')}/batch_features-{uuid.uuid4().hex[:8]}"
    cust = t.customer.select(F.col("c_custkey").alias("customer_id"))
    feats = features.batch_features(cust, "customer_id", D.web_events(t), D.web_sessions(t), D.web_orders(t),
                                    run_date=run_date, ev_ts="timestamp", ev_type="event_type", ev_product="product_id",
                                    session_key="session_id", s_start="start_time", s_end="end_time",
                                    o_ts="order_time", o_amount="total_usd").drop("run_date")
    io.publish(feats, out, ["customer_id"], partition=f"run_date={run_date}")
    io.check_written(spark, out, run_date)
    return spark.read.parquet(out).where(F.col("run_date") == F.lit(run_date).cast("date"))


def credit_observations(t: D.Tables) -> DataFrame:
    """Cohort (customer, order date) -> forward default label (J7) ->
    latest shipment strictly before the score date (J6) -> customer
    attributes (J3) -> same-day market rate (J8) -> ratios and transforms
    (P28, P29)."""
    cohort = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("score_date"))
    ship = D.shipments(t)
    lab = joins.interval_label(cohort, ship.select("o_custkey", "l_shipdate", "overdue_days"), "o_custkey", "score_date",
                               "l_shipdate", "overdue_days")
    asof = joins.asof_join(lab, ship.select("o_custkey", "l_shipdate", "l_extendedprice", "overdue_days"), ["o_custkey"],
                           "score_date", "l_shipdate", ["l_extendedprice", "overdue_days"], strict=True, suffix="_last")
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment", "c_nationkey")
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("score_date")).agg(F.avg("o_totalprice").alias("market_avg_price"))
    out = asof.join(cust, "o_custkey", "left").join(daily, "score_date", "left")
    return (out.withColumn("balance_to_last_shipment", ratio("c_acctbal", "l_extendedprice"))
            .withColumn("log_last_shipment", F.log1p("l_extendedprice"))
            .withColumn("days_since_last_shipment", F.datediff("score_date", F.col("l_shipdate").cast("date"))))


def booking_table(t: D.Tables) -> DataFrame:
    """E5: bookings (orders) with the latest earlier review of the same
    customer (J6, strict; reviews repaired then averaged per customer and
    day), season (P25), per-line value (P28), a recoded status flag (P10)
    and a constant fill for bookings without an earlier review (P5)."""
    bookings = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    reviews = D.dated_reviews(t).groupBy("o_custkey", "l_shipdate").agg(F.avg("review_score").alias("stay_rating"))
    b = joins.asof_join(bookings, reviews, ["o_custkey"], "o_orderdate", "l_shipdate", ["stay_rating"], strict=True)
    b = b.join(lines, "o_orderkey", "left")
    b = (b.withColumn("season", season(F.month("o_orderdate")))
         .withColumn("value_per_line", ratio("o_totalprice", "n_lines"))
         .withColumn("is_canceled", F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)))
    return clean.fill_const(b, {"stay_rating": -1.0})


def visitor_features(t: D.Tables) -> DataFrame:
    """First event per user (P14), user x event-type counts (A40),
    row shares (P30), user x daypart counts (A40), sessions per active day
    (A41, 30 idle minutes), customer attributes (J3)."""
    ev = t.events
    types = ["view", "click", "purchase", "signup", "error"]
    first = clean.dedup_first(ev.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]) \
        .select("user_id", F.col("event_type").alias("first_event_type"))
    piv = clean.row_share(features.pivot_counts(ev, "user_id", "event_type", types, prefix="n_"), [f"n_{v}" for v in types])
    parts = features.pivot_counts(ev.withColumn("daypart", features.daypart(F.col("ts"))), "user_id", "daypart", features.DAYPARTS, prefix="at_")
    spd = features.sessions_per_active_day(ev, "user_id", "ts", ["event_id"])
    cust = D.customer_region(t).select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "r_name")
    return piv.join(first, "user_id").join(parts, "user_id").join(spd, "user_id").join(cust, "user_id", "left")
