"""Data marts and SQL-origin ad-hoc reports.

Inputs use canonical column names (documented per function); the plan layer
renames source columns onto them. Every per-order fact is aggregated to one
row per order *before* it meets the order table, so the joins never fan out
and all of them share the ``order_id`` partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import band, epoch_seconds, flag, pct_text, ratio
from tessera.operators.ordered import quantiles

__all__ = [
    "customer_mart", "order_fact_aggregates", "order_segments", "top_customers", "region_report",
    "first_month_cohort", "payer_share", "payer_share_by", "global_stats", "zero_share",
    "item_popularity", "group_activity",
]


# Order-count segments of the marketplace report (label, lower bound inclusive, upper exclusive).
ORDER_SEGMENTS = [(None, 2, "1 order"), (2, 6, "2-5 orders"), (6, 11, "6-10 orders"), (11, None, "11 and more orders")]


def order_fact_aggregates(payment_type, payment_sequential, payment_installments, price, delivery_cost,
                          review_score, *, transfer: str, promo: str) -> list:
    """Per-order fact aggregates (A7-A10) as aggregate expressions, so a caller
    whose facts live in one table can compute them in a single grouped pass."""
    return [
        F.min(F.when(payment_type == transfer, payment_sequential)).alias("first_transfer_seq"),
        F.max(flag(payment_type == promo)).alias("binary_promo"),
        F.max(flag(payment_installments > 1)).alias("installment"),
        (F.sum(price) + F.sum(delivery_cost)).alias("order_cost"),
        F.avg(F.when(review_score > 5, review_score.cast("double") / 10.0)
              .otherwise(review_score.cast("double"))).alias("order_rating"),
    ]


def customer_mart(orders: DataFrame, users: DataFrame, items: DataFrame | None = None, payments: DataFrame | None = None,
                  reviews: DataFrame | None = None, *, delivered: str, cancelled: str, transfer: str, promo: str,
                  top_regions: int = 3, order_facts: DataFrame | None = None) -> DataFrame:
    """A11 customer mart (one row per user and region).

    orders(order_id, buyer_id, order_status, order_purchase_ts)
    users(buyer_id, user_id, region)
    items(order_id, price, delivery_cost)
    payments(order_id, payment_type, payment_sequential, payment_installments)
    reviews(order_id, review_score)
    order_facts (optional, replaces the three above): one row per order with
    first_transfer_seq, binary_promo, installment, order_cost, order_rating
    (see ``order_fact_aggregates``).
    """
    # Regions ranked by *all* orders (before the status filter), top k. Orders
    # are counted per buyer first (map-side combined), so the join to users sees
    # one row per buyer instead of one per order.
    per_buyer = orders.groupBy("buyer_id").agg(F.count(F.lit(1)).alias("_orders"))
    ranked = (per_buyer.join(users.select("buyer_id", "region"), "buyer_id")
              .groupBy("region").agg(F.sum("_orders").alias("_n"))
              .orderBy(F.col("_n").desc(), F.col("region").asc()).limit(top_regions).select("region"))
    filtered = (orders.where(F.col("order_status").isin(delivered, cancelled))
                .join(users.select("buyer_id", "user_id", "region"), "buyer_id")
                .join(F.broadcast(ranked), "region", "left_semi"))

    if order_facts is None:
        # One pass over payments gives first transfer sequence, promo and installment flags.
        pay = payments.groupBy("order_id").agg(
            F.min(F.when(F.col("payment_type") == transfer, F.col("payment_sequential"))).alias("first_transfer_seq"),
            F.max(flag(F.col("payment_type") == promo)).alias("binary_promo"),
            F.max(flag(F.col("payment_installments") > 1)).alias("installment"))
        # Delivered-order cost.
        cost = items.groupBy("order_id").agg((F.sum("price") + F.sum("delivery_cost")).alias("order_cost"))
        # A10: repaired review score, averaged per order.
        rev = reviews.groupBy("order_id").agg(F.avg(
            F.when(F.col("review_score") > 5, F.col("review_score").cast("double") / 10.0)
            .otherwise(F.col("review_score").cast("double"))).alias("order_rating"))
        facts_joined = (filtered.select("order_id", "user_id", "region", "order_status", "order_purchase_ts")
                        .join(pay, "order_id", "left").join(cost, "order_id", "left").join(rev, "order_id", "left"))
    else:
        facts_joined = (filtered.select("order_id", "user_id", "region", "order_status", "order_purchase_ts")
                        .join(order_facts, "order_id", "left"))

    per_order = (facts_joined
                 .withColumn("is_cancel", F.col("order_status") == cancelled)
                 .withColumn("delivered_cost", F.when(F.col("order_status") == delivered, F.col("order_cost"))))

    n_orders = F.count(F.lit(1))
    n_cancel = F.count(F.when(F.col("is_cancel"), F.lit(1)))
    n_install = F.count(F.when(F.col("installment") == 1, F.lit(1)))
    first_ts = F.min("order_purchase_ts")
    last_ts = F.max("order_purchase_ts")
    return per_order.groupBy("user_id", "region").agg(
        first_ts.alias("first_order_ts"),
        last_ts.alias("last_order_ts"),
        (epoch_seconds(last_ts) - epoch_seconds(first_ts)).alias("lifetime_sec"),
        n_orders.alias("total_orders"),
        F.avg("order_rating").alias("avg_order_rating"),
        F.count("order_rating").alias("num_orders_with_rating"),
        n_cancel.alias("num_canceled_orders"),
        ratio(n_cancel, n_orders).alias("canceled_orders_ratio"),
        F.sum("delivered_cost").alias("total_order_costs"),
        ratio(F.sum("delivered_cost"), n_orders - n_cancel).alias("avg_order_cost"),
        n_install.alias("num_installment_orders"),
        F.coalesce(F.sum("binary_promo"), F.lit(0)).cast("bigint").alias("num_orders_with_promo"),
        flag(F.sum("first_transfer_seq") > 0).alias("used_money_transfer"),
        flag(n_install > 0).alias("used_installments"),
        flag(n_cancel > 0).alias("used_cancel"))


def _per_user(mart: DataFrame) -> DataFrame:
    """A user can appear once per region in the mart; re-aggregate to the user."""
    return mart.groupBy("user_id").agg(
        F.min("first_order_ts").alias("first_order_ts"),
        F.max("last_order_ts").alias("last_order_ts"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_order_costs").alias("total_order_costs"),
        F.avg("avg_order_rating").alias("avg_order_rating"),
        flag(F.sum("used_money_transfer") > 0).alias("used_money_transfer"),
        (epoch_seconds(F.max("last_order_ts")) - epoch_seconds(F.min("first_order_ts"))).alias("lifetime_sec"),
        F.sum("num_orders_with_rating").alias("num_orders_with_rating"))


def order_segments(mart: DataFrame) -> DataFrame:
    """A12 users per order-count segment with mean orders and mean order cost."""
    users = _per_user(mart).withColumn("segmentation", band("total_orders", ORDER_SEGMENTS, "unknown"))
    return users.groupBy("segmentation").agg(
        F.count("user_id").alias("total_users"),
        F.round(F.avg("total_orders"), 1).alias("avg_total_orders"),
        F.round(ratio(F.sum("total_order_costs"), F.sum("total_orders")), 1).alias("avg_total_order_costs"))


def top_customers(mart: DataFrame, k: int = 15, min_orders: int = 3) -> DataFrame:
    """A13 + W2: top-k rows by average order cost among users with at least
    ``min_orders`` orders, ranked 1..k. The rank is computed after the top-k
    cut, so the global window only sees k rows."""
    top = (mart.where(F.col("total_orders") >= min_orders)
           .orderBy(F.col("avg_order_cost").desc_nulls_last(), F.col("user_id").asc(), F.col("region").asc())
           .limit(k))
    w = Window.orderBy(F.col("avg_order_cost").desc_nulls_last(), F.col("user_id").asc(), F.col("region").asc())
    return top.withColumn("rank_no", F.row_number().over(w))


def region_report(mart: DataFrame) -> DataFrame:
    """A14 per-region users, orders, average cost and percentage shares."""
    return mart.groupBy("region").agg(
        F.count("user_id").alias("total_users"),
        ratio(F.sum("total_order_costs"), F.sum("total_orders")).alias("avg_order_cost"),
        F.sum("total_orders").alias("total_orders"),
        pct_text(F.sum("num_installment_orders"), F.sum("total_orders")).alias("installment_share"),
        pct_text(F.sum("num_orders_with_promo"), F.sum("total_orders")).alias("promo_use_share"),
        pct_text(F.sum("used_cancel"), F.count("user_id")).alias("canceled_share"))


def first_month_cohort(mart: DataFrame, year: int) -> DataFrame:
    """A15 cohort by month of first order within ``year``."""
    users = _per_user(mart).where(F.year("first_order_ts") == year)
    month = F.date_trunc("month", F.col("first_order_ts").cast("timestamp"))
    avg_life = F.avg("lifetime_sec")
    avg_life_nz = F.avg(F.nullif(F.col("lifetime_sec"), F.lit(0.0)))
    return (users.withColumn("month_start", month)
            .groupBy("month_start").agg(
                F.count("user_id").alias("total_users"),
                F.sum("total_orders").alias("total_orders"),
                ratio(F.sum("total_order_costs"), F.sum("total_orders")).alias("avg_order_cost"),
                F.avg("avg_order_rating").alias("avg_order_rating"),
                pct_text(F.sum("used_money_transfer"), F.count("user_id")).alias("used_money_transfer_share"),
                (F.floor(avg_life / 60) * 60).cast("bigint").alias("avg_lifetime_sec"),
                (F.floor(avg_life_nz / 60) * 60).cast("bigint").alias("avg_lifetime_nonzero_sec"))
            .select(F.month("month_start").cast("bigint").alias("month_no"),
                    F.date_format("month_start", "MMMM").alias("month"), "*")
            .drop("month_start"))


# ---------------------------------------------------------------- game database

def payer_share(users: DataFrame, payer_col: str = "payer") -> DataFrame:
    """A2 share of paying users overall (one row)."""
    return users.agg(F.count(F.lit(1)).alias("total_players"),
                     F.count(F.when(F.col(payer_col) == 1, F.lit(1))).alias("total_paying_players"),
                     ratio(F.count(F.when(F.col(payer_col) == 1, F.lit(1))), F.count(F.lit(1))).alias("share_paying_players"))


def payer_share_by(users: DataFrame, dim: DataFrame, key: str, name_col: str, payer_col: str = "payer") -> DataFrame:
    """A3 payer share per dimension value (grouped by key and name, D8)."""
    agg = users.groupBy(key).agg(F.count(F.lit(1)).alias("total_players"),
                                 F.sum(F.col(payer_col)).cast("bigint").alias("total_paying_players"))
    return (agg.join(dim.select(key, name_col), key)
            .withColumn("share_paying_players", ratio("total_paying_players", "total_players")))


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """A1 count, sum, max, min, mean, exact median, sample std of a measure."""
    x = F.col(col)
    median = quantiles(df, col, [0.5], names=["median"]).scalar()  # one row
    xd = x.cast("double")
    return df.agg(F.count(F.lit(1)).alias("cnt"), F.sum(x).alias("sum_value"), F.max(x).alias("max_value"),
                  F.min(x).alias("min_value"), ratio(F.sum(x), F.count(x)).alias("avg_value"),
                  median.alias("median_value"), F.stddev_samp(xd).alias("std_value"))


def zero_share(df: DataFrame, col: str) -> DataFrame:
    """A4 rows with a zero measure: count and share."""
    zero = F.count(F.when(F.col(col) == 0, F.lit(1)))
    return df.agg(F.count(F.col(col)).alias("total_events"), zero.alias("zero_events"),
                  ratio(zero, F.count(F.lit(1))).alias("zero_share"))


def item_popularity(events: DataFrame, items: DataFrame, item_key: str, item_name: str,
                    user_col: str, amount_col: str) -> DataFrame:
    """A5 per item: sales, share of all sales, share of distinct buyers.

    Totals are scalar subqueries (J11, run once, no join); the distinct
    buyer count per item is a partial-aggregated distinct (no group is ever
    collected into one task)."""
    ev = events.where(F.col(amount_col) != 0)
    all_sales = ev.agg(F.count(F.lit(1))).scalar()          # scalar subqueries, evaluated once
    all_buyers = ev.agg(F.count_distinct(user_col)).scalar()
    per_item = ev.groupBy(item_key).agg(F.count(F.lit(1)).alias("total_item_transactions"),
                                        F.count_distinct(user_col).alias("unique_buyers"))
    return (per_item.join(items.select(item_key, item_name), item_key)
            .select(item_key, item_name, "total_item_transactions", "unique_buyers",
                    ratio("total_item_transactions", all_sales).alias("item_share"),
                    ratio("unique_buyers", all_buyers).alias("popularity_share")))


def group_activity(users: DataFrame, events: DataFrame, dim: DataFrame, *, user_key: str, group_key: str,
                   group_name: str, amount_col: str, payer_col: str = "payer") -> DataFrame:
    """A6 activity per group: players, buyers, payer share among buyers, mean
    purchases, mean ticket, mean spend. Only groups with at least one buyer
    and one paying buyer are kept (the reference inner-joins its parts)."""
    per_user = events.where(F.col(amount_col) > 0).groupBy(user_key).agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum(amount_col).alias("tx_sum"))
    u = users.select(user_key, group_key, payer_col).join(per_user, user_key, "left")
    buyer = F.col("tx_count").isNotNull()
    rep = u.groupBy(group_key).agg(
        F.count_distinct(user_key).alias("total_players"),
        F.count(F.when(buyer, F.lit(1))).alias("total_players_with_transaction"),
        F.count(F.when(buyer & (F.col(payer_col) == 1), F.lit(1))).alias("total_paying_buyers"),
        F.avg("tx_count").alias("avg_transaction_count"),
        ratio(F.sum("tx_sum"), F.sum("tx_count")).alias("avg_transaction"),
        ratio(F.sum("tx_sum"), F.count("tx_sum")).alias("avg_sum_of_transaction"))
    rep = rep.where((F.col("total_players_with_transaction") > 0) & (F.col("total_paying_buyers") > 0))
    return (rep.join(dim.select(group_key, group_name), group_key)
            .select(group_name, "total_players", "total_players_with_transaction",
                    ratio("total_players_with_transaction", "total_players").alias("share_with_transaction_players"),
                    ratio("total_paying_buyers", "total_players_with_transaction").alias("share_paying_among_buyers"),
                    "avg_transaction_count", "avg_transaction", "avg_sum_of_transaction"))
