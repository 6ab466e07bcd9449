"""Edge rows from FIXTURES.md on tiny hand-built frames."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tessera.operators import features, marts


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_customer_mart_edge_rows(spark):
    orders = spark.createDataFrame([
        ("o1", "b1", "D", _ts("2023-01-05 10:00:00")), ("o2", "b1", "D", _ts("2023-02-05 10:00:00")),
        ("o3", "b2", "C", _ts("2023-01-07 10:00:00")), ("o4", "b2", "C", _ts("2023-03-07 10:00:00")),   # all cancelled
        ("o5", "b3", "D", _ts("2023-01-09 10:00:00")), ("o6", "b4", "D", _ts("2023-01-10 10:00:00")),   # b3/b4: one user, two regions
        ("o7", "b5", "X", _ts("2023-01-11 10:00:00"))],
        "order_id string, buyer_id string, order_status string, order_purchase_ts timestamp")
    users = spark.createDataFrame([("b1", "u1", "R1"), ("b2", "u2", "R1"), ("b3", "u3", "R1"), ("b4", "u3", "R2"),
                                   ("b5", "u5", "R3")], "buyer_id string, user_id string, region string")
    items = spark.createDataFrame([("o1", 100.0, 10.0), ("o1", 50.0, 5.0), ("o2", 20.0, 0.0), ("o5", 30.0, 3.0),
                                   ("o6", 40.0, 4.0), ("o3", 999.0, 9.0)], "order_id string, price double, delivery_cost double")
    pays = spark.createDataFrame([("o1", "promo", 1, 1), ("o1", "promo", 2, 1), ("o1", "transfer", 3, 1),
                                  ("o2", "card", 2, 3), ("o5", "transfer", 4, 1)],
                                 "order_id string, payment_type string, payment_sequential int, payment_installments int")
    revs = spark.createDataFrame([("o1", 45), ("o2", 3), ("o5", 5)], "order_id string, review_score int")
    mart = marts.customer_mart(orders, users, items, pays, revs, delivered="D", cancelled="C", transfer="transfer",
                               promo="promo", top_regions=2)
    rows = {(r["user_id"], r["region"]): r for r in mart.collect()}
    assert set(rows) == {("u1", "R1"), ("u2", "R1"), ("u3", "R1"), ("u3", "R2")}        # R3 not in top-2, status X dropped
    u1 = rows[("u1", "R1")]
    assert u1["total_orders"] == 2 and math.isclose(u1["total_order_costs"], 185.0)
    assert math.isclose(u1["avg_order_rating"], (4.5 + 3) / 2)                           # 45 -> 4.5
    assert u1["num_orders_with_promo"] == 1 and u1["used_money_transfer"] == 1           # two promo lines = one order
    assert u1["num_installment_orders"] == 1 and u1["used_installments"] == 1
    u2 = rows[("u2", "R1")]
    assert u2["num_canceled_orders"] == 2 and u2["canceled_orders_ratio"] == 1.0
    assert u2["avg_order_cost"] is None and u2["total_order_costs"] is None              # 0 denominator -> NULL
    assert rows[("u3", "R1")]["used_money_transfer"] == 1                                # sequence starting at 4
    assert rows[("u3", "R2")]["used_money_transfer"] == 0


def test_batch_feature_window_edges(spark):
    run = "2024-01-25"
    ev = spark.createDataFrame([
        (1, 10, _ts("2024-01-25 00:00:00"), "page_view", 1),     # exactly at run date: excluded
        (1, 10, _ts("2024-01-18 00:00:00"), "page_view", 2),     # exactly run date - 7 d: included
        (1, 11, _ts("2024-01-20 12:00:00"), "add_to_cart", 2),
        (1, 11, _ts("2024-01-20 12:30:00"), "purchase", 3)],
        "customer_id int, session_id int, timestamp timestamp, event_type string, product_id int")
    ses = ev.groupBy("session_id", "customer_id").agg(F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"))
    orders = spark.createDataFrame([(1, _ts("2024-01-20 12:30:00"), 30.0), (1, _ts("2024-01-26 00:00:00"), 99.0)],
                                   "customer_id int, order_time timestamp, total_usd double")
    cust = spark.createDataFrame([(1,), (2,)], "customer_id int")
    out = {r["customer_id"]: r for r in features.batch_features(
        cust, "customer_id", ev, ses, orders, run_date=run, ev_ts="timestamp", ev_type="event_type",
        ev_product="product_id", session_key="session_id", s_start="start_time", s_end="end_time",
        o_ts="order_time", o_amount="total_usd").collect()}
    c1, c2 = out[1], out[2]
    assert c1["page_view_counter_7"] == 1 and c1["add_to_cart_counter_7"] == 1 and c1["purchase_counter_7"] == 1
    assert c1["unique_product_in_7"] == 2 and c1["conversion_add_to_cart_div_page_view_7"] == 1.0
    assert c1["total_amount_30"] == 30.0 and c1["days_since_last_purchase"] == 4        # later order ignored
    assert c1["session_counter_7"] == 2                                                   # session 10 starts exactly at run_date - 7 d
    assert c2["page_view_counter_30"] == 0 and c2["days_since_last_purchase"] == -1 and c2["mean_amount_30"] == 0
