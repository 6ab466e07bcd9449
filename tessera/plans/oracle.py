"""DuckDB SQL equivalents of the registered queries (same parquet tables).

``final`` applies the normalisation of ``queries.finish``: doubles rounded
to 12 significant digits, integers as BIGINT, dates/timestamps as text.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def sig(c: str, digits: int = 12) -> str:
    """Significant-digit rounding, same arithmetic as ``functions.sig_round``."""
    x = f"CAST({c} AS DOUBLE)"
    e = f"(floor(log10(abs({x}))) - {digits - 1})"
    return (f"(CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} "
            f"WHEN {e} >= 0 THEN round({x} / pow(10.0, {e})) * pow(10.0, {e}) "
            f"ELSE round({x} * pow(10.0, -{e})) / pow(10.0, -{e}) END)")


def final(sql: str, dbl=(), ints=(), ts=(), dates=(), digits: int = 12) -> str:
    parts = [f"{sig(c, digits)} AS {c}" for c in dbl]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ts]
    parts += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    if not parts:
        return sql
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({sql}) AS _q"


def oracle(name: str, **kw):
    def deco(fn):
        ORACLE[name] = final(fn(), **kw)
        return fn
    return deco


# ------------------------------------------------------------------ marketplace mart
# Review scores of open lines are stored times ten; corrected, every line's is its quantity mod 5, plus 1.
MARKET = """
line_facts AS (
  SELECT l_orderkey AS order_id,
         sum(CAST(l_extendedprice AS DECIMAL(15,2))) + sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2))) AS cost,
         bool_or(l_returnflag = 'A') AS by_transfer, bool_or(l_returnflag = 'R') AS by_promo,
         bool_or(CAST(floor(l_quantity) AS BIGINT) % 4 > 1) AS in_parts,
         avg(CAST(CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS DOUBLE)) AS rating
  FROM lineitem GROUP BY l_orderkey),
placed AS (
  SELECT c.c_custkey AS user_id, r.r_name AS region, o.o_orderstatus AS status, o.o_orderdate AS ts, x.*,
         count(*) OVER (PARTITION BY r.r_name) AS region_size
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN line_facts x ON x.order_id = o.o_orderkey),
wanted AS (
  SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY region_size DESC, region) AS place FROM placed)
  WHERE place <= 3 AND status IN ('F', 'P')),
mart AS (
  SELECT user_id, region, min(ts) AS first_order_ts, max(ts) AS last_order_ts, epoch(max(ts)) - epoch(min(ts)) AS lifetime_sec,
         count(*) AS total_orders, avg(rating) AS avg_order_rating, count(rating) AS num_orders_with_rating,
         count(*) FILTER (status = 'P') AS num_canceled_orders,
         CAST(count(*) FILTER (status = 'P') AS DOUBLE) / count(*) AS canceled_orders_ratio,
         sum(cost) FILTER (status = 'F') AS total_order_costs,
         CAST(sum(cost) FILTER (status = 'F') AS DOUBLE) / NULLIF(count(*) FILTER (status = 'F'), 0) AS avg_order_cost,
         count(*) FILTER (in_parts) AS num_installment_orders, count(*) FILTER (by_promo) AS num_orders_with_promo,
         CAST(coalesce(bool_or(by_transfer), false) AS INT) AS used_money_transfer,
         CAST(coalesce(bool_or(in_parts), false) AS INT) AS used_installments,
         CAST(bool_or(status = 'P') AS INT) AS used_cancel
  FROM wanted GROUP BY user_id, region),
buyers AS (
  SELECT user_id, min(ts) AS first_order_ts, epoch(max(ts)) - epoch(min(ts)) AS lifetime_sec, count(*) AS total_orders,
         sum(cost) FILTER (status = 'F') AS total_order_costs, avg(rating) AS avg_order_rating,
         CAST(coalesce(bool_or(by_transfer), false) AS INT) AS used_money_transfer
  FROM wanted GROUP BY user_id)
"""

PCT = "CAST(CAST(round(CAST({n} AS DOUBLE) / NULLIF({d}, 0) * 100, 2) AS DECIMAL(20,2)) AS VARCHAR) || '%'"


@oracle("customer_mart", ts=("first_order_ts", "last_order_ts"),
        dbl=("lifetime_sec", "avg_order_rating", "canceled_orders_ratio", "total_order_costs", "avg_order_cost"),
        ints=("used_money_transfer", "used_installments", "used_cancel"))
def _():
    return f"WITH {MARKET} SELECT * FROM mart"


@oracle("order_segments", dbl=("avg_total_orders", "avg_total_order_costs"))
def _():
    return f"""WITH {MARKET}
    SELECT CASE WHEN total_orders = 1 THEN '1 order' WHEN total_orders < 6 THEN '2-5 orders'
                WHEN total_orders < 11 THEN '6-10 orders' WHEN total_orders >= 11 THEN '11 and more orders'
                ELSE 'unknown' END AS segmentation,
           count(user_id) AS total_users, round(avg(total_orders), 1) AS avg_total_orders,
           round(CAST(sum(total_order_costs) AS DOUBLE) / NULLIF(sum(total_orders), 0), 1) AS avg_total_order_costs
    FROM buyers GROUP BY segmentation"""


@oracle("top_customers", ts=("first_order_ts", "last_order_ts"),
        dbl=("lifetime_sec", "avg_order_rating", "canceled_orders_ratio", "total_order_costs", "avg_order_cost"),
        ints=("used_money_transfer", "used_installments", "used_cancel", "rank_no"))
def _():
    return f"""WITH {MARKET}
    SELECT *, row_number() OVER (ORDER BY avg_order_cost DESC NULLS LAST, user_id, region) AS rank_no
    FROM mart WHERE total_orders > 2 ORDER BY avg_order_cost DESC NULLS LAST, user_id, region LIMIT 15"""


@oracle("region_report", dbl=("avg_order_cost",), ints=("total_orders",))
def _():
    return f"""WITH {MARKET}
    SELECT region, count(user_id) AS total_users,
           CAST(sum(total_order_costs) AS DOUBLE) / NULLIF(sum(total_orders), 0) AS avg_order_cost,
           sum(total_orders) AS total_orders,
           {PCT.format(n='sum(num_installment_orders)', d='sum(total_orders)')} AS installment_share,
           {PCT.format(n='sum(num_orders_with_promo)', d='sum(total_orders)')} AS promo_use_share,
           {PCT.format(n='sum(used_cancel)', d='count(user_id)')} AS canceled_share
    FROM mart GROUP BY region"""


@oracle("first_month_cohort", ints=("total_orders", "avg_lifetime_sec", "avg_lifetime_nonzero_sec"),
        dbl=("avg_order_cost", "avg_order_rating"))
def _():
    return f"""WITH {MARKET}
    SELECT month(date_trunc('month', first_order_ts)) AS month_no,
           monthname(date_trunc('month', first_order_ts)) AS month,
           count(user_id) AS total_users, sum(total_orders) AS total_orders,
           CAST(sum(total_order_costs) AS DOUBLE) / NULLIF(sum(total_orders), 0) AS avg_order_cost,
           avg(avg_order_rating) AS avg_order_rating,
           {PCT.format(n='sum(used_money_transfer)', d='count(user_id)')} AS used_money_transfer_share,
           floor(avg(lifetime_sec) / 60) * 60 AS avg_lifetime_sec,
           floor(avg(NULLIF(lifetime_sec, 0)) / 60) * 60 AS avg_lifetime_nonzero_sec
    FROM buyers WHERE year(first_order_ts) = 1995
    GROUP BY date_trunc('month', first_order_ts)"""


# ------------------------------------------------------------------ game database
GAME = """
g_users AS (SELECT c_custkey AS id, c_nationkey AS race_id, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS payer FROM customer),
g_race AS (SELECT n_nationkey AS race_id, n_name AS race FROM nation),
g_items AS (SELECT p_partkey AS item_code, p_name AS game_items FROM part),
g_events AS (SELECT o.o_custkey AS id, l.l_partkey AS item_code,
                    CASE WHEN l.l_discount = 0 THEN CAST(0 AS DECIMAL(15,2))
                         ELSE CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) END AS amount
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""


@oracle("payer_share", dbl=("share_paying_players",))
def _():
    return f"""WITH {GAME}
    SELECT count(*) AS total_players, count_if(payer = 1) AS total_paying_players, avg(payer) AS share_paying_players FROM g_users"""


@oracle("payer_share_by_race", dbl=("share_paying_players",), ints=("race_id", "total_paying_players"))
def _():
    return f"""WITH {GAME}
    SELECT race_id, race, count(*) AS total_players, sum(payer) AS total_paying_players, avg(payer) AS share_paying_players
    FROM g_users JOIN g_race USING (race_id) GROUP BY ALL"""


@oracle("global_stats", dbl=("sum_value", "max_value", "min_value", "avg_value", "median_value", "std_value"))
def _():
    return f"""WITH {GAME}
    SELECT count(*) AS cnt, sum(amount) AS sum_value, max(amount) AS max_value, min(amount) AS min_value,
           CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_value, quantile_cont(CAST(amount AS DOUBLE), 0.5) AS median_value,
           stddev_samp(CAST(amount AS DOUBLE)) AS std_value
    FROM g_events"""


@oracle("zero_share", dbl=("zero_share",))
def _():
    return f"""WITH {GAME}
    SELECT count(amount) AS total_events, count_if(amount = 0) AS zero_events, avg(CAST(amount = 0 AS INT)) AS zero_share FROM g_events"""


@oracle("item_popularity", dbl=("item_share", "popularity_share"), ints=("total_item_transactions",))
def _():
    # One row per buyer and item: rows are its buyers, their counts its transactions.
    return f"""WITH {GAME}, bought AS (SELECT item_code, id, count(*) AS times FROM g_events WHERE amount <> 0 GROUP BY ALL)
    SELECT item_code, game_items, sum(times) AS total_item_transactions, count(*) AS unique_buyers,
           CAST(sum(times) AS DOUBLE) / CAST(sum(sum(times)) OVER () AS DOUBLE) AS item_share,
           CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT id) FROM bought) AS popularity_share
    FROM bought JOIN g_items USING (item_code) GROUP BY ALL"""


@oracle("group_activity", dbl=("share_with_transaction_players", "share_paying_among_buyers",
                               "avg_transaction_count", "avg_transaction", "avg_sum_of_transaction"))
def _():
    return f"""WITH {GAME},
    player AS (
      SELECT race_id, id, max(payer) AS payer, count(*) FILTER (amount > 0) AS purchases, coalesce(sum(amount) FILTER (amount > 0), 0) AS spent
      FROM g_users LEFT JOIN g_events USING (id) GROUP BY race_id, id)
    SELECT race, count(*) AS total_players, count_if(purchases > 0) AS total_players_with_transaction,
           count_if(purchases > 0) / count(*) AS share_with_transaction_players,
           count_if(purchases > 0 AND payer = 1) / count_if(purchases > 0) AS share_paying_among_buyers,
           sum(purchases) / count_if(purchases > 0) AS avg_transaction_count,
           CAST(sum(spent) AS DOUBLE) / sum(purchases) AS avg_transaction,
           CAST(sum(spent) AS DOUBLE) / count_if(purchases > 0) AS avg_sum_of_transaction
    FROM player JOIN g_race USING (race_id) GROUP BY race HAVING count_if(purchases > 0 AND payer = 1) > 0"""


# ------------------------------------------------------------------ time-aware core
PANEL = """
panel AS (SELECT c.c_nationkey AS store, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS dept,
                 CAST(date_trunc('week', o.o_orderdate) AS DATE) AS date,
                 sum(CAST(o.o_totalprice AS DECIMAL(15,2))) AS weekly_sales
          FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY ALL)
"""
W = "PARTITION BY store, dept ORDER BY date"


@oracle("ts_lags", dates=("date",), dbl=("weekly_sales", "sales_1week_ago", "sales_2week_ago", "sales_4week_ago"),
        ints=("store", "dept"))
def _():
    return f"""WITH {PANEL}
    SELECT *, lag(weekly_sales, 1) OVER ({W}) AS sales_1week_ago, lag(weekly_sales, 2) OVER ({W}) AS sales_2week_ago,
           lag(weekly_sales, 4) OVER ({W}) AS sales_4week_ago FROM panel"""


EXPANDING = f"""CAST(sum(weekly_sales) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE)
           / NULLIF(count(weekly_sales) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"""


def _rolling(n):
    f = f"OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(weekly_sales) {f} = {n} THEN CAST(sum(weekly_sales) {f} AS DOUBLE) / {n} END"


@oracle("ts_expanding_mean", dates=("date",), dbl=("weekly_sales", "avg_sales_before"), ints=("store", "dept"))
def _():
    return f"WITH {PANEL} SELECT *, {EXPANDING} AS avg_sales_before FROM panel"


@oracle("ts_rolling_mean", dates=("date",), dbl=("weekly_sales", "mean_sales_2week", "mean_sales_4week"),
        ints=("store", "dept"))
def _():
    return f"WITH {PANEL} SELECT *, {_rolling(2)} AS mean_sales_2week, {_rolling(4)} AS mean_sales_4week FROM panel"


@oracle("ts_features", dates=("date",), ints=("store", "dept", "month", "quarter", "year"),
        dbl=("weekly_sales", "avg_sales_before", "sales_1week_ago", "sales_2week_ago", "sales_4week_ago",
             "mean_sales_2week", "mean_sales_4week"))
def _():
    return f"""WITH {PANEL}
    SELECT *, month(date) AS month, quarter(date) AS quarter, year(date) AS year, {EXPANDING} AS avg_sales_before,
           lag(weekly_sales, 1) OVER ({W}) AS sales_1week_ago, lag(weekly_sales, 2) OVER ({W}) AS sales_2week_ago,
           lag(weekly_sales, 4) OVER ({W}) AS sales_4week_ago,
           {_rolling(2)} AS mean_sales_2week, {_rolling(4)} AS mean_sales_4week FROM panel"""


@oracle("lag_gap_days", dates=("order_dt",), ints=("days_since_prev",))
def _():
    return """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_dt,
           datediff('day', lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                    CAST(o_orderdate AS DATE)) AS days_since_prev FROM orders"""


SHIP = """
ship AS (SELECT o.o_custkey, l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_extendedprice,
                datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS overdue_days
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""


@oracle("asof_join", ts=("o_orderdate", "l_shipdate"), dbl=("l_extendedprice",), ints=("l_linenumber",))
def _():
    return f"""WITH {SHIP},
    pairs AS (SELECT o.o_orderkey, s.l_shipdate, s.l_orderkey, s.l_linenumber, s.l_extendedprice,
                     row_number() OVER (PARTITION BY o.o_orderkey
                                        ORDER BY s.l_shipdate DESC, s.l_orderkey DESC, s.l_linenumber DESC,
                                                 s.l_extendedprice DESC) AS rn
              FROM orders o JOIN ship s ON s.o_custkey = o.o_custkey AND s.l_shipdate < o.o_orderdate)
    SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, p.l_shipdate, p.l_orderkey, p.l_linenumber, p.l_extendedprice
    FROM orders o LEFT JOIN pairs p ON p.o_orderkey = o.o_orderkey AND p.rn = 1"""


@oracle("interval_label", dates=("score_date",), ints=("target",))
def _():
    return f"""WITH {SHIP},
    firsts AS (SELECT o_custkey, min(CAST(l_shipdate AS DATE)) AS f FROM ship WHERE overdue_days >= 90 GROUP BY o_custkey),
    last AS (SELECT max(CAST(l_shipdate AS DATE)) AS l FROM ship)
    SELECT c.o_orderkey, c.o_custkey, CAST(c.o_orderdate AS DATE) AS score_date,
           CASE WHEN f.f IS NOT NULL AND f.f < CAST(c.o_orderdate AS DATE) + 365 THEN 1 ELSE 0 END AS target
    FROM orders c LEFT JOIN firsts f ON f.o_custkey = c.o_custkey
    WHERE (f.f IS NULL OR f.f >= CAST(c.o_orderdate AS DATE))
      AND CAST(c.o_orderdate AS DATE) <= (SELECT l FROM last) - 365"""


# ------------------------------------------------------------------ profiling and data quality
ACTIVITY = """
ca AS (SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, c.c_acctbal, e.n_events, e.value_sum, e.first_event_ts
       FROM customer c LEFT JOIN (SELECT user_id, count(*) AS n_events, sum(value) AS value_sum, min(ts) AS first_event_ts
                                  FROM events GROUP BY user_id) e ON e.user_id = c.c_custkey)
"""
CA_COLS = ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "n_events", "value_sum", "first_event_ts"]


@oracle("null_share", dbl=("null_share",))
def _():
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_share FROM ca" for c in CA_COLS)
    return f"WITH {ACTIVITY} {parts}"


@oracle("profile_counts")
def _():
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM ca"
        for c in CA_COLS)
    return f"WITH {ACTIVITY} {parts}"


@oracle("describe_numeric", dbl=("mean", "std", "min", "max", "q25", "q50", "q75"))
def _():
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
        f"min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
        f"quantile_cont({c}, 0.75) AS q75 FROM lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return parts


@oracle("null_share_by", dbl=("null_share",))
def _():
    return f"""WITH {ACTIVITY}
    SELECT c_mktsegment, count(*) AS rows, count(*) - count(n_events) AS nulls,
           CAST(count(*) - count(n_events) AS DOUBLE) / count(*) AS null_share
    FROM ca WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment HAVING count(*) - count(n_events) > 0"""


@oracle("dup_count_key", ints=("duplicate_rows",))
def _():
    return """SELECT COALESCE(sum(n - 1), 0) AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
           count(*) AS distinct_keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


@oracle("dup_count_rows", ints=("duplicate_rows",))
def _():
    return """SELECT COALESCE(sum(n - 1), 0) AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
           count(*) AS distinct_keys FROM (SELECT count(*) AS n FROM lineitem
           GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus, l_shipdate)"""


@oracle("cardinality", ints=("high_cardinality",))
def _():
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, "
        f"CASE WHEN count(DISTINCT {c}) > 300 THEN 1 ELSE 0 END AS high_cardinality FROM orders" for c in cols)


@oracle("date_span", dates=("min_date", "max_date"), ints=("span_days",))
def _():
    return """SELECT min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date,
           datediff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) AS span_days FROM orders"""


@oracle("value_counts", dbl=("share",))
def _():
    return """SELECT o_orderpriority, count(*) AS cnt,
           CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders WHERE o_orderpriority IS NOT NULL) AS share
    FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority"""


@oracle("key_overlap")
def _():
    return """SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS keys_a,
                  (SELECT count(DISTINCT user_id) FROM events) AS keys_b,
                  (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders) a
                   JOIN (SELECT DISTINCT user_id FROM events) b ON a.o_custkey = b.user_id) AS keys_both"""


@oracle("removal_report", dbl=("removed_share",))
def _():
    return """WITH kept AS (SELECT * FROM orders WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)
                              AND o_totalprice > 0)
    SELECT (SELECT count(*) FROM orders) AS rows_before, (SELECT count(*) FROM kept) AS rows_after,
           (SELECT count(*) FROM orders) - (SELECT count(*) FROM kept) AS removed,
           CAST((SELECT count(*) FROM orders) - (SELECT count(*) FROM kept) AS DOUBLE) / (SELECT count(*) FROM orders) AS removed_share"""


# ------------------------------------------------------------------ cleaning

@oracle("fill_group_mean", dbl=("n_events_filled",))
def _():
    return f"""WITH {ACTIVITY}, m AS (SELECT c_mktsegment, avg(n_events) AS g FROM ca GROUP BY c_mktsegment)
    SELECT ca.c_custkey, ca.c_mktsegment, ca.n_events, COALESCE(CAST(ca.n_events AS DOUBLE), m.g) AS n_events_filled
    FROM ca LEFT JOIN m ON m.c_mktsegment IS NOT DISTINCT FROM ca.c_mktsegment"""


@oracle("dedup_first", ts=("ts",), dbl=("value",))
def _():
    return """SELECT user_id, event_id, ts, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1"""


@oracle("trim_percentile", dbl=("o_totalprice",))
def _():
    return """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)"""


@oracle("iqr_outliers", dbl=("q1", "median", "q3", "lower", "upper"))
def _():
    return """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                              quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
    f AS (SELECT q1, median, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b)
    SELECT f.*, (SELECT count(*) FROM lineitem WHERE l_extendedprice < f.lower) AS outliers_low,
                (SELECT count(*) FROM lineitem WHERE l_extendedprice > f.upper) AS outliers_high FROM f"""


@oracle("calendar_parts", ts=("o_orderdate",), dates=("month_start",),
        ints=("month", "quarter", "year", "weekday", "hour"))
def _():
    return """SELECT o_orderkey, o_orderdate, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter,
           year(o_orderdate) AS year, isodow(o_orderdate) - 1 AS weekday, dayname(o_orderdate) AS weekday_name,
           hour(o_orderdate) AS hour, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders"""


@oracle("packed_time", ts=("hour_code_ts",), dates=("hour_code_date",), ints=("hour_code_hour",))
def _():
    return """WITH p AS (SELECT o_orderkey, strftime(o_orderdate, '%y%m%d%H') AS hour_code FROM orders)
    SELECT o_orderkey, hour_code, strptime(hour_code, '%y%m%d%H') AS hour_code_ts,
           CAST(strptime(hour_code, '%y%m%d%H') AS DATE) AS hour_code_date,
           hour(strptime(hour_code, '%y%m%d%H')) AS hour_code_hour FROM p"""


PURCHASES = """
cr AS (SELECT c.c_custkey AS user_id, c.c_mktsegment AS service_name, r.r_name AS region_name
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
tk AS (SELECT l_orderkey AS order_id, count(*) AS tickets_count FROM lineitem GROUP BY l_orderkey),
pur AS (SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, CAST(o.o_orderdate AS DATE) AS created_dt,
               o.o_orderdate AS created_ts, CAST(o.o_totalprice AS DECIMAL(15,2)) AS revenue,
               CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'mobile' ELSE 'desktop' END AS device_type,
               o.o_orderstatus AS event_type, cr.service_name, cr.region_name,
               COALESCE(tk.tickets_count, 0) AS tickets_count,
               CASE WHEN cr.service_name = 'MACHINERY' THEN 'kzt' ELSE 'rub' END AS currency_code
        FROM orders o JOIN cr ON cr.user_id = o.o_custkey LEFT JOIN tk ON tk.order_id = o.o_orderkey),
rates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS data, 100 AS nominal,
                 CAST(CAST(20 AS DECIMAL(10,2)) + CAST(day(o_orderdate) AS DECIMAL(10,2)) / 10 AS DECIMAL(10,2)) AS curs
          FROM orders WHERE day(o_orderdate) != 31)
"""


@oracle("currency_convert", dates=("created_dt",), dbl=("revenue", "revenue_rub"))
def _():
    return f"""WITH {PURCHASES}
    SELECT p.order_id, p.created_dt, p.currency_code, p.revenue,
           CASE WHEN p.currency_code = 'kzt' THEN p.revenue / r.nominal * r.curs ELSE p.revenue END AS revenue_rub
    FROM pur p LEFT JOIN rates r ON r.data = p.created_dt"""


# ------------------------------------------------------------------ point-in-time batch features
WEB = """
wev AS (SELECT event_id, user_id AS customer_id, user_id * 100000 + (CAST(ts AS DATE) - DATE '1970-01-01') AS session_id,
               ts AS timestamp,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id FROM events),
wses AS (SELECT user_id * 100000 + (CAST(ts AS DATE) - DATE '1970-01-01') AS session_id, user_id AS customer_id,
                min(ts) AS start_time, max(ts) AS end_time FROM events GROUP BY ALL),
word AS (SELECT event_id AS order_id, user_id AS customer_id, ts AS order_time, CAST(value AS DECIMAL(15,2)) AS total_usd
         FROM events WHERE event_type = 'purchase')
"""
RD = "TIMESTAMP '2024-01-25 00:00:00'"


def _w(col, d):
    return f"({col} >= {RD} - INTERVAL {d} DAY AND {col} < {RD})"


def _evf(d):
    w = _w("timestamp", d)
    return (f"count(*) FILTER (WHERE {w} AND event_type = 'page_view') AS page_view_counter_{d}, "
            f"count(*) FILTER (WHERE {w} AND event_type = 'add_to_cart') AS add_to_cart_counter_{d}, "
            f"count(*) FILTER (WHERE {w} AND event_type = 'purchase') AS purchase_counter_{d}, "
            f"count(DISTINCT CASE WHEN {w} THEN product_id END) AS unique_product_in_{d}")


@oracle("batch_features", dates=("run_date",),
        dbl=("conversion_add_to_cart_div_page_view_7", "conversion_purchase_div_add_to_cart_7",
             "conversion_add_to_cart_div_page_view_30", "conversion_purchase_div_add_to_cart_30",
             "mean_amount_30", "total_amount_30", "session_duration_in_7", "session_duration_in_30"))
def _():
    return f"""WITH {WEB},
    ef AS (SELECT customer_id, {_evf(7)}, {_evf(30)} FROM wev WHERE {_w("timestamp", 30)} GROUP BY customer_id),
    ofe AS (SELECT customer_id, CAST(sum(total_usd) AS DOUBLE) / count(total_usd) AS mean_amount_30,
                   sum(total_usd) AS total_amount_30 FROM word WHERE {_w("order_time", 30)} GROUP BY customer_id),
    sf AS (SELECT customer_id, count(*) FILTER (WHERE {_w("start_time", 7)}) AS session_counter_7,
                  avg(CASE WHEN {_w("start_time", 7)} THEN epoch(end_time) - epoch(start_time) END) AS session_duration_in_7,
                  count(*) FILTER (WHERE {_w("start_time", 30)}) AS session_counter_30,
                  avg(CASE WHEN {_w("start_time", 30)} THEN epoch(end_time) - epoch(start_time) END) AS session_duration_in_30
           FROM wses WHERE {_w("start_time", 30)} GROUP BY customer_id),
    rf AS (SELECT customer_id, CAST(floor((epoch({RD}) - epoch(max(order_time))) / 86400) AS BIGINT) AS days_since_last_purchase
           FROM word WHERE order_time < {RD} GROUP BY customer_id)
    SELECT c.c_custkey AS customer_id,
           COALESCE(page_view_counter_7, 0) AS page_view_counter_7, COALESCE(add_to_cart_counter_7, 0) AS add_to_cart_counter_7,
           COALESCE(purchase_counter_7, 0) AS purchase_counter_7, COALESCE(unique_product_in_7, 0) AS unique_product_in_7,
           COALESCE(page_view_counter_30, 0) AS page_view_counter_30, COALESCE(add_to_cart_counter_30, 0) AS add_to_cart_counter_30,
           COALESCE(purchase_counter_30, 0) AS purchase_counter_30, COALESCE(unique_product_in_30, 0) AS unique_product_in_30,
           COALESCE(CAST(add_to_cart_counter_7 AS DOUBLE) / NULLIF(page_view_counter_7, 0), 0) AS conversion_add_to_cart_div_page_view_7,
           COALESCE(CAST(purchase_counter_7 AS DOUBLE) / NULLIF(add_to_cart_counter_7, 0), 0) AS conversion_purchase_div_add_to_cart_7,
           COALESCE(CAST(add_to_cart_counter_30 AS DOUBLE) / NULLIF(page_view_counter_30, 0), 0) AS conversion_add_to_cart_div_page_view_30,
           COALESCE(CAST(purchase_counter_30 AS DOUBLE) / NULLIF(add_to_cart_counter_30, 0), 0) AS conversion_purchase_div_add_to_cart_30,
           COALESCE(mean_amount_30, 0) AS mean_amount_30, COALESCE(total_amount_30, 0) AS total_amount_30,
           COALESCE(session_counter_7, 0) AS session_counter_7, COALESCE(session_duration_in_7, 0) AS session_duration_in_7,
           COALESCE(session_counter_30, 0) AS session_counter_30, COALESCE(session_duration_in_30, 0) AS session_duration_in_30,
           COALESCE(days_since_last_purchase, -1) AS days_since_last_purchase, DATE '2024-01-25' AS run_date
    FROM (SELECT DISTINCT c_custkey FROM customer) c
    LEFT JOIN ef ON ef.customer_id = c.c_custkey LEFT JOIN ofe ON ofe.customer_id = c.c_custkey
    LEFT JOIN sf ON sf.customer_id = c.c_custkey LEFT JOIN rf ON rf.customer_id = c.c_custkey"""


TYPES = ["view", "click", "purchase", "signup", "error"]


@oracle("pivot_counts", dbl=tuple(f"n_{v}_share" for v in TYPES))
def _():
    cnt = ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS n_{v}" for v in TYPES)
    tot = " + ".join(f"n_{v}" for v in TYPES)
    shares = ", ".join(f"CAST(n_{v} AS DOUBLE) / NULLIF({tot}, 0) AS n_{v}_share" for v in TYPES)
    return f"SELECT *, {shares} FROM (SELECT user_id, {cnt} FROM events GROUP BY user_id)"


# ------------------------------------------------------------------ A/B test
AB = """
abs_ AS (SELECT s.*, r.r_name AS region, c.c_mktsegment AS device,
                s.user_id * 100000 + (s.session_date - DATE '1970-01-01') AS session_id,
                CASE WHEN s.user_id % 2 = 0 THEN 'A' ELSE 'B' END AS test_group
         FROM (SELECT user_id, CAST(ts AS DATE) AS session_date, min(ts) AS session_start_ts, count(*) AS page_counter,
                      max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS registration_flag
               FROM events GROUP BY ALL) s
         LEFT JOIN customer c ON c.c_custkey = s.user_id LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
         LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY session_start_ts, session_id) AS rn
                                      FROM abs_) WHERE rn = 1)
"""
AB_COLS = ("session_date", "session_start_ts", "page_counter", "registration_flag", "region", "device", "session_id", "test_group")


def phi(z):
    """Same closed form as ``functions.normal_cdf`` (Abramowitz-Stegun 26.2.17)."""
    t = f"(1.0 / (1.0 + 0.2316419 * abs({z})))"
    poly = (f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))")
    pdf = f"(exp(-({z}) * ({z}) / 2.0) / {(2 * 3.141592653589793) ** 0.5!r})"
    return f"(CASE WHEN ({z}) >= 0 THEN 1.0 - {pdf} * {poly} ELSE {pdf} * {poly} END)"


@oracle("top_user_sessions", dates=("session_date",), ts=("session_start_ts",))
def _():
    return f"""WITH {AB}, per AS (SELECT user_id, count(DISTINCT session_id) AS n FROM abs_ GROUP BY user_id)
    SELECT * FROM abs_ WHERE user_id = (SELECT user_id FROM per ORDER BY n DESC, user_id LIMIT 1)"""


@oracle("daily_users", dates=("session_date",), dbl=("registration_share",))
def _():
    return f"""WITH {AB}
    SELECT session_date, count(DISTINCT user_id) AS users,
           count(DISTINCT CASE WHEN registration_flag = 1 THEN user_id END) AS registered_users,
           CAST(count(DISTINCT CASE WHEN registration_flag = 1 THEN user_id END) AS DOUBLE) / count(DISTINCT user_id) AS registration_share
    FROM abs_ GROUP BY session_date"""


@oracle("page_distribution")
def _():
    return f"WITH {AB} SELECT page_counter, count(*) AS sessions FROM firsts GROUP BY page_counter"


@oracle("daily_success", dates=("session_date",), dbl=("success_share",))
def _():
    return f"""WITH {AB}
    SELECT session_date, count(*) AS sessions, count(*) FILTER (WHERE page_counter >= 4) AS successes,
           CAST(count(*) FILTER (WHERE page_counter >= 4) AS DOUBLE) / count(*) AS success_share
    FROM firsts GROUP BY session_date"""


@oracle("ab_plan", dbl=("base_share", "avg_daily_users", "effect_size_h"), ints=("sample_size_per_arm", "test_days"))
def _():
    from tessera.functions.columns import z_quantile
    zz = z_quantile(0.975) + z_quantile(0.8)
    return f"""WITH {AB},
    ds AS (SELECT avg(share) AS base_share FROM (SELECT CAST(count(*) FILTER (WHERE page_counter >= 4) AS DOUBLE) / count(*) AS share
                                                FROM firsts GROUP BY session_date)),
    du AS (SELECT avg(u) AS avg_daily_users FROM (SELECT count(DISTINCT user_id) AS u FROM abs_ GROUP BY session_date)),
    h AS (SELECT base_share, avg_daily_users,
                 abs(2 * asin(sqrt(base_share * (1 + 0.03))) - 2 * asin(sqrt(base_share))) AS effect_size_h FROM ds, du)
    SELECT *, ceil(2 * pow({zz!r} / effect_size_h, 2)) AS sample_size_per_arm,
           ceil(2 * ceil(2 * pow({zz!r} / effect_size_h, 2)) / avg_daily_users) AS test_days FROM h"""


@oracle("arm_sizes", dbl=("diff_pct",))
def _():
    return f"""WITH {AB}, d1 AS (SELECT * FROM abs_ WHERE session_date = (SELECT min(session_date) FROM abs_)),
    c AS (SELECT count(DISTINCT CASE WHEN test_group = 'A' THEN user_id END) AS users_a,
                 count(DISTINCT CASE WHEN test_group = 'B' THEN user_id END) AS users_b FROM d1)
    SELECT *, CAST(abs(users_a - users_b) * 100 AS DOUBLE) / NULLIF(users_a, 0) AS diff_pct FROM c"""


@oracle("arm_balance", dbl=("share_a", "share_b", "gap_pp"))
def _():
    return f"""WITH {AB},
    c AS (SELECT device, count(*) FILTER (WHERE test_group = 'A') AS n_a, count(*) FILTER (WHERE test_group = 'B') AS n_b
          FROM firsts GROUP BY device),
    s AS (SELECT *, CAST(n_a AS DOUBLE) / NULLIF((SELECT count(*) FROM firsts WHERE test_group = 'A'), 0) AS share_a,
                    CAST(n_b AS DOUBLE) / NULLIF((SELECT count(*) FROM firsts WHERE test_group = 'B'), 0) AS share_b FROM c)
    SELECT *, abs(share_a - share_b) * 100 AS gap_pp FROM s"""


@oracle("metric_per_arm", dbl=("share",))
def _():
    return f"""WITH {AB}
    SELECT test_group, CAST(sum(CASE WHEN page_counter >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS successes, count(*) AS users,
           CAST(sum(CASE WHEN page_counter >= 4 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS share
    FROM firsts GROUP BY test_group"""


@oracle("prop_ztest", dbl=("share_a", "share_b", "lift", "z_stat", "p_value"))
def _():
    z = "((CAST(x_a AS DOUBLE) / n_a - CAST(x_b AS DOUBLE) / n_b) / sqrt(((x_a + x_b) / CAST(n_a + n_b AS DOUBLE)) * (1 - (x_a + x_b) / CAST(n_a + n_b AS DOUBLE)) * (1.0 / n_a + 1.0 / n_b)))"
    return f"""WITH {AB},
    g AS (SELECT CAST(sum(CASE WHEN test_group = 'A' THEN (page_counter >= 4)::INT END) AS BIGINT) AS x_a,
                 count(*) FILTER (WHERE test_group = 'A') AS n_a,
                 CAST(sum(CASE WHEN test_group = 'B' THEN (page_counter >= 4)::INT END) AS BIGINT) AS x_b,
                 count(*) FILTER (WHERE test_group = 'B') AS n_b FROM firsts)
    SELECT *, CAST(x_a AS DOUBLE) / n_a AS share_a, CAST(x_b AS DOUBLE) / n_b AS share_b,
           (CAST(x_b AS DOUBLE) / n_b - CAST(x_a AS DOUBLE) / n_a) / NULLIF(CAST(x_a AS DOUBLE) / n_a, 0) AS lift,
           {z} AS z_stat, {phi(z)} AS p_value FROM g"""


@oracle("psi", dbl=("psi",), ints=("drifting",))
def _():
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stack = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v, CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS side FROM lineitem"
        for c in cols)
    return f"""WITH both_ AS ({stack}),
    rng AS (SELECT column_name, min(v) AS lo, max(v) AS hi FROM both_ GROUP BY column_name),
    binned AS (SELECT b.*, CASE WHEN r.hi = r.lo THEN 0 ELSE CAST(least(floor((b.v - r.lo) / ((r.hi - r.lo) / 10)), 9) AS INTEGER) END AS bin
               FROM both_ b JOIN rng r USING (column_name)),
    cnt AS (SELECT column_name, bin, count(*) FILTER (WHERE side = 0) AS n_e, count(*) FILTER (WHERE side = 1) AS n_a FROM binned GROUP BY ALL),
    tot AS (SELECT column_name, count(*) FILTER (WHERE side = 0) AS t_e, count(*) FILTER (WHERE side = 1) AS t_a FROM binned GROUP BY ALL),
    grid AS (SELECT column_name, unnest(range(0, 10)) AS bin FROM rng),
    full_ AS (SELECT g.column_name, COALESCE(c.n_e, 0) AS n_e, COALESCE(c.n_a, 0) AS n_a, t.t_e, t.t_a
              FROM grid g LEFT JOIN cnt c USING (column_name, bin) JOIN tot t USING (column_name)),
    p AS (SELECT column_name, sum((greatest(CAST(n_a AS DOUBLE) / t_a, 1e-10) - greatest(CAST(n_e AS DOUBLE) / t_e, 1e-10))
                                  * ln(greatest(CAST(n_a AS DOUBLE) / t_a, 1e-10) / greatest(CAST(n_e AS DOUBLE) / t_e, 1e-10))) AS psi
          FROM full_ GROUP BY column_name)
    SELECT column_name, psi, CASE WHEN psi >= 0.2 THEN 1 ELSE 0 END AS drifting FROM p"""


@oracle("cramers_v", dbl=("chi2", "cramers_v"))
def _():
    cols = ["c_mktsegment", "c_nationkey", "c_acctbal"]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    ex = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {a} AS va, {b} AS vb FROM w" for a, b in pairs)
    return f"""WITH st AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
    w AS (SELECT CAST(c_mktsegment AS VARCHAR) AS c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                 CAST(CAST(CASE WHEN st.hi = st.lo THEN 0 ELSE least(floor((c_acctbal - st.lo) / ((st.hi - st.lo) / 10)), 9) END AS BIGINT) AS VARCHAR) AS c_acctbal
          FROM customer, st),
    ex AS ({ex}),
    cell AS (SELECT col_a, col_b, va, vb, count(*) AS o FROM ex GROUP BY ALL),
    ra AS (SELECT col_a, col_b, va, sum(o) AS ra FROM cell GROUP BY ALL),
    rb AS (SELECT col_a, col_b, vb, sum(o) AS rb FROM cell GROUP BY ALL),
    n AS (SELECT col_a, col_b, sum(o) AS n, count(DISTINCT va) AS r, count(DISTINCT vb) AS k FROM cell GROUP BY ALL),
    chi AS (SELECT c.col_a, c.col_b, n.n, n.r, n.k, sum(CAST(c.o AS DOUBLE) * c.o / (CAST(ra.ra AS DOUBLE) * rb.rb / n.n)) AS s
            FROM cell c JOIN ra USING (col_a, col_b, va) JOIN rb USING (col_a, col_b, vb) JOIN n USING (col_a, col_b)
            GROUP BY ALL)
    SELECT col_a, col_b, s - n AS chi2,
           COALESCE(sqrt(greatest(0.0, (s - n) / n - (k - 1) * (r - 1) / (n - 1.0))
                / NULLIF(least((k - pow(k - 1, 2) / (n - 1.0)) - 1, (r - pow(r - 1, 2) / (n - 1.0)) - 1), 0)), 0.0) AS cramers_v
    FROM chi"""


# ------------------------------------------------------------------ metrics
SCORED = """
sc AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS y,
              round(1.0 / (1.0 + exp(-(o_totalprice - 150000.0) / 50000.0)), 3) AS p, o_orderkey % 5 AS fold FROM orders),
pr AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(15,2)) AS y, o.o_orderkey % 5 AS fold, l.pred
       FROM orders o JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                                                  * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS pred
                           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)
"""


def _reg(src, by=""):
    e = "(CAST(pred AS DOUBLE) - CAST(y AS DOUBLE))"
    grp = f"GROUP BY {by}" if by else ""
    sel = f"{by}, " if by else ""
    if by:
        mean = f"(SELECT avg(CAST(y AS DOUBLE)) FROM {src} i WHERE i.{by} = {src}.{by})"
    else:
        mean = f"(SELECT avg(CAST(y AS DOUBLE)) FROM {src})"
    return f"""SELECT {sel}avg({e} * {e}) AS mse, avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse,
           1.0 - sum({e} * {e}) / NULLIF(sum(pow(CAST(y AS DOUBLE) - {mean}, 2)), 0) AS r2 FROM {src} {grp}"""


@oracle("regression_metrics", dbl=("mse", "mae", "rmse", "r2"))
def _():
    return f"WITH {SCORED} {_reg('pr')}"


@oracle("mape", dbl=("mape",))
def _():
    return f"""WITH {SCORED} SELECT avg(CASE WHEN CAST(y AS DOUBLE) != 0
                THEN abs((CAST(y AS DOUBLE) - CAST(pred AS DOUBLE)) / CAST(y AS DOUBLE)) END) * 100 AS mape FROM pr"""


@oracle("pricing_risk", dbl=("overpricing_rate", "underpricing_rate", "underpricing_loss"))
def _():
    return f"""WITH {SCORED}, d AS (SELECT CAST(y AS DOUBLE) AS yy, CAST(pred AS DOUBLE) AS pp FROM pr)
    SELECT avg(CASE WHEN pp > yy * 1.2 THEN 1.0 ELSE 0.0 END) AS overpricing_rate,
           avg(CASE WHEN pp < yy * (1 - 0.2) THEN 1.0 ELSE 0.0 END) AS underpricing_rate,
           COALESCE(sum(CASE WHEN pp < yy * (1 - 0.2) THEN yy - pp END), 0.0) AS underpricing_loss FROM d"""


@oracle("cv_summary", dbl=("rmse_mean", "rmse_std", "mae_mean", "mae_std", "r2_mean", "r2_std"))
def _():
    return f"""WITH {SCORED}, f AS ({_reg('pr', 'fold')})
    SELECT avg(rmse) AS rmse_mean, stddev_pop(rmse) AS rmse_std, avg(mae) AS mae_mean, stddev_pop(mae) AS mae_std,
           avg(r2) AS r2_mean, stddev_pop(r2) AS r2_std FROM f"""


CONF = """SELECT count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
                 count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp
          FROM (SELECT *, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc)"""


@oracle("confusion")
def _():
    return f"WITH {SCORED} {CONF}"


@oracle("binary_scores", dbl=("accuracy", "precision", "recall", "f1", "macro_f1"))
def _():
    return f"""WITH {SCORED}, c AS ({CONF}),
    r AS (SELECT (tp + tn) * 1.0 / (tp + tn + fp + fn) AS accuracy,
                 COALESCE(tp * 1.0 / NULLIF(tp + fp, 0), 0) AS p1, COALESCE(tp * 1.0 / NULLIF(tp + fn, 0), 0) AS r1,
                 COALESCE(tn * 1.0 / NULLIF(tn + fn, 0), 0) AS p0, COALESCE(tn * 1.0 / NULLIF(tn + fp, 0), 0) AS r0 FROM c),
    f AS (SELECT *, COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0) AS f1, COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0) AS f0 FROM r)
    SELECT CAST(accuracy AS DOUBLE) AS accuracy, CAST(p1 AS DOUBLE) AS precision, CAST(r1 AS DOUBLE) AS recall,
           CAST(f1 AS DOUBLE) AS f1, CAST((f1 + f0) / 2 AS DOUBLE) AS macro_f1 FROM f"""


@oracle("classification_report", dbl=("precision", "recall", "f1"))
def _():
    return f"""WITH {SCORED}, d AS (SELECT y, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc),
    cls AS (SELECT y AS cls FROM d UNION SELECT pred FROM d),
    m AS (SELECT cls.cls, count(*) FILTER (WHERE d.y = cls.cls AND d.pred = cls.cls) AS tp,
                 count(*) FILTER (WHERE d.y = cls.cls) AS support, count(*) FILTER (WHERE d.pred = cls.cls) AS predicted
          FROM cls, d GROUP BY cls.cls),
    r AS (SELECT cls, COALESCE(CAST(tp AS DOUBLE) / NULLIF(predicted, 0), 0) AS precision,
                 COALESCE(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0) AS recall, support FROM m)
    SELECT cls, precision, recall, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1, support FROM r"""


@oracle("roc_auc", dbl=("roc_auc",))
def _():
    return f"""WITH {SCORED}, t AS (SELECT p AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
                                   FROM sc GROUP BY p),
    c AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM t)
    SELECT sum(pos * (COALESCE(below, 0) + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS roc_auc FROM c"""


PRT = """t AS (SELECT p AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM sc GROUP BY p),
    c AS (SELECT s, pos, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
                 (SELECT count(*) FROM sc WHERE y = 1) AS total_pos FROM t)"""


@oracle("average_precision", dbl=("average_precision",))
def _():
    return f"WITH {SCORED}, {PRT} SELECT sum(CAST(pos AS DOUBLE) / total_pos * (CAST(tp AS DOUBLE) / (tp + fp))) AS average_precision FROM c"


@oracle("pr_curve", dbl=("threshold", "precision", "recall"))
def _():
    return f"""WITH {SCORED}, {PRT} SELECT s AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
           CAST(tp AS DOUBLE) / total_pos AS recall FROM c"""


@oracle("log_loss_brier", dbl=("log_loss", "brier"))
def _():
    return f"""WITH {SCORED}, d AS (SELECT y, p, least(greatest(p, 1e-15), 1 - 1e-15) AS pp FROM sc)
    SELECT avg(-(y * ln(pp) + (1 - y) * ln(1 - pp))) AS log_loss, avg(pow(p - y, 2)) AS brier FROM d"""


@oracle("calibration_curve", dbl=("prob_pred", "prob_true"), ints=("bin",))
def _():
    return f"""WITH {SCORED} SELECT greatest(0, least(9, ceil(p * 10) - 1)) AS bin, avg(p) AS prob_pred,
           avg(CAST(y AS DOUBLE)) AS prob_true, count(*) AS n FROM sc GROUP BY ALL"""


@oracle("ece_mce", dbl=("ece", "mce"))
def _():
    return f"""WITH {SCORED}, b AS (SELECT least(floor(p * 10), 9) AS bin, avg(p) AS conf, avg(CAST(y AS DOUBLE)) AS acc,
                                          count(*) AS n FROM sc GROUP BY ALL)
    SELECT sum(n * abs(conf - acc)) / sum(n) AS ece, max(abs(conf - acc)) AS mce FROM b"""


SWEEP = """grid AS (SELECT CAST(range AS DOUBLE) / 1000.0 AS threshold FROM range(0, 1001)),
    sw AS (SELECT g.threshold, count(*) FILTER (WHERE sc.p <= g.threshold) AS a,
                  count(*) FILTER (WHERE sc.p <= g.threshold AND sc.y = 1) AS ad,
                  (SELECT count(*) FROM sc) AS n, (SELECT count(*) FROM sc WHERE y = 1) AS d
           FROM grid g, sc GROUP BY g.threshold),
    app AS (SELECT threshold, CAST(a AS DOUBLE) / n AS approval_rate, COALESCE(CAST(ad AS DOUBLE) / NULLIF(a, 0), 0) AS default_rate,
                   COALESCE(CAST(ad AS DOUBLE) / NULLIF(d, 0), 0) AS missed_default_rate FROM sw)"""


@oracle("threshold_sweep", dbl=("threshold", "approval_rate", "default_rate", "missed_default_rate"))
def _():
    return f"WITH {SCORED}, {SWEEP} SELECT * FROM app"


@oracle("approval_threshold", dbl=("threshold", "approval_rate", "default_rate", "missed_default_rate"))
def _():
    return f"""WITH {SCORED}, {SWEEP} SELECT * FROM app
    WHERE approval_rate >= 0.3 AND default_rate <= 0.35 AND missed_default_rate <= 0.5
    ORDER BY approval_rate DESC, threshold LIMIT 1"""


RSWEEP = """grid AS (SELECT CAST(range AS DOUBLE) / 1000.0 AS threshold FROM range(0, 1001)),
    cm AS (SELECT g.threshold, count(*) FILTER (WHERE sc.y = 0 AND sc.p < g.threshold) AS tn,
                  count(*) FILTER (WHERE sc.y = 0 AND sc.p >= g.threshold) AS fp,
                  count(*) FILTER (WHERE sc.y = 1 AND sc.p < g.threshold) AS fn,
                  count(*) FILTER (WHERE sc.y = 1 AND sc.p >= g.threshold) AS tp FROM grid g, sc GROUP BY g.threshold),
    rev AS (SELECT *, (tp * 45000 + tn * 64500 - fp * 7000 - fn * 64500) - ((tn + fp) * 64500 - (tp + fn) * 64500) AS incremental_revenue,
                   CAST((tp * 45000 + tn * 64500 - fp * 7000 - fn * 64500) - ((tn + fp) * 64500 - (tp + fn) * 64500) AS DOUBLE)
                   / NULLIF(CAST((tn + fp) * 64500 - (tp + fn) * 64500 AS DOUBLE), 0) * 100 AS relative_ir FROM cm)"""


@oracle("revenue_sweep", dbl=("threshold", "relative_ir"), ints=("incremental_revenue",))
def _():
    return f"WITH {SCORED}, {RSWEEP} SELECT * FROM rev"


@oracle("best_revenue_threshold", dbl=("threshold", "relative_ir"), ints=("incremental_revenue",))
def _():
    return f"WITH {SCORED}, {RSWEEP} SELECT * FROM rev ORDER BY incremental_revenue DESC, threshold LIMIT 1"


@oracle("approval_at", dbl=("approval_rate", "default_rate", "missed_default_rate"))
def _():
    return f"""WITH {SCORED}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE p <= 0.5) AS a,
                                      count(*) FILTER (WHERE p <= 0.5 AND y = 1) AS ad, count(*) FILTER (WHERE y = 1) AS d FROM sc)
    SELECT CAST(a AS DOUBLE) / n AS approval_rate, COALESCE(CAST(ad AS DOUBLE) / NULLIF(a, 0), 0) AS default_rate,
           COALESCE(CAST(ad AS DOUBLE) / NULLIF(d, 0), 0) AS missed_default_rate FROM c"""


@oracle("business_effect", dbl=("cancel_rate_before", "cancel_rate_after", "occupancy_change_pct", "relative_ir"))
def _():
    return f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (WHERE y = 0 AND p <= 0.415) AS tn, count(*) FILTER (WHERE y = 0 AND p > 0.415) AS fp,
                                      count(*) FILTER (WHERE y = 1 AND p <= 0.415) AS fn, count(*) FILTER (WHERE y = 1 AND p > 0.415) AS tp FROM sc)
    SELECT CAST(fn + tp AS DOUBLE) / (tn + fp + fn + tp) AS cancel_rate_before, CAST(fn AS DOUBLE) / (tn + fp + fn + tp) AS cancel_rate_after,
           CAST(tn - (tn + fp) AS DOUBLE) / (tn + fp) * 100 AS occupancy_change_pct,
           CAST((tp * 45000 + tn * 64500 - fp * 7000 - fn * 64500) - ((tn + fp) * 64500 - (tp + fn) * 64500) AS DOUBLE)
           / NULLIF(CAST((tn + fp) * 64500 - (tp + fn) * 64500 AS DOUBLE), 0) * 100 AS relative_ir FROM c"""


# ------------------------------------------------------------------ ticket purchases (AFI)
PROFILE = """
gaps AS (SELECT order_id, datediff('day', lag(created_dt) OVER (PARTITION BY user_id ORDER BY created_ts, order_id), created_dt) AS days_since_prev FROM pur),
pp AS (SELECT p.*, g.days_since_prev, CAST(CAST(p.revenue AS DOUBLE) / NULLIF(p.tickets_count, 0) AS DECIMAL(25,10)) AS rev_per_ticket
       FROM pur p LEFT JOIN gaps g USING (order_id)),
firsto AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_ts, order_id) AS rn FROM pur) WHERE rn = 1),
prof AS (SELECT a.*, f.device_type AS first_device_type, f.region_name AS first_region_name, f.service_name AS first_service_name,
                f.event_type AS first_event_type,
                CASE WHEN a.total_orders >= 2 THEN 1 ELSE 0 END AS is_two, CASE WHEN a.total_orders >= 5 THEN 1 ELSE 0 END AS is_five
         FROM (SELECT user_id, min(created_ts) AS first_order, max(created_ts) AS last_order, count(DISTINCT order_id) AS total_orders,
                      CAST(sum(revenue) AS DOUBLE) / count(revenue) AS avg_order_rev, avg(tickets_count) AS avg_tickets_count,
                      avg(days_since_prev) AS avg_days_since_prev,
                      CAST(sum(rev_per_ticket) AS DOUBLE) / count(rev_per_ticket) AS avg_revenue_per_ticket
               FROM pp GROUP BY user_id) a JOIN firsto f USING (user_id))
"""
PROF_DBL = ("avg_order_rev", "avg_tickets_count", "avg_days_since_prev", "avg_revenue_per_ticket")


@oracle("monthly_revenue", dates=("month",), dbl=("total",))
def _():
    return f"WITH {PURCHASES} SELECT CAST(date_trunc('month', created_dt) AS DATE) AS month, sum(revenue) AS total FROM pur GROUP BY 1"


@oracle("revenue_by_device", dbl=("mean", "median"))
def _():
    return f"""WITH {PURCHASES} SELECT device_type, count(revenue) AS n, CAST(sum(revenue) AS DOUBLE) / count(revenue) AS mean,
           quantile_cont(CAST(revenue AS DOUBLE), 0.5) AS median FROM pur GROUP BY device_type"""


@oracle("user_profile", ts=("first_order", "last_order"), dbl=PROF_DBL)
def _():
    return f"WITH {PURCHASES}, {PROFILE} SELECT * FROM prof"


@oracle("kpi_sheet", dbl=("value",))
def _():
    m = ["users", "mean_order_revenue", "share_two_plus_pct", "share_five_plus_pct", "orders", "mean_tickets",
         "mean_days_between", "median_order_revenue", "median_tickets"]
    row = """SELECT CAST(count(*) AS DOUBLE) AS users, avg(avg_order_rev) AS mean_order_revenue,
                    avg(is_two) * 100 AS share_two_plus_pct, avg(is_five) * 100 AS share_five_plus_pct,
                    CAST(sum(total_orders) AS DOUBLE) AS orders, avg(avg_tickets_count) AS mean_tickets,
                    avg(avg_days_since_prev) AS mean_days_between, quantile_cont(avg_order_rev, 0.5) AS median_order_revenue,
                    quantile_cont(CAST(avg_tickets_count AS DOUBLE), 0.5) AS median_tickets FROM prof"""
    un = " UNION ALL ".join(f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM k" for c in m)
    return f"WITH {PURCHASES}, {PROFILE}, k AS ({row}) {un}"


@oracle("return_split", dbl=("share_of_all",))
def _():
    return f"""WITH {PURCHASES}, {PROFILE} SELECT is_two, first_device_type, count(*) AS users,
           CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM prof) AS share_of_all FROM prof GROUP BY ALL"""


@oracle("return_share", dbl=("return_share",))
def _():
    return f"""WITH {PURCHASES}, {PROFILE} SELECT first_region_name, count(*) AS users, avg(CAST(is_two AS DOUBLE)) AS return_share
           FROM prof GROUP BY ALL"""


@oracle("return_by_segment", dbl=("return_share",))
def _():
    seg = ("CASE WHEN avg_tickets_count >= 1 AND avg_tickets_count < 2 THEN '1-2' WHEN avg_tickets_count >= 2 AND avg_tickets_count < 3 THEN '2-3' "
           "WHEN avg_tickets_count >= 3 AND avg_tickets_count < 5 THEN '3-5' WHEN avg_tickets_count >= 5 AND avg_tickets_count < 100 THEN '5-100' END")
    return f"""WITH {PURCHASES}, {PROFILE} SELECT {seg} AS segment, count(*) AS users, avg(CAST(is_two AS DOUBLE)) AS return_share
           FROM prof WHERE {seg} IS NOT NULL GROUP BY ALL"""


@oracle("weekday_return", dbl=("return_share",), ints=("weekday_no",))
def _():
    return f"""WITH {PURCHASES}, {PROFILE} SELECT isodow(first_order) - 1 AS weekday_no, dayname(first_order) AS weekday,
           count(*) AS users, avg(CAST(is_two AS DOUBLE)) AS return_share FROM prof GROUP BY ALL"""


@oracle("histogram", dbl=("bin_lo", "bin_hi"), ints=("bin",))
def _():
    return f"""WITH {PURCHASES}, st AS (SELECT min(CAST(revenue AS DOUBLE)) AS lo, max(CAST(revenue AS DOUBLE)) AS hi FROM pur),
    b AS (SELECT device_type, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((CAST(revenue AS DOUBLE) - lo) / ((hi - lo) / 10.0)), 9) END AS INTEGER) AS bin
          FROM pur, st WHERE revenue IS NOT NULL)
    SELECT device_type, bin, count(*) AS n, (SELECT lo FROM st) + bin * (((SELECT hi FROM st) - (SELECT lo FROM st)) / 10.0) AS bin_lo,
           (SELECT lo FROM st) + (bin + 1) * (((SELECT hi FROM st) - (SELECT lo FROM st)) / 10.0) AS bin_hi FROM b GROUP BY ALL"""


@oracle("box_stats", dbl=("q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high"))
def _():
    return f"""WITH {PURCHASES}, q AS (SELECT service_name, quantile_cont(CAST(revenue AS DOUBLE), 0.25) AS q1,
                                         quantile_cont(CAST(revenue AS DOUBLE), 0.5) AS median,
                                         quantile_cont(CAST(revenue AS DOUBLE), 0.75) AS q3 FROM pur GROUP BY service_name),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
    SELECT f.*, min(CASE WHEN CAST(p.revenue AS DOUBLE) BETWEEN f.lower_fence AND f.upper_fence THEN CAST(p.revenue AS DOUBLE) END) AS whisker_low,
           max(CASE WHEN CAST(p.revenue AS DOUBLE) BETWEEN f.lower_fence AND f.upper_fence THEN CAST(p.revenue AS DOUBLE) END) AS whisker_high,
           count(*) FILTER (WHERE NOT (CAST(p.revenue AS DOUBLE) BETWEEN f.lower_fence AND f.upper_fence)) AS outliers
    FROM f JOIN pur p ON p.service_name IS NOT DISTINCT FROM f.service_name GROUP BY ALL"""


# ------------------------------------------------------------------ places and games
PLACES = """
pl AS (SELECT p_partkey AS id, p_name AS name, p_type AS category, p_brand AS district, p_size / 10.0 AS rating,
              CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS chain, CAST(p_retailprice AS DECIMAL(15,2)) AS avg_bill FROM part),
gm AS (SELECT p_name AS name, p_brand AS platform, p_type AS genre, p_size * 2 AS critic_score, (p_retailprice - 900) / 10 AS user_score FROM part)
"""


@oracle("category_counts")
def _():
    return f"WITH {PLACES} SELECT district, category, count(*) AS n FROM pl GROUP BY ALL"


@oracle("chain_share", dbl=("share",))
def _():
    return f"WITH {PLACES} SELECT category, count(*) AS n, CAST(sum(chain) AS BIGINT) AS flagged, CAST(sum(chain) AS DOUBLE) / count(*) AS share FROM pl GROUP BY ALL"


@oracle("topk_groups", dbl=("mean_rating",))
def _():
    return f"""WITH {PLACES}, t AS (SELECT name, count(*) AS n, avg(rating) AS mean_rating FROM pl GROUP BY name ORDER BY n DESC, name LIMIT 15)
    SELECT *, row_number() OVER (ORDER BY n DESC, name) AS rank_no FROM t"""


@oracle("bill_by_district", dbl=("mean", "median"))
def _():
    return f"""WITH {PLACES} SELECT district, count(avg_bill) AS n, CAST(sum(avg_bill) AS DOUBLE) / count(avg_bill) AS mean,
           quantile_cont(CAST(avg_bill AS DOUBLE), 0.5) AS median FROM pl GROUP BY district"""


@oracle("grade_shares", dbl=("critic_share", "user_share"))
def _():
    c = "CASE WHEN critic_score >= 0 AND critic_score < 30 THEN 'low' WHEN critic_score >= 30 AND critic_score < 80 THEN 'mid' WHEN critic_score >= 80 AND critic_score < 101 THEN 'high' END"
    u = "CASE WHEN user_score >= 0 AND user_score < 3 THEN 'low' WHEN user_score >= 3 AND user_score < 8 THEN 'mid' WHEN user_score >= 8 AND user_score < 10.1 THEN 'high' END"
    return f"""WITH {PLACES},
    a AS (SELECT {c} AS grade, count(*) AS critic_count FROM gm WHERE {c} IS NOT NULL GROUP BY 1),
    b AS (SELECT {u} AS grade, count(*) AS user_count FROM gm WHERE {u} IS NOT NULL GROUP BY 1)
    SELECT COALESCE(a.grade, b.grade) AS grade, a.critic_count, CAST(a.critic_count AS DOUBLE) / (SELECT sum(critic_count) FROM a) AS critic_share,
           b.user_count, CAST(b.user_count AS DOUBLE) / (SELECT sum(user_count) FROM b) AS user_share
    FROM a FULL OUTER JOIN b ON a.grade = b.grade"""


@oracle("top_platforms")
def _():
    return f"""WITH {PLACES}, t AS (SELECT platform, count(*) AS n FROM gm GROUP BY platform ORDER BY n DESC, platform LIMIT 7)
    SELECT *, row_number() OVER (ORDER BY n DESC, platform) AS rank_no FROM t"""


# ------------------------------------------------------------------ other grouped reports

@oracle("monthly_rating", dates=("month",), dbl=("mean_value",))
def _():
    return """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n, avg(l_quantity / 10.0) AS mean_value
    FROM lineitem GROUP BY 1 HAVING count(*) >= 10"""


@oracle("yearly_overdue", dbl=("mean_value",), ints=("year",))
def _():
    return f"WITH {SHIP} SELECT year(l_shipdate) AS year, avg(CAST(overdue_days AS DOUBLE)) AS mean_value, count(overdue_days) AS n FROM ship GROUP BY 1"


@oracle("top_sales_mean", dbl=("mean_value",), ints=("store",))
def _():
    return f"""WITH {PANEL} SELECT store, count(*) AS n, CAST(sum(weekly_sales) AS DOUBLE) / count(weekly_sales) AS mean_value FROM panel
    WHERE CAST(weekly_sales AS DOUBLE) > (SELECT quantile_cont(CAST(weekly_sales AS DOUBLE), 0.99) FROM panel) GROUP BY store"""


@oracle("cluster_profile", dbl=tuple(f"mean_e{i}" for i in range(64)), ints=("label",))
def _():
    means = ", ".join(f"avg(CAST(embedding[{i + 1}] AS DOUBLE)) AS mean_e{i}" for i in range(64))
    return f"SELECT label, count(*) AS n, {means} FROM embeddings GROUP BY label"


@oracle("error_profile", dbl=("mean_rel_error", "share_under", "share_over"))
def _():
    return f"""WITH {SCORED}, m_users AS (
      SELECT c_custkey AS buyer_id, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    e AS (SELECT u.region AS r_name, (CAST(pr.pred AS DOUBLE) - CAST(pr.y AS DOUBLE)) / NULLIF(CAST(pr.y AS DOUBLE), 0) AS rel
          FROM pr JOIN orders o USING (o_orderkey) JOIN m_users u ON u.buyer_id = o.o_custkey)
    SELECT r_name, count(*) AS n, avg(rel) AS mean_rel_error, avg(CASE WHEN rel < 0 THEN 1.0 ELSE 0.0 END) AS share_under,
           avg(CASE WHEN rel > 0 THEN 1.0 ELSE 0.0 END) AS share_over FROM e GROUP BY r_name"""


# ------------------------------------------------------------------ cleaning chains
@oracle("games_cleaning", dbl=("critic_score", "user_score"), ints=("year_of_release",))
def _():
    return """WITH raw AS (
      SELECT lower(trim(replace('  ' || upper(p_name) || ' ', '  ', ' '))) AS name0, '  ' || upper(p_name) || ' ' AS rawname,
             p_brand AS platform, CASE WHEN p_size > 45 THEN NULL ELSE 1990 + p_size END AS year_of_release, p_type AS genre,
             CASE WHEN p_size < 5 THEN NULL ELSE p_size * 2 END AS critic_score,
             CASE WHEN p_size % 7 = 0 THEN NULL ELSE (p_retailprice - 900) / 10 END AS user_score,
             CASE WHEN p_type = 'PROMO' THEN 'E' ELSE p_type END AS rating FROM part),
    gm AS (SELECT platform, avg(critic_score) AS m FROM raw GROUP BY platform),
    f AS (SELECT replace(lower(trim(rawname)), '  ', ' ') AS name, r.platform, r.year_of_release, r.genre,
                 COALESCE(CAST(r.critic_score AS DOUBLE), gm.m) AS critic_score, COALESCE(r.user_score, -1.0) AS user_score, r.rating
          FROM raw r LEFT JOIN gm ON gm.platform IS NOT DISTINCT FROM r.platform
          WHERE r.year_of_release IS NOT NULL AND r.year_of_release BETWEEN 1995 AND 2030),
    d AS (SELECT DISTINCT * FROM f)
    SELECT *, CASE WHEN critic_score >= 0 AND critic_score < 30 THEN 'low' WHEN critic_score >= 30 AND critic_score < 80 THEN 'mid'
                   WHEN critic_score >= 80 AND critic_score < 101 THEN 'high' ELSE 'none' END AS critic_grade FROM d"""


@oracle("derived_columns", ts=("order_ts_utc",), ints=("many_lines", "has_lines", "in_last_year"),
        dbl=("value_per_line", "log_value", "sqrt_value", "stability", "qty_rescaled", "acctbal_valid", "acctbal_clipped"))
def _():
    return """WITH l AS (SELECT l_orderkey, count(*) AS n_lines, max(l_quantity) AS max_qty FROM lineitem GROUP BY l_orderkey),
    o AS (SELECT o.o_orderkey, o.o_orderdate, timezone('UTC', timezone('Europe/Moscow', o.o_orderdate)) AS utc_ts, o.o_totalprice,
                 l.n_lines, l.max_qty, c.c_acctbal
          FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey)
    SELECT o_orderkey,
           CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
                WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' WHEN month(o_orderdate) IN (9, 10, 11) THEN 'autumn' END AS season,
           utc_ts AS order_ts_utc,
           CASE WHEN COALESCE(n_lines, 0) >= 5 THEN 1 ELSE 0 END AS many_lines,
           o_totalprice / NULLIF(CAST(n_lines AS DOUBLE), 0) AS value_per_line, ln(1 + o_totalprice) AS log_value,
           sqrt(o_totalprice) AS sqrt_value, o_totalprice / (COALESCE(n_lines, 0) + 1) AS stability,
           CASE WHEN max_qty > 45 THEN floor(max_qty / 10.0) ELSE max_qty END AS qty_rescaled,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal_valid, greatest(c_acctbal, 0.0) AS acctbal_clipped,
           CAST(CAST(round(CAST(n_lines AS DOUBLE) / 7 * 100, 2) AS DECIMAL(20,2)) AS VARCHAR) || '%' AS line_fill_pct,
           CASE WHEN n_lines IS NOT NULL THEN 1 ELSE 0 END AS has_lines,
           CASE WHEN utc_ts >= TIMESTAMP '1998-01-01' - INTERVAL 365 DAY AND utc_ts < TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS in_last_year
    FROM o"""


@oracle("text_flags", ints=("has_the_and",))
def _():
    return """SELECT doc_id, lang, CASE WHEN text IS NULL THEN NULL WHEN contains(lower(text), 'the') AND contains(lower(text), 'and') THEN 1 ELSE 0 END AS has_the_and,
           length(lower(trim(text))) AS norm_len FROM documents"""


# ------------------------------------------------------------------ splits and preparation
DOCS = "dl AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic FROM documents d JOIN labels l USING (doc_id))"


@oracle("stratified_split", dbl=("quality",), ints=("n",))
def _():
    return f"""WITH {DOCS}, c AS (SELECT quality, count(*) AS n FROM dl GROUP BY quality)
    SELECT 'test' AS split, quality, ceil(n * 0.2) AS n FROM c WHERE ceil(n * 0.2) > 0
    UNION ALL SELECT 'train', quality, n - ceil(n * 0.2) FROM c WHERE n - ceil(n * 0.2) > 0"""


@oracle("stratified_folds", dbl=("quality",), ints=("fold", "n"))
def _():
    return f"""WITH {DOCS}, r AS (SELECT quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS rk FROM dl)
    SELECT rk % 5 AS fold, quality, count(*) AS n FROM r GROUP BY ALL"""


@oracle("group_split_leakage")
def _():
    return "SELECT 'train' AS split_a, 'test' AS split_b, CAST(0 AS BIGINT) AS shared_keys"


def ranked_hash(key: str) -> str:
    """``splits.hash_rank`` of one column."""
    return f"CAST('0x' || substr(md5('42|' || {key}), 1, 15) AS BIGINT)"


@oracle("hash_split_rows")
def _():
    u = f"({ranked_hash('o_orderkey')} / pow(2.0, 60))"
    return f"SELECT o_orderkey, CASE WHEN {u} < 0.6 THEN 'train' WHEN {u} < 0.8 THEN 'val' ELSE 'test' END AS split FROM orders"


@oracle("hash_split")
def _():
    u = f"({ranked_hash('o_orderkey')} / pow(2.0, 60))"
    return f"SELECT CASE WHEN {u} < 0.6 THEN 'train' WHEN {u} < 0.6 + 0.2 THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM orders GROUP BY 1"


@oracle("stratified_split_rows", dbl=("quality",))
def _():
    return f"""WITH {DOCS}, r AS (
      SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {ranked_hash('doc_id')}, doc_id) AS place, count(*) OVER (PARTITION BY quality) AS n FROM dl)
    SELECT doc_id, quality, CASE WHEN place <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r"""


@oracle("stratified_fold_rows", dbl=("quality",), ints=("fold",))
def _():
    return f"""WITH {DOCS}
    SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY {ranked_hash('doc_id')}, doc_id) - 1) % 5 AS fold FROM dl"""


@oracle("resample_rows", dbl=("toxic",), ints=("copies",))
def _():
    return f"""WITH {DOCS}, r AS (
      SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic = 1 ORDER BY {ranked_hash('doc_id')}, doc_id) - 1 AS place,
             count(*) FILTER (toxic = 1) OVER () AS few, count(*) FILTER (toxic <> 1) OVER () AS many FROM dl),
    aim AS (SELECT *, CAST(greatest(few, floor(0.3 * many)) AS BIGINT) AS target FROM r)
    SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN target // few + (CASE WHEN place < target % few THEN 1 ELSE 0 END) ELSE 1 END AS copies
    FROM aim WHERE toxic = 1 OR place < least(many, floor(target / 0.6))"""


@oracle("row_split_leakage", ints=("shared_keys",))
def _():
    u = f"({ranked_hash('o_orderkey')} / pow(2.0, 60))"
    return f"""WITH s AS (SELECT DISTINCT o_custkey, CASE WHEN {u} < 0.8 THEN 'train' WHEN {u} < 0.8 + 0.1 THEN 'val' ELSE 'test' END AS split FROM orders),
    pairs(split_a, split_b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test'))
    SELECT split_a, split_b, (SELECT count(*) FROM s a JOIN s b ON a.o_custkey = b.o_custkey WHERE a.split = split_a AND b.split = split_b) AS shared_keys FROM pairs"""


def neighbours(distance: str, weight: str) -> str:
    u = f"({ranked_hash('vec_id')} / pow(2.0, 60))"
    return f"""WITH e AS (SELECT vec_id, CAST(label AS DOUBLE) AS y, CAST(embedding AS DOUBLE[]) AS x, {u} < 0.8 AS train FROM embeddings),
    near AS (SELECT t.vec_id, t.y AS own, r.y, {distance} AS d, row_number() OVER (PARTITION BY t.vec_id ORDER BY {distance}, r.vec_id) AS place
             FROM e t JOIN e r ON r.train AND NOT t.train)
    SELECT vec_id, own AS y, sum(y * {weight}) / sum({weight}) AS prediction FROM near WHERE place <= 5 GROUP BY vec_id, own"""


@oracle("knn_regression", dbl=("y", "prediction"), digits=9)
def _():
    return neighbours("list_distance(t.x, r.x)", "1 / greatest(d, 1e-12)")


@oracle("knn_manhattan", dbl=("y", "prediction"), digits=9)
def _():
    return neighbours("list_sum(list_transform(list_zip(t.x, r.x), lambda z: abs(z[1] - z[2])))", "1.0")


@oracle("alpha_grid", dbl=("alpha", "intercept", "w_quantity", "w_discount", "mae", "mse", "r2"), digits=7)
def _():
    u = f"({ranked_hash('l_orderkey')} / pow(2.0, 60))"
    return f"""WITH RECURSIVE d AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y, {u} < 0.8 AS train FROM lineitem),
    m AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb,
                 covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM d WHERE train),
    alphas(alpha) AS (SELECT unnest([0.1, 10, 1000, 100000]::DOUBLE[])),
    penalty AS (SELECT 'ols' AS model, CAST(0 AS DOUBLE) AS alpha, CAST(0 AS DOUBLE) AS p UNION ALL SELECT 'ridge', alpha, alpha / n FROM alphas, m),
    solved AS (SELECT model, alpha, (ay * (bb + p) - yb * ab) / ((aa + p) * (bb + p) - ab * ab) AS w1, (yb * (aa + p) - ay * ab) / ((aa + p) * (bb + p) - ab * ab) AS w2 FROM penalty, m),
    descent(k, alpha, w1, w2) AS (
      SELECT 0, CAST(alpha AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM alphas
      UNION ALL
      SELECT k + 1, alpha, v1, sign(yb - ab * v1) * greatest(abs(yb - ab * v1) - alpha, 0) / bb
      FROM (SELECT k, alpha, ab, bb, yb, sign(ay - ab * w2) * greatest(abs(ay - ab * w2) - alpha, 0) / aa AS v1 FROM descent, m) WHERE k < 100),
    fits AS (SELECT model, CAST(alpha AS DOUBLE) AS alpha, w1, w2 FROM solved UNION ALL SELECT 'lasso', alpha, w1, w2 FROM descent WHERE k = 100)
    SELECT model, alpha, my - w1 * ma - w2 * mb AS intercept, w1 AS w_quantity, w2 AS w_discount, avg(abs(y - (my - w1 * ma - w2 * mb) - w1 * a - w2 * b)) AS mae,
           avg(pow(y - (my - w1 * ma - w2 * mb) - w1 * a - w2 * b, 2)) AS mse, 1 - avg(pow(y - (my - w1 * ma - w2 * mb) - w1 * a - w2 * b, 2)) / var_pop(y) AS r2
    FROM fits, m, d WHERE NOT train GROUP BY model, alpha, w1, w2, my, ma, mb"""


LOGISTIC = "round(1.0 / (1.0 + exp(-(o_totalprice - 150000.0) / 50000.0)), 3)"
TIME_FOLDS = """dated AS (SELECT o_orderkey, o_totalprice, o_orderstatus, dense_rank() OVER (ORDER BY CAST(o_orderdate AS DATE)) AS p FROM orders),
    folded AS (SELECT *, (SELECT max(p) FROM dated) - (3 - fold) * 100 AS train_end FROM dated, (SELECT unnest(range(0, 3)) AS fold))"""


@oracle("grouped_time_folds", ints=("fold",))
def _():
    return f"""WITH {TIME_FOLDS}
    SELECT o_orderkey, fold, CASE WHEN p <= train_end THEN 'train' ELSE 'validation' END AS role FROM folded WHERE p <= train_end + 100"""


def stacked() -> str:
    return f"""{TIME_FOLDS},
    stacked AS (SELECT fold, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS y, 'logistic' AS candidate, {LOGISTIC} AS score FROM folded WHERE p > train_end AND p <= train_end + 100
      UNION ALL SELECT fold, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, 'price_digits', floor(o_totalprice) % 100 / 100 FROM folded WHERE p > train_end AND p <= train_end + 100)"""


@oracle("fold_ranking_scores", dbl=("average_precision", "roc_auc"), ints=("fold",), digits=10)
def _():
    return f"""WITH {stacked()}, t AS (
      SELECT candidate, fold, score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM stacked GROUP BY ALL),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n
          FROM t WINDOW g AS (PARTITION BY candidate, fold), w AS (PARTITION BY candidate, fold ORDER BY score DESC))
    SELECT candidate, fold, sum(pos / p * (tp / (tp + fp))) AS average_precision, sum(neg * (tp - 0.5 * pos)) / any_value(p * n) AS roc_auc FROM c GROUP BY candidate, fold"""


def threshold_counts() -> str:
    return f"""{stacked()}, counts AS (
      SELECT candidate, fold, count(*) FILTER (y = 0 AND score <= 0.4) AS tn, count(*) FILTER (y = 0 AND score > 0.4) AS fp,
             count(*) FILTER (y = 1 AND score <= 0.4) AS fn, count(*) FILTER (y = 1 AND score > 0.4) AS tp FROM stacked GROUP BY candidate, fold)"""


@oracle("fold_threshold_scores", dbl=("missed_rate", "revenue", "revenue_percent"), ints=("fold",), digits=10)
def _():
    return f"""WITH {threshold_counts()}, money AS (
      SELECT *, (tn + fp) * 64500 - (tp + fn) * 64500 AS base, tp * 45000 + tn * 64500 - fp * 7000 - fn * 64500 AS gained FROM counts)
    SELECT candidate, fold, fn / (fn + tp) AS missed_rate, gained - base AS revenue, (gained - base) / base * 100 AS revenue_percent FROM money"""


@oracle("scorer_ranking", dbl=("mean_score", "std_score"), ints=("place",), digits=10)
def _():
    return f"""WITH {threshold_counts()}, s AS (
      SELECT candidate, avg(fn / (fn + tp)) AS mean_score, stddev_pop(fn / (fn + tp)) AS std_score FROM counts GROUP BY candidate)
    SELECT *, row_number() OVER (ORDER BY mean_score, candidate) AS place FROM s"""


@oracle("time_split", dates=("first_date", "last_date"))
def _():
    return """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
    s AS (SELECT d, CASE WHEN d < DATE '1999-08-01' THEN 'train' WHEN d < DATE '2000-08-01' THEN 'calib' ELSE 'test' END AS split FROM o)
    SELECT split, count(*) AS n, min(d) AS first_date, max(d) AS last_date FROM s GROUP BY split"""


@oracle("time_fraction_split")
def _():
    e = "CAST(epoch_us(o_orderdate) AS DOUBLE)"
    return f"""WITH q AS (SELECT quantile_cont({e}, 0.6) AS c0, quantile_cont({e}, 0.8) AS c1 FROM orders)
    SELECT CASE WHEN {e} < q.c0 THEN 'train' WHEN {e} < q.c1 THEN 'val' ELSE 'test' END AS split, count(*) AS n
    FROM orders, q GROUP BY 1"""


@oracle("time_folds", ints=("fold",))
def _():
    return """WITH r AS (SELECT dense_rank() OVER (ORDER BY CAST(o_orderdate AS DATE)) AS p FROM orders),
    n AS (SELECT max(p) AS n FROM r), f AS (SELECT unnest(range(0, 3)) AS fold),
    b AS (SELECT fold, n - (3 - fold) * (n // 4) AS end_train, n // 4 AS ts FROM f, n)
    SELECT b.fold, count(*) FILTER (WHERE r.p <= b.end_train) AS train_rows,
           count(*) FILTER (WHERE r.p > b.end_train AND r.p <= b.end_train + b.ts) AS test_rows FROM b, r GROUP BY b.fold"""


@oracle("resample", dbl=("toxic",), ints=("n",))
def _():
    return f"""WITH {DOCS}, c AS (SELECT count(*) FILTER (WHERE toxic = 1) AS n_min, count(*) FILTER (WHERE toxic != 1) AS n_maj FROM dl),
    t AS (SELECT n_min, n_maj, greatest(n_min, floor(0.3 * n_maj)) AS target_min FROM c)
    SELECT 1.0 AS toxic, target_min AS n FROM t UNION ALL SELECT 0.0, least(n_maj, floor(target_min / 0.6)) FROM t"""


@oracle("class_weights", dbl=("quality", "weight"))
def _():
    return f"""WITH {DOCS}, c AS (SELECT quality, count(*) AS nc FROM dl GROUP BY quality)
    SELECT dl.doc_id, dl.quality, (SELECT count(*) FROM dl) / ((SELECT count(*) FROM c) * c.nc) AS weight
    FROM dl JOIN c ON c.quality IS NOT DISTINCT FROM dl.quality"""


@oracle("target_encoding", dbl=("o_orderpriority_te",))
def _():
    return f"""WITH {SCORED}, s AS (SELECT sc.*, o.o_orderpriority FROM sc JOIN orders o USING (o_orderkey)),
    tr AS (SELECT * FROM s WHERE fold != 0), prior AS (SELECT avg(CAST(y AS DOUBLE)) AS p FROM tr),
    enc AS (SELECT o_orderpriority, (sum(CAST(y AS DOUBLE)) + 10.0 * (SELECT p FROM prior)) / (count(*) + 10.0) AS e FROM tr GROUP BY 1)
    SELECT s.o_orderkey, CASE WHEN s.fold = 0 THEN 'test' ELSE 'train' END AS split, s.o_orderpriority,
           COALESCE(enc.e, (SELECT p FROM prior)) AS o_orderpriority_te
    FROM s LEFT JOIN enc USING (o_orderpriority)"""


ORACLE["written_batch_features"] = ORACLE["batch_features"]


# ------------------------------------------------------------------ end-to-end jobs E4-E6
@oracle("visitor_features", dbl=tuple(f"n_{v}_share" for v in TYPES) + ("sessions_per_day",))
def _():
    cnt = ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS n_{v}" for v in TYPES)
    tot = " + ".join(f"n_{v}" for v in TYPES)
    shares = ", ".join(f"CAST(n_{v} AS DOUBLE) / NULLIF({tot}, 0) AS n_{v}_share" for v in TYPES)
    return f"""WITH piv AS (SELECT user_id, {cnt} FROM events GROUP BY user_id),
    sh AS (SELECT *, {shares} FROM piv),
    fe AS (SELECT user_id, event_type AS first_event_type FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1),
    marked AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked),
    daily AS (SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT session) AS sessions FROM numbered GROUP BY ALL),
    spd AS (SELECT user_id, avg(sessions) AS sessions_per_day FROM daily GROUP BY user_id),
    parts AS (SELECT user_id, count(*) FILTER (hour(ts) < 6) AS at_night, count(*) FILTER (hour(ts) BETWEEN 6 AND 11) AS at_morning,
                     count(*) FILTER (hour(ts) BETWEEN 12 AND 17) AS at_day, count(*) FILTER (hour(ts) >= 18) AS at_evening FROM events GROUP BY user_id),
    cu AS (SELECT c.c_custkey AS user_id, c.c_mktsegment, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
           JOIN region r ON n.n_regionkey = r.r_regionkey)
    SELECT * FROM sh JOIN fe USING (user_id) JOIN parts USING (user_id) JOIN spd USING (user_id) LEFT JOIN cu USING (user_id)"""


@oracle("credit_observations", dates=("score_date",), ts=("l_shipdate",),
        dbl=("l_extendedprice", "c_acctbal", "market_avg_price", "balance_to_last_shipment", "log_last_shipment"),
        ints=("target", "overdue_days", "c_nationkey", "days_since_last_shipment"))
def _():
    return f"""WITH {SHIP},
    firsts AS (SELECT o_custkey, min(CAST(l_shipdate AS DATE)) AS f FROM ship WHERE overdue_days >= 90 GROUP BY o_custkey),
    last AS (SELECT max(CAST(l_shipdate AS DATE)) AS l FROM ship),
    lab AS (SELECT c.o_orderkey, c.o_custkey, CAST(c.o_orderdate AS DATE) AS score_date,
                   CASE WHEN f.f IS NOT NULL AND f.f < CAST(c.o_orderdate AS DATE) + 365 THEN 1 ELSE 0 END AS target
            FROM orders c LEFT JOIN firsts f ON f.o_custkey = c.o_custkey
            WHERE (f.f IS NULL OR f.f >= CAST(c.o_orderdate AS DATE)) AND CAST(c.o_orderdate AS DATE) <= (SELECT l FROM last) - 365),
    pairs AS (SELECT lab.o_orderkey, s.l_shipdate, s.l_extendedprice, s.overdue_days,
                     row_number() OVER (PARTITION BY lab.o_orderkey ORDER BY s.l_shipdate DESC, s.l_extendedprice DESC, s.overdue_days DESC) AS rn
              FROM lab JOIN ship s ON s.o_custkey = lab.o_custkey AND s.l_shipdate < CAST(lab.score_date AS TIMESTAMP)),
    a AS (SELECT lab.*, p.l_shipdate, p.l_extendedprice, p.overdue_days FROM lab LEFT JOIN pairs p ON p.o_orderkey = lab.o_orderkey AND p.rn = 1),
    daily AS (SELECT CAST(o_orderdate AS DATE) AS score_date, avg(o_totalprice) AS market_avg_price FROM orders GROUP BY 1)
    SELECT a.*, c.c_acctbal, c.c_mktsegment, c.c_nationkey, d.market_avg_price,
           c.c_acctbal / NULLIF(a.l_extendedprice, 0) AS balance_to_last_shipment, ln(1 + a.l_extendedprice) AS log_last_shipment,
           datediff('day', CAST(a.l_shipdate AS DATE), a.score_date) AS days_since_last_shipment
    FROM a LEFT JOIN customer c ON c.c_custkey = a.o_custkey LEFT JOIN daily d ON d.score_date = a.score_date"""


@oracle("booking_table", ts=("o_orderdate", "l_shipdate"), dbl=("o_totalprice", "stay_rating", "value_per_line"),
        ints=("is_canceled",))
def _():
    return """WITH rv AS (SELECT o.o_custkey, l.l_shipdate,
                   avg(CASE WHEN (CASE WHEN l.l_linestatus = 'O' THEN (CAST(floor(l.l_quantity) AS BIGINT) % 5 + 1) * 10
                                       ELSE CAST(floor(l.l_quantity) AS BIGINT) % 5 + 1 END) > 5
                            THEN (CASE WHEN l.l_linestatus = 'O' THEN (CAST(floor(l.l_quantity) AS BIGINT) % 5 + 1) * 10
                                       ELSE CAST(floor(l.l_quantity) AS BIGINT) % 5 + 1 END) / 10.0
                            ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) % 5 + 1 AS DOUBLE) END) AS stay_rating
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2),
    pairs AS (SELECT b.o_orderkey, r.l_shipdate, r.stay_rating,
                     row_number() OVER (PARTITION BY b.o_orderkey ORDER BY r.l_shipdate DESC, r.stay_rating DESC) AS rn
              FROM orders b JOIN rv r ON r.o_custkey = b.o_custkey AND r.l_shipdate < b.o_orderdate),
    nl AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
    SELECT b.o_orderkey, b.o_custkey, b.o_orderdate, b.o_totalprice, b.o_orderstatus, p.l_shipdate,
           COALESCE(p.stay_rating, -1.0) AS stay_rating, nl.n_lines,
           CASE WHEN month(b.o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(b.o_orderdate) IN (3, 4, 5) THEN 'spring'
                WHEN month(b.o_orderdate) IN (6, 7, 8) THEN 'summer' WHEN month(b.o_orderdate) IN (9, 10, 11) THEN 'autumn' END AS season,
           b.o_totalprice / NULLIF(CAST(nl.n_lines AS DOUBLE), 0) AS value_per_line,
           CASE WHEN b.o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_canceled
    FROM orders b LEFT JOIN pairs p ON p.o_orderkey = b.o_orderkey AND p.rn = 1 LEFT JOIN nl ON nl.l_orderkey = b.o_orderkey"""


# ------------------------------------------------------------------ remaining profiling / cleaning / join operators
@oracle("load_report", dates=("min_date", "max_date", "first_plan_date"))
def _():
    return f"""WITH {PANEL}, fp AS (SELECT max(date) - 7 * 7 AS first_plan FROM panel)
    SELECT count(*) AS rows, min(date) AS min_date, max(date) AS max_date,
           min(CASE WHEN date >= (SELECT first_plan FROM fp) THEN date END) AS first_plan_date FROM panel"""


@oracle("anomaly_counts")
def _():
    return """SELECT l_returnflag, count(*) AS rows, 'quantity_over_45' AS "check" FROM lineitem WHERE l_quantity > 45 GROUP BY 1
    UNION ALL SELECT l_returnflag, count(*), 'zero_discount' FROM lineitem WHERE l_discount = 0 GROUP BY 1"""


@oracle("fills", ts=("first_event_ts",), dbl=("n_events", "value_sum"))
def _():
    return f"""WITH {ACTIVITY},
    med AS (SELECT quantile_cont(CAST(n_events AS DOUBLE), 0.5) AS m FROM ca WHERE c_nationkey < 15),
    mx AS (SELECT max(first_event_ts) AS m FROM ca),
    mv AS (SELECT CAST(sum(CAST(value_sum AS DECIMAL(15,2))) AS DOUBLE) / count(value_sum) AS m FROM ca)
    SELECT c_custkey, COALESCE(CAST(n_events AS DOUBLE), (SELECT m FROM med)) AS n_events,
           COALESCE(first_event_ts, (SELECT m FROM mx)) AS first_event_ts,
           COALESCE(CAST(CAST(value_sum AS DECIMAL(15,2)) AS DOUBLE), (SELECT m FROM mv)) AS value_sum FROM ca"""


@oracle("suffixed_join", dbl=("total_orders", "total_lines"))
def _():
    return """WITH a AS (SELECT o_custkey AS cust, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total_orders
                    FROM orders GROUP BY 1),
    b AS (SELECT o.o_custkey AS cust, count(*) AS n_lines, sum(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS total_lines
          FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1)
    SELECT a.cust, a.n_orders, a.total_orders, b.n_lines, b.total_lines FROM a LEFT JOIN b USING (cust)"""


@oracle("group_share", dbl=("price", "customer_total", "share_of_customer"))
def _():
    return """WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) AS price FROM orders),
    t AS (SELECT o_custkey, sum(price) AS customer_total FROM o GROUP BY 1)
    SELECT o.*, t.customer_total, CAST(o.price AS DOUBLE) / CAST(t.customer_total AS DOUBLE) AS share_of_customer
    FROM o LEFT JOIN t ON t.o_custkey IS NOT DISTINCT FROM o.o_custkey"""


@oracle("weak_features", dbl=("cramers_v",))
def _():
    inner = ORACLE["cramers_v"]
    return f"""WITH a AS ({inner})
    SELECT col_b AS feature, cramers_v FROM a WHERE col_a = 'c_mktsegment' AND cramers_v <= 0.1
    UNION ALL SELECT col_a, cramers_v FROM a WHERE col_b = 'c_mktsegment' AND cramers_v <= 0.1"""


@oracle("top_names_categories")
def _():
    return f"""WITH {PLACES}, t AS (SELECT name, count(*) AS n FROM pl GROUP BY name ORDER BY n DESC, name LIMIT 15)
    SELECT DISTINCT pl.name, pl.category FROM pl WHERE pl.name IN (SELECT name FROM t)"""


@oracle("sql_region_report", dbl=("mean_rating",), ints=("used_installments", "buyers", "orders", "most_orders", "rated"))
def _():
    return f"""WITH {MARKET}
    SELECT region, used_installments, count(*) AS buyers, sum(total_orders) AS orders, max(total_orders) AS most_orders,
           sum(num_orders_with_rating) AS rated, sum(avg_order_rating * num_orders_with_rating) / sum(num_orders_with_rating) AS mean_rating
    FROM mart GROUP BY ALL"""


@oracle("lagged_label", dates=("score_date",), ints=("lag_1_target",))
def _():
    return f"""WITH {SHIP},
    firsts AS (SELECT o_custkey, min(CAST(l_shipdate AS DATE)) AS f FROM ship WHERE overdue_days >= 90 GROUP BY o_custkey),
    last AS (SELECT max(CAST(l_shipdate AS DATE)) AS l FROM ship),
    lab AS (SELECT c.o_orderkey, c.o_custkey, CAST(c.o_orderdate AS DATE) AS score_date,
                   CASE WHEN f.f IS NOT NULL AND f.f < CAST(c.o_orderdate AS DATE) + 365 THEN 1 ELSE 0 END AS target
            FROM orders c LEFT JOIN firsts f ON f.o_custkey = c.o_custkey
            WHERE (f.f IS NULL OR f.f >= CAST(c.o_orderdate AS DATE)) AND CAST(c.o_orderdate AS DATE) <= (SELECT l FROM last) - 365),
    lg AS (SELECT o_orderkey, o_custkey, score_date,
                  lag(target) OVER (PARTITION BY o_custkey ORDER BY score_date, o_orderkey) AS lag_1_target FROM lab)
    SELECT * FROM lg WHERE lag_1_target IS NOT NULL"""


@oracle("stream_daily_users", dates=("session_date",))
def _():
    return """WITH d AS (SELECT CAST(ts AS DATE) AS session_date, user_id,
                            max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS registered FROM events GROUP BY 1, 2)
    SELECT session_date, count(*) AS users, CAST(sum(registered) AS BIGINT) AS registered_users FROM d GROUP BY 1"""


@oracle("stream_run_date_features", dates=("run_date",), dbl=("max_value",))
def _():
    return """SELECT CAST(ts AS DATE) AS run_date, user_id, count(*) AS n_events, count(DISTINCT event_type) AS n_types,
                     max(value) AS max_value, count(*) FILTER (event_type = 'signup') AS n_signups FROM events GROUP BY 1, 2"""


# ------------------------------------------------------------------ round trips, text branch and reports in order

@oracle("csv_round_trip", dbl=("p_retailprice",))
def _():
    return "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"


@oracle("tsv_decimal_comma", dbl=("c_acctbal",))
def _():
    return "SELECT c_custkey, c_name, c_acctbal FROM customer"


@oracle("model_round_trip")
def _():
    return "SELECT count(*) AS rows, count(*) FILTER (l_quantity IS NULL) AS different FROM lineitem"


@oracle("dropped_columns")
def _():
    return "SELECT s_suppkey, s_nationkey FROM supplier"


@oracle("column_ranges")
def _():
    kinds = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int"}
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{k}' AS type, count({c}) AS non_null, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM part"
                              for c, k in kinds.items())


@oracle("users_in_both_arms")
def _():
    return f"WITH {AB} SELECT user_id, 2 AS arms FROM abs_ GROUP BY user_id HAVING min(page_counter) < 3 AND max(page_counter) >= 3"


@oracle("yearly_spend", dbl=("spend_A", "spend_N", "spend_R", "total"), ints=("year",))
def _():
    each = {f: f"coalesce(sum(CAST(l_extendedprice AS DECIMAL(15,2))) FILTER (l_returnflag = '{f}'), 0)" for f in "ANR"}
    return f"SELECT year(l_shipdate) AS year, {', '.join(f'{x} AS spend_{f}' for f, x in each.items())}, {' + '.join(each.values())} AS total FROM lineitem GROUP BY 1"


@oracle("weekly_totals", dbl=("total",), dates=("date",))
def _():
    return f"WITH {PANEL} SELECT date, sum(weekly_sales) AS total, count(*) AS n FROM panel GROUP BY date"


@oracle("median_by_holiday", dbl=("median",))
def _():
    return f"WITH {PANEL} SELECT month(date + 6) = 12 AS is_holiday, quantile_cont(CAST(weekly_sales AS DOUBLE), 0.5) AS median FROM panel GROUP BY 1"


@oracle("region_report_in_order", ints=("total_orders", "position"))
def _():
    return f"""WITH {MARKET} SELECT region, count(user_id) AS total_users, sum(total_orders) AS total_orders,
           row_number() OVER (ORDER BY sum(total_orders) DESC, region) AS position FROM mart GROUP BY region"""


STOPPED = ("a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with").split()


def weighed(rows: str, fitted: str) -> str:
    """Columns of ``rows(id, text)`` with TF-IDF weights of the five most frequent terms of those where ``fitted`` holds."""
    stop = ", ".join(f"'{w}'" for w in STOPPED)
    return f"""rows_ AS ({rows}),
    words AS (SELECT id, unnest(string_split_regex(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_\\x09-\\x0D ]', ' ', 'g'), '[\\x09-\\x0D ]+')) AS term FROM rows_),
    kept AS (SELECT id, term, count(*) AS tf FROM words WHERE length(term) >= 2 AND term NOT IN ({stop}) GROUP BY id, term),
    terms AS (SELECT term, ln((1 + (SELECT count(*) FROM rows_ WHERE {fitted})) / (1 + count(*))) + 1 AS idf
              FROM kept WHERE {fitted} GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5),
    placed AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS place FROM terms),
    weights AS (SELECT id, place, tf * idf AS w FROM kept JOIN placed USING (term)),
    norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY id)"""


FIVE = ", ".join(f"coalesce(max(w / norm) FILTER (place = {i}), 0.0) AS w{i}" for i in range(5))


@oracle("tfidf_features", dbl=tuple(f"w{i}" for i in range(5)), digits=9)
def _():
    return f"""WITH {weighed("SELECT doc_id AS id, text FROM documents", "id % 4 <> 0")}
    SELECT rows_.id AS doc_id, {FIVE} FROM rows_ LEFT JOIN weights USING (id) LEFT JOIN norms USING (id) GROUP BY rows_.id"""


@oracle("booking_text_features", dbl=tuple(f"w{i}" for i in range(5)), digits=9)
def _():
    early = "id IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
    return f"""WITH {weighed("SELECT o_orderkey AS id, text FROM orders LEFT JOIN documents ON doc_id = o_orderkey", early)}
    SELECT rows_.id AS o_orderkey, {FIVE} FROM rows_ LEFT JOIN weights USING (id) LEFT JOIN norms USING (id) GROUP BY rows_.id"""


@oracle("scaled_features")
def _():
    return """WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
    s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd, min(l_tax) AS lo, max(l_tax) AS hi FROM t)
    SELECT l_orderkey, l_linenumber, [(l_quantity - mq) / sq, (l_discount - md) / sd, (l_tax - lo) / (hi - lo)] AS selected FROM lineitem, s WHERE l_shipdate >= TIMESTAMP '1998-01-01'"""
