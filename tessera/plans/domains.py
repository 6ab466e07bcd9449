"""Views of the driver tables in the roles the operators expect.

Each function derives a canonical input from the given tables only (no
made-up rows), so every registered query grows with the data. The same
derivations are written as SQL CTEs in ``tessera.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.io import read_table


def money(c, scale: int = 2):
    """Money as an exact decimal, so sums do not depend on summation order."""
    return c.cast(f"decimal(15,{scale})")


def rate(c):
    """A 2-decimal rate (tax, discount) as an exact decimal; products of money
    and rates are then exact, never rounded."""
    return c.cast("decimal(4,2)")


class Tables:
    """Lazy access to the parquet tables of one data directory."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "base"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]


# ------------------------------------------------------------------ marketplace (MART)
# Order status codes used as delivered / cancelled, and payment kinds.
DELIVERED, CANCELLED = "F", "P"
TRANSFER, PROMO, CARD = "transfer", "promo", "card"


def market_orders(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("buyer_id"),
                           F.col("o_orderstatus").alias("order_status"),
                           F.col("o_orderdate").alias("order_purchase_ts"))


def customer_region(t: Tables) -> DataFrame:
    """customer -> nation -> region (dimension chain; nation/region are tiny)."""
    return (t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
            .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", "n_name"), "c_nationkey")
            .join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey"))


def market_users(t: Tables) -> DataFrame:
    return customer_region(t).select(F.col("c_custkey").alias("buyer_id"), F.col("c_custkey").alias("user_id"),
                                     F.col("r_name").alias("region"))


def market_payments(t: Tables) -> DataFrame:
    """One payment per line: sequence = line number, kind from the return flag,
    installments from the quantity."""
    kind = (F.when(F.col("l_returnflag") == "A", F.lit(TRANSFER))
            .when(F.col("l_returnflag") == "R", F.lit(PROMO)).otherwise(F.lit(CARD)))
    return t.lineitem.select(F.col("l_orderkey").alias("order_id"), kind.alias("payment_type"),
                             F.col("l_linenumber").cast("bigint").alias("payment_sequential"),
                             (F.floor("l_quantity").cast("bigint") % 4).alias("payment_installments"))


def market_reviews(t: Tables) -> DataFrame:
    """One review per line: score 1..5, stored x10 for open lines (the repair case)."""
    base = F.floor("l_quantity").cast("bigint") % 5 + 1
    score = F.when(F.col("l_linestatus") == "O", base * 10).otherwise(base)
    return t.lineitem.select(F.col("l_orderkey").alias("order_id"), score.alias("review_score"))


def market_order_facts(t: Tables) -> DataFrame:
    """All per-order facts (payments, cost, review) in ONE grouped pass over
    lineitem, since items, payments and reviews are all derived from it."""
    from tessera.operators.marts import order_fact_aggregates
    kind = (F.when(F.col("l_returnflag") == "A", F.lit(TRANSFER))
            .when(F.col("l_returnflag") == "R", F.lit(PROMO)).otherwise(F.lit(CARD)))
    q = F.floor("l_quantity").cast("bigint")
    score = F.when(F.col("l_linestatus") == "O", (q % 5 + 1) * 10).otherwise(q % 5 + 1)
    aggs = order_fact_aggregates(kind, F.col("l_linenumber").cast("bigint"), q % 4, money(F.col("l_extendedprice")),
                                 money(F.col("l_extendedprice")) * rate(F.col("l_tax")), score,
                                 transfer=TRANSFER, promo=PROMO)
    return t.lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(*aggs)


def market_mart(t: Tables) -> DataFrame:
    from tessera.operators.marts import customer_mart
    return customer_mart(market_orders(t), market_users(t), delivered=DELIVERED, cancelled=CANCELLED,
                         transfer=TRANSFER, promo=PROMO, top_regions=3, order_facts=market_order_facts(t))


# ------------------------------------------------------------------ game database (GSQL)

def game_users(t: Tables) -> DataFrame:
    """Players: customer id, race = nation, payer when the account balance is positive."""
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("race_id"),
                             F.when(F.col("c_acctbal") > 0, F.lit(1)).otherwise(F.lit(0)).alias("payer"))


def game_race(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("race_id"), F.col("n_name").alias("race"))


def game_items(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("item_code"), F.col("p_name").alias("game_items"))


def game_events(t: Tables) -> DataFrame:
    """Purchases: one per line, buyer from the order; zero amount when the line has no discount."""
    amount = (F.when(F.col("l_discount") == 0, F.lit(0).cast("decimal(15,2)"))
              .otherwise(money(F.col("l_extendedprice")) * (1 - rate(F.col("l_discount")))))
    return (t.lineitem.select("l_orderkey", "l_partkey", "l_discount", "l_extendedprice")
            .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
            .select(F.col("o_custkey").alias("id"), F.col("l_partkey").alias("item_code"), amount.alias("amount")))


# ------------------------------------------------------------------ weekly panel (SRES / SPRE)

def weekly_panel(t: Tables) -> DataFrame:
    """(store, dept, week) sales: store = customer nation, dept = order
    priority number, week = Monday of the order date."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("store"))
    return (o.join(c, "o_custkey")
            .groupBy("store", F.substring("o_orderpriority", 1, 1).cast("int").alias("dept"),
                     F.date_trunc("week", F.col("o_orderdate").cast("timestamp")).cast("date").alias("date"))
            .agg(F.sum(money(F.col("o_totalprice"))).alias("weekly_sales")))


# ------------------------------------------------------------------ shipments as dated events (LOAN / HOTEL)

def shipments(t: Tables) -> DataFrame:
    """Line shipments with the ordering customer and the shipping delay in
    days (ship date - order date) as the overdue measure."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
            .join(o, "l_orderkey")
            .select("o_custkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
                    F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("overdue_days")))


# ------------------------------------------------------------------ customers with (sparse) event activity

def customer_activity(t: Tables) -> DataFrame:
    """Every customer with its event activity; customers without events have
    NULL activity columns (the null-bearing table for profiling / fills)."""
    ev = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"),
        F.min("ts").alias("first_event_ts"))
    return t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal").join(ev, "c_custkey", "left")


# ------------------------------------------------------------------ ticket purchases (AFI)
# The foreign currency, the segment paying in it, and the rate nominal.
FOREIGN, HOME, FOREIGN_SEGMENT, NOMINAL = "kzt", "rub", "MACHINERY", 100


def purchases(t: Tables) -> DataFrame:
    """Orders as ticket purchases: device from priority, service = market
    segment, region name, currency from the segment, tickets = line count."""
    tickets = t.lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count(F.lit(1)).alias("tickets_count"))
    cr = customer_region(t).select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("service_name"),
                                   F.col("r_name").alias("region_name"))
    device = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("mobile")).otherwise(F.lit("desktop"))
    o = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                        F.col("o_orderdate").cast("date").alias("created_dt"), F.col("o_orderdate").alias("created_ts"),
                        money(F.col("o_totalprice")).alias("revenue"), device.alias("device_type"),
                        F.col("o_orderstatus").alias("event_type"))
    return (o.join(cr, "user_id").join(tickets, "order_id", "left")
            .withColumn("tickets_count", F.coalesce(F.col("tickets_count"), F.lit(0)))
            .withColumn("currency_code", F.when(F.col("service_name") == FOREIGN_SEGMENT, F.lit(FOREIGN)).otherwise(F.lit(HOME))))


def daily_rates(t: Tables) -> DataFrame:
    """A rate per order day (none on the 31st, to exercise missing days):
    curs = 20 + day-of-month / 10 per NOMINAL units."""
    d = t.orders.select(F.col("o_orderdate").cast("date").alias("data")).distinct()
    return (d.where(F.dayofmonth("data") != 31)
            .select("data", F.lit(NOMINAL).alias("nominal"),
                    (F.lit(20).cast("decimal(10,2)") + (F.dayofmonth("data").cast("decimal(10,2)") / 10)).cast("decimal(10,2)").alias("curs")))


# ------------------------------------------------------------------ web events, sessions, orders (CBF / AB)
# Driver event types in the roles of the feature job.
EVENT_ROLES = {"view": "page_view", "click": "add_to_cart", "purchase": "purchase"}
RUN_DATE = "2024-01-25"


def _event_role():
    expr = None
    for k, v in EVENT_ROLES.items():
        expr = F.when(F.col("event_type") == k, F.lit(v)) if expr is None else expr.when(F.col("event_type") == k, F.lit(v))
    return expr.otherwise(F.col("event_type"))


def _session_id():
    return F.col("user_id") * 100000 + F.unix_date(F.col("ts").cast("date"))


def web_events(t: Tables) -> DataFrame:
    """Events with roles, product id from the JSON props and a session id
    (one session per user and day)."""
    return t.events.select("event_id", F.col("user_id").alias("customer_id"), _session_id().alias("session_id"),
                           F.col("ts").alias("timestamp"), _event_role().alias("event_type"),
                           F.get_json_object("props", "$.k").cast("bigint").alias("product_id"))


def web_sessions(t: Tables) -> DataFrame:
    return (t.events.groupBy(_session_id().alias("session_id"), F.col("user_id").alias("customer_id"))
            .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time")))


def web_orders(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"), F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_time"), money(F.col("value")).alias("total_usd"))


def ab_sessions(t: Tables) -> DataFrame:
    """App sessions for the A/B test: one per user and day, pages = events,
    registered when a signup happened, arm A/B by user id parity, region and
    device from the customer."""
    s = t.events.groupBy(F.col("user_id"), F.col("ts").cast("date").alias("session_date")).agg(
        F.min("ts").alias("session_start_ts"), F.count(F.lit(1)).alias("page_counter"),
        F.max(F.when(F.col("event_type") == "signup", F.lit(1)).otherwise(F.lit(0))).alias("registration_flag"))
    cr = customer_region(t).select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region"),
                                   F.col("c_mktsegment").alias("device"))
    return (s.join(cr, "user_id", "left")
            .withColumn("session_id", F.col("user_id") * 100000 + F.unix_date("session_date"))
            .withColumn("test_group", F.when(F.col("user_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B"))))


# ------------------------------------------------------------------ scored orders (metrics)
# The logistic score of an order's cancellation from its total price.
SCORE_CENTER, SCORE_SCALE = 150000.0, 50000.0


def scored_orders(t: Tables) -> DataFrame:
    """Label y = order cancelled (status P); score p = rounded logistic of
    the total price (3 decimals, so ties occur); fold = order key mod 5."""
    p = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("o_totalprice") - SCORE_CENTER) / SCORE_SCALE)), 3)
    return t.orders.select("o_orderkey", (F.col("o_orderstatus") == "P").cast("int").alias("y"), p.alias("p"),
                           (F.col("o_orderkey") % 5).alias("fold"))


def priced_orders(t: Tables) -> DataFrame:
    """Regression pair: actual order total vs. the total recomputed from its
    lines (price x (1 - discount) x (1 + tax)), exact decimals."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(money(F.col("l_extendedprice")) * (1 - rate(F.col("l_discount"))) * (1 + rate(F.col("l_tax")))).alias("pred"))
    return (t.orders.select("o_orderkey", money(F.col("o_totalprice")).alias("y"), (F.col("o_orderkey") % 5).alias("fold"))
            .join(lines, "o_orderkey"))


# ------------------------------------------------------------------ places (FOOD) and games (VG) on parts
def places(t: Tables) -> DataFrame:
    """Parts as catering places: category = type, district = brand, rating =
    size / 10, chain when size > 25, average bill = retail price."""
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
                         F.col("p_brand").alias("district"), (F.col("p_size") / 10.0).alias("rating"),
                         (F.col("p_size") > 25).cast("int").alias("chain"), money(F.col("p_retailprice")).alias("avg_bill"))


# Grade bands of the two scoring systems (label, lower inclusive, upper exclusive).
CRITIC_BANDS = [(0, 30, "low"), (30, 80, "mid"), (80, 101, "high")]
USER_BANDS = [(0, 3, "low"), (3, 8, "mid"), (8, 10.1, "high")]


def games(t: Tables) -> DataFrame:
    """Parts as games: platform = brand, genre = type, critic score = 2 x size,
    user score = retail price above 900 / 10."""
    return t.part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("platform"), F.col("p_type").alias("genre"),
                         (F.col("p_size") * 2).alias("critic_score"), ((F.col("p_retailprice") - 900) / 10).alias("user_score"))


# ------------------------------------------------------------------ labelled documents (classification jobs)

def doc_features(t: Tables) -> DataFrame:
    """Documents with whole-text numeric features and, where labelled, the
    quality / toxicity labels (inner join: labelled documents only)."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars", "text")
    words = F.size(F.filter(F.split(F.col("text"), r"\s+"), lambda w: w != ""))
    lines = F.size(F.split(F.col("text"), "\n"))
    digits = F.length(F.regexp_replace("text", r"[^0-9]", ""))
    upper = F.length(F.regexp_replace("text", r"[^\p{Lu}]", ""))
    return (d.join(t.labels, "doc_id")
            .select("doc_id", "lang", "source", F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
                    F.log1p(words.cast("double")).alias("log_words"), lines.cast("double").alias("n_lines"),
                    F.try_divide(digits.cast("double"), F.col("n_chars").cast("double")).alias("digit_share"),
                    F.try_divide(upper.cast("double"), F.col("n_chars").cast("double")).alias("upper_share"),
                    F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic")))


def store_attributes(t: Tables) -> DataFrame:
    """Stores of the panel (nations): type = region, size = number of customers."""
    size = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("store_size"))
    n = t.nation.select(F.col("n_nationkey").alias("store"), F.col("n_regionkey").cast("double").alias("store_type"))
    return n.join(size.withColumnRenamed("c_nationkey", "store"), "store", "left")


def weekly_factors(t: Tables) -> DataFrame:
    """Outside factors of each week, known beforehand: mean discount, tax and quantity of what ships in it."""
    week = F.date_trunc("week", F.col("l_shipdate").cast("timestamp")).cast("date").alias("date")
    return t.lineitem.groupBy(week).agg(F.avg("l_discount").alias("factor_discount"), F.avg("l_tax").alias("factor_tax"), F.avg("l_quantity").alias("factor_quantity"))


def labelled(t: Tables) -> DataFrame:
    """Ids and labels of the labelled documents."""
    return t.documents.select("doc_id").join(t.labels, "doc_id").select("doc_id", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"))


DOC_NUMERIC = ["log_chars", "log_words", "n_lines", "digit_share", "upper_share"]


def dirty_games(t: Tables) -> DataFrame:
    """Parts as a raw games table with the defects the cleaning steps fix:
    padded upper-case names, 'unknown' years, 'tbd' user scores, missing
    critic scores and an obsolete rating code."""
    year = F.when(F.col("p_size") > 45, F.lit("unknown")).otherwise((F.lit(1990) + F.col("p_size")).cast("string"))
    user = F.when(F.col("p_size") % 7 == 0, F.lit("tbd")).otherwise(((F.col("p_retailprice") - 900) / 10).cast("string"))
    critic = F.when(F.col("p_size") < 5, F.lit(None).cast("int")).otherwise(F.col("p_size") * 2)
    rating = F.when(F.col("p_type") == "PROMO", F.lit("K-A")).otherwise(F.col("p_type"))
    return t.part.select(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("Name"), F.col("p_brand").alias("Platform"),
                         year.alias("Year_of_Release"), F.col("p_type").alias("Genre"), critic.alias("Critic_Score"),
                         user.alias("User_Score"), rating.alias("Rating"))


def dated_reviews(t: Tables) -> DataFrame:
    """One review per line, dated by its ship date and attributed to the
    ordering customer; the x10 scores are repaired (A10) before use."""
    base = F.floor("l_quantity").cast("bigint") % 5 + 1
    raw = F.when(F.col("l_linestatus") == "O", base * 10).otherwise(base)
    fixed = F.when(raw > 5, raw.cast("double") / 10.0).otherwise(raw.cast("double"))
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return t.lineitem.select("l_orderkey", "l_shipdate", fixed.alias("review_score")).join(o, "l_orderkey")
