"""User value, order, category and affinity features over events and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import features as fe
from shoplens.plans.domain import AS_OF, CATALOGUE, INTERACTIONS, PRICED, catalogue, interactions
from shoplens.plans.registry import flat, query, rounded

VALID = "user_id IS NOT NULL AND product_id IS NOT NULL AND product_sku_id IS NOT NULL"


@query("flt_valid_keys", f"WITH {INTERACTIONS} SELECT interaction_type, count(*) AS n FROM interactions WHERE {VALID} GROUP BY 1")
def _(spark, d):
    return fe.valid_interactions(interactions(spark, d)).groupBy("interaction_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flt_interaction_type",
    f"""WITH {INTERACTIONS} SELECT user_id, product_id, interaction_type FROM interactions
    WHERE interaction_type IN ('new_purchase', 'return')""",
)
def _(spark, d):
    return fe.of_type(interactions(spark, d), "new_purchase", "return").select("user_id", "product_id", "interaction_type")


@query(
    "join_interactions_products",
    f"WITH {PRICED} SELECT user_id, product_id, itemid, mrp, brandname, l1code, interaction_type FROM priced",
)
def _(spark, d):
    rows = fe.with_catalogue(interactions(spark, d), catalogue(spark, d))
    return rows.select("user_id", "product_id", "itemid", "mrp", "brandname", "l1code", "interaction_type")


@query(
    "agg_ltov",
    f"""WITH {INTERACTIONS} SELECT user_id,
    round(sum(CASE WHEN interaction_type = 'return' THEN -booked_rev ELSE booked_rev END), 6) AS "LTOV"
    FROM interactions WHERE {VALID} AND interaction_type IN ('new_purchase', 'return') GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.lifetime_order_value(interactions(spark, d)))


RETURNS_SQL = f"""returned AS (SELECT user_id, product_id, product_sku_id FROM interactions
  WHERE {VALID} AND interaction_type = 'return'),
bought AS (SELECT user_id, product_id, product_sku_id, booked_rev FROM interactions
  WHERE {VALID} AND interaction_type = 'new_purchase')"""


@query(
    "join_return_purchase",
    f"""WITH {INTERACTIONS}, {RETURNS_SQL}
    SELECT user_id, product_id, product_sku_id, booked_rev, count(*) AS pairs
    FROM returned JOIN bought USING (user_id, product_id, product_sku_id) GROUP BY ALL""",
)
def _(spark, d):
    return flat(fe.return_purchase_pairs(interactions(spark, d)))


@query(
    "agg_tvr",
    f"""WITH {INTERACTIONS}, {RETURNS_SQL} SELECT user_id, round(sum(booked_rev), 6) AS "TVR"
    FROM returned JOIN bought USING (user_id, product_id, product_sku_id) GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.total_returned_value(interactions(spark, d)))


@query(
    "agg_tnr",
    f"""WITH {INTERACTIONS} SELECT user_id, count(*) AS "TNR" FROM interactions
    WHERE {VALID} AND interaction_type = 'return' GROUP BY user_id""",
)
def _(spark, d):
    return fe.returns_count(interactions(spark, d))


WEEKS_SQL = f"""base AS (SELECT DISTINCT user_id, ts, year(ts) AS year, weekofyear(ts) AS week FROM interactions
  WHERE {VALID} AND interaction_type = 'orders'),
grid AS (SELECT * FROM (SELECT DISTINCT user_id FROM base) CROSS JOIN (SELECT DISTINCT year, week FROM base)),
weekly AS (SELECT user_id, year, week, count(*) AS n FROM base GROUP BY ALL)"""


@query(
    "join_user_week_grid",
    f"""WITH {INTERACTIONS}, {WEEKS_SQL} SELECT user_id, year, week, coalesce(n, 0) AS orders_per_week
    FROM grid LEFT JOIN weekly USING (user_id, year, week)""",
)
def _(spark, d):
    return flat(fe.user_week_grid(interactions(spark, d)))


@query(
    "agg_orders_per_week",
    f"""WITH {INTERACTIONS}, {WEEKS_SQL} SELECT user_id, round(avg(coalesce(n, 0)), 6) AS avg_orders_per_week
    FROM grid LEFT JOIN weekly USING (user_id, year, week) GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.orders_per_week(interactions(spark, d)))


LAGS_SQL = f"""times AS (SELECT DISTINCT user_id, ts FROM interactions WHERE {VALID} AND interaction_type = 'orders'),
lagged AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev_ts FROM times)"""


@query(
    "win_lag_orders",
    f"""WITH {INTERACTIONS}, {LAGS_SQL} SELECT user_id, CAST(epoch_us(ts) AS BIGINT) AS ts_us,
    CAST(floor(epoch(ts)) - floor(epoch(prev_ts)) AS DOUBLE) AS interval_secs FROM lagged""",
)
def _(spark, d):
    rows = fe.previous_orders(interactions(spark, d))
    return rows.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), F.col("interval_secs").cast("double").alias("interval_secs"))


@query(
    "agg_avg_interval",
    f"""WITH {INTERACTIONS}, {LAGS_SQL},
    gaps AS (SELECT user_id, floor(epoch(ts)) - floor(epoch(prev_ts)) AS secs FROM lagged WHERE prev_ts IS NOT NULL)
    SELECT user_id, round(avg(secs), 6) AS avg_interval_secs, round(round(avg(secs) / 86400, 2), 6) AS avg_interval_days
    FROM gaps GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.average_interval(interactions(spark, d)))


@query(
    "agg_avg_discount",
    f"""WITH {PRICED} SELECT user_id, round(avg(CASE WHEN mrp IS NOT NULL AND booked_rev IS NOT NULL AND mrp <> 0
    THEN (1.0 - booked_rev / mrp) * 100 END), 6) AS avg_discount FROM priced WHERE {VALID} GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.average_discount(interactions(spark, d), catalogue(spark, d)))


@query(
    "agg_avg_bag",
    f"""WITH {PRICED} SELECT user_id, round(avg(bag), 6) AS avg_bag_value FROM (
    SELECT user_id, ts, sum(mrp) AS bag FROM priced WHERE interaction_type = 'new_purchase' GROUP BY user_id, ts) GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.average_bag(interactions(spark, d), catalogue(spark, d)))


def _units(unit: int) -> str:
    return f"sign(secs) * floor((abs(secs) + {unit // 2}) / {unit})"


CART_SQL = f"""carts AS (SELECT user_id, product_id, floor(epoch(ts)) AS c FROM interactions WHERE interaction_type = 'add_to_cart'),
buys AS (SELECT user_id, product_id, floor(epoch(ts)) AS p FROM interactions WHERE interaction_type = 'new_purchase'),
lags AS (SELECT user_id, product_id, p - c AS secs FROM carts JOIN buys USING (user_id, product_id))"""


@query(
    "join_cart_purchase",
    f"""WITH {INTERACTIONS}, {CART_SQL} SELECT user_id, product_id, count(*) AS pairs,
    CAST(sum({_units(36)}) AS BIGINT) AS hour_hundredths, CAST(sum({_units(864)}) AS BIGINT) AS day_hundredths
    FROM lags GROUP BY user_id, product_id""",
)
def _(spark, d):
    sums = [F.col(c).cast("bigint").alias(c) for c in ("pairs", "hour_hundredths", "day_hundredths")]
    return fe.cart_purchase_lags(interactions(spark, d)).select("user_id", "product_id", *sums)


@query(
    "agg_cart_to_checkout",
    f"""WITH {INTERACTIONS}, {CART_SQL} SELECT user_id,
    round(CAST(sum({_units(36)}) AS DOUBLE) / (count(*) * 100), 6) AS avg_cart_to_checkout_hours,
    round(CAST(sum({_units(864)}) AS DOUBLE) / (count(*) * 100), 6) AS avg_cart_to_checkout_days FROM lags GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.cart_to_checkout(interactions(spark, d)))


@query(
    "agg_categories",
    f"""WITH {PRICED} SELECT user_id, string_agg(DISTINCT l1code, '|' ORDER BY l1code) AS l1codes,
    string_agg(DISTINCT l2code, '|' ORDER BY l2code) AS l2codes, string_agg(DISTINCT brickname, '|' ORDER BY brickname) AS bricks,
    count(DISTINCT l1code) AS num_l1codes, count(DISTINCT l2code) AS num_l2codes, count(DISTINCT brickname) AS num_bricks
    FROM priced WHERE interaction_count <> 0 GROUP BY user_id""",
)
def _(spark, d):
    return flat(fe.category_sets(interactions(spark, d), catalogue(spark, d)))


@query(
    "agg_attribute_categories",
    f"""WITH {PRICED} SELECT user_id AS userid, string_agg(DISTINCT l1code, '|' ORDER BY l1code) AS l1codes,
    count(DISTINCT l1code) AS num_l1codes FROM priced WHERE interaction_count <> 0 GROUP BY user_id""",
)
def _(spark, d):
    rows = interactions(spark, d).withColumnsRenamed({"user_id": "userid", "interaction_count": "quantity"})
    return flat(fe.category_sets(rows, catalogue(spark, d), [("l1code", "l1codes")], "userid", "quantity"))


AFFINITY_SQL = f"""affinity AS (
  SELECT user_id, brandname, round(sum(interaction_count * (CASE interaction_type WHEN 'product_views' THEN 1 WHEN 'product_clicks' THEN 5
    WHEN 'add_to_cart' THEN 8 WHEN 'wishlist' THEN 7 WHEN 'orders' THEN 10 WHEN 'new_purchase' THEN 10 WHEN 'return' THEN -5
    WHEN 'exchange' THEN -3 ELSE 0 END) * exp(-0.05::DOUBLE * date_diff('day', day, DATE '{AS_OF}'))), 2) AS affinity_score
  FROM priced WHERE user_id IS NOT NULL AND brandname IS NOT NULL AND interaction_count <> 0 GROUP BY user_id, brandname)"""


@query("agg_brand_affinity", f"WITH {PRICED}, {AFFINITY_SQL} SELECT user_id, brandname AS brand, affinity_score FROM affinity")
def _(spark, d):
    rows = fe.brand_affinity(interactions(spark, d), catalogue(spark, d), F.lit(AS_OF).cast("date"))
    return rows.select("user_id", "brand_affinity.brand", "brand_affinity.affinity_score")


def user_features(spark, d):
    """One row per user: numbers and lists."""
    return fe.user_feature_table(interactions(spark, d), catalogue(spark, d), F.lit(AS_OF).cast("date"))


FEATURES_SQL = f"""{PRICED}, {RETURNS_SQL}, {WEEKS_SQL}, {LAGS_SQL}, {CART_SQL},
f1 AS (SELECT user_id, sum(CASE WHEN interaction_type = 'return' THEN -booked_rev ELSE booked_rev END) AS "LTOV"
  FROM interactions WHERE {VALID} AND interaction_type IN ('new_purchase', 'return') GROUP BY user_id),
f2 AS (SELECT user_id, sum(booked_rev) AS "TVR" FROM returned JOIN bought USING (user_id, product_id, product_sku_id) GROUP BY user_id),
f3 AS (SELECT user_id, count(*) AS "TNR" FROM interactions WHERE {VALID} AND interaction_type = 'return' GROUP BY user_id),
f4 AS (SELECT user_id, avg(coalesce(n, 0)) AS avg_orders_per_week FROM grid LEFT JOIN weekly USING (user_id, year, week) GROUP BY user_id),
f5 AS (SELECT user_id, round(avg(floor(epoch(ts)) - floor(epoch(prev_ts))) / 86400, 2) AS avg_interval_days
  FROM lagged WHERE prev_ts IS NOT NULL GROUP BY user_id),
f6 AS (SELECT user_id, avg((1.0 - booked_rev / mrp) * 100) AS avg_discount FROM priced WHERE {VALID} AND mrp <> 0 GROUP BY user_id),
f7 AS (SELECT user_id, avg(bag) AS avg_bag_value FROM (SELECT user_id, ts, sum(mrp) AS bag FROM priced
  WHERE interaction_type = 'new_purchase' GROUP BY user_id, ts) GROUP BY user_id),
f8 AS (SELECT user_id, CAST(sum({_units(36)}) AS DOUBLE) / (count(*) * 100) AS avg_cart_to_checkout_hours,
  CAST(sum({_units(864)}) AS DOUBLE) / (count(*) * 100) AS avg_cart_to_checkout_days FROM lags GROUP BY user_id),
f9 AS (SELECT user_id, count(DISTINCT l1code) AS num_l1codes, count(DISTINCT l2code) AS num_l2codes,
  count(DISTINCT brickname) AS num_bricks, string_agg(DISTINCT l1code, '|' ORDER BY l1code) AS l1codes,
  string_agg(DISTINCT l2code, '|' ORDER BY l2code) AS l2codes, string_agg(DISTINCT brickname, '|' ORDER BY brickname) AS bricks
  FROM priced WHERE interaction_count <> 0 GROUP BY user_id),
{AFFINITY_SQL},
f10 AS (SELECT user_id, string_agg(brandname || '=' || CAST(round(affinity_score * 100) AS BIGINT), '|' ORDER BY brandname) AS brands FROM affinity GROUP BY user_id),
features AS (SELECT * FROM f1 FULL JOIN f2 USING (user_id) FULL JOIN f3 USING (user_id) FULL JOIN f4 USING (user_id)
  FULL JOIN f5 USING (user_id) FULL JOIN f6 USING (user_id) FULL JOIN f7 USING (user_id) FULL JOIN f8 USING (user_id)
  FULL JOIN f9 USING (user_id) FULL JOIN f10 USING (user_id))"""
FEATURE_NAMES = [
    "LTOV", "TVR", "TNR", "avg_orders_per_week", "avg_interval_days", "avg_discount", "avg_bag_value",
    "avg_cart_to_checkout_hours", "avg_cart_to_checkout_days", "num_l1codes", "num_l2codes", "num_bricks",
]


@query(
    "join_features_union",
    "WITH " + FEATURES_SQL + " SELECT user_id, "
    + ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in FEATURE_NAMES) + ", l1codes, l2codes, bricks, brands FROM features",
)
def _(spark, d):
    rows = user_features(spark, d)
    numbers = [rounded(F.col(c).cast("double")).alias(c) for c in FEATURE_NAMES]
    lists = [F.array_join(c, "|").alias(c) for c in ("l1codes", "l2codes", "bricks")]
    hundredths = F.transform("brand_affinity", lambda b: F.concat(b["brand"], F.lit("="), F.round(b["affinity_score"] * 100).cast("bigint").cast("string")))
    return rows.select("user_id", *numbers, *lists, F.array_join(hundredths, "|").alias("brands"))


@query(
    "flt_null_rows",
    "WITH " + FEATURES_SQL + " SELECT user_id, round(CAST(\"TVR\" AS DOUBLE), 6) AS \"TVR\" FROM features WHERE "
    + " AND ".join(f'"{c}" IS NOT NULL' for c in FEATURE_NAMES),
)
def _(spark, d):
    from shoplens.operators.cleaning import drop_null_rows

    return flat(drop_null_rows(user_features(spark, d)).select("user_id", "TVR"))
