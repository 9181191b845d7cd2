"""Edge rows of the user features and the skew-safe helpers, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shoplens.operators import features as fe
from shoplens.operators import scale as sc

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
COLUMNS = "user_id string, product_id string, product_sku_id string, interaction_type string, booked_rev double, interaction_count bigint, timestamp timestamp, date date"


def row(user, product, kind, rev=10.0, minutes=0, count=1, sku=None):
    ts = T0 + dt.timedelta(minutes=minutes)
    return (user, product, sku or product, kind, rev, count, ts, ts.date())


@pytest.fixture(scope="module")
def interactions(spark):
    rows = [
        row("a", "p", "new_purchase", 10.0, 5),
        row("a", "p", "new_purchase", 20.0, 6),
        row("a", "p", "return", 10.0, 50),
        row("a", "p", "return", 10.0, 60),
        row("b", "q", "return", 7.0, 1),
        row(None, "q", "new_purchase", 99.0, 1),
        row("c", "q", "orders", 1.0, 0),
        row("d", "q", "orders", 1.0, 0),
        row("d", "q", "orders", 1.0, 0),
        row("d", "r", "orders", 1.0, 90),
        row("d", "r", "orders", 1.0, 60 * 24 * 8),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def catalogue(spark):
    rows = [("p", 40.0, "nike", "l1", "l2", "x"), ("q", 0.0, "puma", "l1", "l3", "y"), ("r", None, "puma", "l4", "l3", "z")]
    return spark.createDataFrame(rows, "itemid string, mrp double, brandname string, l1code string, l2code string, brickname string")


def values(df):
    return {r[0]: r[1] for r in df.collect()}


def test_order_value_subtracts_returns_and_skips_null_keys(interactions):
    assert values(fe.lifetime_order_value(interactions)) == {"a": 10.0, "b": -7.0}


def test_returned_value_counts_a_purchase_once_per_return(interactions):
    assert values(fe.total_returned_value(interactions)) == {"a": 60.0}
    pairs = {(r.booked_rev, r.pairs) for r in fe.return_purchase_pairs(interactions).collect()}
    assert pairs == {(10.0, 2), (20.0, 2)}


def test_returns_without_purchase_still_count(interactions):
    assert values(fe.returns_count(interactions)) == {"a": 2, "b": 1}


def test_interval_needs_two_distinct_times(interactions):
    got = {r.user_id: (r.avg_interval_secs, r.avg_interval_days) for r in fe.average_interval(interactions).collect()}
    assert got == {"d": (60 * 60 * 24 * 8 / 2, 4.0)}


def test_weekly_mean_covers_all_weeks_of_the_data(interactions):
    assert values(fe.orders_per_week(interactions)) == {"c": 0.5, "d": 1.5}
    assert fe.user_week_grid(interactions).count() == 4


def test_discount_ignores_null_and_zero_mrp(interactions, catalogue):
    got = values(fe.average_discount(interactions, catalogue))
    assert got["a"] == pytest.approx((75 + 50 + 75 + 75) / 4)
    assert got["d"] is None


def test_affinity_uses_weights_and_decay(spark, interactions, catalogue):
    as_of = F.lit("2024-01-01").cast("date")
    got = {(r.user_id, r.brandname): r.affinity_score for r in fe.affinity_scores(interactions, catalogue, as_of).collect()}
    assert got[("a", "nike")] == 10.0  # 2 * 10 - 2 * 5
    assert got[("d", "puma")] == pytest.approx(30 + 10 * 2.718281828 ** (0.05 * 8), abs=0.01)


def test_one_pass_equals_the_separate_features(interactions, catalogue):
    as_of = F.lit("2024-01-01").cast("date")
    separate = fe.union_features(
        [
            fe.lifetime_order_value(interactions),
            fe.returns_count(interactions),
            fe.average_discount(interactions, catalogue),
            fe.category_sets(interactions, catalogue),
            fe.brand_affinity(interactions, catalogue, as_of).groupBy("user_id").agg(F.array_sort(F.collect_list("brand_affinity")).alias("brand_affinity")),
        ]
    )
    together = fe.value_and_category_features(fe.enriched(interactions, catalogue), as_of)
    assert sorted(map(str, together.select(*separate.columns).collect())) == sorted(map(str, separate.collect()))


def test_order_times_equal_the_separate_features(interactions, catalogue):
    separate = fe.union_features([fe.orders_per_week(interactions), fe.average_interval(interactions).drop("avg_interval_secs"), fe.average_bag(interactions, catalogue)])
    together = fe.order_time_features(fe.enriched(interactions, catalogue)).filter("coalesce(avg_orders_per_week, avg_interval_days, avg_bag_value) IS NOT NULL")
    assert sorted(map(str, together.select(*separate.columns).collect())) == sorted(map(str, separate.collect()))


def test_feature_table_reads_few_times(interactions, catalogue):
    table = fe.user_feature_table(interactions, catalogue, F.lit("2024-01-01").cast("date"))
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 5
    assert table.count() == table.select("user_id").distinct().count()
    assert {"l1codes", "brand_affinity", "LTOV", "TVR", "avg_cart_to_checkout_hours"} <= set(table.columns)


def half_away(secs, per):
    units = abs(secs) * 100
    rounded = (units + per // 2) // per
    return rounded if secs >= 0 else -rounded


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cart_lags_equal_the_pairwise_sums(spark, seed):
    rng = random.Random(seed)
    rows = []
    for kind in ("add_to_cart", "new_purchase"):
        for _ in range(120):
            # multiples of 18 and 432 seconds hit exact halves, on both sides of zero
            shift = rng.choice([18 * rng.randint(-50, 50), 432 * rng.randint(-300, 300), rng.randint(-10**6, 10**6)])
            ts = T0 + dt.timedelta(seconds=shift)
            rows.append((rng.choice("uv"), rng.choice("pq"), "s", kind, 1.0, 1, ts, ts.date()))
    got = {(r.user_id, r.product_id): (r.pairs, r.hour_hundredths, r.day_hundredths) for r in fe.cart_purchase_lags(spark.createDataFrame(rows, COLUMNS)).collect()}
    want = {}
    for c in rows:
        for p in rows:
            if c[3] == "add_to_cart" and p[3] == "new_purchase" and c[:2] == p[:2]:
                secs = int((p[6] - c[6]).total_seconds())
                n, h, d = want.get(c[:2], (0, 0, 0))
                want[c[:2]] = (n + 1, h + half_away(secs, 3600), d + half_away(secs, 86400))
    assert got == want


def test_global_positions_split_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), "id").repartition(7)
    got = sorted((r.position, r.v, r.id) for r in sc.global_positions(df, [F.asc("v"), F.asc("id")]).collect())
    assert [p for p, _, _ in got] == list(range(1, 3001))
    assert [(v, i) for _, v, i in got] == sorted((v, i) for _, v, i in got)


def test_exact_percentiles_match_numpy_on_skewed_groups(spark):
    import numpy as np

    rng = random.Random(5)
    rows = [("hot", 1.0)] * 400 + [("hot", rng.random()) for _ in range(601)] + [("cold", rng.random()) for _ in range(10)] + [("one", 3.0)]
    got = {r.g: r for r in sc.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", (0.1, 0.5, 0.9), ["a", "b", "c"]).collect()}
    for g in ("hot", "cold", "one"):
        want = np.percentile([v for k, v in rows if k == g], [10, 50, 90])
        assert [got[g].a, got[g].b, got[g].c] == pytest.approx(list(want))


def test_top_n_beyond_the_group_limit_threshold(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id"))
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        got = sc.top_n_per_group(df, ["g"], [F.desc("id")], 20).groupBy("g").agg(F.min("id").alias("low"), F.count("id").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    assert {(r.g, r.low, r.n) for r in got} == {(0, 4960, 20), (1, 4961, 20)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_equals_plain_join(spark, how):
    """A third of the rows on one key, some on a second heavy one, some without a key."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, 2).when(F.col("id") % 50 != 7, F.col("id"))
    fact = spark.range(6000).select(key.alias("k"), "id", F.lit("a").alias("name"))
    lookup = spark.createDataFrame([(1, "x"), (1, "x2"), (2, "w"), (5, "y"), (8, None), (None, "none")], "k bigint, value string")
    want = sorted(map(str, fact.join(lookup, "k", how).collect()))
    heavy = {r.k: r._salts for r in sc.heavy_keys(fact, ["k"], 100).collect()}
    assert heavy[1] == 20 and set(heavy) - {None} == {1, 2}  # in proportion, and no light key
    joined = sc.hot_key_join(fact, lookup, ["k"], how, task_rows=100)
    assert joined.columns == fact.join(lookup, "k", how).columns
    assert sorted(map(str, joined.collect())) == want
    assert sc.heavy_keys(fact, ["k"], 10_000) is None
    plain = sc.hot_key_join(fact, lookup, ["k"], how, task_rows=10_000)
    assert "_salt" not in plain._jdf.queryExecution().toString()
    assert sorted(map(str, plain.collect())) == want


def test_heavy_keys_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sc, "MOST_HEAVY", 4)
    fact = spark.range(2000).select((F.col("id") % 20).alias("k"))
    fact = fact.unionByName(spark.range(900).select(F.lit(3).cast("long").alias("k")))
    heavy = sc.heavy_keys(fact, ["k"], 50).collect()
    assert [r.k for r in heavy] == [3] and heavy[0]._salts == 2


def test_lag_crosses_empty_buckets(spark):
    times = [0, 10, 86399, 86400, 86400 * 9 + 5]
    df = spark.createDataFrame([("u", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t)) for t in times], "user_id string, ts timestamp")
    got = {r.ts: r.prev_ts for r in sc.lag_by_time(df, ["user_id"], "ts").collect()}
    stamps = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t) for t in times]
    assert got == dict(zip(stamps, [None, *stamps]))
