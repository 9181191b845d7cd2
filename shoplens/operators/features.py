"""Per-user value, order and affinity features over an interactions table.

Columns: user_id, product_id, product_sku_id, interaction_type, booked_rev, interaction_count,
timestamp, date. The catalogue has itemid, mrp, brandname, l1code, l2code, brickname.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.scale import hot_key_join, lag_by_time, materialise

KEYS = ("user_id", "product_id", "product_sku_id")

# Interaction weights and the daily decay rate of the affinity score.
INTERACTION_WEIGHTS = {
    "product_views": 1,
    "product_clicks": 5,
    "add_to_cart": 8,
    "wishlist": 7,
    "orders": 10,
    "new_purchase": 10,
    "return": -5,
    "exchange": -3,
}
DECAY_RATE = 0.05


def valid_interactions(df: DataFrame) -> DataFrame:
    return df.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & F.col("product_sku_id").isNotNull())


def of_type(df: DataFrame, *types: str) -> DataFrame:
    return df.filter(F.col("interaction_type").isin(*types))


def with_catalogue(interactions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Inner join on product_id = itemid; a popular product spreads over several tasks."""
    renamed = catalogue.withColumnRenamed("itemid", "product_id")
    return hot_key_join(interactions, renamed, ["product_id"]).withColumn("itemid", F.col("product_id"))


def lifetime_order_value(df: DataFrame) -> DataFrame:
    signed = F.when(F.col("interaction_type") == "return", -F.col("booked_rev")).otherwise(F.col("booked_rev"))
    return of_type(valid_interactions(df), "new_purchase", "return").groupBy("user_id").agg(F.sum(signed).alias("LTOV"))


def return_purchase_pairs(df: DataFrame) -> DataFrame:
    """Returns joined to purchases on the three keys, with equal result rows folded into ``pairs``.

    The plain join repeats a purchase once per return of the same item. One aggregate gives every
    distinct result row and its number of repeats, so a popular item never multiplies out.
    """
    rows = of_type(valid_interactions(df), "new_purchase", "return")
    is_return = F.col("interaction_type") == "return"
    by_price = rows.groupBy(*KEYS, F.when(~is_return, F.col("booked_rev")).alias("booked_rev"), is_return.alias("returned")).agg(
        F.count(F.lit(1)).alias("n")
    )
    returns = by_price.filter("returned").select(*KEYS, F.col("n").alias("returns"))
    purchases = by_price.filter("not returned").select(*KEYS, "booked_rev", "n")
    return purchases.join(returns, list(KEYS)).select(*KEYS, "booked_rev", (F.col("n") * F.col("returns")).alias("pairs"))


def total_returned_value(df: DataFrame) -> DataFrame:
    """Summed revenue of purchases that have returns, a purchase counting once per return.

    The sum over pairs is (returns) x (summed revenue) per item, so no join is needed.
    """
    rows = of_type(valid_interactions(df), "new_purchase", "return")
    is_return = F.col("interaction_type") == "return"
    items = rows.groupBy(*KEYS).agg(
        F.count(F.when(is_return, 1)).alias("returns"),
        F.count(F.when(~is_return, 1)).alias("purchases"),
        F.sum(F.when(~is_return, F.col("booked_rev"))).alias("revenue"),
    )
    matched = items.filter((F.col("returns") > 0) & (F.col("purchases") > 0))
    return matched.groupBy("user_id").agg(F.sum(F.col("returns") * F.col("revenue")).alias("TVR"))


def returns_count(df: DataFrame) -> DataFrame:
    return of_type(valid_interactions(df), "return").groupBy("user_id").agg(F.count(F.lit(1)).alias("TNR"))


def _order_weeks(df: DataFrame) -> DataFrame:
    """Distinct order times with calendar year and ISO week."""
    return (
        of_type(valid_interactions(df), "orders")
        .select("user_id", "timestamp")
        .distinct()
        .withColumn("year", F.year("timestamp"))
        .withColumn("week", F.weekofyear("timestamp"))
    )


def user_week_grid(df: DataFrame) -> DataFrame:
    """Every user with every week found in the data, and the user's distinct order times in it.

    The weeks are one small array (a bounded domain), looked up in each user's week counts.
    """
    weekly = _order_weeks(df).groupBy("user_id", "year", "week").agg(F.count(F.lit(1)).alias("n"))
    week = F.struct("year", "week")
    # every present week occurs in `weekly`, which has one row per user and week
    all_weeks = weekly.agg(F.array_sort(F.collect_set(week))).scalar()
    per_user = weekly.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct(week.alias("key"), F.col("n").alias("value")))).alias("counts")
    )
    grid = per_user.select("user_id", "counts", F.explode(all_weeks).alias("w"))
    found = F.coalesce(F.try_element_at("counts", F.col("w")), F.lit(0)).alias("orders_per_week")
    return grid.select("user_id", F.col("w.year").alias("year"), F.col("w.week").alias("week"), found)


def orders_per_week(df: DataFrame) -> DataFrame:
    """Mean of weekly distinct order times over all weeks of the data: total / number of weeks."""
    orders = _order_weeks(df)
    weeks = orders.agg(F.countDistinct("year", "week")).scalar()
    totals = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("orders"))
    return totals.select("user_id", (F.col("orders") / weeks).alias("avg_orders_per_week"))


def previous_orders(df: DataFrame) -> DataFrame:
    """Distinct order times per user with the one before, and the seconds between."""
    orders = of_type(valid_interactions(df), "orders").select("user_id", F.col("timestamp").alias("ts")).distinct()
    gap = F.unix_timestamp("ts") - F.unix_timestamp("prev_ts")
    return lag_by_time(orders, ["user_id"], "ts", "prev_ts").withColumn("interval_secs", gap)


def average_interval(df: DataFrame) -> DataFrame:
    """Mean seconds between consecutive distinct order times.

    Consecutive gaps add up to last minus first, so counting and two extremes are enough.
    """
    orders = of_type(valid_interactions(df), "orders").select("user_id", "timestamp").distinct()
    span = F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))
    stats = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), span.alias("span")).filter("n > 1")
    mean = F.col("span") / (F.col("n") - 1)
    return stats.select(
        "user_id", mean.alias("avg_interval_secs"), F.round(mean / 86400, 2).alias("avg_interval_days")
    )


def average_discount(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    priced = with_catalogue(valid_interactions(df), catalogue)
    usable = F.col("mrp").isNotNull() & F.col("booked_rev").isNotNull() & (F.col("mrp") != 0)
    off = (1.0 - F.try_divide(F.col("booked_rev").cast("double"), F.col("mrp").cast("double"))) * 100
    return priced.groupBy("user_id").agg(F.avg(F.when(usable, off)).alias("avg_discount"))


def average_bag(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    bags = with_catalogue(of_type(df, "new_purchase"), catalogue).groupBy("user_id", "timestamp")
    return bags.agg(F.sum("mrp").alias("bag")).groupBy("user_id").agg(F.avg("bag").alias("avg_bag_value"))


LAG_UNITS = {"hour_hundredths": 36, "day_hundredths": 864}  # seconds in a hundredth of an hour and of a day


def cart_purchase_lags(df: DataFrame) -> DataFrame:
    """All cart x purchase pairs per (user, product), summed: pairs, hour and day hundredths.

    A pair's lag in hours or days is rounded to two places before it is summed, halves away from zero; purchases before the
    cart give negative lags. Sums are exact whole numbers (decimals); the pairs themselves are never produced.

    With p = unit*a + r and c = unit*b + s, floor((p - c + unit/2) / unit) is (a - b) plus 1 where r - s >= unit/2 and minus 1
    where r - s < -unit/2. The first part needs sums only. For the second a cart opens two marks, at s + unit/2 and at
    s - unit/2, and a purchase at r passes those up to r: a running sum over at most 3*unit places. A negative exact half
    rounds one lower; those pairs share a residue class and are counted by a running sum in time. Both running sums, for both
    units, are tracks of one table, so the rows are read, grouped and sorted once.
    """
    keys = ["user_id", "product_id"]
    secs = F.unix_timestamp(F.col("timestamp").cast("timestamp"))
    counts = (
        of_type(df, "add_to_cart", "new_purchase")
        .filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy(*keys, (F.col("interaction_type") == "add_to_cart").alias("is_cart"), secs.alias("secs"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    is_cart = F.col("is_cart")

    def event(unit: int, track: str, group: Column, place: Column) -> Column:
        return F.struct(F.lit(unit).alias("unit"), F.lit(track).alias("track"), group.cast("long").alias("group"), place.cast("long").alias("place"))

    events = []
    for unit in LAG_UNITS.values():
        half, rest = unit // 2, F.pmod("secs", F.lit(unit))
        events.append(event(unit, "time", F.when(is_cart, rest).otherwise(F.pmod(rest + half, F.lit(unit))), F.col("secs")))
        events.append(event(unit, "mark", F.lit(0), F.when(is_cart, rest + half).otherwise(rest)))
        events.append(F.when(is_cart, event(unit, "mark", F.lit(0), rest - half)))
    track = [*keys, "unit", "track", "group"]
    placed = (
        counts.select(*keys, "is_cart", "n", F.explode(F.filter(F.array(*events), lambda e: e.isNotNull())).alias("e"))
        .select(*keys, "is_cart", "n", "e.*")
        .groupBy(*track, "place")
        .agg(F.sum(F.when(is_cart, F.col("n")).otherwise(0)).alias("carts"), F.sum(F.when(is_cart, 0).otherwise(F.col("n"))).alias("buys"))
    )
    inside = Window.partitionBy(*track).orderBy("place")
    placed = placed.withColumns(
        {
            "opened": F.sum("carts").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "bought_before": F.coalesce(F.sum("buys").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    big = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")  # a million carts against a million purchases pass 64 bits
    sums = []
    for unit in LAG_UNITS.values():
        on_time = (F.col("unit") == unit) & (F.col("track") == "time")
        whole = F.floor(F.col("place") / F.lit(unit))
        total = lambda x, on: F.coalesce(F.sum(F.when(on, x)), F.lit(0))
        sums += [
            total(F.col("carts"), on_time).alias(f"carts_{unit}"),
            total(F.col("buys"), on_time).alias(f"buys_{unit}"),
            total(F.col("carts") * whole, on_time).alias(f"cart_whole_{unit}"),
            total(F.col("buys") * whole, on_time).alias(f"buy_whole_{unit}"),
            total(big("buys") * big("opened"), (F.col("unit") == unit) & (F.col("track") == "mark")).alias(f"passed_{unit}"),
            total(big("carts") * big("bought_before"), on_time).alias(f"halves_{unit}"),
        ]
    found = placed.groupBy(*keys).agg(*sums)
    pairs = {u: big(f"carts_{u}") * big(f"buys_{u}") for u in LAG_UNITS.values()}
    units = [
        (big(f"carts_{u}") * big(f"buy_whole_{u}") - big(f"buys_{u}") * big(f"cart_whole_{u}") + F.col(f"passed_{u}") - pairs[u] - F.col(f"halves_{u}")).alias(name)
        for name, u in LAG_UNITS.items()
    ]
    return found.select(*keys, pairs[36].alias("pairs"), *units).filter("pairs > 0")


def cart_to_checkout(df: DataFrame) -> DataFrame:
    sums = cart_purchase_lags(df).groupBy("user_id").agg(
        F.sum("pairs").alias("n"), F.sum("hour_hundredths").alias("h"), F.sum("day_hundredths").alias("d")
    )
    return sums.select(
        "user_id",
        (F.col("h").cast("double") / (F.col("n").cast("double") * 100)).alias("avg_cart_to_checkout_hours"),
        (F.col("d").cast("double") / (F.col("n").cast("double") * 100)).alias("avg_cart_to_checkout_days"),
    )


def category_sets(
    df: DataFrame,
    catalogue: DataFrame,
    columns: Sequence[tuple[str, str]] = (("l1code", "l1codes"), ("l2code", "l2codes"), ("brickname", "bricks")),
    user: str = "user_id",
    count: str = "interaction_count",
) -> DataFrame:
    """Sorted category sets per user and their sizes; sets are bounded by the catalogue's categories."""
    used = with_catalogue(df.filter(F.col(count) != 0), catalogue)
    sets = used.groupBy(user).agg(*[F.array_sort(F.collect_set(c)).alias(name) for c, name in columns])
    return sets.select("*", *[F.size(name).alias(f"num_{name}") for _, name in columns])


def affinity_scores(
    df: DataFrame, catalogue: DataFrame, as_of: Column, attribute: str = "brandname", decay: float = DECAY_RATE
) -> DataFrame:
    """Decayed, weighted interaction score per (user, attribute value), rounded to two places."""
    weights = F.create_map(*[F.lit(x) for pair in INTERACTION_WEIGHTS.items() for x in pair])
    weight = F.coalesce(F.try_element_at(weights, F.col("interaction_type")), F.lit(0))
    rows = with_catalogue(df.filter(F.col("user_id").isNotNull() & (F.col("interaction_count") != 0)), catalogue)
    score = F.col("interaction_count") * weight * F.exp(F.lit(-decay) * F.datediff(as_of, F.col("date")))
    return (
        rows.filter(F.col(attribute).isNotNull())
        .groupBy("user_id", attribute)
        .agg(F.round(F.sum(score), 2).alias("affinity_score"))
    )


def brand_affinity(df: DataFrame, catalogue: DataFrame, as_of: Column) -> DataFrame:
    pair = F.struct(F.col("brandname").alias("brand"), F.col("affinity_score"))
    return affinity_scores(df, catalogue, as_of).select("user_id", pair.alias("brand_affinity"))


def enriched(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Interactions beside their catalogue row where there is one (``_item``), written once for all features."""
    used = ["user_id", "product_id", "product_sku_id", "interaction_type", "booked_rev", "interaction_count", "timestamp", "date"]
    items = catalogue.withColumnRenamed("itemid", "product_id").withColumn("_item", F.lit(True))
    return materialise(hot_key_join(df.select(*used), items, ["product_id"], "left"), "enriched")


CATEGORY_LISTS = (("l1code", "l1codes"), ("l2code", "l2codes"), ("brickname", "bricks"))


def value_and_category_features(rows: DataFrame, as_of: Column, decay: float = DECAY_RATE) -> DataFrame:
    """LTOV, TNR, avg_discount, category lists and their sizes and the brand affinity list of each user, from one pass over
    ``enriched`` rows.

    Equal to joining lifetime_order_value, returns_count, average_discount, category_sets and brand_affinity, each of which
    reads the table for itself; users none of them would list are left out. Sums are taken per user and brand first, so
    a user with a large share of the rows is spread by brand. Lists hold catalogue values and are sorted.
    """
    valid = F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & F.col("product_sku_id").isNotNull()
    kind, revenue, mrp = F.col("interaction_type"), F.col("booked_rev"), F.col("mrp")
    returned = valid & (kind == "return")
    valued = returned | (valid & (kind == "new_purchase"))
    placed = F.col("_item").isNotNull()
    counted = placed & (F.col("interaction_count") != 0)
    off = (1.0 - F.try_divide(revenue.cast("double"), mrp.cast("double"))) * 100
    discounted = valid & placed & mrp.isNotNull() & revenue.isNotNull() & (mrp != 0)
    weights = F.create_map(*[F.lit(x) for pair in INTERACTION_WEIGHTS.items() for x in pair])
    score = F.col("interaction_count") * F.coalesce(F.try_element_at(weights, kind), F.lit(0)) * F.exp(F.lit(-decay) * F.datediff(as_of, F.col("date")))
    times = lambda condition: F.count(F.when(condition, 1))
    by_brand = rows.groupBy("user_id", "brandname").agg(
        F.sum(F.when(valued, F.when(returned, -revenue).otherwise(revenue))).alias("value"),
        times(returned).alias("returns"),
        F.sum(F.when(discounted, off)).alias("off"),
        times(discounted & off.isNotNull()).alias("offs"),
        times(counted).alias("counted"),
        times(valued | (valid & placed) | counted).alias("listed"),
        F.sum(F.when(counted, score)).alias("score"),
        *[F.collect_set(F.when(counted, F.col(c))).alias(name) for c, name in CATEGORY_LISTS],
    )
    brand = F.struct(F.col("brandname").alias("brand"), F.round("score", 2).alias("affinity_score"))
    liked = F.col("user_id").isNotNull() & F.col("brandname").isNotNull() & (F.col("counted") > 0)
    any_counted = F.sum("counted") > 0
    lists = [F.when(any_counted, F.array_sort(F.array_distinct(F.flatten(F.collect_list(name))))).alias(name) for _, name in CATEGORY_LISTS]
    affinity = F.array_sort(F.collect_list(F.when(liked, brand)))
    users = by_brand.groupBy("user_id").agg(
        F.sum("value").alias("LTOV"),
        F.nullif(F.sum("returns"), F.lit(0)).alias("TNR"),
        F.try_divide(F.sum("off"), F.sum("offs")).alias("avg_discount"),
        *lists,
        F.when(F.size(affinity) > 0, affinity).alias("brand_affinity"),
        F.sum("listed").alias("_listed"),
    )
    return users.filter("_listed > 0").drop("_listed").select("*", *[F.size(name).alias(f"num_{name}") for _, name in CATEGORY_LISTS])


def order_time_features(rows: DataFrame) -> DataFrame:
    """avg_orders_per_week, avg_interval_days and avg_bag_value of each user from one aggregate over ``enriched`` rows by user and time.

    Equal to joining orders_per_week, average_interval and average_bag.
    """
    valid = F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & F.col("product_sku_id").isNotNull()
    bagged = F.col("_item").isNotNull() & (F.col("interaction_type") == "new_purchase")
    ordered = valid & (F.col("interaction_type") == "orders")
    times = rows.filter(bagged | ordered).groupBy("user_id", "timestamp").agg(
        F.count(F.when(ordered, 1)).alias("orders"), F.count(F.when(bagged, 1)).alias("bags"), F.sum(F.when(bagged, F.col("mrp"))).alias("bag")
    )
    times = materialise(times, "order-times")
    weeks = times.filter("orders > 0").agg(F.countDistinct(F.year("timestamp"), F.weekofyear("timestamp"))).scalar()
    at = F.when(F.col("orders") > 0, F.col("timestamp"))
    span = F.unix_timestamp(F.max(at)) - F.unix_timestamp(F.min(at))
    n = F.count(at)
    return times.groupBy("user_id").agg(
        F.when(n > 0, n / weeks).alias("avg_orders_per_week"),
        F.when(n > 1, F.round(span / F.nullif(n - 1, F.lit(0)) / 86400, 2)).alias("avg_interval_days"),
        F.avg(F.when(F.col("bags") > 0, F.col("bag"))).alias("avg_bag_value"),
    )


def union_features(tables: Sequence[DataFrame], key: str = "user_id") -> DataFrame:
    """One row per user over all feature tables, numbers and lists alike; each table has one row per user.

    The tables are put under one another, each with nulls for the columns of the others, and folded by one aggregate: one
    shuffle for any number of tables. Users without a key are one user.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return rows.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c != key])


def user_feature_table(df: DataFrame, catalogue: DataFrame, as_of: Column) -> DataFrame:
    """All features of every user: twelve numbers, three category lists and the brand affinity list."""
    rows = enriched(df, catalogue)
    return union_features(
        [value_and_category_features(rows, as_of), order_time_features(rows), total_returned_value(rows), cart_to_checkout(rows)]
    )
