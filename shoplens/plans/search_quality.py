"""Click-through, coverage, comparison, profile and guardrail queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions.arrays import cosine_strict
from shoplens.operators import guardrails as gr
from shoplens.operators import quality as qu
from shoplens.plans.domain import (
    DETECTED, HISTORY, PRODUCTS, RESULTS, SHOWN, TEMPLATED, TRUTH, WORD_COUNTS, detected_entities, history, products,
    search_results, shown_products, table, templated_queries, tokens_sql, truth_detected, vectors, word_counts,
)
from shoplens.operators.scale import materialise
from shoplens.plans.registry import flat, query


@query("arr_explode_products", f"WITH {RESULTS} SELECT query, id, round(score, 6) AS score FROM results")
def _(spark, d):
    return flat(qu.explode_products(search_results(spark, d)))


CTR_SQL = f"""{RESULTS}, {SHOWN}, ctr AS (SELECT query, option_code, sum(impressions) AS impressions, sum(clicks) AS clicks,
  sum(clicks) / nullif(sum(impressions), 0) AS ctr FROM shown GROUP BY 1, 2),
joined AS (SELECT r.query, r.id, r.score, c.ctr FROM results r LEFT JOIN ctr c ON r.query = c.query AND r.id = c.option_code)"""


@query(
    "agg_ctr",
    f"""WITH {CTR_SQL} SELECT query, option_code, CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,
    round(ctr, 6) AS ctr FROM ctr""",
)
def _(spark, d):
    return flat(qu.click_through(shown_products(spark, d)))


def joined_ctr(spark, d):
    return qu.score_with_ctr(qu.explode_products(search_results(spark, d)), qu.click_through(shown_products(spark, d)))


@query("join_score_ctr_left", f"WITH {CTR_SQL} SELECT query, id, round(score, 6) AS score, round(ctr, 6) AS ctr FROM joined")
def _(spark, d):
    return flat(joined_ctr(spark, d).select("query", "id", "score", "ctr"))


@query(
    "agg_ctr_query",
    f"WITH {CTR_SQL} SELECT query, round(least(avg(ctr), 1.0), 6) AS avg_ctr_query_level FROM joined WHERE ctr IS NOT NULL GROUP BY query",
)
def _(spark, d):
    return flat(qu.query_ctr(joined_ctr(spark, d)))


@query(
    "sort_ctr",
    f"""WITH {CTR_SQL} SELECT row_number() OVER (ORDER BY round(m, 9) DESC, query) AS position, query, round(least(m, 1.0), 6) AS avg_ctr_query_level
    FROM (SELECT query, avg(ctr) AS m FROM joined WHERE ctr IS NOT NULL GROUP BY query)""",
)
def _(spark, d):
    return flat(qu.sorted_query_ctr(joined_ctr(spark, d)))


@query("agg_ctr_coverage", f"WITH {CTR_SQL} SELECT count(*) FILTER (WHERE ctr IS NULL) AS null_ctr, count(*) AS total FROM joined")
def _(spark, d):
    return qu.ctr_coverage(joined_ctr(spark, d))


def ranking_history(spark, d):
    rows = table(spark, d, "lineitem").filter(F.col("l_returnflag") != "N")
    return rows.select(
        F.col("l_orderkey").cast("string").alias("search_term"),
        F.col("l_partkey").cast("string").alias("option_code"),
        (F.col("l_discount") * 10).alias("norm_revr"),
        F.col("l_quantity").alias("norm_ordr_clicks"),
        F.col("l_tax").alias("norm_ctr"),
    )


RANKING_SQL = f"""{RESULTS}, ranking AS (SELECT CAST(l_orderkey AS VARCHAR) AS query, CAST(l_partkey AS VARCHAR) AS id, l_discount * 10 AS norm_revr,
  l_quantity AS norm_ordr_clicks, l_tax AS norm_ctr FROM lineitem WHERE l_returnflag <> 'N')"""


@query(
    "join_score_history_inner",
    f"""WITH {RANKING_SQL} SELECT query, id, round(score, 6) AS score, round(norm_revr, 6) AS norm_revr,
    norm_ordr_clicks, norm_ctr FROM results JOIN ranking USING (query, id)""",
)
def _(spark, d):
    return flat(qu.score_with_history(qu.explode_products(search_results(spark, d)), ranking_history(spark, d)))


@query(
    "agg_correlation",
    f"""WITH {RANKING_SQL} SELECT round(corr(score, norm_revr), 6) AS corr_norm_revr, round(corr(score, norm_ordr_clicks), 6)
    AS corr_norm_ordr_clicks, round(corr(score, norm_ctr), 6) AS corr_norm_ctr FROM results JOIN ranking USING (query, id)""",
)
def _(spark, d):
    rows = qu.score_with_history(qu.explode_products(search_results(spark, d)), ranking_history(spark, d))
    return flat(qu.correlations(rows, "score", ["norm_revr", "norm_ordr_clicks", "norm_ctr"]))


@query(
    "agg_zsr",
    """WITH r AS (SELECT CASE WHEN value < 5 THEN '{"point_ids": []}' ELSE '{"point_ids": [' || event_id || ']}' END AS response FROM events)
    SELECT count(*) FILTER (WHERE contains(response, '{"point_ids": []')) AS zero_results, count(*) AS total,
    round(count(*) FILTER (WHERE contains(response, '{"point_ids": []')) / count(*), 6) AS ratio FROM r""",
)
def _(spark, d):
    response = F.when(F.col("value") < 5, '{"point_ids": []}').otherwise(F.concat(F.lit('{"point_ids": ['), F.col("event_id").cast("string"), F.lit("]}")))
    return flat(qu.zero_results(table(spark, d, "events").select(response.alias("response"))))


@query(
    "agg_minmax",
    """WITH s AS (SELECT min(p_size) a, max(p_size) b, min(p_retailprice) c, max(p_retailprice) e FROM part)
    SELECT p_partkey, round((p_size - a) / (b - a), 6) AS p_size, round((p_retailprice - c) / (e - c), 6) AS p_retailprice, 0.0::DOUBLE AS same
    FROM part, s""",
)
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", F.lit(3).alias("same"))
    return flat(qu.min_max_scale(rows, exclude=["p_partkey"]))


@query(
    "agg_describe",
    """SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS stddev,
    min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem""",
)
def _(spark, d):
    rows = qu.describe(table(spark, d, "lineitem"), "l_extendedprice")
    return rows.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


def pair_similarities(spark, d):
    """Each vector against the one with the next id."""
    rows = vectors(spark, d)
    ahead = rows.select((F.col("id") - 1).alias("id"), F.col("vec").alias("other"))
    return rows.join(ahead, "id").select("id", F.col("label").cast("string").alias("category"), cosine_strict(F.col("vec"), F.col("other")).alias("similarity"))


SIMILAR_SQL = """pairs AS (SELECT a.vec_id AS id, CAST(a.label AS VARCHAR) AS category,
  list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
  FROM embeddings a JOIN embeddings b ON a.vec_id + 1 = b.vec_id)"""


@query("ml_cosine_pair_np", f"WITH {SIMILAR_SQL} SELECT id, category, round(similarity, 6) AS similarity FROM pairs")
def _(spark, d):
    return flat(pair_similarities(spark, d))


def describe_sql(source: str) -> str:
    return f"""SELECT category, count(similarity) AS count, round(avg(similarity), 6) AS mean, round(stddev_samp(similarity), 6) AS std,
    round(min(similarity), 6) AS min, round(max(similarity), 6) AS max, round(quantile_cont(similarity, 0.25), 6) AS p25,
    round(quantile_cont(similarity, 0.5), 6) AS p50, round(quantile_cont(similarity, 0.75), 6) AS p75
    FROM (SELECT category, similarity FROM {source} UNION ALL SELECT 'All', similarity FROM {source}) GROUP BY category"""


@query("agg_describe_by_category", f"WITH {SIMILAR_SQL} {describe_sql('pairs')}")
def _(spark, d):
    return flat(qu.describe_by_category(pair_similarities(spark, d)))


@query("agg_bad_pairs", f"WITH {SIMILAR_SQL} SELECT id, category, round(similarity, 6) AS similarity FROM pairs WHERE similarity < 0.9")
def _(spark, d):
    return flat(qu.bad_pairs(pair_similarities(spark, d)))


QUANTILES = (0.0, 0.1, 0.15, 0.2, 0.25, 0.5, 0.75, 1.0)


@query(
    "agg_score_quantiles",
    "SELECT flags AS vertical, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}::DOUBLE), 6) AS q{int(round(p * 100)):03d}" for p in QUANTILES)
    + " FROM (SELECT l_returnflag || l_linestatus AS flags, l_extendedprice FROM lineitem) GROUP BY 1",
)
def _(spark, d):
    rows = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("vertical"), "l_extendedprice")
    return flat(qu.score_quantiles(rows, ["vertical"], "l_extendedprice"))


SET_ARGS = ("truth_category", "category", "truth_brand", "brand")


def _joined(expr: str) -> str:
    return f"array_to_string(list_sort({expr}), '|')"


def compare_columns(prefix: str, truth: str, found: str) -> str:
    hit = f"list_intersect({truth}, {found})"
    miss = f"list_filter({truth}, lambda x: NOT list_contains({found}, x))"
    extra = f"list_filter({found}, lambda x: NOT list_contains({truth}, x))"
    return f"""{_joined(hit)} AS {prefix}_intersection, {_joined(miss)} AS {prefix}_not_detected, {_joined(extra)} AS {prefix}_extra_detected,
    len({hit}) AS {prefix}_intersection_count, len({miss}) AS {prefix}_miss_count, len({extra}) AS {prefix}_extra_count"""


@query(
    "arr_set_compare",
    f"WITH {TRUTH} SELECT o_orderkey, {compare_columns('cat', 'truth_category', 'category')}, {compare_columns('brand', 'truth_brand', 'brand')} FROM truth",
)
def _(spark, d):
    return flat(gr.set_compare(truth_detected(spark, d), *SET_ARGS).drop("query", "vertical", *SET_ARGS))


def strict_columns(prefix: str, truth: str, found: str) -> str:
    hit = f"list_intersect({truth}, {found})"
    miss = f"CASE WHEN len({found}) = 0 THEN {truth} ELSE CAST([] AS VARCHAR[]) END"
    extra = f"CASE WHEN len({truth}) = 0 THEN {found} ELSE CAST([] AS VARCHAR[]) END"
    return f"""{_joined(hit)} AS {prefix}_hit, {_joined(miss)} AS {prefix}_miss, {_joined(extra)} AS {prefix}_extra,
    len({hit}) AS {prefix}_hit_count, len({miss}) AS {prefix}_miss_count, len({extra}) AS {prefix}_extra_count"""


@query(
    "arr_set_compare_strict",
    f"""WITH {TRUTH}, t AS (SELECT * EXCLUDE (truth_brand, brand), list_transform(truth_brand, lambda x: lower(x)) AS truth_brand,
      list_transform(brand, lambda x: lower(x)) AS brand FROM truth)
    SELECT o_orderkey, {strict_columns('cat', 'truth_category', 'category')}, {strict_columns('brand', 'truth_brand', 'brand')} FROM t""",
)
def _(spark, d):
    rows = truth_detected(spark, d).withColumn("truth_brand", F.transform("truth_brand", lambda b: F.lower(b)))
    return flat(gr.set_compare_strict(rows, *SET_ARGS).drop("query", "vertical", *SET_ARGS))


@query(
    "agg_ground_truth",
    f"""WITH {TRUTH}, c AS (SELECT o_orderkey, len(list_intersect(truth_category, category)) AS hits, len(truth_category) AS t,
    len(category) AS f FROM truth) SELECT o_orderkey, hits, t - hits AS missed, f - hits AS extra,
    round(hits / nullif(f, 0), 6) AS precision, round(hits / nullif(t, 0), 6) AS recall FROM c""",
)
def _(spark, d):
    rows = qu.detected_vs_truth(truth_detected(spark, d), "truth_category", "category")
    return flat(rows.select("o_orderkey", "hits", "missed", "extra", "precision", "recall"))


STATUS_SQL = f"""{TRUTH}, s AS (SELECT query, vertical, truth_category, truth_brand, category, brand, CASE
  WHEN len(truth_category) > 0 AND len(truth_brand) > 0 AND len(category) > 0 AND len(brand) > 0 THEN 'hit'
  WHEN len(truth_category) > 0 AND len(truth_brand) > 0 THEN 'miss' WHEN len(category) > 0 AND len(brand) > 0 THEN 'extra' END AS status FROM truth)"""
HIT_SQL = ", ".join(
    f"""count(*) FILTER (WHERE status = '{k}') AS {k}_count,
    coalesce(string_agg(DISTINCT vertical, '|' ORDER BY vertical) FILTER (WHERE status = '{k}'), '') AS {k}_verticals"""
    for k in ("hit", "extra", "miss")
)
HIT_ARGS = (["truth_category", "truth_brand"], ["category", "brand"])


@query("agg_hit_miss_extra", f"WITH {STATUS_SQL} SELECT query, {HIT_SQL} FROM s GROUP BY query")
def _(spark, d):
    return flat(gr.hit_miss_extra(truth_detected(spark, d), *HIT_ARGS))


@query(
    "agg_topn_steps",
    f"""WITH {STATUS_SQL}, filled AS (SELECT * FROM s WHERE len(truth_category) + len(truth_brand) + len(category) + len(brand) > 0)
    SELECT 'query' AS level, count(DISTINCT query) AS n, count(*) FILTER (WHERE status = 'hit') AS hits, count(*) FILTER (WHERE status = 'miss') AS misses,
      count(*) FILTER (WHERE status = 'extra') AS extras FROM filled
    UNION ALL SELECT 'empty', count(*), 0, 0, 0 FROM s WHERE len(truth_category) + len(truth_brand) + len(category) + len(brand) = 0
    UNION ALL SELECT 'query_vertical', count(*), CAST(sum(len(list_intersect(truth_category, category))) AS BIGINT),
      CAST(sum(len(list_filter(truth_category, lambda x: NOT list_contains(category, x)))) AS BIGINT),
      CAST(sum(len(list_filter(category, lambda x: NOT list_contains(truth_category, x)))) AS BIGINT) FROM filled""",
)
def _(spark, d):
    from shoplens.operators.cleaning import split_all_empty

    rows = materialise(truth_detected(spark, d), "truth")  # read by three reports
    filled, empty = split_all_empty(rows, ["truth_category", "truth_brand", "category", "brand"])
    per_query = gr.hit_miss_extra(filled, *HIT_ARGS)
    level = gr.set_compare(filled, *SET_ARGS)
    count = F.count(F.lit(1)).alias("n")
    parts = [
        per_query.agg(F.lit("query").alias("level"), count, F.sum("hit_count").alias("hits"), F.sum("miss_count").alias("misses"), F.sum("extra_count").alias("extras")),
        empty.agg(F.lit("empty").alias("level"), count, *[F.lit(0).cast("bigint").alias(c) for c in ("hits", "misses", "extras")]),
        level.agg(
            F.lit("query_vertical").alias("level"), count, F.sum("cat_intersection_count").alias("hits"),
            F.sum("cat_miss_count").alias("misses"), F.sum("cat_extra_count").alias("extras"),
        ),
    ]
    return flat(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(
    "agg_net_score",
    """SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS l_discount,
    round(sum(l_tax * l_quantity) / sum(l_quantity), 6) AS l_tax FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    return flat(qu.net_scores(table(spark, d, "lineitem"), ["l_discount", "l_tax"], "l_quantity", ["l_returnflag"]))


@query(
    "agg_under_score",
    f"""WITH {HISTORY}, q AS (SELECT search_term AS query, sum(freq) AS freq, sum(clicks) AS c FROM history GROUP BY 1)
    SELECT query, CAST(freq AS BIGINT) AS freq, round(c / freq, 6) AS score, round(freq * (1 - c / freq), 6) AS loss FROM q
    ORDER BY freq - c DESC, query LIMIT 200""",
)
def _(spark, d):
    h = history(spark, d).withColumnRenamed("search_term", "query")
    steps = h.groupBy("query").agg(F.sum("freq").alias("freq"))
    performance = h.groupBy("query").agg((F.sum("clicks") / F.sum("freq")).alias("score"))
    exact = qu.under_performing(steps, performance.withColumn("score", F.round("score", 9)), 200)
    return flat(exact.select("query", "freq", "score", "loss"))


@query(
    "agg_word_coverage",
    f"""WITH {WORD_COUNTS}, corpus AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS word FROM documents),
    j AS (SELECT products AS freq, c.word IS NOT NULL AS known FROM word_counts LEFT JOIN corpus c USING (word))
    SELECT count(*) AS words, count(*) FILTER (WHERE known) AS covered_words, CAST(sum(freq) AS BIGINT) AS freq,
    CAST(sum(freq) FILTER (WHERE known) AS BIGINT) AS covered_freq, round(count(*) FILTER (WHERE known) / count(*), 6) AS word_coverage,
    round(sum(freq) FILTER (WHERE known) / sum(freq), 6) AS freq_coverage FROM j""",
)
def _(spark, d):
    from shoplens.functions.text import normal_tokens

    corpus = table(spark, d, "documents").select(F.explode_outer(normal_tokens(F.col("text"))).alias("word")).filter(F.col("word").isNotNull())
    return flat(qu.word_coverage(word_counts(spark, d).withColumnRenamed("products", "freq"), corpus))


def intents(spark, d):
    """Detected categories of a name: those of its small parts."""
    p = products(spark, d).filter(F.col("size") <= 5)
    return p.select(F.col("name").alias("query"), "category").distinct()


INTENTS_SQL = f"""{HISTORY}, {PRODUCTS}, intents AS (SELECT DISTINCT name AS query, category FROM products WHERE size <= 5),
pair AS (SELECT search_term AS query, sku, sum(clicks) AS clicks FROM history GROUP BY 1, 2),
judged AS (SELECT pair.query, pair.clicks, category, i.query IS NOT NULL AS hit FROM pair JOIN products USING (sku)
  LEFT JOIN intents i USING (query, category))"""


def named_history(spark, d):
    return history(spark, d).withColumnRenamed("search_term", "query")


def covered_sql(key: str) -> str:
    return f"""WITH {INTENTS_SQL} SELECT {key}, count(*) AS products, count(*) FILTER (WHERE hit) AS covered,
    round(100.0 * count(*) FILTER (WHERE hit) / count(*), 6) AS percent_covered FROM judged GROUP BY 1"""


@query("agg_interaction_covered", covered_sql("query"))
def _(spark, d):
    return flat(qu.interaction_covered(named_history(spark, d), products(spark, d), intents(spark, d), "category", ["query"]))


@query("agg_interaction_covered_intent", covered_sql("category"))
def _(spark, d):
    return flat(qu.interaction_covered(named_history(spark, d), products(spark, d), intents(spark, d), "category", ["category"]))


@query(
    "agg_history_coverage",
    f"""WITH {INTENTS_SQL} SELECT query, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(coalesce(sum(clicks) FILTER (WHERE hit), 0) AS BIGINT) AS covered_clicks,
    round(coalesce(sum(clicks) FILTER (WHERE hit), 0) / nullif(sum(clicks), 0), 6) AS history_coverage FROM judged GROUP BY query""",
)
def _(spark, d):
    rows = named_history(spark, d).groupBy("query", "sku").agg(F.sum("clicks").alias("clicks"))
    clicks = rows.join(products(spark, d).select("sku", "category"), "sku")
    return flat(qu.history_coverage(clicks, intents(spark, d)))


@query(
    "agg_entity_performance",
    f"""WITH {INTENTS_SQL}, c AS (SELECT query, category, sum(clicks) AS clicks FROM judged GROUP BY 1, 2)
    SELECT category, count(*) AS queries, CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks FROM intents LEFT JOIN c USING (query, category) GROUP BY 1""",
)
def _(spark, d):
    return flat(qu.entity_performance(named_history(spark, d), products(spark, d), intents(spark, d), "category"))


TOKEN_CATEGORY_SQL = f"""{PRODUCTS},
det AS (SELECT DISTINCT unnest({tokens_sql('name')}) AS token, category FROM products WHERE size <= 25),
his AS (SELECT DISTINCT unnest({tokens_sql("name || ' ' || brandname")}) AS token, category FROM products WHERE size > 10)"""


@query(
    "agg_token_category_performance",
    f"""WITH {TOKEN_CATEGORY_SQL}, j AS (SELECT coalesce(det.token, his.token) AS token, det.token IS NOT NULL AS d, his.token IS NOT NULL AS h
      FROM det FULL JOIN his ON det.token = his.token AND det.category = his.category),
    c AS (SELECT token, count(*) FILTER (WHERE d) AS detected, count(*) FILTER (WHERE h) AS expected, count(*) FILTER (WHERE d AND h) AS common FROM j GROUP BY token)
    SELECT *, round(common / nullif(detected, 0), 6) AS precision, round(common / nullif(expected, 0), 6) AS recall FROM c""",
)
def _(spark, d):
    from shoplens.functions.text import normal_tokens

    p = products(spark, d)
    det = p.filter("size <= 25").select(F.explode_outer(normal_tokens(F.col("name"))).alias("token"), "category").filter(F.col("token").isNotNull())
    his = p.filter("size > 10").select(F.explode_outer(normal_tokens(F.concat_ws(" ", "name", "brandname"))).alias("token"), "category").filter(F.col("token").isNotNull())
    return flat(qu.token_category_performance(det, his))


@query(
    "agg_product_counts",
    f"""WITH {TRUTH}, {PRODUCTS}, f AS (SELECT o_orderkey AS query, unnest(brand) AS brandname FROM truth)
    SELECT query, count(DISTINCT sku) AS products FROM f JOIN products USING (brandname) GROUP BY query""",
)
def _(spark, d):
    filters = truth_detected(spark, d).select(F.col("o_orderkey").alias("query"), F.col("brand").alias("values"))
    return qu.filter_product_counts(filters, products(spark, d), "brandname")


DIFF_SQL = """a AS (SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size <= 40),
b AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN p_size + 1 ELSE p_size END AS p_size, p_retailprice FROM part WHERE p_size >= 10)"""


@query(
    "agg_quality_diff",
    f"""WITH {DIFF_SQL} SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.p_partkey IS NULL THEN 'added'
    WHEN b.p_partkey IS NULL THEN 'removed' WHEN a.p_size = b.p_size AND a.p_retailprice = b.p_retailprice THEN 'same' ELSE 'changed' END AS status,
    CAST(b.p_size - a.p_size AS DOUBLE) AS delta_p_size, round(b.p_retailprice - a.p_retailprice, 6) AS delta_p_retailprice
    FROM a FULL JOIN b ON a.p_partkey = b.p_partkey""",
)
def _(spark, d):
    p = table(spark, d, "part").withColumn("p_size", F.col("p_size").cast("double"))
    new = p.filter("p_size >= 10").withColumn("p_size", F.when(F.col("p_size") % 7 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return flat(qu.corpus_diff(p.filter("p_size <= 40"), new, ["p_partkey"], ["p_size", "p_retailprice"]))


@query(
    "agg_issue_score_delta",
    """WITH n AS (SELECT c_custkey AS query, c_acctbal AS score FROM customer), b AS (SELECT o_custkey AS query, avg(o_totalprice) AS score FROM orders GROUP BY 1)
    SELECT n.query, n.score, round(b.score, 4) AS previous_score, round(n.score - b.score, 4) AS delta FROM n LEFT JOIN b USING (query)""",
)
def _(spark, d):
    now = table(spark, d, "customer").select(F.col("c_custkey").alias("query"), F.col("c_acctbal").alias("score"))
    before = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("query")).agg(F.avg("o_totalprice").alias("score"))
    out = qu.issue_score_delta(now, before)
    return out.withColumns({"previous_score": F.round("previous_score", 4), "delta": F.round("delta", 4)})


@query(
    "agg_null_profile",
    """WITH t AS (SELECT CASE WHEN o_orderdate >= DATE '1999-01-01' THEN 3 WHEN o_orderdate >= DATE '1997-01-01' THEN 6 ELSE 12 END AS period,
      nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
    SELECT period, 'status' AS "column", round(100.0 * count(*) FILTER (WHERE status IS NULL) / count(*), 6) AS percent_null FROM t GROUP BY 1
    UNION ALL SELECT period, 'priority', round(100.0 * count(*) FILTER (WHERE priority IS NULL) / count(*), 6) FROM t GROUP BY 1""",
)
def _(spark, d):
    day = F.col("o_orderdate")
    period = F.when(day >= F.lit("1999-01-01").cast("date"), 3).when(day >= F.lit("1997-01-01").cast("date"), 6).otherwise(12)
    rows = table(spark, d, "orders").select(
        period.alias("period"), F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    return flat(qu.null_profile(rows, ["status", "priority"], "period"))


@query(
    "agg_null_rows",
    """WITH t AS (SELECT o_orderpriority AS file, nullif(o_orderstatus, 'P') AS status, o_totalprice AS amount, o_orderdate AS ts FROM orders)
    SELECT file, count(*) AS total_rows, count(*) FILTER (WHERE status IS NULL) AS null_rows,
    round(100.0 * count(*) FILTER (WHERE status IS NULL) / count(*), 6) AS null_row_percentage, """
    + ", ".join(f"round(coalesce(sum(amount) FILTER (WHERE ts >= DATE '2000-01-01' - INTERVAL {m} MONTH), 0), 2) AS sales_last_{m}_months" for m in (3, 6, 12))
    + " FROM t GROUP BY file",
)
def _(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("file"), F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("ts"),
    )
    out = qu.null_row_profile(rows, "file", ["status"], "amount", "ts", F.lit("2000-01-01").cast("date"))
    return flat(out.withColumns({f"sales_last_{m}_months": F.round(f"sales_last_{m}_months", 2) for m in (3, 6, 12)}))


@query(
    "agg_family_share",
    """WITH a AS (SELECT p_type AS family, p_partkey AS article FROM part), m AS (SELECT DISTINCT l_partkey AS article, l_returnflag AS file FROM lineitem
      WHERE l_quantity > 45)
    SELECT family, round(100.0 * count(*) FILTER (WHERE x.file = 'A') / max(n), 6) AS "A", round(100.0 * count(*) FILTER (WHERE x.file = 'N') / max(n), 6) AS "N",
    round(100.0 * count(*) FILTER (WHERE x.file = 'R') / max(n), 6) AS "R"
    FROM (SELECT family, file, n FROM (SELECT a.family, a.article, c.n FROM a JOIN (SELECT family, count(*) AS n FROM a GROUP BY 1) c USING (family)) b
      LEFT JOIN m USING (article)) x GROUP BY family""",
)
def _(spark, d):
    articles = table(spark, d, "part").select(F.col("p_type").alias("family"), F.col("p_partkey").alias("article_id"))
    matches = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("article_id"), F.col("l_returnflag").alias("file"))
    return flat(qu.family_share(articles, matches, ["A", "N", "R"]))


WRONG_SQL = f"""v AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS token FROM documents),
t AS (SELECT conv_id, turn, unnest(list_distinct({tokens_sql('text')})) AS token FROM conversations)"""


def wrong(spark, d):
    from shoplens.functions.text import normal_tokens

    vocabulary = table(spark, d, "documents").select(F.explode_outer(normal_tokens(F.col("text"))).alias("token")).filter(F.col("token").isNotNull())
    queries = table(spark, d, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query"),
        normal_tokens(F.col("text")).alias("tokens"),
        F.lit(1).alias("freq"),
    )
    return qu.wrong_tokens(queries, vocabulary)


@query("agg_wrong_tokens", f"WITH {WRONG_SQL} SELECT token, count(*) AS freq FROM t ANTI JOIN v USING (token) GROUP BY token")
def _(spark, d):
    return wrong(spark, d)[0]


@query(
    "agg_wrong_token_queries",
    f"WITH {WRONG_SQL} SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS query, token, 1 AS freq FROM t ANTI JOIN v USING (token)",
)
def _(spark, d):
    return flat(wrong(spark, d)[1])


ENTITY_CASES = {
    "brand": ("brand_string_mv", "brand"), "colour": ("brickprimarycolor_en_string_mv", "colour"),
    "l1": ("l1_category", "l1"), "l2": ("l2_category", "l2"), "l3": ("l3_category", "l3"),
}
EXPECTED_SQL = f"""{TEMPLATED}, expected AS (SELECT query_template, array_to_string(query, ' ') AS input_query, array_to_string(query_template, ', ') AS
  query_template_string, p_partkey, """ + ", ".join(
    f"CASE WHEN list_contains(query_template, '{e}') THEN [query[list_position(query_template, '{e}')]] ELSE CAST([] AS VARCHAR[]) END AS {s}_gr"
    for e, s in ENTITY_CASES.values()
) + """ FROM templated), uniq AS (SELECT * FROM expected WHERE input_query IN (SELECT input_query FROM expected GROUP BY 1 HAVING count(*) = 1))"""
GR = ["brand_gr", "colour_gr", "l1_gr", "l2_gr", "l3_gr"]


def expected(spark, d):
    return gr.template_entities(templated_queries(spark, d))


def unique_expected(spark, d):
    return gr.unique_queries(expected(spark, d).withColumnRenamed("query", "query_parts"))


@query(
    "arr_template_extract",
    f"WITH {EXPECTED_SQL} SELECT p_partkey, input_query, " + ", ".join(f"array_to_string({g}, '|') AS {g}" for g in GR) + " FROM expected",
)
def _(spark, d):
    return flat(expected(spark, d).select(F.col("product_count").alias("p_partkey"), "input_query", *GR))


@query("arr_wrap_scalar", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS wrapped, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS n FROM part")
def _(spark, d):
    from shoplens.functions.arrays import wrap_scalar

    value = wrap_scalar(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")))
    return flat(table(spark, d, "part").select("p_partkey", value.alias("wrapped"), F.size(value).alias("n")))


@query("win_unique_query", f"WITH {EXPECTED_SQL} SELECT p_partkey, input_query FROM uniq")
def _(spark, d):
    return unique_expected(spark, d).select(F.col("product_count").alias("p_partkey"), "input_query")


@query(
    "win_topn_per_template",
    f"""WITH {EXPECTED_SQL} SELECT query_template_string, input_query, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_template_string
    ORDER BY input_query) AS rank FROM uniq) WHERE rank <= 15""",
)
def _(spark, d):
    return flat(gr.top_n_per_template(unique_expected(spark, d), 15).select("query_template_string", "input_query", "rank"))


@query("win_first_per_template", f"WITH {EXPECTED_SQL} SELECT query_template_string, min(input_query) AS input_query FROM uniq GROUP BY 1")
def _(spark, d):
    return gr.first_per_template(unique_expected(spark, d)).select("query_template_string", "input_query")


def template_results(spark, d):
    return gr.join_detected(unique_expected(spark, d), detected_entities(spark, d))


TEMPLATE_JOIN = f"{EXPECTED_SQL}, {DETECTED}, res AS (SELECT u.*, d.* EXCLUDE (input_query) FROM uniq u JOIN detected d USING (input_query))"
PROC = [g.replace("_gr", "_proc") for g in GR]


@query("join_template_result", f"WITH {TEMPLATE_JOIN} SELECT input_query, " + ", ".join(f"array_to_string({c}, '|') AS {c}" for c in GR + PROC) + " FROM res")
def _(spark, d):
    return flat(template_results(spark, d).select("input_query", *GR, *PROC))


MISMATCH = "(" + " OR ".join(f"{g} <> {p}" for g, p in zip(GR, PROC)) + ")"


@query("arr_entity_mismatch", f"WITH {TEMPLATE_JOIN} SELECT input_query FROM res WHERE {MISMATCH}")
def _(spark, d):
    return gr.entity_mismatches(template_results(spark, d)).select("input_query")


@query(
    "arr_synonym_check",
    f"WITH {TEMPLATE_JOIN} SELECT input_query, list_has_any(flatten([{', '.join(GR)}]), all_syn) AS check_syn FROM res WHERE {MISMATCH}",
)
def _(spark, d):
    return gr.synonym_check(gr.entity_mismatches(template_results(spark, d))).select("input_query", "check_syn")


SCORE_SQL = ", ".join(f"len(list_intersect({g}, {p})) AS {g.replace('_gr', '_score')}" for g, p in zip(GR, PROC))


@query(
    "arr_entity_scores",
    f"""WITH {TEMPLATE_JOIN}, sc AS (SELECT input_query, query_template, {SCORE_SQL} FROM res WHERE {MISMATCH})
    SELECT *  EXCLUDE (query_template), array_to_string(list_sort(query_template), '|') AS imp_entities,
    brand_score + colour_score + l1_score + l2_score + l3_score = len(query_template) AS score_alignment FROM sc""",
)
def _(spark, d):
    scored = gr.entity_scores(gr.entity_mismatches(template_results(spark, d)))
    return flat(scored.select("input_query", *[g.replace("_gr", "_score") for g in GR], "imp_entities", "score_alignment"))


@query(
    "arr_entity_failed",
    f"""WITH {TEMPLATE_JOIN}, sc AS (SELECT input_query, query_template, {SCORE_SQL} FROM res WHERE {MISMATCH})
    SELECT input_query FROM sc WHERE brand_score + colour_score + l1_score + l2_score + l3_score <> len(query_template)""",
)
def _(spark, d):
    scored = gr.entity_scores(gr.entity_mismatches(template_results(spark, d)))
    return gr.failed_rows(scored).select("input_query")


def counted_names(spark, d):
    return table(spark, d, "part").groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("brandname")).agg(F.count(F.lit(1)).alias("distinct_products"))


BANDS_SQL = """b AS (SELECT p_brand || ' ' || p_type AS brandname, count(*) AS distinct_products FROM part GROUP BY 1 HAVING count(*) > 5),
r AS (SELECT *, row_number() OVER (ORDER BY distinct_products DESC, brandname) AS rn, count(*) OVER () AS c FROM b)"""
BAND_PARTS = [("top", "rn <= 30"), ("mid", "rn > c // 2 - 15 AND rn <= c // 2 + 15"), ("least", "rn > c - 30")]


@query(
    "band_top_mid_least",
    f"WITH {BANDS_SQL} " + " UNION ALL ".join(f"SELECT brandname, distinct_products, '{b}' AS band FROM r WHERE {w}" for b, w in BAND_PARTS),
)
def _(spark, d):
    return gr.brand_bands(counted_names(spark, d), 30, 5)


@query(
    "set_pandas_concat",
    f"WITH {BANDS_SQL} SELECT band, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{b}' AS band FROM r WHERE {w}" for b, w in BAND_PARTS) + ") GROUP BY band",
)
def _(spark, d):
    return gr.brand_bands(counted_names(spark, d), 30, 5).groupBy("band").agg(F.count(F.lit(1)).alias("n"))


RANKED_SQL = """ranked AS (SELECT lower(regexp_replace(o.p_brand, '#', ' # ')) AS query, r.p_brand AS brandname,
  (r.p_partkey - o.p_partkey) AS rank FROM part o JOIN part r ON r.p_partkey > o.p_partkey AND r.p_partkey <= o.p_partkey + 3)"""


def ranked_brands(spark, d):
    """Result brands of a brand query: those of the next three parts."""
    p = table(spark, d, "part")
    name = F.lower(F.regexp_replace("p_brand", "#", " # "))
    probes = p.select(name.alias("query"), "p_partkey", F.explode_outer(F.sequence(F.lit(1), F.lit(3))).alias("rank")).filter(F.col("rank").isNotNull())
    results = p.select(F.col("p_partkey").alias("hit"), F.col("p_brand").alias("brandname"))
    return probes.join(results, F.col("p_partkey") + F.col("rank") == F.col("hit")).select("query", "rank", "brandname")


NORMAL = "lower(regexp_replace({}, '[^a-zA-Z0-9]', '', 'g'))"
SAME_BRAND = f"{NORMAL.format('brandname')} = {NORMAL.format('query')}"


@query(
    "arr_brand_check",
    f"""WITH {RANKED_SQL} SELECT query, coalesce(string_agg(DISTINCT brandname, '|' ORDER BY brandname) FILTER (WHERE NOT {SAME_BRAND}), '') AS not_matching_brands,
    count(*) FILTER (WHERE NOT {SAME_BRAND}) AS not_matching_count,
    coalesce(string_agg(DISTINCT brandname, '|' ORDER BY brandname) FILTER (WHERE {SAME_BRAND}), '') AS matching_brands,
    count(*) FILTER (WHERE {SAME_BRAND}) AS matching_count, 2 AS total_count, count(*) FILTER (WHERE NOT {SAME_BRAND}) = 0 AS passed
    FROM ranked WHERE rank <= 2 GROUP BY query""",
)
def _(spark, d):
    return flat(gr.brand_check(ranked_brands(spark, d), 2))
