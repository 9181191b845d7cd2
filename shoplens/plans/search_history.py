"""Query cleaning, history joins and aggregates, relevance, dictionary extracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shoplens.functions.text import normal_brand, vertical_name, vertical_snake
from shoplens.operators import cleaning as cl
from shoplens.operators import history as hi
from shoplens.plans.domain import (
    HISTORY, NAMED_QUERIES, PRODUCTS, SEARCHES, SHEET, SHOWN, TRUTH, history, named_queries, products, searches, shown_products,
    synonyms_sheet, table, tokens_sql, truth_detected,
)
from shoplens.operators.scale import materialise, scratch_path
from shoplens.plans.registry import flat, query
from shoplens.sources.incremental import DailySums

LAST_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape_sql(column: str) -> str:
    for name, text in LAST_ENTITIES:
        text = text.replace("'", "''")
        column = f"replace({column}, '{name}', '{text}')"
    return column


CLEANED = rf"""step1 AS (SELECT lower(regexp_replace(trim({unescape_sql('search_term')}), '\s+', ' ', 'g')) AS q, total_searches FROM searches),
step2 AS (SELECT translate(q, '“”‘’', '""''''') AS q, total_searches FROM step1
  WHERE len(list_filter(range(1, length(q) - 2), lambda i: q[i] = q[i + 1] AND q[i] = q[i + 2] AND q[i] = q[i + 3])) = 0),
cleaned AS (SELECT q AS query, sum(total_searches) AS freq FROM step2
  WHERE regexp_matches(q, '[a-z0-9]') AND length(q) <= 100
    AND NOT regexp_matches(q, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')
    AND NOT regexp_matches(q, '^[0-9]+(\s[0-9]+)*$') AND len(regexp_split_to_array(q, '[^a-zA-Z0-9_]+')) <= 8
  GROUP BY q)"""


@query("qry_initial_analysis", f"WITH {SEARCHES}, {CLEANED} SELECT query, CAST(freq AS BIGINT) AS freq FROM cleaned")
def _(spark, d):
    return cl.query_and_word_tables(searches(spark, d))[0]


@query(
    "qry_initial_words",
    f"""WITH {SEARCHES}, {CLEANED}, w AS (SELECT unnest(list_distinct({tokens_sql('query')})) AS word, freq FROM cleaned)
    SELECT word, CAST(sum(freq) AS BIGINT) AS freq, count(*) AS queries FROM w GROUP BY word""",
)
def _(spark, d):
    return cl.query_and_word_tables(searches(spark, d))[1]


@query(
    "qry_clean_topk",
    f"WITH {SEARCHES}, {CLEANED} SELECT query, CAST(freq AS BIGINT) AS freq FROM cleaned ORDER BY freq DESC, query LIMIT 1000",
)
def _(spark, d):
    return cl.clean_top_queries(searches(spark, d), 1000)


@query(
    "topk_queries",
    f"WITH {NAMED_QUERIES} SELECT query, freq FROM named_queries ORDER BY freq DESC, query LIMIT 100",
)
def _(spark, d):
    return cl.top_queries(named_queries(spark, d).select("query", "freq"), 100)


@query(
    "qry_html_decode",
    f"SELECT page_id, md5({unescape_sql('html')}) AS decoded, length({unescape_sql('html')}) AS n FROM pages",
)
def _(spark, d):
    from shoplens.functions.text import unescape_html

    text = unescape_html(F.col("html"))
    return table(spark, d, "pages").select("page_id", text.alias("t")).select("page_id", F.md5("t").alias("decoded"), F.length("t").alias("n"))


@query(
    "qry_history_normalise",
    f"""WITH {SEARCHES} SELECT search_term, array_to_string({tokens_sql('search_term')}, '|') AS query_normalised
    FROM searches WHERE len({tokens_sql('search_term')}) > 0""",
)
def _(spark, d):
    return flat(cl.normalise_history(searches(spark, d)).select("search_term", "query_normalised"))


@query(
    "qry_history_tracker",
    f"""WITH {SEARCHES}, n AS (SELECT search_term, array_to_string({tokens_sql('search_term')}, ' ') AS joined FROM searches)
    SELECT CASE WHEN joined = '' THEN 'dropped' WHEN joined = search_term THEN 'unchanged' ELSE 'changed' END AS outcome,
    count(*) AS rows FROM n GROUP BY 1""",
)
def _(spark, d):
    return cl.normalise_tracker(searches(spark, d))


@query(
    "qry_short",
    f"""WITH {HISTORY} SELECT array_to_string(query_normalised, '|') AS query_normalised, CAST(sum(freq) AS BIGINT) AS freq
    FROM history WHERE len(query_normalised) <= 3 GROUP BY 1""",
)
def _(spark, d):
    return flat(cl.short_queries(history(spark, d), 3))


@query(
    "qry_performance_normalise",
    f"""WITH {NAMED_QUERIES} SELECT unnest(list_distinct(tokens)) AS word, query, freq FROM named_queries""",
)
def _(spark, d):
    return cl.word_query_pairs(named_queries(spark, d))


BRANDS_SQL = "brands AS (SELECT DISTINCT p_brand AS brandname FROM part)"
NUMBER_LIST = "[" + ", ".join(f"'{w}'" for w in cl.NUMBER_WORDS) + "]"


@query(
    "brand_numeric_identify",
    f"""WITH {BRANDS_SQL} SELECT brandname FROM brands WHERE regexp_matches(brandname, '[0-9]')
    OR list_has_any({tokens_sql('brandname')}, {NUMBER_LIST})""",
)
def _(spark, d):
    return cl.numeric_brands(products(spark, d).select("brandname").distinct())


NUMBER_CASE = "CASE t " + " ".join(f"WHEN '{w}' THEN '{n}'" for w, n in cl.NUMBER_WORDS.items()) + " ELSE t END"


@query(
    "qry_text_to_num",
    f"""WITH {SEARCHES}, {BRANDS_SQL}, kept AS (SELECT lower(brandname) AS b FROM brands WHERE regexp_matches(brandname, '[0-9]')
      OR list_has_any({tokens_sql('brandname')}, {NUMBER_LIST}))
    SELECT DISTINCT search_term AS query, CASE WHEN search_term IN (SELECT b FROM kept) THEN search_term
    ELSE array_to_string(list_transform({tokens_sql('search_term')}, lambda t: {NUMBER_CASE}), ' ') END AS query_numeric FROM searches""",
)
def _(spark, d):
    queries = searches(spark, d).select(F.col("search_term").alias("query")).distinct()
    return cl.text_to_number(queries, products(spark, d).select("brandname").distinct()).select("query", "query_numeric")


@query(
    "qry_normalise_brand",
    "SELECT p_partkey, lower(regexp_replace(p_brand || ' & ' || p_name, '[^a-zA-Z0-9]', '', 'g')) AS brand FROM part",
)
def _(spark, d):
    text = F.concat_ws(" & ", "p_brand", "p_name")
    return table(spark, d, "part").select("p_partkey", normal_brand(text).alias("brand"))


@query(
    "qry_vertical_name",
    """SELECT c_custkey, replace(replace(replace(c_mktsegment || ' & ' || c_name || ', x', ' ', ''), '&', 'And'), ',', '_') AS vertical,
    replace(replace(replace(lower(c_mktsegment || ' & ' || c_name || ', x'), '&', 'and'), ' ', '_'), ',', '_') AS snake FROM customer""",
)
def _(spark, d):
    text = F.concat("c_mktsegment", F.lit(" & "), "c_name", F.lit(", x"))
    return table(spark, d, "customer").select("c_custkey", vertical_name(text).alias("vertical"), vertical_snake(text).alias("snake"))


@query(
    "qry_variant_extract_brand_acronym",
    f"WITH {SHEET} SELECT lower(synonyms) AS phrase, keyword AS phrase_key, '1' AS is_acronym FROM sheet WHERE variant = 'BRAND ACRONYM'",
)
def _(spark, d):
    return cl.brand_acronyms(synonyms_sheet(spark, d))


@query(
    "qry_variant_extract_hinglish",
    f"""WITH {SHEET} SELECT lower(synonyms) AS "Word", keyword AS "Hinglish Translation", '1' AS is_hinglish FROM sheet
    WHERE variant = 'HINGLISH'""",
)
def _(spark, d):
    return cl.hinglish(synonyms_sheet(spark, d))


@query(
    "qry_variant_extract_ukus",
    f"WITH {SHEET} SELECT lower(keyword) AS uk, lower(synonyms) AS american FROM sheet WHERE variant = 'UK TO US'",
)
def _(spark, d):
    return cl.uk_to_us(synonyms_sheet(spark, d))


EXTERNAL_SQL = f"""WITH {SHEET}, numbered AS (SELECT *, row_number() OVER (ORDER BY keyword NULLS FIRST, synonyms, variant) AS row_num
  FROM sheet WHERE variant IN ('SPELL VARIANT', 'STEM VARIANT', 'BRAND EXPANSION'))"""


@query(
    "qry_variant_extract_external",
    EXTERNAL_SQL
    + """ SELECT row_num, lower(keyword) AS word, lower(synonyms) AS rightword, NULL::VARCHAR AS _c3, NULL::VARCHAR AS w_count,
    NULL::VARCHAR AS r_count, NULL::VARCHAR AS old_r_count, NULL::VARCHAR AS soundex, NULL::VARCHAR AS "dropThese?",
    NULL::VARCHAR AS "RtoR", NULL::VARCHAR AS "Remarks", 'W2R' AS mapping_type FROM numbered""",
)
def _(spark, d):
    return cl.external_variants(synonyms_sheet(spark, d))


@query(
    "win_row_number_global",
    "SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS row_num FROM part",
)
def _(spark, d):
    from shoplens.operators.scale import global_positions

    rows = table(spark, d, "part").select("p_name", "p_partkey")
    return global_positions(rows, [F.asc("p_name"), F.asc("p_partkey")], "row_num").select("p_partkey", "row_num")


@query(
    "qry_variant_extract_vocab",
    f"""WITH {SHEET} SELECT lower(keyword) AS externalword, lower(unnest(string_split(synonyms, '|'))) AS rightword,
    NULL::FLOAT AS score, NULL::INTEGER AS rightword_count, NULL::VARCHAR AS "Drop", variant FROM sheet
    WHERE variant IN ('DEVNAGRI', 'EXPANSION', 'NUMERICAL', 'SYMBOL')""",
)
def _(spark, d):
    return cl.external_vocabulary(synonyms_sheet(spark, d))


@query(
    "qry_variant_extract_synonyms",
    f"""WITH {SHEET} SELECT lower(coalesce(keyword, synonyms)) AS token, lower(synonyms) AS synonyms FROM sheet
    WHERE variant IN ('SYNONYMS', 'HINGLISH SYNONYMS', 'SUBSTITUTE')""",
)
def _(spark, d):
    return cl.external_synonyms(synonyms_sheet(spark, d))


@query(
    "set_union_rows",
    f"""WITH {SHEET} SELECT keyword AS token, synonyms FROM sheet WHERE keyword IS NOT NULL
    UNION ALL SELECT synonyms, synonyms FROM sheet WHERE keyword IS NULL""",
)
def _(spark, d):
    from shoplens.operators.tables import union_rows

    sheet = synonyms_sheet(spark, d)
    with_key = sheet.filter(F.col("keyword").isNotNull()).select(F.col("keyword").alias("token"), "synonyms")
    without = sheet.filter(F.col("keyword").isNull()).select(F.col("synonyms").alias("token"), "synonyms")
    return union_rows(with_key, without)


@query(
    "list_clean",
    """SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([p_brand, p_type, CASE WHEN p_size > 25 THEN p_brand END],
    lambda v: v IS NOT NULL))), '|') AS cleaned FROM part""",
)
def _(spark, d):
    from shoplens.functions.arrays import clean_list, parse_list_text

    plain = F.array(F.concat(F.lit("['"), "p_brand", F.lit("']")), "p_type", F.when(F.col("p_size") > 25, F.col("p_brand")))
    text = F.concat(
        F.lit("['"), "p_brand", F.lit("', '"), "p_type", F.when(F.col("p_size") > 25, F.concat(F.lit("', '"), "p_brand")).otherwise(""), F.lit("']")
    )
    values = F.when(F.col("p_size") % 2 == 0, parse_list_text(text)).otherwise(plain)
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(clean_list(values)), "|").alias("cleaned"))


TRUTH_LISTS = ["truth_category", "truth_brand", "category", "brand"]


@query(
    "flt_all_empty",
    f"""WITH {TRUTH} SELECT len(truth_category) = 0 AND len(truth_brand) = 0 AND len(category) = 0 AND len(brand) = 0 AS empty,
    o_orderkey FROM truth""",
)
def _(spark, d):
    filled, empty = cl.split_all_empty(truth_detected(spark, d), TRUTH_LISTS)
    return filled.select(F.lit(False).alias("empty"), "o_orderkey").unionByName(empty.select(F.lit(True).alias("empty"), "o_orderkey"))


@query("flt_ctr_anomaly", f"WITH {SHOWN} SELECT query, option_code, impressions, clicks FROM shown WHERE clicks > impressions")
def _(spark, d):
    rows = cl.click_anomalies(shown_products(spark, d))
    return rows.select(F.array_join("query_normalised", " ").alias("query"), "option_code", "impressions", "clicks")


@query(
    "sample_limit",
    f"""WITH {NAMED_QUERIES} SELECT query FROM named_queries WHERE length(query) <= 25
    AND ('0x' || substr(md5(query || '|sample|7'), 1, 8))::BIGINT % 1000000 < 500000 ORDER BY query LIMIT 2000""",
)
def _(spark, d):
    return cl.sample_queries(named_queries(spark, d).select("query"))


@query(
    "cat_range_bucket",
    """WITH s AS (SELECT p_type, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY p_type)
    SELECT p_partkey, CAST(coalesce(least(floor((p_retailprice - lo) / nullif((hi - lo) / 4, 0)), 3), 0) AS BIGINT) AS range_id
    FROM part JOIN s USING (p_type)""",
)
def _(spark, d):
    return flat(cl.category_ranges(table(spark, d, "part"), "p_type", "p_retailprice").select("p_partkey", "range_id"))


def interactions_table(spark, d):
    return history(spark, d).select(
        "search_term", "sku", "date",
        F.col("freq").alias("product_unique_list_view"),
        F.col("clicks").alias("product_unique_list_clicks"),
        F.col("carts").alias("unique_adds_to_cart"),
    ).filter(F.col("product_unique_list_clicks") > 0)


def positions_table(spark, d):
    return history(spark, d).filter(F.col("position") <= 4).select("search_term", "sku", "date", F.col("freq").alias("product_unique_list_view"))


MERGE_SQL = f"""{HISTORY},
i AS (SELECT search_term, sku, sum(freq) AS views, sum(clicks) AS clicks, sum(carts) AS carts FROM history WHERE clicks > 0 GROUP BY ALL),
p AS (SELECT search_term, sku, sum(freq) AS views FROM history WHERE position <= 4 GROUP BY ALL)"""


@query(
    "join_history_merge",
    f"""WITH {MERGE_SQL} SELECT search_term, sku, CAST(coalesce(i.views, 0) + coalesce(p.views, 0) AS BIGINT) AS freq,
    CAST(coalesce(clicks, 0) AS BIGINT) AS clicks FROM i FULL JOIN p USING (search_term, sku)""",
)
def _(spark, d):
    return hi.merge_history(interactions_table(spark, d), positions_table(spark, d))


SCIENCE_SQL = f"""{MERGE_SQL}, science AS (SELECT search_term, sku, CAST(coalesce(p.views, 0) AS BIGINT) AS impressions,
  CAST(coalesce(clicks, 0) AS BIGINT) AS clicks, CAST(coalesce(carts, 0) AS BIGINT) AS total_quantity
  FROM i FULL JOIN p USING (search_term, sku))"""


def science(spark, d):
    return hi.science_table(interactions_table(spark, d), positions_table(spark, d))


@query("join_ds_preprocess", f"WITH {SCIENCE_SQL} SELECT * FROM science")
def _(spark, d):
    return science(spark, d)


SCORES_SQL = f"""{SCIENCE_SQL}, rated AS (SELECT *, coalesce(clicks / nullif(impressions, 0), 0) AS ctr,
  coalesce(total_quantity / nullif(clicks, 0), 0) AS rate FROM science),
lim AS (SELECT search_term, min(ctr) AS c0, max(ctr) AS c1, min(rate) AS r0, max(rate) AS r1 FROM rated GROUP BY search_term),
scored AS (SELECT search_term, sku, round(0.5 * coalesce((ctr - c0) / nullif(c1 - c0, 0), 0)
  + 0.3 * coalesce((rate - r0) / nullif(r1 - r0, 0), 0), 6) AS score FROM rated JOIN lim USING (search_term))"""


@query("agg_relevance_score", f"WITH {SCORES_SQL} SELECT * FROM scored")
def _(spark, d):
    return flat(hi.relevance_scores(science(spark, d)).select("search_term", "sku", "score"))


@query("agg_relevance_score_nonzero", f"WITH {SCORES_SQL} SELECT * FROM scored WHERE score > 0")
def _(spark, d):
    return flat(hi.nonzero_scores(hi.relevance_scores(science(spark, d))).select("search_term", "sku", "score"))


REVENUE_SQL = f"""{SCIENCE_SQL}, {PRODUCTS}, sold AS (SELECT search_term, sku, impressions, clicks, total_quantity, total_quantity * price AS revenue FROM science JOIN products USING (sku)),
rated AS (SELECT *, coalesce(clicks / nullif(impressions, 0), 0) AS ctr, coalesce(total_quantity / nullif(clicks, 0), 0) AS rate, coalesce(revenue / nullif(clicks, 0), 0) AS revr FROM sold),
lim AS (SELECT search_term, min(ctr) AS c0, max(ctr) AS c1, min(rate) AS r0, max(rate) AS r1, min(revr) AS v0, max(revr) AS v1 FROM rated GROUP BY search_term)"""


@query(
    "agg_relevance_score_revenue",
    f"""WITH {REVENUE_SQL} SELECT search_term, sku, round(0.5 * coalesce((ctr - c0) / nullif(c1 - c0, 0), 0) + 0.3 * coalesce((rate - r0) / nullif(r1 - r0, 0), 0)
    + 0.2 * coalesce((revr - v0) / nullif(v1 - v0, 0), 0), 6) AS score FROM rated JOIN lim USING (search_term)""",
)
def _(spark, d):
    priced = science(spark, d).join(products(spark, d).select("sku", "price"), "sku")
    rows = priced.withColumn("revenue", F.col("total_quantity") * F.col("price")).drop("price")
    return flat(hi.relevance_scores(rows, ctr_weight=0.5, order_weight=0.3, revenue_weight=0.2, revenue="revenue").select("search_term", "sku", "score"))


RANGE = ("1996-01-01", "1999-06-30")
RANGE_SQL = f"day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"


@query(
    "agg_range_sum",
    f"""WITH {HISTORY} SELECT search_term, array_to_string(query_normalised, '|') AS query_normalised, sku,
    CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(freq) AS BIGINT) AS freq FROM history WHERE {RANGE_SQL} GROUP BY 1, 2, 3""",
)
def _(spark, d):
    rows = hi.range_sum(history(spark, d), "date", *[F.lit(x).cast("date") for x in RANGE], ["search_term", "query_normalised", "sku"], ["clicks", "freq"])
    return flat(rows)


@query(
    "agg_range_sum_short",
    f"""WITH {HISTORY} SELECT array_to_string(query_normalised, '|') AS query_normalised, CAST(sum(freq) AS BIGINT) AS freq
    FROM history WHERE {RANGE_SQL} AND len(query_normalised) <= 3 GROUP BY 1""",
)
def _(spark, d):
    short = history(spark, d).filter(F.size("query_normalised") <= 3)
    return flat(hi.range_sum(short, "date", *[F.lit(x).cast("date") for x in RANGE], ["query_normalised"], ["freq"]))


ROLLED_DAYS = ("1998-06-01", 9, 5)  # first day, days taken in, length of the window


@query(
    "agg_range_sum_rolling",
    f"""WITH {HISTORY} SELECT search_term, sku, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(freq) AS BIGINT) AS freq FROM history
    WHERE day BETWEEN DATE '{ROLLED_DAYS[0]}' + {ROLLED_DAYS[1] - ROLLED_DAYS[2]} AND DATE '{ROLLED_DAYS[0]}' + {ROLLED_DAYS[1] - 1} GROUP BY 1, 2""",
)
def _(spark, d):
    """The window's sums kept up day by day: each step adds the day that comes and subtracts the one that leaves."""
    start, days, length = ROLLED_DAYS
    rows = history(spark, d).select("search_term", "sku", "clicks", "freq", "date")
    dates = [(dt.date.fromisoformat(start) + dt.timedelta(days=k)).isoformat() for k in range(days)]
    rows = materialise(rows.filter(F.col("date").between(dates[0], dates[-1])), "rolled")
    window = DailySums(spark, scratch_path(spark, "window"), ["search_term", "sku"], ["clicks", "freq"], days=length)
    for date in dates:
        total = window.advance(rows.filter(F.col("date") == F.lit(date).cast("date")), date)
    return total


# the further aggregates kept over the range: result columns, SQL of the grouping columns, filter
RANGE_TABLES = {
    "agg_range_sum_queries": (["search_term", "query_normalised"], "search_term, array_to_string(query_normalised, '|') AS query_normalised", "freq", "true"),
    "agg_range_sum_impressions": (["search_term", "sku"], "search_term, sku", "freq", "true"),
    "agg_range_sum_clicks": (["search_term", "sku"], "search_term, sku", "freq", "clicks > 0"),
    "agg_range_sum_cold_cache": (["search_term"], "search_term", "freq", "true"),
}


def _range_table(name: str) -> None:
    keys, shown, total, only = RANGE_TABLES[name]
    sql = f"""WITH {HISTORY} SELECT {shown}, CAST(sum({total}) AS BIGINT) AS {total} FROM history WHERE {RANGE_SQL} AND {only} GROUP BY ALL"""

    @query(name, sql)
    def run(spark, d):
        rows = history(spark, d).filter(only)
        return flat(hi.range_sum(rows, "date", *[F.lit(x).cast("date") for x in RANGE], keys, [total]))


for _name in RANGE_TABLES:
    _range_table(_name)


@query(
    "agg_range_sum_science",
    f"""WITH {HISTORY} SELECT search_term, sku, CAST(sum(freq) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(carts) AS BIGINT) AS total_quantity
    FROM history WHERE {RANGE_SQL} GROUP BY 1, 2""",
)
def _(spark, d):
    rows = history(spark, d).withColumnsRenamed({"freq": "impressions", "carts": "total_quantity"})
    return hi.range_sum(rows, "date", *[F.lit(x).cast("date") for x in RANGE], ["search_term", "sku"], ["impressions", "clicks", "total_quantity"])


@query(
    "agg_group_queries_freq",
    f"WITH {HISTORY} SELECT search_term, CAST(sum(freq) AS BIGINT) AS freq FROM history GROUP BY search_term",
)
def _(spark, d):
    return hi.group_queries(history(spark, d))[0]


@query(
    "agg_group_queries",
    f"""WITH {HISTORY} SELECT search_term, sku, CAST(sum(freq) AS BIGINT) AS impressions FROM history GROUP BY 1, 2""",
)
def _(spark, d):
    return hi.group_queries(history(spark, d))[1]


@query(
    "agg_group_queries_clicks",
    f"""WITH {HISTORY} SELECT search_term, sku, CAST(sum(clicks) AS BIGINT) AS clicks FROM history GROUP BY 1, 2 HAVING sum(clicks) > 0""",
)
def _(spark, d):
    return hi.group_queries(history(spark, d))[2]


def affinity_sql(attribute: str, percentile: float, by_token: bool) -> str:
    key = "token" if by_token else "search_term"
    source = (
        f"(SELECT unnest(list_distinct(query_normalised)) AS token, {attribute}, clicks FROM short JOIN products USING (sku))"
        if by_token
        else "(SELECT * FROM short JOIN products USING (sku))"
    )
    return f"""WITH {HISTORY}, {PRODUCTS},
    short AS (SELECT * FROM history WHERE len(query_normalised) <= 3 AND clicks > 0),
    c AS (SELECT {key}, {attribute}, CAST(sum(clicks) AS BIGINT) AS clicks FROM {source} GROUP BY 1, 2),
    s AS (SELECT *, sum(clicks) OVER (PARTITION BY {key}) AS total, coalesce(sum(clicks) OVER (PARTITION BY {key} ORDER BY clicks DESC, {attribute}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
    SELECT {key}, {attribute}, clicks, round(clicks / total, 6) AS share FROM s WHERE before / total < {percentile}"""


@query("agg_history_affinity", affinity_sql("category", 0.9733, False))
def _(spark, d):
    return flat(hi.history_affinity(history(spark, d), products(spark, d), "category", 0.9733))


@query("agg_history_affinity_brands", affinity_sql("brandname", 0.9733, False))
def _(spark, d):
    return flat(hi.history_affinity(history(spark, d), products(spark, d), "brandname", 0.9733))


@query("agg_history_affinity_tokens", affinity_sql("category", 0.25, True))
def _(spark, d):
    return flat(hi.history_affinity(history(spark, d), products(spark, d), "category", 0.25, by_token=True))


@query(
    "agg_history_training",
    f"""WITH {HISTORY}, fresh AS (SELECT search_term, sku, sum(clicks) AS clicks FROM history WHERE day >= DATE '1998-01-01' GROUP BY 1, 2
      HAVING sum(clicks) >= 2), old AS (SELECT search_term, sku, sum(clicks) AS clicks FROM history WHERE day < DATE '1998-01-01' GROUP BY 1, 2)
    SELECT search_term AS query, sku AS product, CAST(sum(clicks) AS BIGINT) AS clicks
    FROM (SELECT * FROM fresh UNION ALL SELECT * FROM old) GROUP BY 1, 2""",
)
def _(spark, d):
    rows = history(spark, d).withColumnsRenamed({"search_term": "query", "sku": "product"})
    split = F.lit("1998-01-01").cast("date")
    old = rows.filter(F.col("date") < split).groupBy("query", "product").agg(F.sum("clicks").alias("clicks"))
    return hi.training_pairs(rows.filter(F.col("date") >= split), old)


@query(
    "agg_history_categories_topn",
    f"""WITH {HISTORY}, {PRODUCTS}, f AS (SELECT len(query_normalised) AS length, search_term, sum(freq) AS freq FROM history
      WHERE len(query_normalised) IN (2, 4) GROUP BY 1, 2),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY length ORDER BY freq DESC, search_term) AS rank FROM f) WHERE rank <= 2000),
    v AS (SELECT search_term, string_agg(DISTINCT category, '|' ORDER BY category) AS values FROM history JOIN products USING (sku) GROUP BY 1)
    SELECT length, search_term, CAST(freq AS BIGINT) AS freq, rank, values FROM top LEFT JOIN v USING (search_term)""",
)
def _(spark, d):
    return flat(hi.top_queries_by_length(history(spark, d), products(spark, d), "category", (2, 4), 2000))


@query(
    "agg_history_combine",
    f"""WITH {HISTORY} SELECT array_to_string(query_normalised, '|') AS query_normalised, sku, CAST(sum(freq) AS BIGINT) AS freq,
    CAST(sum(clicks) AS BIGINT) AS clicks FROM history WHERE len(query_normalised) <= 3 GROUP BY 1, 2""",
)
def _(spark, d):
    rows = history(spark, d).select("query_normalised", "sku", "freq", "clicks", F.year("date").alias("year"))
    spans = (F.col("year") <= 1996, F.col("year").between(1997, 1998), F.col("year") >= 1999)
    months = [rows.filter(span).drop("year") for span in spans]
    return flat(hi.combine_months(months))


@query(
    "win_history_rank",
    f"""WITH {HISTORY}, t AS (SELECT search_term AS query, sum(freq) AS freq FROM history WHERE position <= 3 GROUP BY 1),
    r AS (SELECT query, freq, rank() OVER (ORDER BY freq DESC) AS rank FROM t),
    truth AS (SELECT DISTINCT p_name || ' ' || p_brand AS query FROM part)
    SELECT query, CAST(freq AS DOUBLE) AS freq, CAST(rank AS DOUBLE) AS rank FROM truth LEFT JOIN r USING (query)""",
)
def _(spark, d):
    seen = history(spark, d).filter(F.col("position") <= 3).select(F.col("search_term").alias("query"), "freq")
    truth = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("query"))
    return hi.history_rank(truth, seen).select("query", F.col("freq").cast("double").alias("freq"), F.col("rank").cast("double").alias("rank"))
