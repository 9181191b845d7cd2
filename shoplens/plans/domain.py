"""The domain tables, derived from the given ones, and the same derivations as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.text import normal_tokens
from shoplens.operators.scale import spread

AS_OF = "2024-02-01"
SENTENCE = r"[.!?\n]+"
EVENT_TYPES = {
    "view": "product_views", "click": "add_to_cart", "signup": "orders", "purchase": "new_purchase", "error": "return",
}
VARIANT_NAMES = [
    "BRAND ACRONYM", "HINGLISH", "UK TO US", "SPELL VARIANT", "STEM VARIANT", "BRAND EXPANSION", "DEVNAGRI", "EXPANSION",
    "NUMERICAL", "SYMBOL", "SYNONYMS", "HINGLISH SYNONYMS", "SUBSTITUTE",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    names = F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair])
    product = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        "user_id",
        product.alias("product_id"),
        product.alias("product_sku_id"),
        F.try_element_at(names, F.col("event_type")).alias("interaction_type"),
        F.col("value").alias("booked_rev"),
        F.lit(1).cast("bigint").alias("interaction_count"),
        F.col("ts").alias("timestamp"),
        F.to_date("ts").alias("date"),
    )


INTERACTIONS = """interactions AS (
  SELECT user_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS product_id,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS product_sku_id,
         CASE event_type WHEN 'view' THEN 'product_views' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'orders'
              WHEN 'purchase' THEN 'new_purchase' WHEN 'error' THEN 'return' END AS interaction_type,
         value AS booked_rev, 1 AS interaction_count, ts, CAST(ts AS DATE) AS day
  FROM events)"""


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("itemid"),
        F.col("p_retailprice").alias("mrp"),
        F.col("p_brand").alias("brandname"),
        F.col("p_type").alias("l1code"),
        F.col("p_size").cast("string").alias("l2code"),
        F.col("p_name").alias("brickname"),
    )


CATALOGUE = """catalogue AS (
  SELECT p_partkey AS itemid, p_retailprice AS mrp, p_brand AS brandname, p_type AS l1code,
         CAST(p_size AS VARCHAR) AS l2code, p_name AS brickname FROM part)"""
PRICED = f"""{INTERACTIONS}, {CATALOGUE},
priced AS (SELECT * FROM interactions JOIN catalogue ON product_id = itemid)"""


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brandname"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


PRODUCTS = """products AS (
  SELECT p_partkey AS sku, p_name AS name, p_brand AS brandname, p_type AS category, p_size AS size,
         p_retailprice AS price FROM part)"""


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Searches of product names leading to products: term, sku, day, views, clicks, cart additions."""
    columns = ["l_partkey", "l_linestatus", "l_shipdate", "l_quantity", "l_returnflag", "l_linenumber"]
    rows = spread(table(spark, folder, "lineitem").select(*columns)).join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    term = F.when(F.col("l_linestatus") == "O", F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    return rows.select(
        term.alias("search_term"),
        normal_tokens(term).alias("query_normalised"),
        F.col("l_partkey").alias("sku"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("freq"),
        F.when(F.col("l_returnflag") == "N", 0).otherwise(F.col("l_linenumber")).cast("bigint").alias("clicks"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("bigint").alias("carts"),
        F.col("l_linenumber").alias("position"),
    )


def tokens_sql(text: str) -> str:
    return rf"list_filter(string_split(trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda t: t <> '')"


HISTORY = f"""history_raw AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN p_name ELSE p_name || ' ' || p_brand END AS search_term,
         l_partkey AS sku, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS freq,
         CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_linenumber END AS clicks,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS carts, l_linenumber AS position
  FROM lineitem JOIN part ON l_partkey = p_partkey),
history AS (SELECT *, {tokens_sql('search_term')} AS query_normalised FROM history_raw)"""


def searches(spark: SparkSession, folder: str) -> DataFrame:
    """Every sentence of every document as one search."""
    text = spread(table(spark, folder, "documents").select("text")).select(F.explode_outer(F.split("text", SENTENCE)).alias("search_term")).filter(F.col("search_term").isNotNull())
    return text.withColumn("total_searches", F.lit(1).cast("bigint"))


SEARCHES = r"""searches AS (
  SELECT unnest(regexp_split_to_array(text, '[.!?\n]+')) AS search_term, 1 AS total_searches FROM documents)"""


def words(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct words of all conversation texts."""
    text = spread(table(spark, folder, "conversations").select("text")).select(F.explode_outer(normal_tokens(F.col("text"))).alias("word")).filter(F.col("word").isNotNull())
    return text.distinct()


WORDS = f"words AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS word FROM conversations)"


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words of conversations with the number of texts holding them."""
    text = spread(table(spark, folder, "conversations").select("text")).select(F.explode_outer(F.array_distinct(normal_tokens(F.col("text")))).alias("word")).filter(F.col("word").isNotNull())
    return text.groupBy("word").agg(F.count(F.lit(1)).alias("products"))


WORD_COUNTS = f"""word_counts AS (
  SELECT word, count(*) AS products FROM (SELECT unnest(list_distinct({tokens_sql('text')})) AS word FROM conversations)
  GROUP BY word)"""


def turn_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as queries: query id, text tokens, freq."""
    return spread(table(spark, folder, "conversations").select("conv_id", "turn", "text")).select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query"),
        normal_tokens(F.col("text")).alias("tokens"),
        F.lit(1).cast("bigint").alias("freq"),
    )


TURN_QUERIES = f"""turn_queries AS (
  SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS query, {tokens_sql('text')} AS tokens, 1 AS freq
  FROM conversations)"""


def named_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Product names with brand as queries: query, tokens, freq (number of products)."""
    text = F.lower(F.concat_ws(" ", "p_name", "p_brand"))
    rows = table(spark, folder, "part").groupBy(text.alias("query")).agg(F.count(F.lit(1)).alias("freq"))
    return rows.withColumn("tokens", normal_tokens(F.col("query")))


def similarity_sql(a: str, b: str) -> str:
    return f"(1.0::DOUBLE - damerau_levenshtein({a}, {b}) / greatest(length({a}), length({b})))"


def sound_sql(word: str) -> str:
    return f"({word}[1] || regexp_replace({word}[2:], '[aeiouhwy]', '', 'g'))"


NAMED_QUERIES = f"""named_queries AS (
  SELECT query, freq, {tokens_sql('query')} AS tokens
  FROM (SELECT lower(p_name || ' ' || p_brand) AS query, count(*) AS freq FROM part GROUP BY 1))"""


def synonyms_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Part rows as a synonyms sheet; every fifth size leaves the keyword empty."""
    names = F.array(*map(F.lit, VARIANT_NAMES))
    return table(spark, folder, "part").select(
        F.element_at(names, (F.pmod("p_partkey", F.lit(len(VARIANT_NAMES))) + 1).cast("int")).alias("variant"),
        F.when(F.col("p_size") % 5 == 0, None).otherwise(F.concat_ws(" ", "p_name", "p_type")).alias("keyword"),
        F.concat_ws("|", "p_brand", "p_type", F.element_at(F.split("p_name", " "), 2)).alias("synonyms"),
    )


SHEET = f"""sheet AS (
  SELECT [{', '.join(repr(v) for v in VARIANT_NAMES)}][p_partkey % {len(VARIANT_NAMES)} + 1] AS variant,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name || ' ' || p_type END AS keyword,
         p_brand || '|' || p_type || '|' || string_split(p_name, ' ')[2] AS synonyms
  FROM part)"""


def truth_detected(spark: SparkSession, folder: str) -> DataFrame:
    """Per order: brands and types of returned lines as truth, of accepted lines as detected."""
    rows = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    kept = lambda flag, c: F.array_sort(F.collect_set(F.when(F.col("l_returnflag") == flag, F.col(c))))
    return rows.groupBy("o_orderkey", "o_custkey", "o_orderpriority").agg(
        kept("R", "p_type").alias("truth_category"),
        kept("R", "p_brand").alias("truth_brand"),
        kept("A", "p_type").alias("category"),
        kept("A", "p_brand").alias("brand"),
    ).withColumnsRenamed({"o_custkey": "query", "o_orderpriority": "vertical"})


def _kept_sql(flag: str, c: str) -> str:
    return f"coalesce(list_sort(list(DISTINCT {c}) FILTER (WHERE l_returnflag = '{flag}')), [])"


TRUTH = f"""truth AS (
  SELECT o_orderkey, o_custkey AS query, o_orderpriority AS vertical,
         {_kept_sql('R', 'p_type')} AS truth_category, {_kept_sql('R', 'p_brand')} AS truth_brand,
         {_kept_sql('A', 'p_type')} AS category, {_kept_sql('A', 'p_brand')} AS brand
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_custkey, o_orderpriority)"""


def search_results(spark: SparkSession, folder: str) -> DataFrame:
    """Result list per order: an order has few lines."""
    item = F.struct(F.col("l_partkey").cast("string").alias("colorGroup_string"), F.col("l_extendedprice").alias("score"))
    rows = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("products"))
    return rows.select(F.col("l_orderkey").cast("string").alias("query"), "products")


RESULTS = """results AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS query, CAST(l_partkey AS VARCHAR) AS id, l_extendedprice AS score FROM lineitem)"""


def shown_products(spark: SparkSession, folder: str) -> DataFrame:
    """Impressions and clicks of open lines, tokenised query."""
    rows = table(spark, folder, "lineitem").filter(F.col("l_linestatus") == "O")
    return rows.select(
        F.array(F.col("l_orderkey").cast("string")).alias("query_normalised"),
        F.col("l_partkey").cast("string").alias("option_code"),
        F.floor("l_quantity").alias("impressions"),
        F.col("l_linenumber").cast("bigint").alias("clicks"),
    )


SHOWN = """shown AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS query, CAST(l_partkey AS VARCHAR) AS option_code,
         CAST(floor(l_quantity) AS BIGINT) AS impressions, l_linenumber AS clicks
  FROM lineitem WHERE l_linestatus = 'O')"""


def templated_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as templated queries: three templates chosen by size."""
    p = table(spark, folder, "part")
    colour, noun = F.element_at(F.split("p_name", " "), 1), F.element_at(F.split("p_name", " "), 2)
    size = F.col("p_size").cast("string")
    pick = F.col("p_size") % 3
    lists = lambda *cs: F.array(*[F.lit(c) if isinstance(c, str) else c for c in cs])
    template = (
        F.when(pick == 0, lists("brand_string_mv", "l1_category", "l2_category"))
        .when(pick == 1, lists("brickprimarycolor_en_string_mv", "l1_category", "l2_category"))
        .otherwise(lists("brand_string_mv", "l2_category", "l3_category"))
    )
    values = (
        F.when(pick == 0, lists(F.col("p_brand"), F.col("p_type"), size))
        .when(pick == 1, lists(colour, F.col("p_type"), size))
        .otherwise(lists(F.col("p_brand"), size, noun))
    )
    return p.select(template.alias("query_template"), values.alias("query"), F.col("p_partkey").alias("product_count"))


TEMPLATED = """templated AS (
  SELECT CASE p_size % 3 WHEN 0 THEN ['brand_string_mv', 'l1_category', 'l2_category']
              WHEN 1 THEN ['brickprimarycolor_en_string_mv', 'l1_category', 'l2_category']
              ELSE ['brand_string_mv', 'l2_category', 'l3_category'] END AS query_template,
         CASE p_size % 3 WHEN 0 THEN [p_brand, p_type, CAST(p_size AS VARCHAR)]
              WHEN 1 THEN [string_split(p_name, ' ')[1], p_type, CAST(p_size AS VARCHAR)]
              ELSE [p_brand, CAST(p_size AS VARCHAR), string_split(p_name, ' ')[2]] END AS query,
         p_partkey
  FROM part)"""


def detected_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Detected lists for every templated query: sizes above 25 lose the brand, odd ones their l1."""
    t = templated_queries(spark, folder)
    p = table(spark, folder, "part").select("p_partkey", "p_size", "p_brand", "p_type", "p_name")
    rows = t.join(p, t["product_count"] == p["p_partkey"])
    none = F.array().cast("array<string>")
    has = lambda name: F.array_contains("query_template", name)
    colour, noun = F.element_at(F.split("p_name", " "), 1), F.element_at(F.split("p_name", " "), 2)
    size = F.col("p_size").cast("string")
    return rows.select(
        F.array_join("query", " ").alias("query"),
        F.when(has("l1_category") & (F.col("p_size") % 2 == 0), F.array("p_type")).otherwise(none).alias("l1_proc"),
        F.when(has("l2_category"), F.array(size)).otherwise(none).alias("l2_proc"),
        F.when(has("l3_category"), F.array(noun)).otherwise(none).alias("l3_proc"),
        F.when(has("brand_string_mv") & (F.col("p_size") <= 25), F.array("p_brand")).otherwise(none).alias("brand_proc"),
        F.when(has("brickprimarycolor_en_string_mv"), F.array(colour)).otherwise(none).alias("colour_proc"),
        F.array("p_type", "p_name").alias("all_syn"),
    ).distinct()


DETECTED = """detected AS (
  SELECT DISTINCT array_to_string(t.query, ' ') AS input_query,
         CASE WHEN p_size % 3 <> 2 AND p_size % 2 = 0 THEN [p_type] ELSE CAST([] AS VARCHAR[]) END AS l1_proc,
         [CAST(p_size AS VARCHAR)] AS l2_proc,
         CASE WHEN p_size % 3 = 2 THEN [string_split(p_name, ' ')[2]] ELSE CAST([] AS VARCHAR[]) END AS l3_proc,
         CASE WHEN p_size % 3 <> 1 AND p_size <= 25 THEN [p_brand] ELSE CAST([] AS VARCHAR[]) END AS brand_proc,
         CASE WHEN p_size % 3 = 1 THEN [string_split(p_name, ' ')[1]] ELSE CAST([] AS VARCHAR[]) END AS colour_proc,
         [p_type, p_name] AS all_syn
  FROM templated t JOIN part p ON t.p_partkey = p.p_partkey)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def name_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """First and second token of product names as wrong-to-right pairs."""
    tokens = normal_tokens(F.col("p_name"))
    return (
        table(spark, folder, "part")
        .select(F.element_at(tokens, 1).alias("wrongword"), F.element_at(tokens, 2).alias("rightword"))
        .distinct()
    )


NAME_PAIRS = """name_pairs AS (
  SELECT DISTINCT string_split(p_name, ' ')[1] AS wrongword, string_split(p_name, ' ')[2] AS rightword FROM part)"""
