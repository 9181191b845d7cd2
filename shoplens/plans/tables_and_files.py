"""Sources, sinks, JSON text and table-combination queries.

Queries that write use the session's shared folder and read the written table back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators import jsonschema as js
from shoplens.operators import tables as ta
from shoplens.operators import vocabulary as vo
from shoplens.operators.scale import materialise, scratch_path, spread
from shoplens.plans.domain import HISTORY, NAME_PAIRS, NAMED_QUERIES, PRODUCTS, history, name_pairs, named_queries, products, table
from shoplens.plans.registry import flat, query
from shoplens.sources import incremental as inc
from shoplens.sources import readers as rd
from shoplens.sources import writers as wr

PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


@query("src_parquet", PART_SQL)
def _(spark, d):
    return rd.read_parquet(spark, f"{d}/part.parquet")


@query("sink_parquet", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, d):
    path = scratch_path(spark, "sink")
    wr.write_parquet(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, partition_by=["o_orderstatus"])
    return rd.read_parquet(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("src_csv", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def _(spark, d):
    path = scratch_path(spark, "csv")
    wr.write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), path)
    return rd.read_csv(spark, path)


@query("sink_csv", "SELECT query, freq FROM (SELECT lower(p_name || ' ' || p_brand) AS query, count(*) AS freq FROM part GROUP BY 1)")
def _(spark, d):
    path = scratch_path(spark, "csv")
    wr.write_csv(named_queries(spark, d).select("query", "freq"), path)
    return rd.read_csv(spark, path, "query string, freq bigint")


@query("sink_named_csv", "SELECT DISTINCT lower(p_brand) AS phrase, p_type AS phrase_key, '1' AS is_acronym FROM part")
def _(spark, d):
    folder, other = scratch_path(spark, "named"), scratch_path(spark, "copy")
    rows = table(spark, d, "part").select(F.lower("p_brand").alias("phrase"), F.col("p_type").alias("phrase_key"), F.lit("1").alias("is_acronym")).distinct()
    wr.write_named_csv(rows, folder, "BrandAcronyms.csv", other)
    return rd.read_csv(spark, f"{other}/BrandAcronyms.csv")


HISTORY_SCHEMA = T.StructType([T.StructField("search_term", T.StringType()), T.StructField("freq", T.LongType()), T.StructField("clicks", T.LongType())])


def raw_csv(spark, d, path, bad):
    """History as raw CSV lines where every odd position puts text into a number column."""
    term, number = F.col("search_term"), F.when(bad, F.lit("n/a")).otherwise(F.col("freq").cast("string"))
    wr.write_csv(history(spark, d).select(term, number.alias("freq"), "clicks"), path)


@query("src_history_csv", f"WITH {HISTORY} SELECT search_term, freq, clicks FROM history WHERE position <> 7")
def _(spark, d):
    path = scratch_path(spark, "raw")
    raw_csv(spark, d, path, F.col("position") == 7)
    return rd.history_csv(spark, path, HISTORY_SCHEMA, "search_term", scratch_path(spark, "history"))[0]


@query("src_history_csv_bad", f"WITH {HISTORY} SELECT search_term || ',n/a,' || clicks AS _corrupt_record FROM history WHERE position = 7")
def _(spark, d):
    path = scratch_path(spark, "raw")
    raw_csv(spark, d, path, F.col("position") == 7)
    return rd.parse_typed_csv(spark, path, HISTORY_SCHEMA)[1]


@query("src_zsr_csv", f"WITH {HISTORY} SELECT search_term, CAST(sum(freq) AS BIGINT) AS freq FROM history WHERE clicks = 0 GROUP BY 1")
def _(spark, d):
    path, target = scratch_path(spark, "raw"), scratch_path(spark, "zsr")
    wr.write_csv(history(spark, d).filter("clicks = 0").select("search_term", "freq"), path)
    good, _ = rd.history_csv(spark, path, T.StructType(HISTORY_SCHEMA.fields[:2]), "search_term", target)
    return good.groupBy("search_term").agg(F.sum("freq").alias("freq"))


@query("src_parquet_truth", "SELECT p_partkey, p_brand || '|' || p_type AS brands FROM part")
def _(spark, d):
    path, target = scratch_path(spark, "truth"), scratch_path(spark, "truth")
    text = F.concat(F.lit("['"), "p_brand", F.lit("', '"), "p_type", F.lit("', '"), "p_brand", F.lit("']"))
    wr.write_csv(table(spark, d, "part").select("p_partkey", text.alias("brands")), path)
    rows = rd.truth_csv(spark, path, ["brands"], target)
    return flat(rows.withColumn("p_partkey", F.col("p_partkey").cast("bigint")))


ROUTE_SQL = """f AS (SELECT '/landing/' || CASE event_type WHEN 'view' THEN 'PID_ZSR_' WHEN 'click' THEN 'QUERY_POSITION_' WHEN 'purchase' THEN 'PID_'
  WHEN 'error' THEN 'FREQUENCY_' ELSE 'zsr_' END || event_id || '.csv' AS path, ts FROM events)"""


def landing_mark():
    """Beginning of the file name an event lands under."""
    kinds = {"view": "PID_ZSR_", "click": "QUERY_POSITION_", "purchase": "PID_", "error": "FREQUENCY_"}
    return reduce(lambda c, kv: c.when(F.col("event_type") == kv[0], kv[1]), kinds.items(), F.when(F.lit(False), "")).otherwise("zsr_")


@query(
    "src_landing_route",
    f"""WITH {ROUTE_SQL} SELECT path, CASE WHEN contains(path, 'ZSR') THEN 'zsr' WHEN contains(path, 'POSITION') THEN 'query_position'
    WHEN contains(path, 'PID') THEN 'query_product_interactions' WHEN contains(path, 'FREQUENCY') THEN 'query_level' ELSE 'other' END AS type
    FROM f WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
)
def _(spark, d):
    path = F.concat(F.lit("/landing/"), landing_mark(), F.col("event_id").cast("string"), F.lit(".csv"))
    files = table(spark, d, "events").select(path.alias("path"), F.col("ts").alias("modificationTime"))
    return rd.route_landing(files, F.lit("2024-01-15").cast("date")).select("path", "type")


@query(
    "sink_cumulative_archive",
    f"""WITH {HISTORY} SELECT search_term AS query, CAST(sum(freq) AS BIGINT) AS freq FROM history GROUP BY 1""",
)
def _(spark, d):
    base = scratch_path(spark, "archive")
    rows = history(spark, d).select(F.col("search_term").alias("query"), "freq", "date")
    edge = F.lit("1998-01-01").cast("date")
    # the second day comes three times, first in part: each run takes the place of the one before
    for day, part in (
        ("1998-01-01", F.col("date") < edge), ("1998-01-02", F.col("date") > edge), ("1998-01-02", F.col("date") >= edge), ("1998-01-02", F.col("date") >= edge),
    ):
        total = inc.save_with_archive(rows.filter(part), base, day, ["query"], ["freq"])
    return total.select("query", "freq")


ROUTED_SQL = f"""{ROUTE_SQL}, n AS (SELECT path[10:] AS file FROM f WHERE CAST(ts AS DATE) = DATE '2024-01-15')
    SELECT CASE WHEN contains(file, 'ZSR') THEN 'zsr' WHEN contains(file, 'POSITION') THEN 'query_position' WHEN contains(file, 'PID') THEN 'query_product_interactions'
    WHEN contains(file, 'FREQUENCY') THEN 'query_level' ELSE 'other' END AS type, count(*) AS files, 2 * count(*) AS lines, 0::BIGINT AS moved_again FROM n GROUP BY 1"""


@query("src_landing_files", f"WITH {ROUTED_SQL}")
def _(spark, d):
    """The events of a day land as one folder each, are routed by type and date, and routed again, which moves nothing."""
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "routed")
    e = table(spark, d, "events").filter(F.to_date("ts") == F.lit("2024-01-15").cast("date"))
    lines = F.explode(F.array(F.lit("event_id,value"), F.concat_ws(",", F.col("event_id").cast("string"), F.col("value").cast("string"))))
    landed = e.select(F.concat(landing_mark(), F.col("event_id").cast("string"), F.lit(".csv")).alias("name"), lines.alias("value"))
    wr.write_text_folders(spread(landed, "name"), landing, ["name"])
    name = F.regexp_extract("path", "/name=([^/]+)/", 1)
    today = spark.sql("SELECT CAST(current_date() AS STRING) AS d").first()["d"]
    inc.route_landing_files(spark, landing, target, today, name)
    again = inc.route_landing_files(spark, landing, target, today, name).count()
    with rd.many_small_files(spark):
        data = f"{target}/data"
        found = rd.text_lines(spark, data, rd.binary_files(spark, data)).select(*[rd.folder_value(F.col("url"), c).alias(c) for c in ("type", "file")])
        sums = materialise(found.groupBy("type").agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("lines")), "routed-sums")
    return sums.withColumn("moved_again", F.lit(again).cast("long"))


@query(
    "sink_corpus_json",
    """SELECT p_name AS key, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS values, 'r2cats' AS lookup FROM part GROUP BY 1
    UNION ALL SELECT string_split(p_name, ' ')[1], string_agg(DISTINCT string_split(p_name, ' ')[2], '|' ORDER BY string_split(p_name, ' ')[2]), 'w2r' FROM part GROUP BY 1""",
)
def _(spark, d):
    folder = scratch_path(spark, "corpus")
    tables = {"r2cats": (products(spark, d), "name", "category"), "w2r": (name_pairs(spark, d), "wrongword", "rightword")}
    wr.write_corpus_json(tables, folder, size=3)
    schema = "key string, segment int, values array<string>"
    parts = [wr.whole_lists(spark.read.schema(schema).json(f"{folder}/{n}")).withColumn("lookup", F.lit(n)) for n in tables]
    return flat(parts[0].unionByName(parts[1]))


def json_text(spark, d):
    """Events as JSON text: ``v`` is a number for some types and text for others, ``n`` nests."""
    e = table(spark, d, "events")
    value = F.when(F.col("event_type") == "view", F.floor("value").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    text = F.concat(
        F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "v": '), value, F.lit(', "n": {"u": '), F.col("user_id").cast("string"),
        F.lit(', "x": ['), F.col("value").cast("string"), F.lit(", 1]}}"),
    )
    return e.select("event_id", F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(text).alias("json"))


def schema_rows(spark, d, mode):
    """The inferred schema as one row per field, beside the number of rows it was inferred from."""
    rows = json_text(spark, d)
    schema = js.infer_schema(rows, "json", mode)
    fields = F.array(*[F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type")) for f in schema.fields])
    total = rows.agg(F.count(F.lit(1)).alias("rows"))
    return total.select("rows", F.explode(fields).alias("f")).select("rows", "f.field", "f.type")


INFERRED = "SELECT rows, field, type FROM (SELECT count(*) AS rows FROM events), (VALUES ('k', '{k}'), ('v', '{v}'), ('n', '{n}')) t(field, type)"


@query("json_schema_infer", INFERRED.format(k="int", v="int", n="struct<u:int,x:array<double>>"))
def _(spark, d):
    return schema_rows(spark, d, "precedence")


@query("json_type_merge", INFERRED.format(k="bigint", v="string", n="struct<u:bigint,x:array<double>>"))
def _(spark, d):
    return schema_rows(spark, d, "spark")


@query(
    "json_parse",
    """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, user_id AS u,
    CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) ELSE -1 END AS v, round(value + 1, 6) AS x FROM events WHERE event_type <> 'error'""",
)
def _(spark, d):
    parsed = js.parse_json(json_text(spark, d), "json").filter("json.k IS NOT NULL")
    total = F.aggregate("json.n.x", F.lit(0.0), lambda a, b: a + b)
    return flat(parsed.select("event_id", F.col("json.k").alias("k"), F.col("json.n.u").alias("u"), F.coalesce("json.v", F.lit(-1)).alias("v"), total.alias("x")))


COMMON_SQL = """a AS (SELECT p_name AS token, max(p_size) AS size, max(p_brand) AS brand FROM part WHERE p_size > 20 GROUP BY 1),
b AS (SELECT p_name AS token, max(p_size) AS size, max(p_type) AS kind, max(p_brand) AS brand FROM part GROUP BY 1)"""


def common_tables(spark, d):
    p = table(spark, d, "part").withColumnRenamed("p_name", "token")
    a = p.filter("p_size > 20").groupBy("token").agg(F.max("p_size").alias("size"), F.max("p_brand").alias("brand"))
    b = p.groupBy("token").agg(F.max("p_size").alias("size"), F.max("p_type").alias("kind"), F.max("p_brand").alias("brand"))
    return a, b


@query(
    "set_union_common_cols",
    f"WITH {COMMON_SQL} SELECT b.token, CAST(coalesce(a.size, b.size) AS BIGINT) AS size, coalesce(a.brand, b.brand) AS brand FROM b LEFT JOIN a USING (token)",
)
def _(spark, d):
    return flat(ta.union_common_columns(common_tables(spark, d), ["token"]))


@query(
    "set_union_reference_cols",
    f"""WITH {COMMON_SQL} SELECT b.token, CAST(coalesce(a.size, b.size) AS BIGINT) AS size, kind, coalesce(a.brand, b.brand) AS brand FROM b LEFT JOIN a USING (token)""",
)
def _(spark, d):
    a, b = common_tables(spark, d)
    return flat(ta.union_common_columns([a, b], ["token"], "reference", b))


@query(
    "set_merge_phrase_keys",
    """SELECT p_name AS phrase_key, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS categories, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS brands,
    max(p_size) AS size FROM part GROUP BY 1""",
)
def _(spark, d):
    p = table(spark, d, "part").select(F.col("p_name").alias("phrase_key"), F.array("p_type").alias("categories"), F.array("p_brand").alias("brands"), F.col("p_size").alias("size"))
    return flat(ta.merge_phrase_keys(p, ["categories", "brands"], ["size"]))


PROPERTY_SQL = f"""{PRODUCTS}, tok AS (SELECT DISTINCT name AS token FROM products WHERE size > 30),
cats AS (SELECT name AS token, string_agg(DISTINCT category, '|' ORDER BY category) AS categories FROM products WHERE size > 10 GROUP BY 1),
ents AS (SELECT brandname AS token, string_agg(DISTINCT category, '|' ORDER BY category) AS entities FROM products GROUP BY 1)"""


def properties(spark, d):
    p = products(spark, d)
    cats = p.filter("size > 10").groupBy(F.col("name").alias("token")).agg(F.array_sort(F.collect_set("category")).alias("categories"))
    ents = p.groupBy(F.col("brandname").alias("token")).agg(F.array_sort(F.collect_set("category")).alias("entities"))
    tokens = p.filter("size > 30").select(F.col("name").alias("token"))
    return ta.combine_properties(tokens, {"categories": cats, "entities": ents})


@query(
    "set_combine_properties",
    f"WITH {PROPERTY_SQL} SELECT token, coalesce(categories, '') AS categories, coalesce(entities, '') AS entities FROM tok LEFT JOIN cats USING (token) LEFT JOIN ents USING (token)",
)
def _(spark, d):
    return flat(properties(spark, d)[0])


@query("set_combine_properties_extra", f"WITH {PROPERTY_SQL} SELECT token FROM (SELECT token FROM cats UNION SELECT token FROM ents) ANTI JOIN tok USING (token)")
def _(spark, d):
    return properties(spark, d)[1]


@query(
    "set_combine_variants",
    f"""WITH {NAME_PAIRS}, p AS (SELECT string_split(p_name, ' ')[2] AS rightword, max(p_brand) AS brand FROM part GROUP BY 1),
    x AS (SELECT DISTINCT p_brand AS rightword, p_type AS brand FROM part)
    SELECT wrongword, rightword, brand FROM name_pairs JOIN p USING (rightword) UNION ALL SELECT NULL, rightword, brand FROM x""",
)
def _(spark, d):
    p = table(spark, d, "part")
    props = p.groupBy(F.element_at(F.split("p_name", " "), 2).alias("token")).agg(F.max("p_brand").alias("brand"))
    extras = p.select(F.col("p_brand").alias("rightword"), F.col("p_type").alias("brand")).distinct()
    return ta.combine_variants(name_pairs(spark, d), props, extras).select("wrongword", "rightword", "brand")


@query("voc_unify_verticals", f"WITH {NAMED_QUERIES} SELECT query, freq, 'first' AS vertical FROM named_queries UNION ALL SELECT p_name, count(*), 'second' FROM part GROUP BY 1")
def _(spark, d):
    second = table(spark, d, "part").groupBy(F.col("p_name").alias("query")).agg(F.count(F.lit(1)).alias("freq"))
    return vo.unify_verticals({"first": named_queries(spark, d).select("query", "freq"), "second": second})
