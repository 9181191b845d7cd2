"""Vector, nearest-neighbour and recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.functions.arrays import cosine
from shoplens.operators import features as fe
from shoplens.operators import recommend as re
from shoplens.operators.quality import min_max_scale
from shoplens.operators.scale import materialise
from shoplens.plans.domain import AS_OF, catalogue, interactions, table, vectors
from shoplens.operators.scale import scratch_path
from shoplens.plans.registry import flat, query
from shoplens.sources.incremental import VectorCache
from shoplens.plans.user_features import FEATURE_NAMES, FEATURES_SQL, user_features


@query(
    "ml_cosine_pair",
    """SELECT a.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine
    FROM embeddings a JOIN embeddings b ON a.vec_id + 2 = b.vec_id""",
)
def _(spark, d):
    rows = vectors(spark, d)
    ahead = rows.select((F.col("id") - 2).alias("id"), F.col("vec").alias("other"))
    return flat(rows.join(ahead, "id").select("id", cosine(F.col("vec"), F.col("other")).alias("cosine")))


@query("ml_assemble", "SELECT c_custkey, 1 AS n, c_acctbal AS first FROM customer")
def _(spark, d):
    rows = re.assemble(table(spark, d, "customer"))
    return flat(rows.select("c_custkey", F.size("features").alias("n"), F.element_at("features", 1).alias("first")))


def affinity(spark, d):
    return fe.affinity_scores(interactions(spark, d), catalogue(spark, d), F.lit(AS_OF).cast("date"))


@query("arr_explode_affinity", f"WITH {FEATURES_SQL} SELECT user_id, brandname, affinity_score AS score FROM affinity")
def _(spark, d):
    pair = F.struct(F.col("brandname").alias("attribute"), "affinity_score")
    lists = affinity(spark, d).groupBy("user_id").agg(F.collect_list(pair).alias("attribute_affinity_brandname"))
    return flat(re.explode_affinity(lists))


KNN_SQL = """pairs AS (SELECT a.vec_id AS probe, b.vec_id AS base, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS cosine
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY cosine DESC, base) AS rank FROM pairs)"""


@query("join_knn_cosine", f"WITH {KNN_SQL} SELECT probe, base, round(cosine, 6) AS cosine, rank FROM ranked WHERE rank <= 3")
def _(spark, d):
    return flat(re.nearest_neighbours(vectors(spark, d), k=3))


@query("ml_neighbour_words", f"WITH {KNN_SQL} SELECT 'w' || probe AS word, 'w' || base AS similar, round(cosine, 6) AS similarity FROM ranked WHERE rank = 1")
def _(spark, d):
    near = re.nearest_neighbours(vectors(spark, d), k=1)
    name = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    return flat(near.select(name("probe").alias("word"), name("base").alias("similar"), F.col("cosine").alias("similarity")))


@query(
    "topk_similar",
    """SELECT b.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine_sim
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id = 0 ORDER BY
    list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id LIMIT 10""",
)
def _(spark, d):
    rows = vectors(spark, d)
    return flat(re.similar_to_one(rows, rows.filter("id = 0"), 10, "id", "vec").select("id", "cosine_sim"))


@query("ml_vector_cache", "SELECT CAST(label AS BIGINT) AS query, max(vec_id) AS ts, round(arg_max(embedding, vec_id)[1]::DOUBLE, 6) AS first FROM embeddings GROUP BY 1")
def _(spark, d):
    rows = vectors(spark, d).select(F.col("label").alias("query"), F.col("id").alias("ts"), "vec")
    return flat(re.latest_vectors(rows).select("query", "ts", F.element_at("vec", 1).alias("first")))


@query(
    "ml_vector_cache_days",
    """WITH r AS (SELECT 'q' || (vec_id // 3) AS query, vec_id AS ts, embedding, vec_id % 3 AS day FROM embeddings WHERE vec_id % 7 <> 3 OR vec_id % 3 = 2)
    SELECT query, max(ts) AS ts, round(arg_max(embedding, ts)[1]::DOUBLE, 6) AS first FROM r GROUP BY 1""",
)
def _(spark, d):
    """Three days taken into the kept cache: new queries by anti-join, newer vectors by upsert, and a fold of the two tables."""
    v = vectors(spark, d).select(F.concat(F.lit("q"), F.floor(F.col("id") / 3).cast("string")).alias("query"), F.col("id").alias("ts"), "vec")
    cache = VectorCache(spark, scratch_path(spark, "vector-cache"), buckets=8, share=0.5)
    seen = v.filter("ts % 7 != 3 OR ts % 3 = 2")
    cache.upsert(seen.filter("ts % 3 = 0"))
    second = seen.filter("ts % 3 = 1")
    cache.upsert(cache.unseen(second))
    cache.upsert(second)
    cache.upsert(seen.filter("ts % 3 = 2"))
    return flat(cache.read().select("query", "ts", F.element_at("vec", 1).alias("first")))


def scaled_rows(spark, d):
    """user x brand rows without nulls, features scaled to [0, 1] and assembled."""
    rows = user_features(spark, d).select("user_id", *[F.col(c).cast("double").alias(c) for c in FEATURE_NAMES])
    joined = rows.join(affinity(spark, d).withColumnRenamed("affinity_score", "score"), "user_id").na.drop()
    # the extremes and the scaling both read the joined rows: write them once
    return re.assemble(min_max_scale(materialise(joined, "features")), FEATURE_NAMES)


NOT_NULL = " AND ".join(f'"{c}" IS NOT NULL' for c in FEATURE_NAMES)
SCALED_SQL = f"""{FEATURES_SQL},
lists AS (SELECT DISTINCT f.user_id, """ + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FEATURE_NAMES) + f""" FROM features f JOIN affinity USING (user_id) WHERE {NOT_NULL}),
spans AS (SELECT """ + ", ".join(f'min("{c}") AS "lo_{c}", max("{c}") AS "hi_{c}"' for c in FEATURE_NAMES) + """ FROM lists),
scaled AS (SELECT user_id, [""" + ", ".join(f'coalesce(("{c}" - "lo_{c}") / nullif("hi_{c}" - "lo_{c}", 0), 0)' for c in FEATURE_NAMES) + """] AS v FROM lists, spans),
rows_ AS (SELECT user_id, brandname, affinity_score AS score, v FROM affinity JOIN scaled USING (user_id))"""


@query(
    "ml_brand_score",
    f"""WITH {SCALED_SQL}, me AS (SELECT * FROM scaled WHERE user_id = (SELECT min(user_id) FROM scaled)),
    near AS (SELECT r.user_id FROM rows_ r, me WHERE r.user_id <> me.user_id ORDER BY round(list_cosine_similarity(r.v, me.v), 9) DESC, r.user_id LIMIT 25)
    SELECT me.user_id, b.brandname, round(coalesce((SELECT min(score) FROM rows_ r WHERE r.user_id = me.user_id AND r.brandname = b.brandname),
      (SELECT avg(score) FROM rows_ r WHERE r.brandname = b.brandname AND r.user_id IN (SELECT user_id FROM near)), 0), 6) AS predicted
    FROM me, (SELECT 'Brand#1' AS brandname) b""",
)
def _(spark, d):
    rows = scaled_rows(spark, d)
    user = rows.agg(F.min("user_id")).first()[0]
    return flat(re.brand_score(rows, user, "Brand#1", 25))


@query(
    "ml_attribute_recommend",
    f"""WITH {SCALED_SQL}, p AS (SELECT a.user_id AS target, b.user_id, round(list_cosine_similarity(a.v, b.v), 12) AS c FROM scaled a JOIN scaled b ON a.user_id <> b.user_id),
    near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY c DESC, user_id) AS k FROM p) WHERE k <= 10),
    m AS (SELECT target AS user_id, brandname, round(avg(score), 6) AS predicted FROM near JOIN rows_ USING (user_id) GROUP BY 1, 2),
    fresh AS (SELECT m.* FROM m ANTI JOIN (SELECT user_id, brandname FROM rows_) r USING (user_id, brandname))
    SELECT user_id, brandname, predicted, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted DESC, brandname) AS rank FROM fresh) WHERE rank <= 10""",
)
def _(spark, d):
    rows = scaled_rows(spark, d)
    users = rows.groupBy("user_id").agg(F.any_value("features").alias("features"))
    return flat(re.recommend_attributes(rows, users))


@query("ml_als")
def _(spark, d):
    ratings = re.als_ratings(affinity(spark, d).withColumnRenamed("affinity_score", "score"))
    return flat(re.als_predictions(ratings, ratings.select("user_id", "brandname", "user", "item")))


@query(
    "ml_als_solved",
    f"""WITH {FEATURES_SQL} SELECT user_id, count(*) AS ratings, true AS solved FROM affinity GROUP BY user_id""",
)
def _(spark, d):
    """Whether each user's factors solve their least squares against the items."""
    ratings = re.als_ratings(affinity(spark, d).withColumnRenamed("affinity_score", "score"))
    users = ratings.select("user", "user_id").distinct()
    found = re.als_residuals(ratings).join(users, "user")
    return found.select("user_id", "ratings", (F.col("residual") < 1e-3).alias("solved"))
