"""Named queries of the text operators over the given tables, with SQL where SQL gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import collocations, decontamination, exact_dedup, language_id, lm_hmm, ngram_jaccard, preference, quality, sentencepiece_trie, structure_repair, substring_dedup, toxicity, url_filter
from shoplens.llm.columns import fold, table, with_heavy_keys
from shoplens.operators.scale import materialise, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@query("op1_quality")
def quality_scores(spark, folder):
    """Learns from four of five folds of the labelled documents, scores all."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, labels.filter(~held).select("doc_id", F.col("quality").alias("label")))
    found = quality.classify(docs, model)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op2_substring_dedup")
def repeated_windows(spark, folder):
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


@query("op3_language_id")
def languages(spark, folder):
    """Learns from three of four folds, predicts for all rows."""
    docs = table(spark, folder, "documents")
    held = fold(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.filter(~held).select("doc_id", "text", "lang"))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held.alias("held_out"), F.col("lang").alias("lang_pred"), "score", "rejected")


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query("op4_sentencepiece")
def piece_ids(spark, folder, model=PIECE_MODEL):
    """Ids of every text, and whether decoding them gives the text back."""
    docs = table(spark, folder, "documents")
    return sentencepiece_trie.round_trip(docs, model)


@query("op5_lm_score")
def text_likelihoods(spark, folder):
    """Learns from six of seven folds, scores all rows."""
    return lm_hmm.score_texts(table(spark, folder, "documents"), fold(F.col("doc_id"), 7) == 2)


@query("op6_preference_format")
def preference_format(spark, folder):
    return preference.format_pairs(preference.preference_pairs(table(spark, folder, "conversations")))


@query("op7_url_filter")
def judged_urls(spark, folder):
    return url_filter.filter_urls(table(spark, folder, "pages"), URL_RULES)


@query(
    "op8_exact_dedup",
    """
    WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def exact_duplicates(spark, folder):
    """The documents come in two batches, the lower half of the ids first: the second meets what the index holds of the first."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = exact_dedup.DigestIndex(scratch_path(spark, "digest-index"), buckets)
    docs = table(spark, folder, "documents")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    early = F.coalesce(F.col("doc_id") <= F.lit(middle).cast("long"), F.lit(False))
    parts = [exact_dedup.deduplicate(docs.filter(part), index, uuid.uuid4().hex) for part in (early, ~early)]
    rows = materialise(parts[0].unionByName(parts[1]).drop("group_size"), "decided")
    sizes = rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"))
    found = with_heavy_keys(rows, sizes, ["text_sha256"], "group_size", rows.count())
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op9_ngram_jaccard")
def near_duplicate_components(spark, folder):
    return ngram_jaccard.near_duplicates(table(spark, folder, "documents"))


@query("op10_decontamination")
def benchmark_leaks(spark, folder):
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_toxicity")
def toxicity_scores(spark, folder):
    """Learns from four of five folds of the labelled documents, scores all."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.filter(~held).select("doc_id", F.col("toxic").alias("label")))
    found = toxicity.classify(docs, model)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op12_structure_repair")
def repaired_conversations(spark, folder):
    """Damages the conversations by the digests of their turns and repairs them."""
    turns = table(spark, folder, "conversations")
    return structure_repair.repair_report(structure_repair.damage(turns), turns)


@query(
    "op13_collocations",
    """
    WITH p AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
      FROM documents
    ),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
    n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
    g AS (SELECT lang, unnest(flatten([[array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)] FOR k IN range(1, 6)])) AS phrase FROM w),
    f AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 100),
    c AS (SELECT lang, phrase, ws, f AS a, unnest(range(1, len(ws))) AS k FROM f WHERE len(ws) > 1),
    s AS (
      SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM c JOIN n ON n.lang = c.lang
      JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.k], ' ')
      JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1:], ' ')
    ),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    kept AS (
      SELECT * FROM b WHERE NOT EXISTS (
        SELECT 1 FROM f WHERE f.lang = b.lang AND len(f.phrase) > len(b.phrase) AND 100 * f.f >= 100 * b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' '))
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000
    """,
)
def phrase_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))
