"""Gaps between ids, very long URLs, an index opened with another bucket count, clashing columns in the pipeline, bounded samples."""

import time

from pyspark.sql import functions as F

from shoplens.llm import exact_dedup, language_id, preference, quality, url_filter
from shoplens.llm.queries import URL_RULES, exact_duplicates


def test_replies_pair_over_gaps(spark):
    turns = [(i, t, r, f"{i} {r}") for i in (1, 5, 6, 90, 91) for t, r in enumerate(["user", "assistant"])] + [(7, 0, "user", "open"), (92, 0, "user", "x")]
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.chosen_id, r.rejected_id) for r in preference.preference_pairs(table).filter("kind = 'reply'").collect()}
    assert got == {(1, 5), (5, 6), (6, 90), (90, 91)}


def test_url_of_a_million_letters(spark):
    urls = [(1, "http://a.org/" + "x" * 1_000_000), (2, "http://b.com/de/y"), (3, "http://c.net/" + "y" * 50), (4, "http://example.org/es/" + "q/" * 40)]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    start = time.time()
    got = {r.page_id: r for r in url_filter.filter_urls(pages, URL_RULES).collect()}
    assert time.time() - start < 90 and set(got) == {1, 2, 3, 4}
    assert len(got[1].path) == 1_000_001 and got[1].verdict == "allow" and got[2].verdict == "block"


def test_index_keeps_its_buckets(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id bigint, text string")
    exact_dedup.deduplicate(rows, exact_dedup.DigestIndex(str(tmp_path / "index"), 8), "one").collect()
    spark.sql(f"DROP TABLE {exact_dedup.DigestIndex(str(tmp_path / 'index'), 8).name}")
    again = exact_dedup.DigestIndex(str(tmp_path / "index"), 3)
    found = exact_dedup.deduplicate(rows.withColumn("doc_id", F.col("doc_id") + 1000), again, "two").collect()
    assert again.kept(spark) == 8 and not any(r.kept for r in found) and {r.keep_id for r in found} == set(range(200))


def test_second_batch_meets_the_first(spark, tmp_path):
    rows = [(1, "a"), (9, "a"), (2, "b"), (8, "b"), (3, None), (7, ""), (None, "a"), (6, "c"), (4, "d  e"), (5, "d e")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(spark, str(tmp_path)).collect()}
    assert got == {(1, 1, 3, True), (9, 1, 3, False), (None, 1, 3, False), (2, 2, 2, True), (8, 2, 2, False), (3, 3, 2, True), (7, 3, 2, False), (6, 6, 1, True), (4, 4, 2, True), (5, 4, 2, False)}


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline

    words = [" ".join(f"{k}{i}" for i in range(30)) for k in "abcd"]
    spark.createDataFrame([(1, words[3])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kinds = "doc_id bigint, text string, row_digest string, _row string, kept_id string, kept_digest string, own_id string, component_id string, lettered_0 string"
    rows = [(i, t, "a", "b", "c", "d", "e", "f", "g") for i, t in enumerate([words[0], words[0], words[1], words[1] + " end", words[3], words[2]])]
    docs = spark.createDataFrame(rows, kinds)
    for stage, kept in ((corpus_pipeline.drop_copies, {0, 2, 3, 4, 5}), (corpus_pipeline.drop_near_copies, {0, 2, 4, 5}), (corpus_pipeline.drop_benchmark_leaks, {0, 1, 2, 3, 5})):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.collect()} == {rows[i] for i in kept}
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_samples_are_bounded(spark, monkeypatch):
    """A third of the rows on one id, and rows without ids."""
    monkeypatch.setattr(quality, "LABELLED", 20)
    monkeypatch.setattr(language_id, "PER_LANGUAGE", 20)
    rows = [(1 if i % 3 == 0 else None if i % 3 == 1 else i, f"text number {i} of many", ["en", "de"][i % 2]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(1, 1.0), (2, 0.0), (5, 1.0)], "doc_id bigint, label double")
    assert len(quality.fit(docs, labels).labels) == 20
    sizes = []
    monkeypatch.setattr(language_id, "materialise", lambda df, name: sizes.append(name) or df)
    model = language_id.fit(docs)
    assert model.languages == ["de", "en"] and sizes == ["language-draws"]
    assert quality.fit(docs, labels.limit(0)).labels.size == 0
