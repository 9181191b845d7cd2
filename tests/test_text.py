"""Query cleaning, lists, JSON schema and landing rules on hand-written rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.text import unescape_html
from shoplens.operators import vocabulary
from shoplens.functions import arrays as ar
from shoplens.functions import text as tx
from shoplens.operators import cleaning as cl
from shoplens.operators import guardrails as gr
from shoplens.operators import jsonschema as js
from shoplens.operators import quality as qu
from shoplens.sources import readers as rd
from shoplens.sources import writers as wr


def one(spark, column, **kw):
    return spark.range(1).select(column(**kw).alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [
        ("a &amp; b", "a & b"), ("&lt;p&gt;", "<p>"), ("it&#39;s", "it's"), ("&#x20AC;5", "€5"), ("&amp;lt;", "&lt;"),
        ("&unknown; &amp", "&unknown; &amp"), ("caf&eacute;", "café"), ("&#128512;", "😀"), ("x & y", "x & y"), ("", ""),
    ],
)
def test_unescape(spark, text, want):
    assert one(spark, lambda: tx.unescape_html(F.lit(text))) == want


def test_cleaning_chain(spark):
    rows = [
        ("  Red   Shoes ", 2), ("red shoes", 3), ("aaa b", 1), ("aaaa b", 1), ("“quoted”", 1), ("!!", 1), ("12.5", 1), ("12 13", 1),
        ("x" + " y" * 49 + " ", 1), ("ab" * 50, 1), ("ab" * 50 + "c", 1), ("1 2 3 4 5 6 7 h", 1), ("1 2 3 4 5 6 7 8 i", 1), (None, 1),
    ]
    df = spark.createDataFrame(rows, "search_term string, total_searches bigint")
    got = {r.query: r.freq for r in cl.clean_queries(df).collect()}
    assert got == {"red shoes": 5, "aaa b": 1, '"quoted"': 1, "ab" * 50: 1, "1 2 3 4 5 6 7 h": 1}
    top = cl.top_queries(spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "query string, freq bigint"), 2).collect()
    assert [r.query for r in top] == ["c", "a"]


def test_accented_letters_and_edges_count_as_pieces(spark):
    # seven words of accented letters are nine pieces, two of them empty; a leading sign adds one
    rows = [("été " * 7, 1), ("!a b c d e f g h", 1)]
    assert cl.clean_queries(spark.createDataFrame(rows, "search_term string, total_searches bigint")).count() == 0


def test_lists(spark):
    df = spark.createDataFrame([(["['a']", "b", "b", None],), ([],), (None,)], "v array<string>")
    assert [sorted(r.v) for r in cl.clean_lists(df, ["v"]).collect()] == [["a", "b"], [], []]
    assert one(spark, lambda: ar.parse_list_text(F.lit("['a', 'b']"))) == ["a", "b"]


SETS = "query string, vertical string, tc array<string>, dc array<string>, tb array<string>, db array<string>"
SET_ROWS = [
    ("q1", "v1", ["a", "b"], ["b", "c"], ["nike"], ["Nike"]),
    ("q1", "v2", ["a"], [], ["nike"], []),
    ("q2", "v1", [], ["a"], [], ["Puma"]),
    ("q2", "v2", None, None, None, None),
]


def test_set_comparison(spark):
    df = spark.createDataFrame(SET_ROWS, SETS)
    wide = {(r.query, r.vertical): r for r in gr.set_compare(df, "tc", "dc", "tb", "db").collect()}
    first = wide[("q1", "v1")]
    assert (first.cat_intersection, first.cat_not_detected, first.cat_extra_detected) == (["b"], ["a"], ["c"])
    assert first.brand_intersection_count == 0  # a length, case-sensitive
    strict = {(r.query, r.vertical): r for r in gr.set_compare_strict(df, "tc", "dc", "tb", "db").collect()}
    assert strict[("q1", "v1")].brand_hit == ["nike"] and strict[("q1", "v1")].cat_miss == []
    assert strict[("q1", "v2")].cat_miss == ["a"] and strict[("q2", "v1")].cat_extra == ["a"]
    status = {r.query: (r.hit_count, r.extra_count, r.miss_count, r.hit_verticals) for r in gr.hit_miss_extra(df, ["tc", "tb"], ["dc", "db"]).collect()}
    assert status == {"q1": (1, 0, 1, ["v1"]), "q2": (0, 1, 0, [])}
    filled, empty = cl.split_all_empty(df, ["tc", "dc", "tb", "db"])
    assert (filled.count(), empty.count()) == (3, 1)


def test_click_through_edges(spark):
    df = spark.createDataFrame([(["a", "b"], "x", 0, 2), (["c"], "y", 2, 6), (["c"], "z", 4, 2)], "query_normalised array<string>, option_code string, impressions bigint, clicks bigint")
    ctr = qu.click_through(df)
    assert {(r.query, r.option_code): r.ctr for r in ctr.collect()} == {("a b", "x"): None, ("c", "y"): 3.0, ("c", "z"): 0.5}
    scores = spark.createDataFrame([("c", "y", 1.0), ("c", "z", 1.0), ("c", "w", 1.0)], "query string, id string, score double")
    joined = qu.score_with_ctr(scores, ctr)
    assert qu.query_ctr(joined).first().avg_ctr_query_level == 1.0  # mean 1.75, capped after averaging
    assert qu.ctr_coverage(joined).first() == (1, 3)


def test_constant_column_scales_to_zero(spark):
    got = qu.min_max_scale(spark.createDataFrame([("u", 1.0, 5), ("v", 3.0, 5)], "user_id string, a double, b int")).collect()
    assert {(r.a, r.b) for r in got} == {(0.0, 0.0), (1.0, 0.0)}


def test_synonym_check_literal_form_never_matches(spark):
    names = list(gr.ENTITY_COLUMNS.values())
    df = spark.createDataFrame([([["x"]] * 5 + [["x"]])[0:6]], [f"{n}_gr" for n in names] + ["all_syn"])
    assert gr.synonym_check(df).first().check_syn is True
    assert gr.synonym_check(df, literal=True).first().check_syn is False


def test_json_merge_rules(spark):
    df = spark.createDataFrame(
        [('{"a": 1, "b": {"x": 1}}',), ('{"a": "t", "b": {"y": [1, 2.5]}, "c": null}',), ("[1]",), ("{bad}",), (None,), (' {"d": 5000000000, "e": true, "f": []} ',)],
        "j string",
    )
    want = "struct<a:int,b:struct<x:int,y:array<double>>,c:string,d:bigint,e:boolean,f:array<string>>"
    assert js.infer_schema(df.repartition(3), "j").simpleString() == want
    assert js.infer_schema(df.filter("j like '{\"a%'"), "j", "spark")["a"].dataType == T.StringType()
    parsed = js.parse_json(df, "j").filter("j.a = 1").collect()
    assert len(parsed) == 1 and parsed[0].j.b.x == 1
    assert js.infer_schema(df.filter("j is null"), "j") == T.StructType([])


def test_landing_marks_are_upper_case_and_ordered(spark):
    names = ["PID_ZSR.csv", "POSITION_PID.csv", "PID.csv", "FREQUENCY.csv", "zsr.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.x for r in df.select(rd.landing_type(F.col("n")).alias("x")).collect()]
    assert got == ["zsr", "query_position", "query_product_interactions", "query_level", "other"]


def test_landed_files_are_listed(spark, tmp_path):
    (tmp_path / "ZSR_1.csv").write_text("a")
    rows = rd.route_landing(rd.landed_files(spark, str(tmp_path)), F.current_date()).collect()
    assert [r.type for r in rows] == ["zsr"]


def test_named_csv_holds_all_rows(spark, tmp_path):
    wr.write_named_csv(spark.range(10), str(tmp_path / "x"), "x.csv")
    assert (tmp_path / "x" / "x.csv").read_text().split() == ["id", *map(str, range(10))]


def test_number_references_outside_unicode_stay(spark):
    texts = ["&#9999999;", "&#xD800;", "&#55296; a", "&#00000000065;", "&#x000000042;", "&#x10FFFF;", "&#1114112;"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(unescape_html(F.col("t"))).collect()]
    assert got == ["&#9999999;", "&#xD800;", "&#55296; a", "A", "B", chr(0x10FFFF), "&#1114112;"]


def test_replaced_rows_stay_apart(spark):
    rows = spark.createDataFrame([(1, ["x"]), (1, ["z"]), (2, []), (3, None), (4, ["x", "z", "x"]), (4, ["x", "z", "x"])], "query int, tokens array<string>")
    mapping = spark.createDataFrame([("x", "y")], "wrongword string, rightword string")
    got = sorted((r.query, r.corrected, r.tokens) for r in vocabulary.replace_tokens(rows, mapping).collect())
    assert got == [(1, "y", 1), (1, "z", 1), (2, "", 0), (3, "", 0), (4, "y z y", 3), (4, "y z y", 3)]


def test_long_phrases_are_found(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c", "d", "e", "f"])], "query int, tokens array<string>")
    phrases = spark.createDataFrame([("a b c d e",), ("b c",)], "phrase string")
    assert [r.phrase for r in vocabulary.longest_phrase(rows, phrases).collect()] == ["a b c d e"]
    values = spark.createDataFrame([("c d e", "kind")], "token string, value string")
    assert [r.value for r in vocabulary.identify_intent(rows, {"category": values}).collect()] == ["kind"]


def test_archive_rerun_changes_nothing(spark, tmp_path):
    day = lambda n: spark.createDataFrame([("q", n), ("r", 1)], "query string, freq bigint")
    from shoplens.sources.incremental import save_with_archive

    args = (str(tmp_path / "kept"),)
    save_with_archive(day(1), *args, "2024-01-01", ["query"], ["freq"])
    save_with_archive(day(9), *args, "2024-01-02", ["query"], ["freq"])
    total = save_with_archive(day(5), *args, "2024-01-02", ["query"], ["freq"])
    assert {(r.query, r.freq) for r in total.collect()} == {("q", 6), ("r", 2)}


def test_streamed_accumulation_reads_each_file_once(spark, tmp_path):
    from shoplens.streaming.accumulate import accumulate_history, archived_totals

    land, arch, check = (str(tmp_path / n) for n in ("land", "arch", "check"))
    schema = T.StructType([T.StructField("q", T.StringType()), T.StructField("date", T.StringType()), T.StructField("n", T.LongType())])
    for rows in ([("a", "2024-01-01", 1)], [("a", "2024-01-02", 2), ("b", "2024-02-01", 4)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(land)
        accumulate_history(spark, land, schema, arch, check, ["q"], ["n"]).awaitTermination()
    got = archived_totals(spark, arch, "2024-01-01", "2024-01-31", ["q"], ["n"]).collect()
    assert [(r.q, r.n) for r in got] == [("a", 3)]


def test_phrase_trie_against_brute_force(spark):
    """Phrases of 1 to 60 tokens, overlapping ones and such that are the beginning of others."""
    import random

    draw = random.Random(5)
    lists = [[draw.choice("abcde") for _ in range(draw.randint(0, 40))] for _ in range(60)]
    long = [draw.choice("abcdefgh") for _ in range(60)]
    lists += [["x", *long, "y"], long[:59], long[1:], [], None, ["a", None, "b"]]
    phrases = {" ".join(long), " ".join(long[:5]), "a", "b c", "b c d", "zz"} | {" ".join(t[k : k + draw.randint(1, 9)]) for t in lists[:30] for k in (0, 4) if t}
    phrases = sorted(p for p in phrases if p)
    rows = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(lists)], "query string, tokens array<string>")
    known = spark.createDataFrame([(p,) for p in phrases + phrases[:3]] + [(None,)], "phrase string")
    want = set()
    for i, t in enumerate(lists):
        for p in phrases:
            w = p.split(" ")
            want |= {(f"q{i}", k, p, len(w)) for k in range(len(t or []) - len(w) + 1) if t[k : k + len(w)] == w}
    from shoplens.operators import phrase_trie

    got = phrase_trie.matches(rows, phrase_trie.token_trie(known), ["query"])
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(length == 60 for *_, length in want)
    best = {}
    for q, _, p, n in want:
        best[q] = min(best.get(q, (0, "")), (-n, p))
    assert {r.query: (-r.phrase_tokens, r.phrase) for r in vocabulary.longest_phrase(rows, known).collect()} == best
    lookup = known.select(F.col("phrase").alias("token"), F.lit("v").alias("value"))
    assert {r.query for r in vocabulary.identify_intent(rows, {"kind": lookup}).collect()} == set(best)
    assert phrase_trie.matches(rows.limit(0), phrase_trie.token_trie(known), ["query"]).collect() == []
    assert phrase_trie.matches(rows, phrase_trie.token_trie(known.limit(0)), ["query"]).collect() == []


def test_trie_plan_does_not_grow(spark):
    from shoplens.operators import phrase_trie

    sizes = []
    for n in (3, 60):
        known = spark.createDataFrame([(" ".join("abc"[k % 3] for k in range(n)),)], "phrase string")
        rows = spark.createDataFrame([("q", ["a"])], "query string, tokens array<string>")
        plan = phrase_trie.matches(rows, phrase_trie.token_trie(known), ["query"])._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(plan.count("\n"))
    assert sizes[0] == sizes[1]


def test_json_kinds_of_all_shapes(spark):
    """Structs, arrays, doubles, longs, booleans, nesting, and what unlike values of one field become."""
    texts = [
        '{"a": 1, "s": {"x": 1, "y": {"z": true}}, "l": [1, 2.5], "b": true, "o": {}, "e": [], "m": {"k": 1}, "n": null, "t": "x", "od d": [[1], []]}',
        '{"a": 3000000000, "s": {"x": "q", "y": {"z": "no"}, "w": [{"p": 1}]}, "l": [true], "b": "yes", "e": [7], "m": 5, "big": 99999999999999999999}',
        ' {"a": -2147483648, "s": {"w": [{"p": 1.5, "q": [1e3]}]}, "n": {"deep": 1}, "mix": [1, "a", [2]], "one": 1.0}',
        '{"d": false, "arr": [{"u": 1}, {"u": "s", "v": null}]}', "{broken", "[1, 2]", "", None, "{}", "{} {}", "7",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "j string").repartition(4)
    want = (
        "struct<a:bigint,arr:array<struct<u:int,v:string>>,b:boolean,big:string,d:boolean,e:array<int>,l:array<double>,m:int,mix:array<int>,"
        "n:string,o:struct<>,od d:array<array<int>>,one:double,s:struct<w:array<struct<p:double,q:array<double>>>,x:int,y:struct<z:boolean>>,t:string>"
    )
    found = js.infer_schema(df, "j")
    assert found.simpleString() == want
    plan = js.value_kinds(df, "j")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "RDD" not in plan
    rows = js.parse_json(df, "j").filter("j.s.y.z").collect()
    assert len(rows) == 1 and rows[0].j["l"] == [1.0, 2.5]
    reader = js.infer_schema(df.filter("j not like '%\"n\"%'"), "j", "spark")
    assert reader["d"].dataType == T.BooleanType() and reader["arr"].dataType.simpleString() == "array<struct<u:string,v:string>>"
    assert js.infer_schema(df.limit(0), "j") == js.infer_schema(df.limit(0), "j", "spark") == T.StructType([])
