"""Text operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoplens.llm import decontamination, exact_dedup, language_id, lm_hmm, ngram_jaccard, preference, quality, sentencepiece_trie, substring_dedup, url_filter
from shoplens.llm.queries import PIECE_MODEL, URL_RULES
from shoplens.operators.scale import scratch_path

KINDS = "doc_id bigint, text string, lang string, source string, n bigint, row bigint, entries string, name string, version string"


def words(text):
    return (text or "").encode().split()


def made_texts():
    random = np.random.default_rng(3)
    pool = ["the", "of", "and", "ering", "thble", "Ounti", "é", "shan,", "re.", " x", "日本", "tion"] + [f"w{i}" for i in range(150)]
    base = [" ".join(random.choice(pool, 60)) for _ in range(12)]
    passage = " ".join(random.choice(pool, 40))
    texts = list(base)
    for t in base[:6]:
        parts = t.split()
        parts[7] = "changed"
        texts += [t, " ".join(parts), t.replace(" ", "\n\t ", 5), "lead " + passage + " " + t]
    texts += [None, "", " \t\n", "one", "one two", "one two", "!!! ... 123", "rep " * 90, "rep " * 91, "a b " * 60, " ".join(random.choice(pool, 4000)), "x" * 5000, None]
    return texts


TEXTS = made_texts()
ROWS = [(i, t, "en", "s", 1, 2, "e", "n", "v") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", "s", 1, 2, "e", "n", "v"), (None, "null id " + TEXTS[0], None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, KINDS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KINDS)


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_substrings(docs, none):
    count = Counter(tuple(w[j : j + 35]) for _, t, *_ in ROWS for w in [words(t)] for j in range(len(w) - 34))
    want = []
    for i, t, *_ in ROWS:
        w, cut = words(t), set()
        for j in range(len(w) - 34):
            if count[tuple(w[j : j + 35])] > 1:
                cut.update(range(j, j + 35))
        kept = b" ".join(x for j, x in enumerate(w) if j not in cut)
        want.append((i, len(w), len(cut), hashlib.sha256(kept).hexdigest()))
    assert bag(substring_dedup.remove_repeats(docs).collect()) == bag(want)
    assert sum(w[2] for w in want) > 1000
    assert substring_dedup.remove_repeats(none).collect() == []


def test_near_duplicates(docs, none):
    sets = []
    for _, t, *_ in ROWS:
        w = [x.lower() for x in words(t)]
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(ROWS)))
    for a in range(len(ROWS)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {g: min((ROWS[k][0] for k in range(len(ROWS)) if group[k] == g and ROWS[k][0] is not None), default=None) for g in group}
    want = [(r[0], len(sets[k]), least[group[k]]) for k, r in enumerate(ROWS)]
    assert bag(ngram_jaccard.near_duplicates(docs).collect()) == bag(want)
    assert ngram_jaccard.near_duplicates(none).collect() == []


@pytest.mark.parametrize(("rounds", "crowd", "rare"), [(0, 2, 1), (0, 3, 4), (2, 4, 2)])
def test_crowds_lose_no_link(spark, monkeypatch, rounds, crowd, rare):
    """Copies of one text with few to many edits out of few words: some link with each other only, not with a hub."""
    for name, value in (("HUB_ROUNDS", rounds), ("CROWD", crowd), ("RARE", rare)):
        monkeypatch.setattr(ngram_jaccard, name, value)
    random = np.random.default_rng(rare)
    base = [f"w{k}" for k in random.integers(0, 400, 90)]
    rows = []
    for i in range(60):
        copy = list(base) if i % 3 else list(rows[i // 2]) if i else list(base)
        for at in random.choice(90, random.integers(0, 7), replace=False):
            copy[at] = f"v{random.integers(0, 3)}"
        rows.append(copy[: 90 - random.integers(0, 12)] if i % 7 == 0 else copy)
        rows[-1] += ["pad"] * (90 - len(rows[-1]))
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert 5 < len(set(group)) < 60
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in ngram_jaccard.near_duplicates(frame).collect()} == dict(enumerate(group))


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
@pytest.mark.parametrize("n", [2, 3, 5, 9, 16, 23, 64, 130])
def test_entries_are_shared(n, share):
    """Sets over the threshold share at least the promised entries, however many shingles count as frequent."""
    random = np.random.default_rng(n)
    for _ in range(40):
        x = random.integers(1, 1 << 62, n).astype(np.uint64)
        most = int(n - np.ceil(0.75 * n))
        lost = random.integers(0, most + 1)
        y = np.concatenate([x[lost:], random.integers(1, 1 << 62, random.integers(0, most + 1)).astype(np.uint64)])
        both = n - lost
        if 4 * both < 3 * (n + len(y) - both):
            continue
        found = []
        for values in (x, y):
            common = values % np.uint64(1000) < np.uint64(1000 * share)
            order = np.lexsort((values, common))
            _, names = ngram_jaccard.entries(np.zeros(len(values), dtype=np.int64), values[order], common[order], 1)
            found.append(set(names.tolist()))
        assert len(found[0] & found[1]) >= max(1, min(len(x), len(y)) // ngram_jaccard.SHARED)


def test_order_of_a_set_with_names_alike():
    random = np.random.default_rng(4)
    doc = np.sort(random.integers(0, 70_000, 5000))
    name = random.integers(0, 4, 5000).astype(np.uint64) << np.uint64(60) | random.integers(0, 3, 5000).astype(np.uint64)
    common = random.random(5000) < 0.5
    order, want = ngram_jaccard._ordered(doc, name, common), np.lexsort((name, common, doc))
    assert (doc[order] == doc[want]).all() and (name[order] == name[want]).all() and (common[order] == common[want]).all()


def test_closed_entries_leave(spark):
    """Nodes 1 and 2 are linked: their entries leave. Node 5 shares too little for any link. 3 and 4 may still meet."""
    posts = spark.createDataFrame([(10, 1, 32), (10, 2, 32), (20, 3, 32), (20, 4, 32), (21, 3, 32), (21, 4, 32), (20, 5, 320)], "entry bigint, node bigint, n bigint")
    named = spark.createDataFrame([(1, 1), (2, 1)], "node bigint, component bigint")
    assert sorted(tuple(r) for r in ngram_jaccard._open(posts, named).select("entry", "node").collect()) == [(20, 3), (20, 4), (21, 3), (21, 4)]


def test_hmm_sums_to_brute_force():
    random = np.random.default_rng(1)
    model = lm_hmm.maximised(random.random(lm_hmm.STATES * (1 + lm_hmm.STATES + lm_hmm.CLASSES) + 1))
    texts = [np.array(list(random.integers(0, 50, k)) + [lm_hmm.END]) for k in (0, 1, 3, 2)]
    for s, got in zip(texts, lm_hmm.forward(model, texts), strict=True):
        now = model.start * model.emit[s[0]]
        for c in s[1:]:
            now = (now @ model.move) * model.emit[c]
        assert got == pytest.approx(np.log(now.sum()))


def test_expected_counts_are_brute_force():
    random = np.random.default_rng(2)
    model = lm_hmm.maximised(random.random(lm_hmm.STATES * (1 + lm_hmm.STATES + lm_hmm.CLASSES) + 1) ** 6 * 1e6)
    texts = [np.array(list(random.integers(0, 50, k)) + [lm_hmm.END]) for k in (0, 40, 1, 3, 40, 17)]
    starts, moves = np.zeros(lm_hmm.STATES), np.zeros((lm_hmm.STATES, lm_hmm.STATES))
    emissions, likelihood = np.zeros((lm_hmm.CLASSES, lm_hmm.STATES)), 0.0
    for s in texts:
        ahead, behind = [model.start * model.emit[s[0]]], [np.ones(lm_hmm.STATES)]
        for c in s[1:]:
            ahead.append((ahead[-1] @ model.move) * model.emit[c])
        for c in s[:0:-1]:
            behind.insert(0, model.move @ (model.emit[c] * behind[0]))
        p = ahead[-1].sum()
        likelihood += np.log(p)
        starts += ahead[0] * behind[0] / p
        for t, c in enumerate(s):
            emissions[c] += ahead[t] * behind[t] / p
            if t:
                moves += np.outer(ahead[t - 1], model.emit[c] * behind[t]) * model.move / p
    want = np.concatenate([starts, moves.ravel(), emissions.ravel(), [likelihood]])
    room = {}
    assert lm_hmm.expected(model, texts, room) == pytest.approx(want, rel=1e-4, abs=1e-5)
    assert lm_hmm.expected(model, texts[::-1], room) == pytest.approx(want, rel=1e-4, abs=1e-5)
    assert lm_hmm.forward(model, texts).sum() == pytest.approx(likelihood, rel=1e-12)


def test_long_texts_step_together(monkeypatch):
    """A batch takes as many steps as its longest text has tokens: long texts spread over all batches would each cost theirs."""
    monkeypatch.setattr(lm_hmm, "BATCH_TOKENS", 6000)
    codes = pa.array([np.zeros(k, dtype="<u2").tobytes() for k in [1000, *[100] * 50] * 6], pa.binary())
    parts = [part for _, part in lm_hmm._sequences(iter([pa.record_batch({"codes": codes})]))]
    assert sorted(len(s) for part in parts for s in part) == sorted(len(c.as_buffer()) // 2 + 1 for c in codes)
    assert sum(max(map(len, part)) for part in parts) < 3000


def test_language_model(docs, none):
    from pyspark.sql import functions as F

    held = F.col("doc_id") % 7 == 2
    got = {(r.doc_id, r.n_tokens): r for r in lm_hmm.score_texts(docs, held).collect()}
    tokens = [(i, [x.lower() for x in words(t)] + [b""]) for i, t, *_ in ROWS]
    count = Counter(w for i, ws in tokens if i is None or i % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens:
        r = got[i, len(ws)]
        assert (r.n_known, r.train_tokens) == (sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        assert np.isfinite(r.score) and r.score < 0
    assert lm_hmm.score_texts(none, held).collect() == []


def test_states_part_on_long_texts_only(spark):
    text = "the cat sat on a mat and " * 800
    rows = spark.createDataFrame([(i, text) for i in range(2)], "doc_id bigint, text string").withColumn("held_out", F.lit(False)).withColumn("row", F.col("doc_id"))
    vocab = lm_hmm.vocabulary(lm_hmm.word_counts(rows))
    model = lm_hmm.train(lm_hmm.coded(rows, vocab))
    assert np.abs(model.emit - model.emit[:, :1]).max() > 0.01


def test_pieces(docs, none):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECE_MODEL)
    got = sentencepiece_trie.round_trip(docs, PIECE_MODEL).collect()
    assert bag((r.doc_id, tuple(r.ids) if r.ids is not None else None) for r in got) == bag((i, None if t is None else tuple(model.encode(t))) for i, t, *_ in ROWS)
    assert all(r.same for r in got)
    assert sentencepiece_trie.round_trip(none, PIECE_MODEL).collect() == []
    back = sentencepiece_trie.decode(sentencepiece_trie.encode(docs, PIECE_MODEL), PIECE_MODEL).collect()
    assert bag((r.doc_id, r.text) for r in back) == bag((i, t) for i, t, *_ in ROWS)


def test_exact_copies_and_second_batch(spark, docs, none):
    index = exact_dedup.DigestIndex(scratch_path(spark, "test-index"), 4)
    got = exact_dedup.deduplicate(docs, index, "first").collect()
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in ROWS]
    size = Counter(plain)
    least = {p: min((r[0] for r, q in zip(ROWS, plain, strict=True) if q == p and r[0] is not None), default=None) for p in plain}
    want = [(r[0], least[p], size[p], hashlib.sha256(p.encode()).hexdigest()) for r, p in zip(ROWS, plain, strict=True)]
    assert bag((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == bag(want)
    assert sum(r.kept for r in got) == len(size) and all(r.doc_id == r.keep_id for r in got if r.kept)
    more = spark.createDataFrame([(900, TEXTS[0]), (901, "new"), (902, "new")], "doc_id bigint, text string")
    again = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(more, index, "second").collect()}
    assert again == {900: (0, False), 901: (901, True), 902: (901, False)}
    assert exact_dedup.deduplicate(none, index, "third").collect() == []


def test_language(spark, docs, none):
    texts = {"en": "the house is on the hill and they like it", "de": "das haus steht auf dem berg und sie mögen es"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(t.split())), lang, "x") for i in range(40) for lang, t in texts.items()] + [(99, None, "en", "x"), (98, "!!", "de", "x"), (97, "the", None, "x")]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lettered string")
    model = language_id.fit(labelled)
    got = language_id.identify(labelled, model).collect()
    assert bag((r.doc_id, r.lang) for r in got) == bag((i, "und" if t in (None, "!!") else lang or "en") for i, t, lang, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    far = spark.createDataFrame([(1, "日本語の文章です"), (2, ""), (3, "the house")], "doc_id bigint, text string")
    assert {r.doc_id: r.rejected for r in language_id.identify(far, model).collect()} == {1: True, 2: True, 3: False}
    assert [r.doc_id for r in language_id.accepted(far, model).collect()] == [3]
    assert language_id.identify(none, model).collect() == []
    assert {r.lang for r in language_id.identify(labelled, language_id.fit(none)).collect()} == {"und"}


def test_quality(spark, none):
    good = [(i, f"this is plain text number {i} with words and more words") for i in range(40)]
    bad = [(100 + i, "BUY!! NOW!! $$$ *** CLICK!! " * (1 + i % 5)) for i in range(40)]
    rows = spark.createDataFrame([*good, *bad, (200, None), (201, ""), (202, " ")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good[::2]] + [(i, 0) for i, _ in bad[::2]] + [(1, None)], "doc_id bigint, label int")
    got = {r.doc_id: r for r in quality.classify(rows, quality.fit(rows, labels)).collect()}
    assert all(got[i].predicted == 1 and got[i].score > 0.9 for i, _ in good) and all(got[i].predicted == 0 for i, _ in bad)
    assert got[200].score == got[201].score == got[202].score == 0.5
    model = quality.fit(none, labels)
    assert quality.classify(none, model).collect() == [] and {r.score for r in quality.classify(rows, model).collect()} == {0.5}


def test_urls(spark):
    urls = ["http://a.example.org/en/1x", "http://EXAMPLE.org/es/2", "https://x.org/p?q#f", "ftp://b.com/de/9", "http://c.com/fr/1", "http://d.net/en/5", None, "", "no scheme/fr/", "http://e.com", "http://org/#x", "http://forg/x"] + [f"http://good.org/{i}" for i in range(30)] + [f"http://bad.com/de/{i}" for i in range(30)]
    rows = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(0, urls[0], "h", "r")], "page_id bigint, url string, host string, rule string")
    got = url_filter.filter_urls(rows, URL_RULES).collect()
    assert len(got) == len(urls) + 1

    def want(url):
        if not url or "://" not in url:
            return "", "", None, None
        host = re.split("[/?#]", url.split("://", 1)[1], maxsplit=1)[0].lower()
        path = re.split("[?#]", url.split("://", 1)[1], maxsplit=1)[0][len(host) :]
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None

    for r in got:
        host, path, rule, verdict = want(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert url_filter.filter_urls(rows.limit(0), URL_RULES).collect() == []


def test_decontamination(spark, docs):
    item = "If Anna buys 12 apples for 30 dollars and then sells 12 apples at the market for 45 dollars how much does she gain"
    other = "If Anna buys 7 apples for 20 dollars and then sells 7 apples at the market for 31 dollars how much does she gain"
    broken = "If Anna buys 7 apples for 20 dollars and then sells 9 apples at the market for 31 dollars how much does she gain"
    bench = spark.createDataFrame([(1, item, "x"), (2, "short question with only six", "x"), (3, None, "x"), (4, "", "x"), (5, "two words", "x")], "item_id bigint, text string, doc_id string")
    rows = spark.createDataFrame([(1, "before. " + item + " after"), (2, "so " + other), (3, broken), (4, "a short question with only six here"), (5, None), (6, ""), (7, "two words"), (8, "clean " * 50), (1, "before. " + item + " after")], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.exact for r in decontamination.contaminated(rows, bench).collect()}
    assert got == {(1, 1): True, (2, 1): False, (4, 2): True}
    assert decontamination.contaminated(docs, bench.limit(0)).collect() == [] == decontamination.contaminated(rows.limit(0), bench).collect()


def leaks(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.contaminated(rows, bench).collect()}


NOUNS = "wenn wir morgen in das große Haus am alten Markt gehen und dort viele rote Blumen kaufen dann sehen wir vor dem Haus auch noch jene kleine Katze die immer so gern auf der Mauer liegt"


def test_leaks_survive_a_conflict(spark):
    pears = "she puts 3 apples and 4 pears into the old basket and then asks how many pieces of fruit are there"
    got = leaks(spark, [NOUNS, pears], [NOUNS.replace("dem Haus", "dem Baum"), pears.replace("3", "6").replace("4", "6")])
    assert set(got) == {(0, 0), (1, 1)}
    assert got[0, 0].covered_words >= 20 and not got[1, 1].exact


def test_leaks_poor_in_words(spark):
    sums = "What is 12 + 34 * 56 - 78 + 90?"
    add = "Add the numbers 3 and 4 and 5 and 6 and 7 and 8 and 9 and 10 and 11 and 12"
    items = [sums, add, "Why cats purr", "水的化学式是什么", NOUNS.lower()]
    passage = " ".join(NOUNS.lower().split()[6:18])
    got = leaks(spark, items, ["so: " + sums, add, "tell me why cats purr at night", "请问水的化学式是什么呢", "odd " + passage + " end", "even so " + passage, None, "why cats"])
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4)}
    assert got[4, 4].covered_words == got[5, 4].covered_words == 12


def test_leaks_with_other_names_or_case(spark):
    tom = "Tom has 3 apples. Tom buys 4 more. How many does Tom have?"
    got = leaks(spark, [tom, NOUNS], [tom.replace("Tom", "Ann"), "So, " + tom.replace("Tom", "Ann").replace("3", "8"), NOUNS.lower(), NOUNS.upper(), tom.upper(), tom.replace("Tom", "Ann", 1).replace("Tom", "Bob", 1)])
    assert {k: r.exact for k, r in got.items()} == {(0, 0): False, (1, 0): False, (2, 1): True, (3, 1): True, (4, 0): True}
    assert got[2, 1].covered_words == got[3, 1].covered_words == 36


def test_preferences(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "q"), (2, 1, "assistant", "bad"), (3, 1, "assistant", "good"), (3, 0, "user", "q"), (4, 0, "user", None), (5, 0, None, "q"), (None, 0, "user", "q"), (1, 0, "user", "q")]
    table = spark.createDataFrame([(*t, "x") for t in turns], "conv_id bigint, turn bigint, role string, text string, chosen string")
    got = {(r.chosen_id, r.rejected_id, r.kind): r for r in preference.format_pairs(preference.preference_pairs(table)).collect()}
    assert set(got) == {(1, 2, "opening"), (1, 2, "reply"), (2, 3, "reply")}
    row = got[1, 2, "opening"]
    assert (row.common_turns, row.prompt) == (1, "<|user|>\nq<|end|>\n")
    assert [tuple(s) for s in row.chosen] == [("<|assistant|>\n", False), ("good<|end|>\n", True)]
    assert [tuple(s) for s in row.rejected] == [("<|assistant|>\n", False), ("bad<|end|>\n", True)]
    assert preference.preference_pairs(table.limit(0)).collect() == []


def test_pipeline_rows(spark):
    import corpus_pipeline
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    got = corpus_pipeline.run(spark, folder).collect()
    seen, kept = set(), []
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", d["text"] or "")
        if key not in seen and any(c.isalpha() for c in key):
            seen.add(key)
            kept.append(d)
    found = {r.doc_id: r.component_id for r in ngram_jaccard.near_duplicates(spark.createDataFrame([(d["doc_id"], d["text"]) for d in kept], "doc_id bigint, text string")).collect()}
    items = [re.findall(r"\w+", b["text"].lower()) for b in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    grams = {tuple(i[k : k + 12]) for i in items for k in range(len(i) - 11)} | {tuple(i) for i in items if len(i) < 12}
    clean = set()
    for d in kept:
        w = re.findall(r"\w+", d["text"].lower())
        if found[d["doc_id"]] == d["doc_id"] and not any(tuple(w[k : k + s]) in grams for s in {len(g) for g in grams} for k in range(len(w))):
            clean.add(d["doc_id"])
    assert {r.doc_id for r in got} == clean and all(r.same for r in got)


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    import corpus_pipeline

    texts = [" ".join(f"{k}{i}" for i in "bcdefghijklmnopqrstuvwxyz") for k in "abcdf"]
    spark.createDataFrame([(1, texts[0])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[0]), (7, texts[3])], "doc_id bigint, text string")
    assert bag(corpus_pipeline.drop_benchmark_leaks(spark, rows, str(tmp_path)).collect()) == bag([(None, texts[1]), (7, texts[2]), (7, texts[3])])
    rows = spark.createDataFrame([(None, texts[0]), (None, texts[0] + " end"), (None, texts[1]), (9, texts[2] + " end"), (8, texts[2]), (None, texts[2]), (8, texts[3])], "doc_id bigint, text string")
    got = bag((r.doc_id, r.text.removesuffix(" end")) for r in corpus_pipeline.drop_near_copies(spark, rows, str(tmp_path)).collect())
    assert got == bag([(None, texts[0]), (None, texts[1]), (8, texts[2]), (8, texts[3])])


def test_folds_follow_crc32(spark):
    from pyspark.sql import functions as F

    from shoplens.llm.columns import fold

    assert [r[0] for r in spark.range(50).select(fold(F.col("id"), 7)).collect()] == [zlib.crc32(str(i).encode()) % 7 for i in range(50)]
