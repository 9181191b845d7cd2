"""Toxicity, conversation repair and collocations against brute force, on rows with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoplens.llm import collocations, quality, structure_repair, toxicity
from shoplens.llm.columns import labelled_sample

KINDS = "doc_id bigint, text string, lang string, source string, draw bigint, shard int, label double, n bigint, size bigint, digest bigint"
BLANKS = " \t\n\x0b\f\r"


# --- toxicity


def insulting(count, seed=1):
    """Texts of common and made-up words; every third one holds two of six insults."""
    random = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        words = list(random.choice(["the", "of", "and", "is", "On"], 30)) + [f"w{random.integers(0, 4000)}" for _ in range(20)]
        bad = i % 3 == 0
        if bad:
            words[3:5] = random.choice(["Fool", "oaf", "twit", "dolt", "clod", "prat"], 2)
        random.shuffle(words)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def extended(rows):
    return [(i, t, "en", "s", 1, 2, 0.5, 3, 4, 5) for i, t in rows]


def test_toxicity_of_held_out_texts(spark):
    rows = insulting(900)
    odd = [(5000, None), (5001, ""), (5002, " \n\t"), (5003, rows[0][1]), (5003, rows[0][1]), (None, rows[0][1]), (5004, rows[1][1] + " x" * 400_000), (5005, rows[0][1] + " x" * 400_000)]
    docs = spark.createDataFrame(extended([r[:2] for r in rows] + odd), KINDS).repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(2, None), (None, 1), (77777, 1)], "doc_id bigint, label int")
    model = toxicity.fit(docs, labels)
    found = toxicity.classify(docs, model).collect()
    assert len(found) == len(rows) + len(odd)
    truth = {i: y for i, _, y in rows}
    held = [(truth[r.doc_id], r.predicted) for r in found if r.doc_id in truth and r.doc_id % 5 == 0]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    score = defaultdict(set)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        score[r.doc_id].add(r.score)
    assert len(score[5000] | score[5001] | score[5002]) == 1  # null, empty and blank
    assert score[5003] == score[None] == score[0]  # repeated rows
    assert min(score[5005]) > 0.5 > max(score[5004])  # very long ones are read to the end
    assert toxicity.fit(docs, labels).weights.tolist() == model.weights.tolist()


def test_toxicity_without_rows_or_labels(spark):
    none = spark.createDataFrame([], KINDS)
    docs = spark.createDataFrame(extended([(1, "one two"), (2, None)]), KINDS)
    labels = spark.createDataFrame([], "doc_id bigint, label int")
    model = toxicity.fit(docs, labels)
    assert {r.score for r in toxicity.classify(docs, model).collect()} == {0.5}
    assert toxicity.classify(none, toxicity.fit(none, labels)).collect() == []


def test_features_are_words_pairs_and_skips():
    texts = ["A b c", None, "", "x x x", "b\tCé b c", "long " * 3000]
    flat, bounds = toxicity.features(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        want = len(set(w)) + len(set(zip(w, w[1:]))) + len(set(zip(w, w[2:])))
        own = flat[bounds[i] : bounds[i + 1]]
        assert len(own) == 1 + want and own[0] == 0 and (np.diff(own) > 0).all()
    a, b = (set(toxicity.features(pa.array([t]))[0].tolist()) for t in ("p q r", "P  q z r"))
    assert len(a & b) == 5  # constant, three words, the pair p q


def test_steps_follow_the_formula():
    """One coordinate at a time with plain numbers."""
    random = np.random.default_rng(2)
    z, n = np.zeros(40), np.zeros(40)
    zs, ns = [0.0] * 40, [0.0] * 40
    for _ in range(300):
        places = np.unique(random.integers(0, 40, 9))
        label = float(3 in places)
        toxicity.learn(z, n, places, label)
        w = {}
        for k in places:
            w[k] = 0.0 if abs(zs[k]) <= toxicity.L1 else -(zs[k] - math.copysign(toxicity.L1, zs[k])) / ((toxicity.BETA + math.sqrt(ns[k])) / toxicity.RATE + toxicity.L2)
        g = (1 / (1 + math.exp(-sum(w.values()))) - label) * (toxicity.POSITIVE if label else 1)
        for k in places:
            sigma = (math.sqrt(ns[k] + g * g) - math.sqrt(ns[k])) / toxicity.RATE
            zs[k] += g - sigma * w[k]
            ns[k] += g * g
    assert np.allclose(z, zs) and np.allclose(n, ns)
    found = toxicity.weight(z, n)
    assert found[3] > 0 and found.argmax() == 3 and (found == 0).any()


def test_labelled_sample_is_bounded(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(1, "same")] * 500 + [(2, "b"), (3, None), (None, "c")]
    docs = spark.createDataFrame(extended(rows), KINDS).repartition(4)
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, None), (3, 0), (None, 1)], "doc_id bigint, label int")
    assert labelled_sample(docs, labels, 50).count() == 50
    all_rows = labelled_sample(docs, labels, 100_000).collect()
    assert len(all_rows) == 2 * 3001 + 1
    drawn = labelled_sample(docs, labels, 50).collect()
    assert {r.draw for r in drawn} == set(sorted(r.draw for r in all_rows)[:50])


# --- conversation repair


def shown(value):
    return " " if value is None else str(value)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        draw, role, text = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20, shown(role), shown(text)
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def cheapest(rows, insert=5):
    """Forward over all states, keeping whole audits: rows (turn, role, text) of one conversation in order."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(BLANKS)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def better(best, state, new):
        if state not in best or new[:2] < best[state][:2]:
            best[state] = new

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, kept) in list(best.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        better(best, step[state, role[0]], (cost + insert, audit + "I", [*kept, f"{role}:"]))
        return best

    best = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, kept) in best.items():
            better(after, state, (cost + 2, audit + "D", kept))
            if fault in ("", "truncated"):
                more = cost + (5 if fault else 0)
                if (state, role[:1]) in step:
                    better(after, step[state, role[:1]], (more, audit + "K", [*kept, f"{role}:{text}"]))
                for other in ("user", "assistant"):
                    if (state, other[0]) in step:
                        better(after, step[state, other[0]], (more + 1, audit + "R", [*kept, f"{other}:{text}"]))
        best = inserted(after)
    cost, audit, kept = min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def reports(rows):
    by = {conv: [] for conv, *_ in rows}
    for conv, *row in damaged(rows):
        by[conv].append(row)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        out[conv] = cheapest(own)
    return out


def talks():
    random = np.random.default_rng(11)
    rows, texts = [], ["Yes.", "No", "", " \t", "Why?", "é!", "x. ", "a:b\nc.", None, "y.\u0085", "Done.\n\f"]
    for conv in [*range(120), None]:
        for turn in range(random.integers(1, 12)):
            role = random.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User", None], p=[0.1, 0.25, 0.25, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])
            text = random.choice(texts) if random.random() < 0.5 else f"Turn {turn} of {random.integers(0, 50)}."
            rows.append((conv, None if random.random() < 0.05 else int(turn) * int(random.integers(1, 3)), role, text))
    rows += rows[:40]
    rows += [(500, 3, "user", "Hi."), (501, None, "user", "Hi."), (501, None, "assistant", "Hi.")]
    rows += [(600, t, random.choice(["user", "assistant", "system"]), f"{random.integers(0, 300)}" + random.choice([".", "", "!"])) for t in range(900)]
    rows += [(601, 7, "user", "Same.")] * 300
    return [(c, t, None if r is None else str(r), None if x is None else str(x)) for c, t, r, x in rows]


@pytest.mark.parametrize("segment", [256, 3])
def test_repairs(spark, monkeypatch, segment):
    """Whole conversations and such cut into many segments."""
    monkeypatch.setattr(structure_repair, "SEGMENT", segment)
    rows = talks()
    kinds = "conv_id bigint, turn bigint, role string, text string, conv string, place string, copy int, n int, digest int, edit int"
    turns = spark.createDataFrame([(*r, "c", "p", 1, 2, 3, 4) for r in rows], kinds).repartition(5)
    got = structure_repair.repair_report(structure_repair.damage(turns), turns).collect()
    want = reports(rows)
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert {"D", "K", "R"} <= set("".join(w[6] for w in want.values()))


def test_walks_with_inserts(monkeypatch):
    """With cheap inserts, which the set costs never choose, in segments of all sizes."""
    monkeypatch.setattr(structure_repair, "INSERT", 1)
    monkeypatch.setattr(structure_repair, "END", structure_repair.with_inserts([0, structure_repair.FAR, structure_repair.FAR, 0]))
    random = np.random.default_rng(8)
    rows = [(t, str(random.choice(["user", "assistant", "system", "tool"])), f"{t}" + str(random.choice([".", ""]))) for t in range(61)]
    want = cheapest(rows, insert=1)
    codes = "".join(chr(65 + 4 * (not x.endswith(".")) + ("sua".find(r[0]) if r[0] in "sua" else 3)) for _, r, x in rows)
    steps, end = structure_repair.Steps(), structure_repair.END
    for size in (1, 2, 7, 30, 61):
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        behind = [end]
        for part in reversed(parts):
            table = steps.table(part)
            behind.append(tuple(min(table[4 * s + e] + behind[-1][e] for e in range(4)) for s in range(4)))
        behind.reverse()
        state, audit, cost, kept = structure_repair.START, "", 0, []
        for i, part in enumerate(parts):
            row = {"conv": "c", "seg": i, "segs": len(parts), "start": i * size, "codes": part, "behind": list(behind[i + 1]), "crossed": 0, "entry": state}
            found = next(structure_repair._walks([pa.RecordBatch.from_pylist([row])])).to_pylist()[0]
            for *_, state in steps.walk(part, behind[i + 1], state):
                pass
            audit, cost = audit + found["audit"], cost + found["cost"]
            kept += sorted((e["place"], e["order"], e["edit"], e["role"]) for e in found["edits"])
        lines = [f"{role or rows[at][1]}:" + ("" if edit == "I" else rows[at][2]) for at, _, edit, role in kept]
        assert "I" in audit
        assert (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()) == want[5:]


def test_repaired_rows_fit(spark):
    turns = spark.createDataFrame(talks(), "conv_id bigint, turn bigint, role string, text string")
    done = structure_repair.repair(turns)
    kept = defaultdict(list)
    for r in done.rows.collect():
        kept[r.conv].append((r.place, r.order, r.role))
    for rows in kept.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r[2][0] for r in sorted(rows)))
    none = turns.limit(0)
    assert structure_repair.repair_report(structure_repair.damage(none), none).collect() == []
    empty = structure_repair.repair_report(none, turns.select("conv_id").limit(1)).collect()[0]
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_wide_turns(spark):
    low, high = -(2**63), 2**63 - 1
    turns = spark.createDataFrame([(1, low, "user", "A."), (1, high, "assistant", "B."), (2, 5, "user", "A."), (2, high, "assistant", "B.")], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv: (r.gaps, r.audit) for r in structure_repair.repair(turns).reports.collect()}
    assert got == {"1": (None, "KK"), "2": (high - 6, "KK")}


# --- collocations


def phrases(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    met, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                met.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    often = {k: v for k, v in met.items() if v >= least}
    found = defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) == 1 or any(l2 == lang and len(q) > len(p) and 100 * f >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), f in often.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (often[lang, p[:k]] * often[lang, p[k:]]), k, often[lang, p[:k]], often[lang, p[k:]]) for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for lang, own in found.items() for i, (score, a, p, left, right) in enumerate(sorted(own)[:top])}


def test_collocations(spark):
    random = np.random.default_rng(4)
    pool = ["the", "The", "of", "New", "york", "é", "日本", "a b", "x-y", "'s"] + [f"w{i}" for i in range(60)]
    ends = [" ", " ", " ", "  ", "\t", " \t ", ". ", ",", ";", "\n", "\x0b", "\x0c", "\r", "!", "? ", ": "]
    rows = []
    for i in range(150):
        words = list(random.choice(pool, random.integers(0, 60), p=[0.04] * 10 + [0.01] * 60))
        for passage in ("new York stock exchange is open today", "once upon a time"):
            at = random.integers(0, len(words) + 1)
            words[at:at] = passage.split() if random.random() < 0.5 else []
        rows.append((random.choice(["en", "de"]), "".join(w + random.choice(ends) for w in words)))
    rows += [(None, "one two three. " * 9), ("fr", None), ("fr", ""), ("fr", " ,.\n"), (None, "one two " * 3000), ("", "rare words here")]
    rows += [rows[0]] * 7
    rows = [(None if lang is None else str(lang), text) for lang, text in rows]
    kinds = "lang string, text string, n bigint, digest string, phrase string, f int, size int, w0 string, parts string"
    docs = spark.createDataFrame([(*r, 1, "d", "p", 2, 3, "w", "x") for r in rows], kinds).repartition(4)
    for least, top in ((4, 2000), (9, 5)):
        got = collocations.collocations(docs, least=least, top=top).collect()
        want = phrases(rows, least, top)
        assert len(got) == len(want) and {tuple(r) for r in got} == want
        assert any(" " in r.phrase and len(r.phrase.split(" ")) == 5 for r in got)
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_false_hits_change_nothing(spark, monkeypatch):
    """A tiny bit table lets nearly everything through."""
    monkeypatch.setattr(collocations, "BITS", 6)
    rows = [("en", f"alpha beta gamma {i % 7} delta. beta gamma {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in collocations.collocations(docs, least=5).collect()} == phrases(rows, 5, 2000)


def test_scores_are_exact(spark):
    """Products beyond 64 bits, and equal scores after rounding down."""
    a, n, counts = 9_000_000_000_007, 900_000_000_000_000_011, [10_000_000_000_000_003, 9_100_000_000_000_001]
    rows = [("en", "p q", 2, a, n, [counts[0]] * 4, [counts[1]] * 4), ("en", "p q r", 3, 100, 1000, [1000, 1001, 1, 1], [1001, 1000, 1, 1])]
    frame = spark.createDataFrame(rows, "lang string, phrase string, size bigint, f bigint, n bigint, parts array<bigint>, rests array<bigint>")
    got = {r.phrase: (r.score, r.l, r.r) for r in collocations.best_cuts(frame).collect()}
    assert got["p q"] == (1000 * a * n // (counts[0] * counts[1]), *counts)
    assert got["p q r"] == (1000 * 100 * 1000 // (1000 * 1000), 1000, 1000) or got["p q r"][0] == min(10**8 // (1000 * 1000), 10**8 // (1001 * 1001))
