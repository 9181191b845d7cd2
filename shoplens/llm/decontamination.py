"""Benchmark decontamination by template canonicalisation.

Texts become word templates: digit runs, names and units turn into typed placeholders. Windows of template
words are joined by hash to the benchmark's, so a question asked again with other numbers or names still
meets its item; windows of raw words are joined too, so a verbatim copy meets it whatever it is made of. Each aligned match then has its changed slots checked: an item value that changes must always stand
for one document value. Windows that keep their values need no check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.scale import materialise

NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
# Unit words that become a placeholder after a number.
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "l", "ml", "s", "min", "h", "hours", "minutes", "seconds", "days", "weeks", "years", "miles", "meters", "kilometers", "grams", "kilograms", "liters", "dollars", "euros", "cents", "percent", "degrees", "stunden", "tage", "jahre", "heures", "jours", "ans", "horas", "dias")
# Words that begin sentences and are no names, though capitalised.
OPENERS = (
    "a", "after", "all", "also", "an", "and", "are", "as", "at", "because", "before", "both", "but", "by", "can", "could", "did", "do", "does", "each", "every", "find", "finally", "first", "for", "from", "give", "given", "has", "have", "he", "her", "his", "how", "however", "if", "in", "is", "it", "its", "later", "let", "many", "my", "next", "no", "not", "now", "of", "on", "one", "or", "our", "she", "should", "since", "so", "some", "suppose", "that", "the", "their", "then", "there", "these", "they", "this", "those", "to", "under", "until", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whose", "why", "will", "with", "would", "yes", "you", "your",
    "aber", "alle", "als", "am", "auch", "auf", "aus", "bei", "bis", "da", "dann", "das", "dem", "den", "der", "des", "die", "dies", "diese", "dieser", "dieses", "doch", "durch", "ein", "eine", "einem", "einen", "einer", "er", "es", "für", "gib", "hat", "ich", "ihr", "im", "ist", "jede", "jeder", "jedes", "kann", "mit", "nach", "nun", "nur", "oder", "ohne", "seit", "sie", "sind", "und", "unter", "viele", "vom", "von", "vor", "war", "warum", "was", "welche", "welcher", "welches", "wenn", "wer", "wie", "wieviel", "wieviele", "wir", "wo", "zu", "zum", "zur",
    "au", "aux", "avec", "ce", "ces", "cette", "chaque", "combien", "comme", "comment", "dans", "de", "elle", "elles", "en", "est", "et", "il", "ils", "je", "la", "le", "les", "leur", "mais", "nous", "où", "par", "pour", "pourquoi", "quand", "que", "quel", "quelle", "quelles", "quels", "qui", "sa", "sans", "si", "son", "sur", "un", "une", "vous",
    "al", "cada", "como", "con", "cuando", "cuál", "cuándo", "cuánta", "cuántas", "cuánto", "cuántos", "cómo", "del", "donde", "dónde", "el", "ella", "ellas", "ellos", "entonces", "entre", "esta", "este", "esto", "hay", "las", "lo", "los", "me", "más", "para", "pero", "por", "qué", "quién", "se", "sin", "sobre", "su", "también", "tiene", "una", "y", "ya", "yo",
)
WINDOW, ENOUGH, LITERALS, LEAST = 8, 12, 5, 3
# Scripts without blanks between words: each letter is a word.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _plain(text: Column) -> Column:
    """Text without the placeholders' characters, its unspaced letters set apart; words of both kinds below then line up."""
    text = F.replace(F.translate(F.coalesce(text, F.lit("")), f"İ{NUMBER}{NAME}{UNIT}", "I   "), F.lit("ß"), F.lit("ss"))  # as in capitals
    return F.when(text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)


def _template(text: Column) -> Column:
    """Template words of a text; as many as ``_values`` gives for it.

    A name is a capital with lower-case letters, wherever it stands, unless it is one of ``OPENERS``. What stands around a
    window thus does not change its template.
    """
    text = F.regexp_replace(text, "[0-9]+", NUMBER)
    opener = "|".join(dict.fromkeys(w[0].upper() + w[1:] for w in OPENERS if len(w) > 1))
    text = F.regexp_replace(text, rf"(?=\p{{Lu}})(?<![\p{{L}}{NUMBER}])(?!(?:{opener})(?!\p{{L}}))\p{{Lu}}\p{{Ll}}+(?![\p{{L}}{NUMBER}])", NAME)
    text = F.regexp_replace(text, rf"(?i)(?<={NUMBER} )(?:{'|'.join(UNITS)})(?![\p{{L}}{NUMBER}])", UNIT)
    return F.filter(F.split(F.lower(text), rf"[^\p{{L}}{NUMBER}{NAME}{UNIT}]+"), lambda w: w != "")


def _values(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}0-9]+"), lambda w: w != "")


def _worded(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, plain, raw): digests of the template words and of the raw words of a text, place by place.

    The costly arrays are set behind generators, which filters and projections do not move below.
    """
    once = lambda value: F.explode(F.array(F.struct(value.alias("v"), F.lit(1).alias("one"))))
    digests = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    rows = rows.select(key, once(_plain(F.col("text"))).alias("t")).select(key, F.col("t.v").alias("text"))
    rows = rows.select(key, "text", once(_template(F.col("text"))).alias("t")).select(key, "text", F.col("t.v").alias("words"))
    slotted = F.exists("words", lambda w: w.rlike(f"[{NUMBER}{NAME}{UNIT}]"))
    both = F.struct(digests(F.col("words")).alias("plain"), F.when(slotted, digests(_values(F.col("text")))).alias("raw"))
    rows = rows.select(key, once(both).alias("b"))
    return rows.select(key, F.col("b.v.plain").alias("plain"), F.coalesce("b.v.raw", "b.v.plain").alias("raw"))


def _windows(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Every window of ``size`` words of rows (keys, plain, raw): (keys, size, at, hash, raw_hash, literals, slots).

    The hashes take the template's and the raw word digests in order; ``at`` counts words from 0. ``slots`` has the digest
    of the raw word of each placeholder and null for each real word, and is null without placeholders.
    """
    shifted = [F.slice(c, k + 1, F.size(c) - size + 1).alias(f"{c}{k}") for c in ("plain", "raw") for k in range(size)]
    out = rows.filter(F.size("plain") >= size).select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w"))
    plain, raw = [F.col(f"w.plain{k}") for k in range(size)], [F.col(f"w.raw{k}") for k in range(size)]
    slots = F.array(*[F.when(p != r, r) for p, r in zip(plain, raw, strict=True)])
    literals = sum((F.when(p == r, 1).otherwise(0) for p, r in zip(plain, raw, strict=True)), F.lit(0))
    out = out.select(*keys, F.lit(size).alias("size"), "at", F.xxhash64(*plain).alias("hash"), F.xxhash64(*raw).alias("raw_hash"), literals.alias("literals"), slots.alias("slots"))
    return out.withColumn("slots", F.when(F.col("literals") < size, F.col("slots")))


def _named(windows: DataFrame, by_template: Column) -> DataFrame:
    """Windows under their template, where ``by_template`` holds, and under their raw words; once where these are the same.

    A template with placeholders never equals raw words, so both share the column ``hash``. ``slots`` is null under raw words.
    """
    slotted = F.col("slots").isNotNull()
    empty = F.lit(None).cast("array<bigint>")
    word = F.struct(F.col("raw_hash").alias("hash"), empty.alias("slots"))
    shape = F.struct("hash", "slots")
    names = F.when(slotted & by_template, F.array(shape, word)).otherwise(F.array(word))
    return windows.select(*[c for c in windows.columns if c not in ("hash", "raw_hash", "literals", "slots")], F.explode(names).alias("named")).select("*", "named.hash", "named.slots").drop("named")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Documents holding benchmark text, one row per (doc_id, item_id).

    Windows are ``WINDOW`` words, every one of an item against every one of a document, met by their lower-cased raw words
    and, with at least ``LITERALS`` real words, by their template. Items of ``LEAST`` to ``WINDOW - 1`` words are windows of
    their own; shorter ones are not looked for. In scripts without blanks a letter is a word. A document holds an item when aligned
    windows cover at least ``ENOUGH`` words of it (for shorter items: all). Windows without
    placeholders or with the item's own values always count. One with a changed value counts unless that item value stands
    for several document values in the alignment; two item values may become one. In an alignment with such a conflict
    nothing confirms the other changes, so their words are not counted as covered.

    The item windows are written first, so Spark broadcasts them only if their size on disk is under the session's limit
    and sorts and merges otherwise. Null and empty texts hold nothing; rows with a null id are reported under null;
    repeated rows count as one document; items of equal text are reported each; other columns are not read.

    Returns doc_id, item_id, windows, covered_words, item_words, slots (pairs of values seen), exact.
    """
    items = _worded(benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).dropDuplicates(["item_id", "text"]), "item_id")
    n = F.size("plain")
    shapes = materialise(items.withColumn("item_words", n).withColumn("needed", F.least(F.lit(ENOUGH), n)).filter(n >= LEAST), "items")
    sizes = sorted(r[0] for r in shapes.select(F.least(F.lit(WINDOW), "item_words")).distinct().collect()) or [WINDOW]
    keys = ["item_id", "item_words", "needed"]
    own = [_windows(shapes.filter(F.least(F.lit(WINDOW), "item_words") == k), keys, k) for k in sizes]
    known = _named(reduce(DataFrame.unionByName, own), F.col("literals") >= LITERALS).withColumnsRenamed({"at": "item_at", "slots": "item_slots"})
    known = materialise(known, "item-windows")
    texts = _worded(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), "doc_id")
    if len(sizes) > 1:
        texts = materialise(texts, "texts")  # read once for each size
    met = reduce(DataFrame.unionByName, [_named(_windows(texts, ["doc_id"], k), F.col("literals") >= LITERALS).join(known, ["size", "hash"]) for k in sizes])
    place = F.col("item_at")
    pairs = F.filter(
        F.transform(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")), lambda p, k: F.struct((place + k).alias("at"), p["i"].alias("i"), p["d"].alias("d"))),
        lambda p: p["i"].isNotNull(),
    )
    window = F.struct(place.alias("at"), F.col("size"), F.coalesce(pairs, F.array()).alias("pairs"))
    lined = met.groupBy("doc_id", "item_id", "item_words", "needed", (F.col("at") - place).alias("offset")).agg(F.collect_set(window).alias("met"))  # at most the item's windows a text
    value = lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d"))
    lined = lined.withColumn("pairs", F.array_distinct(F.transform(F.flatten("met.pairs"), value)))
    values = F.array_distinct("pairs.i")
    torn = F.filter(values, lambda v: F.size(F.filter("pairs", lambda p: p["i"] == v)) > 1)
    lined = lined.withColumn("torn", F.when(F.size(values) < F.size("pairs"), torn).otherwise(F.array()))
    lined = lined.withColumn("met", F.filter("met", lambda w: ~F.exists(w["pairs"], lambda p: (p["i"] != p["d"]) & F.array_contains("torn", p["i"]))))
    covered = F.array_distinct(F.flatten(F.transform("met", lambda w: F.sequence(w["at"], w["at"] + w["size"] - 1))))
    changed = F.transform(F.filter(F.flatten("met.pairs"), lambda p: p["i"] != p["d"]), lambda p: p["at"])
    best = lined.groupBy("doc_id", "item_id", "item_words", "needed").agg(
        F.sum(F.size("met")).cast("long").alias("windows"),
        F.size(F.array_distinct(F.flatten(F.collect_set(F.when(F.size("torn") > 0, F.array_except(covered, changed)).otherwise(covered))))).cast("long").alias("covered_words"),
        F.array_distinct(F.flatten(F.collect_set(F.transform(F.flatten("met.pairs"), value)))).alias("pairs"),
    )
    return best.filter(F.col("covered_words") >= F.col("needed")).select(
        "doc_id", "item_id", "windows", "covered_words", F.col("item_words").cast("long").alias("item_words"),
        F.size("pairs").cast("long").alias("slots"), F.forall("pairs", lambda p: p["i"] == p["d"]).alias("exact"),
    )
