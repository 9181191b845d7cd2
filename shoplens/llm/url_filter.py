"""URL filter: host and path rules, and for all other URLs a character language-model ratio.

Two variable-order Markov models, one of accepted and one of rejected URLs, give each character a
log-probability after its longest kept context. A URL's score is the mean difference of the two; the cut
between accepted and rejected is calibrated on labelled URLs that the models were not fitted on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.scale import materialise

SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789-._/?=&%:#~+*"
START = "^"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null without one.

    A rule (verdict, host, path) fits its host and all subdomains when the path starts with the rule's.
    """
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in ordered
    ]
    return F.coalesce(*fits)


def _positions(urls: DataFrame, keys: Sequence[str], order: int) -> DataFrame:
    """One row per character with the ``order`` characters before it; START fills the front."""
    spelled = F.regexp_replace(F.lower(F.col("url")), "[^a-z0-9._/?=&%:#~+-]", "*")
    padded = F.concat(F.lit(START * order), spelled).cast("binary")  # one byte a character: a place is found without counting up to it
    at = F.explode(F.sequence(F.lit(1), F.length("text") - order))
    wide = urls.withColumn("text", padded).filter(F.length("text") > order).select(*keys, "text", at.alias("at"))
    return wide.select(*keys, F.substring("text", F.col("at"), F.lit(order)).cast("string").alias("context"), F.substring("text", F.col("at") + order, F.lit(1)).cast("string").alias("symbol"))


def fit(urls: DataFrame, order: int = 4, prior: float = 8.0, contexts: int = 2000) -> DataFrame:
    """Model table (context, difference): for each kept context the log10 ratio of every symbol.

    ``urls`` holds url and accepted (boolean). A context is kept when it has more than 1/``contexts`` of all
    characters, so each order keeps fewer than ``contexts``: rare contexts fall back to their shorter
    suffix (that is the variable order). Each order is smoothed towards the one below with weight ``prior``.
    """
    counted = (
        _positions(urls, ["accepted"], order)
        .groupBy("context", "symbol")
        .agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no"))
    )
    counted = materialise(counted, "url-counts")
    total = counted.agg(F.coalesce(F.sum(F.col("yes") + F.col("no")), F.lit(0))).first()[0]
    alphabet = F.array(*[F.lit(s) for s in SYMBOLS])

    def counts(size: int) -> DataFrame:
        shorter = F.substring("context", order - size + 1, size) if size else F.lit("")
        merged = counted.groupBy(shorter.alias("context"), "symbol").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        by_symbol = merged.groupBy("context").agg(
            F.sum("yes").alias("n_yes"),
            F.sum("no").alias("n_no"),
            F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("yes", "no")))).alias("seen"),  # at most one entry per symbol
        )
        return by_symbol.filter((F.col("n_yes") + F.col("n_no")) * contexts > F.lit(total))

    def smoothed(side: str, below: str | None) -> Column:
        uniform = F.lit(1.0 / len(SYMBOLS))
        return F.transform(
            F.sequence(F.lit(1), F.lit(len(SYMBOLS))),
            lambda i: (
                F.coalesce(F.element_at("seen", F.element_at(alphabet, i)).getField(side), F.lit(0))
                + prior * (F.element_at(F.col(below), i) if below else uniform)
            )
            / (F.col(f"n_{side}") + prior),
        )

    levels = [counts(0).select("context", smoothed("yes", None).alias("p_yes"), smoothed("no", None).alias("p_no"))]
    for size in range(1, order + 1):
        parent = levels[-1].select(F.col("context").alias("suffix"), F.col("p_yes").alias("b_yes"), F.col("p_no").alias("b_no"))
        suffix = F.substring("context", 2, size - 1) if size > 1 else F.lit("")
        joined = counts(size).withColumn("suffix", suffix).join(parent, "suffix")
        levels.append(joined.select("context", smoothed("yes", "b_yes").alias("p_yes"), smoothed("no", "b_no").alias("p_no")))
    ratio = F.zip_with("p_yes", "p_no", lambda a, b: F.log10(a / b))
    return materialise(reduce(DataFrame.unionByName, levels).select("context", ratio.alias("difference")), "url-model")


def score(urls: DataFrame, model: DataFrame, keys: Sequence[str], order: int = 4) -> DataFrame:
    """Mean log10 ratio per character for each row; ``keys`` must tell rows apart. Rows without text are left out.

    The model is broadcast: it has fewer than ``contexts`` rows per order by construction.
    """
    rows = _positions(urls, keys, order)
    found = []
    for size in range(order, -1, -1):
        name = F.substring("context", order - size + 1, size) if size else F.lit("")
        part = model.filter(F.length("context") == size).select(F.col("context").alias(f"c{size}"), F.col("difference").alias(f"d{size}"))
        rows = rows.withColumn(f"c{size}", name).join(F.broadcast(part), f"c{size}", "left")
        found.append(F.col(f"d{size}"))
    place = F.expr(f"instr('{SYMBOLS}', symbol)")
    value = F.element_at(F.coalesce(*found), place)
    return rows.groupBy(*keys).agg(F.avg(value).alias("score"))


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], id: str = "page_id", url: str = "url", order: int = 4
) -> DataFrame:
    """Judge each row's url: by the longest rule, else by the language-model ratio.

    URLs under a rule are the labelled ones. Four in five, by crc32 of the url, fit the models; the others set the
    cut, halfway between the mean scores of accepted and rejected. A null, empty or unlabelled-model URL scores 0.
    Without labelled URLs of one kind the cut is 0, and without any model every score is 0, which passes as allow.
    Repeated rows are judged alike, each with a row of its own; other columns are not read. An empty table gives no rows.

    Returns page_id, host, path, rule, verdict, score (mean log10 ratio per character).
    """
    judged = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url")).withColumn("row", F.monotonically_increasing_id())
    judged = judged.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    judged = materialise(judged.withColumn("by", longest_rule(F.col("host"), F.col("path"), rules)), "judged")  # rows keep their number
    labelled = judged.filter("by is not null").select("url", (F.col("by.verdict") == "allow").alias("accepted"), F.pmod(F.crc32("url"), F.lit(5)).alias("part"))
    model = fit(labelled.filter("part != 0").select("url", "accepted"), order)
    tested = labelled.filter("part = 0").withColumn("row", F.monotonically_increasing_id())
    means = score(tested, model, ["row", "accepted"], order).groupBy().agg(
        F.avg(F.when(F.col("accepted"), F.col("score"))).alias("yes"), F.avg(F.when(~F.col("accepted"), F.col("score"))).alias("no")
    ).first()
    cut = 0.0 if means.yes is None or means.no is None else (means.yes + means.no) / 2
    given = F.coalesce(F.length("url") > 0, F.lit(False))
    scored = judged.join(score(judged.filter(given).select("row", "url"), model, ["row"], order), "row", "left").withColumn("given", given)
    ratio = F.when(F.col("given"), F.coalesce("score", F.lit(0.0))).otherwise(F.lit(0.0))
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("by.rule").alias("rule"),
        F.coalesce(F.col("by.verdict"), F.when(ratio >= F.lit(cut), "allow").otherwise("block")).alias("verdict"),
        ratio.alias("score"),
    )
