"""Phrases of any length found in token lists by walking a trie table with joins, one token deeper each round.

The trie of all phrases is a table of edges: a node stands for a beginning of some phrase and is named by a digest of its
tokens. A walk starts at every token that begins a phrase and goes on only where the next token leads to another node, so
the work follows what is really found, not the length of the longest phrase. Every round is the same small plan over the
table the round before has written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.scale import hot_key_join, materialise, scratch_path

ROOT = ""


def _next(node: Column, token: Column) -> Column:
    return F.sha2(F.concat_ws(" ", node, token), 256)


def token_trie(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """Edges (node, token, next, ends) of the trie of blank-separated phrases; ``ends`` marks nodes that are whole phrases.

    Repeated phrases are one; null phrases are left out.
    """
    tokens = F.split(F.col(phrase), " ")
    start = F.struct(F.lit(ROOT).alias("node"), F.array().cast("array<struct<node:string,token:string,next:string>>").alias("edges"))
    walked = F.aggregate(
        tokens,
        start,
        lambda at, t: F.struct(
            _next(at["node"], t).alias("node"),
            F.concat(at["edges"], F.array(F.struct(at["node"].alias("node"), t.alias("token"), _next(at["node"], t).alias("next")))).alias("edges"),
        ),
    )
    known = phrases.select(phrase).filter(F.col(phrase).isNotNull()).distinct()
    edges = known.select(walked.alias("w")).select(F.col("w.node").alias("last"), F.explode("w.edges").alias("e")).select("last", "e.*")
    return edges.groupBy("node", "token", "next").agg(F.max(F.col("next") == F.col("last")).alias("ends"))


def matches(rows: DataFrame, trie: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every known phrase inside the token lists of ``rows`` (keys, tokens): keys, start (from 0), phrase, phrase_tokens.

    Rows keep their number of repeats; null tokens match nothing. A round joins the open walks to the edges of their nodes, hot
    nodes split by their measured rows, and stops when no walk goes on: at most as many rounds as the longest phrase found has tokens.
    """
    trie = materialise(trie, "trie")
    folder = scratch_path(trie.sparkSession, "walks")
    starts = F.explode(F.sequence(F.lit(0), F.size("tokens") - 1))
    walks = rows.filter(F.size("tokens") > 0).select(*keys, "tokens", starts.alias("start"), F.lit(0).alias("depth"), F.lit(ROOT).alias("node"))
    depth = 0
    while True:
        path = f"{folder}/round={depth}"
        due = walks.withColumn("token", F.get("tokens", F.col("start") + F.col("depth")))
        moved = hot_key_join(due, trie, ["node", "token"]).select(*keys, "tokens", "start", (F.col("depth") + 1).alias("depth"), F.col("next").alias("node"), "ends")
        moved.write.parquet(path)
        written = trie.sparkSession.read.schema(moved.schema).parquet(path)
        walks = written.filter(F.size("tokens") > F.col("start") + F.col("depth")).drop("ends")
        depth += 1
        if walks.isEmpty():
            break
    found = trie.sparkSession.read.schema(moved.schema).parquet(*[f"{folder}/round={k}" for k in range(depth)]).filter("ends")
    text = F.array_join(F.slice("tokens", F.col("start") + 1, F.col("depth")), " ")
    return found.select(*keys, "start", text.alias("phrase"), F.col("depth").alias("phrase_tokens"))
