"""Mixing sources to target weights: hash-random order, prefix sums, a cut at each budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import WORD, global_rank, materialise, running_before, spare


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0,
                   epochs: float = 3.0) -> DataFrame:
    """One row per source: its size and its target, in words.

    Sources in code point order, null last, take the weights in turn. ``share`` of all words is
    dealt by weight; a target stops at ``epochs`` times its source, and what is over is dealt
    again among the others, until none is above. Each round is one aggregate over the sources.
    """
    ranked = global_rank(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")),
        [F.col("source").asc_nulls_last()], "_rank", "mix-sources",
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialise(
        ranked.withColumn("_weight", F.get(turn, F.pmod("_rank", F.lit(len(weights))).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(epochs))).drop("_rank"),
        "mix-weights",
    )
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        over = F.col("_weight") * F.lit(level) > F.col("_cap")
        full, weight, number = sources.agg(
            F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_weight"))),
            F.count(F.when(over, 1)),
        ).first()
        if number == capped or not weight:
            break
        level, capped = max(0.0, total - (full or 0.0)) / weight, number
    target = F.least(F.col("_cap"), F.col("_weight") * F.lit(level))
    if total and not weight:  # every source is at its limit
        target = F.col("_cap")
    return sources.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0,
        epochs: float = 3.0, seed: str = "mix") -> DataFrame:
    """How many words of each document a weighted mix takes.

    A document's place in its source's order is the MD5 of the seed and its id. A source gives
    whole epochs while its target allows, then documents in order up to the exact rest; the one
    at the cut gives part of its words. Returns ``doc_id, source, size, source_size, target,
    taken``, one row per row of ``docs``.

    Null text has size 0, null source is a source of its own (the last), a null id is hashed as
    an empty one. Repeated ids follow each other in order of size. Sources without words have
    target 0. An empty table gives an empty result. Only the ids, sources and sizes of ``docs``
    are shuffled.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = materialise(
        docs.select("doc_id", "source", key.alias("_key"),
                    F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")),
        "mix-sizes",
    )
    targets = materialise(
        source_targets(sized, weights, share, epochs).withColumnRenamed("source", "_source"),
        "mix-targets",
    )
    placed = running_before(sized, "source", "_key", "size", ["doc_id", "size"], "mix")
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.floor("target") - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    taken = F.when(F.col("source_size") > 0, whole * F.col("size") + part).otherwise(0)
    return (
        placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "source", "size", "source_size", "target",
                taken.cast("bigint").alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as its share of words rounds to.

    Rows that share an id each get the mean of their copies, rounded up.
    """
    numbers = mix(docs, **options)
    own, each, copy = spare(docs, "_id"), spare(docs, "_each"), spare(docs, "_copy")
    copies = (
        numbers.filter("taken > 0")
        .groupBy(F.col("doc_id").alias(own))
        .agg((F.sum(F.round(F.col("taken") / F.col("size"))) / F.count("*")).alias("mean"))
        .select(own, F.ceil("mean").cast("int").alias(each)).filter(F.col(each) > 0)
    )
    return (
        docs.join(copies, F.col("doc_id").eqNullSafe(F.col(own)))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(each))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
