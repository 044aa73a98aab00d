"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise


def _towards_least(links: DataFrame, large: bool) -> DataFrame:
    """One star step: ``links(a, b)`` with a > b; a's neighbours are tied to the least of them."""
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = near.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        tied = links.join(least, F.col("a") == F.col("u"))
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of orderable ids, any direction -> ``(node, root)``: all nodes but the roots.

    The root is the least id of the component. Each round ties every node's larger neighbours to
    its least one, then its smaller ones; the number of rounds grows with the logarithm of the
    longest path. Rounds are written to the shared scratch folder; the driver only sees a count
    and a checksum of a round.
    """
    now = materialise(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        now = materialise(_towards_least(materialise(_towards_least(now, True), "links"), False), "links")
