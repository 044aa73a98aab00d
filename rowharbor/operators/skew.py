"""Left joins on keys of which a few hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.runtime import field, fits_broadcast, materialise

TRACKED, FREQUENT, SALTS = 1000, 100, 64  # counters of the sketch, keys it names, tasks a hot key is spread over


def frequent_keys(df: DataFrame, keys: Sequence[str], least_share: float) -> DataFrame:
    """Keys that hold ``least_share`` of the rows or more: candidates from a sketch of fixed size, so
    that no key is shuffled, each with its estimated count. At most ``FREQUENT`` of them."""
    one = F.to_json(F.struct(*[field(k).alias(f"k{i}") for i, k in enumerate(keys)]))
    found = df.select(one.alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {FREQUENT}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    named = found.select("_rows", F.inline("_top"))
    return named.filter(F.col("count") >= F.col("_rows") * least_share).select(F.col("item").alias("_key"), "count")


def join_hot(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], absent: Column | None = None, least_share: float = 0.01
) -> DataFrame:
    """``rows`` left join ``other`` (unique keys) on ``keys``.

    Where ``other``, a written table, is small enough to broadcast, that is all. Beyond that, rows with a
    null key, or ``absent``, which can't match, pass by unshuffled, and keys that a sketch finds frequent
    among the others are salted: their rows are spread over ``SALTS`` tasks, and their rows of ``other`` are
    repeated for each, which are ``FREQUENT`` times ``SALTS`` at most. ``rows`` are written out for that. A key
    that ``absent`` speaks of must not be in ``other``.
    """
    if fits_broadcast(other):
        return rows.join(other, list(keys), "left").select(
            *[field(c) for c in rows.columns], *[field(c) for c in other.columns if c not in keys])
    staged = materialise(rows, "hot-join")
    missing = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    for k in keys:
        missing = missing | field(k).isNull()
    added = [c for c in other.columns if c not in keys]
    here = staged.filter(~missing)
    gone = staged.filter(missing).select(
        *[field(c) for c in rows.columns], *[F.lit(None).cast(other.schema[c].dataType).alias(c) for c in added])
    one = F.to_json(F.struct(*[field(k).alias(f"k{i}") for i, k in enumerate(keys)]))
    hot = materialise(frequent_keys(here, keys, least_share).select("_key", F.lit(True).alias("_hot")), "hot-keys")
    spread = F.pmod(F.xxhash64(*[field(c) for c in rows.columns]), F.lit(SALTS)).cast("int")
    salted = (
        here.withColumn("_key", one).join(F.broadcast(hot), "_key", "left")  # FREQUENT rows at most
        .withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(0)).drop("_key", "_hot")
    )
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = (
        other.withColumn("_key", one).join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.explode(every)).drop("_key", "_hot")
    )
    wanted = [*rows.columns, *added]
    met = salted.join(copies, [*keys, "_salt"], "left")
    return met.select(*[field(c) for c in wanted]).unionByName(gone)
