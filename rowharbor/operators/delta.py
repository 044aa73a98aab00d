"""Change detection between two versions of a table, and applying the changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.runtime import field, materialise
from rowharbor.sources.store import signature_of

CHANGE = "change"
INSERTED, UPDATED, DELETED, UNCHANGED = "inserted", "updated", "deleted", "unchanged"
COPIES = "copies"


def row_signature(columns: Sequence[str]) -> Column:
    """Digest of a row in hexadecimal digits."""
    return F.lower(F.hex(signature_of(columns)))


def signatures(df: DataFrame, key: str) -> DataFrame:
    """Key and 32-byte digest of every row: what can be kept beside a version, to compare the next
    one with."""
    rest = [c for c in df.columns if c != key]
    return df.select(field(key), signature_of(rest).alias("signature"))


def compare_signatures(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``(key, change)`` for every key of either version, from their signatures."""
    change = (
        F.when(F.col("_old").isNull(), INSERTED)
        .when(F.col("_new").isNull(), DELETED)
        .when(F.col("_old") != F.col("_new"), UPDATED)
        .otherwise(UNCHANGED)
    )
    was = old.select(field(key), F.col("signature").alias("_old"))
    now = new.select(field(key), F.col("signature").alias("_new"))
    return was.join(now, key, "full_outer").select(field(key), change.alias(CHANGE))


def keyed_changes(prev: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``(key, change)`` for every key of either version. Keys are unique per side, columns in
    the same order. Only keys and digests are shuffled."""
    return compare_signatures(signatures(prev, key), signatures(new, key), key)


def delta(
    prev: DataFrame, new: DataFrame, key: str, prev_signatures: DataFrame | None = None
) -> DataFrame:
    """Changed rows: inserted and updated ones with their new values, deleted ones with the key
    and nulls. Unchanged rows are left out."""
    old = signatures(prev, key) if prev_signatures is None else prev_signatures
    return changed_rows(new, compare_signatures(old, signatures(new, key), key), key)


def changed_rows(new: DataFrame, judged: DataFrame, key: str) -> DataFrame:
    """The changed rows for the changes of keys, from ``compare_signatures``.

    The changed keys are written to scratch space; whole rows are fetched for them alone, without shuffling
    the table where the changed keys are few enough for Catalyst to broadcast.
    """
    changed = materialise(judged.filter(F.col(CHANGE) != UNCHANGED), "changes")
    came = new.join(changed.filter(F.col(CHANGE) != DELETED), key)
    gone = changed.filter(F.col(CHANGE) == DELETED)
    values = [
        field(key) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name)
        for f in new.schema.fields
    ]
    return came.select(*[field(c) for c in new.columns], CHANGE).unionByName(
        gone.select(*values, CHANGE)
    )


def row_digests(df: DataFrame) -> list[Column]:
    """128 bits of a row as two numbers; nulls count by their place, and so does the order of columns."""
    same = [field(f.name) + F.lit(0.0).cast(f.dataType) if f.dataType.typeName() in ("double", "float") else field(f.name)
            for f in df.schema.fields]  # -0.0 equals 0.0
    nulls = F.array_compact(F.array(*[F.when(field(c).isNull(), F.lit(i)) for i, c in enumerate(df.columns)]))
    return [F.xxhash64(*same, nulls).alias("_d1"), F.xxhash64(F.lit(1), nulls, *same[::-1]).alias("_d2")]


def changed_digests(prev: DataFrame, new: DataFrame) -> DataFrame:
    """``_d1, _d2, _net``: the digests of which one table has more copies than the other. Only digests
    are shuffled, one per task and digest."""
    both = new.select(*row_digests(new), F.lit(1).alias("_n")).unionByName(
        prev.select(*[field(c) for c in new.columns]).select(*row_digests(new), F.lit(-1).alias("_n"))
    )
    return both.groupBy("_d1", "_d2").agg(F.sum("_n").alias("_net")).filter(F.col("_net") != 0)


def delta_multiset(prev: DataFrame, new: DataFrame) -> DataFrame:
    """Changes between two tables without a key: each distinct row with how many copies came
    (``inserted``) or went (``deleted``).

    Copies are counted by digest, with map-side combine, so a row repeated any number of times
    shuffles as one digest per task. The digests whose counts differ are written to scratch space, and rows are
    fetched for them alone: unchanged rows are not shuffled where those digests are few enough for
    Catalyst to broadcast. Copies stay a count (see ``expand_copies``).
    """
    columns = new.columns
    net = materialise(changed_digests(prev, new), "digests")
    either = new.unionByName(prev.select(*[field(c) for c in columns]))
    met = either.select("*", *row_digests(new)).join(net, ["_d1", "_d2"])
    one = met.groupBy("_d1", "_d2", "_net").agg(F.first(F.struct(*[field(c) for c in columns])).alias("_row"))
    return one.select(
        *[F.col("_row").getField(c).alias(c) for c in columns],
        F.when(F.col("_net") > 0, INSERTED).otherwise(DELETED).alias(CHANGE),
        F.abs("_net").alias(COPIES),
    )


def expand_copies(df: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Rows repeated by their ``copies``. A long run is cut into chunks first and spread out, so
    that no task writes all copies of one row."""
    columns = [c for c in df.columns if c != COPIES]
    chunks = df.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(COPIES) - 1) / chunk)))
    )
    size = F.least(F.lit(chunk).cast("bigint"), F.col(COPIES) - F.col("_chunk") * chunk)
    sized = chunks.select(*[field(c) for c in columns], "_chunk", size.alias("_size"))
    single = sized.filter(F.col("_size") == 1).select(*[field(c) for c in columns])
    many = sized.filter(F.col("_size") > 1).repartition("_chunk", *[field(c) for c in columns])
    return single.unionByName(
        many.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))))
        .select(*[field(c) for c in columns])
    )


def apply_delta(prev: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The new version, from the previous one and its changes. A stored row without a key goes
    where the changes delete the null key."""
    gone = changes.select(field(key).alias("_changed"))
    kept = prev.join(gone, field(key).eqNullSafe(F.col("_changed")), "left_anti")
    came = changes.filter(F.col(CHANGE) != DELETED)
    return kept.select(*[field(c) for c in prev.columns]).unionByName(
        came.select(*[field(c) for c in prev.columns])
    )


def apply_delta_multiset(prev: DataFrame, changes: DataFrame) -> DataFrame:
    """The new version of a table without a key. Rows that don't change pass by; only copies of
    changed rows are counted and written out anew."""
    columns = prev.columns
    by = F.when(F.col(CHANGE) == INSERTED, F.col(COPIES)).otherwise(-F.col(COPIES))
    judged = changes.select(*[field(c) for c in columns], by.cast("bigint").alias("_n"))
    changed = materialise(judged.select(*row_digests(prev), "_n", F.struct(*[field(c) for c in columns]).alias("_row")), "changed")
    signed = prev.select("*", *row_digests(prev))
    keys = changed.select("_d1", "_d2")
    kept = signed.join(keys, ["_d1", "_d2"], "left_anti").select(*[field(c) for c in columns])
    had = signed.join(keys, ["_d1", "_d2"], "left_semi").groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_had"))
    left = changed.join(had, ["_d1", "_d2"], "left").withColumn(COPIES, F.col("_n") + F.coalesce("_had", F.lit(0)))
    again = left.filter(F.col(COPIES) > 0).select(*[F.col("_row").getField(c).alias(c) for c in columns], COPIES)
    return kept.unionByName(expand_copies(again))


def latest_snapshot(listing: DataFrame) -> DataFrame:
    """Newest completed version per dataset, from paths like
    ``completed/2014/6/3/signatures/02%3A32%3A42.567-name`` (URL-encoded or not).

    A path that carries no such date is left out; a dataset without any version has a null path.
    """
    decoded = F.url_decode(F.col("path"))
    day = r"(?:^|/)(\d{4})/(\d{1,2})/(\d{1,2})/(?:.*/)?"
    clock = r"(\d{1,2}):(\d{1,2}):(\d{1,2}(?:\.\d+)?)(?:-[^/]*)?/?$"
    parts = [F.regexp_extract("_path", day + clock, i) for i in range(1, 7)]
    at = F.struct(
        *[p.try_cast("int").alias(f"_{i}") for i, p in enumerate(parts[:5])],
        parts[5].try_cast("decimal(12,9)").alias("_5"),
    )
    dated = listing.withColumn("_path", decoded).withColumn(
        "_at", F.when(F.col("_path").rlike(day + clock), at)
    )
    order = F.when(F.col("_at").isNotNull(), F.struct("_at", "_path"))
    return dated.groupBy("dataset_id").agg(F.max_by("_path", order).alias("path"))
