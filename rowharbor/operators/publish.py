"""Replace, upsert, append and delete: keyed merges of incoming rows into a stored table.

Every operator returns the resulting table plus a ``:action`` column (a system column, hidden
from readers), so that counting what happened needs no second run of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.operators.typing import ERRORS, add_error
from rowharbor.runtime import field, materialise

ACTION = ":action"
CREATED, UPDATED, UNCHANGED = "created", "updated", "unchanged"


def _as_target(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """Incoming rows in the shape of the target; columns the file lacks become null."""
    have = set(incoming.columns)
    return incoming.select(
        *[
            (field(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in target.schema.fields
        ]
    )


def replace(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """The table becomes the file."""
    return _as_target(incoming, target).withColumn(ACTION, F.lit(CREATED))


def append(target: DataFrame, incoming: DataFrame, key: str | None = None) -> DataFrame:
    """Add rows as new; with a row identifier this is an upsert."""
    if key is not None:
        return upsert(target, incoming, key)
    return target.withColumn(ACTION, F.lit(UNCHANGED)).unionByName(
        _as_target(incoming, target).withColumn(ACTION, F.lit(CREATED))
    )


def flag_null_keys(incoming: DataFrame, key: str) -> DataFrame:
    """A row without its row identifier is an error."""
    return add_error(incoming, field(key).isNull(), key, F.lit(""), "row identifier")


def last_by_key(
    incoming: DataFrame, key: str | Sequence[str], order: Column | Sequence[Column]
) -> DataFrame:
    """The last row of each key, by ``order``.

    An aggregate with map-side combine: a key that holds a large share of the rows is reduced to
    one row per task before anything is shuffled. ``order`` must not tie inside a key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = F.struct(*order) if isinstance(order, (list, tuple)) else order
    rest = [c for c in incoming.columns if c not in keys]
    if not rest:
        return incoming.dropDuplicates(keys)
    kept = F.max_by(F.struct(*[field(c) for c in rest]), by).alias("_last")
    grouped = incoming.groupBy(*[field(k) for k in keys]).agg(kept)
    return grouped.select(
        *[
            field(c) if c in keys else F.col("_last").getField(c).alias(c)
            for c in incoming.columns
        ]
    )


def last_of_few_repeats(
    staged: DataFrame, key: str | Sequence[str], order: Column | Sequence[Column]
) -> DataFrame:
    """``last_by_key`` for rows whose keys seldom repeat and are never null.

    Keys alone are shuffled to find those that repeat. Rows of all other keys pass by unshuffled
    where Catalyst can broadcast the repeated keys, which are written out so that their size is
    known. Pass staged rows: they are read twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    seen = staged.groupBy(*[field(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialise(seen.filter(F.col("_n") > 1).drop("_n"), "repeated")
    once = staged.join(repeated, keys, "left_anti").select(*[field(c) for c in staged.columns])
    again = last_by_key(staged.join(repeated, keys, "left_semi"), keys, order)
    return once.unionByName(again)


def repeated_keys(staged: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row; only keys are shuffled."""
    seen = staged.groupBy(field(key)).agg(F.count(F.lit(1)).alias("_n"))
    return seen.filter(F.col("_n") > 1).select(field(key))


def last_positions(staged: DataFrame, key: str | Sequence[str], position: str) -> DataFrame:
    """``key, _last`` of the keys that repeat: their greatest position, a ``bigint`` that no two rows share.

    A hash aggregate of numbers with map-side combine: nothing is sorted, and no row but its key and
    position is shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    seen = staged.groupBy(*[field(k) for k in keys]).agg(
        F.max(field(position)).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    return seen.filter(F.col("_n") > 1).select(*[field(k) for k in keys], "_last")


def last_by_position(staged: DataFrame, key: str | Sequence[str], position: str) -> DataFrame:
    """The last row of each key, by ``position``, without that column. Keys are not null.

    Rows are looked up for repeated keys only; all others pass by unshuffled where Catalyst can
    broadcast the repeated keys, which are written out so that their size is known. Pass staged
    rows: they are read twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    repeated = materialise(last_positions(staged, keys, position), "repeated")
    met = staged.join(repeated, keys, "left")
    last = met.filter(F.col("_last").isNull() | (F.col("_last") == field(position)))
    return last.select(*[field(c) for c in staged.columns if c != position])


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: str | None,
    mode: str = "patch",
    few: bool = False,
) -> DataFrame:
    """Merge on the row identifier: a known key is updated (even by equal values), an unknown one
    is created. Keys must be unique on both sides (see ``last_by_key``).

    ``patch`` takes a null as "not supplied" and keeps the stored value; ``full`` writes it.

    In general this is one full outer join, a shuffle of either side on the key. ``few`` says that
    the incoming rows are a small part of the table: the merge is then written so that Catalyst
    can broadcast them, when their size allows it, and leave the table unshuffled.
    """
    if mode not in ("patch", "full"):
        raise ValueError(f"unknown mode '{mode}'")
    if key is None:
        return append(target, incoming)
    supplied = [c for c in target.columns if c in set(incoming.columns) and c != key]
    types = dict(zip(target.columns, [f.dataType for f in target.schema.fields]))
    new = incoming.select(
        field(key).cast(types[key]).alias(key),
        *[field(c).cast(types[c]).alias(f"_new_{c}") for c in supplied],
        F.lit(True).alias("_in"),
    )

    def merged(c: str) -> Column:
        if c == key or c not in supplied:
            return field(c)
        if mode == "patch":
            return F.coalesce(field(f"_new_{c}"), field(c)).alias(c)
        return F.when(F.col("_in"), field(f"_new_{c}")).otherwise(field(c)).alias(c)

    if few:
        known = target.select(field(key)).join(new.select(field(key)), key, "left_semi")
        unseen = incoming.join(known, key, "left_anti")
        touched = F.when(F.col("_in"), UPDATED).otherwise(UNCHANGED).alias(ACTION)
        return (
            target.join(new, key, "left")
            .select(*[merged(c) for c in target.columns], touched)
            .unionByName(_as_target(unseen, target).withColumn(ACTION, F.lit(CREATED)))
        )
    both = target.withColumn("_old", F.lit(True)).join(new, key, "full_outer")
    action = (
        F.when(F.col("_in").isNull(), UNCHANGED)
        .when(F.col("_old").isNull(), CREATED)
        .otherwise(UPDATED)
    )
    return both.select(*[merged(c) for c in target.columns], action.alias(ACTION))


def delete(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Drop the rows named by the first column of ``ids``. Unknown ids are no error."""
    kind = target.schema[key].dataType
    wanted = ids.select(field(ids.columns[0]).try_cast(kind).alias(key))
    kept = target.join(wanted, key, "left_anti")
    return kept.select(*[field(c) for c in target.columns], F.lit(UNCHANGED).alias(ACTION))


def actions(
    target: DataFrame, incoming: DataFrame, key: str | None, method: str
) -> DataFrame:
    """What each incoming row does to the table: ``created``, ``updated``, ``deleted``,
    ``unknown`` (an id that is not stored) or ``error``; nothing is written. Pass the rows that
    ``last_by_key`` leaves, so that a repeated key counts once.
    """
    method = method.lower()
    failed = F.size(ERRORS) > 0 if ERRORS in incoming.columns else F.lit(False)
    marked = incoming.withColumn("_failed", failed)
    if method == "replace" or (key is None and method in ("append", "upsert")):
        return marked.withColumn(
            "action", F.when(F.col("_failed"), "error").otherwise(CREATED)
        ).drop("_failed")
    kind = target.schema[key].dataType
    stored = target.select(field(key).alias("_stored_key")).distinct()
    cast_key = field(key).try_cast(kind)
    joined = marked.join(stored, cast_key == F.col("_stored_key"), "left")
    hit, miss = ("deleted", "unknown") if method == "delete" else (UPDATED, CREATED)
    return joined.withColumn(
        "action",
        F.when(F.col("_failed"), "error")
        .when(F.col("_stored_key").isNotNull(), hit)
        .otherwise(miss),
    ).drop("_failed", "_stored_key")


def _counts() -> list[Column]:
    return [
        F.count_if(F.col("action") == CREATED).alias("rows_created"),
        F.count_if(F.col("action") == UPDATED).alias("rows_updated"),
        F.count_if(F.col("action") == "deleted").alias("rows_deleted"),
        F.count_if(F.col("action") == "error").alias("errors"),
    ]


def batch_results(rows: DataFrame, rows_per_batch: int, record: str = "record_no") -> DataFrame:
    """Counts per batch of ``rows_per_batch`` records; 0 means one batch. A report only: batches
    do not drive execution."""
    size = F.lit(rows_per_batch)
    batch = F.floor(F.col(record) / size) if rows_per_batch else F.lit(0)
    return rows.groupBy(batch.cast("bigint").alias("batch")).agg(*_counts())


def publish_summary(rows: DataFrame) -> DataFrame:
    """One row: created, updated, deleted, errors and the resulting status."""
    return rows.agg(*_counts()).withColumn(
        "status", F.when(F.col("errors") > 0, "PUBLISH_ERROR").otherwise("SUCCESS")
    )
