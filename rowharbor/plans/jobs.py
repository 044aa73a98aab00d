"""Whole jobs: publish a file, replace by changes only, copy a dataset, replace layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowharbor.control import Control, ControlError, check_action, check_encoding, check_formats
from rowharbor.operators import delta, layers, port, publish
from rowharbor.operators.errors import drop_uninterpretable, error_report, split_errors
from rowharbor.operators.geo import add_synthetic_columns
from rowharbor.operators.shape import clean_cells, fit_names, ignore_columns, trim_stored
from rowharbor.operators.typing import ERRORS, cast_types, field_types
from rowharbor.runtime import field, fits_broadcast, materialise
from rowharbor.sources.delimited import (
    SOURCE_COLUMNS,
    data_columns,
    leading_records,
    scan_delimited,
    usable_names,
    with_position,
    with_record_no,
)
from rowharbor.sources.sinks import append_run_log, write_set_aside
from rowharbor.sources.store import SIGNATURE, DatasetStore, Layout, Version, buckets_for, digest_sum

POSITION = "_position"
PART_ROWS = 2_000_000  # stored rows of a bucket that one task of a merge takes


class PublishRefused(ValueError):
    """A file that does not fit its dataset."""


@dataclass(frozen=True)
class PublishResult:
    dataset_id: str
    method: str
    version: int | None
    rows_created: int = 0
    rows_updated: int = 0
    rows_deleted: int = 0
    errors: int = 0
    report: str | None = None  # folder with a row for each cell that could not be read

    @property
    def status(self) -> str:
        return "PUBLISH_ERROR" if self.errors else "SUCCESS"


def check_job(
    spark: SparkSession, control: Control, key: str | None, requested: str | None = None
) -> None:
    """Everything that can be said about a job without reading data."""
    file = control.file
    java_charsets = spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "true"
    problems = (
        check_action(control.action, key, requested)
        + check_formats(file)
        + check_encoding(file, java_charsets)
    )
    if problems:
        raise ControlError("; ".join(problems))


def prepare_rows(
    rows: DataFrame,
    control: Control,
    types: Mapping[str, str],
    key: str | None,
    gazetteer: DataFrame | None = None,
) -> DataFrame:
    """Text rows, cleaned and typed, with an error list. Narrow steps only. An ignored column may
    still be part of a composite one."""
    file = control.file
    ignored = set(file.ignore_columns)
    wanted = {c: t for c, t in types.items() if c not in ignored}
    typed = cast_types(clean_cells(rows, file), wanted, file)
    composed = ignore_columns(add_synthetic_columns(typed, file, gazetteer), file.ignore_columns)
    return publish.flag_null_keys(composed, key) if key and key in composed.columns else composed


def check_header(
    names: Sequence[str], fields: Sequence[str], control: Control, key: str | None
) -> None:
    """Whether a file's columns can be published into a dataset with these fields."""
    file, method = control.file, control.action.lower()
    composite = {*file.synthetic_locations, *file.synthetic_points}
    heads = [n for n in names if n not in file.ignore_columns]
    extra = [n for n in heads if n not in fields]
    if extra:
        raise PublishRefused(f"Extra Columns Specified: {', '.join(extra)}")
    twice = [n for n in heads if n in composite]
    if twice:
        raise PublishRefused(f"Ambiguous Column Name: {', '.join(twice)}")
    missing = [f for f in fields if f not in {*heads, *file.ignore_columns, *composite}]
    if key is not None and key not in heads and (missing or method != "replace"):
        raise PublishRefused(f"Missing Row Identifier: {key}")
    if key is None and missing and method == "replace":
        raise PublishRefused(f"Missing Fields: not mapped: {', '.join(missing)}")


def prepare_ids(rows: DataFrame, control: Control, types: Mapping[str, str], key: str) -> DataFrame:
    """The ids a delete file names: its first column, whatever it is called."""
    first = data_columns(rows)[0]
    others = [field(c) for c in rows.columns if c in SOURCE_COLUMNS]
    ids = rows.select(field(first).alias(key), *others)
    typed = cast_types(clean_cells(ids, control.file), {key: types.get(key, "text")}, control.file)
    return publish.flag_null_keys(typed, key)


def publish_rows(
    store: DatasetStore,
    dataset_id: str,
    rows: DataFrame,
    control: Control,
    types: Mapping[str, str] | None = None,
    key: str | None = None,
    gazetteer: DataFrame | None = None,
    set_aside: str | None = None,
    batch: str | None = None,
    report: str | None = None,
    whole_folder: bool = False,
) -> PublishResult:
    """Publish scanned text rows by the control's action.

    ``whole_folder``: the files are the parts of one export, and reports number its records through them.

    Of rows with the same key the last one counts. The rows are parsed once, into scratch space;
    bad rows are skipped, set aside or refused as the control says, and the rest is merged into a
    new version that is checked before it is published. Of a dataset stored by the same key, only
    the buckets that incoming keys fall in are read and written; rows appended to a dataset without a
    key are written alone.
    """
    method = control.action.lower()
    if batch is not None and store.has_batch(dataset_id, batch):
        return PublishResult(dataset_id, method, store.current_version(dataset_id))
    file = control.file
    base = store.published(dataset_id)
    target = trim_stored(store.read(dataset_id, base), file)
    types = {**field_types(target), **(types or {})}
    if method == "delete":
        prepared = prepare_ids(rows, control, types, key)
    else:
        fitted = fit_names(rows, target.columns)
        if file.columns:  # a field mapped twice leaves an unnamed column behind
            spare = set(usable_names(file.columns)) - set(file.columns)
            fitted = ignore_columns(fitted, spare)
        check_header(data_columns(fitted), target.columns, control, key)
        prepared = prepare_rows(fitted, control, types, key, gazetteer)
    parsed = materialise(prepared, "parsed")

    good, _ = split_errors(parsed)
    errors = parsed.filter(F.size(ERRORS) > 0).count()
    if file.set_aside_errors and set_aside and errors:
        write_set_aside(with_record_no(parsed, True, whole_folder, only=F.size(ERRORS) > 0), set_aside)
    if report and errors:  # also where the file is refused for them
        error_report(parsed, leading_records(file), whole_folder).write.mode("append").parquet(report)
    if file.drop_uninterpretable_rows:
        good = drop_uninterpretable(parsed, file.drop_uninterpretable_rows)
    if key is not None and not publish.repeated_keys(good, key).isEmpty():
        good = publish.last_by_position(with_position(good, POSITION), key, POSITION)
    incoming = good.select(*[field(c) for c in good.columns if c not in SOURCE_COLUMNS])

    parts = None
    if method != "replace" and key is not None and base.layout.key == (key,):
        parts = touched_parts(base, good, key)
        target = trim_stored(store.read(dataset_id, base, parts), file)
    alone = method == "append" and key is None and not base.layout.key
    if method == "replace":
        merged = publish.replace(target, incoming)
    elif alone:
        merged = publish.append(target.limit(0), incoming)
    elif method == "delete":
        merged = publish.delete(*meeting(base, parts, target, incoming, key, fits_broadcast(parsed)), key)
    elif key is None:
        merged = publish.append(target, incoming)
    else:
        few = fits_broadcast(parsed)
        merged = publish.upsert(*meeting(base, parts, target, incoming, key, few), key, few=few)

    version, sent = store.stage(merged, dataset_id, parts=parts, append=alone)
    counts = _written_actions(store, dataset_id, version) if sent.rows else {}
    before = sum(base.rows if parts is None else [base.rows[i] for i in parts])
    deleted = before - sent.rows if method == "delete" else 0
    if file.column_statistics and sent.rows:
        store.describe_staged(dataset_id, version)
    store.publish(dataset_id, version, sent, batch)
    return PublishResult(
        dataset_id, method, version,
        counts.get(publish.CREATED, 0), counts.get(publish.UPDATED, 0), deleted, errors,
        report if errors else None,
    )


def touched_parts(base: Version, rows: DataFrame, key: str) -> list[int]:
    """The buckets that the keys of ``rows`` fall in; a number for each at most."""
    stored = field(key).try_cast(base.schema[key].dataType)
    found = rows.select(base.layout.bucket([stored]).alias("part")).distinct()
    return sorted(r[0] for r in found.collect())


def meeting(
    base: Version, parts: list[int] | None, target: DataFrame, incoming: DataFrame, key: str, few: bool
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a merge by buckets, partitioned alike by the key.

    The number of partitions is a multiple of the number of buckets, so the one shuffle of the
    merge also leaves the rows of a bucket in few tasks, to be written as they are. Where the
    incoming rows are few, the stored ones are not shuffled.
    """
    if parts is None or few:
        return target, incoming
    largest = max((base.rows[i] for i in parts), default=0)
    number = base.layout.buckets * -(-max(1, largest) // PART_ROWS)
    first = incoming.columns[0] if key not in incoming.columns else key
    as_stored = incoming.withColumn(first, field(first).try_cast(base.schema[key].dataType))
    return target.repartition(number, field(key)), as_stored.repartition(number, field(first))


def _written_actions(store: DatasetStore, dataset_id: str, version: int) -> dict[str, int]:
    """What happened, counted from the one written column that says so."""
    written = store.read_staged(dataset_id, version).groupBy(field(publish.ACTION)).count()
    return {r[0]: r[1] for r in written.collect()}  # a handful of actions


def publish_file(
    store: DatasetStore,
    dataset_id: str,
    path: str,
    control: Control,
    types: Mapping[str, str] | None = None,
    key: str | None = None,
    run_log: str | None = None,
    job_file: str | None = None,
    **options,
) -> PublishResult:
    """Publish a file or folder of files. Types that are not named follow from the dataset.

    With a ``run_log`` every job leaves a row there, also one that was refused or failed.
    """
    try:
        check_job(store.spark, control, key)
        names = control.file.columns
        if names is None and not control.file.has_header_row and control.action.lower() != "delete":
            names = store.read(dataset_id).columns  # a file without a header follows the dataset
        rows = scan_delimited(store.spark, path, control.file, names)
        result = publish_rows(store, dataset_id, rows, control, types, key, **options)
    except Exception as error:
        if run_log:
            none = PublishResult(dataset_id, (control.action or "").lower(), None)
            append_run_log(result_frame(store.spark, none, path, job_file, f"{type(error).__name__}: {error}"[:2000]), run_log)
        raise
    if run_log:
        append_run_log(result_frame(store.spark, result, path, job_file), run_log)
    return result


def replace_by_delta(
    store: DatasetStore, dataset_id: str, new: DataFrame, key: str | None,
    order: Column | None = None,
) -> PublishResult:
    """Make a dataset equal to ``new``, reporting only what changed. Without a key, equal rows
    count by their copies. With one, the last row of a repeated key counts, by ``order`` or as the
    rows are read; rows without a key are errors and left out."""
    base = store.published(dataset_id)
    prev = store.read(dataset_id, base)
    shaped = new.select(*[field(c) for c in prev.columns])
    errors, parts = 0, None
    if key is not None:
        at = F.monotonically_increasing_id() if order is None else order
        staged = materialise(
            new.withColumn("_order", at).select(*[field(c) for c in prev.columns], "_order"), "new"
        )
        errors = staged.filter(field(key).isNull()).count()
        last = publish.last_of_few_repeats(staged.filter(field(key).isNotNull()), key, F.col("_order"))
        shaped = materialise(last.drop("_order"), "new-by-key")
        changes = materialise(changed_rows(store, dataset_id, base, prev, shaped, key), "delta")
        if base.layout.key == (key,):
            parts = touched_parts(base, changes, key)
            prev = store.read(dataset_id, base, parts)
        after = delta.apply_delta(prev, changes, key)
        tally = changes.groupBy(delta.CHANGE).count()
    else:
        changes = materialise(delta.delta_multiset(prev, shaped), "delta")
        after = delta.apply_delta_multiset(prev, changes)
        tally = changes.groupBy(delta.CHANGE).agg(F.sum(delta.COPIES))
    counts = {r[0]: r[1] for r in tally.collect()}  # one row per kind of change
    version, sent = store.stage(after, dataset_id, parts=parts)
    store.publish(dataset_id, version, sent)
    return PublishResult(
        dataset_id, "replace", version, counts.get(delta.INSERTED, 0),
        counts.get(delta.UPDATED, 0), counts.get(delta.DELETED, 0), errors,
    )


def changed_rows(
    store: DatasetStore, dataset_id: str, base: Version, prev: DataFrame, new: DataFrame, key: str
) -> DataFrame:
    """``delta.delta`` of the stored rows and ``new``.

    Where signatures are stored, the stored rows are not read: the digests of the buckets of ``new`` are
    compared with the stored ones first, and signatures only in buckets that differ.
    """
    layout = base.layout
    if layout.key != (key,) or not layout.signed:
        return delta.delta(prev, new, key)
    typed = new.withColumn(key, field(key).cast(base.schema[key].dataType))
    signed = materialise(
        delta.signatures(typed, key).withColumn("_part", layout.bucket()).withColumnRenamed("signature", SIGNATURE), "signed"
    )
    now = {r[0]: int(r[1]) for r in signed.groupBy("_part").agg(digest_sum([key])).collect()}  # one row per bucket
    unlike = [i for i in range(layout.buckets) if now.get(i) != base.digests[i]]
    here = signed.filter(F.col("_part").isin(unlike)).select(field(key), field(SIGNATURE).alias("signature"))
    old = store.read_signatures(dataset_id, base, unlike).withColumnRenamed(SIGNATURE, "signature")
    return delta.changed_rows(typed, delta.compare_signatures(old, here, key), key)


def version_changes(store: DatasetStore, dataset_id: str, older: int, newer: int) -> DataFrame:
    """``(key, change)`` between two versions of a signed dataset, for the keys that changed. Buckets
    that both versions share, or whose digests are equal, are not read."""
    old, new = store.version(dataset_id, older), store.version(dataset_id, newer)
    if old is None or new is None:
        raise LookupError(f"'{dataset_id}' has no version {older if old is None else newer}")
    unlike, (key,) = old.parts_unlike(new), old.layout.key
    was, now = (store.read_signatures(dataset_id, v, unlike).withColumnRenamed(SIGNATURE, "signature") for v in (old, new))
    changes = delta.compare_signatures(was, now, key)
    return changes.filter(F.col(delta.CHANGE) != delta.UNCHANGED)


def create_dataset(
    store: DatasetStore, dataset_id: str, rows: DataFrame, key: str | None = None,
    buckets: int | None = None, signed: bool = False, statistics: bool = False,
) -> int:
    """First version of a dataset. ``statistics`` keeps those of its columns, as the option of that name
    of a control does for what it publishes. With a ``key``, a row identifier, it is stored by buckets of that, so
    that merges write only what they touch; ``signed`` keeps a digest of every row, so that a replace
    by changes reads only what may differ."""
    store.register(dataset_id)
    layout = Layout()
    if key is not None:
        layout = Layout((key,), buckets or buckets_for(rows.count()), signed)
    number = layout.buckets if key is not None else 0
    shaped = rows.repartition(number, field(key)) if number else rows
    version, sent = store.stage(shaped, dataset_id, layout)
    if statistics and sent.rows:
        store.describe_staged(dataset_id, version)
    store.publish(dataset_id, version, sent)
    return version


def port_dataset(
    store: DatasetStore,
    source_id: str,
    sink_id: str,
    copy: str = "all",
    method: str = "upsert",
    key: str | None = None,
    publish_copy: bool = True,
) -> PublishResult:
    """Copy ``schema``, ``data`` or ``all`` of a dataset to another one."""
    source = store.read(source_id)
    if copy != "data":
        store.register(sink_id)
    if copy == "schema":
        result = port.copy_schema(source).withColumn(publish.ACTION, F.lit(publish.CREATED))
    elif copy == "all":
        result = port.copy_all(source)
    elif copy == "data":
        sink = store.read(sink_id)
        port.assert_schemas_alike(source, sink)
        result = port.copy_data(source, sink, key, method)
    else:
        raise ValueError(f"unknown copy type '{copy}'")
    version, sent = store.stage(result, sink_id)
    counts = _written_actions(store, sink_id, version)
    if publish_copy:
        store.publish(sink_id, version, sent)
    return PublishResult(
        sink_id, method, version,
        counts.get(publish.CREATED, 0), counts.get(publish.UPDATED, 0),
    )


LAYER = ("dataset_id", "uid")


def create_layers(store: DatasetStore, dataset_id: str, rows: DataFrame, buckets: int | None = None) -> int:
    """First version of a geographic dataset, stored by buckets of its layers."""
    store.register(dataset_id)
    layout = Layout(LAYER, buckets or buckets_for(rows.count()))
    version, sent = store.stage(rows.repartition(layout.buckets, *LAYER), dataset_id, layout)
    store.publish(dataset_id, version, sent)
    return version


def replace_layers(
    store: DatasetStore, dataset_id: str, features: DataFrame, existing: DataFrame
) -> int:
    """Replace the layers of a geographic dataset by those of a scanned file.

    The features are scanned once. Of a dataset stored by layers, only the buckets of layers that go
    or come are read and written; files of other layers stay as they are, and so do the rows that
    readers of the old version see.
    """
    scanned = materialise(features, "features")
    file_layers = scanned.select("dataset_id", "layer").distinct()
    mapping = materialise(layers.map_layers(file_layers, existing), "layers")
    base = store.published(dataset_id)
    parts = None
    if base.layout.key == LAYER:
        uids = mapping.select("dataset_id", "uid").unionByName(
            layers.apply_layer_map(file_layers, mapping)
            .select("dataset_id", F.coalesce("replaces", "layer").alias("uid"))
        )
        typed = uids.select(*[field(c).cast(base.schema[c].dataType).alias(c) for c in LAYER])
        parts = sorted(r[0] for r in typed.select(base.layout.bucket()).distinct().collect())
    replaced = layers.replace_layers(store.read(dataset_id, base, parts), scanned, mapping)
    if parts is not None:
        replaced = replaced.repartition(base.layout.buckets, *LAYER)
    version, sent = store.stage(replaced, dataset_id, parts=parts)
    store.publish(dataset_id, version, sent)
    return version


def result_frame(
    spark: SparkSession, result: PublishResult, path: str, job_file: str | None = None, failure: str | None = None
) -> DataFrame:
    """A job result, or why the job failed, as the one-row input of the run log."""
    return spark.range(1).select(
        F.current_timestamp().alias("run_at"),
        F.lit(result.dataset_id).alias("dataset_id"),
        F.lit(path).alias("file"),
        F.lit(result.method).alias("method"),
        F.lit(job_file).cast("string").alias("job_file"),
        F.lit(result.rows_updated).alias("rows_updated"),
        F.lit(result.rows_created).alias("rows_created"),
        F.lit(result.rows_deleted).alias("rows_deleted"),
        F.lit(failure is not None or result.errors > 0).alias("is_error"),
        F.lit(failure or f"{result.errors} rows could not be read").alias("message"),
    )
