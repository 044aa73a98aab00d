"""Change detection: round trips, multisets, hot rows, snapshots."""

import random

from pyspark.sql import functions as F

from rowharbor.operators import delta
from rowharbor.operators.publish import ACTION, delete, last_by_key, upsert
from rowharbor.sources.store import fingerprint

SCHEMA = "id int, a string, b double"


def table(spark, rng, n):
    ids = rng.sample(range(2 * n), n)
    rows = [(i, rng.choice(["x", "y", None]), rng.choice([1.0, 2.5, None])) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    key = repr
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_apply_of_delta_is_the_new_table(spark):
    rng = random.Random(3)
    for _ in range(3):
        prev, new = table(spark, rng, 60), table(spark, rng, 60)
        assert same(delta.apply_delta(prev, delta.delta(prev, new, "id"), "id"), new)


def test_multiset_round_trip(spark):
    rng = random.Random(4)
    prev = table(spark, rng, 20).union(table(spark, rng, 20)).drop("id")
    new = table(spark, rng, 30).union(table(spark, rng, 30)).drop("id")
    assert same(delta.apply_delta_multiset(prev, delta.delta_multiset(prev, new)), new)


def test_multiset_counts_copies_like_a_group_by(spark):
    """Nulls in different places, signed zeros, and rows of equal values in other columns."""
    cols = "a int, b int, x double"
    prev = spark.createDataFrame([(1, None, 0.0), (None, 1, 0.0), (1, 1, -0.0), (1, 1, 0.0), (2, 2, 1.0)], cols)
    new = spark.createDataFrame([(None, 1, 0.0), (None, 1, 0.0), (1, 1, 0.0), (1, 1, 0.0), (2, 2, float("nan"))], cols)
    got = sorted(map(str, delta.delta_multiset(prev, new).select("a", "b", "change", "copies").collect()))
    assert got == sorted(map(str, spark.createDataFrame(
        [(1, None, "deleted", 1), (None, 1, "inserted", 1), (2, 2, "deleted", 1), (2, 2, "inserted", 1)],
        "a int, b int, change string, copies bigint").collect()))
    after = delta.apply_delta_multiset(prev, delta.delta_multiset(prev, new))
    assert after.count() == 5 and delta.delta_multiset(after, new).count() == 0


def test_hot_row_stays_one_row(spark):
    """A row repeated very often is one counted row, and expands in chunks."""
    new = spark.range(250_000).select(F.lit(1).alias("a"))
    prev = spark.range(10).select(F.lit(1).alias("a"))
    changes = delta.delta_multiset(prev, new)
    assert [tuple(r) for r in changes.collect()] == [(1, "inserted", 249_990)]
    assert delta.expand_copies(changes, 1000).count() == 249_990


def test_null_is_part_of_the_signature(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "x", None), (1, "x", None)], "k int, a string, b string")
    signed = [r.signature for r in delta.signatures(df, "k").collect()]
    assert signed[0] != signed[1] == signed[2]


def test_fingerprint_sees_any_change(spark):
    a = spark.createDataFrame([(1, None), (None, 1)], "x int, y int")
    b = spark.createDataFrame([(None, 1), (1, None)], "x int, y int")
    c = spark.createDataFrame([(1, None), (1, None)], "x int, y int")
    assert fingerprint(a) == fingerprint(b) != fingerprint(c)


def test_latest_snapshot(spark):
    rows = [
        ("a", "completed/2013/12/31/signatures/22:11:00.102-f.sig"),
        ("a", "completed/2014/2/3/signatures/05%3A10%3A50.456-f.sig"),
        ("a", "completed/2014/2/3/signatures/22%3A11%3A00.102-f.sig"),
        ("a", "completed/2014/2/3/signatures/00:01:34.232-f.sig"),
        ("b", "completed/readme"),
    ]
    got = delta.latest_snapshot(spark.createDataFrame(rows, "dataset_id string, path string"))
    assert {r.dataset_id: r.path for r in got.collect()} == {
        "a": "completed/2014/2/3/signatures/22:11:00.102-f.sig", "b": None}


def test_upsert_laws(spark):
    rng = random.Random(5)
    target, more = table(spark, rng, 40), table(spark, rng, 40)
    none = more.limit(0)
    assert same(upsert(target, none, "id").drop(ACTION), target)
    assert same(upsert(target, more, "id", "full", few=True), upsert(target, more, "id", "full"))
    assert same(upsert(target, more, "id", few=True), upsert(target, more, "id"))
    added = more.join(target, "id", "left_anti")
    back = delete(upsert(target, added, "id").drop(ACTION), added.select("id"), "id")
    assert same(back.drop(ACTION), target)


def test_last_by_key_with_a_hot_key(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    got = last_by_key(rows, "k", F.col("n"))
    assert got.count() == 66_667
    assert got.filter("k = -1").first().n == 99_999


def test_last_by_position(spark):
    from rowharbor.operators.publish import last_by_position

    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"), F.lit("x").alias("v")
    )
    got = last_by_position(rows.withColumn("at", F.col("n")), "k", "at")
    assert got.columns == ["k", "n", "v"] and got.count() == 66_667 and got.filter("k = -1").first().n == 99_999


def test_replace_by_changes_with_repeated_and_null_keys(spark, tmp_path):
    from rowharbor.plans import jobs
    from rowharbor.sources.store import DatasetStore

    store = DatasetStore(spark, str(tmp_path / "store"))
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "kept by nobody")], "id bigint, name string")
    jobs.create_dataset(store, "aaaa-0001", old)
    new = spark.createDataFrame(
        [(1, "x", 1), (1, "y", 2), (2, "b", 3), (3, "c", 5), (3, "d", 4), (None, "n", 6)], "id bigint, name string, at int"
    )
    result = jobs.replace_by_delta(store, "aaaa-0001", new, "id", F.col("at"))
    assert sorted(map(tuple, store.read("aaaa-0001").collect())) == [(1, "y"), (2, "b"), (3, "c")]
    assert (result.rows_created, result.rows_updated, result.rows_deleted, result.errors) == (1, 1, 1, 1)
