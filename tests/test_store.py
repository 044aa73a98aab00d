"""Datasets stored by buckets of their key: what a publish reads, writes and refuses."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from rowharbor.control import Control, FileControl, generate_control
from rowharbor.plans import jobs
from rowharbor.sources.store import DatasetStore, Layout, PublishConflict, PublishFailed, buckets_for

TYPES = {"id": "bigint", "v": "text"}


@pytest.fixture()
def store(spark, tmp_path):
    made = DatasetStore(spark, str(tmp_path / "store"), deep_check=True)
    rows = spark.range(400).select("id", F.concat(F.lit("v"), "id").alias("v"))
    jobs.create_dataset(made, "d", rows, "id", buckets=32, signed=True)
    return made


def upsert(store, tmp_path, rows, action="upsert", **options):
    path = tmp_path / "in.csv"
    path.write_text("id,v\n" + "".join(f"{i},{v}\n" for i, v in rows))
    return jobs.publish_file(store, "d", str(path), generate_control("in.csv", action), TYPES, "id", **options)


def content(store):
    return {r["id"]: r["v"] for r in store.read("d").collect()}


def files_of(store, version):
    return {i: f for i, f in enumerate(store.version("d", version).folders)}


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_only_touched_buckets_are_written(spark, store, tmp_path, broadcast):
    before, listed = files_of(store, 1), sorted(os.listdir(tmp_path / "store/d/versions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        result = upsert(store, tmp_path, [(7, "new"), (8, ""), (1000, "added"), (7, "last")])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (result.rows_created, result.rows_updated, result.version) == (1, 2, 2)
    layout = store.published("d").layout
    touched = {r[0] for r in spark.createDataFrame([(7,), (8,), (1000,)], "id bigint").select(layout.bucket()).collect()}
    after = files_of(store, 2)
    assert {i for i in after if after[i] != before[i]} == touched and len(touched) < 4
    assert set(listed) < set(os.listdir(tmp_path / "store/d/versions"))
    expected = {i: f"v{i}" for i in range(400)} | {7: "last", 1000: "added"}
    assert content(store) == expected and sum(store.published("d").rows) == 401
    assert store.read("d", store.version("d", 1)).count() == 400  # the old version still reads
    assert store.read("d").columns == ["id", "v"]
    # a bucket has one file, as its rows came from one task
    for i in touched:
        assert len([f for f in os.listdir(tmp_path / f"store/d/versions/%3Afolder={after[i]}/%3Abucket={i}") if f.endswith(".parquet")]) <= 2


def test_a_merge_of_many_rows_shuffles_each_side_once(spark, store):
    base = store.published("d")
    incoming = spark.range(200).select("id", F.lit("x").alias("v"))
    target, new = jobs.meeting(base, list(range(32)), store.read("d", base), incoming, "id", few=False)
    from rowharbor.operators import publish

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = publish.upsert(target, new, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(id") == 2 == plan.count("Exchange ") and "hashpartitioning(id#" in plan
    rows = target.select(F.spark_partition_id().alias("p"), base.layout.bucket().alias("b")).distinct().collect()
    assert len({r["p"] for r in rows}) == len(rows)  # no task has rows of two buckets


def test_deletes_and_empty_buckets(store, tmp_path):
    result = upsert(store, tmp_path, [(i, "") for i in range(0, 400)] + [(5000, "")], "delete")
    assert result.rows_deleted == 400 and content(store) == {} and store.read("d").columns == ["id", "v"]
    assert set(store.published("d").folders) == {None}
    assert upsert(store, tmp_path, [(1, "again")]).rows_created == 1 and content(store) == {1: "again"}


def test_the_second_writer_of_a_version_is_refused(spark, store, tmp_path):
    other = DatasetStore(spark, store.root)
    mine, sent = store.stage(store.read("d"), "d")
    theirs, sent_too = other.stage(store.read("d").filter("id < 5"), "d")
    assert mine == theirs == 2
    store.publish("d", mine, sent)
    with pytest.raises(PublishConflict, match="taken by"):
        other.publish("d", theirs, sent_too)
    assert store.read("d").count() == 400
    again, sent_too = other.stage(store.read("d").filter("id < 5"), "d")
    other.publish("d", again, sent_too)
    assert store.read("d").count() == 5 and store.current_version("d") == 3


def test_one_of_many_writers_wins(spark, store):
    staged = [(s := DatasetStore(spark, store.root), *s.stage(store.read("d").filter(F.col("id") < i), "d")) for i in range(1, 5)]
    won = []

    def race(i, own, version, sent):
        try:
            own.publish("d", version, sent)
            won.append(i)
        except PublishConflict:
            pass

    threads = [threading.Thread(target=race, args=(i, *s)) for i, s in enumerate(staged, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and store.read("d").count() == won[0]


def test_a_dead_writer_can_be_released(spark, store, tmp_path, monkeypatch):
    """A claim without a commit blocks others, but not the same batch when it runs again."""
    real = DatasetStore._claim

    def dying(self, *args):
        real(self, *args)
        raise OSError("lost")

    monkeypatch.setattr(DatasetStore, "_claim", dying)
    with pytest.raises(OSError):
        upsert(store, tmp_path, [(1, "x")], batch="b#1")
    monkeypatch.setattr(DatasetStore, "_claim", real)
    with pytest.raises(PublishConflict):
        upsert(store, tmp_path, [(1, "y")])
    assert upsert(store, tmp_path, [(1, "x")], batch="b#1").version == 2 and content(store)[1] == "x"
    with pytest.raises(ValueError):
        store.release("d", 2)
    (tmp_path / "store/d/claims/v3").write_text("gone")
    with pytest.raises(PublishConflict):
        upsert(store, tmp_path, [(1, "z")])
    store.release("d", 3)
    assert upsert(store, tmp_path, [(1, "z")]).version == 3 and content(store)[1] == "z"


def test_changes_read_only_buckets_that_differ(spark, store, tmp_path, monkeypatch):
    read = []
    real = DatasetStore.read_signatures
    monkeypatch.setattr(DatasetStore, "read_signatures", lambda self, d, v, parts=None: read.append(sorted(parts)) or real(self, d, v, parts))
    new = store.read("d").filter("id <> 3").withColumn("v", F.when(F.col("id") == 9, "nine").otherwise(F.col("v")))
    new = new.unionByName(spark.createDataFrame([(700, "more")], "id bigint, v string"))
    result = jobs.replace_by_delta(store, "d", new, "id")
    assert (result.rows_created, result.rows_updated, result.rows_deleted) == (1, 1, 1)
    layout = store.published("d").layout
    touched = sorted({r[0] for r in spark.createDataFrame([(3,), (9,), (700,)], "id bigint").select(layout.bucket()).collect()})
    assert read == [touched]
    assert [i for i, f in files_of(store, 2).items() if f != files_of(store, 1)[i]] == touched
    read.clear()
    upsert(store, tmp_path, [(10, "v10"), (11, "x")])  # the first one changes nothing
    got = {r["id"]: r["change"] for r in jobs.version_changes(store, "d", 1, 3).collect()}
    assert got == {3: "deleted", 9: "updated", 700: "inserted", 11: "updated"}
    same = {r[0] for r in spark.createDataFrame([(10,)], "id bigint").select(layout.bucket()).collect()}
    eleven = {r[0] for r in spark.createDataFrame([(11,)], "id bigint").select(layout.bucket()).collect()}
    assert read[0] == read[1] == sorted({*touched, *eleven}) and (same <= {*touched, *eleven} or not same & set(read[0]))
    files = jobs.version_changes(store, "d", 1, 3).inputFiles()
    assert files and all(int(f.split("bucket=")[1].split("/")[0]) in read[0] for f in files)


def test_appends_without_a_key_add_a_folder(spark, tmp_path):
    store = DatasetStore(spark, str(tmp_path / "store"))
    jobs.create_dataset(store, "d", spark.createDataFrame([(1, "a")], "id bigint, v string"))
    path = tmp_path / "in.csv"
    path.write_text("id,v\n2,b\n2,b\n")
    for _ in range(2):
        result = jobs.publish_file(store, "d", str(path), Control("Append", None, FileControl(separator=",")), TYPES)
        assert (result.rows_created, result.rows_updated) == (2, 0)
    version = store.published("d")
    assert len(version.folders) == 3 and version.rows == (1, 2, 2) and store.read("d").count() == 5


def test_keys_of_another_type_and_nulls(spark, tmp_path):
    """Keys are cast to the stored type before their bucket is taken; a stored null key has a bucket too."""
    store = DatasetStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    jobs.create_dataset(store, "d", rows, "id", buckets=16)
    result = upsert(store, tmp_path, [(1, "x"), (3, "y")])
    assert (result.rows_created, result.rows_updated) == (1, 1)
    assert content(store) == {1: "x", 2: "b", None: "n", 3: "y"}


def test_layouts_are_checked(spark, store):
    with pytest.raises(ValueError):
        store.stage(store.read("d"), "d", Layout(), parts=[1])
    with pytest.raises(ValueError):
        store.stage(store.read("d"), "d", append=True)
    version, sent = store.stage(store.read("d"), "d", parts=[0])
    with pytest.raises(PublishFailed):
        store.publish("d", version, sent)
    assert buckets_for(0) == 16 and buckets_for(20_000_000) == 32 and buckets_for(10**15) == 1 << 16


def test_layers_that_stay_keep_their_files(spark, tmp_path):
    """A replaced, a new and an empty-handed layer; buckets of other layers are not touched."""
    store = DatasetStore(spark, str(tmp_path / "store"))
    rows = [(1, f"u{i % 40}", i) for i in range(400)]
    jobs.create_layers(store, "l", spark.createDataFrame(rows, "dataset_id int, uid string, f int"), buckets=64)
    features = spark.createDataFrame([(1, "roads", 1000), (1, "roads", 1001), (1, "rivers", 2000)], "dataset_id int, layer string, f int")
    existing = spark.createDataFrame([(1, "roads", "u7"), (1, "parks", "u8")], "dataset_id int, layer string, uid string")
    jobs.replace_layers(store, "l", features, existing)
    got = sorted((r["uid"], r["f"]) for r in store.read("l").collect())
    assert got == sorted([(u, f) for _, u, f in rows if u != "u7"] + [("u7", 1000), ("u7", 1001), ("rivers", 2000)])
    old, new = store.version("l", 1), store.version("l", 2)
    changed = [i for i, (a, b) in enumerate(zip(old.folders, new.folders)) if a != b]
    touched = spark.createDataFrame([(1, "u7"), (1, "rivers")], "dataset_id int, uid string").select(old.layout.bucket())
    assert changed == sorted({r[0] for r in touched.collect()}) and len(changed) == 2


def test_statistics_merge_without_reading_the_table(spark, tmp_path):
    """Parts are described when they are written; rewriting a bucket replaces its description."""
    store = DatasetStore(spark, str(tmp_path / "store"))
    rows = spark.range(2000).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 500)).alias("v"), (F.col("id") / 2).alias("x"))
    jobs.create_dataset(store, "d", rows, "id", buckets=16, statistics=True)
    path = tmp_path / "in.csv"
    path.write_text("id,v,x\n5,changed entirely,-7\n9000,,1e6\n")
    made = generate_control("in.csv", "upsert")
    control = Control(made.action, None, made.file.with_options(column_statistics=True))
    jobs.publish_file(store, "d", str(path), control, {"id": "bigint", "v": "text", "x": "double"}, "id")
    found = store.statistics("d")
    assert all("/statistics/" in f for f in found.inputFiles())
    got = {r["column_name"]: r for r in found.collect()}
    assert (got["id"]["rows"], got["id"]["nulls"], got["id"]["largest"]) == (2001, 0, 9000)
    assert abs(got["id"]["distinct_values"] - 2001) < 40 and abs(got["v"]["distinct_values"] - 376) < 12
    assert (got["v"]["nulls"], got["v"]["shortest"], got["v"]["longest"], got["v"]["largest_text"]) == (501, 2, 16, "v99")
    exact = store.read("d").agg(F.avg("x")).first()[0]
    assert got["x"]["smallest"] == -7 and got["x"]["mean"] == pytest.approx(exact) and abs(got["x"]["p50"] - 500) < 25
