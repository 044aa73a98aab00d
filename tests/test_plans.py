"""Shapes of the physical plans, and where scratch space lies."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rowharbor import runtime
from rowharbor.control import FileControl
from rowharbor.operators import checks, delta, joblog, profile, publish
from rowharbor.operators.shape import clean_cells
from rowharbor.operators.typing import cast_types
from rowharbor.plans import job_queries, publish_queries, registry
from rowharbor.plans.registry import in_order, table
from rowharbor.sources.delimited import scan_delimited


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, pattern):
    return len(re.findall(pattern, plan(df)))


@pytest.fixture()
def shuffled(spark):
    """No side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_upsert_is_one_join(spark, sf_dir, shuffled):
    orders = table(spark, sf_dir, "orders")
    merged = publish.upsert(orders, orders.limit(5), "o_orderkey")
    assert count(merged, "SortMergeJoin.*FullOuter") == 1
    assert count(merged, "Exchange hashpartitioning") == 2


def test_few_rows_leave_the_table_unshuffled(spark, sf_dir, tmp_path):
    orders = table(spark, sf_dir, "orders")
    orders.limit(5).write.parquet(str(tmp_path / "few"))
    few = publish.last_by_key(spark.read.parquet(str(tmp_path / "few")), "o_orderkey", F.col("o_totalprice"))
    merged = publish.upsert(orders, few, "o_orderkey", few=True)
    assert count(merged, "BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan(merged)


def test_delete_prunes_and_joins_on_the_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kept = publish.delete(orders, orders.select("o_orderkey").limit(3), "o_orderkey")
    assert count(kept, "BroadcastHashJoin.*LeftAnti") == 1


def test_last_by_key_combines_before_the_shuffle(spark, sf_dir):
    got = publish.last_by_key(table(spark, sf_dir, "events"), "user_id", F.col("ts"))
    text = plan(got)
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning(user_id")
    assert count(got, "Exchange") == 1 and "Window" not in text


def test_delta_shuffles_digests_of_the_old_side(spark, sf_dir, shuffled):
    orders = table(spark, sf_dir, "orders")
    got = delta.keyed_changes(orders, orders, "o_orderkey")
    assert count(got, "SortMergeJoin.*FullOuter") == 1 and count(got, "Exchange") <= 2


def test_multiset_delta_shuffles_digests_and_changed_rows_only(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    counted = delta.changed_digests(lines, lines.filter("l_linenumber > 1"))
    assert count(counted, "Exchange") == 1 and "partial_sum" in plan(counted)
    assert "l_shipdate" not in re.search(r"Exchange hashpartitioning.*", plan(counted))[0]
    got = delta.delta_multiset(lines, lines.filter("l_orderkey <> 1"))
    # whole rows meet the few changed digests by broadcast, before they are shuffled
    assert count(got, "BroadcastHashJoin.*Inner") >= 1 and "SortMergeJoin" not in plan(got)
    assert count(got, "Exchange hashpartitioning") == 1
    assert plan(got).index("Exchange hashpartitioning") < plan(got).index("BroadcastHashJoin")


def test_last_by_position_is_a_hash_aggregate(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("at", F.monotonically_increasing_id())
    found = publish.last_positions(lines, ["l_orderkey", "l_linenumber"], "at")
    assert count(found, "HashAggregate") == 2 and "SortAggregate" not in plan(found) and "Sort " not in plan(found)
    assert count(found, "Exchange") == 1 and "l_shipdate" not in plan(found)
    rows = publish.last_by_position(lines, ["l_orderkey", "l_linenumber"], "at")
    assert "Aggregate" not in plan(rows) and "Exchange hashpartitioning" not in plan(rows)


def test_leading_records_are_dropped_without_staging(spark, tmp_path):
    for n, name in enumerate("ab"):
        (tmp_path / f"{name}.csv").write_text("note\n" * 2 + "id,v\n" + "".join(f"{i},{n}\n" for i in range(5)))
    got = scan_delimited(spark, str(tmp_path), FileControl(separator=",", skip=2))
    assert got.columns[:2] == ["id", "v"] and got.count() == 10
    assert "/records-" not in plan(got) and count(got, "BroadcastHashJoin") == 1 and "hashpartitioning" not in plan(got)
    # a first split that holds no more than the leading records
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    try:
        small = scan_delimited(spark, str(tmp_path), FileControl(separator=",", skip=2, multi_line=False))
        assert sorted(r["id"] for r in small.collect()) == sorted("01234" * 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cleaning_and_typing_are_narrow_and_compiled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day,at\n1,2020-01-01,x\n")
    control = FileControl(separator=",", multi_line=False)
    types = {"id": "bigint", "day": "calendar_date", "at": "date"}
    got = cast_types(clean_cells(scan_delimited(spark, str(tmp_path), control), control), types, control)
    text = plan(got)
    assert "Exchange" not in text and "Python" not in text
    projects = re.findall(r"(\*\(\d+\) )?Project", text)
    assert projects and all(projects)


def test_ignored_columns_are_not_read(spark, sf_dir):
    stats = profile.column_statistics(table(spark, sf_dir, "orders").select("o_custkey"))
    assert "ReadSchema: struct<o_custkey:bigint>" in plan(stats)


def test_first_event_filters_at_the_scan(spark, tmp_path, sf_dir):
    table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("type")
    ).write.parquet(str(tmp_path / "log"))
    got = joblog.first_event(spark.read.parquet(str(tmp_path / "log")), "view")
    assert "partial_min_by" in plan(got) and count(got, "Exchange") == 1
    assert plan(got).index("partial_min_by") < plan(got).index("Filter")


def test_header_checks_join_by_equality(spark):
    headers = spark.createDataFrame([("f", "d", 0, "a")], "file_id string, dataset_id string, pos int, name string")
    columns = spark.createDataFrame(
        [("d", 0, "a", "text", True)],
        "dataset_id string, pos int, field_name string, type string, is_row_id boolean")
    text = plan(checks.check_columns(headers, columns))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("ExistingRDD") == 2  # each relation is read once


def test_exports_in_order_grow_by_files(spark, monkeypatch):
    """What one task sorts and writes does not grow with the table."""
    monkeypatch.setattr(registry, "FILE_ROWS", 100)
    rows = spark.range(3000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    parts = in_order(rows, "a", "b").rdd.glom().collect()
    assert max(map(len, parts)) < 400 and [tuple(r) for part in parts for r in part] == sorted((i % 7, i) for i in range(3000))


@pytest.mark.parametrize("name", ["job_outcomes", "last_write_wins_scan"])
def test_scanned_files_grow_by_number(spark, sf_dir, monkeypatch, name):
    module = job_queries if name == "job_outcomes" else publish_queries
    monkeypatch.setattr(registry, "FILE_ROWS", 100)
    rows, write = [], module.as_delimited

    def seen(df, *rest):
        path = write(df, *rest)
        sizes = spark.read.csv(path, header=True).groupBy(F.input_file_name()).count().collect()
        rows.append((max(r["count"] for r in sizes), sum(r["count"] for r in sizes)))
        return path

    monkeypatch.setattr(module, "as_delimited", seen)
    getattr(module, name)(spark, sf_dir)
    (largest, total), = rows
    assert total > 1000 and largest < 500


def test_exact_ranks(spark):
    """Distinct counts and whether a value lies between two percentiles, as Spark's own aggregates say."""
    for values, medians in (([1, 1, 2, None, 5], {1, 2}), ([None], {None}), ([*range(101)], {47, 48, 52, 53}), ([0] * 49 + [1] * 51, {0, 1})):
        rows = spark.createDataFrame([(v,) for v in values], "x bigint")
        low, high, d = rows.agg(F.percentile("x", 0.48), F.percentile("x", 0.52), F.count_distinct("x")).first()
        for m in medians:
            found = spark.createDataFrame([("x", None if m is None else float(m)), ("y", 1.0)], "column_name string, p50 double")
            want = None if m is None else low <= m <= high
            assert tuple(publish_queries._exact(rows, found, "x", True).first()) == ("x", d, want)
    texts = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    found = spark.createDataFrame([("x", None)], "column_name string, p50 double")
    assert tuple(publish_queries._exact(texts, found, "x", False).first()) == ("x", 2, None)


def test_exact_statistics_hold_no_column_in_one_task(spark, sf_dir):
    text = plan(publish_queries.merged_statistics(spark, sf_dir))
    assert "percentile(" not in text and "Expand" not in text


def fake(master, configured):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d: configured),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_scratch_space():
    assert runtime.scratch_root(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    own = runtime.scratch_root(fake("local[2]", None))
    assert own == runtime.scratch_root(fake("local[2]", None))
    with pytest.raises(RuntimeError):
        runtime.scratch_root(fake("yarn", None))
