"""Catalogue, profiling, checks, job logs and copies on small hand-written relations."""

import json

from pyspark.sql import functions as F

from rowharbor.operators import catalog, checks, joblog, port, profile, shape
from rowharbor.operators.publish import replace
from rowharbor.control import FileControl, ColumnOverride
from rowharbor.sources.delimited import usable_names
from rowharbor.sources.joblog import scan_job_log
from rowharbor.sources.sinks import append_run_log, read_run_log

COLUMNS = "dataset_id string, pos int, field_name string, type string, is_row_id boolean"
HEADERS = "file_id string, dataset_id string, pos int, name string"


def header_rows(file, dataset, names):
    return [(file, dataset, i, n) for i, n in enumerate(names)]


def verdicts(df):
    return sorted((r.file_id, r.status, r.message.split(":")[0]) for r in df.collect())


def test_check_columns(spark):
    columns = spark.createDataFrame(
        [("k", 0, "id", "number", True), ("k", 1, "name", "text", False), ("k", 2, "day", "date", False),
         ("n", 0, "a", "text", False), ("n", 1, "b", "text", False), ("n", 2, "c", "text", False)],
        COLUMNS)
    headers = spark.createDataFrame(
        header_rows("partial", "k", [" ID ", "Name"]) + header_rows("no id", "k", ["name"])
        + header_rows("extra", "k", ["id", "other"]) + header_rows("twice", "k", ["id", "id"])
        + header_rows("gap", "n", ["a"]) + header_rows("full", "n", ["A", "b", "c"])
        + header_rows("waived", "n", ["a", "b"]) + header_rows("lost", "unknown", ["q"]), HEADERS)
    left_out = spark.createDataFrame([("waived", "c")], "file_id string, name string")
    assert verdicts(checks.check_columns(headers, columns, left_out)) == [
        ("extra", "PUBLISH_ERROR", "Extra Columns Specified"),
        ("gap", "MISSING_COLUMNS", "Missing Fields"),
        ("lost", "PUBLISH_ERROR", "Extra Columns Specified"),
        ("no id", "PUBLISH_ERROR", "Missing Row Identifier"),
        ("twice", "PUBLISH_ERROR", "Extra Columns Specified"),
    ]
    gap = checks.missing_columns(headers, columns, left_out).filter("file_id = 'gap'").first()
    assert gap.message.endswith("b, c")
    assert verdicts(checks.check_columns(headers, columns, method="upsert")) == [
        ("extra", "PUBLISH_ERROR", "Extra Columns Specified"),
        ("lost", "PUBLISH_ERROR", "Extra Columns Specified"),
        ("twice", "PUBLISH_ERROR", "Extra Columns Specified"),
    ]


def test_map_and_ignore(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    mapped = shape.map_columns(df, ["x", "y", "x"])
    assert mapped.columns == ["y", "x"] and tuple(mapped.first()) == ("2", "3")
    assert usable_names(["x", "y", "X", "", "column_0"]) == [
        "column_0_", "y", "X", "column_3", "column_0"]
    assert shape.ignore_columns(df, ["b", "zzz"]).columns == ["a", "c"]


def test_system_and_computed_columns(spark):
    df = spark.range(1).select(
        F.lit(1).alias(":id"), F.lit(2).alias("kept"),
        F.lit(3).alias("region", metadata={shape.COMPUTED: True}))
    assert shape.drop_system_columns(df).columns == ["kept"]
    assert port.copy_schema(df).columns == ["kept"] and port.copy_schema(df).count() == 0


def test_trim_stored_side(spark):
    df = spark.createDataFrame([(" a ", " b ")], "x string, y string")
    control = FileControl(overrides={"x": ColumnOverride(trim_server_whitespace=True)})
    assert tuple(shape.trim_stored(df, control).first()) == ("a", " b ")


def test_replace_follows_the_target_schema(spark):
    target = spark.createDataFrame([], "a int, b string")
    got = replace(target, spark.createDataFrame([("x", 1)], "b string, a int"))
    assert got.columns[:2] == ["a", "b"] and got.first()[0] == 1


def test_grouped_columns(spark):
    rows = [("d", "n", {"grouping_aggregate": "count", "drill_down": "true", "align": "right"}),
            ("d", "plain", {"drill_down": "true"}), ("d", "bare", None)]
    df = spark.createDataFrame(rows, "dataset_id string, field_name string, format map<string,string>")
    got = [(r.field_name, r.format) for r in port.adapt_grouped_columns(df).collect()]
    assert got == [("count_n", {"align": "right"}), ("plain", {}), ("bare", None)]


def test_copy_catalog_rows(spark):
    rows = spark.createDataFrame([("a", "Old", "res")], "dataset_id string, title string, resource_name string")
    renames = spark.createDataFrame([("a", "b", "New"), ("a", "c", " ")],
                                    "dataset_id string, new_id string, new_title string")
    got = {tuple(r) for r in port.copy_catalog_rows(rows, renames).collect()}
    assert got == {("b", "New", None), ("c", "Old", None)}
    assert port.schemas_alike(rows, rows) and not port.schemas_alike(rows, renames)


def test_licenses(spark):
    known = catalog.licenses(spark)
    labels = [r.label for r in catalog.license_list(known).collect()]
    assert labels[0] == catalog.NO_LICENSE_LABEL and labels[1:] == sorted(labels[1:])
    assert len(labels) == 32
    df = spark.createDataFrame([("ODBL",), ("odbl",), (None,)], "code string")
    got = [r.license_label for r in catalog.lookup_license(df, known, F.col("code")).collect()]
    assert got == ["Open Data Commons Open Database License"] + [catalog.NO_LICENSE_LABEL] * 2
    by_label = spark.createDataFrame([("See Terms of Use",)], "label string")
    found = catalog.lookup_license(by_label, known, F.col("label"), by="label").first()
    assert found.license_id == "SEE_TERMS_OF_USE"


def test_metadata_update(spark):
    schema = ("dataset_id string, title string, description string, category string, tags array<string>, "
              "license_id string, attribution string, attribution_link string, private map<string,string>")
    rows = spark.createDataFrame(
        [("a", "T", "D", "C", ["x"], "ODBL", "me", "l", {"contactEmail": "old", "k": "v"}),
         ("b", "T", "D", "C", ["x"], "ODBL", "me", "l", None)], schema)
    updates = spark.createDataFrame(
        [("a", "New", None, None, None, "", "you", None, "new")],
        "dataset_id string, title string, description string, category string, keywords array<string>, "
        "license_id string, data_provided_by string, source_link string, contact_info string")
    after = {r.dataset_id: r for r in catalog.update_metadata(rows, updates).collect()}
    a = after["a"]
    assert (a.title, a.description, a.tags, a.license_id) == ("New", None, [], "")
    assert a.private == {"contactEmail": "new", "k": "v"}
    assert tuple(after["b"]) == tuple(rows.filter("dataset_id = 'b'").first())
    bad = spark.createDataFrame([("abcd-1234", " "), ("x", "T"), ("abcd-1234", "T")],
                                "dataset_id string, title string")
    assert sorted(r.message for r in checks.check_metadata(bad).collect()) == [
        "Dataset title is required", "Invalid dataset id"]


def job_log(tmp_path):
    job = {"jobId": "j1", "dataset": "d1", "timestamp": "2014-06-16T17:39:35.626Z"}
    events = [
        {"type": "Committing-Job", "data": {**job, "control": {"opaque": "u1"}, "extra": 1}},
        {"type": "committing-job", "data": {**job, "jobId": "j2", "portControl": {"opaque": "u2"}}},
        {"type": "committed-job", "data": job},
        {"type": "applying-diff-time", "data": {**job, "duration": 541}},
        {"type": "failure", "data": {**job, "details": {
            "type": "bad", "column": "day", "value": "x", "record": 7, "expectedType": ["date", "text"]}}},
        {"type": "finished", "data": {**job, "inserted": 1, "updated": 0, "deleted": 1, "errors": 0}},
        {"type": "finished", "data": {**job, "inserted": 9}},
        {"type": "only a type"},
    ]
    path = tmp_path / "log.json"
    path.write_text(json.dumps(events, indent=1))
    return str(path)


def test_job_log(spark, tmp_path):
    log = scan_job_log(spark, job_log(tmp_path))
    assert [r.type for r in log.orderBy("pos").collect()][0] == "Committing-Job"
    assert log.count() == 8
    assert [tuple(r) for r in joblog.crud_counts(log).collect()] == [("j1", 1, 0, 1, 0)]
    failures = [(r.column, r.record, r.expected_type) for r in joblog.failure_details(log).collect()]
    assert failures == [("day", 7, "date"), ("day", 7, "text")]
    submissions = spark.createDataFrame(
        [("d1", "u1"), ("d1", "u2"), ("d1", "u3"), ("d9", "u1")], "dataset_id string, opaque string")
    states = joblog.commit_state(submissions, log, log)
    assert {(r.dataset_id, r.opaque): r.state for r in states.collect()} == {
        ("d1", "u1"): "COMMITTED", ("d1", "u2"): "COMMITTING", ("d1", "u3"): "NOT_COMMITTING",
        ("d9", "u1"): "UNKNOWN"}
    no_log = log.filter("job_id != 'j2'")
    taken = joblog.commit_state(submissions, log, no_log).filter("opaque = 'u2'").first()
    assert taken.state == "UNKNOWN"


def test_progress(spark):
    df = spark.createDataFrame([(1, 3, "reading"), (1, 0, "SUCCESS: ok"), (None, 5, "FAILURE")],
                               "rows int, total int, english string")
    assert [(r.percent, r.outcome) for r in joblog.progress(df).collect()] == [
        (33, None), (None, "SUCCESS"), (None, "PUBLISH_ERROR")]


def test_run_log(spark, tmp_path):
    schema = ("run_at timestamp, dataset_id string, file string, method string, job_file string, "
              "rows_updated bigint, rows_created bigint, rows_deleted bigint, is_error boolean, message string")
    path = str(tmp_path / "log")
    rows = [(None, "a", "f", "upsert", None, 1, None, None, False, "x"),
            (None, "a", "f", "Upsert", None, None, None, None, True, "broken")]
    for row in rows:
        append_run_log(spark.createDataFrame([row], schema), path)
    got = sorted((str(r.Success), r.Errors or "", r.RowsUpdated, r.RowsCreated) for r in read_run_log(spark, path).collect())
    assert got == [("None", "broken", 0, 0), ("True", "", 1, 0)]
    summary = joblog.run_summary(read_run_log(spark, path)).first()
    assert (summary.runs, summary.succeeded, summary.failed, summary.rows_updated) == (2, 1, 1, 1)


def test_statistics(spark):
    df = spark.createDataFrame([(1, "a", None), (3, "bbb", 2.0), (None, None, 2.0)], "n int, s string, d double")
    got = {r.column_name: r for r in profile.column_statistics(df, exact=True).collect()}
    assert (got["n"].rows, got["n"].nulls, got["n"].mean, got["n"].largest) == (3, 1, 2.0, "3")
    assert (got["s"].shortest, got["s"].longest, got["s"].distinct_values) == (1, 3, 2)
    assert got["d"].distinct_values == 1 and got["d"].smallest == "2.0"
    empty = {r.column_name: r for r in profile.column_statistics(df.limit(0)).collect()}
    assert empty["n"].rows == 0 and empty["n"].mean is None


def test_datetimes_without_a_date_column(spark):
    rows = spark.createDataFrame([("a",)], "name string")
    found = checks.check_datetimes(rows, {"name": "text"}, FileControl())
    assert found.columns == ["name", "column", "value", "status"] and found.count() == 0


def test_ignored_headers_are_not_extra(spark):
    headers = spark.createDataFrame([(1, 9, "id"), (1, 9, " Note ")], "file_id int, dataset_id int, name string")
    columns = spark.createDataFrame([(9, "id", 0, True)], "dataset_id int, field_name string, pos int, is_row_id boolean")
    ignored = spark.createDataFrame([(1, "note")], "file_id int, name string")
    assert checks.check_columns(headers, columns).count() == 1
    assert checks.check_columns(headers, columns, ignored).count() == 0
