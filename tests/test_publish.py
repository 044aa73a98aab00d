"""Publishing goldens: counts and totals of replace, upsert, append, delete and their errors."""

from datetime import datetime

import pytest

from rowharbor.control import Control, generate_control
from rowharbor.operators.errors import UninterpretableRows, error_report
from rowharbor.operators.publish import actions, batch_results, publish_summary
from rowharbor.plans.jobs import (
    PublishRefused,
    create_dataset,
    port_dataset,
    prepare_rows,
    publish_file,
    replace_by_delta,
)
from rowharbor.runtime import materialise
from rowharbor.sources.delimited import scan_delimited, with_record_no
from rowharbor.sources.store import DatasetStore

TYPES = {"id": "bigint", "name": "text", "another_name": "text", "date": "calendar_date"}
SCHEMA = "id bigint, name string, another_name string, date timestamp_ntz"
TWO = [(1, "ann", "x", datetime(2020, 1, 1)), (2, "bob", "y", datetime(2020, 1, 2))]
THREE = [*TWO, (3, "cy", "z", datetime(2020, 1, 3))]


@pytest.fixture()
def store(spark, tmp_path):
    return DatasetStore(spark, str(tmp_path / "store"), deep_check=True)


def put(store, rows, dataset_id="ab12-cd34"):
    create_dataset(store, dataset_id, store.spark.createDataFrame(rows, SCHEMA))
    return dataset_id


def csv(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


HEADER = "id,name,another_name,date\n"


def run(store, tmp_path, text, method, key="id", name="in.csv", header=True):
    control = generate_control(name, method, has_header_row=header)
    return publish_file(store, "ab12-cd34", csv(tmp_path, text, name), control, TYPES, key)


def rows(store):
    return sorted(tuple(r) for r in store.read("ab12-cd34").collect())


def test_replace(store, tmp_path):
    put(store, THREE)
    got = run(store, tmp_path, HEADER + "7,a,b,04/30/2011\n8,c,d,05/01/2011\n", "replace")
    assert (got.rows_created, got.errors) == (2, 0)
    assert rows(store) == [
        (7, "a", "b", datetime(2011, 4, 30)), (8, "c", "d", datetime(2011, 5, 1))
    ]


def test_upsert_counts_and_sparse_cells(store, tmp_path):
    put(store, TWO)
    got = run(store, tmp_path, HEADER + "1,ann,x,2020-01-01\n2,,new,\n3,cy,z,01/03/2020\n", "upsert")
    assert (got.rows_updated, got.rows_created, got.errors) == (2, 1, 0)
    assert rows(store) == [TWO[0], (2, "bob", "new", datetime(2020, 1, 2)), THREE[2]]


def test_upsert_of_nothing(store, tmp_path):
    put(store, THREE)
    got = run(store, tmp_path, HEADER.strip(), "upsert")
    assert (got.rows_updated, got.rows_created, got.errors) == (0, 0, 0)
    assert rows(store) == THREE


def test_tsv_without_header(store, tmp_path):
    put(store, TWO)
    got = run(store, tmp_path, '3\t"cy"\tz\t01/03/2020\n', "upsert", name="in.tsv", header=False)
    assert got.rows_created == 1
    assert rows(store)[2] == (3, '"cy"', "z", datetime(2020, 1, 3))


def test_display_names_as_header(store, tmp_path):
    put(store, TWO)
    got = run(store, tmp_path, 'ID, Name ,"Another Name",Date\n3,cy,z,01/03/2020\n', "upsert")
    assert (got.rows_created, got.errors) == (1, 0)
    assert rows(store)[2] == THREE[2]


@pytest.mark.parametrize("text,method,key,message", [
    ("id,name,another_name,date,more\n", "upsert", "id", "Extra Columns"),
    ("id,id,name\n1,2,x\n", "upsert", "id", "Extra Columns"),
    ("name\nx\n", "upsert", "id", "Missing Row Identifier"),
    ("name\nx\n", "replace", "id", "Missing Row Identifier"),
    ("id,name\n1,x\n", "replace", None, "Missing Fields: not mapped: another_name, date"),
])
def test_files_that_do_not_fit(store, tmp_path, text, method, key, message):
    put(store, TWO)
    with pytest.raises(PublishRefused, match=message):
        run(store, tmp_path, text, method, key)
    assert rows(store) == TWO


def test_partial_replace_with_key(store, tmp_path):
    put(store, TWO)
    assert run(store, tmp_path, "id,name\n7,x\n", "replace").rows_created == 1
    assert rows(store) == [(7, "x", None, None)]


def test_field_mapped_twice_in_the_control(store, tmp_path):
    put(store, TWO)
    made = generate_control("in.csv", "upsert", ["id", "name", "name", "date"])
    path = csv(tmp_path, "a,b,c,d\n1,old,new,01/01/2020\n")
    got = publish_file(store, "ab12-cd34", path, made, TYPES, "id")
    assert got.rows_updated == 1 and rows(store)[0][1] == "new"


def test_last_write_wins(store, tmp_path):
    put(store, TWO)
    text = HEADER + "9,first,a,\n" + "9,second,b,\n" * 3 + "9,last,c,\n"
    got = run(store, tmp_path, text, "upsert")
    assert (got.rows_created, got.rows_updated) == (1, 0)
    assert rows(store)[2][1] == "last"


def test_replace_keeps_the_last_row_of_a_key(store, tmp_path):
    put(store, TWO)
    got = run(store, tmp_path, HEADER + "7,a,,\n7,b,,\n", "replace")
    assert got.rows_created == 1 and rows(store) == [(7, "b", None, None)]


def test_types_follow_from_the_dataset(store, tmp_path):
    put(store, TWO)
    path = csv(tmp_path, HEADER + "9,x,y,01/02/2020\n8,x,y,bad\n")
    got = publish_file(store, "ab12-cd34", path, generate_control("in.csv", "upsert"), key="id")
    assert (got.rows_created, got.errors) == (1, 1)
    assert rows(store)[2] == (9, "x", "y", datetime(2020, 1, 2))


def test_append_without_key(store, tmp_path):
    put(store, TWO)
    got = run(store, tmp_path, HEADER + "1,again,x,\n", "append", key=None)
    assert got.rows_created == 1 and len(rows(store)) == 3


@pytest.mark.parametrize("text,header,left", [("1\n2\n", False, 1), ("id\n123456\n1\n3\n4444\n", True, 1)])
def test_delete(store, tmp_path, text, header, left):
    put(store, THREE)
    got = run(store, tmp_path, text, "delete", header=header)
    assert (got.rows_deleted, got.errors, len(rows(store))) == (2, 0, left)


BAD = HEADER + "1,a,b,01/01/2020\n2,c,d,02/01/2020\n3,e,f,not a date\n"


def test_bad_date_is_skipped_and_reported(spark, store, tmp_path):
    put(store, TWO)
    got = run(store, tmp_path, BAD, "upsert")
    assert (got.errors, got.rows_updated, got.rows_created) == (1, 2, 0)
    assert got.status == "PUBLISH_ERROR"
    control = generate_control("in.csv", "upsert")
    scanned = scan_delimited(spark, csv(tmp_path, BAD), control.file)
    parsed = materialise(prepare_rows(scanned, control, TYPES, "id"), "parsed")
    report = error_report(parsed).collect()
    assert [(r.line, r.column, r.value) for r in report] == [(4, "date", "not a date")]
    assert report[0].message.endswith("(line 4 of file)")


def test_batches_of_two(spark, store, tmp_path):
    target = spark.createDataFrame(TWO, SCHEMA)
    text = HEADER + "1,a,b,bad\n2,c,d,02/01/2020\n3,e,f,bad\n"
    control = generate_control("in.csv", "upsert")
    scanned = with_record_no(scan_delimited(spark, csv(tmp_path, text), control.file))
    done = actions(target, prepare_rows(scanned, control, TYPES, "id"), "id", "upsert")
    per_batch = [tuple(r) for r in batch_results(done, 2).orderBy("batch").collect()]
    assert per_batch == [(0, 0, 1, 0, 1), (1, 0, 0, 0, 1)]
    assert tuple(publish_summary(done).first()) == (0, 1, 0, 2, "PUBLISH_ERROR")


def test_ten_percent_policy(spark, store, tmp_path):
    put(store, TWO)
    control = generate_control("in.csv", "upsert")
    strict = control.file.with_options(drop_uninterpretable_rows="TenPercent")
    with pytest.raises(UninterpretableRows):
        publish_file(store, "ab12-cd34", csv(tmp_path, BAD), Control("Upsert", None, strict), TYPES, "id")
    assert rows(store) == TWO


def test_replace_by_delta(spark, store):
    put(store, THREE)
    new = [THREE[0], (2, "bob", "changed", None), (4, "dee", None, None)]
    got = replace_by_delta(store, "ab12-cd34", spark.createDataFrame(new, SCHEMA), "id")
    assert (got.rows_created, got.rows_updated, got.rows_deleted) == (1, 1, 1)
    assert rows(store) == sorted(new)
    again = replace_by_delta(store, "ab12-cd34", spark.createDataFrame([*new, new[0]], SCHEMA), None)
    assert (again.rows_created, again.rows_updated, again.rows_deleted) == (1, 0, 0)
    assert len(rows(store)) == 4


def test_port(store):
    put(store, THREE)
    assert port_dataset(store, "ab12-cd34", "zz99-zz99", "schema").rows_created == 0
    assert store.read("zz99-zz99").count() == 0
    got = port_dataset(store, "ab12-cd34", "zz99-zz99", "data", "upsert", "id")
    assert got.rows_created == 3
    assert sorted(store.read("zz99-zz99").collect()) == sorted(store.read("ab12-cd34").collect())


def test_every_job_leaves_a_run_log_row(spark, store, tmp_path):
    """A job that publishes, one with bad cells, one that is refused, and one that fails."""
    put(store, TWO)
    log, report, aside = (str(tmp_path / t) for t in ("log", "report", "aside"))

    def job(text, action="upsert", **options):
        made = generate_control("in.csv", action)
        control = Control(made.action, None, made.file.with_options(set_aside_errors=True))
        return publish_file(store, "ab12-cd34", csv(tmp_path, text), control, TYPES, "id", run_log=log, job_file="a.job", report=report, **options)

    assert job(HEADER + "1,a,b,\n").report is None
    bad = job(HEADER + "3,c,d,04/30/2011\n\n9,a,b,never\n", set_aside=aside)
    assert (bad.errors, bad.status, bad.report) == (1, "PUBLISH_ERROR", report)
    lines = spark.read.parquet(report).collect()
    assert sorted((r["line"], r["column"], r["value"]) for r in lines) == [(3, "date", "never")]
    assert [r["record_no"] for r in spark.read.parquet(aside).collect()] == [1]
    with pytest.raises(PublishRefused):
        job("id,unheard\n1,2\n")
    with pytest.raises(Exception, match="(?i)action|method"):
        job(HEADER, "merge")
    rows = spark.read.parquet(log).orderBy("Date").collect()
    assert [(r["Success"], r["RowsCreated"], r["JobFile"]) for r in rows] == [
        (True, 0, "a.job"), (None, 1, "a.job"), (None, 0, "a.job"), (None, 0, "a.job")]
    assert rows[1]["Errors"] == "1 rows could not be read" and "Extra Columns" in rows[2]["Errors"]


def test_records_of_an_export_in_parts(spark, store, tmp_path):
    """Reports number the records through all files of a folder."""
    put(store, TWO)
    report, aside, folder = str(tmp_path / "report"), str(tmp_path / "aside"), tmp_path / "parts"
    folder.mkdir()
    csv(folder, HEADER + "3,c,d,\n4,c,d,never\n", "part-0.csv")
    csv(folder, HEADER + "5,c,d,soon\n6,c,d,\n7,c,d,late\n", "part-1.csv")
    made = generate_control("in.csv", "upsert")
    control = Control(made.action, None, made.file.with_options(set_aside_errors=True))
    done = publish_file(store, "ab12-cd34", str(folder), control, TYPES, "id", set_aside=aside, report=report, whole_folder=True)
    assert (done.rows_created, done.errors) == (2, 3)
    assert sorted((r["line"], r["value"]) for r in spark.read.parquet(report).collect()) == [(3, "never"), (4, "soon"), (6, "late")]
    assert sorted(r["record_no"] for r in spark.read.parquet(aside).collect()) == [1, 2, 4]
