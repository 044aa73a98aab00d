"""Registered queries: errors, publishing, change detection, copies and whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.control import Control, generate_control
from rowharbor.operators import delta, joblog, publish
from rowharbor.operators.errors import drop_uninterpretable, error_report, split_errors
from rowharbor.operators.port import compare_schemas, copy_all, copy_data, materialise_grouped_view
from rowharbor.operators.shape import clean_cells, drop_system_columns
from rowharbor.operators.typing import ERRORS, cast_types
from rowharbor.plans import jobs
from rowharbor.plans.registry import as_delimited, in_order, query, table
from rowharbor.plans.scan_queries import ORDERS, PLAIN
from rowharbor.runtime import field, materialise, scratch_path
from rowharbor.sources.delimited import scan_delimited, with_position, with_record_no
from rowharbor.sources.sinks import (
    append_run_log,
    read_run_log,
    run_log_rows,
    write_set_aside,
)
from rowharbor.sources.store import DatasetStore, table_fingerprint, write_dataset

# Orders whose day cannot be read: 1 in 15 of all.
DAMAGED_SQL = "(o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"


def _damaged():
    return (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")


def damaged_orders(spark, sf_dir, bad=None):
    """Orders as a CSV export in key order, some with a day nobody can read; typed, with errors."""
    day = F.when(_damaged() if bad is None else bad, "soon").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    orders = in_order(table(spark, sf_dir, "orders"), "o_orderkey").withColumn("o_orderdate", day)
    rows = scan_delimited(spark, as_delimited(orders, "damaged"), PLAIN)
    return cast_types(clean_cells(rows, PLAIN), ORDERS, PLAIN)


@query(f"SELECT * FROM orders WHERE NOT {DAMAGED_SQL}")
def set_aside_good(spark, sf_dir):
    good, _ = split_errors(damaged_orders(spark, sf_dir))
    return good.select(*ORDERS)


@query(f"""
SELECT o_orderkey, 'o_orderdate' AS "column", 'soon' AS "value" FROM orders WHERE {DAMAGED_SQL}
""")
def set_aside_bad(spark, sf_dir):
    """Bad rows stored for inspection and read back."""
    _, bad = split_errors(damaged_orders(spark, sf_dir))
    path = scratch_path(spark, "set-aside")
    write_set_aside(bad, path)
    stored = spark.read.schema(bad.schema).parquet(path)
    return stored.select("o_orderkey", F.explode(ERRORS).alias("e")).select(
        "o_orderkey", "e.column", "e.value"
    )


@query(f"""
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) + 1 AS line FROM orders)
SELECT line, 'Cannot read ''soon'' in column ''o_orderdate'' as calendar_date (line '
       || line::VARCHAR || ' of file)' AS message
FROM numbered WHERE {DAMAGED_SQL}
""")
def error_lines(spark, sf_dir):
    staged = materialise(damaged_orders(spark, sf_dir), "parsed")
    return error_report(staged, whole_folder=True).select("line", "message")


@query("SELECT * FROM orders WHERE o_totalprice <= 490000")
def drop_ten_percent(spark, sf_dir):
    """A few bad rows, within what the policy tolerates."""
    damaged = damaged_orders(spark, sf_dir, F.col("o_totalprice") > 490000)
    return drop_uninterpretable(materialise(damaged, "parsed"), "TenPercent").select(*ORDERS)


# Stored: orders placed before 2000. Incoming: orders placed from 1998 on, 1000 dearer, with the
# priority left empty where the status is P.
STORED_SQL = "stored AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
INCOMING_SQL = """incoming AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 AS o_totalprice, o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""


def stored_orders(spark, sf_dir):
    placed = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").filter(placed)


def incoming_orders(spark, sf_dir):
    placed = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return (
        table(spark, sf_dir, "orders").filter(placed)
        .withColumn("o_totalprice", F.col("o_totalprice") + 1000)
        .withColumn("o_orderpriority", priority)
    )


def shown(df):
    """A publish result with its action under a plain name."""
    return df.withColumnRenamed(publish.ACTION, "action")


@query(f"""
WITH {INCOMING_SQL} SELECT *, 'created' AS action FROM incoming
""")
def replace(spark, sf_dir):
    return shown(publish.replace(stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)))


def upsert_sql(mode: str) -> str:
    def value(c: str) -> str:
        if c == "o_orderkey":
            return "coalesce(i.o_orderkey, s.o_orderkey) AS o_orderkey"
        if mode == "patch":
            return f"coalesce(i.{c}, s.{c}) AS {c}"
        return f"CASE WHEN i.o_orderkey IS NOT NULL THEN i.{c} ELSE s.{c} END AS {c}"

    columns = ", ".join(value(c) for c in ORDERS)
    return f"""
WITH {STORED_SQL}, {INCOMING_SQL}
SELECT {columns},
       CASE WHEN i.o_orderkey IS NULL THEN 'unchanged'
            WHEN s.o_orderkey IS NULL THEN 'created' ELSE 'updated' END AS action
FROM stored s FULL JOIN incoming i ON s.o_orderkey = i.o_orderkey"""


@query(upsert_sql("patch"))
def upsert_patch(spark, sf_dir):
    return shown(
        publish.upsert(stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir), "o_orderkey")
    )


@query(upsert_sql("patch"))
def upsert_few(spark, sf_dir):
    """The form for few incoming rows, which leaves the table unshuffled where they fit."""
    stored, incoming = stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)
    return shown(publish.upsert(stored, incoming, "o_orderkey", few=True))


@query(upsert_sql("full"))
def upsert_full(spark, sf_dir):
    stored, incoming = stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)
    return shown(publish.upsert(stored, incoming, "o_orderkey", "full"))


@query(f"""
WITH {STORED_SQL}, {INCOMING_SQL}
SELECT *, 'unchanged' AS action FROM stored UNION ALL SELECT *, 'created' FROM incoming
""")
def append(spark, sf_dir):
    return shown(publish.append(stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)))


@query(f"""
WITH {STORED_SQL}, {INCOMING_SQL}
SELECT *, 'unchanged' AS action FROM stored
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)
""")
def delete_ids(spark, sf_dir):
    """Ids come as text; many of them are not stored."""
    ids = incoming_orders(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("id"))
    return shown(publish.delete(stored_orders(spark, sf_dir), ids, "o_orderkey"))


@query("""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
""")
def last_write_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return publish.last_by_key(events, "user_id", [F.col("ts"), F.col("event_id")])


_LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus")


_LAST_LINES_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {", ".join(c + " DESC" for c in _LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1
"""


@query(_LAST_LINES_SQL)
def last_write_wins_lines(spark, sf_dir):
    """A two-column key that repeats."""
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col(c) for c in _LINE_ORDER]
    return publish.last_by_key(lines, ["l_orderkey", "l_linenumber"], order)


@query(_LAST_LINES_SQL)
def last_of_few_repeats(spark, sf_dir):
    """The form for keys that seldom repeat."""
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col(c) for c in _LINE_ORDER]
    return publish.last_of_few_repeats(lines, ["l_orderkey", "l_linenumber"], order)


@query(_LAST_LINES_SQL)
def last_write_wins_scan(spark, sf_dir):
    """Repeated keys of a file: the record that stands last counts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_ORDER)
    path = as_delimited(in_order(lines, *_LINE_ORDER), "lines")
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    staged = materialise(scan_delimited(spark, path, PLAIN), "lines-scanned")
    last = publish.last_by_position(with_position(staged, "_at"), ["l_orderkey", "l_linenumber"], "_at")
    return last.select(*[F.col(c).cast(kinds[c]).alias(c) for c in table(spark, sf_dir, "lineitem").columns])


def _actions(spark, sf_dir):
    """Damaged orders against the stored ones."""
    numbered = with_record_no(damaged_orders(spark, sf_dir), whole_folder=True)
    return publish.actions(stored_orders(spark, sf_dir), numbered, "o_orderkey", "upsert")


_ACTION_SQL = f"""
WITH t AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch,
                  {DAMAGED_SQL} AS bad,
                  o_orderdate < TIMESTAMP '2000-01-01' AS known
           FROM orders)
SELECT {{batch}} count(*) FILTER (WHERE NOT bad AND NOT known) AS rows_created,
       count(*) FILTER (WHERE NOT bad AND known) AS rows_updated,
       0::BIGINT AS rows_deleted,
       count(*) FILTER (WHERE bad) AS errors{{more}}
FROM t"""


@query(_ACTION_SQL.format(batch="batch,", more="") + " GROUP BY batch")
def batch_results(spark, sf_dir):
    return publish.batch_results(_actions(spark, sf_dir), 1000)


@query(_ACTION_SQL.format(batch="", more=", 'PUBLISH_ERROR' AS status"))
def publish_summary(spark, sf_dir):
    return publish.publish_summary(_actions(spark, sf_dir))


@query(f"""
WITH {STORED_SQL}, {INCOMING_SQL}
SELECT count(*) FILTER (WHERE s.o_orderkey IS NOT NULL) AS rows_deleted,
       count(*) FILTER (WHERE s.o_orderkey IS NULL) AS unknown_ids
FROM incoming i LEFT JOIN stored s ON s.o_orderkey = i.o_orderkey
""")
def delete_counts(spark, sf_dir):
    done = publish.actions(
        stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir), "o_orderkey", "delete"
    )
    return done.agg(
        F.count_if(F.col("action") == "deleted").alias("rows_deleted"),
        F.count_if(F.col("action") == "unknown").alias("unknown_ids"),
    )


# Changes: what upsert_full would leave, against what was stored; orders of status O are gone.
_NEW_SQL = f"""{STORED_SQL}, {INCOMING_SQL}, fresh AS (
  SELECT * FROM incoming
  UNION ALL SELECT * FROM stored WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus <> 'O')"""


def fresh_orders(spark, sf_dir):
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    kept = stored_orders(spark, sf_dir).filter(old & (F.col("o_orderstatus") != "O"))
    return incoming_orders(spark, sf_dir).unionByName(kept)


@query(f"""
WITH {_NEW_SQL}
SELECT coalesce(f.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN 'inserted' WHEN f.o_orderkey IS NULL THEN 'deleted'
            WHEN (f.o_totalprice, f.o_orderdate, f.o_custkey, f.o_orderstatus)
                 IS DISTINCT FROM (s.o_totalprice, s.o_orderdate, s.o_custkey, s.o_orderstatus)
                 OR f.o_orderpriority IS DISTINCT FROM s.o_orderpriority THEN 'updated'
            ELSE 'unchanged' END AS change
FROM stored s FULL JOIN fresh f ON s.o_orderkey = f.o_orderkey
""")
def delta_keyed(spark, sf_dir):
    return delta.keyed_changes(
        stored_orders(spark, sf_dir), fresh_orders(spark, sf_dir), "o_orderkey"
    )


@query(f"WITH {_NEW_SQL} SELECT * FROM fresh")
def apply_delta(spark, sf_dir):
    """The previous version with the changes applied is the new version."""
    prev, new = stored_orders(spark, sf_dir), fresh_orders(spark, sf_dir)
    changes = materialise(delta.delta(prev, new, "o_orderkey"), "delta")
    return delta.apply_delta(prev, changes, "o_orderkey")


# Without a key: order lines reduced to three columns, so that rows repeat.
LINES_SQL = """old AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_discount FROM lineitem),
new AS (SELECT l_returnflag, l_linestatus, l_linenumber,
               CASE WHEN l_quantity > 40 THEN l_tax ELSE l_discount END AS l_discount
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01')"""


def line_versions(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    names = ["l_returnflag", "l_linestatus", "l_linenumber"]
    changed = F.when(F.col("l_quantity") > 40, F.col("l_tax")).otherwise(F.col("l_discount"))
    recent = F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    new = lines.filter(recent).select(*names, changed.alias("l_discount"))
    return lines.select(*names, "l_discount"), new


@query(f"""
WITH {LINES_SQL}, net AS (
  SELECT l_returnflag, l_linestatus, l_linenumber, l_discount, sum(n) AS n FROM (
    SELECT *, 1 AS n FROM new UNION ALL SELECT *, -1 FROM old)
  GROUP BY ALL)
SELECT l_returnflag, l_linestatus, l_linenumber, l_discount,
       CASE WHEN n > 0 THEN 'inserted' ELSE 'deleted' END AS change, abs(n)::BIGINT AS copies
FROM net WHERE n <> 0
""")
def delta_multiset(spark, sf_dir):
    prev, new = line_versions(spark, sf_dir)
    return delta.delta_multiset(prev, new)


@query(f"WITH {LINES_SQL} SELECT * FROM new")
def apply_delta_multiset(spark, sf_dir):
    prev, new = line_versions(spark, sf_dir)
    changes = materialise(delta.delta_multiset(prev, new), "delta")
    return delta.apply_delta_multiset(prev, changes)


@query("""
SELECT c_custkey, sha256('{"c_custkey":' || c_custkey::VARCHAR || ',"c_name":"' || c_name
       || '","c_mktsegment":' || CASE WHEN c_nationkey < 5 THEN 'null'
                                      ELSE '"' || c_mktsegment || '"' END || '}') AS signature
FROM customer
""")
def row_signatures(spark, sf_dir):
    segment = F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", segment.alias("c_mktsegment")
    )
    return rows.select("c_custkey", delta.row_signature(rows.columns).alias("signature"))


@query("""
SELECT user_id AS dataset_id,
       arg_max('completed/' || strftime(ts, '%Y/') || month(ts)::VARCHAR || '/' || day(ts)::VARCHAR
               || '/signatures/' || strftime(ts, '%H:%M:%S.%f') || '-' || event_type, ts) AS path
FROM events GROUP BY user_id
""")
def latest_snapshot(spark, sf_dir):
    """Listings with URL-encoded times, as a storage service gives them."""
    path = F.concat(
        F.lit("completed/"), F.date_format("ts", "yyyy/M/d"), F.lit("/signatures/"),
        F.date_format("ts", "HH'%3A'mm'%3A'ss.SSSSSS"), F.lit("-"), "event_type",
    )
    return delta.latest_snapshot(
        table(spark, sf_dir, "events").select(F.col("user_id").alias("dataset_id"), path.alias("path"))
    )


@query("""
SELECT 'lineitem' AS dataset, count(*) AS rows, true AS verified FROM lineitem
UNION ALL SELECT 'orders', count(*), true FROM orders
UNION ALL SELECT 'documents', count(*), true FROM documents
""")
def verify_publish(spark, sf_dir):
    """Tables written as datasets and checked against what was meant to be written."""
    checked = None
    for name in ("lineitem", "orders", "documents"):
        source, path = table(spark, sf_dir, name), scratch_path(spark, name)
        write_dataset(source, path)
        found = table_fingerprint(spark.read.schema(source.schema).parquet(path))
        both = table_fingerprint(source).unionByName(found)
        one = both.agg(F.max("rows").alias("rows"), F.count_distinct(F.struct("*")).alias("kinds"))
        one = one.select(
            F.lit(name).alias("dataset"), "rows", (F.col("kinds") == 1).alias("verified")
        )
        checked = one if checked is None else checked.unionByName(one)
    return checked


@query("""
SELECT l_returnflag, l_linestatus, count(l_orderkey) AS count_l_orderkey,
       sum(l_quantity) AS sum_l_quantity, min(l_shipdate) AS min_l_shipdate,
       max(l_extendedprice) AS max_l_extendedprice, avg(l_linenumber) AS avg_l_linenumber
FROM lineitem GROUP BY ALL
""")
def grouped_view(spark, sf_dir):
    return materialise_grouped_view(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"l_orderkey": "count", "l_quantity": "sum", "l_shipdate": "min",
         "l_extendedprice": "max", "l_linenumber": "avg"},
    )


# Catalogue relations drawn from the orders: each customer is a dataset, the priorities it uses
# are its columns, typed by how they are spelt.
COLUMNS_SQL = """dataset_columns AS (
  SELECT o_custkey AS dataset_id,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) - 1 AS pos,
         o_orderpriority AS field_name,
         CASE WHEN o_orderpriority < '3' THEN 'text' WHEN o_orderpriority < '4' THEN 'location'
              WHEN o_orderpriority < '5' THEN 'point' ELSE 'number' END AS type
  FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders))"""


def dataset_columns(spark, sf_dir):
    used = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()
    p = F.col("field_name")
    # a customer has as many columns as there are priorities, so ranking is a count
    listed = used.groupBy(F.col("o_custkey").alias("dataset_id")).agg(
        F.array_sort(F.collect_set("o_orderpriority")).alias("_names")
    )
    kind = (
        F.when(p < "3", "text").when(p < "4", "location").when(p < "5", "point").otherwise("number")
    )
    return listed.select("dataset_id", F.posexplode("_names").alias("pos", "field_name")).select(
        "dataset_id", "pos", "field_name", kind.alias("type")
    )


@query(f"""
WITH {COLUMNS_SQL}, shapes AS (
  SELECT dataset_id, string_agg(field_name || ':' || type, ',' ORDER BY pos) AS shape
  FROM dataset_columns GROUP BY dataset_id)
SELECT c.c_custkey AS source_id, c.c_custkey + 1 AS sink_id,
       CASE WHEN a.shape IS NOT DISTINCT FROM b.shape THEN 'SUCCESS' ELSE 'INVALID_SCHEMAS' END AS status
FROM customer c LEFT JOIN shapes a ON a.dataset_id = c.c_custkey
                LEFT JOIN shapes b ON b.dataset_id = c.c_custkey + 1
""")
def schemas_alike(spark, sf_dir):
    pairs = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("source_id"), (F.col("c_custkey") + 1).alias("sink_id")
    )
    return compare_schemas(pairs, dataset_columns(spark, sf_dir))


@query("SELECT * FROM supplier")
def copy_all_rows(spark, sf_dir):
    source = table(spark, sf_dir, "supplier").withColumn(":created_at", F.current_timestamp())
    return drop_system_columns(copy_all(source))


@query(f"WITH {STORED_SQL}, {INCOMING_SQL} SELECT * FROM incoming")
def copy_replace(spark, sf_dir):
    source, sink = incoming_orders(spark, sf_dir), stored_orders(spark, sf_dir)
    return drop_system_columns(copy_data(source, sink, method="replace"))


@query(f"SELECT * EXCLUDE (action) FROM ({upsert_sql('patch')})")
def copy_upsert(spark, sf_dir):
    source, sink = incoming_orders(spark, sf_dir), stored_orders(spark, sf_dir)
    return drop_system_columns(copy_data(source, sink, "o_orderkey"))


def store_with_orders(spark, sf_dir, signed=False):
    store = DatasetStore(spark, scratch_path(spark, "store"))
    jobs.create_dataset(store, "orde-rs01", stored_orders(spark, sf_dir), "o_orderkey", signed=signed)
    return store


def _publish_csv(spark, sf_dir, method):
    """A whole job: control, scan, clean, type, merge, write, verify, publish."""
    store = store_with_orders(spark, sf_dir)
    path = as_delimited(incoming_orders(spark, sf_dir), "incoming")
    control = generate_control("incoming.csv", method)
    split = Control(control.action, None, control.file.with_options(multi_line=False))
    result = jobs.publish_file(store, "orde-rs01", path, split, ORDERS, "o_orderkey")
    return store, result


@query(f"SELECT * EXCLUDE (action) FROM ({upsert_sql('patch')})")
def publish_file_upsert(spark, sf_dir):
    store, _ = _publish_csv(spark, sf_dir, "upsert")
    return store.read("orde-rs01")


@query(f"""
WITH {STORED_SQL}, {INCOMING_SQL}
SELECT 'orde-rs01' AS "DatasetID", 'upsert' AS "PublishMethod",
       count(*) FILTER (WHERE s.o_orderkey IS NULL) AS "RowsCreated",
       count(*) FILTER (WHERE s.o_orderkey IS NOT NULL) AS "RowsUpdated",
       0::BIGINT AS "RowsDeleted", true AS "Success"
FROM incoming i LEFT JOIN stored s ON s.o_orderkey = i.o_orderkey
""")
def run_log_of_publish(spark, sf_dir):
    """The run-log row a published file leaves behind."""
    _, result = _publish_csv(spark, sf_dir, "upsert")
    log = scratch_path(spark, "run-log")
    append_run_log(jobs.result_frame(spark, result, "incoming.csv"), log)
    return read_run_log(spark, log).select(
        "DatasetID", "PublishMethod", "RowsCreated", "RowsUpdated", "RowsDeleted", "Success"
    )


@query(f"WITH {_NEW_SQL} SELECT * FROM fresh")
def replace_by_changes(spark, sf_dir):
    """A replace whose changes are found first and reported, as a whole job."""
    store = store_with_orders(spark, sf_dir, signed=True)
    jobs.replace_by_delta(store, "orde-rs01", fresh_orders(spark, sf_dir), "o_orderkey")
    return store.read("orde-rs01")


@query(f"""
WITH {STORED_SQL}, {INCOMING_SQL}, touched AS (
  SELECT i.o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN 'inserted' ELSE 'updated' END AS change,
         s.o_orderkey IS NOT NULL AND s.o_orderstatus IS NOT DISTINCT FROM coalesce(i.o_orderstatus, s.o_orderstatus)
         AND s.o_custkey IS NOT DISTINCT FROM coalesce(i.o_custkey, s.o_custkey)
         AND s.o_totalprice IS NOT DISTINCT FROM coalesce(i.o_totalprice, s.o_totalprice)
         AND s.o_orderdate IS NOT DISTINCT FROM coalesce(i.o_orderdate, s.o_orderdate)
         AND s.o_orderpriority IS NOT DISTINCT FROM coalesce(i.o_orderpriority, s.o_orderpriority) AS same
  FROM incoming i LEFT JOIN stored s ON s.o_orderkey = i.o_orderkey
)
SELECT o_orderkey, change FROM touched WHERE NOT same
""")
def version_changes(spark, sf_dir):
    """The keys that an upsert of a file really changed, from the signatures kept beside two versions."""
    store = store_with_orders(spark, sf_dir, signed=True)
    path = as_delimited(incoming_orders(spark, sf_dir), "incoming")
    jobs.publish_file(store, "orde-rs01", path, generate_control("incoming.csv", "upsert"), ORDERS, "o_orderkey")
    return jobs.version_changes(store, "orde-rs01", 1, 2)


def _merged_sql(name: str, number: bool) -> str:
    bounds = f"min({name})::DOUBLE AS smallest, max({name})::DOUBLE AS largest" if number else "NULL::DOUBLE AS smallest, NULL::DOUBLE AS largest"
    texts = "NULL::INT AS shortest, NULL::INT AS longest" if number else f"min(length({name}))::INT AS shortest, max(length({name}))::INT AS longest"
    mean = f"round(sum({name}::DECIMAL(38,6))::DOUBLE / count({name}), 3)" if number else "NULL::DOUBLE"
    return f"""SELECT '{name}' AS column_name, count(*) AS "rows", count(*) - count({name}) AS nulls, {bounds}, {texts},
        {mean} AS mean, true AS distinct_close, {"true" if number else "NULL"} AS median_close FROM after"""


_MERGED = {"o_orderkey": True, "o_custkey": True, "o_totalprice": True, "o_orderstatus": False, "o_orderpriority": False}


@query(f"WITH after AS (SELECT * EXCLUDE (action) FROM ({upsert_sql('patch')})) "
       + " UNION ALL ".join(_merged_sql(n, number) for n, number in _MERGED.items()))
def merged_statistics(spark, sf_dir):
    """Statistics kept of each bucket when it was written, merged after an upsert. Distinct counts must be
    within 5 % of the exact ones, medians within 2 % of the ranks."""
    store = DatasetStore(spark, scratch_path(spark, "store"))
    jobs.create_dataset(store, "orde-rs01", stored_orders(spark, sf_dir), "o_orderkey", statistics=True)
    path = as_delimited(incoming_orders(spark, sf_dir), "incoming")
    made = generate_control("incoming.csv", "upsert")
    control = Control(made.action, None, made.file.with_options(column_statistics=True))
    jobs.publish_file(store, "orde-rs01", path, control, ORDERS, "o_orderkey")
    found = materialise(store.statistics("orde-rs01").filter(F.col("column_name").isin(*_MERGED)), "statistics")
    table_now = store.read("orde-rs01")
    rows = reduce(DataFrame.unionByName, [_exact(table_now, found, n, number) for n, number in _MERGED.items()])
    close = F.abs(F.col("distinct_values") - F.col("d")) <= F.col("d") * 0.05
    return found.join(rows, "column_name").select(
        "column_name", "rows", "nulls", "smallest", "largest", "shortest", "longest", F.round("mean", 3).alias("mean"),
        close.alias("distinct_close"), "median_close")


def _exact(rows, found, name, number):
    """A column's exact count of distinct values, and whether the median found lies between the exact
    percentiles 0.48 and 0.52. Only its distinct values are shuffled, and ranks counted: the percentile of a share is at
    or next to the value at place ``share * (n - 1)``, from 0, and no value lies between those two."""
    values = rows.groupBy(field(name)).agg(F.count(F.lit(1)).alias("k")).filter(field(name).isNotNull())
    median = found.filter(F.col("column_name") == name).select(F.col("p50").alias("m"))
    x = field(name).cast("double") if number else F.lit(None).cast("double")
    counted = values.crossJoin(F.broadcast(median)).agg(
        F.count(F.lit(1)).alias("d"), F.max("m").alias("m"), F.sum("k").alias("n"),
        F.sum(F.when(x < F.col("m"), F.col("k")).otherwise(0)).alias("below"),
        F.sum(F.when(x <= F.col("m"), F.col("k")).otherwise(0)).alias("upto"))
    low, high = (f((F.col("n") - 1) * F.lit(p)) for f, p in ((F.ceil, 0.48), (F.floor, 0.52)))
    within = (F.col("upto") > low) & (F.col("below") <= high)
    return counted.select(F.lit(name).alias("column_name"), "d", F.when(F.col("m").isNotNull(), within).alias("median_close"))


def _repeating_orders(spark, sf_dir):
    """Every order; open ones come again with another priority, pending ones without their key."""
    orders = table(spark, sf_dir, "orders")
    again = orders.filter("o_orderstatus = 'O'").withColumn("o_orderpriority", F.lit("LATER"))
    lost = orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.lit(None).cast("bigint"))
    parts = [d.withColumn("at", F.lit(i)) for i, d in enumerate((orders, again, lost))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _replace_repeating(spark, sf_dir):
    store = DatasetStore(spark, scratch_path(spark, "store"))
    jobs.create_dataset(store, "orde-rs01", table(spark, sf_dir, "orders"), "o_orderkey", signed=True)
    rows = _repeating_orders(spark, sf_dir)
    return store, jobs.replace_by_delta(store, "orde-rs01", rows, "o_orderkey", F.col("at"))


@query("""
SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN 'LATER' ELSE o_orderpriority END AS o_orderpriority)
FROM orders
""")
def delta_repeated_keys(spark, sf_dir):
    """A replace by changes from rows that repeat keys or lack them."""
    return _replace_repeating(spark, sf_dir)[0].read("orde-rs01")


@query("""
SELECT 0::BIGINT AS rows_created, count(*) FILTER (WHERE o_orderstatus = 'O') AS rows_updated,
       0::BIGINT AS rows_deleted, count(*) FILTER (WHERE o_orderstatus = 'P') AS errors FROM orders
""")
def delta_repeated_counts(spark, sf_dir):
    """What that replace reports."""
    result = _replace_repeating(spark, sf_dir)[1]
    names = ("rows_created", "rows_updated", "rows_deleted", "errors")
    # the counts are the job's result, drawn from the orders it published
    return table(spark, sf_dir, "orders").limit(1).select(
        *[F.lit(getattr(result, n)).cast("bigint").alias(n) for n in names]
    )


@query("""
SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN 'LATER' ELSE o_orderpriority END AS o_orderpriority)
FROM orders
""")
def copy_repeated_keys(spark, sf_dir):
    """A copy by upsert from a source that repeats keys."""
    source = _repeating_orders(spark, sf_dir).filter("o_orderkey is not null")
    ordered = source.withColumnRenamed("at", ":at")
    target = table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'")
    return drop_system_columns(copy_data(ordered, target, "o_orderkey", order=F.col("`:at`")))


@query("""
SELECT o_custkey AS dataset_id, lower(o_orderstatus) AS method, count(*) AS runs,
       count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS succeeded,
       count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS failed,
       sum(o_orderkey)::BIGINT AS rows_created, 0::BIGINT AS rows_deleted, max(o_orderdate) AS last_run
FROM orders GROUP BY ALL
""")
def run_summary(spark, sf_dir):
    """Run-log rows of many jobs, summed up per dataset and method."""
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("run_at"),
        F.col("o_custkey").alias("dataset_id"),
        F.lit("in.csv").alias("file"),
        F.col("o_orderstatus").alias("method"),
        F.lit(None).cast("string").alias("job_file"),
        F.col("o_orderkey").alias("rows_created"),
        F.lit(0).alias("rows_updated"),
        F.lit(None).cast("bigint").alias("rows_deleted"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_error"),
        F.lit("no").alias("message"),
    )
    return joblog.run_summary(run_log_rows(runs)).drop("rows_updated")


@query("""
SELECT 'part' AS dataset, count(*) AS rows FROM part
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'pages', count(*) FROM pages
""")
def row_counts(spark, sf_dir):
    counted = None
    for name in ("part", "events", "pages"):
        one = table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted
