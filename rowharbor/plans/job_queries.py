"""Registered queries: more whole jobs, each ending in what readers of the dataset see."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from rowharbor.control import Control, ControlError, generate_control, parse_control, parse_port_control
from rowharbor.operators import catalog
from rowharbor.operators.port import copy_catalog_rows
from rowharbor.operators.typing import ERRORS
from rowharbor.plans import jobs
from rowharbor.plans.catalogue_queries import catalog_rows
from rowharbor.plans.geo_queries import LAYERS_SQL, existing_layers
from rowharbor.plans.publish_queries import (
    INCOMING_SQL,
    LINES_SQL,
    STORED_SQL,
    incoming_orders,
    line_versions,
    store_with_orders,
    upsert_sql,
)
from rowharbor.plans.registry import as_delimited, in_order, query, table
from rowharbor.plans.scan_queries import ORDERS
from rowharbor.runtime import scratch_path
from rowharbor.sources.store import DatasetStore

CONTROL = {
    "action": "Replace",
    "opaque": "not needed here",
    "tsv": {
        "columns": ["o_orderkey", "day", "closed", "price", "lat", "lon", "remark"],
        "skip": 1,
        "quote": "\u0000",
        "ignoreColumns": ["remark", "lat", "lon", "never there"],
        "floatingTimestampFormat": "MM/dd/yyyy",
        "overrides": {"closed": {"timestampFormat": ["YYYY/MM"], "timezone": "PDT"}},
        "syntheticPoints": {"spot": {"type": "point", "latitude": "lat", "longitude": "lon"}},
    },
}


@query("""
SELECT o_orderkey, o_orderdate AS day,
       epoch_us(date_trunc('month', o_orderdate)) + 25200000000 AS closed_micros,
       o_totalprice AS price, o_totalprice / 10000 AS lat, o_custkey / 10 AS lon
FROM orders WHERE o_custkey / 10 <= 180
""")
def publish_with_control(spark, sf_dir):
    """A tab-separated file whose control names and ignores columns, overrides formats and builds
    a point; rows off the globe are errors and stay out."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Day"),
        F.date_format("o_orderdate", "yyyy/MM").alias("Closed"),
        F.concat(F.lit("  "), F.col("o_totalprice").cast("string")).alias("Price"),
        (F.col("o_totalprice") / 10000).alias("Lat"),
        (F.col("o_custkey") / 10).alias("Lon"),
        F.lit('a "remark').alias("Remark"),
    )
    path = as_delimited(rows, "tsv", "\t")
    control = parse_control(json.dumps(CONTROL))
    store = DatasetStore(spark, scratch_path(spark, "store"))
    empty = spark.createDataFrame(
        [], "o_orderkey bigint, day timestamp_ntz, closed timestamp, price decimal(38,9), "
            "spot struct<longitude:double,latitude:double>")
    jobs.create_dataset(store, "orde-rs02", empty)
    types = {"o_orderkey": "bigint", "day": "calendar_date", "closed": "date", "price": "number"}
    jobs.publish_file(store, "orde-rs02", path, control, types)
    return store.read("orde-rs02").select(
        "o_orderkey", "day", F.unix_micros("closed").alias("closed_micros"),
        F.col("price").cast("double").alias("price"),
        F.col("spot.latitude").alias("lat"), F.col("spot.longitude").alias("lon"),
    )


@query(f"WITH {INCOMING_SQL} SELECT * FROM incoming")
def publish_file_replace(spark, sf_dir):
    store = store_with_orders(spark, sf_dir)
    path = as_delimited(incoming_orders(spark, sf_dir), "incoming")
    jobs.publish_file(
        store, "orde-rs01", path, generate_control("in.csv", "replace"), ORDERS, "o_orderkey"
    )
    return store.read("orde-rs01")


@query(f"""
WITH {STORED_SQL}, {INCOMING_SQL}
SELECT s.*, (SELECT count(*) FROM stored JOIN incoming USING (o_orderkey)) AS rows_deleted
FROM stored s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)
""")
def publish_file_delete(spark, sf_dir):
    """A file of ids, half of them unknown."""
    store = store_with_orders(spark, sf_dir)
    ids = incoming_orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    result = jobs.publish_file(
        store, "orde-rs01", as_delimited(ids, "ids"), generate_control("in.csv", "delete"), ORDERS,
        "o_orderkey",
    )
    return store.read("orde-rs01").withColumn(
        "rows_deleted", F.lit(result.rows_deleted).cast("bigint")
    )


@query(f"WITH {LINES_SQL} SELECT * FROM new")
def replace_by_changes_unkeyed(spark, sf_dir):
    """A replace through the changes of a dataset without a row identifier."""
    prev, new = line_versions(spark, sf_dir)
    store = DatasetStore(spark, scratch_path(spark, "store"))
    jobs.create_dataset(store, "line-s001", prev)
    jobs.replace_by_delta(store, "line-s001", new, None)
    return store.read("line-s001")


@query(f"SELECT * EXCLUDE (action) FROM ({upsert_sql('patch')})")
def port_datasets(spark, sf_dir):
    """One dataset copied to a new id, then another one published into the copy."""
    store = store_with_orders(spark, sf_dir)
    control = parse_port_control(
        '{"sourceDataset": "orde-rs01", "copyType": {"type": "schema_and_data"}}'
    )
    jobs.port_dataset(store, control.source_dataset, "copy-0001", control.copy)
    jobs.create_dataset(store, "more-0001", incoming_orders(spark, sf_dir))
    jobs.port_dataset(store, "more-0001", "copy-0001", "data", "upsert", "o_orderkey")
    return store.read("copy-0001")


@query(f"""
WITH {LAYERS_SQL}
SELECT o_custkey AS dataset_id, o_custkey::VARCHAR || '/' || o_orderpriority AS uid, o_orderkey AS feature
FROM orders WHERE o_orderstatus <> 'O'
AND o_custkey::VARCHAR || '/' || o_orderpriority NOT IN (SELECT uid FROM layer_map)
UNION ALL
SELECT o_custkey, coalesce(m.uid, o_orderpriority), o_orderkey FROM orders
LEFT JOIN layer_map m ON m.dataset_id = o_custkey AND m.layer = o_orderpriority
WHERE o_orderstatus = 'O'
""")
def publish_layers(spark, sf_dir):
    """Layer-wise replacement as a whole job."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("dataset_id"), F.col("o_orderpriority").alias("layer"),
        F.col("o_orderkey").alias("feature"), "o_orderstatus",
    )
    uid = F.concat(F.col("dataset_id").cast("string"), F.lit("/"), F.col("layer"))
    store = DatasetStore(spark, scratch_path(spark, "store"))
    stored = orders.filter(F.col("o_orderstatus") != "O").select("dataset_id", uid.alias("uid"), "feature")
    jobs.create_layers(store, "laye-rs01", stored)
    scanned = orders.filter(F.col("o_orderstatus") == "O").drop("o_orderstatus")
    jobs.replace_layers(store, "laye-rs01", scanned, existing_layers(spark, sf_dir))
    return store.read("laye-rs01")


@query("""
SELECT 10000000 + d.doc_id AS dataset_id,
       CASE WHEN quality = 1 THEN 'Copy of ' || d.doc_id::VARCHAR ELSE 'Text ' || d.doc_id::VARCHAR END AS title,
       d.source AS category
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
""")
def copy_catalog(spark, sf_dir):
    """Catalogue rows of the copies of all rated texts; a blank title keeps the old one."""
    rated = table(spark, sf_dir, "labels")
    renames = rated.select(
        F.col("doc_id").alias("dataset_id"),
        (F.col("doc_id") + 10_000_000).alias("new_id"),
        F.when(F.col("quality") == 1, F.concat(F.lit("Copy of "), F.col("doc_id").cast("string")))
        .otherwise(" ").alias("new_title"),
    )
    rows = catalog_rows(spark, sf_dir).select("dataset_id", "title", "category")
    return copy_catalog_rows(rows, renames)


@query("""
SELECT license_id, label, count(doc_id) AS datasets FROM (
  SELECT '' AS license_id, '-- No License --' AS label
  UNION ALL SELECT 'CC_40_BY', 'Creative Commons Attribution 4.0 International'
  UNION ALL SELECT 'ODBL', 'Open Data Commons Open Database License'
) JOIN documents ON license_id = CASE lang WHEN 'en' THEN 'CC_40_BY' WHEN 'fr' THEN 'ODBL' ELSE '' END
GROUP BY ALL
""")
def licenses_in_use(spark, sf_dir):
    """The licence list with how many texts carry each."""
    code = F.when(F.col("lang") == "en", "CC_40_BY").when(F.col("lang") == "fr", "ODBL").otherwise("")
    known = catalog.license_list(catalog.licenses(spark)).drop("place")
    used = table(spark, sf_dir, "documents").groupBy(code.alias("license_id")).agg(
        F.count(F.lit(1)).alias("datasets")
    )
    return known.join(used, "license_id")


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


_LICENSES_SQL = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in catalog.LICENSES)


@query(f"""
SELECT place, k.license_id, label, datasets FROM (
  SELECT '' AS license_id, '-- No License --' AS label, 1 AS place
  UNION ALL SELECT *, 1 + row_number() OVER (ORDER BY label) FROM (VALUES {_LICENSES_SQL}) AS l(license_id, label)) k
JOIN (SELECT CASE lang WHEN 'en' THEN 'CC_40_BY' WHEN 'fr' THEN 'ODBL' ELSE '' END AS license_id, count(*) AS datasets
      FROM documents GROUP BY 1) u ON u.license_id = k.license_id
""")
def licenses_in_order(spark, sf_dir):
    """Where the licences that texts carry stand in the whole list."""
    code = F.when(F.col("lang") == "en", "CC_40_BY").when(F.col("lang") == "fr", "ODBL").otherwise("")
    used = table(spark, sf_dir, "documents").groupBy(code.alias("license_id")).agg(F.count(F.lit(1)).alias("datasets"))
    listed = catalog.license_list(catalog.licenses(spark)).withColumn("place", F.col("place").cast("bigint"))
    return listed.join(used, "license_id").select("place", "license_id", "label", "datasets")


@query("""
SELECT o_orderkey, o_orderdate IS NULL AS unread FROM (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderdate END AS o_orderdate
  FROM orders)
WHERE o_orderdate IS NOT NULL OR o_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
""")
def publish_and_set_aside(spark, sf_dir):
    """Rows with an unreadable day go to a side output, the others are published. ``unread`` tells
    which stored orders had a bad row set aside."""
    day = F.when(F.col("o_orderpriority") == "2-HIGH", "never").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    store = store_with_orders(spark, sf_dir)
    path = as_delimited(table(spark, sf_dir, "orders").withColumn("o_orderdate", day), "incoming")
    made = generate_control("in.csv", "upsert")
    control = Control(made.action, None, made.file.with_options(set_aside_errors=True))
    aside = scratch_path(spark, "aside")
    jobs.publish_file(store, "orde-rs01", path, control, ORDERS, "o_orderkey", set_aside=aside)
    bad = spark.read.parquet(aside).select("o_orderkey", F.lit(True).alias("_bad"))
    seen = store.read("orde-rs01").join(bad, "o_orderkey", "left")
    return seen.select("o_orderkey", F.col("_bad").isNotNull().alias("unread"))


@query("""
WITH lines AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)
SELECT n + 1 AS line, 'never' AS message, 'set aside' AS kind, n - 1 AS logged FROM lines WHERE o_orderpriority = '2-HIGH'
UNION ALL
SELECT NULL, 'refused', 'run log', 2 FROM (SELECT count(*) FROM orders)
""")
def job_outcomes(spark, sf_dir):
    """What jobs leave behind: lines of cells that could not be read, rows set aside with their record
    number, and a run-log row of each job, the refused one included."""
    store = store_with_orders(spark, sf_dir)
    day = F.when(F.col("o_orderpriority") == "2-HIGH", "never").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = table(spark, sf_dir, "orders").withColumn("o_orderdate", day)
    path = as_delimited(in_order(rows, "o_orderkey"), "incoming")
    made = generate_control("in.csv", "upsert")
    control = Control(made.action, None, made.file.with_options(set_aside_errors=True))
    aside, report, log = (scratch_path(spark, t) for t in ("aside", "report", "run-log"))
    jobs.publish_file(store, "orde-rs01", path, control, ORDERS, "o_orderkey", run_log=log, set_aside=aside, report=report,
                      whole_folder=True)
    try:
        refused = Control("Delete", None, made.file)
        jobs.publish_file(store, "orde-rs01", path, refused, ORDERS, None, run_log=log)
    except ControlError:
        pass
    bad = spark.read.parquet(aside).select("o_orderkey", "record_no", F.explode(ERRORS).alias("e"))
    lines = spark.read.parquet(report).select("line", "value")
    met = bad.join(lines, F.col("record_no") + 2 == F.col("line")).select(
        "line", F.col("value").alias("message"), F.lit("set aside").alias("kind"), F.col("record_no").alias("logged"))
    runs = spark.read.parquet(log).agg(
        F.lit(None).cast("bigint").alias("line"), F.lit("refused").alias("message"), F.lit("run log").alias("kind"),
        F.count_if(F.col("Errors").isNotNull()).alias("logged"))
    return met.unionByName(runs)
