"""Registered queries: scans, cleaning, parsing and text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.control import NO_QUOTE, ColumnOverride, FileControl
from rowharbor.functions import text
from rowharbor.functions.patterns import DEFAULT_TIME_FORMATS
from rowharbor.functions.temporal import parse_fixed, parse_floating
from rowharbor.operators.shape import clean_cells, ignore_columns, map_columns, trim_stored
from rowharbor.operators.typing import ERRORS, cast_types
from rowharbor.plans.registry import as_delimited, in_order, query, table
from rowharbor.runtime import scratch_path
from rowharbor.sources.delimited import (
    column_preview,
    mark_blank_lines,
    sample_rows,
    scan_delimited,
    scan_head,
    with_record_no,
)
from rowharbor.sources.sinks import export_json
from rowharbor.sources.store import export_dataset

PLAIN = FileControl(separator=",", multi_line=False)
VERBATIM = FileControl(separator=",", trim_whitespace=False, empty_text_is_null=False)

CUSTOMER = {"c_custkey": "bigint", "c_name": "text", "c_nationkey": "int", "c_acctbal": "double",
            "c_mktsegment": "text"}
PART = {"p_partkey": "bigint", "p_name": "text", "p_brand": "text", "p_type": "text",
        "p_size": "int", "p_retailprice": "double"}
ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "text",
          "o_totalprice": "double", "o_orderdate": "calendar_date", "o_orderpriority": "text"}


def typed_scan(spark, path, control, types, **options):
    """Scan, clean and type a file; only the dataset's columns."""
    rows = scan_delimited(spark, path, control, **options)
    return cast_types(clean_cells(rows, control), types, control).select(*types)


@query("SELECT * FROM customer")
def scan_csv_roundtrip(spark, sf_dir):
    path = as_delimited(table(spark, sf_dir, "customer"), "customer")
    return typed_scan(spark, path, PLAIN, CUSTOMER)


@query("SELECT * FROM part")
def scan_tsv_roundtrip(spark, sf_dir):
    path = as_delimited(table(spark, sf_dir, "part"), "part", "\t")
    control = PLAIN.with_options(separator="\t", quote=NO_QUOTE)
    return typed_scan(spark, path, control, PART)


@query("SELECT s_suppkey AS column_0, s_name AS column_1, s_nationkey AS column_2 FROM supplier")
def scan_without_header(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    path = as_delimited(rows, "supplier", header=False)
    types = {"column_0": "bigint", "column_1": "text", "column_2": "int"}
    return typed_scan(spark, path, PLAIN.with_options(has_header_row=False), types)


@query("SELECT conv_id, turn, role, text FROM conversations")
def scan_multiline_text(spark, sf_dir):
    path = as_delimited(table(spark, sf_dir, "conversations"), "conversations")
    types = {"conv_id": "bigint", "turn": "bigint", "role": "text", "text": "text"}
    return typed_scan(spark, path, VERBATIM, types)


@query("SELECT conv_id, turn, role, text FROM conversations")
def scan_multiline_split(spark, sf_dir):
    """The same text as an export in parts, which are read side by side."""
    path = as_delimited(table(spark, sf_dir, "conversations").repartition(16, "conv_id"), "conversations")
    types = {"conv_id": "bigint", "turn": "bigint", "role": "text", "text": "text"}
    return typed_scan(spark, path, VERBATIM, types)


@query("""
    SELECT doc_id, '5" ' || regexp_replace(coalesce(text, ''), '[",\\r\\n]', ' ', 'g') AS note, split
    FROM documents, (VALUES (true), (false)) AS readers(split)
""")
def scan_stray_quotes(spark, sf_dir):
    """Texts with a quote in an unquoted cell, read by whole files and split by lines."""
    note = F.concat(F.lit('5" '), F.regexp_replace(F.coalesce("text", F.lit("")), r'[",\r\n]', " "))
    path = scratch_path(spark, "stray")
    lines = table(spark, sf_dir, "documents").select(F.concat_ws(",", "doc_id", note))
    lines.write.text(path)
    types = {"doc_id": "bigint", "note": "text"}
    control = VERBATIM.with_options(has_header_row=False, columns=[*types])
    read = [
        typed_scan(spark, path, control.with_options(multi_line=not split), types).withColumn("split", F.lit(split))
        for split in (True, False)
    ]
    return read[0].unionByName(read[1])


@query("SELECT page_id, url, html FROM pages")
def scan_quoted_html(spark, sf_dir):
    path = as_delimited(table(spark, sf_dir, "pages"), "pages")
    types = {"page_id": "bigint", "url": "text", "html": "text"}
    return typed_scan(spark, path, VERBATIM, types)


@query("""
SELECT c_custkey, 'Käufer é ' || c_name AS c_name, replace(c_mktsegment, 'I', 'Ï') AS c_mktsegment FROM customer
""")
def scan_latin1(spark, sf_dir):
    """A file whose cells hold accented letters in one byte each."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Käufer é "), "c_name").alias("c_name"),
        F.replace("c_mktsegment", F.lit("I"), F.lit("Ï")).alias("c_mktsegment"),
    )
    path = scratch_path(spark, "latin1")
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    control = PLAIN.with_options(encoding="ISO-8859-1")
    return typed_scan(spark, path, control, {k: CUSTOMER[k] for k in rows.columns})


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS record_no FROM orders
""")
def record_numbers(spark, sf_dir):
    path = as_delimited(in_order(table(spark, sf_dir, "orders"), "o_orderkey"), "orders")
    numbered = with_record_no(scan_delimited(spark, path, PLAIN), whole_folder=True)
    return numbered.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "record_no")


@query("""
SELECT p_partkey, p_name, p_type FROM part ORDER BY p_partkey LIMIT 100
""")
def sample_of_file(spark, sf_dir):
    path = as_delimited(in_order(table(spark, sf_dir, "part"), "p_partkey"), "part")
    known = ["p_type", "p_partkey", "p_name", "not_in_file"]
    rows = sample_rows(scan_head(spark, path, PLAIN, 100), 100, known)
    return rows.withColumn("p_partkey", F.col("p_partkey").try_cast("bigint"))


@query("""
WITH head AS (SELECT * FROM part ORDER BY p_partkey LIMIT 10)
SELECT 0 AS pos, 'p_partkey' AS column_name,
       left(string_agg(p_partkey::VARCHAR, ', ' ORDER BY p_partkey), 50) AS preview FROM head
UNION ALL
SELECT 1, 'p_name', left(string_agg(p_name, ', ' ORDER BY p_partkey), 50) FROM head
UNION ALL
SELECT 2, 'p_brand',
       left(string_agg(CASE WHEN p_size < 25 THEN p_brand ELSE 'N/A' END, ', ' ORDER BY p_partkey), 50)
FROM head
""")
def preview_of_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") < 25, F.col("p_brand")).alias("p_brand")
    )
    path = as_delimited(in_order(part, "p_partkey"), "part")
    return column_preview(scan_head(spark, path, PLAIN, 10), 10, 50)


@query("""
WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
SELECT count(*) AS lines, count(*) FILTER (WHERE regexp_full_match(line, '\\s*')) AS blank_lines
FROM lines
""")
def blank_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return mark_blank_lines(spark, path).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("blank").alias("blank_lines")
    )


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL ELSE p_name END AS p_name,
       CASE WHEN p_size < 10 THEN '' ELSE p_brand END AS p_brand,
       '  ' || p_type AS p_type
FROM part
""")
def trim_and_null(spark, sf_dir):
    padded = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") < 10, " \t ").otherwise(
            F.concat(F.lit(" \u000b "), "p_name", F.lit("\t  "))
        ).alias("p_name"),
        F.when(F.col("p_size") < 10, "   ").otherwise(F.concat(F.lit("\t"), "p_brand")).alias("p_brand"),
        F.concat(F.lit("  "), "p_type").alias("p_type"),
    )
    path = as_delimited(padded, "padded")
    control = PLAIN.with_options(
        overrides={
            "p_brand": ColumnOverride(empty_text_is_null=False),
            "p_type": ColumnOverride(trim_whitespace=False),
        }
    )
    types = {"p_partkey": "bigint", "p_name": "text", "p_brand": "text", "p_type": "text"}
    return typed_scan(spark, path, control, types)


@query("""
SELECT c_custkey, c_name, '  ' || c_mktsegment || ' ' AS c_mktsegment, c_acctbal FROM customer
""")
def trim_stored_cells(spark, sf_dir):
    """Texts of the stored side are trimmed where the control asks for it, here for all columns but one."""
    stored = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" \t"), "c_name", F.lit("\u000b ")).alias("c_name"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("c_mktsegment"), "c_acctbal",
    )
    control = PLAIN.with_options(
        trim_server_whitespace=True, overrides={"c_mktsegment": ColumnOverride(trim_server_whitespace=False)}
    )
    return trim_stored(stored, control)


@query("SELECT c_custkey AS id, c_name AS title, c_mktsegment AS kind FROM customer")
def mapped_columns(spark, sf_dir):
    """Columns renamed by position, one dataset field claimed twice, one file column ignored."""
    path = as_delimited(table(spark, sf_dir, "customer"), "customer")
    rows = scan_delimited(spark, path, PLAIN)
    mapped = map_columns(rows, ["id", "title", "kind", "balance", "kind"])
    kept = ignore_columns(mapped, ["balance", "never_there"])
    return kept.select(F.col("id").try_cast("bigint").alias("id"), "title", "kind")


@query("SELECT o_orderkey, o_orderdate AS parsed FROM orders")
def parse_floating_multi(spark, sf_dir):
    """Dates printed in one of five ways, read back by one list of formats."""
    d, kind = F.col("o_orderdate"), F.col("o_orderpriority")
    printed = (
        F.when(kind == "1-URGENT", F.date_format(d, "MM/dd/yy"))
        .when(kind == "2-HIGH", F.date_format(d, "M/d/yyyy"))
        .when(kind == "3-MEDIUM", F.date_format(d, "dd-MMM-yyyy"))
        .when(kind == "5-LOW", F.date_format(d, "MM/dd/yyyy hh:mm:ss a"))
        .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    read = parse_floating(F.col("text"), DEFAULT_TIME_FORMATS)
    # a two-digit year means the 2000s
    century = F.when(
        (kind == "1-URGENT") & (F.year("o_orderdate") < 2000), F.expr("INTERVAL '100' YEAR")
    ).otherwise(F.expr("INTERVAL '0' YEAR"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", printed.alias("text"), century.alias("century"))
        .select("o_orderkey", (read - F.col("century")).alias("parsed"))
    )


@query("SELECT event_id, epoch_us(date_trunc('second', ts)) AS at_micros FROM events")
def parse_fixed_tz(spark, sf_dir):
    """Instants printed with and without an offset; the latter are in the default zone."""
    ts, kind = F.col("ts"), F.col("event_type")
    west = ts - F.expr("INTERVAL '8' HOUR")
    east = ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE")
    printed = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "signup", F.date_format(east, "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(kind == "purchase", F.date_format(west, "MM/dd/yyyy hh:mm:ss a' -0800'"))
        .when(kind == "click", F.date_format(west, "MM/dd/yyyy hh:mm:ss a"))
        .otherwise(F.date_format(west, "yyyy-MM-dd HH:mm:ss"))
    )
    formats = ["ISO8601", "MM/dd/yyyy hh:mm:ss a Z", "MM/dd/yyyy hh:mm:ss a"]
    read = parse_fixed(F.col("text"), formats, "PST")
    return (
        table(spark, sf_dir, "events")
        .select("event_id", printed.alias("text"))
        .select("event_id", F.unix_micros(read).alias("at_micros"))
    )


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END AS price,
       (o_totalprice > 400000)::INT + (o_orderstatus = 'F')::INT AS bad_cells
FROM orders
""")
def cast_with_errors(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 400000, "n/a").otherwise(F.col("o_totalprice").cast("string"))
        .alias("price"),
        F.when(F.col("o_orderstatus") == "F", "31/31/2011")
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("day"),
    )
    path = as_delimited(orders, "orders")
    types = {"o_orderkey": "bigint", "price": "number", "day": "calendar_date"}
    rows = cast_types(clean_cells(scan_delimited(spark, path, PLAIN), PLAIN), types, PLAIN)
    return rows.select(
        "o_orderkey", F.col("price").cast("double").alias("price"),
        F.size(ERRORS).alias("bad_cells"),
    )


@query("""
SELECT conv_id, turn, length(text) AS chars FROM conversations
""")
def export_without_system_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn(":id", F.col("conv_id"))
    visible = export_dataset(rows.withColumn("chars", F.length("text")).drop("role", "text"))
    return visible


@query("SELECT event_id, user_id, event_type, value FROM events")
def export_as_json(spark, sf_dir):
    path = scratch_path(spark, "json")
    export_json(table(spark, sf_dir, "events").withColumn(":updated_at", F.col("ts")), path)
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return spark.read.schema(schema).json(path)


@query("""
SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages
""")
def url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.url_host(F.col("url")).alias("host"))


@query("""
SELECT doc_id, lang AS extension, source || '.' || upper(lang) AS file_name FROM documents
""")
def file_ext(spark, sf_dir):
    path = F.concat(F.lit("/in.coming/"), "source", F.lit("."), F.upper("lang"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.file_extension(path).alias("extension"),
        text.file_name(path).alias("file_name"),
    )


@query("""
SELECT o_orderkey,
       o_orderkey::VARCHAR || CASE
         WHEN o_orderkey % 100 IN (11, 12, 13) THEN 'th'
         WHEN o_orderkey % 10 = 1 THEN 'st'
         WHEN o_orderkey % 10 = 2 THEN 'nd'
         WHEN o_orderkey % 10 = 3 THEN 'rd' ELSE 'th' END AS nth
FROM orders
""")
def ordinal(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.ordinal(F.col("o_orderkey")).alias("nth")
    )


@query("""
WITH t AS (
  SELECT p_partkey, string_split(p_name, ' ') AS words, p_type FROM part
)
SELECT p_partkey, len(words) + 2 AS parts,
       list_aggregate(list_concat(words, [p_type || ',x', 'a\\b']), 'string_agg', '|') AS joined,
       list_aggregate(words, 'string_agg', ', ') || ', ' || p_type || '\\,x, a\\\\b' AS rejoined
FROM t
""")
def comma_lists(spark, sf_dir):
    """Names as comma lists with protected commas and backslashes, split and joined again."""
    listed = F.concat(
        F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(", "), "p_type", F.lit("\\,x,a\\\\b")
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", text.comma_split(listed).alias("parts"))
    return rows.select(
        "p_partkey",
        F.size("parts").alias("parts"),
        F.array_join("parts", "|").alias("joined"),
        text.comma_join(F.col("parts")).alias("rejoined"),
    )


@query("""
WITH t AS (SELECT c_custkey, substr(md5(c_name), 1, 4) || '-' || substr(md5(c_name), 5, 3
                  + (c_nationkey < 12)::INT) AS uid FROM customer)
SELECT c_custkey, uid, length(uid) = 9 AS valid FROM t
""")
def uid_valid(spark, sf_dir):
    digest = F.md5("c_name")
    width = F.lit(3) + (F.col("c_nationkey") < 12).cast("int")
    uid = F.concat(F.substr(digest, F.lit(1), F.lit(4)), F.lit("-"), F.substr(digest, F.lit(5), width))
    return table(spark, sf_dir, "customer").select("c_custkey", uid.alias("uid")).select(
        "c_custkey", "uid", text.uid_valid(F.col("uid")).alias("valid")
    )


@query("""
SELECT p_partkey, upper(p_name[1]) || substr(p_name, 2) AS title,
       p_size::VARCHAR || '.' || length(p_name)::VARCHAR AS version,
       lower(p_type) AS header
FROM part
""")
def text_helpers(spark, sf_dir):
    release = F.concat(
        F.lit("release v"), F.col("p_size").cast("string"), F.lit("."),
        F.length("p_name").cast("string"), F.lit("-beta"),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.capitalise_first(F.col("p_name")).alias("title"),
        text.strip_version(release).alias("version"),
        text.normalise_header(F.concat(F.lit(" "), F.col("p_type"), F.lit("\t"))).alias("header"),
    )
