"""Registered queries: validation, matching, profiling, catalogue metadata and job logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.operators import catalog, checks, joblog, match, port, profile
from rowharbor.plans.publish_queries import COLUMNS_SQL, DAMAGED_SQL, dataset_columns
from rowharbor.plans.registry import as_delimited, query, table
from rowharbor.plans.scan_queries import PLAIN
from rowharbor.runtime import scratch_path
from rowharbor.sources.delimited import scan_delimited
from rowharbor.sources.joblog import scan_job_log

# Header relations drawn from the order lines: each order is a file for its customer's dataset.
# Its header cells are the order's priority and the ship years of its lines.
HEADERS_SQL = """headers AS (
  SELECT DISTINCT o_orderkey AS file_id, o_custkey AS dataset_id,
         CASE WHEN l_discount < 0.02 THEN ' ' || l_shipmode ELSE l_shipmode END AS name
  FROM (SELECT *, CASE WHEN l_linenumber < 3 THEN lower(o_orderpriority)
                       WHEN l_linenumber < 5 THEN '1-urgent' ELSE l_returnflag END AS l_shipmode
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey))"""

# The row identifier of every dataset is its first column, unless that is 2-HIGH.
ROW_ID_SQL = "columns AS (SELECT *, pos = 0 AND field_name <> '2-HIGH' AS is_row_id FROM dataset_columns)"


def headers(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").join(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_discount", "l_returnflag"
        ),
        "o_orderkey",
    )
    name = (
        F.when(F.col("l_linenumber") < 3, F.lower("o_orderpriority"))
        .when(F.col("l_linenumber") < 5, "1-urgent")
        .otherwise(F.col("l_returnflag"))
    )
    padded = F.when(F.col("l_discount") < 0.02, F.concat(F.lit(" "), name)).otherwise(name)
    return joined.select(
        F.col("o_orderkey").alias("file_id"), F.col("o_custkey").alias("dataset_id"),
        padded.alias("name"),
    ).distinct()


def id_columns(spark, sf_dir):
    first = (F.col("pos") == 0) & (F.col("field_name") != "2-HIGH")
    return dataset_columns(spark, sf_dir).withColumn("is_row_id", first)


_EXTRA_SQL = """
extra AS (
  SELECT file_id, dataset_id, 'PUBLISH_ERROR' AS status,
         'Extra Columns Specified: the file contains column ''' || lname
         || ''', but the dataset does not.' AS message
  FROM (SELECT file_id, dataset_id, lower(trim(name)) AS lname, count(*) AS n FROM headers GROUP BY ALL) h
  WHERE n > 1 OR NOT EXISTS (SELECT 1 FROM columns c WHERE c.dataset_id = h.dataset_id
                             AND lower(c.field_name) = h.lname))"""


@query(f"""
WITH {COLUMNS_SQL}, {HEADERS_SQL}, {ROW_ID_SQL}, {_EXTRA_SQL}
SELECT * FROM extra
""")
def extra_columns(spark, sf_dir):
    return checks.check_columns(headers(spark, sf_dir), id_columns(spark, sf_dir), method="upsert")


@query(f"""
WITH {COLUMNS_SQL}, all_{HEADERS_SQL.strip()}, {ROW_ID_SQL},
headers AS (SELECT * FROM all_headers WHERE lower(trim(name)) NOT IN ('4-not specified', 'r')), {_EXTRA_SQL},
absent AS (
  SELECT f.file_id, c.* FROM (SELECT DISTINCT file_id, dataset_id FROM all_headers) f
  JOIN columns c ON c.dataset_id = f.dataset_id
  WHERE NOT EXISTS (SELECT 1 FROM all_headers h WHERE h.file_id = f.file_id
                    AND lower(trim(h.name)) = lower(c.field_name))),
gaps AS (
  SELECT file_id, dataset_id, string_agg(field_name, ', ' ORDER BY pos) AS listed
  FROM absent WHERE field_name <> '4-NOT SPECIFIED' GROUP BY ALL),
judged AS (
  SELECT g.*, r.field_name AS row_id, a.field_name IS NOT NULL AS no_id
  FROM gaps g LEFT JOIN columns r ON r.dataset_id = g.dataset_id AND r.is_row_id
  LEFT JOIN absent a ON a.file_id = g.file_id AND a.is_row_id)
SELECT * FROM extra
UNION ALL
SELECT file_id, dataset_id, CASE WHEN row_id IS NULL THEN 'MISSING_COLUMNS' ELSE 'PUBLISH_ERROR' END,
       CASE WHEN row_id IS NULL THEN 'Missing Fields: not mapped: ' || listed
            ELSE 'Missing Row Identifier: column ''' || row_id || ''' must be present in the file.' END
FROM judged WHERE row_id IS NULL OR no_id
""")
def check_columns(spark, sf_dir):
    """All files against their datasets, for a replace; every control ignores one of the fields and
    one header that no dataset has."""
    files = headers(spark, sf_dir)
    names = F.explode(F.array(F.lit("4-NOT SPECIFIED"), F.lit("R")))
    ignored = files.select("file_id").distinct().withColumn("name", names)
    return checks.check_columns(files, id_columns(spark, sf_dir), ignored)


@query(f"""
WITH {COLUMNS_SQL}, {HEADERS_SQL},
synthetic AS (
  SELECT file_id, dataset_id, '1-Urgent' AS name, 'city' AS part, '5-LOW' AS source FROM (SELECT DISTINCT file_id, dataset_id FROM headers)
  UNION ALL SELECT file_id, dataset_id, '1-Urgent', 'zip', '3-MEDIUM' FROM (SELECT DISTINCT file_id, dataset_id FROM headers))
SELECT DISTINCT s.file_id, s.dataset_id, 'PUBLISH_ERROR' AS status,
       'Ambiguous Column Name: ''1-Urgent'' is also in the file.' AS message
FROM synthetic s JOIN headers h ON h.file_id = s.file_id AND lower(trim(h.name)) = '1-urgent'
UNION ALL
SELECT s.file_id, s.dataset_id, 'PUBLISH_ERROR',
       'Unsupported Datatype: ' || part || ' component of ''1-Urgent'' is of type ''' || type
       || '''; it requires ' || CASE WHEN part = 'city' THEN '''text'' column' ELSE '''text'' or ''number'' columns' END
FROM synthetic s JOIN dataset_columns c ON c.dataset_id = s.dataset_id AND c.field_name = s.source
WHERE (part = 'city' AND type <> 'text') OR (part = 'zip' AND type NOT IN ('text', 'number'))
""")
def check_synthetic(spark, sf_dir):
    files = headers(spark, sf_dir)
    parts = F.array(
        F.struct(F.lit("city").alias("part"), F.lit("5-LOW").alias("source")),
        F.struct(F.lit("zip").alias("part"), F.lit("3-MEDIUM").alias("source")),
    )
    synthetic = files.select("file_id", "dataset_id").distinct().select(
        "file_id", "dataset_id", F.lit("1-Urgent").alias("name"), F.inline(parts)
    )
    return checks.check_synthetic(files, dataset_columns(spark, sf_dir), synthetic)


@query("""
SELECT 'ROWS_DO_NOT_CONTAIN_SAME_NUMBER_OF_COLUMNS' AS status,
       o_orderkey::VARCHAR || ',' || CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
       ELSE o_orderpriority || ',' || o_orderstatus || ',surplus' END AS record
FROM orders WHERE o_orderstatus IN ('P', 'F')
""")
def check_ragged(spark, sf_dir):
    """Lines with a cell too few or too many."""
    line = F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
        F.when(F.col("o_orderstatus") == "F", "surplus"),
    )
    path = scratch_path(spark, "ragged")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    control = PLAIN.with_options(columns=["key", "priority", "status"], has_header_row=False)
    return checks.check_ragged(scan_delimited(spark, path, control)).select("status", "record")


@query(f"""
SELECT o_orderkey::VARCHAR AS o_orderkey, 'o_orderdate' AS "column", 'soon' AS "value",
       'INVALID_DATETIME' AS status
FROM orders WHERE {DAMAGED_SQL}
UNION ALL
SELECT o_orderkey::VARCHAR, 'closed', '2001-13-01', 'INVALID_DATETIME' FROM orders
WHERE o_orderpriority = '2-HIGH'
""")
def check_datetimes(spark, sf_dir):
    bad = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(bad, "soon").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "2001-13-01")
        .when(F.col("o_orderpriority") == "5-LOW", "2001-01-31 10:00:00 -05:00").alias("closed"),
    )
    path = as_delimited(rows, "dates")
    types = {"o_orderkey": "number", "o_orderdate": "calendar_date", "closed": "date"}
    scanned = scan_delimited(spark, path, PLAIN)
    return checks.check_datetimes(scanned, types, PLAIN).select(
        "o_orderkey", "column", "value", "status"
    )


@query("""
SELECT page_id, coalesce(regexp_extract(url, '^.+\\.([^.]*)$', 1), '') AS extension, false AS allowed
FROM pages
UNION ALL
SELECT doc_id, lang, lang IN ('csv', 'tsv') FROM documents
UNION ALL
SELECT doc_id, 'csv', true FROM documents
""")
def check_file_format(spark, sf_dir):
    """Links and document names as files to publish."""
    links = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("page_id"), F.col("url").alias("path")
    )
    docs = table(spark, sf_dir, "documents")
    names = docs.select("doc_id", F.concat("source", F.lit("."), "lang"))
    tables = docs.select("doc_id", F.concat("source", F.lit(".CSV")))
    files = links.union(names).union(tables)
    return checks.check_file_format(files).select("page_id", "extension", "allowed")


@query("""
SELECT event_id AS job_id,
       CASE WHEN event_type = 'click' THEN 'PUBLISH_ERROR' WHEN event_type = 'error' THEN 'PUBLISH_ERROR'
            WHEN event_type = 'signup' AND value < 50 THEN 'PUBLISH_ERROR'
            WHEN event_type = 'purchase' AND user_id < 10 THEN 'PUBLISH_ERROR'
            ELSE 'VALID' END AS status,
       CASE WHEN event_type = 'click' THEN 'Unknown Publish Method'
            WHEN event_type = 'error' THEN 'Conflicting Publish Methods'
            WHEN event_type = 'signup' AND value < 50 THEN 'Dataset Requirement Unfulfilled'
            WHEN event_type = 'purchase' AND user_id < 10 THEN 'Publish Method Not Allowed' END AS message
FROM events
""")
def check_actions(spark, sf_dir):
    """Events read as jobs: the type stands for the publish method."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "click", "merge").when(kind == "signup", "Delete")
        .when(kind == "purchase", "Append").when(kind == "error", "Replace").otherwise("Upsert")
    )
    jobs = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("job_id"),
        F.when((kind == "purchase") & (F.col("user_id") < 10), "port").otherwise("publish").alias("job_type"),
        action.alias("action"),
        F.when(kind == "error", "upsert").alias("requested"),
        F.when(F.col("value") >= 50, "id").alias("row_id"),
    )
    return checks.check_actions(jobs)


_FORMATS = ("ISO8601", "yyyy-MM-dd", "MM/dd/yyyy hh:mm:ss a Z", "dd 'of' MMM ''yy", "EEE d", "yyyy 'open", "")
_CHARSETS = (None, "UTF-8", "iso-8859-1", "klingon", "utf-16LE", "windows-9999")


@query("""
WITH jobs AS (
  SELECT event_id AS job_id,
    list_filter([CASE event_id % 7 WHEN 4 THEN 'EEE d' WHEN 5 THEN 'yyyy ''open' WHEN 6 THEN '' END,
                 CASE user_id % 7 WHEN 4 THEN 'EEE d' WHEN 5 THEN 'yyyy ''open' WHEN 6 THEN '' END], lambda x: x IS NOT NULL) AS bad,
    CASE event_id % 6 WHEN 3 THEN 'klingon' WHEN 5 THEN 'windows-9999' END AS charset
  FROM events)
SELECT job_id, CASE WHEN len(bad) > 0 OR charset IS NOT NULL THEN 'PUBLISH_ERROR' ELSE 'VALID' END AS status,
       CASE WHEN len(bad) > 0 THEN 'Unsupported Date Time Format: ' || array_to_string(bad, ', ')
            WHEN charset IS NOT NULL THEN 'Unsupported Encoding: ' || charset END AS message
FROM jobs
""")
def check_settings(spark, sf_dir):
    """Events read as jobs, each with two time formats and a charset."""
    formats = F.array(*[F.lit(f) for f in _FORMATS])
    charsets = F.array(*[F.lit(c) for c in _CHARSETS])
    jobs = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("job_id"),
        F.array(F.get(formats, (F.col("event_id") % 7).cast("int")), F.get(formats, (F.col("user_id") % 7).cast("int"))).alias("formats"),
        F.get(charsets, (F.col("event_id") % 6).cast("int")).alias("encoding"),
    )
    return checks.check_settings(jobs)


@query("""
SELECT doc_id::VARCHAR AS dataset_id, 'Invalid dataset id' AS message FROM documents WHERE n_chars >= 2000
UNION ALL
SELECT 'data-' || right('000' || doc_id::VARCHAR, 4), 'Dataset title is required'
FROM documents WHERE n_chars < 2000 AND lang = 'en'
""")
def check_metadata(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    uid = F.concat(F.lit("data-"), F.right(F.concat(F.lit("000"), key), F.lit(4)))
    updates = table(spark, sf_dir, "documents").select(
        F.when(F.col("n_chars") >= 2000, key).otherwise(uid).alias("dataset_id"),
        F.when(F.col("lang") == "en", "  ").otherwise(F.col("source")).alias("title"),
    )
    return checks.check_metadata(updates)


# Matching: each order is a dataset with a column per part it holds, and a file whose headers
# spell the parts in another way.
NAMES_SQL = """parts AS (
  SELECT DISTINCT l_orderkey AS id, p_name FROM lineitem JOIN part ON p_partkey = l_partkey),
columns AS (
  SELECT id AS dataset_id, row_number() OVER (PARTITION BY id ORDER BY p_name) - 1 AS pos,
         replace(p_name, ' ', '_') AS field_name, upper(p_name) || ' (n)' AS display_name
  FROM parts),
headers AS (
  SELECT id AS file_id, id AS dataset_id,
         row_number() OVER (PARTITION BY id ORDER BY p_name) - 1 AS pos,
         CASE WHEN length(p_name) % 3 = 0 THEN upper(p_name) || '  (n)'
              WHEN length(p_name) % 3 = 1 THEN upper(p_name[1]) || substr(p_name, 2)
              ELSE replace(p_name, ' ', '-') || '!' END AS name
  FROM parts)"""


def _part_names(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("p_partkey")
    )
    named = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    # the distinct part names bound the list of one order
    lists = named.groupBy("id").agg(F.array_sort(F.collect_set("p_name")).alias("_names"))
    return lists.select("id", F.posexplode("_names").alias("pos", "p_name"))


def name_columns(spark, sf_dir):
    return _part_names(spark, sf_dir).select(
        F.col("id").alias("dataset_id"), "pos",
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("field_name"),
        F.concat(F.upper("p_name"), F.lit(" (n)")).alias("display_name"),
    )


def name_headers(spark, sf_dir):
    rest = F.length("p_name") % 3
    name = (
        F.when(rest == 0, F.concat(F.upper("p_name"), F.lit("  (n)")))
        .when(rest == 1, F.concat(F.upper(F.left("p_name", F.lit(1))), F.substr("p_name", F.lit(2))))
        .otherwise(F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("!")))
    )
    return _part_names(spark, sf_dir).select(
        F.col("id").alias("file_id"), F.col("id").alias("dataset_id"), "pos", name.alias("name")
    )


# The two weighted distances, cell by cell: one step of the recursion adds one cell of the table,
# and only the last row of cells is kept.
SCORES_SQL = f"""{NAMES_SQL},
pairs AS (SELECT DISTINCT h.name AS h, c.field_name AS f FROM headers h JOIN columns c USING (dataset_id)),
cost(h, f, a, b, back) AS (
  SELECT h, f, h, f, false FROM pairs UNION ALL SELECT h, f, f, h, true FROM pairs),
cells(h, f, a, b, back, k, last) AS (
  SELECT h, f, a, b, back, 0, [0.0::DOUBLE] FROM cost
  UNION ALL
  SELECT h, f, a, b, back, k + 1,
    list_append(
      CASE WHEN len(last) > length(b) + 1 THEN last[2:] ELSE last END,
      CASE
        WHEN (k + 1) < length(b) + 1 THEN last[-1] + CASE WHEN back THEN 0.0 ELSE 1.0 END
        WHEN (k + 1) % (length(b) + 1) = 0 THEN last[-(length(b) + 1)] + dcost
        ELSE least(
          last[-1] + CASE WHEN back THEN 0.0 ELSE 1.0 END,
          last[-(length(b) + 1)] + dcost,
          last[-(length(b) + 2)] + CASE
            WHEN ca = cb THEN 0.0
            WHEN back THEN CASE WHEN ca = '_' AND NOT regexp_full_match(cb, '[A-Za-z0-9]') THEN 0.0 ELSE 1.0 END
            WHEN cb = '_' AND NOT regexp_full_match(ca, '[A-Za-z0-9]') THEN 0.1
            WHEN regexp_full_match(ca, '[A-Z]') AND regexp_full_match(cb, '[a-z]') THEN 0.1
            ELSE 1.0 END)
      END)
  FROM (
    SELECT *, a[(k + 1) // (length(b) + 1)] AS ca, b[(k + 1) % (length(b) + 1)] AS cb,
           CASE WHEN back OR regexp_full_match(a[(k + 1) // (length(b) + 1)], '[A-Za-z0-9_]') THEN 1.0
                ELSE 0.1 END AS dcost
    FROM cells) t
  WHERE k + 1 < (length(a) + 1) * (length(b) + 1)),
done AS (SELECT h, f, back, last[-1] AS d FROM cells WHERE k + 1 = (length(a) + 1) * (length(b) + 1)),
by_field AS (
  SELECT x.h, x.f, CASE WHEN y.d < length(x.f) * 0.25 THEN x.d ELSE 'Infinity'::DOUBLE END AS d
  FROM done x JOIN done y ON x.h = y.h AND x.f = y.f AND NOT x.back AND y.back),
scored AS (
  SELECT h.file_id, h.dataset_id, h.pos AS header_pos, h.name AS header, c.pos AS column_pos, c.field_name,
         least(b.d, CASE WHEN levenshtein(h.name, c.display_name)
                              < greatest(length(h.name), length(c.display_name)) * 0.25
                         THEN levenshtein(h.name, c.display_name)::DOUBLE ELSE 'Infinity'::DOUBLE END) AS badness
  FROM headers h JOIN columns c USING (dataset_id) JOIN by_field b ON b.h = h.name AND b.f = c.field_name),
finite AS (SELECT * REPLACE (round(badness, 6) AS badness) FROM scored WHERE badness < 'Infinity'::DOUBLE)"""


@query(f"WITH RECURSIVE {SCORES_SQL} SELECT * FROM finite")
def score_columns(spark, sf_dir):
    scored = match.score_columns(name_headers(spark, sf_dir), name_columns(spark, sf_dir))
    return scored.withColumn("badness", F.round("badness", 6))


@query(f"""
WITH RECURSIVE {SCORES_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY badness, header_pos, column_pos) AS r
  FROM finite),
walk(file_id, r, used_h, used_c, taken) AS (
  SELECT DISTINCT file_id, 0::BIGINT, []::BIGINT[], []::BIGINT[], []::BIGINT[] FROM ranked
  UNION ALL
  SELECT file_id, rank,
         CASE WHEN free THEN list_append(used_h, header_pos) ELSE used_h END,
         CASE WHEN free THEN list_append(used_c, column_pos) ELSE used_c END,
         CASE WHEN free THEN list_append(taken, rank) ELSE taken END
  FROM (SELECT w.*, k.header_pos, k.column_pos, k.r AS rank,
               NOT list_contains(used_h, k.header_pos) AND NOT list_contains(used_c, k.column_pos) AS free
        FROM walk w JOIN ranked k ON k.file_id = w.file_id AND k.r = w.r + 1) s),
final AS (SELECT file_id, arg_max(taken, r) AS taken FROM walk GROUP BY file_id),
chosen AS (SELECT k.* FROM final f JOIN ranked k ON k.file_id = f.file_id AND list_contains(f.taken, k.r))
SELECT h.file_id, h.dataset_id, h.pos AS header_pos, h.name AS header, c.field_name, c.badness
FROM headers h LEFT JOIN chosen c ON c.file_id = h.file_id AND c.header_pos = h.pos
""")
def match_columns(spark, sf_dir):
    matched = match.match_columns(name_headers(spark, sf_dir), name_columns(spark, sf_dir))
    return matched.withColumn("badness", F.round("badness", 6))


def _statistics_sql(table_name: str, columns: dict[str, str]) -> str:
    def one(i: int, name: str, kind: str) -> str:
        mean = (f"round(sum({name}::DECIMAL(38,6))::DOUBLE / count({name}), 4)" if kind == "n"
                else "-1::DOUBLE")
        short = f"min(length({name}))::INT" if kind == "s" else "-1"
        long = f"max(length({name}))::INT" if kind == "s" else "-1"
        return f"""
SELECT {i} AS pos, '{name}' AS column_name, count(*) AS rows, count(*) - count({name}) AS nulls,
       count(DISTINCT {name}) AS distinct_values, min({name})::VARCHAR AS smallest,
       max({name})::VARCHAR AS largest, {mean} AS mean, {short} AS shortest, {long} AS longest
FROM {table_name}"""

    return " UNION ALL ".join(one(i, n, k) for i, (n, k) in enumerate(columns.items()))


def _statistics_shown(found):
    """Rounded means; -1 where a figure does not apply."""
    return found.withColumns(
        {
            "mean": F.coalesce(F.round("mean", 4), F.lit(-1.0)),
            "shortest": F.coalesce("shortest", F.lit(-1)),
            "longest": F.coalesce("longest", F.lit(-1)),
        }
    )


@query(_statistics_sql("orders", {
    "o_orderkey": "n", "o_custkey": "n", "o_orderstatus": "s", "o_totalprice": "n",
    "o_orderdate": "t", "o_orderpriority": "s"}))
def column_statistics(spark, sf_dir):
    found = profile.column_statistics(table(spark, sf_dir, "orders"), exact=True)
    return _statistics_shown(found)


@query(
    "SELECT * EXCLUDE (distinct_values) FROM ("
    + _statistics_sql("lineitem", {
        "l_orderkey": "n", "l_partkey": "n", "l_suppkey": "n", "l_linenumber": "n",
        "l_quantity": "n", "l_extendedprice": "n", "l_discount": "n", "l_tax": "n",
        "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"})
    + ")"
)
def column_statistics_quick(spark, sf_dir):
    """The estimate of distinct values is not SQL-comparable; all other columns are."""
    found = profile.column_statistics(table(spark, sf_dir, "lineitem"))
    return _statistics_shown(found.drop("distinct_values"))


@query(f"""
WITH {COLUMNS_SQL}
SELECT dataset_id, count(*) FILTER (WHERE type = 'location') AS locations,
       count(*) FILTER (WHERE type = 'point') AS points FROM dataset_columns GROUP BY dataset_id
""")
def count_types(spark, sf_dir):
    return profile.count_types(dataset_columns(spark, sf_dir))


@query(f"""
WITH {COLUMNS_SQL}
SELECT * FROM dataset_columns d WHERE field_name <> '5-LOW'
AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = dataset_id AND o_orderpriority = field_name
                AND o_orderstatus = 'F')
""")
def unmapped_columns(spark, sf_dir):
    """Mapped: priorities of finished orders. Ignored: one priority, everywhere."""
    columns = dataset_columns(spark, sf_dir)
    mapped = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("dataset_id"), F.col("o_orderpriority").alias("field_name")
    )
    ignored = columns.filter(F.col("field_name") == "5-LOW")
    return profile.unmapped_columns(columns, mapped, ignored)


@query(f"""
WITH {COLUMNS_SQL}
SELECT dataset_id, string_agg('"' || field_name || '"', ',' ORDER BY pos) AS quoted,
       count(*) AS width,
       string_agg(field_name || '=' || type, ';' ORDER BY pos) AS types
FROM dataset_columns GROUP BY dataset_id
""")
def field_lists(spark, sf_dir):
    listed = profile.field_list(dataset_columns(spark, sf_dir))
    pairs = F.transform("fields", lambda f: F.concat(f, F.lit("="), F.col("types")[f]))
    return listed.select(
        "dataset_id", "quoted", F.size("fields").cast("bigint").alias("width"),
        F.array_join(pairs, ";").alias("types"),
    )


@query(f"""
WITH {COLUMNS_SQL}
SELECT o_orderkey, o_custkey AS dataset_id, w.name, c.field_name
FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN lower(o_orderpriority) ELSE '3-Medium' END AS name
      FROM orders) w
LEFT JOIN dataset_columns c ON c.dataset_id = o_custkey AND lower(c.field_name) = lower(w.name)
""")
def find_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "dataset_id": F.col("o_custkey"),
            "name": F.when(F.col("o_orderstatus") == "O", F.lower("o_orderpriority")).otherwise("3-Medium"),
        }
    )
    asked = orders.select("dataset_id", "name").distinct()
    found = profile.find_column(dataset_columns(spark, sf_dir), asked)
    return orders.select("o_orderkey", "dataset_id", "name").join(found, ["dataset_id", "name"])


@query(f"""
WITH {COLUMNS_SQL}
SELECT dataset_id, CASE WHEN type = 'text' THEN 'sum_' || field_name ELSE field_name END AS field_name,
       CASE WHEN type = 'point' THEN 1 ELSE 0 END::INT AS left_over
FROM dataset_columns
""")
def grouped_columns(spark, sf_dir):
    """Columns of grouped views with their format maps."""
    entries = F.map_from_entries(
        F.array_compact(
            F.array(
                F.when(F.col("type") == "text",
                       F.struct(F.lit("grouping_aggregate").alias("k"), F.lit("sum").alias("v"))),
                F.when(F.col("type") != "location",
                       F.struct(F.lit("drill_down").alias("k"), F.lit("true").alias("v"))),
                F.when(F.col("type") == "point", F.struct(F.lit("align").alias("k"), F.lit("right").alias("v"))),
            )
        )
    )
    adapted = port.adapt_grouped_columns(dataset_columns(spark, sf_dir).withColumn("format", entries))
    return adapted.select("dataset_id", "field_name", F.size("format").alias("left_over"))


def catalog_rows(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("dataset_id"),
        F.concat(F.lit("Text "), F.col("doc_id").cast("string")).alias("title"),
        F.col("lang").alias("description"),
        F.col("source").alias("category"),
        F.array("lang", "source").alias("tags"),
        F.lit("CC_40_BY").alias("license_id"),
        F.lit(None).cast("string").alias("attribution"),
        F.lit("http://example.org/").alias("attribution_link"),
        F.when(F.col("lang") == "en", F.create_map(F.lit("owner"), "source")).alias("private"),
    )


def _updates(spark, sf_dir):
    n = F.lit(None).cast("string")
    rated = table(spark, sf_dir, "labels")
    return rated.select(
        F.col("doc_id").alias("dataset_id"),
        F.concat(F.lit("Rated "), F.col("quality").cast("string")).alias("title"),
        n.alias("description"),
        F.lit("rated").alias("category"),
        F.when(F.col("quality") == 1, F.array(F.lit("good"))).alias("keywords"),
        F.when(F.col("toxic") == 1, F.lit("")).alias("license_id"),
        F.lit("raters").alias("data_provided_by"),
        n.alias("source_link"),
        F.lit("desk@example.org").alias("contact_info"),
    )


_METADATA_SQL = """
SELECT doc_id AS dataset_id,
  CASE WHEN rated THEN 'Rated ' || quality::VARCHAR ELSE 'Text ' || doc_id::VARCHAR END AS title,
  CASE WHEN rated THEN NULL ELSE lang END AS description,
  CASE WHEN rated THEN 'rated' ELSE source END AS category,
  CASE WHEN NOT rated THEN lang || ',' || source WHEN quality = 1 THEN 'good' ELSE '' END AS keywords,
  CASE WHEN rated AND toxic = 1 THEN '' ELSE 'CC_40_BY' END AS license_id,
  CASE WHEN rated THEN 'raters' END AS data_provided_by,
  CASE WHEN rated THEN NULL ELSE 'http://example.org/' END AS source_link,
  CASE WHEN rated THEN 'desk@example.org' END AS contact_info
FROM (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic, l.doc_id IS NOT NULL AS rated
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""


@query(_METADATA_SQL)
def update_metadata(spark, sf_dir):
    """Ratings written over the catalogue records of their texts, and read back."""
    after = catalog.update_metadata(catalog_rows(spark, sf_dir), _updates(spark, sf_dir))
    return catalog.read_metadata(after).withColumn("keywords", F.array_join("keywords", ","))


@query(_METADATA_SQL)
def update_metadata_repeated(spark, sf_dir):
    """The same ratings after earlier ones of the same texts; the later of two updates counts."""
    later = _updates(spark, sf_dir).withColumn("at", F.lit(2))
    earlier = later.withColumn("at", F.lit(1)).withColumn("title", F.lit("Not yet rated"))
    after = catalog.update_metadata(
        catalog_rows(spark, sf_dir), later.unionByName(earlier), F.col("at")
    )
    return catalog.read_metadata(after).withColumn("keywords", F.array_join("keywords", ","))


@query("""
SELECT doc_id AS dataset_id, 'PUBLISH_ERROR' AS status,
       'No dataset has this id, or publishing to it is not allowed' AS message
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def unknown_metadata(spark, sf_dir):
    """Updates for every text against a catalogue that only knows the rated ones."""
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("dataset_id"))
    return catalog.unknown_datasets(known, catalog_rows(spark, sf_dir).select("dataset_id"))


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'CC_40_BY' WHEN 'fr' THEN 'ODBL' ELSE '' END AS license_id,
       CASE lang WHEN 'en' THEN 'Creative Commons Attribution 4.0 International'
                 WHEN 'fr' THEN 'Open Data Commons Open Database License'
                 ELSE '-- No License --' END AS license_label
FROM documents
""")
def lookup_license(spark, sf_dir):
    code = F.when(F.col("lang") == "en", "CC_40_BY").when(F.col("lang") == "fr", "ODBL").otherwise("odbl")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return catalog.lookup_license(docs, catalog.licenses(spark), code).drop("lang")


# Events read as a job log: the user is the job, the type is the event type.
def event_log(spark, sf_dir):
    """Events written as log lines and scanned as a job log."""
    e = table(spark, sf_dir, "events")
    number = (F.col("value") * 100).cast("bigint")
    data = F.struct(
        F.col("user_id").cast("string").alias("jobId"),
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("dataset"),
        F.lit("in.csv").alias("filename"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(F.col("event_type") != "error", number).alias("duration"),
        F.col("event_id").cast("int").alias("inserted"),
        F.lit(0).alias("updated"),
        F.lit(1).alias("deleted"),
        F.when(F.col("event_type") == "error",
               F.struct(F.lit("bad cell").alias("type"), F.lit("amount").alias("column"),
                        F.col("value").cast("string").alias("value"), number.alias("record"),
                        F.array(F.lit("number"), F.lit("date")).alias("expectedType"))).alias("details"),
        F.when(F.col("event_type") == "view",
               F.struct(F.col("event_id").cast("string").alias("opaque"))).alias("control"),
        F.when(F.col("event_type") == "signup",
               F.struct(F.col("event_id").cast("string").alias("opaque"))).alias("portControl"),
    )
    kind = (
        F.when(F.col("event_type") == "view", "Committing-Job").when(F.col("event_type") == "click", "finished")
        .when(F.col("event_type") == "error", "failure").otherwise(F.col("event_type"))
    )
    path = scratch_path(spark, "job-log")
    e.select(kind.alias("type"), data.alias("data"), F.lit(1).alias("ignored")).write.json(path)
    return scan_job_log(spark, path, json_lines=True)


def _micros(name: str):
    return F.unix_micros(F.col("at")).alias(name)


@query("""
SELECT user_id::VARCHAR AS job_id, epoch_us(min(ts)) AS at_micros,
       arg_min(event_id, ts)::VARCHAR AS opaque
FROM events WHERE event_type = 'view' GROUP BY user_id
""")
def first_event(spark, sf_dir):
    log = event_log(spark, sf_dir).withColumn("pos", F.col("at"))
    return joblog.first_event(log, "committing-job").select("job_id", _micros("at_micros"), "opaque")


@query("""
SELECT user_id::VARCHAR AS job_id, arg_min(event_id, ts)::INT AS rows_created, 0::INT AS rows_updated,
       1::INT AS rows_deleted
FROM events WHERE event_type = 'click' GROUP BY user_id
""")
def crud_counts(spark, sf_dir):
    log = event_log(spark, sf_dir).withColumn("pos", F.col("at"))
    return joblog.crud_counts(log).drop("errors")


@query("""
SELECT CASE event_type WHEN 'view' THEN 'Committing-Job' WHEN 'click' THEN 'finished' ELSE event_type END AS stage,
       count(*) AS events, sum(d)::BIGINT AS total, max(d) AS longest,
       quantile_disc(d, 0.5) AS p50, quantile_disc(d, 0.95) AS p95
FROM (SELECT *, trunc(value * 100)::BIGINT AS d FROM events WHERE event_type <> 'error')
GROUP BY event_type
""")
def stage_durations(spark, sf_dir):
    return joblog.stage_durations(event_log(spark, sf_dir), accuracy=100_000)


@query("""
SELECT user_id::VARCHAR AS job_id, 'bad cell' AS reason, 'amount' AS "column", value::VARCHAR AS "value",
       trunc(value * 100)::BIGINT AS record, unnest(['number', 'date']) AS expected_type
FROM events WHERE event_type = 'error'
""")
def failure_details(spark, sf_dir):
    return joblog.failure_details(event_log(spark, sf_dir))


@query("""
SELECT 'd' || user_id::VARCHAR AS dataset_id, event_id::VARCHAR AS opaque,
       CASE WHEN event_type = 'view' THEN user_id::VARCHAR END AS job_id,
       CASE WHEN event_type <> 'view' THEN 'NOT_COMMITTING'
            WHEN value > 100 THEN 'COMMITTED'
            WHEN EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.value > 100) THEN 'COMMITTED'
            ELSE 'COMMITTING' END AS state
FROM events e
""")
def commit_state(spark, sf_dir):
    """Every event is a submission; views were taken by a job. A job with a large event counts as
    committed."""
    log = event_log(spark, sf_dir)
    submissions = table(spark, sf_dir, "events").select(
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("dataset_id"),
        F.col("event_id").cast("string").alias("opaque"),
    )
    job_log = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        F.when(F.col("value") > 100, "Committed-Job").otherwise("processing").alias("type"),
    )
    return joblog.commit_state(submissions, log, job_log)


@query("""
SELECT event_id, coalesce(floor(user_id * 100 / nullif(trunc(value)::BIGINT, 0))::INT, -1) AS percent,
       CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'error' THEN 'PUBLISH_ERROR' END AS outcome
FROM events
""")
def progress(spark, sf_dir):
    kind = F.col("event_type")
    status = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("rows"),
        F.col("value").cast("bigint").alias("total"),
        F.when(kind == "view", "SUCCESS: done").when(kind == "error", "FAILURE: no").otherwise(kind)
        .alias("english"),
    )
    return joblog.progress(status).select(
        "event_id", F.coalesce("percent", F.lit(-1)).alias("percent"), "outcome"
    )


@query("""
SELECT user_id AS job_id, max(ts) AS at, arg_max(event_type, ts) AS type, arg_max(value, ts) AS value
FROM events GROUP BY user_id
""")
def latest_status(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), F.col("ts").alias("at"), F.col("event_type").alias("type"),
        "value",
    )
    return joblog.latest_status(events)
