"""Registered queries: composite columns, geographic files, layers and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.control import Control
from rowharbor.operators import geo, layers
from rowharbor.operators.typing import ERRORS
from rowharbor.plans import jobs
from rowharbor.plans.publish_queries import upsert_sql, incoming_orders, stored_orders
from rowharbor.plans.registry import query, table
from rowharbor.plans.scan_queries import ORDERS, PLAIN
from rowharbor.runtime import scratch_path
from rowharbor.sources.geo import scan_geojson, scan_kml
from rowharbor.sources.sinks import write_delimited
from rowharbor.sources.store import DatasetStore
from rowharbor.streaming.ingest import ingest_stream
from rowharbor.streaming.status import closed_jobs as closed_stream
from rowharbor.streaming.status import current_status, status_stream, write_closed, write_status


@query("""
SELECT c_custkey, c_name AS address, c_mktsegment AS city, c_nationkey::VARCHAR AS zip, c_acctbal AS latitude
FROM customer
""")
def synthetic_location(spark, sf_dir):
    parts = {"address": "c_name", "city": "c_mktsegment", "zip": "c_nationkey", "latitude": "c_acctbal"}
    made = geo.synthetic_location(table(spark, sf_dir, "customer"), "place", parts)
    return made.select(
        "c_custkey", "place.address", "place.city", "place.zip", "place.latitude"
    )


@query("""
SELECT p_partkey,
       CASE WHEN p_retailprice <= 990 THEN p_retailprice / 10 - 9 END AS lat,
       CASE WHEN p_retailprice <= 990 THEN p_size::DOUBLE END AS lon,
       (p_retailprice > 990)::INT AS faults
FROM part
""")
def synthetic_point(spark, sf_dir):
    """Latitudes above 90 are errors."""
    price = F.col("p_retailprice")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(price <= 990, price / 10 - 9).otherwise(price).cast("string").alias("lat"),
        F.col("p_size").cast("string").alias("lon"),
    )
    made = geo.synthetic_point(rows, "spot", "lat", "lon")
    return made.select(
        "p_partkey", F.col("spot.latitude").alias("lat"), F.col("spot.longitude").alias("lon"),
        F.size(ERRORS).alias("faults"),
    )


@query("""
SELECT c_custkey, CASE WHEN n_regionkey < 3 THEN n_nationkey::DOUBLE END AS lat,
       CASE WHEN n_regionkey < 3 THEN n_regionkey::DOUBLE END AS lon
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def geocode_join(spark, sf_dir):
    """Customers placed by the nation they name, in another spelling; some nations are unknown."""
    nation = table(spark, sf_dir, "nation")
    gazetteer = nation.filter(F.col("n_regionkey") < 3).select(
        F.col("n_name").alias("country"), F.lit("any").alias("city"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(" Nation "), F.col("c_nationkey").cast("string"), F.lit(".")).alias("land"),
        F.lit("ANY").alias("town"),
    )
    made = geo.geocode_join(rows, gazetteer, "spot", {"city": "town", "country": "land"})
    return made.select(
        "c_custkey", F.col("spot.latitude").alias("lat"), F.col("spot.longitude").alias("lon")
    )


@query("""
SELECT p_brand AS layer, 'EPSG:4326' AS reference_system, p_name AS title, 'Point' AS geometry_type,
       '[' || p_size::VARCHAR || ',' || p_partkey::VARCHAR || ']' AS coordinates
FROM part
""")
def scan_geojson_features(spark, sf_dir):
    """Parts as features, one collection per line."""
    part = table(spark, sf_dir, "part")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.create_map(F.lit("title"), "p_name").alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("p_size", "p_partkey").alias("coordinates"))
        .alias("geometry"),
    )
    collection = part.select(
        F.lit("FeatureCollection").alias("type"),
        F.col("p_brand").alias("name"),
        F.struct(F.struct(F.lit("EPSG:4326").alias("name")).alias("properties")).alias("crs"),
        F.array(feature).alias("features"),
    )
    path = scratch_path(spark, "geojson")
    collection.write.json(path)
    return scan_geojson(spark, path, sequence=True).select(
        "layer", "reference_system", F.variant_get("properties", "$.title", "string").alias("title"),
        "geometry_type", "coordinates",
    )


@query("""
SELECT s_name AS name, CASE WHEN s_acctbal > 5000 THEN 'Point' ELSE 'LineString' END AS geometry_type,
       CASE WHEN s_acctbal > 5000 THEN s_nationkey::VARCHAR || ',' || s_suppkey::VARCHAR
            ELSE '0,0 ' || s_nationkey::VARCHAR || ',1' END AS coordinates
FROM supplier
""")
def scan_kml_placemarks(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey").cast("string")
    point = F.concat(F.lit("<Point><coordinates> "), nation, F.lit(","), F.col("s_suppkey").cast("string"),
                     F.lit(" </coordinates></Point>"))
    line = F.concat(F.lit("<LineString><coordinates>0,0 "), nation, F.lit(",1</coordinates></LineString>"))
    mark = F.concat(
        F.lit("<Placemark><name>"), "s_name", F.lit("</name>"),
        F.when(F.col("s_acctbal") > 5000, point).otherwise(line), F.lit("</Placemark>"),
    )
    path = scratch_path(spark, "kml")
    s.select(mark.alias("value")).write.text(path)
    return scan_kml(spark, path, sequence=True).select("name", "geometry_type", "coordinates")


@query("""
SELECT p_brand AS layer, p_partkey AS id, p_size AS size, typeof(p_size) = 'INTEGER' AS whole, p_name AS title,
       CASE p_size % 3 WHEN 0 THEN 'Point' WHEN 1 THEN 'MultiPoint' ELSE 'GeometryCollection' END AS geometry_type,
       CASE p_size % 3 WHEN 0 THEN '[' || p_size || ',1]' WHEN 1 THEN '[[0,0],[' || p_size || ',1]]' END AS coordinates,
       unnest(CASE p_size % 3 WHEN 0 THEN ['Point [' || p_size || ',1]'] WHEN 1 THEN ['MultiPoint [[0,0],[' || p_size || ',1]]']
              ELSE ['Point [' || p_size || ',1]', 'LineString [[0,0],[2,' || p_size || ']]'] END) AS part
FROM part
""")
def scan_geojson_documents(spark, sf_dir):
    """Whole documents, one per brand, with typed properties and geometries of several parts."""
    part = table(spark, sf_dir, "part")
    size, kind = F.col("p_size"), F.col("p_size") % 3
    point = F.format_string('{"type": "Point", "coordinates": [%d, 1]}', size)
    shape = (
        F.when(kind == 0, point)
        .when(kind == 1, F.format_string('{"type": "MultiPoint",\n "coordinates": [[0, 0], [%d, 1]]}', size))
        .otherwise(F.concat(F.lit('{"type": "GeometryCollection", "geometries": ['), point,
                            F.format_string(', {"type": "LineString", "coordinates": [[0, 0], [2, %d]]}]}', size)))
    )
    feature = F.concat(
        F.format_string('{"type": "Feature", "id": %d, "properties": {"size": %d, "title": ', "p_partkey", "p_size"),
        F.to_json(F.struct(F.col("p_name").alias("t")).alias("s")).substr(F.lit(6), F.length("p_name") + 2), F.lit('},\n "geometry": '), shape, F.lit("}"))
    listed = part.groupBy("p_brand").agg(F.array_join(F.collect_list(feature), ",\n").alias("f"))  # a document of each brand
    whole = F.concat(F.lit('{"type": "FeatureCollection",\n "name": "'), "p_brand", F.lit('", "features": [\n'), "f", F.lit("]}"))
    path = scratch_path(spark, "geojson")
    listed.select(whole.alias("value"), "p_brand").write.partitionBy("p_brand").text(path)
    found = scan_geojson(spark, path)
    size_type = F.schema_of_variant(F.variant_get("properties", "$.size", "variant"))
    return found.select(
        "layer", F.col("feature_id").cast("bigint").alias("id"), F.variant_get("properties", "$.size", "int").alias("size"),
        (size_type == "BIGINT").alias("whole"), F.variant_get("properties", "$.title", "string").alias("title"),
        "geometry_type", "coordinates", F.explode("parts").alias("p"),
    ).select("layer", "id", "size", "whole", "title", "geometry_type", "coordinates",
             F.concat_ws(" ", "p.type", "p.coordinates").alias("part"))


@query("""
SELECT s_name AS name, s_nationkey::VARCHAR AS nation,
       CASE WHEN s_suppkey % 2 = 0 THEN 'MultiGeometry' ELSE 'Polygon' END AS geometry_type,
       CASE WHEN s_suppkey % 2 = 0 THEN 3 ELSE 1 END::INT AS parts,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Point ' || s_suppkey || ',1|LineString 0,0 ' || s_suppkey || ',1|Point 9,9'
            ELSE 'Polygon 0,0 5,0 ' || s_suppkey || ',5 0,0' END AS shapes,
       CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE '1,1 2,1 1,2 1,1' END AS hole
FROM supplier
""")
def scan_kml_geometries(spark, sf_dir):
    """Whole documents, one per nation: geometries of several parts, polygons with holes, extended data."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    ring = "<LinearRing><coordinates>{}</coordinates></LinearRing>"
    polygon = F.concat(
        F.lit("<Polygon><outerBoundaryIs><LinearRing><coordinates> 0,0 5,0 "), key, F.lit(",5 0,0</coordinates></LinearRing></outerBoundaryIs>"),
        F.lit(f"<innerBoundaryIs>{ring.format('1,1 2,1 1,2 1,1')}</innerBoundaryIs></Polygon>"))
    several = F.concat(
        F.lit("<MultiGeometry><LineString><coordinates>0,0 "), key, F.lit(",1</coordinates></LineString>\n<Point><coordinates>"), key,
        F.lit(",1 </coordinates></Point><MultiGeometry><Point><coordinates>9,9</coordinates></Point></MultiGeometry></MultiGeometry>"))
    mark = F.concat(
        F.lit("<Placemark><name>"), "s_name", F.lit('</name><ExtendedData><Data name="nation"><value>'),
        F.col("s_nationkey").cast("string"), F.lit("</value></Data></ExtendedData>"),
        F.when(F.col("s_suppkey") % 2 == 0, several).otherwise(polygon), F.lit("</Placemark>\n"))
    document = s.groupBy("s_nationkey").agg(F.array_join(F.collect_list(mark), "").alias("marks"))
    path = scratch_path(spark, "kml")
    whole = F.concat(F.lit("<kml><Document>\n"), "marks", F.lit("</Document></kml>"))
    document.select(whole.alias("value"), "s_nationkey").write.partitionBy("s_nationkey").text(path)
    return scan_kml(spark, path).select(
        "name", F.col("properties")["nation"].alias("nation"), "geometry_type", F.size("parts").alias("parts"),
        F.array_join(F.transform("parts", lambda p: F.concat_ws(" ", p["type"], p["coordinates"])), "|").alias("shapes"),
        F.get(F.get("parts", F.lit(0))["holes"], F.lit(0)).alias("hole"),
    )


# Layers: each customer is a geographic dataset; open orders give the layers of the file, filled
# ones the layers that exist, both named after the priority.
LAYERS_SQL = """file_layers AS (
  SELECT DISTINCT o_custkey AS dataset_id, o_orderpriority AS layer FROM orders WHERE o_orderstatus = 'O'),
existing AS (
  SELECT DISTINCT o_custkey AS dataset_id, o_orderpriority AS layer,
         o_custkey::VARCHAR || '/' || o_orderpriority AS uid FROM orders WHERE o_orderstatus <> 'O'),
n AS (
  SELECT dataset_id, nf = 1 AND ne = 1 AS single
  FROM (SELECT dataset_id, count(*) AS nf FROM file_layers GROUP BY 1)
  JOIN (SELECT dataset_id, count(*) AS ne FROM existing GROUP BY 1) USING (dataset_id)),
layer_map AS (
  SELECT f.dataset_id, f.layer, e.uid FROM file_layers f JOIN existing e ON e.dataset_id = f.dataset_id
  JOIN n ON n.dataset_id = f.dataset_id WHERE n.single OR e.layer = f.layer)"""


def _layers(spark, sf_dir, rows):
    return table(spark, sf_dir, "orders").filter(rows).select(
        F.col("o_custkey").alias("dataset_id"), F.col("o_orderpriority").alias("layer")
    ).distinct()


def existing_layers(spark, sf_dir):
    uid = F.concat(F.col("dataset_id").cast("string"), F.lit("/"), F.col("layer"))
    return _layers(spark, sf_dir, F.col("o_orderstatus") != "O").withColumn("uid", uid)


@query(f"""
WITH {LAYERS_SQL}
SELECT f.dataset_id, f.layer, m.uid AS replaces FROM file_layers f
LEFT JOIN layer_map m ON m.dataset_id = f.dataset_id AND m.layer = f.layer
""")
def map_layers(spark, sf_dir):
    file_layers = _layers(spark, sf_dir, F.col("o_orderstatus") == "O")
    mapping = layers.map_layers(file_layers, existing_layers(spark, sf_dir))
    return layers.apply_layer_map(file_layers, mapping)


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
def replace_layers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("dataset_id"), F.col("o_orderpriority").alias("layer"),
        F.col("o_orderkey").alias("feature"), "o_orderstatus",
    )
    uid = F.concat(F.col("dataset_id").cast("string"), F.lit("/"), F.col("layer"))
    target = orders.filter(F.col("o_orderstatus") != "O").select("dataset_id", uid.alias("uid"), "feature")
    features = orders.filter(F.col("o_orderstatus") == "O").drop("o_orderstatus")
    mapping = layers.map_layers(_layers(spark, sf_dir, F.col("o_orderstatus") == "O"), existing_layers(spark, sf_dir))
    return layers.replace_layers(target, features, mapping)


@query("""
SELECT c_nationkey AS dataset_id, c_mktsegment AS layer, count(*) AS features,
       'EPSG:' || max(c_nationkey)::VARCHAR AS reference_system,
       grouping(c_mktsegment)::INT AS is_total
FROM customer GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_nationkey))
""")
def scan_summary(spark, sf_dir):
    features = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("dataset_id"), F.col("c_mktsegment").alias("layer"),
        F.concat(F.lit("EPSG:"), F.col("c_nationkey").cast("string")).alias("reference_system"),
    )
    return layers.scan_summary(features).withColumn("is_total", F.col("is_total").cast("int"))


def _finish(stream):
    """Wait for a stream that stops by itself, and fail where it failed."""
    stream.awaitTermination()


@query(f"SELECT * EXCLUDE (action) FROM ({upsert_sql('patch')})")
def ingest_files(spark, sf_dir):
    """Files of changed orders that arrive in a folder, published batch by batch."""
    root = scratch_path(spark, "ingest")
    store = DatasetStore(spark, f"{root}/store")
    jobs.create_dataset(store, "orde-rs01", stored_orders(spark, sf_dir), "o_orderkey")
    arriving = incoming_orders(spark, sf_dir).repartitionByRange(4, "o_orderkey")
    write_delimited(arriving, f"{root}/incoming")
    file = PLAIN.with_options(columns=list(ORDERS), skip=1)
    _finish(
        ingest_stream(
            spark, f"{root}/incoming", Control("Upsert", None, file), store, "orde-rs01", ORDERS,
            "o_orderkey", f"{root}/checkpoint", max_files=2,
        )
    )
    return store.read("orde-rs01")


@query("""
SELECT user_id AS job_id, max(ts) AS at, arg_max(event_type, ts) AS type FROM events GROUP BY user_id
""")
def latest_status_stream(spark, sf_dir):
    """Events that arrive in files, reduced to the newest per job while they come in."""
    root = scratch_path(spark, "status")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), F.col("ts").alias("at"), F.col("event_type").alias("type")
    )
    events.repartitionByRange(4, "at").write.parquet(f"{root}/events")
    arriving = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2)
        .parquet(f"{root}/events")
    )
    _finish(write_status(status_stream(arriving, ["at"]), f"{root}/status", f"{root}/checkpoint"))
    return current_status(spark.read.parquet(f"{root}/status"))


CLOSED_SQL = """
WITH marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM events),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked)
SELECT user_id AS job_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS events,
       arg_max(event_type, (ts, event_id)) AS type
FROM numbered GROUP BY user_id, session
HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
"""


@query(CLOSED_SQL)
def closed_jobs(spark, sf_dir):
    """Events that come late, out of order and repeated: jobs closed after six hours of silence."""
    root = scratch_path(spark, "closed")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("job_id"), F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("type")
    )
    bounds = events.agg(F.min(F.unix_micros("at")).alias("a"), F.max(F.unix_micros("at")).alias("b")).first()
    span = max(1, (bounds["b"] - bounds["a"]) // 6 + 1)
    own = F.floor((F.unix_micros("at") - bounds["a"]) / span)
    # an event in five comes with the files of an hour later, and one in seven comes again
    late = F.floor((F.unix_micros("at") + 3_600_000_000 - bounds["a"]) / span)
    arriving = events.withColumn("file", F.when(F.col("event_id") % 5 == 0, late).otherwise(own))
    again = arriving.filter("event_id % 7 = 0").withColumn("file", late)
    sent = arriving.unionByName(again).withColumn("file", F.col("file").cast("int"))
    for number in range(8):  # files are taken in the order they were written
        sent.filter(F.col("file") == number).drop("file").coalesce(1).write.mode("append").parquet(f"{root}/events")
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
    )
    _finish(write_closed(closed_stream(stream, "at", "6 hours", "2 hours"), f"{root}/closed", f"{root}/checkpoint"))
    found = spark.read.schema("job_id bigint, first_at timestamp, last_at timestamp, events bigint, type string").parquet(f"{root}/closed")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_at", "last_at")})
