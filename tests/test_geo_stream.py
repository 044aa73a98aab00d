"""Geographic files, composite columns and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from rowharbor.control import Control, FileControl, Synthetic
from rowharbor.operators import geo, layers
from rowharbor.operators.typing import ERRORS
from rowharbor.plans import jobs
from rowharbor.sources.geo import scan_geojson, scan_kml
from rowharbor.sources.store import DatasetStore, PublishFailed
from rowharbor.streaming.ingest import ingest_stream
from rowharbor.streaming.status import deduplicated


def test_geojson(spark, tmp_path):
    doc = {"type": "FeatureCollection", "name": "towns",
           "crs": {"type": "name", "properties": {"name": "EPSG:4326"}},
           "features": [
               {"type": "Feature", "properties": {"n": 1, "s": "x"},
                "geometry": {"type": "Point", "coordinates": [1.5, 2]}},
               {"type": "Feature", "properties": None,
                "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(doc, indent=2))
    rows = scan_geojson(spark, str(tmp_path / "a.geojson")).orderBy("feature_no").collect()
    assert [(r.layer, r.geometry_type, r.coordinates) for r in rows] == [
        ("towns", "Point", "[1.5,2]"), ("towns", "LineString", "[[0,0],[1,1]]")]
    assert json.loads(str(rows[0].properties.toJson())) == {"n": 1, "s": "x"} and rows[0].reference_system == "EPSG:4326"


def test_kml(spark, tmp_path):
    (tmp_path / "a.kml").write_text(
        "<kml><Document><Placemark><name>A#1</name><Point><coordinates> 1,2 </coordinates></Point>"
        "</Placemark>\n<Placemark><name>B</name><Polygon><outerBoundaryIs><LinearRing>"
        "<coordinates>0,0 1,1 0,1 0,0</coordinates></LinearRing></outerBoundaryIs></Polygon>"
        "</Placemark></Document></kml>")
    rows = scan_kml(spark, str(tmp_path / "a.kml")).collect()
    assert [(r.name, r.geometry_type, r.coordinates) for r in rows] == [
        ("A#1", "Point", "1,2"), ("B", "Polygon", "0,0 1,1 0,1 0,0")]


def test_geojson_of_odd_shapes(spark, tmp_path):
    """Collections, nested ones, no geometry, and properties of several types."""
    point = {"type": "Point", "coordinates": [1, 2]}
    deep = {"type": "GeometryCollection", "geometries": [point, {"type": "GeometryCollection", "geometries": [point]}]}
    features = [{"type": "Feature", "properties": {"a": [1, {"b": None}], "x": 2.5, "t": True}, "geometry": deep},
                {"type": "Feature", "properties": None, "geometry": None}, {"type": "Feature"}]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows = scan_geojson(spark, str(tmp_path / "a.geojson")).select(
        "*", F.to_json("properties").alias("p"), F.variant_get("properties", "$.x", "double").alias("x")).orderBy("feature_no").collect()
    assert [(r.geometry_type, r.coordinates, r.x) for r in rows] == [("GeometryCollection", None, 2.5), (None, None, None), (None, None, None)]
    assert json.loads(rows[0].p) == {"a": [1, {"b": None}], "x": 2.5, "t": True}
    assert [tuple(p) for p in rows[0].parts] == [("Point", "[1,2]"), ("GeometryCollection", '[{"coordinates":[1,2],"type":"Point"}]')]
    assert rows[1].parts is None


def bytes_read(spark):
    files = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in files if s.getScheme() == "file")


@pytest.mark.parametrize("split", [None, 20_000])
def test_geojson_is_read_once(spark, tmp_path, split):
    """Ids that are numbers keep their text, and no id costs another read of the file."""
    features = ", ".join('{"type": "Feature", "id": %d.50,\n "properties": {"n": %d}, "geometry": null}' % (i, i) for i in range(3000))
    path = tmp_path / "a.geojson"
    path.write_text('{"type": "FeatureCollection",\n "name": "n", "features": [%s]}' % features)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        if split:
            for k, v in zip(names, (split, 1)):
                spark.conf.set(k, str(v))
        start = bytes_read(spark)
        found = scan_geojson(spark, str(path)).select("feature_no", "feature_id").collect()
        done = bytes_read(spark) - start
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r) for r in found) == [(i, f"{i}.50") for i in range(3000)]
    parts = -(-path.stat().st_size // split) if split else 1  # a part looks for the record's end
    assert done < 1.5 * parts * path.stat().st_size


def test_joins_on_hot_and_absent_keys(spark, tmp_path):
    """A third of the rows without a key, a third with one key: the result of a plain join, spread evenly."""
    from rowharbor.operators.skew import join_hot

    i = F.col("id")
    spark.range(60_000).select(
        F.when(i % 3 == 0, None).when(i % 3 == 1, "hot").otherwise(F.concat(F.lit("k"), (i % 20_000).cast("string"))).alias("k"), i.alias("n")
    ).write.parquet(str(tmp_path / "rows"))
    spark.range(30_000).select(F.when(i == 0, "hot").otherwise(F.concat(F.lit("k"), i.cast("string"))).alias("k"), (i * 2).alias("v")).write.parquet(str(tmp_path / "other"))
    rows, other = spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "other"))
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(key, value)
    try:
        got = join_hot(rows, other, ["k"])
        tasks = [r["count"] for r in got.filter("k is not null").groupBy(F.spark_partition_id()).count().collect()]
        assert sorted(tasks)[-1] <= 2 * sorted(tasks)[len(tasks) // 2]
        plain = rows.join(other, "k", "left")
        assert got.columns == ["k", "n", "v"] and got.exceptAll(plain).count() == 0 == plain.exceptAll(got).count()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)
    assert "Exchange " not in join_hot(rows, other, ["k"])._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange ", "")


def test_points_and_locations(spark):
    df = spark.createDataFrame(
        [("10", "20", "Main St."), ("95", "20", None), ("x", "20", ""), (None, None, "main st")],
        "lat string, lon string, street string")
    control = FileControl(
        synthetic_locations={"place": Synthetic("location", {"address": "street", "latitude": "lat"})},
        synthetic_points={"spot": Synthetic("point", {"latitude": "lat", "longitude": "lon"}),
                          "found": Synthetic("geocoded", {"address": "street"})})
    gazetteer = spark.createDataFrame(
        [("MAIN  st", 1.0, 2.0), ("main st", 3.0, 4.0)], "address string, latitude double, longitude double")
    rows = geo.add_synthetic_columns(df, control, gazetteer).collect()
    by_lat = {r.lat: r for r in rows}
    assert len(rows) == 4
    assert (by_lat["10"].spot.latitude, by_lat["10"].spot.longitude) == (10.0, 20.0)
    assert by_lat["95"].spot is None and by_lat["95"][ERRORS][0]["expected"] == "point"
    assert by_lat["x"].spot is None and by_lat["x"][ERRORS] == []
    assert by_lat["10"].place.address == "Main St." and by_lat["10"].place.city is None
    assert by_lat["10"].found == by_lat[None].found is not None
    assert by_lat["x"].found is None


def test_locations_are_geocoded_where_the_control_says_so(spark):
    df = spark.createDataFrame([(None, None, "Main St."), ("5", "6", "main st"), (None, None, "  "), (None, "1", "nowhere")],
                               "lat string, lon string, street string")
    parts = {"address": "street", "latitude": "lat", "longitude": "lon"}
    gazetteer = spark.createDataFrame([("MAIN  st", 1.0, 2.0), ("", 9.0, 9.0)], "address string, latitude double, longitude double")
    for asked, first in ((True, (1.0, 2.0)), (False, (None, None))):
        control = FileControl(synthetic_locations={"place": Synthetic("location", parts)}, use_geocoding=asked)
        got = geo.add_synthetic_columns(df, control, gazetteer)
        assert got.columns == [*df.columns, "place"]
        places = sorted(((r.street, r.place.latitude, r.place.longitude) for r in got.collect()), key=str)
        assert places == sorted([("Main St.", *first), ("main st", 5.0, 6.0), ("  ", None, None), ("nowhere", None, 1.0)], key=str)


def test_streams_skip_records_before_the_header(spark, tmp_path):
    store = DatasetStore(spark, str(tmp_path / "store"))
    jobs.create_dataset(store, "d", spark.createDataFrame([(1, "a")], "id int, v string"), "id", buckets=16)
    (tmp_path / "in").mkdir()
    for n in (2, 3):
        (tmp_path / f"in/{n}.csv").write_text(f"about,this\nid,v\n{n},x\n1,{n}\n")
    control = Control("Upsert", None, FileControl(separator=",", columns=["id", "v"], skip=2))
    ingest_stream(spark, str(tmp_path / "in"), control, store, "d", {"id": "int"}, "id", str(tmp_path / "cp"), 1).awaitTermination()
    got = {r["id"]: r["v"] for r in store.read("d").collect()}
    assert got in ({1: "3", 2: "x", 3: "x"}, {1: "2", 2: "x", 3: "x"})


def test_closed_jobs_are_written_once(spark, tmp_path):
    """Events out of order and repeated; one job that speaks again after its silence; state is let go."""
    from rowharbor.streaming.status import closed_jobs, write_closed

    def put(n, *events):
        rows = [(e, j, f"2024-01-01 {t}", k) for e, j, t, k in events]
        df = spark.createDataFrame(rows, "event_id int, job_id string, t string, type string")
        df.select("event_id", "job_id", F.to_timestamp("t").alias("at"), "type").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        schema = "event_id int, job_id string, at timestamp, type string"
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        write_closed(closed_jobs(events, "at", "10 minutes", "5 minutes"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        out = spark.read.schema("job_id string, first_at timestamp, last_at timestamp, events bigint, type string").parquet(str(tmp_path / "out"))
        return sorted((r["job_id"], r["first_at"].strftime("%H:%M"), r["last_at"].strftime("%H:%M"), r["events"], r["type"]) for r in out.collect())

    put(0, (2, "a", "00:06:00", "done"), (1, "a", "00:00:00", "begun"), (3, "b", "00:08:00", "begun"))
    put(1, (2, "a", "00:06:00", "done"), (4, "b", "00:04:00", "queued"), (5, "c", "00:30:00", "begun"))
    assert run() == [("a", "00:00", "00:06", 2, "done"), ("b", "00:04", "00:08", 2, "begun")]
    put(2, (6, "a", "00:40:00", "again"), (7, "z", "00:01:00", "too late"))
    put(3, (8, "d", "01:30:00", "begun"))
    assert run() == [("a", "00:00", "00:06", 2, "done"), ("a", "00:40", "00:40", 1, "again"), ("b", "00:04", "00:08", 2, "begun"), ("c", "00:30", "00:30", 1, "begun")]


def test_composite_takes_the_place_of_a_mapped_column(spark):
    df = spark.createDataFrame([("a", "b")], "Place string, street string")
    made = geo.synthetic_location(df, "place", {"address": "street"})
    assert made.columns == ["street", "place"] and made.first().place.address == "b"


def test_layer_mapping(spark):
    files = spark.createDataFrame([("a", "new name"), ("b", "x"), ("b", "y")], "dataset_id string, layer string")
    existing = spark.createDataFrame([("a", "old name", "u1"), ("b", "x", "u2"), ("c", "x", "u3")],
                                     "dataset_id string, layer string, uid string")
    mapping = layers.map_layers(files, existing)
    assert {tuple(r) for r in mapping.collect()} == {("a", "new name", "u1"), ("b", "x", "u2")}
    target = spark.createDataFrame([("b", "u2", 1), ("b", "u9", 2)], "dataset_id string, uid string, f int")
    features = spark.createDataFrame([("b", "x", 3), ("b", "y", 4)], "dataset_id string, layer string, f int")
    after = layers.replace_layers(target, features, mapping)
    assert {tuple(r) for r in after.collect()} == {("b", "u9", 2), ("b", "u2", 3), ("b", "y", 4)}


def test_ingest_is_idempotent(spark, tmp_path):
    store = DatasetStore(spark, str(tmp_path / "store"))
    jobs.create_dataset(store, "d", spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"))
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("id,v\n2,c\n3,d\n")
    control = Control("Upsert", None, FileControl(separator=",", columns=["id", "v"], skip=1))

    def run(checkpoint):
        ingest_stream(spark, str(folder), control, store, "d", {"id": "int", "v": "text"}, "id",
                      str(tmp_path / checkpoint)).awaitTermination()
        return sorted(tuple(r) for r in store.read("d").collect())

    assert run("cp") == [(1, "a"), (2, "c"), (3, "d")]
    version = store.current_version("d")
    assert run("cp") == [(1, "a"), (2, "c"), (3, "d")] and store.current_version("d") == version
    (folder / "2.csv").write_text("id,v\n3,e\n1,\n")
    assert run("cp") == [(1, "a"), (2, "c"), (3, "e")]
    # a batch that was committed before is not published again
    rows = spark.createDataFrame([("9", "z")], "id string, v string")
    again = jobs.publish_rows(store, "d", rows, control, {}, "id", batch=f"{tmp_path}/cp#0")
    assert again.version == store.current_version("d") and store.read("d").count() == 3


def test_unpublished_version_is_not_seen(spark, tmp_path):
    store = DatasetStore(spark, str(tmp_path / "store"))
    df = spark.range(3)
    jobs.create_dataset(store, "d", df)
    version, sent = store.stage(spark.range(5), "d")
    assert store.read("d").count() == 3
    with pytest.raises(PublishFailed):
        store.publish("d", version, type(sent)(4))
    assert store.read("d").count() == 3
    store.publish("d", version, sent)
    assert store.read("d").count() == 5
    with pytest.raises(LookupError):
        store.read("never")


def test_repeated_events_are_dropped(spark, tmp_path):
    df = spark.createDataFrame([("j", "2020-01-01 00:00:00"), ("j", "2020-01-01 00:00:00"),
                                ("j", "2020-01-01 00:00:05")], "job_id string, t string")
    df.select("job_id", F.to_timestamp("t").alias("at")).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = (deduplicated(events, "at", ["job_id", "at"], "1 minute").writeStream
             .format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
