"""Metrics, point cloud and streaming operators on micro fixtures."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import rows
from emporium.operators import metrics, points
from emporium.operators.sinks import publish_tables, read_published, write_report
from emporium.sources.files import read_exposition

T = dt.datetime


def test_weather_missing_fields_and_failed_city(spark):
    ok_body = json.dumps({"main": {"temp": 20.5, "feels_like": 19, "humidity": 40, "pressure": 1000},
                          "wind": {"speed": 3}, "clouds": {"all": 10}, "visibility": 10000})
    df = spark.createDataFrame([
        ("Astana", T(2024, 1, 1, 0, 0, 0), True, ok_body),
        ("Dubai", T(2024, 1, 1, 0, 0, 0), True, ok_body),
        ("Dubai", T(2024, 1, 1, 0, 0, 20), False, None),     # failed fetch
    ], "city string, ts timestamp, ok boolean, body string")
    samples = metrics.weather_to_metrics(df)
    assert samples.count() == 27
    latest = {(r.metric, r.labels["city"]): (r.ts, r.value) for r in metrics.latest_gauges(samples).collect()}
    assert latest[("owm_rain_1h_mm", "Astana")][1] == 0.0          # missing → 0
    assert latest[("owm_temperature_celsius", "Dubai")] == (T(2024, 1, 1), 20.5)  # old value kept
    health = rows(metrics.api_health(samples.withColumn("round", F.col("ts")), "round"))
    assert [h[1] for h in health] == [1, 0]


def test_exposition_roundtrip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cpu.prom")
    with open(path, "w") as f:
        f.write("# HELP cpu_temperature_celsius Fake\n# TYPE cpu_temperature_celsius gauge\n"
                "cpu_temperature_celsius 58.3\n\n"
                'battery_percent{host="a",slot="1"} 77\n'
                "broken_metric notanumber\n"
                "# trailing comment\n")
    got = {r.metric: (dict(r.labels), r.value) for r in read_exposition(spark, path).collect()}
    assert got == {"cpu_temperature_celsius": ({}, 58.3),
                   "battery_percent": ({"host": "a", "slot": "1"}, 77.0),
                   "broken_metric": ({}, None)}
    text = [r.value for r in metrics.to_exposition(read_exposition(spark, path).drop("ts")
                                                   .where("value is not null")).collect()]
    assert 'battery_percent{host="a",slot="1"} 77.0' in text
    assert "# TYPE battery_percent gauge" in text


def test_exposition_in_many_files_keeps_order_headers_and_times(spark, tmp_dir):
    from emporium.operators.sinks import write_exposition
    path = os.path.join(tmp_dir, "many")
    samples = spark.range(2_000).selectExpr(
        "concat('m', id % 7) AS metric", "map('k', cast(id AS string)) AS labels",
        "CASE WHEN id % 5 > 0 THEN timestamp_millis(1700000000000 + id) END AS ts",
        "cast(id AS double) AS value")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = write_exposition(samples, path, {"m3": "the third"})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(names) > 1
    assert [r.value for r in spark.read.text(path + "/_order").collect()] == names
    text = [line for n in names for line in open(os.path.join(path, n)).read().splitlines()]
    heads = [line for line in text if line.startswith("#")]
    assert heads == [f"# {kind}" for k in range(7)
                     for kind in (f"HELP m{k} {'the third' if k == 3 else ''}", f"TYPE m{k} gauge")]
    seen = None
    for line in text:  # a metric's samples follow its own header
        if line.startswith("# TYPE"):
            seen = line.split()[2]
        elif not line.startswith("#"):
            assert line.startswith(seen + "{")
    back = read_exposition(spark, path)
    got = {(r.metric, r.labels["k"], r.value, r.ms) for r in back.select(
        "metric", "labels", "value", F.unix_millis("ts").alias("ms")).collect()}
    timed = {(f"m{k % 7}", str(k), float(k), 1700000000000 + k) for k in range(2_000) if k % 5}
    assert timed <= got and len(got) == 2_000
    assert min(ms for m, k, v, ms in got - timed) > 1700000010000  # the file's time


def test_relabel_and_query_metrics(spark):
    s = spark.createDataFrame([("m", {"__address__": "x:1", "instance": "x:1"}, 1.0)],
                              "metric string, labels map<string,string>, value double")
    r = metrics.relabel(s, "__address__", "instance", "external_apis").first()
    assert r.labels == {"__address__": "x:1", "instance": "external_apis"}
    q = spark.createDataFrame([("t", 3)], "tbl string, n int")
    m = rows(metrics.query_to_metrics(q, ["tbl"], ["n"], "db_").select("metric", "value"))
    assert m == [("db_n", 3.0)]


def _cube(spark):
    corners = [(i, float(x), float(y), float(z)) for i, (x, y, z) in enumerate(
        [(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)])]
    return spark.createDataFrame(corners + [(8, 0.5, 0.5, 0.5)], "point_id long, x double, y double, z double")


def test_cube_points(spark):
    p = _cube(spark)
    box = points.points_bbox(p).first()
    assert (box.x_min, box.z_max, box.y_center) == (0.0, 1.0, 0.5)
    assert points.points_crop(p, 1.0).count() == 9
    assert points.points_scaled_crop(p).count() == 9
    vox = points.points_voxels(p, 0.5)
    assert vox.agg(F.sum("n")).first()[0] == 9
    plane = points.points_plane(p).first()
    assert abs(plane.plane_y - 0.5) < 1e-12
    below = points.points_clip(p, points.points_plane(p))
    above = p.join(below, "point_id", "left_anti")
    assert below.count() + above.count() == 9
    assert {r.point_id for r in below.collect()} == {0, 1, 4, 5}    # y = 0; y = 0.5 is not < 0
    colored = points.points_color_by_height(p)
    assert colored.agg(F.min("r"), F.max("r")).first()[0] == 0.0
    ext = {r.extreme: r.point_id for r in points.points_extremes(p).collect()}
    assert ext == {"min": 0, "max": 1}   # ties on z → smallest id


def test_stream_replay_and_late_rows(spark, tmp_dir):
    from emporium.streaming import ingest as st
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    schema = "order_id string, order_purchase_timestamp timestamp"
    b1 = spark.createDataFrame([("o1", T(2020, 1, 1, 10)), ("o2", T(2020, 1, 2, 10))], schema)
    b1.coalesce(1).write.parquet(os.path.join(src, "b1"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src)
    table, ckpt = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "ck")
    st.ingest_if_absent(stream, table, ckpt, "order_id").awaitTermination()
    b2 = spark.createDataFrame([("o2", T(2020, 1, 2, 11)), ("o3", T(2020, 1, 5, 10))], schema)
    b2.coalesce(1).write.parquet(os.path.join(src, "b2"))
    st.ingest_if_absent(stream, table, ckpt, "order_id").awaitTermination()
    got = rows(st.read_ingested(spark, table).select("order_id"))
    assert got == [("o1",), ("o2",), ("o3",)]         # shared key o2 added once
    # replaying the second batch (its output folder is overwritten) adds nothing
    st.ingest_if_absent(stream, table, os.path.join(tmp_dir, "ck2"), "order_id").awaitTermination()
    assert st.read_ingested(spark, table).count() == 3


def test_daily_counts_drop_late_rows(spark, tmp_dir):
    from emporium.streaming import ingest as st
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    schema = "order_id string, order_purchase_timestamp timestamp"
    first = spark.createDataFrame([("o1", T(2020, 1, 1, 10)), ("o2", T(2020, 1, 2, 10)),
                                   ("o2", T(2020, 1, 2, 11)), ("o3", T(2020, 1, 5, 10))], schema)
    first.coalesce(1).write.parquet(os.path.join(src, "b1"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src)
    out, ck = os.path.join(tmp_dir, "daily"), os.path.join(tmp_dir, "ck")
    counts = st.daily_counts(stream, "order_purchase_timestamp", "1 day")
    st.run_to_table(counts, out, ck).awaitTermination()
    # watermark is now 2020-01-04 10:00: a row for 2019-12-01 is late
    late = spark.createDataFrame([("o0", T(2019, 12, 1, 10)), ("o4", T(2020, 1, 9, 10))], schema)
    late.coalesce(1).write.parquet(os.path.join(src, "b2"))
    st.run_to_table(counts, out, ck).awaitTermination()
    days = rows(spark.read.parquet(out).select("day", "n"))
    assert days == [(dt.date(2020, 1, 1), 1), (dt.date(2020, 1, 2), 2), (dt.date(2020, 1, 5), 1)]


def test_publish_and_report(spark, tmp_dir):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(T(2020, 1, 1),)], "ts timestamp")
    root = os.path.join(tmp_dir, "wh")
    v1 = publish_tables(spark, {"a": a, "b": b}, root, version="001")
    publish_tables(spark, {"a": a.union(a), "b": b}, root, version="002")
    latest = read_published(spark, root)
    assert latest["a"].count() == 2
    assert read_published(spark, root, v1)["a"].count() == 1
    n = write_report({"a": a, "b": b}, os.path.join(tmp_dir, "report"))
    assert n == 2


def test_snapshot_first_creation_wins_and_replace(spark):
    from emporium.operators.sinks import drop_snapshot, snapshot
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    drop_snapshot(spark, "temp_session_data")
    snapshot(spark, "temp_session_data", a)
    assert rows(snapshot(spark, "temp_session_data", b)) == [(1,)]        # IF NOT EXISTS
    assert rows(snapshot(spark, "temp_session_data", b, replace=True)) == [(2,)]
    assert rows(spark.table("temp_session_data")) == [(2,)]
    drop_snapshot(spark, "temp_session_data")
    assert not spark.catalog.tableExists("temp_session_data")


def test_analyze_and_catalog_counts(spark):
    from emporium.operators.quality import rows_total, table_count
    from emporium.operators.sinks import analyze_table
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.mode("overwrite") \
        .saveAsTable("emporium_analyze_t")
    analyze_table(spark, "emporium_analyze_t")
    stats = spark.sql("DESCRIBE TABLE EXTENDED emporium_analyze_t").where("col_name = 'Statistics'").first()
    assert "2 rows" in stats.data_type
    assert table_count(spark).first()[0] >= 1
    t = spark.table("emporium_analyze_t")
    assert rows_total({"a": t, "b": t}).first()[0] == 4


def test_jdbc_options():
    import pytest
    from emporium.sources.files import jdbc_options
    o = jdbc_options("jdbc:postgresql://db/x", "orders", partition_column="id", lower_bound=0,
                     upper_bound=100, num_partitions=4, search_path="shop")
    assert o["numPartitions"] == "4" and o["sessionInitStatement"] == "SET search_path TO shop"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_sanitize_resample_info_and_writers(spark, tmp_dir):
    from emporium.operators.sinks import sanitize_for_export, write_exposition
    from emporium.sources.files import read_weather_json
    df = spark.createDataFrame([(T(2020, 1, 1, 10, 0, 0),)], "ts timestamp")
    out = sanitize_for_export(df)
    assert dict(out.dtypes)["ts"] == "timestamp_ntz" and out.first().ts == T(2020, 1, 1, 10)
    s = spark.createDataFrame([("m", {"city": "a"}, T(2024, 1, 1, 0, 0, 1), 1.0),
                               ("m", {"city": "a"}, T(2024, 1, 1, 0, 0, 14), 2.0),
                               ("m", {"city": "a"}, T(2024, 1, 1, 0, 0, 16), 3.0)],
                              "metric string, labels map<string,string>, ts timestamp, value double")
    steps = {(r.step_start, r.value) for r in metrics.resample_last(s, "15 seconds").collect()}
    assert steps == {(T(2024, 1, 1, 0, 0, 0), 2.0), (T(2024, 1, 1, 0, 0, 15), 3.0)}
    info = metrics.info_metric(spark, "owm_exporter_info", {"source": "openweather"},
                               cities=["Astana", "London"]).first()
    assert info.value == 1.0 and info.labels == {"source": "openweather", "cities": "Astana,London"}
    path = os.path.join(tmp_dir, "expo")
    write_exposition(s.drop("ts"), path, {"m": "a metric"})
    text = [r.value for r in spark.read.text(path).collect()]
    assert text[:2] == ["# HELP m a metric", "# TYPE m gauge"] and 'm{city="a"} 1.0' in text
    wpath = os.path.join(tmp_dir, "weather.json")
    with open(wpath, "w") as f:
        f.write(json.dumps({"city": "London", "ts": "2024-01-01T00:00:00", "ok": True,
                            "body": json.dumps({"main": {"temp": 5.0}})}) + "\n")
    w = metrics.weather_to_metrics(read_weather_json(spark, wpath))
    got = {r.metric: r.value for r in w.collect()}
    assert got["owm_temperature_celsius"] == 5.0 and got["owm_wind_speed_ms"] == 0.0


def test_exposition_label_values_with_commas_and_quotes(spark, tmp_dir):
    from emporium.operators.sinks import write_exposition
    s = spark.createDataFrame([("m", {"city": 'a,b "c"', "zone": "x=1\\y"}, 2.5)],
                              "metric string, labels map<string,string>, value double")
    path = os.path.join(tmp_dir, "expo2")
    write_exposition(s, path)
    back = read_exposition(spark, path).first()
    assert back.metric == "m" and back.value == 2.5
    assert back.labels == {"city": 'a,b "c"', "zone": "x=1\\y"}


def test_ingest_layout_prunes_to_touched_buckets(spark, tmp_dir):
    from pyspark.sql import functions as F
    from emporium.streaming import ingest as st
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    schema = "order_id string, v int"
    seed = spark.range(2000).selectExpr("cast(id as string) as order_id", "cast(id as int) as v")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src)
    spark.createDataFrame([("new-1", 1)], schema).write.parquet(os.path.join(src, "b1"))
    table = os.path.join(tmp_dir, "t")
    st.ingest_if_absent(stream, table, os.path.join(tmp_dir, "ck"), "order_id", seed=seed).awaitTermination()
    stored = spark.read.parquet(table)
    assert stored.select(st.BUCKET_COL).distinct().count() == st.KEY_BUCKETS
    bucket = spark.createDataFrame([("new-1",)], "order_id string").select(
        st.key_bucket(["order_id"])).first()[0]
    def files_read(df):
        return df.select(F.input_file_name()).distinct().count()
    one = files_read(stored.where(F.col(st.BUCKET_COL).isin([bucket])))
    assert 1 <= one <= 2 < files_read(stored) / 10     # a one-key batch reads ~1/64 of the files
    assert st.read_ingested(spark, table).count() == 2001
