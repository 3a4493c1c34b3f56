"""Writes that must not lose rows, and values that must come out exact."""

from __future__ import annotations

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from emporium.operators import dml, metrics, profile
from emporium.operators.sinks import NothingPublished, publish_tables, read_published
from emporium.plans.load import bulk_load
from emporium.sources.testdata import Star
from emporium.streaming import ingest as st


def ingest(spark, rows, tmp, name, **options):
    source = f"{tmp}/source-{name}"
    spark.createDataFrame(rows, "k long, v string").repartition(3).write.parquet(source)
    stream = spark.readStream.schema("k long, v string").option("maxFilesPerTrigger", 1).parquet(source)
    st.ingest_if_absent(stream, f"{tmp}/table", f"{tmp}/ckpt-{name}", "k", **options).awaitTermination()
    return sorted(map(tuple, st.read_ingested(spark, f"{tmp}/table").collect()))


def test_streams_with_own_checkpoints_keep_each_others_rows(spark, tmp_dir):
    one = [(i, "one") for i in range(40)]
    assert ingest(spark, one, tmp_dir, "a") == one
    two = [(i, "two") for i in range(30, 80)]
    want = one + [(i, "two") for i in range(40, 80)]
    assert ingest(spark, two, tmp_dir, "b") == want
    # a seed is inserted if absent too, and a restart adds nothing
    seed = spark.createDataFrame([(1, "seed"), (200, "seed")], "k long, v string")
    want = sorted(want + [(200, "seed"), (300, "three")])
    assert ingest(spark, [(200, "three"), (300, "three")], tmp_dir, "c", seed=seed) == want
    stream = spark.readStream.schema("k long, v string").parquet(f"{tmp_dir}/source-c")
    st.ingest_if_absent(stream, f"{tmp_dir}/table", f"{tmp_dir}/ckpt-c", "k", seed=seed).awaitTermination()
    assert sorted(map(tuple, st.read_ingested(spark, f"{tmp_dir}/table").collect())) == want


def test_versions_are_ordered_by_publication(spark, tmp_dir):
    for n, version in enumerate(("v9", "v10", "0001", "a"), 1):
        publish_tables(spark, {"t": spark.range(n)}, tmp_dir, version)
        assert read_published(spark, tmp_dir)["t"].count() == n
    assert read_published(spark, tmp_dir, "v9")["t"].count() == 1
    names = [publish_tables(spark, {"t": spark.range(n)}, tmp_dir) for n in (7, 8)]  # one second
    assert names[0] != names[1] and read_published(spark, tmp_dir)["t"].count() == 8
    with pytest.raises(NothingPublished):
        read_published(spark, f"{tmp_dir}/nowhere")


def test_a_load_does_not_take_a_read_error_for_an_empty_warehouse(spark, tmp_dir):
    bulk_load(spark, {}, tmp_dir)  # nothing published yet: starts empty
    publish_tables(spark, {"sellers": spark.range(1)}, tmp_dir)
    bad = f"{tmp_dir}/_manifests/v=bad"
    spark.createDataFrame([("{not json",)], "value string").write.text(bad)
    with pytest.raises(Exception) as e:
        bulk_load(spark, {}, tmp_dir)
    assert not isinstance(e.value, NothingPublished)
    shutil.rmtree(bad)
    assert "sellers" in read_published(spark, tmp_dir)


def test_malformed_body_keeps_the_gauge(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("x", at, json.dumps({"main": {"temp": 20.0}}), True),
            ("x", at + dt.timedelta(hours=1), "not json", True),
            ("x", at + dt.timedelta(hours=2), '{"main": {"temp": 5', True),
            ("x", at + dt.timedelta(hours=3), json.dumps({"main": {"temp": 9.0}}), False)]
    samples = metrics.weather_to_metrics(
        spark.createDataFrame(rows, "city string, ts timestamp, body string, ok boolean"))
    latest = {r.metric: r.value for r in metrics.latest_gauges(samples).collect()}
    assert 20.0 in latest.values() and 9.0 not in latest.values()
    assert {r.ok for r in samples.where("ts > timestamp'2024-01-01'").collect()} == {False}


def test_integer_assignment_is_exact(spark):
    big = 2**53 + 1
    t = spark.createDataFrame([(1, big)], "k int, n bigint")
    changed = dml.update_where(t, {"n": F.col("n") + 2}).changed.collect()
    assert [r.n for r in changed] == [big + 2]
    half = F.lit("2.5").cast("decimal(3,1)")
    assert [r.n for r in dml.update_where(t, {"n": half}).changed.collect()] == [3]
    assert [r.n for r in dml.update_where(t, {"n": F.lit(2.5)}).changed.collect()] == [2]


@pytest.mark.parametrize("odd", [float("inf"), float("-inf"), float("nan"), 1.7e308])
def test_ranks_with_values_beyond_any_width(spark, odd):
    values = [float(i) for i in range(20)] + [odd, -1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    def order(v):
        return (v != v, v)
    want = sorted(values, key=order)
    for k in (0, 5, 10, 20):
        assert profile.exact_kth(df, k, accuracy=3) == want[k]


def test_label_with_a_line_end_survives(spark, tmp_dir):
    labels = {"a": 'x\ny', "b": 'back\\n"q"\\'}
    samples = spark.createDataFrame([("m", labels, 1.5)], "metric string, labels map<string,string>, value double")
    metrics.to_exposition(samples).write.text(f"{tmp_dir}/text")
    back = metrics.parse_exposition(spark.read.text(f"{tmp_dir}/text")).collect()
    assert [(r.metric, r.labels, r.value) for r in back] == [("m", labels, 1.5)]


def test_streams_read_a_table_that_is_a_folder(spark, tmp_dir):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3) \
        .write.parquet(f"{tmp_dir}/events.parquet")
    for folder in (tmp_dir, "/root/testdata/sf0.001"):
        raw = Star(spark, folder, streaming=True).raw("events")
        name = "events_" + str(abs(hash(folder)))
        query = raw.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(name).count() == Star(spark, folder).raw("events").count() > 0
