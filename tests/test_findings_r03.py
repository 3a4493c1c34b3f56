"""Findings of round 3: whole arrivals per micro-batch, rows carried once, samples not sorted."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from emporium.operators.metrics import latest_gauges
from emporium.operators.upsert import first_wins, insert_if_absent
from emporium.plans import jobs, load
from emporium.sources.files import read_csv_table
from emporium.sources.testdata import Star


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def many_files(spark):
    """Shuffles keep their number of partitions, as those of large tables do."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture()
def stores(monkeypatch):
    made, make = [], jobs._store

    def keep(*args):
        made.append(make(*args))
        return made[-1]

    monkeypatch.setattr(jobs, "_store", keep)
    return made


def test_an_arrival_of_many_files_is_one_batch(spark, tmp_dir, many_files, stores):
    lines = [(k, 1 + n % 2, n, n % 3, 1.0, 10.0 + n, dt.datetime(2020, 1, 1 + n)) for k in range(12) for n in range(6)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_extendedprice double, l_shipdate timestamp_ntz").repartition(5) \
        .write.parquet(f"{tmp_dir}/lineitem.parquet")
    got = rows(jobs.stream_dedupe_items(Star(spark, tmp_dir)).select("order_id", "order_item_id", "price"))
    # supplier n % 3 decides the arrival: the first of an (order, line) comes with supplier 0
    assert got == sorted([(str(k), i, 10.0 + n) for k in range(12) for i, n in ((1, 0), (2, 3))], key=repr)
    assert len(stores[0][0].committed()) == jobs.ARRIVALS


def test_gauges_of_an_arrival_are_upserted_together(spark, tmp_dir, many_files, stores):
    events = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i % 8, "click", float(i)) for i in range(60)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double") \
        .repartition(5).write.parquet(f"{tmp_dir}/events.parquet")
    got = rows(jobs.stream_latest_gauges(Star(spark, tmp_dir)).select("city", "value"))
    assert got == [("city_0", 56.0), ("city_1", 57.0), ("city_2", 58.0), ("city_3", 59.0)]
    assert len(stores[0][0].committed()) == jobs.ARRIVALS


def test_first_wins_carries_a_row_once(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), rng.choice([None, 0.5, 1.5]),
             rng.choice([None, "x", "y"])) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, i int, v double, w string").repartition(4)

    def rank(r):  # nulls first
        return [(r[c] is not None, r[c] or 0) for c in (3, 2)]

    want = [r for r in data if r[0] is None or r[1] is None]
    for key in {r[:2] for r in data if None not in r[:2]}:
        want.append(min((r for r in data if r[:2] == key), key=rank))
    got = first_wins(df, ["k", "i"], ["w"])
    assert rows(got) == sorted(want, key=repr) and got.columns == df.columns
    assert "min_by" not in plan(got)
    # an order by an expression, keys of doubles, rows that are all key
    latest = first_wins(df.where("v IS NOT NULL"), ["v"], [F.length("w"), "k"])
    assert sorted(r["v"] for r in latest.collect()) == [0.5, 1.5]
    pairs = first_wins(df.select("k", "i"), ["k", "i"])
    assert pairs.where("k IS NOT NULL AND i IS NOT NULL").count() == len({r[:2] for r in data if None not in r[:2]})
    assert pairs.where("k IS NULL OR i IS NULL").count() == sum(None in r[:2] for r in data)
    # maps cannot be ordered
    maps = df.select("k", "v", F.create_map(F.lit("a"), F.col("v")).alias("m"))
    assert first_wins(maps, "k").where("k IS NOT NULL").count() == 3


def test_loading_twice_has_no_rows_twice(spark):
    items = spark.createDataFrame([("o1", 1, "old")], "k string, i int, v string")
    batch = spark.createDataFrame([("o1", 1, "a"), ("o2", 1, "c"), ("o2", 1, "b")], items.schema)
    once = insert_if_absent(items, batch, ["k", "i"], ["v"])
    twice = insert_if_absent(once.table, batch, ["k", "i"], ["v"])
    assert rows(twice.table) == [("o1", 1, "old"), ("o2", 1, "b")]
    assert "min_by" not in plan(twice.table)


def test_exported_csv_is_compressed_in_bounded_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(load, "ROWS_PER_FILE", 10, raising=False)
    data = [(f"p{i}", None if i % 3 else f'a "q", {i}', *[i] * 7) for i in range(35)]
    products = spark.createDataFrame(data, load.SCHEMAS["products"]).coalesce(1)
    path = load.export_csv({"products": products}, tmp_dir)["products"]
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    assert rows(read_csv_table(spark, "products", path, with_position=False)) == rows(products)


def test_latest_gauges_sorts_only_the_latest(spark):
    t = [None, *(dt.datetime(2024, 1, 1, h) for h in range(3))]
    data = [("m", "a", t[1], 1.0, True), ("m", "a", t[2], 2.0, True), ("m", "a", t[2], 5.0, True),
            ("m", "a", t[3], 9.0, False), ("m", None, t[1], 3.0, True), ("m", None, None, 8.0, True),
            ("n", "a", None, 4.0, True), ("n", "a", None, None, True), (None, "a", t[1], 6.0, True)]
    samples = spark.createDataFrame(data, "metric string, city string, ts timestamp_ntz, value double, ok boolean") \
        .withColumn("labels", F.when(F.col("city").isNotNull(), F.create_map(F.lit("city"), "city"))).drop("city")
    latest = latest_gauges(samples)
    assert rows(latest.select("metric", F.col("labels")["city"], "ts", "value")) == sorted(
        [("m", "a", t[2], 5.0), ("m", None, t[1], 3.0), ("n", "a", None, 4.0), (None, "a", t[1], 6.0)], key=repr)
    assert "LeftSemi" in plan(latest)
