"""Stores of tables that streams commit to: crashes, replays, keys, compaction."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from emporium.streaming import ingest as st
from emporium.streaming.epochs import EpochStore, Table

ORDERS, ITEMS = "k long, v string", "k long, i int, v string"


def store_at(spark, root, **options):
    return EpochStore(spark, root, {
        "orders": Table(st._schema(ORDERS), ["k"]),
        "items": Table(st._schema(ITEMS), ["k", "i"], ["v"])}, buckets=4, **options)


def nulls_first(row):
    return (row[0] is not None, row[0] or 0, row[1:])


def rows(store, name):
    return sorted(map(tuple, store.read(name).collect()), key=nulls_first)


def orders(spark, *data):
    return {"orders": spark.createDataFrame(data, ORDERS),
            "items": spark.createDataFrame([(k, 1, v) for k, v in data], ITEMS)}


def test_a_crash_between_tables_shows_nothing(spark, tmp_dir, monkeypatch):
    store = store_at(spark, f"{tmp_dir}/s")
    store.commit("r", 0, orders(spark, (1, "a")))
    whole = EpochStore._write

    def fails(self, name, df, epoch):
        if name == "items":
            raise RuntimeError("lost")
        whole(self, name, df, epoch)

    monkeypatch.setattr(EpochStore, "_write", fails)
    with pytest.raises(RuntimeError):
        store.commit("r", 1, orders(spark, (2, "b")))
    assert os.path.exists(f"{tmp_dir}/s/orders/data/epoch=r-1")  # written, but not committed
    assert rows(store, "orders") == [(1, "a")] and rows(store, "items") == [(1, 1, "a")]
    monkeypatch.setattr(EpochStore, "_write", whole)
    # the replay takes its first attempt's place; after the record it does nothing
    again = store_at(spark, f"{tmp_dir}/s")
    assert again.commit("r", 1, orders(spark, (2, "b")))
    assert not again.commit("r", 1, orders(spark, (3, "c")))
    assert rows(again, "orders") == [(1, "a"), (2, "b")] and rows(again, "items") == [(1, 1, "a"), (2, 1, "b")]


def test_a_stream_killed_between_two_tables_goes_on(spark, tmp_dir, monkeypatch):
    for k in range(4):  # four files, so four micro-batches; every key comes twice
        spark.createDataFrame([(i, f"{k}") for i in range(k * 5, k * 5 + 10)], ORDERS) \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/orders")
        spark.createDataFrame([(i, 1, f"{k}") for i in range(k * 5, k * 5 + 10)], ITEMS) \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/items")

    def run(store):
        streams = {n: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/{n}")
                   for n, s in (("orders", ORDERS), ("items", ITEMS))}
        st.ingest_tables(streams, store, f"{tmp_dir}/ckpt").awaitTermination()

    whole, calls = EpochStore._write, []

    def fails(self, name, df, epoch):
        calls.append(epoch)
        if name == "items" and epoch.endswith("-2"):
            raise RuntimeError("lost")
        whole(self, name, df, epoch)

    monkeypatch.setattr(EpochStore, "_write", fails)
    store = store_at(spark, f"{tmp_dir}/s")
    with pytest.raises(Exception, match="lost"):
        run(store)
    assert [k for k, _ in rows(store, "orders")] == [k for k, _, _ in rows(store, "items")] == list(range(15))
    monkeypatch.setattr(EpochStore, "_write", whole)
    run(store)
    first = {}
    for k in range(4):
        for i in range(k * 5, k * 5 + 10):
            first.setdefault(i, str(k))
    assert rows(store, "orders") == sorted(first.items())
    assert rows(store, "items") == [(i, 1, v) for i, v in sorted(first.items())]


def test_keys_are_new_over_the_whole_history(spark, tmp_dir):
    """Random batches against a dict; a filter far too small passes everything on."""
    rng = random.Random(7)
    tight = store_at(spark, f"{tmp_dir}/tight", expected_keys=1, compact_every=4)
    roomy = store_at(spark, f"{tmp_dir}/roomy", expected_keys=2_000_000, compact_every=100)
    want = {}
    for n in range(6):
        batch = [(rng.randrange(400), f"{n}") for _ in range(150)] + [(None, f"null {n}")]
        df = spark.createDataFrame(batch, ORDERS)
        for store in (tight, roomy):
            store.commit("r", n, {"orders": df})
        for k, v in batch:
            want.setdefault((k, v) if k is None else k, (k, v))
    assert rows(tight, "orders") == rows(roomy, "orders") == sorted(want.values(), key=nulls_first)
    assert len(tight._state().epochs) < 4 and len(roomy._state().epochs) == 6
    assert rows(tight, "items") == []


def test_compaction_and_vacuum(spark, tmp_dir):
    store = store_at(spark, f"{tmp_dir}/s")
    for n in range(3):
        store.commit("r", n, orders(spark, (n, "v"), (0, "again")))
    store.commit("other", 0, orders(spark, (9, "w")))
    before = rows(store, "orders")
    store.compact()
    store.vacuum()
    assert rows(store, "orders") == before == [(0, "again"), (1, "v"), (2, "v"), (9, "w")]
    assert len(os.listdir(f"{tmp_dir}/s/orders/data")) == 1
    # numbers of both runs are still known, keys still stored
    assert not store.commit("r", 2, orders(spark, (70, "x"))) and not store.commit("other", 0, {})
    assert store.commit("r", 3, orders(spark, (9, "y"), (10, "z")))
    assert rows(store, "orders") == sorted(before + [(10, "z")])


def test_days_are_whole_in_any_order(spark, tmp_dir):
    days = [f"2024-01-{d:02d} {h:02d}:00:00" for d in range(1, 29) for h in (0, 23)] * 2
    random.Random(1).shuffle(days)
    for k in range(4):
        spark.createDataFrame([(d,) for d in days[k::4]], "t string") \
            .selectExpr("cast(t as timestamp_ntz) as t").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema("t timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    store = EpochStore(spark, f"{tmp_dir}/s", {"days": st.day_counts("day date, n long")}, compact_every=3)
    st.count_days(stream, "t", store, "days", f"{tmp_dir}/ckpt").awaitTermination()
    got = {str(r["day"]): r["n"] for r in store.read("days").collect()}
    assert got == {f"2024-01-{d:02d}": 4 for d in range(1, 29)}


def test_a_batch_writes_the_series_it_changes(spark, tmp_dir):
    schema = "metric string, labels map<string,string>, ts timestamp_ntz, value double"
    batches = [[("m", "a", 1, 1.0), ("m", "b", 1, 2.0)], [("m", "a", 2, 3.0)], [("m", "a", 1, 9.0), ("n", "b", 1, 4.0)]]
    for b in batches:
        spark.createDataFrame(b, "metric string, city string, s int, value double") \
            .selectExpr("metric", "map('city', city) AS labels",
                        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts", "value") \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    store = EpochStore(spark, f"{tmp_dir}/s", {"latest": st.latest_values(schema)})
    st.upsert_latest(stream, store, "latest", f"{tmp_dir}/ckpt").awaitTermination()
    got = store.read("latest").select("metric", F.col("labels")["city"], F.second("ts"), "value").collect()
    assert sorted(map(tuple, got)) == [("m", "a", 2, 3.0), ("m", "b", 1, 2.0), ("n", "b", 1, 4.0)]
    written = [store._stored("latest", [e]).count() for e in sorted(store._state().epochs)]
    assert written == [2, 1, 1]  # the third batch's older value of (m, a) changes nothing
