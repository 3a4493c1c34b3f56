"""Findings of round 4: a batch is neither cached nor met by stored keys in a broadcast."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from emporium.plans import jobs
from emporium.sources.testdata import Star
from emporium.streaming import epochs
from emporium.streaming import ingest as st
from emporium.streaming.epochs import BUCKET, PROBES, SLOT_BITS, EpochStore, Table

SCHEMA = "k string, i int, v double"


def store_at(spark, root, **options):
    return EpochStore(spark, root, {"t": Table(st._schema(SCHEMA), ["k", "i"], ["v"])}, buckets=4, **options)


@pytest.fixture()
def plans(monkeypatch):
    """The plans of the rows that stores write, by epoch and table."""
    made, write = {}, EpochStore._write

    def keep(self, name, df, epoch):
        made[epoch, name] = df._jdf.queryExecution().executedPlan().toString()
        write(self, name, df, epoch)

    monkeypatch.setattr(EpochStore, "_write", keep)
    return made


def some_days(spark, folder):
    """Orders 0 to 11, each with six lines that repeat three line numbers."""
    day = dt.datetime(2020, 1, 1)
    spark.createDataFrame([(k, k % 5, "FOP"[k % 3], 100.0 + k, day, "1-URGENT") for k in range(12)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, 3 * (1 + n % 3), n, n % 3, 1.0, 10.0 + n, day) for k in range(12) for n in range(6)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("name", ["items", "orders", "payments"])
def test_stored_keys_are_merged_and_batches_are_not_cached(spark, tmp_dir, plans, name):
    some_days(spark, tmp_dir)
    got = rows(getattr(jobs, f"stream_ingest_{name}")(Star(spark, tmp_dir)))
    batches = {k: p for k, p in plans.items() if not k[0].startswith("seed")}
    assert len(batches) == 3 * jobs.ARRIVALS
    for (epoch, table), plan in batches.items():
        assert "InMemoryTableScan" not in plan, (epoch, table)
        anti = ["SortMergeJoin" in line for line in plan.splitlines() if "LeftAnti" in line]
        met = table == "order_items" or not epoch.endswith("-0")  # the seed holds items only
        assert anti == [True] * met, (epoch, table)
    if name == "items":  # six numbered lines of an order, and the first of a raw line number that is none of them
        assert {r[:2] for r in got} == {(str(k), i) for k in range(12) for i in (1, 2, 3, 4, 5, 6, 9)}
        assert [r[5] for r in got if r[:2] == ("3", 9)] == [12.0]
    elif name == "orders":  # as they came first
        assert [(r[0], r[2]) for r in got] == sorted(
            (str(k), ("delivered", "shipped", "processing")[k % 3]) for k in range(12))
    else:
        assert [(r[0], r[1], r[4]) for r in got] == sorted(
            [(str(k), 1, 100.0 + k) for k in range(12)] + [("0", 2, 10.0), ("10", 2, 10.0)])
    assert len(got) == {"items": 84, "orders": 12, "payments": 14}[name]


def test_filter_is_the_bitmap_of_its_bits(spark):
    rng = random.Random(5)
    places = [(b, s, *(rng.randrange(SLOT_BITS) for _ in range(PROBES))) for b in range(2) for s in range(3)
              for _ in range(400)] + [(2, 0, 0, 0, 0), (2, 1, SLOT_BITS - 1, 63, 64)]
    df = spark.createDataFrame(places, f"{BUCKET} int, _slot int, _bit0 int, _bit1 int, _bit2 int")
    want = df.select(BUCKET, "_slot", F.explode(F.array("_bit0", "_bit1", "_bit2")).alias("b")) \
        .groupBy("_slot", BUCKET).agg(F.bitmap_construct_agg(F.col("b").cast("long")).alias("bits"))
    assert rows(EpochStore._filter(df)) == rows(want.select("_slot", "bits", BUCKET))


@pytest.mark.parametrize("most", [0, 8 << 20])
def test_large_and_small_filters_pass_the_same_rows(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(epochs, "BROADCAST_BITMAPS", most)
    rng, store, want, nulls = random.Random(11), store_at(spark, f"{tmp_dir}/s"), {}, []
    for n in range(3):
        batch = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3]), float(100 * n + at)) for at in range(30)]
        store.commit("r", n, {"t": spark.createDataFrame(batch, SCHEMA)})
        for r in batch:
            if None in r[:2]:
                nulls.append(r)
            else:
                want.setdefault(r[:2], r)
    assert rows(store.read("t")) == sorted([*want.values(), *nulls], key=repr)


def test_rows_that_change_when_read_again_are_staged(spark, tmp_dir):
    store = store_at(spark, f"{tmp_dir}/s")
    for n in range(3):
        changing = spark.range(300).select((F.rand() * 120).cast("int").cast("string").alias("k"),
                                           F.lit(1).alias("i"), F.rand().alias("v"))
        store.commit("r", n, {"t": changing})
    keys = [r[0] for r in rows(store.read("t"))]
    assert len(keys) == len(set(keys)) > 100
    assert os.listdir(f"{tmp_dir}/s/_staged") == []  # nothing stays
    os.makedirs(f"{tmp_dir}/s/_staged/r-3.t")  # but what a broken commit left
    store.vacuum()
    assert not os.path.exists(f"{tmp_dir}/s/_staged")
