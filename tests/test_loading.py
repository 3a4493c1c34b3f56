"""Loading: CSV rules, first-wins de-duplication, insert-if-absent, append."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from conftest import rows
from emporium.operators import upsert
from emporium.sources.files import read_csv_table

REVIEW_HEADER = ("review_id,order_id,review_score,review_comment_title,review_comment_message,"
                 "review_creation_date,review_answer_timestamp\n")


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_quotes(spark, tmp_dir):
    # embedded newline, doubled quote, quoted empty string vs empty field
    path = _write(os.path.join(tmp_dir, "r.csv"), REVIEW_HEADER
                  + 'r1,o1,5,"","two\nlines, ""quoted""",2018-01-01 10:00:00,2018-01-02 10:00:00\n'
                  + "r2,o2,4,,plain,2018-01-01 10:00:00,\n")
    got = rows(read_csv_table(spark, "order_reviews", path, with_position=False))
    assert got == [
        ("r1", "o1", 5, "", 'two\nlines, "quoted"', dt.datetime(2018, 1, 1, 10), dt.datetime(2018, 1, 2, 10)),
        ("r2", "o2", 4, None, "plain", dt.datetime(2018, 1, 1, 10), None),
    ]


def test_csv_leading_zero_zip_is_int(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "c.csv"),
                  "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                  "c1,u1,01310,sao paulo,SP\n")
    got = rows(read_csv_table(spark, "customers", path, with_position=False))
    assert got == [("c1", "u1", 1310, "sao paulo", "SP")]


def test_csv_bad_row_aborts_load(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "bad.csv"), REVIEW_HEADER
                  + "r1,o1,5,,,2018-01-01 10:00:00,\n"
                  + "r2,o2,five,,,2018-01-01 10:00:00,\n")
    with pytest.raises(Exception):
        read_csv_table(spark, "order_reviews", path).collect()

@pytest.mark.parametrize("row", ['s1,1,"a\nb",X', 's1,1,a,"X\nY"'])
def test_csv_newline_needs_multi_line(spark, tmp_dir, row):
    path = _write(os.path.join(tmp_dir, "n.csv"),
                  "seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + row + "\n")
    with pytest.raises(Exception):
        read_csv_table(spark, "sellers", path).collect()
    whole = read_csv_table(spark, "sellers", path, multi_line=True, with_position=False)
    assert "\n" in "".join(str(v) for v in whole.first())


def test_csv_split_file_keeps_its_order(spark, tmp_dir):
    n = 2_000
    path = _write(os.path.join(tmp_dir, "s.csv"),
                  "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                  + "".join(f"s{i:05d},{i},city,X\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_csv_table(spark, "sellers", path)
        assert df.rdd.getNumPartitions() > 1
        got = [r.seller_id for r in df.orderBy("_source_pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [f"s{i:05d}" for i in range(n)]


def test_csv_positions_follow_file_order(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "p.csv"),
                  "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                  "s1,1,a,X\ns1,2,b,Y\ns2,3,c,Z\n")
    df = read_csv_table(spark, "sellers", path)
    first = upsert.first_wins(df, "seller_id", ["_source_file", "_source_pos"])
    assert rows(first.select("seller_id", "seller_city")) == [("s1", "a"), ("s2", "c")]


def _target(spark):
    return spark.createDataFrame([("k1", "old")], "k string, v string")


def test_dup_keys_first_row_wins_and_existing_row_kept(spark):
    new = spark.createDataFrame([("k1", "new", 1), ("k2", "first", 2), ("k2", "second", 3),
                                 ("k3", "b", 5), ("k3", "a", 4)], "k string, v string, pos int")
    target = _target(spark)
    ch = upsert.insert_if_absent(target, new.select("k", "v"), "k")  # default: smallest row
    assert rows(ch.table) == [("k1", "old"), ("k2", "first"), ("k3", "a")]
    # explicit arrival order
    ordered = upsert.first_wins(new, "k", ["pos"]).select("k", "v")
    assert rows(ordered) == [("k1", "new"), ("k2", "first"), ("k3", "a")]
    ch2 = upsert.insert_if_absent(target, new.select("k", "v"), "k")
    assert ch2.rowcount() == 2


def test_insert_twice_equals_once(spark):
    new = spark.createDataFrame([("k2", "x"), ("k2", "y"), ("k3", "z")], "k string, v string")
    once = upsert.insert_if_absent(_target(spark), new, "k")
    twice = upsert.insert_if_absent(once.table, new, "k")
    assert rows(once.table) == rows(twice.table)
    assert twice.rowcount() == 0


def test_null_keys_never_conflict(spark):
    target = spark.createDataFrame([(None, "stored"), ("a", "stored")], "k string, v string")
    new = spark.createDataFrame([(None, "n1"), (None, "n2"), ("a", "dup"), ("b", "new")],
                                "k string, v string")
    ch = upsert.insert_if_absent(target, new, "k")
    assert rows(ch.changed) == sorted([(None, "n1"), (None, "n2"), ("b", "new")], key=repr)


def test_distinct_load_collapses_full_duplicates(spark):
    target = spark.createDataFrame([], "a int, b string")
    new = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (1, None)], "a int, b string")
    ch = upsert.insert_distinct_if_absent(target, new)
    # full duplicates collapse; rows with a NULL are distinct from each other
    # under a unique index but DISTINCT already merged the identical pair
    assert rows(ch.table) == sorted([(1, "x"), (1, None)], key=repr)


def test_append_raises_on_duplicate(spark):
    target = _target(spark)
    ok = upsert.append(target, spark.createDataFrame([("k9", "v")], "k string, v string"), "k")
    assert len(ok.table.collect()) == 2
    bad = upsert.append(target, spark.createDataFrame([("k1", "v")], "k string, v string"), "k")
    with pytest.raises(Exception, match="duplicate key"):
        bad.table.collect()


def test_bulk_load_all_or_nothing(spark, tmp_dir):
    from emporium.plans.load import bulk_load
    from emporium.operators.sinks import read_published
    cust = _write(os.path.join(tmp_dir, "customers.csv"),
                  "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                  "c1,u1,1,first,SP\nc1,u1,1,second,SP\nc2,u2,2,x,RJ\n")
    orders = _write(os.path.join(tmp_dir, "orders.csv"),
                    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
                    "o1,c1,created,2020-01-01 10:00:00,,,,\n")
    root = os.path.join(tmp_dir, "wh")
    r1 = bulk_load(spark, {"customers": cust, "orders": orders}, root, version="v1")
    assert rows(r1.tables["customers"].select("customer_id", "customer_city")) == [("c1", "first"), ("c2", "x")]
    assert r1.tables["orders"].count() == 1
    r2 = bulk_load(spark, {"customers": cust, "orders": orders}, root, version="v2")
    assert r2.inserted["customers"].count() == 0 and r2.tables["customers"].count() == 2
    bad = _write(os.path.join(tmp_dir, "bad_orders.csv"),
                 "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                 "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
                 "o2,c9,created,2020-01-01 10:00:00,,,,\n")
    with pytest.raises(ValueError, match="foreign key"):
        bulk_load(spark, {"orders": bad}, root, version="v3")
    latest = read_published(spark, root)
    assert rows(latest["orders"].select("order_id")) == [("o1",)]   # v3 never published


def test_append_order_with_items_and_payments(spark):
    orders = spark.createDataFrame([("o1", "c1")], "order_id string, customer_id string")
    items = spark.createDataFrame([("o1", 1, 10)], "order_id string, order_item_id int, price int")
    pays = spark.createDataFrame([("o1", 1, 10)], "order_id string, payment_sequential int, v int")
    o, i, p = upsert.append_order(
        orders, items, pays,
        spark.createDataFrame([("o2", "c2")], orders.schema),
        spark.createDataFrame([("o2", 1, 5), ("o2", 2, 6)], items.schema),
        spark.createDataFrame([("o2", 1, 11)], pays.schema))
    assert (o.table.count(), i.table.count(), p.table.count()) == (2, 3, 2)
    _, bad_items, _ = upsert.append_order(
        orders, items, pays, spark.createDataFrame([], orders.schema),
        spark.createDataFrame([("o9", 1, 5)], items.schema), spark.createDataFrame([], pays.schema))
    with pytest.raises(Exception, match="foreign key"):
        bad_items.table.collect()


def test_first_wins_with_map_column(spark):
    df = spark.createDataFrame([("k", {"a": "1"}, 2), ("k", {"a": "2"}, 1)],
                               "k string, labels map<string,string>, pos int")
    got = upsert.first_wins(df, "k", ["pos"]).collect()
    assert len(got) == 1 and got[0].labels == {"a": "2"}


def test_first_wins_across_csv_files(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "sellers")
    os.makedirs(folder)
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    _write(os.path.join(folder, "part-1.csv"), header + "s2,2,b-first,Y\ns1,1,a-first,X\n")
    _write(os.path.join(folder, "part-2.csv"), header + "s1,9,a-second,X\ns3,3,c,Z\ns2,8,b-second,Y\n")
    df = read_csv_table(spark, "sellers", folder)
    first = upsert.first_wins(df, "seller_id", ["_source_file", "_source_pos"])
    got = rows(first.select("seller_id", "seller_city"))
    assert got == [("s1", "a-first"), ("s2", "b-first"), ("s3", "c")]
