"""

The reference creates staging tables, COPYs each CSV, inserts with
``ON CONFLICT DO NOTHING`` in parent-before-child order and commits once.
Here: each CSV is read with COPY's rules, de-duplicated (first row of a key
by file and position wins; geolocation is unique on all columns), inserted
if absent into the currently published version (if any), checked for
orphaned foreign keys, and all nine tables are published under one new
version whose manifest is written last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from emporium.operators import quality, upsert
from emporium.operators.sinks import NothingPublished, publish_tables, read_published
from emporium.sources.files import KEYS, LOAD_ORDER, SCHEMAS, read_csv_table

# (child table, foreign key columns, parent table, parent key columns)
FOREIGN_KEYS = [
    ("orders", ["customer_id"], "customers", ["customer_id"]),
    ("order_items", ["order_id"], "orders", ["order_id"]),
    ("order_items", ["product_id"], "products", ["product_id"]),
    ("order_items", ["seller_id"], "sellers", ["seller_id"]),
    ("order_payments", ["order_id"], "orders", ["order_id"]),
    ("order_reviews", ["order_id"], "orders", ["order_id"]),
]

#: Rows of an exported file.
ROWS_PER_FILE = 1_000_000


@dataclass
class LoadResult:
    version: str
    tables: dict[str, DataFrame]
    inserted: dict[str, DataFrame]


def bulk_load(spark: SparkSession, csv_paths: dict[str, str], root: str,
              version: str | None = None, check_keys: bool = True) -> LoadResult:
    """Load every table of ``csv_paths`` (name → CSV file or folder) into ``root``."""
    try:
        current = read_published(spark, root)
    except NothingPublished:
        current = {}
    new_tables, inserted = {}, {}
    for name in LOAD_ORDER:
        target = current.get(name)
        if target is None:
            target = spark.createDataFrame([], SCHEMAS[name])
        if name not in csv_paths:
            new_tables[name] = target
            continue
        staged = read_csv_table(spark, name, csv_paths[name])
        if KEYS[name] is None:
            change = upsert.insert_distinct_if_absent(target, staged.select(*target.columns))
        else:
            batch = upsert.first_wins(staged, KEYS[name], ["_source_file", "_source_pos"])
            change = upsert.insert_if_absent(target, batch.select(*target.columns), KEYS[name],
                                             dedupe=False)
        new_tables[name] = change.table
        inserted[name] = change.changed
    # each table is computed once, when its version folder is written; the
    # foreign keys are checked on the written Parquet before the manifest
    version = publish_tables(spark, new_tables, root, version,
                             check=check_foreign_keys if check_keys else None)
    return LoadResult(version, read_published(spark, root, version), inserted)


def check_foreign_keys(tables: dict[str, DataFrame]) -> None:
    """Raise on the first foreign key (in declaration order) with orphaned
    child rows; the independent checks run as concurrent jobs."""
    from emporium.operators.sinks import _run_all
    checks = {i: (lambda c=child, f=fk, p=parent, k=key:
                  quality.check_foreign_key(tables[c], f, tables[p], k).isEmpty())
              for i, (child, fk, parent, key) in enumerate(FOREIGN_KEYS)
              if child in tables and parent in tables}
    clean = _run_all(checks)
    for i, (child, fk, parent, key) in enumerate(FOREIGN_KEYS):
        if i in clean and not clean[i]:
            raise ValueError(f"insert or update on table {child} violates foreign key "
                             f"{fk} -> {parent}{key}")


def export_csv(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write tables as CSV folders the loader reads back (header, COPY quoting),
    compressed: a file is then read by one task, so its rows are bounded."""
    from emporium.operators.sinks import _run_all
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in tables}

    def write_one(name: str, df: DataFrame) -> None:
        (df.select(*SCHEMAS[name].fieldNames()).write.mode("overwrite")
         .option("header", True).option("quote", '"').option("escape", '"')
         .option("nullValue", "\\N").option("emptyValue", '""')
         .option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
         .csv(paths[name]))

    _run_all({name: (lambda n=name, d=df: write_one(n, d)) for name, df in tables.items()})
    return paths
