"""Tables that streams write to: several tables per commit, keys looked up in a stored index.

A store is a folder of tables.  One commit (an *epoch*, usually a micro-batch)
writes each table's rows to folders of its own and then one small commit
record that names the epoch; readers take the folders of recorded epochs
only.  A crash between two tables therefore shows nothing of the epoch, and
its replay overwrites the same folders.  An epoch is ``<run>-<n>``, a run's
numbers ascend, so a replay after the record was written is recognised and
does nothing.  A store has one writer at a time and any number of readers.

A table with a key takes a row only if its key is new (``ON CONFLICT DO
NOTHING``), over the whole history and without streaming state:

* its files are laid out by a hash bucket of the key; Parquet being columnar,
  the key columns of a bucket are the bucket's key index;
* beside them each epoch leaves a Bloom filter per bucket, in bitmaps of
  32,768 bits (``slots`` per bucket), sorted by bucket: a batch is first joined with the bitmaps
  of the buckets it touches, and only rows whose bits are all set are
  anti-joined with stored keys, read from the buckets of those rows.

A batch is looked at several times (its buckets, their filters, its rows), so its
rows are staged in files of the store first: nothing of it is held in memory.
The least row per key then decides the tasks once; the lookup in the filters (a
broadcast, as the layout bounds them), the anti-join with stored keys and the
writing go on in those tasks.

A table without a key takes every row; its readers see all of them, or what
``merge`` makes of them (sums of partial counts, latest values).

``compact`` rewrites what is visible as one epoch, after which a reader opens
one folder per table, and ``vacuum`` deletes what no reader needs.  A commit
compacts by itself after ``compact_every`` epochs, which also bounds the
records that the driver reads.  Buckets and slots are properties of the store,
written when it is made; more keys than expected make the filter pass more
rows on to the anti-join and change no result.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from emporium.operators.sinks import _run_all
from emporium.operators.upsert import _any_null, first_of_keys, first_wins

BUCKET = "key_bucket"
SLOT_BITS = 32_768
PROBES = 3
#: Bits of the filter per expected key.
BITS_PER_KEY = 10
#: Bytes of all bitmaps up to which a batch meets them in a broadcast.
BROADCAST_BITMAPS = 8 << 20


@dataclass
class Table:
    """A table of a store: its schema and, optionally, what makes a row new."""

    schema: StructType
    key: Sequence[str] = ()
    order_by: Sequence[Column | str] | None = None
    merge: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class _State:
    """What the commit records say: visible epochs, last number per run, last sequence."""

    epochs: list[str] = field(default_factory=list)
    done: dict[str, int] = field(default_factory=dict)
    sequence: int = 0


class EpochStore:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table], buckets: int = 64,
                 expected_keys: int = 3_000_000, compact_every: int = 50):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self.compact_every = compact_every
        layout = self._layout() or {
            "buckets": buckets, "slots": max(1, -(-expected_keys * BITS_PER_KEY // (buckets * SLOT_BITS)))}
        self.buckets, self.slots = layout["buckets"], layout["slots"]
        if self._layout() is None:
            self._write_text(json.dumps(layout), f"{self.root}/_layout")

    # ------------------------------------------------------------- records
    def _layout(self) -> dict | None:
        lines = self._read_text(f"{self.root}/_layout")
        return json.loads(lines[0]) if lines else None

    def _read_text(self, path: str) -> list[str]:
        try:
            return [r[0] for r in self.spark.read.option("recursiveFileLookup", True).text(path).collect()]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _write_text(self, line: str, path: str) -> None:
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    def _state(self) -> _State:
        state = _State()
        records = sorted(map(json.loads, self._read_text(f"{self.root}/_commits")), key=lambda r: r["sequence"])
        for r in records:
            if r["base"]:
                state.epochs = []
            state.epochs.append(r["epoch"])
            for run, n in r["done"].items():
                state.done[run] = max(n, state.done.get(run, n))
            state.sequence = r["sequence"]
        return state

    def _record(self, state: _State, epoch: str, done: dict[str, int], base: bool = False) -> None:
        record = {"sequence": state.sequence + 1, "epoch": epoch, "done": done, "base": base}
        self._write_text(json.dumps(record), f"{self.root}/_commits/{epoch}")

    def committed(self) -> list[str]:
        """The epochs that readers see, oldest first."""
        return self._state().epochs

    # ------------------------------------------------------------- reading
    def _folder(self, name: str, epochs: list[str], schema: StructType | str, kind: str = "data") -> DataFrame:
        """The rows of a table's epochs, read with their schema (an epoch may be empty)."""
        if not epochs:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{name}/{kind}"
        return self.spark.read.schema(schema).option("basePath", base) \
            .parquet(*(f"{base}/epoch={e}" for e in epochs))

    def _stored(self, name: str, epochs: list[str]) -> DataFrame:
        table = self.tables[name]
        return self._folder(name, epochs, StructType(list(table.schema.fields)).add(BUCKET, IntegerType()))

    def read(self, name: str) -> DataFrame:
        """The table as of the last commit."""
        rows = self._stored(name, self._state().epochs).select(*self.tables[name].schema.names)
        merge = self.tables[name].merge
        return merge(rows) if merge else rows

    # ------------------------------------------------------------- writing
    def _key_hash(self, name: str, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *self.tables[name].key)

    def _places(self, name: str) -> list[Column]:
        """Bucket, slot and bits of a row's key."""
        bits = [F.pmod(self._key_hash(name, 2 + i), F.lit(SLOT_BITS)).cast("int").alias(f"_bit{i}")
                for i in range(PROBES)]
        return [F.pmod(self._key_hash(name, 0), F.lit(self.buckets)).cast("int").alias(BUCKET),
                F.pmod(self._key_hash(name, 1), F.lit(self.slots)).cast("int").alias("_slot"), *bits]

    _BITMAPS = f"_slot int, bits binary, {BUCKET} int"

    def _bitmaps(self, name: str, epochs: list[str], buckets: list[int]) -> DataFrame:
        """The bitmaps of some buckets, as words of 32 bits, the first byte highest."""
        words = F.transform(F.sequence(F.lit(0), F.lit(SLOT_BITS // 32 - 1)), lambda w: F.conv(
            F.hex(F.substring(F.col("bits"), w * 4 + 1, F.lit(4))), 16, 10).cast("long"))
        bitmaps = self._folder(name, epochs, self._BITMAPS, "filter").where(F.col(BUCKET).isin(buckets)) \
            .groupBy(BUCKET, "_slot").agg(F.bitmap_or_agg("bits").alias("bits")) \
            .select(BUCKET, "_slot", words.alias("_words"))
        bounded = self.buckets * self.slots * SLOT_BITS // 8 <= BROADCAST_BITMAPS
        return bitmaps.hint("broadcast" if bounded else "merge")

    @staticmethod
    def _seen() -> Column:
        """Whether all bits of a row's key are set in its bitmap."""
        def is_set(bit: Column) -> Column:
            word = F.get(F.col("_words"), F.shiftright(bit, 5))
            return F.getbit(word, (3 - F.shiftright(bit, 3) % 4) * 8 + bit % 8) == 1
        return F.coalesce(reduce(Column.__and__, (is_set(F.col(f"_bit{i}")) for i in range(PROBES))), F.lit(False))

    def _new_rows(self, name: str, rows: DataFrame, epochs: list[str]) -> DataFrame:
        """The rows of a batch whose key is neither repeated in it nor stored.
        The batch is read several times, so it is a staged one if any epoch is stored."""
        table = self.tables[name]
        keys = list(table.key)
        if not epochs:
            return first_wins(rows, keys, table.order_by)
        null_key = _any_null(keys)
        # repeated keys change neither the buckets a batch touches nor those it may repeat
        places = rows.where(~null_key).select(*self._places(name))
        touched = [r[0] for r in places.select(BUCKET).distinct().collect()]  # at most `buckets`
        bitmaps = self._bitmaps(name, epochs, touched)
        suspect = [r[0] for r in places.join(bitmaps, [BUCKET, "_slot"], "left").where(self._seen())
                   .select(BUCKET).distinct().collect()]
        probed = first_of_keys(rows.where(~null_key), keys, table.order_by).select("*", *self._places(name)) \
            .join(bitmaps, [BUCKET, "_slot"], "left").select(*rows.columns, self._seen().alias("_seen"))
        stored = self._stored(name, epochs).where(F.col(BUCKET).isin(suspect)) \
            .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        same = reduce(Column.__and__, (F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)))
        # merged: the planner knows stored keys by their compressed size in files, a fraction of what
        # they take in a broadcast (320 MB for 3 million keys), and a merge may spill
        fresh = probed.join(stored.hint("merge"), same & F.col("_seen"), "left_anti")
        return fresh.select(*rows.columns).unionByName(rows.where(null_key))

    def _write(self, name: str, rows: DataFrame, epoch: str) -> None:
        """A table's part of an epoch; anything of an earlier attempt is replaced."""
        table = self.tables[name]
        base = f"{self.root}/{name}"
        if not table.key:
            rows.withColumn(BUCKET, F.lit(0)).write.mode("overwrite").partitionBy(BUCKET) \
                .parquet(f"{base}/data/epoch={epoch}")
            return
        # whichever task holds a row writes it, so neither a bucket nor null keys bound the writers
        rows.select("*", self._places(name)[0]) \
            .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{base}/data/epoch={epoch}")
        written = self._stored(name, [epoch]).select(*table.key).where(~_any_null(table.key))
        self._filter(written.select(*self._places(name))) \
            .sortWithinPartitions(BUCKET, "_slot") \
            .write.mode("overwrite").parquet(f"{base}/filter/epoch={epoch}")

    @staticmethod
    def _filter(places: DataFrame) -> DataFrame:
        """The bitmaps of keys: bit ``b`` is bit ``b % 8`` of byte ``b / 8``.

        Bits are gathered in words of 64 by a hash aggregate, which merges them
        before they move; a bitmap has at most 512 words, written as hexadecimal
        digits with the words without a bit between them.
        """
        bit = F.col("_bit")
        at = (7 - F.shiftright(bit, 3) % 8) * 8 + bit % 8
        words = places.select(BUCKET, "_slot", F.explode(F.array(*[f"_bit{i}" for i in range(PROBES)])).alias("_bit")) \
            .groupBy(BUCKET, "_slot", F.shiftright(bit, 6).alias("_word")) \
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at)).alias("_bits")) \
            .groupBy(BUCKET, "_slot").agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))

        def digits(word: Column, i: Column) -> Column:
            before = F.coalesce(F.get(F.col("_words"), i - 1)["_word"], F.lit(-1))
            return F.concat(F.call_function("repeat", F.lit("0"), (word["_word"] - before - 1) * 16),
                            F.lpad(F.hex(word["_bits"]), 16, "0"))
        bits = F.unhex(F.rpad(F.array_join(F.transform("_words", digits), ""), SLOT_BITS // 4, "0"))
        return words.select("_slot", bits.alias("bits"), BUCKET)

    # ------------------------------------------------------------- staging
    @contextmanager
    def staged(self, epoch: str, name: str, rows: DataFrame) -> Iterator[DataFrame]:
        """The rows in files of the store, for as long as they are looked at."""
        path = f"{self.root}/_staged/{epoch}.{name}"
        rows.write.mode("overwrite").parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            self._delete(path)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def commit(self, run: str, n: int, batches: dict[str, DataFrame], staged: bool = False) -> bool:
        """Commit one epoch of ``run`` to all tables of ``batches`` together;
        False if it was committed before.  ``staged``: the batches are read from
        files and may be read again."""
        state = self._state()
        if state.done.get(run, n - 1) >= n:
            return False
        epoch = f"{run}-{n}"

        def part(name: str) -> None:
            rows = batches[name].select(*self.tables[name].schema.names) if name in batches \
                else self.spark.createDataFrame([], self.tables[name].schema)
            if not self.tables[name].key or name not in batches:
                self._write(name, rows, epoch)
            elif staged or not state.epochs:
                self._write(name, self._new_rows(name, rows, state.epochs), epoch)
            else:
                with self.staged(epoch, name, rows) as kept:
                    self._write(name, self._new_rows(name, kept, state.epochs), epoch)

        _run_all({name: (lambda name=name: part(name)) for name in self.tables})
        self._record(state, epoch, {run: n})
        if len(state.epochs) + 1 >= self.compact_every:
            self.compact()
        return True

    # --------------------------------------------------------- maintenance
    def compact(self) -> None:
        """Rewrite the visible rows as one epoch that replaces all before it."""
        state = self._state()
        epoch = f"base-{state.sequence + 1}"

        def part(name: str) -> None:
            rows = self.read(name)
            if self.tables[name].key:  # the files of all epochs are gathered in fewer
                rows = rows.repartition(self._places(name)[0], F.xxhash64(*rows.columns))
            self._write(name, rows, epoch)

        _run_all({name: (lambda name=name: part(name)) for name in self.tables})
        self._record(state, epoch, state.done, base=True)

    def vacuum(self) -> None:
        """Delete epochs that a compaction replaced or that were never committed,
        and their records.  Readers that started before the compaction must be done."""
        visible = set(self._state().epochs)
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folders = [f"{self.root}/{name}/{kind}" for name in self.tables for kind in ("data", "filter")]
        for folder in [*folders, f"{self.root}/_commits"]:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            fs = path.getFileSystem(conf)
            for status in (fs.listStatus(path) if fs.exists(path) else ()):
                if status.getPath().getName().removeprefix("epoch=") not in visible:
                    fs.delete(status.getPath(), True)
        self._delete(f"{self.root}/_staged")  # of commits that broke off
