"""Near-duplicate groups of documents by SimHash (segment-popcount embedding).

1. Each text gets a 64-bit fingerprint: lower-cased (A-Z) words, overlapping
   word shingles with repeats, XXH64 of every shingle; a bit is set when more
   than half of the shingle hashes have it.
2. Each distinct fingerprint is embedded as sixteen segment bit counts, one
   per four bits.  The Manhattan distance of two embeddings never exceeds
   the Hamming distance of the fingerprints.
3. Grid range-join: two embeddings at Manhattan distance two or less have a
   grid point within one step of both, so every fingerprint visits its own
   grid point and the up to 32 points one step away.  Fingerprints that meet
   nobody at a point are done.
4. Exact check: at a shared grid point, two fingerprints differ in at most
   two bits exactly if they share a 64-bit value that is at most one flipped
   bit from each and whose own embedding is that point.  Each fingerprint
   lists those one to four values and links to the smallest fingerprint that
   lists the same value.  At most 65 fingerprints can list a value, so the
   groups are bounded however large a family of copies is, no pairs are
   written out, and no link is lost.
5. Components of the links give the groups.

Only distinct fingerprints enter steps 2 to 5; exact copies are one row.  The
answers for fingerprints that hold a large part of all documents are
broadcast (``hot.join_counted``), so no group of copies meets in one task.

Defined results: a null or empty text has fingerprint zero and is linked
like any other.  Null ids are ignored when the smallest id is chosen (null
when the group has no other).  Repeated rows are answered one by one.  Empty
input gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.llm.graph import components
from emporium.llm.hot import join_counted
from emporium.session import materialise

SEED = 42
#: Shingles hashed at a time, so that a very long text needs little memory.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    total, ones = 0, np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    while True:
        block = [digest(g, SEED) for g, _ in zip(grams, range(BLOCK))]
        if block:
            bits = np.unpackbits(np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8),
                                 axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(block)
        if len(block) < BLOCK:
            break
    packed = np.packbits(ones * 2 > total, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text, shingle: int = 3):
    """Column of fingerprints (bigint) of a text column."""
    @F.pandas_udf(T.LongType())
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")
    return simhash.asNondeterministic()(text)  # evaluated once, never copied by the optimizer


# SQL over ``fp``: its sixteen segment bit counts, packed as the nibbles of a
# long (each count is at most 4, so sums of nibbles never carry).
_LOW = "1229782938247303441L"  # the lowest bit of every nibble
_EMBEDDING = " + ".join([f"(fp & {_LOW})"]
                        + [f"(shiftrightunsigned(fp, {i}) & {_LOW})" for i in (1, 2, 3)])
# Visit 32 is the embedding itself; visits 2s and 2s + 1 add or take one from
# the count of segment s, where that count has room.
_SEGMENT = "4 * shiftright(visit, 1)"
_POINT = f"""CASE WHEN visit = 32 THEN vector
    WHEN visit % 2 = 0 AND (shiftrightunsigned(vector, {_SEGMENT}) & 15) < 4
        THEN vector + shiftleft(1L, {_SEGMENT})
    WHEN visit % 2 = 1 AND (shiftrightunsigned(vector, {_SEGMENT}) & 15) > 0
        THEN vector - shiftleft(1L, {_SEGMENT}) END"""
# The 64-bit values at most one bit from fp whose embedding is the visited
# point: flips of a zero bit raise a count, flips of a one bit lower it.
_VALUES = f"""CASE WHEN visit = 32 THEN array(fp) ELSE transform(
    filter(sequence(0, 3), i -> (shiftrightunsigned(fp, {_SEGMENT} + i) & 1) = visit % 2),
    i -> fp ^ shiftleft(1L, {_SEGMENT} + i)) END"""


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints ``(fp)`` → edges ``(a, b)`` whose components are
    those of "differ in at most two bits"."""
    visits = (fps.selectExpr("fp", f"{_EMBEDDING} AS vector", "explode(sequence(0, 32)) AS visit")
              .selectExpr("fp", "visit", f"{_POINT} AS point").where("point IS NOT NULL"))
    met = visits.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("point"))).where("n > 1")
    listed = met.selectExpr("fp", f"explode({_VALUES}) AS value")
    first = F.min("fp").over(Window.partitionBy("value"))
    return listed.select(F.col("fp").alias("a"), first.alias("b")).where("a <> b").distinct()


def fingerprint_groups(fps: DataFrame) -> DataFrame:
    """``(fp, first_id, ...)`` per distinct fingerprint → ``(fp, component_id, ...)``."""
    fps = materialise(fps, "simhash-distinct")
    roots = components(links(fps.select("fp")), "simhash-links")
    linked = materialise(fps.join(roots, fps.fp == roots.node).select("fp", "root", "first_id"),
                         "simhash-linked")
    least = materialise(linked.groupBy("root").agg(F.min("first_id").alias("least_id"),
                                                   F.count(F.lit(1)).alias("n")), "simhash-least")
    named = join_counted(linked, least, ["root"], linked.count()).select("fp", "least_id")
    return fps.join(named, "fp", "left") \
        .withColumn("component_id", F.coalesce("least_id", "first_id")).drop("first_id", "least_id")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest
    id reachable over links of at most two differing bits.
    """
    signed = materialise(docs.select(F.col(id_col).alias("doc_id"),
                                     fingerprint_column(F.col(text_col), shingle).alias("fp")),
                         "simhash-fingerprints")
    groups = materialise(fingerprint_groups(signed.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))), "simhash-groups")
    return join_counted(signed, groups, ["fp"], signed.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group left:
    the one with the smallest id (of equal ids, the first written); rows with
    a null id stay only when their group has no other."""
    tagged = materialise(
        docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs[id_col].alias("id"),
                    fingerprint_column(docs[text_col], shingle).alias("fp"),
                    F.monotonically_increasing_id().alias("row_no")), "simhash-tagged")
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "row_no")
    fps = tagged.groupBy("fp").agg(F.min(rank).alias("first_id"))
    kept = fingerprint_groups(fps).select(F.col("component_id.row_no").alias("row_no")).distinct()
    return tagged.join(kept, "row_no", "left_semi").select("doc.*")
