r"""Fuzzy line dedup by MinHash: one line stays of every group of near-equal lines.

Lines end at ``\n``.  A line is compared in lower case with white space runs
as one space and none at its ends; two lines are near-equal when the Jaccard
similarity of their sets of 8-character shingles (the whole line, if shorter)
is 0.8 or more, and a group is a connected component of such links.

1. Equal lines: a partially aggregated group-by leaves each different line
   once, however often it occurs, and that one is brought to its normal form.
2. MinHash: 64 minima of hashed shingles, the first of 32 orders and of their
   reverses, as 16 bands of four: lines at 0.8 share a band with probability 0.9998.  Bands held by one line are dropped,
   and bands with the same set of lines count once.
3. Exact check within a band: lines come together in units of a bounded
   number of lines and characters.  In a unit the shingles are numbered
   exactly, a product of the lines-by-shingles matrix with itself counts what
   each pair shares, and a union-find leaves at most one link a line.  A
   larger band is cut into chunks, each checked together with the band's
   first line, the pivot.  Lines linked to the pivot are in one group already
   and need not meet each other again.  A few far lines, those that are not
   linked to it, meet all lines of the band, chunk by chunk.  The lines of bands
   with many far lines are joined by their rarest shingles: of two lines
   at 0.8 or more the prefixes in one order of all shingles share a shingle
   (lines of log files with a common start do not, and cost a few rows each).
   The groups under these shingles are checked in the same way; only lines that
   are far from the pivot of such a group too meet all its lines, chunk by
   chunk.  No link is lost.
4. Distributed union-find over the links; the line that stays in a group is
   the first one of the smallest document id.

Defined results: lines without any visible character always stay and belong
to no group; a null text has no lines and stays null; documents that repeat
in id and text are one document and are answered alike; documents with null
ids come last when the line that stays is chosen; an empty table gives no
rows.  Very long texts and lines are whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.llm.graph import components
from emporium.llm.hot import join_counted
from emporium.session import materialise

SHINGLE = 8
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: Lines and characters of a chunk; a unit holds two chunks at most.
CHUNK_LINES, CHUNK_CHARS = 256, 1 << 18
#: Far lines of up to this number of chunks meet all lines of their band, at
#: one row more a line than this at most.  Lines of more crowded bands are joined by
#: their rarest shingles, about as many rows a line, with the same links.
FAR_CHUNKS = 32
#: Columns of the lines-by-shingles matrix held at a time.
TILE = 4_096
#: Characters of a line up to which two lines are compared by sets of strings.
SHORT = 1 << 11
#: The lines to compare are broadcast up to this measured number (8 bytes each).
BROADCAST_LINES = 1_000_000
#: Counts of shingles by hash, which order the shingles of lines in large bands.
BUCKETS = 1 << 18
#: Band keys of a bucket, about; a task holds up to twice as many at a time.
BUCKET_KEYS = 1 << 18
#: Characters hashed at a time.
PIECE = 1 << 16

_random = np.random.default_rng(20240607)
#: Multiplied by each of these, a shingle's hash gives two orders: from the smallest and from the largest.
_FACTORS = _random.integers(1, 1 << 32, BANDS // 2 * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
#: Added to every hash before (an offset of its own for each factor): no window of equal characters stays at zero.
_OFFSET = np.uint32(0x5BD1E995)


def _mix(h: np.ndarray) -> np.ndarray:
    """Mixes in place."""
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def band_hashes(lines: list[str]) -> np.ndarray:
    """``lines x BANDS`` signed 64-bit hashes, one per band of minima.  The first half
    of the bands holds the smallest products, the second half the largest: two minima of
    one order and its reverse never depend on the same shingle unless there is only one,
    so two lines that differ in one are not likelier to differ in the other."""
    half = BANDS // 2 * ROWS
    least = np.full((half, len(lines)), 0xFFFFFFFF, dtype=np.uint32)
    largest = np.zeros((half, len(lines)), dtype=np.uint32)
    rows, parts, size = [], [], 0

    def flush():
        if not parts:
            return
        lengths = np.array([len(p) for p in parts])
        h = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4") * np.uint32(0x9E3779B1)
        _mix(h)
        for i in (1, 2, 4):  # windows of two, four and eight characters
            turned = h[:-i] * np.uint32(0x27D4EB2F)
            turned += h[i:]
            h = _mix(turned)
        # drop the windows that reach over the end of a part
        inside, ends = np.ones(len(h), dtype=bool), np.cumsum(lengths)[:-1]
        for i in range(1, SHINGLE):
            inside[ends - i] = False
        h = h[inside]
        h += _OFFSET
        first = np.r_[0, np.cumsum(lengths - SHINGLE + 1)[:-1]]
        turned, low, high = np.empty_like(h), *np.empty((2, half, len(parts)), dtype=np.uint32)
        for k in range(half):
            np.multiply(h, _FACTORS[k], out=turned)
            np.minimum.reduceat(turned, first, out=low[k])
            np.maximum.reduceat(turned, first, out=high[k])
        # (a line has one part here: only full pieces, which end a turn, are followed by others)
        at = np.array(rows)
        least[:, at] = np.minimum(least[:, at], low)
        largest[:, at] = np.maximum(largest[:, at], high)
        rows.clear()
        parts.clear()

    for row, line in enumerate(lines):
        # a line shorter than a shingle is padded to one
        line = line if len(line) >= SHINGLE else line.ljust(SHINGLE, "\0")
        for at in range(0, len(line) - SHINGLE + 1, PIECE):
            rows.append(row)
            parts.append(line if len(line) < PIECE + SHINGLE else line[at:at + PIECE + SHINGLE - 1])
            size += len(parts[-1])
            if size >= PIECE:
                flush()
                size = 0
    flush()
    out = np.empty((BANDS, len(lines)), dtype=np.uint64)
    minima = np.concatenate((least, largest))
    for band in range(BANDS):
        mixed = np.full(len(lines), (band + 1) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
        for r in range(ROWS):
            mixed = (mixed ^ minima[band * ROWS + r]) * np.uint64(0xFF51AFD7ED558CCD)
            mixed ^= mixed >> np.uint64(32)
        out[band] = mixed
    return out.T.view(np.int64)


def shingles(line: str) -> frozenset[str]:
    return frozenset([line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))])


def _sorted_windows(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 8-character windows that start at ``at``, brought together when
    equal: their starts, and a number for each that grows with every new one."""
    h, exact = codes.astype(np.uint64), int(codes.max()) < 256
    if exact:
        # eight code points below 256 are one 64-bit number
        for i in (1, 2, 4):
            h = h[:-i] | (h[i:] << np.uint64(8 * i))
    else:
        h = np.zeros(len(codes) - SHINGLE + 1, dtype=np.uint64)
        for i in range(SHINGLE):
            h = h * np.uint64(0xD6E8FEB86659FD93) + codes[i:len(h) + i]
            h ^= h >> np.uint64(32)
    while True:
        own = h[at]
        order = np.argsort(own)
        starts, own = at[order], own[order]
        same = own[1:] == own[:-1]
        left, right = starts[:-1][same], starts[1:][same]
        if exact or all(np.array_equal(codes[left + i], codes[right + i]) for i in range(SHINGLE)):
            return starts, np.cumsum(np.r_[False, ~same])
        # two different windows share a hash: rank the windows themselves
        windows = np.lib.stride_tricks.sliding_window_view(codes, SHINGLE)
        h, exact = np.unique(windows, axis=0, return_inverse=True)[1].ravel(), True


def unit_links(lines: list[str], least: float = LEAST_SIMILARITY) -> list[tuple[int, int]]:
    """Links between the lines of a unit (by position): a spanning forest of
    "exact Jaccard of ``least`` or more"."""
    m = len(lines)
    if m < 2:
        return []
    parts = [line.ljust(SHINGLE, "\0") for line in lines]
    if m == 2 and max(map(len, parts)) <= SHORT:
        a, b = map(shingles, parts)
        shared = len(a & b)
        return [(1, 0)] if shared >= least * (len(a) + len(b) - shared) else []
    lengths = np.array([len(p) for p in parts])
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")
    owner = np.repeat(np.arange(m), lengths)
    at = np.arange(len(codes))
    starts, column = _sorted_windows(codes, at[at + SHINGLE <= np.cumsum(lengths)[owner]])
    owner = owner[starts]
    shared, sizes = np.zeros((m, m)), np.zeros(m)
    width = int(column[-1]) + 1
    for first in range(0, width, TILE):
        low, high = np.searchsorted(column, (first, first + TILE))
        tile = np.zeros((m, min(TILE, width - first)), dtype=np.float32)
        tile[owner[low:high], column[low:high] - first] = 1.0
        shared += tile @ tile.T
        sizes += tile.sum(axis=1)
    similar = shared >= least * (sizes[:, None] + sizes[None, :] - shared)
    root = np.arange(m)  # the smallest position each line is connected to
    while True:
        near = np.where(similar, root[None, :], m).min(axis=1)
        near = np.minimum(root, near)
        near = near[near]
        if np.array_equal(near, root):
            break
        root = near
    return [(i, int(r)) for i, r in enumerate(root) if r != i]


_ENDS = " \t\r\f\v"
_ODD = ("  ", "\t", "\r", "\f", "\v")


def normal_form(line: Column) -> Column:
    """Lower case, white space runs as one space and none at the ends (trimming,
    which lists all places of a line's characters, and the regular expression
    run only where there is something to replace)."""
    ends = reduce(Column.__or__, (f(line, F.lit(c)) for f in (F.startswith, F.endswith) for c in _ENDS))
    line = F.when(ends, F.btrim(line, F.lit(_ENDS))).otherwise(line)
    odd = reduce(Column.__or__, (F.contains(line, F.lit(c)) for c in _ODD))
    return F.lower(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line))


def pairs_linked(pairs: list[tuple[str, str]], least: float = LEAST_SIMILARITY) -> np.ndarray:
    """Whether each pair is linked, as by ``unit_links``.  Eight code points below 256
    are one number, so the windows of many pairs of short lines are sorted and
    counted together; other pairs are compared by themselves."""
    linked, coded = np.zeros(len(pairs), dtype=bool), []
    for at, (a, b) in enumerate(pairs):
        try:
            if max(len(a), len(b)) > SHORT:
                raise ValueError("long")
            coded.append((max(len(a), len(b), SHINGLE), at, a.encode("latin-1"), b.encode("latin-1")))
        except ValueError:  # (a code point above 255 is one, too)
            linked[at] = bool(unit_links([a, b], least))
    coded.sort(key=lambda c: c[0])  # lines of about one length lie together, as they are filled up to the longest
    start = 0
    while start < len(coded):
        stop = start + 1
        while stop < len(coded) and 2 * coded[stop][0] * (stop + 1 - start) <= PIECE:
            stop += 1
        block, start = coded[start:stop], stop
        width = block[-1][0]
        text = b"".join([line.ljust(width, b"\0") for c in block for line in c[2:]])
        windows = np.ndarray((2 * len(block), width - SHINGLE + 1), "<u8", text, strides=(width, 1)).copy()
        counts = np.array([max(len(line) - SHINGLE + 1, 1) for c in block for line in c[2:]])
        # places behind a line's end repeat its first window
        np.copyto(windows, windows[:, :1].copy(), where=np.arange(windows.shape[1]) >= counts[:, None])
        both = windows.reshape(len(block), -1)

        def different(rows: np.ndarray) -> np.ndarray:
            rows = np.sort(rows, axis=1)
            return 1 + np.count_nonzero(rows[:, 1:] != rows[:, :-1], axis=1)

        sizes = different(windows).reshape(-1, 2).sum(axis=1)
        union = different(both)
        linked[[c[1] for c in block]] = sizes - union >= least * union
    return linked


def _links_in_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit and line → links to the smallest line of each part
    of a unit; a unit may go on in the next batch."""
    open_unit, ids, lines = None, [], []

    def close():
        if len(lines) == 2:  # nearly all units: compared together
            pairs.append((*open_unit[1:], ids[1], ids[0]))
            met.append(tuple(lines))
        else:
            found.extend([(*open_unit[1:], ids[a], ids[b]) for a, b in unit_links(lines)])

    def links():
        rows = found + [p for p, link in zip(pairs, pairs_linked(met)) if link]
        columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["same", "n", "a", "b"])

    for batch in batches:
        found, pairs, met = [], [], []
        units = np.stack([batch[c].to_numpy() for c in ("unit", "same", "n")], axis=1)
        starts = np.flatnonzero(np.r_[True, (units[1:] != units[:-1]).any(axis=1)][:len(units)])
        own_ids, own_lines = batch["line_id"].to_pylist(), texts(batch, "line")
        for unit, start, stop in zip(units[starts].tolist(), starts, [*starts[1:], len(units)]):
            if unit != open_unit:
                close()
                open_unit, ids, lines = unit, [], []
            ids += own_ids[start:stop]
            lines += own_lines[start:stop]
        yield links()
    found, pairs, met = [], [], []
    close()
    yield links()


def _linked(members: DataFrame, wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """``(same, n, unit, line_id)`` → links ``(same, n, a, b)`` within each
    unit; ``wanted`` holds the ids of the members."""
    wanted = materialise(wanted.select("line_id").distinct(), "lines-wanted")
    if wanted.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    return members.join(lines.join(wanted, "line_id", "left_semi"), "line_id") \
        .select("unit", "same", "n", "line_id", "line") \
        .repartition("unit").sortWithinPartitions("unit", "same", "n", "line_id") \
        .mapInArrow(_links_in_units, "same long, n long, a long, b long")


def _met(held: DataFrame) -> DataFrame:
    """``(key, line_id, chars)`` → the members ``(same, n, chunks, pivot,
    line_id, chars)`` of every group of two or more lines with one key; with
    columns ``far`` and ``label``, of those with a far line and lines that are
    not yet linked.  Keys with the same lines count once."""
    own = Window.partitionBy("key")
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK_LINES), F.ceil(F.col("total") / CHUNK_CHARS))
    wanted = F.col("n") > 1
    if "far" in held.columns:
        wanted &= F.max("far").over(own) & (F.min("label").over(own) != F.max("label").over(own))
    return materialise(
        held.withColumn("n", F.count(F.lit(1)).over(own))
        .withColumn("same", F.bit_xor(F.xxhash64("line_id")).over(own))
        .withColumn("total", F.sum("chars").over(own))
        .withColumn("pivot", F.min("line_id").over(own))
        .withColumn("wanted", wanted).where("wanted")
        .select("same", "n", chunks.cast("int").alias("chunks"), "pivot", "line_id",
                "chars").distinct(), "lines-met")


def _repeated_bands(lines: DataFrame) -> DataFrame:
    """``(line_id, line, chars)``, the last a power of two → ``(key, line_id, chars)``
    of the bands that two lines or more hold.  Nearly all bands are held by one line, so a batch's
    bands travel as arrays, a row for each bucket of keys, and only those seen
    twice in their bucket become rows.  A bucket's keys are about ``BUCKET_KEYS``
    in number; the lines under one key pass by one batch after the other."""
    n_buckets = max(1, lines.count() * BANDS // BUCKET_KEYS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = band_hashes(texts(batch, "line")).ravel()
            sizes = np.log2(batch["chars"].to_numpy()).astype(np.int8)
            # (the upper half decides, so that the buckets stay even whatever their number)
            bucket = ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
            bucket = bucket.astype(np.min_scalar_type(n_buckets))  # (short numbers are sorted by radix)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[starts, len(bucket)].astype(np.int32)
            row = order // BANDS
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts].astype(np.int64)),
                 *(pa.ListArray.from_arrays(ends, column) for column in (
                     keys[order], batch["line_id"].to_numpy()[row], sizes[row]))],
                ["bucket", "keys", "line_ids", "sizes"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, once, waiting, n_waiting = None, Once(), [], 0

        def flush(last):
            nonlocal waiting, n_waiting
            if waiting:
                keys, ids, sizes = map(np.concatenate, zip(*waiting))
                if last and not len(once.keys):  # the whole bucket is here: nothing has to be kept for later
                    rows = may_repeat(keys)
                    keys, ids, sizes = keys[rows], ids[rows], sizes[rows]
                yield pa.RecordBatch.from_pandas(
                    once.repeated(keys, ids, np.left_shift(1, sizes, dtype=np.int64)), preserve_index=False)
            waiting, n_waiting = [], 0

        for batch in batches:
            buckets, ends = batch["bucket"].to_numpy(), batch["keys"].offsets.to_numpy()
            columns = [batch[c].values.to_numpy() for c in ("keys", "line_ids", "sizes")]
            row = 0
            while row < len(buckets):
                if buckets[row] != bucket:
                    yield from flush(True)
                    bucket, once = buckets[row], Once()
                elif n_waiting >= 2 * BUCKET_KEYS:
                    yield from flush(False)
                # the rows of this bucket, of about as many keys as fit (the three lists of a row are equally long)
                stop = np.searchsorted(buckets, bucket, "right")
                stop = min(stop, max(row + 1, np.searchsorted(ends, ends[row] + 2 * BUCKET_KEYS - n_waiting)))
                waiting.append([c[ends[row]:ends[stop]] for c in columns])
                n_waiting += len(waiting[-1][0])
                row = stop
        yield from flush(True)

    return lines.mapInArrow(deal, "bucket long, keys array<long>, line_ids array<long>, sizes array<byte>") \
        .repartition("bucket").sortWithinPartitions("bucket") \
        .mapInArrow(repeated, "key long, line_id long, chars long")


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return batch[column].to_numpy(zero_copy_only=False).tolist()


def may_repeat(keys: np.ndarray) -> np.ndarray:
    """The places of all keys that stand more than once, and of a few others."""
    ordered = np.sort(keys)
    bits = np.int64((1 << 20) - 1)
    marked = np.zeros(1 << 20, dtype=bool)
    marked[ordered[1:][ordered[1:] == ordered[:-1]] & bits] = True
    return np.flatnonzero(marked[keys & bits])


class Once:
    """The first row of every key so far, sorted by key; in ``told`` are those given out."""

    def __init__(self):
        self.keys, self.ids, self.chars = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.told = np.zeros(0, dtype=bool)

    def repeated(self, keys: np.ndarray, ids: np.ndarray, chars: np.ndarray) -> pd.DataFrame:
        """The rows among these and earlier ones that share their key with another
        row and were not given out yet."""
        order = np.argsort(keys)
        keys, ids, chars = keys[order], ids[order], chars[order]
        first = np.r_[True, keys[1:] != keys[:-1]][:len(keys)]
        group = np.cumsum(first) - 1
        own, several = keys[first], np.bincount(group) > 1
        place = np.searchsorted(self.keys, own)
        known = np.zeros(len(own), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == own[inside]
        # earlier rows whose key comes again for the first time
        met = place[known]
        met = met[~self.told[met]]
        self.told[met] = True
        given = (several | known)[group]
        out = pd.DataFrame({"key": np.r_[self.keys[met], keys[given]], "line_id": np.r_[self.ids[met], ids[given]],
                            "chars": np.r_[self.chars[met], chars[given]]})
        new = ~known
        at, rows = place[new], np.flatnonzero(first)[new]
        self.keys, self.ids, self.chars = (np.insert(a, at, b[rows]) for a, b in (
            (self.keys, keys), (self.ids, ids), (self.chars, chars)))
        self.told = np.insert(self.told, at, several[new])
        return out


def _mine() -> Column:
    return F.pmod(F.xxhash64("line_id"), F.col("chunks")).cast("int")


def _pivot_links(met: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links that every chunk together with its group's pivot gives, and
    the lines ``(same, n, chunks, pivot, line_id, chars, far)`` of the groups of
    several chunks; a line that no link leads to the pivot is far."""
    spread = F.when(F.col("line_id") == F.col("pivot"), F.sequence(F.lit(0), F.col("chunks") - 1)) \
        .otherwise(F.array(_mine()))
    placed = met.withColumn("chunk", F.explode(spread)) \
        .select("same", "n", F.xxhash64("same", "n", "chunk").alias("unit"), "line_id")
    links = materialise(_linked(placed, met, lines), "lines-linked")
    wide = materialise(
        met.where("chunks > 1").join(
            links.select("same", "n", F.col("a").alias("line_id"), F.col("b").alias("pivot"),
                         F.lit(True).alias("near")), ["same", "n", "line_id", "pivot"], "left")
        .select("same", "n", "chunks", "pivot", "line_id", "chars",
                (F.col("near").isNull() & (F.col("line_id") != F.col("pivot"))).alias("far")),
        "lines-wide")
    return links, wide


def _far_groups(wide: DataFrame) -> DataFrame:
    """``(same, n, rows, far_chunks)`` of the groups with far lines."""
    far_lines, far_chars = F.sum(F.col("far").cast("long")), F.sum(F.when(F.col("far"), F.col("chars")))
    return materialise(
        wide.groupBy("same", "n").agg(
            F.count(F.lit(1)).alias("rows"),
            F.greatest(F.ceil(far_lines / CHUNK_LINES), F.ceil(F.coalesce(far_chars, F.lit(0)) / CHUNK_CHARS))
            .cast("int").alias("far_chunks")).where("far_chunks > 0"), "lines-far")


def _crossed_links(wide: DataFrame, groups: DataFrame, lines: DataFrame) -> DataFrame:
    """The links between the far lines of a group and all its lines, chunk by chunk."""
    # chunks 0 to far_chunks - 1 hold the far lines, those behind them the near ones
    place = F.pmod(F.xxhash64(F.lit(2), "line_id"), F.col("far_chunks"))
    meets = F.when(F.col("far"), F.sequence(F.lit(0), F.col("far_chunks") + F.col("chunks") - 1)) \
        .otherwise(F.sequence(F.lit(0), F.col("far_chunks") - 1))
    meeting = materialise(join_counted(wide, groups, ["same", "n"], wide.count(), "rows"), "lines-meeting")
    crossed = meeting.withColumn("mine", F.when(F.col("far"), place).otherwise(F.col("far_chunks") + _mine())) \
        .withColumn("other", F.explode(meets)) \
        .select("same", "n", F.xxhash64(F.lit(1), "same", "n", F.least("mine", "other"),
                                        F.greatest("mine", "other")).alias("unit"), "line_id")
    return _linked(crossed, meeting, lines)


def shingle_hashes(line: str) -> np.ndarray:
    """64-bit hashes of the different shingles of a line."""
    h = np.frombuffer(line.ljust(SHINGLE, "\0").encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    for i in (1, 2, 4):  # windows of two, four and eight characters
        h = (h[:-i] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[i:] + np.uint64(0xD6E8FEB86659FD93))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def prefix(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of a line of which two lines at ``LEAST_SIMILARITY`` share
    one: the first ``size - ceil(least * size) + 1`` in the order of the counts."""
    size = len(hashes)
    # (similar lines share least * size at least; the margin is for rounding)
    keep = size - int(np.ceil(LEAST_SIMILARITY * size - 1e-6)) + 1
    order = np.lexsort((hashes, counts[hashes & np.uint64(len(counts) - 1)]))
    return hashes[order[:keep]]


def _rare_shingles(hard: DataFrame) -> DataFrame:
    """Lines ``(line_id, line, chars, far, label)`` → ``(key, line_id, chars, far,
    label)``, a row for each shingle in the line's prefix.  The order of all shingles is
    by the count of their bucket, then hash: ``BUCKETS`` counts are broadcast,
    whatever the number of lines."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for pdf in batches:
            for line in pdf["line"]:
                np.add.at(total, (shingle_hashes(line) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "times": total[used]})

    buckets = hard.select("line").mapInPandas(count, "bucket long, times long") \
        .groupBy("bucket").agg(F.sum("times").alias("times")).toPandas()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[buckets["bucket"].to_numpy()] = buckets["times"].to_numpy()
    shared = hard.sparkSession.sparkContext.broadcast(counts)

    def rarest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, keys, size = [], [], 0
            for row, line in enumerate(pdf["line"]):
                keys.append(prefix(shingle_hashes(line), shared.value))
                at.append(np.full(len(keys[-1]), row))
                size += len(keys[-1])
                if size >= PIECE or row == len(pdf) - 1:
                    rows = pdf[["line_id", "chars", "far", "label"]].iloc[np.concatenate(at)].reset_index(drop=True)
                    yield rows.assign(key=np.concatenate(keys).view(np.int64))
                    at, keys, size = [], [], 0

    return hard.mapInPandas(rarest, "line_id long, chars long, far boolean, label long, key long")


def line_links(lines: DataFrame) -> DataFrame:
    """Different lines ``(line_id, line)`` → links ``(a, b)``."""
    # (lengths rounded up to a power of two take next to no room in the shuffle)
    chars = F.pow(2, F.ceil(F.log2(F.length("line")))).cast("long").alias("chars")
    met = _met(_repeated_bands(lines.select("line_id", "line", chars)))
    links, wide = _pivot_links(met, lines)
    groups = _far_groups(wide)
    found = [links, _crossed_links(wide, groups.where(F.col("far_chunks") <= FAR_CHUNKS), lines)]
    crowded = groups.where(F.col("far_chunks") > FAR_CHUNKS)
    if not crowded.isEmpty():
        # a link of a far line is met again under a shingle of both prefixes;
        # lines with one label are linked to one line already
        label = F.when(F.col("far"), F.col("line_id")).otherwise(F.col("pivot"))
        hard = join_counted(wide, crowded.select("same", "n", "rows"), ["same", "n"], wide.count(), "rows") \
            .groupBy("line_id").agg(F.max("far").alias("far"), F.min(label).alias("label"))
        hard = materialise(lines.join(hard, "line_id").select("line_id", "line", chars, "far", "label"),
                           "lines-hard", compression="zstd")
        links, wide = _pivot_links(_met(_rare_shingles(hard)), hard.select("line_id", "line"))
        found += [links, _crossed_links(wide, _far_groups(wide), hard.select("line_id", "line"))]
    return reduce(DataFrame.unionByName, found).select("a", "b")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, row_key, line_no, raw, line)`` of every line with visible characters:
    as it stands and in its normal form."""
    # the key is computed before the lines part, so no line carries its whole text
    read = docs.select(F.col(id_col).alias("doc_id"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
                       F.split(F.col(text_col), "\n").alias("lines"))
    lines = read.select("doc_id", "row_key", F.posexplode("lines").alias("line_no", "raw"))
    # (asked of the raw line: a filter on the normal form would compute it twice)
    return lines.where(F.ltrim("raw", F.lit(_ENDS)) != "").withColumn("line", normal_form(F.col("raw")))


def _keys(line: str) -> list[Column]:
    """A line's 128-bit key."""
    return [F.xxhash64(line).alias("key1"), F.xxhash64(F.lit(1), line).alias("key2")]


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, row_key, removed)`` for the documents that lose lines:
    ``removed`` lists their positions (from 0) in ascending order."""
    # lines that differ in case or white space only share all bands and are linked like other
    # near-equal lines; so each different line is brought to its normal form once, and
    # the documents' lines are looked up as they stand
    lines = _lines(docs, id_col, text_col)
    different = materialise(
        lines.groupBy("raw").agg(
            F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("first_doc"),
            F.coalesce(F.min_by("row_key", "doc_id"),
                       F.min(F.when(F.col("doc_id").isNull(), F.col("row_key")))).alias("first_row"))
        .withColumn("line_id", F.monotonically_increasing_id())
        .select("line_id", normal_form(F.col("raw")).alias("line"), "times", "first_doc", "first_row",
                *_keys("raw")), "lines",
        compression="zstd")
    roots = components(line_links(different.select("line_id", "line")), "line-links")
    grouped = different.select("line_id", "key1", "key2", "times", "first_doc", "first_row") \
        .join(roots, F.col("line_id") == F.col("node"), "left") \
        .withColumn("group", F.coalesce("root", "line_id")) \
        .where("times > 1 OR root IS NOT NULL")
    grouped = materialise(grouped.select("group", "key1", "key2", "first_doc", "first_row"),
                          "lines-grouped")
    stays = materialise(grouped.groupBy("group").agg(
        F.min("first_doc").alias("keep_doc"),
        F.coalesce(F.min_by("first_row", "first_doc"), F.min("first_row")).alias("keep_row"),
        F.count(F.lit(1)).alias("n")), "lines-stay")
    decided = materialise(join_counted(grouped, stays, ["group"], grouped.count())
                          .select("key1", "key2", "group", "keep_doc", "keep_row"), "lines-decided")

    # a repeated document counts once
    seen = lines.select("doc_id", "row_key", "line_no", *_keys("raw")).join(decided, ["key1", "key2"])
    home = F.col("doc_id").eqNullSafe(F.col("keep_doc")) & (F.col("row_key") == F.col("keep_row"))
    first = F.min("line_no").over(Window.partitionBy("doc_id", "row_key", "group"))
    return seen.withColumn("stays", home & (F.col("line_no") == first)).where("NOT stays") \
        .groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without its removed lines."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
                       docs[id_col].alias("own_id"), docs[text_col].alias("own_text")) \
        .withColumn("own_key", F.xxhash64("own_id", "own_text"))
    removed = removed_lines(docs, id_col, text_col)
    joined = rows.join(removed, F.col("own_id").eqNullSafe(F.col("doc_id"))
                       & (F.col("own_key") == F.col("row_key")), "left")
    left = F.expr("""array_join(filter(split(own_text, '\\n'),
                     (line, at) -> NOT array_contains(removed, at)), '\\n')""")
    text = F.when(F.col("removed").isNull(), F.col("own_text")).otherwise(left)
    return joined.select(*(text.alias(c) if c == text_col else F.col("doc")[c].alias(c)
                           for c in docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` for every row of ``docs``."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("own_key"),
                       F.when(F.col("text").isNull(), 0).otherwise(F.octet_length("text") + 1 - F.octet_length(
                           F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
                       .cast("long").alias("n_lines"))
    removed = removed_lines(docs).withColumnRenamed("doc_id", "removed_from")
    joined = rows.join(removed, F.col("doc_id").eqNullSafe(F.col("removed_from"))
                       & (F.col("own_key") == F.col("row_key")), "left")
    return joined.select("doc_id", "n_lines",
                         F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                         F.coalesce(F.col("removed").cast("array<int>"),
                                    F.array().cast("array<int>")).alias("removed"))
