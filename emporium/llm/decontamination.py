r"""Benchmark decontamination: passages of documents that repeat a benchmark item.

Words are runs of letters and digits (``[0-9a-z]`` and everything beyond
ASCII) of the lower-cased (A-Z) text; shingles are five words, or all the
words of a shorter item.

1. Item-sized windows: for an item of L words, every L words in a row of a
   document; a document of fewer words is one window, compared if it has
   enough shingles to reach ``least``.  A window without a single shingle of any item has similarity
   zero and is passed over; all others are fingerprinted with a 64-bit
   SimHash of their shingles, repeats included.
2. Multi-index Hamming blocks: fingerprints are cut into seven blocks.  Two
   fingerprints at 20 bits or fewer differ in at most two bits in some block,
   so looking each block up among the item blocks and their variants of up to
   two flipped bits finds every item within the radius.  At similarity 0.8
   the expected distance is 9.7 bits with a deviation of 2.9.
3. Exact check: candidates are kept if the weighted Jaccard similarity (by
   shingle counts) of window and item is ``least`` (0.8) or more.

The items are broadcast in chunks of at most about ``CHUNK_BYTES``; a larger
benchmark takes more passes over the documents, not more memory.

Defined results: null and empty texts match nothing and hold no item; items
with the same words are each reported; repeated rows are answered one by one;
an empty benchmark or document table gives no matches.  Very long texts are
windows like any other.  Only id and text are read for ``matches``;
``keep_clean`` returns all columns of the documents as they are.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.session import materialise

SHINGLE = 5
LEAST_SIMILARITY = 0.8
RADIUS = 20
#: Seven blocks: with three or more bits in each, two fingerprints differ in 21.
BLOCKS = tuple(np.array_split(np.arange(64), 7))
VARIANT_BITS = RADIUS // len(BLOCKS)
#: Bytes of items held by a task at a time.
CHUNK_BYTES = 4 << 20

# Bytes that belong to words stay, A-Z become a-z, all else is a space.
_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
               for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


def _gram_hash(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n word ids in a row; -1 marks a word of no item."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(max(0, len(ids) - n + 1), dtype=np.uint64)
    for i in range(n):
        out = (out * np.uint64(0xD6E8FEB86659FD93)) + mixed[i:len(mixed) - n + 1 + i]
    return out


def _simhash(bits: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of ``count`` shingles from each start; ``bits`` is shingles x 64."""
    before = np.zeros((len(bits) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=before[1:])
    ones = before[starts + count] - before[starts]
    return np.packbits(ones * 2 > count, axis=1, bitorder="little").view("<u8").ravel()


def _shingle_bits(words: list[bytes], n: int) -> np.ndarray:
    digests = np.array([xxhash.xxh64_intdigest(b" ".join(g), 42)
                        for g in zip(*(words[i:] for i in range(n)))], dtype="<u8")
    return np.unpackbits(digests.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _block_values(fps: np.ndarray, block: np.ndarray) -> np.ndarray:
    return (fps >> np.uint64(block[0])) & np.uint64((1 << len(block)) - 1)


class HammingIndex:
    """All items within ``RADIUS`` bits of a fingerprint, by seven block tables."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.tables = []
        for block in BLOCKS:
            flips = [0] + [sum(1 << b for b in bits) for k in range(1, VARIANT_BITS + 1)
                           for bits in combinations(range(len(block)), k)]
            values = _block_values(fps, block)[:, None] ^ np.array(flips, dtype=np.uint64)
            items = np.repeat(np.arange(len(fps)), len(flips))
            order = np.argsort(values.ravel(), kind="stable")
            self.tables.append((values.ravel()[order], items[order]))

    def within(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, item, distance)`` of all pairs at ``RADIUS`` bits or fewer."""
        found = []
        for block, (values, items) in zip(BLOCKS, self.tables):
            own = _block_values(fps, block)
            low = np.searchsorted(values, own, "left")
            n = np.searchsorted(values, own, "right") - low
            query = np.repeat(np.arange(len(fps)), n)
            at = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            found.append(query * len(self.fps) + items[at])
        pairs = np.unique(np.concatenate(found))
        query, item = np.divmod(pairs, max(1, len(self.fps)))
        distance = np.bitwise_count(fps[query] ^ self.fps[item]).astype(np.int64)
        near = distance <= RADIUS
        return query[near], item[near], distance[near]


def weighted_jaccard(a: Counter, b: Counter) -> float:
    shared = sum(min(n, b[g]) for g, n in a.items())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def _shingles(words: list[bytes], n: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(n))))


class ItemSet:
    """The items of one chunk, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[object, str]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words, self.counts, fps = [], [], [], []
        grams: dict[int, list[np.ndarray]] = defaultdict(list)
        owner: dict[int, list[np.ndarray]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            n = min(SHINGLE, len(words))
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            hashes = np.unique(_gram_hash(ids, n))
            grams[n].append(hashes)
            owner[n].append(np.full(len(hashes), len(words)))
            self.ids.append(item_id)
            self.words.append(words)
            self.counts.append(_shingles(words, n))
            fps.append(_simhash(_shingle_bits(words, n), np.array([0]), len(words) - n + 1)[0])
        # shingle hash → item lengths, by shingle length
        self.grams = {}
        for n in grams:
            pairs = np.unique(np.stack([np.concatenate(grams[n]),
                                        np.concatenate(owner[n]).astype(np.uint64)]), axis=1)
            self.grams[n] = pairs[0], pairs[1].astype(np.int64)
        lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        fps = np.array(fps, dtype="<u8")
        self.by_length = {int(size): (np.flatnonzero(lengths == size),
                                      HammingIndex(fps[lengths == size]))
                          for size in np.unique(lengths)}

    def search(self, text: str | None, least: float) -> list[tuple]:
        """``(item_id, start_word, n_words, distance, similarity)``: the best
        window of each item found in the text."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        best: dict[int, tuple] = {}
        for n, (hashes, lengths) in self.grams.items():
            if len(ids) < n:
                continue
            known = np.r_[0, np.cumsum(ids >= 0)]
            whole = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(whole):
                continue
            own = _gram_hash(ids, n)[whole]
            low = np.searchsorted(hashes, own, "left")
            many = np.searchsorted(hashes, own, "right") - low
            hit = many > 0
            if not hit.any():
                continue
            at = np.repeat(whole[hit], many[hit])
            pick = np.arange(len(at)) - np.repeat(np.cumsum(many[hit]) - many[hit], many[hit]) \
                + np.repeat(low[hit], many[hit])
            sizes = lengths[pick]
            for size in np.unique(sizes):
                self._windows(words, n, int(size), at[sizes == size], least, best)
        return [(self.ids[i], *m) for i, m in sorted(best.items())]

    def _windows(self, words, n, size, hits, least, best) -> None:
        """Fingerprint the windows of ``size`` words that hold a hit, look
        them up, and check the candidates exactly."""
        long = min(size, len(words))  # a document shorter than the item is one window
        last = len(words) - long
        if (long - n + 1) / (size - n + 1) < least:
            return
        edge = np.zeros(last + 2, dtype=np.int64)  # starts of windows that cover a hit
        low = np.clip(hits - (long - n), 0, last + 1)
        np.add.at(edge, low, 1)
        np.add.at(edge, np.clip(hits + 1, 0, last + 1), -1)
        starts = np.flatnonzero(np.cumsum(edge)[:last + 1] > 0)
        if not len(starts):
            return
        items, index = self.by_length[size]
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > long) + 1):
            for block in np.array_split(run, -(-len(run) // 4096)):
                first = int(block[0])
                part = words[first:int(block[-1]) + long]
                fps = _simhash(_shingle_bits(part, n), block - first, long - n + 1)
                query, item, distance = index.within(fps)
                for q, i, d in zip(query.tolist(), items[item].tolist(), distance.tolist()):
                    if i in best and best[i][3] == 1.0:
                        continue
                    start = int(block[q])
                    sim = weighted_jaccard(_shingles(words[start:start + long], n), self.counts[i])
                    if sim >= least and (i not in best or sim > best[i][3]):
                        best[i] = (start, long, d, sim)


def item_chunks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark in chunks of about ``chunk_bytes``, each read by itself."""
    items = items.where(F.col(text_col).isNotNull())
    total = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    chunk = F.pmod(F.xxhash64(id_col, text_col), F.lit(chunks))
    for c in range(chunks):
        yield [tuple(r) for r in items.where(chunk == c).select(id_col, text_col)
               .orderBy(id_col, text_col).collect()]


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            least: float = LEAST_SIMILARITY, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, distance, similarity)``: one row
    per document and item found in it, with its most similar window (words
    from 0; of equal windows the first)."""
    fields = "start_word long, n_words long, distance int, similarity double"
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, " \
             f"item_id {items.schema['item_id'].dataType.simpleString()}, {fields}"
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def found_in(chunk) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(chunk)

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            item_set = ItemSet(shared.value)
            for pdf in batches:
                rows = [(doc, *m) for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"])
                        for m in item_set.search(text, least)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start_word", "n_words",
                                                  "distance", "similarity"])
        return read.mapInPandas(search, schema)

    return reduce(DataFrame.unionByName,
                  map(found_in, item_chunks(items, chunk_bytes=chunk_bytes)))


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text",
               least: float = LEAST_SIMILARITY, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found.  What a chunk of the
    benchmark leaves is written before the next one is read, so a task holds
    one chunk's index whatever the benchmark's size."""
    for n, chunk in enumerate(item_chunks(items, chunk_bytes=chunk_bytes)):
        if n:
            docs = materialise(docs, "clean-so-far")
        docs = _without(docs, chunk, text_col, least)
    return docs


def _without(docs: DataFrame, chunk: list[tuple], text_col: str, least: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(chunk)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        item_set = ItemSet(shared.value)
        for batch in batches:
            yield pd.Series([not item_set.search(t, least) for t in batch], dtype=bool)

    doc = F.struct(*(docs[c] for c in docs.columns)).alias("doc")
    marked = docs.select(doc, clean.asNondeterministic()(docs[text_col]).alias("clean"))
    return marked.where("clean").select("doc.*")
