"""Token-id files in Simple-8b word-aligned coding.

Documents are encoded with a public tokenizer, an end id is appended to each,
and the ids are written in ascending document order to files on the shared
folder, one per range of documents.

File format (little-endian):

* magic ``S8BTOK01``
* blocks of up to ``BLOCK`` ids: a header of four 32-bit numbers (ids, words,
  escapes, 0), the 64-bit words, the 64-bit escapes.  A word's top four bits
  select how many ids of how many bits it packs (``SELECTORS``); selector 0
  packs one id as the place of an escape, for ids beyond 60 bits.
* footer: byte offset of each block and of the footer, first id of each block
  and the number of ids, end of each document in ids, document ids, a byte
  per document that is 1 for a null id
* trailer: numbers of ids, blocks and documents, offset of the footer, magic

Any block can be read alone by its offset, and decodes without a loop over
its words.

Writing: a task names its file by a fresh number and reports it; the list of
files is a table that Spark commits, so files of failed or repeated attempts
are never read.

Defined results: a null or empty text has only the end id; documents with
equal ids follow each other in an order fixed by their texts; null document
ids come first; an empty table gives no rows.  Document ids are integers.
Very long texts span blocks.  Other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel

from emporium.session import materialise, scratch_path

MAGIC = b"S8BTOK01"
BLOCK = 1 << 16
END_ID = 0
# Ids and bits per word of each selector; 0 is an escape
SELECTORS = ((1, 60), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
             (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
#: Encoded words kept by a Python worker.
CACHE_WORDS = 800_000
#: Longer pieces (text without spaces, encoded data) are not kept: a bound on the cache's bytes.
LONGEST_KEPT = 48


# ---------------------------------------------------------------- coding
def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, from the exponent of its double (0 has 0; rounding can
    make an id of 53 bits or more one bit longer, never shorter)."""
    exponent = (ids.astype(np.float64).view(np.uint64) >> np.uint64(52)).astype(np.int64) - 1022
    return np.maximum(exponent, 0).astype(np.uint8)


def encode_block(ids: np.ndarray) -> bytes:
    """One block of ids (uint64)."""
    n = len(ids)
    width = _bit_lengths(ids)
    escaped = width > 60
    escapes = ids[escaped]
    if len(escapes):
        ids = ids.copy()
        ids[escaped] = np.arange(len(escapes), dtype=np.uint64)
    selector = np.full(n, len(SELECTORS) - 1, dtype=np.uint8)
    step = np.ones(n, dtype=np.uint8)
    # from few wide ids to many narrow ones; when a packing fits nowhere, no
    # denser one does
    widest, held = width, 1  # the longest of the `held` ids from each place
    for s in range(len(SELECTORS) - 2, 0, -1):
        count, bits = SELECTORS[s]
        if n < count:
            break
        while held < count:
            widest = np.maximum(widest[:-1], width[held:])
            held += 1
        fits = widest <= bits
        if not fits.any():
            break
        np.putmask(selector[:len(fits)], fits, s)
        np.putmask(step[:len(fits)], fits, count)
    selector[escaped], step[escaped] = 0, 1
    steps, starts, at = step.tobytes(), [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = selector[starts].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        own = np.flatnonzero(chosen == s)
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        packed = ids[starts[own][:, None] + np.arange(count)] << shifts
        words[own] |= np.bitwise_or.reduce(packed, axis=1)
    head = np.array([n, len(words), len(escapes), 0], dtype="<u4")
    return head.tobytes() + words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()


def decode_block(data: bytes) -> np.ndarray:
    """The ids (uint64) of one block."""
    n, n_words, n_escapes, _ = np.frombuffer(data, dtype="<u4", count=4).tolist()
    words = np.frombuffer(data, dtype="<u8", count=n_words, offset=16)
    escapes = np.frombuffer(data, dtype="<u8", count=n_escapes, offset=16 + 8 * n_words)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS])[selector]
    places = np.cumsum(counts) - counts
    ids = np.empty(n, dtype=np.uint64)
    for s in np.unique(selector):
        count, bits = SELECTORS[s]
        own = np.flatnonzero(selector == s)
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        values = (words[own][:, None] >> shifts) & np.uint64((1 << bits) - 1)
        if s == 0:
            values = escapes[values.astype(np.int64)]
        ids[places[own][:, None] + np.arange(count)] = values
    return ids


class Writer:
    """Writes one file, a block at a time."""

    def __init__(self, sink):
        self.sink = sink
        self.sink.write(MAGIC)
        self.place, self.total, self.pending, self.n_pending = len(MAGIC), 0, [], 0
        self.offsets, self.firsts, self.ends, self.doc_ids, self.nulls = [], [], [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.n_pending += len(ids)
        self.ends.append(self.total + self.n_pending)
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        if self.n_pending >= BLOCK:
            joined = np.concatenate(self.pending)
            whole = len(joined) - len(joined) % BLOCK
            for at in range(0, whole, BLOCK):
                self._block(joined[at:at + BLOCK])
            self.pending, self.n_pending = [joined[whole:]], len(joined) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = encode_block(ids.astype(np.uint64))
        self.offsets.append(self.place)
        self.firsts.append(self.total)
        self.sink.write(data)
        self.place += len(data)
        self.total += len(ids)

    def close(self) -> None:
        if self.n_pending:
            self._block(np.concatenate(self.pending))
        self.sink.write(b"".join([
            np.array([*self.offsets, self.place], dtype="<u8").tobytes(),
            np.array([*self.firsts, self.total], dtype="<u8").tobytes(),
            np.array(self.ends, dtype="<u8").tobytes(),
            np.array(self.doc_ids, dtype="<i8").tobytes(),
            np.array(self.nulls, dtype="u1").tobytes(),
            np.array([self.total, len(self.offsets), len(self.ends), self.place],
                     dtype="<u8").tobytes(),
            MAGIC]))


class Reader:
    """Reads the index of a file, and any of its blocks."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 40)
        tail = source.read(40)
        source.seek(0)
        if tail[32:] != MAGIC or source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        self.n_ids, n_blocks, n_docs, footer = np.frombuffer(tail[:32], dtype="<u8").tolist()
        source.seek(footer)
        index = source.read(size - 40 - footer)
        place = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            out = np.frombuffer(index, dtype=kind, count=n, offset=place)
            place += out.nbytes
            return out
        self.offsets = take("<u8", n_blocks + 1).astype(np.int64)
        self.firsts = take("<u8", n_blocks + 1).astype(np.int64)
        self.ends = take("<u8", n_docs).astype(np.int64)
        self.doc_ids = take("<i8", n_docs)
        self.nulls = take("u1", n_docs)

    def block(self, k: int) -> np.ndarray:
        self.source.seek(int(self.offsets[k]))
        return decode_block(self.source.read(int(self.offsets[k + 1] - self.offsets[k])))

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document, from the blocks that hold it."""
        start, end = (int(self.ends[k - 1]) if k else 0), int(self.ends[k])
        first = int(np.searchsorted(self.firsts, start, "right")) - 1
        last = int(np.searchsorted(self.firsts, end - 1, "right"))
        ids = np.concatenate([self.block(b) for b in range(first, last)])
        return ids[start - int(self.firsts[first]):end - int(self.firsts[first])]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """``(doc_id, start, n_tokens, crc32 of the ids as 32-bit numbers)`` in
        order, a block in memory at a time."""
        k, crc, at = 0, 0, 0
        starts = np.r_[0, self.ends[:-1]] if len(self.ends) else self.ends
        for b in range(len(self.offsets) - 1):
            ids = self.block(b).astype("<u4")
            first, last = int(self.firsts[b]), int(self.firsts[b + 1])
            while at < last:
                end = min(last, int(self.ends[k]))
                crc = zlib.crc32(ids[at - first:end - first].tobytes(), crc)
                at = end
                if at == self.ends[k]:
                    yield (None if self.nulls[k] else int(self.doc_ids[k]), int(starts[k]),
                           int(self.ends[k] - starts[k]), crc)
                    k, crc = k + 1, 0


# ---------------------------------------------------------------- tokenizer
# Letters of ASCII and Latin-1, the same in every version of Unicode
_LATIN = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"


# Marks that take no part in another pre-token (an apostrophe begins some: 's, 'll)
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_symbols() -> dict[int, str]:
    """The characters by which a byte-level vocabulary writes the UTF-8 bytes
    of the space and of the Latin-1 letters (``str.translate``)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    symbol = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(symbol[b] for b in chr(c).encode()) for c in (0x20, *range(0x80, 0x100))}


_SYMBOLS = _byte_symbols()


def _is_plain(tokenizer: Tokenizer) -> bool:
    """Whether a text is cut by the byte-level expression and nothing else
    before the BPE model."""
    cut = tokenizer.pre_tokenizer
    return tokenizer.normalizer is None and isinstance(tokenizer.model, BPE) \
        and isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space


def _packed(ids: list[int]) -> bytes:
    return struct.pack("<%dI" % len(ids), *ids)


class CachedTokenizer:
    """Encodes texts word by word with a byte-level BPE tokenizer.

    A byte-level pre-token never reaches from a non-space across a following
    space, so a text may be cut before every space that follows a non-space,
    and equal pieces have equal ids.  An added token (``<|endoftext|>``) has its
    own id wherever it stands; a text that holds one is encoded unsplit.

    A piece not seen before is cut further where pre-tokens are sure to end: at
    a line end between non-spaces and before marks behind a letter.  A part of
    nothing but Latin letters is one pre-token, which goes to the library's
    model without the steps that would find that out; all else is encoded whole.
    """

    # White space that, before a space, forbids the cut there
    _GAPS = tuple(c + " " for c in " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0    "
                  "            　")

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        plain, model = _is_plain(self.tokenizer), self.tokenizer.model
        encode = self._encode
        latin = re.compile(f"[{_LATIN}]+").fullmatch

        class Parts(dict):  # part, behind a space or not → its ids as bytes
            def __init__(self, before: str):
                self.before, self.symbol = before, before and _SYMBOLS[ord(before)]

            def __missing__(self, part):
                if len(part) > LONGEST_KEPT:
                    return encode(self.before + part)
                if len(bare) + len(pieces) >= CACHE_WORDS:
                    bare.clear()
                    pieces.clear()
                if plain and part.isalpha() and (part.isascii() or latin(part)):
                    # one pre-token; ASCII letters are their own symbols
                    symbols = part if part.isascii() else part.translate(_SYMBOLS)
                    ids = _packed([t.id for t in model.tokenize(self.symbol + symbols)])
                else:
                    word = part.rstrip(_MARKS)
                    line, end, rest = part.partition("\n")
                    # marks behind a letter are a pre-token of their own
                    if word != part and word[-1:].isalpha():
                        ids = self[word] + bare[part[len(word):]]
                    elif line and rest and " " not in part \
                            and not line[-1].isspace() and not rest[0].isspace():
                        # (two words about a line end rarely meet again)
                        return self[line] + bare[end] + bare[rest]
                    else:
                        ids = encode(self.before + part)
                self[part] = ids
                return ids
        self.bare, self.pieces = bare, pieces = Parts(""), Parts(" ")

    def _encode(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a text and the end id."""
        text = text or ""
        end = np.array([END_ID], dtype="<u4").tobytes()
        if any(token in text for token in self.added):
            return np.frombuffer(self._encode(text) + end, dtype="<u4")
        if any(gap in text for gap in self._GAPS):
            return np.frombuffer(self._spaced(text) + end, dtype="<u4")
        first, *rest = text.split(" ")
        body = b"".join(map(self.pieces.__getitem__, rest))
        return np.frombuffer((self.bare[first] if first else b"") + body + end, dtype="<u4")

    def _spaced(self, text: str) -> bytes:
        """A text with runs of white space: cut only before spaces behind a non-space."""
        out, whole = [], []
        for k, piece in enumerate(text.split(" ")):
            joins = k and (not whole[-1] or whole[-1][-1].isspace())
            if k == 0 or joins:
                whole.append(" " * bool(k) + piece)
                continue
            out.append("".join(whole))
            whole = [" " + piece]
        out.append("".join(whole))
        return b"".join(self.pieces[p[1:]] if p[:1] == " " else self._encode(p) for p in out)


_WORKER_TOKENIZER: list[tuple[str, CachedTokenizer]] = []


def worker_tokenizer(definition: str) -> CachedTokenizer:
    """The tokenizer of this Python worker: its cache serves all tasks the worker runs."""
    if not _WORKER_TOKENIZER or _WORKER_TOKENIZER[0][0] != definition:
        _WORKER_TOKENIZER[:] = [(definition, CachedTokenizer(definition))]
    return _WORKER_TOKENIZER[0][1]


def default_tokenizer() -> str:
    """Path of the 50k byte-level BPE vocabulary of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- Spark
def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it, of a path with a scheme."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of Spark's default file system if it has none,
    so that all executors and Spark itself mean the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write(docs: DataFrame, folder: str, tokenizer_path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs`` into files under ``folder`` (shared by the cluster);
    returns the committed list ``(part, file, n_docs, n_ids)``, a row a file."""
    folder = _qualified(docs.sparkSession, folder)
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        tokenizer = worker_tokenizer(definition.value)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.s8b"
        writer = sink = None
        for pdf in batches:
            for doc_id, null, text in zip(pdf["doc_id"], pdf["no_id"], pdf["text"]):
                if writer is None:
                    sink = store.open_output_stream(f"{root}/{name}")
                    writer = Writer(sink)
                writer.add(None if null else int(doc_id), tokenizer.ids(text))
        if writer is None:
            return
        writer.close()
        sink.close()
        yield pd.DataFrame({"part": [part], "file": [name], "n_docs": [len(writer.ends)],
                            "n_ids": [writer.total]})

    ordered = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")) \
        .withColumn("tie", F.xxhash64("text")) \
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie") \
        .select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
                "text")
    return materialise(ordered.mapInPandas(encode, "part int, file string, n_docs long, n_ids long"),
                       "token-files")


def read(files: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files,
    one task a file; ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    n_files = files.count()
    folder = _qualified(files.sparkSession, folder)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for pdf in batches:
            for name, base in zip(pdf["file"], pdf["base"]):
                with store.open_input_file(f"{root}/{name}") as source:
                    out = pd.DataFrame(Reader(source).documents(),
                                       columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                out["start"] += base
                yield out

    return placed.repartition(max(1, n_files)) \
        .mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write ``docs`` to token files and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer_path), folder)
