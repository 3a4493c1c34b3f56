r"""Quality rules: how much of a text repeats.

Words are runs of ``[^\x20\x09-\x0D]``; lines end at ``\n``.  A text's words
become integer ids, n-grams of several lengths get rolling hashes in numpy
(one multiply and add per length), equal hashes are found by sorting and
confirmed word by word, and the characters of all words inside a repeated
n-gram are counted once each.

Rules: a document fails the base rules with fewer than 50 words or when more
than half of its words lie in repeated three-word windows; it also fails when
a share of its word characters above the limit lies in repeated n-grams of a
length in ``CHAR_LIMITS`` (occurrences after the first), or when its repeated
lines hold more than ``LINE_CHAR_LIMIT`` of the characters.

Defined results: a null or empty text has no words, counts of zero and fails.
Ties and repeated rows are judged one by one, an empty table gives no rows,
and other columns are not read.  Memory is a few numbers per word of the
longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
#: n-gram length → largest share of word characters in its repeats (the
#: limits of the Gopher rules, Rae et al. 2021, table A1).
CHAR_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
LINE_CHAR_LIMIT = 0.20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# The characters counted as symbols
SYMBOLS = b"#*$%&|<>"
_NO_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def characters(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def word_characters(data: bytes) -> np.ndarray:
    """Code points of each word of a text, in order."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.r_[False, ~_SPACE[raw], False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    before = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return before[edges[1::2]] - before[edges[::2]]


def _equal_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each position whose key came before, with the nearest one before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    return order[:-1][same], order[1:][same]


def _repeated(ids: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``n`` ids found more than once, and of those
    the ones that are not the first of their kind."""
    before, later = _equal_pairs(hashes)
    if any(not np.array_equal(ids[before + i], ids[later + i]) for i in range(n)):
        # two different windows share a hash: rank the windows themselves
        windows = np.lib.stride_tricks.sliding_window_view(ids, n)
        before, later = _equal_pairs(np.unique(windows, axis=0, return_inverse=True)[1].ravel())
    return np.union1d(before, later), later


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Mask of the words inside any window of ``n`` words from ``starts``."""
    edge = np.zeros(words + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measures(text: str | None) -> dict:
    """All counts and shares of one text."""
    data = (text or "").encode()
    words = data.split()
    lengths = word_characters(data) if words else np.zeros(0, dtype=np.int64)
    chars = int(lengths.sum())
    out = {"n_words": len(words), "word_chars": chars,
           "n_symbols": len(data.translate(None, _NO_SYMBOLS)), "n_repeat_words": 0}

    lines = [line for line in data.split(b"\n") if line.split()]
    seen: set[bytes] = set()
    repeated_chars, repeats = 0, 0
    for line in lines:
        if line in seen:
            repeats += 1
            repeated_chars += sum(map(characters, line.split()))
        else:
            seen.add(line)
    out["n_dup_lines"] = repeats
    out["dup_line_share"] = repeats / len(lines) if lines else 0.0
    out["dup_line_char_share"] = repeated_chars / chars if chars else 0.0

    shares = dict.fromkeys(CHAR_LIMITS, 0.0)
    vocabulary: dict[bytes, int] = {}
    ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], dtype=np.int64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    mixed ^= mixed >> np.uint64(31)
    rolling = mixed
    for n in range(2, max(CHAR_LIMITS) + 1):
        if len(ids) < n:
            break
        rolling = rolling[:len(ids) - n + 1] * _STEP + mixed[n - 1:]
        if n != 3 and n not in CHAR_LIMITS:
            continue
        every, later = _repeated(ids, rolling, n)
        if not len(every):
            break  # a longer n-gram cannot repeat either
        if n == 3:
            out["n_repeat_words"] = int(_covered(every, n, len(ids)).sum())
        if n in CHAR_LIMITS:
            shares[n] = float(lengths[_covered(later, n, len(ids))].sum() / chars)
    for n, share in shares.items():
        out[f"dup_{n}gram_char_share"] = share
    out["base_failed"] = (out["n_words"] < LEAST_WORDS
                          or 100 * out["n_repeat_words"] > MOST_REPEAT_PERCENT * out["n_words"])
    out["kept"] = not (out["base_failed"]
                       or any(shares[n] > most for n, most in CHAR_LIMITS.items())
                       or out["dup_line_char_share"] > LINE_CHAR_LIMIT)
    return out


COLUMNS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
           "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
           "dup_line_share": "double", "dup_line_char_share": "double",
           **{f"dup_{n}gram_char_share": "double" for n in CHAR_LIMITS}}


def measure_column(text):
    """Column ``struct`` of ``COLUMNS`` for a text column."""
    @F.pandas_udf(", ".join(f"{c} {t}" for c, t in COLUMNS.items()))
    def repetition(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([measures(t) for t in batch], columns=list(COLUMNS))
    return repetition.asNondeterministic()(text)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and all measures and verdicts for every row of ``docs``."""
    return docs.select(docs[id_col].alias("doc_id"), measure_column(docs[text_col]).alias("m")) \
        .select("doc_id", "m.*")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are."""
    doc = F.struct(*(docs[c] for c in docs.columns)).alias("doc")
    return docs.select(doc, measure_column(docs[text_col]).alias("m")).where("m.kept").select("doc.*")
