"""Language identification: multinomial naive Bayes over hashed character n-grams.

``train`` counts hashed character 1- to 3-grams per language on labelled rows
and returns a small model: a matrix of log-probabilities, one row per
language.  ``predict`` broadcasts it and scores whole texts, batch by batch,
as a sparse row-by-matrix product in numpy.

Training sample: of each language's labelled rows, each row is taken with the
probability that makes ``rows_per_language`` (default 2,000) the expected
number, by a seeded hash of its id; a language with fewer rows is taken
whole.  The model's size is languages x 32,768 numbers.

Defined results: a null text, or one without any letter, is ``und`` with
score 0.  Ties go to the first language in code point order.  Without any
labelled text every row is ``und``.  Rows with a null id or a null language
do not train; ids and languages are never read by a prediction.  Repeated
rows are answered one by one, very long texts are scored in pieces, and
other columns are left as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
#: Expected training rows per language; the bound of the training sample.
ROWS_PER_LANGUAGE = 2_000
#: Code points scored at a time.
PIECE = 1 << 18
SMOOTHING = 0.5

# a letter, or one of the other numerics (fractions, superscripts, Roman numerals)
_WORD_CHARACTER = re.compile(r"[^\W\d_]")
# ASCII characters that are not letters count as one separator
_ASCII = np.array([c if chr(c).isalpha() else 32 for c in range(128)], dtype=np.uint32)
_MULTIPLIER = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str) -> bool:
    """Whether a character of a text is of a Unicode letter category."""
    return any(m.group().isalpha() for m in _WORD_CHARACTER.finditer(text))


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    return np.where(codes < 128, _ASCII[np.minimum(codes, 127)], codes)


def _grams(codes: np.ndarray) -> list[np.ndarray]:
    """Hash buckets of the 1-, 2- and 3-grams that end at each code point;
    the k-gram array is k - 1 shorter."""
    a, b, c = (codes * m for m in _MULTIPLIER)
    out = [a, a[1:] ^ (b[:-1] + np.uint32(0x27D4EB2F)),
           a[2:] ^ (b[1:-1] + np.uint32(0x27D4EB2F)) ^ (c[:-2] + np.uint32(0x165667B1))]
    return [((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS)
            for h in out]


def _pieces(texts: Iterator[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, codes)`` pieces; pieces of one text overlap by two code points
    at their start, which belong to the piece before."""
    for row, text in enumerate(texts):
        if text is None or not has_letter(text):
            continue
        for at in range(0, len(text), PIECE):
            yield row, _codes(text[max(0, at - 2):at + PIECE])


def _blocks(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of many texts joined into blocks: ``(row of each code point, codes)``."""
    rows, parts, size = [], [], 0
    for row, codes in _pieces(texts):
        rows.append(row)
        parts.append(codes)
        size += len(codes)
        if size >= PIECE:
            yield np.repeat(rows, [len(p) for p in parts]), np.concatenate(parts)
            rows, parts, size = [], [], 0
    if parts:
        yield np.repeat(rows, [len(p) for p in parts]), np.concatenate(parts)


def _features(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, buckets)``: the n-grams of a block of texts, none across two texts."""
    for rows, codes in _blocks(texts):
        for k, buckets in enumerate(_grams(codes)):
            own = rows[k:]
            inside = own == rows[:len(own)]
            yield own[inside], buckets[inside]


class Model:
    """Languages and their log-probabilities of the hashed n-grams."""

    def __init__(self, languages: list[str], log_probability: np.ndarray):
        self.languages = languages
        self.log_probability = log_probability  # buckets x languages

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted language and its posterior probability for each text."""
        names = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        if not self.languages:
            return names, scores
        total = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts), dtype=bool)
        for rows, buckets in _features(texts):
            if not len(rows):
                continue
            starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            at = rows[starts]
            for lang in range(len(self.languages)):
                total[at, lang] += np.add.reduceat(self.log_probability[lang][buckets], starts)
            seen[at] = True
        best = total.argmax(axis=1)
        odds = np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i in np.flatnonzero(seen):
            names[i], scores[i] = self.languages[best[i]], 1.0 / odds[i]
        return names, scores


def training_sample(labelled: DataFrame, id_col: str = "doc_id", lang_col: str = "lang",
                    rows_per_language: int = ROWS_PER_LANGUAGE, seed: int = 42) -> DataFrame:
    """The rows of ``labelled`` that train the model (see the module text)."""
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = labelled.groupBy(lang_col).count().collect()  # one row per language
    if not sizes:
        return labelled
    share = F.create_map(*(F.lit(x) for r in sizes
                           for x in (r[0], min(1.0, rows_per_language / r["count"]))))
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(u < share[F.col(lang_col)])


def train(sample: DataFrame, text_col: str = "text", lang_col: str = "lang",
          tasks: int = 12) -> Model:
    """Count the n-grams of each language and smooth them to log-probabilities."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, own in pdf.groupby("lang", sort=False):
                table = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for _, buckets in _features(own["text"].tolist()):
                    table += np.bincount(buckets, minlength=BUCKETS)
        if counts:
            yield pd.DataFrame({"lang": list(counts),
                                "counts": [c.tobytes() for c in counts.values()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype=np.int64) for c in pdf["counts"])
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "counts": [total.tobytes()]})

    schema = "lang string, counts binary"
    counted = (sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
               .repartition(tasks).mapInPandas(count, schema)
               .groupBy("lang").applyInPandas(add, schema))
    # one row of fixed size per language: the model
    found = {r.lang: np.frombuffer(r.counts, dtype=np.int64) for r in counted.collect()}
    languages = sorted(lang for lang, c in found.items() if c.any())
    table = np.array([found[lang] + SMOOTHING for lang in languages]).reshape(-1, BUCKETS)
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def predict(df: DataFrame, model: Model, text) -> DataFrame:
    """Column ``struct<lang_pred, score>`` for a text column of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()),
                                T.StructField("score", T.DoubleType())]))
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = shared.value.score(batch.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})
    return language.asNondeterministic()(text)


def held_out(id_col: str = "doc_id"):
    """Rows that never train: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, predict all:
    ``(doc_id, held_out, lang_pred, score)``."""
    model = train(training_sample(docs.where(~held_out(id_col)), id_col, lang_col),
                  text_col, lang_col)
    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       predict(docs, model, F.col(text_col)).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text",
                    least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is identified: not ``und`` and a
    posterior of ``least_score`` or more."""
    doc = F.struct(*(docs[c] for c in docs.columns)).alias("doc")
    scored = docs.select(doc, predict(docs, model, docs[text_col]).alias("p"))
    return scored.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= least_score)) \
        .select("doc.*")
