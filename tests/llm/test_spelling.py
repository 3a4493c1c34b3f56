"""Spelling variants against all pairs of a small vocabulary, and odd texts."""

from __future__ import annotations

import random
import zlib
from collections import Counter

from emporium.llm import spelling as SP

SCHEMA = "doc_id long, text string"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying all of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                run = run.translate(A_TO_Z)
                h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_dense_vocabulary(spark):
    """Few letters, so that almost every prefix goes on in every way."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))): rng.choice([1, 2, 10, 30, 300, 4000])
             for _ in range(1200)}
    words |= {"a" * k: 10 ** (k % 4) for k in range(1, 20)}  # long shared prefixes, one insertion apart
    words |= {"x" * 3000 + "y" + "x" * 3000: 50, "x" * 3000 + "z" + "x" * 3000: 5, "x" * 6000: 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(SP.variants(df)) == brute_variants(words)


def test_other_scripts(spark):
    words = {"привет": 100, "превет": 3, "привед": 2, "приветы": 10, "𝄞𝄞a": 20, "𝄞𝄞": 1, "𝄢𝄞a": 2, "": 3, "b": 40}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(SP.variants(df)) == brute_variants(words)


def test_odd_texts(spark):
    rng = random.Random(4)
    stems = ["Étionêau", "strasse", "straße", "Strassen", "÷×÷×÷×÷", "Nothing", "nothings", "NOTHINGS"]
    rows = [(i, " ".join(rng.choice(stems) + rng.choice([".", "1", "_", "", "-x"]) for _ in range(40)))
            for i in range(60)]
    rows += [(None, None), (None, "Nothing nothing"), (1, ""), (2, "short a b"), (2, "short a b"),
             (3, "verylongword " * 20_000), (4, "z" * 50_000), (4, "z" * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'x' AS word", "2 AS id", "3 AS run")
    assert got(SP.digest(df.repartition(3))) == brute_variants(brute_words(rows))
    assert got(SP.digest(df.where("false"))) == []
