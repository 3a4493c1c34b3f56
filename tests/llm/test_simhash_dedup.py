"""SimHash near-dedup against brute force, and its defined edge cases."""

from __future__ import annotations

import random

import xxhash

from emporium.llm import simhash_dedup as S

SCHEMA = "doc_id long, text string"


def brute_fp(text):
    words = []
    for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or ""):
        words.append("".join(c.lower() if "A" <= c <= "Z" else c for c in w))
    grams = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
             if len(words) >= 3 else [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(fps):
    """doc → smallest doc reachable over fingerprints at two bits or fewer."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = S.near_duplicate_groups(docs).collect()
    fps = {i: brute_fp(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in got} == brute_groups(fps)
    assert len(set(brute_groups(fps).values())) < len(fps)


def test_links_of_clustered_fingerprints(spark):
    rng = random.Random(7)
    fps = {0, 1, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):  # chains of one to three flipped bits
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, first_id long")
    got = {r.fp: r.component_id for r in S.fingerprint_groups(rows).collect()}
    want = brute_groups(dict(enumerate(fps)))
    assert got == {signed[i]: c for i, c in want.items()}


def test_edges(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "one two"), (9, "one two"), (None, "one two"),
            (None, "alone here now"), (1, "A b C " * 50_000), (2, "a B c " * 50_000)]
    got = sorted(S.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect(),
                 key=lambda r: (r.doc_id is None, r.doc_id, r.fingerprint))
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].component_id for i in (5, 4, 3)] == [3, 3, 3] and by[3].fingerprint == "0" * 16
    assert len([r for r in got if r.doc_id == 9]) == 2 and by[9].component_id == 9
    assert by[2].component_id == 1 == by[1].component_id
    assert {r.component_id for r in got if r.doc_id is None} == {9, None}
    assert S.near_duplicate_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_row_of_each_group_stays(spark):
    rows = [(2, "same text here again", "x", 1), (1, "Same text here again", None, 2),
            (1, "Same text here again", None, 2), (None, "same text here again", "y", 3),
            (None, "nobody else wrote this", "z", 4), (7, None, "n", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [rows[1], rows[4], rows[5]], key=repr)
