"""Merkle manifest against a tree built by hand, and its odd inputs."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from emporium.llm import merkle as MK

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """(root, siblings of every leaf level by level) by slicing lists."""
    paths, members = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        parents, above = [], []
        for at in range(0, len(hashes), 8):
            run = hashes[at:at + 8]
            for k in range(len(run)):
                for i in members[at + k]:
                    paths[i].append((run[:k], run[k + 1:]))
            parents.append(sha(*run))
            above.append([i for m in members[at:at + 8] for i in m])
        hashes, members = parents, above
    return hashes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for k in keys:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
    trees = [tree([leaf_of(r, r["text"]) for r in groups[k]]) for k in keys]
    root, tops = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for k, (subroot, paths), top in zip(keys, trees, tops):
        for r, path in zip(groups[k], paths):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = text.translate(A_TO_Z)
            h = leaf_of(r, text)
            for before, after in path + top:
                h = sha(*before, h, *after)
            proof = sha(*(x for before, after in path + top for x in before + after))
            out.append((r["doc_id"], leaf_of(r, r["text"]), subroot, root, proof, h, h == root))
    return sorted(out, key=repr)


def check(df):
    got = sorted(map(tuple, MK.digest(df).collect()), key=repr)
    assert got == brute(df.collect())
    return got


def test_manifest_of_documents(spark):
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
            (2, "Éß x", "en", None, 4), (None, "A", "en", "s", 1), (None, None, None, None, None),
            (3, "Long " * 40_000, "", "s", 1), (6, "UPPER", "", "s", 5), (7, "only", "zz", "s", 4)]
    # 8, 9 and 65 rows: a full run, a last run of one, a third level
    for lang, n in (("eight", 8), ("nine", 9), ("more", 65)):
        rows += [(100 + i, f"Text {i}", lang, "s", i) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df)
    check(df.selectExpr("*", "1 AS g", "2 AS i", "'x' AS h", "'y' AS leaf", "3 AS part", "4 AS path"))
    check(df.where("doc_id = 7"))
    assert MK.digest(df.where("false")).collect() == []


def test_one_group_spans_blocks(spark):
    """More than a window's block of places in one group: 8,193 is two blocks and one row."""
    df = spark.range(8193).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang",
                                      "cast(null AS string) AS source", "id AS n_chars")
    check(df.repartition(7))


@pytest.mark.parametrize("changed", ["upper(source) AS source",
                                     "doc_id + 1 AS doc_id"])
def test_any_change_moves_the_root(spark, changed):
    df = spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(20)], SCHEMA)
    name = changed.split()[-1]
    other = df.selectExpr(*(changed if c == name else c for c in df.columns))
    assert MK.digest(df).first()["root"] != MK.digest(other).first()["root"]
