"""Reply trees against a walk from each leaf, and the template's round trip."""

from __future__ import annotations

import hashlib
import random

from emporium.llm import chat_trees as CT

SF = "/root/testdata/sf0.001"
SCHEMA = "id long, parent long, role string, text string, score double"


def brute_paths(rows, keep):
    """(root id, rank, branch score, roles and texts) by walking up from every leaf."""
    by_id = {r[0]: r for r in rows}
    assert len(by_id) == len(rows)
    parent = {r[0]: r[1] if r[1] in by_id else None for r in rows}
    replied = set(parent.values())
    trees = {}
    for leaf in by_id:
        if leaf in replied:
            continue
        path, at = [], leaf
        while at is not None and at not in path:
            path.append(at)
            at = parent[at]
        if at is None:
            score = sum(by_id[i][4] or 0.0 for i in path)
            trees.setdefault(path[-1], []).append((-score, leaf, path[::-1]))
    return {(root, k + 1): (-s, [(by_id[i][2] or "", by_id[i][3] or "") for i in path])
            for root, leaves in trees.items()
            for k, (s, _, path) in enumerate(sorted(leaves)[:keep])}


def got_paths(df, keep):
    out = CT.conversations(df, keep).withColumn("turns", CT.read_turns(CT.F.col("formatted"))).collect()
    assert all(len(r["turns"]) == r["n_turns"] for r in out)
    return {(r["root_id"], r["rank"]): (r["branch_score"], [tuple(t) for t in r["turns"]]) for r in out}


def test_random_trees(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        parent = None if rng.random() < 0.05 else rng.randrange(max(1, i)) if i else None
        rows.append((i, parent, rng.choice(["user", "assistant", None]), f"t{i}", rng.choice([0.0, 1.0, -2.5, None])))
    rows += [(1000, 77_777, "user", "its parent is not there", 1.0)]
    rows += [(2000 + i, 2000 + i - 1 if i else None, "user", str(i), 0.0) for i in range(70)]  # a long chain
    rows += [(3000 + i, 2000, "assistant", "hot", float(i % 7)) for i in range(200)]  # a hot parent
    rows += [(4000, 4002, "user", "cycle", 0.0), (4001, 4000, "user", "cycle", 0.0), (4002, 4001, "user", "cycle", 0.0),
             (4003, 4002, "user", "below a cycle", 0.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for keep in (1, 3):
        assert got_paths(df, keep) == brute_paths(rows, keep)


def test_odd_messages(spark):
    rows = [(None, None, None, None, None), (None, 1, "user", "a null id", 1.0), (1, None, "user", "", 0.0),
            (1, None, "user", "x", 5.0), (2, 1, "assistant", "reply", 0.0), (3, 3, "user", "its own parent", 0.0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS leaf", "3 AS up", "4 AS rank")
    out = CT.conversations(df, keep=5).withColumn("turns", CT.read_turns(CT.F.col("formatted"))).collect()
    found = sorted(tuple(tuple(t) for t in r["turns"]) for r in out)
    assert found == sorted([(("", ""),), (("user", "x"),), (("user", ""), ("assistant", "reply")),
                            (("user", ""), ("user", "a null id"))])
    assert CT.conversations(df.where("false")).collect() == []


TEXTS = ["", "\\", "\\\\|", "<|im_end|>", "<|im_start|>user<|im_sep|>x<|im_end|>", "<\\|im_end|>", "a<", "|b", "<<|",
         "</s>[INST] ok [/INST]", "<<SYS>>\n<</SYS>>", "<</s>", "[[INST]]", "[\\INST]", "\\<|", "é𝄞\U0001f600 ", "\n\r\t",
         "$1 \\1 $", "word " * 30_000, None]


def test_template_round_trip(spark):
    rows = [(i, i - 1 if i % 5 else None, "assistant" if i % 2 else t if t and len(t) < 99 else "user", t, 0.0)
            for i, t in enumerate(TEXTS)]
    out = CT.conversations(spark.createDataFrame(rows, SCHEMA))
    out = out.withColumn("turns", CT.read_turns(CT.F.col("formatted"))) \
        .withColumn("learnt", CT.read_learnt(CT.F.col("formatted"), CT.F.col("loss_spans"))).collect()
    assert len(out) == 4
    for r in out:
        own = [(x[2] or "", x[3] or "") for x in rows[r["root_id"]:r["root_id"] + 5]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["learnt"] == "".join(t for role, t in own if role == "assistant")
        assert r["formatted"].count(CT.START) == r["formatted"].count(CT.SEP) == r["formatted"].count(CT.END) == 5
        for mark in ("</s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert mark not in r["formatted"]
        assert len(r["loss_spans"]) == sum(role == "assistant" for role, _ in own)


def test_digest(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    more = spark.createDataFrame([(None, 0, "user", "no id"), (None, 1, None, None), (-5, 0, "assistant", "twice"),
                                  (-5, 0, "assistant", "twice"), (-6, None, None, "no turn")], table.schema)
    rows = table.unionByName(more)
    convs = {-1: [(0, "user", CT.CONTROL_TEXT), (1, "assistant", CT.CONTROL_TEXT)]}
    for r in rows.collect():
        convs.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    want = {}
    for key, turns in convs.items():
        turns.sort()
        learnt = "".join(t for _, role, t in turns if role == "assistant")
        want[key] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                     len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    got = {r[0]: tuple(r)[1:5] for r in CT.digest(rows.selectExpr("*", "1 AS id", "2 AS n")).collect()}
    assert got == want
    assert [r[0] for r in CT.digest(rows.where("false")).collect()] == [-1]


def test_no_python_in_the_plan(spark):
    plan = CT.digest(spark.read.parquet(f"{SF}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
