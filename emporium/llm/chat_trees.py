"""Chat formatting: reply trees to training conversations, in DataFrame functions only.

Messages point to the message they reply to.  Three steps, each a few rounds
of self-joins whose pointers double their reach, so that a path of length n
takes about log2(n) rounds:

* every message learns its root, its depth and the score of its branch (the
  sum of the scores from the root down) by joining its pointer's row;
* the leaves of a tree are ranked by branch score, and the ``keep`` best stay;
* the messages of the chosen paths are listed: a path holds its leaf, and a
  round adds to each of its messages the one 1, 2, 4, … replies above.

A round's rows are one per message (per message and chosen path in the last
step) and are written to the shared folder.  Joins are on message rows; a
message with a great many replies is a skewed join key, which AQE splits.
Ranking keeps ``keep`` leaves a tree before its shuffle.  A formatted path is
one row, so the paths themselves, and no other group, are brought together.

A path becomes ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each message,
one after the other.  Control strings of this and of other common templates
that occur in a role or text get a backslash behind their first character and
backslashes are doubled, so no text can end its turn and :func:`unescaped`
gives it back.  The loss mask is the list of code-point spans of the assistant
texts in the formatted string.

Defined results: a null text or role is empty; null or unknown parents make a
message a root; a null id cannot be replied to; of rows with equal ids the
first by role, text and place in the input gets the replies, the others are
leaves; a null score counts 0; leaves with equal scores rank by their row's
order (role, text, place).  Messages on or below a cycle of replies have no
root and are on no path.  Nothing is cut: each kept path is formatted whole.
Columns of the input other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.session import materialise

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Beginnings of control strings in common chat templates, as the
#: first character and what follows it.
CONTROL = r"<(?=\||s>|/s>|<SYS>>|</SYS>>)|\[(?=/?INST\])"
LEARNT_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Double backslashes, and put one behind the first character of a control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({CONTROL})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _messages(messages: DataFrame) -> DataFrame:
    """``(row, id, up, role, text, score)``: ``up`` is the row replied to."""
    rows = materialise(messages.select(
        "id", "parent", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.monotonically_increasing_id().alias("row")), "chat-messages")
    first = F.min(F.struct("role", "text", "row"))  # one row answers to an id
    named = rows.where("id IS NOT NULL").groupBy("id").agg(first["row"].alias("up")) \
        .withColumnRenamed("id", "parent")
    # the null parents of all roots, one key, stay out of the join
    replies = rows.where("parent IS NOT NULL").join(named, "parent", "left").drop("parent")
    roots = rows.where("parent IS NULL").drop("parent").withColumn("up", F.lit(None).cast("long"))
    return materialise(replies.unionByName(roots), "chat-rows")


def _branches(rows: DataFrame) -> DataFrame:
    """``(row, root, depth, score)`` of every message that has a root.

    A pointer says: ``far`` is ``depth`` replies above ``row``, and ``score`` is the
    sum from ``row`` to just below ``far``.  Joined with the pointer of ``far`` it
    reaches twice as far; it is done when it holds the root itself.
    """
    is_root = F.col("up").isNull()
    state = rows.select("row", F.coalesce("up", "row").alias("far"), is_root.alias("done"),
                        F.when(is_root, 0).otherwise(1).cast("long").alias("depth"), "score")
    most, reach = rows.count(), 1
    while True:
        live, done = state.where("NOT done"), state.where("done")
        if reach > most or live.isEmpty():  # what is left then hangs on a cycle
            return done.select("row", F.col("far").alias("root"), "depth", "score")
        above = state.select(F.col("row").alias("far"), F.col("far").alias("far2"), F.col("done").alias("done2"),
                             F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        further = live.join(above, "far").select(
            "row", F.col("far2").alias("far"), F.col("done2").alias("done"),
            (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("score") + F.col("score2")).alias("score"))
        state = materialise(done.unionByName(further), "chat-branches")
        reach *= 2


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``(id, parent, role, text, score)`` messages → the messages of the ``keep``
    best branches of each tree: ``(leaf, rank, branch_score, at, id, role, text)``,
    where ``at`` counts from 0 at the root."""
    rows = _messages(messages)
    replied_to = rows.where("up IS NOT NULL").select(F.col("up").alias("row")).distinct()
    leaves = _branches(rows).join(replied_to, "row", "left_anti").join(rows.select("row", "id"), "row")
    by_score = Window.partitionBy("root").orderBy(F.desc("score"), "id", "row")
    chosen = materialise(
        leaves.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= keep)
        .select(F.col("row").alias("leaf"), "rank", "depth", F.col("score").alias("branch_score")),
        "chat-chosen")

    # with pointers 1, 2, 4, … replies up, a path's listed messages double each round
    on_path = chosen.select("leaf", F.col("leaf").alias("row"), F.col("depth").alias("at"))
    jump = rows.where("up IS NOT NULL").select("row", "up")
    deepest = chosen.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    reach = 1
    while reach <= deepest:
        further = on_path.where(F.col("at") >= reach).join(jump, "row") \
            .select("leaf", F.col("up").alias("row"), (F.col("at") - reach).alias("at"))
        on_path = materialise(on_path.unionByName(further), "chat-paths")
        reach *= 2
        if reach <= deepest:
            twice = jump.select(F.col("row").alias("up"), F.col("up").alias("up2"))
            jump = materialise(jump.join(twice, "up").select("row", F.col("up2").alias("up")), "chat-jumps")
    return on_path.join(chosen.drop("depth"), "leaf") \
        .join(rows.select("row", "id", "role", "text"), "row").drop("row")


def conversations(messages: DataFrame, keep: int = 1, learnt: str = LEARNT_ROLE) -> DataFrame:
    """One row per chosen path: ``(root_id, rank, branch_score, n_turns, formatted,
    loss_spans)``; spans are ``(start, length)`` in code points from 0."""
    turns = best_paths(messages, keep).select(
        "leaf", "rank", "branch_score", "at", "id", (F.col("role") == learnt).alias("learnt"),
        F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP)).alias("head"),
        escaped(F.col("text")).alias("body"))
    before = Window.partitionBy("leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + len(END)
    start = F.coalesce(F.sum(length).over(before), F.lit(0)) + F.length("head")
    placed = turns.withColumn("span", F.struct(start.alias("start"), F.length("body").cast("long").alias("length")))
    turn = F.struct("at", F.concat("head", "body", F.lit(END)).alias("text"), "span", "learnt")
    paths = placed.groupBy("leaf").agg(
        F.min_by("id", "at").alias("root_id"), F.first("rank").alias("rank"),
        F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(turn)).alias("turns"))
    return paths.select(
        "root_id", "rank", "branch_score", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.text"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: t["span"]).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Formatted string → array of ``(role, text)``, unescaped."""
    def parts(turn: Column) -> Column:
        return F.split(turn, SEP.replace("|", r"\|"))

    # what stands before an end mark; nothing stands behind the last one
    turns = F.filter(F.split(formatted, END.replace("|", r"\|")), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.replace(parts(t)[0], F.lit(START), F.lit(""))).alias("role"),
        unescaped(parts(t)[1]).alias("text")))


def read_learnt(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def replies_in_order(rows: DataFrame, tree: str = "conv_id", at: str = "turn") -> DataFrame:
    """Conversations listed turn by turn as reply trees of one branch: each row
    replies to the one before it; equal turns go by role and text.  An id is the
    struct of the tree and the row's number in it."""
    in_tree = Window.partitionBy(tree).orderBy(F.col(at), "role", "text")
    numbered = rows.select(rows[tree].alias("tree"), F.row_number().over(in_tree).alias("n"), "role", "text")
    return numbered.select(
        F.struct("tree", "n").alias("id"),
        F.when(F.col("n") > 1, F.struct("tree", (F.col("n") - 1).alias("n"))).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


#: The text of both turns of the conversation that the query adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def digest(rows: DataFrame) -> DataFrame:
    """Format the conversations and one of control strings, write them, and read
    back ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``."""
    spark = rows.sparkSession
    columns = ["conv_id", "turn", "role", "text"]
    added = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, LEARNT_ROLE, CONTROL_TEXT)],
                                  rows.select(*columns).schema)
    written = materialise(conversations(replies_in_order(rows.select(*columns).unionByName(added))),
                          "chat-formatted")
    turns = F.transform(read_turns(F.col("formatted")),
                        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = written.withColumn("turns", turns) \
        .withColumn("learnt", read_learnt(F.col("formatted"), F.col("loss_spans")))
    return read.select(
        F.col("root_id")["tree"].alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escaped(column: str) -> str:
    """Characters of an escaped text: its own, its backslashes again, one for each control string."""
    marks = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
    return f"length({column}) + " + " + ".join(
        f"(length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in ("\\", *marks))


#: DuckDB: the turns put together straight from the table.
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -1, 1, '{LEARNT_ROLE}', '{CONTROL_TEXT}')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = '{LEARNT_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text)
                       FILTER (WHERE role = '{LEARNT_ROLE}'), '')) AS loss_sha256,
       sum({len(START + SEP + END)} + {_sql_escaped('role')} + {_sql_escaped('text')})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
