"""Spelling variants: words one edit apart, found by walking a trie level by level.

The words of a corpus are counted, the vocabulary's prefixes become the edges
of a trie, a distributed table ``(node, ch, child)``, and states
``(word, position, node, edits)`` move along it by joins.  A node is the 64-bit
hash of its prefix; two prefixes that share a hash only add paths, and each
pair is compared exactly in the end.

One edit leaves one half of a word unchanged.  So a walk along the trie of the
words finds the edits in the second half, and one along the trie of the
reversed words those in the first; either starts on the word's own path, at
its middle, where the trie has thinned out.  One join per trie makes all
one-edit states: the state at each node of a word's second half takes another
edge of the node instead of the word's next character (replacement) or before
it (insertion; a deletion is an insertion seen from the other word).  Each
level then joins the states with the edges on the node and the next
character.  An edge knows the lengths and the next characters that occur
below it, as bits, and how many words; a state that no word below can end is
not made, and one above a single word is decided by comparing with that word.
States that reach the end of their word at the end of a word are neighbours.

The rows of a level are states, never pairs of a group, and a hot node (a
prefix of very many words) has one row per character in the edge table, while
its states are split over tasks by AQE's skew handling.  Levels are written to
the shared folder.  The number of levels is what two different words share
behind an edit.

Defined results: null texts have no words; a null id is the text ``null`` in
the hash; equal rows count each; the walk has no bound on the length of a
word; an empty vocabulary gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.merkle import CRC, CRC_TABLE
from emporium.session import materialise

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A run in a document loses a character when this divides its hash.
NOISE = 31
#: A word is a variant of a neighbour that is this often as frequent.
RATIO = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def noisy(doc_id: Column, run: Column) -> Column:
    """A run of a document, with one character deleted where the hash says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % NOISE == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))) \
        .otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the words of all texts with their counts."""
    runs = F.regexp_extract_all(docs[text_col], F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    run = F.col("run")
    lowered = F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run)
    words = docs.select(docs[id_col].alias("id"), F.explode(runs).alias("run")) \
        .select("id", lowered.alias("run")).select(noisy(F.col("id"), run).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def _bit(number: Column) -> Column:
    """A 64-bit set of one number; all from 63 on share the last bit."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.least(number, F.lit(63)).cast("int"))


def _char_bit(text: Column, at: Column) -> Column:
    """The set of the character behind the first ``at`` of a text, by its code; 0 at the end."""
    return _bit(F.ascii(_char(text, at)) % 64)


def _char(text: Column, at: Column) -> Column:
    """The character behind the first ``at`` of a text, none at its end."""
    return F.substring(text, at + 1, F.lit(1))


def _node(text: Column, length: Column) -> Column:
    return F.xxhash64("reverse", F.substring(text, F.lit(1), length))


def _tries(words: DataFrame) -> DataFrame:
    """Each word as a path of both tries: ``(t, reverse, len)``."""
    return words.select(
        F.explode(F.array(F.struct(F.lit(False).alias("reverse"), F.col("word").alias("t")),
                          F.struct(F.lit(True).alias("reverse"), F.reverse("word").alias("t")))).alias("x")) \
        .select("x.*", F.length("x.t").alias("len"))


def _edges(words: DataFrame) -> DataFrame:
    """The tries: ``(node, ch, child, below, only, ends, lengths, nexts, later)``.

    ``below`` counts the words under ``child``, ``only`` is the hash of one of
    them, ``ends`` says that a word ends at ``child``; the sets hold what may
    follow: lengths from ``child`` on, first and second characters.  Edges under a
    node with a single word are left out: no state goes on there.
    """
    p = F.col("p")
    steps = _tries(words).select("*", F.explode(F.sequence(F.lit(0), F.col("len") - 1)).alias("p"))
    edges = materialise(
        steps.groupBy(_node(F.col("t"), p).alias("node"), _char(F.col("t"), p).alias("ch"),
                      _node(F.col("t"), p + 1).alias("child"))
        .agg(F.count(F.lit(1)).alias("below"), F.min(F.xxhash64("t")).alias("only"),
             F.max(p + 1 == F.col("len")).alias("ends"),
             F.bit_or(_bit(F.col("len") - p - 1)).alias("lengths"),
             F.bit_or(_char_bit(F.col("t"), p + 1)).alias("nexts"),
             F.bit_or(_char_bit(F.col("t"), p + 2)).alias("later")), "spelling-trie")
    single = edges.where("below = 1").select(F.col("child").alias("node"))
    return materialise(edges.join(single, "node", "left_anti"), "spelling-edges")


def _sought(text: Column, at: Column, rest: Column, prefix: str) -> list[Column]:
    """What must be found below a node for ``rest`` characters, those of ``text`` behind ``at``."""
    return [_bit(rest).alias(f"{prefix}lengths"), _char_bit(text, at).alias(f"{prefix}nexts"),
            _char_bit(text, at + 1).alias(f"{prefix}later")]


def _may_end(prefix: str = "") -> Column:
    """Whether the sets of an edge hold what is sought."""
    held = F.lit(True)
    for found in ("lengths", "nexts", "later"):
        held = held & (F.col(found).bitwiseAND(F.col(prefix + found)) == F.col(prefix + found))
    return held


def _decided(states: DataFrame) -> DataFrame:
    """States behind an edge: found when a word ends there or the only word below
    is the target, gone when neither can become true, else to go on."""
    ended = F.col("at") == F.length("target")
    alone = F.col("below") == 1
    found = F.when(alone, F.col("only") == F.xxhash64("target")).when(ended, F.col("ends")).otherwise(False)
    return states.withColumn("found", found).where(F.col("found") | ~(alone | ended)) \
        .select("word", "target", "reverse", "at", "node", "found")


def _spawned(words: DataFrame, edges: DataFrame) -> DataFrame:
    """All one-edit states.  Each pair of equal lengths starts from its smaller
    word, the others from the shorter one."""
    half = F.expr("len div 2")
    least = F.when(F.col("reverse"), F.col("len") - half).otherwise(half)
    t, length, p = F.col("t"), F.col("len"), F.col("p")
    own = _tries(words).select("*", least.alias("least"), F.explode(F.sequence(least, length)).alias("p")).select(
        "t", "reverse", "p", (~F.col("reverse") | (p > F.col("least"))).alias("grows"),
        _node(t, p).alias("node"), _char(t, p).alias("own"),
        *_sought(t, p + 1, length - p - 1, "r_"), *_sought(t, p, length - p, "i_"))
    replaces = (F.col("own") != "") & (F.col("ch") > F.col("own")) & _may_end("r_")
    inserts = F.col("grows") & (F.col("ch") != F.col("own")) & _may_end("i_")
    made = own.join(edges.withColumnRenamed("node", "parent"),
                    (F.col("node") == F.col("parent")) & (replaces | inserts))
    start = F.concat(F.substring(t, F.lit(1), p), F.col("ch"))
    targets = F.array_compact(F.array(
        F.when(replaces, F.concat(start, F.substring(t, p + 2, F.length(t)))),
        F.when(inserts, F.concat(start, F.substring(t, p + 1, F.length(t))))))
    return _decided(made.select(F.col("t").alias("word"), F.explode(targets).alias("target"), "reverse",
                                (p + 1).alias("at"), F.col("child").alias("node"), "below", "only", "ends"))


def _advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one character further."""
    at = F.col("at")
    going = states.select("word", "target", "reverse", "at", F.col("node").alias("parent"),
                          _char(F.col("target"), at).alias("next"),
                          *_sought(F.col("target"), at + 1, F.length("target") - at - 1, "s_"))
    met = going.join(edges, (F.col("parent") == F.col("node")) & (F.col("next") == F.col("ch")) & _may_end("s_"))
    return _decided(met.select("word", "target", "reverse", (at + 1).alias("at"), F.col("child").alias("node"),
                               "below", "only", "ends"))


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, near)``: all pairs of words of ``(word, …)`` that are one edit
    apart, in both orders."""
    words = words.select("word")
    edges = _edges(words)
    states = materialise(_spawned(words, edges), "spelling-states")
    pairs = states.where("found")
    while not (going := states.where("NOT found")).isEmpty():
        states = materialise(_advanced(going, edges), "spelling-states")
        pairs = pairs.unionByName(states.where("found"))
    one = pairs.select(*(F.when(F.col("reverse"), F.reverse(c)).otherwise(F.col(c)).alias(c)
                         for c in ("word", "target"))).distinct()
    # a node stands for all prefixes with its hash: the target must be a word itself
    one = one.join(words.select(F.col("word").alias("target")), "target")
    return one.select("word", F.col("target").alias("near")) \
        .unionByName(one.select(F.col("target").alias("word"), F.col("word").alias("near")))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, n)`` → ``(word, form, root, n, n_near, form_n)``.

    ``form`` is the most frequent neighbour (ties: the smallest) if it is ``ratio``
    times as frequent, ``root`` the last form of the forms' forms.
    """
    words = materialise(words, "spelling-words")
    counted = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    kept = -F.col("best.less") >= ratio * F.col("n")
    formed = materialise(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(kept, F.col("best.near")).alias("form"), F.when(kept, -F.col("best.less")).alias("form_n")),
        "spelling-forms")
    # a form is more frequent than its word: the chains end; each round doubles the reach
    reach = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialise(reach.join(further, "root", "left")
                              .select("word", F.coalesce("next", "root").alias("root"),
                                      F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reach = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            break
    return formed.join(reach, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    return variants(vocabulary(docs))


_BYTES = """flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, 'null') || ':' || run, ''),
      lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT]
                     ELSE [192 + (unicode(s) >> 6)::BIGINT, 128 + (unicode(s) & 63)::BIGINT] END))"""

#: DuckDB: neighbours through the words with one character left out, instead of a trie.
ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                                             '[{LETTERS}]{{{LEAST_LENGTH},}}')) AS run
    FROM documents) GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, {CRC.format(bytes=_BYTES)} AS h FROM runs, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {NOISE} = 0 THEN left(run, (h % length(run))::INT)
                        || right(run, (length(run) - h % length(run) - 1)::INT) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
gaps AS (
  SELECT word, n, i, left(word, i - 1) || right(word, length(word) - i) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word),
best AS (
  SELECT word, count(*)::BIGINT AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n
  FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN near_n >= {RATIO} * w.n THEN near END AS form,
         CASE WHEN near_n >= {RATIO} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
