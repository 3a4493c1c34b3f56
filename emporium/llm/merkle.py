"""Merkle dataset manifest: one hash per group and table that any row can be proved against.

Every row is a leaf; in each group (a ``lang``) the leaves ascend by id and
every ``FAN`` consecutive nodes become one parent until one node, the
subroot, is left.  The subroots in group order form the top tree in the same
way.  A level is one window: lag and lead columns at the fixed offsets 1 to
``FAN`` - 1, masked by a node's slot in its run and by the run's length, give
each node its siblings, and the first child of a run hashes the parent.  A
row's proof is its siblings on every level up to the root.

No group is brought into one task.  The leaves are written once, sorted by
range over the cluster; a leaf's place in its group is its place in its sorted
partition plus the rows of the group in the partitions before (one row per
group and partition).  The windows run over blocks of ``BLOCK`` places, whole
runs each, and a proof goes down from parent to child by joins with ``FAN``
rows a key at most.  Each level is written to the shared folder; the driver
sees the size of the largest group and the root.

Defined results: nulls in the leaf columns are encoded as ``-`` and differ from
empty texts; a null group comes first, a null id before all ids; rows with
equal ids are ordered by leaf hash, and rows equal in all leaf columns, which
are interchangeable, by their place in the input; a group of one row has that
leaf as its subroot and one group alone has its subroot as the root; an empty
table has no rows and no root.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.session import materialise

FAN = 8
#: Places of a window's block, a power of the fan.
BLOCK = FAN ** 4
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """A value as its UTF-8 byte count, ``:`` and its text; null as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def _placed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``i``, the place in its ``g`` in ``order`` (which ends in a
    unique column), and ``n``, the rows of the ``g``."""
    ranged = materialise(
        nodes.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)),
        f"{name}-sorted")
    stretch = ranged.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    by_part = Window.partitionBy("g").orderBy("part")
    before = F.sum("rows").over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    stretch = stretch.select("g", "part", "first", F.coalesce(before, F.lit(0)).alias("before"),
                             F.sum("rows").over(Window.partitionBy("g")).alias("n"))
    return ranged.join(stretch, ["g", "part"]) \
        .withColumn("i", F.col("at") - F.col("first") + F.col("before")) \
        .drop("at", "part", "first", "before")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``(g, i, n, h)`` nodes of a level → with ``before`` and ``after``, the joined
    hashes of the run's other nodes, and on the first child ``parent``."""
    block = Window.partitionBy("g", F.expr(f"i div {BLOCK}")).orderBy("i")
    slot = F.col("i") % FAN
    length = F.least(F.lit(FAN), F.col("n") - (F.col("i") - slot))
    before = [F.when(slot >= k, F.lag("h", k).over(block)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("h", k).over(block)) for k in range(1, FAN)]
    return nodes.withColumn("before", F.concat_ws("", *before)) \
        .withColumn("after", F.concat_ws("", *after)) \
        .withColumn("parent", F.when(slot == 0, F.sha2(F.concat("h", "after"), 256)))


def _levels(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels of the trees of ``(g, i, n, h)`` nodes, lowest first, each
    ``(g, i, before, after)``, and ``(g, level, h)`` of the last node of each ``g``."""
    levels: list[DataFrame] = []
    largest = nodes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    ends = nodes.where("n = 1").select("g", F.lit(0).alias("level"), "h")
    while largest > 1:
        done = materialise(
            _with_siblings(nodes.where("n > 1")).select("g", "i", "n", "before", "after", "parent"),
            f"{name}-level{len(levels)}")
        levels.append(done)
        nodes = done.where("parent IS NOT NULL").select(
            "g", F.expr(f"i div {FAN}").alias("i"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
            F.col("parent").alias("h"))
        largest = -(-largest // FAN)
        ends = ends.unionByName(nodes.where("n = 1").select("g", F.lit(len(levels)).alias("level"), "h"))
    return levels, ends


_PATH = "array<struct<before:string,after:string>>"


def _paths(levels: list[DataFrame], ends: DataFrame) -> DataFrame:
    """``(g, i, path)`` of every leaf: its siblings, level by level upwards.

    ``ends`` is ``(g, level, path)``: how the path goes on from the last node of
    a ``g``, which is on that level.
    """
    def ending(level: int) -> DataFrame:
        return ends.where(F.col("level") == level).select("g", F.lit(0).cast("long").alias("i"), "path")

    above = ending(len(levels))
    for level in range(len(levels) - 1, -1, -1):
        parents = above.select("g", F.col("i").alias("up"), F.col("path").alias("rest"))
        own = F.array(F.struct("before", "after"))
        nodes = levels[level].join(
            parents, (levels[level]["g"] == parents["g"]) & (F.expr(f"i div {FAN}") == F.col("up"))) \
            .select(levels[level]["g"], "i", F.concat(own, F.col("rest")).alias("path"))
        above = nodes.unionByName(ending(level))
    return above


def manifest(docs: DataFrame, leaf: Column, id_col: str = "doc_id", group_col: str = "lang",
             **carried: Column) -> DataFrame:
    """``(id, group, leaf, subroot, root, path)`` per row, and the ``carried`` columns.

    ``path`` holds the siblings ``before`` and ``after`` the row's node on each
    level; :func:`folded` hashes a leaf up along it.
    """
    leaves = materialise(
        docs.select(docs[id_col].alias("id"), docs[group_col].alias("group"), leaf.alias("leaf"),
                    # not null, and in the order of the group, null first
                    F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit("")).alias("g"),
                    F.monotonically_increasing_id().alias("row"),
                    *(c.alias(f"carried_{name}") for name, c in carried.items())), "merkle-leaves")
    nodes = materialise(_placed(leaves, ["id", "leaf", "row"], "merkle").drop("row"), "merkle-nodes")
    levels, ends = _levels(nodes.withColumnRenamed("leaf", "h").select("g", "i", "n", "h"), "merkle")

    ends = materialise(ends, "merkle-subroots")
    tops = materialise(_placed(ends.select(F.lit(0).alias("g"), F.col("g").alias("group_key"), "level", "h"),
                               ["group_key"], "merkle-top"), "merkle-tops")
    top_levels, top_ends = _levels(tops.select("g", "i", "n", "h"), "merkle-top")
    top = top_ends.first()  # one row, or none for an empty table
    root = F.lit(top["h"] if top else None).cast("string")
    nothing = F.array().cast(_PATH)
    top_paths = _paths(top_levels, top_ends.select("g", "level", nothing.alias("path")))
    ends = materialise(tops.join(top_paths, ["g", "i"]).select(
        F.col("group_key").alias("g"), "level", "path", F.col("h").alias("subroot")), "merkle-ends")

    # the subroot goes down with the path, as its last element
    last = F.array(F.struct(F.col("subroot").alias("before"), F.lit("").alias("after")))
    paths = _paths(levels, ends.select("g", "level", F.concat("path", last).alias("path")))
    size = F.size("path")
    return nodes.join(paths, ["g", "i"]).select(
        "id", "group", "leaf", F.element_at("path", -1)["before"].alias("subroot"), root.alias("root"),
        F.slice("path", F.lit(1), size - 1).alias("path"),
        *(F.col(f"carried_{name}").alias(name) for name in carried))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_hash(path: Column) -> Column:
    """One hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row,
    the last two for a table in which the texts of the rows whose id's crc32 is
    divisible by 3 were lower-cased."""
    def leaf(text: Column) -> Column:
        return leaf_hash(*(text if c == "text" else docs[c] for c in LEAF_COLUMNS))

    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    proved = manifest(docs, leaf(docs["text"]), arrived=F.when(tampered, leaf(lower_ascii(docs["text"])))
                      .otherwise(leaf(docs["text"])))
    return proved.withColumn("folded_root", folded(F.col("arrived"), F.col("path"))).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


#: DuckDB's crc32 of a list of bytes ``{bytes}``, with the polynomial's table
#: from ``crc_table(t)``, which a query joins.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
CRC = """xor(list_reduce(list_concat([4294967295], {bytes}),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _sql_leaf(text: str) -> str:
    parts = (text if c == "text" else f"{c}::VARCHAR" for c in LEAF_COLUMNS)
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({p}))::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


#: DuckDB: levels grouped by place div 8 in a recursive table, each row walked up
#: through the running concatenations of its runs.
ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT doc_id, lang, {_sql_leaf('text')} AS leaf,
         CASE WHEN {CRC.format(bytes="list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)")} % 3 = 0
              THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              END AS changed
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT 0 AS level, lang, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, lang, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY level, lang, i // 8, n),
subroots AS (
  SELECT lang, level, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i,
         count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM tops WHERE n > 1 GROUP BY level, i // 8, n),
near AS (
  SELECT level, lang, i,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY level, lang, i // 8 ORDER BY i)),
near_top AS (
  SELECT level, i,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY level, i // 8 ORDER BY i)),
walk AS (
  SELECT doc_id, lang, leaf, coalesce(changed, leaf) AS h, '' AS proof, 0 AS level, i FROM placed
  UNION ALL
  SELECT w.doc_id, w.lang, w.leaf, sha256(s.l || w.h || s.r), w.proof || s.l || s.r, w.level + 1, w.i // 8
  FROM walk w JOIN near s ON s.level = w.level AND s.i = w.i AND s.lang IS NOT DISTINCT FROM w.lang),
climb AS (
  SELECT w.doc_id, w.leaf, s.subroot, w.h, w.proof, 0 AS level, s.i
  FROM walk w JOIN subroots s ON s.level = w.level AND s.lang IS NOT DISTINCT FROM w.lang
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, sha256(s.l || c.h || s.r), c.proof || s.l || s.r, c.level + 1, c.i // 8
  FROM climb c JOIN near_top s ON s.level = c.level AND s.i = c.i)
SELECT c.doc_id, c.leaf, c.subroot, t.h AS root, sha256(c.proof) AS proof_sha256,
       c.h AS folded_root, c.h = t.h AS verified
FROM climb c JOIN tops t ON t.n = 1 AND t.level = c.level
"""
