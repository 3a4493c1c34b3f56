"""Mixing sources to target weights.

Tokens (words) are added up per source; the sources share the total by
weight, no source more than ``MOST_REPEATS`` times its own size, the excess
going to the others by weight.  A source's repetition rate is target / size.
Each document is emitted floor(rate) times, plus one copy with probability
equal to the fraction p of the rate.  The draws are seeded hashes, so a rerun
takes the same copies, and they are made dependent so that a source's words
come near its target: a source's documents lie in a row, by size class (the
leading six bits of the size) and, where a class has several, at a place in it
that a hash of the id gives; a hash of the source is the start u of a grid, and
the document at place i has the copy when a whole number lies between
i * p + u and (i + 1) * p + u.  Whatever its place, that has probability p over
the start, and of neighbours, which are of like size, a share of p is taken.

Everything is DataFrame work: a partially aggregated sum per source, window
sums over the sources and size classes (a row each; at most 32 classes an
octave), and a join of the documents with that table.  The table is broadcast
only after its rows and bytes were counted and found small; otherwise the join
is an ordinary one, which AQE splits at a hot class.

Defined results: null or empty texts have size 0; sources sort by code point
with the null source last, a source of its own; an empty or all-empty corpus
has targets of 0 and copies of 0; in place of a null id the text is hashed;
repeated rows share a place and are taken alike.  All columns are kept, also
ones with the names used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.session import materialise

MOST_REPEATS = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix-42"
#: The source table is broadcast up to these measured bounds.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 8 << 20


def word_count(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` runs of a text, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """Hash of a key as a double in [0, 1): 52 bits of a seeded MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, size)`` rows → ``(source, source_size, target)`` per source.

    With the sources in ascending order of bound / weight, the ones that stop
    at their bound are a prefix: source i stops when its bound is at most its
    share by weight of what the sources before it leave.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*(F.lit(w) for w in weights))
    ranked = totals.withColumn("n", F.row_number().over(by_name)) \
        .withColumn("weight", F.get(weight, (F.col("n") - 1) % len(weights)).cast("long")) \
        .withColumn("bound", F.col("source_size") * MOST_REPEATS)
    fill = Window.orderBy(F.col("bound") / F.col("weight"), "n")
    everything = Window.partitionBy()
    room = F.col("total") - (F.sum("bound").over(fill) - F.col("bound"))
    weight_left = F.col("weights") - (F.sum("weight").over(fill) - F.col("weight"))
    wide = "decimal(38,0)"
    stops = F.col("bound").cast(wide) * weight_left <= F.col("weight").cast(wide) * room
    marked = ranked.withColumn("total", F.sum("source_size").over(everything)) \
        .withColumn("weights", F.sum("weight").over(everything)).withColumn("stops", stops)
    left = F.col("total") - F.sum(F.when(F.col("stops"), F.col("bound")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("stops"), F.col("bound").cast("double")) \
        .otherwise((F.col("weight") * left).cast("double") / open_weight)
    return marked.select("source", "source_size", target.alias("target"))


def size_class(size: Column) -> Column:
    """Sizes with the same leading six bits, in the order of the sizes."""
    bits = F.length(F.bin(size))
    return (bits * 64 + F.expr("shiftright(size, greatest(length(bin(size)) - 6, 0))")).cast("int")


def _classes(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` per size class, with ``before`` and ``rows``: the documents of
    the source in smaller classes, and in the class."""
    below = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    counts = sized.select("source", "class", F.col("n").alias("rows")) \
        .withColumn("before", F.coalesce(F.sum("rows").over(below), F.lit(0)))
    named = targets.withColumnRenamed("source", "of")
    return counts.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with its part in the mix:
    ``(doc struct, id, size, source_size, target, copies)``."""
    key = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("null:"), F.md5(docs[text_col])))
    sized = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
                        docs[id_col].alias("id"), docs[source_col].alias("source"),
                        word_count(docs[text_col]).alias("size"), key.alias("key")) \
        .withColumn("class", size_class(F.col("size")))
    counted = materialise(sized.groupBy("source", "class").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")),
                          "mix-sizes")
    targets = materialise(_classes(counted, source_targets(counted.select("source", "size"), weights)), "mix-targets")
    rows, size = targets.agg(F.count(F.lit(1)), F.sum(F.octet_length("source") + 64)).first()
    if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        targets = F.broadcast(targets)
    targets = targets.withColumnRenamed("source", "target_source").withColumnRenamed("class", "target_class")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    share = F.col("rate") - F.floor("rate")
    place = F.col("before") + F.floor(uniform(F.col("key"), seed) * F.col("rows"))
    start = uniform(F.col("source"), seed + ":start")
    extra = F.floor((F.col("place") + 1) * share + F.col("start")) - F.floor(F.col("place") * share + F.col("start"))
    same = F.col("source").eqNullSafe(F.col("target_source")) & (F.col("class") == F.col("target_class"))
    return sized.join(targets, same) \
        .withColumn("rate", rate).withColumn("place", place).withColumn("start", start) \
        .select("doc", "id", "size", "source_size", "target", (F.floor("rate") + extra).cast("int").alias("copies"))


def mix(docs: DataFrame, **columns) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    taken = mixed(docs, **columns).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")) \
        .select("doc.*")


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs``."""
    return mixed(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                              (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB: the targets filled source by source over a table of one row each,
#: the copies from the same seeded MD5.
ORACLE = rf"""
WITH sized AS (
  SELECT *, length(bin(size)) * 64 + (size >> greatest(length(bin(size)) - 6, 0)::INT) AS class
  FROM (SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents)),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
levels AS (
  -- the level at which a source stops, and what all would take at that level
  SELECT a.source, 3.0 * a.source_size / a.weight AS level,
         sum(least(3.0 * b.source_size, b.weight * (3.0 * a.source_size / a.weight))) AS taken
  FROM totals a, totals b GROUP BY a.source, a.source_size, a.weight),
goal AS (SELECT sum(source_size)::DOUBLE AS total FROM totals),
stopped AS (
  SELECT t.*, l.taken <= g.total AS stops FROM totals t
  JOIN levels l ON l.source IS NOT DISTINCT FROM t.source, goal g),
open AS (
  SELECT (SELECT total FROM goal) - coalesce(sum(3 * source_size) FILTER (WHERE stops), 0) AS words,
         sum(weight) FILTER (WHERE NOT stops) AS weights
  FROM stopped),
targets AS (
  SELECT source, source_size, CASE WHEN stops THEN (3 * source_size)::DOUBLE
         ELSE (weight * words)::DOUBLE / weights END AS target
  FROM stopped, open),
ranged AS (
  SELECT source, class, count(*) AS rows,
         coalesce(sum(count(*)) OVER (PARTITION BY source ORDER BY class
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized GROUP BY source, class),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         r.before + floor(('0x' || substr(md5('{SEED}:' || coalesce(s.doc_id::VARCHAR, 'null:' || md5(s.text), 'null')), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE * r.rows) AS place,
         ('0x' || substr(md5('{SEED}:start:' || coalesce(s.source, 'null')), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  JOIN ranged r ON r.source IS NOT DISTINCT FROM s.source AND r.class = s.class)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + floor((place + 1) * (rate - floor(rate)) + start)
         - floor(place * (rate - floor(rate)) + start))::BIGINT * size)::BIGINT AS taken
FROM rated
"""
