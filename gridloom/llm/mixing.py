"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame operations only.

Golden-ratio points are mapped through the cumulative weights of the sources, which deals slots to
sources evenly at every stretch of the schedule. A source's documents stand in shuffled order as one
stream of words, cut into blocks of equal length; its r-th slot takes its r-th block, and the stream starts
again when it ends. The last block is cut where the source's target is met.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import before, documents, join_small, stage, text_key, workspace

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)

#: Words in a block.
BLOCK = 1024

#: Documents that share a range of the shuffled order, on average.
RANGE = 64

#: Cells of the unit interval by which points find their source.
CELLS = 4096

#: Share of all words that the mix takes, and times that a source may be taken.
SHARE, MOST = 1.5, 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size, target, take, slots, low, high) for each source of (key, size).

    A source is capped when the rate at which the uncapped ones share exceeds its own; sources ordered by
    that rate make this one running sum. One row a source goes through one task, so sources may be millions at most.
    Sources whose texts are all blank have target 0 and no slots.
    """
    by = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy((F.col("key") == "n").cast("int"), "key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    by = by.withColumn("w", weight).withColumn("cap", F.lit(float(MOST)) * F.col("source_size"))
    by = by.withColumn("own", F.col("cap") / F.col("w"))
    order = Window.orderBy("own", "key")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    all_ = F.sum("source_size").over(Window.partitionBy()) * SHARE
    rate = (all_ - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("w").over(later)
    by = by.withColumn("rate", rate).withColumn("free", F.col("rate") < F.col("own"))
    first = F.min(F.when(F.col("free"), F.struct("own", "key", "rate"))).over(Window.partitionBy())
    by = by.withColumn("first", first)
    free = F.col("first").isNotNull() & (F.struct("own", "key") >= F.struct("first.own", "first.key"))
    by = by.withColumn("target", F.when(free, F.col("first.rate") * F.col("w")).otherwise(F.col("cap")))
    by = by.withColumn("take", F.least(F.floor(F.col("target") + 0.5), F.lit(MOST) * F.col("source_size")).cast("long"))
    by = by.withColumn("slots", F.ceil(F.col("take") / F.lit(BLOCK)).cast("long"))
    n, up_to = F.sum("slots").over(Window.partitionBy()), F.sum("slots").over(Window.orderBy("key"))
    return by.select("key", "source_size", "target", "take", "slots", F.try_divide(up_to - F.col("slots"), n).alias("low"), F.try_divide(up_to, n).alias("high"))


def golden(j: Column) -> Column:
    """Fractional part of j times the golden ratio, for long j; in two parts, which keeps it precise."""
    ratio = Fraction(1134903170, 1836311903)  # consecutive Fibonacci numbers
    high, low = F.floor(j / F.lit(1 << 20)).cast("double"), (j % F.lit(1 << 20)).cast("double")
    x = high * float(ratio * (1 << 20) % 1)
    y = low * float(ratio)
    z = x - F.floor(x) + y - F.floor(y)
    return z - F.floor(z)


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """(slot, key, rank): each source's slots in order, as many as it needs.

    Points beyond a source's need are left out; what discrepancy leaves short stands behind the last point.
    """
    spark = sources.sparkSession
    wanted = sources.where("slots > 0").select("key", "slots", "low", "high")
    cells = wanted.select("*", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1).cast("long")))).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), golden(F.col("id") + 1).alias("u")).withColumn("cell", F.floor(F.col("u") * CELLS))
    dealt = join_small(points, cells, ["cell"], "inner").where("u >= low and u < high").select("slot", "key", "slots", F.lit(1).cast("long").alias("one"))
    ranked = before(dealt, ["key"], "slot", "one", max(slots, 1), "rank").where("rank < slots").select("slot", "key", "rank")
    held = dealt.groupBy("key").agg(F.sum("one").alias("held"))
    short = wanted.join(held, "key", "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long"))).where("held < slots")
    short = short.select("key", F.explode(F.sequence(F.col("held"), F.col("slots") - 1)).alias("rank"))
    return ranked.union(short.select(F.lit(slots).cast("long") + F.col("rank"), "key", "rank"))


def mix(docs: DataFrame, folder: str, seed: str = "mix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sources, pieces) of the mix of ``docs`` (doc_id, text, source).

    documents: key, range, number (unique with key and range), doc_id, text_hash, size, at; sources as in
    ``targets``; pieces: slot, key, rank, range, number, epoch, from_word, words: what each block takes of
    each document. Null sources are one source, ordered last; null and blank texts have size 0 and no piece.
    The order is that of a hash of doc_id and text, so rows that share a doc_id, or have none, are spread like others; rows
    that repeat both are documents of their own next to each other. Reruns agree.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("source").alias("key"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"), order.alias("h"))
    rows = stage(rows, f"{folder}/sizes")
    n = rows.count()
    ranges = max(1, n // RANGE)
    rows = rows.withColumn("range", F.floor(F.conv(F.substring("h", 1, 12), 16, 10).cast("double") / float(1 << 48) * ranges).cast("long"))
    sources = stage(targets(rows), f"{folder}/sources")
    part = Window.partitionBy("key", "range").orderBy("h", "size", "text_hash")
    inside = F.coalesce(F.sum("size").over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    numbered = rows.withColumn("inside", inside).withColumn("number", F.row_number().over(part))
    base = before(rows.groupBy("key", "range").agg(F.sum("size").alias("n")), ["key"], "range", "n", ranges, "base").select("key", "range", "base")
    placed = numbered.join(base, ["key", "range"]).withColumn("at", F.col("base") + F.col("inside"))
    placed = stage(placed.select("key", "range", "number", "doc_id", "text_hash", "size", "at"), f"{folder}/placed")
    slots = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    each = join_small(placed.where("size > 0"), sources.select("key", "source_size", "take"), ["key"], "inner")
    each = each.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(MOST - 1).cast("long"))).alias("epoch"))
    each = each.withColumn("at", F.col("at") + F.col("epoch") * F.col("source_size")).withColumn("end", F.least(F.col("at") + F.col("size"), F.col("take"))).where("at < end")
    each = each.select("*", F.explode(F.sequence(F.floor(F.col("at") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))).alias("rank"))
    start = F.greatest(F.col("at"), F.col("rank") * BLOCK)
    each = each.withColumn("from_word", start - F.col("at")).withColumn("words", F.least(F.col("end"), (F.col("rank") + 1) * BLOCK) - start)
    pieces = each.join(schedule(sources, slots), ["key", "rank"])
    return placed, sources, pieces.select("slot", "key", "rank", "range", "number", "epoch", "from_word", "words")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, sources, pieces = mix(documents(spark, sf_dir), workspace(spark, "mixing"))
    zero = F.lit(0).cast("long")
    rows = docs.select("key", "range", "number", "doc_id", "size", zero.alias("words")).union(pieces.select("key", "range", "number", F.lit(None).cast("long"), zero, "words"))
    rows = rows.groupBy("key", "range", "number").agg(F.max("doc_id").alias("doc_id"), F.max("size").alias("size"), F.sum("words").alias("taken"))
    rows = join_small(rows, sources.select("key", "source_size", "target"), ["key"], "inner")
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it: once for each pass that takes most of its words.

    Each partition has its rows in the order of the slots where a pass begins to take them. Documents are dealt to partitions by
    hash, so each partition is a sample that follows the schedule, and texts are shuffled once only. Rows that
    repeat doc_id, source and text are all taken by a pass that takes at least half of them. Blank texts are in no pass.
    """
    folder = workspace(docs.sparkSession, "mixing")
    placed, _, pieces = mix(docs, folder)
    passes = pieces.groupBy("key", "range", "number", "epoch").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
    most = placed.join(passes, ["key", "range", "number"], "left").withColumn("most", 2 * F.col("words") > F.col("size"))
    epochs = [F.struct((2 * F.count_if(F.col("most") & (F.col("epoch") == e)) >= F.countDistinct("range", "number")).alias("in"), F.min(F.when(F.col("most") & (F.col("epoch") == e), F.col("slot"))).alias("slot")) for e in range(MOST)]
    taken = most.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("key").alias("_key"), F.col("text_hash").alias("_hash")).agg(F.array(*epochs).alias("epochs"))
    taken = taken.select("_id", "_key", "_hash", F.transform(F.filter("epochs", lambda e: e["in"]), lambda e: e.slot).alias("_slots")).where(F.size("_slots") > 0)
    keyed = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), text_key("source").alias("_key"), F.xxhash64("text").alias("_hash"))
    each = keyed.join(taken, ["_id", "_key", "_hash"]).select("_row", F.explode("_slots").alias("_slot"))
    return each.sortWithinPartitions("_slot").select("_row.*")


#: The closed form of what the schedule takes: passes over each source's shuffled stream up to its target.
ORACLE = r"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS h FROM documents),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM d),
s AS (SELECT k, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY k = 'n', k) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY k),
r AS (SELECT *, 2 * source_size / w AS own,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2 * source_size / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2 * source_size / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM s),
f AS (SELECT own AS o, k AS fk, rate AS rate1 FROM r WHERE rate < own ORDER BY own, k LIMIT 1),
t AS (SELECT k, source_size, CASE WHEN o IS NOT NULL AND (own, k) >= (o, fk) THEN rate1 * w ELSE 2.0::DOUBLE * source_size END AS target FROM r LEFT JOIN f ON true),
u AS (SELECT *, least(floor(target + 0.5)::BIGINT, 2 * source_size) AS take FROM t)
SELECT doc_id, size, source_size, target,
    (greatest(0, least(a + size, take) - a) + greatest(0, least(a + source_size + size, take) - a - source_size))::BIGINT AS taken
FROM p JOIN u USING (k)
"""
