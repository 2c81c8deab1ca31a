"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh 2016).

For radius r, each of the 64 bits gets a non-zero vector of r + 1 bits; the table of each non-zero
vector v masks the fingerprints to the bits whose vector has odd overlap with v. Any r bits leave some v
without odd overlap, so every pair within the radius collides in some table. A bucket with
too many fingerprints is split by the same construction over the bits that its mask leaves free, again and again: each
time about half of them are left, and a bucket has no more fingerprints than two to the number of its free bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import HOT_SHARE, documents, join_skewed, stage, workspace

#: Distinct fingerprints compared with each other in a bucket; larger buckets are split further.
BUCKET = 4096

#: One in so many is looked at to find hot buckets.
SAMPLE = 64

#: Stands for all bits in a mask, and marks edges.
ALL = -1


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of a whole text's word shingles (ASCII lower case); 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(shingle, len(words))
    hash_, starts = xxhash.xxh64_intdigest, (ends - lengths)[: len(words) - k + 1].tolist()
    set_, n = np.zeros(64, dtype=np.int64), len(starts)
    stops = ends[k - 1 :].tolist()
    for i in range(0, n, 1 << 16):
        h = np.fromiter([hash_(whole[a:b], 42) for a, b in zip(starts[i : i + (1 << 16)], stops[i : i + (1 << 16)], strict=True)], dtype="<u8")
        set_ += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * set_ > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp) of each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            fps = pa.array(np.array(fps, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), fps], names=["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def masks(radius: int, bits: list[int]) -> list[int]:
    """Covering masks over these bit positions, as signed 64-bit numbers."""
    basis = [1 << i for i in range(radius + 1)]
    vectors = [*basis, *(v for v in range(1, 1 << radius + 1) if v not in basis)]  # as many bits as a basis has leave no mask empty
    out = []
    for v in sorted(vectors):
        mask = sum(1 << b for i, b in enumerate(bits) if (v & vectors[i % len(vectors)]).bit_count() & 1)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _keyed(rows: DataFrame) -> DataFrame:
    """(fp, used, key) of rows (fp, used): the bucket of fingerprints that agree in the bits of the mask ``used``."""
    return rows.select("fp", "used", F.xxhash64("used", F.col("fp").bitwiseAND(F.col("used"))).alias("key"))


def _tables(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, used) for each of the first masks."""
    first = F.array(*[F.lit(m).cast("long") for m in masks(radius, list(range(64)))])
    return distinct.select("fp", F.explode(first).alias("used"))


def _finer(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, used) for each mask of the bits that ``used`` leaves free of rows (fp, used); there are few different masks."""
    finer = []
    for r in rows.select("used").distinct().collect():
        free = [b for b in range(64) if not r.used >> b & 1]
        finer += [(r.used, r.used | m) for m in masks(radius, free)]
    table = rows.sparkSession.createDataFrame(finer, "used long, finer long")
    return rows.join(F.broadcast(table), "used").select("fp", F.col("finer").alias("used"))


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits of 64-bit numbers, signed or not; numpy counts those of a signed number's magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _cluster(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that chain the members of each set connected by distances within the radius."""
    rest, out = fps, []
    while len(rest) > 1:
        group, todo = [rest[0]], [rest[0]]
        rest = rest[1:]
        while todo and len(rest):
            near = _differing(rest, todo.pop()) <= radius
            found = rest[near]
            todo += list(found)
            group += list(found)
            rest = rest[~near]
        group.sort()
        out += list(zip(group[:-1], group[1:], strict=True))
    return out


def _buckets(rows: DataFrame, radius: int) -> DataFrame:
    """Edges (ALL, a, b) within the buckets of rows (fp, used, key), and the members (used, fp, null) of those too large.

    Where no more than ``radius`` bits are free, all members are linked, and no bucket is too large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), dtype=np.int64)
        over: int | None = None  # key of a bucket that is passed on

        def passed(x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 2]), pa.nulls(len(x), pa.int64())], names=["used", "a", "b"])

        def bucketed(x: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.diff(x[:, 1])) + 1
            starts, sizes = np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [len(x)]]))
            two = starts[sizes == 2]
            a, b = x[two, 2], x[two + 1, 2]
            near = _differing(a, b) <= radius
            edges = list(zip(a[near].tolist(), b[near].tolist(), strict=True))
            for i, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                edges += _cluster(x[i : i + n, 2].copy(), radius)
            e = np.array(edges, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(e), ALL)), pa.array(e[:, 0]), pa.array(e[:, 1])], names=["used", "a", "b"])

        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in ("used", "key", "fp")], axis=1).astype(np.int64)
            if over is not None:
                same = x[:, 1] == over
                yield passed(x[same])
                x = x[~same]
                if not len(x):
                    continue
                over = None
            x = np.concatenate([held, x])
            if not len(x):
                continue
            other = x[:, 1] != x[-1, 1]
            split = len(x) - int(np.argmax(other[::-1])) if other.any() else 0
            if split:
                whole = x[:split]
                sizes = np.unique(whole[:, 1], return_inverse=True, return_counts=True)
                large = (sizes[2][sizes[1]] > BUCKET) & (64 - np.bitwise_count(whole[:, 0].copy().view(np.uint64)).astype(int) > radius)
                yield passed(whole[large])
                if not large.all():
                    yield bucketed(whole[~large])
            held = x[split:]
            if len(held) > BUCKET and 64 - (int(held[0, 0]) & (1 << 64) - 1).bit_count() > radius:
                over = int(held[0, 1])
                yield passed(held)
                held = held[:0]
        if len(held):
            yield bucketed(held)

    return rows.select("used", "key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(run, "used long, a long, b long")


def links(distinct: DataFrame, radius: int, folder: str) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) that connect all within ``radius`` bits, without all pairs.

    Keys of buckets that a sample shows to be hot are split before they are shuffled, other large buckets after. The sample
    only chooses the way, never the result; at most SAMPLE * HOT_SHARE keys can be above the bound, as each takes one in so
    many of all rows.
    """
    tables = len(masks(radius, list(range(64))))
    rows = _keyed(_tables(distinct, radius))
    seen = _keyed(_tables(distinct.where(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(SAMPLE)) == 0), radius)).groupBy("key").count()
    most = max(BUCKET, distinct.count() * tables // HOT_SHARE)
    hot = [r.key for r in seen.where(F.col("count") > most // SAMPLE).select("key").collect()]
    hot = distinct.sparkSession.createDataFrame([(k,) for k in hot], "key long").withColumn("hot", F.lit(True))
    rows = rows.join(F.broadcast(hot), "key", "left")
    level = 1
    found = stage(_buckets(rows.where("hot is null"), radius), f"{folder}/level-{level}")
    edges = found.where("b is not null").select("a", "b")
    again = rows.where("hot").select("fp", "used").union(found.where("b is null").select("a", "used"))
    while again.limit(1).count():
        level += 1
        found = stage(_buckets(_keyed(_finer(again, radius)), radius), f"{folder}/level-{level}")
        edges = edges.union(found.where("b is not null").select("a", "b"))
        again = found.where("b is null").select(F.col("a").alias("fp"), "used")
    return edges


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id) for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id among the rows whose fingerprints can be reached over links of at
    most ``radius`` differing bits, itself included; rows without doc_id never give it. Null, empty and blank
    texts have fingerprint 0, linked like any other; a text of fewer words than a shingle is one shingle.
    Repeated rows come back repeated. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "simhash")
    each = stage(fingerprints(docs, shingle), f"{folder}/each")
    total = each.count()
    distinct = stage(each.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), f"{folder}/distinct")
    edges = stage(links(distinct.select("fp"), radius, folder), f"{folder}/links")
    label = components(edges, f"{folder}/components")
    distinct = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp").cast("string"))
    distinct = stage(distinct, f"{folder}/labelled")
    least = distinct.groupBy("label").agg(F.min("first").alias("component_id"), F.count("*").alias("fps"))
    classes = join_skewed(distinct, least, "label", "fps", total, F.col("fp"))
    classes = stage(classes.select(F.col("fp").cast("string").alias("key"), "component_id", "rows"), f"{folder}/classes")
    out = join_skewed(each.withColumn("key", F.col("fp").cast("string")), classes, "key", "rows", total, F.monotonically_increasing_id())
    return out.select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
