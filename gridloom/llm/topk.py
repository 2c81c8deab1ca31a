"""Exact top-k search: tiled products of queries and shards, partial selection, tree merging.

Candidates are dealt to shards and queries to blocks, both of bounded size by count. Every block travels to every
shard as one packed row, behind the shard's vectors; a task holds one shard and one block, multiplies
them tile by tile, and keeps each query's best of the tile. Lists are merged in a tree of bounded fan-in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stage, workspace

#: Vectors in a shard and queries in a block, on average; rows of a tile; lists merged at once.
SHARD, BLOCK, TILE, FAN = 8192, 1024, 2048, 16


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, x) of rows with an id and a vector whose components are all finite; x are doubles."""
    x = F.col(vector_column).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x"), F.coalesce(finite, F.lit(False)).alias("ok"))
    return rows.where("ok and vec_id is not null").select("vec_id", "x")


def _bound(q: np.ndarray) -> float:
    return float(np.abs(q).max(initial=0))


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products as longs, from rows of integral doubles; beyond the range of long the nearest long."""
    most = max(1.0, queries.shape[1] * _bound(queries) * _bound(shard))
    if most < 1 << 24:
        return (queries.astype(np.float32) @ shard.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (queries @ shard.T).astype(np.int64)
    whole = lambda a: np.array([[int(v) for v in r] for r in a], dtype=object).reshape(a.shape)
    exact = whole(queries) @ whole(shard).T if queries.shape[1] else np.zeros((len(queries), len(shard)), dtype=object)
    return np.array([[min(max(int(v), -(1 << 63)), (1 << 63) - 1) for v in r] for r in exact], dtype=np.int64).reshape(len(queries), len(shard))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` highest scores, ties to the smaller id; ``ids`` ascend."""
    n = scores.shape[1]
    if n <= k:
        rows, columns = np.indices(scores.shape)
        return rows.ravel(), columns.ravel()
    if np.abs(scores.astype(float)).max(initial=0) * n < 1 << 52:  # one key for score and place
        top = np.argpartition(scores * n + np.arange(n - 1, -1, -1), n - k, axis=1)[:, n - k :]
    else:
        top = np.argsort(-scores.astype(object) if scores.min() == -(1 << 63) else -scores, axis=1, kind="stable")[:, :k]
    return np.repeat(np.arange(len(scores)), k), top.ravel()


def _pack(rows: DataFrame, block: int) -> DataFrame:
    """Blocks (block, dim, ids, data) of vectors of one dimension, as packed longs and doubles."""
    n = rows.count()
    dealt = rows.select("vec_id", "x", F.size("x").alias("dim"), F.pmod(F.xxhash64("vec_id", "x"), F.lit(max(1, -(-n // block)))).alias("block"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy().astype("<i8")
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8")
        return pa.table({"block": [key[0].as_py()], "dim": [key[1].as_py()], "ids": [ids.tobytes()], "data": [x.tobytes()]}, schema=pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())]))

    return dealt.groupBy("block", "dim").applyInArrow(run, "block long, dim int, ids binary, data binary")


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` candidates of highest inner product, fewer if there are fewer.

    Both tables are (vec_id, x) with integral doubles x. A row with the query's own id isn't its candidate, nor is a
    vector of another length. Ties go to the smaller vec_id. Repeated rows each take a rank, and a query
    id that repeats is answered for all its vectors together.
    """
    spark = candidates.sparkSession
    folder = workspace(spark, "topk")
    shards = max(1, -(-candidates.count() // SHARD))
    blocks = stage(_pack(queries, BLOCK), f"{folder}/blocks")
    none, binary = F.lit(None).cast("array<double>"), F.lit(None).cast("binary")
    a = candidates.select(F.pmod(F.xxhash64("vec_id", "x", F.lit(1)), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), F.size("x").alias("dim"), "vec_id", "x", binary.alias("ids"), binary.alias("data"))
    b = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "dim", F.lit(None).cast("long").alias("vec_id"), none.alias("x"), "ids", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        ids: list[np.ndarray] = []
        data: list[np.ndarray] = []
        own: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            shard, kind, dim = (batch.column(c).to_numpy() for c in ("shard", "kind", "dim"))
            cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0) | (np.diff(dim) != 0)) + 1
            for i, j in zip([0, *cut], [*cut, len(batch)], strict=True):
                if i == j:
                    continue
                if at != (shard[i], dim[i]):
                    at, ids, data, own = (shard[i], dim[i]), [], [], None
                part = batch.slice(i, j - i)
                if kind[i] == 0:
                    ids.append(part.column("vec_id").to_numpy())
                    data.append(part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(j - i, at[1]))
                    continue
                if own is None:
                    if not ids:
                        continue
                    all_ids = np.concatenate(ids)
                    order = np.argsort(all_ids, kind="stable")
                    own = all_ids[order], np.concatenate(data)[order]
                for row in part.to_pylist():
                    q = np.frombuffer(row["ids"], dtype="<i8")
                    x = np.frombuffer(row["data"], dtype="<f8").reshape(len(q), at[1])
                    for s in range(0, len(own[0]), TILE):
                        yield tile(int(at[0]), q, x, own[0][s : s + TILE], own[1][s : s + TILE])

    def tile(shard: int, q: np.ndarray, x: np.ndarray, ids: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        scores = products(x, y)
        # each id's rows in the tile could be the query's own: keep as many more, then drop them
        most = int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 0
        r, c = best(scores, ids, k + (most if np.isin(q, ids).any() else 0))
        keep = q[r] != ids[c]
        r, c = r[keep], c[keep]
        s = scores[r, c]
        order = np.lexsort((ids[c], -s.astype(float) if len(s) and s.min() == -(1 << 63) else -s, r))
        r, c, s = r[order], c[order], s[order]
        first = np.searchsorted(r, r)
        keep = np.arange(len(r)) - first < k
        r, c, s = r[keep], c[keep], s[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(r), shard)), pa.array(q[r]), pa.array(ids[c]), pa.array(s)], names=["shard", "query_id", "vec_id", "score"])

    dealt = a.union(b).repartition(min(shards, 10_000), "shard").sortWithinPartitions("shard", "dim", "kind")
    lists = dealt.mapInArrow(run, "shard long, query_id long, vec_id long, score long")
    entry = F.struct(F.expr("-cast(score as decimal(20,0))").alias("o"), "vec_id", "score")
    merged = lists.groupBy("query_id", "shard").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("top"))
    while shards > 1:
        shards = -(-shards // FAN)
        merged = merged.groupBy("query_id", F.expr(f"shard div {FAN}").alias("shard")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return merged.select("query_id", F.posexplode("top").alias("p", "e")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "e.vec_id", "e.score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    rows = rows.select("vec_id", F.transform("x", lambda v: F.floor(v * 256).cast("double")).alias("x"))
    return top_k(rows.where("vec_id % 50 = 0"), rows, 5)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
