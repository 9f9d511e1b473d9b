"""Exact top-k inner products by a three-phase uniform threshold.

A vector's score is the sum of m partial scores, one for each block of dimensions. Phase 1 gathers, from each task, the
rows of its highest partial scores, with their sums; the k-th highest sum of a query is a cutoff that no result is below.
Phase 2 broadcasts it: a row can reach the cutoff only if one of its partial scores reaches a m-th of it, so just these
are collected. Phase 3 resolves them: exact sums, those below the cutoff dropped, the k best of each task and then of all.
Queries are broadcast in chunks of bounded size; each chunk reads the table twice, and its result is a table before the next
chunk's queries take its place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .near_vectors import usable

#: Bytes of the queries of one broadcast; queries and rows scored at once; dimension blocks.
CHUNK_BYTES, QUERIES, ROWS, PARTS = 16 << 20, 2048, 2048, 4


def integers(col: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles (exact below 2**53), equally long lists only."""
    x = col.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(scale * x).reshape(len(col), -1)


def product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of integers: by doubles where each sum is below 2**53, by 64-bit integers otherwise."""
    if not q.size or not v.size or np.abs(q).max() * np.abs(v).max() * q.shape[1] < 2.0**53:
        return (q @ v.T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of a row of scores, ties to the smaller id."""
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def best_of(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(df: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, parts: int = PARTS, chunk: int | None = None) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k highest integer inner products of each query, all if there are fewer.

    queries and df: vec_id, embedding. Components count as floor(scale * x). A query is compared with every row of another
    vec_id whose vector is equally long. Vectors that are null or empty or hold null or non-finite components, and rows
    without vec_id, take no part. Repeated rows are rows of their own; sums beyond 64 bits wrap. Empty tables give no rows.
    """
    spark = df.sparkSession
    tables = common.Tables(spark)
    rows, queries = (usable(x.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec")).where("vec_id is not null"), "vec") for x in (df, queries))
    n, longest = queries.agg(F.count("*"), F.max(F.size("vec"))).first()
    chunks = -(-n // (chunk or max(1, CHUNK_BYTES // (8 * (longest or 1)))))
    out = None
    for c in range(chunks):
        mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c)
        sets: dict[int, tuple] = {}
        got = mine.toArrow()  # at most about `chunk` vectors
        lengths = pc.list_value_length(got.column("vec"))
        for dim in pc.unique(lengths).to_pylist():
            part = got.filter(pc.equal(lengths, dim)).combine_chunks()
            sets[dim] = (part.column("vec_id").to_numpy(), integers(part.column("vec").combine_chunks(), scale))
        shared = spark.sparkContext.broadcast(sets)

        def scored(batches, shared=shared):
            """(query ids, row ids, partial scores by block) of up to ROWS rows at once."""
            for b in batches:
                lengths = pc.list_value_length(b.column(1)).to_numpy()
                for dim in np.unique(lengths):
                    if int(dim) not in shared.value:
                        continue
                    q_ids, q = shared.value[int(dim)]
                    part = b.filter(pa.array(lengths == dim))
                    ids, v = part.column(0).to_numpy(), integers(part.column(1), scale)
                    cuts = np.linspace(0, dim, min(parts, dim) + 1).astype(int)
                    for at in range(0, len(ids), ROWS):
                        for of in range(0, len(q_ids), QUERIES):
                            yield q_ids[of : of + QUERIES], ids[at : at + ROWS], [product(q[of : of + QUERIES, a:z], v[at : at + ROWS, a:z]) for a, z in zip(cuts[:-1], cuts[1:])]

        def keep(found, q_id, score, ids):
            if q_id in found:
                score, ids = np.concatenate([found[q_id][0], score]), np.concatenate([found[q_id][1], ids])
            at = best(score, ids, k)
            found[q_id] = (score[at], ids[at])

        def emit(found):
            rows = [(q, v, s) for q, (score, ids) in found.items() for v, s in zip(ids.tolist(), score.tolist())]
            yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

        def gather(batches):
            found: dict = {}
            for q_ids, ids, partial in scored(batches):
                total = sum(partial)
                for i, q_id in enumerate(q_ids.tolist()):
                    at = np.unique(np.concatenate([best(p[i], ids, k + 1) for p in partial]))
                    at = at[ids[at] != q_id]
                    keep(found, q_id, total[i, at], ids[at])
            yield from emit(found)

        schema = "query_id bigint, vec_id bigint, score bigint"
        lists = rows.mapInArrow(gather, schema)
        ranked = lists.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        cutoff = spark.sparkContext.broadcast({r.query_id: r.score for r in ranked.where(F.col("r") == k).select("query_id", "score").collect()})

        def resolve(batches, cutoff=cutoff):
            found: dict = {}
            low = -(1 << 62)
            for q_ids, ids, partial in scored(batches):
                cut = np.array([cutoff.value.get(q, low) for q in q_ids.tolist()])
                share = cut // len(partial)  # at most a m-th of the cutoff
                enough = np.zeros(partial[0].shape, bool)
                for p in partial:
                    enough |= p >= share[:, None]
                for i in np.flatnonzero(enough.any(axis=1)).tolist():
                    at = np.flatnonzero(enough[i])
                    total = sum(p[i, at] for p in partial)
                    ok = (total >= cut[i]) & (ids[at] != q_ids[i])
                    if ok.any():
                        keep(found, int(q_ids[i]), total[ok], ids[at][ok])
            yield from emit(found)

        part = best_of(rows.mapInArrow(resolve, schema), k) if chunks == 1 else tables.write(best_of(rows.mapInArrow(resolve, schema), k))
        if chunks > 1:
            shared.destroy()
            cutoff.destroy()
        out = part if out is None else out.union(part)
    if out is None:
        out = best_of(rows.where("false").select(F.col("vec_id").alias("query_id"), "vec_id", F.col("vec_id").alias("score")), k)
    return out
