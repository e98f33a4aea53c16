"""Operator 5: nearest neighbours by inner product with a permutation index.

A few vectors are pivots. Each vector is known by the order in which it sees the pivots,
nearest first. The index holds, for every block of vectors, a file for each pivot: the
position that the pivot has in each vector's order. A query's own order is held against the
files: the footrule distance of two orders is the sum of the differences of positions. The
nearest ``SHARE`` of a block by footrule, with all that tie with the last of them, and however
many see the pivots almost as the query does (``TIGHT`` of the mean footrule of two random
orders: a dense group of any size), are reranked by the exact inner product in double precision.

Inner products are made into distances first: every vector gets one more component that
brings it to the greatest norm M there is, and a query gets 0 there, so the nearest vectors
are those with the largest inner product.

``PIVOTS`` vectors of each dimension are the pivots: of a bounded sample (``SAMPLE`` distinct
vectors, by hash) each next one is the one farthest from those chosen, so a dense group gives
few. Every row is indexed. Blocks are formed by hash and hold about ``BLOCK`` vectors; each block
of queries meets each block of vectors, and a task merges what its blocks find before
anything is shuffled, so no pair of a query and a vector ever becomes a row but the best ones.

Edge cases: rows with a null id, and vectors that are null, empty, zero or hold null or
non-finite components take no part; repeated rows count once; a query meets vectors of its
own dimension alone, and never its own id; ties go to the smaller id; an empty table, or one
without queries, gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import stored, tidy

PIVOTS, SAMPLE, SHARE, TIGHT, LEAST = 128, 2048, 0.15, 0.2, 64
BLOCK, QUERY_BLOCK = 4096, 1024


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (array<double>), dim and norm of the rows that take part, each once."""
    v = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where((F.size("vector") > 0) & ~bad)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    return v.distinct().select("vec_id", "vector", F.size("vector").alias("dim"), norm.alias("norm")).where(F.exists("vector", lambda x: x != 0))


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` vectors of a sample, each the farthest (by direction) from those before it."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return sample[chosen]


def _orders(vectors: np.ndarray, last: np.ndarray, pivots: np.ndarray, pivots_last: np.ndarray) -> np.ndarray:
    """Position of each pivot (column) in each vector's (row's) order, nearest first."""
    near = vectors @ pivots.T + np.outer(last, pivots_last)
    order = np.argsort(-near, axis=1, kind="stable")
    out = np.empty(order.shape, np.uint8)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.uint8)[None, :], axis=1)
    return out


def _blocks(rows: DataFrame, pivots: dict[int, np.ndarray], greatest: dict[int, float], queries: bool) -> DataFrame:
    """A row for each (dim, block): ids, vectors and, pivot after pivot, positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(key, ids, vectors):
            dim, number = key
            x, m, p = np.array(vectors), greatest[dim], pivots[dim]
            rest = lambda a: np.sqrt(np.maximum(m * m - (a * a).sum(axis=1), 0))
            files = np.ascontiguousarray(_orders(x, np.zeros(len(x)) if queries else rest(x), p, rest(p)).T)
            columns = [pa.array([dim], pa.int32()), pa.array([number], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()), pa.array([files.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["dim", "block", "ids", "vectors", "files"])

        key, ids, vectors = None, [], []
        for batch in batches:
            for dim, number, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (dim, number) != key:
                    if ids:
                        yield block(key, ids, vectors)
                    key, ids, vectors = (dim, number), [], []
                ids.append(i)
                vectors.append(v)
        if ids:
            yield block(key, ids, vectors)

    dealt = rows.repartition(F.col("dim"), F.col("block")).sortWithinPartitions("dim", "block", "vec_id")
    return dealt.select("dim", "block", "vec_id", "vector").mapInArrow(tidy(run), "dim int, block int, ids array<long>, vectors binary, files binary")


def footrule(query_files: np.ndarray, files: np.ndarray) -> np.ndarray:
    """Sums over the pivots (rows) of the differences of positions, for each query and vector."""
    total = np.zeros((query_files.shape[1], files.shape[1]), np.uint16)
    for a in range(0, len(files), 2):
        # positions are below 128, so the differences of two pivots fit into a byte together
        part = np.zeros(total.shape, np.uint8)
        for p in range(a, min(a + 2, len(files))):
            x, y = files[p][None, :], query_files[p][:, None]
            part += np.maximum(x, y) - np.minimum(x, y)
        total += part
    return total


def _best(query_ids, queries, query_files, ids, vectors, files, k):
    """Each query's k best of a block: (query, ids, scores), best first."""
    n = len(ids)
    take = min(n, max(LEAST, k + 1, math.ceil(SHARE * n)))
    tight = int(TIGHT * (len(files) ** 2 - 1) / 3)
    for a in range(0, len(query_ids), 128):
        far = footrule(query_files[:, a : a + 128], files)
        bound = np.maximum(np.partition(far, take - 1, axis=1)[:, take - 1], tight)
        for r in range(len(far)):
            near = np.flatnonzero(far[r] <= bound[r])
            near = near[ids[near] != query_ids[a + r]]
            score = (vectors[near] * queries[a + r]).sum(axis=1)
            if len(near) > 4 * k:
                enough = score >= np.partition(score, len(score) - k)[len(score) - k]
                near, score = near[enough], score[enough]
            order = np.lexsort((ids[near], -score))[:k]
            yield a + r, ids[near[order]], score[order]


def search(table: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each row for which ``is_query`` (of vec_id) holds."""
    spark = table.sparkSession
    rows = stored(usable(table, id_col, vector_col), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kinds = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("m"), F.count(F.when(is_query, 1)).alias("queries")).where("queries > 0").collect()
    if not kinds:
        return empty
    greatest = {r["dim"]: r["m"] for r in kinds}
    pivots = {}
    for dim in greatest:
        # copies of a vector are one pivot
        some = rows.where(F.col("dim") == dim).groupBy("vector").agg(F.min(F.xxhash64("vec_id")).alias("h")).orderBy("h").limit(SAMPLE).collect()
        pivots[dim] = spread(np.array([r["vector"] for r in some]), PIVOTS)
    sizes = F.create_map(*[F.lit(x) for r in kinds for x in (r["dim"], math.ceil(r["n"] / BLOCK))])
    query_sizes = F.create_map(*[F.lit(x) for r in kinds for x in (r["dim"], math.ceil(r["queries"] / QUERY_BLOCK))])
    here = rows.where(F.col("dim").isin(list(greatest)))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.col("n")).cast("int").alias("block")
    index = stored(_blocks(here.withColumn("n", sizes[F.col("dim")]).select("dim", deal("n"), "vec_id", "vector"), pivots, greatest, False), "index")
    asked = stored(_blocks(here.where(is_query).withColumn("n", query_sizes[F.col("dim")]).select("dim", deal("n"), "vec_id", "vector"), pivots, greatest, True), "queries")
    every = F.explode(F.sequence(F.lit(0), sizes[F.col("dim")] - 1))
    sent = asked.select("dim", F.col("block").alias("part"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("files").alias("q_files"), every.alias("block"))
    met = sent.join(index, ["dim", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        names: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, part, q_ids, q_vectors, q_files, ids, vectors, files in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                q_ids, ids = np.array(q_ids), np.array(ids)
                shape = lambda raw, n: np.frombuffer(raw, np.uint8).reshape(-1, n)
                best = found.setdefault((dim, part), [(np.zeros(0, np.int64), np.zeros(0))] * len(q_ids))
                names[dim, part] = q_ids
                for q, i, s in _best(q_ids, np.frombuffer(q_vectors).reshape(-1, dim), shape(q_files, len(q_ids)), ids, np.frombuffer(vectors).reshape(-1, dim), shape(files, len(ids)), k):
                    i, s = np.concatenate([best[q][0], i]), np.concatenate([best[q][1], s])
                    order = np.lexsort((i, -s))[:k]
                    best[q] = (i[order], s[order])
        for key, best in found.items():
            lengths = [len(i) for i, _ in best]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(names[key], lengths), pa.int64()), pa.array(np.concatenate([i for i, _ in best]), pa.int64()),
                pa.array(np.concatenate([s for _, s in best]), pa.float64())], names=["query_id", "vec_id", "score"])

    each = met.select("dim", "part", "q_ids", "q_vectors", "q_files", "ids", "vectors", "files").mapInArrow(tidy(run), "query_id long, vec_id long, score double")
    # repeated ids: of a vec_id's vectors the best counts
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
