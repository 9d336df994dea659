"""Nearest neighbours by inner product: p-stable hashing with multiprobe search.

A vector is hashed to the cells of a few random projections, in several tables. A query visits the
buckets of each table in the order of their estimated success: the squared distances from the
query's projections to the borders that a bucket lies beyond, added up, least first, until a share of
the rows has been seen. What the tables give is merged, and the inner products themselves rank it.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2), M the largest norm. A
query is scaled to norm M for the order of the buckets (the order of its inner products stays the
same); a shorter one would lie near the middle of all rows and tell buckets apart by little.
Rows are dealt evenly to shards of bounded size, each with its own tables, so equal vectors never
crowd one task; queries visit every shard in groups of bounded size, and a shard answers with its
nearest few. For hashing, and for the rough scores that come before those in double precision, vectors
are scaled by a power of two to a largest norm from 1 to 2, so any finite vectors will do.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import written

#: Width in units of the largest norm. With these, isotropic vectors (the hardest case) keep a recall over 0.9.
TABLES, PROJECTIONS, WIDTH = 5, 10, 2.5
SHARE = 0.22


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), np.float64).reshape(-1, dim)


class Tables:
    """The hash tables of one shard."""

    def __init__(self, x: np.ndarray, largest: float, tables: int, projections: int, width: float, seed: int) -> None:
        rng = np.random.default_rng(seed)
        dim = x.shape[1]
        self.width = width * largest
        self.a = rng.normal(size=(tables, dim + 1, projections))
        self.b = rng.uniform(0, self.width, (tables, projections))
        more = np.sqrt(np.maximum(largest**2 - (x * x).sum(1), 0))
        self.cells, self.bucket, self.rows = [], [], []
        for a, b in zip(self.a, self.b, strict=True):
            h = np.floor((x @ a[:dim] + more[:, None] * a[dim] + b) / self.width).astype(np.int64)
            cells, bucket, n = np.unique(h, axis=0, return_inverse=True, return_counts=True)
            self.cells.append(cells)
            self.bucket.append(bucket.reshape(-1))
            self.rows.append(n)

    def candidates(self, q: np.ndarray, share: float, least: int) -> np.ndarray:
        """seen[i, k]: query i visits a bucket with row k in some table."""
        seen = np.zeros((len(q), len(self.bucket[0])), bool)
        for a, b, cells, bucket, n in zip(self.a, self.b, self.cells, self.bucket, self.rows, strict=True):
            f = q @ a[:-1] + b
            low = cells * self.width
            beyond = np.zeros((len(q), len(cells)))
            for j in range(f.shape[1]):
                at = f[:, j : j + 1]
                beyond += np.maximum(np.maximum(low[None, :, j] - at, at - low[None, :, j] - self.width), 0) ** 2
            order = beyond.argsort(1)
            total = n[order].cumsum(1)
            # the bucket that passes the share is visited whole; a shard of few rows is seen in full
            visit = total - n[order] < max(share * len(bucket), least)
            chosen = np.zeros(beyond.shape, bool)
            np.put_along_axis(chosen, order, visit, 1)
            seen |= chosen[:, bucket]
        return seen


def nearest(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


#: Largest norms (as powers of two) of which no product of two components overflows or vanishes: there rough
#: scores can tell which rows are not among the nearest.
PLAIN = (-400, 500)


def search_shard(k: int, log_norm: dict[int, float], tables: int, projections: int, width: float, share: float, seed: int):
    """log_norm: the largest norm of each dimension as a power of two."""

    def fn(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "ids": [], "scores": []}
        if rows.num_rows and queries.num_rows:
            dim = rows["dim"][0].as_py()
            x, ids = matrix(rows["v"], dim), rows["id"].to_numpy()
            q, qids = matrix(queries["v"], dim), queries["id"].to_numpy()
            exponent = int(np.floor(log_norm[dim]))
            largest = 2.0 ** (log_norm[dim] - exponent)
            near = np.ldexp(x, -exponent)
            index = Tables(near, largest, tables, projections, width, seed)
            short = near.astype(np.float32)
            scaled = q / np.abs(q).max(1, keepdims=True)  # squares of very small components are zero
            scaled *= largest / np.sqrt((scaled * scaled).sum(1, keepdims=True))
            for at in range(0, len(q), 128):
                part, order = q[at : at + 128], scaled[at : at + 128]
                for i, seen in enumerate(index.candidates(order, share, k + 1)):
                    some = np.flatnonzero(seen & (ids != qids[at + i]))
                    if len(some) > k and PLAIN[0] < exponent < PLAIN[1] and np.abs(part[i]).max() > 2.0 ** PLAIN[0]:
                        rough = short[some] @ order[i].astype(np.float32)
                        edge = np.partition(rough, len(some) - k)[len(some) - k]
                        some = some[rough >= edge - 1e-4 * largest**2]
                    with np.errstate(all="ignore"):
                        score = (x[some] * part[i]).sum(1) + 0.0  # row by row: equal vectors get equal scores
                    best = nearest(ids[some], score, k)
                    out["query"].append(qids[at + i])
                    out["ids"].append(ids[some][best])
                    out["scores"].append(score[best])
        return pa.table(out, schema=pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))]))

    return fn


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, share: float = SHARE, shard_rows: int = 8192, group_queries: int = 4096, seed: int = 7) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row for which
    ``is_query`` holds, nearest first, equal scores by id.

    Rows with a null id or a vector that is null, empty, zero, or has a null or non-finite component
    take no part. Vectors are compared with those of the same length. A row is no candidate of its
    own id; repeated rows count as one, wherever they are dealt. Products beyond double precision are
    infinite or zero, and so equal among those that are found; sums of opposite infinities come last. An
    empty table, or one without queries, gives no row.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    # the number that deals a row is written with it: a row must have the same one wherever it is sent
    rows = rows.groupBy("id", "v").agg(F.max("q").alias("q"))
    rows = written(rows.select("id", "v", "q", F.size("v").alias("dim"), F.xxhash64(F.monotonically_increasing_id()).alias("mix")), "vectors")
    top = F.array_max(F.transform("v", F.abs))
    norm = F.log2(top) + F.log2(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / top) * (x / top))) / 2
    sizes = {r["dim"]: r for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("queries"), F.max(norm).alias("log_norm")).collect()}
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = F.create_map(*[F.lit(x) for d, r in sizes.items() for x in (d, ceil(r["n"] / shard_rows))])[F.col("dim")]
    groups = F.create_map(*[F.lit(x) for d, r in sizes.items() for x in (d, max(1, ceil(r["queries"] / group_queries)))])[F.col("dim")]
    data = rows.select("id", "v", "dim", F.pmod("mix", shards).alias("shard"), F.explode(F.sequence(F.lit(0), groups - 1)).alias("part"))
    asked = rows.where("q").select("id", "v", "dim", F.pmod("mix", groups).alias("part"), F.explode(F.sequence(F.lit(0), shards - 1)).alias("shard")).select("id", "v", "dim", F.col("shard").cast("long"), F.col("part").cast("int"))
    key = ("dim", "shard", "part")
    log_norm = {d: r["log_norm"] for d, r in sizes.items()}
    data = data.select("id", "v", "dim", F.col("shard").cast("long"), F.col("part").cast("int"))
    found = data.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(search_shard(k, log_norm, tables, projections, width, share, seed), "query long, ids array<long>, scores array<double>")
    pairs = F.flatten(F.collect_list(F.arrays_zip("ids", "scores")))
    best = found.groupBy("query").agg(pairs.alias("p")).select("query", F.slice(F.array_sort(F.array_distinct(F.transform("p", lambda x: F.struct((-x["scores"]).alias("s"), x["ids"].alias("id"))))), 1, k).alias("p"))
    return best.select(F.col("query").alias("query_id"), F.posexplode("p")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias("vec_id"), (-F.col("col.s")).alias("score"))


def exact(vectors: DataFrame, is_query: Column, *, k: int = 20, **more) -> DataFrame:
    """The same by comparing with every row, to measure recall against."""
    return search(vectors, is_query, k=k, share=1.1, tables=1, projections=1, **more)
