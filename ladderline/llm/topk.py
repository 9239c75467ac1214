"""Exact top-k search by inner product over a pivot-distance index.

Largest inner product becomes nearest neighbour by one more coordinate: with M at least the
largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |x' - q'|^2 = M^2 + |q|^2 - 2 q.x.
Each vector is keyed by its nearest pivot and its distance to it; the distances of a pivot
are cut into rings (annuli), as few as fill blocks. For a query at distance d from a pivot, the
triangle inequality puts every vector of a ring [lo, hi] at least max(d - hi, lo - d, 0) away.

A search expands rings nearest first. Its first step visits, in order of their bounds, the
rings that surely hold k candidates, which gives a k-th best score. The second visits only
the rings whose bound admits a score at least that good, and is exact: a ring left out can't
hold a better vector or an equal one. Rings are stored in blocks of bounded size, queries
are taken in blocks too, and only (query block, ring block) pairs are multiplied, each with
the queries of the block that visit the ring, in the narrowest integer type that holds them;
a pair returns k rows for each query at most.

Pivots are k-means centres of a bounded sample; every vector is indexed. Scores are exact inner
products of integer vectors: in doubles or 64 bits where the lengths of the vectors prove that
these hold them, in Python's integers elsewhere. A score beyond 64 bits is given as the nearest
64-bit number, and ranks as that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import saved, ship


@dataclass(frozen=True)
class IndexParams:
    """pivots, rings: largest size of the ring table; block: vectors in a stored block."""

    pivots: int = 32
    rings: int = 32
    sample: int = 4096
    block: int = 2048
    query_block: int = 256


def _floor(x: Column) -> Column:
    """As a double: from 2^52 on every double is whole, and none need fit in 64 bits."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def _norm(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda a, v: a + v * v)


def quantise(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id and vec (floor(scale * x), whole numbers as doubles) of rows whose vector is usable.

    Vectors that are null or hold null, NaN or infinite components, and rows without an id,
    take no part. (Nor do vectors whose squared length no double holds, beyond 1e150.)
    """
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) | (_norm(F.transform(x, lambda v: v.cast("double") * scale)) == float("inf"))
    ok = rows.where(F.col(key).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    return ok.select(F.col(key).cast("bigint").alias("id"), F.transform(x, lambda v: _floor(v.cast("double") * scale)).alias("vec"))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """k-means centres of the sample (at most n, fewer if it has fewer distinct points)."""
    pts = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    c = pts[rng.permutation(len(pts))[:n]]
    for _ in range(rounds if len(pts) > n else 0):
        near = np.argmin((c * c).sum(1)[None, :] - 2 * pts @ c.T, axis=1)
        size = np.bincount(near, minlength=len(c))
        for j in np.nonzero(size)[0]:
            c[j] = pts[near == j].mean(axis=0)
    return c


def _lift(x: np.ndarray, m2: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, m2 - (x * x).sum(axis=1)))[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0, d2))


def narrowest(square: float) -> str:
    """The type for whole components of vectors of at most that squared norm."""
    return "<i2" if square < 2**29 else "<i4" if square < 2**61 else "<f8"


def products(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of y and x, whole numbers, exactly; cut off at 64 bits.

    Sums below 2^53 are exact in doubles in any order, and those below 2^62 in 64-bit integers.
    """
    if not len(x) or not len(y):
        return np.zeros((len(y), len(x)), np.int64)
    a, b = y.astype(float), x.astype(float)
    bound = np.sqrt((a * a).sum(1).max()) * np.sqrt((b * b).sum(1).max())
    if bound < 2**52:
        return (a @ b.T).astype(np.int64)
    if bound < 2**61 and max(np.abs(a).max(), np.abs(b).max()) < 2**61:
        return y.astype(np.int64) @ x.astype(np.int64).T
    whole = lambda m: np.array([[int(v) for v in r] for r in m.tolist()], object).reshape(m.shape)
    s, most = whole(a) @ whole(b).T, (1 << 63) - 1
    return np.array([[max(-most, min(most, v)) for v in r] for r in s], np.int64)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, p: IndexParams = IndexParams()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest scores of each query.

    Candidates are all rows but those with the query's own id; ties go to the smaller id.
    Fewer than k candidates give fewer rows. Repeated rows count each; rows that repeat a
    query's id compete for the same k ranks. The commonest length among usable vectors of ``rows`` (the shortest of several)
    is the index's; vectors of any other length take no part. Empty tables give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    base = quantise(rows, key, vector, scale).where(F.size("vec") > 0)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    norm = _norm(F.col("vec"))
    stats = base.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m2")).orderBy(F.desc("n"), "dim").first()
    if not stats:
        return spark.createDataFrame([], schema)
    dim, m2 = int(stats["dim"]), float(stats["m2"])
    base = base.where(F.size("vec") == dim)
    # The narrowest type that holds every component: what travels most are vectors.
    kind = narrowest(m2)
    picked = base.orderBy(F.xxhash64("id"), "id").limit(p.sample).select("vec").toArrow()  # p.sample rows at most
    pivots = fit_pivots(_lift(_matrix(picked.column(0).combine_chunks()).astype(float), m2), p.pivots)

    def key_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = _distances(_lift(_matrix(b.column(1)).astype(float), m2), pivots)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], names=["id", "vec", "pivot", "dist"])

    keyed = saved(base.mapInArrow(key_of, "id bigint, vec array<double>, pivot int, dist double"), "keyed")
    # Ring edges: approximate quantiles of each pivot's distances; at most pivots * rings values.
    # Rings that a block holds together are one: each ring that a query visits costs a copy of its vector.
    cuts = keyed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("dist", [i / p.rings for i in range(1, p.rings)], 1000).alias("q")).collect()
    step = {r["pivot"]: min(p.rings, max(1, p.block * p.rings // r["n"])) for r in cuts}
    edges = spark.createDataFrame([(i, sorted(set(q[step[i] - 1 :: step[i]]))) for i, _, q in cuts], "pivot int, edges array<double>")
    ringed = keyed.join(F.broadcast(edges), "pivot").withColumn("ring", F.size(F.filter("edges", lambda e: e < F.col("dist"))))
    size = ringed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    ring = sorted((r["pivot"], r["ring"], r["n"], r["lo"], r["hi"]) for r in size.collect())  # pivots * rings rows at most
    r_pivot, r_n = np.array([r[0] for r in ring]), np.array([r[2] for r in ring])
    r_lo, r_hi = np.array([r[3] for r in ring]), np.array([r[4] for r in ring])
    blocks_of = -(-r_n // p.block)
    nblocks = spark.createDataFrame([(r[0], r[1], i, int(b)) for i, (r, b) in enumerate(zip(ring, blocks_of, strict=True))], "pivot int, ring int, cell int, nb int")
    cells = ringed.join(F.broadcast(nblocks), ["pivot", "ring"]).select("cell", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int").alias("blk"), "id", "vec")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (cell, blk) to rows of up to p.block vectors."""
        for b in batches:
            if not b.num_rows:
                continue
            c, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            cut = np.nonzero((np.diff(c) != 0) | (np.diff(k2) != 0))[0] + 1
            for x, y in zip([0, *cut.tolist()], [*cut.tolist(), len(c)], strict=True):
                for i in range(x, y, p.block):
                    s = b.slice(i, min(p.block, y - i))
                    m = _matrix(s.column(3)).astype(kind)
                    yield pa.RecordBatch.from_arrays([s.column(0)[:1], s.column(1)[:1], pa.array([s.column(2).to_numpy().astype("<i8").tobytes()]), pa.array([m.tobytes()])], names=["cell", "blk", "ids", "m"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = "cell int, blk int, ids binary, m binary"
    index = saved(cells.repartition(parts, "cell", "blk").sortWithinPartitions("cell", "blk").mapInArrow(pack, packed), "index")

    q = quantise(queries, key, vector, scale).where(F.size("vec") == dim)

    def bounds(x: np.ndarray) -> np.ndarray:
        """Largest score that each query can have in each ring, rounded up generously."""
        lifted = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        d = _distances(lifted, pivots)[:, r_pivot]
        n2 = (x * x).sum(1)[:, None]
        # Rounding of squared distances is relative to the longest vectors.
        low = np.maximum(0, np.maximum(d - r_hi, r_lo - d) * (1 - 1e-9) - 1e-3 - 1e-6 * np.sqrt(np.maximum(m2, n2)))
        up = (m2 + n2 - low * low) / 2
        return np.maximum(up + 1e-9 * np.maximum(m2, n2) + 1, -(2.0**63))

    def visits(floor: bool):
        """A row for each block of a ring and block of queries that visit it: the rings that hold k
        candidates, or all that may beat the floor."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, p.query_block):
                    s = b.slice(at, p.query_block)
                    x = _matrix(s.column(1))
                    up = bounds(x.astype(float))
                    if floor:
                        least = np.array([-np.inf if v is None else v for v in s.column(2).to_pylist()])
                        use = up >= least[:, None]
                    else:
                        order = np.argsort(-up, axis=1, kind="stable")
                        got = np.cumsum(r_n[order], axis=1) - r_n[order]
                        use = np.zeros(up.shape, bool)
                        # k + 1: the query itself may be among them
                        np.put_along_axis(use, order, got < k + 1, axis=1)
                    ids, x = s.column(0).to_numpy().astype("<i8"), x.astype(q_kind)
                    for j in np.nonzero(use.any(axis=0))[0].tolist():
                        who, n = use[:, j], int(blocks_of[j])
                        same = [pa.array([v] * n, pa.binary()) for v in (ids[who].tobytes(), x[who].tobytes())]
                        yield pa.RecordBatch.from_arrays([pa.array([j] * n, pa.int32()), pa.array(range(n), pa.int32()), *same], names=["cell", "blk", "qids", "qm"])

        return run

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of a block for each query of a block."""
        for b in batches:
            for r in b.to_pylist():
                ids, qids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["qids"], "<i8")
                x, y = (np.frombuffer(r[m], t).reshape(-1, dim) for m, t in (("m", kind), ("qm", q_kind)))
                s = products(y, x)
                own = qids[:, None] == ids[None, :]
                s[own] = np.iinfo(np.int64).min
                order = np.lexsort((np.broadcast_to(ids, s.shape), ~s), axis=1)[:, :k]
                i = np.repeat(np.arange(len(qids)), order.shape[1])
                j = order.ravel()
                ok = ~own[i, j]
                yield pa.RecordBatch.from_arrays([pa.array(qids[i[ok]]), pa.array(ids[j[ok]]), pa.array(s[i[ok], j[ok]])], names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def search(src: DataFrame, floor: bool) -> DataFrame:
        v = src.mapInArrow(visits(floor), "cell int, blk int, qids binary, qm binary")
        # Shuffled whatever Spark estimates: it knows of the visits only how large the queries are, and
        # of the index its compressed files, and would broadcast either through the driver.
        hits = v.hint("merge").join(index, ["cell", "blk"]).select("ids", "m", "qids", "qm").mapInArrow(multiply, "query_id bigint, vec_id bigint, score bigint")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    q2 = q.agg(F.coalesce(F.max(norm), F.lit(0.0))).first()[0]
    q_kind = narrowest(q2)
    first = search(q, False).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("least"))
    second = q.join(first.select(F.col("query_id").alias("id"), "least"), "id", "left")
    return search(second.select("id", "vec", "least"), True).select("query_id", "rank", "vec_id", "score")
