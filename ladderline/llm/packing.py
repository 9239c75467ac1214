"""Packing token sequences into fixed windows by non-negative least squares.

Documents of a window or more give whole windows; what is left of each has one of
``window - 1`` lengths. Packing is planned on the histogram of those lengths alone, whose
size doesn't depend on the data:

1. enumerate shallow combinations of lengths (up to four) that fill a window exactly;
2. solve min |A x - h|, x >= 0, for their repeat counts x against the histogram h;
3. round down, clipped to what is there;
4. pack the residual histogram greedily: the largest length, then the largest that still fits.

A plan is a list of patterns with repeat counts. Pieces of one length are numbered, and the
n-th of them takes the n-th slot of that length, so that assignment is one bounded join.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import pieces_of, saved, ship
from .token_output import tokenizer_of


def combinations(h: np.ndarray, window: int, grid: int = 24) -> np.ndarray:
    """Rows of up to four lengths (0: none) that sum to the window; h[i] counts length i.

    Pairs are complete. In triples and fours the middle lengths come from a grid of
    quantiles of the histogram, which keeps the number of columns fixed.
    """
    lengths = np.arange(1, window)
    pairs = np.stack([lengths[: window // 2], window - lengths[: window // 2]], 1)
    out = [np.pad(pairs, ((0, 0), (0, 2)))]
    total = h[1:window].sum()
    if total:
        cut = np.cumsum(h[1:window]) / total
        q = np.unique(np.searchsorted(cut, (np.arange(grid) + 0.5) / grid) + 1)
        a, b = (x.ravel() for x in np.meshgrid(lengths, q, indexing="ij"))
        c = window - a - b
        ok = (c >= 1) & (a >= c)
        out.append(np.pad(np.stack([a[ok], b[ok], c[ok]], 1), ((0, 0), (0, 1))))
        small = q[:: max(1, len(q) // 8)]
        a, b, c = (x.ravel() for x in np.meshgrid(lengths, small, small, indexing="ij"))
        d = window - a - b - c
        ok = (d >= 1) & (a >= d) & (b <= c)
        out.append(np.stack([a[ok], b[ok], c[ok], d[ok]], 1))
    return np.unique(np.sort(np.concatenate(out), axis=1)[:, ::-1], axis=0)


def nnls(combos: np.ndarray, h: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - h|; A[l, j] is how often combination j has length l.

    Accelerated projected gradient; the step is the inverse of a bound on the norm of A'A.
    """
    present = combos > 0
    use = np.bincount(combos[present], minlength=len(h)).astype(float)
    step = 1.0 / max(1.0, 4.0 * use.max())
    # Columns are scaled by how many others share their lengths, which evens out convergence.
    scale = 1.0 / np.where(present, np.sqrt(use[combos]), 0).sum(1).clip(1.0)
    scale = scale / scale.max()
    x = y = np.zeros(len(combos))
    t = 1.0
    step /= max(1e-12, float((scale**2).max()))

    def apply(v: np.ndarray) -> np.ndarray:
        return np.bincount(combos.ravel(), np.where(present, (v * scale)[:, None], 0).ravel(), minlength=len(h))

    for _ in range(rounds):
        r = apply(y) - h
        grad = scale * np.where(present, r[combos], 0).sum(1)
        new = np.maximum(0, y - step * grad)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x * scale


def plan(h: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often), which uses up h exactly. h[i]: pieces of length i, i <= window."""
    left = h.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    if left.sum():
        combos = combinations(left, window)
        x = nnls(combos, left.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            need = Counter(int(v) for v in combos[j] if v)
            n = min(int(x[j]), *(int(left[v]) // m for v, m in need.items()))
            if n:
                out.append((tuple(sorted(need.elements(), reverse=True)), n))
                for v, m in need.items():
                    left[v] -= m * n
    there = [int(v) for v in np.nonzero(left)[0]]
    while there:
        room, need = window, Counter()
        while room and (i := bisect_right(there, room)):
            while i and left[there[i - 1]] <= need[there[i - 1]]:
                i -= 1
            if not i:
                break
            v = there[i - 1]
            m = min(room // v, int(left[v]) - need[v])
            need[v] += m
            room -= m * v
        n = min(int(left[v]) // m for v, m in need.items())
        out.append((tuple(sorted(need.elements(), reverse=True)), n))
        for v, m in need.items():
            left[v] -= m * n
        there = [v for v in there if left[v]]
    return out


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, n, sequence, each, offset): piece numbers first .. first + n * each - 1
    of that length go, ``each`` to a sequence, to sequences from ``sequence`` on, from ``offset``."""
    out, used, base = [], Counter(), 0
    for lengths, n in patterns:
        offset = 0
        for v, each in sorted(Counter(lengths).items(), reverse=True):
            out.append((v, used[v], n * each, base, each, offset))
            used[v] += n * each
            offset += v * each
        base += n
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole windows and the rest of each document: key, start, length, ids_crc32, doc_tokens.

    A null or empty text is its end token alone.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_of(tokenizer_path)
        for b in pieces_of(batches, "_text"):
            flat, ends = tok.column(b.column(1), end_id)
            raw, total = memoryview(flat.astype("<u4").tobytes()), np.diff(ends)
            n = -(-total // window)
            row = np.repeat(np.arange(len(n)), n)
            start = window * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
            length = np.minimum(window, total[row] - start)
            at = ends[row] + start
            crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at.tolist(), (at + length).tolist(), strict=True)]
            cols = [pa.array(x, pa.int64()) for x in (start, length, crc, total[row])]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *cols], names=[key, "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, docs[text].alias("_text")).mapInArrow(run, f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def assign(pieces: DataFrame, window: int, key: str = "doc_id", chunks: int = 256) -> DataFrame:
    """Add sequence_id and offset to pieces by the plan for their length histogram.

    Pieces of a length are numbered in ``chunks`` hash groups each, so that no length, however
    common, is sorted in one task; the numbers before each group come from a table of at most
    window * chunks rows. ``pieces`` is read twice: give a written table.
    """
    spark = pieces.sparkSession
    p = pieces.withColumn("_chunk", F.pmod(F.xxhash64(key, "start"), F.lit(chunks)).cast("int"))
    by_chunk = p.groupBy("length", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    h = np.zeros(window + 1, np.int64)
    for r in by_chunk.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most `window` rows
        h[r["length"]] = r["n"]
    rows = slots(plan(h, window)) or [(0, 0, 0, 0, 1, 0)]
    table = spark.createDataFrame(rows, "length bigint, first bigint, n bigint, seq bigint, each bigint, off bigint")
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_chunk.select("length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_chunk").orderBy(key, "start", "doc_tokens", "ids_crc32")
    numbered = (
        p.withColumn("_k", F.row_number().over(inside) - 1)
        .join(bases, ["length", "_chunk"])
        .select(key, "start", "length", "ids_crc32", "doc_tokens", (F.col("_k") + F.col("_base")).alias("_k"))
    )
    # A sequence has `each` pieces of the length next to each other: a plan has few slots a length.
    at = F.col("_k") - F.col("first")
    return (
        numbered.join(F.broadcast(table), "length")
        .where((at >= 0) & (at < F.col("n")))
        .select(
            key, "start", "length", "ids_crc32", "doc_tokens",
            (F.col("seq") + F.expr("(_k - first) div each")).alias("sequence_id"),
            (F.col("off") + at % F.col("each") * F.col("length")).alias("offset"),
        )
    )


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack whole documents (null text: only the end token) into sequences of ``window`` tokens.

    One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset. Every id
    lies in one piece. Null keys and repeated rows are packed like others; an empty table gives
    no rows; other columns are left out.
    """
    return assign(saved(token_pieces(docs, tokenizer_path, end_id, window, key, text), "pieces"), window, key)
