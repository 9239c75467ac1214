"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint holds every 64-bit hash of a text's five-word shingles that lies below a fixed
fraction of the range. Since the threshold is the same for all texts, long texts keep more: two
fingerprints of any lengths are samples of one set of shingles, so the share of one inside the
other estimates containment without bias, and the fingerprint of several texts together is made
from theirs. A text whose hashes all lie above keeps the smallest, so that equal short texts
are alike and different ones aren't.

For likenesses along an order of documents, documents are dealt into blocks by range of their
keys, and the first of each block goes to the end of the block before it as well: each text is
shuffled once, and each block is read in order as a stream.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import FIXED_KEY, begin, pieces_of, shingle_hashes, ship, word_hashes

#: Words of a shingle; one hash of so many is kept, on average.
WORDS, SCALE = 5, 8
#: Keys sampled for each block, to set its bounds.
SAMPLED = 64


def sketches(texts: Sequence[str | None], scale: int = SCALE) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of 5-word shingles that are below 2^64 / scale, else
    the smallest one. Words are lower-cased (A-Z); fewer than five are one shingle; none, none."""
    begin("fingerprint")
    h, ends = word_hashes(pa.array(texts, pa.large_string()), FIXED_KEY)
    runs = shingle_hashes(h, WORDS) if len(h) >= WORDS else h[:0]
    low = np.flatnonzero(runs < np.uint64((1 << 64) // scale))
    cut = np.searchsorted(low, ends)
    out = []
    for (x, y), (i, j) in zip(pairwise(ends.tolist()), pairwise(cut.tolist()), strict=True):
        if y - x < WORDS:
            out.append(shingle_hashes(h[x:y], WORDS))
            continue
        # Shingles that begin in a text's last four words reach into the next.
        own = low[i:j]
        kept = np.unique(runs[own[own <= y - WORDS]])
        out.append(kept if len(kept) else runs[x : y - WORDS + 1].min(keepdims=True))
    return out


def written(sketch: np.ndarray) -> str:
    """A fingerprint as text: Base64 of its hashes, little-endian, ascending."""
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merged(fingerprints: Sequence[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """The fingerprint of texts taken together (as sets of shingles), from theirs."""
    all_ = np.unique(np.concatenate([*fingerprints, np.zeros(0, np.uint64)]))
    low = all_[all_ < np.uint64((1 << 64) // scale)]
    return low if len(low) else all_[:1]


def both(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common shingles among all of two texts; 1 for two without any."""
    n = both(a, b)
    return n / (len(a) + len(b) - n) if len(a) or len(b) else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has; 1 if a has none."""
    return both(a, b) / len(a) if len(a) else 1.0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", scale: int = SCALE) -> DataFrame:
    """Key, n_chars (code points) and fingerprint of every text; no shuffle. Null counts as empty;
    null keys and repeated rows stay as they are; other columns are left out."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, "_text"):
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([written(s) for s in sketches(texts, scale)])], names=[key, "n_chars", "fingerprint"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, docs[text].alias("_text")).mapInArrow(run, f"`{key}` {kind}, n_chars bigint, fingerprint string")


def _order() -> list[Column]:
    """Descending key, none last; equal ones by a hash of their texts. (~x falls as x rises, and never overflows.)"""
    return [F.col("_id").isNull().alias("_none"), F.coalesce(F.bitwise_not(F.col("_id").cast("bigint")), F.lit(0)).alias("_down"), F.xxhash64("_text").alias("_hash")]


def _blocks(rows: DataFrame, n: int) -> tuple[list[tuple], dict[tuple, int]]:
    """Lower bounds of the order in each block but the first, and for the first key of each block
    the block before it (for the first of all, the last). ``SAMPLED`` keys a block, and one a
    block, reach the driver."""
    keys = rows.select(*_order())
    some = keys.distinct().orderBy(F.xxhash64("_none", "_down", "_hash"), "_down", "_hash").limit(SAMPLED * n).collect()
    some = sorted(map(tuple, some))
    bounds = sorted({some[i * len(some) // n] for i in range(1, n)}) if some else []

    @F.arrow_udf("int")
    def block(none: pa.Array, down: pa.Array, hash_: pa.Array) -> pa.Array:
        return pa.array([bisect_right(bounds, k) for k in zip(none.to_pylist(), down.to_pylist(), hash_.to_pylist(), strict=True)], pa.int32())

    first = keys.withColumn("_b", block("_none", "_down", "_hash")).groupBy("_b").agg(F.min(F.struct("_none", "_down", "_hash")).alias("k")).collect()
    heads = sorted((r["_b"], tuple(r["k"])) for r in first)
    return bounds, {k: heads[i - 1][0] for i, (_, k) in enumerate(heads)}


def edited(text: str, following: str) -> str:
    """The text with the last half of its characters replaced by the first as many of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(key, text, following text) from rows (block, tail, key, text) in order, some MB at a time.
    The tail of a block is the first text of the next."""
    held = None
    for b in pieces_of(batches, "_text"):
        out = []
        for block, tail, key, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held is not None:
                if held[0] != block:
                    raise RuntimeError("a block has lost its end")
                out.append((held[1], held[2], text or ""))
            held = None if tail else (block, key, text or "")
        if out:
            yield out
    if held is not None:
        raise RuntimeError("a block has lost its end")


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text", scale: int = SCALE) -> DataFrame:
    """One row per input row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, contained_edited, contained_next.

    Keys are whole numbers. The next row is that of the next smaller key, rows without key last, and
    after the last the first; rows of one key follow each other in the order of a hash of their
    texts. A single row is its own next. The edited text is ``edited`` of both. near: estimated
    likeness of the own fingerprint to the edited text's and to the next row's; contained: the
    own one's share in those. Null counts as empty. Other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(docs[key].alias("_id"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, before = _blocks(rows, n)

    @F.arrow_udf("array<struct<_block:int,_tail:boolean>>")
    def places(none: pa.Array, down: pa.Array, hash_: pa.Array) -> pa.Array:
        out = []
        for k in zip(none.to_pylist(), down.to_pylist(), hash_.to_pylist(), strict=True):
            own = [{"_block": bisect_right(bounds, k), "_tail": False}]
            out.append([*own, {"_block": before[k], "_tail": True}] if k in before else own)
        return pa.array(out, pa.list_(pa.struct([("_block", pa.int32()), ("_tail", pa.bool_())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for part in _pairs(_once(batches, seen)):
            own, nxt = [t for _, t, _ in part], [t for *_, t in part]
            new = [edited(t, f) for t, f in zip(own, nxt, strict=True)]
            # Where rows follow each other the next one's sketch is the following row's.
            chain = [i for i in range(len(part)) if i + 1 == len(part) or nxt[i] is not own[i + 1]]
            s, e, last = sketches(own, scale), sketches(new, scale), sketches([nxt[i] for i in chain], scale)
            f = [*s[1:], s[0]]
            for i, x in zip(chain, last, strict=True):
                f[i] = x
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, *_ in part], id_type), pa.array([len(t) for t in own], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
                    pa.array(list(map(written, s))), pa.array(list(map(written, e))), pa.array(list(map(likeness, s, e))), pa.array(list(map(likeness, s, f))),
                    pa.array(list(map(containment, s, e))), pa.array(list(map(containment, s, f))),
                ],
                names=["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained_edited", "contained_next"],
            )

    id_type = pa.schema([("k", _arrow(docs.schema[key].dataType.simpleString()))]).field("k").type
    at = rows.select("*", *_order()).withColumn("_at", F.explode(places("_none", "_down", "_hash"))).select("_at._block", "_at._tail", "_id", "_text", "_none", "_down", "_hash")
    dealt = at.repartitionById(n, F.col("_block")).sortWithinPartitions("_block", "_tail", "_none", "_down", "_hash", "_text").select("_block", "_tail", "_id", "_text")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, contained_next double"
    return dealt.mapInArrow(run, schema).withColumnRenamed("_id", key)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]


def _once(batches: Iterator[pa.RecordBatch], seen: set) -> Iterator[pa.RecordBatch]:
    """The rows with one tail a block: rows that repeat the first key of a block came along as well."""
    for b in batches:
        keep = []
        for block, tail in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            keep.append(not tail or block not in seen)
            if tail:
                seen.add(block)
        yield b if all(keep) else b.filter(pa.array(keep))
