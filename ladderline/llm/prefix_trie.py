"""The prefix trie of conversations, by Patricia construction.

A conversation is a path of turns, each a 128-bit digest of role and text, so paths sort as byte
strings. Sorted paths are cut into parts by range, and a part that is read in order gives the
points of its tree at once: the common prefix of two neighbours is a branch, a path's end is an
end or a leaf. Only these points are made, each with the edge above it; sums go up the compressed
tree as points close. Nodes inside an edge differ from its lower end in saved tokens alone, which
are sums over the rest of the edge; they are expanded last.

A node that the neighbours of a part share (a prefix of the path before it or of the one after)
is known there in part only. Such nodes lie on the first and last path of a part. They are
written one by one with what the part knows, and everything known adds up: what is counted once
for a node (the node itself, its turn's words) counts where the node comes first. So no part
needs more than two paths of its neighbours, whatever first turn the conversations have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import saved, ship

#: Bytes of a turn's digest; conversations in a part about; characters of ids in a piece of text.
UNIT, PART, PIECE = 16, 50_000, 1 << 16
#: SHA-256 of nothing.
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: A conversation's opening is that of the first of its family of so many.
FAMILY, OPENING = 20, 4


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (digest, words) in order: by turn, null first, equal ones by
    digest of role and text. Null role or text counts as empty; rows without conv_id take no part."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * UNIT)
    t = rows.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), digest.alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    own = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("numbered", "turn", "digest", "words"))).alias("turns"))
    return own.withColumn("turns", F.transform("turns", lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, path (digests one after the other) and words (one number a turn) of conversations
    whose first h turns are those of the first conversation of their family; h is the CRC-32 of
    the id modulo 4."""
    h = F.expr(f"CAST(crc32(CAST(conv_id AS STRING)) % {OPENING} AS INT)")
    heads = turns.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_first"), F.slice("turns", 1, OPENING - 1).alias("_head"))
    t = turns.withColumn("_first", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "_first", "left").withColumn("_h", h)
    none = F.slice("turns", 1, 0)
    all_ = F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")), F.slice("turns", F.col("_h") + 1, F.size("turns")))
    t = t.select("conv_id", all_.alias("t"))
    return t.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), "")).alias("path"), F.transform("t", lambda x: x["words"]).alias("words"))


def common(a: bytes, b: bytes) -> int:
    """How many turns two paths share."""
    lo, hi = 0, min(len(a), len(b)) // UNIT
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * UNIT : mid * UNIT] == b[lo * UNIT : mid * UNIT]:
            lo = mid
        else:
            hi = mid - 1
    return lo


@dataclass(slots=True)
class Point:
    """A branch, end or leaf: what lies below it in this part."""

    depth: int
    path: int
    first: int
    n: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    base: int = 0
    """Of every node below, conversations times words of its turn."""
    less: int = 0
    """Of every node below that comes first here, words of its turn."""
    ends: list[int] = field(default_factory=list)
    last: int = -1

    def take(self, child: Point, base: int, less: int, new: bool) -> None:
        self.n += child.n
        self.least = child.least if self.least is None else min(self.least, child.least)
        self.children += new
        self.leaves += child.leaves
        self.base += base
        self.less += less


class Part:
    """The points of one part's sorted paths. before, after: the neighbouring paths of other parts."""

    def __init__(self, paths: list[bytes], ids: list[list[int]], words: list[list[int]], before: bytes | None, after: bytes | None):
        self.paths, self.ids, self.words, self.after = paths, ids, words, after
        self.left = -1 if before is None else common(before, paths[0])
        self.right = -1 if after is None else common(paths[-1], after)
        #: (point, the point above it), as they close.
        self.edges: list[tuple[Point, Point | None]] = []
        self._build()

    def is_leaf(self, i: int) -> bool:
        here = self.paths[i]
        if i + 1 < len(self.paths):
            return not self.paths[i + 1].startswith(here)
        # Copies of the path in the next part, or what follows there, decide.
        return self.after is None or not self.after.startswith(here)

    def new(self, p: Point) -> bool:
        """Whether a point, and every node of its edge, comes first in this part."""
        return not (p.first == 0 and p.depth <= self.left)

    def shared(self, p: Point) -> bool:
        return not self.new(p) or p.last == len(self.paths) - 1 and p.depth <= self.right

    def along(self, p: Point, above: int) -> Iterator[tuple[int, int, int]]:
        """(depth, base, less) of the nodes of a point's edge, from below."""
        base, less, once = p.base, p.less, self.new(p)
        for d in range(p.depth, above, -1):
            w = self.words[p.path][d - 1] if d else 0
            base, less = base + p.n * w, less + once * w
            yield d, base, less

    def _close(self, stack: list[Point], depth: int, i: int) -> None:
        """Close points below depth; path i - 1 was the last. A point at depth is left on top."""
        while stack[-1].depth > depth:
            p = stack.pop()
            p.last = i - 1
            if stack[-1].depth < depth:
                stack.append(Point(depth, p.path, p.first))
            up = stack[-1]
            self.edges.append((p, up))
            for _, base, less in self.along(p, up.depth):
                pass
            up.take(p, base, less, self.new(p))

    def _build(self) -> None:
        stack = [Point(0, 0, 0)]
        if self.left > 0:
            stack.append(Point(self.left, 0, 0))
        for i, path in enumerate(self.paths):
            if i:
                self._close(stack, common(self.paths[i - 1], path), i)
            if stack[-1].depth < len(path) // UNIT:
                stack.append(Point(len(path) // UNIT, i, i))
            p = stack[-1]
            p.n += len(self.ids[i])
            p.least = self.ids[i][0] if p.least is None else min(p.least, self.ids[i][0])
            p.ends = self.ids[i]
            p.leaves += self.is_leaf(i)
        self._close(stack, max(self.right, 0), len(self.paths))
        self._close(stack, 0, len(self.paths))
        stack[0].last = len(self.paths) - 1
        self.edges.append((stack[0], None))

    def keys(self, path: bytes, most: int) -> list[bytes]:
        """Digests of a path's prefixes of up to ``most`` turns."""
        h, out = hashlib.sha256(), []
        for d in range(most + 1):
            out.append(h.digest()[:UNIT])
            h.update(path[d * UNIT : (d + 1) * UNIT])
        return out

    def rows(self, part: int) -> Iterator[dict]:
        """Rows of the compressed tree: edges (kind 0), shared nodes (1), pieces of ids of ends of those (2)."""
        on_first, on_last = self.keys(self.paths[0], max(self.left, 0)), self.keys(self.paths[-1], max(self.right, 0))
        key = lambda p, d: on_first[d] if not self.new(p) else on_last[d]
        for p, up in self.edges:
            same = {"part": part, "conv_id": p.least, "n_convs": p.n, "n_leaves": p.leaves}
            if not self.shared(p):
                top = up.depth + 1 if up else 0
                far = up is not None and self.shared(up)
                sums = [base - less for _, base, less in self.along(p, top - 1)] if p.depth else [p.base - p.less]
                ends = hashlib.sha256(",".join(map(str, p.ends)).encode()).hexdigest()
                yield same | {
                    "kind": 0, "top": top, "depth": p.depth, "n_children": p.children, "saved": sums[::-1], "ends": ends,
                    "parent_conv_id": None if up is None or far else up.least, "parent_key": key(up, up.depth) if far else None,
                }
                continue
            below = p.children
            for d, base, less in self.along(p, up.depth) if up else [(0, p.base, p.less)]:
                yield same | {"kind": 1, "depth": d, "n_children": below, "base": base, "less": less, "key": key(p, d), "parent_key": key(p, d - 1) if d else None}
                below = int(self.new(p))
            for no, text in enumerate(pieces(p.ends)):
                yield {"kind": 2, "part": part, "key": key(p, p.depth), "no": no, "text": text}


def pieces(ids: list[int]) -> Iterator[str]:
    """Decimal ids, comma-joined, in pieces of some ``PIECE`` characters."""
    at = PIECE // 20
    for i in range(0, len(ids), at):
        yield ",".join(map(str, ids[i : i + at]))


_EDGES = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("conv_id", pa.int64()), ("top", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.list_(pa.int64())), ("ends", pa.string()), ("parent_conv_id", pa.int64()),
    ("key", pa.binary()), ("parent_key", pa.binary()), ("base", pa.int64()), ("less", pa.int64()), ("no", pa.int32()), ("text", pa.string()),
])
_SPARK = (
    "kind int, part int, conv_id bigint, top bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved array<bigint>, ends string,"
    " parent_conv_id bigint, key binary, parent_key binary, base bigint, less bigint, no int, text string"
)


def _part_points(rows: pa.Table, near: pa.Table) -> pa.Table:
    """Rows (part, conv_id, path, words) of one part and its row of neighbours to rows of points."""
    ids, paths = rows.column("conv_id").to_numpy(), rows.column("path").to_pylist()
    order = sorted(range(len(paths)), key=lambda i: (paths[i], ids[i]))
    groups: list[list[int]] = []
    for i in order:
        if groups and paths[groups[-1][0]] == paths[i]:
            groups[-1].append(i)
        else:
            groups.append([i])
    words = rows.column("words").combine_chunks().take(pa.array([g[0] for g in groups])).to_pylist()
    before, after = (near.column(c)[0].as_py() for c in ("before", "after"))
    part = Part([paths[g[0]] for g in groups], [ids[g].tolist() for g in groups], words, before, after)
    return pa.Table.from_pylist(list(part.rows(rows.column("part")[0].as_py())), _EDGES)


def points(convs: DataFrame) -> DataFrame:
    """The compressed tree of (conv_id, path, words), written: edges with their lower points, and what
    parts know of the nodes they share."""
    spark = convs.sparkSession
    ship(spark)
    convs = saved(convs, "conversations")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-convs.count() // PART))
    # By id too, so that copies of a common conversation fall into many parts.
    cut = saved(convs.repartitionByRange(parts, "path", "conv_id").withColumn("part", F.spark_partition_id()), "parts")
    ends = cut.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # One row a part.
    w = Window.orderBy("part")
    near = ends.select("part", F.lag("last").over(w).alias("before"), F.lead("first").over(w).alias("after"))
    return saved(cut.groupBy("part").cogroup(near.groupBy("part")).applyInArrow(_part_points, _SPARK), "points")


def _ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, part, no, text) in order to the SHA-256 of each key's texts, comma-joined."""
    key, h = None, None
    for b in batches:
        done = []
        for k, text in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
            if k == key:
                h.update(b"," + text.encode())
                continue
            if key is not None:
                done.append((key, h.hexdigest()))
            key, h = k, hashlib.sha256(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], names=["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], names=["key", "ends"])


def nodes(tree: DataFrame) -> DataFrame:
    """All nodes of a compressed tree: shared ones added up, edges expanded."""
    spark = tree.sparkSession
    known = tree.where("kind = 1")
    total = known.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves")], (F.sum("base") - F.sum("less")).alias("saved_tokens"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = tree.where("kind = 2").select("key", "part", "no", "text").repartition(n, "key").sortWithinPartitions("key", "part", "no")
    ends = text.mapInArrow(_ends_of, "key binary, ends string")
    total = saved(total.join(ends, "key", "left"), "shared")
    above = total.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    shared = total.join(above, "parent_key", "left").select(*cols, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))

    edge = tree.where("kind = 0").drop("kind", "key", "base", "less", "no", "text")
    # By part and node: no part has more edges than paths, however many hang from one node.
    of_part = known.select("part", F.col("key").alias("parent_key")).join(above, "parent_key")
    hung = edge.where("parent_key IS NOT NULL").drop("parent_conv_id").join(of_part, ["part", "parent_key"])
    edge = edge.where("parent_key IS NULL").unionByName(hung)
    low = F.col("top") + F.col("i") == F.col("depth")
    own = edge.select("*", F.posexplode("saved").alias("i", "saved_tokens")).select(
        "conv_id", (F.col("top") + F.col("i")).alias("depth"), F.when(F.col("i") == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(low, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves", "saved_tokens", F.when(low, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"),
    )
    return shared.unionByName(own)


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rows (conv_id, turn, role, text), of any order. Turns go by turn, null
    first, equal ones by digest of role and text, and each counts; null role or text is empty.
    Rows without conv_id take no part; other columns are left out. An empty table has no nodes,
    not even a root. One conversation's path (some 24 bytes a turn) must fit in a task.
    """
    return nodes(points(rebuilt(turns_of(rows))))
