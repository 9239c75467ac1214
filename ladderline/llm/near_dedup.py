"""MinHash near-duplicates with odd sketches.

Documents are sets of word shingles. Documents of equal sets fall together by a digest of
the set. Of each class one representative goes on: its MinHash samples are cut into bands
(equal band, candidate pair) and folded into an odd sketch, a bitmap in which each sample
flips one bit. The population count of two sketches' XOR estimates how many samples differ,
most precisely where few do, so it rejects most candidates before sets are compared.

Every link found is confirmed on full sets, and links only matter through the components
they make. So pairs are tried in an order that finds components early: in a star round
each representative meets one member of each of its buckets (in another round, another one), of
which it verifies the most similar by sketch; pairs inside a component are skipped from then on.
What is left (buckets that still touch several components) is compared exhaustively in blocks
of bounded size, in two steps. Finer sketches are compared inside the buckets, and each block
returns a forest over its close rows. Each row's set then travels to the group that these
forests connect, where close pairs are compared exactly; each block returns a forest of
confirmed links. So no step returns more edges than it got rows, however many pairs a group has.

With 40 bands of 5, a pair at similarity 0.8 shares no band with probability
(1 - 0.8^5)^40 < 2e-7; the sketch bounds lose it with less. Words are hashed under a random
key of the run, so no text can be written to collide; classes and shingles are 64-bit digests
of those.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import FIXED_KEY, MIX_C, begin, fresh_key, pieces_of, saved, scramble, ship, shingle_hashes, word_hashes

BANDS, ROWS, SKETCH_WORDS = 40, 5, 8
#: Sketches of 512 bits that differ in more than this are not compared further. Samples that
#: differ at similarity 0.8: 40 of 200 (80 flips, 69 bits expected); 6 standard deviations
#: more are 74 (148 flips, 112 bits expected, standard deviation 9).
MOST_BITS = 128
STAR_ROUNDS, BLOCK, BLOCK_BYTES = 1, 2048, 16 << 20
#: 64-bit words of the bitmap that keeps other texts out of a shuffle (4 MB).
FILTER_WORDS = 1 << 19

#: Fine sketches, for what star rounds leave: 2048 samples in 4096 bits. At similarity 0.8,
#: 410 samples differ (819 flips, 675 bits expected, standard deviation 34); 6 of those more
#: are 879 bits, which pairs below 0.7 exceed.
FINE, FINE_BITS, MOST_FINE = 2048, 4096, 880

_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)[:, None]
_MUL = (_rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * 2 + 1)[:, None]
_FINE_XOR = _rng.integers(0, 1 << 32, FINE, dtype=np.uint32)[:, None]
_FINE_MUL = (_rng.integers(0, 1 << 31, FINE, dtype=np.uint32) * 2 + 1)[:, None]
_FINE_PERM = scramble(np.arange(1, FINE + 1, dtype=np.uint64) * MIX_C + np.uint64(1 << 40))
_PERM = scramble(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * MIX_C)


def min_samples(s: np.ndarray, xor: np.ndarray = _XOR, mul: np.ndarray = _MUL) -> np.ndarray:
    """One minimum for each hash function over a non-empty set of 64-bit hashes."""
    x = (s >> np.uint64(32)).astype(np.uint32)[None, :]
    best = np.full(len(xor), 0xFFFFFFFF, np.uint32)
    for i in range(0, x.shape[1], 512):
        for j in range(0, len(xor), 256):
            part = (x[:, i : i + 512] ^ xor[j : j + 256]) * mul[j : j + 256]
            np.minimum(best[j : j + 256], part.min(axis=1), out=best[j : j + 256])
    return best


def band_keys(mins: np.ndarray) -> np.ndarray:
    """Signed keys of the bands of a row of samples, or of each row of many."""
    m, acc = mins.reshape(*mins.shape[:-1], BANDS, ROWS).astype(np.uint64), np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        acc = scramble(acc * MIX_C + m[..., j])
    return acc.view(np.int64)


def odd_sketch(mins: np.ndarray, perm: np.ndarray = _PERM, bits: int = 64 * SKETCH_WORDS) -> np.ndarray:
    """Parity bitmap of a row of samples, or of each row of many (bits: a power of two), as signed 64-bit words."""
    rows = mins.reshape(-1, mins.shape[-1])
    at = (scramble(perm + rows.astype(np.uint64)) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)
    at += bits * np.arange(len(rows))[:, None]
    flips = np.bincount(at.ravel(), minlength=bits * len(rows)) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64).reshape(*mins.shape[:-1], bits // 64)


def shingle_sets(texts: pa.Array, k: int, words: int = FIXED_KEY) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of k-word shingles; of the whole sequence if it is shorter.
    ``words``: the key of the word hashes."""
    begin("near_dedup")
    h, ends = word_hashes(texts, words)
    runs = shingle_hashes(h, k)
    cut = ends.tolist()
    # Runs that begin in the last k - 1 words of a row reach into the next.
    return [np.unique(runs[x : y - k + 1] if y - x >= k else shingle_hashes(h[x:y], k)) for x, y in pairwise(cut)]


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    return shingle_sets(pa.array([text], pa.binary()), k)[0]


def node_of(s: np.ndarray) -> int:
    """Signed 64-bit digest of a set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, k: int, key: str, text: str, words: int = FIXED_KEY) -> DataFrame:
    """Key as ``id``, n_shingles, node (digest of the set, null for an empty one), bands, sketch."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for b in pieces_of(batches, "_text"):
            sets = shingle_sets(b.column(1), k, words)
            some = [i for i, s in enumerate(sets) if len(s)]
            mins = np.array([min_samples(sets[i]) for i in some], np.uint32).reshape(-1, BANDS * ROWS)
            # Row number in the lists for each text; none for empty sets.
            at = pa.array(np.cumsum([len(s) > 0 for s in sets]) - 1, mask=np.array([not len(s) for s in sets]))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())).cast(longs).take(at) for x in (band_keys(mins), odd_sketch(mins))]
            node = [node_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.int64()), *lists], names=["id", "n_shingles", "node", "bands", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("id"), docs[text].alias("_text")).mapInArrow(run, f"id {kind}, n_shingles bigint, node bigint, bands array<bigint>, sketch array<bigint>")


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of (id, _text) whose id is in ``ids``.

    A bitmap of the ids' hashes, of ``FILTER_WORDS`` words whatever the corpus, drops most other
    texts before they are shuffled; once a very large corpus has filled it, all texts are.
    """
    slot = lambda: F.pmod(F.xxhash64("id"), F.lit(64 * FILTER_WORDS))
    words = ids.groupBy(F.shiftright(slot(), 6).alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, CAST(pmod(xxhash64(id), {64 * FILTER_WORDS}) & 63 AS INT)))").alias("_mask"))
    hashed = docs.withColumn("_slot", slot())
    # One row for each word of the bitmap: a proven bound.
    likely = hashed.join(F.broadcast(words), F.shiftright("_slot", 6) == F.col("_word")).where("bit_get(_mask, CAST(_slot & 63 AS INT)) = 1")
    # Not a semi-join, which would be moved before the filter.
    return likely.select("id", "_text").join(ids.distinct(), "id")


def _sets(docs: DataFrame, ids: DataFrame, nodes: DataFrame, k: int, key: str, text: str, words: int) -> DataFrame:
    """node and packed shingle set, once for each of ``nodes``, from documents with those ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, "_text"):
            sets = [s for s in shingle_sets(b.column(1), k, words) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "set"])

    texts = _among(docs.select(docs[key].alias("id"), docs[text].alias("_text")), ids)
    return texts.mapInArrow(run, "node bigint, set binary").join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _fine(sets: DataFrame) -> DataFrame:
    """node and fine sketch of (node, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fine = [odd_sketch(min_samples(np.frombuffer(s.as_buffer(), np.uint64), _FINE_XOR, _FINE_MUL), _FINE_PERM, FINE_BITS).tobytes() for s in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fine, pa.binary())], names=["node", "fine"])

    return sets.select("node", "set").mapInArrow(run, "node bigint, fine binary")


def _differing_bits() -> str:
    return " + ".join(f"bit_count(sa[{i}] ^ sb[{i}])" for i in range(SKETCH_WORDS))


def linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of two sorted sets."""
    if len(s) > len(t):
        s, t = t, s
    if not len(s) or 100 * len(s) < percent * len(t):
        return False
    both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
    return 100 * both >= percent * (len(s) + len(t) - both)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b), those with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(sets.toDF("b", "tb"), "b")
    both = with_b.join(sets.toDF("a", "ta"), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def unite(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Merge the classes of u[i] and v[i]: the new class numbers, and the i that merged two classes."""
    used: list[int] = []
    at = np.arange(len(u))
    while True:
        at = at[root[u[at]] != root[v[at]]]
        if not len(at):
            return root, used
        x, y = root[u[at]], root[v[at]]
        high, first = np.unique(np.maximum(x, y), return_index=True)
        to = np.arange(len(root))
        to[high] = np.minimum(x, y)[first]
        while (to[to] != to).any():
            to = to[to]
        root = to[root]
        used += at[first].tolist()


def _in_blocks(rows: DataFrame, group: str, compare: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """What ``compare`` returns, as (a, b), for all pairs of blocks of each group's rows.

    rows: group, node, label, bytes and more. Groups are cut into blocks by hash, of about
    ``BLOCK`` rows and ``BLOCK_BYTES`` bytes at most, so that no task holds more than two of
    them. The column side of a table is 1 for the second block of two.
    """
    more = [c for c in rows.columns if c != group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None

        def done() -> Iterator[pa.RecordBatch]:
            if held and sum(b.num_rows for b in held) > 1:
                a, b = compare(pa.Table.from_batches(held).combine_chunks())
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            g = np.stack([b.column(c).to_numpy() for c in (0, 1, 2)])
            cut = np.nonzero((np.diff(g, axis=1) != 0).any(axis=0))[0] + 1
            for x, y in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
                new = tuple(int(v) for v in g[:, x])
                if name is not None and new != name:
                    yield from done()
                    held = []
                name = new
                held.append(b.slice(x, y - x))
        yield from done()

    size = rows.groupBy(group).agg(F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("nb"))
    own = rows.join(size, group).withColumn("o", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    dealt = own.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.select(group, F.least("o", "p").alias("i"), F.greatest("o", "p").alias("j"), (F.col("o") > F.col("p")).cast("int").alias("side"), *more)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, group, "i", "j").sortWithinPartitions(group, "i", "j").mapInArrow(run, "a bigint, b bigint")


def _close(t: pa.Table, labels: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers u, v of different labels whose sizes and fine sketches allow a link, and the bits
    in which these differ; some hundred thousand pairs at a time at most."""
    sizes, side = t.column("n").to_numpy(), t.column("side").to_numpy()
    # Unsigned: numpy counts the bits of absolute values.
    words = np.frombuffer(b"".join(t.column("fine").to_pylist()), np.uint64).reshape(len(sizes), -1)
    lone = not side.any()
    i = np.nonzero(side == 0)[0]
    j = i if lone else np.nonzero(side == 1)[0]
    for at in range(0, len(i), 128):
        r = i[at : at + 128]
        ok = (labels[r][:, None] != labels[j][None, :]) & (100 * np.minimum(sizes[r][:, None], sizes[j][None, :]) >= percent * np.maximum(sizes[r][:, None], sizes[j][None, :]))
        if lone:
            ok &= r[:, None] < j[None, :]
        p, q = np.nonzero(ok)
        p, q = r[p], j[q]
        found = []
        for x in range(0, len(p), 1 << 14):
            u, v = p[x : x + (1 << 14)], q[x : x + (1 << 14)]
            bits = np.bitwise_count(words[u] ^ words[v]).sum(axis=1)
            near = bits <= MOST_FINE
            found.append((u[near], v[near], bits[near]))
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _close_forest(rows: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b), at most one a row and block, that connect all rows of one key with close sketches.

    rows: key, node, label, n, fine.
    """

    def compare(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        nodes, out = t.column("node").to_numpy(), []
        labels = np.unique(t.column("label").to_numpy(), return_inverse=True)[1]
        root = np.arange(len(nodes))
        for u, v, _ in _close(t, labels, percent) if labels.any() else ():
            root, used = unite(root, u, v)
            out += [(nodes[u[x]], nodes[v[x]]) for x in used]
        return tuple(np.array(out, np.int64).reshape(-1, 2).T)

    return _in_blocks(rows.withColumn("bytes", F.lit(8)), "key", compare)


def _linked_forest(rows: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b), at most one a row and block, that connect all linked rows of a group.

    rows: key (of the group), node, label, n, fine, set. Pairs whose labels meet through links found
    before aren't compared, which is why near-equal ones come first.
    """

    def compare(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        nodes, out = t.column("node").to_numpy(), []
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("set").combine_chunks()]
        root = np.unique(t.column("label").to_numpy(), return_inverse=True)[1]
        for u, v, bits in _close(t, root, percent) if root.any() else ():
            order = np.argsort(bits, kind="stable")
            for x, y in zip(u[order].tolist(), v[order].tolist(), strict=True):
                if root[x] != root[y] and linked(sets[x], sets[y], percent):
                    root[root == root[y]] = root[x]
                    out.append((nodes[x], nodes[y]))
        return tuple(np.array(out, np.int64).reshape(-1, 2).T)

    return _in_blocks(rows.withColumn("bytes", F.octet_length("set")), "key", compare)


def near_components(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_shingles, component_id (smallest key reachable) and kept (key = component_id).

    One row per input row. Sets: distinct k-word shingles of the lower-cased (A-Z) words;
    fewer words than k count as one shingle; a null or empty text has none and is linked with
    nothing. Rows that repeat a key share its component. A null key is linked with nothing:
    its component_id is null and it is kept. Keys are whole numbers; other columns are left out.

    ``percent`` is 80 or more: bands and sketch bounds are made for that.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be 80 to 100")
    words = fresh_key()
    sig = saved(signatures(docs, k, key, text, words), "signatures")
    own = sig.where("node IS NOT NULL AND id IS NOT NULL")
    classes = saved(own.groupBy("node").agg(F.min("id").alias("rep")), "classes")
    reps = own.join(classes.select("node", F.col("rep").alias("id")), ["node", "id"], "left_semi").dropDuplicates(["node"])
    reps = saved(reps.select("node", F.col("n_shingles").alias("n"), "bands", "sketch"), "representatives")
    banded = reps.select(F.explode("bands").alias("key"), "node")
    ends = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    live = saved(banded.join(ends, "key", "left_semi").distinct(), "buckets")
    nodes = live.select("node").distinct()
    sketches = saved(reps.drop("bands").join(nodes, "node", "left_semi"), "sketches")
    sizes = sketches.select("node", "n")
    sets = saved(_sets(docs, classes.join(nodes, "node", "left_semi").select(F.col("rep").alias("id")), nodes, k, key, text, words), "sets")

    links = tested = classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    roots = links.toDF("node", "label")
    allowed = f"100 * least(na, nb) >= {percent} * greatest(na, nb) AND {_differing_bits()} <= {MOST_BITS}"
    for step in range(STAR_ROUNDS + 1):
        lab = live.join(roots, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        mixed = lab.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by(F.struct("node", "label"), F.xxhash64("node", F.lit(step))).alias("c")).where("lo < hi")
        if step < STAR_ROUNDS:
            star = lab.join(mixed.select("key", "c"), "key").where("label <> c.label").select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"), "node")
            star = star.distinct().join(tested, ["a", "b"], "left_anti")
            star = star.join(sketches.toDF("a", "na", "sa"), "a").join(sketches.toDF("b", "nb", "sb"), "b").where(allowed)
            best = star.groupBy("node").agg(F.min_by(F.struct("a", "b"), F.expr(_differing_bits())).alias("p"))
            pairs = saved(best.select("p.a", "p.b").distinct(), "pairs")
            if pairs.isEmpty():
                continue
            found = saved(_verify(pairs, sets, percent), "links")
            tested = tested.unionAll(pairs)
        else:
            left = saved(lab.join(mixed.select("key"), "key", "left_semi"), "left")
            wanted = left.select("node", "label").distinct()
            fine = saved(_fine(sets.join(wanted.select("node"), "node", "left_semi")).join(sizes, "node"), "fine")
            edges = saved(_close_forest(left.join(fine, "node"), percent), "close")
            group = components(edges).toDF("node", "key")
            found = saved(_linked_forest(group.join(wanted, "node").join(fine, "node").join(sets, "node"), percent), "links")
        links = links.unionAll(found)
        roots = saved(components(links).toDF("node", "label"), "roots")

    # Classes meet through keys they share.
    member = own.select("id", "node")
    shared = member.groupBy("id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("id", F.col("lo").alias("a"))
    if not shared.isEmpty():
        meet = member.join(shared, "id").select("a", F.col("node").alias("b")).distinct()
        roots = saved(components(links.unionAll(meet)).toDF("node", "label"), "roots")
    labelled = classes.join(roots, "node", "left").select("node", "rep", F.coalesce("label", "node").alias("label"))
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_node = labelled.where("label <> node").join(least, "label").select("node", "component_id").unionAll(least.toDF("node", "component_id"))
    of_id = member.join(of_node, "node").groupBy("id").agg(F.min("component_id").alias("component_id"))
    out = sig.select("id", "n_shingles").join(of_id, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(key), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
