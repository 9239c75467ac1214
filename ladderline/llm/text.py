"""What the text operators share: words, hashes, chunked tokenisation, the shared folder."""

from __future__ import annotations

import atexit
import ctypes
import gc
import hashlib
import os
import re
import secrets
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Collection, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern, as a Java and DuckDB character class.
SPACE = r"[\x20\x09-\x0D]"

#: Rows of an Arrow batch at most.
ARROW_ROWS = 1000

_own_dir: str | None = None
_shipped: set[str] = set()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors see.

    Where that setting is absent a temporary folder of this process stands in on a local master;
    on a cluster, whose executors would each write to a disk of their own, it is an error.
    Folders go when the JVM ends.
    """
    global _own_dir
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _own_dir is None:
            _own_dir = tempfile.mkdtemp(prefix="ladderline-")
            atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
        base = f"file://{_own_dir}"
    out = f"{base.rstrip('/')}/ladderline-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(out)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return out


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    out = shared_dir(spark, label)
    df.write.option("compression", "zstd").parquet(out)
    return spark.read.schema(df.schema).parquet(out)


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, so that workers can import it.

    Also bounds Arrow batches: rows hold whole texts, and each task has a batch in the JVM and
    one or two in its worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(root)
    folder = tempfile.mkdtemp(prefix="ladderline-src-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    out = os.path.join(folder, "ladderline_src.zip")
    with zipfile.ZipFile(out, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), top))
    spark.sparkContext.addPyFile(out)
    _shipped.add(app)


def free(name: str, taken: Collection[str]) -> str:
    """``name``, with as many underscores before it as it takes to clash with none, in any case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


_caches: dict[str, Callable[[], None]] = {}
_user = ""


def cached_by(user: str, clear: Callable[[], None]) -> None:
    """Names the operator for which a worker keeps something between tasks, and how to drop it."""
    _caches[user] = clear


def begin(user: str) -> None:
    """Called where a task of an operator starts. A worker outlives its tasks: what it kept for
    another operator goes, and freed memory goes back to the system."""
    global _user
    if user == _user:
        return
    _user = user
    for name, clear in _caches.items():
        if name != user:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lower_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text with A-Z lower-cased; none for null."""
    return text.lower().split() if text else []


MIX_A, MIX_B, MIX_C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on each other (xor-shift-multiply)."""
    x = (x ^ (x >> np.uint64(32))) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return x ^ (x >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words (of the whole sequence where there are fewer)."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = scramble(out * MIX_C + h[j : len(h) - k + 1 + j] + np.uint64(j + 1))
    return out


def pieces_of(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most`` bytes of text each, one row at least."""
    for b in batches:
        col = b.column(b.schema.get_field_index(text))
        if b.num_rows == 0:
            continue
        col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
        sizes = np.frombuffer(col.buffers()[1], np.int64, col.offset + b.num_rows + 1)[col.offset :]
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + most, side="right")) - 1)
            yield b.slice(at, to - at)
            at = to


def as_bytes(col: pa.Array) -> list[bytes | None]:
    return col.cast(pa.binary()).to_pylist()


_MARKS = ".,;:!?#$%&*"
#: Bytes that are encoded together, longest chunk whose ids are kept.
_STEP, _LONGEST = 2 << 20, 256


class _ByteHash:
    """64-bit hashes of substrings of a buffer, all from one running sum.

    sum of t[byte] * b^i over a substring, divided by b^start: b is odd, so it has an inverse.
    Strings can be made to collide, so whoever looks something up by these compares bytes too.
    """

    _t = scramble(np.arange(1, 257, dtype=np.uint64) * MIX_A)
    _b = np.uint64(0x2545F4914F6CDD1D)
    _power = _inverse = np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._power) < n:
            # b * x = 1 modulo 2^64, each step doubles the right bits.
            x = int(cls._b)
            for _ in range(6):
                x = x * (2 - int(cls._b) * x) % (1 << 64)
            factors = np.ones((2, n), np.uint64)
            factors[0, 1:], factors[1, 1:] = cls._b, x
            cls._power, cls._inverse = np.multiply.accumulate(factors, axis=1)

    def __init__(self, data: np.ndarray):
        self._grow(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._t[data] * self._power[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64) * MIX_C)


def _runs(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (length[0] of them), first[1], ..."""
    ends = np.cumsum(length)
    return np.repeat(first - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


#: Longest word, in bytes, that the multilinear hash takes; longer ones go through blake2b.
_WORD = 4096
_FACTOR = (_LOWER.astype(np.uint64) + np.uint64(1))
#: Key of hashes that must mean the same in every run.
FIXED_KEY = 20240607


def fresh_key() -> int:
    """A random key for the word hashes of one run, drawn on the driver and sent with its tasks:
    nobody can write texts that collide under a key that isn't there yet."""
    return secrets.randbits(63)


@lru_cache(maxsize=4)
def _multipliers(key: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=key)).integers(0, 1 << 64, _WORD, dtype=np.uint64)


def _words_in(data: np.ndarray, offs: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows, and where each row's begin and the last's end.

    A word's hash is the sum of (byte + 1) * r[place] modulo 2^64 for random r: two words differ
    in a coefficient below 256, so they collide with at most 2^-57 over the choice of r.
    """
    full = ~_BLANK[data]
    begins, stops = full.copy(), full.copy()
    begins[1:] &= ~full[:-1]
    stops[:-1] &= ~full[1:]
    # A row's first byte begins a word whatever stands before it, and its last byte ends one.
    head, tail = offs[:-1][np.diff(offs) > 0], offs[1:][np.diff(offs) > 0] - 1
    begins[head], stops[tail] = full[head], full[tail]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    at = np.searchsorted(start, offs)
    size = (end - start).astype(np.int32)
    if not len(size):
        return np.zeros(0, np.uint64), at
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), size)
    long = np.flatnonzero(size > _WORD)
    r = _multipliers(key)
    out = scramble(np.add.reduceat(_FACTOR[data[full]] * (r[place % _WORD] if len(long) else r[place]), first))
    for i in long.tolist():
        word = _LOWER[data[start[i] : end[i]]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=key.to_bytes(8, "little")).digest(), "little")
    return out, at


def word_hashes(texts: pa.Array, key: int = FIXED_KEY) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of texts with A-Z lower-cased, row after
    row, and where each row's begin and the last's end. Null counts as empty."""
    # Small steps: a hash takes some 40 bytes for each byte of a step while it runs.
    data, offs = _buffers(texts)
    step, parts, ends, total, r = _STEP // 8, [], [np.zeros(1, np.int64)], 0, 0
    while r < len(offs) - 1:
        to = max(r + 1, int(np.searchsorted(offs, offs[r] + step, side="right")) - 1)
        x, y = int(offs[r]), int(offs[to])
        if y - x <= 2 * step:
            h, at = _words_in(data[x:y], offs[r : to + 1] - x, key)
            end = at[1:]
        else:  # one long text, cut at blanks
            each = []
            while x < y:
                blank = np.flatnonzero(_BLANK[data[min(y, x + step) : min(y, x + 2 * step)]])
                cut = min(y, x + step) + int(blank[0]) if len(blank) else y
                each.append(_words_in(data[x:cut], np.array([0, cut - x]), key)[0])
                x = cut
            h = np.concatenate(each)
            end = np.array([len(h)])
        parts.append(h)
        ends.append(end + total)
        total, r = total + len(h), to
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(ends)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column, and where each row's begin and the last's end."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(col)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    return data, np.frombuffer(col.buffers()[1], np.int64, col.offset + n + 1)[col.offset :] if n else np.zeros(1, np.int64)


class _Kept:
    """Ids by hash: sorted hashes, where in a pool their ids are, and the bytes that they are for.
    A length of -1 says that the chunk can't stand by itself. Beyond ``most`` entries the half
    met longest ago goes."""

    def __init__(self, most: int):
        self.most, self.now = most, 0
        self.key, self.at, self.len, self.seen = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.text, self.text_used = np.zeros(1 << 16, np.uint8), 0
        self.text_at, self.text_len = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes, and which of them are there."""
        if not len(self.key):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[i] == key
        self.seen[i[hit]] = self.now
        return i, hit

    def differ(self, i: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which substrings of data are not the bytes that entries i are for."""
        size = (end - start).astype(np.int32)
        bad = self.text_len[i] != size
        # Where lengths differ no byte needs to be read.
        size[bad] = 0
        last = np.cumsum(size)
        place = np.arange(last[-1] if len(last) else 0, dtype=np.int32)
        ours = np.repeat((start - (last - size)).astype(np.int32), size) + place
        theirs = np.repeat(self.text_at[i] - (last - size), size) + place
        wrong = np.flatnonzero(data[ours] != self.text[theirs])
        bad[np.searchsorted(last, wrong, side="right")] = True
        return bad

    def append(self, ids: np.ndarray) -> int:
        """Put ids at the end of the pool; where they are."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + len(ids), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def add(self, key: np.ndarray, ids: list[bytes | None], text: list[bytes]) -> None:
        """New hashes, in any order, with the ids of the bytes that they are for."""
        n = np.array([-1 if x is None else len(x) // 4 for x in ids], np.int32)
        at = self.append(np.frombuffer(b"".join([x for x in ids if x]), "<u4")) + np.cumsum(n.clip(0)) - n.clip(0)
        flat, size = np.frombuffer(b"".join(text), np.uint8), np.array([len(x) for x in text], np.int32)
        if self.text_used + len(flat) > len(self.text):
            self.text = np.concatenate([self.text[: self.text_used], np.zeros(self.text_used + len(flat), np.uint8)])
        self.text[self.text_used : self.text_used + len(flat)] = flat
        text_at = self.text_used + np.cumsum(size) - size
        self.text_used += len(flat)
        order = np.argsort(key)
        where = np.searchsorted(self.key, key[order])
        self.key, self.at, self.len, self.text_at, self.text_len = (
            np.insert(x, where, y[order]) for x, y in ((self.key, key), (self.at, at), (self.len, n), (self.text_at, text_at), (self.text_len, size))
        )
        self.seen = np.insert(self.seen, where, self.now)

    def turn(self) -> None:
        self.now += 1
        if len(self.key) > self.most:
            stay = np.sort(np.argsort(-self.seen, kind="stable")[: self.most // 2])
            self.key, self.at, self.len, self.seen, self.text_at, self.text_len = (x[stay] for x in (self.key, self.at, self.len, self.seen, self.text_at, self.text_len))
            n = self.len.clip(0).astype(np.int64)
            self.pool = self.pool[_runs(self.at, n)]
            self.used, self.at = len(self.pool), np.cumsum(n) - n
            m = self.text_len.astype(np.int64)
            self.text = self.text[_runs(self.text_at, m)]
            self.text_used, self.text_at = len(self.text), np.cumsum(m) - m


class ChunkEncoder:
    """Token ids of whole texts from ids of their space-separated chunks.

    A byte-level BPE pre-token never spans a single space that has other characters on both
    sides; it can only begin with it. So a text is the sequence of its chunks (each a space
    and what follows up to the next space), and ids of a chunk depend on it alone. Distinct
    chunks of a few MB of text are found by 64-bit hashes, and ids of those met lately are kept
    (``most`` of them, some 60 bytes each) with their bytes. Every chunk is compared with the
    bytes that its hash stands for; one that differs is encoded by itself. Texts where a space touches other white space, or
    that hold one of ``apart`` (added tokens), go through ``whole`` instead.

    Where the pattern makes letters, a run of marks and a line feed pre-tokens of their own,
    which is tried out once, a new chunk is put together from those, mostly known, parts.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], whole: Callable[[str], bytes], most: int = 1 << 20, apart: tuple[str, ...] = ()):
        self.encode, self.whole, self.apart = encode, whole, [x.encode() for x in apart]
        self.kept = _Kept(most)
        #: Strings that no space precedes.
        self.bare: dict[str, bytes] = {}
        cut = encode([" ab.?\nCd$$,", " ab", ".?", "\n", "Cd", "$$,"])
        self.line = cut[3]
        self.in_parts = cut[0] == b"".join(cut[1:])

    def _bare(self, strings: set[str]) -> dict[str, bytes]:
        if len(self.bare) > 100_000:
            self.bare = {}
        if new := [*strings.difference(self.bare)]:
            self.bare.update(zip(new, self.encode(new), strict=True))
        return self.bare

    def _learn(self, key: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray, hashes: _ByteHash) -> None:
        """Add new chunks, given by their hashes and places."""
        raw, plain, other, blank, made = data.tobytes(), [], [], [], []
        text = [raw[x:y].decode() for x, y in zip(start.tolist(), end.tolist(), strict=True)]
        for i, c in enumerate(text):
            if c.isalpha():
                plain.append(i)
                continue
            a = c.rstrip(_MARKS)
            if a.isalpha() and self.in_parts:
                made.append((i, a, c[len(a) :], "", ""))
                continue
            if not c or c[0].isspace() or c[-1].isspace():
                blank.append(i)
                continue
            x, _, y = c.partition("\n")
            a, b = x.rstrip(_MARKS), y.rstrip(_MARKS)
            if a.isalpha() and b.isalpha() and self.in_parts:
                made.append((i, a, x[len(a) :], b, y[len(b) :]))
            else:
                other.append(i)
        todo = plain + other
        strings, keys = [" " + text[i] for i in todo], key[todo]
        if made:
            first = start[[x[0] for x in made]]
            last = first + np.array([len(x[1]) if x[1].isascii() else len(x[1].encode()) for x in made])
            core = hashes.of(first, last)
            distinct, one = np.unique(core, return_index=True)
            new = ~self.kept.find(distinct)[1] & ~np.isin(distinct, keys)
            strings += [" " + made[i][1] for i in one[new].tolist()]
            keys = np.concatenate([keys, distinct[new]])
        ids: list[bytes | None] = []
        for i in range(0, len(strings), 4096):
            ids += self.encode(strings[i : i + 4096])
        self.kept.add(np.concatenate([keys, key[blank]]), ids + [None] * len(blank), [x[1:].encode() for x in strings] + [text[i].encode() for i in blank])
        if made:
            bare = self._bare({p for x in made for p in x[2:] if p}) | {"": b""}
            i, _ = self.kept.find(core)
            at, n = self.kept.at[i], self.kept.len[i]
            cores = [self.kept.pool[x:y].tobytes() for x, y in zip(at.tolist(), (at + n).tolist(), strict=True)]
            for j in np.flatnonzero(self.kept.differ(i, data, first, last)).tolist():
                cores[j] = self.encode([" " + made[j][1]])[0]
            whole = [c + bare[m] + (self.line + bare[b] + bare[n] if b else b"") for c, (_, _, m, b, n) in zip(cores, made, strict=True)]
            self.kept.add(key[[x[0] for x in made]], whole, [text[x[0]].encode() for x in made])

    def _flat(self, data: np.ndarray, offs: np.ndarray, head: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows, one after the other, and where each row's end. Without ``head`` the first
        row goes on after a space."""
        n, kept = len(offs) - 1, self.kept
        space = np.flatnonzero(data == 32)
        of = np.searchsorted(offs[1:], space, side="right")
        first = np.arange(n) + np.searchsorted(space, offs[:-1])
        start = np.empty(n + len(space), np.int64)
        start[first], start[np.arange(len(space)) + of + 1] = offs[:-1], space + 1
        end = np.append(start[1:] - 1, 0)
        end[np.append(first[1:], len(end)) - 1] = offs[1:]
        row = np.zeros(len(start), np.int64)
        row[first[1:]] = 1
        row = np.cumsum(row)
        alone = np.zeros(len(start), bool)  # chunks that are encoded by themselves
        alone[first if head else first[1:]] = True
        long = ~alone & (end - start > _LONGEST)
        alone |= long
        common = np.flatnonzero(~alone)
        kept.turn()
        hashes = _ByteHash(data)
        key, one, inverse = np.unique(hashes.of(start[common], end[common]), return_index=True, return_inverse=True)
        _, hit = kept.find(key)
        if not hit.all():
            new = common[one[~hit]]
            self._learn(key[~hit], start[new], end[new], data, hashes)
        i = kept.find(key)[0][inverse]
        at, size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        at[common], size[common] = kept.at[i], kept.len[i]
        other = common[kept.differ(i, data, start[common], end[common])]
        alone[other] = long[other] = True
        size[other] = 0
        raw = data.tobytes()
        text = lambda x, y: raw[x:y].decode()
        single = np.flatnonzero(alone)
        strings = [(" " if far else "") + text(x, y) for far, x, y in zip(long[single].tolist(), start[single].tolist(), end[single].tolist(), strict=True)]
        size[single[[k for k, c in enumerate(strings) if c and c[-1].isspace() or c[:1] == " " and c[1:2].isspace()]]] = -1
        bad = np.zeros(n, bool)
        bad[row[size < 0]] = True
        for x in self.apart:
            p = raw.find(x)
            while p >= 0:
                bad[np.searchsorted(offs[1:], p, side="right")] = True
                p = raw.find(x, p + 1)
        size[bad[row]] = 0
        good = np.flatnonzero(~bad[row[single]] & (end[single] > start[single]))
        odd = np.flatnonzero(bad)
        more = self.encode([strings[k] for k in good.tolist()]) + [self.whole(("" if head or r else " ") + text(offs[r], offs[r + 1])) for r in odd.tolist()]
        # These ids stand behind those that are kept, for this call only.
        mark, lens = kept.used, np.array([len(x) // 4 for x in more], np.int64)
        where = np.concatenate([single[good], first[odd]])
        at[where], size[where] = kept.append(np.frombuffer(b"".join(more), "<u4")) + np.cumsum(lens) - lens, lens
        flat = kept.pool[_runs(at, size)]
        kept.used = mark
        return flat, np.cumsum(np.bincount(row, size, minlength=n).astype(np.int64))

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Unsigned 32-bit ids of all rows, one after the other, and where each row's begin and the
        last's end. Null counts as empty."""
        data, offs = _buffers(texts)
        n, parts, ends, total, r = len(offs) - 1, [], [np.zeros(1, np.int64)], 0, 0
        while r < n:
            to = max(r + 1, int(np.searchsorted(offs, offs[r] + _STEP, side="right")) - 1)
            if offs[to] - offs[r] <= 2 * _STEP:
                flat, end = self._flat(data[offs[r] : offs[to]], offs[r : to + 1] - offs[r])
            else:  # one long text
                flat = self._long(data[offs[r] : offs[to]])
                end = np.array([len(flat)])
            parts.append(flat)
            ends.append(end + total)
            total, r = total + len(flat), to
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.concatenate(ends)

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Ids of a text that is cut at spaces with no white space beside them, or taken whole."""
        at, parts, raw = 0, [], data.tobytes()
        if any(x in raw for x in self.apart):
            return np.frombuffer(self.whole(raw.decode()), "<u4")
        while at < len(data):
            cut = raw.find(b" ", at + _STEP)
            while 0 <= cut < len(raw) - 1 and (raw[cut - 1] >= 128 or raw[cut + 1] >= 128 or raw[cut - 1 : cut].isspace() or raw[cut + 1 : cut + 2].isspace()):
                cut = raw.find(b" ", cut + 1)
            to = len(raw) if cut < 0 or cut >= len(raw) - 1 else cut
            piece = data[at:to]
            # A space that leads a piece leads its first chunk.
            flat = self._flat(piece[1:], np.array([0, len(piece) - 1]), head=False)[0] if at else self._flat(piece, np.array([0, len(piece)]))[0]
            parts.append(flat)
            at = to
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null counts as empty."""
        flat, ends = self.column(pa.array(texts, pa.large_string()))
        raw = flat.astype("<u4").tobytes()
        return [raw[4 * x : 4 * y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
