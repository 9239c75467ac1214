"""How the tokens of two tokenizers lie on each other, by a dictionary of groups.

Both tokenizers cut one byte string; where a token of each ends at the same byte, the string is cut
into groups. A group is its ids of both, so what lies inside it, the pairs of overlapping tokens, is
the same wherever it occurs: groups are interned, links are expanded once for each distinct group,
and a corpus is a list of group numbers with frequencies.

One pass over the texts writes, for each block of some MB, its distinct groups, its documents as
(group, frequency) and, for each pair of ids, how many of its documents hold it. Pair counts are
added up; the dictionary is joined with them once, which gives each group's figures; these go back
to the blocks by group key, a row for each group and block, and documents are sums over their
block's groups. So a common group, or pair, is one row a block whatever its frequency.

Texts are tokenised in chunks between single spaces, which no token of either side reaches over
(of the piece model that is checked when it is loaded), so each distinct chunk is tokenised and
cut once in a block or more.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import begin, cached_by, pieces_of, saved, ship

#: Bytes of text in a block; characters of chunks, with 64 for each, that a worker keeps from one
#: block to the next (some 250 MB with all that belongs to them).
BLOCK, KEPT = 8 << 20, 64 << 20
#: A space between two characters that are no white space.
_SPLIT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" \s|\s ")


def chunks_of(text: str) -> list[str]:
    """The text cut at single spaces, which are left out."""
    if text[0].isspace() or text[-1].isspace() or _ODD.search(text):
        return _SPLIT.split(text)
    return text.split(" ")


def _byte_level() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable ones stand for themselves, the others, in
    order, for characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def byte_tokens(path: str) -> tuple[object, list[bytes]]:
    """A byte-level tokenizer of the tokenizers library, without special tokens, and the bytes of its ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    vocab, of = t.get_vocab(with_added_tokens=True), _byte_level()
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return t, out


def piece_tokens(path: str) -> tuple[object, list[bytes]]:
    """A sentencepiece model, and the bytes of its ids; a piece may hold a space only where it begins."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("pieces of this model reach over spaces")
    return sp, [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def cuts(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> list[tuple[int, int, int, int]]:
    """Where the groups of both sides begin and end, in a and in b: cut where tokens of both end."""
    out, i, j, n = [], 0, 0, len(a)
    while i < n:
        i0, j0 = i, j
        x, y = a_size[a[i]], b_size[b[j]]
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                x += a_size[a[i]]
                i += 1
            else:
                y += b_size[b[j]]
                j += 1
        out.append((i0, i, j0, j))
    return out


def links_of(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> list[int]:
    """Pairs of a group's tokens whose bytes overlap, each as a * 2^32 + b, in order."""
    out, i, j = [], 0, 0
    x, y = a_size[a[0]], b_size[b[0]]
    while True:
        out.append(a[i] << 32 | b[j])
        step_a, step_b = x <= y, y <= x
        i, j = i + step_a, j + step_b
        if i == len(a) or j == len(b):
            return out
        if step_a:
            x += a_size[a[i]]
        if step_b:
            y += b_size[b[j]]


def _take(off: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """data[off[i] : off[i + 1]] for each i of at, one after the other."""
    size = off[at + 1] - off[at]
    last = np.cumsum(size)
    return data[np.repeat(off[at] - (last - size), size) + np.arange(last[-1] if len(last) else 0)]


class Aligner:
    """Both tokenizers, and what is known of the chunks and groups met."""

    def __init__(self, byte_path: str, piece_path: str):
        (self.a, self.a_bytes), (self.b, self.b_bytes) = byte_tokens(byte_path), piece_tokens(piece_path)
        self.a_size, self.b_size = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.forget()

    def forget(self) -> None:
        #: Chunk to number; by number: its groups as text (None: no tokens), its ids' numbers.
        self.number: dict[str, int] = {}
        self.text: list[str | None] = []
        self.n_a, self.n_b = array("i"), array("i")
        self.group_off, self.group_at = array("q", [0]), array("i")
        #: Group (its pair, or the ids of both sides) to number; by number: its key and its pairs.
        #: Pair to number.
        self.group: dict[int | tuple[int, ...], int] = {}
        self.key: list[str] = []
        self.pair_off, self.pair_at = array("q", [0]), array("i")
        self.pair: dict[int, int] = {}
        self.chars = 0

    def _groups(self, a: list[int], b: list[int]) -> list[int]:
        """Numbers of the groups of a chunk; new ones are written out and expanded to pairs."""
        out, known = [], self.group
        for i0, i, j0, j in cuts(a, b, self.a_size, self.b_size):
            k = a[i0] << 32 | b[j0] if i - i0 == 1 == j - j0 else (*a[i0:i], -1, *b[j0:j])
            g = known.get(k)
            if g is None:
                g = known[k] = len(known)
                x, y = a[i0:i], b[j0:j]
                self.key.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
                self.pair_at.extend(self.pair.setdefault(p, len(self.pair)) for p in dict.fromkeys(links_of(x, y, self.a_size, self.b_size)))
                self.pair_off.append(len(self.pair_at))
            out.append(g)
        return out

    def learn(self, chunks: list[str]) -> None:
        """Number new chunks: each, after a space, is tokenised, compared with its bytes and cut."""
        a_ids = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        for c, a, b in zip(chunks, a_ids, self.b.encode(chunks, out_type=int, num_threads=1), strict=True):
            want = (" " + c).encode()
            self.number[c] = len(self.text)
            self.chars += len(c) + 64
            if b"".join([self.a_bytes[i] for i in a]) == want == b"".join([self.b_bytes[i] for i in b]):
                found = self._groups(a, b)
                self.text.append(";".join([self.key[g] for g in found]))
                self.group_at.extend(found)
                self.n_a.append(len(a))
                self.n_b.append(len(b))
            else:
                self.text.append(None)
                self.n_a.append(0)
                self.n_b.append(0)
            self.group_off.append(len(self.group_at))

    def chunks(self, texts: list[str | None]) -> list[np.ndarray]:
        """Chunk numbers of each text: none for null, empty and texts whose tokens don't give them back."""
        cut = [chunks_of(t) if t else [] for t in texts]
        if new := list({c for x in cut for c in x if c not in self.number}):
            self.learn(new)
        out = []
        for t, x in zip(texts, cut, strict=True):
            at = np.array([self.number[c] for c in x], np.int64)
            if any(self.text[i] is None for i in set(at.tolist())):
                # Taken whole, as the text's tokens are defined.
                if t not in self.number:
                    self.learn([t])
                at = np.array([self.number[t]] if self.text[self.number[t]] is not None else [], np.int64)
            out.append(at)
        return out


_made: dict[tuple[str, str], Aligner] = {}
cached_by("alignment", _made.clear)


def aligner_of(byte_path: str, piece_path: str) -> Aligner:
    begin("alignment")
    key = (byte_path, piece_path)
    if key not in _made:
        _made[key] = Aligner(*key)
    return _made[key]


class Block:
    """Documents of one block: their groups by number, and pair counts."""

    def __init__(self, aligner: Aligner, number: int):
        self.al, self.number, self.bytes = aligner, number, 0
        if aligner.chars > KEPT:
            aligner.forget()
        self.ids: list = []
        self.figures: list[tuple[int, int, int, str]] = []
        self.groups: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []

    def add(self, batch: pa.RecordBatch) -> None:
        al = self.al
        texts = batch.column(1).to_pylist()
        cut = al.chunks(texts)
        off, at, pair_off, pair_at = np.array(al.group_off), np.array(al.group_at), np.array(al.pair_off), np.array(al.pair_at)
        n_a, n_b = np.array(al.n_a), np.array(al.n_b)
        for c in cut:
            flat = _take(off, at, c)
            g, n = np.unique(flat, return_counts=True)
            self.groups.append(g.astype(np.int64))
            self.times.append(n)
            self.pairs.append(np.unique(_take(pair_off, pair_at, g)))
            digest = hashlib.sha256(";".join([al.text[i] for i in c.tolist()]).encode()).hexdigest() if len(c) else ""
            self.figures.append((int(n_a[c].sum()), int(n_b[c].sum()), len(flat), digest))
        self.ids.append(batch.column(0))
        self.bytes += sum(len(t) for t in texts if t)

    def rows(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Rows of the block: documents (kind 0), groups (1), pair counts (2)."""
        if not self.figures:
            return
        flat = np.concatenate(self.groups)
        used, local = np.unique(flat, return_inverse=True)
        ends = pa.array(np.concatenate([[0], np.cumsum([len(g) for g in self.groups])]).astype(np.int32))
        n_a, n_b, n_g, digest = zip(*self.figures, strict=True)
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (local, np.concatenate(self.times))]
        ids = pa.chunked_array(self.ids).combine_chunks()
        yield _rows(id_type, len(n_a), 0, self.number, {"id": ids, "n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()), "n_groups": pa.array(n_g, pa.int64()), "digest": pa.array(digest), "groups": lists[0], "times": lists[1]})
        names = self.al.key
        for i in range(0, len(used), 1 << 15):
            part = used[i : i + (1 << 15)]
            yield _rows(id_type, len(part), 1, self.number, {"no": pa.array(np.arange(i, i + len(part), dtype=np.int32)), "key": pa.array([names[g] for g in part.tolist()])})
        n = np.bincount(np.concatenate(self.pairs), minlength=1)
        codes = np.fromiter(self.al.pair, np.int64, len(self.al.pair))
        held = np.flatnonzero(n)
        if len(codes):
            yield _rows(id_type, len(held), 2, self.number, {"pair": pa.array(codes[held]), "docs": pa.array(n[held])})


_FIELDS = {
    "kind": "int", "block": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "digest": "string", "groups": "array<int>", "times": "array<int>",
    "no": "int", "key": "string", "pair": "bigint", "docs": "bigint",
}
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _rows(id_type: pa.DataType, n: int, kind: int, block: int, cols: dict[str, pa.Array]) -> pa.RecordBatch:
    same = {"kind": pa.array(np.full(n, kind, np.int32)), "block": pa.array(np.full(n, block, np.int64))}
    have = cols | same
    kinds = {"id": id_type} | {k: _ARROW[t] for k, t in _FIELDS.items()}
    return pa.RecordBatch.from_arrays([have[k] if k in have else pa.nulls(n, t) for k, t in kinds.items()], names=list(kinds))


def blocks(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the texts, written: each block's documents, distinct groups and pair counts."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, first, count = aligner_of(byte_path, piece_path), TaskContext.get().partitionId() << 24, 0
        block, kind = None, None
        for b in pieces_of(batches, "_text", 1 << 20):
            kind = b.schema.field(0).type
            block = block or Block(al, first + count)
            block.add(b)
            if block.bytes >= BLOCK:
                yield from block.rows(kind)
                block, count = None, count + 1
        if block:
            yield from block.rows(kind)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{k} {t}" for k, t in _FIELDS.items())
    return saved(docs.select(docs[key].alias("id"), docs[text].alias("_text")).mapInArrow(run, schema), "blocks")


def group_figures(written: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per distinct group: key, n_links, n_best (links whose count is the highest of their A id), count_sum."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner_of(byte_path, piece_path)
        for b in batches:
            row, pair = [], []
            for i, k in enumerate(b.column(0).to_pylist()):
                a, c = ([int(x) for x in side.split(",")] for side in k.split("|"))
                found = links_of(a, c, al.a_size, al.b_size)
                pair += found
                row += [i] * len(found)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(pair, pa.int64())], names=["key", "pair"])

    counts = written.where("kind = 2").groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    counts = saved(counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pairs")
    keys = written.where("kind = 1").select("key").distinct()
    links = keys.mapInArrow(expand, "key string, pair bigint")
    return links.join(counts, "pair").groupBy("key").agg(F.count(F.lit(1)).alias("n_links"), F.count_if("best").alias("n_best"), F.sum("docs").alias("count_sum"))


def align(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is the byte-level tokenizer on a space and the text, B the piece model on the text, both
    without special tokens. A text that is null or empty, or whose tokens of either side don't
    join to a space and the text, has no tokens: zeros and ''. A pair's count is the number of
    rows that hold it linked; rows that repeat a key, or have none, count each. Other columns
    are left out; an empty table gives no rows.
    """
    written = blocks(docs, byte_path, piece_path, key, text)
    of_block = written.where("kind = 1").select(F.col("block").alias("of"), "no", "key").join(group_figures(written, byte_path, piece_path), "key").drop("key")

    def total(rows: pa.Table, figures: pa.Table) -> pa.Table:
        own = rows.select(["id", "n_a", "n_b", "n_groups"])
        ends = np.concatenate([[0], np.cumsum(rows.column("groups").combine_chunks().value_lengths().to_numpy())])
        at, times = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("groups", "times"))
        for c in ("n_links", "n_best", "count_sum"):
            of = np.zeros(figures.num_rows, np.int64)
            of[figures.column("no").to_numpy()] = figures.column(c).to_numpy()
            run = np.concatenate([[0], np.cumsum(of[at] * times)]) if len(at) else np.zeros(1, np.int64)
            own = own.append_column(c, pa.array(run[ends[1:]] - run[ends[:-1]]))
        return own.append_column("groups_sha256", rows.column("digest"))

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    rows = written.where("kind = 0").select("block", "id", "n_a", "n_b", "n_groups", "digest", "groups", "times")
    return rows.groupBy("block").cogroup(of_block.groupBy("of")).applyInArrow(total, schema).withColumnRenamed("id", key)
