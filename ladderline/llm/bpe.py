"""Byte-level BPE through a sentencepiece model written straight from a rank file.

The model file is serialised here, byte for byte: each vocabulary entry becomes a piece
whose characters stand for its bytes (byte b is the character U+0100 + b), its score is
the negative rank, normalisation is the identity. Merging the best-scored neighbours first
is then the same as merging the lowest rank first. Ids equal ranks; one piece for unknown
characters follows them and cannot occur. Decoding maps the pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import tempfile
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import ChunkEncoder, begin, cached_by, pieces_of, ship

SHIFT = 0x100


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in order of rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(t) for t, r in rows}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"ranks of {path} have gaps")
    return [ranks[i] for i in range(len(ranks))]


def to_chars(data: bytes) -> str:
    return (np.frombuffer(data, np.uint8).astype("<u2") + SHIFT).tobytes().decode("utf-16-le")


def to_bytes(chars: str) -> bytes:
    return (np.frombuffer(chars.encode("utf-16-le"), "<u2") - SHIFT).astype(np.uint8).tobytes()


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | bytes | float) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece ModelProto. Field numbers and codes of that format."""
    pieces = [_field(1, _field(1, to_chars(t).encode()) + _field(2, float(-rank)) + _field(3, 1)) for rank, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encode texts to ids and back, pre-token by pre-token."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks_path)
        with tempfile.NamedTemporaryFile(suffix=".model", delete=False) as f:
            f.write(serialise(self.tokens))
        try:
            self.model = sentencepiece.SentencePieceProcessor(model_file=f.name)
        finally:
            os.unlink(f.name)
        self.find = regex.compile(pattern).findall
        self.inverse = [to_bytes(self.model.id_to_piece(i)) for i in range(len(self.tokens))]
        self.sizes = np.array([len(x) for x in self.inverse], np.int64)
        self.chunks = ChunkEncoder(self._chunks, self._whole)

    def _pre_tokens(self, pre: list[str]) -> list[list[int]]:
        return self.model.encode([to_chars(p.encode()) for p in pre], out_type=int, num_threads=1)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        found = [self.find(c) for c in chunks]
        ids, at, out = self._pre_tokens([p for f in found for p in f]), 0, []
        for f in found:
            a = array("I")
            for x in ids[at : at + len(f)]:
                a.extend(x)
            at += len(f)
            out.append(a.tobytes())
        return out

    def _whole(self, text: str) -> bytes:
        a, known = array("I"), {}
        pre = self.find(text)
        distinct = list(dict.fromkeys(pre))
        known = dict(zip(distinct, self._pre_tokens(distinct), strict=True))
        for p in pre:
            a.extend(known[p])
        return a.tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.chunks.ids(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.inverse.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes of all ids, and where those of each row begin and the last's end."""
        plain = b"".join(map(self.inverse.__getitem__, flat.tolist()))
        at = np.concatenate([[0], np.cumsum(self.sizes[flat])])
        return memoryview(plain), at[ends]


_models: dict[tuple[str, str], ByteBpe] = {}
cached_by("bpe", _models.clear)


def model_of(ranks_path: str, pattern: str) -> ByteBpe:
    """One model for each worker process, with the chunks it has met."""
    begin("bpe")
    key = (ranks_path, pattern)
    if key not in _models:
        _models[key] = ByteBpe(*key)
    return _models[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Encode every text, decode its ids again; one row out for each row in.

    Returns ``key``, ``n_tokens``, ``ids_sha256`` (over ids as little-endian unsigned 32-bit
    integers), ``decoded_sha256``, ``n_bytes`` (decoded), and with ``ids=True`` the ids.
    Null and empty texts have no tokens; null keys and repeated rows stay as they are; other
    columns are left out. Work is per row: no shuffle, memory bounded by slices of the input.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model_of(ranks_path, pattern)
        for b in pieces_of(batches, "_text"):
            flat, ends = bpe.chunks.column(b.column(1))
            raw, cut = memoryview(flat.astype("<u4").tobytes()), list(pairwise(ends.tolist()))
            plain, at = bpe.decode_all(flat, ends)
            out = {
                key: b.column(0),
                "n_tokens": pa.array(np.diff(ends)),
                "ids_sha256": pa.array([hashlib.sha256(raw[4 * x : 4 * y]).hexdigest() for x, y in cut]),
                "decoded_sha256": pa.array([hashlib.sha256(plain[x:y]).hexdigest() for x, y in pairwise(at.tolist())]),
                "n_bytes": pa.array(np.diff(at)),
            }
            if ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint" + ", ids array<int>" * ids
    return docs.select(key, docs[text].alias("_text")).mapInArrow(run, schema)
