"""Token ids as Parquet list columns, laid out for selective reads.

A token dataset is a folder of Parquet files in ascending key order. Its columns: the key,
``part`` (number of the file in that order), ``row`` (number in the file), ``n_tokens`` and
``ids`` (list of int). Ids are dictionary-encoded (or delta-encoded on request), row groups and pages have set sizes, and
Spark's writer adds column and offset indexes, so a reader of some keys fetches those pages
only, and a reader of ``n_tokens`` none of the ids.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import ChunkEncoder, begin, cached_by, pieces_of, saved, shared_dir, ship


class JsonTokenizer:
    """The tokenizers library on one tokenizer file; ids are kept for chunks met lately.

    Added tokens in a text are what the library makes of them: texts that hold one go through it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        vocab = self.tokenizer.get_vocab()
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.leads = np.zeros(max(vocab.values()) + 1, bool)
        self.leads[[i for t, i in vocab.items() if t.startswith(space)]] = True
        self.chunks = ChunkEncoder(self._chunks, lambda t: self._each([t])[0], apart=added)

    def _each(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, texts: list[str]) -> list[bytes]:
        """Chunks of a space and no other white space are encoded as one text, which is cheaper: no
        token reaches over a space, so each chunk begins at a token that begins with one."""
        joint = [i for i, t in enumerate(texts) if t[0] == " " and t.split() == [t[1:]]]
        out: list[bytes] = [b""] * len(texts)
        for at in range(0, len(joint), 512):
            part = joint[at : at + 512]
            ids = np.array(self._ids("".join([texts[i] for i in part])), "<u4")
            first = np.nonzero(self.leads[ids])[0].tolist()
            if len(first) != len(part) or first[0]:
                raise ValueError("this tokenizer's tokens reach over spaces")
            data = ids.tobytes()
            for i, x, y in zip(part, first, [*first[1:], len(ids)], strict=True):
                out[i] = data[4 * x : 4 * y]
        rest = sorted(set(range(len(texts))).difference(joint))
        for i, b in zip(rest, self._each([texts[i] for i in rest]), strict=True):
            out[i] = b
        return out

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.chunks.ids(texts)

    def column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each followed by ``end_id``, and where each row's begin and the last's end."""
        flat, ends = self.chunks.column(texts)
        out = np.full(len(flat) + len(ends) - 1, end_id, np.uint32)
        own = np.ones(len(out), bool)
        ends = ends + np.arange(len(ends))
        own[ends[1:] - 1] = False
        out[own] = flat
        return out, ends


_tokenizers: dict[str, JsonTokenizer] = {}
cached_by("tokens", _tokenizers.clear)


def tokenizer_of(path: str) -> JsonTokenizer:
    begin("tokens")
    if path not in _tokenizers:
        _tokenizers[path] = JsonTokenizer(path)
    return _tokenizers[path]


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text", encoding: str = "dictionary", row_group_mb: int = 32, page_kb: int = 64, page_rows: int = 2000) -> None:
    """Tokenise whole texts (null: empty), append ``end_id``, write the dataset to ``out``.

    One shuffle: texts are dealt by ranges of the key, then tokenised where they are written.
    Null keys come first. Empty tables give an empty dataset. Rows with equal keys are all
    written, in an order fixed by their text. Other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, row = tokenizer_of(tokenizer_path), 0
        for b in pieces_of(batches, "_text"):
            flat, ends = tok.column(b.column(2), end_id)
            at = pa.array(np.arange(row, row + b.num_rows))
            row += b.num_rows
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), at, pa.array(np.diff(ends)), ids], names=[key, "part", "row", "n_tokens", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    dealt = docs.select(key, docs[text].alias("_text")).repartitionByRange(parts, key).sortWithinPartitions(key, "_text")
    rows = dealt.select(key, F.spark_partition_id().alias("part"), "_text").mapInArrow(run, f"`{key}` {kind}, part int, row bigint, n_tokens bigint, ids array<int>")
    options = {
        "compression": "zstd",
        "parquet.block.size": row_group_mb << 20,
        "parquet.page.size": page_kb << 10,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
    }
    rows.write.options(**{k: str(v) for k, v in options.items()}).parquet(out)


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


def token_starts(tokens: DataFrame) -> DataFrame:
    """Where each row's ids begin in the dataset: running sums inside a part, plus the parts before."""
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = tokens.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    local = tokens.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return local.join(parts, "part").withColumn("start", F.col("start") + F.col("_base")).drop("_base")


def token_digests(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: key, part, row, and n_tokens and the crc32 of its ids, both taken from the ids column."""
    ship(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            ends = ids.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            crc = [zlib.crc32(flat[4 * i : 4 * j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())], names=[key, "part", "row", "n_tokens", "ids_crc32"])

    kind = tokens.schema[key].dataType.simpleString()
    return tokens.select(key, "part", "row", "ids").mapInArrow(run, f"`{key}` {kind}, part int, row bigint, n_tokens bigint, ids_crc32 bigint")


def token_index(docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text", out: str | None = None, encoding: str = "dictionary") -> DataFrame:
    """Write the token dataset, read it back, return key, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    out = out or shared_dir(spark, "tokens")
    write_tokens(docs, out, tokenizer_path, end_id, key, text, encoding)
    digests = saved(token_digests(read_tokens(spark, out), key), "digests")
    return token_starts(digests).select(key, "start", "n_tokens", "ids_crc32")
