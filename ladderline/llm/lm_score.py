"""n-gram scores by deleted interpolation, with mixture weights learned by EM.

P(w | v) = a_b C(v w) / C(v) + b_b C(w) / N + c_b / (V + 1), where C counts the training
documents, v is the token before (the end token before the first), and the weights depend on
b, the power of two that C(v) lies in. Weights are learned by expectation-maximisation on
held-out counts: each training token is predicted from the counts without itself.

Counts are exact and never gathered. Documents are dealt into blocks; each block sends its
distinct words and bigrams, as sorted 64-bit hashes (under a random key of the run) with training counts, to the owners of
hash ranges (one packed row for each block and range), and gets back the totals in the order
in which it sent them. So no word, however common, is more than one number per block, and
the totals need no keys on their way back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import FIXED_KEY, MIX_B, MIX_C, begin, fresh_key, saved, scramble, ship, word_hashes

END = np.uint64(0x51ED270B9F0DA3A7)
BLOCK_BYTES = 4 << 20
OWNER_BLOCKS = 1
#: EM sees log2 probabilities in steps of a quarter: a bounded grid, whatever the corpus.
STEP, LOWEST, BUCKETS = 0.25, 64.0, 40


def planes(x: np.ndarray) -> bytes:
    """The bytes of an integer array, all first bytes first: high ones are mostly 0 and compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Block:
    """Tokens of some documents and their distinct keys (words, bigrams) with training counts."""

    def __init__(self, texts: pa.Array, training: np.ndarray, words: int = FIXED_KEY):
        begin("lm_score")
        h, ends = word_hashes(texts, words)
        self.lens = lens = np.diff(ends) + 1
        tok = np.insert(h, ends[1:], END)
        first = np.cumsum(lens) - lens
        prev = np.roll(tok, 1)
        prev[first] = END
        weight = np.repeat(training, lens)
        uni, word = np.unique(tok, return_inverse=True)
        bi, pair = np.unique(scramble(prev * MIX_B + tok * MIX_C + np.uint64(1)), return_inverse=True)
        keys = np.concatenate([scramble(uni + np.uint64(2)), bi])
        order = np.argsort(keys, kind="stable")
        where = np.empty(len(keys), np.int64)
        where[order] = np.arange(len(keys))
        counts = np.concatenate([np.bincount(word, weight, minlength=len(uni)), np.bincount(pair, weight, minlength=len(bi))])
        self.keys, self.counts = keys[order], counts[order].astype(np.uint64)
        self.is_word = order < len(uni)
        self.word_at, self.pair_at = where[word], where[len(uni) + pair]

    def ranges(self, n: int) -> Iterator[tuple[int, slice]]:
        """Slices of the sorted keys by owner, for owners that have any; n is a power of two."""
        shift = np.uint64(64 - (n.bit_length() - 1))
        owner = (self.keys >> shift).astype(np.int64) if n > 1 else np.zeros(len(self.keys), np.int64)
        own, first = np.unique(owner, return_index=True)
        for o, x, y in zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(owner)], strict=True):
            yield o, slice(x, y)


def _annotated(docs: DataFrame, training: Column, key: str, text: str) -> DataFrame:
    """Rows of key, training, and per token (arrays) the counts pair and word.

    The count of the token before is that of the neighbour, so it isn't stored. One row without
    key holds the training tokens N and distinct training words V of each owner of a range of
    hashes. An owner gets as many keys as some ``OWNER_BLOCKS`` blocks have, whatever the corpus,
    so a block's messages get smaller as the corpus grows: from 50 kB at 0.5 GB and 1 kB at 30 GB
    down to single keys. There are never more of them than keys; totals are 64-bit numbers.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(docs[key].alias("id"), F.coalesce(F.col(text), F.lit("")).cast("string").alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    owners = 1 << max(0, (-(-blocks // OWNER_BLOCKS) - 1).bit_length())
    # By text too, and by place in the input: neither rows without id nor repeated rows meet.
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1024))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text", place), F.lit(blocks)).cast("int"))
    words = fresh_key()
    kind = docs.schema[key].dataType.simpleString()

    def block_of(t: pa.Table) -> Block:
        return Block(t.column("text").combine_chunks(), t.column("train").to_numpy().astype(float), words)

    def ask(t: pa.Table) -> pa.Table:
        b, at = block_of(t), t.column("block")[0].as_py()
        out = [(o, at, planes(np.diff(b.keys[s], prepend=np.uint64(0))), planes(b.counts[s].astype("<u4")), np.packbits(b.is_word[s]).tobytes()) for o, s in b.ranges(owners)]
        cols = list(zip(*out, strict=True))
        return pa.table({"owner": pa.array(cols[0], pa.int32()), "block": pa.array(cols[1], pa.int32()), **{n: pa.array(c, pa.binary()) for n, c in zip(("keys", "counts", "words"), cols[2:], strict=True)}})

    def answer(t: pa.Table) -> pa.Table:
        keys = [np.cumsum(unplanes(x, "<u8"), dtype=np.uint64) for x in t.column("keys").to_pylist()]
        n = np.concatenate([unplanes(x, "<u4") for x in t.column("counts").to_pylist()]).astype(np.int64)
        word = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[: len(k)] for x, k in zip(t.column("words").to_pylist(), keys, strict=True)])
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        head = np.concatenate([[True], np.diff(flat[order]) != 0])
        sums = np.add.reduceat(n[order], np.nonzero(head)[0])
        total = np.empty(len(flat), np.int64)
        total[order] = sums[np.cumsum(head) - 1]
        is_word = word[order][head].astype(bool)
        at, cut = 0, []
        for k in keys:
            cut.append(planes(total[at : at + len(k)]))
            at += len(k)
        own = t.column("owner")[0].as_py()
        more = np.array([int(sums[is_word].sum()), int((sums[is_word] > 0).sum())], "<i8").tobytes()
        blocks_ = [*t.column("block").to_pylist(), -1 - own]
        return pa.table({"block": pa.array(blocks_, pa.int32()), "owner": pa.array([own] * len(blocks_), pa.int32()), "totals": pa.array([*cut, more], pa.binary())})

    def annotate(t: pa.Table, answers: pa.Table) -> pa.Table:
        longs = pa.list_(pa.int64())
        schema = pa.schema([("id", t.schema.field("id").type), ("train", pa.bool_()), ("pair", longs), ("word", longs), ("n", pa.int64()), ("v", pa.int64())])
        if not t.num_rows:
            s = np.sum([np.frombuffer(x, "<i8") for x in answers.column("totals").to_pylist()], axis=0) if answers.num_rows else [0, 0]
            return pa.table([[None], [None], [None], [None], [int(s[0])], [int(s[1])]], schema=schema)
        b = block_of(t)
        a = sorted(zip(answers.column("owner").to_pylist(), answers.column("totals").to_pylist(), strict=True))
        total = np.concatenate([unplanes(x, "<i8") for _, x in a])
        ends = pa.array(np.concatenate([[0], np.cumsum(b.lens)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(total[x])) for x in (b.pair_at, b.word_at)]
        none = pa.nulls(t.num_rows, pa.int64())
        return pa.table([t.column("id").combine_chunks(), t.column("train").combine_chunks(), *lists, none, none], schema=schema)

    by_block = dealt.groupBy("block")
    asked = by_block.applyInArrow(ask, "owner int, block int, keys binary, counts binary, words binary")
    answers = asked.groupBy("owner").applyInArrow(answer, "block int, owner int, totals binary")
    out = f"id {kind}, train boolean, pair array<bigint>, word array<bigint>, n bigint, v bigint"
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(annotate, out)


def _flat(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _before(word: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Count of the token before each: its neighbour's; of a first token, that of the end, which
    is the last of its document."""
    out = np.roll(word, 1)
    first = np.cumsum(lens) - lens
    out[first] = word[first + lens - 1]
    return out


def _bucket(before: np.ndarray) -> np.ndarray:
    return np.where(before > 0, np.floor(np.log2(np.maximum(before, 1))) + 1, 0).astype(np.int64).clip(0, BUCKETS - 1)


def _grid(p: np.ndarray) -> np.ndarray:
    """Probability to grid index: 0 for none, else -log2 p in steps."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.rint(np.minimum(-np.log2(p), LOWEST) / STEP), 0).astype(np.int64)


_SIDE = int(LOWEST / STEP) + 2


def _held_out_counts(ann: DataFrame, n: int) -> np.ndarray:
    """Rows (bucket, bigram grid, word grid, tokens) over all training tokens, each predicted
    from the counts without itself. At most BUCKETS * _SIDE^2 rows, in practice a few thousand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, int] = {}
        for b in batches:
            b = b.filter(b.column(0))
            if not b.num_rows:
                continue
            pair, word = (_flat(b.column(i)) for i in (1, 2))
            ctx = _before(word, b.column(2).value_lengths().to_numpy()) - 1
            p2 = np.where(ctx > 0, (pair - 1) / np.maximum(ctx, 1), 0)
            p1 = (word - 1) / max(1, n - 1)
            code = (_bucket(ctx) * _SIDE + _grid(p2)) * _SIDE + _grid(p1)
            for c, m in zip(*np.unique(code, return_counts=True), strict=True):
                acc[int(c)] = acc.get(int(c), 0) + int(m)
        yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int64()), pa.array(list(acc.values()), pa.int64())], names=["code", "m"])

    got = ann.where("id IS NOT NULL OR pair IS NOT NULL").select("train", "pair", "word").mapInArrow(run, "code bigint, m bigint")
    t = got.groupBy("code").agg(F.sum("m").alias("m")).toArrow()
    code, m = t.column("code").to_numpy(), t.column("m").to_numpy()
    return np.stack([code // _SIDE**2, code // _SIDE % _SIDE, code % _SIDE, m], 1)


def learn_weights(counts: np.ndarray, v: int, rounds: int = 60) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, word and uniform estimate by EM; bucket 0 has no bigram part."""
    value = np.concatenate([[0.0], 2.0 ** (-STEP * np.arange(_SIDE - 1))])
    w = np.full((BUCKETS, 3), 1 / 3)
    w[0] = (0, 0.5, 0.5)
    for b in range(BUCKETS):
        c = counts[counts[:, 0] == b]
        p = np.stack([value[c[:, 1]], value[c[:, 2]], np.full(len(c), 1 / (v + 1))], 1)
        for _ in range(rounds):
            r = p * w[b]
            r *= (c[:, 3] / np.maximum(r.sum(1), 1e-300))[:, None]
            # One pseudo-count for each estimate keeps every weight above 0.
            new = r.sum(0) + (1.0 if b else np.array([0, 1, 1]))
            w[b] = new / new.sum()
    return w


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, train, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z); tokens are the words and one end. A null or empty text is the
    end alone. ``training`` says which rows are learned from (null: not). base_score is the
    add-half unigram score, score the model's, both log10 and both over all tokens. Null keys
    and repeated rows are scored like others; an empty table gives no rows; without training
    rows every word is unknown and equally likely.
    """
    kind = docs.schema[key].dataType.simpleString()
    ann = saved(_annotated(docs, training, key, text), "annotated")
    s = ann.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    n, v = int(s[0]), int(s[1])
    w = learn_weights(_held_out_counts(ann, n), v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens = b.column(2).value_lengths().to_numpy()
            pair, word = (_flat(b.column(i)) for i in (2, 3))
            before = _before(word, lens)
            base = np.log10((word + 0.5) / (n + 0.5 * (v + 1)))
            lam = w[_bucket(before)]
            p = lam[:, 0] * pair / np.maximum(before, 1) + lam[:, 1] * word / max(1, n) + lam[:, 2] / (v + 1)
            first = np.cumsum(lens) - lens
            sums = [np.add.reduceat(x, first) if len(first) else x[:0] for x in (base, np.log10(p), (word > 0).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lens.astype(np.int64)), pa.array(sums[2].astype(np.int64)), pa.array(np.full(len(lens), n, np.int64)), pa.array(sums[0]), pa.array(sums[1])],
                names=[key, "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    out = f"`{key}` {kind}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return ann.where("pair IS NOT NULL").select("id", "train", "pair", "word").mapInArrow(run, out)
