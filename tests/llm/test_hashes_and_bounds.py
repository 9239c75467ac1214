"""Hashes: texts written to collide, hot ids, large vectors, and the samples' bounds."""

import base64
import hashlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from ladderline.llm import bpe, langid, lm_score, near_dedup, text, token_output, topk, toxicity  # noqa: E402


def _colliding() -> tuple[str, str]:
    """Two 256-byte strings with one polynomial hash modulo 2^64: the difference of s + u and u + s
    is that of s and u times 1 - b^n, and each doubling makes that factor even more often."""
    table, b = text._ByteHash._t, text._ByteHash._b
    words = np.array(list(product(range(97, 123), repeat=4)), np.uint8)
    power = np.multiply.accumulate(np.array([1, b, b, b], np.uint64))
    low = (table[words] * power).sum(axis=1) & np.uint64((1 << 25) - 1)
    order = np.argsort(low, kind="stable")
    i = int(np.flatnonzero(low[order][1:] == low[order][:-1])[0])
    s, u = (words[order[j]].tobytes().decode() for j in (i, i + 1))
    for _ in range(6):
        s, u = s + u, u + s
    return s, u


@pytest.fixture(scope="module")
def pair():
    s, u = _colliding()
    data = np.frombuffer((s + u).encode(), np.uint8)
    h = text._ByteHash(data).of(np.array([0, 256]), np.array([256, 512]))
    assert h[0] == h[1] and s != u
    return s, u


def test_colliding_chunks_get_their_own_ids(spark, pair):
    import tiktoken
    from tokenizers import Tokenizer

    s, u = pair
    texts = [f"a {s} b", f"a {u} b", f"a {u}. {s}, {u}.\n{s} b", f"{s} {u}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    for r in bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
        want = np.array(enc(texts[r.doc_id]), "<u4").tobytes()
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(want).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    # The tokenizer that op4 and op7 share; the second pass meets what the first has kept.
    shared = token_output.tokenizer_of(P.path("byte_bpe_50k.json"))
    for _ in range(2):
        for i in range(len(texts)):
            assert shared.chunks.ids([texts[i]])[0] == np.array(t.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()


def test_colliding_words_stay_apart(spark, pair):
    s, u = (x * 4 for x in pair)
    docs = spark.createDataFrame([(1, f"{s} {s}"), (2, f"{u} {u}")], "doc_id bigint, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_components(docs, k=2, percent=80).collect()}
    assert got == {1: (1, True), 2: (2, True)}
    scored = {r.doc_id: r.n_known for r in lm_score.score(docs, F.col("doc_id") == 1).collect()}
    assert scored == {1: 3, 2: 1}


def test_word_hash_tells_words_apart_by_content_alone():
    words = ["a", "b", "ab", "ba", "x" * 4096, "x" * 4097, "x" * 4096 + "y", "é", "A"]
    one, _ = text.word_hashes(pa.array([" ".join(words)]), 5)
    each = [int(text.word_hashes(pa.array([f" \n{w}\t"]), 5)[0][0]) for w in words]
    assert one.tolist() == each and len(set(each)) == len(words) - 1 and each[0] == each[-1]
    assert text.word_hashes(pa.array(["a"]), 6)[0][0] != one[0]
    assert text.word_hashes(pa.array([None, "", "  "]), 5)[1].tolist() == [0, 0, 0, 0]


def test_similarities_below_the_bands_are_refused(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        near_dedup.near_components(docs, percent=50)


@pytest.mark.parametrize("large", [1e7, 1e17, 3e38])
def test_top_k_of_large_components(spark, large):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=4)]) for i in range(120)]
    rows[7] = (7, [float(np.float32(large)), 0.5, 0.0, -1.0])
    rows[20] = (20, [float(np.float32(-large)), 0.5, 0.0, -1.0])
    rows[40] = (40, [float(np.float32(large)), 1.0, 2.0, -1.0])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    most = (1 << 63) - 1
    cut = lambda s: max(-most, min(most, s))
    want = []
    for q in range(0, 120, 20):
        s = sorted((-cut(sum(a * b for a, b in zip(whole[q], whole[i], strict=True))), i) for i in whole if i != q)[:10]
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    p = topk.IndexParams(pivots=8, rings=4, block=32, query_block=16)
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 10, p=p).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_samples_are_bounded_where_ids_repeat(spark):
    rows = [(1, "one two three", "en")] * 2000 + [(2, "uno dos tres", "es"), (None, "x y", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    m = langid.fit(docs)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before)
    assert m.langs == ["en", "es"] and jobs < 12
    alone = langid.fit(spark.createDataFrame([rows[0], rows[-2]], docs.schema))
    assert np.allclose(m.logp, alone.logp)
    labels = spark.createDataFrame([(1, 1), (2, 0)] * 50, "doc_id bigint, toxic int")
    assert toxicity.fit(docs, labels).informed


def test_rows_without_id_are_dealt_to_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 4096)
    rows = [(None, "same text")] * 300 + [(5, "other words here")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    seen = {(r.n_tokens, r.n_known, r.train_tokens) for r in lm_score.score(docs, F.lit(True)).collect()}
    assert seen == {(3, 3, 2100), (4, 4, 2100)}


def test_markup_that_hides_or_never_closes(spark):
    rows = [('<html data-lang="fr" lang="en"><p>x</p>',), ("<html><script>" * 3 + "y",), ("a <b <c> <!-- z",)]
    got = spark.createDataFrame(rows, "html string").select(langid.declared_of(F.col("html")).alias("d"), langid.visible_of(F.col("html")).alias("v")).collect()
    assert [r.d for r in got] == ["en", "", ""] and [r.v.split() for r in got] == [["x"], [], ["a", "<b"]]
