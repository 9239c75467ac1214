"""Tokenisers, quality rules, licenses, packing: brute force and edge cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from ladderline.llm import bpe, license_scan, packing, quality, token_output  # noqa: E402

EDGE = [None, "", " ", "\n", " \n x", "a", "hello  world", "don't stop. Don't!", "tab\tand nbsp", "日本語 ½ Ⅷ", "x" * 30000, "word " * 5000, "<|endoftext|>", "a b c a b c a b c d"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """Edge cases (with repeated rows, a null id and a clashing extra column) and real texts."""
    rows = [(i, t, "z") for i, t in enumerate(EDGE)] + [(3, "\n", "z"), (None, "no id", None)]
    real = [(1000 + r.doc_id, r.text, "r") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    return spark.createDataFrame(rows + real, "doc_id bigint, text string, ids string").cache()


def _encode():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda x: t.encode(x, add_special_tokens=False).ids


def _u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe_round_trip(docs):
    enc = _encode()
    want = sorted((str(r.doc_id), len(enc(r.text or "")), hashlib.sha256(_u32(enc(r.text or ""))).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    got = bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_chunk_encoders_equal_the_libraries():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    enc, rnd = _encode(), random.Random(1)
    parts = [" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", "　", "'s", "don't", "Hello", "é", "日本", "½", "12", ".", ",", "!!", "-", "😀", "́", "A", "﻿", "$$", "###", "word", ".\n", "Ab.\nCd,", "<|endoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    want = [_u32(t.encode(x, add_special_tokens=False).ids) for x in texts]
    for most in (1 << 20, 200):  # chunks that come back after they were dropped
        own = token_output.JsonTokenizer(P.path("byte_bpe_50k.json"))
        own.chunks.kept.most = most
        assert [x for i in range(0, len(texts), 100) for x in own.encode(texts[i : i + 100])] == want
    assert bpe.ByteBpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encode(texts) == [_u32(enc(x)) for x in texts]


def test_long_texts_are_cut_where_it_does_not_matter(monkeypatch):
    from ladderline.llm import text

    monkeypatch.setattr(text, "_STEP", 64)
    lib, own, rnd = _library(), token_output.JsonTokenizer(P.path("byte_bpe_50k.json")), random.Random(2)
    parts = [" ", "  ", "\n", "word", " and", " x.\nY", "é", "\t", "!", "z" * 300, " <|endoftext|>", "\xa0"]
    texts = ["".join(rnd.choices(parts, [30, 2, 2, 20, 30, 5, 4, 1, 5, 1, 0.2, 1], k=rnd.randint(0, 200))) for _ in range(300)]
    assert own.encode([*texts, None, ""]) == [*(_u32(lib(x)) for x in texts), b"", b""]


def test_word_hashes(monkeypatch):
    import pyarrow as pa

    from ladderline.llm import text

    rnd = random.Random(0)
    parts = ["a", "B", "b", "Zz", "é", "É", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", " ", "word"]
    texts = [None, "", "   "] + ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(2000)]
    for step in (text._STEP, 16):  # texts longer than two steps are cut at blanks
        monkeypatch.setattr(text, "_STEP", step)
        h, ends = text.word_hashes(pa.array(texts))
        of, back = {}, {}
        for t, x, y in zip(texts, ends[:-1], ends[1:]):
            words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
            assert len(words) == y - x
            assert all(of.setdefault(w, v) == v and back.setdefault(v, w) == w for w, v in zip(words, h[x:y].tolist()))


def test_byte_hashes_tell_substrings_apart():
    from ladderline.llm import text

    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 20000, dtype=np.uint8)
    start = rng.integers(0, 19000, 50000)
    end = start + rng.integers(0, 40, 50000)
    raw, h = data.tobytes(), text._ByteHash(data).of(start, end)
    same = {}
    for x, y, k in zip(start.tolist(), end.tolist(), h.tolist()):
        same.setdefault(raw[x:y], set()).add(k)
    assert all(len(v) == 1 for v in same.values()) and len({v for s in same.values() for v in s}) == len(same)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(docs, spark, tmp_path, encoding):
    """Null ids first, equal ids in the order of their texts; starts follow the order in the files."""
    out = str(tmp_path / "tokens")
    rows = docs.union(spark.createDataFrame([(6, t, "again") for t in ("hello", "a b c d e f g h", None, "zz")], docs.schema))
    got = token_output.token_index(rows, P.path("byte_bpe_50k.json"), 2, out=out, encoding=encoding).orderBy("start").collect()
    start = 0
    order = sorted(rows.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0, d.text is not None, (d.text or "").encode()))
    for r, d in zip(got, order, strict=True):
        ids = _library()(d.text or "") + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(_u32(ids)))
        start += len(ids)
    import glob

    import pyarrow.parquet as pq

    kinds = {e for f in glob.glob(f"{out}/*.parquet") for g in [pq.ParquetFile(f).metadata] if g.num_row_groups for e in g.row_group(0).column(4).encodings}
    assert ("RLE_DICTIONARY" in kinds or "PLAIN_DICTIONARY" in kinds) if encoding == "dictionary" else "DELTA_BINARY_PACKED" in kinds
    f = pq.ParquetFile(sorted(glob.glob(f"{out}/*.parquet"))[0]).metadata
    assert f.num_row_groups == 0 or f.row_group(0).column(4).has_offset_index
    by_file = [r.ids for r in sorted(token_output.read_tokens(spark, out).collect(), key=lambda r: (r.part, r.row))]
    assert [zlib.crc32(_u32(x)) for x in by_file] == [r.ids_crc32 for r in got]
    assert token_output.token_index(rows.limit(0), P.path("byte_bpe_50k.json"), 2).count() == 0


def test_quality_measures(docs):
    def measure(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        k = Counter(zip(w, w[1:], w[2:]))
        cover = {j for i in range(len(w) - 2) if k[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(cover)

    got = quality.ledger(docs)
    assert sorted((str(r.doc_id), *[r[m] for m in quality.MEASURES]) for r in got.collect()) == sorted((str(r.doc_id), *measure(r.text)) for r in docs.collect())
    rows = got.collect()
    mask = quality.bits(quality.POLICIES["v2"])
    by_rule = {r.rule: r for r in quality.ablation(got, "v2").collect()}
    for i, (name, _) in enumerate(quality.RULES):
        assert by_rule[name].fails == sum(r.failed >> i & 1 for r in rows)
        assert by_rule[name].kept_without == sum(r.failed & mask & ~(1 << i) == 0 for r in rows)


def test_licenses(spark):
    apache, mit = license_scan.TEMPLATES["Apache-2.0"], license_scan.TEMPLATES["MIT"]
    filler = " ".join(f"w{i}" for i in range(500))
    texts = [
        None, "", filler, f"{filler}\n{apache[0]}\n{filler}", f"{mit[1]} {filler} {apache[1]}", mit[1].replace("restriction", "limits"), "licensed under the apache licence",
        f"all RIGHTS reserved. {filler}", " ".join([filler, apache[0]] * 40),
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, license int")
    got = {}
    for r in license_scan.scan(df).collect():
        got.setdefault(r.doc_id, {})[r.license] = r
    assert {k: set(v) for k, v in got.items()} == {3: {"Apache-2.0"}, 4: {"MIT", "Apache-2.0"}, 5: {"MIT"}, 7: {"all-rights-reserved"}, 8: {"Apache-2.0"}}
    assert (got[3]["Apache-2.0"].first_word, got[3]["Apache-2.0"].n_words, got[3]["Apache-2.0"].percent) == (500, 7, 100)
    assert 80 <= got[5]["MIT"].percent < 100


def test_short_notices_are_found_among_any_neighbours():
    """Templates of one shingle; one in some hundred neighbours used to hide the second."""
    m = license_scan.Matcher({"a": ("All rights reserved.",), "b": ("Licensed under CC BY-NC 4.0.",), "c": ("uno dos tres quatro cinco seis",), "d": ("one two three four five six seven eight nine",)})
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(1 << 40)}"
    for _ in range(8000):
        at = rng.randrange(3)
        text = [word() for _ in range(at)] + ["Licensed", "under", "CC", "BY-NC", "4.0."] + [word() for _ in range(8)]
        assert m.find(" ".join(text).encode()) == [("b", at, 5, 100)]
    for text, name, n in (("All rights reserved.", "a", 3), ("uno dos tres quatro cinco seis", "c", 6), ("one two three four five six seven eight nine", "d", 9)):
        for _ in range(500):
            at = rng.randrange(6)
            assert m.find(" ".join([*(word() for _ in range(at)), text, *(word() for _ in range(6))]).encode()) == [(name, at, n, 100)]


def test_licenses_match_an_exhaustive_count(spark, sf_dir):
    m = license_scan.Matcher(license_scan.TEMPLATES)
    every = [t for classes in m.classes.values() for g in classes.values() for t in g]
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        h = license_scan.word_hashes(r.text.encode())
        want = set()
        for t in every:
            s = license_scan.shingle_hashes(h, t.k) if len(h) >= t.k else h[:0]
            n, w = len(t.shingles), -(-5 * len(t.shingles) // 4)
            if any(100 * len(np.intersect1d(s[i : i + w], t.shingles)) >= 80 * n for i in np.nonzero(np.isin(s, t.shingles))[0]):
                want.add(t.name)
        assert {x[0] for x in m.find(r.text.encode())} == want


def _check_pieces(rows, docs, window=2048):
    enc, seqs = _library(), {}
    ids = {d.doc_id: enc(d.text or "") + [1] for d in docs}
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(_u32(ids[r.doc_id][r.start : r.start + r.length]))
        at[r.doc_id] += r.length
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {k: len(v) for k, v in ids.items()}
    pad = 0
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))]
        n = sum(n for _, n in s)
        assert n <= window
        pad += window - n if n & (n - 1) else 0
    return pad / sum(map(len, ids.values()))


def test_packing(docs, spark, sf_dir):
    clean = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    _check_pieces(packing.pack(clean, P.path("byte_bpe_50k.json"), 1).collect(), clean.collect())
    # With null and repeated ids: every id of every row once, sequences gapless.
    enc, got, seqs = _library(), packing.pack(docs, P.path("byte_bpe_50k.json"), 1).collect(), {}
    whole = [enc(d.text or "") + [1] for d in docs.collect()]
    want = Counter((d.doc_id, at, len(x), zlib.crc32(_u32(x[at : at + 2048]))) for d, x in zip(docs.collect(), whole) for at in range(0, len(x), 2048))
    assert Counter((r.doc_id, r.start, r.doc_tokens, r.ids_crc32) for r in got) == want
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(o == sum(n for _, n in s[:i]) for s in map(sorted, seqs.values()) for i, (o, _) in enumerate(s))
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert _check_pieces(packing.pack(real, P.path("byte_bpe_50k.json"), 1).collect(), real.collect()) < 0.05
    assert packing.pack(real.limit(0), P.path("byte_bpe_50k.json"), 1).count() == 0


def test_plan_uses_the_histogram_up():
    rng = np.random.default_rng(0)
    h = np.bincount(np.clip(rng.lognormal(6, 0.8, 20000), 1, 2048).astype(int), minlength=2049)
    use, pad = np.zeros(2049, int), 0
    for lengths, n in packing.plan(h, 2048):
        for v in lengths:
            use[v] += n
        pad += n * (2048 - sum(lengths))
        assert 0 < sum(lengths) <= 2048
    assert (use == h).all() and pad < 0.01 * (h * np.arange(2049)).sum()
    x = packing.nnls(np.array([[1500, 548, 0, 0], [1024, 1024, 0, 0]]), np.bincount([1500] * 30 + [548] * 30 + [1024] * 40, minlength=2049).astype(float))
    assert np.allclose(x, [30, 20], atol=0.1)
