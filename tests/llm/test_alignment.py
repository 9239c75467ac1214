"""Cross-tokenizer alignment against whole-text brute force."""

import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")

from ladderline.llm import alignment, queries  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "   ", "\n", " \n", "\n  ", "\t", "\x1c", "\x85", "\xa0", "　", "'s", "don't", "Hello", "é", "é", "日本", "½", "12", ".", ",", "!!", "😀", "ａ", "\r\n", "word", "<|endoftext|>", "<s>", "<0x41>", "naïve", "ß", "​"]


def brute(texts):
    """Rows of figures, from whole texts and byte offsets alone."""
    (ta, ab), (tb, bb) = alignment.byte_tokens(A), alignment.piece_tokens(B)
    per_doc, holders, out = [], {}, []
    for n, t in enumerate(texts):
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tb.encode(t) if t else []
        want = (" " + (t or "")).encode()
        if not t or b"".join(ab[i] for i in a) != want or b"".join(bb[i] for i in b) != want:
            per_doc.append(None)
            continue
        spans = []
        for ids, sizes in ((a, ab), (b, bb)):
            at, s = 0, []
            for i in ids:
                s.append((at, at + len(sizes[i]), i))
                at += len(sizes[i])
            spans.append(s)
        ends = sorted({x[1] for x in spans[0]} & {x[1] for x in spans[1]})
        text, low, links = [], 0, []
        for e in ends:
            in_group = [[x for x in s if low <= x[0] and x[1] <= e] for s in spans]
            text.append("|".join(",".join(str(x[2]) for x in s) for s in in_group))
            links += [(x[2], y[2]) for x in in_group[0] for y in in_group[1] if x[0] < y[1] and y[0] < x[1]]
            low = e
        for p in set(links):
            holders.setdefault(p, set()).add(n)
        per_doc.append((len(a), len(b), len(ends), links, hashlib.sha256(";".join(text).encode()).hexdigest()))
    count = {p: len(h) for p, h in holders.items()}
    top = {}
    for (a, _), c in count.items():
        top[a] = max(top.get(a, 0), c)
    for d in per_doc:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            links = d[3]
            out.append((*d[:3], len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), d[4]))
    return out


COLS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block", [1 << 23, 300])
def test_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rnd = random.Random(4)
    texts = [None, "", " ", "▁", "a ▁b", "x" * 3000, "word " * 400, "don't stop", "don't stop", "a", " a", "a "]
    texts += ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 15))) for _ in range(250)]
    rows = [(i if i % 7 else None, t, str(i), "z", 1) for i, t in enumerate(texts)] + [(5, "again", "again", "z", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, id string, key string, block int")
    want = brute([r[1] for r in rows])
    got = alignment.align(df.repartition(3), A, B)
    assert got.columns == ["doc_id", *COLS]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str((r[0], *w)) for r, w in zip(rows, want, strict=True))


def test_no_rows(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string"), A, B).collect() == []


def test_links_of_a_group():
    size = {1: 1, 2: 2, 3: 3}
    assert alignment.cuts([2, 1, 3], [3, 1, 2], size, size) == [(0, 2, 0, 1), (2, 3, 1, 3)]
    assert alignment.links_of([2, 1], [3], size, size) == [2 << 32 | 3, 1 << 32 | 3]
    assert alignment.links_of([2, 2], [1, 3], size, size) == [2 << 32 | 1, 2 << 32 | 3, 2 << 32 | 3]


def test_the_query_takes_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in queries.op12_alignment(spark, sf_dir).collect()}
    assert got == dict(zip([r.doc_id for r in docs], brute([r.text for r in docs]), strict=True))
