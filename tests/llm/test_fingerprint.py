"""Fingerprints: exact sets as yardstick, the order of documents, edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest

from ladderline.llm import fingerprint as fp
from ladderline.llm import queries


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    """Order, edits and every digest by brute force; rows of equal id and text count as one kind."""
    assert len(got) == len(rows)
    texts = {(i, t or "") for i, t in rows}
    by_key = {}
    for i, t in texts:
        by_key.setdefault(i, set()).add(t)
    order = sorted((i for i in by_key if i is not None), reverse=True) + ([None] if None in by_key else [])
    after = {i: order[(n + 1) % len(order)] for n, i in enumerate(order)}
    for r in got:
        mine = [t for t in by_key[r.doc_id] if len(t) == r.n_chars and fp.written(fp.sketches([t])[0]) == r.fingerprint]
        follow = by_key[after[r.doc_id]] | by_key[r.doc_id]
        ok = [(t, f) for t in mine for f in follow if hashlib.sha256(fp.edited(t, f).encode()).hexdigest() == r.edited_sha256]
        assert ok, r
        own = fp.read(r.fingerprint)
        assert any((r.edited_fingerprint, r.near_edited, r.near_next) == (fp.written(e := fp.sketches([fp.edited(t, f)])[0]), fp.likeness(own, e), fp.likeness(own, fp.sketches([f])[0])) for t, f in ok)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_order_edits_and_edges(spark, parts):
    rnd = random.Random(parts)
    words = [f"w{i}" for i in range(50)] + ["é", "日本", "A", "😀"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 4, 5, 30, 200])))) for i in rnd.sample(range(-500, 500), 120)]
    rows += [(None, "no id"), (None, None), (7000, None), (7001, ""), (7002, "   "), (7003, "odd"), (-(2**63), "least"), (2**63 - 1, "most")]
    rows += [(9000, "same"), (9000, "same"), (9000, "other words of one id")] + [(9001, "many copies of one row here")] * 40
    df = spark.createDataFrame([(*r, "z", True, 1.5) for r in rows], "doc_id bigint, text string, _text string, _tail boolean, near_next double").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = fp.compare(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    check(rows, got)
    # Rows of one key and text follow each other: all but one are their own next.
    assert sum(r.near_next == 1.0 for r in got if r.doc_id == 9001) >= 39


def test_one_row_and_none(spark):
    r = fp.compare(spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")).collect()
    assert [(x.doc_id, x.n_chars, x.edited_sha256, x.near_next) for x in r] == [(5, 6, hashlib.sha256(b"abcabc").hexdigest(), 1.0)]
    assert fp.compare(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_estimates_are_near_the_truth():
    rnd = random.Random(2)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(4000)]
    errors = []
    for n in (60, 400, 2000):
        a, b = " ".join(base[:n]), " ".join(base[n // 2 : n // 2 + n])
        x, y = fp.sketches([a, b])
        errors.append(abs(fp.likeness(x, y) - jaccard(a, b)))
    assert max(errors) < 0.25 and errors[-1] < 0.06
    # A short text inside one thirty times as long.
    part, whole = fp.sketches([" ".join(base[1000:1130]), " ".join(base)])
    assert fp.containment(part, whole) == 1.0 and fp.likeness(part, whole) < 0.1
    halves = fp.sketches([" ".join(base[:2002]), " ".join(base[1998:])])
    assert np.array_equal(fp.merged(halves), whole)


def test_short_and_equal_texts():
    x, y, z, none = fp.sketches(["a b", "A  b\n", "a c", " \n"])
    assert len(x) == 1 and fp.likeness(x, y) == 1.0 and fp.likeness(x, z) == 0.0
    assert fp.written(none) == "" and fp.likeness(none, none) == 1.0 and fp.likeness(none, x) == 0.0
    assert np.array_equal(fp.read(fp.written(x)), x) and np.array_equal(fp.merged([]), none)
    together = fp.sketches(["one two three four five six", "a b c", "seven eight nine ten eleven twelve"])
    assert all(np.array_equal(s, fp.sketches([t])[0]) for s, t in zip(together, ["one two three four five six", "a b c", "seven eight nine ten eleven twelve"], strict=True))


def test_the_query_takes_every_document(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op13_fingerprint(spark, sf_dir).collect()
    check(rows, got)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    order = sorted(rows, reverse=True)
    truth = {i: jaccard(t or "", n or "") for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True)}
    assert np.mean([abs(r.near_next - truth[r.doc_id]) for r in got]) < 0.02
    alone = {r.doc_id: r.fingerprint for r in fp.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert alone == {r.doc_id: r.fingerprint for r in got}
