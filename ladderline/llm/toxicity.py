"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed words (case of A-Z and outer punctuation removed). The score
is sigmoid(w0 + sum of w_i + sum over pairs of <v_i, v_j>): linear weights plus learned
pairwise interactions, so that an insult next to a group mention can weigh more than both
alone. Terms that say nothing about the label in the training sample are dropped first (by
chi-square), so the model has a fixed size and a text's length by itself doesn't move it.

Training uses a bounded sample of labelled rows (``FmParams.sample`` for each label), the one
part that doesn't grow with the data; scoring covers every row and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import as_bytes, begin, cached_by, lower_words, pieces_of, quoted, saved, ship

_OUTER = b".,;:!?\"'()[]{}<>*%&$#|-_"


@dataclass(frozen=True)
class FmParams:
    """sample: labelled rows of each label at most; terms: features kept at most."""

    sample: int = 5000
    min_docs: int = 4
    terms: int = 8192
    factors: int = 8
    epochs: int = 12
    batch: int = 128
    rate: float = 0.15
    l2: float = 1e-5
    seed: int = 7


class _TermHash(dict):
    def __missing__(self, word: bytes) -> int:
        core = word.strip(_OUTER)
        h = xxhash.xxh64_intdigest(core) if core else 0
        if len(word) <= 64:  # so that entries bound bytes
            if len(self) >= 150_000:
                self.clear()
            self[word] = h
        return h


_terms = _TermHash()
cached_by("toxicity", _terms.clear)


def term_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit term hashes of a text."""
    begin("toxicity")
    words = set(lower_words(text))
    h = np.fromiter(map(_terms.__getitem__, words), np.uint64, len(words))
    h = np.unique(h)
    return h[1:] if len(h) and h[0] == 0 else h


@dataclass
class Fm:
    """terms: sorted hashes; w0, w, v: bias, weights and factors, the last row of which is zero.
    informed: whether it has seen rows of both labels; if not, it rejects nothing."""

    terms: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray
    informed: bool = True

    def at(self, h: np.ndarray) -> np.ndarray:
        """Row numbers of those of the hashes that the model knows."""
        if not len(self.terms):
            return np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return i[self.terms[i] == h]

    def raw(self, rows: np.ndarray) -> float:
        s = self.v[rows].sum(axis=0)
        return float(self.w0 + self.w[rows].sum() + 0.5 * ((s * s).sum() - (self.v[rows] ** 2).sum()))

    def score(self, text: bytes | None) -> float:
        z = self.raw(self.at(term_set(text))) if self.informed else -40.0
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -40, 40))))


def chi_square(df, pos, n: int, n1: float):
    """Of a term in ``df`` of n rows, ``pos`` of them among the n1 that are toxic (arrays or columns)."""
    share = n1 / max(1, n)
    expect = df * share
    return (pos - expect) ** 2 / (expect * (1 - share) * (1 - df / max(1, n)) + 1e-9)


#: One term in a thousand gets there without any relation to the label.
LEAST_CHI = 10.8


def choose_terms(rows: list[np.ndarray], y: np.ndarray, p: FmParams) -> np.ndarray:
    """The terms with the largest chi-square against the label, sorted by hash."""
    if not rows or not sum(map(len, rows)):
        return np.zeros(0, np.uint64)
    flat = np.concatenate(rows)
    label = np.repeat(y, [len(r) for r in rows])
    terms, inv = np.unique(flat, return_inverse=True)
    df = np.bincount(inv, minlength=len(terms)).astype(float)
    pos = np.bincount(inv, label, minlength=len(terms))
    chi = np.where(df >= p.min_docs, chi_square(df, pos, len(y), float(y.sum())), 0)
    keep = np.argsort(-chi, kind="stable")[: p.terms]
    return np.sort(terms[keep[chi[keep] > LEAST_CHI]])


def train(rows: list[np.ndarray], y: np.ndarray, p: FmParams = FmParams(), terms: np.ndarray | None = None) -> Fm:
    """Fit by mini-batch AdaGrad on logistic loss; deterministic for given rows in a given order."""
    rng = np.random.default_rng(p.seed)
    terms = choose_terms(rows, y, p) if terms is None else terms
    m = Fm(terms, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), p.factors)), bool(0 < y.sum() < len(y)))
    if not len(terms):
        return m
    at = [m.at(r) for r in rows]
    g0, gw, gv = 1.0, np.ones_like(m.w), np.ones_like(m.v)
    for _ in range(p.epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), p.batch):
            pick = order[lo : lo + p.batch]
            lens = np.array([len(at[i]) for i in pick])
            idx = np.concatenate([at[i] for i in pick]).astype(np.int64)
            doc = np.repeat(np.arange(len(pick)), lens)
            vi = m.v[idx]
            s = np.zeros((len(pick), p.factors))
            np.add.at(s, doc, vi)
            q = np.bincount(doc, (vi**2).sum(axis=1), minlength=len(pick))
            z = m.w0 + np.bincount(doc, m.w[idx], minlength=len(pick)) + 0.5 * ((s * s).sum(axis=1) - q)
            e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) / len(pick)
            d0, dw = e.sum(), np.bincount(idx, e[doc], minlength=len(m.w)) + p.l2 * m.w
            dv = p.l2 * m.v
            np.add.at(dv, idx, e[doc][:, None] * (s[doc] - vi))
            g0, gw, gv = g0 + d0 * d0, gw + dw**2 * 1e4, gv + dv**2 * 1e4
            m.w0 -= p.rate * d0
            m.w -= p.rate * dw * 100 / np.sqrt(gw)
            m.v -= p.rate * dv * 100 / np.sqrt(gv)
    return m


def fit(docs: DataFrame, labels: DataFrame, p: FmParams = FmParams(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> Fm:
    """Train on at most ``p.sample`` rows of each label, the first in hash order of the key.

    Where that leaves out rows of a label, the bias is corrected by the rates at which the two
    labels were sampled, so that a score means the same at every size of the input.
    Rows without key or label, or whose document is missing, are not used; of rows that repeat a
    key one is. Without any row of
    a label the model knows no difference and scores every text as clean (0).

    Terms are counted and chosen by grouped aggregation. The driver gets ``p.terms`` terms, and of
    each sampled row a bitmap of those: some kB, however long its text.
    """
    ship(docs.sparkSession)
    known = labels.where(f"`{key}` IS NOT NULL AND `{label}` IN (0, 1)").select(key, F.col(label).cast("int").alias("y")).distinct()
    picks = [known.where(F.col("y") == v).orderBy(F.xxhash64(key), key).limit(p.sample) for v in (0, 1)]
    # At most 2 * p.sample rows: a proven bound, which holds for documents too where ids repeat.
    sample = docs.select(key, docs[text].alias("_text")).join(F.broadcast(picks[0].unionAll(picks[1])), key)
    sample = sample.groupBy(key, "y").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, "_text"):
            sets = [term_set(t).view(np.int64) for t in as_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sets, pa.list_(pa.int64()))], names=[key, "y", "terms"])

    kind = docs.schema[key].dataType.simpleString()
    sets = saved(sample.select(key, "_text", "y").mapInArrow(sets_of, f"`{key}` {kind}, y int, terms array<bigint>"), "terms")
    size = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    counts = sets.select(F.explode("terms").alias("term"), "y").groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"), F.sum("y").cast("double").alias("pos"))
    chi = counts.where(F.col("df") >= p.min_docs).select("term", chi_square(F.col("df"), F.col("pos"), size[0], float(size[1])).alias("chi")).where(F.col("chi") > LEAST_CHI)
    best = chi.orderBy(F.desc("chi"), "term").limit(p.terms).toArrow()
    terms = np.sort(best.column("term").to_numpy().astype(np.int64).view(np.uint64))

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(2)
            bits = [np.packbits(np.isin(terms, x.values.to_numpy().view(np.uint64))).tobytes() for x in own]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(bits, pa.binary())], names=[key, "y", "bits"])

    got = sets.mapInArrow(bits_of, f"`{key}` {kind}, y int, bits binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r[key], r["y"], r["bits"]))
    rows = [terms[np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=len(terms)).astype(bool)] for r in got]
    m = train(rows, np.array([r["y"] for r in got], float), p, terms)
    if m.informed:
        n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        m.w0 += float(np.log(n[1] / min(n[1], p.sample)) - np.log(n[0] / min(n[0], p.sample)))
    return m


def score(docs: DataFrame, model: Fm, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), out: str = "score") -> DataFrame:
    """Add ``out`` (0 to 1) to key and the ``keep`` columns: one row per input row, no shuffle.

    A null or empty text scores as no terms (the bias). Columns that are kept may have any other
    name than ``out``. The model is a few hundred kB at most.
    """
    ship(docs.sparkSession)
    cols = list(dict.fromkeys([key, *keep]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, "_text"):
            s = pa.array([model.score(t) for t in as_bytes(b.column(0))], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], s], schema=pa.schema([*list(b.schema)[1:], pa.field("_score", pa.float64())]))

    names = [f"_c{i}" for i in range(len(cols))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, cols, strict=True)) + ", _score double"
    rows = docs.select(docs[text].alias("_text"), *[quoted(c).alias(n) for n, c in zip(names, cols, strict=True)])
    return rows.mapInArrow(run, schema).toDF(*cols, out)
