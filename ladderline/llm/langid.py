"""Language identification by fusing evidence, Bayesian throughout.

The posterior of a document's language is proportional to

    host prior  x  P(text | language)  x  P(declared language | language)  x  P(suffix | language)

* the text likelihood is a hashed byte-trigram model, tempered (trigrams overlap, so their
  evidence counts a third), and bounded by a uniform background model for text in none of
  the languages;
* markup that declares a language is right with a set probability, otherwise uninformative;
* an address suffix that belongs to one language is weighted alike;
* host priors are smoothed hierarchically: overall counts smooth those of a suffix or domain,
  which smooth those of a host. Counts are expected counts (sums of text posteriors) from
  grouped aggregation over all rows.

Text models are fitted on a bounded sample of rows per language; all the rest covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import as_bytes, begin, pieces_of, quoted, saved, ship

BUCKETS = 1 << 16
OTHER = "und"


@dataclass(frozen=True)
class LangParams:
    """sample: rows per language for the text models; the rest are evidence strengths."""

    sample: int = 1500
    temper: float = 1 / 3
    trust_markup: float = 0.9
    trust_suffix: float = 0.8
    host_mass: float = 20.0
    group_mass: float = 50.0
    other_prior: float = 1e-4
    reject: float = 0.5


#: Address suffixes that belong to one language (fixed values: ISO 3166 codes of countries).
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en"}


def trigram_counts(text: bytes | None) -> np.ndarray:
    """Counts of hashed byte trigrams of the letters and blanks of a text; others become a blank."""
    begin("langid")
    b = np.frombuffer(b" " + (text or b"").lower() + b" ", np.uint8)
    letter = (b >= 128) | ((b >= 97) & (b <= 122))
    b = np.where(letter, b, 32).astype(np.uint32)
    code = (b[:-2] * 40503 + b[1:-1] * 2654435 + b[2:] * 97561) & (BUCKETS - 1)
    return code[letter[1:-1]]


@dataclass
class LangModel:
    langs: list[str]
    logp: np.ndarray
    """(BUCKETS, languages + 1) log probabilities; the last column is the background."""

    def log_likelihood(self, text: bytes | None) -> np.ndarray:
        """Log likelihoods of the languages and the background, 0 for a text without letters."""
        return self.logp[trigram_counts(text)].sum(axis=0)


def fit(docs: DataFrame, label: str = "lang", p: LangParams = LangParams(), key: str = "doc_id", text: str = "text") -> LangModel:
    """Text models from at most ``p.sample`` rows of each language, the first in hash order.

    Languages are the distinct non-null labels (at most 200 are allowed, else an error).
    """
    ship(docs.sparkSession)
    langs = sorted(r[0] for r in docs.where(F.col(label).isNotNull()).select(label).distinct().limit(201).collect())
    if len(langs) > 200:
        raise ValueError("more than 200 languages")
    # Each key once, also where rows repeat it: the sample is bounded whatever the ids are.
    ids = docs.select(F.col(key).alias("_k"), F.col(label).alias("_l")).where("_k IS NOT NULL AND _l IS NOT NULL")
    ids = ids.groupBy("_k").agg(F.min("_l").alias("_l"))
    picks = None
    for lang in langs:
        one = ids.where(F.col("_l") == lang).orderBy(F.xxhash64("_k"), "_k").limit(p.sample)
        picks = one if picks is None else picks.unionAll(one)
    logp = np.full((BUCKETS, len(langs) + 1), -np.log(BUCKETS))
    if picks is None:
        return LangModel(langs, logp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in pieces_of(batches, "_text"):
            for lang, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                sums[lang] = sums.get(lang, 0) + np.bincount(trigram_counts(t), minlength=BUCKETS)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(c[at])], names=["l", "bucket", "n"])

    # The sample has at most p.sample rows a language: a proven bound.
    own = docs.select(F.col(key).alias("_k"), F.col(label).alias("_l"), F.col(text).alias("_text")).join(F.broadcast(picks), ["_k", "_l"])
    one = own.groupBy("_k", "_l").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_l", "_text")
    got = one.mapInArrow(run, "l string, bucket bigint, n bigint").groupBy("l", "bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS rows a language reach the driver.
    t = got.toArrow()
    counts = np.zeros((len(langs), BUCKETS))
    place = {x: i for i, x in enumerate(langs)}
    counts[[place[x] for x in t.column("l").to_pylist()], t.column("bucket").to_numpy()] = t.column("n").to_numpy()
    counts += 0.5
    logp[:, :-1] = np.log(counts / counts.sum(axis=1, keepdims=True)).T
    return LangModel(langs, logp)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def declared_of(html: Column) -> Column:
    """Primary language of the lang attribute of the html element, lower case; empty if none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html(?=\s)[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))


def visible_of(html: Column) -> Column:
    # What is never closed lasts to the end, so every part of a page is looked at once.
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>", " ")
    return F.regexp_replace(bare, r"&[a-zA-Z#0-9]+;", " ")


def identify(rows: DataFrame, model: LangModel, p: LangParams = LangParams(), key: str = "doc_id", text: str = "text", declared: str | None = None, host: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Key, ``keep`` columns, lang_pred, lang_prob and kept, one row per input row.

    ``declared`` and ``host`` name columns with a declared language and a host (or any source
    name); either may be absent or null in rows, and is then no evidence. A host's last label
    is its suffix. A text without letters has no text evidence. kept: the background ("und")
    has less than ``p.reject`` of the posterior, and there is a letter. Null texts are empty
    ones (not kept); null keys and repeated rows are treated as other rows. A model without
    languages (no label to learn from) finds "und" everywhere and keeps every row with a letter.
    """
    ship(rows.sparkSession)
    n, found = len(model.langs), ("lang_pred", "lang_prob", "kept")
    kept = list(dict.fromkeys([key, *keep]))
    cols = [f"_c{i}" for i in range(len(kept))]
    temper, other, trust_d, trust_s = p.temper, p.other_prior, p.trust_markup, p.trust_suffix
    index = {lang: i for i, lang in enumerate(model.langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, "_text"):
            lls, letters = [], []
            for t, d, s in zip(as_bytes(b.column(0)), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                codes = trigram_counts(t)
                ll = model.logp[codes].sum(axis=0) * temper
                if d in index:
                    ll[:n] += np.log((1 - trust_d) / max(1, n))
                    ll[index[d]] += np.log1p(trust_d * n / (1 - trust_d))
                    ll[n] += np.log(1 / max(1, n))
                s = SUFFIXES.get(s or "")
                if s in index:
                    ll[:n] += np.log((1 - trust_s) / n)
                    ll[index[s]] += np.log1p(trust_s * n / (1 - trust_s))
                    ll[n] += np.log(1 / n)
                lls.append(ll - ll.max())
                letters.append(len(codes) > 0)
            arr = pa.array(lls, pa.list_(pa.float64()))
            names = ["_ll", "_letters", "_host", "_suffix"]
            fields = [pa.field("_ll", pa.list_(pa.float64())), pa.field("_letters", pa.bool_()), *[pa.field(x, pa.string()) for x in names[2:]], *list(b.schema)[4:]]
            yield pa.RecordBatch.from_arrays([arr, pa.array(letters, pa.bool_()), b.column(2).cast(pa.string()), b.column(3).cast(pa.string()), *b.columns[4:]], schema=pa.schema(fields))

    dec = F.lower(F.col(declared).cast("string")) if declared else F.lit(None).cast("string")
    hst = F.coalesce(F.col(host).cast("string"), F.lit("")) if host else F.lit("")
    suffix = F.when(hst.contains("."), F.substring_index(hst, ".", -1)).otherwise(F.lit(""))
    src = rows.select(F.col(text).cast("string").alias("_text"), dec.alias("_declared"), hst.alias("_host"), suffix.alias("_suffix"), *[quoted(k).alias(c) for c, k in zip(cols, kept, strict=True)])
    schema = "_ll array<double>, _letters boolean, _host string, _suffix string, " + ", ".join(f"{c} {rows.schema[k].dataType.simpleString()}" for c, k in zip(cols, kept, strict=True))
    ev = saved(src.mapInArrow(run, schema), "evidence")

    if not n:
        return ev.select(*cols, F.lit(OTHER), F.lit(1.0), "_letters").toDF(*kept, *found)

    # Expected counts by host, from evidence alone; a text without letters adds nothing.
    e = [f"exp(_ll[{i}])" for i in range(n)]
    total = " + ".join([*e, f"{other} * exp(_ll[{n}])"])
    per = [F.sum(F.expr(f"CASE WHEN _letters THEN {x} / ({total}) ELSE 0D END")).alias(f"c{i}") for i, x in enumerate(e)]
    by_host = ev.groupBy("_suffix", "_host").agg(*per)
    add = [F.sum(f"c{i}").alias(f"c{i}") for i in range(n)]
    by_group = by_host.groupBy("_suffix").agg(*add)
    overall = by_group.agg(*add).first()
    g = np.array([(overall[i] or 0.0) + 1 for i in range(n)])
    g = g / g.sum()
    arr = lambda mass, counts, base: F.array(*[(F.col(c) + mass * b) / (sum((F.col(x) for x in counts), F.lit(0.0)) + mass) for c, b in zip(counts, base, strict=True)])
    cs = [f"c{i}" for i in range(n)]
    group = by_group.select("_suffix", arr(p.group_mass, cs, [F.lit(float(x)) for x in g]).alias("_gp"))
    hosts = by_host.join(group, "_suffix").select("_suffix", "_host", arr(p.host_mass, cs, [F.col("_gp")[i] for i in range(n)]).alias("_prior"))
    fused = ev.join(hosts, ["_suffix", "_host"])
    names = F.array(*[F.lit(x) for x in [*model.langs, OTHER]])
    w = F.array(*[F.col("_prior")[i] * F.exp(F.col("_ll")[i]) for i in range(n)], F.lit(other) * F.exp(F.col("_ll")[n]))
    fused = fused.withColumn("_w", w).withColumn("_top", F.array_max("_w")).withColumn("_sum", F.aggregate("_w", F.lit(0.0), lambda a, x: a + x))
    best = F.array_position("_w", F.col("_top"))
    return fused.select(
        *cols,
        F.when(F.col("_letters"), F.get(names, (best - 1).cast("int"))).otherwise(F.lit(OTHER)),
        F.col("_top") / F.col("_sum"),
        F.col("_letters") & (F.col("_w")[n] < F.lit(p.reject) * F.col("_sum")),
    ).toDF(*kept, *found)
