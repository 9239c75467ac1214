"""Near duplicates, LM scores, toxicity, language, top-k, pipeline: brute force and edge cases."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from ladderline.llm import components, langid, lm_score, near_dedup, topk, toxicity  # noqa: E402


def _words(t):
    return (t or "").encode().lower().split()


def _classes(rows, k, percent):
    """component of each id by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = _words(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def _near_texts():
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [[rnd.choice(vocabulary) for _ in range(120)] for _ in range(4)]
    out = [None, "", " \n ", "one", "One", "two words", "two  WORDS", "x y z " * 4000]
    for words in base:
        for n in (0, 0, 1, 3, 6, 9, 12, 15, 20, 30):
            w = list(words)
            for _ in range(n):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            out.append(" ".join(w))
    return list(enumerate(out))


@pytest.mark.parametrize("k", [2, 5])
def test_near_components(spark, k):
    rows = _near_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "two words", "x")], "doc_id bigint, text string, digest string")
    got = near_dedup.near_components(df, k=k).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == _classes(rows, k, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_exhaustive_step_is_exact_by_itself(spark, monkeypatch):
    """Without star rounds and with tiny blocks the blocks find everything."""
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rows = _near_texts()
    got = near_dedup.near_components(spark.createDataFrame(rows, "doc_id bigint, text string"), k=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _classes(rows, 2, 80)


def test_near_components_of_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (9, "other text here")], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_components(df, k=2).collect()} == {(5, 5), (9, 5)}
    assert near_dedup.near_components(df.limit(0), k=2).count() == 0
    # One key on many different texts: its texts meet, and no join multiplies its rows.
    many = spark.createDataFrame([(3, f"x{i} y{i} z{i}") for i in range(200)] + [(8, "x7 y7 z7")], df.schema)
    assert Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_components(many, k=2).collect()) == {(3, 3, True): 200, (8, 3, False): 1}


def test_unite_returns_a_forest():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n, e = 40, rng.integers(0, 60)
        u, v = rng.integers(0, n, e), rng.integers(0, n, e)
        root, used = near_dedup.unite(np.arange(n), u, v)
        again, _ = near_dedup.unite(np.arange(n), u[used], v[used])
        assert (root == again).all() and len(used) == n - len(np.unique(root)) and (root[u] == root[v]).all()


def test_components_of_a_path(spark):
    n = 60
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    assert {r.node: r.root for r in components.components(e).collect()} == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100}


def test_odd_sketches_tell_similarities():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    sketch = lambda x: near_dedup.odd_sketch(near_dedup.min_samples(np.unique(x), near_dedup._FINE_XOR, near_dedup._FINE_MUL), near_dedup._FINE_PERM, near_dedup.FINE_BITS).view(np.uint64)
    bits = []
    for same in (0.95, 0.9, 0.8, 0.6):
        keep = round(2000 * same / (1 + same))
        other = np.concatenate([s[:keep], rng.integers(0, 2**63, 1000 - keep, dtype=np.uint64)])
        bits.append(int(np.bitwise_count(sketch(s) ^ sketch(other)).sum()))
    assert bits == sorted(bits) and bits[2] < near_dedup.MOST_FINE < bits[3]
    assert bits[2] == pytest.approx(675, abs=5 * 34)


def test_lm_scores(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 1 << 15)
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120).collect()]
    rows = real + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "The the THE unseenword"), (None, "no id"), (10**6 + 2, "The the THE unseenword")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, word string")
    rule = F.expr("crc32(CAST(doc_id AS STRING)) % 5 <> 1")
    got = lm_score.score(df, rule).collect()
    train = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    tok = [[*_words(t), None] for _, t in rows]
    uni = Counter(w for t, use in zip(tok, train) if use for w in t)
    pair = Counter(p for t, use in zip(tok, train) if use for p in zip([None, *t], t))
    n, v = sum(uni.values()), len(uni)
    held = Counter()
    for t, use in zip(tok, train):
        for a, b in zip([None, *t], t) if use else ():
            ctx = uni[a] - 1
            p2 = (pair[a, b] - 1) / ctx if ctx > 0 else 0
            held[int(lm_score._bucket(np.array([ctx]))[0]), int(lm_score._grid(np.array([p2]))[0]), int(lm_score._grid(np.array([(uni[b] - 1) / (n - 1)]))[0])] += 1
    w = lm_score.learn_weights(np.array([(*k, m) for k, m in held.items()]), v)

    def score(t):
        out = 0.0
        for a, b in zip([None, *t], t):
            lam = w[int(lm_score._bucket(np.array([uni[a]]))[0])]
            out += math.log10(lam[0] * pair[a, b] / max(uni[a], 1) + lam[1] * uni[b] / n + lam[2] / (v + 1))
        return out

    want = sorted((str(i), use, len(t), sum(uni[x] > 0 for x in t), round(sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 6), round(score(t), 6)) for (i, _), use, t in zip(rows, train, tok))
    assert sorted((str(r.doc_id), r.train, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert lm_score.score(df.limit(0), rule).count() == 0
    assert all(math.isfinite(r.score) for r in lm_score.score(df, F.lit(False)).collect())


def test_weights_rise_with_what_explains_the_counts():
    good = lm_score.learn_weights(np.array([[5, 5, 60, 1000]]), 1000)[5]
    none = lm_score.learn_weights(np.array([[5, 0, 20, 1000]]), 1000)[5]
    assert good[0] > 0.9 and none[1] > 0.9 and np.allclose(good.sum(), 1)


def test_languages_of_nothing(spark, sf_dir):
    """No rows, or no labels, to learn from: nothing is told apart and every text with a letter stays."""
    docs = spark.createDataFrame([(1, "some text", None, "a.de"), (2, "12", None, None), (None, None, None, "h")], "doc_id bigint, text string, lang string, source string")
    for m in (langid.fit(docs), langid.fit(docs.limit(0))):
        got = langid.identify(docs, m, declared="lang", host="source").collect()
        assert {(r.doc_id, r.lang_pred, r.lang_prob, r.kept) for r in got} == {(1, "und", 1.0, True), (2, "und", 1.0, False), (None, "und", 1.0, False)}
        assert langid.identify(docs.limit(0), m).count() == 0
    m = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    clash = docs.selectExpr("doc_id AS _row", "text", "lang AS _ll", "source AS kept_")
    assert langid.identify(clash, m, key="_row", keep=("_ll",)).columns == ["_row", "_ll", "lang_pred", "lang_prob", "kept"]


def test_posteriors_by_hand(spark):
    """Text, declaration, suffix and host priors multiplied in Python."""
    p = langid.LangParams()
    rng = np.random.default_rng(3)
    logp = np.log(rng.dirichlet(np.ones(langid.BUCKETS), 4).T)
    m = langid.LangModel(["de", "en", "fr"], logp)
    rows = [(i, " ".join(rng.choice(["ab", "cde", "xyz", "q"], rng.integers(0, 6))), [None, "de", "FR", "xx"][i % 4], [None, "h.de", "k.de", "m.example.com", "plain"][i % 5]) for i in range(60)]
    lls = []
    for _, t, d, h in rows:
        ll = p.temper * logp[langid.trigram_counts(t.encode())].sum(0)
        for lang, trust in (((d or "").lower(), p.trust_markup), (langid.SUFFIXES.get((h or "").rpartition(".")[2]) if h and "." in h else None, p.trust_suffix)):
            if lang in m.langs:
                ll = ll + np.log([*[(1 - trust) / 3 + trust * (x == lang) for x in m.langs], 1 / 3])
        lls.append(ll - ll.max())
    letters = [any(c.isalpha() for c in t) for _, t, _, _ in rows]
    own = [np.exp(x[:3]) / (np.exp(x[:3]).sum() + p.other_prior * np.exp(x[3])) * y for x, y in zip(lls, letters)]
    suffix = lambda h: h.rpartition(".")[2] if h and "." in h else ""
    total = sum(own) + 1
    prior = {}
    for h in {r[3] for r in rows}:
        group = sum(x for x, r in zip(own, rows) if suffix(r[3]) == suffix(h))
        group = (group + p.group_mass * total / total.sum()) / (group.sum() + p.group_mass)
        host = sum(x for x, r in zip(own, rows) if (r[3] or "") == (h or ""))
        prior[h] = (host + p.host_mass * group) / (host.sum() + p.host_mass)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, d string, h string")
    got = {r.doc_id: r for r in langid.identify(df, m, p, declared="d", host="h").collect()}
    for (i, _, _, h), ll, some in zip(rows, lls, letters):
        w = np.exp(ll) * [*prior[h], p.other_prior]
        r = got[i]
        assert r.lang_prob == pytest.approx(w.max() / w.sum(), rel=1e-6) and r.kept == (some and w[3] < p.reject * w.sum())
        assert r.lang_pred == ([*m.langs, "und"][w.argmax()] if some else "und")


def test_toxicity_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    terms = np.unique(toxicity.term_set(b"alpha beta gamma delta insult group"))
    m = toxicity.Fm(terms, 0.3, rng.normal(size=len(terms)), rng.normal(size=(len(terms), 8)))
    at = m.at(toxicity.term_set(b"Alpha, gamma insult unknown"))
    z = 0.3 + sum(m.w[i] for i in at) + sum(m.v[i] @ m.v[j] for i, j in itertools.combinations(at, 2))
    assert len(at) == 3 and m.score(b"Alpha, gamma insult unknown") == pytest.approx(1 / (1 + math.exp(-z)))


def test_toxicity_terms_are_those_of_a_local_count(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    m = toxicity.fit(docs, labels)
    got = docs.join(labels, "doc_id").where("toxic IS NOT NULL").orderBy("doc_id").collect()
    rows, y = [toxicity.term_set((r.text or "").encode()) for r in got], np.array([r.toxic for r in got], float)
    assert np.array_equal(m.terms, toxicity.choose_terms(rows, y, toxicity.FmParams()))


def test_toxicity_learns_an_interaction():
    """Two terms that are harmless alone and toxic together."""
    rnd, rows, y = random.Random(0), [], []
    for _ in range(3000):
        a, b = rnd.random() < 0.4, rnd.random() < 0.4
        text = " ".join([rnd.choice(["alpha", "beta", "gamma"]), *["insult"] * a, *["group"] * b])
        rows.append(toxicity.term_set(text.encode()))
        y.append(float(a and b))
    m = toxicity.train(rows, np.array(y))
    s = {t: m.score(t.encode()) for t in ("alpha insult", "alpha group", "alpha insult group", "alpha")}
    assert s["alpha insult group"] > 0.8 and max(s["alpha insult"], s["alpha group"], s["alpha"]) < 0.2


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.expr("crc32(CAST(doc_id AS STRING)) % 5 = 0")
    m = toxicity.fit(docs, labels.where(~held))
    r = toxicity.score(docs, m).where(held).join(labels, "doc_id").select("toxic", (F.col("score") >= 0.5).cast("int").alias("p")).toPandas()
    assert ((r.p == 1) & (r.toxic == 1)).sum() >= 0.8 * (r.toxic == 1).sum() and ((r.p == 1) & (r.toxic == 0)).sum() <= 0.01 * len(r)
    edge = spark.createDataFrame([(1, None, 5.0), (None, "", 5.0), (1, None, 5.0), (2, "word " * 30000, None)], "doc_id bigint, text string, score double")
    out = toxicity.score(edge, m).collect()
    assert len(out) == 4 and all(0 <= x.score <= 1 for x in out)
    assert toxicity.score(edge.limit(0), m).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).w0 == 0.0


def test_toxicity_bias_does_not_depend_on_the_sample(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(1000).selectExpr("id AS doc_id", "int(id % 10 = 0) AS toxic")
    all_rows = toxicity.fit(docs, labels)
    for most in (50, 100, 300):
        m = toxicity.fit(docs, labels, toxicity.FmParams(sample=most))
        assert not len(m.terms) and abs(m.score(b"unseen") - all_rows.score(b"unseen")) < 0.005
    assert abs(all_rows.score(b"unseen") - 0.1) < 0.005


@pytest.mark.parametrize("labels", [[], [(77, 1)], [(1, 1), (2, 1)], [(1, None)]])
def test_toxicity_without_both_labels_rejects_nothing(spark, tmp_path, labels):
    import corpus_pipeline as cp

    docs = spark.createDataFrame([(1, "a text"), (2, "another"), (3, None), (None, "")], "doc_id bigint, text string")
    given = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    given.write.parquet(f"{tmp_path}/labels.parquet")
    assert sorted(r.text or "" for r in cp.toxicity_stage(spark, docs, str(tmp_path)).collect()) == ["", "", "a text", "another"]
    assert all(r.score < 0.01 for r in toxicity.score(docs, toxicity.fit(docs, given)).collect())


def test_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    m = langid.fit(docs)
    r = langid.identify(docs, m, keep=("lang",)).toPandas()
    assert len(r) == docs.count() and (r.lang == r.lang_pred).mean() > 0.98 and r.kept.all()
    edge = spark.createDataFrame([(1, None, "de", "a.example.de"), (2, "123 !!", None, None), (None, "the and of", "xx", "h"), (2, "123 !!", None, None)], "doc_id bigint, text string, declared string, host string")
    out = {(x.doc_id, x.kept, x.lang_pred) for x in langid.identify(edge, m, declared="declared", host="host").collect()}
    assert out == {(1, False, "und"), (2, False, "und"), (None, True, "en")}
    assert langid.identify(edge.limit(0), m, declared="declared", host="host").count() == 0


def test_declared_markup_and_host_decide_where_the_text_does_not(spark, sf_dir):
    m = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = [(i, "der die und das ist nicht ein", None, "h.example.com") for i in range(50)] + [(100, "x", None, "h.example.com"), (101, "x", "fr", "other.example.com"), (102, "x", None, "z.fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, d string, h string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, m, declared="d", host="h").collect()}
    assert (got[100], got[101], got[102]) == ("de", "fr", "fr")


def _brute(rows, queries, k):
    ok = [(i, np.floor(np.array(v, float) * 1024).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, v in ok:
        if i in queries:
            best = sorted((-int(v @ w), j) for j, w in ok if j != i)[:k]
            out[i] = [(j, -s) for s, j in best]
    return out


@pytest.mark.parametrize("kind", ["clusters", "equal", "few"])
def test_top_k(spark, kind):
    rng = np.random.default_rng(2)
    n = {"clusters": 700, "equal": 300, "few": 5}[kind]
    centre = rng.normal(size=(6, 8))
    x = (centre[rng.integers(0, 6, n)] * rng.uniform(0.2, 3, (n, 1)) + rng.normal(0, 0.1, (n, 8))).astype(np.float32)
    if kind == "equal":
        x[:200] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(10**6, None), (10**6 + 1, [1.0] * 7 + [None]), (10**6 + 2, [float("nan")] * 8), (None, [1.0] * 8)]
    rows.append(rows[3])  # a repeated candidate
    other = [(10**6 + 10, [9.0] * 7), (10**6 + 20, []), (10**6 + 30, [9.0] * 9)]  # of other lengths: no part
    df = spark.createDataFrame([(*r, "x") for r in rows + other], "vec_id bigint, embedding array<float>, score string")
    got = {}
    p = topk.IndexParams(pivots=8, rings=4, block=32, query_block=16)
    for r in topk.top_k(df, df.where("vec_id % 10 = 0"), 10, p=p).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert got == _brute(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 10)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(df, df).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = cp.language_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    clean = cp.toxicity_stage(spark, kept, sf_dir)
    gone = {r.doc_id for r in kept.select("doc_id").collect()} - {r.doc_id for r in clean.select("doc_id").collect()}
    assert clean.columns == docs.columns and gone and not any(labels.get(i) == 0 for i in gone)
    one = cp.near_dedup_stage(spark, clean, sf_dir)
    want = _classes([(r.doc_id, r.text) for r in clean.select("doc_id", "text").collect()], 5, 80)
    assert one.columns == docs.columns and {r.doc_id for r in one.select("doc_id").collect()} == {c for _, c in want.values()}
    packed = cp.packing_stage(spark, one, sf_dir)
    assert packed.select("doc_id").distinct().count() == one.count()


def test_stages_decide_by_row(spark):
    """Equal ids and no ids: one row of each group stays, and no unique text goes with another."""
    import corpus_pipeline as cp

    a, b = "one two three four five six seven", "other words stand in this text here"
    rows = [(5, a), (5, a), (9, a), (9, b), (None, a), (None, "no id but twice a b c"), (None, "no id but twice a b c"), (7, None), (7, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = Counter((r.doc_id, r.text) for r in cp.near_dedup_stage(spark, docs, "").collect())
    assert got == Counter([(5, a), (9, b), (None, "no id but twice a b c"), (7, None), (7, ""), (None, None)])
    # A text without letters goes alone.
    docs = spark.createDataFrame([(1, a, "en", "s", 1), (1, "1 2 3", "en", "s", 1), (None, "4 5", "en", "s", 1), (None, b, "en", "s", 1)], docs.schema)
    assert sorted(r.text for r in cp.language_stage(spark, docs, "").collect()) == [a, b]
    assert cp.near_dedup_stage(spark, docs.limit(0), "").count() == 0


def test_pipeline_of_awkward_tables(spark, tmp_path):
    """No rows, no labels, nulls everywhere, and extra columns named like the stages' own."""
    import corpus_pipeline as cp

    own = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, _text string, Score string, _own_score string, component_id string, _id string"
    text = "some words that say very little but are not few at all"
    rows = [(1, text, None, None, None), (1, text, None, None, None), (None, None, None, None, None), (2, "", None, "s", 0)]
    docs = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], own)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = docs
    for (_, stage), n in zip(cp.STAGES[:3], (2, 2, 1), strict=True):
        at = cp.saved(stage(spark, at, str(tmp_path)), "test")
        assert at.columns == docs.columns and at.count() == n
    got = cp.run(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.start, r.offset) for r in got] == [(1, 0, 0)]
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
