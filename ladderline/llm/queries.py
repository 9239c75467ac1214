"""Registered queries of the subpackage: thin digests over its operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, fingerprint, langid, license_scan, lm_score, near_dedup, packing, prefix_trie, quality, token_output, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output.token_index(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


#: The policy whose verdict the query reports.
QUALITY_POLICY = "v2"


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.ledger(_table(spark, sf_dir, "documents"))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"),
        quality.passes(QUALITY_POLICY).alias("kept"),
        "failed",
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
f AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
         + CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END
         + CASE WHEN 10 * word_chars < 25 * n_words THEN 16 ELSE 0 END
         + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed
FROM f
"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_score.score(_table(spark, sf_dir, "documents"), F.expr("crc32(CAST(doc_id AS STRING)) % 5 <> 1"))
    return out.withColumn("held_out", ~F.col("train")).drop("train")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents"), k=2, percent=80)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, concat(w[i], ' ', w[i + 1]) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r AS (SELECT a AS doc_id, b AS r FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.r = e.a),
c AS (SELECT doc_id, min(r) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(coalesce(c.c, d.doc_id), d.doc_id) AS component_id, coalesce(c.c, d.doc_id) >= d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, window=2048)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by text and host prior, for which the source stands. The lang column only labels
    the sample that the text models are fitted on: it is no evidence of a row's own language."""
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs), host="source")


def op8_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages: declared markup, address suffix and host are evidence."""
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", langid.visible_of(F.col("html")).alias("text"), langid.declared_of(F.col("html")).alias("declared"), langid.host_of(F.col("url")).alias("host")
    )
    model = langid.fit(_table(spark, sf_dir, "documents"))
    return langid.identify(pages, model, key="page_id", declared="declared", host="host")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # Rows without an id are not learned from either.
    held = F.expr("coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, true)")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"), k=10)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT len(e) AS n FROM v WHERE len(e) > 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id JOIN n ON len(q.e) = n.n AND len(c.e) = n.n WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, turn, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, sha256(concat(strlen(role), ':', role, text))[:32] AS digest
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT c, list({'role': role, 'text': text, 'w': w} ORDER BY turn NULLS FIRST, digest) AS l FROM t GROUP BY c),
h AS (
  SELECT c, l, c - c % 20 AS f,
         xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
             lambda a, b: list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, b)),
             CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM own),
whole AS (SELECT h.c, list_concat(list_slice(coalesce(own.l, []), 1, h.h), list_slice(h.l, h.h + 1, len(h.l))) AS l FROM h LEFT JOIN own ON own.c = h.f),
p AS (SELECT c, d, len(l) = d AS last, list_slice(l, 1, d) AS path, CASE WHEN d > 0 THEN l[d].w ELSE 0 END AS w FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM whole)),
n AS (SELECT d, path, min(c) AS node, count(*) AS n_convs, min(w) AS w, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '') AS ends FROM p GROUP BY d, path),
m AS (SELECT p.c, n.node, n.d, n.n_convs, n.w, n.ends FROM p JOIN n ON p.d = n.d AND p.path = n.path),
up AS (SELECT a.node, a.d, a.n_convs, a.w, a.ends, b.node AS parent FROM m a LEFT JOIN m b ON b.c = a.node AND b.d = a.d - 1 WHERE a.c = a.node),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS k FROM up WHERE d > 0 GROUP BY ALL),
x AS (SELECT up.*, coalesce(k, 0) AS k FROM up LEFT JOIN kids ON up.node = kids.node AND up.d = kids.d),
sums AS (
  SELECT a.node, a.d, sum(CASE WHEN x.k = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((x.n_convs - 1) * x.w) AS saved
  FROM x JOIN m a ON a.c = x.node AND a.d <= x.d GROUP BY ALL)
SELECT x.node AS conv_id, CAST(x.d AS BIGINT) AS depth, x.parent AS parent_conv_id, CAST(x.n_convs AS BIGINT) AS n_convs, CAST(x.k AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN sums ON x.node = sums.node AND x.d = sums.d
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_license_scan": op2_license_scan,
        "op3_lm_score": op3_lm_score,
        "op4_token_ids": op4_token_ids,
        "op5_quality_rules": op5_quality_rules,
        "op6_near_dedup": op6_near_dedup,
        "op7_packing": op7_packing,
        "op8_language_id": op8_language_id,
        "op8_language_id_pages": op8_language_id_pages,
        "op9_toxicity": op9_toxicity,
        "op10_top_k": op10_top_k,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_alignment": op12_alignment,
        "op13_fingerprint": op13_fingerprint,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": OP5_SQL, "op6_near_dedup": OP6_SQL, "op10_top_k": OP10_SQL, "op11_prefix_trie": OP11_SQL}
