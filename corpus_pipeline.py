"""The corpus pipeline: language ID, toxicity, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep the columns
of documents. Stages decide about rows, not about ids: rows that share a doc_id, or have none,
stay or go each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderline.llm import langid, near_dedup, packing, toxicity
from ladderline.llm.text import free, quoted, saved


def _numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """docs with a number for each row, and the name of that column; written, so that it doesn't
    change between reads."""
    row = free("_row", docs.columns)
    return saved(docs.withColumn(row, F.monotonically_increasing_id()), label), row


def _without(rows: DataFrame, gone: DataFrame, row: str, label: str) -> DataFrame:
    """The documents without those rows, which are written first: their size decides how they are joined."""
    return rows.join(saved(gone, label), row, "left_anti").drop(row)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in none of the corpus's languages or hold no letters.

    So null and empty texts go. Without any lang there is nothing to tell languages by, and every
    text with a letter stays. Rows are judged one by one, also where ids or whole rows repeat; an
    empty table gives no rows; extra columns stay.
    """
    rows, row = _numbered(docs, "numbered")
    found = langid.identify(rows, langid.fit(rows, key=row), key=row, declared="lang", host="source")
    return _without(rows, found.where(~F.col("kept")).select(row), row, "foreign")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the model scores 0.5 or more. It learns from all labels of documents left.

    Null and empty texts score as the bias, which keeps them unless most labels are toxic; without
    labels of both kinds every row stays. Rows are judged one by one, also where ids are null or
    repeat; an empty table gives no rows; extra columns stay, whatever their names.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free("score", docs.columns)
    scored = toxicity.score(docs, model, keep=tuple(docs.columns), out=score)
    return scored.where(F.col(score) < 0.5).select(*[quoted(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near-duplicates (five-word shingles, 0.8): the one of the
    smallest doc_id, or of none if no row has one.

    Of exact repeats, whole rows too, one stays. Null and empty texts are like no other and stay.
    An empty table gives no rows; extra columns stay.
    """
    rows, row = _numbered(docs, "numbered")
    groups = saved(near_dedup.near_components(rows, k=5, percent=80, key=row).select(row, "component_id"), "groups")
    # Aggregated, not joined by component: one component can hold a large part of the rows.
    named = groups.join(rows.select(row, F.col("doc_id").alias("_id")), row)
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", row))[row].alias(row))
    return _without(rows, groups.select(row).join(first.select(row), row, "left_anti"), row, "copies")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, packed into sequences of 2048 tokens.

    A null or empty text is its end token. Null ids and repeated rows are packed like others; an
    empty table gives no rows; extra columns are left out.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, window=2048)


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: No stage's method has a SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
