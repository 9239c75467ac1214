"""The registered queries themselves: what they give their operators, and the columns they return."""

import zlib

import pytest

pytest.importorskip("public_tokenizers")

from ladderline.llm import langid, quality, queries, toxicity  # noqa: E402

TEXTS = ["the cat sat on the mat and the dog ran", "le chat est sur la table avec le chien", "you are a vile idiot and scum", "a nice day in the garden with flowers"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with null and repeated ids."""
    out = tmp_path_factory.mktemp("tables")
    rows = [(i, f"{TEXTS[i % 4]} {i}", "fr" if i % 4 == 1 else "en", f"s{i % 3}.example", 10) for i in range(80)]
    rows += [(None, TEXTS[2], "en", None, 1), (None, None, None, None, None), (5, TEXTS[0], "en", "s0.example", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(out / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 4 == 2)) for i in range(80)], "doc_id bigint, quality int, toxic int").write.parquet(str(out / "labels.parquet"))
    return str(out)


def test_toxicity_learns_from_no_held_out_row(spark, folder, monkeypatch):
    seen = {}
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels, **k: seen.setdefault("m", fit(docs, seen.setdefault("labels", labels), **k)))
    got = queries.op9_toxicity(spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 0
    rows = got.collect()
    assert len(rows) == 83 and all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    assert not any(held(r.doc_id) for r in seen["labels"].collect())


def test_language_query_takes_the_source_as_host_and_no_label(spark, folder, monkeypatch):
    seen = {}
    identify = langid.identify
    monkeypatch.setattr(langid, "identify", lambda rows, model, **k: identify(rows, model, **seen.setdefault("k", k)))
    got = queries.op8_language_id(spark, folder)
    assert seen["k"] == {"host": "source"} and got.count() == 83


def test_quality_query_reports_the_stated_policy(spark, folder):
    got = queries.op5_quality_rules(spark, folder)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    led = quality.ledger(spark.read.parquet(f"{folder}/documents.parquet"))
    want = led.select("doc_id", "n_words", quality.passes(queries.QUALITY_POLICY).alias("kept"))
    assert sorted(map(str, got.select("doc_id", "n_words", "kept").collect())) == sorted(map(str, want.collect()))
    assert all(r.base_failed and not r.kept for r in got.collect())  # all have fewer than 50 words


def test_model_score_query_holds_out_one_remainder(spark, folder):
    rows = queries.op3_lm_score(spark, folder).collect()
    assert len(rows) == 83 and all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op4_token_ids", "op7_packing", "op12_alignment", "op13_fingerprint"])
def test_every_document_comes_back(spark, folder, name):
    """Rows without id, and rows that repeat one, too: of pieces, all of a document's tokens."""
    rows = queries.queries()[name](spark, folder).collect()
    if name == "op7_packing":
        assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0) and sum(r.start == 0 for r in rows) == 83
    else:
        assert len(rows) == 83 and sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 5 for r in rows) == 2
