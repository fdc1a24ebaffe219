"""Nulls, empty and very long texts, ties, repeated rows, empty tables and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from lanternstats.llm import (
    decontaminate,
    language_id,
    lattice_lm,
    mixing,
    near_duplicates,
    quality_bands,
    secrets,
    token_counts,
    toxicity,
    warc_zstd,
)

from . import helpers as plain

LONG = " ".join(f"wörd{k % 977}" for k in range(60_000)) + " token=abcdefgh12345678 " + "z" * 30_000
TEXT = "a plain text of ten words that stands here again and again " * 8
ROWS = [
    (1, TEXT, "en", "s1", 7),
    (1, TEXT, "en", "s1", 7),
    (None, TEXT, None, None, None),
    (None, "other words of a row without an id", "en", None, 1),
    (2, None, "en", "s2", 2),
    (3, "", "de", "s2", 3),
    (4, " \t\n\x0b\x0c\r ", "de", "s1", 4),
    (5, LONG, "en", "s1", 5),
    (6, TEXT, "en", "s3", 6),
    (7, "12345 !!! \x00 ...", None, "", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, score long"
#: Extra columns with names that operators use themselves.
CLASH = ["size", "node", "h", "row", "id", "n", "w", "component", "spans", "target", "copies", "weight", "key", "kept", "tail", "word"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.selectExpr("*", *[f"'x' AS {c}" for c in CLASH])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "plain text of ten"), (2, "Words, that stand"), (None, "a b c"), (3, None), (4, ""), (1, "plain text of ten"), (5, LONG)]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 1, None), (None, 1, 1), (6, 1, 0), (5, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


def rows_of(frame, *keys):
    return sorted((tuple(r[k] for k in keys) for r in frame.collect()), key=str)


def test_lattice_lm(docs, empty, spark):
    got = lattice_lm.score_documents(docs, head=5, passes=1).collect()
    assert len(got) == len(ROWS)
    tokens = {str((r["doc_id"], r["n_tokens"])) for r in got}
    assert {"(2, 1)", "(3, 1)", "(4, 1)", "(5, 60003)"} <= tokens
    assert all(r["score"] <= 0 and r["n_known"] <= r["n_tokens"] for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 6)}) <= 2
    assert lattice_lm.score_documents(empty).count() == 0
    held = spark.createDataFrame([(2, "never seen"), (3, None)], "doc_id long, text string")
    got = lattice_lm.score_documents(held, fold=(1, 0)).collect()
    assert {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}
    assert {r["base_score"] for r in got} == {0.0} and min(r["score"] for r in got) < -5


def test_secrets(docs, empty):
    got = secrets.digests(secrets.scan(docs))
    assert got.count() == len(ROWS)
    spans = dict(rows_of(got.where("doc_id = 5"), "doc_id", "spans"))
    assert spans == {5: plain.span_text(plain.base_spans(LONG))} and spans[5]
    assert {r["base_sha256"] for r in got.where("doc_id <> 5 OR doc_id IS NULL").collect()} == {plain.sha("")}
    assert secrets.scan(empty).count() == 0


def test_compression_bands(docs, empty):
    got = quality_bands.compression_bands(docs)
    assert rows_of(got.where("doc_id IN (2, 3, 4)"), "doc_id", "n_words", "verdict", "kept") == [
        (2, 0, "empty", False), (3, 0, "empty", False), (4, 0, "incompressible", False)
    ]
    assert got.count() == len(ROWS) and quality_bands.compression_bands(empty).count() == 0


def test_mixing(docs, empty):
    plan = mixing.mix_plan(docs)
    assert plan.count() == len(ROWS) and set(CLASH) <= set(plan.columns)
    assert rows_of(plan.where("source IS NULL"), "size", "source_size") == [(8, 104), (96, 104)]
    assert rows_of(plan.where("source = 's2'"), "size", "target", "copies") == [(0, 0.0, 0), (0, 0.0, 0)]
    assert len(set(rows_of(plan.where("doc_id = 1"), "doc_id", "copies"))) == 1
    assert mixing.mix_plan(empty).count() == 0 and mixing.emit(mixing.mix_plan(empty)).count() == 0


def test_token_counts(docs, empty):
    got = token_counts.token_counts(docs)
    assert rows_of(got.where("doc_id IN (2, 3)"), "doc_id", "n_bytes", "n_tokens", "over_limit") == [(2, 0, 0, False), (3, 0, 0, False)]
    assert got.count() == len(ROWS) and token_counts.token_counts(empty).count() == 0


def test_contamination(docs, empty, items):
    got = decontaminate.contamination(docs, items)
    found = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(ROWS) and set(found) == {r[0] for r in ROWS}
    assert found[1]["items"] == ["1"] and found[1]["n_hit"] == 32
    assert found[5]["n_hit"] == found[5]["n_words"] and found[5]["items"] == ["5"]
    assert found[2]["n_words"] == 0 and not found[4]["contaminated"]
    assert rows_of(got.where("doc_id IS NULL"), "n_words") == [(8,), (96,)]
    assert decontaminate.contamination(empty, items).count() == 0
    clean = decontaminate.contamination(docs, items.where("false"))
    assert clean.count() == len(ROWS) and clean.where("contaminated OR n_items > 0").isEmpty()


def test_contamination_is_judged_by_row(spark, items):
    text = items.where("text IS NOT NULL").first()["text"]
    docs = spark.createDataFrame([(None, text), (None, "quite another text"), (7, text), (7, "clean"), (7, None)], "doc_id int, text string")
    got = rows_of(decontaminate.contamination(docs, items), "doc_id", "contaminated")
    assert got == sorted([(None, True), (None, False), (7, True), (7, False), (7, False)], key=str)


def test_draws_without_an_id(spark):
    rows = [(None, f"w{i} and more", "s") for i in range(2000)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    copies = {r["copies"]: r["count"] for r in plan.groupBy("copies").count().collect()}
    # The rate is 1.5: about half of the rows once, half twice.
    assert set(copies) == {1, 2} and 850 < copies[1] < 1150


def test_blocks_of_the_benchmark(docs, items, monkeypatch):
    whole = rows_of(decontaminate.contamination(docs, items), "doc_id", "n_words", "n_hit", "items_sha256")
    monkeypatch.setattr(decontaminate, "BLOCK", 20_000)
    assert rows_of(decontaminate.contamination(docs, items), "doc_id", "n_words", "n_hit", "items_sha256") == whole


def test_toxicity(docs, empty, labels):
    got = toxicity.toxicity(docs, labels, fold=None)
    assert got.count() == len(ROWS) and got.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    assert {r["predicted"] for r in toxicity.toxicity(docs, labels.where("false")).collect()} == {0}
    assert {r["predicted"] for r in toxicity.toxicity(docs, labels.where("toxic = 1 AND doc_id = 1"), fold=None).collect()} == {1}
    assert toxicity.toxicity(empty, labels).count() == 0


def test_language_id(docs, empty):
    got = language_id.language_id(docs, fold=None)
    assert rows_of(got.where("doc_id IN (2, 3, 4, 7)"), "doc_id", "lang_pred") == [(i, "und") for i in (2, 3, 4, 7)]
    assert rows_of(got.where("doc_id = 6"), "lang_pred") == [("en",)] and got.count() == len(ROWS)
    assert language_id.language_id(empty).count() == 0
    assert {r["lang_pred"] for r in language_id.language_id(docs, labelled=empty).collect()} == {"und"}


def test_near_duplicates(docs, empty, spark):
    got = near_duplicates.near_duplicates(docs)
    assert got.count() == len(ROWS)
    assert rows_of(got.where("doc_id IN (1, 6)"), "doc_id", "component_id", "kept") == [(1, 1, True), (1, 1, True), (6, 1, False)]
    assert rows_of(got.where("doc_id IN (2, 3, 4)"), "doc_id", "n_shingles", "kept") == [(i, 0, True) for i in (2, 3, 4)]
    assert rows_of(got.where("doc_id IS NULL"), "component_id", "kept") == [(None, True)] * 2
    assert near_duplicates.near_duplicates(empty).count() == 0
    copies = spark.createDataFrame([(k, f"{TEXT} w{k}") for k in range(5)], "doc_id int, text string")
    for kind in ("smallint", "decimal(9,0)", "int"):
        of_kind = copies.select(F.col("doc_id").cast(kind).alias("doc_id"), "text")
        assert {int(r.component_id) for r in near_duplicates.near_duplicates(of_kind).collect()} == {0}
    named = spark.createDataFrame([("b", TEXT), ("a", TEXT), ("c", "short")], "doc_id string, text string")
    assert rows_of(near_duplicates.near_duplicates(named), "doc_id", "component_id") == [("a", "a"), ("b", "a"), ("c", "c")]


def test_warc(spark):
    rows = [(3, "http://a/\r\nx y", TEXT), (1, None, TEXT), (2, "", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
            (None, "u", TEXT), (1, None, TEXT), (7, "u", LONG * 2), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS digest", "3 AS first")
    got = warc_zstd.round_trip(pages)
    kinds = rows_of(got, "page_id", "record_type", "refers_to")
    assert kinds == sorted(
        [(3, "revisit", 1), (1, "response", None), (1, "response", None), (2, "response", None), (4, "response", None),
         (5, "response", None), (6, "response", None), (None, "revisit", 1), (7, "response", None), (8, "response", None)], key=str
    )
    sizes = {r["page_id"]: r["payload_bytes"] for r in got.collect()}
    assert sizes[2] == 0 and sizes[3] == len(TEXT) and sizes[7] == len((LONG * 2).encode())
    assert warc_zstd.round_trip(pages.where("false")).count() == 0
