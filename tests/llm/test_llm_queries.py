"""Each registered query against SQL or a plain version, on the whole of its smallest tables."""

import collections
import math

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lanternstats.llm.queries import ORACLES, QUERIES

from . import helpers as plain

FOLDER = plain.FOLDER


def read(name):
    return pd.read_parquet(f"{FOLDER}/{name}.parquet").sort_values(f"{'page' if name == 'pages' else 'doc'}_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def documents():
    return read("documents")


def result(spark, name, key="doc_id"):
    found = QUERIES[name](spark, FOLDER).toPandas().sort_values(key).reset_index(drop=True)
    assert found[key].is_unique
    return found


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    relation = con.sql(ORACLES[name])
    frame = QUERIES[name](spark, FOLDER)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in frame.schema.fields} == dict(zip(relation.columns, map(str, relation.types)))
    key = list(frame.columns) if len(frame.columns) < 5 or name.startswith("op13") else frame.columns[0]
    got = frame.toPandas().sort_values(key).reset_index(drop=True)
    want = relation.df().sort_values(key).reset_index(drop=True)[list(got.columns)]
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_lattice_lm(spark, documents):
    got = result(spark, "op1_lattice_lm")
    tokens = [plain.words(plain.lower(t)) + [""] for t in documents.text]
    held = [plain.fold(i, 7, 2) for i in documents.doc_id]
    counts = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t) for t in tokens]
    assert list(got.held_out) == held and set(got.train_tokens) == {n}
    assert list(got.n_tokens) == list(map(len, tokens))
    assert list(got.n_known) == [sum(w in counts for w in t) for t in tokens]
    np.testing.assert_allclose(got.base_score, base, rtol=1e-9)
    # Training words alone: the model is a little below their relative frequencies, and never above them by much.
    known = got[got.n_known == got.n_tokens]
    assert (known.score / known.n_tokens - known.base_score / known.n_tokens).abs().max() < 0.3
    unknown = got[got.held_out]
    assert (unknown.score < 0).all() and unknown.score.sum() / unknown.n_tokens.sum() > -6


def test_secret_scan(spark):
    folder = "/root/testdata/sf0.01"
    documents = pd.read_parquet(f"{folder}/documents.parquet").sort_values("doc_id").reset_index(drop=True)
    got = QUERIES["op2_secret_scan"](spark, folder).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert list(got.doc_id) == list(documents.doc_id)
    for row, text in zip(got.itertuples(), documents.text):
        spans = plain.base_spans(text)
        kinds = collections.Counter(s[3] for s in spans)
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert row.base_sha256 == plain.sha(plain.span_text(spans))
        assert {s for s in plain.span_text(spans).split(",") if s} <= set(row.spans.split(","))
    assert got.n_assign.sum() + got.n_access.sum() > 0


def test_compression_bands(spark, documents):
    got = result(spark, "op3_compression_bands")
    for row, text in zip(got.itertuples(), documents.text):
        w = plain.words(text)
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {k + d for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if plain.words(x)]
        assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(w), sum(map(len, w)), len(hit))
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (row.kept and row.base_failed)
    assert 0 < got.kept.mean() < 1


def test_token_counts(spark, documents):
    got = result(spark, "op5_token_counts")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [len(e.ids) for e in tokenizer.encode_batch(list(documents.text), add_special_tokens=False)]
    assert list(got.n_tokens) == want
    assert list(got.n_bytes) == [len(t.encode()) for t in documents.text]
    assert list(got.over_limit) == [n > 512 for n in want]


def test_contamination(spark, documents):
    got = result(spark, "op6_decontaminate")
    items = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    want = plain.contamination(dict(zip(documents.doc_id, documents.text)), dict(zip(items.item_id, items.text)))
    for row in got.itertuples():
        n, hit, found = want[row.doc_id]
        digest = plain.sha(",".join(sorted(map(str, found))))
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n, hit, len(found), digest)
        assert row.contaminated == (hit > 0)


def test_toxicity(spark, documents):
    got = result(spark, "op7_toxicity")
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert list(got.held_out) == [plain.fold(i, 3, 1) for i in documents.doc_id]
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet").dropna(subset=["toxic"])
    seen = got[~got.held_out].merge(labels, on="doc_id")
    assert seen[seen.toxic == 1].score.mean() > seen[seen.toxic == 0].score.mean() + 0.5


def test_language_id(spark, documents):
    got = result(spark, "op8_language_id")
    assert list(got.held_out) == [plain.fold(i, 3, 1) for i in documents.doc_id]
    held = got.held_out & documents.lang.notna()
    assert (got.lang_pred == documents.lang)[held].mean() > 0.97
    assert got.score.between(0, 1).all()


def test_near_duplicates(spark, documents):
    got = result(spark, "op9_near_duplicates")
    component, sets = plain.near_duplicates(dict(zip(documents.doc_id, documents.text)), 3, 85)
    assert dict(zip(got.doc_id, got.component_id)) == component
    assert dict(zip(got.doc_id, got.n_shingles)) == {i: len(s) for i, s in sets.items()}
    assert list(got.kept) == list(got.doc_id == got.component_id)
    assert not got.kept.all()


def test_warc(spark):
    got, pages = result(spark, "op10_warc_zstd", "page_id"), read("pages")
    assert list(got.page_id) == list(pages.page_id)
    assert list(got.payload_digest) == list(map(plain.sha, pages.html))


def test_ngram_join(spark, documents):
    got = result(spark, "op11_ngram_join")
    component, sets = plain.near_duplicates(dict(zip(documents.doc_id, documents.text)), 5, 80)
    assert list(got.n_shingles) == [len(sets[i]) for i in got.doc_id]
    assert list(got.component_id) == [component[i] for i in got.doc_id]
    assert len(set(got.component_id)) < len(got)
