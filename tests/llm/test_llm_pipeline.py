"""The stages against plain versions, each on its own input, and the whole on rows with nulls and repeats."""

import collections

import corpus_pipeline
import pandas as pd
import pytest

from . import helpers as plain

FOLDER = plain.FOLDER


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What goes into and comes out of each stage."""
    root, out = tmp_path_factory.mktemp("stages"), [pd.read_parquet(f"{FOLDER}/documents.parquet")]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append(docs.toPandas().sort_values("doc_id").reset_index(drop=True))
    return out


def test_language_stage(kept):
    assert set(kept[1].doc_id) == {i for i, t in zip(kept[0].doc_id, kept[0].text) if any(c.isalpha() for c in t)}


def test_near_duplicate_stage(kept):
    component, _ = plain.near_duplicates(dict(zip(kept[1].doc_id, kept[1].text)), 5, 80)
    assert set(kept[2].doc_id) == set(component.values()) and len(kept[2]) < len(kept[1])


def test_decontamination_stage(kept):
    items = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    found = plain.contamination(dict(zip(kept[2].doc_id, kept[2].text)), dict(zip(items.item_id, items.text)))
    assert set(kept[3].doc_id) == {i for i, (_, hit, _) in found.items() if not hit}


def test_secret_stage(kept):
    before, after = kept[3].set_index("doc_id"), kept[4].set_index("doc_id")
    assert set(before.index) == set(after.index)
    for i, text in before.text.items():
        if plain.base_spans(text):
            assert "[SECRET]" in after.text[i] and not plain.base_spans(after.text[i])
            assert after.n_chars[i] == len(after.text[i])
        elif "[SECRET]" not in after.text[i]:
            assert after.text[i] == text and after.n_chars[i] == before.n_chars[i]


def test_mixing_stage(kept):
    times = collections.Counter(kept[5].doc_id)
    assert set(times) <= set(kept[4].doc_id) and max(times.values()) <= 2
    size = {i: len(plain.words(t)) for i, t in zip(kept[4].doc_id, kept[4].text)}
    taken, total = sum(size[i] * n for i, n in times.items()), sum(size.values())
    assert 1.1 * total < taken < 1.9 * total
    assert list(kept[5].columns) == [*corpus_pipeline.COLUMNS, "copy"]


def test_run_on_nulls_and_repeats(spark, tmp_path):
    text = "some words of a text that is long enough to have shingles token=abcdefgh12345678 and more"
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, text, None, None, None), (None, "no id here", "en", "a", 1),
            (3, None, "en", "b", 0), (4, "", "en", "b", 0), (5, "...", "en", "b", 3), (None, text, "en", "a", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a test item that no document has at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} <= {1, None} and got
    assert all("abcdefgh12345678" not in r["text"] for r in got)
    spark.read.parquet(f"{tmp_path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def staged(spark, path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_rows_are_told_apart_without_ids(spark, tmp_path):
    """Null ids, repeated ids and equal rows: one row of each group stays, and a row goes for its own text only."""
    a, b, c = (" ".join(f"{x}word{k}" for k in range(30)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (1, c), (1, c), (None, c), (None, a), (None, "only here without any id")]
    docs = staged(spark, tmp_path / "near", [(i, t, "en", "s", 1) for i, t in rows])
    got = corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([("3", a), ("5", b), ("1", c), ("None", "only here without any id")])
    docs = staged(spark, tmp_path / "none", [(None, t, "en", "s", 1) for t in (a, a, b)])
    assert sorted(r["text"] for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()) == [a, b]

    spark.createDataFrame([(1, a)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = staged(spark, tmp_path / "leaks", [(i, t, "en", "s", 1) for i, t in [(None, a), (None, b), (None, b), (7, a), (7, c)]])
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([("None", b), ("None", b), ("7", c)])


def test_no_label_rejects_no_text_with_a_letter(spark, tmp_path):
    docs = staged(spark, tmp_path / "plain", [(1, "some words", None, "s", 1), (2, "123 ...", None, "s", 1), (3, None, None, "s", 1), (4, "слово", None, "s", 1)])
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, FOLDER).collect()} == {1, 4}
