"""The n-gram join, ranked search and filter audit by their methods, and on odd rows."""

import collections
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lanternstats.llm import filter_audit, lexical_search, ngram_join
from lanternstats.llm.near_duplicates import Shingler

from . import helpers as plain
from .test_llm_edges import CLASH, LONG, ROWS, SCHEMA, TEXT, rows_of


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in CLASH])


@pytest.fixture(scope="module")
def small():
    """Smaller tables; any size gives the same links."""
    patch = pytest.MonkeyPatch()
    for name, bits in (("sketch", 12), ("ranks", 12), ("prefixes", 12), ("likely_members", 12), ("texts_of", 12)):
        function = getattr(ngram_join, name)
        patch.setattr(function, "__defaults__", (*function.__defaults__[:-1], bits))
    yield
    patch.undo()


# ------------------------------------------------------------ n-gram join


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randrange(999)) if rng.random() < share else w for w in words]


def corpus(rng):
    """Texts with copies of every degree, and passages that many of them share."""
    make = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passage = make(60)
    texts = []
    for _ in range(12):
        base = make(rng.randrange(20, 150))
        texts += [base] + [edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05])) for _ in range(rng.randrange(12))]
    texts += [passage + make(rng.choice([2, 8, 15, 20, 60])) for _ in range(40)]
    texts += [make(k % 6) for k in range(12)] + [["one", "two"], ["ONE", "two"], []]
    rng.shuffle(texts)
    return {k: " ".join(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("lead, block", [(32, 256), (2, 4)])
def test_join_equals_brute_force(spark, small, monkeypatch, lead, block):
    monkeypatch.setattr(ngram_join, "LEAD", lead)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = corpus(random.Random(lead))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(frame).collect()}
    component, sets = plain.near_duplicates(texts, 5, 80)
    assert got == {i: (len(sets[i]), component[i]) for i in texts}


def test_filters_keep_similar_pairs():
    rng = random.Random(1)
    shingles = Shingler(3)
    for share in (0.0, 0.01, 0.03, 0.06):
        base = [f"w{rng.randrange(500)}" for _ in range(200)]
        texts = [" ".join(edited(rng, base, share)) for _ in range(30)]
        full = [shingles(t) for t in texts]
        sets = ngram_join.Sets([ngram_join.fingerprints(s) for s in full], (80, 100))
        for k in range(30):
            others = np.array([j for j in range(30) if j != k])
            similar = {j for j in others if 100 * len(np.intersect1d(full[k], full[j])) >= 80 * len(np.union1d(full[k], full[j]))}
            found = set(sets.candidates(k, others))
            # Fingerprints that are equal by chance let few others pass.
            assert similar <= found and len(found - similar) <= 1


def test_each_order_has_a_say():
    """Two sets that share little are told apart by prefixes alone."""
    one, two = np.arange(0, 200, dtype=np.uint64) * np.uint64(7919), np.arange(199, 399, dtype=np.uint64) * np.uint64(7919)
    sets = ngram_join.Sets([ngram_join.fingerprints(one), ngram_join.fingerprints(two)], (80, 100))
    orders = [sets.shared(0, k, np.array([1]))[0] for k in range(1, 1 + len(ngram_join.ORDERS))]
    assert sets.shared(0, 0, np.array([1]))[0] == 1 and min(orders) == 0


def test_equal_fingerprints_lose_nothing():
    """Members with one fingerprint count as shared in doubt."""
    one = np.arange(100, dtype=np.uint64) * np.uint64(99991)
    twins = np.concatenate([one, one[:30] + np.uint64(1 << 24)])
    sets = ngram_join.Sets([ngram_join.fingerprints(twins), ngram_join.fingerprints(twins[:118])], (80, 100))
    assert list(sets.lost) == [30, 18] and list(sets.candidates(0, np.array([1]))) == [1]


def test_shared_passage_makes_few_cells(spark, small):
    """Documents that share a passage, but are not linked, do not meet in pairs."""
    rows = []
    for n in (300, 600):
        rng = random.Random(n)
        passage = " ".join(f"p{k}" for k in range(60))
        texts = [(i, passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(120))) for i in range(n)]
        frame = spark.createDataFrame(texts, "doc_id long, text string")
        known = ngram_join.sketch(frame, "doc_id", "text", 5)
        total = known.agg(F.sum("n")).first()[0]
        rank = ngram_join.ranks(known.where("piece IS NOT NULL").select("piece", "counts"), total)
        prefixed = ngram_join.prefixes(frame, "doc_id", "text", 5, (80, 100), rank)
        members = prefixed.select(F.explode("prefix").alias("token"), F.col("id").alias("node"), F.lit(176).cast("long").alias("n"))
        rows.append(ngram_join.useful_members(members, (80, 100)).count())
    assert rows[1] <= 2.5 * rows[0] + 10


def test_join_of_odd_rows(docs, spark, small):
    got = ngram_join.ngram_join(docs)
    assert got.count() == len(ROWS)
    assert rows_of(got.where("doc_id IN (1, 6)"), "doc_id", "component_id") == [(1, 1), (1, 1), (6, 1)]
    assert rows_of(got.where("doc_id IN (2, 3, 4)"), "doc_id", "n_shingles", "component_id") == [(i, 0, i) for i in (2, 3, 4)]
    assert rows_of(got.where("doc_id IS NULL"), "component_id") == [(None,)] * 2
    assert got.where("doc_id = 5").first().n_shingles == len(plain.shingles(LONG, 5))
    assert ngram_join.ngram_join(docs.where("false")).count() == 0
    # Two texts under one id are rows of their own.
    twice = spark.createDataFrame([("b", TEXT), ("b", "other words stand here now"), ("a", TEXT), ("c", "other words stand here now")], "doc_id string, text string")
    assert rows_of(ngram_join.ngram_join(twice), "doc_id", "component_id") == [("a", "a"), ("b", "a"), ("b", "b"), ("c", "b")]


# ------------------------------------------------------------ ranked search


def ranked(texts, items, top=50):
    """(item's place, rank, id, score) by scoring every document."""
    terms = {i: lexical_search.terms_of(t) for i, t in texts}
    n, length = sum(bool(t) for t in terms.values()), sum(map(len, terms.values()))
    df = collections.Counter(w for t in terms.values() for w in set(t))
    out = []
    for q, text in enumerate(items):
        scores = []
        for i, t in terms.items():
            tf, m = collections.Counter(t), 50 + (50 * len(t) * n) // max(length, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 20 * m))
                for w in set(lexical_search.terms_of(text)) & set(tf)
            )
            if score > 0:
                scores.append((-score, i))
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return out


@pytest.mark.parametrize("top", [3, 50])
def test_search_equals_scoring_everything(spark, monkeypatch, top):
    monkeypatch.setattr(lexical_search, "BLOCK", 5)
    monkeypatch.setattr(lexical_search, "SHARD", 700)
    rng = random.Random(top)
    word = lambda: f"t{min(rng.randrange(60), rng.randrange(60))}"
    texts = [(i, " ".join(word() for _ in range(rng.randrange(30)))) for i in range(300)]
    texts += [(300 + i, texts[i % 4][1]) for i in range(100)]
    items = [" ".join(word() for _ in range(rng.randrange(1, 9))) for _ in range(25)] + ["", "unseen", "T1 t1"]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    queries = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = lexical_search.lexical_search(frame, queries, top=top)
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()) == sorted(ranked(texts, items, top))


def test_blocks_are_skipped_by_exact_bounds(monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 8)
    monkeypatch.setattr(lexical_search, "STEP", 1)
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 12, 2_000)
    terms = np.concatenate([np.sort(rng.choice(40, s, replace=False)) for s in sizes]).astype(np.int64)
    impacts = rng.integers(1, 1_000, len(terms)) ** 2
    columns = [np.arange(40)] * 40
    shard = lexical_search.Shard(pa.array(np.arange(2_000)), sizes, terms, impacts, columns)
    docs, starts, summaries = shard.blocks_of(7)
    assert sorted(docs) == sorted(shard.members[shard.lists[7] : shard.lists[8]])
    for lo, hi, most in zip(starts, starts[1:], summaries):
        row, term, impact = shard.postings(docs[lo:hi])
        assert [impact[term == t].max(initial=0) for t in range(40)] == list(most)
    matrix = np.zeros((2_000, 40), np.int64)
    matrix[np.repeat(np.arange(2_000), sizes), terms] = impacts
    scored = []
    shard.postings = lambda found, plain_postings=shard.postings: (scored.append(len(found)), plain_postings(found))[1]
    for query in ([3, 7, 20], [1], list(range(0, 40, 3))):
        shard.blocks_of(query[0])
        found, scores = shard.search(np.array(query), 10, 1)
        want = np.sort(matrix[:, query].sum(1))[::-1][:10]
        assert sorted(scores, reverse=True) == list(want)
    # Of the lists of one term only the best blocks are scored.
    scored.clear()
    shard.search(np.array([1]), 10, 1)
    assert sum(scored) < (matrix[:, 1] > 0).sum() / 2


def test_search_of_odd_rows(docs, spark):
    items = [(1, "plain text"), (None, "words of a row"), (2, None), (3, ""), (1, "plain text"), (4, "Wörd7 wörd8"), (5, "absent")]
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS q", "2 AS item", "3 AS rank")
    got = rows_of(lexical_search.lexical_search(docs, queries), "item_id", "rank", "doc_id")
    # Equal texts tie and are ranked by id, without an id last; both rows of an item are answered.
    assert got.count((1, 1, 1)) == 2 and got.count((1, 3, 6)) == 2 and got.count((1, 4, None)) == 2
    assert (None, 1, None) in got and (4, 1, 5) in got and {g[0] for g in got} == {1, None, 4}
    assert lexical_search.lexical_search(docs.where("false"), queries).count() == 0
    assert lexical_search.lexical_search(docs, queries.where("false")).count() == 0
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    assert rows_of(lexical_search.lexical_search(named, queries).where("item_id = 4"), "doc_id") == [("5",)]


def test_rounds_of_items(docs, spark, monkeypatch):
    queries = spark.createDataFrame([(k, f"plain text wörd{k}") for k in range(9)], "item_id long, text string")
    whole = rows_of(lexical_search.lexical_search(docs, queries), "item_id", "rank", "doc_id", "score")
    monkeypatch.setattr(lexical_search, "TERMS", 12)
    assert rows_of(lexical_search.lexical_search(docs, queries), "item_id", "rank", "doc_id", "score") == whole


# ------------------------------------------------------------ filter audit


def audited(rows, labels):
    """{(part, order, step): counts} by applying the filters in every order to every row."""
    out = collections.defaultdict(collections.Counter)
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    texts = collections.defaultdict(list)
    for i, text, _, _ in rows:
        texts[text or ""].append(i)
    for i, text, part, _ in rows:
        text, part = text or "", part or ""
        words = plain.WORD.findall(text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j is not None and j < i for j in texts[text]),
        }
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                counts, here = out[part, order, step], fails[letter] and not gone
                counts["removed"] += here
                counts["redundant"] += fails[letter] and gone
                counts["unique_fails"] += fails[letter] and sum(fails.values()) == 1
                counts["good_lost"] += here and i in good
                counts["toxic_lost"] += here and i in toxic
                gone = gone or fails[letter]
                counts["kept"] += not gone
                out[part, letter]["shapley"] += here
    return out


def test_audit_equals_every_order(spark):
    rng = random.Random(6)
    texts = ["", None, "A B c", "one two " * 30, "x$ " * 5, " ".join(f"W{k}" for k in range(70)), " ".join(f"w{k}" for k in range(70)), " ".join(f"w{k}" for k in range(70)) + " #"]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "s", "t"]), 1) for _ in range(120)] + [(41, LONG, "s", 1), (41, LONG, "s", 1)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(30)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").selectExpr("*", *[f"'x' AS {c}" for c in ("id", "part", "mask", "k", "digest", "first", "least")])
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audited(rows, labels)
    got = filter_audit.filter_audit(docs, frame).collect()
    assert len(got) == 600 * 3
    for r in got:
        counts = want[r.part, r.filter_order, r.step]
        assert [r[c] for c in filter_audit.COUNTS[:-1]] == [counts[c] for c in filter_audit.COUNTS[:-1]]
        assert r.shapley == want[r.part, r.filter_order[r.step - 1]]["shapley"]
    assert filter_audit.filter_audit(docs.where("false"), frame).count() == 0
    assert filter_audit.filter_audit(docs, frame.where("false")).where("good_lost + toxic_lost > 0").isEmpty()
