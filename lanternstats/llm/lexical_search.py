"""Ranked lexical search with posting lists in geometric blocks.

Documents become rows of the forward index: how often each term of the query set stands in them.  A task takes the
rows in shards of a bounded number of postings.  In a shard every posting list that a query visits is cut into
blocks of similar documents: documents are projected at random to a few dimensions, and each goes with the nearest
of evenly spaced members of the list.  A block keeps the coordinatewise maximum of its documents, so the sum of its
coordinates over a query's terms bounds the score of each of them.  A block is skipped only when that bound is below
the score of the worst document that the query would return by then, so results are exact.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanternstats.llm.common import ship, slices, stored, workspace

#: Best documents of an item.
TOP = 50
#: Postings of a shard, and documents of a block, at most (a document is never split).
SHARD = 2_000_000
BLOCK = 64
#: Blocks scored before the bar is raised, and cells of a temporary matrix.
STEP = 8
CELLS = 2_000_000
DIMENSIONS = 16
#: Terms of the queries that go over the documents together, about.
TERMS = 500_000
_SEED = 23
_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text):
    """Terms of a text, in order, as UTF-8 bytes; only A-Z are lower-cased."""
    return text.encode().translate(_TERM).split() if text else []


def forward_index(df, vocabulary, id_col, text_col):
    """(id, n, terms, tf): length of each document, and how often it holds which terms of ``vocabulary``."""

    def run(batches):
        place = vocabulary.get
        for batch in slices(batches):
            n, offsets, terms, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                n.append(len(words))
                found = np.array([k for w in words if (k := place(w)) is not None], np.int32)
                which, often = np.unique(found, return_counts=True)
                terms.append(which)
                counts.append(often.astype(np.int32))
                offsets.append(offsets[-1] + len(which))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(x), pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tf"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, n long, terms array<int>, tf array<int>")


def weights(forward, size):
    """Documents with a term, all their terms, and the weight of each of ``size`` terms."""
    n, length = forward.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(size, np.int64)
    for term, df in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weight[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return n, length, weight


def _ranges(starts, sizes):
    """All positions of the ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Shard:
    """Some documents with their posting lists, which are cut into blocks when first visited."""

    def __init__(self, ids, sizes, terms, impacts, columns):
        """``sizes`` postings of each document; ``columns``: for each term, the terms its visitors ask for."""
        self.ids, self.sizes, self.terms, self.impacts, self.columns = ids, sizes, terms, impacts, columns
        self.starts = np.cumsum(sizes) - sizes
        width = len(columns)
        order = np.argsort(terms, kind="stable")
        self.members = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.lists = np.searchsorted(terms[order], np.arange(width + 1))
        self.most = np.zeros(width, np.int64)
        here = np.flatnonzero(np.diff(self.lists))
        if len(here):
            self.most[here] = np.maximum.reduceat(impacts[order], self.lists[here])
        # Place among documents of one score: by id, null last.
        self.rank = np.empty(len(sizes), np.int64)
        self.rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(sizes))
        self.points = self._project(width)
        self.blocks = {}

    def _project(self, width):
        axes = np.random.default_rng(_SEED).standard_normal((width, DIMENSIONS), np.float32)
        points = np.zeros((len(self.sizes), DIMENSIONS), np.float32)
        ends = np.cumsum(self.sizes)
        lo = 0
        while lo < len(ends):
            first = ends[lo] - self.sizes[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, first + CELLS // DIMENSIONS, "right")))
            part = slice(first, ends[hi - 1])
            full = np.flatnonzero(self.sizes[lo:hi]) + lo
            if len(full):
                moved = axes[self.terms[part]] * self.impacts[part, None].astype(np.float32)
                points[full] = np.add.reduceat(moved, self.starts[full] - first, axis=0)
            lo = hi
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)

    def postings(self, docs):
        """(which of ``docs``, term, impact) of all postings of some documents."""
        sizes = self.sizes[docs]
        at = _ranges(self.starts[docs], sizes)
        return np.repeat(np.arange(len(docs)), sizes), self.terms[at], self.impacts[at]

    def blocks_of(self, term):
        """(documents in the order of blocks, starts of the blocks, summaries) of a posting list."""
        if term not in self.blocks:
            docs = self.members[self.lists[term] : self.lists[term + 1]]
            seeds = docs[:: max(1, len(docs) // math.ceil(len(docs) / BLOCK))]
            nearest = np.empty(len(docs), np.int64)
            step = max(1, CELLS // len(seeds))
            for lo in range(0, len(docs), step):
                nearest[lo : lo + step] = (self.points[docs[lo : lo + step]] @ self.points[seeds].T).argmax(1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            change = np.flatnonzero(np.append(True, nearest[1:] != nearest[:-1]))
            place = np.arange(len(docs)) - np.repeat(change, np.diff(np.append(change, len(docs))))
            starts = np.flatnonzero(place % BLOCK == 0)
            self.blocks[term] = docs, np.append(starts, len(docs)), self._summaries(docs, starts, self.columns[term])
        return self.blocks[term]

    def _summaries(self, docs, starts, asked):
        """The largest impact of each asked term in each block."""
        column = np.full(len(self.columns), -1)
        column[asked] = np.arange(len(asked))
        out = np.zeros((len(starts), len(asked)), np.int64)
        step = max(1, CELLS // (len(asked) * BLOCK))
        for lo in range(0, len(starts), step):
            hi = min(lo + step, len(starts))
            end = starts[hi] if hi < len(starts) else len(docs)
            some = docs[starts[lo] : end]
            row, term, impact = self.postings(some)
            at = column[term]
            full = np.zeros((len(some), len(asked)), np.int64)
            full[row[at >= 0], at[at >= 0]] = impact[at >= 0]
            out[lo:hi] = np.maximum.reduceat(full, starts[lo:hi] - starts[lo], axis=0)
        return out

    def search(self, query, top, bar):
        """(document, score) of the best documents of the sorted terms ``query``, with scores of ``bar`` at least."""
        wanted = np.zeros(len(self.columns), bool)
        wanted[query] = True
        query = query[self.most[query] > 0]
        query = query[np.argsort(-self.most[query], kind="stable")]
        rest = np.cumsum(self.most[query][::-1])[::-1]
        seen = np.zeros(len(self.sizes), bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for k, term in enumerate(query):
            # Documents not seen so far have this term and later ones only, or cannot reach the bar.
            if rest[k] < bar:
                break
            members, starts, summaries = self.blocks_of(term)
            bounds = summaries[:, np.searchsorted(self.columns[term], query[k:])].sum(1)
            order = np.argsort(-bounds, kind="stable")
            for lo in range(0, len(order), STEP):
                some = order[lo : lo + STEP]
                some = some[bounds[some] >= bar]
                if not len(some):
                    break
                found = members[_ranges(starts[some], starts[some + 1] - starts[some])]
                found = found[~seen[found]]
                seen[found] = True
                row, at, impact = self.postings(found)
                got = np.zeros(len(found), np.int64)
                np.add.at(got, row[wanted[at]], impact[wanted[at]])
                good = got >= bar
                docs, scores = np.append(docs, found[good]), np.append(scores, got[good])
                if len(docs) > top:
                    best = np.lexsort((self.rank[docs], -scores))[:top]
                    docs, scores = docs[best], scores[best]
                if len(docs) == top:
                    bar = max(bar, scores.min())
        return docs, scores


def best_of_shards(forward, queries, n, length, weight, top):
    """(q, id, score): the best documents of each query in each shard, with scores above 0.

    ``queries`` is a list of sorted arrays of terms.
    """

    def run(batches):
        asked = [set() for _ in weight]
        for query in queries:
            for term in query:
                asked[term].update(query)
        columns = [np.array(sorted(a), np.int64) for a in asked]
        # The scores that the queries have found so far; what is below all of them is not among the best.
        best = [np.zeros(0, np.int64) for _ in queries]

        def answers(parts):
            table = pa.Table.from_batches(parts).combine_chunks()
            sizes = pc.list_value_length(table.column("terms")).to_numpy().astype(np.int64)
            terms = pc.list_flatten(table.column("terms")).to_numpy().astype(np.int64)
            tf = pc.list_flatten(table.column("tf")).to_numpy().astype(np.int64)
            m = 50 + (50 * table.column("n").to_numpy() * n) // length
            impacts = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)))
            ids = table.column("id").combine_chunks()
            shard = Shard(ids, sizes, terms, impacts, columns)
            for q, query in enumerate(queries):
                docs, scores = shard.search(query, top, max(1, best[q].min() if len(best[q]) == top else 1))
                best[q] = np.sort(np.append(best[q], scores))[-top:]
                if len(docs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(docs), q), pa.int32()), ids.take(pa.array(docs)), pa.array(scores)], names=["q", "id", "score"]
                    )

        parts, held = [], 0
        for batch in slices(batches, 1_024):
            parts.append(batch)
            held += len(batch.column(2).flatten())
            if held >= SHARD:
                yield from answers(parts)
                parts, held = [], 0
        if parts:
            yield from answers(parts)

    kind = forward.schema["id"].dataType.simpleString()
    return forward.where(F.size("terms") > 0).mapInArrow(run, f"q int, id {kind}, score long")


def lexical_search(df, items, id_col="doc_id", text_col="text", item_id_col="item_id", item_text_col="text", top=TOP):
    """(item id, rank, id, score): the ``top`` best documents of each row of ``items`` with scores above 0.

    Equal scores are ranked by id, null last; rows with equal ids and scores rank in either order.  Null and empty
    texts have no terms: such documents count nowhere and are never found, such items find nothing.  Rows of ``items``
    with one id, or none, are answered one by one, each with ranks from 1.  Texts of any length are read whole.  Empty tables give
    no rows.  Extra columns are left out.

    The items are the stated query set: their terms go to all tasks, for about ``TERMS`` of them at a time.
    """
    spark = df.sparkSession
    folder = workspace(spark)
    # Rows are dealt to rounds by a key that stays the same when the table is read again.
    asked = items.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text")).withColumn("size", F.length("text"))
    rounds = 1 + (asked.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // 4) // TERMS
    found = None
    for k in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(rounds)) == k).select("item", "text").collect()
        vocabulary, queries = {}, []
        for row in rows:
            terms = {vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(row.text)}
            queries.append(np.array(sorted(terms), np.int64))
        forward = stored(forward_index(df, vocabulary, id_col, text_col), folder, f"forward-{k}")
        n, length, weight = weights(forward, len(vocabulary))
        if not length or not vocabulary:
            queries = []
        best = best_of_shards(forward, queries, n, max(length, 1), weight, top)
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(
            [(q, row.item) for q, row in enumerate(rows)], f"q int, item {items.schema[item_id_col].dataType.simpleString()}"
        )
        ranked = ranked.join(names, "q").select(
            F.col("item").alias(item_id_col), "rank", F.col("id").alias(id_col), "score"
        )
        found = ranked if found is None else found.unionByName(ranked)
    return found


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
p AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf, any_value(50 + (50 * len(terms) * s.n) // s.l)::BIGINT AS m
  FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d), s GROUP BY doc_id, term),
f AS (SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN p USING (term) GROUP BY item_id, doc_id HAVING score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 50
"""

ship(__name__)
