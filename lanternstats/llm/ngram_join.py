"""Jaccard join of documents on word n-grams, by prefixes under several global orders of the n-grams.

Two sets can only be similar enough if, whatever the order of all n-grams, the first few of one (its prefix) and
the first few of the other share a member.  The first order puts rare n-grams first: documents that share an n-gram
of their prefixes meet in its bucket.  There they are asked for a common member of their prefixes under two further
orders, and only pairs that pass all of them are verified.

How rare an n-gram is comes from a table of a fixed number of cells which counts the n-grams of all documents; any
order is right, and one by cells needs no count for each n-gram.  Documents with equal sets are one class.

Sizes say how many members of their prefixes two similar sets share at least, so a class stays only in as many of
its first buckets as a partner needs to be met.  Buckets with the same members are one bucket.  In large buckets
every class first asks the class that leads most of its buckets; what is still apart in a bucket then meets in blocks inside
tasks, on fingerprints of the sets, and only as many pairs come out as join what belongs together.  Those are
verified on the full sets; if one of them fails, the blocks are asked again without it.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanternstats.llm.bitmaps import PIECES, ROW_BITS, bitmap, cell_of, contains, merged_pieces, pack, table_of
from lanternstats.llm.common import ship, slices, stored, workspace
from lanternstats.llm.near_duplicates import Shingler, components

WORDS = 5
SIMILARITY = (80, 100)
#: Cells of the table of counts, and of the bitmaps that keep most n-grams and rows without partners out of
#: shuffles, as powers of two.  They are sent to all tasks in packed pieces; their size does not depend on the data.
COUNT_BITS = 26
TOKEN_BITS = 26
#: Documents of a bucket that meet as many others in a task at a time.
BLOCK = 256
#: In buckets of more members than this, all of them ask the leader before they ask each other.
LEAD = 32
#: Bits of a fingerprint, and the factors that shuffle fingerprints into the further orders.
FINGERPRINT = 24
ORDERS = (0x9E3779B1, 0x85EBCA6B)
#: n-grams counted at a time.
BATCH = 1_000_000


def prefix_length(n, similarity):
    """Members of a set of ``n`` of which one at least is in each similar set's prefix."""
    t, of = similarity
    return n - (-(-t * n // of)) + 1


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _prints(shingles):
    """(fp1, fp2) of a set."""
    raw = shingles.tobytes()
    return _signed(xxhash.xxh64_intdigest(raw)), _signed(xxhash.xxh64_intdigest(raw, 1))


def sketch(df, id_col, text_col, words, bits=COUNT_BITS):
    """(id, n, fp1, fp2) of each row; and at the end of each task (piece, counts): the cells of its n-grams."""

    def run(batches):
        shingles, cells, waiting, held = Shingler(words), np.zeros(1 << bits, np.uint8), [], 0

        def count():
            at, often = np.unique(cell_of(np.concatenate(waiting), bits), return_counts=True)
            # A cell that a single task fills is frequent enough.
            cells[at] = np.minimum(cells[at] + often, 255).astype(np.uint8)

        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                found = shingles(text)
                rows.append((len(found), *_prints(found)) if len(found) else (0, None, None))
                if len(found):
                    waiting.append(found)
                    held += len(found)
                if held >= BATCH:
                    count()
                    waiting, held = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows)), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())],
                names=["id", "n", "fp1", "fp2", "piece", "counts"],
            )
        if held:
            count()
        if cells.any():
            for k, part in enumerate(np.split(cells, PIECES)):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, batch.column(0).type), *(pa.nulls(1, pa.int64()) for _ in range(3)), pa.array([k], pa.int32()), pa.array([pack(part)])],
                    names=["id", "n", "fp1", "fp2", "piece", "counts"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, n long, fp1 long, fp2 long, piece int, counts binary")


def ranks(pieces, total, bits=COUNT_BITS):
    """How frequent the n-grams of each cell are against the mean of ``total`` n-grams: two levels, 0 to 15, a byte."""
    mean = total / (1 << bits)

    def finish(total, part):
        if part is None:
            level = np.clip(8 + np.floor(4 * np.log2((total + 1.0) / (mean + 1))), 0, 15).astype(np.uint8)
            return level[::2] << 4 | level[1::2]
        return part.astype(np.uint64) if total is None else total + part

    return merged_pieces(pieces, finish)


def _rank(cells, hashes, bits):
    at = cell_of(hashes, bits)
    return np.where(at & 1 == 0, cells[at >> 1] >> 4, cells[at >> 1] & 15)


def prefixes(df, id_col, text_col, words, similarity, rank, bits=COUNT_BITS):
    """(id, fp1, fp2, prefix) of all rows with an n-gram: the first members under the order by rarity."""

    def run(batches):
        shingles, cells = Shingler(words), table_of(rank, (1 << bits) // 2)
        for batch in slices(batches):
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = shingles(text)
                if len(found):
                    order = np.lexsort((found * np.uint64(0x9E3779B97F4A7C15), _rank(cells, found, bits)))
                    first = found[order[: prefix_length(len(found), similarity)]]
                    at.append(i)
                    rows.append((*_prints(found), first.view(np.int64)))
            fp1, fp2, first = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(first, pa.list_(pa.int64()))],
                names=["id", "fp1", "fp2", "prefix"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, fp1 long, fp2 long, prefix array<long>")


def likely_members(prefixed, tokens, bits=TOKEN_BITS):
    """(id, fp1, fp2, token) of the prefixes, of n-grams that may be among ``tokens``."""
    packed = bitmap(tokens, bits)

    def run(batches):
        cells = table_of(packed, (1 << bits) // 8)
        for batch in slices(batches, 4_096):
            column = batch.column(3)
            tokens = column.flatten().to_numpy()
            stay = np.flatnonzero(contains(cells, tokens.view(np.uint64), bits))
            row = pa.array(np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))[stay])
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(row) for k in range(3)), pa.array(tokens[stay])], names=["id", "fp1", "fp2", "token"])

    kind = prefixed.schema["id"].dataType.simpleString()
    return prefixed.select("id", "fp1", "fp2", "prefix").mapInArrow(run, f"id {kind}, fp1 long, fp2 long, token long")


def useful_members(members, similarity):
    """(token, node): the members (token, node, n) of buckets that a partner can make it necessary to keep.

    Sets of sizes x and y that reach the threshold share at least a = t (x + y) / (1 + t) members, so their prefixes
    share at least r = a + 1 - max(t x, t y), each rounded up.  With r shared n-grams of the u that a class shares with any
    other, the first one that it shares with the partner is among its first u - r + 1.
    """
    t, of = similarity
    up = lambda x, d: F.floor((x + (d - 1)) / d).cast("long")
    stats = members.groupBy("token").agg(F.count("*").alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi")).where("k > 1")
    rows = members.join(stats, "token")
    # In a bucket of two the partner's size is known.
    other = F.col("lo") + F.col("hi") - F.col("n")
    lo, hi = (F.when(F.col("k") == 2, other).otherwise(F.col(c)) for c in ("lo", "hi"))
    rows = rows.withColumn("lo", F.greatest(lo, up(F.col("n") * t, of))).withColumn("hi", F.least(hi, F.floor(F.col("n") * of / t)))
    least = lambda y: up((F.col("n") + y) * t, of + t) + 1 - F.greatest(up(F.col("n") * t, of), up(y * t, of))
    rows = rows.withColumn("r", F.least(least(F.col("lo")), least(F.col("hi"))))
    own = Window.partitionBy("node")
    rows = rows.withColumn("u", F.count("*").over(own)).withColumn("at", F.row_number().over(own.orderBy("token")))
    return rows.where("lo <= hi AND at <= u - r + 1").select("token", "node")


def texts_of(df, id_col, text_col, owners, words, result, bits=ROW_BITS):
    """(node, ``result``) of the classes in ``owners`` (id, fp1, fp2, node), read from one row of each class.

    ``result`` is "text", or "prints" for the fingerprints of its set.
    """
    packed = bitmap(owners.select(F.xxhash64("id")), bits)

    def run(batches):
        shingles, cells = Shingler(words), table_of(packed, (1 << bits) // 8)
        for batch in slices(batches):
            some = batch.take(pa.array(np.flatnonzero(contains(cells, batch.column(2).to_numpy().view(np.uint64), bits))))
            texts = some.column(1).to_pylist()
            sets = [shingles(t) for t in texts]
            prints = [_prints(s) for s in sets]
            last = pa.array(texts, pa.string()) if result == "text" else pa.array([fingerprints(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [some.column(0), *(pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)), last], names=["id", "fp1", "fp2", result]
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text_col, F.xxhash64(F.col(id_col)))
    rows = rows.mapInArrow(run, f"id {kind}, fp1 long, fp2 long, {result} {'string' if result == 'text' else 'binary'}")
    # A row that stands twice in the table comes twice; the copies are in one partition after the join.
    return rows.join(owners, ["id", "fp1", "fp2"]).dropDuplicates(["id", "fp1", "fp2"]).select("node", result)


class Sets:
    """Sets by fingerprints, with their prefixes under the further orders.

    Fingerprints of different members may be equal, so what two sets share of them, plus what one of them lost to
    equal fingerprints, is at least what they share.  The prefix keeps its length: with fewer fingerprints the
    number that must be shared is less by as many.
    """

    marks = None

    def __init__(self, raw, similarity):
        self.similarity = similarity
        self.sizes = np.array([len(s) // 3 for s in raw], np.int64)
        flat = np.zeros((int(self.sizes.sum()), 4), np.uint8)
        flat[:, :3] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 3)
        whole = np.split(flat.view(np.uint32)[:, 0], np.cumsum(self.sizes)[:-1]) if len(raw) else []
        self.whole = [np.unique(s) for s in whole]
        self.lost = self.sizes - np.array([len(s) for s in self.whole], np.int64)
        self.parts = [self._flat(self.whole), *(self._flat([self._prefix(s, n, f) for s, n in zip(self.whole, self.sizes)]) for f in ORDERS)]
        if Sets.marks is None:
            Sets.marks = np.zeros(1 << FINGERPRINT, bool)

    def _prefix(self, prints, n, factor):
        size = min(prefix_length(int(n), self.similarity), len(prints))
        order = (prints.astype(np.uint64) * np.uint64(factor)).astype(np.uint32) & np.uint32((1 << FINGERPRINT) - 1)
        return prints[np.argpartition(order, size - 1)[:size]]

    @staticmethod
    def _flat(arrays):
        sizes = np.array([len(a) for a in arrays], np.int64)
        return np.concatenate(arrays), np.cumsum(sizes) - sizes, sizes

    def shared(self, k, part, others):
        """How many members of set ``k`` are in each of ``others``; ``part`` 0 for whole sets, else an order."""
        flat, starts, sizes = self.parts[part]
        marks = Sets.marks
        own = flat[starts[k] : starts[k] + sizes[k]]
        marks[own] = True
        ends = np.cumsum(sizes[others])
        at = np.arange(ends[-1]) + np.repeat(starts[others] - ends + sizes[others], sizes[others])
        found = np.add.reduceat(marks[flat[at]].astype(np.int64), ends - sizes[others])
        marks[own] = False
        return found

    def candidates(self, k, others):
        """Those of ``others`` that may be similar enough to set ``k``, by size, each order and all fingerprints."""
        t, of = self.similarity
        n = self.sizes
        others = others[np.minimum(n[others], n[k]) * of >= np.maximum(n[others], n[k]) * t]
        for order in range(1, len(self.parts)):
            if len(others):
                others = others[self.shared(k, order, others) > 0]
        if not len(others):
            return others
        most = self.shared(k, 0, others) + np.minimum(self.lost[others], self.lost[k])
        stay = of * most >= t * (n[others] + n[k] - most)
        return others[stay][np.argsort(-most[stay], kind="stable")]


def fingerprints(shingles):
    """The members of a set in three bytes each."""
    return shingles.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def verified(pairs, texts, words, similarity):
    """Pairs (a, b) with whether their full sets are similar enough."""
    t, of = similarity

    def run(batches):
        shingles = Shingler(words)
        for batch in slices(batches, 128):
            good = []
            for x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3))):
                x, y = shingles(x), shingles(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(of * both >= t * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], names=["a", "b", "linked"])

    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def _labelled(members, labels):
    return members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def leader_pairs(buckets, prints, similarity):
    """Pairs (a, b) of a class and the leader of most of its buckets that may be linked; ``buckets``: (node, leader)."""
    led = buckets.groupBy("node", "leader").agg(F.count("*").alias("weight"))
    best = led.groupBy("node").agg(F.max_by("leader", F.struct("weight", "leader")).alias("token"))
    best = best.withColumn("component", F.col("node"))
    blocks = best.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    asks = best.join(blocks, "token").select(
        "token", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("i"), "node", "component", F.lit(True).alias("asks")
    )
    asked = blocks.select(
        "token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), F.col("token").alias("node"), F.col("token").alias("component"), F.lit(False).alias("asks")
    )
    cells = asks.unionByName(asked).withColumn("j", F.lit(0).cast("long")).withColumn("tokens", F.array("token")).withColumn("vain", F.array().cast("array<long>"))
    return cell_pairs(cells.join(prints, "node"), similarity)


def bucket_pairs(members, labels, prints, failed, similarity):
    """Pairs (a, b) of different components in a bucket that may be linked; if all are, no others need be looked at.

    In a bucket the largest component needs no comparison within.  The other members ask, in blocks, the blocks of
    all members; a pair of blocks meets in one task.  A pair that shares several buckets is compared in the first of
    them only.  ``failed`` has pairs, in both directions, that were verified in vain.
    """
    bucket = _labelled(members, labels)
    share = bucket.groupBy("token", "component").agg(F.count("*").alias("k"))
    active = share.groupBy("token").agg(
        F.max_by("component", F.struct("k", "component")).alias("main"), F.max("k").alias("k_main"), F.sum("k").alias("k_all"), F.count("*").alias("parts")
    )
    active = active.where("parts > 1").select(
        "token", "main", F.ceil(F.col("k_all") / BLOCK).alias("blocks"), F.ceil((F.col("k_all") - F.col("k_main")) / BLOCK).alias("asking")
    )
    bucket = bucket.join(active, "token")
    own = bucket.groupBy("node").agg(F.collect_list("token").alias("tokens"))
    vain = failed.groupBy("a").agg(F.collect_set("b").alias("vain")).withColumnRenamed("a", "node")
    own = own.join(vain, "node", "left").join(prints, "node")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = bucket.select("token", "node", "component", F.lit(False).alias("asks"), deal("blocks").alias("j"), every("asking").alias("i"))
    asks = bucket.where("component <> main").select(
        "token", "node", "component", F.lit(True).alias("asks"), every("blocks").alias("j"), deal("asking").alias("i")
    )
    return cell_pairs(asked.unionByName(asks).join(own, "node"), similarity)


def cell_pairs(cells, similarity):
    """Pairs (a, b) in the cells (token, i, j), of a member that asks and one that does not, which may be linked.

    Only as many come out as join the members' components, should all of them be linked.
    """

    def pairs_of(table):
        """Pairs in the cells of ``table``, whose rows are ordered by cell."""
        token, i, j, node, part, ask = (table.column(k).to_numpy() for k in range(6))
        tokens, vain = (table.column(k).to_pylist() for k in (6, 7))
        raw = table.column(8).to_pylist()
        starts = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        found = []
        for lo, hi in zip(starts, [*starts[1:], len(node)]):
            sets = Sets(raw[lo:hi], similarity)
            others = np.flatnonzero(~ask[lo:hi])
            group = {}

            def find(x):
                while group.get(x, x) != x:
                    x = group[x]
                return x

            for k in np.flatnonzero(ask[lo:hi]):
                apart = others[part[lo + others] != part[lo + k]]
                mine, lost = set(tokens[lo + k]), set(vain[lo + k] or ())
                for c in sets.candidates(k, apart):
                    left, right = find(part[lo + k]), find(part[lo + c])
                    if left != right and node[lo + c] not in lost and min(mine.intersection(tokens[lo + c])) == token[lo]:
                        group[left] = right
                        found.append((node[lo + k], node[lo + c]))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches):
        rest = None
        for batch in slices(batches, 2_048):
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            cell = np.stack([table.column(c).to_numpy() for c in range(3)], 1)
            other = np.flatnonzero((cell != cell[-1]).any(1))
            cut = int(other[-1]) + 1 if len(other) else 0
            rest = table.slice(cut)
            if cut:
                yield pairs_of(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield pairs_of(rest)

    cells = cells.select("token", "i", "j", "node", "component", "asks", "tokens", "vain", "prints")
    return cells.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(run, "a long, b long")


def ngram_join(df, id_col="doc_id", text_col="text", words=WORDS, similarity=SIMILARITY):
    """Per row of ``df``: the size of its set and the smallest id that it reaches by links, its own included.

    A text of fewer words than an n-gram is one n-gram; null and empty texts have none, are linked with nothing and
    are their own component.  Ids are of any type that has an order.  Rows that repeat an id are rows of their own,
    each in the component of its text.  Rows without an id are not linked and have no component, but a size.  Pairs that reach
    the fraction ``similarity`` are linked.  Texts of any length are compared whole.  An empty table gives no rows.  Extra
    columns are left out.
    """
    folder = workspace(df.sparkSession)
    known = stored(sketch(df, id_col, text_col, words), folder, "sketches")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rank = ranks(known.where("piece IS NOT NULL").select("piece", "counts"), total)
    sketches = known.where("piece IS NULL").select("id", "n", "fp1", "fp2")
    some = sketches.where("n > 0 AND id IS NOT NULL")
    owners = some.groupBy("fp1", "fp2").agg(F.min("id").alias("id"), F.min("n").alias("n")).withColumn("node", F.monotonically_increasing_id())
    owners = stored(owners, folder, "owners")

    prefixed = prefixes(df.where(F.col(id_col).isNotNull()), id_col, text_col, words, similarity, rank)
    prefixed = stored(prefixed, folder, "prefixes")
    tokens = prefixed.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token")
    tokens = stored(tokens, folder, "tokens")
    # Copies do not count, so a bucket may turn out to have one member.
    members = likely_members(prefixed, tokens).join(owners, ["id", "fp1", "fp2"]).join(tokens, "token")
    members = stored(members.select("token", "node", "n").distinct(), folder, "all-members")
    members = stored(useful_members(members, similarity), folder, "useful-members")
    # Of buckets with the same members one is enough.
    same = members.groupBy("token").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.min("node").alias("leader")
    )
    same = same.where("k > 1").groupBy("k", "x", "y").agg(F.min("token").alias("token"), F.min("leader").alias("leader"))
    buckets = stored(members.join(same.select("token", "k", "leader"), "token"), folder, "buckets")
    members = buckets.select("token", "node")

    # Classes with fingerprints of their sets; and, from their owners' rows again, the texts of those to be verified.
    of = lambda nodes: owners.drop("n").join(nodes.distinct(), "node", "left_semi")
    prints = stored(texts_of(df, id_col, text_col, of(members.select("node")), words, "prints"), folder, "prints")
    asked = stored(leader_pairs(buckets.where(f"k > {LEAD} AND node <> leader").select("node", "leader"), prints, similarity), folder, "asked-0")
    labels, links, failed, k = components(asked, f"{folder}/components-0"), asked.limit(0), asked.limit(0), 0
    while True:
        k += 1
        both = failed.unionByName(failed.select(F.col("b").alias("a"), F.col("a").alias("b")))
        asked = stored(asked.unionByName(bucket_pairs(members, labels, prints, both, similarity)), folder, f"asked-{k}")
        nodes = asked.select(F.explode(F.array("a", "b")).alias("node"))
        texts = stored(texts_of(df, id_col, text_col, of(nodes), words, "text"), folder, f"texts-{k}")
        tried = stored(verified(asked, texts, words, similarity), folder, f"tried-{k}")
        links = links.unionByName(tried.where("linked").select("a", "b"))
        labels = components(links, f"{folder}/components-{k}")
        if tried.where("NOT linked").isEmpty():
            break
        failed, asked = failed.unionByName(tried.where("NOT linked").select("a", "b")), asked.limit(0)

    owned = _labelled(owners, labels)
    least = owned.groupBy("component").agg(F.min("id").alias("component_id"))
    by_set = owned.join(least, "component").select("fp1", "fp2", "component_id")
    result = sketches.join(by_set, ["fp1", "fp2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


ship(__name__)
