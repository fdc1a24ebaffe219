"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets form a class, and only one of each class goes on.  Classes that share a band
of their signatures are candidates.  A candidate pair's signatures are compared batch by batch; after each
batch the posterior of its similarity, under a uniform prior, is asked whether the threshold is still likely
enough, and the pair is dropped once it is not.  Survivors are checked on their full shingle sets.

No bucket is turned into all of its pairs.  First every class meets the smallest class of each of its buckets,
and is checked with the most similar of these; what is linked then needs no further comparison.  After that
only pairs from different components are left in a bucket, and they are compared in blocks, inside tasks, of
which only links come out.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lanternstats.llm.bitmaps import ROW_BITS, bitmap, contains, table_of
from lanternstats.llm.common import ship, slices, stored, workspace

WORDS = 5
SIMILARITY = (80, 100)
#: Hashes in a band; there are as many bands as it takes to miss a pair at the threshold this rarely.
ROWS = 5
MISS = 1e-7
#: A pair is pruned when the probability that it reaches the threshold falls below this.
PRUNE = 1e-6
#: Hashes compared at a time.
STEP = 20
#: Classes of a bucket compared with as many others in a task at a time.
BLOCK = 1024
#: Remembered words of a task; beyond that it starts anew.
CACHE = 400_000
_SEED = 11


def band_count(similarity, rows=ROWS, miss=MISS):
    t = similarity[0] / similarity[1]
    return 1 if t >= 1 else math.ceil(math.log(miss) / math.log(1 - t**rows))


def least_matches(similarity, hashes, prune=PRUNE):
    """For each number of hashes compared, the fewest matches with which a pair goes on.

    After m matches of n the posterior is Beta(m + 1, n - m + 1), whose mass above t is that of a binomial
    variable of n + 1 trials at t being at most m.
    """
    t, out = min(similarity[0] / similarity[1], 1 - 1e-12), []
    for n in range(1, hashes + 1):
        mass, m = 0.0, 0
        while m <= n:
            log = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(t) + (n + 1 - m) * math.log1p(-t)
            mass += math.exp(log)
            if mass >= prune:
                break
            m += 1
        out.append(m)
    return np.array(out)


class Shingler:
    """Shingle sets of texts as sorted 64-bit hashes."""

    def __init__(self, words):
        self.words, self.seen = words, {}
        self.odd = np.random.default_rng(_SEED).integers(1, 1 << 63, words + 1, dtype=np.uint64) | np.uint64(1)

    def __call__(self, text):
        tokens = text.encode().lower().split() if text else []
        if not tokens:
            return np.zeros(0, np.uint64)
        if len(self.seen) > CACHE:
            self.seen.clear()
        seen = self.seen
        for w in set(tokens).difference(seen):
            seen[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(seen.__getitem__, tokens), np.uint64, len(tokens))
        k = min(self.words, len(tokens))
        # The number of words goes in, so that a short text is not part of a longer one.
        mixed = np.full(len(tokens) - k + 1, k, np.uint64) * self.odd[-1]
        for i in range(k):
            mixed = (mixed ^ h[i : len(tokens) - k + 1 + i]) * self.odd[i]
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed * self.odd[-1])


def signature(shingles, factors, offsets):
    """The smallest value of each hash function over a set."""
    least = np.full(len(factors), 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 2_048):
        part = (shingles[None, i : i + 2_048] * factors[:, None] + offsets[:, None]) >> np.uint64(32)
        np.minimum(least, part.min(1), out=least)
    return least.astype(np.uint32)


def sketch(df, id_col, text_col, words, hashes):
    """(id, n, fp1, fp2, sig): size of the shingle set, its fingerprint and signature; null for empty sets."""

    def run(batches):
        shingles = Shingler(words)
        random = np.random.default_rng(_SEED + 1)
        factors = random.integers(1, 1 << 63, hashes, dtype=np.uint64) | np.uint64(1)
        offsets = random.integers(0, 1 << 63, hashes, dtype=np.uint64)
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                found = shingles(text)
                if len(found):
                    raw = found.tobytes()
                    rows.append(
                        (len(found), _signed(xxhash.xxh64_intdigest(raw)), _signed(xxhash.xxh64_intdigest(raw, 1)),
                         signature(found, factors, offsets).tobytes())
                    )
                else:
                    rows.append((0, None, None, None))
            columns = zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in columns)], names=["id", "n", "fp1", "fp2", "sig"]
            )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {id_type}, n long, fp1 long, fp2 long, sig binary")


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _matrix(column, hashes):
    """Signatures of an Arrow column of fixed size as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, hashes)


def surviving(left, right, first, second, needed):
    """Pairs of rows ``first`` of ``left`` and ``second`` of ``right`` that are never pruned; and their matches."""
    matches = np.zeros(len(first), np.int32)
    for at in range(0, left.shape[1], STEP):
        to = min(at + STEP, left.shape[1])
        matches = matches + (left[first, at:to] == right[second, at:to]).sum(1)
        stay = matches >= needed[to - 1]
        first, second, matches = first[stay], second[stay], matches[stay]
        if not len(first):
            break
    return first, second, matches


def verify_signatures(pairs, classes, similarity, hashes):
    """Pairs (a, b) that pass the sequential test, with their number of matches."""
    needed = least_matches(similarity, hashes)

    def run(batches):
        for batch in slices(batches, 2_048):
            a, b = (_matrix(batch.column(k), hashes) for k in (2, 3))
            every = np.arange(len(a))
            stay, _, matches = surviving(a, b, every, every, needed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(stay)), batch.column(1).take(pa.array(stay)), pa.array(matches, pa.int32())],
                names=["a", "b", "matches"],
            )

    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    t, of = similarity
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    # A set much smaller than the other cannot be similar enough.
    sized = joined.where(F.least("n_a", "n_b") * of >= F.greatest("n_a", "n_b") * t)
    kind = classes.schema["node"].dataType.simpleString()
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, f"a {kind}, b {kind}, matches int")


def shingle_sets(df, id_col, text_col, nodes, words):
    """(node, shingles) of the documents named in ``nodes`` (distinct); a bitmap keeps most others out of the shuffle."""
    packed = bitmap(nodes.select(F.xxhash64("node")), ROW_BITS)

    def run(batches):
        shingles, cells = Shingler(words), table_of(packed, (1 << ROW_BITS) // 8)
        for batch in slices(batches):
            some = batch.take(pa.array(np.flatnonzero(contains(cells, batch.column(2).to_numpy().view(np.uint64), ROW_BITS))))
            sets = [shingles(t).tobytes() for t in some.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("node"), text_col, F.xxhash64(F.col(id_col)))
    return rows.mapInArrow(run, f"node {id_type}, shingles binary").join(nodes, "node", "left_semi")


def _similar(x, y, t, of):
    """Whether two shingle sets reach the threshold ``t / of``."""
    if of * min(len(x), len(y)) < t * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return of * both >= t * (len(x) + len(y) - both)


def verify_sets(pairs, sets, similarity):
    """Pairs (a, b) whose full sets are similar enough."""
    t, of = similarity

    def run(batches):
        for batch in slices(batches, 64):
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3))
            at = pa.array([i for i, (x, y) in enumerate(zip(a, b)) if _similar(x, y, t, of)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
    kind = sets.schema["node"].dataType.simpleString()
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, f"a {kind}, b {kind}")


def _stars(labels):
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b"))


def components(edges, folder):
    """(node, component) of all nodes of ``edges`` (a, b): the smallest node that is reachable.

    Rounds of two steps.  In the large step a node links its larger neighbours to the smallest neighbour, in the
    small step itself and its smaller ones.  The end is a star around each component's smallest node.  Minima
    are aggregated, then joined, so that a node with very many neighbours is split like any large join key.
    """
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), folder, "links-0")
    state, k = None, 0
    while True:
        k += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, folder, f"large-{k}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m"))
        links = small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()
        links = stored(links, folder, f"links-{k}")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now


def distinct_buckets(members):
    """One of all buckets with the same members; the two sums tell members apart like a hash of 128 bits."""
    same = members.groupBy("h").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    return members.join(same.groupBy("k", "x", "y").agg(F.min("h").alias("h")).select("h"), "h", "left_semi")


def block_links(members, labels, classes, sets, similarity, hashes):
    """Links (a, b) between different components of a bucket, enough of them to join what belongs together.

    In each bucket the component with most members needs no comparison within.  The other members ask, in
    blocks, the blocks of all members; a pair of blocks meets in one task.  A pair that shares several buckets
    is compared in the first of them only.  There it passes the sequential test, then the check on full
    sets, unless its components have been linked in this task already.
    """
    t, of = similarity
    bucket = members.join(labels, "node", "left").select("h", "node", F.coalesce("component", "node").alias("component"))
    share = bucket.groupBy("h", "component").agg(F.count("*").alias("k"))
    active = share.groupBy("h").agg(
        F.max_by("component", F.struct("k", "component")).alias("main"),
        F.max("k").alias("k_main"),
        F.sum("k").alias("k_all"),
        F.count("*").alias("parts"),
    )
    active = active.where("parts > 1").select(
        "h", "main", F.ceil(F.col("k_all") / BLOCK).alias("blocks"), F.ceil((F.col("k_all") - F.col("k_main")) / BLOCK).alias("asking")
    )
    bucket = bucket.join(active, "h").withColumn("mix", F.xxhash64("node"))
    # The buckets of a class are as many as the bands at most.
    own_buckets = bucket.groupBy("node").agg(F.collect_list("h").alias("buckets"))
    own = lambda n: F.pmod("mix", F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = bucket.select("h", "node", "component", F.lit(False).alias("asks"), own("blocks").alias("j"), every("asking").alias("i"))
    asks = bucket.where("component <> main").select(
        "h", "node", "component", F.lit(True).alias("asks"), every("blocks").alias("j"), own("asking").alias("i")
    )
    cells = asked.unionByName(asks.select(asked.columns))
    cells = cells.join(own_buckets.join(classes.select("node", "sig"), "node").join(sets, "node"), "node")
    needed = least_matches(similarity, hashes)

    def links_of(table):
        """Links in the cells of ``table``, whose rows are ordered by cell."""
        column = {name: table.column(name) for name in table.column_names}
        node, part = column["node"].to_pylist(), column["component"].to_pylist()
        cell = np.stack([column[c].to_numpy() for c in ("h", "i", "j")], 1)
        ask, shared = column["asks"].to_numpy(), [set(x) for x in column["buckets"].to_pylist()]
        sig = _matrix(column["sig"], hashes)
        full = [np.frombuffer(x, np.uint64) for x in column["shingles"].to_pylist()]
        starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]).any(1)))
        found = []
        for lo, hi in zip(starts, [*starts[1:], len(node)]):
            at = np.arange(lo, hi)
            q, c = at[ask[lo:hi]], at[~ask[lo:hi]]
            group = {}

            def find(x):
                while group.get(x, x) != x:
                    x = group[x]
                return x

            for i in range(0, len(q), 64):
                few = q[i : i + 64]
                x, y, matches = surviving(sig, sig, np.repeat(few, len(c)), np.tile(c, len(few)), needed)
                for k in np.argsort(-matches, kind="stable"):
                    a, b = x[k], y[k]
                    left, right = find(part[a]), find(part[b])
                    if left != right and min(shared[a] & shared[b]) == cell[lo, 0] and _similar(full[a], full[b], t, of):
                        group[left] = right
                        found.append((node[a], node[b]))
        return found

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            cell = np.stack([table.column(c).to_numpy() for c in ("h", "i", "j")], 1)
            other = np.flatnonzero((cell != cell[-1]).any(1))
            cut = int(other[-1]) + 1 if len(other) else 0
            rest = table.slice(cut)
            if cut:
                yield pairs_of(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield pairs_of(rest)

    def pairs_of(table):
        kind, found = table.column("node").type, links_of(table)
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], kind) for k in (0, 1)], names=["a", "b"])

    kind = classes.schema["node"].dataType.simpleString()
    ordered = cells.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
    return ordered.mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(df, id_col="doc_id", text_col="text", words=WORDS, similarity=SIMILARITY, rows=ROWS):
    """Per row of ``df``: size of its shingle set, its component and whether it is the component's kept one.

    A text of fewer words than a shingle is one shingle; null and empty texts have none, are linked with nothing
    and kept.  Ids are of any type that has an order.  Rows that repeat an id each get the component of their own text; where
    the id is the smallest of both texts' classes, these are one.  Rows without an id are not linked: they are
    kept, with no component.  ``similarity`` is a fraction; pairs that
    reach it are linked.  Empty tables give no rows.  Extra columns are left out.
    """
    folder = workspace(df.sparkSession)
    bands = band_count(similarity, rows)
    hashes = bands * rows
    sketches = stored(sketch(df, id_col, text_col, words, hashes), folder, "sketches")
    some = sketches.where("n > 0 AND id IS NOT NULL")
    owners = some.groupBy("fp1", "fp2").agg(F.min("id").alias("node"))
    owners = stored(owners, folder, "owners")
    # The id in the key deals a very large class out over the tasks.
    classes = some.join(owners.withColumnRenamed("node", "id"), ["fp1", "fp2", "id"]).groupBy("fp1", "fp2").agg(
        F.first("id").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    classes = stored(classes.select("node", "n", "sig"), folder, "classes")

    hashed = lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.substring(F.col("sig"), b * (4 * rows) + 1, F.lit(4 * rows))).alias("h")
    )
    members = classes.select("node", F.inline(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), hashed)))
    buckets = members.groupBy("h").agg(F.min("node").alias("a"), F.count("*").alias("k")).where("k > 1")
    members = stored(members.join(buckets, "h"), folder, "members")

    # First every class meets its most similar leader: what is linked then needs no comparison any more.
    pairs = members.where("node <> a").select("a", F.col("node").alias("b")).distinct()
    near = stored(verify_signatures(pairs, classes, similarity, hashes), folder, "near")
    # A bucket of two is a pair with its leader, so only survivors and larger buckets need their sets.
    nodes = near.select(F.explode(F.array("a", "b")).alias("node")).unionByName(members.where("k > 2").select("node"))
    nodes = stored(nodes.distinct(), folder, "nodes")
    sets = stored(shingle_sets(df, id_col, text_col, nodes, words), folder, "sets")
    best = near.groupBy("b").agg(F.max_by("a", F.struct("matches", "a")).alias("a"))
    links = stored(verify_sets(best, sets, similarity), folder, "first")
    labels = components(links, f"{folder}/first-components")

    # Then the other pairs with leaders, and in buckets of more than two the pairs without one, that are still apart.
    of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    rest = near.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    rest = rest.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b").join(best, ["a", "b"], "left_anti")
    large = stored(distinct_buckets(members.where("k > 2").select("h", "node")), folder, "large")
    later = block_links(large, labels, classes, sets, similarity, hashes)
    later = stored(verify_sets(rest, sets, similarity).unionByName(later), folder, "later")
    if not later.isEmpty():
        labels = components(_stars(labels).unionByName(later), f"{folder}/later-components")

    by_node = owners.join(labels, "node", "left").select("fp1", "fp2", F.coalesce("component", "node").alias("label"))
    result = sketches.join(by_node, ["fp1", "fp2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("label", "id"))
    return result.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


ship(__name__)
