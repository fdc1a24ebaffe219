"""Audit of how quality filters interact, over every order in which they can be applied.

A document fails some of five filters; which ones is a mask of five bits.  Documents are counted by part and mask,
so a part has at most 32 cells however many documents it holds.  For each cell the array of all orders is folded:
``transform`` goes over the 120 orders, ``aggregate`` along the steps of one, and the cell becomes 600 structs
weighted by its counts.  The cells of a part are merged by elementwise sums.  The array of orders is a literal, which
Spark broadcasts with the tasks.
"""

from itertools import permutations

from pyspark.sql import functions as F

from lanternstats.llm.common import UPPER, stored, workspace

LETTERS = "ABCDE"
LEAST_WORDS = 50
#: Percent of the words that are distinct, at least, and of the characters that are capitals, at most.
DISTINCT_SHARE = 65
CAPITAL_SHARE = 5
SYMBOLS = "[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def orders(letters=LETTERS):
    """All orders of the filters, as strings."""
    return ["".join(p) for p in permutations(letters)]


def failures(df, id_col="doc_id", text_col="text", source_col="source"):
    """(id, part, digest, mask) of each row; the mask has a bit for each of the filters A to D that it fails.

    The text is cut into words once.  Equal texts have equal digests, null and empty ones too.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    # The array is made once per row: functions of one lambda argument share it.
    of_words = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    capitals = F.length("text") - F.length(F.translate("text", UPPER, ""))
    rows = rows.select("id", "part", "text", of_words.alias("words"), capitals.alias("capitals"))
    fails = (
        F.col("words.all") < LEAST_WORDS,
        F.col("words.distinct").cast("long") * 100 < F.col("words.all").cast("long") * DISTINCT_SHARE,
        F.col("capitals").cast("long") * 100 > F.length("text").cast("long") * CAPITAL_SHARE,
        F.col("text").rlike(SYMBOLS),
    )
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def cells(facts, labels, folder, id_col="doc_id"):
    """(part, mask, n, good, toxic): rows by part and mask, bit E being set where a smaller id has the same text.

    Rows are first counted by id and text, then by text, part and labels; of each of these counts all but the rows with
    the smallest id of the text fail E.  So the rows of a text with very many copies meet as a few counts.
    """
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(flag("quality"), flag("toxic"))
    same = facts.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("k"))
    same = same.join(known, "id", "left").na.fill(0, ["quality", "toxic"])
    groups = same.groupBy("digest", "part", "mask", "quality", "toxic").agg(
        F.sum("k").alias("n"),
        F.min("id").alias("first"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "k")))["k"].alias("k_first"),
        F.sum(F.when(F.col("id").isNull(), F.col("k")).otherwise(0)).alias("k_null"),
    )
    groups = stored(groups, folder, "groups")
    groups = groups.join(groups.groupBy("digest").agg(F.min("first").alias("least")), "digest")
    # A row without an id is neither smaller nor larger than another.
    clear = F.col("k_null") + F.when(F.col("first") == F.col("least"), F.col("k_first")).otherwise(0)
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("m"), clear.alias("k")),
            F.struct((F.col("mask") + 16).alias("m"), (F.col("n") - clear).alias("k")),
        )
    )
    rows = groups.select("part", "quality", "toxic", split.alias("s")).where("s.k > 0")
    return rows.groupBy("part", F.col("s.m").alias("mask")).agg(
        F.sum("s.k").alias("n"),
        F.sum(F.col("s.k") * F.col("quality")).alias("good"),
        F.sum(F.col("s.k") * F.col("toxic")).alias("toxic"),
    )


def folded(cell, order_list):
    """The 600 structs of one cell: all steps of all orders, weighted by the cell's counts."""

    def walk(order):
        nothing = F.array().cast("array<struct<kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>>")
        start = F.struct(F.lit(False).alias("gone"), nothing.alias("steps"))

        def step(state, bit):
            fails = cell["mask"].bitwiseAND(bit) != 0
            gone = state["gone"]
            here = fails & ~gone
            count = lambda when, of="n": F.when(when, cell[of]).otherwise(F.lit(0).cast("long"))
            made = F.struct(
                count(~(gone | fails)).alias("kept"),
                count(here).alias("removed"),
                count(fails & gone).alias("redundant"),
                count(cell["mask"] == bit).alias("unique_fails"),
                count(here, "good").alias("good_lost"),
                count(here, "toxic").alias("toxic_lost"),
            )
            return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(made)).alias("steps"))

        return F.aggregate(order, start, step, lambda state: state["steps"])

    return F.flatten(F.transform(order_list, walk))


def filter_audit(df, labels, id_col="doc_id", text_col="text", source_col="source", letters=LETTERS):
    """One row per part, order of the filters and step, with the counts named in ``COUNTS``.

    Parts are the values of ``source_col``; null counts as the empty string, and so meets an empty source.  Null and
    empty texts have no words, fail A, and are copies of each other.  Rows with one id are rows of their own, and none
    is a copy of the other; a row without an id fails E never and makes no other row fail it.  An id that has several
    labels is good or toxic if one of them says so; without a label it is neither.  ``shapley`` is
    the number of rows that a filter removes, summed over all orders.  An empty table gives no rows.  Texts of any
    length are judged whole.  Extra columns are left out.
    """
    folder = workspace(df.sparkSession)
    facts = stored(failures(df, id_col, text_col, source_col), folder, "failures")
    every, width, names = orders(letters), len(letters), COUNTS[:-1]
    bits = F.array(*[F.array(*[F.lit(1 << LETTERS.index(c)) for c in order]) for order in every])
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in names])
    plus = lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in names])
    # A part has at most 32 cells.
    parts = cells(facts, labels, folder, id_col).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    merged = F.aggregate("cells", F.array_repeat(zero, len(every) * width), lambda sums, cell: F.zip_with(sums, folded(cell, bits), plus))
    rows = parts.select("part", merged.alias("sums"))
    places = {c: [i * width + order.index(c) for i, order in enumerate(every)] for c in letters}
    total = lambda c: F.aggregate(F.array(*map(F.lit, places[c])), F.lit(0).cast("long"), lambda s, i: s + F.col("sums")[i]["removed"])
    rows = rows.select("part", "sums", F.create_map(*[x for c in letters for x in (F.lit(c), total(c))]).alias("totals"))
    rows = rows.select("part", "totals", F.posexplode("sums").alias("at", "s"))
    order = F.array(*map(F.lit, every))[F.floor(F.col("at") / width).cast("int")]
    rows = rows.select("part", order.alias("filter_order"), (F.col("at") % width + 1).alias("step"), "s.*", "totals")
    shapley = F.col("totals")[F.substring("filter_order", F.col("step"), F.lit(1))]
    return rows.select("part", "filter_order", "step", *names, shapley.alias("shapley"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
f AS (
  SELECT doc_id, part, [len(words) < 50,
    100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)] AS fails FROM d),
l AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
p AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (
  SELECT part, array_to_string(list_transform(o, lambda i: chr((64 + i)::INT)), '') AS filter_order, x.k::INT AS step, o[x.k] AS filter, n, good, toxic,
    fails[o[x.k]] AS failed, len(list_filter(o[:x.k - 1], lambda i: fails[i])) > 0 AS gone, len(list_filter(fails, lambda g: g)) = 1 AS single
  FROM c, p, x),
t AS (
  SELECT part, filter_order, step, filter, sum(CASE WHEN failed OR gone THEN 0 ELSE n END)::BIGINT AS kept,
    sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN failed AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed AND single THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN failed AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN failed AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM t
"""
