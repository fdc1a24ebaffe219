"""Benchmark decontamination: a broadcast hash set of test n-grams.

Every window of a document is looked up by its hash in the benchmark's windows and verified on its words.
Documents are read once and never shuffled: only window hits and one row per document are.  Of a benchmark too large to
be broadcast a bitmap is, so that any size of it works.  Only DataFrame functions are used.
"""

from pyspark.sql import functions as F

from lanternstats.llm.common import ascii_lower, stored, workspace
from lanternstats.plans.bridge_history import filter_bits, maybe_known

WINDOW = 10
#: Most benchmark windows that are broadcast (about 150 bytes each).
BLOCK = 500_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text):
    """Words of a text after lower-casing A-Z; null has none."""
    cut = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.array_remove(cut, "")


def benchmark_windows(items, item_col="item_id", text_col="text", window=WINDOW):
    """One row per different window and item: the window's text, hash and length, and the item."""
    words = items.select(F.col(item_col).alias("item"), word_array(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    grams = words.select(
        "item",
        length.alias("length"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("w") - length + 1),
                lambda i: F.array_join(F.slice("w", i, length), " "),
            )
        ).alias("gram"),
    )
    return grams.distinct().withColumn("h", F.xxhash64("gram"))


def window_hits(df, grams, id_col, text_col):
    """Rows (row, id, at, length, gram): for every row of ``df`` one with its words at 0, and one per hit.

    Documents are read once, whatever the size of the benchmark.  Up to ``BLOCK`` windows are broadcast with their
    words.  Of more, a bitmap of a fixed size is, and only windows that it lets pass are shuffled to be verified.
    """
    # At most ``window`` different lengths: a handful of numbers.
    found = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.count("*").alias("n")).collect()}
    words = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), word_array(F.col(text_col)).alias("w")
    )

    def windows(n):
        at = F.sequence(F.lit(1), F.size("w") - n + 1)
        row = lambda i: F.struct(i.alias("at"), F.lit(n).alias("length"), F.array_join(F.slice("w", i, n), " ").alias("gram"))
        nothing = F.array().cast("array<struct<at:int,length:int,gram:string>>")
        return F.when(F.size("w") >= n, F.transform(at, row)).otherwise(nothing)

    # The first row of a document carries its number of words past the join.
    count = F.array(F.struct(F.lit(0).alias("at"), F.size("w").alias("length"), F.lit("").alias("gram")))
    rows = words.select("row", "id", F.inline(F.concat(count, *[windows(n) for n in sorted(found)])))
    if sum(found.values()) > BLOCK:
        rows = maybe_known(rows, filter_bits(grams, "gram"), "gram").where("_maybe OR at = 0").drop("_maybe")
        tests = grams
    else:
        tests = F.broadcast(grams)
    # First rows match nothing; a hash of their own keeps them from meeting in one task.
    rows = rows.withColumn("hash", F.when(F.col("at") > 0, F.xxhash64("gram")).otherwise(F.xxhash64("row")))
    same = (F.col("hash") == F.col("h")) & (F.col("gram") == F.col("test_gram"))
    tests = tests.select("h", F.col("gram").alias("test_gram"))
    return rows.join(tests, same, "left").where("test_gram IS NOT NULL OR at = 0").select("row", "id", "at", "length", "gram")


def contamination(df, items, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", window=WINDOW):
    """Per row of ``df``: words, hit words, spans of hits (first word, words; from 1), items and their digest.

    A window is ``window`` words; an item of fewer, but not none, is one window.  Documents and items with null
    or empty text have no words and hit nothing.  Rows are told apart by their place, not by their id: null and
    repeated ids give a row each.  Items of one id count as one; those without an id hit words, but are not named.
    Empty tables give no rows or no hits.  Extra columns are left out.
    """
    folder = workspace(df.sparkSession)
    pairs = stored(benchmark_windows(items, item_col, item_text_col, window), folder, "windows")
    # Hits are small beside the texts; written once, the row numbers stay what they are.
    hits = window_hits(df, pairs.select("h", "gram", "length").distinct(), id_col, text_col)
    hits = stored(hits, folder, "hits")
    is_hit = F.col("at") > 0
    found = hits.groupBy("row").agg(
        F.first("id").alias("id"),
        F.max(F.when(~is_hit, F.col("length"))).cast("long").alias("n_words"),
        F.collect_set(F.when(is_hit, F.struct("at", "length"))).alias("spans"),
    )
    # The items of a window meet it only now, so that no row holds all items of a common one.
    named = hits.where(is_hit).select("row", "gram").distinct().join(pairs.select("gram", "item"), "gram")
    named = named.groupBy("row").agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))
    return (
        found.join(named, "row", "left")
        .withColumn("items", F.array_sort(F.coalesce("items", F.array().cast("array<string>"))))
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
            (F.size("spans") > 0).alias("contaminated"),
            F.array_sort("spans").alias("spans"),
            "items",
        )
    )


def clean_documents(df, items, id_col="doc_id", **kwargs):
    """Rows of ``df`` without any window of the benchmark; those of one id, or none, are kept or dropped together."""
    bad = contamination(df, items, id_col, **kwargs).where("contaminated").select(F.col(id_col).alias("_bad"))
    return df.join(bad, F.col(id_col).eqNullSafe(F.col("_bad")), "left_anti")


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS gram
  FROM b WHERE len(w) > 0),
x AS (
  SELECT doc_id, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i, w FROM d CROSS JOIN (SELECT DISTINCT n FROM g)),
h AS (
  SELECT DISTINCT x.doc_id, x.i, x.n, g.item_id FROM x JOIN g ON g.n = x.n AND g.gram = array_to_string(w[i:i + x.n - 1], ' ')),
p AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
