"""Mixing sources to target weights.

Words are summed per source; weights and caps turn the sums into targets, targets by sums into repetition
rates.  A document is emitted floor(rate) times, and once more if a number drawn from the hash of its id falls
below the fraction.  Only DataFrame functions are used.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Size of the mix by size of all sources.
SHARE = 1.5
#: Most copies that a source gives of itself.
MOST = 2
SEED = "mix"


def word_count(text):
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_column, seed=SEED, text_column="text"):
    """A number from 0 to 1 fixed by the id, or by the text where it is null: the first 48 bits of a digest."""
    of_text = F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary")))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), of_text))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def source_targets(sizes, source_col="source", weights=WEIGHTS, share=SHARE, most=MOST):
    """One row per source: its size and its target.

    Targets are in proportion to the weights; those above ``most`` times their source stop there, and the
    excess goes to the others by weight until none is above.  This is one level L with targets
    least(cap, L * weight).  With sources ordered by cap / weight, L is what remains after the first k caps by
    the remaining weight, for the first k that leaves L at or below the next cap / weight.  The table has one
    row per source, which is what the ordering below runs over.
    """
    order = Window.orderBy(F.col(source_col).asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    rows = (
        sizes.groupBy(source_col)
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(most))
    )
    before = Window.orderBy((F.col("cap") / F.col("weight")), F.col(source_col).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))
    return (
        rows.withColumn("level", level)
        .withColumn("level", F.coalesce(F.min(fits).over(everything)["level"], F.lit(float("inf"))))
        .select(source_col, "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))
    )


def mix_plan(df, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED):
    """Every row of ``df`` with its size, source size, target and number of copies.

    Null sources are one source, the last.  Null and empty texts have size 0.  A source of size 0 has target 0
    and no copies.  Rows with the same id draw the same number, as do rows without one whose texts are equal.  An
    empty table gives no rows.  Very long texts are counted whole.  Extra columns are kept, except those with the
    names of the results, which are replaced.
    """
    made = ("size", "source_size", "target", "copies")
    rows = df.drop(*[c for c in made if c not in (id_col, text_col, source_col)])
    # Size and draw come before the join, so that a result without the texts does not shuffle them.
    rows = rows.withColumn("_draw", draw(id_col, seed, text_col)).withColumn("size", word_count(F.col(text_col)))
    sizes = df.select(F.col(source_col), word_count(F.col(text_col)).alias("size"))
    targets = source_targets(sizes, source_col, weights, share, most).withColumnRenamed(source_col, "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        rows.join(targets, F.col(source_col).eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .withColumn("_rate", rate)
        .withColumn(
            "copies",
            (F.floor("_rate") + F.when(F.col("_draw") < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)).cast("long"),
        )
        .drop("_rate", "_draw")
    )


def emit(plan, number_col="copy"):
    """The mix itself: every row as often as planned, numbered from 1."""
    return plan.where("copies > 0").withColumn(number_col, F.explode(F.expr("sequence(1L, copies)")))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM d GROUP BY source),
k AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS bound FROM s),
l AS (
  SELECT a.bound, ((SELECT sum(source_size) FROM k) * 1.5::DOUBLE - coalesce(sum(b.cap), 0)) / ((SELECT sum(weight) FROM k) - coalesce(sum(b.weight), 0)) AS level
  FROM k a LEFT JOIN k b ON b.bound < a.bound GROUP BY a.bound, a.source),
t AS (
  SELECT source, source_size, least(cap, weight * coalesce((SELECT min_by(level, bound) FROM l WHERE level <= bound), 'inf'::DOUBLE)) AS target FROM k),
r AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
   ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS drawn
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
