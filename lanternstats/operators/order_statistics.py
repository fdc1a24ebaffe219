"""Exact order statistics without collecting a group."""

from pyspark.sql import Window, functions as F

BUCKET_BITS = 16


def select_by_rank(values, group, value, ranks):
    """The values at given 0-based positions of each group's sorted values.

    ``ranks`` maps a name to a function from the group size column to a
    position column; a null position is skipped.  Values are whole numbers.

    Equal values are counted first, counts are summed into ranges of 2**16
    neighbouring values, and only the ranges holding a wanted position are
    looked at value by value.  No task sees more than the range counts of a
    group, or the 2**16 distinct values of one range.
    """
    counts = values.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_range", F.shiftright(value, BUCKET_BITS)
    )
    by_group = Window.partitionBy(*group)
    running = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        counts.groupBy(*group, "_range")
        .agg(F.sum("_n").alias("_m"))
        .withColumn("_before", F.sum("_m").over(running) - F.col("_m"))
        .withColumn("_total", F.sum("_m").over(by_group))
        .withColumn(
            "_wanted",
            F.filter(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("name"),
                            (position(F.col("_total")) - F.col("_before")).alias("rank"),
                        )
                        for name, position in ranks.items()
                    ]
                ),
                lambda w: (w["rank"] >= 0) & (w["rank"] < F.col("_m")),
            ),
        )
        .where(F.size("_wanted") > 0)
        .select(*group, "_range", "_wanted")
    )
    inside = (
        Window.partitionBy(*group, "_range")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        counts.join(ranges, [*group, "_range"])
        .withColumn("_upto", F.sum("_n").over(inside))
        .select(*group, value, "_n", "_upto", F.explode("_wanted").alias("_w"))
        .where("_w.rank < _upto AND _w.rank >= _upto - _n")
    )
    return found.groupBy(*group).agg(
        *[F.max(F.when(F.col("_w.name") == name, F.col(value))).alias(name) for name in ranks]
    )
