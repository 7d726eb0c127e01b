"""Length statistics of texts.

Lengths are counted per distinct value first. That table is small (a length
is bounded by the longest text), so quantiles, ranges and bins are exact, cost
one pass over the texts, and no task ever holds all lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.text import word_count
from precis.settings import DEFAULTS


def length_counts(texts: DataFrame, text: str) -> DataFrame:
    """How many texts have each word count."""
    return texts.groupBy(word_count(text).alias("x")).agg(F.count("*").alias("c"))


def length_stats(texts: DataFrame, text: str) -> DataFrame:
    """Count, mean, interpolated median, range and population deviation.

    All NULL but the count for an empty table.
    """
    n = word_count(text)
    return texts.select(n.alias("x")).agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.percentile("x", 0.5).alias("median"),
        F.min("x").alias("shortest"),
        F.max("x").alias("longest"),
        F.stddev_pop("x").alias("std"),
    )


def length_histogram(
    texts: DataFrame, text: str, bins: int = DEFAULTS.histogram_bins
) -> DataFrame:
    """Equal bins from the shortest to the longest text, the last one closed.

    If all lengths are equal the range is half a word to both sides.
    """
    everything = Window.partitionBy()
    counts = (
        length_counts(texts, text)
        .withColumn("lo", F.min("x").over(everything).cast("double"))
        .withColumn("hi", F.max("x").over(everything).cast("double"))
    )
    same = F.col("lo") == F.col("hi")
    ranged = counts.withColumns({
        "lo": F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")),
    })
    bucket = F.least(
        F.width_bucket(F.col("x").cast("double"), F.col("lo"), F.col("hi"), F.lit(bins)),
        F.lit(bins),
    ).cast("long")
    filled = ranged.groupBy("lo", "hi", bucket.alias("bin")).agg(F.sum("c").alias("n"))
    # At most one row per bin is gathered, then every bin comes out of it, also
    # the empty ones.
    gathered = filled.groupBy("lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return gathered.select(
        "lo", "hi", "by_bin",
        F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"),
    ).select(
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_from"),
        (F.col("lo") + width * F.col("bin")).alias("bin_to"),
        F.coalesce(F.try_element_at("by_bin", "bin"), F.lit(0)).alias("n"),
    )


def length_boxplot(texts: DataFrame, text: str) -> DataFrame:
    """Quartiles, whisker ends and the number of outliers.

    Whiskers end at the extreme values within 1.5 interquartile ranges, but
    never inside the box.
    """
    counts = length_counts(texts, text)
    quartiles = F.percentile("x", [0.25, 0.5, 0.75], F.col("c")).over(Window.partitionBy())
    q1, q3 = F.col("q")[0], F.col("q")[2]
    reach = (q3 - q1) * 1.5
    inside = (F.col("x") >= q1 - reach) & (F.col("x") <= q3 + reach)
    marked = counts.withColumn("q", quartiles).withColumn("inside", inside)
    x = F.when(F.col("inside"), F.col("x").cast("double"))
    return (
        marked.groupBy("q")
        .agg(
            F.min(x).alias("lo"), F.max(x).alias("hi"),
            F.sum(F.when(F.col("inside"), 0).otherwise(F.col("c"))).alias("outliers"),
        )
        .select(
            q1.alias("q1"), F.col("q")[1].alias("median"), q3.alias("q3"),
            F.least("lo", q1).alias("whisker_low"), F.greatest("hi", q3).alias("whisker_high"),
            "outliers",
        )
    )
