"""Training and validation parts: reproducible, of exact or expected size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.settings import DEFAULTS

TRAIN, VALIDATION = "train", "validation"
# Times that digests are counted by four more digits.
LEVELS = 3


def row_digest(key: str, seed: int) -> Column:
    """A uniform, repeatable 32-digit hex number for a row key."""
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def _part(chosen: Column, chosen_name: str, rest_name: str) -> Column:
    return F.when(F.coalesce(chosen, F.lit(False)), chosen_name).otherwise(rest_name)


def split_exact(
    df: DataFrame,
    fraction: float = DEFAULTS.train_fraction,
    seed: int = DEFAULTS.seed,
    key: str = "doc_id",
    chosen: str = TRAIN,
    rest: str = VALIDATION,
) -> DataFrame:
    """Add ``split``: exactly ``round(fraction * rows)`` rows are ``chosen``.

    The rows with the smallest digests are chosen. Digests are counted by their
    first four digits, at most 65,536 groups, and the running total names the one
    group in which the parts meet; that group is counted again by the next four
    digits, three times in all. What is left to rank is a share of 1 / 2**48 of the
    rows. The split is then a comparison inside each row, so the table is never
    sorted, gathered or shuffled. Keys must be unique. The key is read once for
    each level: store the table before if it is expensive to make.
    """
    digests = df.select(row_digest(key, seed).alias("digest"))
    near, place = digests, None
    for level in range(LEVELS):
        prefix = F.substring("digest", 1, 4 * (level + 1))
        counts = near.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"))
        # Windows in one task, over the groups, not the rows.
        running = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        if place is None:
            place = F.bround(F.lit(fraction) * F.sum("n").over(Window.partitionBy()), 0).cast("long")
        totals = counts.withColumn("upto", F.sum("n").over(running)).withColumn("wanted", place)
        before = F.col("upto") - F.col("n")
        border = totals.where((before < F.col("wanted")) & (F.col("upto") >= F.col("wanted"))).agg(
            F.max("prefix").alias("prefix"), F.max(F.col("wanted") - before).alias("place")
        )
        near = near.where(prefix == border.select("prefix").scalar())
        place = border.select("place").scalar()
    ranked = near.withColumn("place", F.row_number().over(Window.orderBy("digest")))
    last = ranked.where(F.col("place") <= place).agg(F.max("digest"))
    return df.withColumn("split", _part(row_digest(key, seed) <= last.scalar(), chosen, rest))


def split_hash(
    df: DataFrame,
    fraction: float = DEFAULTS.train_fraction,
    seed: int = DEFAULTS.seed,
    key: str = "doc_id",
) -> DataFrame:
    """Add ``split`` by a fixed digest limit.

    Sizes are met on average only, but a row keeps its part as rows arrive.
    """
    limit = f"{min(int(fraction * 2**32), 2**32 - 1):08x}"
    chosen = F.substring(row_digest(key, seed), 1, 8) < limit
    return df.withColumn("split", _part(chosen, TRAIN, VALIDATION))


def split_fallback(
    train: DataFrame,
    validation: DataFrame | None,
    fraction: float = DEFAULTS.fallback_validation_fraction,
    seed: int = DEFAULTS.seed,
    key: str = "doc_id",
) -> DataFrame:
    """Both parts in one table; without a validation table a share of the
    training rows takes its place and leaves the training part."""
    if validation is None:
        return split_exact(train, fraction, seed, key, chosen=VALIDATION, rest=TRAIN)
    return train.withColumn("split", F.lit(TRAIN)).unionByName(
        validation.withColumn("split", F.lit(VALIDATION))
    )


def count_rows(df: DataFrame) -> DataFrame:
    """Rows per part."""
    return df.groupBy("split").agg(F.count("*").alias("n"))
