"""Equi lookups that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.settings import DEFAULTS, Settings
from precis.sources.storage import cut_lineage

ROW_BYTES = 32


@dataclass(frozen=True)
class Sized:
    """A stored lookup table, one row per key, with its measured size."""

    table: DataFrame
    key: str
    n_rows: int
    n_bytes: int

    @classmethod
    def measure(cls, table: DataFrame, key: str) -> "Sized":
        """Measure a table that is stored already."""
        key_bytes = F.octet_length(F.col(key).cast("string")) + ROW_BYTES
        row = table.agg(F.count("*"), F.coalesce(F.sum(key_bytes), F.lit(0))).first()
        return cls(table, key, *row)

    @classmethod
    def store(cls, table: DataFrame, key: str) -> "Sized":
        """Compute a table once, store it reliably and measure it."""
        return cls.measure(cut_lineage(table), key)

    def is_small(self, settings: Settings = DEFAULTS) -> bool:
        return (
            self.n_rows <= settings.broadcast_rows and self.n_bytes <= settings.broadcast_bytes
        )


def hot_keys(
    table: DataFrame, key: str, weight: Column, settings: Settings = DEFAULTS
) -> DataFrame:
    """The heaviest keys, cut to a proven number of rows and bytes.

    The running sum goes over at most ``hot_rows`` rows.
    """
    weighed = table.withColumn("_weight", weight)
    top = weighed.where(F.col(key).isNotNull()).orderBy(F.desc("_weight"), key).limit(settings.hot_rows)
    running = F.sum(F.octet_length(F.col(key).cast("string")) + ROW_BYTES).over(
        Window.orderBy(F.desc("_weight"), key).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        top.withColumn("_bytes", running)
        .where(F.col("_bytes") <= settings.broadcast_bytes)
        .drop("_weight", "_bytes")
    )


def heavy_keys(table: DataFrame, key: str, weight: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """All keys from some weight on, as many as a lookup table that counts as small may have.

    Keys are counted by weight, so none are sorted; word counts have few different values.
    """
    known = table.where(F.col(key).isNotNull()).withColumn("_weight", weight)
    sizes = known.groupBy("_weight").agg(
        F.count("*").alias("n"), F.sum(F.octet_length(F.col(key).cast("string")) + ROW_BYTES).alias("size"))
    so_far = Window.orderBy(F.desc("_weight")).rowsBetween(Window.unboundedPreceding, 0)
    fits = (F.sum("n").over(so_far) <= settings.broadcast_rows) & (F.sum("size").over(so_far) <= settings.broadcast_bytes)
    least = sizes.withColumn("fits", fits).where("fits").agg(F.min("_weight")).first()[0]
    return known.where(F.col("_weight") >= F.lit(least)).drop("_weight")


def lookup(
    rows: DataFrame, sized: Sized, weight: Column, settings: Settings = DEFAULTS
) -> DataFrame:
    """Left join of ``rows`` with a lookup table on its key.

    A table of small measured size is broadcast. From a larger one only the
    heaviest keys are: word counts are so uneven that a few thousand words make
    up most rows. One join with the whole table follows, for which the rows that
    are settled already, or have no key, travel by a hash of the row instead of
    the key, so no key is heavy and ``rows`` is read once. Columns named ``_hot``,
    ``_all`` and ``_salt`` are used inside.
    """
    if sized.is_small(settings):
        return rows.join(F.broadcast(sized.table), sized.key, "left")
    key, names = sized.key, [c for c in sized.table.columns if c != sized.key]
    payload = F.struct(*names)
    hot = hot_keys(sized.table, key, weight, settings).select(key, payload.alias("_hot"))
    near = rows.join(F.broadcast(hot), key, "left")
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    own = near.select(
        F.when(~settled, F.col(key)).alias("_key"),
        F.when(settled, F.xxhash64(*rows.columns)).otherwise(0).alias("_salt"),
        "*",
    )
    whole = sized.table.select(
        F.col(key).alias("_key"), F.lit(0).cast("long").alias("_salt"), payload.alias("_all"))
    found = F.coalesce("_hot", "_all")
    columns = [F.col(c) for c in near.columns if c != "_hot"]
    return own.join(whole, ["_key", "_salt"], "left").select(
        *columns, *(found.getField(n).alias(n) for n in names))


def lookup_sums(
    rows: DataFrame, sized: Sized, weight: Column, value: str, by: list[str], most: str | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """``(by, total)``: the sum of a looked-up ``value`` over the rows of each group, 0.0 for keys that are unknown or null.

    ``most`` is a column whose greatest value in the group is kept. Of a large table as many keys
    are broadcast as a small one may have, the heaviest; of those only the sums of a group travel,
    and each other key of a group once with its count. ``rows`` is read once.
    """
    key, kept = sized.key, [most] if most else []
    greatest = [F.max(c).alias(c) for c in kept]
    found = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    if sized.is_small(settings):
        near = rows.join(F.broadcast(sized.table.select(key, value)), key, "left")
        return near.groupBy(*by).agg(F.sum(found).alias("total"), *greatest)
    hot = heavy_keys(sized.table, key, weight, settings).select(key, F.struct(value).alias("_hot"))
    near = rows.join(F.broadcast(hot), key, "left")
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    in_task = near.groupBy(*by, F.when(~settled, F.col(key)).alias("_key")).agg(
        F.sum(F.coalesce(F.col("_hot").getField(value).cast("double"), F.lit(0.0))).alias("_near"),
        F.count("*").alias("_n"), *greatest)
    own = in_task.withColumn("_salt", F.when(F.col("_key").isNull(), F.xxhash64(*by)).otherwise(0))
    whole = sized.table.select(F.col(key).alias("_key"), F.lit(0).cast("long").alias("_salt"), value)
    far = F.when(F.col("_key").isNotNull(), F.col("_n") * found).otherwise(0.0)
    return own.join(whole, ["_key", "_salt"], "left").groupBy(*by).agg(F.sum(F.col("_near") + far).alias("total"), *greatest)
