"""Next-token probabilities after two ids, smoothed by discounted back-off over shorter prefixes.

The longest prefix counts how often an id follows it; a shorter one counts after how many
different ids it does (continuation counts), which tells a word that follows anything from
one that follows a single word often. A constant is taken off each count, and what that frees
goes to the next shorter prefix, at last to all ids alike. So each prefix, seen or not, gives
every id a probability, and they sum to one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.settings import PAD, START
from precis.sources.storage import cut_lineage


def trigrams(sequences: DataFrame, ids: str = "ids") -> DataFrame:
    """``(doc_id, pos, u, v, w)``: each id after the first of a sequence, and the two before it.

    Another START stands before each sequence. PAD is no id: it neither follows nor leads.
    """
    long = F.concat(F.array(F.lit(START)), F.filter(ids, lambda x: x.isNotNull() & (x != PAD)))
    n = F.size("s")
    at = sequences.select("doc_id", long.alias("s")).select("doc_id", F.arrays_zip(
        F.slice("s", 1, F.greatest(n - 2, F.lit(0))).alias("u"), F.slice("s", 2, F.greatest(n - 2, F.lit(0))).alias("v"),
        F.slice("s", 3, F.greatest(n - 2, F.lit(0))).alias("w")).alias("z"))
    return at.select("doc_id", F.posexplode_outer("z").alias("pos", "t")).where("t is not null").select(
        "doc_id", "pos", "t.u", "t.v", "t.w")


@dataclass(frozen=True)
class Order:
    """Counts of ids after prefixes of one length, the sums of each prefix, and the discount."""

    counts: DataFrame
    prefixes: DataFrame
    discount: float

    @staticmethod
    def of(counts: DataFrame, prefix: list[str], n: int) -> "Order":
        """``counts`` has the prefix's columns, w and c; names get the order's number."""
        stored = cut_lineage(counts.withColumnRenamed("c", f"c{n}"))
        c = F.col(f"c{n}")
        # The share that counts of one have of those and twice the counts of two; one half where either lacks,
        # so that something is always freed for other ids, and never all.
        row = stored.agg(F.count_if(c == 1).alias("one"), F.count_if(c == 2).alias("two")).first()
        discount = row.one / (row.one + 2 * row.two) if row.one and row.two else 0.5
        sums = stored.groupBy(*prefix).agg(F.sum(c).alias(f"all{n}"), F.count("*").alias(f"kinds{n}"))
        return Order(stored, cut_lineage(sums), discount)


@dataclass(frozen=True)
class Backoff:
    """Three orders: after two ids, after one, and after any; ``size`` is the number of ids there can be."""

    three: Order
    two: Order
    one: Order
    size: int

    @staticmethod
    def fit(sequences: DataFrame, ids: str = "ids", size: int | None = None) -> "Backoff":
        """Fit on ``(doc_id, ids)`` with START and END in the ids. All counts combine before they are shuffled.

        ``size`` counts the ids that can follow; by default those seen and one for all others.
        Null and empty sequences, and those of one id, bring nothing.
        """
        three = Order.of(trigrams(sequences, ids).groupBy("u", "v", "w").agg(F.count("*").alias("c")), ["u", "v"], 3)
        two = Order.of(three.counts.groupBy("v", "w").agg(F.count("*").alias("c")), ["v"], 2)
        one = Order.of(two.counts.groupBy("w").agg(F.count("*").alias("c")), [], 1)
        return Backoff(three, two, one, one.counts.count() + 1 if size is None else size)

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have u, v and w, with ``p``, the probability of w after u and v.

        Five joins by equal keys; the tables are stored, so a key with many rows is split
        and a small table is sent.
        """
        sums = self.one.prefixes
        found = (
            rows.join(self.three.counts, ["u", "v", "w"], "left").join(self.three.prefixes, ["u", "v"], "left")
            .join(self.two.counts, ["v", "w"], "left").join(self.two.prefixes, ["v"], "left").join(self.one.counts, ["w"], "left")
        )
        # One row, or none where nothing was fitted.
        total = sums.first()

        def level(n: int, order: Order, lower: Column) -> Column:
            here = F.greatest(F.coalesce(F.col(f"c{n}"), F.lit(0)) - F.lit(order.discount), F.lit(0.0))
            return F.when(F.col(f"all{n}").isNull(), lower).otherwise(
                (here + F.lit(order.discount) * F.col(f"kinds{n}") * lower) / F.col(f"all{n}"))

        found = found.withColumns({
            "all1": F.lit(total.all1 if total else None).cast("long"), "kinds1": F.lit(total.kinds1 if total else 0).cast("long")})
        lowest = found.withColumn("p1", level(1, self.one, F.lit(1.0 / self.size)))
        lower = lowest.withColumn("p2", level(2, self.two, F.col("p1")))
        return lower.select(*rows.columns, level(3, self.three, F.col("p2")).alias("p"))

    def table(self) -> DataFrame:
        """``(u, v, w, p)`` of all that was seen."""
        return self.probabilities(self.three.counts.select("u", "v", "w"))

    def likelihood(self, sequences: DataFrame, ids: str = "ids") -> DataFrame:
        """``(doc_id, n, log_p)``: the ids after the first of each sequence and the sum of their logarithms.

        Equal rows of a sequence are looked up once. Sequences without such ids have no row.
        """
        counts = trigrams(sequences, ids).groupBy("doc_id", "u", "v", "w").agg(F.count("*").alias("n"))
        return self.probabilities(counts).groupBy("doc_id").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.log("p")).alias("log_p"))
