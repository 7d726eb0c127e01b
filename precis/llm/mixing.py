"""Mix sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import numbered, restored

#: A mean above this is drawn as the sum of equal parts, so that exp(-mean) stays a normal number.
PART = 64.0
#: Sources up to which their table (1.5 KB a source at most) is sent to all tasks.
MOST_BROADCAST = 10_000
SALTS = 64
#: Copies of one row without an id that one task makes at a time.
COPIES = 1 << 12


def source_rates(
    docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, alpha: float = 0.5
) -> tuple[DataFrame, int]:
    """source, rate (the mean number of copies of each of its documents), and the number of sources.

    ``weights`` (source, weight) has the target share of each source; sources that
    it lacks, or gives a null or negative weight, get none. Without it a source's
    weight is its number of documents to the power ``alpha``. The mix has
    ``epochs`` times the documents of the input on average. A null source is a source.
    """
    at = docs.columns.index("source")
    source = docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).select(F.col(f"c{at}").cast("string").alias("source"))
    counts = source.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        given = weights.groupBy(F.col("source").alias("s")).agg(F.greatest(F.sum("weight"), F.lit(0.0)).alias("weight"))
        weighed = counts.join(given, counts["source"].eqNullSafe(given["s"]), "left").select(
            "source", "n", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight"))
    # Three numbers; the decimal makes the sum the same in any order.
    weight = F.sum(F.col("weight").cast("decimal(38,9)")).cast("double")
    total = weighed.agg(F.sum("n").alias("n"), weight.alias("weight"), F.count(F.lit(1)).alias("sources")).first()
    scale = float(epochs) * total.n / total.weight if total.weight else 0.0
    return weighed.select("source", (F.col("weight") * F.lit(scale) / F.col("n")).alias("rate")), total.sources


def uniform(*parts: Column) -> Column:
    """A number from 0 to below 1 that depends on the given columns alone: 52 bits of a digest."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _cdf(mean: Column) -> Column:
    """Cumulative probabilities for 0, 1, 2 ... copies, until they are 1 but for rounding."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    zero = F.exp(-mean)
    start = F.struct(zero.alias("p"), zero.alias("c"), F.array(zero).alias("all"))

    def more(a: Column, k: Column) -> Column:
        p = a["p"] * mean / k
        return F.struct(p.alias("p"), (a["c"] + p).alias("c"), F.concat(a["all"], F.array(a["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, more)["all"]


def poisson_tables(rates: DataFrame) -> DataFrame:
    """source, rate, parts, cdf: what a draw of each source needs."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))
    return rates.select("source", "rate", parts.alias("parts")).select(
        "*", _cdf(F.col("rate") / F.col("parts")).alias("cdf"))


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with ``name``, what draws and order keys depend on: the id as text.

    Rows without an id get a digest of all their columns and, as equal rows of that kind
    are documents too, their number among those. Equal rows travel as one with a count,
    and come apart again block by block, so that many copies fill no task.
    """
    lost = rows.where("doc_id is null")
    digest = F.md5(F.to_json(F.struct(*(F.col(c) for c in rows.columns))))
    once = lost.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times")).withColumn("digest", digest)
    blocks = once.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / COPIES))))
    nth = F.explode(F.sequence(F.col("block") * COPIES + 1, F.least((F.col("block") + 1) * COPIES, "times")))
    each = blocks.repartition("digest", "block").withColumn("nth", nth)
    return rows.where("doc_id is not null").withColumn("name", F.col("doc_id").cast("string")).unionAll(
        each.select(*rows.columns, F.concat_ws("|", F.lit("null"), "digest", "nth")))


def _replicated(
    docs: DataFrame, rows: DataFrame, source: Column, weights: DataFrame | None, epochs: float, alpha: float,
    seed: str, most_broadcast: int,
) -> DataFrame:
    """``rows`` with n_copies, copy (from 1) and order_key, one row for each copy."""
    rates, n_sources = source_rates(docs, weights, epochs, alpha)
    tables = poisson_tables(rates).withColumnRenamed("source", "t_source")
    same, rows = source.eqNullSafe(F.col("t_source")), _named(rows)
    if n_sources <= most_broadcast:
        joined = rows.join(F.broadcast(tables), same)
    else:
        # Each source is SALTS keys, so that one with a third of all rows fills no task.
        salted = tables.withColumn("t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("name", "k2"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(salted, same & (F.col("salt") == F.col("t_salt"))).drop("salt", "t_salt")
    draws = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda part: uniform(F.lit(seed), F.col("name"), part))
    n = F.aggregate(draws, F.lit(0), lambda n, u: n + F.aggregate("cdf", F.lit(0), lambda k, c: k + (c <= u).cast("int")))
    drawn = joined.withColumn("n_copies", F.when(F.col("rate") > 0, n).otherwise(0)).drop("cdf", "parts", "rate", "t_source")
    copies = drawn.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col("name"), F.col("copy").cast("string")))
    return copies.withColumn("order_key", key)


def mix(
    docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, alpha: float = 0.5, seed: str = "mix",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Copies of documents so that sources have their target weights, globally shuffled.

    Each document gets a Poisson number of copies with its source's rate as the
    mean (``source_rates``), found by inverting the distribution at a hash of seed
    and doc_id, so a run can be repeated. The copies are sorted by a digest of
    seed, document and copy number. Rows with equal doc_id draw alike if their
    sources are alike. Rows without doc_id each draw on their own, by a digest of the
    row and, where equal rows stand several times, by their number. Texts may be null,
    empty or long, as they are only carried. An empty table gives none.

    Returns doc_id, source, text, n_copies, copy, order_key in shuffled order.
    """
    at = docs.columns.index("source")
    rows = numbered(docs).select("doc_id", "text", "k2", F.col(f"c{at}").cast("string").alias("source"))
    mixed = _replicated(docs, rows, F.col("source"), weights, epochs, alpha, seed, most_broadcast)
    return mixed.orderBy("order_key").select(
        "doc_id", "source", "text", F.col("n_copies").cast("long"), F.col("copy").cast("long"), "order_key")


def mixed_documents(
    docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, alpha: float = 0.5, seed: str = "mix",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """The copies of ``mix`` in shuffled order, with the columns of ``docs``."""
    at = docs.columns.index("source")
    rows, source = numbered(docs), F.col(f"c{at}").cast("string")
    mixed = _replicated(docs, rows, source, weights, epochs, alpha, seed, most_broadcast)
    return restored(mixed.orderBy("order_key"), docs)
