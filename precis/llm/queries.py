"""The operators over the given tables: one query each, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.llm import conversation_repair as conversations
from precis.llm import passage_quality as quality
from precis.llm import periodic_runs as runs
from precis.llm import pii
from precis.llm import secret_scan as secrets
from precis.llm.decontamination import decontaminate
from precis.llm.line_dedup import line_dedup
from precis.llm.language_id import fit, held_out, label_languages
from precis.llm.mixing import mix
from precis.llm.near_dedup import Settings, near_dedup
from precis.llm.substring_dedup import substring_dedup
from precis.llm.vector_search import search
from precis.llm.warc_revisits import captures, resolve_revisits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), Settings(words=2))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = label_languages(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.fit(docs))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    return found.select(
        "doc_id", *(count(i) for i in range(len(pii.KINDS))), F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.concat("base", "added")).alias("spans"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id", *(count(k) for k in secrets.BASE), F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    fields = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return done.select(
        "record_id", "site", "state", "response_id", F.array_join(fields, "|").alias("headers"),
        F.sha2("payload", 256).alias("payload_sha256"))


def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mix(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "source", "n_copies", "copy", "order_key", F.sha2("text", 256).alias("text_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = runs.periodic_runs(runs.planted(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("col1"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return done.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").cast("long").alias("start"),
        (-F.col("best.col1")).cast("long").alias("length"), F.col("best.period").cast("long").alias("period"),
        F.floor(-1000 * F.col("best.col1").cast("long") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    said, audit = conversations.repair(conversations.damaged(given))
    line = F.struct("place", F.concat_ws(":", "role", "text").alias("line"))
    texts = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    every = given.select("conv_id").distinct()

    def same(other: DataFrame):
        return every["conv_id"].eqNullSafe(other["conv_id"])

    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = every.join(audit, same(audit), "left").join(texts, same(texts), "left")
    return joined.select(
        every["conv_id"], *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce(F.array_join("lines.line", "\n"), F.lit("")), 256).alias("repaired_sha256"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return done.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_near_dedup, op3_substring_dedup, op4_language_id, op5_vector_search, op6_pii,
        op7_secret_scan, op8_benchmark_decontamination, op9_warc_revisits, op10_poisson_mixing, op11_periodic_runs,
        op12_conversation_repair, op13_quality_classifier,
    )
}
