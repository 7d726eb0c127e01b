"""Appends that are repeated or meet each other, and streams against the same work in one batch."""

import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from precis.functions.text import clean_text
from precis.operators.vocabulary import word_freq
from precis.sources import commits, pairs
from precis.streaming import tables

SCHEMA = "doc_id long, texto string, resumen string"


def some(spark, first, n):
    return spark.createDataFrame([(i, f"text {i}", "s") for i in range(first, first + n)], SCHEMA)


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert pairs.append_pairs(some(spark, 0, 3), path, token="job-7") == 3
    assert pairs.append_pairs(some(spark, 0, 3), path, token="job-7") == 3
    assert pairs.append_pairs(some(spark, 0, 3), path, token="job-8") == 6
    assert pairs.append_pairs(some(spark, 0, 3), path) == 9
    keys = [r.doc_id for r in spark.read.parquet(path).collect()]
    assert len(set(keys)) == 9 and {k.rsplit("-", 1)[0] for k in keys} == {"job-7", "job-8", "0"}
    with pytest.raises(ValueError, match="token"):
        pairs.append_pairs(some(spark, 0, 1), path, token="7")
    assert list((tmp_path / "t" / "_staging").iterdir()) == []


def test_two_writers_between_each_other(spark, tmp_path):
    """The second one begins and ends while the first one writes."""
    path, order = str(tmp_path / "t"), []

    def slow(name):
        order.append(name)
        commits.add_batch(spark, path, lambda n: order.append(n) or some(spark, 0, 2).withColumn("by", F.lit(n)))
        return some(spark, 0, 3).withColumn("by", F.lit(name))

    assert commits.add_batch(spark, path, slow)
    assert order == ["0", "1"]
    assert Counter(r.by for r in spark.read.parquet(path).collect()) == {"0": 3, "1": 2}
    # With one token, the one that ends first counts, whole.
    assert not commits.add_batch(spark, path, lambda n: (
        commits.add_batch(spark, path, lambda m: some(spark, 0, 4).withColumn("by", F.lit("inner")), "x")
        and some(spark, 0, 9).withColumn("by", F.lit("outer"))), "x")
    assert Counter(r.by for r in spark.read.parquet(path).collect()) == {"0": 3, "1": 2, "inner": 4}


def test_many_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    folder = commits.Folder(spark, path)
    claimed = []
    threads = [threading.Thread(target=lambda: claimed.extend(commits.next_number(folder) for _ in range(5))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(int, claimed)) == list(range(30))


def test_a_failed_write_leaves_no_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    pairs.append_pairs(some(spark, 0, 2), path)
    broken = some(spark, 0, 2).withColumn("texto", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        pairs.append_pairs(broken, path, token="broken")
    assert pairs.append_pairs(some(spark, 5, 1), path, token="broken") == 3


def test_streams_equal_batches_after_a_restart(spark, tmp_path):
    given = [some(spark, 10 * i, 6).withColumn("texto", F.concat_ws(" ", "texto", F.lit("y más y más"))) for i in range(4)]
    inbox, out, counts = (str(tmp_path / x) for x in ("inbox", "out", "counts"))

    def arrive(df):
        df.coalesce(1).write.mode("append").parquet(inbox)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox)
        tables.append_stream(stream, out, str(tmp_path / "state1"), "in").start().awaitTermination()
        texts = stream.select("doc_id", clean_text("texto").alias("clean"))
        tables.word_freq_stream(texts, "clean", counts, str(tmp_path / "state2")).start().awaitTermination()

    for df in given[:2]:
        arrive(df)
    run()
    run()  # nothing new
    for df in given[2:]:
        arrive(df)
    # Spark lost the note that batch 1 was done: it is repeated, and adds nothing.
    for state in ("state1", "state2"):
        for name in ("1", ".1.crc"):
            (tmp_path / state / "commits" / name).unlink(missing_ok=True)
    run()
    every = given[0].unionAll(given[1]).unionAll(given[2]).unionAll(given[3])
    got = spark.read.parquet(out)
    assert sorted((int(r.doc_id.rsplit("-", 1)[1]), r.texto) for r in got.collect()) == sorted((r.doc_id, r.texto) for r in every.collect())
    assert len({r.doc_id for r in got.collect()}) == 24
    batch = word_freq(every.select("doc_id", clean_text("texto").alias("clean")), "clean")
    assert sorted(map(tuple, tables.read_word_freq(spark, counts).collect())) == sorted(map(tuple, batch.collect()))
