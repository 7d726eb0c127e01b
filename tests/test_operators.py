import math
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from precis.functions.chars import STOPWORDS
from precis.functions.text import tokens
from precis.operators import decoding, encoding, evaluation, filters, importance, lookup
from precis.operators import ranking, salience, splits, statistics, tfidf
from precis.operators import rows as rows_of
from precis.operators import vocabulary as vb
from precis.operators.rows import unroll
from precis.plans import summaries, training_data
from precis.settings import DEFAULTS
from precis.sources import lines, pairs
from precis.sources.storage import scratch_path
from tests.samples import sample_pairs

CATS = ["el gato está en el tejado", "el perro corre por el parque", "el gato y el perro son amigos"]
WORDS = "está en tejado corre por parque y son amigos".split()
SIX = (
    "El gato negro duerme mucho. La lluvia cae sobre el tejado rojo. El gato negro mira la lluvia. "
    "Nadie sabe cuando vuelve el perro. El perro ladra fuerte en casa. "
    "Gato y perro comparten la misma casa vieja."
)
# No table counts as small: lookups take the way for large tables.
TINY = replace(DEFAULTS, broadcast_rows=0, hot_rows=2)


def texts(spark, rows, name="text"):
    return spark.createDataFrame(list(enumerate(rows)), f"doc_id long, {name} string")


@pytest.fixture(scope="module")
def cats(spark):
    return texts(spark, CATS)


@pytest.fixture(scope="module")
def vocab(cats):
    return vb.fit_vocabulary(cats, "text", 100)


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


# --- vocabulary and sequences -----------------------------------------------


def test_vocabulary_golden(vocab, cats):
    expected = ["<PAD>", "<UNK>", "<START>", "<END>", "el", "gato", "perro", *WORDS]
    assert as_dict(vocab.table, "token", "id") == {w: i for i, w in enumerate(expected)}
    assert vocab.tokens.n_rows == 16
    small = vb.vocabulary(vb.word_freq(cats, "text"), 6)
    assert {r.token for r in small.collect()} == {*expected[:6]}
    with pytest.raises(ValueError):
        vb.vocabulary(vb.word_freq(cats, "text"), 3)


def test_word_freq_counts_and_places(spark):
    rows = ["b a b", "", "a c c c", None]
    found = {r.word: (r.freq, r.first_doc, r.first_rank) for r in vb.word_freq(texts(spark, rows), "text").collect()}
    assert found == {"b": (2, 0, 0), "a": (2, 0, 1), "c": (3, 2, 1)}


def test_word_freq_merge_keeps_the_older_place(spark):
    old = vb.word_freq(texts(spark, ["x y"]), "text")
    new = vb.word_freq(texts(spark, ["z y"]), "text", batch=1)
    merged = vb.word_freq_merge(old, new)
    assert [r.word for r in vb.top_words(merged, 3).collect()] == ["y", "x", "z"]
    assert as_dict(merged, "word", "freq") == {"x": 1, "y": 2, "z": 1}


@pytest.mark.parametrize("settings", [DEFAULTS, TINY])
def test_encode_decode(spark, vocab, settings):
    df = texts(spark, [CATS[0], "el león", "", None])
    ids = encoding.encode(df, "text", vocab, settings=settings)
    assert as_dict(ids, "doc_id", "ids") == {0: [4, 5, 7, 8, 4, 9], 1: [4, 1], 2: [], 3: []}
    marked = encoding.encode(df, "text", vocab, markers=True, settings=settings)
    assert as_dict(marked, "doc_id", "ids")[0] == [2, 4, 5, 7, 8, 4, 9, 3]
    seqs = spark.createDataFrame([(0, [2, 4, 1, 99, 3, 0]), (1, [])], "doc_id long, seq array<int>")
    plain = encoding.decode(seqs, "seq", vocab, settings=settings)
    assert as_dict(plain, "doc_id", "text") == {0: "el <UNK> <UNK>", 1: ""}
    full = encoding.decode(seqs, "seq", vocab, keep_specials=True, settings=settings)
    assert as_dict(full, "doc_id", "text")[0] == "<START> el <UNK> <UNK> <END> <PAD>"


def test_roundtrips(spark, cats, vocab):
    ids = encoding.encode(cats, "text", vocab)
    back = encoding.decode(ids, "ids", vocab)
    assert as_dict(back, "doc_id", "text") == dict(enumerate(CATS))
    path = scratch_path(spark, "vocabulary")
    vocab.save(path)
    loaded = vb.Vocabulary.load(spark, path)
    assert as_dict(encoding.encode(cats, "text", loaded), "doc_id", "ids") == as_dict(ids, "doc_id", "ids")


def test_lookup_of_a_large_table_equals_the_plain_join(spark):
    # One key holds a third of all rows.
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("word")
    )
    table = rows.groupBy("word").agg(F.count("*").alias("df")).where("word <> 'w7'")
    sized = lookup.Sized.store(table, "word")
    assert not sized.is_small(TINY) and sized.is_small()
    found = lookup.lookup(rows, sized, F.col("df"), TINY)
    plain = rows.join(table, "word", "left")
    assert sorted(found.collect(), key=repr) == sorted(plain.collect(), key=repr)
    # Keys that are null, or settled by the hot table, go to all partitions.
    nulls = spark.range(800).select(F.when(F.col("id") % 8 == 0, "w1").alias("word"), "id")
    far = lookup.lookup(nulls, sized, F.col("df"), TINY).where("word is null")
    spread = far.select(F.pmod(F.hash(F.lit(None).cast("string"), F.xxhash64("word", "id")), F.lit(8)).alias("p")).distinct()
    assert far.count() == 700 and spread.count() == 8
    assert [r.word for r in lookup.hot_keys(table, "word", F.col("df"), TINY).collect()][0] == "hot"


def test_hot_keys_keep_to_the_byte_limit(spark):
    table = spark.createDataFrame([("a" * 100, 3), ("b" * 100, 2), ("c", 1)], "word string, df long")
    cut = lookup.hot_keys(table, "word", F.col("df"), replace(DEFAULTS, broadcast_bytes=140))
    assert [r.df for r in cut.collect()] == [3]


def test_large_lookups_read_their_rows_once(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tiny = replace(TINY, hot_rows=20)
    idf = tfidf.fit_idf(tfidf.word_lists(docs))
    scores = tfidf.sentence_tfidf(tfidf.sentence_rows(docs), idf, tiny)
    scores.collect()
    plan = scores._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    plain = tfidf.sentence_tfidf(tfidf.sentence_rows(docs), idf)
    rounded = lambda df: sorted((r.doc_id, r.idx, round(r.score, 9)) for r in df.collect())
    assert rounded(scores) == rounded(plain)


def test_sums_of_a_large_lookup(spark):
    names = ["hot", "warm", "cold", "new", None]
    data = [(i // 12, i % 3, i % 5, names[i % 7 % 5]) for i in range(240)]
    rows = spark.createDataFrame(data, "doc_id long, idx int, n int, word string")
    table = spark.createDataFrame([("hot", 90, 1.5), ("warm", 40, -2.0), ("cold", 1, 0.25), ("chill", 1, 9.0), (None, 9, 7.0)],
                                  "word string, df long, idf double")
    sized = lookup.Sized.store(table, "word")
    idf, expected = {"hot": 1.5, "warm": -2.0, "cold": 0.25}, {}
    for doc, idx, n, word in data:
        total, most = expected.get((doc, idx), (0.0, 0))
        expected[doc, idx] = total + idf.get(word, 0.0), max(most, n)
    # All, two and none of the keys are broadcast; keys of one weight go together.
    for settings, heavy in ((DEFAULTS, 4), (replace(DEFAULTS, broadcast_rows=3), 2), (TINY, 0)):
        assert lookup.heavy_keys(table, "word", F.col("df"), settings).count() == heavy
        sums = lookup.lookup_sums(rows, sized, F.col("df"), "idf", ["doc_id", "idx"], "n", settings)
        assert {(r.doc_id, r.idx): (r.total, r.n) for r in sums.collect()} == expected


# --- TF-IDF -----------------------------------------------------------------


@pytest.mark.parametrize("settings", [DEFAULTS, TINY])
def test_tfidf_golden(spark, cats, settings):
    lists = cats.select("doc_id", tokens("text").alias("words"))
    idf = tfidf.fit_idf(lists)
    found = as_dict(idf.table, "word", "idf")
    assert found["el"] == pytest.approx(math.log(3 / 4))
    assert found["gato"] == found["perro"] == 0.0
    assert found["tejado"] == pytest.approx(0.405465, abs=1e-6)
    sentences = spark.createDataFrame(
        [(0, i, t.split()) for i, t in enumerate(CATS)] + [(1, 0, []), (1, 1, ["nunca", "tejado"])],
        "doc_id long, idx int, words array<string>",
    )
    scores = tfidf.sentence_tfidf(sentences, idf, settings)
    by_place = {(r.doc_id, r.idx): r.score for r in scores.collect()}
    assert by_place[0, 0] == pytest.approx(0.106839, abs=1e-6)
    assert by_place[0, 1] == pytest.approx(0.106839, abs=1e-6)
    assert by_place[0, 2] == pytest.approx(0.091576, abs=1e-6)
    assert by_place[1, 0] == 0.0
    assert by_place[1, 1] == pytest.approx(math.log(1.5) / 2)
    top = tfidf.tfidf_top_n(scores.where("doc_id = 0"), 2).orderBy("rank").collect()
    assert [r.idx for r in top] == [1, 0]


def test_threshold_top_n(spark):
    scores = spark.createDataFrame(
        [(0, 0, 0.5), (0, 1, 0.9), (0, 2, 0.4), (0, 3, 0.9)], "doc_id long, idx int, score double")
    found = ranking.threshold_top_n(scores, 2).orderBy("rank").collect()
    assert [(r.idx, r.rank) for r in found] == [(3, 1), (1, 2)]
    assert {r.idx for r in ranking.threshold_top_n(scores, 9).collect()} == {0, 1, 3}


# --- extractive summaries ---------------------------------------------------


def brute_scores(fragments):
    """Scores of one text's fragments, straight from the formula."""
    split = [f.split() for f in fragments]
    long_words = [[w for w in ws if len(w) > 2] for ws in split]
    content = [[w for w in ws if w not in STOPWORDS] for ws in long_words]
    df = Counter(w for ws in long_words for w in set(ws))
    freq = Counter(w for ws in content for w in ws)
    important = {w for w, _ in freq.most_common(max(5, len(freq) // 5))}
    scores = []
    for words, cont in zip(split, content):
        if not cont:
            scores.append(0.0)
            continue
        m = len(cont)
        weight = sum(c / m * math.log(len(split) / (1 + df[w])) for w, c in Counter(cont).items())
        u = len(set(cont) & important)
        scores.append((0.7 * weight / m + 0.3 * u / m) * max(0.5, 1 - abs(len(words) - 10) / 20))
    return scores


def test_six_sentences_golden(spark):
    df = texts(spark, [SIX])
    rows = importance.fragment_rows(importance.fragment_lists(df))
    words = importance.important_words(importance.fragment_word_freq(rows))
    assert {r.word for r in words.collect()} == {"gato", "perro", "negro", "lluvia", "casa"}
    scores = [r.score for r in importance.fragment_importance(rows).orderBy("idx").collect()]
    assert scores == pytest.approx(
        [0.278171, 0.212090, 0.281163, 0.189546, 0.235354, 0.218998], abs=1e-6)
    found = summaries.extractive_summary(df).first()
    assert found.summary == (
        "el gato negro duerme mucho. el gato negro mira la lluvia. el perro ladra fuerte en casa."
    )
    assert (found.n_fragments, found.n_kept) == (6, 3)


def test_sample_pairs_golden(spark):
    p = sample_pairs(spark)
    scores = importance.fragment_importance(
        importance.fragment_rows(importance.fragment_lists(p, "texto")))
    kept = as_dict(ranking.rank_then_restore(scores), "doc_id", "kept")
    assert kept == {0: [1, 2], 1: [0, 1], 2: [0, 2], 3: [0, 1, 2], 4: [0, 1]}
    first = [r.score for r in scores.where("doc_id = 3").orderBy("idx").collect()]
    assert first == pytest.approx([0.258415, 0.080867, 0.076824, 0.061706], abs=1e-6)


def test_scores_equal_brute_force_on_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = importance.fragment_rows(importance.fragment_lists(docs)).cache()
    fragments = {}
    for r in rows.select("doc_id", "idx", "fragment").orderBy("doc_id", "idx").collect():
        fragments.setdefault(r.doc_id, []).append(r.fragment)
    found = {}
    for r in importance.fragment_importance(rows).orderBy("doc_id", "idx").collect():
        found.setdefault(r.doc_id, []).append(r.score)
    rows.unpersist()
    assert found.keys() == fragments.keys()
    for doc_id, parts in fragments.items():
        assert found[doc_id] == pytest.approx(brute_scores(parts), abs=1e-9), doc_id


def test_short_texts_get_a_closing_dot(spark):
    found = as_dict(
        summaries.extractive_summary(texts(spark, ["", None, "hola mundo\nadiós", "uno."])),
        "doc_id", "summary")
    assert found == {0: "", 1: "", 2: "hola mundo. adiós.", 3: "uno.."}


def test_summary_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = sorted(summaries.extractive_summary(docs).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert sorted(summaries.extractive_summary(docs.repartition(16)).collect()) == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def exchanges(df):
    """Shuffles in the plan that ran, and no join."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan
    return plan.count("Exchange hashpartitioning")


def test_summary_needs_one_exchange(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = summaries.extractive_summary(docs)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # the second is the reused one
    assert plan.count("FileScan") == 1


def test_united_summaries_travel_once(spark):
    """Each strategy shuffles its texts once, also as a part of a union; scores of sentences find their texts in place."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = summaries.summarize(docs, "extractive").unionByName(summaries.summarize(docs, "tfidf"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by_text = [x for x in plan.split("\n") if "REPARTITION_BY_NUM" in x and ("sentences" in x or "fragments" in x or "ReusedExchange" not in x)]
    reused = sum("ReusedExchange" in x for x in by_text)
    # Of extractive one and its reuse; of tfidf the same, and one of the kept places, which are small.
    assert reused == 2 and len(by_text) - reused <= 3
    unkeyed = spark.createDataFrame([(None, "Una frase. Otra frase."), (1, "Una frase."), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.summary) for r in summaries.summarize(unkeyed, "tfidf").collect())
    assert [x[1] for x in got[:2]] == ["", ""] and got[2][0] == 1 and got[2][1]


def test_layout_has_more_tasks_for_more_text(spark, monkeypatch):
    monkeypatch.setattr(rows_of, "TASK_BYTES", 100)
    rows = [SIX, None, ""] * 20
    df = texts(spark, rows)
    wanted = math.ceil(20 * len(SIX.encode()) / 100)
    assert rows_of.n_tasks(df, "text") == wanted and rows_of.n_tasks(df.limit(0), "text") == spark.sparkContext.defaultParallelism
    lists = importance.fragment_lists(df)
    assert lists.rdd.getNumPartitions() == wanted
    # Still one exchange: counts by document and word find their rows in place.
    assert exchanges(importance.important_words(importance.fragment_word_freq(importance.fragment_rows(lists)))) == 1
    assert exchanges(tfidf.term_freq(tfidf.sentence_rows(df, colocate=True))) == 1
    assert tfidf.sentence_rows(df, colocate=True).rdd.getNumPartitions() == wanted


def test_keep_important_and_stopwords(spark):
    rows = importance.fragment_rows(importance.fragment_lists(texts(spark, [SIX])))
    content = importance.drop_stopwords(importance.long_word_rows(rows))
    assert not {r.word for r in content.collect()} & set(STOPWORDS)
    kept = importance.keep_important(rows)
    assert exchanges(kept) == 1
    assert Counter(r.word for r in kept.collect()) == {"gato": 3, "perro": 3, "negro": 2, "lluvia": 2, "casa": 2}


def test_strategies(spark):
    df = texts(spark, [SIX, "Uno dos tres. Cuatro cinco seis.", ""])
    assert {r.summary for r in summaries.summarize(df, "tfidf").where("doc_id = 2").collect()} == {""}
    assert summaries.summarize(df).count() == 3
    with pytest.raises(ValueError, match="unknown strategy"):
        summaries.summarize(df, "magic")
    with pytest.raises(ValueError, match="needs a decoder"):
        summaries.summarize(df, "greedy")


def test_summarize_and_log(spark):
    path = scratch_path(spark, "log")
    df = texts(spark, [SIX, "demasiado corto"])
    assert summaries.summarize_and_log(df, path) == 1
    assert summaries.summarize_and_log(df, path) == 2
    assert {r.source for r in spark.read.parquet(path).collect()} == {"summary"}
    log = summaries.summary_log(df)
    log.collect()
    plan = log._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Join") == 1


# --- sources ----------------------------------------------------------------


def test_words_beyond_the_length_are_not_shuffled(spark, vocab):
    df = texts(spark, ["el gato " * 50, None, "", "perro"])
    ids = encoding.encode(df, "text", vocab, keep=3, tasks=5)
    whole = encoding.encode(df, "text", vocab)
    assert as_dict(ids, "doc_id", "ids") == {k: v[:3] for k, v in as_dict(whole, "doc_id", "ids").items()}
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("slice(")


def test_csv_pairs(spark, tmp_path):
    file = tmp_path / "pairs.csv"
    file.write_text('texto,resumen\n"uno ""dos""\ntres",NA\n  x ,"a, b"\n', encoding="utf-8")
    found = {(r.texto, r.resumen) for r in pairs.read_pairs(spark, str(file)).collect()}
    assert found == {('uno "dos"\ntres', None), ("  x ", "a, b")}
    missing = pairs.read_pairs(spark, str(tmp_path / "none.csv"))
    assert missing.count() == 0 and missing.columns == ["doc_id", "texto", "resumen"]


def test_append_and_split_tables(spark, tmp_path):
    path = str(tmp_path / "table")
    assert pairs.read_table(spark, path) is None
    p = sample_pairs(spark)
    assert pairs.append_pairs(p, path) == 5
    assert pairs.append_pairs(p.limit(2), path, source="summary") == 7
    assert pairs.read_table(spark, path).where("source = 'summary'").count() == 2
    keys = [r.doc_id for r in spark.read.parquet(path).collect()]
    assert len(set(keys)) == 7
    with pytest.raises(ValueError, match="unique"):
        pairs.append_pairs(p.unionAll(p), path)
    with pytest.raises(ValueError, match="unique"):
        pairs.append_pairs(p.withColumn("doc_id", F.lit(None).cast("long")), path)
    blank = spark.createDataFrame([(0, " ", "x"), (1, "x", "y")], "doc_id long, texto string, resumen string")
    assert pairs.append_pairs(blank, path, valid_only=True) == 8
    split_path = str(tmp_path / "split")
    pairs.write_split(splits.split_exact(p), split_path)
    assert as_dict(splits.count_rows(spark.read.parquet(split_path)), "split", "n") == {
        "train": 4, "validation": 1}


def test_assemble_lines(spark):
    entered = {
        0: ["", " ", "a ", " b", "", "c"], 1: ["x"], 2: ["", ""], 3: ["p", " ", "q", "", "r"],
    }
    rows = [(d, i, t) for d, ts in entered.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, line string")
    assert exchanges(lines.assemble_lines(df)) == 1
    found = as_dict(lines.assemble_lines(df), "doc_id", "text")
    assert found == {0: "a   b", 1: "x", 3: "p"}


# --- filters and splits -----------------------------------------------------


def test_filters(spark):
    p = spark.createDataFrame(
        [(0, "a", "b"), (1, " 　", "b"), (2, "a", None), (3, "c", "d")],
        "doc_id long, texto string, resumen string")
    assert {r.doc_id for r in filters.valid_pairs(p).collect()} == {0, 3}
    assert filters.min_rows_check(p).first() == (4, True)
    last = filters.last_rows(p).orderBy("number").collect()
    assert [(r.number, r.doc_id) for r in last] == [(2, 1), (3, 2), (4, 3)]
    short = filters.min_words_filter(texts(spark, ["a " * 9, "a " * 10]), "text")
    assert [r.doc_id for r in short.collect()] == [1]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 999, 3000])
def test_split_exact(spark, n):
    found = splits.split_exact(spark.range(n).withColumnRenamed("id", "doc_id"))
    sizes = as_dict(splits.count_rows(found), "split", "n")
    assert sizes.get("train", 0) == round(0.8 * n)
    assert sizes.get("train", 0) + sizes.get("validation", 0) == n


def test_split_is_stable_and_seeded(spark):
    ids = spark.range(500).withColumnRenamed("id", "doc_id")
    one = as_dict(splits.split_exact(ids), "doc_id", "split")
    assert one == as_dict(splits.split_exact(ids.repartition(5)), "doc_id", "split")
    assert one != as_dict(splits.split_exact(ids, seed=7), "doc_id", "split")
    hashed = as_dict(splits.split_hash(ids), "doc_id", "split")
    part = as_dict(splits.split_hash(ids.where("doc_id < 100")), "doc_id", "split")
    assert part == {k: v for k, v in hashed.items() if k < 100}
    assert 350 < sum(v == "train" for v in hashed.values()) < 450


def test_fallback_and_holdout(spark):
    ids = spark.range(10).withColumnRenamed("id", "doc_id")
    both = splits.split_fallback(ids, None)
    assert as_dict(splits.count_rows(both), "split", "n") == {"train": 8, "validation": 2}
    given = splits.split_fallback(ids, spark.range(3).withColumnRenamed("id", "doc_id"))
    assert as_dict(splits.count_rows(given), "split", "n") == {"train": 10, "validation": 3}
    rest = filters.holdout_rest(ids, both.where("split = 'train'"))
    assert {r.doc_id for r in rest.collect()} == {r.doc_id for r in both.where("split = 'validation'").collect()}


# --- statistics and evaluation ----------------------------------------------


def test_length_stats(spark):
    df = texts(spark, ["a " * 5, "a " * 11, "a " * 17])
    row = statistics.length_stats(df, "text").first()
    assert tuple(row)[:5] == (3, 11.0, 11.0, 5, 17)
    assert row.std == pytest.approx(4.898979, abs=1e-6)
    empty = statistics.length_stats(df.limit(0), "text").first()
    assert (empty.n, empty.mean) == (0, None)


def test_histogram(spark):
    df = texts(spark, ["a " * n for n in (1, 1, 16, 31)])
    bins = as_dict(statistics.length_histogram(df, "text"), "bin", "n")
    assert len(bins) == 30 and {b: n for b, n in bins.items() if n} == {1: 2, 16: 1, 30: 1}
    same = statistics.length_histogram(texts(spark, ["a b", "c d"]), "text").where("n > 0").first()
    assert (same.bin, same.n) == (16, 2)
    assert statistics.length_histogram(df.limit(0), "text").count() == 0


def test_boxplot(spark):
    df = texts(spark, ["a " * n for n in (1, 2, 3, 4, 5, 100)])
    row = statistics.length_boxplot(df, "text").first()
    assert tuple(row) == (2.25, 3.5, 4.75, 1.0, 5.0, 1)


def test_reports(spark):
    history = spark.createDataFrame(
        [(0, 3.0, 3.5, 0.1, 0.2), (1, 2.0, 2.5, 0.5, 0.4), (2, 1.5, 2.75, 0.6, 0.3)],
        "epoch int, loss double, val_loss double, accuracy double, val_accuracy double")
    assert tuple(evaluation.training_report(history).first()) == (3, 1.5, 2.75, 0.6, 0.3, 2.5, 0.4)
    scored = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.6), (0, 0.1)], "y int, s double")
    assert tuple(evaluation.binary_metrics(scored, "y", "s").first()) == (4, 0.5, 0.5, 0.5)
    seqs = spark.createDataFrame([([1, 2, 0], [1, 3, 0])], "p array<int>, t array<int>")
    assert tuple(evaluation.token_accuracy(seqs, "p", "t").first())[:2] == (3, 2)
    assert tuple(evaluation.token_accuracy(seqs, "p", "t", ignore_pad=True).first())[:2] == (2, 1)


# --- training data and decoding ---------------------------------------------


def test_appended_twice_and_logged_stays_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    p = sample_pairs(spark)
    pairs.append_pairs(p, path)
    pairs.append_pairs(p, path)
    summaries.summarize_and_log(p.withColumnRenamed("texto", "text"), path)
    table = spark.read.parquet(path)
    books = training_data.fit_two_vocabularies(table)
    assert table.count() == training_data.prepare_seq2seq(table, *books).count() == 15
    halves = as_dict(splits.count_rows(splits.split_exact(table, 0.6)), "split", "n")
    assert halves == {"train": 9, "validation": 6}


def test_read_pairs_has_the_same_keys_for_any_layout(spark, tmp_path):
    p = sample_pairs(spark).unionAll(sample_pairs(spark))
    seen = []
    for n in (1, 16):
        path = str(tmp_path / f"csv{n}")
        pairs.write_pairs_csv(p.repartition(n), path)
        rows = pairs.read_pairs(spark, path).collect()
        assert len({r.doc_id for r in rows}) == len(rows) == 10
        seen.append(sorted(tuple(r) for r in rows))
    assert seen[0] == seen[1]


@pytest.mark.parametrize("settings", [DEFAULTS, TINY])
def test_prepare_seq2seq(spark, settings):
    p = spark.createDataFrame(
        [(0, "El gato come.", "gato come"), (1, "El perro", None), (2, "otro", "gato")],
        "doc_id long, texto string, resumen string")
    books = training_data.fit_two_vocabularies(p.where("doc_id < 2"), settings)
    out = training_data.prepare_seq2seq(p, *books, 4, 4, settings)
    rows = {r.doc_id: (r.encoder_in, r.decoder_in, r.decoder_target) for r in out.collect()}
    assert rows[0] == ([4, 5, 6, 0], [2, 4, 5], [4, 5, 3])
    assert rows[1] == ([4, 7, 0, 0], [2, 3, 0], [3, 0, 0])
    assert rows[2] == ([1, 0, 0, 0], [2, 4, 3], [4, 3, 0])
    one = training_data.encode_for_inference(p, "texto", books[0], 2)
    assert as_dict(one, "doc_id", "encoder_in") == {0: [4, 5], 1: [4, 7], 2: [1, 0]}


def test_vocabularies_come_from_training_rows(spark):
    p = splits.split_exact(sample_pairs(spark))
    left_out = p.where("split = 'validation'").first()
    words = {r.token for r in training_data.fit_two_vocabularies(p)[1].table.collect()}
    train = " ".join(r.resumen.lower() for r in p.where("split = 'train'").collect()).split()
    assert words - {"<PAD>", "<UNK>", "<START>", "<END>"} == set(train)
    assert not set(left_out.resumen.lower().split()) <= words


PROBS = [(2, 4, 0.6), (2, 5, 0.4), (4, 3, 0.3), (4, 5, 0.7), (5, 3, 1.0)]


@pytest.fixture(scope="module")
def model(spark):
    return decoding.NextTokens(spark.createDataFrame(PROBS, "prev int, next int, p double"))


@pytest.mark.parametrize("settings", [DEFAULTS, TINY])
def test_beam_step(spark, model, settings):
    hyps = spark.createDataFrame(
        [(7, 1, [2], 0.0, False)], "doc_id long, hyp_id int, seq array<int>, score double, done boolean")
    expected = [
        [([2, 4], 0.6), ([2, 5], 0.4)],
        [([2, 4, 5], 0.42), ([2, 5, 3], 0.4)],
        [([2, 4, 5, 3], 0.42), ([2, 5, 3], 0.4)],
    ]
    for step in expected:
        hyps = decoding.beam_step(hyps, model.probs, 2, settings)
        found = [(r.seq, round(math.exp(r.score), 6)) for r in hyps.orderBy("hyp_id").collect()]
        assert found == step


def encoded(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")


def test_decoding_depends_on_the_whole_text(spark, model):
    # Two texts with the same first word decode differently.
    rows = encoded(spark, [[4, 5], [4, 9], []])
    assert as_dict(model.greedy(rows), "doc_id", "seq") == {0: [2, 4, 5], 1: [2, 4, 9], 2: [2]}
    beam = as_dict(model.beam_search(rows, 2), "doc_id", "seq")
    assert beam == {0: [2, 4, 5, 3], 1: [2, 4, 9, 3], 2: [2, 3]}
    assert as_dict(model.greedy(rows, 1), "doc_id", "seq")[0] == [2, 4]
    # Without a share of the text all texts go the corpus's way.
    assert set(map(tuple, as_dict(model.greedy(rows, share=0.0), "doc_id", "seq").values())) == {(2, 4, 5)}


def brute_beam(table, start, k, steps):
    beam = [([start], 0.0)]
    for _ in range(steps):
        grown = []
        for place, (seq, score) in enumerate(beam):
            options = sorted(table.get(seq[-1], {}).items(), key=lambda o: (o[1], o[0]))[-k:]
            if seq[-1] == 3 or not options:
                grown.append((-round(score, 10), place, -1, seq, score))
            for n, p in options if seq[-1] != 3 else []:
                total = score + math.log(p + 1e-10)
                grown.append((-round(total, 10), place, n, seq + [n], total))
        beam = [g[3:] for g in sorted(grown)[:k]]
    return beam[0]


def test_beam_search_equals_brute_force(spark):
    links = [(a, b, ((a * 7 + b * 3) % 11 + 1)) for a in (2, *range(4, 12)) for b in range(3, 12) if (a + b) % 4]
    totals = Counter()
    for a, _, w in links:
        totals[a] += w
    probs = [(a, b, w / totals[a]) for a, b, w in links]
    table = {}
    for a, b, p in probs:
        table.setdefault(a, {})[b] = p
    m = decoding.NextTokens(spark.createDataFrame(probs, "prev int, next int, p double"))
    rows = [[5, 6, 5, 7, 1, 9], [11, 4], [], [8, 8, 8, 10, 12]]
    found = {r.doc_id: (r.seq, r.score) for r in m.beam_search(encoded(spark, rows), 3, 6).collect()}
    for i, ids in enumerate(rows):
        steps = Counter((a, b) for a, b in zip([2, *ids], [*ids, 3]) if b != 1)
        mixed = {a: {b: p / 2 for b, p in nexts.items()} for a, nexts in table.items()}
        for (a, b), n in steps.items():
            total = sum(c for (x, _), c in steps.items() if x == a)
            mixed.setdefault(a, {})[b] = mixed.get(a, {}).get(b, 0.0) + n / total / 2
        seq, score = brute_beam(mixed, 2, 3, 6)
        assert found[i][0] == seq
        assert found[i][1] == pytest.approx(score)


def test_next_token_table(spark):
    samples = spark.createDataFrame(
        [(0, [2, 4, 5, 3], [4, 5, 3, 0]), (1, [2, 4, 3, 0], [4, 3, 0, 0])],
        "doc_id long, decoder_in array<int>, decoder_target array<int>")
    table = {(r.prev, r.next): r.p for r in decoding.next_token_table(samples).collect()}
    assert table == {(2, 4): 1.0, (4, 5): 0.5, (4, 3): 0.5, (5, 3): 1.0}
    predicted = decoding.NextTokens.fit(samples).predict(samples)
    assert as_dict(predicted, "doc_id", "predicted") == {0: [4, 3, 3, 0], 1: [4, 3, 0, 0]}


@pytest.mark.parametrize("settings", [DEFAULTS, TINY])
def test_salience(spark, tmp_path, settings):
    rows = [(i, 0, "gato bueno casa" if i % 2 else "perro malo calle", i % 2) for i in range(40)]
    rows += [(40, 0, None, 1), (41, 0, "raro", None), (42, 0, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, idx int, sentence string, label int")
    path = scratch_path(spark, "salience")
    salience.fit_salience(df).save(path)
    model = salience.Salience.load(spark, path)
    score = as_dict(salience.score_salience(model, df.drop("label"), settings), "doc_id", "score")
    assert all((score[i] > 0.5) == bool(i % 2) for i in range(40))
    assert score[40] == score[41] == score[42] == pytest.approx(0.5)
    # 61 words of either kind, 6 different ones.
    assert score[1] == pytest.approx(1 / (1 + math.exp(-3 * math.log(21 / 1))))
    # A word far behind counts like any other.
    long = spark.createDataFrame(
        [(0, 0, "nada " * 60 + "gato"), (1, 0, "nada " * 60 + "perro")], "doc_id long, idx int, sentence string")
    far = as_dict(salience.score_salience(model, long, settings), "doc_id", "score")
    assert far[0] > 0.5 > far[1]


def test_own_specials_and_bare_words(spark, cats):
    own = replace(DEFAULTS, special_tokens=("[P]", "[U]", "[S]", "[E]"))
    book = vb.fit_vocabulary(cats, "text", 100, specials=own.special_tokens)
    assert [r.token for r in book.table.orderBy("id").limit(4).collect()] == list(own.special_tokens)
    seqs = spark.createDataFrame([(0, [2, 4, 99])], "doc_id long, seq array<int>")
    assert as_dict(encoding.decode(seqs, "seq", book, settings=own), "doc_id", "text") == {0: "el [U]"}
    row = texts(spark, ["(casa), ¡sol! -- a.b ..."]).select(tokens("text", strip_punct=True).alias("w")).first()
    assert row.w == ["casa", "¡sol", "a.b"]


def test_fixed_word_lists():
    """The SQL side shares the stopwords; this pins them."""
    from precis.functions.chars import WS_CHARS
    from precis.sources.pairs import NA_TOKENS
    from registry import oracles

    assert len(STOPWORDS) == len(set(STOPWORDS)) == 118
    assert sorted(WS_CHARS) == sorted(oracles.WS_CHARS) == sorted(c for c in map(chr, range(0x110000)) if c.isspace())
    assert sorted(NA_TOKENS) == sorted(oracles.NA_TOKENS)


def test_unroll_keeps_order_and_empty_rows(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (1, [])], "doc_id long, ws array<string>")
    assert unroll(df, ["doc_id"], "ws").count() == 2
    assert unroll(df, ["doc_id"], "ws", keep_empty=True).count() == 3


def test_text_functions_work_on_a_stream(spark, tmp_path):
    from precis.functions.text import clean_text, word_count

    texts(spark, CATS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id long, text string").parquet(str(tmp_path / "in"))
    counted = stream.select("doc_id", word_count(clean_text("text")).alias("n"))
    run = counted.writeStream.format("memory").queryName("counted").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert as_dict(spark.table("counted"), "doc_id", "n") == {0: 6, 1: 6, 2: 7}
