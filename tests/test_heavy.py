"""Bounded counters: bounds hold, vocabularies equal the exact ones, and rare words are not shuffled."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from precis.operators import heavy
from precis.operators import vocabulary as vb


@given(st.lists(st.lists(st.sampled_from("aaaabbbccdefgh"), max_size=30), max_size=8), st.integers(1, 6))
def test_bounds_hold(batches, most):
    counters, true = heavy.Counters(most), Counter()
    for words in batches:
        counters.add(pa.array(words, pa.string()))
        true.update(words)
        low = dict(zip(counters.words.to_pylist(), counters.low.tolist()))
        assert len(low) <= most
        assert all(low.get(w, 0) <= n <= low.get(w, 0) + counters.error for w, n in true.items())
        assert all(n > 0 for n in low.values())


def corpus(spark, n=400):
    """A few words that stand often, and very many that stand once."""
    rng = random.Random(n)
    texts = [" ".join([*rng.choices([f"often{i}" for i in range(12)], weights=range(40, 16, -2), k=30), *(f"rare{i}x{j}" for j in range(9))])
             for i in range(n)]
    return spark.createDataFrame(list(enumerate([*texts, None, "", "<PAD> <PAD>"])), "doc_id long, text string").repartition(6)


def as_rows(v):
    return sorted(map(tuple, v.table.collect()))


@pytest.mark.parametrize("counters", [40, 100_000])
def test_vocabulary_equals_the_exact_one(spark, counters):
    texts = corpus(spark)
    assert as_rows(heavy.fit_vocabulary_bounded(texts, "text", 12, counters=counters)) == as_rows(vb.fit_vocabulary(texts, "text", 12))
    found = heavy.candidates(texts, "text", 10, counters)
    assert found.words.n_rows < 40 and (found.error > 0) == (counters == 40)


def test_bounds_that_do_not_separate_fall_back(spark):
    texts = corpus(spark)
    assert heavy.candidates(texts, "text", 200, 20).words is None
    assert as_rows(heavy.fit_vocabulary_bounded(texts, "text", 200, counters=20)) == as_rows(vb.fit_vocabulary(texts, "text", 200))
    empty = texts.limit(0)
    assert as_rows(heavy.fit_vocabulary_bounded(empty, "text", 9)) == as_rows(vb.fit_vocabulary(empty, "text", 9))


def test_rare_words_are_not_shuffled(spark):
    texts = corpus(spark)
    found = heavy.candidates(texts, "text", 12, 40)
    counts = heavy.survivors_freq(texts, "text", found.words)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    # The filter by the sent words stands below the one exchange by word.
    assert plan.count("Exchange hashpartitioning(word") == 1
    assert plan.index("Exchange hashpartitioning(word") < plan.index("BroadcastHashJoin")
    assert counts.count() < 40 < vb.word_freq(texts, "text").count()
