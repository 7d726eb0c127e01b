"""Every stage, judged on what the stage before it gave, against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
from precis.llm.common import stored
from precis.llm.mixing import PART
from tests.llm import cases
from tests.llm.test_search_and_mix import plain_copies


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{cases.DATA}/documents.parquet")
    odd = spark.createDataFrame(
        [(90_001, None, "en", "src0", None), (90_002, "", None, "src0", 0), (90_003, "12 34", "en", None, 5)], docs.schema)
    docs, columns, kept = stored(docs.unionAll(odd)), docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = as_rows(docs)
        docs = stored(stage(spark, docs, cases.DATA))
        assert docs.columns == columns
        after = kept[name] = as_rows(docs)
        if name == "language_id":
            # All that has letters in one known language stays as it is.
            assert sorted(set(before) - set(after)) == [r for r in sorted(before, key=lambda r: r[0]) if r[0] > 90_000]
        elif name == "line_dedup":
            texts = [t for *_, t in cases.line_dedup([r[1] for r in before], 10)]
            assert sorted(after) == sorted((r[0], t, r[2], r[3], len(t)) for r, t in zip(before, texts))
        elif name == "near_dedup":
            found = cases.near_dedup([r[0] for r in before], [r[1] for r in before], 5)
            assert sorted(after) == sorted(r for r, (_, c) in zip(before, found) if r[0] == c)
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{cases.DATA}/benchmark.parquet").collect()]
            hits = cases.contaminated([r[1] for r in before], items)
            assert sorted(after) == sorted(r for r, (n, h, _) in zip(before, hits) if not (h and 20 * h >= n))
            assert len(after) < len(before)
        else:
            sizes = Counter(r[3] for r in before)
            total = sum(n**0.5 for n in sizes.values())
            rate = {s: n**0.5 / total * len(before) / n for s, n in sizes.items()}
            assert max(rate.values()) < PART
            copies = Counter({r: plain_copies(r[0], rate[r[3]]) for r in before})
            assert Counter(after) == +copies
    assert len(kept) == 5 and defaultdict(int, Counter(r[0] for r in kept["near_dedup"])) == Counter(r[0] for r in kept["near_dedup"])


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, cases.DATA)
    assert out.columns == spark.read.parquet(f"{cases.DATA}/documents.parquet").columns
    assert out.count() > 0
