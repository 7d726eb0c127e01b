"""Quality from passages: the gradient by differences, encoding by hand, held-out accuracy, odd tables."""

import numpy as np
from pyspark.sql import functions as F

from precis.llm import passage_quality as pq
from precis.llm.queries import QUERIES
from tests.llm import cases


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    settings = pq.Settings(hidden=4, gate=3)
    model = pq.Attention(settings, np.zeros(pq.WIDTH), np.ones(pq.WIDTH), 0.3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    model.mean, model.scale = model.mean.astype(float), model.scale.astype(float)
    sizes, label, weight = np.array([1, 4, 2]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 3.0, 2.0])
    x = rng.normal(size=(7, pq.WIDTH)) / 10

    def loss():
        p = model.forward(x, sizes)["p"]
        return -(weight * np.log(np.where(label == 1, p, 1 - p))).sum() / weight.sum()

    got = model.gradient(model.forward(x, sizes), sizes, label, weight)
    for name, d in got.items():
        w = model.w[name].reshape(-1)
        for i in rng.integers(0, w.size, 5):
            old, h = w[i], 1e-5
            w[i] = old + h
            up = loss()
            w[i] = old - h
            down = loss()
            w[i] = old
            assert abs((up - down) / (2 * h) - np.ravel(d)[i]) < 1e-6, name


def test_passages_are_encoded_alone():
    words = [f"w{i}" for i in range(150)]
    texts = [" ".join(words), "", "  \n", "Zwölf BOXER!! 12\n", "x" * 1000, " ".join(words[:64])]
    rows, sizes = pq.encode([t.encode() for t in texts])
    assert sizes.tolist() == [3, 1, 1, 1, 1, 1] and rows.shape == (8, pq.WIDTH)
    # The same rows whatever stands beside a text.
    first = 0
    for t, n in zip(texts, sizes.tolist()):
        alone, _ = pq.encode([t.encode()])
        assert np.array_equal(alone, rows[first : first + n])
        first += n
    assert not rows[3].any() and not rows[4].any()
    fine = dict(zip(range(pq._N_FINE), rows[5] ** 2 * 19))  # 18 bytes of the text and the blank after it
    assert round(fine[2], 3) == 3 and round(fine[3], 3) == 6 and round(fine[4], 3) == 2


def test_attention_finds_the_passage_that_decides(spark):
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(400):
        passages = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], pq.PASSAGE)) for _ in range(6)]
        if i % 2:
            passages[rng.integers(6)] = " ".join(["###"] * pq.PASSAGE)
        texts.append(" ".join(passages))
        labels.append((i, 1 - i % 2))
    docs = cases.frame(spark, texts)
    model = pq.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = pq.score_quality(docs, model).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in got)
    bad = [r for r in got if r.doc_id % 2]
    where = [texts[r.doc_id].split().index("###") // pq.PASSAGE for r in bad]
    assert np.mean([r.top_passage == w for r, w in zip(bad, where)]) > 0.9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op13_quality_classifier"](spark, folder)
    seen = rows.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    assert len(seen) > 1000
    right = np.mean([r.predicted == r.quality for r in seen])
    low = np.array([r.score for r in seen if r.quality == 0])
    high = np.array([r.score for r in seen if r.quality == 1])
    assert right > 0.95 and (low[:, None] < high).mean() > 0.97


def test_odd_rows_and_labels(spark):
    texts = cases.odd_texts()
    docs = cases.frame(spark, [*texts, "same", "same"], ids=[*range(len(texts)), None, None])
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 0, "x"), (2, None, "x"), (None, 1, "x"), (3, 7, "x")], "doc_id long, quality int, label string")
    for given in (labels, labels.limit(0), spark.createDataFrame([(i, i % 2, 1) for i in range(17)], "doc_id long, quality int, ID int")):
        rows = pq.score_quality(docs, pq.fit(docs, given)).collect()
        assert len(rows) == len(texts) + 2 and all(0 <= r.score <= 1 and 0 < r.top_weight <= 1 for r in rows)
        assert len({tuple(r) for r in rows if r.doc_id is None}) == 1
    assert pq.fit(docs, labels.limit(0)) == 0.5
    assert pq.score_quality(docs.limit(0), 0.5).collect() == []
    ids = spark.range(30).select("id", pq.held_out(F.col("id")).alias("h")).collect()
    import zlib

    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in ids)
