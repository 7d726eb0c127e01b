import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from precis.llm import mixing, warc_revisits
from precis.llm.queries import QUERIES
from precis.llm.vector_search import CentroidGraph, Settings, balanced_centroids, distances, search
from tests.llm import cases

VECTORS = "vec_id long, embedding array<float>, label int, v string, h1 int, Vec_ID int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, 0, "", 1, 2) for i, x in rows], VECTORS)


def brute(rows, ids, k):
    out = {}
    good = {(i, tuple(x)) for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)}
    size = Counter(len(x) for _, x in good).most_common(1)[0][0]
    good = [(i, np.array(x, np.float32).astype(float)) for i, x in good if len(x) == size]
    for q in ids:
        for j, own in good:
            if j == q:
                out[q] = sorted((float(np.sqrt(((x - own) ** 2).sum())), i) for i, x in good if i != q)[:k]
    return out


def test_search_is_exact_on_one_list_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(120)]
    # A crowd of equal vectors, repeated rows, and all that takes no part.
    rows += [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(200, 260)] + [rows[3], rows[3]]
    rows += [(300, None), (310, [0.0] * 4), (320, [1.0, None, 2.0, 3.0]), (330, [float("nan")] * 4), (340, [float("inf"), 0.0, 0.0, 0.0]),
             (350, []), (360, [1.0, 2.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    found = search(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    expected = brute(rows, [i for i in range(0, 400, 10)], 10)
    assert got.keys() == expected.keys()
    for q in got:
        assert [i for _, i in got[q]] == [i for _, i in expected[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in expected[q]], rtol=1e-12, atol=0)


def test_search_few_and_no_rows(spark):
    found = search(vectors(spark, [(0, [1.0, 2.0]), (1, [2.0, 2.0]), (100, [1.0, 2.0])]), F.col("vec_id") % 100 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == [
        (0, 1, 100, 0.0), (0, 2, 1, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 1.0)]
    assert search(vectors(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert search(vectors(spark, [(5, None)]), F.col("vec_id") % 100 == 0).collect() == []


def test_far_queries_get_k(spark):
    """Lists of one vector each: the lists of a far query hold fewer than k, but there are many candidates."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3).round(3).tolist()) for i in range(1, 800)] + [(1000, [60.0, 60.0, 60.0]), (1100, [-90.0, 0.0, 1.0])]
    found = search(vectors(spark, rows), F.col("vec_id") % 100 == 0, Settings(list_rows=1, least_probes=2, probe_ratio=1.0, replicas=1))
    got = Counter(r.query_id for r in found.collect())
    assert got == {i: 10 for i in (*range(100, 800, 100), 1000, 1100)}


def test_recall_of_many_lists(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = search(table, F.col("vec_id") % 100 == 0, Settings(list_rows=32, block=64))
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected = brute(rows, [i for i, _ in rows if i is not None and i % 100 == 0], 10)
    assert got.keys() == expected.keys()
    recall = sum(len(got[q] & {i for _, i in expected[q]}) for q in got) / sum(map(len, expected.values()))
    assert recall >= 0.9


def test_lists_are_balanced_and_walks_find_the_nearest():
    rng = np.random.default_rng(5)
    # Half of all points stand in one small spot.
    sample = np.concatenate([rng.normal(size=(1000, 8)), 5 + rng.normal(size=(1000, 8)) / 100])
    centroids = balanced_centroids(sample, 40)
    sizes = np.bincount(distances(sample, centroids).argmin(1), minlength=len(centroids))
    assert sizes.max() <= 4 * len(sample) / 40
    found, _ = CentroidGraph(centroids, Settings()).walk(sample, 16)
    assert (found[:, 0] == distances(sample, centroids).argmin(1)).mean() > 0.98


RECORDS = "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, payload string, site string, bucket int"


def records(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], RECORDS)


def test_revisits(spark):
    old = {"Content-Type": "text/html", "ETag": '"a"', "Age": "1", "age": "2", "X": None}
    new = {"AGE": "9", "Content-Type": "text/plain", "Connection": "close", "Date": "d"}
    rows = [
        (1, "http://www.H.com:80/p/?b=2&utm_x=1&a=1#f", 100, "response", '"a"', "m", old, "one"),
        (2, "https://h.com/p?a=1&b=2", 200, "response", '"b"', None, None, ""),
        (3, "h", 0, "other", None, None, None, None),
        (10, "http://h.com/p?a=1&b=2", 150, "revisit", 'W/"a"', None, new, None),
        (11, "http://h.com/p?a=1&b=2", 200, "revisit", None, "m", new, None),
        (12, "http://h.com/p?a=1&b=2", 90_000_000, "revisit", '"b"', None, None, None),
        (13, "http://h.com/p?a=1&b=2", 100, "revisit", '"a"', None, None, None),
        (14, "http://h.com/p?a=1&b=2", 300, "revisit", '"a"', "m", None, None),
        (15, "http://h.com/p?a=1&b=2", 300, "revisit", None, None, None, None),
        (16, "http://h.com/p?a=1&b=2", 300, "revisit", None, "m", None, None),
        (17, None, 300, "revisit", '"a"', None, None, None),
        (18, "http://h.com/p?a=1&b=2", None, "revisit", '"a"', None, None, None),
    ]
    got = {r.record_id: r for r in warc_revisits.resolve_revisits(records(spark, rows), bucket_seconds=60).collect()}
    assert {i: (r.state, r.response_id) for i, r in got.items()} == {
        10: ("resolved", 1), 11: ("resolved", 1), 12: ("resolved", 2), 13: ("orphan", None), 14: ("mismatch", 2),
        15: ("unchecked", 2), 16: ("mismatch", 2), 17: ("orphan", None), 18: ("orphan", None)}
    assert got[10].headers == {"content-type": "text/html", "etag": '"a"', "age": "9", "date": "d"} and got[10].payload == "one"
    assert got[12].headers == {} and got[12].payload == "" and got[14].payload is None
    assert warc_revisits.resolve_revisits(records(spark, [])).collect() == []


def test_revisit_ties_and_buckets(spark):
    rows = [(i, "http://h/p", 10 * (i // 2), "response", f"{i}", None, {}, str(i)) for i in range(40)]
    rows += [(100 + t, "http://h/p", t, "revisit", None, None, {}, None) for t in range(0, 230, 7)]
    for width in (1, 37, 10_000):
        got = warc_revisits.resolve_revisits(records(spark, rows), bucket_seconds=width).collect()
        for r in got:
            earlier = [(x[2], x[0]) for x in rows[:40] if x[2] < r.record_id - 100]
            assert r.response_id == (max(earlier)[1] if earlier else None)


def test_one_url_at_one_time_is_one_row(spark):
    """A crowd of captures of one URL, at one ts and at many; the windows see a row for each ts."""
    rows = [(i, "http://h/p", 50, "response", f"{i}", None, {}, str(i)) for i in range(300)]
    rows += [(1000 + i, "http://h/p", 60, "revisit", f"{299 if i % 2 else i}", None, {}, None) for i in range(2000)]
    rows += [(5000 + i, "http://h/p", 50 + i, "revisit", None, None, {}, None) for i in range(0, 40, 5)]
    got = {r.record_id: r for r in warc_revisits.resolve_revisits(records(spark, rows)).collect()}
    assert {r.response_id for i, r in got.items() if i != 5000} == {299} and got[5000].state == "orphan"
    assert sum(r.state == "resolved" for i, r in got.items() if i < 5000) == 1000
    light = warc_revisits.latest_response(records(spark, rows).select(*warc_revisits.RECORD))
    assert light.count() == 2008


def plain_copies(doc_id, rate, seed="mix"):
    parts = max(1, math.ceil(rate / mixing.PART))
    total = 0
    for part in range(1, parts + 1):
        u = int(hashlib.md5(f"{seed}|{'null' if doc_id is None else doc_id}|{part}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-rate / parts)
        k = 0
        while c <= u and k < 1000:
            k += 1
            p *= rate / parts / k
            c += p
            total += 1
    return total


@pytest.mark.parametrize("most_broadcast", [10_000, 0])
def test_copies_against_plain_python(spark, most_broadcast):
    texts = cases.odd_texts() * 30
    docs = cases.frame(spark, texts, source="a").unionAll(cases.frame(spark, texts[:60], range(10_000, 10_060), source=None))
    weights = spark.createDataFrame([("a", 1.0), (None, 30.0), ("none", 5.0)], "source string, weight double")
    rows = mixing.mix(docs, weights, epochs=30.0, most_broadcast=most_broadcast).collect()
    n = len(texts) + 60
    rates = {"a": 1 / 31 * 30 * n / len(texts), None: 30 / 31 * 30 * n / 60}
    assert rates[None] > mixing.PART
    expected = Counter({(i, "a"): plain_copies(i, rates["a"]) for i in range(len(texts))}
                       | {(10_000 + i, None): plain_copies(10_000 + i, rates[None]) for i in range(60)})
    got = Counter((r.doc_id, r.source) for r in rows)
    assert got == +expected
    assert [r.order_key for r in rows] == sorted(r.order_key for r in rows)
    assert abs(sum(got.values()) / (30 * n) - 1) < 0.1
    # Target shares hold but for chance.
    assert abs(sum(v for (_, s), v in got.items() if s is None) / sum(got.values()) - 30 / 31) < 0.02


def test_mixing_odd_rows(spark):
    docs = cases.frame(spark, ["t", "t", None], ids=[1, 1, None])
    out = mixing.mixed_documents(docs, epochs=20.0)
    assert out.columns == docs.columns
    got = Counter(r["doc_id"] for r in out.collect())
    assert got[1] == 2 * plain_copies(1, 20.0) and 5 <= got[None] <= 45
    assert mixing.mix(docs.limit(0)).collect() == []


def test_rows_without_id_draw_alone(spark):
    # Different texts, and one text a thousand times.
    texts = [f"text {i}" for i in range(1000)] + ["same"] * 1000
    docs = cases.frame(spark, texts, ids=[None] * len(texts)).repartition(5)
    first, again = (mixing.mix(d).collect() for d in (docs, docs.repartition(2)))
    assert first == again
    for rows in ([r for r in first if r.text == "same"], [r for r in first if r.text != "same"]):
        assert abs(len(rows) - 1000) < 150
    # A Poisson number each, and no two order keys are equal.
    copies = Counter(r.text for r in first)
    share = Counter(copies[t] for t in texts[:1000])
    assert all(abs(share[k] / 1000 - math.exp(-1) / math.factorial(k)) < 0.06 for k in range(4))
    assert len({r.order_key for r in first}) == len(first)


def test_queries_give_contract_columns(spark):
    wanted = {
        "op1": "doc_id n_lines n_dropped kept_sha256", "op2": "doc_id n_shingles component_id kept",
        "op3": "doc_id n_words n_removed kept_sha256", "op4": "doc_id held_out lang_pred score",
        "op5": "query_id rank vec_id score", "op6": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op7": "doc_id n_assign n_access n_hex base_sha256 spans", "op8": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op11": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
        "op13": "doc_id held_out score predicted",
    }
    for name, run in QUERIES.items():
        columns = wanted.get(name.split("_")[0])
        if columns:
            assert run(spark, cases.DATA).columns == columns.split()
