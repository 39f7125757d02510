import zlib

import numpy as np
from pyspark.sql import functions as F

from flowloom.llm import quality
from flowloom.llm.idfilter import members
from flowloom.llm.queries import op7

ROWS = "text string, doc_id long, label int, score string, grams int"


def rows(n=300):
    rng = np.random.default_rng(3)
    words = ["ation", "ing", "the", "house", "river", "stone", "light"]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(words, rng.integers(5, 60)))
        out.append((text if i % 4 else text.replace(" ", "%%% "), i, int(i % 4 > 0), "x", 1))
    return [*out, (None, n, 1, "", 0), ("", n + 1, 0, "", 0), ("no label", n + 2, None, "", 0), ("long " * 50000, None, 1, "", 0), out[1]]


def test_grams_are_those_of_the_whole_text(monkeypatch):
    raw = ("é abc %%% " * 3000 + "Z").encode()
    want = sorted({int(np.uint32(int.from_bytes((b"   " + raw)[i : i + 4], "big") * 2654435761 & 0xFFFFFFFF) >> np.uint32(14)) for i in range(len(raw))})
    assert quality.grams(raw).tolist() == want
    monkeypatch.setattr(quality, "CHUNK", 101)
    assert quality.grams(raw).tolist() == want
    assert quality.grams(None).size == quality.grams(b"").size == 0 and quality.grams(b"a").size == 1


def test_counts_cover_all_rows_and_the_fit_separates(spark):
    data = rows()
    df = spark.createDataFrame(data, ROWS)
    model = quality.learn(df.repartition(3))
    counts = np.zeros((2, quality.BUCKETS))
    for text, _, label, *_ in data:
        if label is not None:
            counts[label, quality.grams((text or "").encode())] += 1
    ratio = quality.log_count_ratio(counts)
    assert np.allclose(model.square, ratio**2, rtol=1e-4)
    got = quality.score_quality(df.repartition(2), model).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert np.mean([(score[i] >= 0.5) == bool(y) for _, i, y, *_ in data[:300]]) > 0.99
    assert score[300] == score[301]


def test_labels_find_their_texts(spark):
    docs = spark.createDataFrame([(f"t{i}", i, None, "", 0) for i in range(3000)] + [("none", None, None, "", 0), ("again", 5, None, "", 0)], ROWS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 3000, 7)] + [(5, 1), (None, 1), (4, None), (99999, 0)], "doc_id long, label int")
    got = sorted((r.doc_id, bytes(r.text).decode(), r.label) for r in quality.labelled_texts(docs, labels).collect())
    assert got == sorted([(i, f"t{i}", i % 2) for i in range(0, 3000, 7)] + [(5, "t5", 1), (5, "again", 1)])
    few = members(docs.select("doc_id"), labels.select("doc_id"), "doc_id").count()
    assert 430 <= few < 900
    assert quality.labelled_texts(docs, labels.limit(0)).count() == 0


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = [np.sort(rng.choice(20, 6, replace=False)) for _ in range(60)]
    y, ratio = rng.integers(0, 2, 60), rng.normal(size=20)

    def loss(w, b):
        sizes = np.bincount(y)
        c = quality.COST * (60 / (2 * sizes))[y]
        v = [ratio[i] / np.linalg.norm(ratio[i]) for i in x]
        hinge = np.array([max(0, 1 - (2 * t - 1) * (w[i] @ z + b)) for i, z, t in zip(x, v, y)])
        return 0.5 * (w @ w + b * b) + c @ hinge**2

    w, b = quality.descend(x, y, ratio, epochs=400)
    best = loss(w, b)
    for _ in range(300):
        assert loss(w + rng.normal(size=20) * 0.02, b + rng.normal() * 0.02) >= best - 1e-6


def test_bounded_sample_and_degenerate_tables(spark):
    df = spark.createDataFrame(rows(), ROWS)
    model = quality.learn(df, sample_rows=100)
    score = {r.doc_id: r.score for r in quality.score_quality(df, model).collect()}
    assert np.mean([(score[i] >= 0.5) == bool(i % 4) for i in range(300)]) > 0.95
    none = df.limit(0)
    empty = quality.learn(none)
    assert quality.score_quality(none, empty).count() == 0
    assert {r.score for r in quality.score_quality(df, empty).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op7(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(F.col("quality").isNotNull()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out]
    by_class = [np.mean([r.predicted == q for r in unseen if r.quality == q]) for q in (0, 1)]
    print("held out", by_class)
    assert min(by_class) > 0.9
