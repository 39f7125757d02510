import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.llm import langid
from flowloom.llm.langid import Languages, counted, has_letter, identify, keep_identified, learn, mixture
from flowloom.llm.queries import op9

DOCS = "lang string, text string, doc_id long, score string, languages int"
EN, FR, DE = "the cat and the dog are in the house with this thing ", "le chat et le chien sont dans la maison avec une chose ", "die katze und der hund sind in dem haus mit einer sache "


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(lang, text * (1 + i % 3), 10 * i + j, "x", 1) for i in range(30) for j, (lang, text) in enumerate([("en", EN), ("fr", FR), ("de", DE)])]
    return spark.createDataFrame([*rows, (None, EN, 900, "", 0), ("en", None, 901, "", 0), ("fr", "123 !!", 902, "", 0)], DOCS)


@pytest.fixture(scope="module")
def model(docs):
    return learn(docs)


def test_counts_are_those_of_all_labelled_rows(docs, model):
    assert model.names == ["de", "en", "fr"]
    want = np.full((3, 1 << 16), 0.5)
    for r in docs.collect():
        if r.lang and r.text and any(c.isalpha() for c in r.text):
            seen, n = counted(r.text.encode())
            want[model.names.index(r.lang), seen] += n
    assert np.allclose(model.p, want / want.sum(axis=1, keepdims=True))


def test_odd_rows_and_mixtures(spark, model):
    rows = [(None, None, 1), (None, "", 2), (None, "12 |%", 3), (None, "a", 4), (None, EN * 5000, 5), (None, EN * 6 + FR * 3, 6), (None, FR, None), (None, DE, 7), (None, DE, 7), (None, "汉字", 8), (None, "⅕ 。", 9)]
    got = {(r.doc_id, i): r for i, r in enumerate(identify(spark.createDataFrame([(*r, "", 0) for r in rows], DOCS).coalesce(1), model).collect())}
    pred = [got[(r[2], i)] for i, r in enumerate(rows)]
    assert [p.lang_pred for p in pred[:3]] == ["und"] * 3 and [p.score for p in pred[:3]] == [0.0] * 3
    assert pred[3].lang_pred != "und" and pred[9].lang_pred != "und" and pred[10].lang_pred == "und"
    assert [p.lang_pred for p in pred[4:9]] == ["en", "en", "fr", "de", "de"]
    assert pred[5].languages == ["en", "fr"] and pred[5].shares[0] == pytest.approx(0.65, abs=0.08)
    assert pred[4].languages == ["en"] and pred[4].score == 1.0
    assert all(0 <= p.score <= 1 for p in pred)


def test_mixture_climbs_the_likelihood():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(50), 3)
    n = rng.multinomial(4000, 0.7 * p[0] + 0.3 * p[2])
    share, likelihood = mixture(p, n, np.full(3, 1 / 3))
    for _ in range(30):
        share, likelihood = mixture(p, n, share)
    assert share == pytest.approx([0.7, 0.0, 0.3], abs=0.05)
    assert likelihood >= max(float(np.log(s @ p) @ n) for s in rng.dirichlet(np.ones(3), 300))


def test_chunks_count_everything():
    raw = (EN * 40000).encode()
    assert abs(counted(raw)[1].sum() - counted(EN.encode())[1].sum() * 40000) < 50000
    assert has_letter("é".encode()) and not has_letter(b"1_") and not has_letter(None)


def test_stage_keeps_rows_as_they_are(spark, docs, model):
    got = keep_identified(docs, model)
    assert got.schema == docs.schema
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in (901, 902))


def test_rows_come_in_small_batches(spark, model, monkeypatch):
    """Whole rows pass through Python: what a worker and its JVM hold at once must not be a partition's texts."""

    def keeper(*_):
        def keep(batches):
            for b in batches:
                yield b.set_column(b.schema.get_field_index("doc_id"), "doc_id", pa.array([len(b)] * len(b), pa.int64()))

        return keep

    def counter(batches):
        for b in batches:
            yield pa.record_batch([pa.array([str(len(b))]), pa.array([0], pa.int64()), pa.array([1], pa.int64())], names=["lang", "bucket", "n"])

    rows = spark.range(0, 3000, 1, 1).select(F.lit("en").alias("lang"), F.lit(EN).alias("text"), F.col("id").alias("doc_id"))
    monkeypatch.setattr(langid, "_keeper", keeper)
    monkeypatch.setattr(langid, "_counter", counter)
    got = [r.doc_id for r in keep_identified(rows, model).collect()]
    assert len(got) == 3000 and max(got) <= 512
    assert max(map(int, learn(rows).names)) <= 512


def test_empty_tables(spark, docs, model):
    none = docs.limit(0)
    assert identify(none, model).count() == 0
    assert learn(none).names == []
    assert {r.lang_pred for r in identify(docs, Languages([], np.zeros((0, 1 << 16)))).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op9(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = [r for r in got.collect() if r.lang]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    unseen = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.97
    assert got.where(F.col("lang_pred") == "und").where(F.col("text").rlike(r"\p{L}")).count() == 0


def test_long_texts_are_counted_as_a_whole(monkeypatch):
    raw = ("Ein Über-langer Text, ção 中文 " * 400).encode()
    whole = np.unique(langid.trigrams(raw), return_counts=True)
    for chunk in (1 << 20, 1000, 7):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        seen, n = langid.counted(raw)
        assert seen.tolist() == whole[0].tolist() and n.tolist() == whole[1].tolist()
