import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from flowloom.llm.queries import QUERIES

EN = "the and of with that stone river house light garden morning window table letter story winter summer market bridge forest".split()
FR = "le la les des une dans avec pour pierre fleuve maison jardin matin fenetre lettre histoire hiver marche pont foret".split()


def tables(spark, folder):
    rng = random.Random(11)
    prose = lambda words, n: " ".join(rng.choice(words) + str(rng.randint(0, 400)) * (rng.random() < 0.3) for _ in range(n))
    docs = [(i, prose(*((EN, 90) if i % 3 else (FR, 120))), "en" if i % 3 else "fr", f"s{i % 4 if i % 2 else 0}") for i in range(120)]
    near = docs[5][1].split()
    near[40] = "changed"
    item = prose(EN, 25)
    docs += [(200, docs[3][1], "fr", "s1"), (201, " ".join(near), "en", "s2"), (202, prose(EN, 30) + " " + item.upper() + " " + prose(EN, 30), "en", "s3"), (203, "12 34 !!", "en", "s1"), (204, None, None, None), (205, prose(EN, 50), None, None)]
    docs.append(docs[7])
    rows = [(*d, len(d[1]) if d[1] is not None else None) for d in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, item


def test_every_stage_takes_effect_and_keeps_the_columns(spark, tmp_path):
    folder = f"file://{tmp_path}"
    docs, _ = tables(spark, folder)
    text = {d[0]: d[1] for d in docs}
    df = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = df.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, folder)
        df.write.parquet(f"{folder}/{name}")
        df = spark.read.parquet(f"{folder}/{name}")
        seen[name] = df.collect()
        assert name == "token_output" or df.columns == columns
    ids = {n: sorted(r.doc_id for r in rows) for n, rows in seen.items()}
    clean = sorted(d[0] for d in docs)
    assert ids["language"] == [i for i in clean if i not in (203, 204)]
    clean = sorted(set(clean) - {200, 201, 203, 204})
    assert ids["near_dedup"] == clean
    clean.remove(202)
    assert ids["decontamination"] == clean
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t))
    total = sum(words(text[i]) for i in clean)
    mixed = sum(words(r.text) for r in seen["mixing"])
    assert set(ids["mixing"]) <= set(clean) and abs(mixed - 1.5 * total) <= 4 * 120
    assert max(np.unique(ids["mixing"], return_counts=True)[1]) <= 2
    assert ids["token_output"] == ids["mixing"]
    whole, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for r in sorted(seen["token_output"], key=lambda r: r.start):
        tokens = [*whole.encode(text[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        start += len(tokens)


def test_query_runs_the_stages(spark, tmp_path):
    folder = f"file://{tmp_path}"
    tables(spark, folder)
    got = QUERIES["pipeline"](spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100


def test_empty_documents(spark, tmp_path):
    folder = f"file://{tmp_path}"
    tables(spark, folder)
    df = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, folder)
    assert df.count() == 0
