import gc
import random
import zlib

import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowloom.llm import tokenfiles
from flowloom.llm.queries import op3
from flowloom.llm.tokenfiles import CACHED_WORDS, Encoder, TokenFiles, read_token_files, token_digest, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
DOCS = "text string, doc_id long, start string, n_tokens int"


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


ODD = [
    None, "", " \n\t", "It's we'll'd 0 00 a0b 10,000 ## #a <|endoftext|> x<|startoftext|>y", "ÀÉ ß İI ǅ Σας ΣΑΣ é ́x á̧",
    "a b c　d​e\u0085f\x1cg\x1d\x1e\x1fh\x0b\x0ci", "汉字 かな 한국어 \U0001f600‍\U0001f600 🇫🇷", "| --- | 0x0 '0' ﻿", "x" * 3000, "\x00 a\x00b", "word " * 20000,
]


def test_encoder_equals_whole_text_encoding():
    rng = random.Random(3)
    letters = "ab'sdÉé \t\n  0123#.<|>İΣ汉\U0001f600"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    encoder = Encoder(PATH, "<u2", True)
    for at in range(0, len(texts), 700):
        part = texts[at : at + 700]
        for t, ids in zip(part, encoder.encode([t and t.encode() for t in part]), strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == whole(t), t


def test_encoder_forgets_what_came_last(monkeypatch):
    monkeypatch.setattr("flowloom.llm.tokenfiles.CACHED_WORDS", 50)
    encoder = Encoder(PATH, "<u2", True)
    for i in range(40):
        texts = [f"the w{i} q{i * j} of" for j in range(12)]
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode([t.encode() for t in texts])] == [whole(t) for t in texts]
    assert len(encoder.known) <= 100 < CACHED_WORDS


def text_hash(text):
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def want(rows, end):
    out, start = [], 0
    for text, name, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, text_hash(r[0]))):
        ids = [*whole(text), end]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, tmp_path):
    rows = [(t, 100 - i, "x", i) for i, t in enumerate(ODD)] + [("same", 7, "", 0), ("same", 7, "", 0), ("other", 7, "", 0), ("no id", None, "", 0)]
    path = f"file://{tmp_path}/out"
    write_token_files(spark.createDataFrame(rows, DOCS), path, PATH, 2, 49_408, splits=True, partitions=3)
    got = read_token_files(spark, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == want(rows, 2)
    files, flat = TokenFiles(path), []
    for i in range(len(files.shards)):
        names, ends, ids = files.shard(i)
        assert len(ids) == 0 or isinstance(ids, np.memmap) and ids.dtype == np.dtype("<u2")
        flat += ids.tolist()
    assert flat == [i for t, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, text_hash(r[0]))) for i in [*whole(t), 2]]


def test_wide_ids_whole_texts_and_empty_table(spark):
    rows = [("ab 0 cd", 1, "", 0), (None, 2, "", 0)]
    df = spark.createDataFrame(rows, DOCS)
    assert [tuple(r) for r in token_digest(df, PATH, 70_000, 70_001).orderBy("start").collect()] == want(rows, 70_000)
    assert token_digest(df.limit(0), PATH, 2, 49_408, splits=True).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.text, r.doc_id) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "doc_id").collect()]
    assert [tuple(r) for r in op3(spark, sf).orderBy("doc_id").collect()] == want(rows, 2)


def test_rows_of_one_id_spread_over_shards(spark, tmp_path):
    rows = [(f"text {i % 40}", 7 if i % 3 == 0 else i, "x", i) for i in range(3000)]
    path = f"file://{tmp_path}/out"
    write_token_files(spark.createDataFrame(rows, DOCS).repartition(6), path, PATH, 2, 49_408, splits=True, partitions=8)
    assert [tuple(r) for r in read_token_files(spark, path).orderBy("start").collect()] == want(rows, 2)
    files = TokenFiles(path)
    held = [int((files.shard(i)[0] == 7).sum()) for i in range(len(files.shards))]
    assert sum(held) == 1001 and sum(n > 0 for n in held) > 1 and max(held) < 700


def test_no_search_for_cycles_while_encoding():
    """The collector is off inside, also when the work fails, and as it was afterwards."""
    seen = []
    try:
        with tokenfiles.uncollected():
            seen.append(gc.isenabled())
            raise ValueError
    except ValueError:
        seen.append(gc.isenabled())
    gc.disable()
    try:
        with tokenfiles.uncollected():
            pass
        seen.append(gc.isenabled())
    finally:
        gc.enable()
    assert seen == [False, True, False]


def test_rows_come_in_small_batches(spark, tmp_path, monkeypatch):
    """A worker holds no more texts at once than it encodes together."""

    class Sizes(tokenfiles.Writer):
        def write(self, batches):
            return tokenfiles.Shard(str(max(len(b) for b in batches)), 0, 0, 0)

    class Source(tokenfiles.TokenFileSource):
        def writer(self, schema, overwrite):
            return Sizes(self.options)

    monkeypatch.setattr(tokenfiles, "TokenFileSource", Source)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    write_token_files(rows, str(tmp_path / "t"), PATH, 2, 49_408, splits=True, partitions=1)
    assert [int(s["name"]) <= tokenfiles.ENCODED_DOCS for s in TokenFiles(str(tmp_path / "t")).shards] == [True]
