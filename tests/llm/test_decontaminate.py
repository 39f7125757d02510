import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.llm import decontaminate as module
from flowloom.llm.decontaminate import Automaton, decontaminate, scan, without, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, n_words string, spans int"


def norm(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    words, hit, found = norm(text), set(), set()
    for name, item in items:
        iw = norm(item)
        n = min(window, len(iw))
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(name)
    return len(words), len(hit), sorted(found, key=str)


def random_case(rng, letters, window):
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 3 * window)))) for i in range(12)]
    text = " ".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
    for _ in range(2):
        text += " " + rng.choice(items)[1]
    return text, items


@pytest.mark.parametrize("window", [3, 10])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_automaton_matches_brute_force(window, letters):
    rng = random.Random(window)
    for _ in range(150):
        text, items = random_case(rng, letters, window)
        spans, found = Automaton([(i, words_of(t.encode())) for i, t in items], window).scan(words_of(text.encode()))
        assert (len(norm(text)), sum(e - s for s, e in spans), sorted(found, key=str)) == brute(text, items, window)


def test_words_are_those_of_the_pattern():
    text = "Àb-C dÉ 1_2\x7f\x00x y  Z{q}"
    assert [w.decode() for w in words_of(text.encode())] == norm(text)


def rows(spark, block_words):
    rng = random.Random(5)
    items, docs = [], []
    for i in range(20):
        text, some = random_case(rng, "abc", 10)
        docs.append((i, text, "x", 1))
        items += [(100 * i + j, t) for j, t in some]
    docs += [(50, None, None, None), (51, "", "", 0), (None, docs[0][1], "x", 1), docs[1], docs[1], (52, "a b c " * 4000, "x", 1)]
    items += [(9000, None), (9001, ""), items[3]]
    return docs, items, scan(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), 10, block_words=block_words).collect()


@pytest.mark.parametrize("block_words", [300_000, 1_500])
def test_rows_and_blocks(spark, block_words):
    docs, items, got = rows(spark, block_words)
    want = sorted((str(d[0]), *brute(d[1], items, 10)) for d in docs)
    assert sorted((str(r.doc.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == want
    assert all(r.doc.n_words in ("x", "", None) for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:3] for r in scan(docs, none).collect()] == [(2, 0)]
    assert scan(docs.limit(0), none).count() == 0


def test_decontaminate_drops_or_cuts(spark):
    leak = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"Clean one, {leak.upper()}! End é.", "", 0), (2, "nothing here", "", 0), (3, None, None, 0)], DOCS)
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate(docs, items).collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate(docs, items, most_coverage=1.0, cut_from=10).collect()}
    assert cut == {1: "Clean one,  ! End é.", 2: "nothing here", 3: None}
    assert without("a b c", [(0, 3)]) == " "


@pytest.mark.parametrize("blocks", [1, 2])
def test_rows_come_in_small_batches(spark, monkeypatch, blocks):
    """Whole rows pass through Python: what a worker and its JVM hold at once must not be a partition's texts."""

    def scanner(*_):
        def scan(batches):
            for b in batches:
                most = [max(len(b), n) for n in b.column("doc").field(0).to_pylist()]
                no, none = pa.array([0] * len(b), pa.int64()), pa.array([[]] * len(b), pa.list_(pa.int64()))
                doc = pa.StructArray.from_arrays([pa.array(most, pa.int64()), b.column("doc").field(1)], ["doc_id", "text"])
                yield pa.RecordBatch.from_arrays([doc, no, no, no, none, none], ["doc", "n_words", "n_hit", "longest", "spans", "items"])

        return scan

    monkeypatch.setattr(module, "_scanner", scanner)
    docs = spark.range(0, 3000, 1, 1).select(F.lit(0).cast("long").alias("doc_id"), F.lit("some text").alias("text"))
    monkeypatch.setattr(module, "scan", lambda *a, f=scan: f(*a, block_words=12 if blocks == 1 else 11))
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    got = [r.doc_id for r in decontaminate(docs, items).collect()]
    assert len(got) == 3000 and max(got) <= 512


def test_scan_cuts_large_batches():
    """A batch of any size is answered in small ones, in order."""

    class Sent:
        value = [(7, b"a b c")]

    fields = pa.struct([("doc_id", pa.int64()), ("text", pa.string())])
    rows = [{"doc_id": i, "text": f"x{i} A, b c" if i % 3 else None} for i in range(1300)]
    empty = pa.array([[]] * 1300, pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(rows, fields), empty, empty], ["doc", "spans", "items"])
    got = list(module._scanner(Sent, ("cut",), 3, None, "text")([batch]))
    assert [len(b) for b in got] == [512, 512, 276]
    flat = [r for b in got for r in b.to_pylist()]
    assert [r["doc"] for r in flat] == rows
    assert all((r["n_words"], r["n_hit"], r["spans"], r["items"]) == ((4, 3, [1, 4], [7]) if i % 3 else (0, 0, [], [])) for i, r in enumerate(flat))
