import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from flowloom.llm import lexical
from flowloom.llm.lexical import Shard, build_index, search

DOCS = "doc_id long, text string, lang string, terms int, ids string"
ITEMS = "item_id long, text string, score int, rank string"


def terms(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t, *_ in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_tokens = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t, *_ in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for doc_id, c, n in counted:
            m = 10 + 90 * n * n_docs // n_tokens
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, doc_id is not None, doc_id))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def tables(rng, n=900):
    words = [f"w{i}" for i in range(400)] + ["Über", "été", "MIXED"]
    common = ["the", "of", "And"]
    docs = [(i, " ".join(rng.choice(common) if rng.random() < 0.5 else words[min(int(rng.expovariate(0.02)), 402)] for _ in range(rng.randint(0, 60))), "en", 0, "") for i in range(n)]
    docs += [(n + i, docs[7][1], None, 0, "") for i in range(300)]  # a large group of copies, all scores tie
    docs += [(9000, None, None, None, None), (9001, "", "", 0, ""), (9002, "... !!", "", 0, ""), (None, docs[9][1], "", 0, ""), docs[11], docs[11], (9003, "w1 of " * 400_000 + "rareword", "", 0, "")]
    items = [(i, " ".join(rng.choice(words + common) for _ in range(rng.randint(1, 40))), 0, "") for i in range(25)]
    items += [(100, None, 0, ""), (101, "", 0, ""), (102, "unheard-of", 0, ""), (103, docs[7][1], 0, ""), (104, "w1", 0, ""), (104, "rareword", 0, ""), (None, "w3 MIXED", 0, ""), (105, "the", 0, ""), items[0]]
    return docs, items


@pytest.mark.parametrize("shard_docs", [40, 500])
def test_matches_brute_force(spark, shard_docs, monkeypatch):
    docs, items = tables(random.Random(shard_docs))
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 4000)  # several chunks
    index = build_index(spark.createDataFrame(docs, DOCS).repartition(3), shard_docs=shard_docs)
    got = search(index, spark.createDataFrame(items, ITEMS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 0, "")], DOCS), spark.createDataFrame([(1, "a c", 0, "")], ITEMS)
    assert search(build_index(docs.where("false")), items).count() == 0
    assert search(build_index(docs), items.where("false")).count() == 0
    assert [r.doc_id for r in search(build_index(docs.union(docs).union(docs.selectExpr("2", "'c'", "''", "0", "''"))), items, k=1).collect()] == [2]


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_BYTES", 10)
    raw = "Ab, cdefghijklmnopqrstuvwx Über;zz  1 2 3 4 5 6 7 8".encode()
    assert [t.decode() for piece in lexical.tokens(raw) for t in piece] == terms(raw.decode())


def test_blocks_that_cannot_compete_are_skipped():
    rng = np.random.default_rng(3)
    n, rows = 4096, []
    for t in range(12):  # long lists; documents 640 to 700 hold their best values
        docs = np.flatnonzero(rng.random(n) < 0.6)
        rows.append((docs, np.where((docs >= 640) & (docs < 700), 50, 1 + rng.integers(0, 2, len(docs)))))
    short = (np.array([5, 650, 3000]), np.array([9, 9, 9]))
    rows.append(short)
    row = {
        "ids": np.arange(n).tobytes(), "lengths": np.full(n, 100).tobytes(), "counts": np.array([len(d) for d, _ in rows]), "tf_bytes": 1,
        "docs": np.concatenate([d for d, _ in rows]).astype(np.uint16).tobytes(), "tfs": np.concatenate([v for _, v in rows]).astype(np.uint8).tobytes(),
    }
    shard = Shard(row, n, 100 * n)
    want = np.zeros(n, np.int64)
    for docs, tf in rows:
        want[docs] += 1000 * ((10**9 * tf) // (1000 * tf + 800))
    none = np.empty(0, np.int64)
    scores, ids = shard.search([(t, 1000) for t in range(13)], 10, (none, none))
    order = np.lexsort((np.arange(n), -want))[:10]
    assert ids.tolist() == order.tolist() and scores.tolist() == want[order].tolist()
    assert 0 < shard.visited < n // 64 // 2
