import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm.merkle import Block, address, build, fold, height_of, lower_ascii, manifest, nodes, proofs, verify

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf int, tree string, at string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, i):
    runs = []
    for level in levels[:-1]:
        runs.append((i % 16, level[i // 16 * 16 : i // 16 * 16 + 16]))
        i //= 16
    return runs


def brute(rows):
    groups = {}
    for doc_id, text, lang, source, n, *_ in rows:
        low = text and "".join(c.lower() if c.isascii() else c for c in text)
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        leaf = leaf_of((doc_id, source, lang, n, text))
        groups.setdefault(source, []).append((doc_id is not None, doc_id, leaf, leaf_of((doc_id, source, lang, n, low)) if bad else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_of([r[2] for r in groups[s].sort() or groups[s]]) for s in order]
    over = levels_of([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, (_, doc_id, leaf, claimed) in enumerate(groups[s]):
            cur, proof = claimed, ""
            for own, run in siblings(trees[k], i) + siblings(over, k):
                proof += "".join(run[:own] + run[own + 1 :])
                cur = h("".join(run[:own] + [cur] + run[own + 1 :]))
            out.append((doc_id, leaf, trees[k][-1][0], over[-1][0], h(proof), cur))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, DOCS).repartition(parts)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, FIELDS, "source", "doc_id", {"text": lower_ascii(F.col("text"))}, tampered)


def shown(rows):
    return sorted(((r.id, *(bytes(r[c]).hex() for c in ("leaf", "subroot", "root", "proof", "folded"))) for r in rows), key=str)


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096])
def test_addresses_fill_a_block_once_and_keep_lower_trees_together(leaves):
    height = height_of(leaves)
    seen = np.concatenate([address(height + 1, leaves, d, np.arange(-(-leaves // 16 ** (height - d)))) for d in range(height + 1)])
    assert sorted(seen) == list(range(nodes(height + 1, leaves)))
    if height == 3:  # two levels above, then trees of two levels, each in one piece
        low, last = address(4, leaves, 2, np.arange(-(-leaves // 16))), address(4, leaves, 3, np.arange(leaves))
        assert (last == low[np.arange(leaves) // 16] + 1 + np.arange(leaves) % 16).all()


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257, 1000])
def test_block_paths_fold_to_its_root(n):
    leaves = [hashlib.sha256(bytes([i % 251, i // 251])).digest() for i in range(n)]
    block = Block(build(leaves, height_of(n)), n, n)
    want = levels_of([x.hex() for x in leaves])[-1][0]
    assert all(fold(leaves[i], block.path(i)).hex() == want for i in range(0, n, 7))
    assert n == 1 or fold(leaves[0], block.path(n - 1)).hex() != want


def test_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, f"Text {rng.random()} Ünd", "en", f"s{min(rng.randrange(60), 21)}", i % 9, 0, "", "") for i in range(1500)]
    rows += [(5000, None, None, None, None, 1, "x", None), (5001, "", "", "", 0, 1, "x", None), (None, "No id", "en", None, 3, 1, "x", None), (None, None, None, "s1", None, 1, "", "")]
    rows += [(5002, "Long Text " * 50_000, "de", "é", 1, 0, "", ""), (5003, "One alone", "de", "zz", 1, 0, "", "")]
    rows += [rows[3]] * 40 + [(rows[4][0], "Same id", *rows[4][2:])]
    made = run(spark, rows)
    assert shown(verify(made).collect()) == brute(rows)
    root = brute(rows)[0][3]
    for r in proofs(made).collect():
        assert fold(bytes(r.leaf), [(a, bytes(s)) for a, s in zip(r["at"], r.siblings)]).hex() == root


def test_trees_of_several_tiers(spark):
    rows = [(i, f"T{i}", None, "hot" if i % 3 else f"s{i % 5000}", None, 0, "", "") for i in range(14_000)]
    made = run(spark, rows, 5)
    assert len(made.groups) == 2 and len(made.over) == 2
    assert shown(verify(made).collect()) == brute(rows)


def test_empty_and_single(spark):
    assert verify(run(spark, [])).count() == 0
    rows = [(10, "ONE", None, None, None, 0, "", "")]
    assert shown(verify(run(spark, rows)).collect()) == brute(rows)
