import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flowloom.llm.mixing import mix, mixed_documents

DOCS = "doc_id long, text string, source string, size string, target int, key string"


def rows(rng, sources=7, n=400):
    hot = [(i, " ".join("w" * rng.randint(1, 12) for _ in range(rng.randint(0, 90))), f"s{0 if rng.random() < 0.4 else rng.randrange(sources)}", "", 0, "") for i in range(n)]
    return [*hot, (n, None, "s1", None, None, None), (n + 1, "a\tb\x0bc d", None, "", 0, ""), (n + 2, "x y", None, "", 0, ""), (None, "no id", "s2", "", 0, ""), (n + 3, "long " * 30000, "s3", "", 0, ""), hot[3], (n + 4, "", "empty", "", 0, "")]


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, todo = 1.5 * sum(sizes.values()), {}, set(order)
    while todo:
        level = left / sum(weight[s] for s in todo)
        full = {s for s in todo if level * weight[s] > 2 * sizes[s]}
        for s in full or todo:
            target[s] = 2.0 * sizes[s] if full else level * weight[s]
            left -= target[s]
        todo -= full or todo
    return target


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_are_met(spark, seed):
    data = rows(random.Random(seed), sources=3 + 4 * seed)
    got = mix(spark.createDataFrame(data, DOCS).repartition(4)).collect()
    assert len(got) == len(data)
    source = {r[0]: r[2] for r in data}
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for i, t, s, *_ in data:
        sizes[s] += words(t)
        largest[s] = max(largest[s], words(t))
    want = targets(sizes)
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken in {0, r.size, 2 * r.size}
        if want[s] >= sizes[s] > 0:
            assert r.taken >= r.size  # complete epochs come first
    assert all(abs(taken[s] - want[s]) <= 1.5 * largest[s] + 1e-6 for s in sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = mix(spark.createDataFrame(data, DOCS).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_fraction_follows_the_keys_and_weights(spark):
    data = [(i, "a b c d e", "x" if i < 2000 else "y", "", 0, "") for i in range(4000)]
    df = spark.createDataFrame(data, DOCS)
    heavy = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = {r.doc_id: r.taken for r in mix(df, weights=(1, 9), share_percent=110, weight=heavy).collect()}
    x = [i for i in range(2000) if got[i]]
    assert sum(got[i] for i in range(2000)) == pytest.approx(0.11 * 20000, abs=5)
    assert sum(i % 2 == 0 for i in x) > 0.7 * len(x)


def test_documents_are_repeated(spark):
    df = spark.createDataFrame(rows(random.Random(4)), DOCS)
    taken = {(r.doc_id, r.size): r.taken for r in mix(df).collect()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    copies = Counter((r.doc_id, words(r.text)) for r in out.collect())
    assert all(copies[k] * k[1] in (v, 2 * v) for k, v in taken.items())  # one row of the table is there twice


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert mix(df).count() == 0 and mixed_documents(df).count() == 0
    only = spark.createDataFrame([(1, None, None, "", 0, "")], DOCS)
    assert [tuple(r) for r in mix(only).collect()] == [(1, 0, 0, 0.0, 0)]


@pytest.mark.parametrize("extra", [0, 700])
def test_equal_rows_are_taken_one_by_one(spark, extra):
    """A source of copies of one row, with or without others around them, meets its target."""
    data = [(7, "a b c d", "x", "", 0, "")] * 1000 + [(100 + i, "e f g", "x", "", 0, "") for i in range(extra)] + [(None, "h i", None, "", 0, "")] * 90
    df = spark.createDataFrame(data, DOCS).repartition(5)
    got = mix(df).collect()
    sizes = {4000 + 3 * extra: 4, 180: 2}
    for size, most in sizes.items():
        rows_of = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in rows_of) - rows_of[0].target) <= most / 2 and len(rows_of) in (1000 + extra, 90)
    assert mixed_documents(df).count() == sum(r.taken // r.size for r in got)
