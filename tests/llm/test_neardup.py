import random

import pytest

from flowloom.llm.components import components
from flowloom.llm.neardup import Linker, WordHashes, keep_one, near_duplicates, shingles

DOCS = "doc_id long, text string, n string, fp int, rep string"


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows, width, percent):
    sets = {}
    for i, t, *_ in rows:
        words = ascii_lower(t or "").encode().split()
        size = min(width, len(words))
        sets[i] = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)} if words else set()
    ids = sorted(k for k in sets if k is not None)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                c = len(sets[x] & sets[y])
                if 100 * c >= percent * (len(sets[x]) + len(sets[y]) - c):
                    p, q = sorted((find(x), find(y)))
                    root[q] = p
    return sorted((str(i), len(sets[i]), None if i is None else find(i)) for i, *_ in rows)


def corpus(rng):
    word = lambda: "w%d" % rng.randint(0, 3000)
    fresh = lambda n: [word() for _ in range(n)]
    texts = []
    for _ in range(25):  # chains of growing edits around the limit
        base = fresh(rng.choice([6, 20, 60, 200]))
        texts.append(base)
        for _ in range(rng.randint(1, 5)):
            base = list(base)
            for _ in range(max(1, len(base) // 60)):
                base[rng.randrange(len(base))] = word()
            texts.append(base)
    passage, base = fresh(50), fresh(90)
    texts += [fresh(60) + passage + fresh(40) for _ in range(90)]  # a common passage, not similar
    texts += [passage + fresh(8) for _ in range(90)]  # mostly the passage
    for _ in range(90):  # a large group of near copies of which few pairs are linked except by the base
        t = list(base)
        t[rng.randrange(90)] = word()
        t[rng.randrange(90)] = word()
        texts.append(t)
    texts += [passage] * 80 + [["A", "b"], ["a", "B"], ["c"], [], ["É", "x"], ["é", "x"]]
    rng.shuffle(texts)
    rows = [(i, (" " if i % 2 else "\n\t").join(t), "x", 1, None) for i, t in enumerate(texts)]
    return [*rows, (5000, None, None, None, None), (5001, " \n ", "", 0, ""), (None, "no id here at all", "", 0, ""), rows[3], rows[3], (5002, "long " * 30000, "", 0, "")]


@pytest.mark.parametrize("width,hot", [(4, 16), (5, 64)])
def test_matches_brute_force(spark, width, hot):
    rows = corpus(random.Random(width))
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5), width=width, percent=80, hot=hot).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == brute(rows, width, 80)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def dense_group(others, tail):
    """Two texts whose common values are all hot, in a group whose centres resemble neither of them."""
    passage, end = [f"p{i}" for i in range(30)], [f"e{i}" for i in range(7)]
    texts = [[*passage, *(f"x{i}" for i in range(tail))], [*(f"y{i}" for i in range(tail)), *passage]]
    texts += [[*passage, *end, f"o{i}"] for i in range(others)]
    return [(i + 1, " ".join(t), "", 0, "") for i, t in enumerate(texts)]


@pytest.mark.parametrize("copies", [(2, 1), (1, 2), (3, 2)])
def test_repeated_rows_in_a_dense_group(spark, copies):
    rows = dense_group(80, 3)
    rows += [rows[0]] * (copies[0] - 1) + [rows[1]] * (copies[1] - 1)
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    want = brute(rows, 5, 80)
    assert {c for i, _, c in want if i in ("1", "2")} == {1}
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == want


def scattered(copies):
    """Copies of one text with edits in different places, about half of them too many for a link with it."""
    rng = random.Random(copies)
    base = [f"b{i}" for i in range(150)]
    texts = [base]
    for c in range(copies):
        t = list(base)
        for e in range(rng.randint(1, 8)):
            t[rng.randrange(150)] = f"n{c}-{e}"
        texts.append(t)
    for c in range(0, copies, 9):  # linked with a far copy, and only so with anything
        t = list(texts[c + 1])
        t[rng.randrange(150)] = f"m{c}"
        texts.append(t)
    return [(i + 1, " ".join(t), "", 0, "") for i, t in enumerate(texts)]


def test_pairs_of_a_group_grow_with_its_size(spark, monkeypatch):
    """Far copies are told apart by their differences from the centre, without a pair each."""
    made, links = [], Linker.links
    monkeypatch.setattr(Linker, "links", lambda self, pairs, *more: made.append(pairs.count()) or links(self, pairs, *more))
    rows = scattered(300)
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5), hot=16).collect()
    want = brute(rows, 5, 80)
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == want
    assert 1 < len({c for *_, c in want}) < len(rows) and sum(made) < 12 * len(rows)


def test_common_values_are_hot_and_few_of_the_sketch(spark):
    """Similarity is 0.8, but only 26 of the 48 retained values of the first text are common ones."""
    rng, hashes, low = random.Random(1), WordHashes(), int(0.3 * 2**63)

    def grow(words, wanted):
        for below in wanted:
            while True:
                new = [*words, "w%d" % rng.randint(0, 10**9)]
                if len(new) < 5 or (shingles(" ".join(new[-5:]).encode(), 5, hashes)[0] < low) == below:
                    break
            words = new
        return words

    passage = grow([], [False] * 4 + [True] * 26 + [False] * 62)
    end = [f"e{i}" for i in range(28)]
    texts = [grow(passage, [True] * 22), passage]
    texts += [[*passage, *end, f"o{i}"] for i in range(80)]
    texts += [[*end, *(f"z{i}-{j}" for j in range(30))] for i in range(200)]
    rows = [(i + 1, " ".join(t), "", 0, "") for i, t in enumerate(texts)]
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    want = brute(rows, 5, 80)
    assert {c for i, _, c in want if i in ("1", "2")} == {1}
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == want


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)), "x", i, "r") for i in range(12)]
    copy = lambda of, new, extra="x": (new, rows[of][1], extra, 0, None)
    near = " ".join([*rows[5][1].split()[:-1], "changed"])
    rows += [
        copy(3, 7), copy(3, 20), copy(3, 2), copy(4, 4, "b"), copy(4, 4, "a"), (5, near, "x", 0, ""), (5, rows[5][1].upper(), "x", 0, ""), (30, near, "x", 0, ""),
        (None, rows[6][1], "x", 0, ""), (None, None, None, None, None), (40, None, "x", 0, ""), (40, "", "x", 0, ""), (40, " ", "x", 0, ""), (41, None, "x", 0, ""),
    ]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    out = keep_one(docs)
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    # brute force: groups of (id, text), then the first of each
    want, groups = [], {}
    for r in {(i, t) for i, t, *_ in rows if i is not None and (t or "").split()}:
        groups[r] = frozenset({tuple(w[j : j + 5]) for w in [r[1].lower().split()] for j in range(len(w) - 4)})
    for r, s in groups.items():
        alike = [o for o, u in groups.items() if 100 * len(s & u) >= 80 * len(s | u)]
        if r[0] == min(i for i, _ in alike):
            want.append((r[0], r[1], sorted(o[1] for o in alike if o[0] == r[0])))
    kept = {(i, t) for i, t, *_ in got if i is not None and (t or "").split()}
    assert {i for i, _ in kept} == {i for i, *_ in want} and len(kept) == len([1 for i, *_ in want if i != 5]) + 1
    assert all(t in own for i, t in kept for j, u, own in want if (i, t) == (j, u))
    assert len([r for r in got if r[0] == 4]) == 1 and (7, rows[7][1]) in kept and (7, rows[3][1]) not in kept
    assert len([r for r in got if r[0] is None]) == 2 and len([r for r in got if r[0] in (40, 41)]) == 4


def test_empty_table_and_nothing_alike(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    got = near_duplicates(spark.createDataFrame([(2, "a b c d e f", "", 0, ""), (1, "g h i j k l", "", 0, "")], DOCS)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2)]


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(7, 160), (1, 2), (2, 2)]
    got = {r.id: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 7 for i in range(100, 161)}, 7: 7, 1: 1, 2: 1}
