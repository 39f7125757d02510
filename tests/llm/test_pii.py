import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flowloom.llm.pii import before, contexts, digest, sanitise

DOCS = "doc_id long, text string, spans string, row int, key string, terms string"
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{3,}"
TOKEN = re.compile("|".join([BASE["phone"].pattern, BASE["ip"].pattern, r"[0-9](?:[\x20-]?[0-9]){12,}", TERM]))


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def low(s):
    return "".join(c.lower() if c.isascii() else c for c in s)


def tokens(text):
    """(token, start) in order: e-mail addresses, and the other tokens between them."""
    out, at = [], 0
    for m in [*BASE["email"].finditer(text), None]:
        gap = text[at : m.start() if m else len(text)]
        out += [(t[0], at + t.start()) for t in TOKEN.finditer(gap)]
        if m:
            out.append((m[0], m.start()))
            at = m.end()
    return out


def is_term(t):
    return re.fullmatch(TERM, t) and not re.fullmatch("[0-9]{13,}", t)


def entity(t):
    d = re.sub("[^0-9]", "", t)
    if "@" in t:
        return "email:" + low(t)
    if t[0] == "+":
        return "phone:" + d if valid("phone", t) else None
    if "." in t:
        return "ip:" + t if valid("ip", t) else None
    return "card:" + d if valid("card", t) else None


def flagged(texts, window=8, least=3, generalise=0.9):
    where, of_entity, of_term = defaultdict(lambda: defaultdict(set)), defaultdict(set), Counter()
    for row, text in enumerate(texts):
        toks = [t for t, _ in tokens(text)]
        of_term.update({low(t) for t in toks if is_term(t)})
        for i, t in enumerate(toks):
            if not is_term(t) and (e := entity(t)):
                of_entity[e].add(row)
                near = [low(x) for x in toks[max(0, i - window) : i + window + 1] if is_term(x)]
                for x in near:
                    where[e, x][row].add(tuple(near))
    n, out = len(texts), {}
    for (e, x), rows in where.items():
        ne = len(of_entity[e])
        if ne < n and len({min(c) for c in rows.values()}) >= least:
            share = math.log(len(rows) * n / (ne * of_term[x])) / math.log(n / ne)
            if share >= generalise:
                out[x] = max(out.get(x, 0), share)
    return out


def brute(rows):
    texts = [t or "" for _, t, *_ in rows]
    told = flagged(texts)
    out = []
    for (doc_id, *_), text in zip(rows, texts):
        base = [(k, *m.span()) for k, rx in BASE.items() for m in rx.finditer(text) if valid(k, m[0])]
        added = [("term", at, at + len(t)) for t, at in tokens(text) if is_term(t) and low(t) in told]
        out.append((doc_id, [b for b in base + added]))
    return sorted(out, key=str)


def tables(rng):
    words = [f"wort{i}" for i in range(300)] + ["Über", "ñandú"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = []
    for i in range(120):
        rows.append((i, f"{prose(30)} call +1 (555) 010-{1000 + i}, or {rng.randrange(300)}.2.3.{i} {prose(20)}"))
    for i in range(12):  # one person's address in different contexts, always beside the nickname and a badge number
        rows.append((200 + i, f"{prose(10)} Zaphod badge 774411 zaphod.b@mail{'.'}example.org {prose(10)}"))
    rows += [(300 + i, f"{prose(9)} zaphod met someone") for i in range(1)]  # discloses also where the address is not
    copied = prose(5) + " uniqueword other@mail.example.org " + prose(5)
    rows += [(400 + i, copied) for i in range(50)]  # copies prove nothing
    odd = [
        "a@b.c_d@e.f.g x", "@a.b", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.001.1.1", "99999999999999999999.1.1.1", "4041894974608795-", "4041 8949-7460 8795 1", "4041894974608796", "0000000000000",
        "+1-2", "+12 3456789 0123456.", "+1(((((((((234567890", "é.foo@x.com jürgen.smith@mail.com", "𝒳𝒴 4041894974608795 𝒳 a@b.co", "+1 22 4041894974608795", "x" * 3_000, "1" * 3_000, "1-" * 1_500, "a." * 2_000 + "@", "+1" + " " * 3_000, "1." * 3_000, "", None,
    ]
    rows += [(500 + i, t) for i, t in enumerate(odd)]
    rows += [(None, "no id: a@b.co"), rows[0], (0, "another text 10.0.0.1")]
    return [(i, t, None, 0, "", "") for i, t in rows]


def test_matches_brute_force(spark):
    rows = tables(random.Random(1))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in sanitise(docs).collect()), key=str)
    assert got == brute(rows)
    told = flagged([t or "" for _, t, *_ in rows])
    assert {"zaphod", "774411"} <= set(told) and "uniqueword" not in told and "call" not in told


def test_clean_text(spark):
    rows = tables(random.Random(2))
    clean = {r.doc_id: r.clean for r in sanitise(spark.createDataFrame(rows, DOCS)).where("doc_id between 200 and 530").collect()}
    assert "aphod" not in clean[205] and "774411" not in clean[205] and "<EMAIL>" in clean[205] and "badge" not in clean[205]
    assert clean[300].endswith("met someone") and "zaphod" not in clean[300]
    assert clean[500] == "<EMAIL><EMAIL> x" and clean[501] == "@a.b" and clean[523] is None and clean[522] == ""
    assert clean[514] == "𝒳𝒴 <CARD> 𝒳 <EMAIL>"
    copy = clean[410]
    assert "uniqueword <EMAIL>" in copy


def test_generalised_terms_keep_a_category(spark):
    rows = [(i, f"t{i} u{i} Zaphod 774411 z@mail.example.org v{i}" if i < 20 else f"Zaphod 774411 w{i}" if i < 24 else f"other x{i}", "", 0, "", "") for i in range(400)]
    got = {r.doc_id: r.clean for r in sanitise(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0] == "t0 u0 <NAME> <NUMBER> <EMAIL> v0" and got[23] == "<NAME> <NUMBER> w23" and got[30] == "other x30"


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100])
def test_prefix_folds(spark, n):
    df = spark.createDataFrame([([(i * 7) % 11 for i in range(n)],)], "v array<long>")
    r = df.select(before(F.col("v"), lambda a, b: a + b).alias("s"), before(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).first()
    v = [(i * 7) % 11 for i in range(n)]
    assert r.s == [sum(v[:i]) for i in range(n)] and r.m == [max(v[:i], default=0) for i in range(n)]


def test_very_long_runs_take_linear_time(spark):
    runs = ["x" * 300_000, "1" * 300_000, "a." * 150_000 + "@", "+1" + " " * 300_000, "1." * 150_000, "a@b.c_" * 20_000, "1 " * 150_000]
    began = time.time()
    got = {r.doc_id: r.n for r in sanitise(spark.createDataFrame([(i, t, "", 0, "", "") for i, t in enumerate(runs)], DOCS)).selectExpr("doc_id", "size(spans) n").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 37_500, 5: 20_000, 6: 0}
    assert time.time() - began < 90


def test_empty_table_and_plan(spark):
    assert digest(sanitise(spark.createDataFrame([], DOCS))).count() == 0
    docs = spark.createDataFrame(tables(random.Random(3)), DOCS)
    for df in (contexts(docs), sanitise(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
