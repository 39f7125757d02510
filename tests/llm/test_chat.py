import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from flowloom.llm.chat import CLOSE, HEAD, OPEN, escape, expand, read_back, unescape

ROWS = "text string, conv_id long, role string, turn long, example string, formatted int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def talks(rng):
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]", "é", "\n", " ", "汉\U0001f600", "\\<s>", "<\\s>", "$1"]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
            rows.append((None if rng.random() < 0.1 else text, c, rng.choice(["user", "assistant", "assistant", "system", None, "[/INST]", "assistant</s>"]), t, "x", 1))
    rows += [("a", None, "user", 0, "", 0), ("b", None, "assistant", 1, "", 0), ("tie", 70, "user", 1, "", 0), ("tie", 70, "user", 1, "", 0), ("z", 70, "assistant", None, "", 0), ("long " * 40000, 71, "assistant", 0, "", 0)]
    rows += [(f"turn {t}", 72, ("user", "assistant")[t % 2], t, "", 0) for t in range(80)]
    rng.shuffle(rows)
    return rows


def test_round_trip(spark):
    rows = talks(random.Random(6))
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    want = defaultdict(list)
    for text, conv, role, turn, *_ in rows:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    got = {r.conv_id: r for r in read_back(expand(df)).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{x}\n" for _, _, a, x in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_examples_hold_their_context_and_one_reply(spark):
    rows = [("hi", 1, "user", 0, "", 0), ("yo", 1, "assistant", 1, "", 0), ("so", 1, "assistant", 2, "", 0), ("bye", 1, "user", 3, "", 0)]
    got = expand(spark.createDataFrame(rows, ROWS)).orderBy("example").collect()
    turn = lambda role, text: OPEN + role + HEAD + text + CLOSE
    whole = [turn("user", "hi"), turn("assistant", "yo"), turn("assistant", "so"), turn("user", "bye")]
    assert [r.formatted for r in got] == ["".join(whole[:2]), "".join(whole[:3]), "".join(whole)]
    assert [r.formatted[r.loss_start : r.loss_end] for r in got] == ["yo", "so", ""]


def test_escaped_text_has_no_control_string(spark):
    texts = ["<s></s>[INST][/INST]", "\\", "<\\/s>", "[\\INST]\\\\", "<<s>>", "[[/INST]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_empty_table(spark):
    assert read_back(expand(spark.createDataFrame([], ROWS))).count() == 0
