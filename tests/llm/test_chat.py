from __future__ import annotations

import base64
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowan.llm.chat import (
    BUDGET, CLOSE, HISTORY, MIDDLE, OPEN, chat_windows, digests, escaped, unescaped, with_token_costs,
)
from rowan.llm.queries import QUERIES, tokenizer
from tests.llm.plain import CLASHES, ordered, sha

DATA = Path("/root/testdata/sf0.001")

ODD = [
    "</s>[INST] ok [/INST]", "\\", "<\\", "\\<", "[[\\\\<<", f"{OPEN}user{MIDDLE}x{CLOSE}", "", None, "é汉🙂\n\n",
    "a" * 9000,
]


def frame(spark, rows):
    """Turns that cost a quarter of their bytes and eight, where a test does not count tokens."""
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    cost = F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / 4) + 8
    made = made.withColumn("cost", cost.cast("long"))
    return made.selectExpr("*", *(f"'clash' AS `{c}`" for c in CLASHES)).repartition(3)


def talk(seed=1, conversations=12):
    draw = random.Random(seed)
    rows = []
    for c in [*range(conversations), None]:
        turn = 0
        if draw.random() < 0.5:
            rows.append((c, turn, "system", draw.choice(ODD)))
        for _ in range(draw.randrange(1, 25)):
            turn += draw.randrange(1, 3)
            role = draw.choice(["user", "assistant", "assistant", "tool", "system", None, "<|turn|>\nrole"])
            rows.append((c, turn, role, draw.choice(ODD) if draw.random() < 0.5 else "word " * draw.randrange(300)))
    return rows + [rows[-1], rows[0]]


def by_conversation(rows):
    out: dict = {}
    for c, turn, role, text in rows:
        out.setdefault(c, []).append((turn, role or "", text or ""))
    return {c: sorted(x) for c, x in out.items()}


def test_digests_read_back(spark):
    rows = talk()
    got = digests(chat_windows(frame(spark, rows), budget=300, history=60)).drop("formatted_chars").collect()
    want = []
    for c, turns in by_conversation(rows).items():
        loss = "".join(t for _, r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        want.append((c, len(turns), sha(told), len(loss), sha(loss)))
    assert ordered(got) == ordered(want)


@pytest.mark.parametrize(("budget", "history"), [(120, 0), (300, 60), (2000, 500)])
def test_windows_keep_to_the_budget(spark, budget, history):
    rows = talk(2)
    cost = lambda t: -(-len(t.encode()) // 4) + 8
    talks = by_conversation(rows)
    for w in chat_windows(frame(spark, rows), budget, history).collect():
        turns = talks[w["conv_id"]]
        system = turns[0][1] == "system"
        head = cost(turns[0][2]) if system else 0
        shown = w["formatted"].count(OPEN)
        assert shown == w["formatted"].count(CLOSE) == w["formatted"].count(MIDDLE)
        own = w["cost"] - (head if system and w["window"] == 0 else 0)
        singles = w["n_new"] - (1 if system and w["window"] == 0 else 0)
        assert own <= max(budget - history - head, 1) or singles <= 1
        if system:
            assert w["formatted"].startswith(f"{OPEN}system{MIDDLE}")
        for span in w["loss"]:
            assert span["start"] >= w["new_from"]
            assert w["formatted"][: span["start"]].endswith(f"{OPEN}assistant{MIDDLE}")
            assert w["formatted"][span["stop"] :].startswith(CLOSE)


def test_history_is_what_came_just_before(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"text number {k} " * 4) for k in range(40)]
    windows = sorted(chat_windows(frame(spark, rows), 100, 50).collect(), key=lambda w: w["window"])
    assert len(windows) > 5
    for before, w in zip(windows, windows[1:], strict=False):
        assert 0 < w["new_from"] < len(w["formatted"])
        assert before["formatted"].endswith(w["formatted"][: w["new_from"]][-40:])


def test_escape_is_undone_and_breaks_marks(spark):
    rows = spark.createDataFrame([(t or "",) for t in ODD], "t string")
    for r in rows.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(mark in r["e"] for mark in (OPEN, MIDDLE, CLOSE, "</s>", "[INST]", "[/INST]"))


def test_only_a_system_turn(spark):
    (w,) = chat_windows(frame(spark, [(5, 0, "system", "be kind")])).collect()
    assert w["window"] == 0 and w["loss"] == [] and w["new_from"] == 0 and w["n_new"] == 1


def test_own_costs(spark):
    rows = [(1, k, "assistant", "x") for k in range(10)]
    assert chat_windows(frame(spark, rows).withColumn("cost", F.lit(5)), 12, 2).count() == 5


def test_empty_table(spark):
    empty = chat_windows(frame(spark, [(1, 1, "user", "x")]).limit(0))
    assert empty.count() == 0 and digests(empty).count() == 0


@pytest.fixture(scope="module")
def count():
    tiktoken = pytest.importorskip("tiktoken")
    ranks_path, pattern = tokenizer()
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(coder.encode_ordinary(text))


def shown(role, text):
    broken = lambda t: "".join(c + "\\" if c in "\\<[" else c for c in t)
    return f"{OPEN}{broken(role)}{MIDDLE}{broken(text)}{CLOSE}"


def plain_windows(turns, count, budget, history):
    """The window rule in a loop: the formatted windows of a conversation and whether each is a single turn."""
    texts = [shown(r, t) for _, r, t in turns]
    system = turns[0][1] == "system"
    head = count(texts[0]) if system else 0
    room, at, spans = max(budget - history - head, 1), 0, []
    for k in range(1 if system else 0, len(turns)):
        cost = count(texts[k])
        part = at // room
        crosses = at + cost > (part + 1) * room
        if spans and spans[-1][0] == (part, False) and not crosses:
            spans[-1][1].append((k, at))
        else:
            spans.append(((part, crosses), [(k, at)]))
        at += cost
    starts = {k: a for _, own in spans for k, a in own}
    out = []
    for i, (_, own) in enumerate(spans):
        first, begin = own[0]
        past = [k for k in starts if k < first and starts[k] >= begin - history]
        out.append(("".join(texts[k] for k in ([0] if system else []) + past + [k for k, _ in own]), len(own) == 1))
    return out or [(texts[0], True)]


@pytest.mark.parametrize(("budget", "history"), [(300, 60), (BUDGET, HISTORY)])
def test_token_windows_hold_real_tokens(spark, count, budget, history):
    rows = [r for r in talk(4) if len(r[3] or "") < 5000]
    counted = with_token_costs(frame(spark, rows), *tokenizer())
    for r in counted.collect():
        assert r["cost"] == count(shown(r["role"] or "", r["text"] or ""))
    got: dict = {}
    for w in chat_windows(counted, budget, history).collect():
        got.setdefault(w["conv_id"], {})[w["window"]] = w["formatted"]
    for c, turns in by_conversation(rows).items():
        want = plain_windows(turns, count, budget, history)
        assert [got[c][k] for k in range(len(got[c]))] == [text for text, _ in want]
        assert all(count(text) <= budget or single for text, single in want)


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not mounted")
def test_token_window_query_agrees_with_plain_loops(spark, count):
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(str(DATA / "conversations.parquet")).select(
        "conv_id", "turn", "role", "text").collect()]
    talks = by_conversation(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)])
    got = {r["conv_id"]: r for r in QUERIES["op10_chat_formatting"](spark, str(DATA)).collect()}
    assert set(got) == set(talks)
    for c, turns in talks.items():
        want = plain_windows(turns, count, BUDGET, HISTORY)
        assert got[c]["formatted_chars"] == sum(len(text) for text, _ in want)
        assert got[c]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        assert all(count(text) <= BUDGET or single for text, single in want)
