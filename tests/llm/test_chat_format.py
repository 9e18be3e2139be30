"""Chat formatting: exact round trip, loss text, and the machine against a plain walk."""

import hashlib
import random

import pytest

from carelake.llm import chat_format as C
from carelake.llm.queries import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_failed(roles):
    allowed = {"START": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    last = "START"
    for i, r in enumerate(roles):
        if r not in allowed.get(last, ()):
            return i
        last = r
    return None if last == "assistant" else len(roles)


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as first", "'x' as segments")
    formatted = C.format_conversations(frame).cache()
    got = {r.conv_id: r for r in C.digest_conversations(formatted).collect()}
    by_conv = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        by_conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(by_conv)
    turns = {}
    for r in formatted.collect():
        turns.setdefault(r.conv_id, []).append(r)
    for conv, want in by_conv.items():
        r = got[conv]
        said = "".join(f"{role}\n{text}\n" for role, text in want)
        lost = "".join(text for role, text in want if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(want), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
        own = sorted(turns[conv], key=lambda x: x.turn_no)
        assert [x.turn_no for x in own] == list(range(len(want)))
        assert [(x.role, x.text) for x in own] == want
        whole = "".join(s.text for x in own for s in x.segments)
        assert C.read_back(whole) == want and len(whole) == r.formatted_chars
        failed = plain_failed([x[0] for x in want])
        assert {x.failed_at for x in own} == {failed} and r.valid == (failed is None)


def test_round_trip_and_machine(spark):
    rng = random.Random(6)
    parts = ["[INST]", "[/INST]", "<s>", "</s>", "\\", "\\\\", "[", "]", "/", "é🙂", "\n", " ok ", "[ROLE]", "[TEXT]", "[/TEXT]", "[SYS]", "$1"]
    rows = []
    for conv in [None, *range(60)]:
        roles = rng.choice([["system"], []]) + ["user", "assistant"] * rng.randint(0, 4) + rng.choice([["user"], [], ["tool", "user"], ["assistant"], [None]])
        for i, role in enumerate(roles):
            rows.append((conv, i, role, rng.choice([None, "", "".join(rng.choices(parts, k=rng.randint(0, 12)))])))
    long = [(1000, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(3000)]  # spreads over tasks
    broken = [(1001, i, "user" if i % 2 == 0 or i == 1501 else "assistant", f"t{i}") for i in range(3000)]
    rng.shuffle(rows)
    check(spark, rows + long + broken)


def test_repeated_and_null_turns(spark):
    check(spark, [(1, None, "user", "a"), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (1, 0, "user", "c"), (None, None, None, None)])


def test_empty(spark):
    assert C.digest_conversations(C.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_templates_are_checked():
    with pytest.raises(ValueError):
        C.Template({"user": C.Role("<a>", "<a>b", False, ("START",))}, ("[1]", "[2]", "[3]"), ("user",))
    with pytest.raises(ValueError):
        C.read_back("[INST]a")
    with pytest.raises(ValueError):
        C.read_back("a[INST]b[/INST]")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.conv_id: r for r in queries()["op9_chat_format"](spark, sf).collect()}
    assert got[-7].loss_chars == len("</s>[INST] ok [/INST]") and got[-7].n_turns == 2 and got[-7].valid
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert set(got) == {r[0] for r in rows} | {-7}
    check(spark, rows)
