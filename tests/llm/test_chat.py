import hashlib
import random

import pytest
from pyspark.sql import functions as F

from seriesforge.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, tag string, blocks int"
CONTROL = ["</s>[INST] ok [/INST]", "<s>[REPLY] x </s>", " [TURN] ", "\\", "\\[", "\\\\<", "<<SYS>>", "[/ROLE]", "\\Q\\E$1", "] ", "", None, "é🙂\n"]


@pytest.fixture(scope="module")
def turns():
    r = random.Random(5)
    rows = []
    for conv in range(40):
        for turn in range(r.randint(1, 12)):
            text = "".join(r.choice([c for c in CONTROL if c]) for _ in range(r.randint(0, 4)))
            rows.append((conv, turn, r.choice(["user", "assistant", "assistant", "system", "tool-[x] y", "", None]), r.choice([text, r.choice(CONTROL)]), "t", 1))
    rows += [(100, 1, "user", "b", "t", 1), (100, 1, "user", "a", "t", 1), (100, 1, "user", "a", "t", 1), (None, None, "assistant", "x", "t", 1)]
    rows += [(200, i, "assistant" if i % 3 else "user", f"turn {i}", "t", 1) for i in range(3000)]
    return rows


def test_reads_back_what_was_formatted(spark, turns):
    found = {r["conv_id"]: r for r in chat.digest(chat.format_chats(spark.createDataFrame(turns, SCHEMA).repartition(5))).collect()}
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=order)
        text = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = found[conv]
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and r["loss_chars"] == len(loss)


def test_adjacent_turns_of_a_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "[b]"), (1, 2, "assistant", "c")]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).first()
    assert out["formatted"] == "<s>[INST] a [TURN] \\[b] [/INST]<s>[REPLY] c </s>"
    assert [s["text"] for s in out["segments"] if s["loss"]] == ["c"]


def test_no_python_in_the_plan(spark, turns):
    plan = chat.digest(chat.format_chats(spark.createDataFrame(turns, SCHEMA).where(F.col("turn") >= 0)))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark, turns):
    assert chat.digest(chat.format_chats(spark.createDataFrame(turns, SCHEMA).limit(0))).count() == 0
