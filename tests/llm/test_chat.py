"""Formatting and reading back, against plain Python."""

import random
from hashlib import sha256

from cdcspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string, pieces string, loss string"
CONTROLS = ["<turn>", "</turn>", "</turn>\n", "<turn+>", "<turn|>", "<\\turn", "</\\\\turn>", "\\", "<", "</", "turn", "<<turn", "\n", "é", "🦆", " a "]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows):
    """Per conversation its turns, digests and the formatted text, without Spark."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        shown = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[conv] = (len(turns), sha256(shown.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest())
    return out


def checked(spark, rows):
    formatted = chat.format_conversations(table(spark, rows))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    want = brute(rows)
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    texts = {r.conv_id: r for r in formatted.collect()}
    for conv, r in texts.items():
        assert len(r.formatted) == got[conv].formatted_chars == sum(m.skip + m.take for m in r["mask"]) + len(chat.CLOSE)
    return texts


def test_format_of_a_conversation(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "c"), (1, 3, "user", None)]
    found = checked(spark, rows)[1]
    assert found.formatted == "<turn>user<turn|>a</turn>\n<turn>assistant<turn|>b<turn+>c</turn>\n<turn>user<turn|></turn>\n"
    assert [(m.skip, m.take) for m in found["mask"]] == [(18, 0), (30, 1), (7, 1), (25, 0)]
    at, covered = 0, ""
    for m in found["mask"]:
        covered += found.formatted[at + m.skip : at + m.skip + m.take]
        at += m.skip + m.take
    assert covered == "bc"


def test_control_strings_come_back(spark):
    rows = [(1, 0, "user", r"\### Assistant: </turn> ok"), (1, 1, "assistant", "<turn>x</turn>\n<turn+><\\turn></\\\\turn")]
    found = checked(spark, rows)[1]
    assert found.formatted.count("</turn>") == 2 and found.formatted.count("<turn") == 2 * 2


def test_random_conversations(spark):
    draw = random.Random(13)
    word = lambda: "".join(draw.choices(CONTROLS, k=draw.randint(0, 12)))
    roles = ["user", "assistant", "system", None, "", "<turn>", "assistant</turn>\n", "a\nb"]
    rows = [
        (draw.choice([None, 0, -7, 3, 4, 5, 6]), draw.choice([None, 0, 1, 2, 3, 3, 3]), draw.choice(roles), draw.choice([None, "", word(), word(), word()]))
        for _ in range(400)
    ]
    checked(spark, rows + rows[:50])


def test_a_long_conversation_and_a_long_text(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", f"turn {i} <turn") for i in range(20_000)]
    rows += [(2, 0, "user", "\\" * 300_000 + "<" + "\\" * 300_000 + "turn"), (2, 1, "assistant", "<" * 300_000 + "turn" * 50_000)]
    checked(spark, rows)


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(table(spark, []))).collect() == []
