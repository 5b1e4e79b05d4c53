import hashlib

import pytest

from codexmill.llm import chat

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def final(spark, events):
    rows = chat.render(spark.createDataFrame(events, EVENTS)).collect()
    return {c: [x for r in sorted((r for r in rows if r["conv_id"] == c), key=lambda r: r["part"]) for x in chat.parse(r["formatted"])] for c in {r["conv_id"] for r in rows}}


def test_fold(spark):
    events = [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 2, "delta", "assistant", "he"), (1, 1, 3, "delta", None, "llo"), (1, 1, 4, "regenerate", None, ""), (1, 1, 5, "delta", None, "bye"),
        (2, 0, 1, "message", "user", "old"), (2, 1, 2, "message", "assistant", "dropped"), (2, 0, 3, "edit", None, "new"), (2, 1, 4, "message", "assistant", "fresh"),
        (3, 0, 1, "message", "user", "gone"), (3, 0, 2, "delete", None, None), (3, 1, 3, "message", None, None),
    ]
    assert final(spark, events) == {1: [("user", "hi"), ("assistant", "bye")], 2: [("user", "new"), ("assistant", "fresh")], 3: [("", "")]}


@pytest.mark.parametrize("text", ["", "\\", "</turn>", '<turn "user">\n', "\\### Assistant: </turn> ok", "\n</turn>\n", "a\\<b\\\\", 'q"">', "é\U0001f600\n\n", "[INST] <|im_end|> ###"])
def test_round_trip(spark, text):
    assert chat.unescape(chat.escape(text)) == text
    rendered = chat.OPEN + chat.escape(text) + chat.BETWEEN + chat.escape(text) + chat.CLOSE
    assert list(chat.parse(rendered * 2)) == [(text, text)] * 2
    assert "</turn>" not in chat.escape(text)


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_digests(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 50)
    rows = [(5, 1, "assistant", "b"), (5, 0, "user", "a"), (6, 0, None, None), (6, 0, "user", "tie"), (None, 2, "user", "x"), (8, None, "assistant", "y" * 300), (8, 1, "assistant", "z</turn>"), (8, 1, "assistant", "z</turn>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'own' as seq", "'own' as kind", "1 as part")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.op2_chat_format(df).collect()}
    own = r"\### Assistant: </turn> ok"
    assert got == {5: expected([("user", "a"), ("assistant", "b")]), 6: expected([("", ""), ("user", "tie")]), None: expected([("user", "x")]), 8: expected([("assistant", "y" * 300)] + [("assistant", "z</turn>")] * 2), -7: expected([("user", own), ("assistant", own)])}
    assert chat.op2_chat_format(df.limit(0)).count() == 1


@pytest.mark.parametrize("text", ["a" * 3_000_000 + "<\n", "<\\" * 1_000_000, "é\n</turn>\n" * 400_000])
def test_very_long_messages(spark, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", "end")]
    got = chat.op2_chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("conv_id = 1").first()
    assert tuple(got)[1:5] == expected([r[2:] for r in rows])


def test_a_long_message_takes_little_memory():
    import tracemalloc

    text = '\\<>"|' * 2_000_000
    formatted = chat.OPEN + "user" + chat.BETWEEN + chat.escape(text) + chat.CLOSE
    tracemalloc.start()
    (_, span), = chat.turns(formatted)
    assert sum(len(x) for x in chat.unescaped(formatted, *span)) == len(text)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()


def test_pieces_end_between_characters(monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 3)
    for text in ("\\\\<a|", "<" * 9, "ab\\", ""):
        e = chat.escape(text)
        assert "".join(chat.unescaped(e, 0, len(e))) == text


def test_what_is_not_the_template_is_an_error():
    for text in ("x", '<turn "user">', '<turn "user">\nabc'):
        with pytest.raises(ValueError):
            list(chat.parse(text))
