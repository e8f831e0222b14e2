from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from feedlake.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string"


def digests(rows):
    """What must be read back, worked out from the rows themselves."""
    by = defaultdict(list)
    for key, turn, role, text in rows:
        by[key].append((turn is None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for key, turns in by.items():
        turns.sort()
        loss = b"".join(t[3] for t in turns if t[2] == b"assistant")
        said = b"".join(t[2] + b"\n" + t[3] + b"\n" for t in turns)
        out[key] = (len(turns), hashlib.sha256(said).hexdigest(), len(loss.decode()), hashlib.sha256(loss).hexdigest())
    return out


def through(spark, rows, extra=False):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        table = table.selectExpr("*", "1 as id", "'x' as record", "2 as n", "'y' as piece", "'z' as layout")
    turns = c.canonical_turns(c.as_records(table, "conv_id", ["turn", "role", "text"]))
    return c.formatted(turns), {r.conv_id: tuple(r)[1:5] for r in c.read_back(c.formatted(turns)).collect()}


def test_round_trip_of_control_strings(spark):
    pick = random.Random(3)
    parts = ["\\", "<turn ", "</turn>", "\n", "### ", "#", "<|", "<", ">", "\\\\", "é", "😀", "\x00", "\n</turn>\n", "### Assistant:"]
    roles = ["user", "assistant", "assistant", None, "", "a>b\\", "x\ny", "<turn "]
    rows = [
        (k or None, pick.choice([t, t, None, 0]), pick.choice(roles), pick.choice([None, "".join(pick.choices(parts, k=pick.randint(0, 9)))]))
        for k in range(120)
        for t in range(pick.randint(1, 5))
    ]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    rows += rows[:20]  # repeated rows stay
    pieces, got = through(spark, rows, extra=True)
    assert got == digests(rows)
    for r in pieces.where("loss_start is not null").collect():
        assert r.piece[: r.loss_start] == "<turn assistant>\n" and r.piece[r.loss_end :] == "\n</turn>\n"


def test_formatted_text_is_the_pieces_in_a_row(spark):
    rows = [(1, 1, "assistant", "b<|x"), (1, 0, "user", "a"), (1, 2, "tool", "</turn>")]
    pieces, _ = through(spark, rows)
    whole = "".join(r.piece for r in sorted(pieces.collect(), key=lambda r: r.n))
    assert whole == "<turn user>\na\n</turn>\n<turn assistant>\nb\\<|x\n</turn>\n<turn tool>\n\\</turn>\n</turn>\n"
    assert c.TEMPLATE.turns(whole) == [("user", "a"), ("assistant", "b<|x"), ("tool", "</turn>")]


def test_long_and_empty_texts_and_empty_table(spark):
    rows = [(1, 0, "user", "\\<turn " * 200_000), (1, 1, "assistant", ""), (2, 0, "assistant", None)]
    assert through(spark, rows)[1] == digests(rows)
    assert through(spark, [])[1] == {}


@pytest.mark.parametrize(
    ("record", "layout", "turns"),
    [
        ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":null}],"id":3}', "messages", [("user", "a"), ("assistant", "")]),
        ('{"system":"s","messages":[{"role":"user"}]}', "messages", [("system", "s"), ("user", "")]),
        ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "exchange", [("user", "q"), ("assistant", "a")]),
        ('{"dialog":[{"user":"u","assistant":"a"},{"user":"v"}]}', "dialogue", [("user", "u"), ("assistant", "a"), ("user", "v")]),
        ('{"instruction":"i","input":"","output":"o"}', "instruction", [("user", "i"), ("assistant", "o")]),
        ('{"output":"o","input":"x","instruction":"i","system":"s"}', "instruction", [("system", "s"), ("user", "i\n\nx"), ("assistant", "o")]),
        ('{"instruction":"i","context":null,"response":"r"}', "reply", [("user", "i"), ("assistant", "r")]),
        ('{"prompt":"p","completion":"c","meta":{"x":[1]}}', "completion", [("user", "p"), ("assistant", "c")]),
        ('{"prompt":"p","response":"c"}', "prompt", [("user", "p"), ("assistant", "c")]),
        ('{"context":"c","question":"q","answer":42}', "question", [("user", "c\n\nq"), ("assistant", "42")]),
        ('{"data":{"prompt":{"text":"p"},"response":{"text":"r"}}}', "nested", [("user", "p"), ("assistant", "r")]),
        ('{"turn":null,"role":null,"text":null}', "row", [("", "")]),
        ('{"messages":[]}', "messages", []),
        ('{"messages":"x"}', None, [(None, '{"messages":"x"}')]),
        ('{"messages":[1,null]}', None, [(None, '{"messages":[1,null]}')]),
        ('{"foo":1}', None, [(None, '{"foo":1}')]),
        ("[1]", None, [(None, "[1]")]),
        ("no json", None, [(None, "no json")]),
        (None, None, [(None, None)]),
    ],
)
def test_layouts(spark, record, layout, turns):
    found = c.canonical_turns(spark.createDataFrame([("k", record)], "id string, record string")).collect()
    assert [(r.role, r.text) for r in sorted(found, key=lambda r: r.place or 0)] == turns
    assert {r.layout for r in found} <= {layout}


def test_layouts_that_look_alike_are_refused():
    with pytest.raises(ValueError, match="look alike"):
        c.Registry((c.Layout("a", turns=(("user", ("p",)),)), c.Layout("b", turns=(("assistant", ("p",)),))))


@given(st.dictionaries(st.text(max_size=3), st.recursive(st.none() | st.integers() | st.text(max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3)), max_size=4))
def test_fingerprint_does_not_depend_on_order(record):
    turned = dict(reversed(record.items()))
    assert c.fingerprint(set(c.field_paths(record))) == c.fingerprint(set(c.field_paths(turned)))
