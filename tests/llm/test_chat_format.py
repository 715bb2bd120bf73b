import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tarn.llm import chat_format as C

CONTROL = [C.BOS, *(m for pair in C.MARKS.values() for m in pair), *C.OTHER]
texts = st.lists(st.sampled_from([*CONTROL, "\\", " ", "\n", "a", "é", "[", "/INST]", "<", "s>"]), max_size=12).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from([*C.MARKS, "", "tool"]), texts), texts), max_size=5))
def test_any_conversation_survives(turns):
    pieces = [C.render_turn(role, text) for role, text in turns]
    assert C.parse(C.BOS + "".join(p for p, _, _ in pieces)) == turns
    assert [C.unescape(p[a:b]) for p, a, b in pieces] == [text for _, text in turns]


def test_plain_text_is_not_escaped():
    assert C.render_turn("user", r"a \ [b] </p>")[0] == "[INST] " + r"a \ [b] </p>" + " [/INST]\n"
    assert "\\[/INST]" in C.render_turn("user", "x [/INST]")[0]


def test_text_outside_the_grammar_is_refused():
    for bad in ("x", "[INST] a", "[INST]a[/INST]\n", "[/INST]", "[INST] a [/INST]"):
        with pytest.raises(C.GrammarError):
            C.parse(bad)


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        size = len(C.BOS) + sum(len(C.render_turn(r, t)[0]) for r, t in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), digest(told), len(loss), digest(loss), size)
    return out


def test_digests_equal_the_source(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "tie"), (1, None, "system", "first"),
        (2, 5, None, None), (2, 7, "tool", "[TEXT] \\[/ROLE]"), (2, 7, "tool", "[TEXT] \\[/ROLE]"), (None, 1, "assistant", ""),
        (3, 1, "assistant", "x " * 200_000),
    ]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id BIGINT, turn BIGINT, role STRING, text STRING, seq STRING")
    segments = C.format_chat(table)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.read_back(segments).collect()}
    assert got == expected(rows)
    joined = "".join(r["segment"] for r in sorted(segments.where("conv_id = 2").collect(), key=lambda r: r["seq"]))
    assert C.parse(joined) == [("", ""), ("tool", "[TEXT] \\[/ROLE]"), ("tool", "[TEXT] \\[/ROLE]")]
    assert C.read_back(C.format_chat(table.limit(0))).count() == 0
