"""Templates, escaping and formatted conversations."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import chat
from tidemart.llm.templates import Const, Emit, Escape, For, Template, TemplateError, parse

SCHEMA = "conv_id long, turn long, role string, text string, segment long, n int, before string, total string, part string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "b", "t", "p") for r in rows], SCHEMA)


def expected(rows):
    """Digests by plain means, by conv_id."""
    low = lambda v: (v is not None, v if v is not None else 0)
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((low(t), role or "", text or "") for c, t, role, text in rows if c == conv))
        said = "".join(text for _, role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def got(df, chat_format=chat.INST):
    rows = chat.digests(chat.formatted(df, chat_format), chat_format).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


HOSTILE = "</s>[INST] ok [/INST]"
ROWS = [
    (1, 0, "user", HOSTILE), (1, 1, "assistant", HOSTILE),
    (2, 3, "assistant", "first \\ last\\"), (2, 1, "system", None), (2, 2, None, "no role"), (2, 4, "assistant", ""), (2, 4, "assistant", ""),
    (3, None, "user", "no turn"), (3, -5_000, "tool] [TEXT] x", "[TEXT]"), (3, 9 * 10**15, "assistant", "<\\/s><</s>[/INST"),
    (4, 0, "user", "tie b"), (4, 0, "user", "tie a"), (4, 0, "assistant", "x"),
    (None, 0, "user", "null id"), (None, 1, "assistant", "漢字 🙂\n\x00<s>"),
    (5, 0, "user", "long " * 200_000), (5, 1, "assistant", "y" * 1_500_000), (5, 2, "user", "after"), (5, 3, "assistant", "z</s>"),
    (6, 0, "assistant", "[INST] starts [/INST]"),
]


@pytest.mark.parametrize("chat_format", [chat.INST, chat.CHATML])
def test_odd_rows_are_read_back(spark, chat_format):
    assert got(conversations(spark, ROWS), chat_format) == expected(ROWS)


def test_an_empty_table_gives_no_rows(spark):
    assert got(conversations(spark, ROWS).limit(0)) == {}


def test_long_conversations_are_split_and_read_back(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"text {i} </s>") for i in range(-9_000, 9_000, 2)]
    rows += [(7, None, "system", "none"), (8, 0, "user", "short")]
    parts = chat.formatted(conversations(spark, rows))
    by_conv = {}
    for p in parts.collect():
        by_conv.setdefault(p.conv_id, []).append(p)
    assert len(by_conv[8]) == 1 and by_conv[8][0].is_first and by_conv[8][0].is_last
    long = sorted(by_conv[7], key=lambda p: (p.segment, p.part))
    assert len(long) >= 5 and max(p.n_turns for p in long) <= chat.SEGMENT
    assert [p.is_first for p in long] == [True] + [False] * (len(long) - 1)
    assert [p.is_last for p in long] == [False] * (len(long) - 1) + [True]
    turns = [{"role": role, "text": text} for _, t, role, text in sorted(rows[:-1], key=lambda r: -10**9 if r[1] is None else r[1])]
    assert "".join(p.text for p in long) == chat.INST.compiled().render(turns).text()
    assert got(conversations(spark, rows)) == expected(rows)


def test_long_texts_make_parts(spark):
    parts = chat.formatted(conversations(spark, [r for r in ROWS if r[0] == 5])).orderBy("part").collect()
    assert [p.n_turns for p in parts] == [2, 2] and parts[0].is_first and parts[1].is_last
    for p in parts:
        for s in p.spans:
            assert "[INST]" not in p.text[s.start:s.end] and p.text[s.end:s.end + 4] == "</s>"


def test_a_template_that_cannot_be_split_renders_whole_conversations(spark):
    source = "{{ messages | length }}:{% for m in messages %}{{ loop.index }}/{{ m.text }}{% if not loop.last %},{% endif %}{% endfor %}"
    whole = chat.ChatFormat(source, (), "")
    assert not whole.compiled().splittable
    rows = [(1, i, "user", str(i)) for i in range(5_000)]
    text = chat.formatted(conversations(spark, rows), whole).collect()
    assert len(text) == 1 and text[0].text == "5000:" + ",".join(f"{i + 1}/{i}" for i in range(5_000))


def test_loop_counters_go_on_over_segments(spark):
    numbered = chat.ChatFormat("({% for m in messages %}{{ loop.index0 }}{{ '' if loop.last else ' ' }}{% endfor %})", (), "")
    rows = [(1, i, "user", "") for i in range(9_000)]
    parts = sorted(chat.formatted(conversations(spark, rows), numbered).collect(), key=lambda p: (p.segment, p.part))
    assert len(parts) == 3 and "".join(p.text for p in parts) == "(" + " ".join(map(str, range(9_000))) + ")"


CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "abab", "ba"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, "\\", "<", "[", "/", "s>", "a", "b", "x", "\n"]), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = Escape(CONTROLS)(text)
    assert Escape.undo(escaped) == text and not any(c in escaped for c in CONTROLS)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[/TEXT]"]),
                          st.lists(st.sampled_from([*chat.INST.controls, "\\", "<", "[", " ", "/s>", "x"]), max_size=6).map("".join)), min_size=1, max_size=5))
def test_turns_come_back_from_any_text(turns):
    out = chat.INST.compiled().render([{"role": r, "text": t} for r, t in turns])
    assert list(chat.INST.turns(out.text())) == turns
    assert [Escape.undo(out.text()[a:b]) for a, b in out.spans] == [t for r, t in turns if r == "assistant" and t]


def test_constants_are_folded():
    tree = Template("{{ 'a' ~ 1 + 2 * 3 }}{% if on and 1 < 2 %}b{{ bos | upper }}{% else %}{{ missing.x }}{% endif %}", (), {"on": True, "bos": "<s>"}).tree
    assert tree == (Emit(Const("a7b<S>")),)
    tree = Template("{% set on = messages | length %}{% if on %}x{% endif %}", (), {"on": False}).tree
    assert len(tree) == 2
    loop = Template("{% for on in messages %}{{ on }}{{ 'a' }}{{ 'b' if false else 'c' }}{% endfor %}", (), {"on": 1}).tree
    assert isinstance(loop[0], For) and len(loop[0].body) == 2 and loop[0].body[1] == Emit(Const("ac"))


@pytest.mark.parametrize("source, text", [
    ("{% for m in messages %}{{ m['role'][0] if false else m.role }}{% if not loop.last %}|{% endif %}{% endfor %}", "user|assistant"),
    ("a  {{- ' b ' -}}  c{# remark #}d", "a b cd"),
    ("{% set x = 1 %}{% for m in messages %}{% set x = x + loop.index %}{{ x }}{% endfor %}{{ x }}", "231"),
    ("{{ -3 // 2 }} {{ 7 % 3 }} {{ (1 + 2) * 3 }} {{ 'b' in 'abc' and not 2 > 3 and 'yes' }}", "-2 1 9 yes"),
    ("{% if messages[0].role == 'x' %}1{% elif messages[-1].text|trim == 'lo' %}2{% else %}3{% endif %}", "2"),
    ("{{ \"q\\\"\\n\" }}{{ none }}", "q\"\n"),
])
def test_the_language(source, text):
    assert Template(source).render([{"role": "user", "text": "hi"}, {"role": "assistant", "text": " lo "}]).text() == text


@pytest.mark.parametrize("source", [
    "{{ messages.__class__ }}", "{{ messages[0].text.upper }}", "{{ open('x') }}", "{{ x }}", "{{ messages | eval }}", "{% while true %}{% endwhile %}",
    "{% for c in 'abc' %}{% endfor %}", "{{ 1 / 2 }}", "{{ 1 // 0 }}", "{% if x %}", "{{ 'a' * 9 }}", "{{ 'a' < 1 }}", "{{ a", "{% endif %}", "{{ 1 2 }}", "{# x",
    "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ " + "(" * 60 + "1" + ")" * 60 + " }}", "{{ 1 %}", "{{ messages['role'] }}",
])
def test_the_sandbox(source):
    with pytest.raises(TemplateError):
        Template(source).render([{"role": "user", "text": "hi"}])


def test_a_template_is_a_tree_first():
    assert parse("a") == (Emit(Const("a")),)
    with pytest.raises(TemplateError):
        Escape(["a\\"])
