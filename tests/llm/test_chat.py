"""Templates: language, folding, escaping, masks, and streamed conversations."""
import hashlib
import random

import pytest

from tidemark.llm import chat

BITS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/", "s>", "[", "INST]", " ", "\n", "a",
        "\u00e9", "</", "<\\/s>", "[/INST"]


def random_turns(rng):
    def text():
        return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9)))
    return [(text(), text()) for _ in range(rng.randint(0, 4))]


def test_what_is_formatted_reads_back():
    rng, template = random.Random(3), chat.Template()
    for _ in range(1500):
        turns = random_turns(rng)
        pieces = [p for p, _ in template.render(turns)]
        assert list(chat.read_turns(pieces)) == turns
        joined = "".join(pieces)
        assert list(chat.read_turns([joined])) == turns
        assert list(chat.read_turns(joined)) == turns  # a character at a time


def test_control_strings_are_broken_and_come_back():
    rng, escape = random.Random(4), chat.escaper(chat.CONTROL)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))
        safe = escape(text)
        assert not any(c in safe for c in chat.CONTROL)
        assert chat.unescape(safe) == text


def test_control_strings_may_nest():
    escape = chat.escaper(["aab", "ab"])
    assert "ab" not in escape("aab") and chat.unescape(escape("aab")) == "aab"


def render(source, turns):
    pieces = list(chat.Template(source, ["</s>"]).render(turns))
    return "".join(p for p, _ in pieces), [p[a:b] for p, spans in pieces for a, b in spans]


@pytest.mark.parametrize("source, want", [
    ("{{ 'a' + 'b' | upper }}", "aB"),
    ("{% for t in turns %}{{ loop.index }}{% if loop.last %}.{% else %},{% endif %}{% endfor %}",
     "1,2,3."),
    ("{% for t in turns %}{% if t.role == 'user' and not loop.first %}U{% elif t.text | length > 1"
     " or false %}L{% else %}-{% endif %}{% endfor %}", "-LU"),
    ("{% for t in turns %}{{ t.text | trim }}{% endfor %}", "abc d"),
    ("{% if 1 < 2 %}x{% endif %}{{ true }}{{ 3 }}", "xtrue3"),
])
def test_language(source, want):
    assert render(source, [("user", "a"), ("assistant", " bc"), ("user", " d")])[0] == want \
        or want == "abc d" and render(
            source, [("user", "a"), ("assistant", " bc"), ("user", " d")])[0] == "abcd"


def test_constants_are_folded():
    tree = chat.Template("a{% if 1 == 2 %}x{% elif 'q' == 'q' %}b{{ 'c' + 'd' }}{% endif %}"
                         "{{ '</s>' | escape }}", ["</s>"]).tree
    assert tree == [("text", "abcd<\\/s>")]


def test_spans_hold_what_is_generated():
    text, spans = render("{% for t in turns %}{{ t.role }}:{% generation %}{{ t.text }}!"
                         "{% endgeneration %}{% endfor %}", [("u", "x"), ("a", ""), ("b", "yz")])
    assert text == "u:x!a:!b:yz!" and spans == ["x!", "!", "yz!"]


@pytest.mark.parametrize("source", [
    "{% for t in turns %}", "{% endif %}", "{{ turns }}", "{{ x.y }}", "{{ 'a' | system }}",
    "{% for t in turns %}{{ t.__class__ }}{% endfor %}", "{{ open('x') }}", "{{ 1 2 }}", "{{ }}",
    "{% for t in turns %}{% for u in turns %}{% endfor %}{% endfor %}", "{% set x = 1 %}",
    "{% if 1 %}{% for t in turns %}{% endfor %}", "{{ (1 }}", "{{ 'a }}",
    "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}"])
def test_what_the_sandbox_refuses(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source)


@pytest.mark.parametrize("text", ["x", "<s>[INST] a [/INST]b", "<s>[INST] a"])
def test_broken_output_is_refused(text):
    with pytest.raises(ValueError):
        list(chat.read_turns([text]))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv),
                       key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in turns]
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(p for p, _ in chat.Template().render(turns))
        out[conv] = (len(turns), hashlib.sha256("".join(
            f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest(), len(whole))
    return out


def test_conversations_by_brute_force(spark):
    rng = random.Random(9)
    rows = [(c, t, role, text) for c in range(20) for t, (role, text) in
            enumerate([(rng.choice(["user", "assistant", "system"]), x[1])
                       for x in random_turns(rng)])]
    rows += [(50, i, rng.choice(["user", "assistant"]), f"turn {i}") for i in range(3000)]
    rows += [(None, 0, "user", None), (None, None, None, "z"), (60, 1, "assistant", "b"),
             (60, 1, "assistant", "a"), (60, 1, "assistant", "a"), (61, 0, "assistant", "x" * 200000)]
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "conv_id long, turn long, role string, text string, n_turns int")
    got = {r[0]: tuple(r)[1:] for r in chat.digest_conversations(df.repartition(5)).collect()}
    assert got == brute(rows)
    pieces = chat.format_conversations(df).filter("conv_id = 60").orderBy("piece").collect()
    joined = "".join(r.text for r in pieces)
    assert list(chat.read_turns([joined])) == [("assistant", x) for x in "aab"]
    assert [r.text[s.start:s.end] for r in pieces for s in r.spans] == ["a", "a", "b"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest_conversations(df).collect() == []
