"""Chat formatting by compiled templates.

A template is parsed into a syntax tree, constant parts are folded, and the
tree becomes nested Python closures that write the text of a conversation and
note which characters are generated (the loss mask).

The language is a sandbox: text, `{{ expression }}` and the statements

    {% for turn in turns %} ... {% endfor %}      one loop, over the turns
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}      marks generated text

Expressions have strings, whole numbers, true and false, names, fields of the
turn (`turn.role`, `turn.text`) and of the loop (`loop.first`, `loop.last`,
`loop.index`, `loop.index0`), == != < > <= >= + and or not, parentheses, and the
filters escape, trim, upper, lower and length. There are no calls, no
attributes of Python objects, no assignments and no way to loop but over the
turns, so a template ends and sees nothing but its inputs.

`escape` breaks every control string inside a text by a backslash after its
first character and doubles backslashes; `unescape` undoes it exactly.

Conversations are rows (conversation, turn, role, text). They are dealt out by
conversation, sorted, and streamed through the closures turn by turn: a task
holds one turn and the one after it, however long a conversation is. A digest
over the turns of one conversation is sequential by nature, so one conversation
is one task's stream.

Nulls: a null role or text is empty, null turns come first, a null conversation
id is a conversation. Turns of the same number follow by role and text; repeated
rows are turns of their own. An empty table gives no rows. Texts have no limit of
length: a task holds two turns. Only the four named columns are read, so others
cannot clash. Rows that have the id of a conversation added by the caller (the
query's control conversation is -1) are turns of that conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "<s>{% for turn in turns %}[INST] {{ turn.role | escape }} [/INST]"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}</s>{% endfor %}"
)


class TemplateError(ValueError):
    """The template is not in the language."""


# ------------------------------------------------------------------ escaping
def escaper(control: Iterable[str]) -> Callable[[str], str]:
    words = sorted(control, key=len, reverse=True)
    if any(len(w) < 2 or "\\" in w for w in words):
        raise TemplateError("control strings have two characters or more and no backslash")
    find = re.compile("|".join([r"\\", *map(re.escape, words)]))

    def fix(m: re.Match) -> str:
        word = m[0]
        # What follows the first character may itself begin a control string.
        return "\\\\" if word == "\\" else word[0] + "\\" + escape(word[1:])

    def escape(text: str) -> str:
        return find.sub(fix, text)

    return escape


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


# ------------------------------------------------------------------ parsing
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_WORD = re.compile(
    r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|<=|>=|[<>+().|]))", re.S)
_FIELDS = {"turn": ("role", "text"), "loop": ("first", "last", "index", "index0")}
_ESCAPES = {"n": "\n", "t": "\t"}


def _words(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _WORD.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the words of one expression; nodes are tuples
    (kind, ...)."""

    def __init__(self, source: str, names: dict[str, str]):
        self.words, self.at, self.names = _words(source), 0, names
        self.tree = self._or()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")

    def _next(self, *values: str) -> str | None:
        if self.at < len(self.words) and self.words[self.at][1] in values \
                and self.words[self.at][0] != "str":
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def _or(self):
        left = self._and()
        while self._next("or"):
            left = ("or", left, self._and())
        return left

    def _and(self):
        left = self._not()
        while self._next("and"):
            left = ("and", left, self._not())
        return left

    def _not(self):
        return ("not", self._not()) if self._next("not") else self._compare()

    def _compare(self):
        left = self._sum()
        while op := self._next("==", "!=", "<=", ">=", "<", ">"):
            left = (op, left, self._sum())
        return left

    def _sum(self):
        left = self._filtered()
        while self._next("+"):
            left = ("+", left, self._filtered())
        return left

    def _filtered(self):
        node = self._value()
        while self._next("|"):
            kind, name = self._take()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def _take(self) -> tuple[str, str]:
        if self.at >= len(self.words):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.words[self.at - 1]

    def _value(self):
        kind, word = self._take()
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1],
                                    flags=re.S))
        if kind == "int":
            return ("const", int(word))
        if word == "(":
            node = self._or()
            if not self._next(")"):
                raise TemplateError("a parenthesis is not closed")
            return node
        if kind == "name" and word in ("true", "false"):
            return ("const", word == "true")
        if kind == "name" and word in self.names:
            role = self.names[word]
            if not self._next("."):
                raise TemplateError(f"{word} has fields only")
            field = self._take()[1]
            if field not in _FIELDS[role]:
                raise TemplateError(f"{word} has no field {field!r}")
            return ("field", role, field)
        raise TemplateError(f"unknown name {word!r}")


def parse(source: str) -> list:
    """The syntax tree: a list of nodes ("text", s), ("out", e), ("if", [(e,
    body)...]), ("for", body), ("generation", body)."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at:m.start()]))
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    parts.reverse()
    state = {"loops": 0}

    def body(ends: tuple[str, ...], names: dict[str, str], inside: bool) -> tuple[list, str]:
        nodes = []
        while parts:
            kind, value = parts.pop()
            if kind == "text":
                nodes.append(("text", value))
            elif kind == "out":
                nodes.append(("out", _Expression(value, names).tree))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return nodes, value
                if word == "if":
                    nodes.append(branch(rest, names, inside))
                elif word == "for":
                    m = re.fullmatch(r"([A-Za-z_]\w*) in turns", rest.strip())
                    if not m or names or inside or state["loops"]:
                        raise TemplateError("one loop over turns, outside of other statements")
                    state["loops"] = 1
                    inner, _ = body(("endfor",), {m[1]: "turn", "loop": "loop"}, inside)
                    nodes.append(("for", inner))
                elif word == "generation":
                    if inside:
                        raise TemplateError("generation does not nest")
                    inner, _ = body(("endgeneration",), names, True)
                    nodes.append(("generation", inner))
                else:
                    raise TemplateError(f"unexpected statement {value!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, ""

    def branch(test: str, names: dict[str, str], inside: bool) -> tuple:
        cases, tree = [], _Expression(test, names).tree
        while True:
            nodes, end = body(("elif", "else", "endif"), names, inside)
            cases.append((tree, nodes))
            if end == "endif":
                return ("if", cases)
            if end == "else":
                nodes, _ = body(("endif",), names, inside)
                return ("if", [*cases, (("const", True), nodes)])
            tree = _Expression(end.partition(" ")[2], names).tree

    return body((), {}, False)[0]


# ------------------------------------------------------------------ folding
FILTERS: dict[str, Callable] = {"escape": str, "trim": str.strip, "upper": str.upper,
                                "lower": str.lower, "length": len}
_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
    "+": lambda a, b: a + b, "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold_expression(node: tuple, filters: dict[str, Callable]) -> tuple:
    kind = node[0]
    if kind in ("const", "field"):
        return node
    if kind == "filter":
        inner = fold_expression(node[2], filters)
        if inner[0] == "const":
            return ("const", filters[node[1]](inner[1]))
        return ("filter", node[1], inner)
    inner = [fold_expression(x, filters) for x in node[1:]]
    if all(x[0] == "const" for x in inner):
        values = [x[1] for x in inner]
        return ("const", not values[0] if kind == "not" else _OPS[kind](*values))
    return (kind, *inner)


def fold(nodes: list, filters: dict[str, Callable]) -> list:
    """Constant expressions become text, decided branches their body, and
    neighbouring texts one."""
    out: list = []

    def put(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "out":
            tree = fold_expression(node[1], filters)
            put(("text", _text(tree[1])) if tree[0] == "const" else ("out", tree))
        elif node[0] == "if":
            cases = []
            for test, body in node[1]:
                test = fold_expression(test, filters)
                if test[0] == "const" and not test[1]:
                    continue
                cases.append((test, fold(body, filters)))
                if test[0] == "const":
                    break
            if cases and cases[0][0][0] == "const":
                for x in cases[0][1]:
                    put(x)
            elif cases:
                put(("if", cases))
        elif node[0] in ("for", "generation"):
            put((node[0], fold(node[1], filters)))
        else:
            put(node)
    return out


def _text(value) -> str:
    return value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) \
        else str(value)


# ------------------------------------------------------------------ closures
class Sink:
    """Text written so far since the last `take`, and its generated spans."""

    def __init__(self):
        self.parts, self.spans, self.size = [], [], 0

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def take(self) -> tuple[str, list[tuple[int, int]]]:
        out = "".join(self.parts), self.spans
        self.parts, self.spans, self.size = [], [], 0
        return out


def _value(node: tuple, filters: dict[str, Callable]) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "field":
        return lambda env, a=node[1], b=node[2]: env[a][b]
    if kind == "filter":
        return lambda env, f=filters[node[1]], x=_value(node[2], filters): f(x(env))
    left = _value(node[1], filters)
    if kind == "not":
        return lambda env: not left(env)
    right = _value(node[2], filters)
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    return lambda env, f=_OPS[kind]: f(left(env), right(env))


def _closure(nodes: list, filters: dict[str, Callable]) -> Callable[[dict, Sink], None]:
    steps = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            steps.append(lambda env, sink, s=node[1]: sink.write(s))
        elif kind == "out":
            steps.append(lambda env, sink, f=_value(node[1], filters): sink.write(_text(f(env))))
        elif kind == "if":
            cases = [(_value(t, filters), _closure(b, filters)) for t, b in node[1]]

            def choose(env, sink, cases=cases):
                for test, run in cases:
                    if test(env):
                        return run(env, sink)

            steps.append(choose)
        else:
            def generated(env, sink, run=_closure(node[1], filters)):
                start = sink.size
                run(env, sink)
                sink.spans.append((start, sink.size))

            steps.append(generated)

    def run_all(env, sink):
        for step in steps:
            step(env, sink)

    return run_all


class Template:
    """A compiled template: `render` yields (text, spans) pieces, one for the
    part before the turns, one per turn and one for the rest."""

    def __init__(self, source: str = TEMPLATE, control: Iterable[str] = CONTROL):
        filters = dict(FILTERS, escape=escaper(control))
        self.tree = fold(parse(source), filters)
        self.control = tuple(control)
        loop = next((i for i, n in enumerate(self.tree) if n[0] == "for"), len(self.tree))
        self._head = _closure(self.tree[:loop], filters)
        self._body = _closure(self.tree[loop][1] if loop < len(self.tree) else [], filters)
        self._tail = _closure(self.tree[loop + 1:], filters)

    def render(self, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, list]]:
        """turns: (role, text) in order, read one ahead."""
        sink, index, turns = Sink(), 0, iter(turns)
        self._head({}, sink)
        yield sink.take()
        turn = next(turns, None)
        while turn is not None:
            after = next(turns, None)
            self._body({"turn": {"role": turn[0], "text": turn[1]},
                        "loop": {"first": index == 0, "last": after is None,
                                 "index": index + 1, "index0": index}}, sink)
            yield sink.take()
            turn, index = after, index + 1
        self._tail({}, sink)
        yield sink.take()


_TURN = re.compile(r"\[INST\] (.*?) \[/INST\](.*?)</s>", re.S)


def read_turns(pieces: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of text that TEMPLATE formatted, given in pieces."""
    held, begun = "", False
    for piece in pieces:
        held += piece
        if not begun and len(held) >= 3:
            if not held.startswith("<s>"):
                raise ValueError("a formatted conversation begins with <s>")
            held, begun = held[3:], True
        at = 0
        while m := _TURN.match(held, at):
            yield unescape(m[1]), unescape(m[2])
            at = m.end()
        held = held[at:]
    if held:
        raise ValueError("a formatted conversation is cut short")


# ------------------------------------------------------------------ Spark
def _sorted_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str):
    return (conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def _conversations(batches) -> Iterator[tuple[object, Iterator[tuple[str, str]]]]:
    """(id, its turns) one conversation after the other; the turns of one must
    be used up before the next is asked for."""
    rows = ((c.as_py(), r.as_py(), t.as_py()) for batch in batches
            for c, r, t in zip(batch.column(0), batch.column(2), batch.column(3)))
    ahead = [next(rows, None)]

    def turns(conv):
        while ahead[0] is not None and ahead[0][0] == conv:
            yield ahead[0][1:]
            ahead[0] = next(rows, None)

    while ahead[0] is not None:
        conv = ahead[0][0]
        yield conv, turns(conv)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE,
                         control: tuple[str, ...] = CONTROL, conv: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, piece, text, spans): the formatted text in pieces by order (a
    piece per turn, and what comes before and after them), each with its
    generated spans as (start, end) in the piece's characters. A conversation's
    text is its pieces joined."""
    Template(template, control)  # a bad template fails here, not in a task

    def run(batches):
        compiled = Template(template, control)
        for conv_id, turns in _conversations(batches):
            out = []
            for piece, (part, spans) in enumerate(compiled.render(turns)):
                out.append((conv_id, piece, part, [{"start": a, "end": b} for a, b in spans]))
                if len(out) == 500:
                    yield _pieces(out)
                    out = []
            yield _pieces(out)

    return _sorted_turns(conversations, conv, turn, role, text).mapInArrow(
        run, "conv_id long, piece long, text string, spans array<struct<start: int, end: int>>")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.string(), spans))],
        names=["conv_id", "piece", "text", "spans"])


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                    ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digest_conversations(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """Format with TEMPLATE and read the output back: per conversation its
    turns' number and digest (role, newline, text, newline each), the length
    and digest of the unescaped text under the loss mask, and the length of the
    formatted text, in code points. Formatting and reading run piece by piece
    in one task, so nothing of a conversation is held."""
    def run(batches):
        compiled, out = Template(), []
        for conv_id, turns in _conversations(batches):
            all_turns, loss = hashlib.sha256(), hashlib.sha256()
            n, loss_chars, chars = 0, 0, [0]

            def pieces():
                nonlocal loss_chars
                for part, spans in compiled.render(turns):
                    chars[0] += len(part)
                    for a, b in spans:
                        plain = unescape(part[a:b])
                        loss_chars += len(plain)
                        loss.update(plain.encode("utf-8"))
                    yield part

            for role_, text_ in read_turns(pieces()):
                n += 1
                all_turns.update(f"{role_}\n{text_}\n".encode("utf-8"))
            out.append((conv_id, n, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars[0]))
            if len(out) == 5000:
                yield _digests(out)
                out = []
        if out:
            yield _digests(out)

    return _sorted_turns(conversations, conv, turn, role, text).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
             " loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(DIGEST)], schema=DIGEST)
