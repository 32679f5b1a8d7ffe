"""Chat formatting: a compiler for a small, sandboxed template language.

``{{ value }}``, ``{% for m in messages %}``, ``{% if %}/{% elif %}/{% else %}``,
``{% set x = value %}`` and ``{% generation %}`` blocks (what the model is
trained on). Values: strings, numbers, ``true false none``, names, ``a.b`` and
``a['b']`` (dictionary keys only: no attribute or method of any Python object
can be reached), ``== != ~ and or not``, parentheses, and the filters
``escape trim upper lower``. A template is parsed into a syntax tree, constant
parts are folded, and the tree becomes nested Python generators that yield
(text, trained on) pieces, so a conversation is rendered turn by turn.

``escape`` marks every control string inside a text by a backslash after its
first character and doubles backslashes, so that no text can forge a marker
and ``unescape`` gives it back.

Conversations are rows by turn: one shuffle by conversation, sorted, rendered
as a stream. Output rows are pieces of a conversation of about ``PIECE_CHARS``
characters, so no conversation is held whole, however long.

Defined cases: null text or role is empty; null turns come first, ties are
ordered by role, then text; rows of a null conversation id form one
conversation; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

CONTROLS = ("<|turn|>", "<|text|>", "</s>", "<s>", "[INST]", "[/INST]")
TEMPLATE = ("{% for m in messages %}<|turn|>{{ m.role | escape }}<|text|>"
            "{% if m.role == 'assistant' %}{% generation %}{{ m['text'] | escape }}{% endgeneration %}"
            "{% else %}{{ m['text'] | escape }}{% endif %}</s>{{ '\\n' }}{% endfor %}")
PIECE_CHARS = 1 << 16
Pieces = Iterator[tuple[str, bool]]


class TemplateError(ValueError):
    pass


_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_MARKED = re.compile("|".join(f"{re.escape(c[0])}\\\\(?={re.escape(c[1:])})" for c in CONTROLS) + r"|\\\\")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: m[0][0], text)


FILTERS = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[.\[\]()~|]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Values:
    """Recursive descent over one expression; nodes are tuples."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *words):
        here = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return here if not words else here[1] in words and here[0] != "str"

    def take(self, *words):
        kind, word = self.peek()
        if kind is None or words and not self.peek(*words):
            raise TemplateError(f"expected {words or 'a value'}, got {word!r}")
        self.at += 1
        return kind, word

    def whole(self):
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.peek("or"):
            self.take()
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.peek("and"):
            self.take()
            node = ("and", node, self.negated())
        return node

    def negated(self):
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        node = self.joined()
        if self.peek("==", "!="):
            node = (self.take()[1], node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while self.peek("~"):
            self.take()
            node = ("~", node, self.filtered())
        return node

    def filtered(self):
        node = self.single()
        while self.peek("|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def single(self):
        kind, word = self.take()
        if kind == "str":
            node = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1]))
        elif kind == "num":
            node = ("const", int(word))
        elif kind == "name":
            node = ("const", {"true": True, "false": False, "none": None}[word]) if word in ("true", "false", "none") else ("name", word)
        elif word == "(":
            node = self.either()
            self.take(")")
        else:
            raise TemplateError(f"unexpected {word!r}")
        while self.peek(".", "["):
            if self.take()[1] == ".":
                node = ("key", node, ("const", self.take()[1]))
            else:
                node = ("key", node, self.either())
                self.take("]")
        return node


_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)


def parse(template: str):
    """The syntax tree: ("block", [node, ...])."""
    parts = [p for p in _TAG.split(template) if p]
    at = 0

    def block(*ends):
        nonlocal at
        nodes = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(("print", _Values(part[2:-2]).whole()))
            elif not part.startswith("{%"):
                nodes.append(("print", ("const", part)))
            else:
                words = part[2:-2].strip()
                head = words.split(None, 1)[0] if words else ""
                if head in ends:
                    return ("block", nodes), words
                nodes.append(statement(head, words))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("block", nodes), ""

    def statement(head, words):
        rest = words[len(head):].strip()
        if head == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest)
            if not m:
                raise TemplateError(words)
            return ("for", m[1], _Values(m[2]).whole(), block("endfor")[0])
        if head == "if":
            test, (body, end) = _Values(rest).whole(), block("elif", "else", "endif")
            if end.startswith("elif"):
                return ("if", test, body, ("block", [statement("if", "if" + end[4:])]))
            return ("if", test, body, block("endif")[0] if end == "else" else ("block", []))
        if head == "generation":
            return ("generation", block("endgeneration")[0])
        if head == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest)
            if not m:
                raise TemplateError(words)
            return ("set", m[1], _Values(m[2]).whole())
        raise TemplateError(f"unknown statement {words!r}")

    return block()[0]


def fold(node):
    """Constant expressions become constants, constant branches are chosen,
    and neighbouring constant texts are joined."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "block":
        out = []
        for part in map(fold, node[1]):
            inner = part[1] if part[0] == "block" else [part]
            for x in inner:
                if x[0] == "print" and x[1][0] == "const" and out and out[-1][0] == "print" and out[-1][1][0] == "const":
                    out[-1] = ("print", ("const", shown(out[-1][1][1]) + shown(x[1][1])))
                else:
                    out.append(x)
        return ("block", out)
    if kind == "if":
        test, yes, no = map(fold, node[1:])
        if test[0] == "const":
            return yes if test[1] else no
        return ("if", test, yes, no)
    node = (kind, *(fold(x) if isinstance(x, tuple) else x for x in node[1:]))
    if kind in ("and", "or", "not", "==", "!=", "~", "filter") and all(x[0] == "const" for x in node[1:] if isinstance(x, tuple)):
        return ("const", value(node)({}))
    return node


def shown(x) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


def value(node) -> Callable[[dict], object]:
    """A closure for one expression."""
    kind = node[0]
    if kind == "const":
        constant = node[1]
        return lambda names: constant
    if kind == "name":
        name = node[1]
        return lambda names: names.get(name)
    if kind == "filter":
        change, inner = FILTERS[node[1]], value(node[2])
        return lambda names: change(shown(inner(names)))
    if kind == "not":
        inner = value(node[1])
        return lambda names: not inner(names)
    a, b = value(node[1]), value(node[2])
    if kind == "key":
        def key(names):
            of, k = a(names), b(names)
            return of.get(k) if type(of) is dict else None      # nothing but plain dictionaries
        return key
    return {"and": lambda names: a(names) and b(names), "or": lambda names: a(names) or b(names),
            "==": lambda names: a(names) == b(names), "!=": lambda names: a(names) != b(names),
            "~": lambda names: shown(a(names)) + shown(b(names))}[kind]


def renderer(node) -> Callable[[dict, bool], Pieces]:
    """A generator function for one statement."""
    kind = node[0]
    if kind == "print":
        text = value(node[1])

        def put(names, trained):
            yield shown(text(names)), trained
        return put
    if kind == "block":
        parts = [renderer(x) for x in node[1]]

        def run(names, trained):
            for part in parts:
                yield from part(names, trained)
        return run
    if kind == "if":
        test, yes, no = value(node[1]), renderer(node[2]), renderer(node[3])
        return lambda names, trained: (yes if test(names) else no)(names, trained)
    if kind == "generation":
        body = renderer(node[1])
        return lambda names, trained: body(names, True)
    if kind == "set":
        name, text = node[1], value(node[2])

        def bind(names, trained):
            names[name] = text(names)
            return iter(())
        return bind
    name, source, body = node[1], value(node[2]), renderer(node[3])

    def loop(names, trained):
        rows = iter(source(names) or ())
        here = next(rows, None)
        n = 0
        while here is not None:
            after = next(rows, None)    # one turn ahead, to know the last
            inner = {**names, name: here, "loop": {"index0": n, "first": n == 0, "last": after is None}}
            yield from body(inner, trained)
            here, n = after, n + 1
    return loop


def compiled(template: str) -> Callable[[dict], Pieces]:
    run = renderer(fold(parse(template)))
    return lambda names: run(dict(names), False)


def _runs(batches, width: int):
    """Rows in order, as (first value, iterator over the rows of that value)."""
    rows = (row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(width)), strict=True))
    row = next(rows, None)
    while row is not None:
        key, state = row[0], [row]

        def run(key=key, state=state):
            while state[0] is not None and state[0][0] == key:
                yield state[0]
                state[0] = next(rows, None)
        inner = run()
        yield key, inner
        for _ in inner:
            pass
        row = state[0]


FORMATTED = "conv_id long, piece int, text string, loss array<struct<start:int,end:int>>"
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def formatted(conversations: DataFrame, template: str = TEMPLATE, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``conv_id, piece, text, loss``: the formatted text of a conversation is
    its pieces in order; ``loss`` are the trained spans within the piece."""
    fold(parse(template))               # a bad template fails here, not in a task

    def render(batches):
        run = compiled(template)
        for conv, rows in _runs(batches, 4):
            messages = ({"role": role or "", "text": text or ""} for _, _, role, text in rows)
            part, size, loss, piece = [], 0, [], 0
            for text, trained in run({"messages": messages}):
                part.append(text)
                if trained and text:
                    loss.append((size, size + len(text)))
                size += len(text)
                if size >= piece_chars:
                    yield made(conv, piece, part, loss)
                    part, size, loss, piece = [], 0, [], piece + 1
            if part:
                yield made(conv, piece, part, loss)

    def made(conv, piece, part, loss):
        spans = [{"start": a, "end": b} for a, b in loss]
        return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([piece], pa.int32()), pa.array(["".join(part)], pa.string()), pa.array([spans], _LOSS)], ["conv_id", "piece", "text", "loss"])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(render, FORMATTED)


_SPLIT = re.compile(r"(<\|turn\|>|<\|text\|>|</s>)")
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(pieces: DataFrame) -> DataFrame:
    """Reads the output of the default template back: turns from the markers,
    trained text from the spans, both unescaped."""
    def read(batches):
        out = []
        for conv, rows in _runs(batches, 4):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = chars = trained = 0
            state, held, role = None, [], ""
            for _, _, text, spans in rows:
                chars += len(text)
                for span in spans:
                    plain = unescape(text[span["start"]:span["end"]])
                    trained += len(plain)
                    loss.update(plain.encode())
                for part in _SPLIT.split(text):
                    if part in ("<|turn|>", "<|text|>"):
                        if part == "<|text|>":
                            role = unescape("".join(held))
                        state, held = part, []
                    elif part == "</s>":
                        turns.update(f"{role}\n{unescape(''.join(held))}\n".encode())
                        n, state, held = n + 1, None, []
                    elif state:
                        held.append(part)
            out.append((conv, n, turns.hexdigest(), trained, loss.hexdigest(), chars))
            if len(out) == 1000:
                yield made(out)
                out = []
        yield made(out)

    def made(out):
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in DIGEST.split(", ")])

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(read, DIGEST)


def round_trip(conversations: DataFrame, **options) -> DataFrame:
    """Formats, writes, reads back and digests."""
    return digests(store(formatted(conversations, **options), "chat"))
