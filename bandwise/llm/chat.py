"""Chat formatting with a small sandboxed template language, compiled to closures.

Language: text, ``{{ expression }}``, ``{% for m in messages %} ... {% endfor %}``,
``{% if e %} ... {% elif e %} ... {% else %} ... {% endif %}`` and ``{% generation %} ...
{% endgeneration %}`` (what it renders is under the loss mask). Expressions:
strings, integers, true/false, the loop variable's ``role``, ``text`` and ``turn``, ``loop.first``,
``==``, ``!=``, ``and``, ``or``, ``not``, ``~`` (join), parentheses, and the
filters in FILTERS. Nothing else can be named, so a template cannot reach Python.

The source is parsed into a tree, constant parts are folded, and every node
becomes a Python closure. A template is text, one loop over the messages, and
text; so conversations stream through it turn by turn, and a very long one comes out
in parts of bounded size (rows ``part`` = 0, 1, ...), never whole in memory.

``escape`` writes a backslash as two, and ``#``, ``<`` and ``:`` as a backslash and a
letter, so the turn marks ``### `` and ``</turn>`` cannot occur in an escaped text.

Defined results: null role or text is empty; rows without conv_id are left out;
turns are ordered by turn (null first), then role and text; repeated rows are turns of their own; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import parts, shipped

TEMPLATE = (
    "{% for m in messages %}### {{ m.role | escape }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>\n{% endfor %}"
)
PART_TURNS = 512
PART_CHARS = 1 << 20
FORMATTED = "conv_id long, part int, offset long, formatted string, spans array<struct<start:long,end:long>>"

_CODES = {"\\": "\\", "#": "h", "<": "l", ":": "c"}
_CHARS = {v: k for k, v in _CODES.items()}
_ESCAPE = re.compile(r"[\\#<:]")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.DOTALL)


def escape(s: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + _CODES[m[0]], s)


def unescape(s: str) -> str:
    return _UNESCAPE.sub(lambda m: _CHARS[m[1]], s)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "upper": str.upper, "lower": str.lower, "trim": str.strip, "title": str.title}


class TemplateError(ValueError):
    pass


# ------------------------------------------------------------------ syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    name: str  # role, text, turn or first


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Out:
    expr: object


@dataclass(frozen=True)
class If:
    cases: tuple  # of (condition, body)
    orelse: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class Template:
    head: tuple
    body: tuple
    tail: tuple


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(\d+)|([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?)|(==|!=|[~|()]))", re.DOTALL)


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str, variable: str | None):
        self.variable, self.tokens, at = variable, [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(next((k, v) for k, v in zip(("str", "int", "name", "op"), m.groups(), strict=True) if v is not None))
            at = m.end()
        self.at = 0

    def parse(self):
        e = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return e

    def _take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _or(self):
        e = self._and()
        while self._take("or"):
            e = Op("or", (e, self._and()))
        return e

    def _and(self):
        e = self._not()
        while self._take("and"):
            e = Op("and", (e, self._not()))
        return e

    def _not(self):
        return Op("not", (self._not(),)) if self._take("not") else self._compare()

    def _compare(self):
        e = self._join()
        op = self._take("==", "!=")
        return Op(op, (e, self._join())) if op else e

    def _join(self):
        e = self._filtered()
        while self._take("~"):
            e = Op("~", (e, self._filtered()))
        return e

    def _filtered(self):
        e = self._atom()
        while self._take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "nothing")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            e = Op("filter:" + name, (e,))
        return e

    def _atom(self):
        if self._take("("):
            e = self._or()
            if not self._take(")"):
                raise TemplateError("missing )")
            return e
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        kind, v = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), v[1:-1], flags=re.DOTALL))
        if kind == "int":
            return Const(int(v))
        if kind == "name":
            if v in ("true", "false"):
                return Const(v == "true")
            if self.variable and v in {f"{self.variable}.{f}" for f in ("role", "text", "turn")}:
                return Field(v.split(".")[1])
            if self.variable and v == "loop.first":
                return Field("first")
        raise TemplateError(f"unknown name {v!r}")


def parse(source: str) -> Template:
    pieces, at = [], 0
    for m in _PIECE.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at : m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    pos = 0

    def block(variable: str | None, ends: tuple[str, ...], marked: bool) -> tuple[list, str]:
        nonlocal pos
        body: list = []
        while pos < len(pieces):
            kind, v = pieces[pos]
            pos += 1
            if kind == "text":
                body.append(Out(Const(v)))
            elif kind == "out":
                body.append(Out(_Expression(v, variable).parse()))
            elif v.split(" ")[0] in ends:
                return body, v
            elif v.startswith("if ") and variable:
                cases, orelse, tag = [], [], v
                while tag.startswith(("if ", "elif ")):
                    cond = _Expression(tag.split(" ", 1)[1], variable).parse()
                    inner, tag = block(variable, ("elif", "else", "endif"), marked)
                    cases.append((cond, tuple(inner)))
                if tag == "else":
                    orelse, tag = block(variable, ("endif",), marked)
                body.append(If(tuple(cases), tuple(orelse)))
            elif v == "generation" and variable and not marked:
                body.append(Generation(tuple(block(variable, ("endgeneration",), True)[0])))
            elif v.startswith("for ") and variable is None:
                m = re.fullmatch(r"for ([A-Za-z_]\w*) in messages", v)
                if not m or any(isinstance(b, Template) for b in body):
                    raise TemplateError(f"cannot read {v!r}")
                body.append(Template((), tuple(block(m[1], ("endfor",), False)[0]), ()))
            else:
                raise TemplateError(f"unexpected tag {v!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return body, ""

    top, _ = block(None, (), False)
    loops = [i for i, b in enumerate(top) if isinstance(b, Template)]
    if len(loops) != 1:
        raise TemplateError("a template has one loop over messages")
    return Template(tuple(top[: loops[0]]), top[loops[0]].body, tuple(top[loops[0] + 1 :]))


# ------------------------------------------------------------------ folding and closures


def _text(v: object) -> str:
    return ("true" if v else "false") if isinstance(v, bool) else str(v)


def _apply(name: str, values: list):
    if name.startswith("filter:"):
        return FILTERS[name[7:]](_text(values[0]))
    if name == "~":
        return _text(values[0]) + _text(values[1])
    if name == "not":
        return not values[0]
    same = values[0] == values[1]
    return same if name == "==" else not same


def fold_expr(e):
    if not isinstance(e, Op):
        return e
    args = tuple(fold_expr(a) for a in e.args)
    if e.name in ("and", "or") and isinstance(args[0], Const):
        decided = not args[0].value if e.name == "and" else bool(args[0].value)
        return args[0] if decided else args[1]
    if e.name not in ("and", "or") and all(isinstance(a, Const) for a in args):
        return Const(_apply(e.name, [a.value for a in args]))
    return Op(e.name, args)


def fold(body: tuple) -> tuple:
    """Constant expressions evaluated, decided branches chosen, neighbouring texts joined."""
    out: list = []
    for b in body:
        if isinstance(b, Out):
            e = fold_expr(b.expr)
            if isinstance(e, Const):
                s = _text(e.value)
                if out and isinstance(out[-1], Out) and isinstance(out[-1].expr, Const):
                    out[-1] = Out(Const(out[-1].expr.value + s))
                elif s:
                    out.append(Out(Const(s)))
            else:
                out.append(Out(e))
        elif isinstance(b, Generation):
            out.append(Generation(fold(b.body)))
        else:
            cases, orelse = [], fold(b.orelse)
            for cond, inner in b.cases:
                cond = fold_expr(cond)
                if isinstance(cond, Const):
                    if cond.value:
                        orelse = fold(inner)
                        break
                    continue
                cases.append((cond, fold(inner)))
            if cases:
                out.append(If(tuple(cases), orelse))
            else:
                out += orelse
    return tuple(out)


class Sink:
    """Rendered text with its length and the marked spans."""

    def __init__(self, offset: int = 0):
        self.offset, self.size, self.parts, self.spans = offset, 0, [], []

    def add(self, s: str) -> None:
        self.parts.append(s)
        self.size += len(s)


def _expr_closure(e) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda m, v=e.value: v
    if isinstance(e, Field):
        return lambda m, k=e.name: m[k]
    args = [_expr_closure(a) for a in e.args]
    if e.name == "and":
        return lambda m: args[0](m) and args[1](m)
    if e.name == "or":
        return lambda m: args[0](m) or args[1](m)
    if e.name.startswith("filter:"):
        f, a = FILTERS[e.name[7:]], args[0]
        return lambda m: f(_text(a(m)))
    return lambda m, name=e.name: _apply(name, [a(m) for a in args])


def _closure(body: tuple) -> Callable[[dict, Sink], None]:
    steps = []
    for b in body:
        if isinstance(b, Out):
            if isinstance(b.expr, Const):
                steps.append(lambda m, sink, s=b.expr.value: sink.add(s))
            else:
                steps.append(lambda m, sink, f=_expr_closure(b.expr): sink.add(_text(f(m))))
        elif isinstance(b, Generation):

            def marked(m, sink, run=_closure(b.body)):
                start = sink.offset + sink.size
                run(m, sink)
                sink.spans.append((start, sink.offset + sink.size))

            steps.append(marked)
        else:

            def choose(m, sink, cases=[(_expr_closure(c), _closure(x)) for c, x in b.cases], orelse=_closure(b.orelse)):  # noqa: B006
                for cond, run in cases:
                    if cond(m):
                        return run(m, sink)
                return orelse(m, sink)

            steps.append(choose)

    def run(m, sink):
        for s in steps:
            s(m, sink)

    return run


@dataclass
class Compiled:
    head: Callable[[dict, Sink], None]
    message: Callable[[dict, Sink], None]
    tail: Callable[[dict, Sink], None]

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        """Text and marked spans of one conversation of (role, text, turn) dicts."""
        sink = Sink()
        self.head({}, sink)
        for i, m in enumerate(messages):
            self.message(m | {"first": not i}, sink)
        self.tail({}, sink)
        return "".join(sink.parts), sink.spans


def compile_template(source: str) -> Compiled:
    t = parse(source)
    return Compiled(_closure(fold(t.head)), _closure(fold(t.body)), _closure(fold(t.tail)))


# ------------------------------------------------------------------ Spark


def render_batches(batches, template: str):
    """Rows sorted by conversation and turn become formatted parts."""
    t = compile_template(template)
    conv, part, turns, sink = None, 0, 0, Sink()
    out: list[tuple] = []

    def flush():
        nonlocal part, turns, sink
        out.append((conv, part, sink.offset, "".join(sink.parts), [{"start": a, "end": b} for a, b in sink.spans]))
        part, turns, sink = part + 1, 0, Sink(sink.offset + sink.size)

    def rows():
        cols = list(zip(*out, strict=True))
        out.clear()
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)], names=["conv_id", "part", "offset", "formatted", "spans"])

    for batch in batches:
        for c, turn, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text")), strict=True):
            first = c != conv
            if first:
                if conv is not None:
                    t.tail({}, sink)
                    flush()
                conv, part, turns, sink = c, 0, 0, Sink()
                t.head({}, sink)
            elif turns >= PART_TURNS or sink.size >= PART_CHARS:
                flush()
            t.message({"role": role or "", "text": text or "", "turn": turn, "first": first}, sink)
            turns += 1
        if out:
            yield rows()
    if conv is not None:
        t.tail({}, sink)
        flush()
        yield rows()


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, offset (code points before the part), formatted text and marked spans (offsets in the conversation)."""
    compile_template(template)  # a wrong template fails here, not in a task
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    placed = rows.where("conv_id IS NOT NULL").repartition(parts(rows), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.mapInArrow(shipped(__name__, "render_batches", template=template), FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a text that TEMPLATE made; anything else is an error."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back_batches(batches):
    """Digests of every conversation, from its parts in order (they never cross a partition)."""
    conv, n, turns, loss, loss_chars, chars = None, 0, None, None, 0, 0
    out: list[tuple] = []

    def done():
        out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    for batch in batches:
        for c, offset, text, spans in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "offset", "formatted", "spans")), strict=True):
            if c != conv:
                if conv is not None:
                    done()
                conv, n, turns, loss, loss_chars, chars = c, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            for role, said in read_turns(text):
                turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                n += 1
            for s in spans:
                said = unescape(text[s["start"] - offset : s["end"] - offset])
                loss.update(said.encode("utf-8", "surrogatepass"))
                loss_chars += len(said)
            chars += len(text)
        if out:
            yield _read(out)
            out = []
    if conv is not None:
        done()
        yield _read(out)


def _read(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text recovered from ``format_conversations`` (directly: its order is relied on)."""
    return formatted.mapInArrow(shipped(__name__, "read_back_batches"), READ)
