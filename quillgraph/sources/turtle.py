"""Turtle text to term rows and back."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from urllib.parse import urljoin

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"

_LEX = re.compile(
    r"""(?P<ws>\s+|\#[^\n]*)|(?P<iri><[^<>"{}|^`\\\x00-\x20]*>)|(?P<text>\"{3}(?:[^"\\]|\\.|"{1,2}(?!"))*\"{3}|'{3}(?:[^'\\]|\\.|'{1,2}(?!'))*'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
    r"""|(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<blank>_:[\w.-]*[\w-])|(?P<name>(?:[^\W\d_][\w.-]*)?:(?:(?:[\w:%]|\\[-_~.!$&'()*+,;=/?\#@%])(?:[\w:%.-]|\\[-_~.!$&'()*+,;=/?\#@%])*)?)"""
    r"""|(?P<number>[+-]?(?:\d+\.\d+(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|\d+(?:[eE][+-]?\d+)?))|(?P<word>[A-Za-z]+)|(?P<mark>[\[\]();,.])""",
    re.DOTALL,
)
_ESCAPE = re.compile(r"""\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))""", re.DOTALL)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}

Term = tuple[str, str, str | None, str | None]  # value, kind (iri, bnode, lit), datatype, language


class TurtleError(ValueError):
    pass


def _unescape(s: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _PLAIN.get(m[3], m[3]), s)


def _tokens(text: str) -> Iterator[tuple[str, str, int]]:
    at = 0
    while at < len(text):
        m = _LEX.match(text, at)
        if not m:
            raise TurtleError(f"line {text.count(chr(10), 0, at) + 1}: unexpected {text[at : at + 20]!r}")
        kind, value = m.lastgroup, m[0]
        if kind in ("name", "blank") and value.endswith("."):  # the last dot ends the statement
            value = value.rstrip(".")
        at += len(value)
        if kind != "ws":
            yield kind, value, at
    yield "end", "", at


class _Parser:
    def __init__(self, text: str, scope: str):
        self.text, self.scope, self.tokens = text, scope, list(_tokens(text))
        self.i, self.blanks, self.base, self.prefixes, self.rows = 0, 0, "", {}, []

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.i][:2]

    def take(self, value: str | None = None, kind: str | None = None) -> str:
        k, v, at = self.tokens[self.i]
        if value is not None and v != value or kind is not None and k != kind:
            raise TurtleError(f"line {self.text.count(chr(10), 0, at) + 1}: expected {value or kind}, found {v or 'the end'!r}")
        self.i += 1
        return v

    def run(self) -> list[tuple[Term, str, Term]]:
        while self.peek()[0] != "end":
            k, v = self.peek()
            if k == "at" and v in ("@prefix", "@base") or k == "word" and v.lower() in ("prefix", "base"):
                self.i += 1
                if v.lower().endswith("prefix"):
                    name = self.take(kind="name")
                    self.prefixes[name[:-1]] = self.iri(self.take(kind="iri"))
                else:
                    self.base = self.iri(self.take(kind="iri"))
                if k == "at":
                    self.take(".")
                continue
            if v == "[":
                subject = self.nested()
                if self.peek()[1] != ".":
                    self.properties(subject)
            else:
                subject = self.node()
                if subject[1] == "lit":
                    raise TurtleError("a literal can't be a subject")
                self.properties(subject)
            self.take(".")
        return self.rows

    def iri(self, token: str) -> str:
        return urljoin(self.base, _unescape(token[1:-1])) if self.base else _unescape(token[1:-1])

    def blank(self) -> Term:
        self.blanks += 1
        return f"{self.scope}-{self.blanks}", "bnode", None, None

    def nested(self) -> Term:
        self.take("[")
        node = self.blank()
        if self.peek()[1] != "]":
            self.properties(node)
        self.take("]")
        return node

    def properties(self, subject: Term) -> None:
        while True:
            if self.peek() == ("word", "a"):
                self.i += 1
                predicate = RDF + "type"
            else:
                term = self.node()
                if term[1] != "iri":
                    raise TurtleError("a predicate must be an IRI")
                predicate = term[0]
            while True:
                self.rows.append((subject, predicate, self.node()))
                if self.peek()[1] != ",":
                    break
                self.i += 1
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.i += 1
            if self.peek()[1] in (".", "]"):
                return

    def node(self) -> Term:
        k, v = self.peek()
        if v == "[":
            return self.nested()
        self.i += 1
        if k == "iri":
            return self.iri(v), "iri", None, None
        if k == "name":
            prefix, _, local = v.partition(":")
            if prefix not in self.prefixes:
                raise TurtleError(f"unknown prefix {prefix}:")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local), "iri", None, None
        if k == "blank":
            return f"{self.scope}-{v[2:]}", "bnode", None, None
        if k == "text":
            quotes = 3 if v[:3] in ('"""', "'''") and len(v) >= 6 else 1
            value = _unescape(v[quotes:-quotes])
            if self.peek()[0] == "at":
                return value, "lit", RDF + "langString", self.take()[1:].lower()
            if self.peek()[0] == "type":
                self.i += 1
                return value, "lit", self.node()[0], None
            return value, "lit", XSD + "string", None
        if k == "number":
            return v, "lit", XSD + ("double" if "e" in v.lower() else "decimal" if "." in v else "integer"), None
        if k == "word" and v in ("true", "false"):
            return v, "lit", XSD + "boolean", None
        if v == "(":
            items = []
            while self.peek()[1] != ")":
                items.append(self.node())
            self.take(")")
            head: Term = (RDF + "nil", "iri", None, None)
            for item in reversed(items):
                cell = self.blank()
                self.rows += [(cell, RDF + "first", item), (cell, RDF + "rest", head)]
                head = cell
            return head
        raise TurtleError(f"unexpected {v or 'end'!r}")


def parse(text: str, scope: str = "b") -> list[tuple[Term, str, Term]]:
    """Triples in text order; blank nodes are named within `scope`."""
    return _Parser(text, scope).run()


def _quote(s: str) -> str:
    return '"' + s.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r") + '"'


def serialize(rows: Iterable[tuple[Term, str, Term]]) -> str:
    """Turtle with one subject a block, in order of subject, predicate, object; each triple once."""

    def show(t: Term) -> str:
        value, kind, datatype, language = t
        if kind == "iri":
            return f"<{value}>"
        if kind == "bnode":
            return "_:" + re.sub(r"\W", "_", value)
        return _quote(value) + (f"@{language}" if language else "" if datatype in (None, XSD + "string") else f"^^<{datatype}>")

    out, last = [], None
    for s, p, o in sorted({(show(s), f"<{p}>", show(o)) for s, p, o in rows}):
        out.append(f" ;\n    {p} {o}" if s == last else f"{' .' if last else ''}\n{s} {p} {o}")
        last = s
    return ("".join(out) + " .\n").lstrip() if out else ""
