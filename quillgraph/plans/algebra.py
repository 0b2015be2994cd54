"""Graph-pattern algebra compiled to DataFrame joins.

A solution table has a string column for each variable, holding N-Triples terms (null: unbound). Basic graph patterns
have bag semantics over a set of triples. Joins are equi-joins on the shared variables, ordered so that the most
bound pattern comes first and each next one is connected; Catalyst then picks the physical join. Which variables may be
unbound is known before anything runs; a join over such a variable is split by which sides bind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.sources.graph import lexical, with_predicate
from quillgraph.sources.tables import cut
from quillgraph.sources.turtle import XSD


#: Closures of so many pairs are broadcast to what they are joined to; larger ones are joined by shuffle.
FEW_PAIRS = 50_000


@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class Path:
    """One or more steps (least = 1), or none or more (least = 0), each over one of these predicates."""

    iris: tuple[str, ...]
    least: int = 1


@dataclass(frozen=True)
class Pattern:
    """Each place is a Var or a term; p may also be a tuple of IRIs (alternation) or a Path."""

    s: object
    p: object
    o: object

    @property
    def vars(self) -> list[str]:
        return list(dict.fromkeys(x.name for x in (self.s, self.p, self.o) if isinstance(x, Var)))

    @property
    def bound(self) -> int:
        # A type pattern selects less than it seems, so bound subjects and objects come before predicates; closures come last.
        return 4 * (not isinstance(self.s, Var)) + 2 * (not isinstance(self.o, Var)) + (not isinstance(self.p, Var)) - 8 * isinstance(self.p, Path)


@dataclass
class Group:
    """A { ... }: `parts` in their order, then exists and filters, which see the whole group.

    A part is ("patterns", [Pattern]), ("union", [Group]), ("optional", Group) or ("minus", Group).
    """

    patterns: list[Pattern] = field(default_factory=list)  # a first part, for short
    parts: list[tuple[str, object]] = field(default_factory=list)
    exists: list[tuple[bool, Group]] = field(default_factory=list)
    filters: list[tuple] = field(default_factory=list)

    def ordered(self) -> list[tuple[str, object]]:
        return ([("patterns", self.patterns)] if self.patterns else []) + self.parts


@dataclass
class Query:
    where: Group
    select: list = field(default_factory=list)  # names, or (function, name or None, distinct, alias)
    distinct: bool = False
    ask: bool = False
    group_by: list[str] = field(default_factory=list)
    having: list[tuple] = field(default_factory=list)
    order_by: list[tuple[str, bool]] = field(default_factory=list)  # (name, descending)
    limit: int | None = None
    offset: int = 0


# ---- terms and their values ----

#: XML Schema datatypes that are compared by number, or as points in time.
NUMERIC = "integer decimal double float int long short byte nonNegativeInteger positiveInteger nonPositiveInteger negativeInteger unsignedLong unsignedInt unsignedShort unsignedByte".split()
TIMES = ["date", "dateTime", "gYear"]


def _typed(term: Column, names: list[str]) -> Column:
    return F.regexp_extract(term, rf'(?s)"\^\^<{XSD}({"|".join(names)})>$', 1) != ""


def number(term: Column) -> Column:
    """Value of a numeric literal; null for other terms."""
    return F.when(_typed(term, NUMERIC), lexical(term).try_cast("double"))


def moment(term: Column) -> Column:
    """Seconds since 1970 of a date, a time or a year; null for other terms."""
    text = lexical(term)
    at = F.when(_typed(term, ["gYear"]), F.try_to_timestamp(F.concat(F.substring(text, 1, 4), F.lit("-01-01")))).otherwise(F.try_to_timestamp(text))
    return F.when(_typed(term, TIMES), at.cast("double"))


def sort_key(term: Column) -> Column:
    """What orders terms: unbound, blank nodes, IRIs, numbers by value, times, other literals by text; the term itself ends every tie."""
    n, t = number(term), moment(term)
    kind = F.when(term.isNull(), 0).when(term.startswith("_"), 1).when(term.startswith("<"), 2).when(n.isNotNull(), 3).when(t.isNotNull(), 4).otherwise(5)
    exact = F.when(n.isNotNull(), lexical(term).try_cast("decimal(38,10)"))  # apart where doubles are equal
    return F.struct(kind.alias("kind"), F.coalesce(n, t).alias("value"), exact.alias("exact"), lexical(term).alias("text"), term.alias("term"))


# ---- solutions and their joins ----


@dataclass(frozen=True)
class Solutions:
    """df: a column for each of `names` (with none: some column). maybe: the names that a row may leave unbound. large: whether they are joined to others by shuffle.

    Sizes are guessed from files and terms are longer than keys: a broadcast of large solutions would put all of them into every task. Files are asked only where a join needs to know.
    """

    df: DataFrame
    names: tuple[str, ...]
    maybe: frozenset[str] = frozenset()
    large: Callable[[], bool] = lambda: False


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _subsets(names: Iterable[str]) -> Iterator[frozenset[str]]:
    names = sorted(names)
    return (frozenset(c) for n in range(len(names) + 1) for c in combinations(names, n))


def _with_nulls(s: Solutions, open_: frozenset[str], unbound: frozenset[str]) -> DataFrame:
    """Rows in which, of the names `open_`, exactly `unbound` are unbound."""
    out = s.df
    for n in sorted(open_):
        out = out.filter(_c(n).isNull() if n in unbound else _c(n).isNotNull())
    return out


def _right(name: str) -> str:
    return f"_r_{name}"


def _meetings(a: Solutions, b: Solutions) -> Iterator[tuple[DataFrame, list[tuple[DataFrame, list[str]]]]]:
    """The rows of a by which shared names they leave unbound, each with the parts of b (renamed) and the names that both bind there."""
    shared = [n for n in a.names if n in b.names]
    open_a, open_b = a.maybe & set(shared), b.maybe & set(shared)
    right = {un: _with_nulls(b, open_b, un).select(*(_c(n).alias(_right(n)) for n in b.names) or [F.lit(1).alias("_r_one")]) for un in _subsets(open_b)}
    for un_a in _subsets(open_a):
        keys = {un: [n for n in shared if n not in un_a and n not in un] for un in right}
        yield _with_nulls(a, open_a, un_a), [(part.hint("merge") if keys[un] and b.large() else part, keys[un]) for un, part in right.items()]


def _merged(a: Solutions, b: Solutions, name: str) -> Column:
    if name not in b.names:
        return _c(name)
    if name not in a.names:
        return _c(_right(name))
    return F.coalesce(_c(name), _c(_right(name))) if name in a.maybe else _c(name)


def _on(keys: list[str], conditions: list[Column]) -> Column | None:
    every = [*(_c(n) == _c(_right(n)) for n in keys), *conditions]
    return reduce(lambda x, y: x & y, every) if every else None


def _select(df: DataFrame, columns: list[Column]) -> DataFrame:
    return df.select(*columns or [F.lit(1).alias("_one")])


def join(a: Solutions | None, b: Solutions, filters: list[tuple] = ()) -> Solutions:
    """Compatible solutions of both, merged: an unbound variable is compatible with everything.

    For each pattern of unbound shared variables one equi-join on those that both bind. Patterns without a common variable ask for all
    combinations; SPARQL defines them so.
    """
    if a is None:
        return b
    names = (*a.names, *(n for n in b.names if n not in a.names))
    conditions = [condition(f, lambda n: _merged(a, b, n) if n in names else F.lit(None).cast("string")) for f in filters]
    columns = [_merged(a, b, n).alias(n) for n in names]
    parts = []
    for left, rights in _meetings(a, b):
        for right, keys in rights:
            on = _on(keys, conditions)
            parts.append(_select(left.crossJoin(right) if on is None else left.join(right, on), columns))
    certain = (set(a.names) - a.maybe) | (set(b.names) - b.maybe)
    return Solutions(reduce(DataFrame.unionAll, parts), names, frozenset(names) - certain, lambda: a.large() or b.large())


def having(a: Solutions, b: Solutions, present: bool, filters: list[tuple] = (), need_common: bool = False) -> Solutions:
    """Rows of a that some (present) or no row of b is compatible with. need_common: only rows of b that bind a variable of theirs count."""
    names = set(a.names) | set(b.names)
    conditions = [condition(f, lambda n: _merged(a, b, n) if n in names else F.lit(None).cast("string")) for f in filters]
    parts = []
    for left, rights in _meetings(a, b):
        found = []
        for right, keys in rights:
            if need_common and not keys:
                continue
            on = _on(keys, conditions)
            found.append((right if on is not None else right.limit(1), F.lit(True) if on is None else on))
        if present and len(found) > 1:  # in the first part that fits, so that a row stays once
            rest = left
            for right, on in found:
                parts.append(rest.join(right, on, "left_semi"))
                rest = rest.join(right, on, "left_anti")
            continue
        for right, on in found:
            left = left.join(right, on, "left_semi" if present else "left_anti")
        if found or not present:
            parts.append(left)
    return Solutions(reduce(DataFrame.unionAll, parts), a.names, a.maybe, a.large) if parts else Solutions(a.df.limit(0), a.names, a.maybe)


def optional(a: Solutions, b: Solutions, filters: list[tuple] = ()) -> Solutions:
    """a with b where that is compatible and the filters, which see both, hold."""
    names = (*a.names, *(n for n in b.names if n not in a.names))
    maybe = frozenset(n for n in names if n not in a.names or n in a.maybe)
    shared = set(a.names) & set(b.names)
    if not shared & (a.maybe | b.maybe):
        conditions = [condition(f, lambda n: _merged(a, b, n) if n in names else F.lit(None).cast("string")) for f in filters]
        ((left, [(right, keys)]),) = _meetings(a, b)
        on = _on(keys, conditions)
        return Solutions(_select(left.join(right, F.lit(True) if on is None else on, "left"), [_merged(a, b, n).alias(n) for n in names]), names, maybe, lambda: a.large() or b.large())
    alone = having(a, b, False, filters).df.withColumns({n: F.lit(None).cast("string") for n in names if n not in a.names})
    return Solutions(join(a, b, filters).df.unionByName(_select(alone, [_c(n) for n in names])), names, maybe, lambda: a.large() or b.large())


def union(branches: list[Solutions]) -> Solutions:
    names = tuple(dict.fromkeys(n for b in branches for n in b.names))
    none = F.lit(None).cast("string")
    parts = [_select(b.df, [_c(n) if n in b.names else none.alias(n) for n in names]) for b in branches]
    return Solutions(reduce(DataFrame.unionAll, parts), names, frozenset(n for n in names if any(n not in b.names or n in b.maybe for b in branches)), lambda: any(b.large() for b in branches))


# ---- patterns ----


def match(graph, pattern: Pattern) -> DataFrame:
    """graph: a DataFrame (s, p, o), or a view that gives the rows for a pattern itself, with its conditions pushed down."""
    pushed = hasattr(graph, "triples")
    out, columns = graph.triples(pattern) if pushed else graph, {}
    for place, term in zip("spo", (pattern.s, pattern.p, pattern.o), strict=True):
        if isinstance(term, Var):
            if term.name in columns:
                out = out.filter(F.col(place) == F.col(columns[term.name]))
            columns.setdefault(term.name, place)
        elif pushed:
            continue
        elif place == "p":
            out = with_predicate(out, *(term if isinstance(term, tuple) else (term,)))
        else:
            out = out.filter(F.col(place) == term)
    return _select(out, [F.col(place).alias(name) for name, place in columns.items()])


def closure(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(s, o) for every o that edges(s, o) reach from s in one step or more; with starts(s), from those alone.

    A semi-naive fixpoint: each round joins only the pairs that the last one found, and what is reached already goes, so cycles end. Every
    round is written to the shared folder; there are as many rounds as the longest shortest path has steps. Nulls reach nothing.
    Sizes are guessed from files and terms are longer than keys, so joins are by shuffle: no round sends edges or pairs to the driver.
    """
    edges = cut(edges.select("s", "o").dropna().distinct()).hint("merge")
    new = edges if starts is None else edges.join(starts.select("s").distinct(), "s", "left_semi")
    reached = new = cut(new)
    while not new.isEmpty():
        step = new.select("s", F.col("o").alias("_via")).join(edges.select(F.col("s").alias("_via"), "o"), "_via").select("s", "o").distinct()
        new = cut(step.join(reached.hint("merge"), ["s", "o"], "left_anti"))
        reached = reached.unionAll(new)
    return reached


def walk(graph, pattern: Pattern, known: Solutions | None = None) -> DataFrame:
    """Solutions of a pattern over a Path, each pair once. A closure starts from a bound end, or from what `known` binds there."""
    step = Pattern(Var("s"), pattern.p.iris, Var("o"))
    edges = match(graph, step)
    back = isinstance(pattern.s, Var) and not isinstance(pattern.o, Var)
    bound = lambda t: known is not None and isinstance(t, Var) and t.name in known.names and t.name not in known.maybe
    if not back and isinstance(pattern.s, Var) and not bound(pattern.s) and bound(pattern.o):
        back = True
    if back:
        edges = edges.select(F.col("o").alias("s"), F.col("s").alias("o"))
    start, end = (pattern.o, pattern.s) if back else (pattern.s, pattern.o)
    starts = None
    if not isinstance(start, Var):
        starts = edges.sparkSession.range(1).select(F.lit(start).alias("s"))
    elif bound(start):
        starts = cut(known.df.select(_c(start.name).alias("s")).distinct())
    pairs = closure(edges, starts)
    if pattern.p.least == 0:
        every = graph.df if hasattr(graph, "df") else graph
        nodes = starts if starts is not None else every.select("s").unionAll(every.select("o")).distinct()
        pairs = pairs.unionAll(nodes.select("s", F.col("s").alias("o"))).distinct()
    columns = {}
    for place, term in (("s", start), ("o", end)):
        if not isinstance(term, Var):
            pairs = pairs.filter(F.col(place) == term)
        elif term.name in columns:
            pairs = pairs.filter(F.col("s") == F.col("o"))
        else:
            columns[term.name] = place
    return _select(pairs, [F.col(place).alias(name) for name, place in columns.items()])


def bgp(graph, patterns: list[Pattern], before: Solutions | None = None) -> Solutions | None:
    """before: solutions that the patterns are joined to."""
    left, out = list(patterns), before
    plain = [p for p in patterns if not isinstance(p.p, Path)]
    views = graph.narrowed(plain) if hasattr(graph, "narrowed") else [graph] * len(plain)
    view_of = {id(p): v for p, v in zip(plain, views, strict=True)}
    seen = set(before.names) if before else set()
    while left:
        nxt = max(left, key=lambda q: (bool(seen & set(q.vars)) or not seen, q.bound, -patterns.index(q)))
        left = [q for q in left if q is not nxt]
        view = view_of.get(id(nxt))
        rows = walk(graph, nxt, out) if view is None else match(view, nxt)
        large = partial(view.large, nxt) if hasattr(view, "large") else lambda: False
        if view is None and out is not None:  # a closure's size isn't guessed from files, so that Catalyst may take what stands before for the smaller side and broadcast that
            if rows.count() > FEW_PAIRS:
                large = lambda: True
            else:
                rows = rows.hint("broadcast")
        out = join(out, Solutions(rows, tuple(nxt.vars), large=large))
        seen |= set(nxt.vars)
    return out


def _constant(x: object) -> bool:
    """A term that is compared as it stands: an IRI or a literal that is no number and no time."""
    return isinstance(x, str) and not any(x.endswith(f"^^<{XSD}{t}>") for t in NUMERIC + TIMES)


def condition(e: tuple, column: Callable[[str], Column] = _c) -> Column:
    """(op, ...): = != < <= > >= in && || ! bound regex. Numbers are compared by value, times as such, other terms as texts."""
    op, *args = e
    operand = lambda x: column(x.name) if isinstance(x, Var) else F.lit(x)
    if op in ("&&", "||"):
        return reduce(lambda a, b: a & b if op == "&&" else a | b, (condition(a, column) for a in args))
    if op == "!":
        return ~condition(args[0], column)
    if op == "bound":
        return operand(args[0]).isNotNull()
    if op == "regex":
        return lexical(operand(args[0])).rlike(args[1])
    if op == "in":
        if all(map(_constant, args[1])):
            return operand(args[0]).isin(*args[1])
        return reduce(lambda a, b: a | b, (condition(("=", args[0], x), column) for x in args[1]))
    a, b = map(operand, args)
    if op in ("=", "!="):
        if any(map(_constant, args)):
            return a == b if op == "=" else a != b
        same = (a == b) | F.coalesce(number(a) == number(b), moment(a) == moment(b), F.lit(False))
        return same if op == "=" else ~same
    pick = {"<": lambda x, y: x < y, "<=": lambda x, y: x <= y, ">": lambda x, y: x > y, ">=": lambda x, y: x >= y}[op]
    na, nb, ta, tb = number(a), number(b), moment(a), moment(b)
    return F.when(na.isNotNull() & nb.isNotNull(), pick(na, nb)).when(ta.isNotNull() & tb.isNotNull(), pick(ta, tb)).otherwise(pick(lexical(a), lexical(b)))


def _body(graph, group: Group, before: Solutions | None = None) -> Solutions:
    """The group's parts, without its filters."""
    out = before
    for kind, part in group.ordered():
        if kind == "patterns":
            out = bgp(graph, part, out)
        elif kind == "union":
            out = join(out, union([solve(graph, b) for b in part]))
        elif kind == "optional":
            if out is None:
                raise ValueError("a group must not begin with an optional part")
            out = optional(out, _body(graph, part) if not part.exists else solve(graph, Group([], part.ordered(), part.exists)), part.filters)
        else:
            if out is None:
                continue
            found = solve(graph, part)
            if set(out.names) & set(found.names):
                out = having(out, found, False, need_common=True)
    if out is None:
        raise ValueError("a group needs a pattern")
    return out


def solve(graph, group: Group) -> Solutions:
    out = _body(graph, group)
    none = F.lit(None).cast("string")
    for f in group.filters:
        out = Solutions(out.df.filter(condition(f, lambda n: _c(n) if n in out.names else none)), out.names, out.maybe, out.large)
    for present, g in group.exists:
        # What it finds is compared with the outer solution before its own filters, which see the outer variables too.
        inner = _body(graph, g) if not g.exists else solve(graph, Group([], g.ordered(), g.exists))
        out = having(out, inner, present, g.filters)
    return out


def run(graph, q: Query, lex: bool = True) -> DataFrame:
    """Solutions of q over graph(s, p, o). lex: terms as their values; otherwise as N-Triples strings."""
    found = solve(graph, q.where)
    out = found.df
    if q.ask:
        return out.limit(1).agg((F.count("*") > 0).alias("ask"))
    aggregates = [x for x in q.select if not isinstance(x, str)]
    if aggregates or q.group_by:
        made = []
        for fn, name, distinct, alias in aggregates:
            c = _c(name) if name else F.lit(1)
            value = lexical(c).try_cast("double")
            least = F.when(c.isNotNull(), sort_key(c))
            pick = {"count": lambda: F.count_distinct(c) if distinct else F.count(c), "sum": lambda: F.sum(value), "avg": lambda: F.avg(value), "min": lambda: lexical(F.min(least)["term"]), "max": lambda: lexical(F.max(least)["term"])}
            made.append(pick[fn]().alias(alias))
        out = out.groupBy(*map(_c, q.group_by)).agg(*made)
    plain = {x[3] for x in aggregates}
    names = [x if isinstance(x, str) else x[3] for x in q.select] or list(found.names)
    for op, name, value in q.having:
        out = out.filter(f"`{name}` {op} {value}")
    keys = {f"_k{i}": (_c(n) if n in plain else sort_key(_c(n)), down) for i, (n, down) in enumerate(q.order_by)}
    shown = out.select(*((lexical(_c(n)) if lex and n not in plain else _c(n)).alias(n) for n in names), *(k.alias(n) for n, (k, _) in keys.items()))
    if q.distinct:
        shown = shown.groupBy(*map(_c, names)).agg(*(F.min(n).alias(n) for n in keys)) if keys else shown.distinct()
    if q.order_by:
        shown = shown.orderBy(*(F.desc(n) if down else F.asc(n) for n, (_, down) in keys.items()), *map(_c, names))
    if q.offset:
        shown = shown.offset(q.offset)
    if q.limit is not None:
        shown = shown.limit(q.limit)
    return shown.select(*map(_c, names)) if keys else shown
