"""The star-schema tables as a virtual graph (s, p, o).

Each predicate is a projection of one table with a constant p. A pattern becomes the union of the branches that can match it:
a bound subject or object turns into a condition on the key or column that its term is made of, which reaches
the scan, or rules the branch out; so do the kinds of terms that the other patterns leave a variable.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.plans.vocabulary import SKOS, Vocabulary
from quillgraph.sources.turtle import RDF, XSD

V = Vocabulary()
#: Patterns over files of more rows than this are joined by shuffle; smaller ones are left to Catalyst, which may broadcast them.
FEW_ROWS = 50_000
LABEL, TYPE = f"<{SKOS}prefLabel>", f"<{RDF}type>"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ent(kind: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"<{V.instances}{kind}."), (F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(">"))


def pred(name: str) -> str:
    return f"<{V.schema}{name}>"


def text(c: Column | str) -> Column:
    return F.concat(F.lit('"'), c if isinstance(c, Column) else F.col(c), F.lit('"'))


def typed(c: Column, datatype: str) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit(f'"^^<{XSD}{datatype}>'))


def item_key(df: DataFrame) -> Column:
    """A line item has no key, so its IRI hashes the whole row."""
    return F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in df.columns)), 256)


@dataclass(frozen=True)
class Term:
    """A column of terms: all begin with `head`; `key` of `kind` is what stands between head and tail; or one constant."""

    column: Column
    head: str
    tail: str = ""
    key: str | None = None
    kind: str = ""
    constant: str | None = None
    uses: tuple[str, ...] = ()  # the columns it is made of, where branches that repeat rows need them

    def condition(self, value: str) -> Column | None:
        """Which rows have this term; None if none can."""
        if self.constant is not None:
            return F.lit(True) if value == self.constant else None
        if not value.startswith(self.head) or not value.endswith(self.tail) or len(value) < len(self.head) + len(self.tail):
            return None
        inner = value[len(self.head) : len(value) - len(self.tail)]
        if self.kind == "string":
            return F.col(self.key) == inner
        if self.kind == "int":
            return F.col(self.key) == int(inner) if inner.lstrip("-").isdigit() and str(int(inner)) == inner else None
        return self.column == value


@dataclass(frozen=True)
class Branch:
    rows: DataFrame
    s: Term
    p: str
    o: Term
    unique: bool = True  # whether no two of its rows are one triple


class View:
    """Branches as one graph; `match` is what a pattern needs of it."""

    def __init__(self, branches: list[Branch], whole: View | None = None):
        self.branches, self.whole = branches, whole or self
        self._rows: dict[tuple[str, ...], int] = {}

    @property
    def df(self) -> DataFrame:
        return self._union(self.branches, {})

    def counts(self) -> DataFrame:
        """(p, n): triples by predicate, as a set. Each branch's keys are counted where they lie; those of branches whose rows may repeat are made distinct."""
        parts = []
        for b in self.branches:
            rows = b.rows
            if not b.unique:
                rows = rows.select(*sorted({c for t in (b.s, b.o) for c in t.uses})).distinct()
            parts.append(rows.agg(F.count("*").alias("n")).select(F.lit(b.p).alias("p"), "n"))
        return reduce(DataFrame.unionAll, parts).groupBy("p").agg(F.sum("n").alias("n"))

    def _union(self, branches: list[Branch], bound: dict[str, str]) -> DataFrame:
        parts = []
        for b in branches:
            rows = b.rows
            for place, value in bound.items():
                rows = rows.filter(getattr(b, place).condition(value))
            parts.append(rows.select(b.s.column.alias("s"), F.lit(b.p).alias("p"), b.o.column.alias("o")))
        if not parts:
            return self._union(self.whole.branches[:1], {}).filter(F.lit(False))
        return reduce(DataFrame.unionAll, parts)

    def _fitting(self, pattern) -> list[Branch]:
        p = pattern.p if isinstance(pattern.p, tuple) else (pattern.p,) if isinstance(pattern.p, str) else None
        ok = [b for b in self.branches if p is None or b.p in p]
        for place in "so":
            value = getattr(pattern, place)
            if isinstance(value, str):
                ok = [b for b in ok if getattr(b, place).condition(value) is not None]
        return ok

    def narrowed(self, patterns: list) -> list[View]:
        """For each pattern a view of the branches that can take part in a solution of all of them."""
        left = [self._fitting(p) for p in patterns]
        kind = lambda t: ("=", t.constant) if t.constant is not None else ("^", t.head)
        ends = [[(place, getattr(p, place).name) for place in "so" if not isinstance(getattr(p, place), str)] for p in patterns]
        while True:
            kinds: dict[str, set] = {}
            for branches, places in zip(left, ends, strict=True):
                for place, name in places:
                    found = {kind(getattr(b, place)) for b in branches}
                    kinds[name] = kinds.get(name, found) & found
            now = [[b for b in branches if all(kind(getattr(b, place)) in kinds[name] for place, name in places)] for branches, places in zip(left, ends, strict=True)]
            if now == left:
                return [View(b, self) for b in now]
            left = now

    def large(self, pattern) -> bool:
        """Whether a branch that fits reads more than FEW_ROWS rows. Files of repeated values are small and terms are long, so sizes of files don't tell; the files' footers do."""
        known = self.whole._rows
        for b in self._fitting(pattern):
            files = tuple(sorted(unquote(f) for f in b.rows.inputFiles() if ".parquet" in f))
            if files not in known:
                known[files] = b.rows.sparkSession.read.parquet(*files).count() if files else 0
            if known[files] > FEW_ROWS:
                return True
        return False

    def triples(self, pattern) -> DataFrame:
        return self._union(self._fitting(pattern), {place: getattr(pattern, place) for place in "so" if isinstance(getattr(pattern, place), str)})


def entity(kind: str, key: str) -> Term:
    return Term(ent(kind, key), f"<{V.instances}{kind}.", ">", key, "int")


def literal(name: str) -> Term:
    return Term(text(name), '"', '"', name, "string")


def constant(value: str) -> Term:
    return Term(F.lit(value), value, constant=value)


def made(column: Column, head: str) -> Term:
    """Any column of terms that begin with head."""
    return Term(column, head)


def _typed(c: Column, datatype: str) -> Term:
    return Term(typed(c, datatype), '"', f'"^^<{XSD}{datatype}>')


def virtual_graph(spark: SparkSession, d: str) -> View:
    t = {n: table(spark, d, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    columns = tuple(t["lineitem"].columns)
    item = Term(ent("Item", item_key(t["lineitem"])), f"<{V.instances}Item.", ">", uses=columns)
    order, order_of_item = entity("Order", "o_orderkey"), entity("Order", "l_orderkey")
    customer, supplier, nation = entity("Customer", "c_custkey"), entity("Supplier", "s_suppkey"), entity("Nation", "n_nationkey")
    rows: list[tuple[str, Term, str, Term]] = []
    for name, kind, key, label in (("region", "Region", "r_regionkey", "r_name"), ("nation", "Nation", "n_nationkey", "n_name"), ("customer", "Customer", "c_custkey", "c_name"), ("supplier", "Supplier", "s_suppkey", "s_name"), ("part", "Part", "p_partkey", "p_name")):
        rows += [(name, entity(kind, key), TYPE, constant(pred(kind))), (name, entity(kind, key), LABEL, literal(label))]
    rows += [
        ("nation", nation, pred("inRegion"), entity("Region", "n_regionkey")),
        ("customer", customer, pred("inNation"), entity("Nation", "c_nationkey")),
        ("customer", customer, pred("segment"), literal("c_mktsegment")),
        ("customer", customer, pred("balance"), _typed(F.col("c_acctbal"), "double")),
        ("supplier", supplier, pred("inNation"), entity("Nation", "s_nationkey")),
        ("orders", order, TYPE, constant(pred("Order"))),
        ("orders", order, pred("placedBy"), entity("Customer", "o_custkey")),
        ("orders", order, pred("status"), literal("o_orderstatus")),
        ("orders", order, pred("priority"), literal("o_orderpriority")),
        ("orders", order, pred("ordered"), _typed(F.to_date("o_orderdate"), "date")),
        ("lineitem", order_of_item, pred("hasItem"), item),
        ("lineitem", item, pred("ofPart"), entity("Part", "l_partkey")),
        ("lineitem", item, pred("fromSupplier"), entity("Supplier", "l_suppkey")),
        ("lineitem", item, pred("shipped"), _typed(F.to_date("l_shipdate"), "date")),
    ]
    branches = [Branch(t[name], s, p, o, name != "lineitem") for name, s, p, o in rows]
    for flag, p in (("R", "returnedItem"), ("A", "acceptedItem")):
        branches.append(Branch(t["lineitem"].filter(F.col("l_returnflag") == flag), order_of_item, pred(p), item, False))
    return View(branches)


def rdf_view(spark: SparkSession, d: str) -> DataFrame:
    return virtual_graph(spark, d).df
