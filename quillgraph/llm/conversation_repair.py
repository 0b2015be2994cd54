"""Conversation structure repair by weighted finite-state composition.

Three machines are composed lazily: the conversation as an input acceptor (a chain with one symbol a row: the role's initial and
the row's fault), an edit transducer (keep, rerole, delete, insert, each with a cost and a label) and a role-grammar acceptor.
The repair is the shortest path through the composition, over weights (cost, label string) ordered lexicographically. Its states are
visited in topological order, row by row, so only the grammar's few states are live at a time: a conversation streams through
however long it is. A run of insertions longer than the grammar has states would come back to a state at a positive cost, so
runs are followed without a repeated state, which keeps the composition acyclic. All edits of a row with the insertions before it
are one label `I*[DKR]`; no such label begins another, so label strings of equal cost are ordered by what was before, then by label.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col, map_rows, read

NAMES = {"u": "user", "a": "assistant"}
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class Grammar:
    """Role initials `(s?(ua)+)?` as an acceptor: arcs[state][initial] is the next state."""

    arcs: tuple[dict[str, int], ...] = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    finals: frozenset[int] = frozenset({0, 3})


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


@dataclass
class Composition:
    """The arcs of the composed machine from a grammar state by an input symbol; each is made when it is first asked for."""

    grammar: Grammar = field(default_factory=Grammar)
    costs: Costs = field(default_factory=Costs)
    _arcs: dict = field(default_factory=dict)
    _runs: dict = field(default_factory=dict)

    def insertions(self, state: int) -> list[tuple[int, str]]:
        """(state, initials inserted) of every run of insertions without a repeated state, the empty one first."""
        if state not in self._runs:
            runs = [(state, "")]
            seen = {state}
            for at, done in runs:  # grows while it is read: a breadth-first walk
                for initial in NAMES:
                    to = self.grammar.arcs[at].get(initial)
                    if to is not None and to not in seen:
                        seen.add(to)
                        runs.append((to, done + initial))
            self._runs[state] = runs
        return self._runs[state]

    def arcs(self, state: int, symbol: tuple[str, bool, bool]) -> list[tuple[int, int, str, str, str]]:
        """symbol: (role initial, must go, truncated). Arcs (to, cost, label, initials inserted, output: '' deleted, '=' kept, or the new initial)."""
        made = self._arcs.get((state, symbol))
        if made is None:
            initial, must_go, truncated = symbol
            best: dict[int, tuple] = {}
            for at, inserted in self.insertions(state):
                moves = [(at, self.costs.delete, "D", "")]
                if not must_go:
                    stay = self.costs.truncated * truncated
                    if initial in self.grammar.arcs[at]:
                        moves.append((self.grammar.arcs[at][initial], stay, "K", "="))
                    moves += [(self.grammar.arcs[at][r], stay + self.costs.rerole, "R", r) for r in NAMES if r in self.grammar.arcs[at]]
                for to, cost, label, output in moves:
                    arc = (cost + self.costs.insert * len(inserted), "I" * len(inserted) + label, inserted, output)
                    best[to] = min(best.get(to, arc), arc)
            made = self._arcs[state, symbol] = [(to, *arc) for to, arc in best.items()]
        return made


class ShortestPath:
    """Relaxes the composed states row by row. Of each row it keeps one byte pair a state, to read the labels back from the end."""

    def __init__(self, machine: Composition):
        self.machine = machine
        #: state -> (cost, place of its label string among those of all live states, digest of the repaired lines or None)
        self.live: dict[int, tuple[int, int, object]] = {0: (0, 0, None)}
        self.back = bytearray()  # of each row and state: the state before, and the place of the label in `labels`
        self.labels: list[str] = []
        self._places: dict[str, int] = {}

    def _place(self, label: str) -> int:
        if label not in self._places:
            self._places[label] = len(self.labels)
            self.labels.append(label)
        return self._places[label]

    def step(self, symbol: tuple[str, bool, bool], role: str, text: str) -> None:
        best: dict[int, tuple] = {}
        for state, (cost, place, _) in self.live.items():
            for to, more, label, inserted, output in self.machine.arcs(state, symbol):
                found = (cost + more, place, label, state, inserted, output)
                if to not in best or found < best[to]:
                    best[to] = found
        order = {to: i for i, (to, _) in enumerate(sorted(best.items(), key=lambda x: x[1][1:3]))}
        row = bytearray(2 * len(self.machine.grammar.arcs))
        live = {}
        for to, (cost, _, label, state, inserted, output) in best.items():
            row[2 * to], row[2 * to + 1] = state, self._place(label)
            digest = self._insert(self.live[state][2], inserted)
            if output:
                digest = self._line(digest, f"{role if output == '=' else NAMES[output]}:{text}")
            live[to] = cost, order[to], digest
        self.back += row
        self.live = live

    def _insert(self, digest, initials: str):
        for r in initials:
            digest = self._line(digest, f"{NAMES[r]}:")
        return digest

    @staticmethod
    def _line(digest, line: str):
        if digest is None:
            return hashlib.sha256(line.encode())
        digest = digest.copy()
        digest.update(b"\n" + line.encode())
        return digest

    def finish(self) -> tuple[int, str, str]:
        """(cost, labels, sha256 of the repaired lines)."""
        ends = []
        for state, (cost, place, digest) in self.live.items():
            for to, inserted in self.machine.insertions(state):
                if to in self.machine.grammar.finals:
                    ends.append((cost + self.machine.costs.insert * len(inserted), place, "I" * len(inserted), state, inserted, digest))
        cost, _, label, state, inserted, digest = min(ends, key=lambda e: e[:4])
        digest = self._insert(digest, inserted)
        pieces = [label]
        width = 2 * len(self.machine.grammar.arcs)
        for at in range(len(self.back) - width, -1, -width):
            pieces.append(self.labels[self.back[at + 2 * state + 1]])
            state = self.back[at + 2 * state]
        return cost, "".join(reversed(pieces)), (digest or hashlib.sha256()).hexdigest()


@dataclass
class _Talk:
    """What is known of the conversation that is passing through."""

    path: ShortestPath
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    before: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, first_turn: int | None, repeated: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        last = text.rstrip(_BLANKS)[-1:]
        # Of rows that share role and text the first turn's is the first, and of equal rows, which come together, the one before.
        again = bool(last) and (self.before == (turn, role, text) or repeated and first_turn != turn)
        cut_off = bool(last) and not again and last not in ".!?"
        self.blank += not last
        self.duplicate += again
        self.truncated += cut_off
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in ("su", "ua", "au")
        self.before = turn, role, text
        self.path.step((role[:1] if role[:1] in ("s", "u", "a") else "", not last or again, cut_off), role, text)

    def result(self) -> tuple:
        cost, audit, digest = self.path.finish()
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


def _ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """Rows (conv, there, turn, role, text, first_turn, repeated), each conversation in one task, in order."""
    rows = df.select(
        col(conv_col).cast("long").alias("conv"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("there"),
        col(turn_col).cast("long").alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    # Keys without nulls, so that one conversation's rows with null ids meet too.
    key = {"_c": F.coalesce(F.col("conv"), F.lit(0)), "_n": F.col("conv").isNull(), "_d": F.sha2(F.concat_ws("\0", "role", "text"), 256)}
    same = rows.filter(F.col("there") & F.col("text").rlike(f"[^{_BLANKS}]")).select(*(c.alias(k) for k, c in key.items()), "turn").groupBy(*key).agg(F.count("*").alias("_rows"), F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("_first"))
    same = same.filter("_rows > 1").select(*key, F.col("_first.turn").alias("first_turn"), F.lit(True).alias("repeated"))
    rows = rows.withColumns(key).join(same, list(key), "left").drop("_d")
    return rows.repartition("_c", "_n").sortWithinPartitions("_n", "_c", "there", "turn", "role", "text").select("conv", "there", "turn", "role", "text", "first_turn", F.coalesce("repeated", F.lit(False)).alias("repeated"))


PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair_plans(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """One row a conversation: its faults, the cheapest edits (`audit`, initials of Delete, Insert, Keep, Rerole) with their cost, and the
    sha256 of the repaired `role:text` lines.

    Rows are taken by turn (nulls first), then role and text. Null roles and texts count as one blank; an empty role has no
    initial and can't be kept; rows with a null id are one conversation. A row is blank, else duplicate (same role and text as a row
    before), else truncated. Rows where `present` is false only name their conversation: one of such rows alone has zeros, an
    empty audit and the hash of an empty text. Other columns are ignored; an empty table gives no row.
    A conversation streams through one task, as its hash needs: of each row 8 bytes stay, no text.
    """

    def rows(incoming):
        machine, now, talk = Composition(costs=costs), None, None
        for conv, there, turn, role, text, first_turn, repeated in incoming:
            if talk is None or conv != now:
                if talk is not None:
                    yield now, *talk.result()
                now, talk = conv, _Talk(ShortestPath(machine))
            if there:
                talk.add(turn, role, text, first_turn, repeated)
        if talk is not None:
            yield now, *talk.result()

    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in PLAN.split(", "))])
    return map_rows(_ordered(df, conv_col, turn_col, role_col, text_col, present), rows, schema, PLAN)


def repaired_turns(df: DataFrame, plans: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, turn, role, text) with place from 0, by the plans of repair_plans(df, ...).

    Inserted rows have a null turn and an empty text. The same cases hold as there; conversations without a plan give no row.
    Each conversation streams through a task behind its own plan.
    """
    base = df.select(col(conv_col).cast("long").alias("conv"), F.lit(1).alias("kind"), col(turn_col).cast("long").alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"))
    both = base.unionByName(plans.select(F.col("conv_id").alias("conv"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text")))
    ordered = both.withColumns({"_c": F.coalesce("conv", F.lit(0)), "_n": F.col("conv").isNull()}).repartition("_c", "_n").sortWithinPartitions("_n", "_c", "kind", "turn", "role", "text")
    grammar = Grammar()

    def rows(incoming):
        now, audit, at, place, state = None, "", 0, 0, 0

        def inserted():
            nonlocal at, place, state
            while at < len(audit) and audit[at] == "I":
                initial = next(r for r in NAMES if r in grammar.arcs[state])
                yield now, place, "I", None, NAMES[initial], ""
                at, place, state = at + 1, place + 1, grammar.arcs[state][initial]

        for conv, kind, turn, role, text in incoming:
            if not kind:
                yield from inserted()
                now, audit, at, place, state = conv, text, 0, 0, 0
                continue
            if conv != now or at >= len(audit):
                continue
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = NAMES[next(r for r in NAMES if r in grammar.arcs[state])]
            yield conv, place, edit, turn, role, text
            place, state = place + 1, grammar.arcs[state][role[0]]
        yield from inserted()

    ddl = "conv_id long, place long, edit string, turn long, role string, text string"
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in ddl.split(", "))])
    return map_rows(ordered.select("conv", "kind", "turn", "role", "text"), rows, schema, ddl)


def damage(df: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) with faults planted by crc32(`conv_id:turn`) % 20, nulls as one blank: 0 drops the row
    (`kept` is false), 1 empties the text, 2 takes its full stops, 3 repeats the row, 4 makes it a user's."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20).alias("_k"))
    changed = rows.withColumns(
        {
            "text": F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "role": F.when(F.col("_k") == 4, "user").otherwise(F.col("role")),
            "kept": F.col("_k") != 0,
            "_twice": F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        }
    )
    return changed.select("conv_id", "turn", "role", "text", "kept")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_plans(damage(read(spark, sf_dir, "conversations")), "conv_id", "turn", "role", "text", present=F.col("kept"))


#: A recursive query over the rows of all conversations at once: the state is the grammar's, `runs` are insertions between states.
ORACLE = r"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT),
      lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 20 AS k
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM raw, range(2) again(i) WHERE k <> 0 AND (i = 0 OR k = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut_off, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered),
marked AS (SELECT conv_id, i, turn, role, text, before, blank, NOT blank AND again AS dup, NOT blank AND NOT again AND cut_off AS trunc FROM faults),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(dup::INT) AS duplicate, sum(trunc::INT) AS truncated,
    sum((i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au'))::INT) AS illegal, max(i) AS n
  FROM marked GROUP BY conv_id),
step(f, r, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
runs(f, q, label, cost, body) AS (VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
  (0, 2, 'I', 5, chr(10) || 'user:'), (0, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 'I', 5, chr(10) || 'user:'),
  (1, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 'I', 5, chr(10) || 'assistant:'), (3, 2, 'I', 5, chr(10) || 'user:')),
path AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, '' AS body FROM counts
  UNION ALL
  SELECT conv_id, i, q, cost, audit, body FROM (
    SELECT p.conv_id, p.i + 1 AS i, coalesce(s.q, r.q) AS q, p.cost + r.cost + e.cost + CASE WHEN e.label <> 'D' AND m.trunc THEN 5 ELSE 0 END AS cost,
      p.audit || r.label || e.label AS audit,
      p.body || r.body || CASE e.label WHEN 'D' THEN '' ELSE chr(10) || CASE e.label WHEN 'K' THEN m.role WHEN 'R' THEN CASE s.r WHEN 'u' THEN 'user' ELSE 'assistant' END END || ':' || m.text END AS body
    FROM path p
    JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1
    JOIN runs r ON r.f = p.q
    JOIN (VALUES ('D', 2), ('K', 0), ('R', 1)) e(label, cost) ON e.label = 'D' OR NOT (m.blank OR m.dup)
    LEFT JOIN step s ON e.label <> 'D' AND s.f = r.q AND (e.label = 'K' AND s.r = left(m.role, 1) OR e.label = 'R' AND s.r IN ('u', 'a'))
    WHERE e.label = 'D' OR s.q IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
ended AS (
  SELECT p.conv_id, p.cost + r.cost AS cost, p.audit || r.label AS audit, p.body || r.body AS body
  FROM path p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i JOIN runs r ON r.f = p.q AND r.q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + r.cost, p.audit || r.label) = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
