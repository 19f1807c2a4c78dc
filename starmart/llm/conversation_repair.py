"""Repair of conversations by generalised LR parsing with weighted edits.

The grammar of roles (``RULES``: a conversation is empty, or an optional system turn and then
pairs of user and assistant) is turned into an LR(0) automaton.  A row may be kept, deleted or
given another role, and empty turns may be inserted; all ways are followed at once on a
graph-structured stack, whose nodes are shared, and ways that end in the same node are merged
by the least (cost, audit), where the audit is the string of the edits' initials.

Audits are not carried along as strings.  Before a row, audits of equally many rows end in a
row's letter, so none is the beginning of another, and their order is a rank; a row adds a few
letters to a rank.  Steps between ranked fronts repeat, so they are remembered, and the audit
is read off the back-pointers.

Rows are range-dealt by (conversation, turn), so a conversation however long lies over many
blocks.  A block settles the conversations inside it.  Its first and last one may go on in
another block: their fragments are parsed from every stack that can stand at their start,
fragments are chained in order, and then repaired each with its own edits.  Only the hash of a
repaired conversation, one sequence by its nature, is fed row by row in one task.

Defined results: a null role or text is one space; roles other than user, assistant and
system begin with their own initial and cannot be kept unless it is s, u or a; rows of a null
conversation are one conversation; null turns come first and count for no gap; rows of equal
turn are ordered by role and the text's hash; a conversation without rows has zeros, an empty
audit and the hash of the empty string; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import only
from starmart.session import stage

# --- grammar and stack -------------------------------------------------------------------

#: S' -> S; S -> nothing | system T | T; T -> T P | P; P -> user assistant.  Small letters are roles.
RULES = (("Z", "S"), ("S", ""), ("S", "sT"), ("S", "T"), ("T", "TP"), ("T", "P"), ("P", "ua"))
ROLES = {"s": "system", "u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1


class Node:
    """Top of a stack; equal stacks are one node, known by its number."""

    __slots__ = ("state", "below", "number", "moves", "accepts")

    def __init__(self, state: int, below: Node | None, number: int):
        self.state, self.below, self.number = state, below, number
        self.moves: dict[str, tuple[Node, ...]] = {}
        self.accepts = False


class Parser:
    """LR(0) automaton of the rules and the graph of stacks over it."""

    def __init__(self):
        self.states: list[frozenset] = []
        self.goto: dict[tuple[int, str], int] = {}
        self._state(self._closure({(0, 0)}))
        self.interned: dict[tuple, Node] = {}
        self.nodes = [self._node(0, None)]
        for node in self.nodes:  # grows while stacks are found; the role grammar has few
            reached = self._reduced(node)
            node.accepts = any((0, 1) in self.states[n.state] for n in reached)
            for role in ROLES:
                tops = chain.from_iterable(self._live(n, role) for n in reached if (n.state, role) in self.goto)
                node.moves[role] = tuple(dict.fromkeys(tops))

    def _closure(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            for k, (head, _) in enumerate(RULES):
                if RULES[rule][1][dot : dot + 1] == head and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    def _state(self, items: frozenset) -> int:
        if items in self.states:
            return self.states.index(items)
        self.states.append(items)
        number = len(self.states) - 1
        for symbol in sorted({RULES[r][1][d] for r, d in items if d < len(RULES[r][1])}):
            kernel = {(r, d + 1) for r, d in items if RULES[r][1][d : d + 1] == symbol}
            self.goto[number, symbol] = self._state(self._closure(kernel))
        return number

    def _node(self, state: int, below: Node | None) -> Node:
        key = (state, below and below.number)
        if key not in self.interned:
            self.interned[key] = Node(state, below, len(self.interned))
        return self.interned[key]

    def _reduced(self, node: Node) -> list[Node]:
        """The node and all that reductions make of it."""
        found = [node]
        for top in found:
            for rule, dot in self.states[top.state]:
                head, body = RULES[rule]
                if rule and dot == len(body):
                    under = top
                    for _ in body:
                        under = under.below
                    new = self._node(self.goto[under.state, head], under)
                    if new not in found:
                        found.append(new)
        return found

    def _live(self, node: Node, role: str) -> list[Node]:
        """Stacks after a shift that can shift again, entered into ``nodes``."""
        top = self._node(self.goto[node.state, role], node)
        able = [n for n in self._reduced(top) if any((n.state, r) in self.goto for r in ROLES)]
        self.nodes += [n for n in able if n not in self.nodes]
        return able


@lru_cache(maxsize=1)
def parser() -> Parser:
    return Parser()


# --- weighted edits ----------------------------------------------------------------------

#: What a row is to the parser: its role's initial, whether it must go, whether it is truncated.
Symbol = tuple[str, bool, bool]
#: Ways followed at once: (cost beyond the cheapest, rank of the audit so far, number of the stack's node).
Front = tuple[tuple[int, int, int], ...]


def _with_inserts(front: Iterable[tuple[int, int, int]]) -> dict[int, tuple[int, int, str]]:
    """Node -> least (cost, rank, letters added) when turns may be inserted."""
    nodes = parser().nodes
    best = {n: (cost, rank, "") for cost, rank, n in front}
    todo = list(best)
    while todo:
        n = todo.pop()
        cost, rank, added = best[n]
        way = (cost + INSERT, rank, added + "I")
        for top in nodes[n].moves["u"] + nodes[n].moves["a"]:
            k = nodes.index(top)
            if k not in best or way < best[k]:
                best[k] = way
                todo.append(k)
    return best


@lru_cache(maxsize=1 << 16)
def step(front: Front, symbol: Symbol) -> tuple[int, Front, tuple[tuple[int, str], ...]]:
    """(cost added to all, next front, per way of it the rank it comes from and the letters added)."""
    nodes = parser().nodes
    initial, must_go, truncated = symbol
    best: dict[int, tuple[int, int, str]] = {}

    def offer(k: int, way: tuple[int, int, str]) -> None:
        if k not in best or way < best[k]:
            best[k] = way

    for n, (cost, rank, added) in _with_inserts(front).items():
        offer(n, (cost + DELETE, rank, added + "D"))
        if must_go:
            continue
        cost += TRUNCATED * truncated
        for top in nodes[n].moves.get(initial, ()):
            offer(nodes.index(top), (cost, rank, added + "K"))
        for role in "ua":
            for top in nodes[n].moves[role]:
                offer(nodes.index(top), (cost + REROLE, rank, added + "R"))
    audits = sorted({way[1:] for way in best.values()})
    least = min(way[0] for way in best.values())
    after = tuple(sorted((cost - least, audits.index((rank, added)), n) for n, (cost, rank, added) in best.items()))
    return least, after, tuple(audits)


def _read_off(backs: list[tuple[tuple[int, str], ...]], rank: int) -> str:
    letters = []
    for audits in reversed(backs):
        rank, added = audits[rank]
        letters.append(added)
    return "".join(reversed(letters))


def _finish(front: Iterable[tuple[int, int, int]]) -> tuple[int, int, str]:
    """The least (cost, rank, letters added) that ends a conversation."""
    nodes = parser().nodes
    return min(way for n, way in _with_inserts(front).items() if nodes[n].accepts)


def _run(symbols: Iterable[Symbol], entry: int) -> tuple[int, Front, list]:
    total, front, backs = 0, ((0, 0, entry),), []
    for symbol in symbols:
        cost, front, audits = step(front, symbol)
        total += cost
        backs.append(audits)
    return total, front, backs


def repair(symbols: Iterable[Symbol]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; of several the audit that is least."""
    total, front, backs = _run(symbols, 0)
    cost, rank, added = _finish(front)
    return total + cost, _read_off(backs, rank) + added


def fragment_ways(symbols: list[Symbol]) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a fragment for every stack that can stand before it."""
    out = []
    for entry in range(len(parser().nodes)):
        total, front, backs = _run(symbols, entry)
        out += [(entry, n, total + cost, _read_off(backs, rank)) for cost, rank, n in front]
    return out


def chain_fragments(fragments: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the whole, and for each fragment the stack before it and its audit (the last with the end's inserts)."""
    front, steps = {0: (0, 0)}, []
    for ways in fragments:
        best: dict[int, tuple] = {}
        for entry, end, cost, audit in ways:
            if entry in front:
                way = (front[entry][0] + cost, front[entry][1], audit, entry)
                if end not in best or way < best[end]:
                    best[end] = way
        order = sorted({way[1:3] for way in best.values()})
        front = {end: (way[0], order.index(way[1:3])) for end, way in best.items()}
        steps.append({front[end][1]: (way[1], way[3], way[2]) for end, way in best.items()})
    cost, rank, added = _finish([(cost, rank, n) for n, (cost, rank) in front.items()])
    out = []
    for taken in reversed(steps):
        rank, entry, audit = taken[rank]
        out.append((entry, audit + added))
        added = ""
    return cost, out[::-1]


def replay(audit: str, roles: list[str], texts: list[str], entry: int = 0) -> list[str]:
    """The repaired ``role:text`` rows that an audit makes of damaged ones."""
    node, rows, out = parser().nodes[entry], iter(zip(roles, texts)), []
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        initial = role[:1]
        if letter != "K":
            initial = next(r for r in "ua" if node.moves[r])
            role = ROLES[initial]
        node = node.moves[initial][0]
        out.append(f"{role}:{text}")
    return out


# --- rows --------------------------------------------------------------------------------

_WHITE = " \t\n\x0b\x0c\r"


def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: the contract's damage; a dropped row has no copies and no text."""
    source = only(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return source.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


class Rows:
    """Rows of a conversation, or of its fragment in a block, in order."""

    def __init__(self, turns: list, roles: list[str], texts: list[str]):
        self.turns, self.roles, self.texts = turns, roles, texts

    def firsts(self) -> set[int]:
        """Places of rows that repeat no earlier one."""
        seen: dict[bytes, int] = {}
        for k, (role, text) in enumerate(zip(self.roles, self.texts)):
            seen.setdefault(hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), k)
        return set(seen.values())

    def judge(self, firsts: set[int]) -> tuple[list[Symbol], tuple[int, int, int], int]:
        """(symbols, counts of blank, duplicate and truncated rows, illegal neighbours)."""
        symbols, blank, duplicate, truncated = [], 0, 0, 0
        for k, (role, text) in enumerate(zip(self.roles, self.texts)):
            seen = text.rstrip(_WHITE)
            empty, again = not seen, k not in firsts
            cut = not empty and not again and seen[-1] not in ".!?"
            blank, duplicate, truncated = blank + empty, duplicate + (again and not empty), truncated + cut
            symbols.append((role[:1], empty or again, cut))
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        return symbols, (blank, duplicate, truncated), illegal

    def span(self) -> tuple[int | None, int | None, int]:
        known = [t for t in self.turns if t is not None]
        return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _gaps(low: int | None, high: int | None, different: int) -> int:
    return 0 if low is None else high - low + 1 - different


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FRAGMENT = "fragment long, turns array<long>, roles array<string>, texts array<string>"
_ARROW = {
    "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    "int": pa.int32(), "boolean": pa.bool_(),
}


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _settle(rows: Rows) -> tuple:
    symbols, counts, illegal = rows.judge(rows.firsts())
    cost, audit = repair(symbols)
    whole = "\n".join(replay(audit, rows.roles, rows.texts))
    return (_gaps(*rows.span()), *counts, illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def _table(rows: list[tuple], id_type: pa.DataType, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[c.split() for c in schema.split(", ")])
    types = [id_type, *[_ARROW[k] for k in kinds]]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv_id", *names]
    )


def settle_blocks(damaged: DataFrame) -> DataFrame:
    """Results of conversations inside a block, and the fragments at its two ends."""
    kind = damaged.schema["conv_id"].dataType.simpleString()
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")]
    columns = 8

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, out, held, types = TaskContext.get().partitionId(), [], None, []

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types.append(batch.schema.field(0).type)
                yield batch

        def fragment(end: int) -> tuple:
            name, rows = held
            return (name, *[None] * columns, 2 * block + end, rows.turns, rows.roles, rows.texts)

        first = True
        for name, group in groupby(_rows(typed()), key=lambda row: row[0]):
            if held:
                out.append(fragment(0) if first else (held[0], *_settle(held[1]), *[None] * 4))
                first = False
            rows = Rows([], [], [])
            for _, turn, role, text, copies in group:
                rows.turns += [turn] * copies
                rows.roles += [role] * copies
                rows.texts += [text] * copies
            held = (name, rows)
            if len(out) >= 1000:
                yield _table(out, types[0], f"{RESULT}, {FRAGMENT}")
                out = []
        if held:
            out.append(fragment(0 if first else 1))
        if out:
            yield _table(out, types[0], f"{RESULT}, {FRAGMENT}")

    ranged = damaged.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.mapInArrow(run, f"conv_id {kind}, {RESULT}, {FRAGMENT}"), "conversation-blocks")


# --- conversations over block borders ----------------------------------------------------

_WAYS = "array<struct<entry: int, exit: int, cost: long, audit: string>>"
_SUMMARY = "blank long, duplicate long, truncated long, illegal long, low long, high long, different long, head string, tail string"


def _summaries(fragments: DataFrame) -> DataFrame:
    """Fragments without their rows: counts, span of turns, initials at both ends, and all ways through."""
    kind = fragments.schema["conv_id"].dataType.simpleString()
    rows = fragments.select("conv_id", "fragment", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"))
    firsts = (
        rows.groupBy("conv_id", "row.roles", F.sha2("row.texts", 256)).agg(F.min(F.struct("fragment", "place")).alias("first"))
        .groupBy(F.col("first.fragment").alias("fragment")).agg(F.collect_list("first.place").alias("firsts"))
    )
    joined = fragments.join(firsts, "fragment", "left").select("conv_id", "fragment", "turns", "roles", "texts", "firsts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, fragment, turns, roles, texts, firsts in _rows([batch]):
                rows = Rows(turns, roles, texts)
                symbols, counts, illegal = rows.judge(set(firsts or ()))
                initials = [r[:1] for r in roles]
                ends = (initials[0], initials[-1]) if initials else (None, None)
                ways = [dict(zip(("entry", "exit", "cost", "audit"), w)) for w in fragment_ways(symbols)]
                out.append([name, fragment, *counts, illegal, *rows.span(), *ends, ways])
            if out:
                names = ["conv_id", "fragment", *[c.split()[0] for c in _SUMMARY.split(", ")], "ways"]
                ways = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
                types = [batch.schema.field(0).type, *[pa.int64()] * 8, *[pa.string()] * 2, ways]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return joined.mapInArrow(run, f"conv_id {kind}, fragment long, {_SUMMARY}, ways {_WAYS}")


_CHOSEN = "array<struct<fragment: long, entry: int, audit: string>>"


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """One conversation from its fragments' summaries."""
    parts = group.sort_values("fragment").to_dict("records")
    cost, chosen = chain_fragments([[(w["entry"], w["exit"], w["cost"], w["audit"]) for w in p["ways"]] for p in parts])
    full = [p for p in parts if p["head"] is not None]
    illegal = sum(int(p["illegal"]) for p in parts)
    illegal += sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
    dated = [p for p in parts if not pd.isna(p["low"])]
    different = sum(int(p["different"]) for p in dated) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
    low, high = (int(dated[0]["low"]), int(dated[-1]["high"])) if dated else (None, None)
    counts = {c: sum(int(p[c]) for p in parts) for c in ("blank", "duplicate", "truncated")}
    plan = [
        {"fragment": int(p["fragment"]), "entry": entry, "audit": audit} for p, (entry, audit) in zip(parts, chosen)
    ]
    return pd.DataFrame([{
        "name": parts[0]["conv_id"], "whole": int(parts[0]["fragment"]), "gaps": _gaps(low, high, different), **counts,
        "illegal": illegal, "cost": cost, "audit": "".join(a for _, a in chosen), "plan": plan,
    }])


def _hashes(fragments: DataFrame, plan: DataFrame) -> DataFrame:
    """(whole, repaired_sha256): fragments repaired one by one, and their rows hashed in order as they stream by."""

    def rebuild(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole, fragment, entry, audit, roles, texts in _rows([batch]):
                rows = replay(audit, roles, texts, entry)
                yield pa.RecordBatch.from_arrays([
                    pa.array([whole] * len(rows), pa.int64()), pa.array([fragment] * len(rows), pa.int64()),
                    pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string()),
                ], names=["whole", "fragment", "place", "row"])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, group in groupby(_rows(batches), key=lambda row: row[0]):
            state, border = hashlib.sha256(), b""
            for _, _, _, row in group:
                state.update(border + row.encode())
                border = b"\n"
            yield pa.RecordBatch.from_arrays([pa.array([whole], pa.int64()), pa.array([state.hexdigest()])], names=["whole", "repaired_sha256"])

    lines = plan.join(fragments.select("fragment", "roles", "texts"), "fragment").select(
        "whole", "fragment", "entry", "audit", "roles", "texts"
    ).mapInArrow(rebuild, "whole long, fragment long, place long, row string")
    ordered = lines.repartition("whole").sortWithinPartitions("whole", "fragment", "place")
    return ordered.mapInArrow(digest, "whole long, repaired_sha256 string")


def settle_borders(fragments: DataFrame) -> DataFrame:
    """Results of the conversations that begin or end a block, from their fragments."""
    kind = fragments.schema["conv_id"].dataType.simpleString()
    numbers = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    chained = stage(
        _summaries(fragments).groupBy("conv_id").applyInPandas(
            _chain, f"name {kind}, whole long, {numbers}, audit string, plan {_CHOSEN}"
        ),
        "conversation-chains",
    )
    plan = chained.select("whole", F.explode("plan").alias("p")).select("whole", "p.*")
    hashed = chained.drop("plan").join(_hashes(fragments, plan), "whole", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return hashed.select(
        F.col("name").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def repair_conversations(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair's cost and audit, and the hash of what it makes."""
    blocks = settle_blocks(damage(conversations, id_col, turn_col, role_col, text_col))
    inside = blocks.where("fragment IS NULL").select("conv_id", *[c.split()[0] for c in RESULT.split(", ")])
    return inside.unionByName(settle_borders(blocks.where("fragment IS NOT NULL").select("conv_id", *[c.split()[0] for c in FRAGMENT.split(", ")])))
