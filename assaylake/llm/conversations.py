"""Conversation structure repair: cheapest edits to a legal order of roles, found on an automaton of shared suffixes.

A legal conversation has the role initials ``(s?(ua)+)?``. Turns are kept (0), given the role user or assistant (2), deleted
(3; a must for blank and repeated turns), or a turn with empty text is inserted (2); a truncated turn that stays adds 1. Among
edits of equal cost those whose initials D, I, K, R come first in ASCII order are taken.

1. Equal turns of a conversation are counted once, so that repeats are combined before they travel. The first turn of each
   (role, text) is found on digests alone; later ones are duplicates.
2. Turns are sorted by conversation and turn over all tasks, so one conversation may span many. Each task cuts its
   conversations into pieces of at most ``piece`` turns, with a signature of one letter for each turn (role, lower case; upper
   case if truncated; ``d`` if it must go).
3. Distinct signatures are sorted from their ends. A task that walks them in this order builds the automaton in which equal
   suffixes are one node: what a signature shares with the one before it is on the stack already. Each node gets, once for
   each state of the grammar, its cost to go and the head of its best audit suffix; the tail is shared with the node behind it.
4. Most conversations are one piece and end there. For those that span pieces, the walk gives a piece's least cost between
   any two states of the grammar; one pass backwards over a conversation's pieces then yields the cost to go behind each,
   the same walk (now with those costs at the end) the edits, and one pass forwards the state each piece begins in. Both
   passes hold one row at a time.

Nulls: a null role or text stands for one space, turns without a number come first, a null ``conv_id`` is a conversation of its
own. Turns with equal numbers are ordered by role and text. Empty and blank texts are blank turns; texts of any length are taken
whole; extra columns are ignored; an empty table gives no rows. Roles count by their first letter; letters other than s, u and a
fit nowhere.
"""

from __future__ import annotations

import hashlib
import sys
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 4096  # turns of a piece
PIECE_BYTES = 1 << 20  # and bytes of its texts, after which it ends
ROWS = 256  # rows of an Arrow batch that the passes write

# states of the grammar: 0 nothing yet, 1 behind a system turn, 2 behind a user turn, 3 behind an assistant turn
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLES = {"u": "user", "a": "assistant"}
GIVEN = ("u", "u", "a", "u")  # the role a turn is given or inserted with in each state
FAR = 1 << 60
END = (0, 4, 2, 0)  # cost to go behind the last turn, with the inserts that lead to a legal end
END_AUDIT = ("", "II", "I", "")
LEGAL = ("su", "ua", "au")  # initials that may follow each other


# ---- the automaton

@lru_cache(maxsize=1 << 16)
def step(after: tuple[int, ...], letter: str) -> tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]:
    """Cost to go, first edit and next state for each state, before a turn with the given letter."""
    must, late, role = letter == "d", int(letter.isupper()), letter.lower()
    best = []
    for state, moves in enumerate(MOVES):
        ways = [(3 + after[state], "D", state)]
        if not must:
            given = moves[GIVEN[state]]
            ways.append((2 + late + after[given], "R", given))
            if role in moves:
                ways.append((late + after[moves[role]], "K", moves[role]))
        best.append(min(ways))
    # inserts lead from one state to another before the same turn; two in a row back to a state never pay
    user, assistant = best[2], best[3]
    best[2] = min(user, (2 + assistant[0], "I", 3))
    best[3] = min(assistant, (2 + user[0], "I", 2))
    best[0] = min(best[0], (2 + best[2][0], "I", 2))
    best[1] = min(best[1], (2 + best[2][0], "I", 2))
    return tuple(min(b[0], FAR) for b in best), tuple(b[1] for b in best), tuple(b[2] for b in best)


class Node:
    """A suffix: its cost to go and best audit suffix for each state of the grammar; tails are shared with the node behind."""

    __slots__ = ("costs", "audits")

    def __init__(self, costs, audits):
        self.costs = costs
        self.audits = audits  # (edit, rest) cells; the last cell's rest is the state the piece ends in


def end_node(costs: tuple[int, ...]) -> Node:
    return Node(costs, (0, 1, 2, 3))


def node_before(node: Node, letter: str) -> Node:
    costs, edits, states = step(node.costs, letter)
    audits: list = [None] * 4
    # an insert stays in front of the same turn: its tail is this node's own cell for the state it leads to
    for state in sorted(range(4), key=lambda s: (edits[s] == "I", s < 2)):
        audits[state] = (edits[state], audits[states[state]] if edits[state] == "I" else node.audits[states[state]])
    return Node(costs, tuple(audits))


def read_out(node: Node, state: int) -> tuple[str, int]:
    """The audit suffix from a state, and the state it ends in."""
    edits, cell = [], node.audits[state]
    while not isinstance(cell, int):
        edits.append(cell[0])
        cell = cell[1]
    return "".join(edits), cell


def walked(words: DataFrame, name: str, starts: tuple[int, ...] = ()) -> DataFrame:
    """(end, signature, costs, audits, ends) for distinct (end, signature): ``end`` holds the cost to go behind it.

    ``audits`` and ``ends`` hold the edits from each of ``starts`` and the state they lead to.
    """
    def run(batches):
        stack: list[Node] = []
        path = ""
        end = None
        for batch in batches:
            out = [[], [], []]
            ends, signatures = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for costs, signature in zip(ends, signatures):
                word = signature[::-1]
                if costs != end:
                    end, path, stack = costs, "", [end_node(tuple(costs))]
                shared = 0
                for x, y in zip(word, path):
                    if x != y:
                        break
                    shared += 1
                del stack[shared + 1:]
                for letter in word[shared:]:
                    stack.append(node_before(stack[-1], letter))
                path = word
                read = [read_out(stack[-1], s) for s in starts]
                for column, value in zip(out, (list(stack[-1].costs), [r[0] for r in read], [r[1] for r in read])):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out[0], pa.list_(pa.int64())),
                 pa.array(out[1], pa.list_(pa.string())), pa.array(out[2], pa.list_(pa.int32()))],
                ["end", "signature", "costs", "audits", "ends"])

    once = stored(words.select("end", "signature").distinct(), f"{name}-words")
    back = F.reverse("signature")
    ordered = once.repartitionByRange("end", back).sortWithinPartitions("end", back)
    return stored(ordered.mapInArrow(run, "end array<long>, signature string, costs array<long>, audits array<string>, ends array<int>"), name)


# ---- turns and pieces

def marked(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n, repeated): distinct turns with their count, and whether an earlier turn has role and text."""
    blank = F.lit(" ")
    own = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                       F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    own = own.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    own = stored(own.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    again = own.groupBy("conv_id", "digest").agg(F.count("*").alias("times"), F.min(place).alias("place")).where("times > 1")
    again = again.select(F.col("conv_id").alias("of"), F.col("digest").alias("as"), F.col("place.turn").alias("first"))
    return own.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("as")), "left").select(
        "conv_id", "turn", "role", "text", "n", (F.col("as").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))).alias("repeated"))


class Piece:
    """Turns of one conversation that follow each other, as they are gathered."""

    def __init__(self, conv, number: int, begins: bool):
        self.conv, self.number, self.begins, self.bytes = conv, number, begins, 0
        self.letters: list[str] = []
        self.initials: list[str] = []
        self.turns: list[dict] = []
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.seen: list = []  # distinct turn numbers

    def add(self, turn, role: str, text: str, fault: str) -> None:
        self.initials.append(role[:1])
        if fault and fault in "bd":
            self.letters.append("d")
        else:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            self.letters.append(letter.upper() if fault == "t" else letter)
            self.turns.append({"role": role, "text": text})
            self.bytes += len(text)
        if fault:
            self.faults[fault] += 1
        if turn is not None and (not self.seen or self.seen[-1] != turn):
            self.seen.append(turn)

    def row(self, part: int, ends: bool):
        pairs = zip(self.initials, self.initials[1:])
        seen = self.seen
        return (self.conv, part, self.number, self.begins and ends, self.faults["b"], self.faults["d"], self.faults["t"],
                sum(a + b not in LEGAL for a, b in pairs), self.initials[0], self.initials[-1],
                seen[0] if seen else None, seen[-1] if seen else None, len(seen), "".join(self.letters), self.turns)


COUNTS = ("conv_id", "part", "number", "whole", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct")
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def fault_of(text: str, repeated: bool) -> str:
    """The first fault: blank, duplicate or truncated, by its initial."""
    bare = text.rstrip(" \t\n\x0b\x0c\r")
    if not bare:
        return "b"
    return "d" if repeated else "" if bare[-1] in ".!?" else "t"


def pieces(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row for each piece of a conversation: counts, signature and the turns that may stay."""
    conv, turn = turns.schema["conv_id"].dataType, turns.schema["turn"].dataType
    kinds = (f"conv_id {conv.simpleString()}, part int, number int, whole boolean, blank long, duplicate long, truncated long, illegal long, "
             f"first_initial string, last_initial string, low {turn.simpleString()}, high {turn.simpleString()}, distinct long, "
             "signature string, turns array<struct<role:string,text:string>>")
    known = stored(marked(turns), "marked")
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    names = [*COUNTS[:8], "first_initial", "last_initial", *COUNTS[8:], "signature", "turns"]

    def run(batches):
        part = TaskContext.get().partitionId()
        types: pa.Schema | None = None
        out: list[tuple] = []
        held: Piece | None = None

        def batch_of(rows):
            columns = list(zip(*rows))
            conv, turn = types.field(0).type, types.field(1).type
            fixed = [conv, pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.string(), turn, turn, pa.int64(), pa.string(), TURNS]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fixed)], names)

        number = size = 0
        for batch in batches:
            types = batch.schema
            for at in range(0, batch.num_rows, ROWS):
                for conv, turn, role, text, n, repeated in zip(*[c.to_pylist() for c in batch.slice(at, ROWS).columns]):
                    for copy in range(n):
                        other = held is None or _changes(conv, held.conv)
                        if other or len(held.letters) >= piece or held.bytes >= PIECE_BYTES:
                            if held is not None:
                                out.append(held.row(part, other))
                                number += 1
                                size += held.bytes
                            # the first conversation of a task may have begun in the one before
                            held = Piece(conv, number, other and number > 0)
                        held.add(turn, role, text, fault_of(text, repeated or copy > 0))
                        if len(out) >= ROWS or size >= 4 * PIECE_BYTES:
                            yield batch_of(out)
                            out, size = [], 0
        if held is not None:
            out.append(held.row(part, False))
        if out:
            yield batch_of(out)

    return stored(known.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, kinds), "pieces")


# ---- conversations that span pieces

def _changes(conv, before) -> bool:
    return conv != before or (conv is None) != (before is None)


def _passed(spans: DataFrame, backwards: bool, columns: str, begin, advance) -> DataFrame:
    """(part, number, ...): one pass over each conversation's pieces, holding one row at a time.

    ``begin()`` gives the state before a conversation, ``advance(state, row)`` the values of a row and the next state.
    """
    width = len(columns.split(", "))

    def run(batches):
        before, state, first = None, None, True
        for batch in batches:
            out = [[] for _ in range(width)]
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if first or _changes(conv, before):
                    before, state, first = conv, begin(), False
                values, state = advance(state, row[2:])
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *map(pa.array, out)],
                                             ["part", "number", *(c.split(" ")[0] for c in columns.split(", "))])

    order = [F.desc("part"), F.desc("number")] if backwards else ["part", "number"]
    ordered = spans.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *order)
    return stored(ordered.mapInArrow(run, f"part int, number int, {columns}"), "passed")


def _behind(spans: DataFrame) -> DataFrame:
    """(part, number, end, closing): the cost to go behind each piece."""
    units = [tuple(0 if s == t else FAR for s in range(4)) for t in range(4)]
    least = walked(spans.select("signature").distinct().select("signature", F.explode(F.array(*map(_costs, units))).alias("end")), "least")
    to = F.array_position("end", F.lit(0).cast("long"))
    least = least.groupBy("signature").agg(F.array_sort(F.collect_list(F.struct(to.alias("to"), "costs"))).alias("least"))

    def back(state, row):
        costs, closing = state
        ahead = tuple(min(row[0][t]["costs"][s] + costs[t] for t in range(4)) for s in range(4))
        return (list(costs), closing), (ahead, False)

    joined = spans.select("conv_id", "part", "number", "signature").join(least, "signature").select("conv_id", "part", "number", "least")
    return _passed(joined, True, "end array<long>, closing boolean", lambda: (END, True), back)


def _before(spans: DataFrame) -> DataFrame:
    """(part, number, start, opening, seam, again): the state each piece begins in.

    ``seam`` is 1 where the turn before and the piece's first turn are an illegal pair, ``again`` where they share a number.
    """
    def forth(held, row):
        state, last, high, opening = held
        ends, opens, closes, low, top = row
        values = (state, opening, int(not opening and last + opens not in LEGAL), int(low is not None and low == high))
        return values, (ends[state], closes, high if top is None else top, False)

    columns = ("conv_id", "part", "number", "ends", "first_initial", "last_initial", "low", "high")
    return _passed(spans.select(*columns), False, "start long, opening boolean, seam long, again long", lambda: (0, "", None, True), forth)


def _costs(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _edited(rows: DataFrame) -> DataFrame:
    """``rows`` with the audit of a last piece completed and ``repaired``, the turns after the edits."""
    names = [c for c in rows.columns if c not in ("signature", "start", "stop", "closing", "turns", "audit")]
    needed = [*names, "signature", "start", "stop", "closing", "turns", "audit"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                audits, left = [], []
                for signature, state, stop, closing, turns, audit in zip(*[c.to_pylist() for c in batch.columns[len(names):]]):
                    audit += END_AUDIT[stop] if closing else ""
                    letters, own, kept = iter(signature), iter(turns), []
                    for edit in audit:
                        given = GIVEN[state]
                        if edit == "I":
                            kept.append({"role": ROLES[given], "text": ""})
                            state = MOVES[state][given]
                            continue
                        turn = None if next(letters) == "d" else next(own)
                        if edit == "K":
                            kept.append(turn)
                            state = MOVES[state][turn["role"][:1]]
                        elif edit == "R":
                            kept.append({"role": ROLES[given], "text": turn["text"]})
                            state = MOVES[state][given]
                    audits.append(audit)
                    left.append(kept)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(names)], pa.array(audits, pa.string()), pa.array(left, TURNS)], [*names, "audit", "repaired"])

    return rows.select(*needed).mapInArrow(run, f"{kinds}, audit string, repaired array<struct<role:string,text:string>>")


def repaired(turns: DataFrame, *, piece: int = PIECE) -> DataFrame:
    """Repaired pieces of conversations; the pieces of one conversation are in order of (part, number).

    Columns: those of ``COUNTS``; ``opening``, and ``cost``, that of the conversation, on its first piece; ``seam`` and ``again``, what
    ``illegal`` counts more and ``distinct`` less at the place where a piece meets the one before; ``audit``, the edits; ``repaired``, the
    turns that are left. ``turns`` has conv_id, turn, role and text.
    """
    rows = pieces(turns, piece)
    whole = rows.where("whole").withColumn("end", _costs(END))
    nodes = walked(whole.select("end", "signature"), "nodes", (0,))
    nothing = F.lit(0).cast("long")
    whole = whole.join(nodes, ["end", "signature"]).select(
        *COUNTS, "signature", "turns", F.lit(True).alias("opening"), F.lit(True).alias("closing"), nothing.alias("start"), nothing.alias("seam"),
        nothing.alias("again"), F.element_at("audits", 1).alias("audit"), F.element_at("ends", 1).alias("stop"), F.element_at("costs", 1).alias("cost"))
    spans = rows.where("not whole")
    # only the differences between the costs behind a piece matter, so that pieces of long conversations share nodes
    level = F.array_min("end")
    spans = spans.join(_behind(spans), ["part", "number"]).withColumn("level", level).withColumn("end", F.transform("end", lambda c: c - level))
    inner = walked(spans.select("end", "signature"), "inner-nodes", (0, 1, 2, 3))
    spans = stored(spans.join(inner, ["end", "signature"]), "spans")
    spans = spans.join(_before(spans), ["part", "number"])
    start = (F.col("start") + 1).cast("int")
    spans = spans.select(
        *COUNTS, "signature", "turns", "opening", "closing", "start", "seam", "again", F.element_at("audits", start).alias("audit"),
        F.element_at("ends", start).alias("stop"), F.when(F.col("opening"), F.element_at("costs", start) + F.col("level")).alias("cost"))
    return stored(_edited(whole.unionByName(spans)), "repaired")


def _digests(rows: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of conversations that span pieces.

    A digest reads its conversation in order, so each goes through one task, a piece at a time.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        before, digest, audit, begun, lines = None, None, [], False, False
        kind = None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([before], kind), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
                                              ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, ROWS):
                for conv_id, edits, turns in zip(*[batch.column(i).slice(at, ROWS).to_pylist() for i in (0, 3, 4)]):
                    if not begun or _changes(conv_id, before):
                        if begun:
                            yield row()
                        before, digest, audit, begun, lines = conv_id, hashlib.sha256(), [], True, False
                    audit.append(edits)
                    for t in turns:
                        digest.update(f"{chr(10) if lines else ''}{t['role']}:{t['text']}".encode())
                        lines = True
        if begun:
            yield row()

    ordered = rows.select("conv_id", "part", "number", "audit", "repaired").repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "part", "number")
    return ordered.mapInArrow(run, f"conv_id {conv}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_audit(conversations: DataFrame, *, piece: int = PIECE) -> DataFrame:
    """One row for every ``conv_id``: gaps, faults, cost and audit of the repair of its damaged turns, and a digest of what is left."""
    rows = repaired(damaged(conversations), piece=piece)
    counts = rows.groupBy("conv_id").agg(
        (F.max("high") - F.min("low") + 1 - F.sum(F.col("distinct") - F.col("again"))).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("seam")).alias("illegal"), F.max("cost").alias("cost"))
    whole = rows.where("whole").select("conv_id", "audit", F.sha2(F.concat_ws("\n", F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))), 256).alias("repaired_sha256"))
    texts = stored(whole.unionByName(_digests(rows.where("not whole"))), "digests")
    every = conversations.select("conv_id").distinct()
    for part in (counts, texts):
        part = part.withColumnRenamed("conv_id", "_conv")
        every = every.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
