"""Conversation repair against a search over all edits, with pieces of every size."""

import functools
import hashlib
import random
import sys
import zlib

import pytest

from assaylake.llm import conversations
from assaylake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, part int, audit string, digest string"
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) of (role, fault, text) rows, trying every edit; at most two inserts before a row can pay."""
    @functools.cache
    def best(i, state, inserts):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 2:
            for given, role in (("u", "user"), ("a", "assistant")):
                if given in NEXT[state]:
                    cost, audit, kept = best(i, given, inserts + 1)
                    ways.append((2 + cost, "I" + audit, ((role, ""), *kept)))
        if i < len(rows):
            role, fault, text = rows[i]
            cost, audit, kept = best(i + 1, state, 0)
            ways.append((3 + cost, "D" + audit, kept))
            if fault not in ("blank", "duplicate"):
                late = int(fault == "truncated")
                if role[:1] in NEXT[state]:
                    cost, audit, kept = best(i + 1, NEXT[state][role[:1]], 0)
                    ways.append((late + cost, "K" + audit, ((role, text), *kept)))
                for given, name in (("u", "user"), ("a", "assistant")):
                    if given in NEXT[state]:
                        cost, audit, kept = best(i + 1, given, 0)
                        ways.append((2 + late + cost, "R" + audit, ((name, text), *kept)))
        return min(ways, default=(10 ** 6, "~", ()))

    return best(0, "", 0)


def truth(rows):
    out = []
    kept_rows = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in kept_rows if r[0] == conv and (r[0] is None) == (conv is None)),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        if not own:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
            continue
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = cheapest([(r[1], f, r[2]) for r, f in zip(own, faults)])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def made_up(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(0, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, turn - 1, None]) if rng.random() < 0.5 else turn * rng.choice([1, 1, 2]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "no", "  ", "", None, "What?", "so on. ", "end\u00a0", f"text {turn}.", f"open {turn}"])))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def got(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("seed, piece", [(1, 4096), (2, 1), (3, 3)])
def test_repair(spark, seed, piece):
    rows = made_up(seed, 60, 14)
    rows += [(None, t, r, x) for t, (r, x) in enumerate([("user", "a."), ("user", "b"), (None, "c."), ("assistant", "a.")])]
    rows += [(None, None, "user", "again."), (None, None, "user", "again."), (None, None, None, None)]
    assert got(conversations.repair_audit(table(spark, rows), piece=piece)) == truth(rows)


def test_one_long_conversation_spans_tasks(spark):
    sys.setrecursionlimit(20_000)
    rng = random.Random(7)
    rows = [(5, t, rng.choice(["user", "assistant"]), f"turn {t % 230}{rng.choice(['.', '.', ''])}") for t in range(400)]
    rows += [(6, 3, "user", "same.")] * 300 + [(7, None, "assistant", "Long " * 30_000 + ".")]
    spans = conversations.pieces(conversations.damaged(table(spark, rows)), 50)
    assert spans.where("conv_id = 5").selectExpr("count(*) n", "max(length(signature)) m").first()["m"] <= 50
    expected = truth(rows)
    assert got(conversations.repair_audit(table(spark, rows), piece=50)) == expected
    assert got(conversations.repair_audit(table(spark, rows))) == expected


def test_suffixes_are_nodes_once():
    end = conversations.end_node(conversations.END)
    tail = conversations.node_before(end, "a")
    one, other = conversations.node_before(tail, "u"), conversations.node_before(tail, "U")
    assert one.audits[0][1] is tail.audits[2] and other.audits[0][1] is tail.audits[2]
    assert conversations.read_out(one, 0) == ("KK", 3) and one.costs[0] == 0 and other.costs[0] == 1


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_conversation_repair"](spark, sf)) == truth(rows)


def test_empty_table_and_all_dropped(spark):
    assert conversations.repair_audit(table(spark, [])).count() == 0
    gone = [(c, 1, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    assert got(conversations.repair_audit(table(spark, gone))) == truth(gone)
