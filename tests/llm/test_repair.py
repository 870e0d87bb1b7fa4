import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import pytest

from feedback_lens.llm import oracles, repair
from feedback_lens.llm.queries import op13_conversation_repair

SF = "/root/testdata/sf0.001"
WANTED = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """All edit sequences with at most one insertion in a gap."""
    best = None
    marks = faults(rows)
    choices = []
    for (role, text), fault in zip(rows, marks, strict=True):
        ways = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            ways += [("K", more, (role, text)), ("R", 1 + more, ("user", text)), ("R", 1 + more, ("assistant", text))]
        choices.append(ways)
    gap = [None, ("I", 5, ("user", "")), ("I", 5, ("assistant", ""))]
    for ways in itertools.product(*choices):
        for gaps in itertools.product(gap, repeat=len(rows) + 1):
            edits = [e for pair in zip(gaps, [*ways, None], strict=True) for e in pair if e]
            lines = [line for _, _, line in edits if line]
            if WANTED.fullmatch("".join(role[:1] or "-" for role, _ in lines)):
                found = sum(c for _, c, _ in edits), "".join(a for a, _, _ in edits), lines
                if best is None or found[:2] < best[:2]:
                    best = found
    return best


def digest(lines):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def run(rows):
    machine = repair.Repair()
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        machine.add(0, role, text, fault)
    return machine.row(1)[6:]


def test_against_all_edit_sequences():
    rng = random.Random(3)
    for _ in range(250):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b!", "c", "", "d?", "e. "])) for _ in range(rng.randrange(5))]
        cost, audit, lines = brute(rows)
        assert run(rows) == (cost, audit, digest(lines)), rows


def plain(rows):
    """The programme with audits as strings."""
    states = {0: (0, "", [])}

    def inserted(states):
        out = dict(states)
        for at, (cost, audit, lines) in states.items():
            name = "assistant" if at == 2 else "user"
            to = 3 if at == 2 else 2
            new = (cost + 5, audit + "I", [*lines, (name, "")])
            out[to] = min(out.get(to, new), new, key=lambda s: s[:2])
        return out

    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        after = {}
        for at, (cost, audit, lines) in inserted(states).items():
            ways = [(at, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (at, role[:1]) in step:
                    ways.append((step[at, role[:1]], (cost + more, audit + "K", [*lines, (role, text)])))
                for other in ("user", "assistant"):
                    if other[0] != role[:1] and (at, other[0]) in step:
                        ways.append((step[at, other[0]], (cost + more + 1, audit + "R", [*lines, (other, text)])))
            for to, new in ways:
                after[to] = min(after.get(to, new), new, key=lambda s: s[:2])
        states = after
    last = inserted(states)
    return min((last[s] for s in (0, 3) if s in last), key=lambda s: s[:2])


@pytest.mark.parametrize("base", [repair.BASE, 0])
def test_long_conversations_whatever_the_window(monkeypatch, base):
    """With base 0 a hash only knows the last edit, so that nearly all prefixes collide and have to be verified."""
    monkeypatch.setattr(repair, "BASE", base)
    rng = random.Random(9)
    for window in (1, 3, 17, 4096):
        monkeypatch.setattr(repair, "WINDOW", window)
        for _ in range(12):
            rows = [(rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"{i}.", f"{i}", "", "x!", f"{i} ?"])) for i in range(150)]
            cost, audit, lines = plain(rows)
            assert run(rows) == (cost, audit, digest(lines))


def test_nodes_are_let_go(monkeypatch):
    monkeypatch.setattr(repair, "WINDOW", 64)
    machine = repair.Repair()
    for i in range(20_000):
        machine.add(i, "user" if i % 3 else "assistant", f"{i}.", None)
    assert max(way.node.depth for way in machine.states.values()) < 200
    assert all(len(t) < 200 for way in machine.states.values() for t in [way.trunk.letters, way.trunk.before.letters])
    assert len(machine.row(1)[7]) >= 20_000


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    rows = con.execute(oracles.CONVERSATION_REPAIR)
    names = [d[0] for d in rows.description]
    df = op13_conversation_repair(spark, SF)
    assert df.columns == names
    assert sorted(map(tuple, df.collect())) == sorted(rows.fetchall())


def hostile():
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice(["Yes.", "no", " \t", None, "Why?", "Étê!\n", ""]))
            for c in [1, 2, 3, None, 5, 6] for t in [0, 1, 1, 2, None, 7]]
    return rows + [(9, 3, "user", "long " * 50_000 + "."), (9, 4, "assistant", "ok."), (9, 4, "assistant", "ok.")]


def test_nulls_ties_and_repeated_rows_against_sql(spark):
    rows = hostile()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS fault", "1 AS copy", "'y' AS was_role")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = sorted(con.execute(oracles.CONVERSATION_REPAIR).fetchall(), key=repr)
    got = repair.repaired(repair.damaged(df)).collect()
    assert sorted(map(tuple, got), key=repr) == expected


def test_dropped_conversations_and_empty_tables(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"4:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(4, turn, "user", "Gone.")], SCHEMA)
    row = repair.repaired(repair.damaged(df)).collect()
    assert [tuple(r) for r in row] == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repaired(repair.damaged(df.limit(0))).collect() == []


def test_rows_as_they_are(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes"), (1, 3, "user", "Go!")]
    got = repair.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    cost, audit, lines = brute([r[2:] for r in rows])
    assert [tuple(r) for r in got] == [(1, 0, 0, 1, 1, 1, cost, audit, digest(lines))]
