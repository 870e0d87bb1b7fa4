"""Repair of conversation structure: cheapest edits that give ``(system? (user assistant)+)?``, with an audit.

Each conversation runs through a dynamic programme over its rows and the four states of the wanted pattern. What is kept per state is its
cost, a running digest of the repaired text, and its audit: the edits' initials so far, as a linked node that shares its prefix with the
audits of other states. A node knows its ancestors at powers of two and a rolling hash, so that two audits of equal cost compare by a
search for their longest common prefix; where the hashes say that two prefixes are equal, they must be the same node or are compared letter
by letter. Every ``WINDOW`` rows the audits are written down as strings, with their order, and nodes start anew: a conversation of any
length takes a bounded number of nodes, and a byte per edit and live audit.

Faults are found by Spark: repeated texts by a window over (conversation, role, text), the rest by column functions. One shuffle by
conversation serves the window and the programme; a conversation is read as a sorted stream, its texts are never held together. One
conversation is one task, as every edit depends on the rows before; its rows spill while they are sorted.

Rows are taken by turn (null first), rows of the same turn by role and text. A null role or text is one space. A null conversation is a
conversation of its own. An empty table gives no rows; other columns are ignored. Texts of any length pass through. The initial of a role is
its first character, nothing for an empty role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_stream

START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NAMES = {"u": "user", "a": "assistant"}
ALTERNATING = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows after which audits are written down and nodes start anew.
WINDOW = 16_384
#: White space and its complement, as the blank and truncated faults see it.
BLANKS = " \t\n\x0b\x0c\r"
MODULUS, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E6

SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class Node:
    """An audit as its last edit and the audit before; ``up[j]`` is the ancestor 2^j edits back."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None = None, letter: str = ""):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % MODULUS
        up = [parent]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])
        self.up = tuple(up)

    def lifted(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            step = min((node.depth - depth).bit_length(), len(node.up)) - 1
            node = node.up[step]
        return node


def letters(node: Node) -> str:
    """Edits up to ``node``."""
    out = []
    while node.up:
        out.append(node.letter)
        node = node.up[0]
    return "".join(reversed(out))


def split(a: Node, b: Node) -> tuple[Node, Node] | None:
    """First nodes in which two audits of the same depth differ, by longest common prefix; None if they agree throughout."""
    if a is b:
        return None
    if a.hash == b.hash:
        return _split_slowly(a, b)
    while a.up[0] is not b.up[0] and a.up[0].hash != b.up[0].hash:
        step = 0
        for j in range(len(a.up) - 1, -1, -1):
            if a.up[j].hash != b.up[j].hash:
                step = j
                break
        a, b = a.up[step], b.up[step]
    if a.up[0] is not b.up[0]:  # equal by hash only: verify
        earlier = _split_slowly(a.up[0], b.up[0])
        if earlier is not None:
            return earlier
    return a, b


def _split_slowly(a: Node, b: Node) -> tuple[Node, Node] | None:
    found = None
    while a is not b:
        if a.letter != b.letter:
            found = a, b
        a, b = a.up[0], b.up[0]
    return found


def smaller(a: Node, b: Node) -> bool:
    """Whether audit ``a`` comes before audit ``b``; a prefix comes before what it begins."""
    depth = min(a.depth, b.depth)
    places = split(a.lifted(depth), b.lifted(depth))
    if places is None:
        return a.depth < b.depth
    return places[0].letter < places[1].letter


class Trunk:
    """The written part of an audit: letters after those of an earlier trunk, and its place among the audits written at the same time.

    Audits are written right after a row. Two different ones then differ in an edit that both have, so their order stays for good.
    """

    __slots__ = ("before", "letters", "rank")

    def __init__(self, before: Trunk | None = None, written: str = "", rank: int = 0):
        self.before, self.letters, self.rank = before, written, rank

    def text(self) -> str:
        parts, trunk = [], self
        while trunk is not None:
            parts.append(trunk.letters)
            trunk = trunk.before
        return "".join(reversed(parts))


class State:
    """Cheapest way into a state of the pattern."""

    __slots__ = ("cost", "trunk", "node", "digest", "lines")

    def __init__(self, cost: int, trunk: Trunk, node: Node, digest, lines: bool):
        self.cost, self.trunk, self.node, self.digest, self.lines = cost, trunk, node, digest, lines

    def then(self, letter: str, cost: int, role: str | None = None, text: str = "") -> State:
        digest, lines = self.digest, self.lines
        if role is not None:
            digest = digest.copy()
            digest.update(("\n" * lines + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            lines = True
        return State(self.cost + cost, self.trunk, Node(self.node, letter), digest, lines)

    def before(self, other: State) -> bool:
        """Order of the audits."""
        return smaller(self.node, other.node) if self.trunk is other.trunk else self.trunk.rank < other.trunk.rank

    def better(self, other: State | None) -> bool:
        return other is None or self.cost < other.cost or (self.cost == other.cost and self.before(other))


class Repair:
    """One conversation, row by row."""

    def __init__(self) -> None:
        self.states: dict[int, State] = {START: State(0, Trunk(), Node(), hashlib.sha256(), False)}
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.before: str | None = None

    def _inserted(self) -> None:
        """Every insertion that pays, in the gap where the programme stands."""
        waiting = list(self.states)
        while waiting:
            at = waiting.pop()
            for initial, role in NAMES.items():
                to = WANTED.get((at, initial))
                if to is not None:
                    way = self.states[at]
                    if (old := self.states.get(to)) is None or way.cost + INSERT <= old.cost:
                        new = way.then("I", INSERT, role)
                        if new.better(old):
                            self.states[to] = new
                            waiting.append(to)

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn or self.turns == 0
            self.last_turn = turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ALTERNATING
        self.before = initial
        self._inserted()
        reached: dict[int, State] = {}
        more = TRUNCATED if fault == "truncated" else 0
        for at, way in self.states.items():
            ways = [(at, way.then("D", DELETE))]
            if fault not in ("blank", "duplicate"):
                if (to := WANTED.get((at, initial))) is not None:
                    ways.append((to, way.then("K", KEEP + more, role, text)))
                for other, name in NAMES.items():
                    if other != initial and (to := WANTED.get((at, other))) is not None:
                        ways.append((to, way.then("R", REROLE + more, name, text)))
            for to, new in ways:
                if new.better(reached.get(to)):
                    reached[to] = new
        self.states = reached
        self.rows += 1
        if self.rows % WINDOW == 0:
            self._settle()

    def _settle(self) -> None:
        """Write the audits down in order and let go of their nodes."""
        ordered = sorted(self.states.values(), key=cmp_to_key(lambda a, b: -1 if a.before(b) else 1))
        for rank, way in enumerate(ordered):
            way.trunk, way.node = Trunk(way.trunk, letters(way.node), rank), Node()

    def row(self, conv_id: int | None) -> tuple:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.first_turn is not None else 0
        self._inserted()
        best = None
        for at in (START, ASSISTANT):
            if (way := self.states.get(at)) is not None and way.better(best):
                best = way
        audit = best.trunk.text() + letters(best.node)
        return conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost, audit, best.digest.hexdigest()


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (f.split() for f in SCHEMA.split(", "))])

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    now, repair, done, size = None, None, [], 0
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "fault", "dropped")]
        for conv_id, turn, role, text, fault, dropped in zip(*columns, strict=True):
            if repair is None or conv_id != now:
                if repair is not None:
                    done.append(repair.row(now))
                    size += len(done[-1][7]) + 200
                now, repair = conv_id, Repair()
            if not dropped:
                repair.add(turn, role, text, fault)
            if size > 1 << 20:
                yield emit(done)
                done, size = [], 0
    if repair is not None:
        done.append(repair.row(now))
    if done:
        yield emit(done)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that a checksum of ``conv_id:turn`` deals: dropped (marked), emptied, stripped of ends, repeated, or user's."""
    spaced = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    dealt = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("was_role"),
        text.alias("was_text"),
        dealt.alias("dealt"),
    )
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate("was_text", ".!?", "")).otherwise(F.col("was_text"))
    rows = rows.withColumn("role", F.when(F.col("dealt") == 4, "user").otherwise(F.col("was_role"))).withColumn("text", text)
    copies = F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("dropped", F.col("dealt") == 0).withColumn("copy", F.explode(copies)).drop("dealt")


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of the cheapest repair, and a digest of the repaired rows.

    ``rows`` are ``conv_id, turn, role, text``; rows marked ``dropped`` only name their conversation. ``was_role``, ``was_text`` and ``copy``
    order rows of the same turn where given.
    """
    order = [F.asc_nulls_first("turn")]
    order += [F.asc(name) for name in ("was_role", "was_text", "copy") if name in rows.columns]
    order += [F.asc("role"), F.asc("text")]
    if "dropped" not in rows.columns:
        rows = rows.withColumn("dropped", F.lit(False))
    rows = rows.withColumns({name: F.coalesce(name, F.lit(" ")) for name in ("role", "text")})
    seen = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(*order)
    end = F.rtrim("text", F.lit(BLANKS))
    numbered = rows.repartition("conv_id").withColumn("nth", F.row_number().over(seen))
    fault = F.when(end == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")
    sorted_rows = numbered.withColumn("fault", fault).sortWithinPartitions("conv_id", *order)
    return arrow_stream(sorted_rows.select("conv_id", "turn", "role", "text", "fault", "dropped"), _repair, SCHEMA)
