r"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation, read by a deterministic scanner from left to right:

    conversation = turn*
    turn         = "[INST:" role "]" text "[/INST]"
    role, text   = (plain character | escape "\" + any character)*

Control strings are ``[INST``, ``[/INST]``, ``<s>``, ``</s>``, ``<<SYS>>``, ``<</SYS>>`` and the escape itself. A turn is rendered
without escapes first and read back; while what comes back differs from the source, control strings inside the content get an escape in
front, until both are identical. Every turn is self-contained, so turns of one conversation are rendered apart and a conversation is their concatenation.

Turns go by ``turn``; ties by role, then text, nulls first. A null text or role is empty, a null conversation id or turn is a value of its
own. Repeated rows are repeated turns. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_map, arrow_stream

ESCAPE = "\\"
OPEN, SHUT, CLOSE = "[INST:", "]", "[/INST]"
#: Strings that must not stand unescaped in content: the grammar's own and those of common chat templates (fixed values).
CONTROLS = ("[INST", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", ESCAPE)
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
LOSS_ROLE = "assistant"


class Malformed(ValueError):
    """The text does not follow the grammar; ``at`` is the place."""

    def __init__(self, at: int) -> None:
        super().__init__(f"no turn of the grammar at {at}")
        self.at = at


def _content(text: str, at: int, end: str) -> tuple[str, int, list[tuple[int, int]]]:
    """Content up to ``end``: unescaped, place behind the end, and spans of ``text`` that hold it (escapes left out)."""
    spans, start = [], at
    stop = re.compile("|".join(map(re.escape, (end, *CONTROLS))))
    while True:
        hit = stop.search(text, at)
        if hit is None:
            raise Malformed(len(text))
        if hit[0] == ESCAPE:
            if hit.end() >= len(text):
                raise Malformed(hit.start())
            spans.append((start, hit.start()))
            start, at = hit.end(), hit.end() + 1
        elif text.startswith(end, hit.start()):
            spans.append((start, hit.start()))
            return "".join(text[a:b] for a, b in spans), hit.start() + len(end), [s for s in spans if s[0] < s[1]]
        else:
            raise Malformed(hit.start())


def parse(text: str) -> list[tuple[str, str, list[tuple[int, int]]]]:
    """Turns of a formatted text: role, text, and the spans of the formatted text that hold the turn's text."""
    at, turns = 0, []
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise Malformed(at)
        role, at, _ = _content(text, at + len(OPEN), SHUT)
        body, at, spans = _content(text, at, CLOSE)
        turns.append((role, body, spans))
    return turns


def _escaped(text: str, marks: set[int]) -> str:
    cuts = sorted(marks)
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
    return ESCAPE.join(parts)


def render_turn(role: str, text: str) -> str:
    """One turn whose parse gives back role and text, with as few escapes as the grammar needs."""
    role_marks: set[int] = set()
    marks: set[int] = set()
    while True:
        head = OPEN + _escaped(role, role_marks) + SHUT
        whole = head + _escaped(text, marks) + CLOSE
        try:
            turns = parse(whole)
        except Malformed:
            turns = []
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return whole
        # All conflicts of one side are found in one sweep, so the loop ends after a few rounds even for texts full of them.
        new_role = {m.start() for m in re.finditer(f"{_CONTROL.pattern}|{re.escape(SHUT)}", role)} - role_marks
        new = {m.start() for m in _CONTROL.finditer(text)} - marks
        if not new_role and not new:  # an end that content and closing mark form together
            new_role, new = set(range(len(role))) - role_marks, set(range(len(text))) - marks
            if not new_role and not new:
                raise Malformed(0)
        role_marks, marks = role_marks | new_role, marks | new


def format_turns(conversations: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text and ``formatted``; a conversation's formatted text is that of its turns in order."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def render(batch: pa.RecordBatch) -> pa.RecordBatch:
        formatted = [render_turn(role, text) for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(formatted, pa.string())], [*batch.schema.names, "formatted"])

    return arrow_map(rows, render, ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", formatted string")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the ``formatted`` texts alone (conv_id and turn only put them in order).

    Turns of one conversation are streamed through running digests; no conversation is held whole.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    ordered = formatted.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "formatted")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None  # conv_id, turns, digest of turns, loss characters, digest of loss, formatted characters
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.null(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def table(done: list[list]) -> pa.RecordBatch:
            rows = [(c, n, t.hexdigest(), k, s.hexdigest(), f) for c, n, t, k, s, f in done]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            types[0] = batch.column(0).type
            done = []
            for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        done.append(now)
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body, spans in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{body}\n".encode())
                    if role == LOSS_ROLE:
                        for a, b in spans:
                            now[3] += b - a
                            now[4].update(text[a:b].encode())
                now[5] += len(text)
            yield table(done)
        if now is not None:
            yield table([now])

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return arrow_stream(ordered, digest, schema)
