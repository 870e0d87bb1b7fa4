import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from feedback_lens.llm.chat import CONTROLS, Malformed, format_turns, parse, read_back, render_turn

PARTS = st.lists(st.one_of(st.text(max_size=6), st.sampled_from([*CONTROLS, "[INST:", "[/INS", "T]", "]", "[", "\\\\", "s>", "<"])), max_size=8)


@settings(max_examples=400, deadline=None)
@given(PARTS.map("".join), PARTS.map("".join), PARTS.map("".join))
def test_round_trip_of_hostile_texts(role, first, second):
    whole = render_turn(role, first) + render_turn("assistant", second)
    turns = parse(whole)
    assert [t[:2] for t in turns] == [(role, first), ("assistant", second)]
    for _, body, spans in turns:
        assert "".join(whole[a:b] for a, b in spans) == body


def test_plain_text_has_no_escape_and_long_hostile_text_ends():
    assert render_turn("user", "hi") == "[INST:user]hi[/INST]"
    assert parse(render_turn("user", "</s>" * 20_000))[0][1] == "</s>" * 20_000


def test_grammar_rejects_other_texts():
    for text in ("x", "[INST:user]", "[INST:user]a</s>[/INST]", "[INST:user]a[/INST] ", "[INST:a]b\\"):
        try:
            parse(text)
        except Malformed:
            continue
        raise AssertionError(text)


def test_digests(spark):
    rows = [
        (1, 1, "assistant", "b</s>", "x"), (1, 0, "user", "a", "x"), (1, 0, "user", "a", "x"), (2, 0, None, None, "x"),
        (None, None, "assistant", "[/INST]\\", "x"), (3, 5, "assistant", "", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in read_back(format_turns(df)).collect()}
    assert len(got) == 4

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert (got[1].n_turns, got[1].turns_sha256) == (3, sha("user\na\nuser\na\nassistant\nb</s>\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (5, sha("b</s>"))
    assert got[1].formatted_chars == sum(len(render_turn(*t)) for t in [("user", "a"), ("user", "a"), ("assistant", "b</s>")])
    assert (got[2].turns_sha256, got[2].loss_chars) == (sha("\n\n"), 0)
    assert (got[None].loss_sha256, got[3].loss_sha256) == (sha("[/INST]\\"), sha(""))
    assert read_back(format_turns(df.limit(0))).count() == 0
