import hashlib
from types import SimpleNamespace

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from feedback_lens.llm.pieces import CharacterMap, Codec, Normaliser, decode_column, digest_column, encode_column

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  ", "a", " a ", "\n", "a\n\nb", " \n ", "▁", "▁▁x ▁", "a  b   c", "漢字 😀 é", "\t tab", "x" * 3000, "\x00\x01", "</s> <s>", "<0x0A>"]


def check(text):
    codec = Codec.of(PATH)
    ids, begins, ends = codec.encode(text)
    want = LIBRARY.encode(text)
    assert ids.tolist() == want
    assert codec.decode(want) == LIBRARY.decode(want)
    data = text.encode()
    assert b"".join(data[a:b] for a, b in zip(begins, ends, strict=True)) == data
    assert all(a <= b for a, b in zip(begins, ends, strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=10), st.sampled_from([" ", "  ", "\n", "▁", "the", "é", "ing"])), max_size=12).map("".join))
def test_equal_to_the_library_with_whole_spans(text):
    check(text)


def test_odd_texts():
    for text in ODD:
        check(text)


def darts(entries: dict[bytes, int]):
    """A tiny double array over the keys, for tests."""
    nodes: dict[bytes, dict[int, bytes]] = {b"": {}}
    for key in entries:
        for i in range(len(key)):
            nodes.setdefault(key[:i], {})[key[i]] = key[: i + 1]
            nodes.setdefault(key[: i + 1], {})
    units, taken = {0: 0}, {0}
    place = {b"": 0}
    for prefix in sorted(nodes, key=len):
        labels = sorted(nodes[prefix]) + ([0] if prefix in entries else [])
        if not labels:
            continue
        at = place[prefix]
        base = next(b for b in range(1, 1 << 12) if all((at ^ b ^ x) not in taken for x in labels))
        units[at] |= base << 10 | (0x100 if prefix in entries else 0)
        for label in labels:
            spot = at ^ base ^ label
            taken.add(spot)
            if label == 0:
                units[spot] = entries[prefix] | 1 << 31
            else:
                units[spot] = label
                place[prefix + bytes([label])] = spot
    size = max(units) + 300
    return b"".join(units.get(i, 0x7F).to_bytes(4, "little") for i in range(size))


def compiled(pairs: dict[str, str]) -> bytes:
    strings, entries = b"", {}
    for key, value in pairs.items():
        entries[key.encode()] = len(strings)
        strings += value.encode() + b"\0"
    trie = darts(entries)
    return len(trie).to_bytes(4, "little") + trie + strings


def test_character_map_takes_the_longest_key():
    pairs = {"a": "1", "ab": "2", "abc": "", "é": "e", "\t": " ", "ﬁ": "fi"}
    blob = compiled(pairs)
    found = CharacterMap(blob)
    for text, used, new in (("abx", 2, "2"), ("abc", 3, ""), ("a", 1, "1"), ("éa", 2, "e"), ("ﬁx", 3, "fi")):
        hit = found.longest(text.encode(), 0)
        assert hit is not None and hit[0] == used and found.replacement(hit[1]) == new.encode()
    assert found.longest(b"x", 0) is None
    spec = SimpleNamespace(precompiled_charsmap=blob, add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
    text, source = Normaliser(spec)(" \tﬁé  abx abc ")
    assert text == "▁fie▁2x"
    data = " \tﬁé  abx abc ".encode()
    assert [data[i : i + 1] for i in source[-3:-1].tolist()] == [b"a", b"x"] and len(source) == len(text.encode()) + 1
    assert Normaliser(spec)("  ")[0] == ""


def test_columns(spark):
    rows = [(i, t, "z") for i, t in enumerate([*ODD, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encode, decode, digest = (f(spark, PATH) for f in (encode_column, decode_column, digest_column))
    got = df.select("doc_id", encode("text").alias("e"), digest("text").alias("d")).withColumn("back", decode("e.ids")).collect()
    for row in got:
        text = rows[row.doc_id][1] or ""
        ids = LIBRARY.encode(text)
        assert row.e.ids == ids and row.back == LIBRARY.decode(ids)
        assert (row.d.n_tokens, row.d.covered_bytes) == (len(ids), len(text.encode()))
        assert row.d.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.d.decoded_sha256 == hashlib.sha256(row.back.encode()).hexdigest()
    assert df.limit(0).select(digest("text").alias("d")).count() == 0
