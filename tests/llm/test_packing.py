import random
import zlib

import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedback_lens.llm import common, packing
from feedback_lens.llm.packing import ChunkEncoder, pack, plan_counts, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", None, " ", "\n\t", "a" * 30_000, "Ünï 12'd we're <|endoftext|>x   b ΣΑΣ é 漢字", "x y " * 9000, "İ ﬁ 9½ --..!"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from([" ", "\n", "\t", "'s", "<|endoftext|>", "Der", "́", " "])), max_size=12))
def test_ids_equal_the_library(parts):
    text = "".join(parts)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ChunkEncoder.of(PATH)(text) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_pieces_cover_every_token(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(0, "", "x")]
    got = token_pieces(spark.createDataFrame(rows, "doc_id long, text string, length string"), PATH).collect()
    for i, text, _ in rows[:-1]:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i})
        want = [
            (p, a, len(ids[a : a + 4096]), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a : a + 4096])))
            for p, a in enumerate(range(0, len(ids), 4096))
        ]
        assert own == want
    assert sum(r.doc_id == 0 for r in got) == 2


def _best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fit = [i for i, space in enumerate(bins) if space >= length]
        if fit:
            best = min(fit, key=bins.__getitem__)
            bins[best] -= length
        else:
            bins.append(capacity - length)
    return len(bins)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=20))
def test_plan_is_best_fit_decreasing_and_gapless(counts):
    runs = plan_counts(counts, 40)
    placed: dict[int, list] = {}
    for length, _, ranks, each, first, base in runs:
        for rank in range(ranks):
            placed.setdefault(first + rank // each, []).append((base + rank % each * length, length))
    for slots in placed.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 40
    assert sum(map(len, placed.values())) == sum(counts.values())
    assert len(placed) == _best_fit([k for k, n in counts.items() for _ in range(n)], 40)


def test_pack_is_gapless(spark):
    rng = random.Random(1)
    rows = [(i, "the " * rng.choice([0, 1, 5, 5, 5, 700, 5000])) for i in range(6000)] + [(7, "again")]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in sequences.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert total == sum(len(t.split()) + 1 for _, t in rows)
    assert len(sequences) == _best_fit([r.length for r in got], 4096)


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_worker_that_serves_another_module_forgets_the_encoder(spark):
    ids = ChunkEncoder.of(PATH)("Ünï 12'd")
    common.serving(packing.__name__)
    ChunkEncoder.of(PATH)
    common.serving(packing.__name__)
    assert packing._ENCODERS  # a stage's next task finds what was remembered
    common.word_hashes([b"a", b"b"])
    common.serving("another")
    assert not packing._ENCODERS and not common._HASHES
    assert ChunkEncoder.of(PATH)("Ünï 12'd") == ids

    def fill(batch):
        ChunkEncoder.of(PATH)
        return batch

    fill.__module__ = packing.__name__

    def left(batch):
        return batch.set_column(0, "id", pa.array([len(packing._ENCODERS)] * len(batch), pa.int64()))

    left.__module__ = "another"
    one = spark.range(64, numPartitions=4)
    assert {r.id for r in common.arrow_map(common.arrow_map(one, fill, "id long").cache(), left, "id long").collect()} == {0}
