"""SentencePiece encoding and decoding with byte offsets.

The normaliser is written here: at each place the longest entry of the model's compiled character map is replaced, and for every
normalised byte its source byte is kept. The normalised text is cut where no piece of the model can cross; each distinct part is merged
by the sentencepiece library once and remembered. Piece lengths, summed up and taken through the alignment, give every piece's
span of original bytes. Decoding maps ids to piece surfaces.

Null is the empty text, which has no piece. Long texts are encoded whole. Only the named text column is read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession

from feedback_lens.llm.common import Remembered, arrow_column

MARK = "▁"
MARK_BYTES = MARK.encode()
_CODECS: dict[str, Codec] = {}


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8 keys, then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """Bytes of the longest key that starts at ``at``, and where its replacement starts."""
        found, node = None, 0
        if not self.units:
            return None
        node ^= self._offset(self.units[0])
        for place in range(at, len(data)):
            node ^= data[place]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[place]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (place + 1 - at, self.units[node] & 0x7FFFFFFF)
        return found

    def replacement(self, start: int) -> bytes:
        return self.strings[start : self.strings.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Normalised text with, for each of its bytes, the original byte it comes from; one more entry marks the end."""

    def __init__(self, spec) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    @property
    def plain(self) -> bool:
        return not self.map.units and not self.squeeze

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        return self._plain(text, data) if self.plain else self._mapped(data)

    def _plain(self, text: str, data: bytes) -> tuple[str, np.ndarray]:
        """No map: only spaces change, from one byte to the mark's three."""
        lead = MARK if self.escape else " "
        out = (lead if self.prefix else "") + (text.replace(" ", MARK) if self.escape else text)
        width = np.ones(len(data), np.int64)
        if self.escape:
            width[np.frombuffer(data, np.uint8) == 0x20] = len(MARK_BYTES)
        source = np.repeat(np.arange(len(data)), width)
        head = np.zeros(len(lead.encode()) if self.prefix else 0, np.int64)
        return out, np.concatenate([head, source, [len(data)]])

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        parts: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit:
                used, new = hit[0], self.map.replacement(hit[1])
            else:
                first = data[at]
                used = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                new = data[at : at + used]
            parts.append((new, at))
            at += used
        space, out, source = MARK_BYTES if self.escape else b" ", bytearray(), []
        begin = 0
        if self.squeeze:
            while begin < len(parts) and parts[begin][0].strip(b" ") == b"":
                begin += 1
        if begin == len(parts):
            return "", np.array([len(data)], np.int64)
        if self.prefix:
            out += space
            source += [parts[begin][1]] * len(space)
        was_space = self.squeeze
        for new, origin in parts[begin:]:
            for byte in new:
                if byte == 0x20:
                    if was_space and self.squeeze:
                        continue
                    out += space
                    source += [origin] * len(space)
                else:
                    out.append(byte)
                    source.append(origin)
                was_space = byte == 0x20
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                del source[-len(space) :]
        return out.decode(), np.array([*source, len(data)], np.int64)


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self.normalise = Normaliser(model.normalizer_spec)
        names = [p.piece for p in model.pieces]
        self.surfaces = [
            bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else b"" if p.type == p.CONTROL else p.piece.replace(MARK, " ").encode()
            for p in model.pieces
        ]
        #: Normalised bytes that a piece stands for.
        self.widths = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in model.pieces])
        # The library is left with the merges alone: what it is given is normalised already.
        spec = model.normalizer_spec
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", False, False, False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        crossing = any(name.lstrip(MARK).find(MARK) > 0 for name in names)
        own = "\n" if not any("\n" in name for name in names) else ""
        #: Parts that no piece crosses: marks with what follows, and characters that no piece has.
        self.parts = re.compile(".+" if crossing else f"{MARK}*[^{MARK}{own}]+|{MARK}+|\n", re.S)
        self.known = Remembered(self._code)

    @staticmethod
    def of(path: str) -> Codec:
        if path not in _CODECS:
            _CODECS[path] = Codec(path)
        return _CODECS[path]

    def _code(self, parts: list[str]) -> list[tuple[bytes, str, bytes]]:
        """For each part: its ids as 32-bit numbers, as decimal text, and their surface."""
        rows = self.merger.encode(parts, num_threads=1)
        return [(np.array(ids, "<u4").tobytes(), ",".join(map(str, ids)), b"".join(map(self.surfaces.__getitem__, ids))) for ids in rows]

    def _coded(self, normalised: str) -> list[tuple[bytes, str, bytes]]:
        return self.known(self.parts.findall(normalised))

    def spans(self, ids: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte of every piece in the original text."""
        ends = np.cumsum(self.widths[ids])
        return source[ends - self.widths[ids]], source[ends]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and ends."""
        normalised, source = self.normalise(text)
        ids = np.frombuffer(b"".join(c[0] for c in self._coded(normalised)), "<u4")
        return ids, *self.spans(ids, source)

    def surface(self, data: bytes) -> str:
        """Text of joined surfaces; the space that the encoder puts first is dropped."""
        return (data[1:] if self.normalise.prefix and data[:1] == b" " else data).decode(errors="replace")

    def decode(self, ids) -> str:
        return self.surface(b"".join(map(self.surfaces.__getitem__, ids)))

    def digests(self, text: str) -> tuple[int, str, str, int]:
        """Number of ids, digest of the ids, digest of the decoded text, original bytes covered by spans."""
        normalised, source = self.normalise(text)
        coded = self._coded(normalised)
        ids = np.frombuffer(b"".join([c[0] for c in coded]), "<u4")
        begins, ends = self.spans(ids, source)
        decoded = self.surface(b"".join([c[2] for c in coded]))
        named = ",".join([c[1] for c in coded])
        covered = int(np.maximum(ends - begins, 0).sum())
        return len(ids), hashlib.sha256(named.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), covered


def encode_column(spark: SparkSession, model: str) -> Callable[..., Column]:
    """Text to struct<ids, begins, ends>: piece ids with their spans of original UTF-8 bytes."""

    def encode(texts: pa.Array) -> pa.Array:
        codec = Codec.of(model)
        rows = [codec.encode(text or "") for text in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]).astype(np.int32)
        flat = [np.concatenate([r[i] for r in rows] or [np.empty(0)]).astype(np.int32) for i in range(3)]
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(f, pa.int32())) for f in flat]
        return pa.StructArray.from_arrays(lists, ["ids", "begins", "ends"])

    return arrow_column(spark, encode, "struct<ids:array<int>,begins:array<int>,ends:array<int>>")


def decode_column(spark: SparkSession, model: str) -> Callable[..., Column]:
    """Array of ids to text; null gives null."""

    def decode(ids: pa.Array) -> pa.Array:
        codec = Codec.of(model)
        return pa.array([None if row is None else codec.decode(row) for row in ids.to_pylist()], pa.string())

    return arrow_column(spark, decode, "string")


def digest_column(spark: SparkSession, model: str) -> Callable[..., Column]:
    """Text to struct<n_tokens, ids_sha256, decoded_sha256, covered_bytes> of the same encoding."""
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("covered_bytes", pa.int64())]

    def digest(texts: pa.Array) -> pa.Array:
        codec = Codec.of(model)
        columns = list(zip(*(codec.digests(text or "") for text in texts.to_pylist()), strict=True)) or [[]] * 4
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    return arrow_column(spark, digest, "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string,covered_bytes:long>")
