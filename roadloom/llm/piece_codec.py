"""SentencePiece encoding and decoding with offsets into the original bytes.

The text is normalised by longest prefix through the model's compiled character map (a double
array over UTF-8 bytes with replacement strings), recording for each normalised byte where it came
from. The model's pieces then tile the normalised bytes, so running sums of their lengths project
every piece to a span of the original.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

from .common import small_batches, text_of

SPACE = "▁".encode()


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields: varints, fixed and bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class CharacterMap:
    """The compiled map: 32-bit units of a double array, then zero-ended replacements."""

    units: np.ndarray
    replacements: bytes

    @classmethod
    def parse(cls, blob: bytes) -> CharacterMap:
        size = int.from_bytes(blob[:4], "little")
        return cls(np.frombuffer(blob[4 : 4 + size], "<u4"), blob[4 + size :])

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at ``at``."""
        units, found = self.units, None
        offset = lambda unit: (unit >> 10) << ((unit & (1 << 9)) >> 6)
        node = offset(int(units[0]))
        for i in range(at, len(data)):
            node ^= data[i]
            unit = int(units[node])
            # the label with the leaf bit must be the byte
            if unit & ((1 << 31) | 0xFF) != data[i]:
                break
            node ^= offset(unit)
            if (unit >> 8) & 1:
                value = int(units[node]) & 0x7FFFFFFF
                end = self.replacements.index(b"\0", value)
                found = (i + 1 - at, self.replacements[value:end])
        return found


class PieceCodec:
    """One model: the library's encoder and decoder, the normaliser, and the pieces' lengths."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            data = file.read()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        spec = dict(_fields(next((v for k, v in _fields(data) if k == 3), b"")))
        self.map = CharacterMap.parse(spec[2]) if spec.get(2) else None
        self.prefix, self.trim, self.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
        n = self.model.get_piece_size()
        self.lengths = np.array([0 if self.model.is_control(i) else 1 if self.model.is_byte(i) else len(self.model.id_to_piece(i).encode()) for i in range(n)], dtype=np.int64)

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of them and the end, the original byte it begins at."""
        if self.map is None and not self.trim:
            return self._plain(data)
        out, source, at = bytearray(), [], 0
        space = SPACE if self.escape else b" "
        if self.trim:
            data_end = len(data.rstrip(b" "))
            at = data_end - len(data[:data_end].lstrip(b" "))
        else:
            data_end = len(data)
        if self.prefix and data_end > at:
            out += space
            source += [at] * len(space)
        last_space, held = self.trim, data[:data_end]
        while at < data_end:
            found = self.map.longest(held, at) if self.map else None
            if found:
                size, new = found
            else:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = data[at : at + size]
            for byte in new:
                if byte == 32:
                    if not (self.trim and last_space):
                        out += space
                        source += [at] * len(space)
                    last_space = True
                else:
                    out.append(byte)
                    source.append(at)
                    last_space = False
            at += size
        if self.trim:
            while out.endswith(space) and len(out) > 0:
                del out[-len(space) :]
                del source[-len(space) :]
        return bytes(out), np.array([*source, data_end], dtype=np.int64)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The same for a model without a character map: only spaces change."""
        space = SPACE if self.escape else b" "
        normal = data.replace(b" ", space)
        width = np.where(np.frombuffer(data, np.uint8) == 32, len(space), 1)
        source = np.repeat(np.arange(len(data), dtype=np.int32), width)
        if self.prefix and data:
            normal, source = space + normal, np.concatenate([np.zeros(len(space), np.int32), source])
        return normal, np.append(source, np.int32(len(data)))

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans of the pieces ``ids``: starts and ends, in order.

        Raises if the pieces don't tile the normalised text.
        """
        normal, source = self.normalise(text.encode())
        edges = np.concatenate([[0], np.cumsum(self.lengths[np.asarray(ids, dtype=np.int64)])])
        if edges[-1] != len(normal):
            raise ValueError(f"pieces cover {edges[-1]} of {len(normal)} normalised bytes")
        return source[edges[:-1]], source[edges[1:]]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, add_eos=True)

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@cache
def codec(path: str) -> PieceCodec:
    """One codec for each worker process and model file."""
    return PieceCodec(path)


@dataclass(frozen=True)
class Encoded:
    """One text's ids and the original byte span of each piece (an end id's span is empty)."""

    ids: list[int]
    starts: np.ndarray
    ends: np.ndarray


def map_encoded(docs: DataFrame, model: str, summary: Callable[[Encoded, PieceCodec], tuple], fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    """doc_id and what ``summary`` makes of each text's encoding, one pass inside the tasks.

    fields: name and Arrow type of each value that ``summary`` returns. ids are the library's for
    the whole text with an end id. Null text is empty text (the end id alone); repeated rows give
    repeated rows; an empty table an empty result; further columns are ignored. ``model`` is a path
    that every executor can open.
    """
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in small_batches(batches):
            out = []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text)
                out.append(summary(Encoded(ids, *own.spans(text, ids)), own))
            columns = list(zip(*out, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True))], names=["doc_id", *(n for n, _ in fields)])

    schema = StructType([rows.schema["doc_id"], *(StructField(n, from_arrow_type(kind)) for n, kind in fields)])
    return rows.mapInArrow(run, schema)


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, starts and ends (bytes of the original text) for every row: see ``map_encoded``."""
    fields = [("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
    return map_encoded(docs, model, lambda x, _: (x.ids, x.starts, x.ends), fields)


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and the decoded text for every row of ``encoded`` (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in small_batches(batches):
            texts = [own.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")
