"""Packing by concatenation and cutting: two passes of prefix sums over partitions.

The first pass encodes each text once and writes blocks of token ids with their offset inside the
partition. Partition totals, one row for each task, are summed to global offsets; the second pass
cuts every block at multiples of the sequence length. Nothing is sorted and no text is shuffled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, small_batches, text_of

#: Tokens in one stored block, a multiple of usual sequence lengths; a longer document has several.
BLOCK = 1 << 16
#: Entries of a worker's memo of encoded words before it starts anew.
MEMO = 400_000
#: Characters of plain texts that are cut at once, beyond them up to the next blank.
PART = 1 << 21
#: Texts that a worker encodes at once: the more, the fewer lookups of a common word.
TEXTS = 1024


# The parts of a tokenizer file for which WordEncoder's cuts hold.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


def cuts_hold(parts: dict) -> bool:
    """Whether a tokenizer file's parts are those above, so that its words can be encoded apart."""
    return (
        parts["normalizer"] == NORMALIZER
        and parts["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
        and all((parts["model"].get(k) or None) == (v or None) for k, v in MODEL.items())
        and not parts["truncation"]
        and not parts["padding"]
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    )


def _table(sets: dict[int, str]) -> bytes:
    """For each Latin-1 character the number of its set, 0 if it has none."""
    found = bytearray(256)
    for number, chars in sets.items():
        for c in chars.encode("latin-1"):
            found[c] = number
    return bytes(found)


#: Kinds of Latin-1 characters; signs are 0.
BLANK, LETTER, DIGIT = 1, 2, 3
#: Lower-case Latin-1 letters of ``WordEncoder.PLAIN``.
LOWER_CASE = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
KINDS = _table({BLANK: "\t\n\r ", LETTER: LOWER_CASE, DIGIT: "0123456789"})
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
#: What an apostrophe takes along.
ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")


def piece_starts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces start in lower-case Latin-1 text, and the places that aren't blank; pieces tile these.

    A piece is an apostrophe that follows no sign with one of ENDINGS, a run of letters, a digit, or
    a run of signs.
    """
    kinds = np.frombuffer(data.translate(KINDS), dtype=np.uint8)
    solid = kinds != BLANK
    starts = kinds == DIGIT
    starts[:1] = True
    starts[1:] |= kinds[1:] != kinds[:-1]
    starts &= solid
    codes = np.frombuffer(data, dtype=np.uint8)
    for at in np.flatnonzero((codes == ord("'")) & starts).tolist():
        if data.startswith(ENDINGS, at + 1):
            end = at + (2 if data[at + 1] in b"stmd" else 3)
            starts[at + 1] = False
            if end < len(data) and solid[end]:
                starts[end] = True
    return starts, solid


class WordEncoder:
    """Exact ids of a tokenizer file as little-endian 32-bit integers, fast for word-level BPE.

    A file whose parts aren't those of ``cuts_hold`` encodes each text whole.

    The tokenizer normalises and splits before it merges, so pieces that it always splits apart
    can be encoded apart and remembered. Texts in plain Latin letters are cut as the tokenizer's
    own pattern cuts them, many texts at once as arrays, and each different piece of a part is
    looked up once; any other text is cut at white space, which no piece crosses.
    """

    PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
    SPACE = re.compile(r"[\t\n\r\x20]+")
    EDGE = re.compile(rb"[\t\n\r\x20]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.by_words = cuts_hold(json.load(file))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: ids of a word's last piece end with the mark
        ends = [i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith("</w>")]
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[ends] = True
        # two generations: what is used again after the young one is full moves on, the rest goes
        self.young: dict[str | bytes, bytes] = {}
        self.old: dict[str | bytes, bytes] = {}

    def known(self, words: list, alone: bool) -> list[bytes]:
        """The ids of each of ``words``, all different; pieces (Latin-1) that aren't ``alone`` are one word each and share calls."""
        found = list(map(self.young.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if len(self.young) + len(missing) > MEMO:
            self.old, self.young = self.young, {}
        fresh = []
        for k in missing:
            if (ids := self.old.get(words[k])) is not None:
                self.young[words[k]] = found[k] = ids
            else:
                fresh.append(k)
        if alone:
            for k in fresh:
                self.young[words[k]] = found[k] = self.whole(words[k])
            return found
        for at in range(0, len(fresh), 256):
            some = fresh[at : at + 256]
            ids = np.array(self.tokenizer.encode(b" ".join([words[k] for k in some]).decode("latin-1"), add_special_tokens=False).ids, dtype="<u4")
            cuts = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(cuts) != len(some):
                raise ValueError(f"{len(some)} words gave {len(cuts)} word ends")
            data, start = ids.tobytes(), 0
            for k, end in zip(some, cuts.tolist(), strict=True):
                self.young[words[k]] = found[k] = data[start:end]
                start = end
        return found

    def whole(self, text: str) -> bytes:
        """The tokenizer's own ids of ``text``."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def by_pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts, cut as arrays; parts end at blanks, so a long text has several."""
        data = "\n".join([*texts, ""]).encode("latin-1").translate(LOWER)
        places, ends, out, at, done = [], [], [], 0, 0
        while at < len(data):
            part = data[at : self.EDGE.search(data, min(at + PART, len(data) - 1)).end()]
            starts, solid = piece_starts(part)
            bounds = np.append(np.flatnonzero(starts[solid]), np.count_nonzero(solid)).astype("<i4")
            chars = pa.py_buffer(np.frombuffer(part, dtype=np.uint8)[solid])
            pieces = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), chars]).dictionary_encode()
            words, found = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), []
            for first in range(0, len(words), MEMO // 4):  # so that the memo never has to hold all
                found += self.known(words[first : first + MEMO // 4], False)
            ids = pa.array(found, pa.large_binary()).take(pieces.indices)
            _, to, values = ids.buffers()
            to = np.frombuffer(to, dtype="<i8")[ids.offset : ids.offset + len(ids) + 1] if len(ids) else np.zeros(1, dtype="<i8")
            if len(ids):
                out.append(memoryview(values)[to[0] : to[-1]])
            places.append(np.flatnonzero(starts) + at)
            ends.append(to[1:] - to[0] + done)
            done += int(to[-1] - to[0])
            at += len(part)
        ends, stream = np.concatenate([[0], *ends]), b"".join(out)
        limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cuts = ends[np.searchsorted(np.concatenate(places), limits)].tolist() if texts else []
        return [stream[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_words:
            return list(map(self.whole, texts))
        plain = [bool(self.PLAIN.fullmatch(t)) and not any(s in t for s in self.special) for t in texts]
        cut = iter(self.by_pieces([t for t, p in zip(texts, plain, strict=True) if p]))
        return [next(cut) if p else self.by_spaces(t) for t, p in zip(texts, plain, strict=True)]

    def by_spaces(self, text: str) -> bytes:
        words, out = [w for w in self.SPACE.split(text) if w], []
        # a long text in parts, so that the memo never has to hold all of its words
        for at in range(0, len(words), MEMO // 4):
            some = words[at : at + MEMO // 4]
            different = list(dict.fromkeys(some))
            out += map(dict(zip(different, self.known(different, True), strict=True)).__getitem__, some)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    return WordEncoder(path)


def encode_blocks(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Blocks of ids, written to the shared folder: doc_id, part, at, start, n, doc_tokens, ids.

    ids are little-endian 32-bit integers; every document ends with ``end_id``. part is the task,
    at the block's offset in it, start its offset in the document. ``tokenizer`` is a path that
    every executor can open.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = encoder(tokenizer).encode_all, TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, TEXTS):
            index, ats, starts, ns, totals, ids = [], [], [], [], [], []
            for i, found in enumerate(encode(batch.column(1).to_pylist())):
                data = found + end
                total = len(data) // 4
                for start in range(0, total, BLOCK):
                    piece = data[4 * start : 4 * (start + BLOCK)]
                    index.append(i)
                    ats.append(at)
                    starts.append(start)
                    ns.append(len(piece) // 4)
                    totals.append(total)
                    ids.append(piece)
                    at += len(piece) // 4
            doc = batch.column(0).take(pa.array(index, pa.int64()))
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array([part] * len(index), pa.int32()), pa.array(ats, long), pa.array(starts, long), pa.array(ns, long), pa.array(totals, long), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "at", "start", "n", "doc_tokens", "ids"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialise(rows.mapInArrow(run, f"doc_id {kind}, part int, at bigint, start bigint, n bigint, doc_tokens bigint, ids binary"), "tokens")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of ``length`` ids.

    doc_id, start, length, doc_tokens, sequence_id, offset and ids (binary) of each piece. A
    document is cut where a sequence ends, and every 65,536 ids; the pieces of a sequence lie
    without a gap from offset 0, and only the last sequence can be shorter. Null text is empty text
    (its end id alone), repeated rows are packed as often as they occur, an empty table gives no
    piece, further columns are ignored.
    """
    blocks = encode_blocks(docs, tokenizer, end_id)
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    # a row for each task of the first pass, so one window and a broadcast hold it
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(bases), "part").withColumn("from", F.col("base") + F.col("at"))
    last = F.expr(f"(`from` + n - 1) div {length}")
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"`from` div {length}"), last)))
    low = F.greatest(F.col("sequence_id") * length, F.col("from"))
    high = F.least((F.col("sequence_id") + 1) * length, F.col("from") + F.col("n"))
    skip = low - F.col("from")
    return cut.select(
        "doc_id", (F.col("start") + skip).alias("start"), (high - low).alias("length"), "doc_tokens", "sequence_id", (low % length).alias("offset"),
        F.substring(F.col("ids"), (skip * 4 + 1).cast("int"), ((high - low) * 4).cast("int")).alias("ids"),
    )
