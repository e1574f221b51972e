"""Chat formatting with offset-aligned loss masks.

A whole conversation is rendered as one string and encoded once with offsets. The turns' spans and
the tokens' spans are both sorted, so a binary search finds the tokens under the loss.
Control strings inside roles and texts are escaped reversibly, and the marks are tokens of their
own, so no token straddles a turn's end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

from .common import small_batches, text_of

START, TEXT, END = "<|im_start|>", "<|im_text|>", "<|im_end|>"
MARKS = (START, TEXT, END)
TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    """Put one more ``!`` between every ``<`` and ``|``, so that no ``<|`` is left."""
    return re.sub(r"<(!*)\|", r"<!\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<!(!*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and each text's span in it (code points, sorted)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{TEXT}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at = spans[-1][1] + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, unescaped."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


@cache
def load_tokenizer(path: str):
    """The tokenizer file with the template's marks added as tokens after its own."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # first, as its own special tokens in a text are then plain text; the marks still match
    tokenizer.add_tokens([AddedToken(m, normalized=False, special=False) for m in MARKS])
    tokenizer.encode_special_tokens = True
    return tokenizer


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the sorted spans: both ends by binary search.

    offsets: (n, 2) starts and ends of the tokens, non-decreasing.
    """
    mask = np.zeros(len(offsets), dtype=bool)
    edges = np.array(spans, dtype=np.int64).reshape(-1, 2)
    lows = np.searchsorted(offsets[:, 0], edges[:, 0], side="left")
    highs = np.searchsorted(offsets[:, 1], edges[:, 1], side="right")
    for low, high in zip(lows.tolist(), highs.tolist(), strict=True):
        mask[low:high] = True
    return mask


@dataclass(frozen=True)
class Formatted:
    """One conversation: its text, token ids, which of them are under the loss, each text's span."""

    conv_id: object
    formatted: str
    ids: list[int]
    mask: np.ndarray
    spans: list[tuple[int, int]]


def format_conversation(conv_id: object, turns: list[tuple[str, str]], tokenizer: str, loss_roles: frozenset[str]) -> Formatted:
    formatted, spans = render(turns)
    code = load_tokenizer(tokenizer).encode(formatted, add_special_tokens=False)
    offsets = np.fromiter(chain.from_iterable(code.offsets), dtype=np.int64, count=2 * len(code)).reshape(-1, 2)
    mask = loss_mask(offsets, [s for (role, _), s in zip(turns, spans, strict=True) if role in loss_roles and s[0] < s[1]])
    return Formatted(conv_id, formatted, code.ids, mask, spans)


def loss_texts(ids: list[int], mask: np.ndarray | list[int], tokenizer: str) -> list[str]:
    """The texts under the mask, read back from the ids: one for each run of masked tokens."""
    decode = load_tokenizer(tokenizer).decode
    edges = np.flatnonzero(np.diff(np.asarray(mask, dtype=np.int8), prepend=0, append=0))
    return [unescape(decode(ids[low:high], skip_special_tokens=False)) for low, high in edges.reshape(-1, 2).tolist()]


def map_formatted(
    conversations: DataFrame, tokenizer: str, summary: Callable[[Formatted], tuple], fields: list[tuple[str, pa.DataType]], loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """conv_id and what ``summary`` makes of each formatted conversation, one pass inside the tasks.

    ``conversations`` has conv_id (of any type that can be ordered), turn, role and text; fields are
    name and Arrow type of each value that ``summary`` returns. Rows are ordered by turn (ties: by
    role, then text; null turns first), all of them kept, repeated ones too; null role or text is
    empty; a row with a null conv_id is a conversation of its own, as nothing says what it belongs
    to; further columns are ignored; an empty table gives an empty result. A task streams its
    sorted rows and holds one conversation at a time, which has to be whole.
    """
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    # rows without a conversation are dealt over all tasks
    deal = F.when(F.col("conv_id").isNull(), F.xxhash64(F.spark_partition_id(), "turn", "role", "text"))
    dealt = rows.withColumn("deal", deal).repartition("conv_id", "deal").sortWithinPartitions("conv_id", "turn", "role", "text")
    roles = frozenset(loss_roles)

    def talks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, object, list[tuple[str, str]]]]:
        kind, now, own = pa.null(), None, []
        for batch in batches:
            kind = batch.column(0).type
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if own and (conv is None or conv != now):
                    yield kind, now, own
                    own = []
                now = conv
                own.append((role, text))
        if own:
            yield kind, now, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kind = [], 0, pa.null()

        def batch() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [kind, *(k for _, k in fields)], strict=True)], names=["conv_id", *(n for n, _ in fields)])

        for kind, conv, turns in talks(batches):
            made = format_conversation(conv, turns, tokenizer, roles)
            held.append((conv, *summary(made)))
            size += len(made.formatted)
            if size > 1 << 20:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    schema = StructType([rows.schema["conv_id"], *(StructField(n, from_arrow_type(kind)) for n, kind in fields)])
    return dealt.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def format_chats(conversations: DataFrame, tokenizer: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, n_turns, formatted, ids, mask (0 and 1) and spans: see ``map_formatted``."""
    fields = [("n_turns", pa.int64()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.int8())), ("spans", pa.list_(pa.list_(pa.int64())))]
    return map_formatted(conversations, tokenizer, lambda x: (len(x.spans), x.formatted, x.ids, x.mask.astype(np.int8).tolist(), [list(s) for s in x.spans]), fields, loss_roles)
