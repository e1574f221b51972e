"""Repair of conversations: faults counted, and the cheapest edits that make turns alternate.

Roles are to read ``(s?(ua)+)?`` by their initials. A dynamic program over the rows keeps, for each
place in that pattern, the cheapest edits so far and, of equally cheap ones, the least string of
their initials (Delete, Insert, Keep, Rerole). Strings are never copied: an edit is a node linked to
the one before it, with ancestors at powers of two and a rolling hash of the string up to it. Two
strings of equal cost are compared by climbing to their longest common prefix, which is then
verified letter by letter.

A conversation may be of any length. Rows are range-partitioned by conversation and order, so a
long one is spread over tasks, and a task cuts its rows into chunks. For a chunk the program is run
from each place of the pattern, which gives a small table from place to place; the tables of a
conversation's chunks are chained afterwards. Conversations that lie inside one task are finished
there. Of those across tasks (at most two for each task), the chunks' texts are rendered where they
are and one task takes the digest over them, a chunk at a time, as SHA-256 is sequential.
The chain of one conversation is one group: some ten letters for each of its rows, where the result
itself holds one.

Defined results: a null role or text is one space, so a null text is blank, and a null conv_id or
turn is a space in the damage's key. Rows with a null conv_id are one conversation. Rows go by turn,
nulls first, ties by role, then text. Repeated rows are duplicates; an empty role has no initial and
is never kept; an empty table gives no rows. Further columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import materialise

#: Rows and characters of a chunk, about.
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20
#: A text of one conversation that has this share of all rows is frequent: there are at most so many.
FREQUENT = 1 << 15

DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
#: Places in the pattern: nothing yet, behind the system row, behind a user row, behind an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The place that an initial leads to from each place.
STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that is put in when a row is inserted or renamed.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ENDS = (START, ASSISTANT)
SPACE = r"[^\x20\x09-\x0D]"
PRIME, BASE = (1 << 61) - 1, 1_000_003


class Edits:
    """Strings of edits as linked nodes; node 0 is the empty string."""

    def __init__(self) -> None:
        self.up: list[tuple[int, ...]] = [()]
        self.letter, self.depth, self.hash = [""], [0], [0]

    def add(self, node: int, letter: str) -> int:
        """The string ``node`` with one more letter."""
        ups = [node]
        # the ancestor 2**k up is that of the ancestor 2**(k-1) up
        while len(self.up[ups[-1]]) >= len(ups):
            ups.append(self.up[ups[-1]][len(ups) - 1])
        self.up.append(tuple(ups))
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % PRIME)
        return len(self.up) - 1

    def climb(self, node: int, steps: int) -> int:
        while steps:
            k = steps.bit_length() - 1
            node, steps = self.up[node][k], steps - (1 << k)
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether string ``a`` comes before string ``b``: at the first letter that differs, else the shorter one."""
        short = min(self.depth[a], self.depth[b])
        x, y = self.climb(a, self.depth[a] - short), self.climb(b, self.depth[b] - short)
        if self._same(x, y):
            return self.depth[a] < self.depth[b]
        # to the highest pair of ancestors whose strings differ; their parents are the longest common prefix
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and not self._same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.letter[x] < self.letter[y]

    def _same(self, x: int, y: int) -> bool:
        """Whether two strings of one length are equal; equal hashes are verified."""
        if self.hash[x] != self.hash[y]:
            return False
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))


#: A row as the program sees it: initial of its role, whether it must go, whether its text is cut off.
Row = tuple[str, bool, bool]


def _better(edits: Edits, found: dict[int, tuple[int, int]], place: int, cost: int, node: int, letter: str) -> bool:
    """Take ``node`` with ``letter`` for ``place`` if that is cheaper, or as cheap and less."""
    held = found.get(place)
    if held is not None and held[0] < cost:
        return False
    fresh = edits.add(node, letter)
    if held is None or cost < held[0] or edits.less(fresh, held[1]):
        found[place] = (cost, fresh)
        return True
    return False


def _inserted(edits: Edits, found: dict[int, tuple[int, int]]) -> None:
    """Rows put in at this point, as far as they are the best way to a place."""
    changed = True
    while changed:
        changed = False
        for place, (cost, node) in list(found.items()):
            changed |= _better(edits, found, NEXT[place][1], cost + INSERT_COST, node, INSERT)


def transfers(rows: Iterable[Row], starts: Iterable[int] = range(4), last: bool = False) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest edits of ``rows`` from each start to each place: (cost, initials).

    Rows are put in before a row of the input; behind the last one too where ``last`` says that the
    conversation ends there.
    """
    rows = list(rows)
    out = {}
    for start in starts:
        edits = Edits()
        now = {start: (0, 0)}
        for initial, must_go, cut in rows:
            _inserted(edits, now)
            after: dict[int, tuple[int, int]] = {}
            kept = TRUNCATED_COST if cut else 0
            for place, (cost, node) in now.items():
                _better(edits, after, place, cost + DELETE_COST, node, DELETE)
                if must_go:
                    continue
                if initial in STEPS[place]:
                    _better(edits, after, STEPS[place][initial], cost + kept, node, KEEP)
                _better(edits, after, NEXT[place][1], cost + kept + REROLE_COST, node, REROLE)
            now = after
        if last:
            _inserted(edits, now)
        out |= {(start, place): (cost, edits.text(node)) for place, (cost, node) in now.items()}
    return out


@dataclass
class _Link:
    """Edits of a chunk behind those of the chunks before it."""

    cost: int
    place: int
    text: str
    before: _Link | None
    number: int = field(default=0)

    def __post_init__(self) -> None:
        self.number = self.before.number + 1 if self.before else 0


def _behind(a: _Link, b: _Link) -> bool:
    """Whether the edits of link ``a`` come before those of ``b``, both of the same number of chunks."""
    left, right = [], []
    while a is not b:
        left.append(a.text)
        right.append(b.text)
        a, b = a.before, b.before
    return "".join(reversed(left)) < "".join(reversed(right))


def chained(tables: Iterable[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """The cheapest edits through all chunks: their cost, and for each chunk its start and its edits."""
    now = {START: _Link(0, START, "", None)}
    for table in tables:
        after: dict[int, _Link] = {}
        for (start, place), (cost, text) in table.items():
            if start not in now:
                continue
            fresh = _Link(now[start].cost + cost, place, text, now[start])
            held = after.get(place)
            if held is None or fresh.cost < held.cost or fresh.cost == held.cost and _behind(fresh, held):
                after[place] = fresh
        now = after
    best = None
    for place in ENDS:
        link = now.get(place)
        if link is not None and (best is None or link.cost < best.cost or link.cost == best.cost and _behind(link, best)):
            best = link
    path, link = [], best
    while link.before is not None:
        path.append((link.before.place, link.text))
        link = link.before
    return best.cost, path[::-1]


def repaired(rows: Iterable[tuple[str, str]], edits: str, start: int = START) -> Iterator[tuple[str, str]]:
    """(role, text) rows as ``edits`` leave them, from the place ``start`` of the pattern."""
    source, place = iter(rows), start
    for letter in edits:
        role, text = ("", "") if letter == INSERT else next(source)
        if letter == DELETE:
            continue
        if letter == KEEP:
            place = STEPS[place][role[0]]
        else:
            role, place = NEXT[place]
        yield role, text


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone of the rows after damage, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row: it stays here as gone, so that its conversation is known. 1 empties its text, 2
    takes its ``[.!?]`` out, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    changed = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    named = marked.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), changed.alias("text"), (F.col("kind") == 0).alias("gone"), copies.alias("copy"))
    return named.drop("copy")


def with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with repeat: role and text were seen in the conversation at an earlier turn.

    Frequent texts meet their rows by broadcast, so no task gets the rows of one.
    """
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = materialise(rows.withColumn("same", same), "damaged")
    seen = rows.where("not gone").groupBy("conv_id", "same").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = materialise(seen.select(F.col("conv_id").alias("seen_id"), F.col("same").alias("seen_same"), F.col("first.turn").alias("seen_turn"), "n", F.lit(True).alias("known")), "seen")
    least = max(2, rows.count() // FREQUENT)
    match = F.col("conv_id").eqNullSafe(F.col("seen_id")) & (F.col("same") == F.col("seen_same"))
    often, seldom = (seen.where(c).drop("n") for c in (F.col("n") >= least, F.col("n") < least))
    met = rows.join(F.broadcast(often), match, "left")
    rest = met.where("known is null and not gone").drop("seen_id", "seen_same", "seen_turn", "known").join(seldom, match, "left")
    # a null turn comes first of all
    later = F.col("known") & F.col("turn").isNotNull() & (F.col("seen_turn").isNull() | (F.col("turn") > F.col("seen_turn")))
    return met.where("known is not null or gone").unionByName(rest).select("conv_id", "turn", "role", "text", "gone", F.coalesce(later, F.lit(False)).alias("repeat"))


STRUCTURE = "conv_id {conv}, part int, chunk int, done boolean, gaps long, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, roles array<string>, texts array<string>, tables array<struct<start:int,place:int,cost:long,edits:string>>, audit string, cost long, digest string"
NOT_BLANK = re.compile(SPACE)
LAST = re.compile(SPACE + r"(?=[\x20\x09-\x0D]*\Z)")
LEGAL = {"su", "ua", "au"}


@dataclass
class _Chunk:
    """Rows of one conversation that follow each other, and what is counted on them."""

    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    rows: list[Row] = field(default_factory=list)
    turns: set[int] = field(default_factory=set)
    chars: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        ending = LAST.search(text)
        blank = ending is None
        duplicate = repeated and not blank
        cut = not blank and not duplicate and ending[0] not in ".!?"
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.roles.append(role)
        self.texts.append(text)
        self.rows.append((role[:1], blank or duplicate, cut))
        self.chars += len(text)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        if turn is not None:
            self.turns.add(turn)

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.chars >= CHUNK_CHARS


def _totals(chunks: list[dict]) -> dict:
    """Counts of a conversation from those of its chunks, in order; chunks without rows count nothing."""
    kept = [c for c in chunks if c["first"] is not None]
    seams = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(kept, kept[1:], strict=False))
    timed = [c for c in chunks if c["turns"]]
    shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:], strict=False))
    gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - sum(c["turns"] for c in timed) + shared if timed else 0
    return {"gaps": gaps, "illegal": sum(c["illegal"] for c in chunks) + seams} | {k: sum(c[k] for c in chunks) for k in ("blank", "duplicate", "truncated")}


def _lines(roles: list[str], texts: list[str], edits: str, start: int) -> list[str]:
    return [f"{role}:{text}" for role, text in repaired(zip(roles, texts, strict=True), edits, start)]


def _counts(chunk: _Chunk) -> dict:
    turns = sorted(chunk.turns)
    return {
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(turns), "blank": chunk.blank, "duplicate": chunk.duplicate, "truncated": chunk.truncated,
        "illegal": chunk.illegal, "first": chunk.roles[0][:1] if chunk.roles else None, "last": chunk.roles[-1][:1] if chunk.roles else None,
    }


def _table(chunk: _Chunk, starts: Iterable[int], last: bool) -> list[dict]:
    return [{"start": s, "place": p, "cost": c, "edits": e} for (s, p), (c, e) in transfers(chunk.rows, starts, last).items()]


def _tables(tables: list[dict]) -> dict[tuple[int, int], tuple[int, str]]:
    return {(t["start"], t["place"]): (t["cost"], t["edits"]) for t in tables}


#: The end of a conversation: a table without rows that lets rows be put in behind the last.
CLOSING = transfers([], last=True)


def _finished(conv: object, chunks: list[_Chunk]) -> dict:
    """The result of a conversation whose chunks are all here, under the columns of STRUCTURE."""
    tables = [transfers(c.rows, range(4) if i else (START,)) for i, c in enumerate(chunks)]
    cost, path = chained([*tables, CLOSING])
    digest, behind = hashlib.sha256(), b""
    audit = []
    for (start, edits), chunk in zip(path, [*chunks, _Chunk()], strict=True):
        for line in _lines(chunk.roles, chunk.texts, edits, start):
            digest.update(behind + line.encode())
            behind = b"\n"
        audit.append(edits)
    totals = _totals([_counts(c) for c in chunks])
    return {"conv_id": conv, "done": True, **totals, "audit": "".join(audit), "cost": cost, "digest": digest.hexdigest()}


def _arrow(types: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(types))


def _in_task(schema: pa.Schema, rows: int):
    """Conversations of a task's sorted rows: finished ones, and chunks of the first and the last, which may go on in other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        size = 0

        def record() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=schema)

        conv, chunks, opened, before = None, None, True, None

        def ended(last: bool) -> list[dict]:
            """The conversation at hand: its result, or its chunks if it is the first or last here."""
            if chunks is None:
                return []
            if not opened and not last:
                return [_finished(conv, chunks)]
            return [{"conv_id": conv, "part": part, "chunk": i, "done": False, "roles": c.roles, "texts": c.texts, "tables": _table(c, range(4), False), **_counts(c)} for i, c in enumerate(chunks)]

        for batch in batches:
            for id_, turn, role, text, gone, repeat in zip(*(batch[i].to_pylist() for i in range(6)), strict=True):
                if chunks is None or id_ != conv:
                    done, opened = ended(False), chunks is None
                    out += done
                    size += sum(len(d["audit"]) if d["done"] else 64 + sum(map(len, d["texts"])) for d in done)
                    conv, chunks, before = id_, [_Chunk()], None
                    if len(out) >= 1000 or size > CHUNK_CHARS:
                        yield record()
                        out, size = [], 0
                if gone:
                    continue
                if chunks[-1].full(rows):
                    chunks.append(_Chunk())
                chunks[-1].add(turn, role, text, repeat or (turn, role, text) == before)
                before = (turn, role, text)
        for one in ended(True):
            out.append(one)
            if len(one["texts"]) >= rows:
                yield record()
                out = []
        if out:
            yield record()

    return run


RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Faults, cheapest edits and digest of each conversation of ``conversations`` after damage.

    Takes conv_id, turn, role and text; returns the columns of RESULT.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    types = STRUCTURE.format(conv=kind)
    rows = with_repeats(damaged(conversations))
    ordered = rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    ordered = ordered.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    schema = _arrow(types)
    found = materialise(ordered.mapInArrow(_in_task(schema, chunk_rows), types), "conversations")
    finished = found.where("done").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("digest").alias("repaired_sha256"))
    return finished.unionByName(_across(found.where("not done"), kind))


def _across(chunks: DataFrame, kind: str) -> DataFrame:
    """The results of conversations whose chunks lie in several tasks."""
    narrow = chunks.drop("roles", "texts", "done", "gaps", "audit", "cost", "digest")
    path_types = f"conv_id {kind}, part int, chunk int, start int, edits string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    path_schema = _arrow(path_types)

    def chain(table: pa.Table) -> pa.Table:
        own = sorted(table.to_pylist(), key=lambda c: (c["part"], c["chunk"]))
        cost, path = chained([*(_tables(c["tables"]) for c in own), CLOSING])
        totals = _totals(own)
        end = path.pop()
        # what is put in behind the last row belongs to the last chunk
        path[-1] = (path[-1][0], path[-1][1] + end[1])
        rows = [{"conv_id": c["conv_id"], "part": c["part"], "chunk": c["chunk"], "start": start, "edits": edits, "cost": cost, **totals} for c, (start, edits) in zip(own, path, strict=True)]
        return pa.Table.from_pylist(rows, schema=path_schema)

    paths = materialise(narrow.groupBy("conv_id").applyInArrow(chain, path_types), "paths")
    at = ["part", "chunk", "conv_id"]
    same = (F.col("c.part") == F.col("p.part")) & (F.col("c.chunk") == F.col("p.chunk")) & F.col("c.conv_id").eqNullSafe(F.col("p.conv_id"))
    joined = chunks.select(*at, "roles", "texts").alias("c").join(paths.alias("p"), same).select("p.*", "c.roles", "c.texts")
    names = ["conv_id", "part", "chunk", "edits", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    rendered_types = f"{path_types.replace(' start int,', '')}, lines string, empty boolean"
    rendered_schema = _arrow(rendered_types)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                lines = _lines(one["roles"], one["texts"], one["edits"], one["start"])
                yield pa.RecordBatch.from_pylist([{n: one[n] for n in names} | {"lines": "\n".join(lines), "empty": not lines}], schema=rendered_schema)

    rendered = materialise(joined.mapInArrow(render, rendered_types), "rendered")
    result_types = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    result_schema = _arrow(result_types)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass over chunks in order: a conversation's digest goes on from chunk to chunk."""
        current, hashed, audit, empty = None, None, [], True

        def result() -> pa.RecordBatch:
            own = {n: current[n] for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
            return pa.RecordBatch.from_pylist([own | {"audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}], schema=result_schema)

        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                if current is None or one["conv_id"] != current["conv_id"]:
                    if current is not None:
                        yield result()
                    current, hashed, audit, empty = one, hashlib.sha256(), [], True
                if not one["empty"]:
                    hashed.update(("" if empty else "\n").encode() + one["lines"].encode())
                    empty = False
                audit.append(one["edits"])
        if current is not None:
            yield result()

    dealt = rendered.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "chunk")
    return dealt.mapInArrow(digest, result_types)
