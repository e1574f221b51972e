"""Hard negatives of a stated set of anchors against all rows, by exact integer products.

Anchors meet candidates in tiles. A tile's scores are one matrix product by Strassen's recursion on
int64, odd sides padded with zeros; additions wrap modulo 2**64, a ring, so whatever fits in 64 bits
at the end is exact. Each task keeps a heap for each anchor (its positives) or for each anchor and
positive (a window of scores); heaps of tiles and of tasks merge.

Candidates are packed into tiles once. Anchors go through them in waves of bounded bytes: a wave is
read by the driver and broadcast, its positives too, so neither grows with the corpus; the number of
waves does. Each wave scans all tiles twice, for positives and for windows, since a window needs
all positives. A wave's result is written, so what follows doesn't hang on its executors.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part. Rows without an id may be found, last among ties, but are never anchors. Repeated rows are rows of their own:
copies of an anchor are anchors, and each one's copies are its positives. Shorter vectors are padded
with zeros. An empty table, or one without anchors, gives no rows. Further columns aren't read.
Components whose products leave 64 bits give scores modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import scratch_path
from .common import materialise

#: A product with a side of at most so many isn't split further.
LEAF = 32
#: Candidates of a tile, and anchors that meet it at once.
TILE, BLOCK = 2048, 512
#: Bytes of the anchors of one wave.
WAVE_BYTES = 32 << 20
#: Multiplications of one task, about.
WORK = 50_000_000_000


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``: ``a`` by ``b`` transposed, by seven products of halves, recursively."""
    (m, k), n = a.shape, b.shape[0]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,jk->ij", a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, n % 2), (0, k % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[0] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:h, :j], b[h:, :j], b[:h, j:], b[h:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * h), np.int64)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The first ``most`` entries of each slot: by score from high to low, then id (none last), then row."""

    FIELDS = ("slot", "score", "id", "none", "row")

    def __init__(self, slots: int, most: int):
        self.slots, self.most = slots, most
        self.entries = {f: np.zeros(0, bool if f == "none" else np.int64) for f in self.FIELDS}
        #: the score below which a full slot takes nothing more
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def merge(self, **entries: np.ndarray) -> None:
        """Take the entries of another set of heaps, or loose ones."""
        if not len(entries["slot"]):
            return
        both = {f: np.concatenate([self.entries[f], entries[f]]) for f in self.FIELDS}
        # the complement turns the order round without leaving 64 bits
        order = np.lexsort([both["row"], both["id"], both["none"], ~both["score"], both["slot"]])
        slot = both["slot"][order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = order[place < self.most]
        self.entries = {f: v[kept] for f, v in both.items()}
        full = order[place == self.most - 1]
        self.least[both["slot"][full]] = both["score"][full]


def eligible(vectors: DataFrame, scale: int, anchor: Column, vec: str = "embedding") -> DataFrame:
    """id, label, row, anchor and the integer components of the rows that take part."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    parts = F.transform(vec, lambda x: F.floor(scale * x.cast("double")).cast("long"))
    chosen = vectors.where(F.col("label").isNotNull() & F.col(vec).isNotNull()).where(sound)
    return chosen.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.monotonically_increasing_id().alias("row"), F.coalesce(anchor, F.lit(False)).alias("anchor"), parts.alias("parts"))


def _matrix(parts: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as rows of a matrix, shorter ones padded with zeros."""
    out = np.zeros((len(parts), width), np.int64)
    sizes = parts.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = parts.flatten().to_numpy(zero_copy_only=False)
    return out


def _pack(width: int):
    """Rows into tiles: the ids, labels, rows and components of up to TILE of them as binary values."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                b = batch.slice(at, TILE)
                none = b["id"].is_null().to_numpy(zero_copy_only=False)
                columns = {"id": b["id"].fill_null(np.iinfo(np.int64).max).to_numpy(), "none": none, "label": b["label"].to_numpy(), "row": b["row"].to_numpy(), "parts": _matrix(b["parts"], width)}
                yield pa.record_batch({"tile": pa.array([int(columns["row"][0])]), "n": pa.array([b.num_rows])} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})

    return packed


TILE_TYPES = "tile long, n long, id binary, none binary, label binary, row binary, parts binary"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        for tile in batch.to_pylist():
            n = tile["n"]
            out = {k: np.frombuffer(tile[k], bool if k == "none" else np.int64) for k in ("id", "none", "label", "row")}
            yield out | {"parts": np.frombuffer(tile["parts"], np.int64).reshape(n, -1)}


def _meet(anchors: dict[str, np.ndarray], tile: dict[str, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first anchor of each block, the block's scores against the tile, and where labels are equal."""
    for at in range(0, len(anchors["row"]), BLOCK):
        block = slice(at, at + BLOCK)
        yield at, strassen(anchors["parts"][block], tile["parts"]), anchors["label"][block, None] == tile["label"]


def _found(slots: np.ndarray, columns: np.ndarray, scores: np.ndarray, tile: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {"slot": slots, "score": scores} | {k: tile[k][columns] for k in ("id", "none", "row")}


def _positives(anchors: dict[str, np.ndarray], batches: Iterator[pa.RecordBatch], most: int) -> Heaps:
    heaps = Heaps(len(anchors["row"]), most)
    for tile in _tiles(batches):
        for at, scores, same in _meet(anchors, tile):
            rows = slice(at, at + len(scores))
            open_ = same & (scores >= heaps.least[rows, None]) & (anchors["row"][rows, None] != tile["row"])
            i, j = np.nonzero(open_)
            heaps.merge(**_found(at + i, j, scores[i, j], tile))
    return heaps


def _windows(anchors: dict[str, np.ndarray], batches: Iterator[pa.RecordBatch], low: int, high: int, most: int, positives: int) -> Heaps:
    """The negatives of each anchor's positives: slot is anchor times ``positives`` plus the positive's place."""
    heaps = Heaps(len(anchors["row"]) * positives, most)
    for tile in _tiles(batches):
        for at, scores, same in _meet(anchors, tile):
            rows = np.arange(at, at + len(scores))
            for k in range(positives):
                target, slots = anchors["score"][rows, k, None], rows * positives + k
                open_ = ~same & anchors["has"][rows, k, None] & (low * target <= 100 * scores) & (100 * scores <= high * target) & (scores >= heaps.least[slots, None])
                i, j = np.nonzero(open_)
                heaps.merge(**_found(slots[i], j, scores[i, j], tile))
    return heaps


HEAP_TYPES = "slot long, score long, id long, none boolean, row long"


def _merged(entries: DataFrame, most: int) -> DataFrame:
    """Heaps of all tasks as one: Spark cuts each task's to ``most`` before it shuffles them."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "none", "id", "row")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).withColumn("id", F.when(~F.col("none"), F.col("id")))


def _wave(tiles: DataFrame, rows: DataFrame, width: int, tasks: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result of the anchors ``rows``, few enough for every task."""
    spark = tiles.sparkSession
    table = rows.orderBy("row").toArrow()
    anchors = {k: table[k].to_numpy() for k in ("row", "label")} | {"parts": _matrix(table["parts"].combine_chunks(), width)}
    shared = spark.sparkContext.broadcast(anchors)
    dealt = tiles.repartition(tasks, "tile")

    def arrow(heaps: Heaps) -> pa.RecordBatch:
        return pa.record_batch({f: pa.array(v) for f, v in heaps.entries.items()})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield arrow(_positives(shared.value, batches, positives))

    best = _merged(dealt.mapInArrow(first, HEAP_TYPES), positives).orderBy("slot", "rank").toArrow()
    slot, place = best["slot"].to_numpy(), best["rank"].to_numpy() - 1
    targets = {"score": np.zeros((len(anchors["row"]), positives), np.int64), "has": np.zeros((len(anchors["row"]), positives), bool)}
    targets["score"][slot, place], targets["has"][slot, place] = best["score"].to_numpy(), True
    aims = spark.sparkContext.broadcast(targets)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield arrow(_windows(shared.value | aims.value, batches, low, high, negatives, positives))

    found = _merged(dealt.mapInArrow(second, HEAP_TYPES), negatives)
    named = pa.table({"slot": slot * positives + place, "anchor_id": table["id"].combine_chunks().take(pa.array(slot)), "positive_id": best["id"], "positive_score": best["score"]})
    # a row for each positive of the wave
    pairs = spark.createDataFrame(named)
    columns = ["anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
    return found.join(F.broadcast(pairs), "slot").select(*columns)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """For each anchor and each of its first positives, the first negatives within the positive's window.

    ``vectors`` has vec_id, label and embedding; ``anchor`` says which rows are anchors. A row's
    score is the inner product of the components floor(scale * x) with the anchor's. Positives are
    the other rows of the anchor's label, negatives those of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Higher scores come first,
    ties by smaller id.
    """
    spark = vectors.sparkSession
    rows = materialise(eligible(vectors, scale, anchor), "vectors")
    count, chosen, width = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("parts"))).first()
    if not chosen:
        return spark.createDataFrame([], RESULT)
    width = max(width, 1)
    tiles = materialise(rows.select("id", "label", "row", "parts").mapInArrow(_pack(width), TILE_TYPES), "tiles")
    waves = -(-chosen * width * 8 // wave_bytes)
    tasks = max(spark.sparkContext.defaultParallelism, -(-count * chosen * width // (waves * WORK)))
    dealt = rows.where("anchor").withColumn("wave", F.pmod(F.xxhash64("row"), F.lit(waves)))
    path = scratch_path(spark, "negatives")
    for w in range(waves):
        few = dealt.where(F.col("wave") == w)
        if waves == 1 or not few.isEmpty():
            found = _wave(tiles, few.select("id", "label", "row", "parts"), width, tasks, positives, negatives, low, high)
            found.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
