"""Hard negatives by a two-dimensional block matrix product.

Rows are dealt into shards, their integer components into chunks of dimensions.  Blocks of anchors go along the row of
the grid, blocks of rows stand in its columns; at each place (anchor block, row block) every chunk gives a partial tile of
int64 scores, which is added to the place's sum as it arises.  Only panels are exchanged, never tiles: an anchor block
goes to each column once, a row block to one task.  The sum is reduced at once: to the nearest rows of an anchor's own
label, then to the first rows of other labels inside the window under each positive, and these are brought together.

Shards follow the labels, so positives are looked for only in the shards of their own bucket of labels, and a frequent
label has as many shards as it needs.  Blocks have about ``ROWS`` and ``ANCHORS`` rows at any size of the input; no task
holds more than a few blocks and one sum.  Work is anchors times rows, as the question is; what a tile sends on is bounded by its anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import drop, written

#: Rows and anchors of a block, dimensions of a chunk.
ROWS, ANCHORS, CHUNK = 1024, 256, 32
#: Squared length of an integer vector from which a score could leave 64 bits: such rows take no part.
LONGEST = float(1 << 56)


def integers(vector: str, scale: int) -> F.Column:
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def _prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``(id, label, v)``: one row of each id, with integer components."""
    size = F.aggregate(F.col(vector_col), F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale), F.lit(2.0)))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    fit = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite).where(size < LONGEST)
    some = fit.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), integers(vector_col, scale).alias("v"))
    return some.groupBy("id").agg(F.min(F.struct("label", "v")).alias("_r")).select("id", "_r.label", "_r.v")


def _padded(rows: pa.StructArray, width: int) -> np.ndarray:
    """The components of some rows as a matrix; what is missing counts as zero."""
    lists = rows.field("v")
    out, flat, ends = np.zeros((len(rows), width), np.int64), lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    for i, (start, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)):
        out[i, : end - start] = flat[start:end]
    return out


_PANEL = "at long, n int, ids binary, labels binary, wanted binary, panel binary"


def _panels(batches: Iterator[pa.RecordBatch], width: int, wanted: int) -> Iterator[pa.RecordBatch]:
    """A row for each block: its ids, labels, components and the ``wanted`` positives."""
    for batch in batches:
        for at, block in zip(batch.column("at").to_pylist(), batch.column("rows"), strict=True):
            rows = block.values
            extra = None
            if wanted:  # per anchor so many ids, then so many scores; absent ones have a negative score, whose window is empty
                pos = np.zeros((len(rows), 2, wanted), np.int64)
                pos[:, 1] = -1
                for i, found in enumerate(rows.field("pos").to_pylist()):
                    for j, p in enumerate(found or ()):
                        pos[i, 0, j], pos[i, 1, j] = p["id"], p["score"]
                extra = pos.tobytes()
            ids, labels = (rows.field(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label"))
            cells = [at, len(rows), ids, labels, extra, _planes(_padded(rows, width))]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, (pa.int64(), pa.int32(), *[pa.binary()] * 4), strict=True)], ["at", "n", "ids", "labels", "wanted", "panel"])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` in 64-bit integers; by doubles where these are exact."""
    longest = [np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    if longest[0] * longest[1] < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _planes(tile: np.ndarray) -> bytes:
    """Bytes of equal weight stand together: those of small numbers compress to nothing."""
    return tile.reshape(-1).view(np.uint8).reshape(-1, 8).T.tobytes()


def _tile(planes: bytes, width: int) -> np.ndarray:
    flat = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64)
    return flat.reshape(-1, width) if width else flat.reshape(0, 0)


def _matrix(row: dict[str, pa.Scalar], panel: str, n: str, width: int) -> np.ndarray:
    return _tile(row[panel].as_buffer(), width) if width else np.zeros((row[n].as_py(), 0), np.int64)


def _places(batches: Iterator[pa.RecordBatch], width: int, chunk: int, reduce: Callable[..., dict[str, np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Each row is a place of the grid: the partial tiles of its chunks are added, and the sum is reduced as soon as it is whole."""
    column, b = None, None
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r] for c in batch.schema.names}
            if row["j"].as_py() != column:  # places come column by column
                column, b = row["j"].as_py(), _matrix(row, "other_panel", "m", width)
            a = _matrix(row, "panel", "n", width)
            total = np.zeros((len(a), len(b)), np.int64)
            for start in range(0, width, chunk):
                total += product(a[:, start : start + chunk], b[:, start : start + chunk])
            meta = {c: np.frombuffer(row[c].as_buffer(), np.int64) if row[c].is_valid else None for c in ("ids", "labels", "wanted", "other_ids", "other_labels")}
            found = reduce(total, **meta)
            if len(found[names[0]]):
                yield pa.RecordBatch.from_arrays([pa.array(found[c], pa.int64()) for c in names], names)


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties to smaller ids."""
    if len(score) > 4 * n:
        edge = np.partition(score, len(score) - n)[len(score) - n]
        some = np.flatnonzero(score >= edge)
        return some[np.lexsort((ids[some], -score[some]))[:n]]
    return np.lexsort((ids, -score))[:n]


def nearest_of_label(tile: np.ndarray, ids, labels, wanted, other_ids, other_labels, count: int) -> dict[str, np.ndarray]:
    """Of each anchor the ``count`` first other rows of its label in a tile."""
    found: list[tuple[int, int, int]] = []
    for r in range(len(ids)):
        some = np.flatnonzero((other_labels == labels[r]) & (other_ids != ids[r]))
        for c in some[_first(tile[r, some], other_ids[some], count)]:
            found.append((ids[r], other_ids[c], tile[r, c]))
    return dict(zip(("anchor", "id", "score"), np.array(found, np.int64).reshape(-1, 3).T, strict=True))


def first_in_windows(tile: np.ndarray, ids, labels, wanted, other_ids, other_labels, count: int, low: int, high: int) -> dict[str, np.ndarray]:
    """Of each anchor and positive the ``count`` first rows of other labels with ``low * positive <= 100 * score <= high * positive``."""
    pos, found = wanted.reshape(len(ids), 2, -1), []
    for r in range(len(ids)):
        other = np.flatnonzero(other_labels != labels[r])
        score = tile[r, other]
        for p, own in zip(*pos[r], strict=True):
            if own >= 0:  # under a negative score the window is empty
                some = other[(100 * score >= low * own) & (100 * score <= high * own)]
                for c in some[_first(tile[r, some], other_ids[some], count)]:
                    found.append((ids[r], p, own, other_ids[c], tile[r, c]))
    return dict(zip(("anchor", "positive", "positive_score", "id", "score"), np.array(found, np.int64).reshape(-1, 5).T, strict=True))


def _summed_tiles(anchors: DataFrame, panels: DataFrame, width: int, chunk: int, reduce: Callable[..., dict[str, np.ndarray]], names: list[str]) -> DataFrame:
    """``anchors`` are panels with the place ``j`` of each row block they meet."""
    own = anchors.select("j", "ids", "labels", "wanted", "panel", "n")
    other = panels.select(F.col("at").alias("j"), F.col("ids").alias("other_ids"), F.col("labels").alias("other_labels"), F.col("panel").alias("other_panel"), F.col("n").alias("m"))
    return own.join(other.hint("merge"), "j").mapInArrow(partial(_places, width=width, chunk=chunk, reduce=reduce, names=names), ", ".join(f"{n} long" for n in names))


def _blocks(rows: DataFrame, width: int, wanted: int = 0) -> DataFrame:
    """The panel of the rows of each block ``at``; blocks have a bounded number of rows."""
    columns = ["id", "label", "v"] + (["pos"] if wanted else [])
    held = rows.groupBy("at").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    return written(held.mapInArrow(partial(_panels, width=width, wanted=wanted), _PANEL), "panels")


def _dealt(rows: DataFrame, buckets: int, most: int) -> DataFrame:
    """Adds ``bucket`` of the label, and ``at``: blocks of about ``most`` rows, numbered bucket by bucket; ``first`` and ``parts`` of its bucket."""
    own = rows.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(buckets)))
    sizes = own.groupBy("bucket").agg(F.ceil(F.count("*") / most).alias("parts"))
    numbered = sizes.withColumn("first", F.sum("parts").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))  # one row for each block's worth of rows
    found = own.join(numbered.withColumn("first", F.coalesce("first", F.lit(0).cast("long"))), "bucket")
    return found.withColumn("at", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")))


def hard_negatives(
    vectors: DataFrame, anchors: str, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, rows: int = ROWS, anchor_rows: int = ANCHORS, chunk: int = CHUNK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows that the condition ``anchors`` on ``id`` picks.

    A score is the inner product of ``floor(scale * x)``.  Rows without id, label or vector, and those with a null or
    non-finite component, take no part, nor do vectors longer than 2**28 after scaling, whose scores could leave 64 bits.  Of rows with one id that of the least
    label, then components, takes part; shorter vectors count as padded with zeros.  Ties go to smaller ids.  Other
    columns are not read; an empty table gives no rows.
    """
    own = written(_prepared(vectors, id_col, vector_col, label_col, scale), "vectors")
    n, width = own.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    buckets = max(1, -(-n // rows))
    dealt = written(_dealt(own, buckets, rows), "dealt")
    grid = _blocks(dealt.select("at", "id", "label", "v"), width)
    picked = dealt.where(anchors)
    number = picked.count()
    # positives: anchors in blocks of their bucket meet the shards of that bucket
    near = picked.withColumnsRenamed({"at": "_at", "first": "_first", "parts": "_parts"})
    sizes = near.groupBy("bucket").agg(F.ceil(F.count("*") / anchor_rows).alias("_n"), F.min("_first").alias("from"), F.max("_parts").alias("to"))
    placed = near.join(sizes, "bucket").withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_n")))
    own_blocks = _blocks(placed.select((F.col("bucket") * (1 << 32) + F.col("_part")).alias("at"), "id", "label", "v"), width)
    where = sizes.select(F.col("bucket").alias("_b"), "from", "to")
    along = own_blocks.join(where, F.shiftright("at", 32) == F.col("_b")).select(F.explode(F.sequence("from", F.col("from") + F.col("to") - 1)).alias("j"), "ids", "labels", "wanted", "panel", "n")
    tiles = _summed_tiles(along, grid, width, chunk, partial(nearest_of_label, count=positives), ["anchor", "id", "score"])
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = tiles.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= positives)
    found = written(first.groupBy("anchor").agg(F.collect_list(F.struct("id", "score")).alias("pos")), "positives")
    # negatives: every block of anchors with its windows meets every shard
    wide = picked.select("id", "label", "v").join(found.withColumnRenamed("anchor", "id"), "id")
    parts = max(1, -(-number // anchor_rows))
    all_blocks = _blocks(wide.select(F.pmod(F.xxhash64("id"), F.lit(parts)).alias("at"), "id", "label", "v", "pos"), width, positives)
    shards = dealt.agg(F.coalesce(F.max("at"), F.lit(-1))).first()[0] + 1
    across = all_blocks.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("j"), "ids", "labels", "wanted", "panel", "n")
    if not shards:
        across = across.limit(0)
    names = ["anchor", "positive", "positive_score", "id", "score"]
    inside = _summed_tiles(across, grid, width, chunk, partial(first_in_windows, count=negatives, low=low, high=high), names)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    best = written(inside.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives), "negatives")
    drop(own, dealt, grid, own_blocks, found, all_blocks)
    return best.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
