"""Near copies by SimHash's Gray-order index, MinHash keys and the exact similarity of their word shingles.

Two texts link when the sets of their shingles of five words have a Jaccard similarity of 0.8 at least.
Candidates come from two indexes.  The Gray-order index of ``simhash`` finds texts whose fingerprints differ in at most two
bits; each is held against the least text of its group.  Pairs near 0.8 differ by up to 11 bits and more, and ranges for
so many bits are too short to be exchange keys, so these meet under ``BANDS`` keys, each of ``ROWS`` least values (MinHash): a
pair of similarity s meets with probability 1 - (1 - s**6)**32, which is 0.99994 at 0.8 and more above.

Every candidate is verified on the whole texts.  First each text is held against the least text of its fingerprints' group
and of its keys; then all pairs under one key that the links so far leave in different components, so a chain whose ends are
unlike is found too.  The texts of such a key are dealt into blocks, and a task holds two blocks at a time: it counts what
all their pairs share by products of matrices and gives at most one link a text, so that rows grow with texts times blocks, not with pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .grouped import by_group
from .scratch import drop, written
from .simhash import fingerprinted, links, one_of_each, shingle_hashes

WIDTH, BANDS, ROWS = 5, 32, 6
#: Similarity that links, as a fraction.
SHARE = (4, 5)
_FACTORS, _SHIFTS = np.random.default_rng(42).integers(0, 1 << 32, (2, BANDS * ROWS), np.uint32)
_FACTORS |= np.uint32(1)
_CHUNK, _BATCH = 4096, 256
#: Shingles that a task remembers.
_KNOWN = 1_000_000
#: Texts and shingles that a block of the texts under one key holds, about.
BLOCK, _HELD = 256, 1 << 17
_LAST = np.iinfo(np.int64).max


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """``BANDS`` keys of a set of shingle hashes; the same for all empty sets."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _CHUNK):
        np.minimum(least, (short[at : at + _CHUNK, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(at, _BATCH)
            sets = [np.unique(shingle_hashes(t, WIDTH)) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            keys = np.concatenate([band_keys(s) for s in sets]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_h"), pa.array(map(len, sets), pa.int64()), lists], ["_id", "_h", "_size", "_keys"])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles reach ``SHARE``; empty sets are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SHARE[1] * both >= SHARE[0] * (len(a) + len(b) - both)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}
    held = 0

    def sets(nodes: list[int], texts: pa.Array) -> list[np.ndarray]:
        nonlocal held
        for i, node in enumerate(nodes):
            if node not in known:
                known[node] = np.unique(shingle_hashes(texts[i].as_py(), WIDTH))
                held += len(known[node])
        return [known[node] for node in nodes]

    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(at, _BATCH)
            left, right = (sets(batch.column(node).to_pylist(), batch.column(text).cast(pa.binary())) for node, text in (("a", "_left"), ("b", "_right")))
            some = pa.array([alike(x, y) for x, y in zip(left, right, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(some), batch.column("b").filter(some)], ["a", "b"])
            if held > _KNOWN:  # bounded memory: the task begins anew
                known.clear()
                held = 0


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose whole texts are alike."""
    left, right = texts.toDF("a", "_left"), texts.toDF("b", "_right")
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "_left", "_right").mapInArrow(_verified, "a long, b long")


def gray_pairs(marked: DataFrame) -> DataFrame:
    """``(a, b)`` from ``marked(_h, _fp)``: each text with the least of those that the Gray-order index links it to."""
    once = marked.select("_h", "_fp").distinct()
    roots = written(components(links(once.select("_fp").distinct())), "roots")
    grouped = once.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left").select("_h", F.coalesce("root", "_fp").alias("_group"))
    least = grouped.groupBy("_group").agg(F.min("_h").alias("b"), F.count("*").alias("n")).where("n > 1").select("_group", "b")
    return grouped.join(least, "_group").where(F.col("_h") != F.col("b")).select(F.col("_h").alias("a"), "b")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of shingles that the sets ``left`` have in common with the sets ``right``."""
    every, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[which]  # a shingle of one set is shared with none
    row = np.repeat(np.arange(len(sets)), [*map(len, sets)])[number >= 0]
    number = number[number >= 0]
    order = np.argsort(number)
    row, number = row[order], number[order]
    both = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int((count > 1).sum()), _CHUNK):
        a, b = np.searchsorted(number, [at, at + _CHUNK])
        ones = np.zeros((len(sets), _CHUNK), np.float32)
        ones[row[a:b], number[a:b] - at] = 1
        both += (ones[left] @ ones[right].T).astype(np.int64)  # up to 4,096, so exact
    return both


def _tile(group: pa.Table) -> pa.Table:
    """Each text of two blocks with the least text that links between the blocks lead to; those that lead to none have no row."""
    node, root, own, i, j = (group.column(c).to_numpy() for c in ("_h", "_root", "_own", "_i", "_j"))
    left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
    label = node.copy()
    if len(left) and len(right):
        sets = [np.unique(shingle_hashes(t, WIDTH)) for t in group.column("_text").cast(pa.binary()).to_pylist()]
        size = np.array([*map(len, sets)])
        both = shared_counts(sets, left, right)
        linked = SHARE[1] * both >= SHARE[0] * (size[left][:, None] + size[right] - both)
        linked &= root[left][:, None] != root[right]
        before = None
        while linked.any() and not np.array_equal(label, before):
            before = label.copy()
            label[left] = np.minimum(label[left], np.where(linked, label[right], _LAST).min(axis=1))
            label[right] = np.minimum(label[right], np.where(linked, label[left][:, None], _LAST).min(axis=0))
    some = label != node
    return pa.table({"a": node[some], "b": label[some]})


def links_across(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b)`` from ``rows(_key, _h, _size, _root)``: links that bring together all texts under one key that are alike and have different roots."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("_size") / _HELD), F.lit(1))
    dealt = rows.join(rows.groupBy("_key").agg(blocks.alias("_blocks")), "_key").withColumn("_own", F.expr("pmod(xxhash64(_h), _blocks)"))
    tiles = dealt.select("_key", "_h", "_root", "_own", F.explode(F.expr("sequence(0L, _blocks - 1)")).alias("_with"))
    tiles = tiles.select("_key", "_h", "_root", "_own", F.least("_own", "_with").alias("_i"), F.greatest("_own", "_with").alias("_j"))
    return by_group(tiles.join(texts.hint("merge"), "_h"), ["_key", "_i", "_j"], _tile, "a long, b long").distinct()


def _sizes_fit() -> F.Column:
    """Sets whose sizes differ by more than the share can't reach it."""
    return F.least("_size", "_other") * SHARE[1] >= F.greatest("_size", "_other") * SHARE[0]


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``(_id, _h, root)``; near copies, and what they link, share a root.

    Null texts count as empty, and texts without a word are alike; ids may be null or repeated; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))
    rows = written(source.mapInArrow(_sketched, "_id long, _h long, _size long, _keys array<long>"), "sketches", _BATCH)
    once = rows.groupBy("_h").agg(F.min("_size").alias("_size"), F.min("_keys").alias("_keys"))
    every = once.select("_h", "_size", F.explode("_keys").alias("_key"))
    least = every.groupBy("_key").agg(F.min(F.struct("_h", "_size")).alias("m"), F.count("*").alias("n")).where("n > 1").select("_key", F.col("m._h").alias("b"), F.col("m._size").alias("_other"))
    met = written(every.join(least, "_key"), "met")
    marked = fingerprinted(docs, id_col, text_col)
    under_keys = met.where((F.col("_h") != F.col("b")) & _sizes_fit()).select(F.col("_h").alias("a"), "b")
    first = written(under_keys.union(gray_pairs(marked)).distinct(), "pairs")
    wanted = met.select("_h").union(first.select("a")).union(first.select("b")).distinct()
    texts = source.select("_h", "_text").join(wanted, "_h", "left_semi").groupBy("_h").agg(F.first("_text").alias("_text"))
    texts = written(texts, "texts")
    found = written(_links(first, texts), "links", _BATCH)
    # keys that the first links leave in more than one component: all pairs across these
    roots = written(components(found), "roots")
    labelled = met.join(roots.withColumnRenamed("node", "_h"), "_h", "left").select("_key", "_h", "_size", F.coalesce("root", "_h").alias("_root"))
    several = labelled.groupBy("_key").agg(F.min("_root").alias("x"), F.max("_root").alias("y")).where("x < y").select("_key")
    open_rows = written(labelled.join(several, "_key"), "open")
    more = written(links_across(open_rows, texts), "links", _BATCH)
    rooted = components(found.union(more)).select(F.col("node").alias("_h"), "root")
    drop(met, marked, first, texts, found, roots, open_rows, more)
    return rows.select("_id", "_h").join(rooted, "_h", "left").select("_id", "_h", F.coalesce("root", "_h").alias("root"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, that of the least id; columns as they were."""
    return one_of_each(docs, near_copies(docs, id_col, text_col), id_col, text_col)
