"""Similarity join of documents on their sets of word shingles, by grouped prefixes.

Every set is put in one total order that begins with its rarest shingles.  Two sets of the wanted similarity share a
shingle of their prefixes, so only prefixes are exchanged.  Sets with the same prefix and size are one group and are
exchanged once; pairs of groups that meet are filtered by size and position, then expanded to their members, whose
parity bitmaps bound the difference of two sets from below.  What passes is verified on the whole sets.

The order comes from ``BUCKETS`` counters of all shingles of all texts, a table of fixed size: any total order gives right results, this
one keeps shingles that many texts share out of prefixes.  Under one shingle each member is first held against the
least; then components that are still apart ask for their nearest pairs, more in each round, until none is left unasked.
So a large group of near copies costs about its size, and no pair that may link goes unverified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .scratch import drop, written

WIDTH = 3
#: Similarity that links, as a fraction of small numbers.
SHARE = (9, 10)
#: Counters that order the shingles, and the parts in which tasks send them.
BUCKETS, SLICES = 1 << 20, 256
#: Bits of the filter that keeps unwanted texts out of an exchange.
FILTER = 1 << 26
#: Members of a shingle beyond which its pairs are dealt over tasks by blocks.
SPLIT = 20_000
#: Bits of a parity bitmap; pairs that a component may ask for in its first round, and their growth by round.
_BITS, _QUOTA, _MORE = 1024, 8, 8
_ROWS, _TOGETHER, _PAIRS = 256, 20_000, 200_000
#: Shingles that a task remembers.
_KNOWN = 4_000_000
_FACTORS = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)))
_MIX, _HALF, _TOP = np.uint64(0xD6E8FEB86659FD93), np.uint64(32), np.uint64(44)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; with fewer words that of the whole sequence, without any none."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    found = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        found = _mixed(found * _FACTORS[i % 3] + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(found)


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            yield batch, [shingle_set(t) for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for _, sets in _texts(batches, "_text"):
        flat = np.concatenate(sets)
        counts += np.bincount((flat >> _TOP).astype(np.int64), minlength=BUCKETS)
    if counts.any():
        parts = [p.tobytes() for p in counts.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(part.as_buffer(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())], ["slice", "counts"])


def _levels(source: DataFrame) -> np.ndarray:
    """How often the shingles of each bucket occur, on a logarithmic scale of bytes: ``BUCKETS`` bytes, whatever the input."""
    parts = source.mapInArrow(_counted, "slice int, counts binary").repartition(64, "slice").mapInArrow(_summed, "slice int, counts binary")
    counts = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    for r in parts.collect():  # a table of fixed size
        counts[r.slice] = np.frombuffer(r.counts, np.int64)
    return np.minimum(np.round(8 * np.log2(counts.ravel() + 1)), 255).astype(np.uint8)


def prefix_length(n: int) -> int:
    return n + (-n * SHARE[0]) // SHARE[1] + 1


def _sketcher(levels: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _texts(batches, "_text"):
            nodes, groups, prefixes, bits = [], [], [], []
            for x in sets:
                if not len(x):
                    for column in (nodes, groups, prefixes, bits):
                        column.append(None)
                    continue
                first = x[np.lexsort((x, levels[(x >> _TOP).astype(np.int64)]))[: prefix_length(len(x))]]
                nodes.append(xxhash.xxh3_128_digest(x.tobytes()))
                groups.append(xxhash.xxh3_128_digest(first.tobytes(), len(x)))
                prefixes.append(first.view(np.int64))
                bits.append(np.packbits(np.bincount((x % np.uint64(_BITS)).astype(np.int64), minlength=_BITS).astype(np.uint8) & 1).tobytes())
            columns = [pa.array(map(len, sets), pa.int64()), pa.array(nodes, pa.binary()), pa.array(groups, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_t"), *columns], ["_id", "_t", "_n", "_node", "_group", "_prefix", "_bits"])

    return sketched


_SKETCH = "_id long, _t binary, _n long, _node binary, _group binary, _prefix array<long>, _bits binary"


def candidates(n: np.ndarray, pos: np.ndarray, bits: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of index pairs those that may link, by size, position in the prefix and bitmap; and the least difference of each."""
    a, b = SHARE
    small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
    most = np.minimum(pos[left], pos[right]) + 1 + np.minimum(n[left] - pos[left], n[right] - pos[right]) - 1
    some = np.flatnonzero((b * small >= a * large) & ((a + b) * most >= a * (small + large)))
    apart = np.bitwise_count(bits[left[some]] ^ bits[right[some]]).sum(axis=1, dtype=np.int64)
    fit = (a + b) * apart <= (b - a) * (n[left[some]] + n[right[some]])
    return some[fit], apart[fit]


def _nearest(n: np.ndarray, pos: np.ndarray, bits: np.ndarray, root: np.ndarray, quota: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs over different roots that may link, of each root the ``quota`` nearest; and whether a root has more."""
    held, more, m = [np.empty((0, 3), np.int64)], False, len(n)

    def cut(rows: np.ndarray) -> np.ndarray:
        nonlocal more
        keep = np.zeros(len(rows), bool)
        for end in (0, 1):
            order = np.lexsort((rows[:, 1], rows[:, 0], rows[:, 2], root[rows[:, end]]))
            of = root[rows[order, end]]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, np.int64)
            place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
            keep[order[place < quota]] = True
        more = more or not keep.all()
        return rows[keep]

    step = max(1, _PAIRS // m)
    for at in range(0, m, step):
        left, right = np.meshgrid(np.arange(at, min(at + step, m)), np.arange(m), indexing="ij")
        some = (left < right) & (root[left] != root[right])
        left, right = left[some], right[some]
        fit, apart = candidates(n, pos, bits, left, right)
        held.append(np.stack([left[fit], right[fit], apart], axis=1))
        if sum(map(len, held)) > _PAIRS:
            held = [cut(np.concatenate(held))]
    found = cut(np.concatenate(held))
    return found[:, 0], found[:, 1], more


def _asker(quota: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Under each key the ``quota`` nearest pairs of each root over different roots."""

    def of_key(rows: pa.Table) -> pa.RecordBatch | None:
        nodes = rows.column("_node").to_pylist()
        if len(nodes) < 2:
            return None
        n, pos = (rows.column(c).to_numpy() for c in ("_n", "_pos"))
        bits = np.frombuffer(b"".join(rows.column("_bits").to_pylist()), np.uint64).reshape(len(n), -1)
        root = np.unique(np.array([r.hex() for r in rows.column("_root").to_pylist()]), return_inverse=True)[1]
        left, right, more = _nearest(n, pos, bits, root, quota)
        if not len(left):
            return None
        a, b = zip(*(sorted((nodes[i], nodes[j])) for i, j in zip(left.tolist(), right.tolist(), strict=True)), strict=True)
        key = rows.column("_key")[0].as_py()
        return pa.RecordBatch.from_arrays([pa.array([key] * len(a), pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([more] * len(a))], ["_key", "a", "b", "more"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key and block and are taken whole ones at a time."""
        held, n = [], 0

        def taken(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            key, block = (table.column(c).to_numpy() for c in ("_key", "_block"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            ends = [0, *cuts.tolist(), *([len(key)] if last else [])]
            for i, j in zip(ends, ends[1:], strict=False):
                if j - i > 1 and (found := of_key(table.slice(i, j - i))):
                    yield found
            if not last:
                held.append(table.slice(ends[-1]))

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
            if n >= _TOGETHER:
                whole, held, n = pa.concat_tables(held).combine_chunks(), [], 0
                yield from taken(whole, False)
        if held:
            yield from taken(pa.concat_tables(held).combine_chunks(), True)

    return asked


def _asked(met: DataFrame, quota: int, split: int) -> DataFrame:
    """Pairs ``(_key, a, b, more)`` to verify; keys of many members are dealt by pairs of blocks of at most about ``split`` rows each."""
    many = met.groupBy("_key").agg(F.count("*").alias("_m")).where(F.col("_m") > split)
    parts = F.ceil(F.col("_m") * 2 / split).cast("int")
    dealt = met.join(many, "_key", "left").withColumn("_parts", F.coalesce(parts, F.lit(1)))
    own = F.pmod(F.hash("_node"), F.col("_parts"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda other: F.least(own, other).cast("long") * F.col("_parts") + F.greatest(own, other))
    rows = dealt.withColumn("_block", F.explode(pairs)).drop("_m", "_parts")
    return rows.repartition("_key", "_block").sortWithinPartitions("_key", "_block").mapInArrow(_asker(quota), "_key long, a binary, b binary, more boolean")


def _starred(met: DataFrame) -> DataFrame:
    """Each member of a key beside the key's least node, as pairs that may link; no key has to come together."""
    first = met.groupBy("_key").agg(F.min(F.struct("_node", "_n", "_pos", "_bits")).alias("_least"))
    both = met.join(first, "_key").where(F.col("_node") != F.col("_least._node"))
    flat = both.select("_key", "_node", "_n", "_pos", "_bits", *(F.col(f"_least.{c}").alias(f"_o{c}") for c in ("_node", "_n", "_pos", "_bits")))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if m := b.num_rows:
                n, pos = (np.concatenate([b.column(c).to_numpy(), b.column(f"_o{c}").to_numpy()]) for c in ("_n", "_pos"))
                bits = np.frombuffer(b"".join(b.column("_bits").to_pylist() + b.column("_o_bits").to_pylist()), np.uint64).reshape(2 * m, -1)
                fit = pa.array(candidates(n, pos, bits, np.arange(m), np.arange(m, 2 * m))[0])
                yield pa.RecordBatch.from_arrays([b.column("_o_node").take(fit), b.column("_node").take(fit)], ["a", "b"])  # the least comes first

    return flat.mapInArrow(passed, "a binary, b binary")


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach ``SHARE``."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return SHARE[1] * both >= SHARE[0] * (len(x) + len(y) - both)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, np.ndarray] = {}

    def sets(nodes: list[bytes], texts: pa.Array) -> list[np.ndarray]:
        for node, text in zip(nodes, texts, strict=True):
            if node not in known:
                known[node] = shingle_set(text.as_py())
        return [known[node] for node in nodes]

    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            left, right = (sets(batch.column(node).to_pylist(), batch.column(text).cast(pa.binary())) for node, text in (("a", "_left"), ("b", "_right")))
            some = pa.array([alike(x, y) for x, y in zip(left, right, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(some), batch.column("b").filter(some)], ["a", "b"])
            if sum(map(len, known.values())) > _KNOWN:  # bounded memory: the task begins anew
                known.clear()


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets, made anew from whole texts, are alike."""
    nodes = pairs.select(F.col("a").alias("_node")).union(pairs.select("b")).distinct()
    wanted = texts.join(nodes, "_node", "left_semi")
    left, right = wanted.toDF("a", "_left"), wanted.toDF("b", "_right")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_left", "_right").mapInArrow(_verified, "a binary, b binary")


def _members(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``met``: a row for each member under each prefix shingle that it shares; ``(_node, _t)``: a text of each distinct set.

    Groups go by 64 bits here: two that share them only meet more often.
    """
    some = rows.where("_n > 0").withColumn("_group", F.xxhash64("_group"))
    groups = some.groupBy("_group", "_n").agg(F.first("_prefix").alias("_prefix"), F.count_distinct("_node").alias("_many"))
    postings = groups.select("_group", "_n", "_many", F.posexplode("_prefix").alias("_pos", "_key"))
    shared = postings.groupBy("_key").agg(F.count("*").alias("_of")).where("_of > 1").select("_key", F.lit(True).alias("_shared"))
    # members of one group share all of their prefix, one shingle is enough for them
    kept = postings.join(shared, "_key", "left").where("_shared or (_many > 1 and _pos = 0)")
    by_size, (a, b) = Window.partitionBy("_key").orderBy("_n"), SHARE
    beside = (b * F.lag("_n").over(by_size) >= a * F.col("_n")) | (b * F.col("_n") >= a * F.lead("_n").over(by_size))
    kept = kept.withColumn("_beside", F.coalesce(beside, F.lit(False)))  # the next in size is near enough if any is
    kept = kept.where("_beside or (_many > 1 and _pos = 0)")
    # shingles that the same groups share are one key: near copies meet once, not under each
    of_key = Window.partitionBy("_key")
    lists = [F.bit_xor(F.xxhash64("_group", F.lit(i))).over(of_key).alias(f"_x{i}") for i in (0, 1)]
    kept = kept.select("_group", "_n", "_pos", F.count("*").over(of_key).alias("_of"), *lists).groupBy("_of", "_x0", "_x1", "_group", "_n").agg(F.min("_pos").cast("long").alias("_pos"))
    kept = kept.select(F.xxhash64("_of", "_x0", "_x1").alias("_key"), "_group", "_n", "_pos")
    nodes = some.groupBy("_node").agg(F.first("_group").alias("_group"), F.first("_n").alias("_n"), F.first("_bits").alias("_bits"), F.min("_t").alias("_t"))
    return kept.join(nodes.select("_node", "_group", "_n", "_bits"), ["_group", "_n"]).select("_key", "_node", "_n", "_pos", "_bits"), nodes.select("_node", "_t")


def _sifted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Without most of the texts that are not wanted, before they are exchanged: by one bit of ``FILTER`` for each digest."""
    place = F.pmod(F.xxhash64("_t"), F.lit(FILTER))
    part, bit = F.floor(place / 32768), F.pmod(place, F.lit(32768))
    bits = wanted.groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(bit).alias("_bitmap"))
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = texts.withColumn("_part", part).withColumn("_bit", bit).join(F.broadcast(bits), "_part")  # 8 MB at most
    return found.where(F.floor(byte / F.pow(F.lit(2), F.col("_bit") % 8)) % 2 == 1).select("_t", "_text")


def _with_sets(sets: DataFrame | None, pairs: DataFrame, named: DataFrame, texts: DataFrame) -> DataFrame:
    """``(_node, _text)`` of all nodes of ``pairs`` and of those in ``sets``; only texts that some pair needs are fetched."""
    nodes = pairs.select(F.col("a").alias("_node")).union(pairs.select("b")).distinct()
    if sets is not None:
        nodes = written(nodes.join(sets, "_node", "left_anti"), "nodes")
        if not nodes.limit(1).count():
            drop(nodes)
            return sets
    wanted = written(named.join(nodes, "_node", "left_semi"), "wanted")
    made = written(wanted.join(_sifted(texts, wanted), "_t").dropDuplicates(["_t", "_node"]).select("_node", "_text"), "texts")
    drop(wanted)
    if sets is None:
        return made
    both = written(sets.union(made), "texts")
    drop(sets, made, nodes)
    return both


def linked_sets(rows: DataFrame, texts: DataFrame, split: int = SPLIT) -> DataFrame:
    """``(node, root)`` for each distinct set that links with another; ``rows`` are sketches, ``texts(_t, _text)`` the texts by digest."""
    found, named = _members(rows)
    met = written(found, "met")
    asked = written(_starred(met).distinct(), "pairs")
    sets = _with_sets(None, asked, named, texts)
    links = written(_links(asked, sets), "links")
    roots, quota, least = components(links), _QUOTA, 3  # of two members all pairs have been asked
    while True:
        rooted = met.join(roots.withColumnRenamed("node", "_node"), "_node", "left").withColumn("_root", F.coalesce("root", "_node")).drop("root")
        apart = rooted.groupBy("_key").agg(F.min("_root").alias("_x"), F.max("_root").alias("_y"), F.count("*").alias("_m")).where((F.col("_x") < F.col("_y")) & (F.col("_m") >= least)).select("_key")
        pairs = written(_asked(rooted.join(apart, "_key"), quota, split), "asked")
        new = written(pairs.select("a", "b").distinct().join(asked, ["a", "b"], "left_anti"), "pairs")
        open_keys = pairs.where("more").select("_key").distinct()
        if new.limit(1).count():
            sets = _with_sets(sets, new, named, texts)
            more_links = written(_links(new, sets), "links")
            if more_links.limit(1).count():
                before, links = links, written(links.union(more_links), "links")
                old, roots = roots, components(links)
                drop(before, old)
            drop(more_links)
        if not open_keys.limit(1).count():
            drop(met, sets, asked, pairs, new, links)
            return roots
        before, met = met, written(met.join(open_keys, "_key", "left_semi"), "met")
        was, asked = asked, written(asked.union(new), "pairs")
        drop(before, was, pairs, new)
        quota *= _MORE


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT) -> DataFrame:
    """A row for each row of ``docs``: ``(_id, n_shingles, component)``, the size of its set and the least id that links reach.

    Null and blank texts have an empty set and are linked with nothing.  Equal sets always link, whatever their texts.
    Null ids name a component only where it has no other; repeated ids and rows stay repeated; other columns are not
    read; an empty table gives no rows.  Sets are told by 128-bit digests, shingles by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.unhex(F.md5(text)).alias("_t"), text.alias("_text"))
    levels = _levels(source.select("_text"))
    rows = written(source.mapInArrow(_sketcher(levels), _SKETCH), "sketches")
    roots = linked_sets(rows, source.select("_t", "_text"), split)
    nodes = rows.where("_n > 0").groupBy("_node").agg(F.min("_id").alias("_least"))
    classes = nodes.join(roots.withColumnRenamed("node", "_node"), "_node", "left").select("_node", "_least", F.coalesce("root", "_node").alias("_root"))
    least = classes.groupBy("_root").agg(F.min("_least").alias("component"))
    named = classes.join(least, "_root").select("_node", "component")
    return rows.join(named, "_node", "left").select("_id", F.col("_n").alias("n_shingles"), F.when(F.col("_n") > 0, F.col("component")).otherwise(F.col("_id")).alias("component"))
