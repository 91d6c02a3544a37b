"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are 64-bit majorities over the XXH64 of word shingles.  Two fingerprints link when
they differ in at most two bits.  Three bit ranges of 22, 21 and 21 bits are exchange keys: two
linked fingerprints agree on one range at least.  What meets under a key is sorted by Gray rank,
where equal leading bits stand together; each byte of the pattern is one level of nodes, shared
by all fingerprints below, and a search leaves a node, with all below it, as soon as the
differences gathered on the way exceed two.

Only distinct fingerprints are exchanged, so exact copies cost nothing.  A key with more than
``SPLIT`` distinct fingerprints is dealt again by three ranges of its other bits, which keeps
every link.  A task sends on one star for each group that it links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import free_prefix, written

WIDTH, SEED, DISTANCE = 3, 42, 2
#: Distinct fingerprints that one exchange key may bring to a task before it is dealt again.
SPLIT = 200_000
_RANGES = ((42, 22), (21, 21), (0, 21))
_ROWS, _HASHES, _TOGETHER = 256, 100_000, 200_000


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """Of each run of ``width`` words, or of all words where there are fewer."""
    words = text.lower().split() if text else []
    if len(words) < width:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def fingerprints(texts: list[bytes | None], width: int = WIDTH) -> np.ndarray:
    """Of each text; zero where there is no word."""
    hashes = [shingle_hashes(text, width) for text in texts]
    sizes = [len(found) for found in hashes]
    out = np.zeros(len(texts), np.uint64)
    start = 0
    while start < len(texts):  # some texts at a time: the bits take 64 bytes a hash
        end, total = start + 1, sizes[start]
        while end < len(texts) and total + sizes[end] <= _HASHES:
            total += sizes[end]
            end += 1
        out[start:end] = _majority(hashes[start:end], sizes[start:end])
        start = end
    return out


def _majority(hashes: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    counts, out = np.array(sizes), np.zeros(len(sizes), np.uint64)
    some = counts > 0
    if some.any():
        flat = np.concatenate(hashes)
        ends = np.cumsum(counts[some])
        total = np.zeros((some.sum(), 64), np.int64)
        for at in range(0, len(flat), _HASHES):  # a single very long text also goes by parts
            part = flat[at : at + _HASHES]
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            first, last = np.searchsorted(ends, [at, at + len(part) - 1], side="right")
            cuts = np.maximum(np.concatenate([[0], ends[:-1]])[first : last + 1] - at, 0)
            total[first : last + 1] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * total > counts[some][:, None], axis=1).view(">u8").ravel()
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            found = fingerprints(batch.column("_text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_h"), pa.array(found.view(np.int64))], ["_id", "_h", "_fp"])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def linked_pairs(group: np.ndarray, codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of equal group whose distinct codes differ in ``distance`` bits at most.

    ``group`` and ``codes`` must be sorted by group, then Gray rank, without repeated rows.
    """
    n = len(codes)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    starts = [np.flatnonzero(new)]  # first row of each node, level by level
    for level in range(8):
        prefix = codes >> np.uint64(56 - 8 * level)
        cut = new.copy()
        cut[1:] |= prefix[1:] != prefix[:-1]
        starts.append(np.flatnonzero(cut))
    children = [np.searchsorted(starts[d + 1], np.append(starts[d], n)) for d in range(8)]
    root = np.cumsum(new) - 1
    left, right = [], []
    todo = [(0, np.arange(i, min(i + 16384, n)), root[i : min(i + 16384, n)], np.zeros(min(i + 16384, n) - i, np.int8)) for i in range(0, n, 16384)]
    while todo:
        level, query, node, seen = todo.pop()
        if level == 8:
            left.append(query)
            right.append(starts[8][node])
            continue
        width = children[level][node + 1] - children[level][node]
        if len(query) > 1 and width.sum() > 4_000_000:  # bounded memory: halves of the frontier in turn
            half = len(query) // 2
            todo += [(level, query[:half], node[:half], seen[:half]), (level, query[half:], node[half:], seen[half:])]
            continue
        query, seen = np.repeat(query, width), np.repeat(seen, width)
        offset = np.arange(len(query)) - np.repeat(np.cumsum(width) - width, width)
        node = np.repeat(children[level][node], width) + offset
        ends = np.append(starts[level + 1][1:], n)
        shift = np.uint64(56 - 8 * level)
        differ = (codes[query] ^ codes[starts[level + 1][node]]) >> shift & np.uint64(255)
        seen = seen + np.bitwise_count(differ).astype(np.int8)
        keep = (seen <= distance) & (ends[node] - 1 > query)  # a node that ends before the query was met from the other side
        todo.append((level + 1, query[keep], node[keep], seen[keep]))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = np.concatenate(left), np.concatenate(right)
    keep = right > left
    return left[keep], right[keep]


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index in the component of each index."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            return label


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and are taken whole keys at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(k) for k, _ in held) >= _TOGETHER:
            key, code = (np.concatenate(c) for c in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield _linked(key[:cut], code[:cut])
            held = [(key[cut:], code[cut:])]
    if held:
        yield _linked(*(np.concatenate(c) for c in zip(*held, strict=True)))


def _linked(key: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
    code = code.view(np.uint64)
    order = np.lexsort((gray_rank(code), key))
    key, code = key[order], code[order]
    left, right = linked_pairs(key, code)
    root = _roots(len(code), left, right)
    some = np.flatnonzero(root != np.arange(len(code)))
    signed = code.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[some]), pa.array(signed[root[some]])], ["a", "b"])


def _part(shift: int, bits: int) -> F.Column:
    return F.shiftrightunsigned("_fp", shift).bitwiseAND(F.lit((1 << bits) - 1))


def links(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """``(a, b)`` edges over the distinct ``_fp``, a star for each group met under one key."""
    keyed = distinct.select("_fp", F.explode(F.array(*(F.xxhash64(F.lit(i), _part(*r)) for i, r in enumerate(_RANGES)))).alias("_key"))
    many = keyed.groupBy("_key").count().where(F.col("count") > split).select("_key", F.lit(True).alias("_many"))
    # 64 bits in 9 ranges: outside the range that agrees, one of three parts of each other range agrees too
    finer = F.array(*(F.xxhash64("_key", F.lit(i), *(_part(s, b) for s, b in parts)) for i, parts in enumerate(_thirds())))
    dealt = keyed.join(many, "_key", "left").select("_fp", F.explode(F.when(F.col("_many"), finer).otherwise(F.array("_key"))).alias("_key"))
    return dealt.repartition("_key").sortWithinPartitions("_key").select("_key", "_fp").mapInArrow(_stars, "a long, b long")


def _thirds() -> list[tuple[tuple[int, int], ...]]:
    """Three disjoint sets of bits that make up the word: at most two differ, so one set agrees."""
    return [tuple((s + b * i // 3, b * (i + 1) // 3 - b * i // 3) for s, b in _RANGES) for i in range(3)]


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _h, _fp)`` for each row: id, XXH64 of the text and fingerprint; a null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))
    return written(rows.mapInArrow(_hashed, "_id long, _h long, _fp long"), "fingerprints")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT) -> DataFrame:
    """A row for each row of ``docs``: ``(_id, _h, _fp, component, root)``, the least id that links reach and the component's least fingerprint.

    Null texts count as empty and share the zero fingerprint; null ids never name a component
    unless it has no other; repeated rows stay repeated; an empty table gives no rows; other columns
    are not read.
    """
    rows = fingerprinted(docs, id_col, text_col)
    distinct = rows.groupBy("_fp").agg(F.min("_id").alias("_least"))
    rooted = components(links(distinct.select("_fp"), split)).select(F.col("node").alias("_fp"), "root")
    classes = distinct.join(rooted, "_fp", "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("_least").alias("component"))
    return rows.join(classes.join(least, "root").select("_fp", "component", "root"), "_fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, see ``one_of_each``."""
    return one_of_each(docs, near_duplicates(docs, id_col, text_col), id_col, text_col)


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each ``root`` of ``found(_id, _h, root)``, that of the least id, then text hash (null ids first go); columns as they were.

    Ids may be null or repeated, they name no component.  Repeated rows of the document that stays are given once.
    """
    own = free_prefix(docs.columns)
    kept_id, kept_h, times = f"{own}id", f"{own}h", f"{own}n"
    rows = found.groupBy("_id", "_h", "root").agg(F.count("*").alias("_n"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_h", "_n")).alias("k")
    named = written(rows.groupBy("root").agg(first).select(F.col("k._id").alias(kept_id), F.col("k._h").alias(kept_h), F.col("k._n").alias(times)), "kept")
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.xxhash64(text) == F.col(kept_h))
    out = docs.join(named, same)
    if named.where(F.col(times) > 1).limit(1).count():
        out = out.where(F.col(times) == 1).unionByName(out.where(F.col(times) > 1).dropDuplicates([kept_id, kept_h]))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def hex_digits(fp: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
