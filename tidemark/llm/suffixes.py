"""Removal of long strings that occur more than once, by a sparse distributed suffix array.

Every ``LENGTH``-byte string holds one anchor, the position whose ``GRAM``-byte gram has the least
hash among all that start in it (the last one on a tie).  The choice depends on the string alone,
so all its copies have the anchor at the same place, and strings are told apart by their offset before it: the
strings of half an anchor's offsets share some 116 bytes about it, their core.  Only suffixes that start at anchors are sorted, one byte in
about 72, and of these only those with a half whose core occurs again, by a 64-bit hash that is counted with pre-aggregation.

* The bytes that the strings of a half reach are its context.  Equal contexts are first brought together (by a 128-bit
  digest): each is then sorted once, with its number of copies.
* Sampled splitters range-partition the suffixes by their leading bytes, then the core's hash, so a bucket holds whole cores.
  Only a core of more than ``PIECE`` contexts is cut, by a digest as salt, into as many pieces as its contexts fill.
* A bucket sorts its suffixes by multikey quicksort, eight bytes a key, and again by the bytes
  before the anchor, read backwards.  A string that starts ``o`` bytes before the anchor occurs
  again if both orders put the suffix in a common run: ``LENGTH - o`` common bytes after, ``o`` before.
* The strings of a core that is cut are compared across its pieces, as 128-bit digests counted with pre-aggregation;
  a piece gives each of its different strings once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import drop, free_prefix, written

LENGTH, GRAM = 200, 32
#: Contexts that a bucket holds, about, and contexts that it sorts together.
BUCKET, _SORTED = 50_000, 10_000
#: Contexts of one core beyond which it is cut, and that a piece of it holds, about.
PIECE = 10_000
_HALF = (LENGTH - GRAM) // 2 + 1
_ROWS = 256
_LOW = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_TOP = np.uint64(1 << 63)
#: Bytes of texts that are scanned together, and starts of a text that are.
_TOGETHER, _PART = 1 << 18, 1 << 19


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as a text has needed them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.full(max(n, 1 << 18), base, np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
            for powers in (self.up, self.down):
                powers[0] = 1
                np.cumprod(powers, out=powers)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def blocks(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """A row for each half of an anchor's offsets: number of the text, anchor, half, first and last start, hash of the core."""
    parts: list[tuple[int, int, bytes]] = []  # a very long text goes by parts
    for i, text in enumerate(texts):
        parts += [(i, at, text[at : at + _PART + LENGTH - 1]) for at in range(0, len(text) - LENGTH + 1, _PART)]
    out, at = [], 0
    while at < len(parts):
        end, size = at + 1, len(parts[at][2])
        while end < len(parts) and size + len(parts[end][2]) <= _TOGETHER:
            size += len(parts[end][2])
            end += 1
        out.append(_blocks(parts[at:end]))
        at = end
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.empty(0, np.int64) for _ in range(6))


def _blocks(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """The parts, of at least ``LENGTH`` bytes each, stand one after another; starts whose string would leave its part are none."""
    w = LENGTH - GRAM + 1
    sizes = np.array([len(p[2]) for p in parts])
    n = int(sizes.sum())
    up, down = _powers.upto(n)
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8).astype(np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up, out=sums[1:])
    h = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    m = len(h)
    key = (h & ~_LOW) | (_LOW - np.arange(m, dtype=np.uint64))
    rows = -(-m // w)
    padded = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = key
    grid = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = m - w + 1
    least = np.minimum(back[:starts], ahead[w - 1 : w - 1 + starts])
    begin = np.cumsum(sizes) - sizes
    cut = np.unique(np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, begin, np.minimum(begin + sizes - LENGTH + 1, starts)]))
    cut = cut[cut < starts]
    low, high = cut, np.append(cut[1:], starts) - 1
    of = np.searchsorted(begin, low, side="right") - 1
    inside = low + LENGTH <= begin[of] + sizes[of]
    low, high, of = low[inside], high[inside], of[inside]
    pos = (_LOW - (least[low] & _LOW)).astype(np.int64)
    number, shift = (np.array(c)[of] for c in zip(*((p[0], p[1]) for p in parts), strict=True))
    shift = shift - begin[of]
    out = []
    for half in (0, 1):
        first, last = (np.maximum(low, pos - _HALF + 1), high) if half == 0 else (low, np.minimum(high, pos - _HALF))
        some = first <= last
        p = pos[some]
        a = p - _HALF * half
        b = a + (LENGTH - _HALF + 1 if half == 0 else GRAM + _HALF)
        core = _mixed(_mixed((sums[b] - sums[a]) * down[a]) + np.uint64(half))
        out.append((number[some], p + shift[some], np.full(len(p), half), first[some] + shift[some], last[some] + shift[some], core.view(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cores of each text, those that occur twice in it given twice."""
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            number, *_, core = blocks(batch.column("_text").cast(pa.binary()).to_pylist())
            order = np.lexsort((core, number))
            number, core = number[order], core[order]
            same = np.zeros(len(core), bool)
            same[1:] = (core[1:] == core[:-1]) & (number[1:] == number[:-1])
            third = same.copy()
            third[1:] &= same[:-1]
            number, core = number[~third], core[~third]
            offsets = pa.array(np.searchsorted(number, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.ListArray.from_arrays(offsets, pa.array(core))], ["k1", "k2", "cores"])


_CONTEXTS = "k1 long, k2 long, lows array<int>, lead int, span int, c1 long, c2 long, first8 long, core long, bytes binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text its different contexts with a core in ``_found``: where they begin, and the bytes, ``lead`` of them before the anchor."""
    names = [c.split(" ")[0] for c in _CONTEXTS.split(", ")]
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int32())] + [pa.int32()] * 2 + [pa.int64()] * 4 + [pa.binary()]
    for whole in batches:
        for start in range(0, whole.num_rows, 64):
            batch = whole.slice(start, 64)
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            number, pos, half, first, last, core = blocks(texts)
            wanted = batch.column("_found")
            pairs = np.stack([np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy()), wanted.flatten().to_numpy()], axis=1)
            known = set(map(tuple, pairs.tolist()))
            rows: dict[tuple, list] = {}
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for i, p, h, a, b, c in zip(*(x.tolist() for x in (number, pos, half, first, last, core)), strict=True):
                if (i, c) not in known:
                    continue
                context = texts[i][a : b + LENGTH]
                digest = _digest(context, p - a)
                if (row := rows.get((i, digest))) is not None:
                    row[2].append(a)
                    continue
                begin = p - a - _HALF * h
                rows[i, digest] = [k1[i], k2[i], [a], p - a, b - a, *digest, int.from_bytes(context[begin : begin + 8], "big") - (1 << 63), c, context]
            columns = zip(*rows.values(), strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _digest(data: bytes, seed: int = 0) -> tuple[int, int]:
    found = xxhash.xxh3_128_intdigest(data, seed=seed)
    return (found >> 64) - (1 << 63), (found & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of big-endian 64-bit words, and for each row in it the words it has in common with the row before.

    Multikey quicksort: rows are parted by one word, and only parts of two or more rows go on to the next.
    """
    n, depth = words.shape
    order, part = np.arange(n), np.zeros(n, np.int64)
    common = np.zeros(n, np.int64)
    active = np.arange(n)  # places in the order that lie in parts of two or more
    for k in range(depth):
        if len(active) < 2:
            break
        column = words[order[active], k]
        by = np.lexsort((column, part[active]))
        order[active] = order[active[by]]
        column, same = column[by], part[active]
        joined = np.zeros(len(active), bool)
        joined[1:] = (same[1:] == same[:-1]) & (column[1:] == column[:-1])
        common[active[joined]] = k + 1
        part[active] = active[np.maximum.accumulate(np.where(joined, 0, np.arange(len(active))))]
        keep = joined.copy()
        keep[:-1] |= joined[1:]
        active = active[keep]
    return order, common


def _common_bytes(rows: np.ndarray, words: np.ndarray, sizes: np.ndarray, order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the one before it in the order."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        k = np.minimum(common[1:], words.shape[1] - 1)
        a, b = order[1:], order[:-1]
        x, y = (rows.reshape(len(rows), -1, 8)[i, k] for i in (a, b))
        differ = x != y
        inside = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
        out[1:] = np.minimum(np.minimum(8 * k + inside, sizes[a]), sizes[b])
    return out


def repeated_starts(contexts: list[bytes], lead: np.ndarray, span: np.ndarray, copies: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each context the starts of its strings (0 to span) that occur again in the same or another context."""
    n = len(contexts)
    if not n:
        return []
    width = -(-length // 8) * 8
    sizes = np.array([len(c) for c in contexts])
    right, left = np.zeros((n, width), np.uint8), np.zeros((n, width), np.uint8)
    for i, c in enumerate(contexts):
        after, before = c[lead[i] : lead[i] + length], c[: lead[i]][::-1]
        right[i, : len(after)] = np.frombuffer(after, np.uint8)
        left[i, : len(before)] = np.frombuffer(before, np.uint8)
    after, before = np.minimum(sizes - lead, length), lead
    runs = []
    for rows, size in ((right, after), (left, before)):
        words = rows.view(">u8").astype(np.uint64)
        order, common = multikey_order(words)
        runs.append((order, _common_bytes(rows, words, size, order, common)))
    near = []  # most bytes in common with a neighbour
    for order, lcp in runs:
        best = np.empty(n, np.int64)
        best[order] = np.maximum(lcp, np.append(lcp[1:], 0))
        near.append(best)
    found = [[] for _ in range(n)]
    whole = copies > 1
    place = []
    for order, _ in runs:
        at = np.empty(n, np.int64)
        at[order] = np.arange(n)
        place.append(at)
    for o in range(int(before.max()) + 1):
        within = np.flatnonzero((lead - o >= 0) & (lead - o <= span) & (near[0] >= length - o) & (near[1] >= o))
        if not len(within):
            continue
        classes = np.cumsum(runs[0][1] < length - o)[place[0][within]] * (n + 1) + (np.cumsum(runs[1][1] < o)[place[1][within]] if o else 0)
        _, which, count = np.unique(classes, return_inverse=True, return_counts=True)
        for i in within[(count[which] > 1) & ~whole[within]]:
            found[i].append(lead[i] - o)
    return [np.arange(span[i] + 1) if whole[i] else np.array(found[i][::-1], np.int64) for i in range(n)]


def _runs(starts: np.ndarray) -> list[dict[str, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"first": int(a), "last": int(b)} for a, b in zip(np.append(starts[0], starts[cut + 1]), np.append(starts[cut], starts[-1]), strict=True)]


_RUN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_STRING = pa.list_(pa.struct([("start", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]))
_SORT = "c1 long, c2 long, runs array<struct<first:int,last:int>>, strings array<struct<start:int,h1:long,h2:long>>"


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts one range of suffixes: runs of starts that occur again in it, and for pieces of a core that is cut the digests of their different strings."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    words = np.stack([table.column(k).to_numpy().view(np.uint64) ^ _TOP for k in ("first8", "core", "piece")], axis=1)
    order, common = multikey_order(words)
    cut = table.column("piece").to_numpy()[order] >= 0
    for some, most in ((~cut, _SORTED), (cut, 1)):  # whole cores, some at a time; pieces one by one
        inner = order[some]
        heads = np.append(np.flatnonzero(common[some] < 3), len(inner))
        at = 0
        while at < len(inner):
            end = int(heads[min(np.searchsorted(heads, at + most), len(heads) - 1)])
            rows = table.take(pa.array(inner[at:end])).to_pydict()
            at = end
            if most == 1:
                yield from _piece(rows)
                continue
            found = repeated_starts(rows["bytes"], np.array(rows["lead"]), np.array(rows["span"]), np.array(rows["copies"]))
            again = [i for i, f in enumerate(found) if len(f)]
            yield _sorted_rows([rows["c1"][i] for i in again], [rows["c2"][i] for i in again], [_runs(found[i]) for i in again], None)


def _piece(rows: dict[str, list]) -> Iterator[pa.RecordBatch]:
    """Runs of starts that occur again in a piece, and where each of its different strings stands first."""
    sizes = np.array(rows["span"]) + 1
    begin = np.append(0, np.cumsum(sizes))
    of = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(of)) - begin[of]
    pairs = (_digest(data[s : s + LENGTH]) for data, n in zip(rows["bytes"], sizes.tolist(), strict=True) for s in range(n))
    h1, h2 = np.fromiter(pairs, np.dtype((np.int64, 2)), len(of)).T
    order = np.lexsort((h2, h1))  # stable: equal strings stay in order
    new = np.ones(len(of), bool)
    new[1:] = (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])
    first, again = np.empty(len(of), bool), np.empty(len(of), bool)
    first[order], again[order] = new, ~(new & np.append(new[1:], True))
    again |= np.array(rows["copies"])[of] > 1
    strings = pa.StructArray.from_arrays([pa.array(start[first], pa.int32()), pa.array(h1[first]), pa.array(h2[first])], fields=list(_STRING.value_type))
    offsets = np.append(0, np.cumsum(first))[begin]
    for at in range(0, len(sizes), 256):
        end = min(at + 256, len(sizes))
        lists = pa.ListArray.from_arrays(pa.array(offsets[at : end + 1], pa.int32()), strings)
        runs = [_runs(start[a:b][again[a:b]]) or None for a, b in zip(begin[at:end].tolist(), begin[at + 1 : end + 1].tolist(), strict=True)]
        yield _sorted_rows(rows["c1"][at:end], rows["c2"][at:end], runs, lists)


def _sorted_rows(c1: list, c2: list, runs: list, strings: pa.Array | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(runs, _RUN), pa.nulls(len(c1), _STRING) if strings is None else strings], ["c1", "c2", "runs", "strings"])


def text_key(text: Column) -> list[Column]:
    """Two numbers by which texts are told apart: a 64-bit hash, and length and CRC."""
    return [F.xxhash64(text).alias("k1"), (F.crc32(text) + F.octet_length(text) * F.lit(1 << 32)).alias("k2")]


def _neighbours(starts: str) -> Column:
    """Sorted starts as runs of neighbours."""
    ends = lambda step, edge: F.filter(starts, lambda s, i: F.coalesce(F.get(starts, i + step) != s + step, F.lit(True)) if edge else (i == 0) | (F.get(starts, i + step) != s + step))
    return F.zip_with(ends(-1, False), ends(1, True), lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def repeated_spans(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows(k1, k2, _text)`` to ``spans`` and ``texts``, by text, where some string of it occurs again.

    ``spans``: k1, k2 and ``spans``, sorted stretches of bytes [first, last) that may overlap.  ``texts``: k1, k2, _text.
    A text of several rows is taken once: its strings count, that they all occur again is for the caller to see.
    """
    scan = written(rows.mapInArrow(_scanned, "k1 long, k2 long, cores array<long>"), "scan")
    cores = scan.select("k1", "k2", F.explode("cores").alias("core"))
    again = cores.groupBy("core").count().where("count > 1").select("core")
    found = cores.join(again.hint("merge"), "core").groupBy("k1", "k2").agg(F.collect_set("core").alias("_found"))
    texts = written(rows.groupBy("k1", "k2").agg(F.first("_text").alias("_text")).join(found.hint("merge"), ["k1", "k2"]), "texts")
    drop(scan)
    members = written(texts.mapInArrow(_contexts, _CONTEXTS), "contexts")
    once = [F.first(c).alias(c) for c in ("lead", "span", "first8", "core", "bytes")]
    pool = written(members.groupBy("c1", "c2").agg(F.sum(F.size("lows")).alias("copies"), *once), "pool")
    buckets = max(1, -(-pool.count() // BUCKET))
    large = pool.groupBy("first8", "core").count().where(F.col("count") > PIECE).select("first8", "core", F.ceil(F.col("count") / PIECE).alias("pieces"))
    # at most one row for PIECE contexts, so a broadcast; -1 where a core stays whole
    parted = pool.join(F.broadcast(large), ["first8", "core"], "left").withColumn("piece", F.coalesce(F.expr("pmod(c1, pieces)"), F.lit(-1).cast("long"))).drop("pieces")
    dealt = parted.repartitionByRange(buckets, "first8", "core", "piece")
    ranked = written(dealt.mapInArrow(_bucket, _SORT), "sorted")
    strings = ranked.where("strings is not null").select("c1", "c2", F.inline("strings"))
    twice = strings.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2")
    starts = strings.join(twice, ["h1", "h2"]).groupBy("c1", "c2").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    runs = ranked.where("runs is not null").select("c1", "c2", "runs").union(starts.select("c1", "c2", _neighbours("starts")))
    placed = members.select("k1", "k2", "lows", "c1", "c2").join(runs, ["c1", "c2"]).select("k1", "k2", F.explode("lows").alias("low"), "runs").select("k1", "k2", "low", F.inline("runs"))
    span = F.struct((F.col("low") + F.col("first")).alias("first"), (F.col("low") + F.col("last") + LENGTH).alias("last"))
    spans = written(placed.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(span)).alias("spans")), "spans")
    drop(members, pool, ranked)
    return spans, texts.select("k1", "k2", "_text")


def _cut(text: bytes, spans: list[dict[str, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left without the spans, and the spans where they touch or overlap made one."""
    merged: list[list[int]] = []
    for s in spans:
        if merged and s["first"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s["last"])
        else:
            merged.append([s["first"], s["last"]])
    kept, at = [], 0
    for first, last in merged:
        kept.append(text[at:first])
        at = last
    return b"".join([*kept, text[at:]]), [(a, b) for a, b in merged]


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_of = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            done = [_cut(t, s) for t, s in zip(batch.column("_text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.array([[{"first": a, "last": b} for a, b in m] for _, m in done], spans_of), pa.array([hashlib.sha256(k).hexdigest() for k, _ in done]), pa.array([k for k, _ in done], pa.binary())],
                ["k1", "k2", "spans", "sha", "kept"],
            )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: ``doc_id, n_bytes, spans, kept_sha256, whole, k1, k2, kept``.

    ``spans`` are the removed [first, last) bytes; ``kept`` the bytes left where only a part went (null
    where nothing or all of the text went).  A null text counts as empty and keeps its row; texts
    shorter than ``LENGTH`` lose nothing; repeated rows and equal texts each lose all their text, since each occurs
    elsewhere; ids may be null; an empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*text_key(text), text.alias("_text"))
    meta = written(docs.select(F.col(id_col).cast("long").alias("_id"), *text_key(text), F.octet_length(text).cast("long").alias("_n"), F.sha2(text, 256).alias("_sha")), "meta")
    spans, texts = repeated_spans(rows)
    cuts = written(texts.join(spans, ["k1", "k2"]).mapInArrow(_cuts, "k1 long, k2 long, spans array<struct<first:int,last:int>>, sha string, kept binary"), "cuts")
    copied = meta.where(F.col("_n") >= LENGTH).groupBy("k1", "k2").count().where("count > 1").select("k1", "k2", F.lit(True).alias("whole"))
    all_of_it = F.array(F.struct(F.lit(0).alias("first"), F.col("_n").cast("int").alias("last")))
    none = F.array().cast("array<struct<first:int,last:int>>")
    whole = F.coalesce("whole", F.lit(False))
    return meta.join(cuts, ["k1", "k2"], "left").join(copied, ["k1", "k2"], "left").select(
        F.col("_id").alias("doc_id"),
        F.col("_n").alias("n_bytes"),
        F.when(whole, all_of_it).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("sha", "_sha")).alias("kept_sha256"),
        whole.alias("whole"),
        "k1",
        "k2",
        F.when(~whole, F.col("kept")).alias("kept"),
    )


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text`` (and ``n_chars`` set anew, if there); columns and types as they were.

    A character that is cut through goes as a whole.  Rows that lose nothing are unchanged, null texts stay null.
    """
    own = free_prefix(docs.columns)
    cut = without_repeats(docs, id_col, text_col).where(F.col("whole") | F.col("kept").isNotNull())
    by_text = cut.groupBy("k1", "k2").agg(F.first("whole").alias("_whole"), F.first("kept").alias("_kept"))
    by_text = by_text.mapInArrow(_readable([f"{own}1", f"{own}2", f"{own}left"]), f"{own}1 long, {own}2 long, {own}left string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    k1, k2 = text_key(text)
    out = docs.join(by_text, (k1 == F.col(f"{own}1")) & (k2 == F.col(f"{own}2")), "left")
    left = F.col(f"{own}left")

    def column(name: str) -> Column:
        if name == text_col:
            return F.coalesce(left, F.col(name)).alias(name)
        if name == "n_chars":
            return F.when(left.isNotNull(), F.char_length(left).cast(docs.schema[name].dataType)).otherwise(F.col(name)).alias(name)
        return F.col(f"`{name}`")

    return out.select(*map(column, docs.columns))


def _readable(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = ["" if w else k.decode("utf-8", "ignore") for w, k in zip(batch.column("_whole").to_pylist(), batch.column("_kept").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(left, pa.string())], names)

    return run
