"""Packing of tokenised documents into fixed-length sequences: shortest-pack-first over the length histogram.

Documents are cut into pieces of at most ``SIZE`` ids.  The driver sees only the histogram of piece
lengths (at most ``SIZE`` rows).  Lengths are placed longest first, each into the shortest packs
with room for it, as counts of packing patterns; new packs take as many pieces of the length as
fit.  Patterns are then joined back to pieces by rank: the pieces of each length are numbered, and
a pattern slot owns a range of those numbers.  Numbers come from two levels, (length, bucket) and
place in the bucket, so that one very common length is dealt over many tasks.
"""

from __future__ import annotations

import array
import functools
import heapq
import itertools
import json
import operator
import os
import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

SIZE, END = 4096, 2
#: Entries of a task's caches, about, and of them that a worker keeps when they are full or the task ends.
CACHE, KEPT = 1 << 19, 1 << 17
#: Pieces in one bucket of the numbering.
BUCKET = 50_000
#: Rows taken together.
_ROWS = 4096


class WordIds:
    """Ids of whole texts, each distinct chunk between white space encoded once by the library.

    This needs a tokenizer that never joins what stands on two sides of white space, which ``_NORMALIZER`` and ``_SPLITS``
    tell from its file; texts go whole through any other.  Special tokens that a text spells are taken as the library takes them.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        added = made.get("added_tokens") or []
        self.by_chunks = made.get("normalizer") == _NORMALIZER and made.get("pre_tokenizer") == _SPLITS and all(t["content"].split() == [t["content"]] and not (t["normalized"] or t["single_word"]) for t in added)
        self.tokenize = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_SPELLING)
            found = self.words[word] = _little(map(_ID, self.tokenize(spelt)))
        return found

    def forget(self, most: int) -> None:
        """Caches of more than ``most`` entries keep ``KEPT``, those met first, among which are the frequent ones."""
        for name in ("known", "words"):
            if len(cache := getattr(self, name)) > most:
                setattr(self, name, dict(itertools.islice(cache.items(), KEPT)))

    def chunks(self, chunks: list[str]) -> list[bytes]:
        """Plain words go to the tokenizer's model at once, whatever else a chunk holds through the whole tokenizer."""
        self.forget(CACHE)
        known, word_ids, rest = self.known, self._word, []
        for c in chunks:
            if c not in known:
                if c.isalpha() and _PLAIN(c):
                    known[c] = word_ids(c.lower())
                elif found := _PLAIN(c):
                    word, mark = found.groups()
                    known[c] = word_ids(word.lower()) + word_ids(mark) if mark else word_ids(word.lower())
                else:
                    rest.append(c)
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            for c, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                known[c] = np.array(e.ids, "<u4").tobytes()
        return [*map(known.__getitem__, chunks)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text of an array without nulls."""
        if not self.by_chunks:
            return [np.array(e.ids, "<u4").tobytes() for t in texts.to_pylist() for e in [self.tokenizer.encode(t, add_special_tokens=False)]]
        for mark in "\n\t\r":  # other white space is left to the tokenizer
            texts = pc.replace_substring(texts, mark, " ")
        parts = pc.split_pattern(texts.cast(pa.large_string()), " ")
        every = parts.flatten().dictionary_encode()
        ids = pa.array(self.chunks(every.dictionary.to_pylist()), pa.large_binary())
        joined = ids.take(every.indices)  # the ids of all chunks stand one after another
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :]
        cuts = offsets[parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()]
        data = joined.buffers()[2]
        view = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(view[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_ID = operator.attrgetter("id")


def _little(ids: Iterable[int]) -> bytes:
    found = array.array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


#: The settings under which white space always parts words.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITS = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: A run of letters that Unicode normalisation leaves alone, then at most one mark: two tokens of the pre-tokenizer.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([,.;:!?]?)").fullmatch
#: How byte-level models spell the bytes 128 to 255: those without a printable character of their own follow from 256 + 33 on.
_SPELLING = {b: chr(289 + i) for i, b in enumerate([*range(127, 161), 173]) if b > 127}


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _pieces(path: str, size: int, end: int | None, keep_ids: bool):
    tail = np.array([] if end is None else [end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                out: list[list] = [[] for _ in range(6)]
                for doc, ids in zip(batch.column("_id").to_pylist(), words.encode(batch.column("_text")), strict=True):
                    ids += tail
                    for start in range(0, len(ids), 4 * size):
                        part = ids[start : start + 4 * size]
                        for column, value in zip(out, (doc, start // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part if keep_ids else None), strict=True):
                            column.append(value)
                kinds = (*[pa.int64()] * 5, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
        words.forget(KEPT)  # the worker lives on, with whatever tasks come next

    return run


def tokenized_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int | None = END, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, ids)``: every document in pieces of ``size`` ids at most.

    A null text counts as empty and is one piece with the end id; with ``end=None`` it has no piece.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(_pieces(tokenizer, size, end, keep_ids), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def packing_patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in the order of their offsets) with how many packs follow each."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by space left
    spaces: list[int] = []  # the same, as a heap of the most space first

    def put(pattern: tuple[int, ...], count: int, left: int) -> None:
        if not room[left]:
            heapq.heappush(spaces, -left)
        room[left].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        if length <= 0:
            continue
        while todo:
            while spaces and not room[-spaces[0]]:
                heapq.heappop(spaces)
            if spaces and -spaces[0] >= length:
                left = -spaces[0]
                pattern, count = room[left].pop()
                used = min(todo, count)
                if count > used:
                    room[left].append((pattern, count - used))
                put((*pattern, length), used, left - length)
                todo -= used
                continue
            each = size // length
            packs, rest = divmod(todo, each)
            if packs:
                put((length,) * each, packs, size - length * each)
            if rest:
                put((length,) * rest, 1, size - length * rest)
            todo = 0
    return [x for left in sorted(room) for x in room[left]]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, list[np.ndarray]]:
    """For each length its slots: first rank, first sequence, packs, offset; a slot owns ``packs`` ranks."""
    taken: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows[length].append((taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return {k: [np.array(c, np.int64) for c in zip(*v, strict=True)] for k, v in rows.items()}


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                first, base, at = slots[int(length[part[0]])]
                slot = np.searchsorted(first, rank[part], side="right") - 1
                sequence[part] = base[slot] + rank[part] - first[slot]
                offset[part] = at[slot]
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; each sequence is filled from 0 without gaps.

    Only ``length`` (1 to ``size``) is needed, other columns pass through and break ties of the numbering;
    repeated rows are packed as often as they occur, an empty table gives no rows.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    slots = spark.sparkContext.broadcast(_slots(packing_patterns(histogram, size)))
    buckets = max(1, sum(histogram.values()) // BUCKET)
    keys = [c for c in pieces.columns if c not in ("ids", "length")]
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    before = dealt.groupBy("length", "_bucket").count().withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).drop("count")
    within = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*keys)))
    ranked = within.join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_place") - 1)
    ranked = ranked.select(*pieces.columns, F.col("_rank").cast("long").alias("_rank"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_placed(slots), f"{kinds}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int | None = END, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every document tokenised, cut and packed: ``doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset``.

    Null texts count as empty; ids may be null or repeated; very long texts become many pieces; other columns are not read.
    """
    pieces = tokenized_pieces(docs, tokenizer, size, end, id_col, text_col, keep_ids)
    return pack(written(pieces if keep_ids else pieces.drop("ids"), "pieces"), size)
