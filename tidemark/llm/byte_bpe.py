"""Byte-level BPE by Spark's higher-order functions, from a literal rank map.

Narrow steps of one stage, without an exchange.  ``_numbered`` splits texts and numbers words: one that is a token has
that token's id, any other the next number of its partition, and comes along as an array of bytes with the first row of the texts
where it is first seen.  Spark folds each of these distinct words by ranked merges.  ``_assembled`` takes the words by their numbers,
so that ids stand in the order of the text.  Spark decodes each distinct word by joining the pieces that its ids stand for.

In the fold a word is an array of numbers, each a symbol in the low 16 bits and above them the rank of its pair with the next.
The least number is then the pair to merge, its first place the leftmost, and its rank is the id of what the two
become.  Spark looks through a map entry by entry, so the rank map is one literal array: the pairs of a left symbol lie at
that symbol's displacement plus the right symbol, and each entry holds the left symbol and the rank.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that a partition remembers; beyond so many it begins anew and folds again what it meets again.
REMEMBERED = 1_000_000
_NONE = 1 << 24
_LOW = 65535
_WINDOW = 4096  # places tried together
#: Bytes of texts that are split together.
_TOGETHER = 1 << 22
#: Fixed value: the pattern whose matches never reach over a space that a further character follows.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters below this are letters to Python and to the pattern alike; marks that no other alternative of the pattern begins with.
_LATIN, _MARKS = "\u0250", frozenset(",.;:!?")
_Batches = Iterator[pa.RecordBatch]


@functools.lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _array(values: list, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def displaced(pairs: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
    """Displacements by left symbol, and entries ``left << 16 | rank`` (-1 where none is), longest rows placed first."""
    rows: dict[int, list[int]] = defaultdict(list)
    for a, b in pairs:
        rows[a].append(b)
    taken, moves, free = np.zeros(2 * _LOW, bool), [0] * (max(rows, default=0) + 1), 0
    starts: dict[int, int] = defaultdict(int)  # by length of row: windows before it were found full
    for a, found in sorted(rows.items(), key=lambda r: -len(r[1])):
        at = np.sort(np.array(found))
        while taken[free]:
            free += 1
        tried = max(free, starts[len(at).bit_length()])
        while True:
            if tried + _WINDOW + _LOW >= len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            fits = tried + np.flatnonzero(~taken[tried : tried + _WINDOW]) - int(at[0])
            for b in at[1:]:
                fits = fits[~taken[fits + b]]
                if not len(fits):
                    break
            if len(fits):
                break
            tried += _WINDOW
        starts[len(at).bit_length()] = tried
        moves[a] = int(fits[0])
        taken[at + moves[a]] = True
    entries = [-1] * (int(np.flatnonzero(taken).max(initial=-1)) + 1)
    for (a, b), rank in pairs.items():
        entries[moves[a] + b] = a << 16 | rank
    return moves, entries


class Merges:
    """The rank map as a foldable expression; ranks and ids must lie below 65,536."""

    def __init__(self, path: str) -> None:
        ranks = ranks_of(path)
        if max(ranks.values()) > _LOW:
            raise ValueError("a rank does not fit in 16 bits")
        pairs = {(ranks[t[:i]], ranks[t[i:]]): r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        moves, entries = displaced(pairs)
        spelt = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            spelt[rank] = token.hex()
        self.pieces = F.split(F.lit(",".join(spelt)), ",")
        single = [ranks[bytes([b])] for b in range(256)]
        joined = [pairs.get((a, b), _NONE) << 16 | a for a in single for b in single]
        self.tables = F.struct(_array(joined, "long").alias("first"), _array([_NONE << 16 | a for a in single], "long").alias("last"), _array(moves, "int").alias("moves"), _array(entries, "long").alias("entries"))

    def fold(self, t: Column, word: Column) -> Column:
        """Ids of an array of bytes; ``t`` is bound to ``tables``."""
        def paired(a: Column, b: Column) -> Column:
            """The symbol with the rank of its pair; ``b`` is null after the last."""
            entry = F.get(t["entries"], F.get(t["moves"], a.cast("int")) + b.cast("int"))
            ranked = F.when(F.shiftright(entry, 16) == a, F.shiftleft(entry.bitwiseAND(F.lit(_LOW)), 16) + a)
            return F.coalesce(ranked, F.lit(_NONE << 16) + a)

        low = lambda x: x.bitwiseAND(F.lit(_LOW))

        def merged(s: Column, least: Column, p: Column) -> Column:
            """The symbol at ``p`` and the next become one; only the pairs on its two sides are new."""
            new = F.shiftright(least, 16)
            each = lambda x, i: F.when(i > p, x).when(i < p - 2, x).when(i == p, F.lit(-1).cast("long")).when(i == p - 1, paired(new, low(F.get(s, p + 1)))).otherwise(paired(low(x), new))
            return F.array_remove(F.transform(s, each), F.lit(-1).cast("long"))

        def step(s: Column, _: Column) -> Column:
            return _let(F.array_min(s), lambda least: F.when(least >= _NONE << 16, s).otherwise(_let(F.array_position(s, least).cast("int"), lambda p: merged(s, least, p))))

        start = F.transform(word, lambda x, i: F.coalesce(F.get(t["first"], x * 256 + F.get(word, i + 1)), F.get(t["last"], x)))
        return F.transform(F.aggregate(F.slice(word, 2, F.size(word)), start, step), lambda x: low(x).cast("int"))


class _Words:
    """Numbers of words: a token's id, or else the next number after the ids; ``new`` holds the latter's bytes.

    A text is cut before each space that a further character follows; no match of the pattern reaches over such a place, so each
    distinct chunk is split by the pattern once.  Texts in which white space stands beside a space are split whole, as are all under another pattern.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.split, self.next = ranks, regex.compile(pattern).findall, max(ranks.values()) + 1
        self.by_chunks = pattern == _PATTERN
        self.numbers: dict[str, int] = {}
        #: Chunks by number; the words of each stand in ``flat`` up to its end.
        self.chunks: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q", [0])
        self.new: list[bytes] = []

    def of(self, words: list[str]) -> list[int]:
        return [self.numbers[w] if w in self.numbers else self._number(w) for w in words]

    def _number(self, word: str) -> int:
        raw = word.encode()
        number = self.ranks.get(raw)  # a word that is a token is that token alone
        if number is None:
            self.new.append(raw)
            number = self.next
            self.next += 1
        self.numbers[word] = number
        return number

    def _chunk(self, chunk: str) -> None:
        """Takes up a chunk and the space before it; one that is empty or begins with white space has no words, its texts are split whole."""
        if chunk and not chunk[0].isspace():
            words = None
            if chunk.isascii() or max(chunk) < _LATIN:  # a run of letters is one match, as is a mark after it
                if chunk.isalpha():
                    words = [" " + chunk]
                elif chunk[-1] in _MARKS and chunk[:-1].isalpha():
                    words = [" " + chunk[:-1], chunk[-1]]
            self.flat.extend(self.of(words or self.split(" " + chunk)))
        self.chunks[chunk] = len(self.ends) - 1
        self.ends.append(len(self.flat))

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of all texts, and where each text's begin and end."""
        if not self.by_chunks:
            found = [np.array(self.of(self.split(t)), np.int32) for t in texts.to_pylist()]
            return np.concatenate([np.empty(0, np.int32), *found]), np.cumsum([0, *map(len, found)])
        parts = pc.split_pattern(texts.cast(pa.large_string()), " ")
        every = parts.flatten().dictionary_encode()
        known, chunks = self.chunks, every.dictionary.to_pylist()
        for c in [c for c in chunks if c not in known]:
            self._chunk(c)
        flat, bounds = np.array(self.flat, np.int32), np.array(self.ends, np.int64)
        at = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))[every.indices.to_numpy()]
        cuts = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        ends, sizes = bounds[1:], np.diff(bounds)
        # texts that hold an odd chunk, and the first chunk of every text, which no space precedes, go one by one
        odd_at = sizes[at] == 0
        whole = np.add.reduceat(np.append(odd_at, False), cuts[:-1]) > 0 if len(cuts) > 1 else np.zeros(0, bool)
        out, counts = [], []
        strings = texts.to_pylist()
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if whole[i]:
                out.append(np.array(self.of(self.split(strings[i])), np.int32))
            else:
                rest = at[a + 1 : b]
                out += [np.array(self.of(self.split(strings[i].partition(" ")[0])), np.int32), _gathered(flat, ends[rest] - sizes[rest], sizes[rest])]
            counts.append(len(out[-1]) + (0 if whole[i] else len(out[-2])))
        return np.concatenate(out) if out else np.empty(0, np.int32), np.cumsum([0, *counts])


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` one after another."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(total)]


def _lists(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def _slices(batches: _Batches) -> _Batches:
    """Rows of some ``_TOGETHER`` bytes of text, or of one longer text."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _TOGETHER, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _numbered(path: str, pattern: str, remembered: int) -> Callable[[_Batches], _Batches]:
    """Each text's words by number; ``_base`` is how many words had been folded before the row, 0 to begin anew."""

    def run(batches: _Batches) -> _Batches:
        ranks = ranks_of(path)
        words, base = _Words(ranks, pattern), 0
        for part in _slices(batches):
            if base > remembered:
                words, base = _Words(ranks, pattern), 0
            codes, cuts = words.codes(pc.fill_null(part.column("text"), ""))
            new, words.new = words.new, []
            sizes = np.cumsum([0, *map(len, new)])
            spelt = _lists(np.frombuffer(b"".join(new), np.uint8), sizes, pa.int32())
            rows = part.num_rows  # the first row brings the new words of all
            folds = pa.ListArray.from_arrays(pa.array([0] + [len(new)] * rows, pa.int32()), spelt)
            bases = [base] + [base + len(new)] * (rows - 1)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(bases, pa.int64()), _lists(codes, cuts, pa.int32()), folds], ["doc_id", "_base", "_codes", "_new"])
            base += len(new)

    return run


class _Table:
    """Sequences by number, which stand one after another in ``flat``."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat, self.sizes, self.ends = flat, sizes.astype(np.int64), np.cumsum(sizes, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def extended(self, held: int, flat: np.ndarray, sizes: np.ndarray) -> _Table:
        """The first ``held`` sequences and more."""
        return _Table(np.concatenate([self.flat[: self.ends[held - 1]], flat]), np.concatenate([self.sizes[:held], sizes]))

    def gathered(self, numbers: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the numbers stand for, and where each text's begin and end."""
        sizes = self.sizes[numbers]
        return _gathered(self.flat, self.ends[numbers] - sizes, sizes), np.append(0, np.cumsum(sizes))[cuts]


def _assembled(path: str) -> Callable[[_Batches], _Batches]:
    """Ids and bytes of each text in order."""

    def run(batches: _Batches) -> _Batches:
        ranks = ranks_of(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        least = len(tokens)
        ids = _Table(np.arange(least, dtype=np.int32), np.ones(least, np.int64))
        pieces = _Table(np.frombuffer(b"".join(tokens), np.uint8), np.array([*map(len, tokens)]))
        for found in batches:
            docs, bases, codes, folded, spelt = (found.column(c) for c in ("doc_id", "_base", "_codes", "_folded", "_pieces"))
            begins = np.unique(np.append(np.flatnonzero(folded.value_lengths().to_numpy()), [0, found.num_rows])).tolist()  # rows that bring words
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                base = bases[a].as_py()
                fresh, bytes_ = folded.slice(a, 1).flatten(), spelt.slice(a, 1).flatten()
                if base and len(ids) != least + base:
                    raise RuntimeError("rows came in another order than they were numbered in")
                ids = ids.extended(least + base, fresh.flatten().to_numpy(), fresh.value_lengths().to_numpy())
                pieces = pieces.extended(least + base, np.frombuffer(b"".join(bytes_.to_pylist()), np.uint8), pc.binary_length(bytes_).to_numpy())
                part = codes.slice(a, b - a)
                numbers, cuts = part.flatten().to_numpy(), np.append(0, np.cumsum(part.value_lengths().to_numpy(), dtype=np.int64))
                decoded, ends = pieces.gathered(numbers, cuts)
                data = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(decoded.tobytes())])
                yield pa.RecordBatch.from_arrays([docs.slice(a, b - a), _lists(*ids.gathered(numbers, cuts), pa.int32()), data], ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """``doc_id, ids, decoded``: ids of the whole text as an array, and the bytes that they stand for.

    Null texts count as empty (no ids, no bytes); ids may be null or repeated; equal rows stay; an empty table gives no rows;
    other columns are not read.  A task holds at most ``remembered`` words besides those of one text.
    """
    merges = Merges(path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    numbered = rows.mapInArrow(_numbered(path, pattern, remembered), "doc_id long, _base long, _codes array<int>, _new array<array<int>>")
    folds = _let(merges.tables, lambda t: F.transform("_new", lambda w: merges.fold(t, w)))
    folded = numbered.select("doc_id", "_base", "_codes", folds.alias("_folded"))
    spelt = _let(merges.pieces, lambda t: F.transform("_folded", lambda w: F.unhex(F.array_join(F.transform(w, lambda i: F.get(t, i)), ""))))
    return folded.withColumn("_pieces", spelt).mapInArrow(_assembled(path), "doc_id long, ids array<int>, decoded binary")
