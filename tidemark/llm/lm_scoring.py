"""Cross-entropy difference of each document under matched target and background n-gram models.

Both are word bigram models: a bigram's count is smoothed by ``PRIOR`` occurrences dealt as the word model deals
them, a word's by ``ADDED`` a word of the vocabulary.  Vocabulary (every word of every document, and the text's end),
order and smoothing are the same; only the counts differ.  The background counts cover all documents, the target
counts those that a label calls good.  Counts are spread over the cluster and grow with the corpus: nothing is
broadcast, and the driver reads three totals.

Texts lie in blocks of about ``BLOCK`` bytes.  A block, or each part of it that one task reads, asks once for each of its different words and bigrams: it sends
sorted 64-bit names with its own counts, cut at fixed names into one row a range, and gets back the corpus counts in
the same order.  So a hot word is one name a block, not one an occurrence; the tables of a block are bounded by its
bytes, and ranges are as many as keep the names of one bounded.  Words are runs of bytes without ASCII white space;
words and bigrams with equal names (hashes of 63 bits) count as one, some hundreds of pairs among 10**11 names.
A document's score is the mean over its words and its end of target loss minus background loss: low is close to the target.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

#: Bytes of text in a block (a longer text is a block of its own), and bytes of text whose names make a range on average.
BLOCK, RANGE = 1 << 24, 1 << 24
#: Smoothing: occurrences of a word before any is counted, and of each history as its words are.
ADDED, PRIOR = 0.1, 5.0
#: The end of a text, which is also what stands before its first word.
EDGE = 1
_CACHED, _LONG = 500_000, 64


class _Hashes(dict):
    """An odd 64-bit name of each word; keeps short words, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word) | 1
        if len(word) <= _LONG:
            if len(self) >= _CACHED:
                self.clear()
            self[word] = found
        return found


def _tokens(text: bytes, hashes: _Hashes) -> np.ndarray:
    """The names of the text's words and of its end; nothing for a text without words."""
    found = text.split()
    out = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    return np.append(out, np.uint64(EDGE)) if found else out


def _bigrams(tokens: np.ndarray) -> np.ndarray:
    """An even name for each token with the one before it."""
    before = np.roll(tokens, 1)
    return ((before << np.uint64(23) | before >> np.uint64(41)) ^ tokens) & ~np.uint64(1)


def _packed(values: np.ndarray) -> bytes:
    """Numbers as their width in bytes, then compressed planes: all low bytes, all second bytes and so on."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max((int(values.max(initial=0)).bit_length() + 7) // 8, 1)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, : data[0]] = raw.T
    return out.view(np.uint64).ravel()


def _values(column: pa.ChunkedArray) -> Iterator[bytes]:
    return (v.as_py() for chunk in column.chunks for v in chunk)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of a partition by the bytes before them, and from 0."""
    seen, at, first = 0, 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = seen + np.cumsum(sizes)
        seen = int(ends[-1]) if len(ends) else seen
        block, row = first + (ends - sizes) // BLOCK, np.arange(at, at + len(sizes))
        at += len(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(row), *batch.columns], ["_block", "_row", *batch.schema.names])


def _counted(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([np.empty(0, np.uint64), *tokens, *(_bigrams(t) for t in tokens)])
    return np.unique(every, return_counts=True)


def _edges(n_ranges: int) -> np.ndarray:
    return np.array([(i << 64) // n_ranges for i in range(n_ranges)], np.uint64)


def _asked(n_ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The different names of each run of rows of a block and their counts, one row for each range that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, hashes = _edges(n_ranges), _Hashes()
        held: list[tuple[np.ndarray, bool]] = []
        block = start = after = -1

        def out() -> Iterator[pa.RecordBatch]:
            names, background = _counted([t for t, _ in held])
            some, n = _counted([t for t, good in held if good])
            target = np.zeros(len(names), np.uint64)
            target[np.searchsorted(names, some)] = n
            cuts = np.append(np.searchsorted(names, edges), len(names))
            used = np.flatnonzero(np.diff(cuts))
            for some in np.array_split(used, 1 + len(used) // 1024):
                slices = [slice(cuts[i], cuts[i + 1]) for i in some]
                parts = [np.diff(names[s], prepend=edges[i]) for i, s in zip(some, slices)], [target[s] for s in slices], [background[s] for s in slices]
                same = [pa.array(np.full(len(some), v, np.int64)) for v in (block, start)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(some.astype(np.int64)), *(pa.array(list(map(_packed, p)), pa.binary()) for p in parts)], ["block", "start", "range", "names", "target", "background"])

        for batch in batches:
            columns = (batch.column(c) for c in ("_block", "_row", "_text", "_target"))
            for of, row, text, good in zip(*columns):
                of, row = of.as_py(), row.as_py()
                if (of, row) != (block, after):
                    if held:
                        yield from out()
                    held, block, start = [], of, row
                after = row + 1
                held.append((_tokens(text.as_py().encode(), hashes), good.as_py()))
        if held:
            yield from out()

    return run


def _answered(n_ranges: int) -> Callable[[pa.Table], pa.Table]:
    """For each row of one range the corpus counts of its names; beside them the range's words and their occurrences."""

    def run(asked: pa.Table) -> pa.Table:
        edge = _edges(n_ranges)[asked.column("range")[0].as_py()]
        held = [np.cumsum(_unpacked(v)) + edge for v in _values(asked.column("names"))]
        names, where = np.unique(np.concatenate(held), return_inverse=True)
        sums = [np.bincount(where, np.concatenate(list(map(_unpacked, _values(asked.column(c)))))).astype(np.uint64) for c in ("target", "background")]
        words = names & np.uint64(1) == 1
        total = [int(words.sum()), *(int(n[words].sum()) for n in sums)]
        ends = np.cumsum([len(h) for h in held])
        slices = [where[e - len(h) : e] for h, e in zip(held, ends, strict=True)]
        replies = {f"sum_{c}": pa.array([_packed(n[s]) for s in slices], pa.binary()) for c, n in zip(("target", "background"), sums, strict=True)}
        same = {n: pa.array(np.full(len(held), v, np.int64)) for n, v in zip(("words", "target", "background"), total, strict=True)}
        return pa.table({**{c: asked.column(c) for c in ("block", "start", "range")}, **replies, **same})

    return run


def _scored(size: int, totals: tuple[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores the texts of one block by the answers that its parts got."""
    base = np.array(totals) + ADDED * size

    def score(t: np.ndarray, names: np.ndarray, sums: np.ndarray) -> float:
        if not len(t):
            return 0.0
        word, pair = sums[np.searchsorted(names, t)], sums[np.searchsorted(names, _bigrams(t))]
        below = (word + ADDED) / base
        p = (pair + PRIOR * below) / (np.roll(word, 1, axis=0) + PRIOR)
        return float(np.log(p[:, 1] / p[:, 0]).mean())

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts, answers, hashes = texts.sort_by("_row"), answers.sort_by([("start", "ascending"), ("range", "ascending")]), _Hashes()
        tokens = [_tokens(v.encode(), hashes) for v in _values(texts.column("_text"))]
        of = answers.column("start").to_numpy()
        # a part without words asks nothing: its texts have no tokens and may stand with the part before
        cuts = np.append(np.searchsorted(texts.column("_row").to_numpy(), np.unique(of)), len(tokens))
        scores = [0.0] * len(tokens)
        for start, a, b in zip(np.unique(of), cuts, cuts[1:]):
            part = answers.filter(pc.equal(answers.column("start"), start))
            names, _ = _counted(tokens[a:b])
            sums = np.stack([np.concatenate(list(map(_unpacked, _values(part.column(c))))) for c in ("sum_target", "sum_background")], 1).astype(float)
            if len(sums) != len(names):
                raise ValueError(f"{len(sums)} answers for {len(names)} names")
            scores[a:b] = [score(t, names, sums) for t in tokens[a:b]]
        lengths = [max(len(t) - 1, 0) for t in tokens]
        return pa.table({"doc_id": texts.column("_id"), "n_tokens": pa.array(lengths, pa.int64()), "score": pa.array(scores, pa.float64())})

    return run


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score`` for each document; ``targets`` has the ids whose texts train the target model.

    Null and wordless texts have no tokens and score 0; ids may be null (never a target) or repeated; without any
    target text the target model is uniform over the shared vocabulary; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    good = targets.select(F.col(targets.columns[0]).cast("long").alias("_id")).where("_id is not null").distinct().withColumn("_good", F.lit(True))
    # texts meet ids by a merge at every size: how many targets there are has no bound
    marked = rows.join(good.hint("merge"), "_id", "left").select("_id", "_text", F.coalesce("_good", F.lit(False)).alias("_target"))
    blocked = scratch.written(marked.mapInArrow(_blocked, "_block long, _row long, _id long, _text string, _target boolean"), "lm-texts")
    size = blocked.agg(F.coalesce(F.sum(F.octet_length("_text").cast("long")), F.lit(0))).first()[0]
    n_ranges = 1 + size // RANGE
    asked = blocked.select("_block", "_row", "_text", "_target").mapInArrow(_asked(n_ranges), "block long, start long, `range` long, names binary, target binary, background binary")
    answered = asked.groupBy("range").applyInArrow(_answered(n_ranges), "block long, start long, `range` long, sum_target binary, sum_background binary, words long, target long, background long")
    answers = scratch.written(answered, "lm-answers")
    names = ("words", "target", "background")
    total = answers.select("range", *names).distinct().agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)).first()
    replies = answers.drop(*names)
    scored = blocked.drop("_target").groupBy("_block").cogroup(replies.groupBy("block")).applyInArrow(_scored(total.words, (total.target, total.background)), "doc_id long, n_tokens long, score double")
    out = scratch.written(scored, "lm-scores")
    scratch.drop(blocked, answers)
    return out
