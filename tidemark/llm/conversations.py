"""Repair of conversation structure by least-cost edits, computed once for each shared prefix of signatures.

A row's symbol is the class of its role's initial and its first fault; a conversation's symbols in order are its
signature.  Equal signatures are one row; distinct ones are range-partitioned and sorted, so that a walk over them is a
walk over a prefix trie: the layers of the dynamic programme for the prefix shared with the signature before are kept,
only new nodes get a layer, and an answer leaves at each terminal node.  Answers go back to conversations by signature.

The automaton of ``(s?(ua)+)?`` has four states, so a layer is four entries: cost, place among the layer's audits, and the way back.
Rows of a conversation stream through one task, sorted; only counters, the symbols and a digest are held, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters that are not white space.
VISIBLE = r"[^\x20\x09-\x0D]"
#: What edits cost; rows that are cut short and stay cost more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEEPS = {"s": {_START: _SYSTEM}, "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, "a": {_USER: _ASSISTANT}, "": {q: q for q in range(4)}, "?": {}}
#: The state after a row that is inserted or given another role; it says which role that is.
_NEXT = {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER, _USER: _ASSISTANT}
#: Symbols: classes of initials by faults, one character for each pair.
CLASSES, FAULTS = ("s", "u", "a", "", "?"), ("sound", "truncated", "blank", "duplicate")
_SYMBOLS = {chr(ord("A") + 4 * i + j): (c, f) for i, c in enumerate(CLASSES) for j, f in enumerate(FAULTS)}
_LEGAL = ("su", "ua", "au")

Entry = tuple[int, int, str] | None  # cost above the layer's least, rank of the audit's base, what follows the base


def _layer(best: dict[int, tuple[int, int, str, int, str]]) -> tuple[int, tuple[Entry, ...], tuple]:
    """Closes a layer under inserts: its least cost, its entries relative to that, and (state before, letters) of each."""
    for _ in range(3):
        for q, (cost, rank, tail, before, letters) in sorted(best.items()):
            new = (cost + INSERT, rank, tail + "I", before, letters + "I")
            if _NEXT[q] not in best or new[:3] < best[_NEXT[q]][:3]:
                best[_NEXT[q]] = new
    least = min(v[0] for v in best.values())
    entries: list[Entry] = [None] * 4
    place, base = -1, None
    for rank, tail, q in sorted((v[1], v[2], q) for q, v in best.items()):
        if base is None or rank != base[0] or not tail.startswith(base[1]):
            place, base = place + 1, (rank, tail)
        entries[q] = (best[q][0] - least, place, tail[len(base[1]) :])
    return least, tuple(entries), tuple(best[q][3:] if q in best else None for q in range(4))


@cache
def first_layer() -> tuple[int, tuple[Entry, ...], tuple]:
    return _layer({_START: (0, 0, "", _START, "")})


@cache
def next_layer(entries: tuple[Entry, ...], symbol: str) -> tuple[int, tuple[Entry, ...], tuple]:
    """The layer after one more row.

    Two audits of one layer and cost differ before either ends, since what one would have more are inserts, which cost;
    so the least of each state is enough.
    """
    kind, fault = _SYMBOLS[symbol]
    best: dict[int, tuple[int, int, str, int, str]] = {}

    def offer(to: int, q: int, cost: int, letter: str) -> None:
        base, rank, tail = entries[q]
        new = (base + cost, rank, tail + letter, q, letter)
        if to not in best or new[:3] < best[to][:3]:
            best[to] = new

    for q in range(4):
        if entries[q] is None:
            continue
        offer(q, q, DELETE, "D")
        if fault in ("sound", "truncated"):
            more = TRUNCATED if fault == "truncated" else 0
            if q in _KEEPS[kind]:
                offer(_KEEPS[kind][q], q, more, "K")
            offer(_NEXT[q], q, REROLE + more, "R")
    return _layer(best)


def solved(signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """``(signature, cost, audit)`` of sorted signatures; a stack of layers is the path in the trie."""
    path, costs, entries, backs = "", [0], [first_layer()[1]], [first_layer()[2]]
    for signature in signatures:
        n = shared = min(len(path), len(signature))
        if path[:n] != signature[:n]:
            low, high = 0, n  # longest shared prefix
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if path[:mid] == signature[:mid] else (low, mid - 1)
            shared = low
        del costs[shared + 1 :], entries[shared + 1 :], backs[shared + 1 :]
        for symbol in signature[shared:]:
            more, layer, back = next_layer(entries[-1], symbol)
            costs.append(costs[-1] + more)
            entries.append(layer)
            backs.append(back)
        path = signature
        cost, q = min((entries[-1][q], q) for q in (_START, _ASSISTANT) if entries[-1][q] is not None)
        total, letters = costs[-1] + cost[0], []
        for back in reversed(backs):
            q, step = back[q]
            letters.append(step)
        yield signature, total, "".join(reversed(letters))


def applied(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The repaired ``(role, text)`` rows."""
    edits, state = iter(audit), _START
    rows = iter(rows)
    for edit in edits:
        role, text = (None, "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            initial = role[:1]
            state = _KEEPS[initial if initial in ("s", "u", "a", "") else "?"][state]
        else:
            state = _NEXT[state]
            role = "user" if state == _USER else "assistant"
        yield role, text


def marked(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """``(_c, _conv, _turn, _role, _text, _copy, _gone, _symbol)`` for each row; null roles and texts are one space.

    ``gone`` names a boolean column of rows that stand for a conversation without being part of it.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    own = F.when(F.col(conv).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(conv).cast("string")))
    lost = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    rows = turns.select(own.alias("_c"), F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("_turn"), space(role).alias("_role"), space(text).alias("_text"), lost.alias("_gone")).repartition("_c")
    copy = F.row_number().over(Window.partitionBy("_c", "_gone", "_role", "_text").orderBy(F.asc_nulls_first("_turn")))
    initial = F.substring("_role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).when(initial == "", 3).otherwise(4)
    last = F.regexp_extract("_text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", 2).when(F.col("_copy") > 1, 3).when(~last.isin(".", "!", "?"), 1).otherwise(0)
    return rows.withColumn("_copy", copy).withColumn("_symbol", F.when(~F.col("_gone"), F.char(F.lit(ord("A")) + 4 * kind + fault)))


_SUMMARY = "_c string, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn."""
    out: list[tuple] = []
    conv, symbols, low, high, distinct, illegal, before = None, [], None, None, 0, 0, None

    def whole() -> None:
        signature = "".join(symbols)
        faults = [sum(signature.count(s) for s, (_, f) in _SYMBOLS.items() if f == name) for name in ("blank", "duplicate", "truncated")]
        out.append((conv, high - low + 1 - distinct if distinct else 0, *faults, illegal, signature))

    def sent() -> pa.RecordBatch:
        names = [f.split()[0] for f in _SUMMARY.split(", ")]
        types = [pa.string(), *[pa.int64()] * 5, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    for batch in batches:
        for c, turn, symbol in zip(*(batch.column(x).to_pylist() for x in ("_c", "_turn", "_symbol")), strict=True):
            if c != conv:
                if conv is not None:
                    whole()
                conv, symbols, low, high, distinct, illegal, before = c, [], None, None, 0, 0, None
            if symbol is None:
                continue
            symbols.append(symbol)
            if turn is not None and turn != high:
                low, high, distinct = turn if low is None else low, turn, distinct + 1
            kind = _SYMBOLS[symbol][0]
            illegal += before is not None and before + kind not in _LEGAL
            before = kind
        if len(out) > 10_000:
            yield sent()
            out.clear()
    if conv is not None:
        whole()
    if out:
        yield sent()


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sorted_signatures() -> Iterator[str]:
        for batch in batches:
            yield from batch.column(0).to_pylist()

    held: list[tuple[str, int, str]] = []
    size = 0
    for found in solved(sorted_signatures()):
        held.append(found)
        size += len(found[0])
        if size > 1 << 22:
            yield _answer_batch(held)
            held, size = [], 0
    if held:
        yield _answer_batch(held)


def _answer_batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["signature", "cost", "audit"])


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions("_c", *first, F.asc_nulls_first("_turn"), "_role", "_text", "_copy")


def audits(rows: DataFrame) -> DataFrame:
    """``(_c, gaps, blank, duplicate, truncated, illegal, cost, audit)`` for each conversation of ``marked`` rows."""
    summary = _sorted(rows).select("_c", "_turn", "_symbol").mapInArrow(_summed, _SUMMARY)
    distinct = summary.select("signature").distinct()
    answers = distinct.repartitionByRange("signature").sortWithinPartitions("signature").mapInArrow(_answers, "signature string, cost long, audit string")
    return summary.join(answers, "signature").drop("signature")


def _streamed(rows: DataFrame, found: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``f`` over rows sorted by conversation, each behind one row that holds the audit."""
    own = rows.where(~F.col("_gone")).select("_c", F.lit(1).alias("_part"), "_turn", "_role", "_text", "_copy")
    heads = found.select("_c", F.lit(0).alias("_part"), F.lit(None).cast("long").alias("_turn"), F.lit("").alias("_role"), F.col("audit").alias("_text"), F.lit(0).alias("_copy"))
    return _sorted(own.union(heads).repartition("_c"), "_part").select("_c", "_part", "_role", "_text").mapInArrow(f, schema)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[tuple[str, str]]]]:
    """Each conversation with its repaired rows; these must be taken before the next is asked for."""
    flat = (r for b in batches for r in zip(*(b.column(x).to_pylist() for x in ("_c", "_part", "_role", "_text")), strict=True))
    ahead = next(flat, None)
    while ahead is not None:
        conv, audit = ahead[0], ahead[3]
        ahead = next(flat, None)

        def own() -> Iterator[tuple[str, str]]:
            nonlocal ahead
            while ahead is not None and ahead[0] == conv and ahead[1]:
                yield ahead[2:]
                ahead = next(flat, None)

        rows = own()
        yield conv, applied(rows, audit)
        for _ in rows:  # none is left if all edits were applied
            pass


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple[str, str]] = []
    for conv, rows in _conversations(batches):
        digest, mark = hashlib.sha256(), b""
        for role, text in rows:
            digest.update(mark + f"{role}:{text}".encode())
            mark = b"\n"
        out.append((conv, digest.hexdigest()))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["_c", "repaired_sha256"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["_c", "repaired_sha256"])


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple[str, int, str, str]] = []
    names, types = ["_c", "position", "role", "text"], [pa.string(), pa.int64(), pa.string(), pa.string()]
    for conv, rows in _conversations(batches):
        for at, (role, text) in enumerate(rows):
            out.append((conv, at, role, text))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def repaired_turns(turns: DataFrame, **columns: str) -> DataFrame:
    """The conversations after repair: ``(conv_id, position, role, text)``; conversations of which nothing stays have no row."""
    rows = marked(turns, **columns)
    names = rows.groupBy("_c").agg(F.min("_conv").alias("conv_id"))
    return _streamed(rows, audits(rows), _rows_out, "_c string, position long, role string, text string").join(names, "_c").select("conv_id", "position", "role", "text")


def repaired_conversations(turns: DataFrame, **columns: str) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` for each conversation.

    Rows are taken by turn (nulls first), rows of one turn by role and text.  A null conversation id is a conversation of its
    own; null roles and texts count as one space; a role without a character adds no initial.  Roles are told by their first
    letter as it is written.  Repeated rows are duplicates.  A conversation all of whose rows are ``gone`` has zeros, an empty audit and the digest
    of nothing; an empty table gives no rows; other columns are not read.  The digest of a conversation is a chain over its texts, so
    it is made by one task, which holds one batch of them.
    """
    rows = marked(turns, **columns)
    found = audits(rows)
    digests = _streamed(rows, found, _digested, "_c string, repaired_sha256 string")
    names = rows.groupBy("_c").agg(F.min("_conv").alias("conv_id"))
    return names.join(found, "_c").join(digests, "_c").drop("_c")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by the CRC-32 of their place, to try the repair on: dropped (kept as ``gone``), emptied, cut short, repeated or given the user's role."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    body = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    names = F.when(F.col("_code") == 4, "user").otherwise(space(role))
    times = F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = turns.select(conv, turn, role, text, code.alias("_code")).withColumn("_n", times)
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), names.alias("role"), body.alias("text"), (F.col("_code") == 0).alias("gone"))
