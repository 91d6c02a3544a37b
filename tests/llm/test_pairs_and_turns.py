"""Hard negatives, conversation repair and the similarity join against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import conversations as C
from tidemark.llm import hard_negatives as H
from tidemark.llm import jaccard_join as J

VECTORS = "vec_id long, embedding array<double>, label int, panel string, at int"


def _mined(rows):
    """Hard negatives of anchors divisible by 5, by plain loops; rows that take no part are left out, of repeated ids the least stays."""
    fit = {}
    for i, v, label, *_ in rows:
        if None in (i, v, label) or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * x)) for x in v]
        if sum(x * x for x in q) < 2**56:
            fit[i] = min(fit.get(i, (label, q)), (label, q))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in (i for i in fit if i % 5 == 0):
        order = sorted(((-score(fit[a][1], v), i, label) for i, (label, v) in fit.items() if i != a))
        for s, p, _ in [o for o in order if o[2] == fit[a][0]][:5]:
            inside = [o for o in order if o[2] != fit[a][0] and 50 * -s <= 100 * -o[0] <= 95 * -s]
            out += [(a, p, r, o[1], -s, -o[0]) for r, o in enumerate(inside[:3], 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=7).round(1).tolist(), int(rng.integers(3)) if i % 3 else 0, "x", 1) for i in range(120)]
    rows += [(200, None, 1, "x", 1), (205, [1.0, None], 1, "x", 1), (210, [float("nan")] * 7, 0, "x", 1), (215, [float("inf")], 0, "x", 1), (220, [1e9], 0, "x", 1)]
    rows += [(None, [1.0] * 7, 0, "x", 1), (225, [1.0] * 7, None, "x", 1), (230, [], 1, "x", 1), (235, [0.5, 0.5], 2, "x", 1), (0, [0.1] * 7, 2, "x", 1), rows[4], rows[4]]
    df = spark.createDataFrame(rows, VECTORS)
    found = H.hard_negatives(df, "id % 5 = 0", rows=20, anchor_rows=4, chunk=3)
    assert sorted(map(tuple, found.collect())) == _mined(rows)
    assert not H.hard_negatives(df.limit(0), "id % 5 = 0").count()
    assert not H.hard_negatives(df.where("label = 0"), "id % 5 = 0").count()


def test_products_stay_exact():
    a = np.array([[1 << 27, 3], [-5, 1 << 26]])
    assert (H.product(a, a) == a @ a.T).all() and (H._tile(H._planes(H.product(a, a)), 2) == a @ a.T).all()


def test_tiles_are_added_where_they_arise(spark):
    """Panels are exchanged, partial tiles are not: above the step that makes scores there is no exchange."""
    rows = spark.createDataFrame([(i % 2, i, i % 3, [i, 1 - i, 2]) for i in range(12)], "at long, id long, label long, v array<long>")
    grid = H._blocks(rows, 3)
    along = grid.withColumn("j", H.F.explode(H.F.array(H.F.lit(0).cast("long"), H.F.lit(1).cast("long")))).drop("at")
    tiles = H._summed_tiles(along, grid, 3, 2, H.partial(H.nearest_of_label, count=9), ["anchor", "id", "score"])
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")
    v = {i: np.array([i, 1 - i, 2]) for i in range(12)}
    assert sorted(map(tuple, tiles.collect())) == sorted((a, b, int(v[a] @ v[b])) for a in v for b in v if a != b and a % 3 == b % 3)


def _cheapest(rows):
    """The least (cost, audit) over all edits of ``(role, fault)`` rows, by trying them all."""
    best = []

    def go(i, cost, audit, initials, run):
        if cost > 2 * len(rows):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best.append((cost, audit))
        for x in "ua" if run < 2 else "":
            go(i, cost + 5, audit + "I", initials + x, run + 1)
        if i < len(rows):
            role, fault = rows[i]
            go(i + 1, cost + 2, audit + "D", initials, 0)
            if fault in ("sound", "truncated"):
                more = 5 * (fault == "truncated")
                go(i + 1, cost + more, audit + "K", initials + role[:1], 0)
                for x in "ua":
                    go(i + 1, cost + 1 + more, audit + "R", initials + x, 0)

    go(0, 0, "", "", 0)
    return min(best)


def _symbols(rows):
    of = {v: k for k, v in C._SYMBOLS.items()}
    return "".join(of[r[:1] if r[:1] in ("s", "u", "a", "") else "?", f] for r, f in rows)


def test_audits_equal_all_edits_tried():
    rng = random.Random(5)
    for _ in range(250):
        rows = [(rng.choice(["system", "user", "assistant", "", "tool"]), rng.choice(C.FAULTS)) for _ in range(rng.randrange(5))]
        assert next(C.solved(iter([_symbols(rows)])))[1:] == _cheapest(rows)


def test_shared_prefixes_give_what_each_signature_gives_alone():
    rng = random.Random(6)
    some = sorted({"".join(rng.choice(sorted(C._SYMBOLS)) for _ in range(rng.randrange(9))) for _ in range(2000)})
    assert list(C.solved(iter(some))) == [next(C.solved(iter([s]))) for s in some]
    long = "".join(rng.choice("ABEFIJ") for _ in range(50_000))
    assert len(list(C.solved(iter([long[:-1] + "A", long[:-1] + "B"])))) == 2


def _plain(rows):
    """Damage and repair of ``(conv, turn, role, text)`` rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            kept += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        seen, faults = set(), []
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "sound" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit = _cheapest([(r[1], f) for r, f in zip(kept, faults, strict=True)])
        mended, state, at = [], "", iter(kept)
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(at)
            if edit != "D":
                role = role if edit == "K" else "assistant" if state == "u" else "user"
                state = role[:1] or state
                mended.append(f"{role}:{text}")
        odd = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, odd, cost, audit, hashlib.sha256("\n".join(mended).encode()).hexdigest())
    return out


def test_conversations_equal_a_plain_version(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No", " \t\n", "", None, "Why?", "So!\n ", "cut.. off", " "]
    rows = [(c if c % 9 else None, rng.choice([None, *range(5)]), rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool", "User"]), rng.choice(texts)) for c in range(60) for _ in range(rng.randrange(1, 5)) if c % 9 or c == 9]
    rows += [(1000 + c, t, "user" if t % 2 == 0 else "assistant", "Hm.") for c in range(80) for t in range(2)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, _c int")
    found = C.repaired_conversations(C.damaged(df), gone="gone").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == _plain(rows)
    assert not C.repaired_conversations(df.limit(0)).count()
    turns = C.repaired_turns(C.damaged(df), gone="gone").orderBy("conv_id", "position").collect()
    for conv, (*_, digest) in _plain(rows).items():
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns if r.conv_id == conv).encode()).hexdigest() == digest


def _classes(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {b" ".join(w)} if 0 < len(w) < 3 else {b" ".join(w[k : k + 3]) for k in range(len(w) - 2)}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def _chains(n, seed):
    """Texts that share words, chains of near copies, exact copies, a passage that many hold, blanks and nulls."""
    rng, out = random.Random(seed), [None, "", " \t ", "One", "one", "one two", "One  TWO", "Éa b c", "éa b c"]
    words = [f"w{i}" for i in range(400)]
    common = rng.choices(words, k=40)
    for _ in range(n):
        text = rng.choices(words, k=rng.randrange(30, 90))
        for _ in range(rng.randrange(6)):
            out.append(" ".join(text if rng.random() < 0.7 else text + common))
            text = list(text)
            text[rng.randrange(len(text))] = rng.choice(words)
    return out + [" ".join(common)] * 3


@pytest.mark.parametrize("split, quota", [(J.SPLIT, J._QUOTA), (8, 1)])
def test_similarity_join_equals_brute_force(spark, monkeypatch, split, quota):
    monkeypatch.setattr(J, "_QUOTA", quota)
    texts = list(enumerate(_chains(40, 11)))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, _node string, a int")
    found = {r[0]: (r[1], r[2]) for r in J.jaccard_components(df, split=split).select("_id", "n_shingles", "component").collect()}
    assert found == _classes(texts)


def test_similarity_join_of_odd_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "x"), (None, None), (7, "a b c e f")]
    found = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r[0] or 0, r[1], r[2] or 0) for r in found) == sorted([(5, 2, 5), (5, 2, 5), (0, 2, 5), (0, 1, 0), (0, 0, 0), (7, 3, 7)])
    assert not J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count()


def test_no_pair_is_lost_by_the_filters():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        y = x.copy()
        y[rng.integers(0, n, rng.integers(0, 3))] = rng.integers(0, 1 << 63, 1).astype(np.uint64)
        x, y = np.unique(x), np.unique(y)
        if not J.alike(x, y):
            continue
        levels = rng.integers(0, 3, J.BUCKETS).astype(np.uint8)
        order = [s[np.lexsort((s, levels[(s >> np.uint64(44)).astype(np.int64)]))] for s in (x, y)]
        first = [o[: J.prefix_length(len(o))] for o in order]
        both = np.intersect1d(*first)
        assert len(both)
        bits = np.stack([np.packbits(np.bincount((s % np.uint64(1024)).astype(np.int64), minlength=1024).astype(np.uint8) & 1).view(np.uint64) for s in (x, y)])
        for t in both:
            pos = np.array([int(np.flatnonzero(f == t)[0]) for f in first])
            assert len(J.candidates(np.array([len(x), len(y)]), pos, bits, np.array([0]), np.array([1]))[0]) == 1
