"""Operators against brute force on small rows with nulls, empty and long texts, ties, repeated rows and extra columns."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, grouped, html_text, lm_scoring, near_copies, neighbours, packing, quality, sharding, simhash, suffixes, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component long, _fp string"
WORDS = "amber basin cedar delta ember fjord grove haven inlet jetty knoll lagoon marsh notch oasis prairie quarry ridge shoal tundra".split()


def _prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 50, n)))


PASSAGE = _prose(99, 60)
ROWS = [
    (0, _prose(0, 120), "en", "a"), (1, _prose(0, 120), "en", "a"), (2, _prose(0, 119) + " changed", "en", "b"), (3, None, "en", "a"), (4, "", None, None),
    (5, "  \t\n ", "en", "a"), (6, _prose(6, 40) + " " + PASSAGE + " " + _prose(7, 40), "de", "a"), (7, _prose(8, 30) + "x" + PASSAGE + "y", "de", "a"),
    (8, "aaaa " * 300, "en", "a"), (9, "İstanbul ΣΑΣ don't it's café, naïve—’s 12345 ＡＢＣ 中文字符 😀 x\x0by\x1cz <|endoftext|>", "en", "a"), (10, "q" * 3000, "en", "a"),
    (11, _prose(11, 6000), "en", "a"), (None, "one two", "en", "a"), (None, "one two", "en", "a"), (12, _prose(12, 80), "en", "a"), (12, _prose(12, 80), "en", "a"), (13, "é" * 250 + "end", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 7, "extra") for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _bytes(text):
    return (text or "").encode()


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    assert 49407 in tokenizer.encode(ROWS[9][1], add_special_tokens=False).ids  # a special token that a text spells
    expected = Counter()
    for doc, text, *_ in ROWS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            expected[doc, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    found = packing.packed_documents(docs, path).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.packed_documents(none, path).count() == 0


def test_packing_worker_keeps_few_words(monkeypatch):
    """A worker outlives the task: what it remembers afterwards must not grow with the texts it has seen."""
    monkeypatch.setattr(packing, "KEPT", 50, raising=False)
    monkeypatch.setattr(packing, "_ROWS", 4)
    path = public_tokenizers.path("word_bpe_49k.json")
    packing._word_ids.cache_clear()
    texts = [_prose(seed, 200).replace(" ", ", ") + f" é{seed}x don't" for seed in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], ["_id", "_text"])
    for most in (1 << 20, 100):  # caches that are never full, and full ones
        monkeypatch.setattr(packing, "CACHE", most)
        found = [x for out in packing._pieces(path, 4096, 2, True)(iter([batch])) for x in out.column("ids").to_pylist()]
        plain = Tokenizer.from_file(path)
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        words = packing._word_ids(path)
        assert 0 < len(words.known) <= 50 and len(words.words) <= 50
    packing._word_ids.cache_clear()


def test_patterns_use_every_piece_once():
    histogram = {4096: 3, 3000: 5, 1000: 7, 96: 11, 5: 100}
    used = Counter()
    for pattern, count in packing.packing_patterns(histogram):
        assert sum(pattern) <= 4096
        for length in pattern:
            used[length] += count
    assert used == histogram


def test_quality_counts(docs, none):
    expected = Counter()
    for doc, text, *_ in ROWS:
        data = _bytes(text)
        words, lines = data.split(), data.split(b"\n")
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        dup = sum(1 for i, x in enumerate(lines) if x.split() and x in lines[:i])
        n, repeated = len(words), len(covered)
        expected[doc, n, sum(len(w.decode()) for w in words), sum(data.count(bytes([c])) for c in b"#*$%&|<>"), dup, repeated, n < 10 or 100 * repeated > 20 * n] += 1
    found = quality.judged(docs).collect()
    assert Counter((r._id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == expected
    assert all(r.kept != r.base_failed for r in found)  # no group is large enough here
    assert quality.judged(none).count() == 0
    assert quality.drop_outliers(docs).columns == docs.columns


def test_quality_rejects_what_stands_apart(spark):
    rows = [(i, _prose(i, 60 + i % 50), "en", "a") for i in range(300)] + [(1000 + i, " ".join(w + "###" for w in _prose(i, 80).split()), "en", "a") for i in range(20)]
    found = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r._id for r in found if not r.kept} == {1000 + i for i in range(20)}


def test_small_groups_are_judged_by_their_language(spark):
    rows = [(i, _prose(i, 60 + i % 50), "en", "a") for i in range(200)] + [(900 + i, _prose(900 + i, 70), "en", "b") for i in range(5)] + [(950, _prose(950, 70), "xx", "c")]
    odd = [(1000, " ".join(w + "###" for w in _prose(1, 80).split()), "en", "b"), (1001, " ".join(w + "###" for w in _prose(2, 80).split()), "xx", "c")]
    found = quality.judged(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")).collect()
    assert {r._id for r in found if not r.kept} == {1000, 1001}


def _fingerprint(text):
    words = _bytes(text).lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("split", [simhash.SPLIT, 1])
def test_simhash(docs, none, split):
    codes = [_fingerprint(r[1]) for r in ROWS]
    component = list(range(len(ROWS)))
    for _ in ROWS:
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a ^ b).bit_count() <= 2:
                    component[i] = min(component[i], component[j])
    least = [min((ROWS[j][0] for j in range(len(ROWS)) if component[j] == component[i] and ROWS[j][0] is not None), default=None) for i in range(len(ROWS))]
    found = simhash.near_duplicates(docs, split=split).collect()
    assert Counter((r._id, r._fp % (1 << 64), r.component) for r in found) == Counter((r[0], c, x) for r, c, x in zip(ROWS, codes, least))
    assert simhash.near_duplicates(none).count() == 0


def test_gray_index_equals_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    codes = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for _ in range(3))]))
    group = np.zeros(len(codes), np.int64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    left, right = simhash.linked_pairs(group, codes)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2
    assert set(zip(left.tolist(), right.tolist())) == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}


def test_near_duplicates_keep_one_of_each(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 1 not in ids and 12 in ids


def test_null_and_repeated_ids_name_no_component(spark):
    rows = [(None, _prose(200 + i, 80)) for i in range(5)] + [(7, _prose(300, 80)), (7, _prose(301, 80)), (None, _prose(301, 80)), (8, _prose(300, 80))]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(rows[:7])


def test_pipeline_drops_near_copies(spark, none):
    import corpus_pipeline

    def changed(seed, *places):
        words = _prose(seed, 150).split()
        for at in places:
            words[at] = f"new{at}"
        return " ".join(words)

    texts = [changed(1), changed(1, 20, 90), changed(1, 20, 60, 90, 120), changed(1, 60, 120, 140), changed(2), changed(2, *range(0, 150, 10)), changed(3), changed(3, 5), "", None, " ", "a b", "A  b"]
    rows = [(i, t) for i, t in enumerate(texts)]
    sets = [{tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set() for w in ((t or "").lower().split() for t in texts)]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 5 * len(a & b) >= 4 * len(a | b):
                    label[i] = min(label[i], label[j])
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label)) and 5 in label and len(set(label)) < 7
    assert corpus_pipeline.near_duplicates(spark, none, "").count() == 0


def test_near_copies_come_through_the_gray_order_index(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(near_copies, "gray_pairs", lambda marked, real=near_copies.gray_pairs: asked.append(real(marked)) or asked[-1])
    monkeypatch.setattr(near_copies, "band_keys", lambda s: np.arange(near_copies.BANDS) * 1_000_003 + len(s) * 7919 if len(s) else np.zeros(near_copies.BANDS, np.int64))
    words = _prose(41, 3000).split()
    changed = [*words[:1500], "other", *words[1500:]]
    other = _prose(42, 500)
    rows = [(0, " ".join(words)), (1, " ".join(changed)), (2, other), (3, None), (4, " ")]
    found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    root = {r._id: r.root for r in found}
    assert asked and root[0] == root[1] != root[2] and root[3] == root[4]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


@pytest.mark.parametrize("odd", ["If x <y, it's so.", '<a href="/x>link</a>', "<svg class='i'/>", "<math/>", "<canvas>", "<object data=x>", "<video src=x>", "</ >", "a <b it's", "<canvas><canvas></canvas>"])
def test_html_goes_on_after_odd_tags(odd):
    blocks = [_prose(n, 40) for n in range(3)]
    found = html_text.main_text(f"<html><body><p>{blocks[0]}</p><p>{odd}</p><p>{blocks[1]}, it's</p><p>{blocks[2]}</p></body></html>")
    assert all(b in found for b in blocks)
    assert html_text.main_text(f"<p>{blocks[0]}</p><svg><title>{blocks[1]}</title></svg><a href='x") == blocks[0]


@pytest.mark.parametrize("bucket", [suffixes.BUCKET, 5])
def test_repeated_strings(docs, none, bucket, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    size = suffixes.LENGTH
    texts = [_bytes(r[1]) for r in ROWS]
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    expected = Counter()
    for (doc, *_), text in zip(ROWS, texts):
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                gone[i : i + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum())
        kept = bytes(b for b, g in zip(text, gone) if not g)
        expected[doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    found = suffixes.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(s.last - s.first for s in r.spans), len(r.spans), r.kept_sha256) for r in found) == expected
    assert suffixes.without_repeats(none).count() == 0
    assert suffixes.drop_repeats(docs).count() == len(ROWS)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/ b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "é\r\n\r\nWARC/1.1\r\n" * 50), (6, "http://f", "y" * 3_000_000), (None, "http://g", "z")]
    found = warc.archived_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    last = {}
    for page, _, html in rows:
        last[html or ""] = max(last.get(html or "", page), page) if page is not None else None
    expected = {(p, len(_bytes(h)), base64.b32encode(hashlib.sha1(_bytes(h)).digest()).decode(), "response" if last[h or ""] == p else "revisit", None if last[h or ""] == p else last[h or ""]) for p, _, h in rows}
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == expected and len(found) == len(rows)
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_carry_uri_and_date(spark):
    pages = [(i, f"http://example.org/{i}?a=b c", f"<p>Tel\nnumber 5000\nx {i % 3}" if i % 2 else "one\ntwo 7\nfiledesc://x 1") for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    records = warc.converted(warc.pages_as_arc(df)).collect()
    assert {r.page_id: (r.uri, r.date) for r in records if r.kind == "response"} == {i: (warc._field(u), warc._iso(warc._STAMP)) for i, u, _ in pages}
    assert sum(r.kind == "warcinfo" for r in records) == warc.pages_as_arc(df).count()


def test_no_bytes_end_a_conversion(spark):
    rng = random.Random(4)
    lines = [b"a b 3", b"filedesc://x 0.0.0.0 2020 text/plain 9", b"1 0 x", b"URL Archive-date 2", b"", b"http://x 1 2 3 4", b"\xff 12", b"Tel", b"number 5000"]
    some = [b"\n".join(rng.choice(lines) for _ in range(rng.randrange(9))) for _ in range(400)] + [bytes(rng.randrange(256) for _ in range(60)) for _ in range(100)]
    warc.converted(spark.createDataFrame([(bytearray(x),) for x in some], "content binary")).collect()


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records(version):
    blocks = [("http://a/ b", "20200102030405", "text/html", b"one\ntwo"), (None, "2020", "text/plain", b"")]
    info, *found = warc.arc_records(warc.arc_file("x.arc", version, blocks))
    assert info["info"] and info["URL"] == "filedesc://x.arc"
    assert [(r["URL"], r["Archive-date"], r["block"], r["version"]) for r in found] == [("http://a/%20b", "20200102030405", b"one\ntwo", version), ("-", "2020", b"", version)]
    assert warc._iso("2020") == "2020-01-01T00:00:00Z" and warc._iso("20200102030405") == "2020-01-02T03:04:05Z"


def test_bad_arc_records(spark, tmp_path):
    good = warc.arc_file("x.arc", 1, [("http://a", "2020", "text/html", b"HTTP/1.1 200 OK\r\n\r\nbody"), ("http://b", "2020", "text/plain", b"plain"), ("http://b", "2020", "text/plain", b"plain")])
    bad = good + b"http://c 0.0.0.0 2020 text/html ??\n\nno header at all\nhttp://d 1.2.3.4 2021 text/plain 3\nabc\nhttp://e 0.0.0.0 2020 text/plain 99\ncut"
    frame = spark.createDataFrame([(bad,), (b"",), (None,), (b"no archive",)], "content binary")
    rows = {(r.kind, r.uri, bytes(r.payload), r.truncated) for r in warc.converted(frame).collect() if r.kind != "warcinfo"}
    assert rows == {("response", "http://a", b"body", False), ("resource", "http://b", b"plain", False), ("resource", "http://d", b"abc", False), ("resource", "http://e", b"cut", True)}
    warc.convert(frame, f"file://{tmp_path}/out")
    read = warc.read_warc(spark, f"file://{tmp_path}/out").collect()
    assert Counter(r.record_type for r in read) == {"warcinfo": 1, "response": 1, "resource": 4}
    assert len({r.record_id for r in read}) == 6


def test_sharding(docs, none):
    found = sharding.exact_shards(docs, 5).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((d, len(_bytes(t)) + 8, zlib.crc32(_bytes(t))) for d, t, *_ in ROWS)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sharding.exact_shards(none).count() == 0


def test_hypergeometric_draws(spark):
    from math import comb

    from pyspark.sql import functions as F

    total, marked, drawn = 50, 20, 12
    draws = spark.range(4000).select(sharding.hypergeometric(*(F.lit(x).cast("long") for x in (total, marked, drawn)), (F.col("id") + 0.5) / 4000).alias("k")).groupBy("k").count().collect()
    share = {r["k"]: r["count"] / 4000 for r in draws}
    for k in range(drawn + 1):
        assert abs(share.get(k, 0) - comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)) < 1e-3


def test_byte_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for remembered in (byte_bpe.REMEMBERED, 1):
        found = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, remembered=remembered).collect()
        assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found) == Counter((d, tuple(library.encode_ordinary(t or "")), _bytes(t)) for d, t, *_ in ROWS)
    assert byte_bpe._PATTERN == public_tokenizers.PATTERN
    other = r"\w+|\W+"
    library = tiktoken.Encoding("other", pat_str=other, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.encode(docs, path, other).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in found if r.doc_id in (0, 3, 6)) == Counter((d, tuple(library.encode_ordinary(t or ""))) for d, t, *_ in ROWS if d in (0, 3, 6))
    assert byte_bpe.encode(none, path, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("block", [lm_scoring.BLOCK, 40])
def test_cross_entropy_difference(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(lm_scoring, "BLOCK", block)
    monkeypatch.setattr(lm_scoring, "RANGE", 1 << 24 if block > 40 else 100)
    targets = spark.createDataFrame([(6,), (7,), (None,)], "doc_id long")
    texts = {d: _bytes(t).split() for d, t, *_ in ROWS if [r[0] for r in ROWS].count(d) == 1}

    def model(some, vocabulary):
        grams = Counter(g for t in some if t for g in zip([None, *t], [*t, None]))
        words = Counter()
        for (_, w), n in grams.items():
            words[w] += n

        def p(v, w):
            below = (words[w] + lm_scoring.ADDED) / (sum(words.values()) + lm_scoring.ADDED * vocabulary)
            return (grams[v, w] + lm_scoring.PRIOR * below) / (words[v] + lm_scoring.PRIOR)

        return p

    every = [_bytes(t).split() for _, t, *_ in ROWS]
    size = len({w for t in every for w in t}) + 1
    background = model(every, size)
    for ids in ((6, 7), ()):
        target = model([_bytes(t).split() for d, t, *_ in ROWS if d in ids], size)
        found = lm_scoring.cross_entropy_difference(docs, targets if ids else targets.where("doc_id is null")).collect()
        assert Counter(r.doc_id for r in found) == Counter(d for d, *_ in ROWS)
        for r in found:
            if r.doc_id in texts:
                t = texts[r.doc_id]
                assert r.n_tokens == len(t)
                assert r.score == pytest.approx(np.mean([np.log(background(*g)) - np.log(target(*g)) for g in zip([None, *t], [*t, None])]) if t else 0, abs=1e-9)
        if ids:
            scores = {r.doc_id: r.score for r in found}
            assert scores[6] < scores[0]
    assert lm_scoring.cross_entropy_difference(none, targets).count() == 0


def test_word_hashes_are_bounded(monkeypatch):
    monkeypatch.setattr(lm_scoring, "_CACHED", 2)
    hashes = lm_scoring._Hashes()
    first = lm_scoring._tokens(b"a b c a " + b"x" * 100, hashes)
    assert len(hashes) <= 2 and first[0] == first[3] and len(set(first.tolist())) == 5


@pytest.mark.parametrize("block", [neighbours.BLOCK, 100])
def test_nearest(spark, block):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((400, 16)) * rng.uniform(0.5, 2, (400, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] * 16), (400, vectors[0].tolist()), (1080, [1.0, 2.0]), (1081, [3.0, -1.0]), (1082, [2.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, "vec_id % 20 = 0", block=block, queries=5 if block == 100 else neighbours.QUERIES).collect()
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 1080] == [(1082, 6.0), (1081, 1.0)]  # other lengths
    every = np.vstack([vectors, vectors[:1]])
    hits = 0
    for q in range(0, 401, 20):
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        score = every @ every[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(401), -score))[:20]
        hits += len(set(best.tolist()) & {r.vec_id for r in mine})
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(r.score == pytest.approx(float(every[r.vec_id] @ every[q]), abs=1e-12) for r in mine)
    assert hits >= 0.9 * 20 * 21
    few = neighbours.nearest(frame.where("vec_id < 5"), "vec_id % 20 = 0").collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert neighbours.nearest(frame.where("false"), "true").count() == 0


def test_main_text():
    page = """<html><head><title>T</title><script>if (a < b) "<p>no</p>"</script></head><body><header><h1>Site</h1></header><nav><a href="/">Menu, one</a></nav>
    <div class="cookie-notice">We use cookies, really, a lot of them.</div>
    <div id="content"><h1>Caf&eacute; &amp; more</h1><p>First   paragraph, with commas, and enough words to count as text.<p>Second&nbsp;one, <b>bold</b>, which goes on for quite some while, so that it counts.<br>after
    <div class="ad-box">Buy, buy, buy</div><ul><li>item one, short</li><li>item two</li></ul></div>
    <div class="comments"><p>A reader says, at length, that this was a nice article, thank you.</p></div><form><p>Name, please, and a long address</p></form>
    <div class="sidebar"><a href="/x">link, link, link, link, link, link</a></div><footer>&copy; us</footer>"""
    assert html_text.main_text(page) == "Café & more\nFirst paragraph, with commas, and enough words to count as text.\nSecond one, bold, which goes on for quite some while, so that it counts. after\nitem one, short\nitem two"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p") == ""
    assert html_text.main_text("<article><p>one<p>two</article>") == "one\ntwo"


@pytest.mark.parametrize("shape", ["article", "main", "divs", "heading"])
def test_no_block_of_an_article_is_lost(shape):
    long = ["word " * 60 + f"a, b, {i}." for i in range(3)]
    parts = [f"<section><p>{x}</p></section>" for x in long]
    few = "<section><h2>Head</h2><p>Short one.</p></section>"
    lists = "<div><ul><li>x one</li><li>y two</li></ul></div><div><table><tr><td>1</td><td>2</td></tr></table></div>"
    menu = '<ul class="menu"><li><a href="/">Home</a></li></ul><div class="comments"><p>I, for one, agree.</p></div>'
    spelt = {"article": f"<article>{parts[0]}{few}{parts[1]}{lists}</article>", "main": f"<main>{lists}{few}{parts[2]}</main>", "divs": f"<div><p>{long[0]}</p></div>{lists}", "heading": f"<div><h1>Title</h1></div><div><p>{long[0]}</p><p>{long[1]}</p></div>"}
    table, head = ["x one", "y two", "1", "2"], ["Head", "Short one."]
    expected = {"article": [long[0], *head, long[1], *table], "main": [*table, *head, long[2]], "divs": [long[0], *table], "heading": ["Title", long[0], long[1]]}
    found = html_text.main_text(f"<html><body>{menu}{spelt[shape]}{menu}<footer>Foot</footer></body></html>")
    assert found.split("\n") == expected[shape]


def test_extract(spark):
    rows = [(1, "u", "<article><p>one &lt; two</p></article>"), (1, "u", "<article><p>one &lt; two</p></article>"), (None, None, None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    assert sorted((r.text, r.n_chars) for r in html_text.extract(frame).collect()) == [("", 0), ("one < two", 9), ("one < two", 9)]
    assert html_text.extract(frame.where("false")).count() == 0


def test_stages_bear_clashing_columns(spark):
    import corpus_pipeline

    rows = [(i, _prose(i, 60 + i % 50), "en", "a", 5, 1, 2, 3, 4) for i in range(80)] + [(80, _prose(3, 63), "en", "a", 5, 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, _n int, _j_id int, _left int, _t_id int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
    assert docs.count() == 80 and corpus_pipeline.packing(spark, docs, "").count() == 80


@pytest.mark.parametrize("block", [near_copies.BLOCK, 7])
def test_near_copies_compare_blocks_without_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "band_keys", lambda s: np.arange(near_copies.BANDS) * 1_000_003)  # all under the same keys
    rows = []
    for i in range(80):  # chains of texts like the next alone, and texts that are like none
        words = _prose(51, 150).split()
        for at in (0, 12, 24, 36, 48, 110, 122, 134):
            words[at + i // 8] = f"chain{i // 8}"
        for at in range(60, 60 + 6 * (i % 8)):
            words[at] = f"own{i}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    label = [*range(len(rows))]
    while True:
        after = [min(label[j] for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)) for a in sets]
        if after == label:
            break
        label = after
    made = {}
    monkeypatch.setattr(near_copies, "written", lambda df, name, batch=None, real=near_copies.written: made.setdefault(name, []).append(real(df, name, batch)) or made[name][-1])
    monkeypatch.setattr(near_copies, "drop", lambda *tables: None)
    found = {r._id: r.root for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    groups = lambda of: sorted(sorted(i for i in of if of[i] == r) for r in set(of.values()))
    assert groups(found) == groups(dict(enumerate(label))) and 1 < len(set(label)) < len(rows)
    assert len(made["pairs"]) == 1  # no table of all pairs
    assert all(t.count() < 40 * len(rows) for t in made["links"])


@pytest.mark.parametrize("piece", [suffixes.PIECE, 6])
def test_repeated_strings_of_a_hot_core(spark, monkeypatch, piece):
    monkeypatch.setattr(suffixes, "PIECE", piece)
    monkeypatch.setattr(suffixes, "BUCKET", 20)
    size, base = suffixes.LENGTH, _prose(61, 60)
    rows = [(i, f"{_prose(100 + i % 17, 9)} {base[i % 5 * 9 : len(base) - i % 7 * 11]} {_prose(200 + i % 23, 9)}") for i in range(60)]
    seen = Counter(t[i : i + size] for _, t in rows for i in range(len(t) - size + 1))
    expected = set()
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                gone[i : i + size] = True
        expected.add((doc, hashlib.sha256(bytes(b for b, g in zip(text.encode(), gone) if not g)).hexdigest()))
    made = {}
    monkeypatch.setattr(suffixes, "written", lambda df, name, real=suffixes.written: made.setdefault(name, real(df, name)))
    monkeypatch.setattr(suffixes, "drop", lambda *tables: None)
    found = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept_sha256) for r in found} == expected and len({k for _, k in expected}) > 1
    strings = made["sorted"].selectExpr("inline(strings)").count()
    assert (strings == 0) if piece == suffixes.PIECE and piece > 60 else strings > 0


def test_byte_bpe_splits_plain_chunks_without_the_pattern():
    import pyarrow as pa

    ranks = byte_bpe.ranks_of(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    random.seed(5)
    texts = ["".join(random.choices([*"aZéßªŁɐΣ中1²'.,;:!?-\t\n \x0b\x1c ́", "'s", " ", " ", " haus,"], k=random.randint(0, 30))) for _ in range(3000)]
    words = byte_bpe._Words(ranks, byte_bpe._PATTERN)
    names = {number: raw for raw, number in ranks.items()}
    codes, cuts = words.codes(pa.array(texts))
    names |= {max(ranks.values()) + 1 + i: raw for i, raw in enumerate(words.new)}
    pattern = words.split
    assert [[names[c] for c in codes[a:b].tolist()] for a, b in zip(cuts[:-1], cuts[1:])] == [[w.encode() for w in pattern(t)] for t in texts]
    asked = []
    words.split = lambda text: asked.append(text) or pattern(text)
    words.codes(pa.array(["one Straßenzug, Überfluß. Zoë naïf"]))
    assert asked == ["one"]


def test_groups_are_whole_whatever_batches_cut_them():
    keys = [("a", 1), ("a", 1), ("a", 2), ("b", 2), ("b", 2), ("b", 2), ("c", 2)]
    whole = pa.RecordBatch.from_pydict({"k": [k for k, _ in keys], "j": [j for _, j in keys], "n": list(range(7))})
    for size in range(1, 8):
        batches = [whole.slice(0, 0), *(whole.slice(at, size) for at in range(0, 7, size)), whole.slice(7, 0)]
        assert [g.column("n").to_pylist() for g in grouped.whole_groups(iter(batches), ["k", "j"])] == [[0, 1], [2], [3, 4, 5], [6]]
    assert not list(grouped.whole_groups(iter([]), ["k"]))


def test_groups_share_a_stream_of_their_task(spark):
    """An executor's memory outside the heap grew with the number of groups where each had vectors of its own."""
    texts = spark.createDataFrame([(i, _prose(i // 2, 40)) for i in range(6)], "_h long, _text string")
    rows = spark.createDataFrame([(k, h, 36, h) for k in range(3) for h in range(6)], "_key long, _h long, _size long, _root long")
    linked = near_copies.links_across(rows, texts)
    features = spark.createDataFrame([(f"g{i % 3}", *(float((i * p) % 11) for p in (1, 2, 3, 5))) for i in range(300)], "_group string, length double, symbols double, lines double, repeats double")
    estimated = quality.estimates(features)
    for plan in (x._jdf.queryExecution().toString() for x in (linked, estimated)):
        assert "FlatMapGroups" not in plan and "MapInArrow" in plan
    assert {tuple(r) for r in linked.collect()} == {(1, 0), (3, 2), (5, 4)}
    assert {r._group for r in estimated.collect()} == {"g0", "g1", "g2"}
