"""Quality rules: base counts of each text, then robust multivariate outliers by language and source.

Counts become a vector of four ratios, damped so that short texts stay near the middle.  For each
group a minimum-covariance-determinant estimate is found by concentration steps over all its rows:
distances under the present centre and covariance, then centre and covariance of the ``SUPPORT``
share of rows with the least distance.  A step is one aggregate by group and distance bin (bins
carry count, sums and cross products), so a group of any size is reduced before it is exchanged,
and what one task sees of a group is bounded by the number of bins.  Steps run from two starts at
once, the median-and-deviation diagonal and the full covariance, until no determinant changes; the lesser one wins.

Groups with fewer than ``LEAST`` rows are judged by the estimate of their whole language, large groups included, and languages with fewer by
that of all rows; only a table with fewer rows than that in all has no estimate, and no row is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grouped import by_group
from .scratch import drop, free_prefix, written

FEATURES = ("length", "symbols", "lines", "repeats")
#: Share of rows that an estimate rests on, rows that a group needs, concentration steps.
SUPPORT, LEAST, STEPS = 0.75, 60, 8
#: Squared Mahalanobis distance beyond which a text is rejected; 0.999 of a chi-square variable with 4 degrees lie below 18.5.
CUTOFF = 60.0
#: Least standard deviation of each feature: one that is constant in a group must not reject what differs slightly.
FLOOR = (0.03, 0.06, 0.1, 0.1)
_CHI_MEDIAN = 3.3567
#: Relative change of a determinant that counts as none.
_STILL = 1e-3
_BIN = 32.0
_ROWS = 256
_SYMBOLS = [bytes([c]) for c in b"[#*$%&|<>]"]
_SPACES = [bytes([c]) for c in b"\x20\x09\x0a\x0b\x0c\x0d"]
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words that stand in a window found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    if len(index) == n:
        return 0
    code, size = ids[: n - window + 1], len(index)
    for k in range(1, window):  # exact: codes stay below the number of rows
        _, code = np.unique(code * size + ids[k : n - window + 1 + k], return_inverse=True)
    twice = np.bincount(code)[code] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    """Words, code points in them, symbols, lines that repeat an earlier one, lines with a word, words in repeated windows."""
    words = text.split()
    if not words:
        return 0, 0, sum(map(text.count, _SYMBOLS)), 0, 0, 0
    points = len(text.decode("utf-8", "replace")) if not text.isascii() else len(text)
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(words), points - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), len(lines), repeated_words(words)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            rows = [counts(t or b"") for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            columns = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_h", "_lang", "_source")), *map(pa.array, columns)], ["_id", "_h", "_lang", "_source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"])


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _h, _lang, _source)`` with the base counts and ``base_failed``, a row for each row of ``docs``."""
    def column(name: str) -> F.Column:
        return (F.col(name) if name in docs.columns else F.lit(None)).cast("string")

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), column("lang").alias("_lang"), column("source").alias("_source"), text.alias("_text"))
    out = rows.mapInArrow(_counted, f"_id long, _h long, _lang string, _source string, {COUNTS}")
    return written(out.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")), "counts")


def _vector() -> list[F.Column]:
    damped = F.col("n_words") + 50
    found = (F.log((F.col("word_chars") + 250) / damped), F.sqrt(F.col("n_symbols") / damped), F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5)), F.sqrt(F.col("n_repeat_words") / damped))
    return [c.alias(n) for c, n in zip(found, FEATURES, strict=True)]


_P = len(FEATURES)
_CROSS = [(i, j) for i in range(_P) for j in range(i, _P)]
_PARAMS = "_group string, start int, det double, scale double, centre array<double>, inverse array<double>"
_ARROW = pa.schema([("_group", pa.string()), ("start", pa.int32()), ("det", pa.float64()), ("scale", pa.float64()), ("centre", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64()))])


def _moments(prefix: str = "") -> list[F.Column]:
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    return [F.count("*").alias("n"), *sums, *(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c{i}{j}") for i, j in _CROSS)]


def _estimate(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    n = rows["n"].sum()
    centre = np.array([rows[f"s{i}"].sum() for i in range(_P)]) / n
    cov = np.zeros((_P, _P))
    for i, j in _CROSS:
        cov[i, j] = cov[j, i] = rows[f"c{i}{j}"].sum() / n - centre[i] * centre[j]
    return centre, cov


def _param(group: str, start: int, centre: np.ndarray, cov: np.ndarray, scale: float) -> dict:
    cov = cov + np.diag(np.square(FLOOR))
    return {"_group": group, "start": start, "det": float(np.linalg.det(cov)), "scale": scale, "centre": centre.tolist(), "inverse": np.linalg.inv(cov).ravel().tolist()}


def _table(params: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(params, _ARROW)


def _starts(group: pa.Table) -> pa.Table:
    rows = group.to_pandas()
    centre, cov = _estimate(rows)
    row = rows.iloc[0]
    median = np.array([row[f"m{i}"] for i in range(_P)], float)
    spread = np.maximum([(row[f"u{i}"] - row[f"l{i}"]) / 1.349 for i in range(_P)], FLOOR)
    return _table([_param(row["_group"], 0, centre, cov, 1.0), _param(row["_group"], 1, median, np.diag(np.square(spread)), 1.0)])


def _concentrated(group: pa.Table) -> pa.Table:
    """From the bins of one group and start: the estimate over the rows with the least distances."""
    rows = group.to_pandas().sort_values("_bin")
    total = rows["n"].sum()
    reach = rows["n"].cumsum().to_numpy()
    half = int(np.searchsorted(reach, 0.5 * total))
    median = float(np.exp((rows["_bin"].to_numpy()[half] + 0.5) / _BIN))
    last = int(np.searchsorted(reach, SUPPORT * total))
    centre, cov = _estimate(rows.iloc[: last + 1])
    return _table([_param(rows["_group"].iloc[0], int(rows["start"].iloc[0]), centre, cov, median / _CHI_MEDIAN)])


def _distance() -> F.Column:
    terms = [(F.col(FEATURES[i]) - F.col("centre")[i]) * (F.col(FEATURES[j]) - F.col("centre")[j]) * F.col("inverse")[i * _P + j] for i in range(_P) for j in range(_P)]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(1e-6))


def _binned(rows: DataFrame, params: DataFrame) -> DataFrame:
    found = rows.join(params, "_group").withColumn("_bin", F.floor(F.log(_distance()) * _BIN).cast("int"))
    return found.groupBy("_group", "start", "_bin").agg(*_moments())


def estimates(rows: DataFrame) -> DataFrame:
    """``(_group, centre, inverse, scale)`` from ``_group`` and the features: minimum covariance determinant of each group."""
    quartiles = [F.percentile_approx(f, p, 1000).alias(f"{n}{i}") for i, f in enumerate(FEATURES) for n, p in (("l", 0.25), ("m", 0.5), ("u", 0.75))]
    params = written(by_group(rows.groupBy("_group").agg(*_moments(), *quartiles), ["_group"], _starts, _PARAMS), "start")
    for _ in range(STEPS):
        after = written(by_group(_binned(rows, params), ["_group", "start"], _concentrated, _PARAMS), "step")
        was = params.select("_group", "start", F.col("det").alias("_was"))
        moved = after.join(was, ["_group", "start"]).where(F.abs(F.col("det") / F.col("_was") - 1) > _STILL).limit(1).count()
        drop(params)
        params = after
        if not moved:
            break
    best = params.withColumn("_place", F.row_number().over(Window.partitionBy("_group").orderBy("det", "start"))).where("_place = 1").select("_group", "centre", "inverse", F.lit(0).alias("start"), "det", "scale")
    # the spread of the estimate follows from the median distance under it
    final = by_group(_binned(rows, best), ["_group", "start"], _scaled, "_group string, scale double")
    return best.select("_group", "centre", "inverse").join(final, "_group")


def _scaled(group: pa.Table) -> pa.Table:
    rows = group.to_pandas().sort_values("_bin")
    half = int(np.searchsorted(rows["n"].cumsum().to_numpy(), 0.5 * rows["n"].sum()))
    # at least 1: a middle that is narrower than the floor says nothing about the rest
    return pa.table({"_group": [rows["_group"].iloc[0]], "scale": [max(1.0, float(np.exp((rows["_bin"].to_numpy()[half] + 0.5) / _BIN)) / _CHI_MEDIAN)]})


def _grouped(rows: DataFrame, least: int) -> DataFrame:
    """Adds ``_group``, whose estimate judges the row: language and source, or for small groups the language, or all; null where all are few.

    ``_pools`` are the groups whose estimates rest on the row.
    """
    names = F.coalesce(F.col("_lang"), F.lit("")), F.coalesce(F.col("_source"), F.lit(""))
    keyed = rows.withColumn("_l", names[0]).withColumn("_s", names[1])
    sizes = keyed.where("not base_failed").groupBy("_l", "_s").count()
    language = Window.partitionBy("_l")
    pooled = sizes.withColumn("_of_l", F.sum("count").over(language)).withColumn("_least", F.min("count").over(language))
    every = pooled.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("_all"), F.coalesce(F.min("_of_l"), F.lit(0)).alias("_least_l"))
    own, of_language, of_all = F.concat(F.lit("1"), F.to_json(F.array("_l", "_s"))), F.concat(F.lit("2"), F.to_json(F.array("_l"))), F.lit("3")
    group = F.when(F.col("count") >= least, own).when(F.col("_of_l") >= least, of_language).when(F.col("_all") >= least, of_all)
    pools = F.array(F.when(F.col("count") >= least, own), F.when((F.col("_of_l") >= least) & (F.col("_least") < least), of_language), F.when((F.col("_all") >= least) & (F.col("_least_l") < least), of_all))
    named = pooled.crossJoin(F.broadcast(every)).select("_l", "_s", group.alias("_group"), F.array_compact(pools).alias("_pools"))  # one row
    return keyed.join(named, ["_l", "_s"], "left").drop("_l", "_s")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF, least: int = LEAST) -> DataFrame:
    """``(_id, _h, counts, base_failed, distance, kept)``, a row for each row of ``docs``.

    Null texts count as empty and fail the base rules; null languages and sources are groups of their
    own; repeated rows each count; an empty table gives no rows.  ``distance`` is null where
    the base rules failed or no group was large enough.
    """
    rows = _grouped(counted(docs, id_col, text_col), least)
    rows = written(rows.select("*", *_vector()), "vectors")
    params = written(estimates(rows.where("not base_failed").select(F.explode("_pools").alias("_group"), *FEATURES)), "estimates")
    found = rows.join(params.withColumnRenamed("_group", "_g"), (F.col("_group") == F.col("_g")) & ~F.col("base_failed"), "left")
    found = found.withColumn("distance", F.when(F.col("centre").isNotNull(), _distance() / F.col("scale")))
    kept = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= cutoff))
    return found.select("_id", "_h", "_lang", "_source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "base_failed", *FEATURES, "distance", kept.alias("kept"))


def drop_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they were; repeated rows have one verdict and stay repeated."""
    verdicts = judged(docs, id_col, text_col, cutoff).where("kept")
    lang, source = (c if c in docs.columns else None for c in ("lang", "source"))
    own = free_prefix(docs.columns)
    kept = verdicts.select(*(F.col(f"_{c}").alias(own + c) for c in ("id", "h", "lang", "source")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(f"{own}id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(f"{own}h"))
    for name, own in ((lang, f"{own}lang"), (source, f"{own}source")):
        if name:
            same &= F.col(name).cast("string").eqNullSafe(F.col(own))
    return docs.join(kept, same, "left_semi")
