"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

Rows lie in blocks.  How many rows of each block go to each shard is drawn first: the matrix of a
uniformly random permutation has the multivariate hypergeometric law with the block sizes as row
sums and the shard sizes as column sums, so its cells are drawn one after another by inverting the
hypergeometric distribution.  Rows are permuted within their block, the first so many go to shard 0
and so on, and after the exchange they are permuted again within the shard.

All of it is DataFrame operations and higher-order functions.  The matrix has at most ``BLOCKS`` rows; no
block, and no range of slots in a shard, is much above ``ROWS`` rows up to a thousand times as many.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

SHARDS, SEED = 24, 20_250_101
#: Rows that a block takes until there are ``BLOCKS`` blocks; the same for the ranges of slots in a shard.
ROWS, BLOCKS = 4_000, 1_024


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _upto(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows out of ``total`` are among the ``marked`` ones: the value at which the distribution reaches ``u``.

    Weights are taken relative to the mode over 12 standard deviations on either side, beyond which
    they are lost in double precision.
    """
    d = lambda c: c.cast("double")
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - marked))
    high = F.least(drawn, marked)
    mode = F.greatest(low, F.least(high, F.floor((d(drawn) + 1) * (d(marked) + 1) / (d(total) + 2)).cast("long")))
    share = d(marked) / F.greatest(d(total), F.lit(1.0))
    reach = F.ceil(12 * F.sqrt(d(drawn) * share * (1 - share))).cast("long") + 30
    bound = F.struct(total.alias("t"), marked.alias("m"), drawn.alias("n"), u.alias("u"), low.alias("low"), high.alias("high"), mode.alias("mode"), reach.alias("reach"))

    def tails(x: Column) -> Column:
        first, last = F.greatest(x["low"], x["mode"] - x["reach"]), F.least(x["high"], x["mode"] + x["reach"])
        down = F.aggregate(_upto(first + 1, x["mode"]), F.lit(1.0), lambda w, k: w * d(k) * d(x["t"] - x["m"] - x["n"] + k) / (d(x["m"] - k + 1) * d(x["n"] - k + 1)))
        return _let(F.struct(x.alias("x"), first.alias("first"), last.alias("last"), down.alias("w")), walk)

    def after(x: Column, k: Column, w: Column) -> Column:
        return w * d(x["m"] - k) * d(x["n"] - k) / (d(k + 1) * d(x["t"] - x["m"] - x["n"] + k + 1))

    def walk(y: Column) -> Column:
        steps, x = _upto(y["first"], y["last"]), y["x"]
        start = F.struct(y["w"].alias("w"), F.lit(0.0).alias("sum"))
        whole = F.aggregate(steps, start, lambda s, k: F.struct(after(x, k, s["w"]).alias("w"), (s["sum"] + s["w"]).alias("sum")))["sum"]
        return _let(whole * x["u"], lambda goal: F.aggregate(
            steps,
            F.struct(y["w"].alias("w"), F.lit(0.0).alias("sum"), y["last"].alias("found"), F.lit(False).alias("over")),
            lambda s, k: F.struct(after(x, k, s["w"]).alias("w"), (s["sum"] + s["w"]).alias("sum"), F.when(~s["over"] & (s["sum"] + s["w"] >= goal), k).otherwise(s["found"]).alias("found"), (s["over"] | (s["sum"] + s["w"] >= goal)).alias("over")),
        )["found"])

    return _let(bound, tails)


def _uniform(*key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / float(1 << 53)


def communication_matrix(blocks: DataFrame, total: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(block, upto)`` from ``(block, n)``: ranks below ``upto[s]`` (and not below ``upto[s-1]``) go to shard s."""
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    long = lambda n: F.lit(n).cast("long")

    def row(state: Column, block: Column) -> Column:
        def cell(s: Column, shard: Column) -> Column:
            room = state["room"][shard]
            k = hypergeometric(s["pop"], room, s["left"], _uniform(F.lit(seed), block["block"], shard))
            return _let(F.struct(s.alias("s"), k.alias("k"), room.alias("room")), lambda v: F.struct((v["s"]["left"] - v["k"]).alias("left"), (v["s"]["pop"] - v["room"]).alias("pop"), F.concat(v["s"]["out"], F.array(v["k"])).alias("out")))

        start = F.struct(block["n"].alias("left"), F.aggregate(state["room"], long(0), lambda a, r: a + r).alias("pop"), F.array().cast("array<bigint>").alias("out"))
        drawn = F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, cell)["out"]
        return _let(drawn, lambda out: F.struct(F.zip_with(state["room"], out, lambda r, k: r - k).alias("room"), F.concat(state["rows"], F.array(F.struct(block["block"].alias("block"), out.alias("out")))).alias("rows")))

    listed = blocks.agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("blocks"))  # at most BLOCKS rows
    first = F.struct(F.array(*map(long, sizes)).alias("room"), F.array().cast("array<struct<block:bigint,out:array<bigint>>>").alias("rows"))
    rows = listed.select(F.inline(F.aggregate("blocks", first, row)["rows"]))
    running = F.aggregate("out", F.array().cast("array<bigint>"), lambda a, k: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), long(0)) + k)))
    return rows.select("block", running.alias("upto"))


def exact_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: every row in one of ``shards`` shards whose counts differ by one at most.

    ``size`` is the text's UTF-8 bytes (null: none) plus 8.  Ids may be null or repeated and rows may be equal: each row gets a
    slot of its own; an empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # fixed by writing: tells equal rows apart
    rows = written(rows.withColumn("_one", F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32", "_row")).withColumn("_two", F.xxhash64(F.lit(seed + 1), "_one", "_row")), "rows")
    total = rows.count()
    blocks = max(1, min(BLOCKS, total // ROWS))
    ranges = max(1, total // shards // ROWS)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("_two", F.lit(seed + 2)), F.lit(blocks)))
    matrix = written(communication_matrix(dealt.groupBy("block").agg(F.count("*").alias("n")), total, shards, seed), "matrix")
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("block").orderBy("_one", "_row")) - 1)
    sent = ranked.join(F.broadcast(matrix), "block")  # at most BLOCKS rows
    sent = sent.withColumn("shard", F.size(F.filter("upto", lambda n: n <= F.col("_rank")))).withColumn("_range", F.pmod("_two", F.lit(ranges)))
    sent = written(sent.select("doc_id", "size", "text_crc32", "shard", "_range", "_two", "_row"), "sent")
    before = sent.groupBy("shard", "_range").count().withColumn("_before", F.sum("count").over(Window.partitionBy("shard").orderBy("_range")) - F.col("count")).drop("count")
    within = sent.withColumn("_place", F.row_number().over(Window.partitionBy("shard", "_range").orderBy("_two", "_row")))
    slot = (F.col("_before") + F.col("_place") - 1).cast("long")
    return within.join(before, ["shard", "_range"]).select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
