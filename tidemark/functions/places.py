"""Place labels made comparable, and found in a gazetteer whole or by their longest run of words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Articles before a place's name, and nouns that say what kind of place it is.
ARTICLES = ("al", "ar", "ash", "as", "el")
NOUNS = ("mukarramah", "munawwarah", "province", "region", "regions", "area", "areas", "emirate", "governorate", "city")


@F.pandas_udf(StringType())
def _decomposed(x: pd.Series) -> pd.Series:
    return x.str.normalize("NFKD")


def place(label: Column) -> Column:
    """A label without accents, quotes, articles, marks and nouns of place, in lower case; empty for null.

    Spark has no Unicode decomposition, so labels with letters beyond ASCII pass through Arrow batches: give distinct labels.
    """
    t = F.lower(F.regexp_replace(_decomposed(F.coalesce(label, F.lit(""))), r"\p{Mn}+", ""))
    t = F.regexp_replace(F.regexp_replace(t, "[`'’]", ""), r"[\-–_/(),.]+", " ")
    t = F.regexp_replace(t, rf"(?U)\b({'|'.join(ARTICLES)})\s+", "")
    t = F.regexp_replace(t, rf"(?U)\b({'|'.join(NOUNS)})\b", " ")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def gazetteer(places: DataFrame, label: str = "label") -> DataFrame:
    """Places by normalised label, the last of those that are spelt alike by ``rank``; empty ones are left out."""
    named = places.withColumn("_place", place(F.col(label))).where("_place <> ''")
    rest = [c for c in places.columns if c not in (label, "rank")]
    return named.groupBy("_place").agg(F.max_by(F.struct(*rest), F.struct("rank", *rest)).alias("_best")).select("_place", *(F.col(f"_best.{c}").alias(c) for c in rest))


def resolved(labels: DataFrame, known: DataFrame, label: str = "label", longest: int = 3) -> DataFrame:
    """``labels`` that are places, with the columns of ``known`` (a ``gazetteer``): a whole label decides, else its longest run of words, of these the leftmost.

    Each distinct label is looked up once. A null or empty label is no place.
    """
    once = labels.select(F.col(label).alias("_label")).where("_label is not null").distinct()
    words = once.withColumn("_key", place(F.col("_label"))).where("_key <> ''").withColumn("_words", F.split("_key", " "))

    def runs(n: int) -> Column:
        starts = F.when(F.size("_words") >= n, F.sequence(F.lit(1), F.size("_words") - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda p: F.struct(F.lit(-n).alias("_size"), p.alias("_pos"), F.array_join(F.slice("_words", p, n), " ").alias("_place")))

    whole = F.array(F.struct(F.lit(-(1 << 30)).alias("_size"), F.lit(0).alias("_pos"), F.col("_key").alias("_place")))
    tried = words.select("_label", F.inline(F.concat(whole, *map(runs, range(longest, 0, -1)))))
    rest = [c for c in known.columns if c != "_place"]
    best = tried.join(known, "_place").groupBy("_label").agg(F.min_by(F.struct(*rest), F.struct("_size", "_pos")).alias("_best"))
    return labels.join(best.select(F.col("_label"), *(F.col(f"_best.{c}").alias(c) for c in rest)), F.col(label) == F.col("_label")).drop("_label")
