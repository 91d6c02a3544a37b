"""Label and period functions as column expressions, so that they stay inside generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names.
MONTH_WORD = "(january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec)"
SPACE = r"[ \t\r\n\f]+"


def collapsed(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, SPACE, " "))


#: What is cut from a label's end: marks, and white space as ``\\s`` of a pattern.
_TRAILING = "*٭∗·•:-– \t\n\x0b\f\r"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def fold(x: Column) -> Column:
    """Without footnote numbers and trailing marks, in lower case; null where nothing is left. Patterns run only on labels that hold what they look for."""
    footnote = lambda x: F.when(F.contains(x, F.lit("(")), F.regexp_replace(x, r"\([ \t\r\n\f]*[0-9]+[ \t\r\n\f]*\)", "")).otherwise(x)
    spaces = lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x)
    ended = F.translate(F.rtrim(bound(x, footnote), F.lit(_TRAILING)), "\t\r\n\f", "    ")
    return bound(F.lower(F.trim(bound(ended, spaces))), lambda x: F.nullif(x, F.lit("")))


def ident(first: Column, second: Column) -> Column:
    return F.coalesce(fold(first), fold(second), F.lit(""))


def joined_key(*parts: Column) -> Column:
    """MD5 of the parts with bars between; null where any part is null."""
    spelt = [parts[0]]
    for part in parts[1:]:
        spelt += [F.lit("|"), part]
    return F.md5(F.concat(*spelt))


def short_key(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def normalized(x: Column) -> Column:
    """Arabic letter forms made one, without stretching and vowel marks, in lower case."""
    return F.translate(F.lower(x), "آأإىةـًٌٍَُِّْ", "ااايه")


def period_type(p: Column) -> Column:
    return F.when(p.rlike("-Q[1-4]$"), "quarterly").when(p.rlike("^[0-9]{4}-[0-9]{2}$"), "monthly").when(p.rlike("^[0-9]{4}$"), "annual")


def period_order(p: Column) -> Column:
    """Year times 100 plus the month that a period ends in (0 for a whole year): sorts mixed periods by meaning."""
    year = F.substring(p, 1, 4).cast("int")
    quarter = F.regexp_extract(p, "-Q([1-4])$", 1)
    month = F.regexp_extract(p, "^[0-9]{4}-([0-9]{2})$", 1)
    return year * 100 + F.when(quarter != "", F.try_to_number(quarter, F.lit("9")).cast("int") * 3).when(month != "", F.try_to_number(month, F.lit("99")).cast("int")).otherwise(0)


def without_period(label: Column) -> Column:
    """Without one leading month, quarter or year word; as it was where nothing else is left."""
    short = F.regexp_replace(label, f"^(?i)(?:{MONTH_WORD}|q[1-4]|(?:19|20)[0-9][0-9]) ", "")
    return F.when(F.trim(short) == "", label).otherwise(short)


def tidy(label: Column) -> Column:
    """White space collapsed, capitals softened, a base year that stands before the name, in brackets or not, moved behind it."""
    t = collapsed(F.coalesce(label, F.lit("")))
    soft = F.when((F.length(t) > 3) & (t == F.upper(t)) & (t != F.lower(t)), F.initcap(F.lower(t))).otherwise(t)
    return F.regexp_replace(soft, r"^\(?\s*((?:19|20)[0-9]{2})\s*=\s*100\s*\)?\s*[:\-–]?\s*(\S.*)$", "$2 ($1=100)")


def theme(label: Column, words: list[tuple[str, str]], default: str) -> Column:
    """The theme of the first keyword that the label contains."""
    return F.coalesce(*(F.when(F.contains(F.lower(label), F.lit(w)), F.lit(t)) for w, t in words), F.lit(default))
