"""What a spreadsheet's cell says: numbers, languages, periods and kinds of measure, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.labels import bound, normalized

# The words of the sheets, folded as ``normalized`` folds them.
MONTH_NAMES = (
    ("january", "jan", "يناير"), ("february", "feb", "فبراير"), ("march", "mar", "مارس"), ("april", "apr", "ابريل"), ("may", "مايو"), ("june", "jun", "يونيو"),
    ("july", "jul", "يوليو"), ("august", "aug", "اغسطس"), ("september", "sep", "sept", "سبتمبر"), ("october", "oct", "اكتوبر"), ("november", "nov", "نوفمبر"), ("december", "dec", "ديسمبر"),
)
QUARTER_NAMES = (("q1", "الربع الاول"), ("q2", "الربع الثاني"), ("q3", "الربع الثالث"), ("q4", "الربع الرابع"))
ORDINALS = ("first", "second", "third", "fourth")
ARABIC_ORDINALS = ("الاول", "الثاني", "الثالث", "الرابع")
WEIGHT_WORDS = ("weight", "وزن", "الاوزان", "الوزن", "الاهميه", "relative importance")
CHANGE_WORDS = ("change", "تغير", "معدل", "نسبه التغير", "growth")
INDEX_WORDS = ("index", "الرقم القياسي", "الارقام القياسيه", "القياسي", "القياسيه", "مؤشر", "المؤشر")
CONNECTORS = ("in", "from", "of", "for", "the", "to", "and", "at", "على", "في", "من", "مقارنة", "مع", "خلال")

SPACES = r"[\s\x1c-\x1f\x85   -     　]+"
ARABIC, LATIN, LETTER = r"[؀-ۿﭐ-﻿]", "[A-Za-z]", r"[A-Za-z؀-ۿ]"
YEAR = r"(?<!\d)(19[5-9]\d|20[0-4]\d)(?!\d)"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_CAPTION = r"^(?i)\s*(table|جدول)\s*[(\[]?\s*[\d٠-٩]+([.\-–][\d٠-٩]+)*\s*[)\]]?\s*[:\-–]?\s*"


def text(x: Column) -> Column:
    """Runs of white space as one space, none at the ends; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), SPACES, " "))


def number(x: Column) -> Column:
    """The finite number that a cell is, thousands marked by commas or not; else null."""
    return number_in(text(x))


def number_in(t: Column) -> Column:
    """``number`` of what ``text`` gave."""
    bare = F.replace(t, F.lit(","), F.lit(""))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def _word(words: tuple[str, ...]) -> str:
    return f"(?<![a-z])(?:{'|'.join(words)})(?![a-z])"


def _first(t: Column, groups: tuple[tuple[str, ...], ...]) -> Column:
    """The number of the first group of which a word stands in the text."""
    return F.coalesce(*(F.when(t.rlike(_word(w)), F.lit(n)) for n, w in enumerate(groups, 1)))


def year(t: Column) -> Column:
    return F.regexp_extract(t, YEAR, 1).try_cast("int")


def month(t: Column) -> Column:
    return _first(t, MONTH_NAMES)


def quarter(t: Column) -> Column:
    return _first(t, QUARTER_NAMES)


def _of(y: Column, q: Column, m: Column) -> Column:
    sub = F.when(q.isNotNull(), F.concat(F.lit("-Q"), q.cast("string"))).when(m.isNotNull(), F.concat(F.lit("-"), F.lpad(m.cast("string"), 2, "0"))).otherwise("")
    return F.concat(y.cast("string"), sub)


def period(x: Column) -> Column:
    """``YYYY-Qn``, ``YYYY-MM`` or ``YYYY`` that a cell states, else null; a bare year only where at most 12 characters stand on either side."""
    return bound(normalized(text(x)), lambda t: F.when((F.length(t) <= 40) & t.rlike(YEAR), bound(F.struct(year(t).alias("y"), quarter(t).alias("q"), month(t).alias("m")), lambda said: _stated(t, said))))


def _stated(t: Column, said: Column) -> Column:
    iso = F.nullif(F.regexp_extract(t, r"^(\d{4}-\d{2})(-\d{2})?", 1), F.lit(""))
    bare = F.when(t.rlike(r"^\D{0,12}\d{4}\D{0,12}\z"), said["y"].cast("string"))
    return F.when(said["q"].isNotNull() | said["m"].isNotNull(), _of(said["y"], said["q"], said["m"])).otherwise(F.coalesce(iso, bare))


def period_type(p: Column) -> Column:
    return F.when(p.contains("-Q"), "quarterly").when(F.length(p) == 7, "monthly").when(p.isNotNull(), "annual")


_MARKS = r"[*٭∗†‡\s]*"
#: What any cell that adds to a period holds: a year at its beginning, a date, the word of a quarter, or that of a month.
_PART = "|".join((rf"^{_MARKS}(?:1{_MARKS}9{_MARKS}[5-9]|2{_MARKS}0{_MARKS}[0-4])", r"^\d{4}-\d{2}-\d{2}", "q[1-4]", "quarter", "الربع", *(w for names in MONTH_NAMES for w in names)))


def period_part(x: Column) -> Column:
    """What one cell adds to a period: ``(kind, year, sub)`` with kind year, quarter or month; null for none."""
    return period_part_in(text(x))


def period_part_in(t: Column) -> Column:
    """``period_part`` of what ``text`` gave."""
    return bound(normalized(t), lambda t: F.when((F.length(t) <= 30) & t.rlike(_PART), _part(t)))


def _part(t: Column) -> Column:
    alone = F.regexp_extract(F.regexp_replace(t, r"[*٭∗†‡\s]+", ""), r"^(19[5-9]\d|20[0-4]\d)(\.0)?\z", 1).try_cast("int")
    y = F.regexp_extract(t, r"(19[5-9]\d|20[0-4]\d)", 1).try_cast("int")
    iso = F.regexp_extract(t, r"^\d{4}-(\d{2})-\d{2}\z", 1).try_cast("int")
    ordinal = F.coalesce(*(F.when(t.rlike(rf"(?<![a-z]){w}\s+quarter"), n) for n, w in enumerate(ORDINALS, 1)))
    arabic = F.when(t.contains("الربع"), F.coalesce(*(F.when(t.contains(w), n) for n, w in enumerate(ARABIC_ORDINALS, 1))))
    none = F.lit(None).cast("int")
    part = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("year"), b.alias("sub"))
    named = lambda n: F.when(n["q"].isNotNull(), part("quarter", n["y"], n["q"])).when(n["m"].isNotNull(), part("month", n["y"], n["m"]))
    words = bound(F.struct(y.alias("y"), F.coalesce(quarter(t), ordinal, arabic).alias("q"), month(t).alias("m")), named)
    return bound(F.struct(iso.alias("iso"), alone.alias("alone")), lambda d: F.when(d["iso"].isNotNull(), part("month", y, d["iso"])).when(d["alone"].isNotNull(), part("year", d["alone"], none)).otherwise(words))


def joined_period(y: Column, part: Column) -> Column:
    """A period from a year and the ``period_part`` of a quarter or month, if any; null without a year."""
    sub = part["sub"]
    return _of(y, F.when(part["kind"] == "quarter", sub), F.when(part["kind"] == "month", sub))


def release_period(y: Column, named: Column, title: Column) -> Column:
    """The period of a release: its year, with its month, else a month or quarter that its title names; null without a year in digits."""
    own, low = F.trim(F.lower(F.coalesce(named, F.lit("")))), F.lower(F.coalesce(title, F.lit("")))
    exact = F.coalesce(*(F.when(own == names[0], n) for n, names in enumerate(MONTH_NAMES, 1)))
    begun = F.coalesce(*(F.when(low.rlike(rf"\b{names[0][:3]}[a-z]*\b"), n) for n, names in enumerate(MONTH_NAMES, 1)))
    q = F.regexp_extract(low, r"\bq([1-4])\b", 1).try_cast("int")
    m = F.coalesce(exact, begun)
    digits = y.cast("string")
    return F.when(digits.rlike("^[0-9]+$"), _of(digits, F.when(m.isNull(), q), m))


def index_base(x: Column) -> Column:
    return F.nullif(F.regexp_extract(text(x), r"(20\d\d)\s*=\s*100", 1), F.lit(""))


def kind(label: Column, sheet: Column | None = None) -> Column:
    """weight, change, index or value, by the words of the label, else of the sheet's name."""
    t = normalized(F.coalesce(label, F.lit("")))
    has = lambda words: t.rlike("|".join(words))
    found = F.when(has(WEIGHT_WORDS), "weight").when(has(INDEX_WORDS), "index").when(has(CHANGE_WORDS), "change")
    if sheet is not None:
        found = found.when(sheet.rlike(r"(?i)(_d[aqmy]\b|_d[aqmy]_|\bd[aqmy]\b|change|تغير|التغيّر)"), "change").when(sheet.rlike("(?i)(_i\\b|_i_|index|الرقم القياسي|الأرقام القياسية)"), "index")
    return found.otherwise("value")


def is_caption(x: Column) -> Column:
    return x.rlike(_CAPTION)


def without_caption(x: Column) -> Column:
    """Without a leading table number, in either script and any brackets; as it was where nothing else is left."""
    short = F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), _CAPTION, ""))
    return F.when(short == "", F.trim(F.coalesce(x, F.lit("")))).otherwise(short)


def bilingual(x: Column) -> Column:
    """``(en, ar)``: the words of a label by script, in order.

    Numbers and marks stay with the run that they follow, or go to ``en`` before any; a word in both scripts is cut in two.
    """
    tokens = F.filter(F.split(F.regexp_replace(F.coalesce(x, F.lit("")), SPACES, " "), r"[ |]+"), lambda w: w != "")
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("en"), none.alias("ar"), F.lit("").alias("run"))

    def add(held: Column, word: Column, to: Column) -> Column:
        return F.when(to & (word != ""), F.array_append(held, word)).otherwise(held)

    def step(s: Column, w: Column) -> Column:
        ar, en = w.rlike(ARABIC), w.rlike(LATIN)
        run = F.when(ar & en, "").when(ar, "ar").when(en, "en").when(s["run"] == "", "en").otherwise(s["run"])
        latin = F.when(ar & en, F.regexp_replace(w, ARABIC, "")).otherwise(w)
        arabic = F.when(ar & en, F.regexp_replace(w, LATIN, "")).otherwise(w)
        return F.struct(add(s["en"], latin, (ar & en) | (run == "en")).alias("en"), add(s["ar"], arabic, (ar & en) | (run == "ar")).alias("ar"), run.alias("run"))

    def clean(words: Column) -> Column:
        return text(F.regexp_replace(F.array_join(words, " "), r"^[ \-–:,|]+|[ \-–:,|]+\z", ""))

    return F.aggregate(tokens, start, step, lambda s: F.struct(clean(s["en"]).alias("en"), clean(s["ar"]).alias("ar")))


_MONTHS = "|".join(w for names in MONTH_NAMES for w in names if w.isascii())
_ARABIC_MONTHS = "يناير|فبراير|مارس|ابريل|أبريل|مايو|يونيو|يوليو|اغسطس|أغسطس|سبتمبر|اكتوبر|أكتوبر|نوفمبر|ديسمبر"
_PERIOD_WORDS = (
    r"(?i)(?<![a-z؀-ۿ])(q[1-4]([_\- ]?(19|20)\d{2})?|(19|20)\d{2}[-/](0?[1-9]|1[0-2])([-/]\d{1,2})?|(19|20)\d{2}"
    rf"|(first|second|third|fourth)\s+quarter|{_MONTHS}|الربع\s+(الاول|الأول|الثاني|الثالث|الرابع)|{_ARABIC_MONTHS})(?![a-z؀-ۿ])"
)


def stable(label: Column) -> Column:
    """A column's label without its period and base, the same in every release; empty where no letter or digit is left."""
    whole = F.coalesce(label, F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(whole, r"\(?\s*(19|20)\d{2}\s*=\s*100\s*\)?", " "), _PERIOD_WORDS, " ")
    bare = F.regexp_replace(bare, r"(?<![A-Za-z0-9؀-ۿ])[*٭∗†‡]+(?![A-Za-z0-9؀-ۿ])", " ")
    loose = F.regexp_replace(bare, rf"(?i)(?<![a-z])({'|'.join(CONNECTORS)})(?![a-z])", " ")
    loose = F.regexp_replace(F.regexp_replace(loose, r"(?<![\d.])\d{1,2}(?![\d.%])", " "), "=", " ")
    found = F.when(F.trim(bare) != F.trim(whole), loose).otherwise(bare)
    tidy = text(F.regexp_replace(F.regexp_replace(found, r"[\s,;:\-–_/()]+", " "), r"^[ =]+|[ =]+\z", ""))
    return F.when(tidy.rlike(r"[A-Za-z؀-ۿ0-9]"), tidy).otherwise("")


def not_restated(parts: Column) -> Column:
    """Heading parts without those whose words stand, in a run, inside a longer part."""
    spelt = F.transform(parts, lambda p: F.struct(p.alias("part"), F.concat(F.lit(" "), text(normalized(p)), F.lit(" ")).alias("run")))
    words = lambda run: F.size(F.split(run, " "))
    kept = F.filter(spelt, lambda a: (F.trim(a["run"]) == "") | ~F.exists(spelt, lambda b: (words(b["run"]) > words(a["run"])) & F.contains(b["run"], a["run"])))
    found = F.transform(kept, lambda a: a["part"])
    return F.when(F.size(found) > 0, found).otherwise(parts)


def without_common(labels: Column, label: Column) -> Column:
    """A label without the words that all ``labels`` of its sheet share; whole where these are all it has, or where it is the only one."""
    split = lambda x: F.filter(F.split(x, " "), lambda w: w != "")
    shared = F.aggregate(F.slice(labels, 2, 1 << 30), split(labels[0]), lambda s, x: F.array_intersect(s, split(x)))
    kept = F.filter(split(label), lambda w: ~F.array_contains(shared, w))
    return F.when((F.size(labels) < 2) | (F.size(kept) == 0), label).otherwise(F.array_join(kept, " "))
