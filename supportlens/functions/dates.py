"""Dates anywhere in a text (E3, extension): spans with the date they name.

A small grammar over word tokens, run as one regular expression in the JVM:
the text is cut at its matches, the pieces give the places, each match is
parsed by itself. Forms, the first that fits at a word wins and matches do not overlap:

    2024-05-12
    12.05.2024   12/05/2024                    (day first)
    12 May 2024   12th of May, 2024   12. Mai   12 de mayo de 2024   1er mars
    May 12, 2024   May 12th   May 2024
    today / tomorrow / yesterday, weekdays      (by ``ref_date``)

Month, weekday and relative words are those of English, German, French and
Spanish. A missing year is ``ref_date``'s; a month and year name the day of
``ref_date``, capped at the month's end; a weekday is the latest one strictly
before ``ref_date``. Dates the calendar does not have are left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .entities import DEFAULT_REF_DATE, WEEKDAYS
from .text import as_text

# Month names and their usual short forms, January to December.
MONTHS = (
    "january jan januar janvier janv enero ene",
    "february feb februar februari février fevrier févr febrero",
    "march mar märz maerz mars marzo",
    "april apr avril avr abril abr",
    "may mai mayo",
    "june jun juni juin junio",
    "july jul juli juillet juil julio",
    "august aug août aout agosto ago",
    "september sep sept septembre septiembre setiembre",
    "october oct oktober okt octobre octubre",
    "november nov novembre noviembre",
    "december dec dezember dez décembre decembre déc diciembre dic",
)
# Weekdays, Monday to Sunday, in the four languages.
DAYS = (
    "monday montag lundi lunes", "tuesday dienstag mardi martes", "wednesday mittwoch mercredi miércoles miercoles",
    "thursday donnerstag jeudi jueves", "friday freitag vendredi viernes",
    "saturday samstag sonnabend samedi sábado sabado", "sunday sonntag dimanche domingo",
)
# Days from the reference date. "morgen" and "mañana" are left
# out: as often as not they mean the morning.
RELATIVE = {0: "today heute aujourd'hui hoy", 1: "tomorrow demain", -1: "yesterday gestern hier ayer"}


def _words(groups) -> str:
    """Alternatives, longer words first, so that none hides behind its beginning."""
    return "|".join(sorted((w for g in groups for w in g.split()), key=lambda w: (-len(w), w)))


WORD = r"[\p{L}\p{N}_]"
_MONTH = f"(?:{_words(MONTHS)})"
_DAY = r"\d{1,2}(?:st|nd|rd|th|er)?"
_OF = r"(?:\.?\s+(?:of\s+|de\s+)?)"
_YEAR = r"(?:,?\s+(?:de\s+|del\s+)?\d{4})"
FORMS = (
    r"\d{4}-\d{1,2}-\d{1,2}",
    r"\d{1,2}[./]\d{1,2}[./]\d{4}",
    rf"{_DAY}{_OF}{_MONTH}\.?{_YEAR}",
    rf"{_DAY}{_OF}{_MONTH}",
    rf"{_MONTH}\.?\s+{_DAY}{_YEAR}",
    rf"{_MONTH}\.?\s+\d{{4}}",
    rf"{_MONTH}\.?\s+{_DAY}",
    _words([*RELATIVE.values(), *DAYS]),
)
# A date begins and ends with a word of its own; a number with decimals or of
# a longer date is none.
DATE_RE = rf"(?<!{WORD})(?<!\d[./-])(?:{'|'.join(FORMS)})(?!{WORD})(?![./-]\d)"


def _lookup(table: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def mention_date(mention: Column, ref_date: dt.date = DEFAULT_REF_DATE) -> Column:
    """The date that one lower-cased match names, null if there is no such day."""
    numbers = F.transform(F.regexp_extract_all(mention, F.lit(r"\d+"), 0), lambda n: n.cast("int"))
    months = _lookup({w: i for i, g in enumerate(MONTHS, 1) for w in g.split()})
    near = {w: n for n, g in RELATIVE.items() for w in g.split()}
    for i, g in enumerate(DAYS):
        near |= dict.fromkeys(g.split(), -((ref_date.weekday() - i - 1) % len(WEEKDAYS) + 1))
    month = F.element_at(F.filter(F.transform(F.split(mention, r"[^\p{L}]+"), lambda w: F.try_element_at(months, w)),
                                  lambda m: m.isNotNull()), 1)
    first, second, third = (F.get(numbers, i) for i in range(3))
    year = F.lit(ref_date.year)
    end = F.dayofmonth(F.last_day(_ymd(first, month, F.lit(1))))
    return (F.when(mention.rlike(r"^\d{4}-"), _ymd(first, second, third))
             .when(mention.rlike(r"^\d{1,2}[./]\d"), _ymd(third, second, first))
             .when(F.size(numbers) == 0, F.date_add(F.lit(ref_date), F.try_element_at(_lookup(near), mention)))
             .when(F.size(numbers) == 2, _ymd(second, month, first))
             .when(F.length(F.regexp_extract(mention, r"\d+", 0)) == 4, _ymd(first, month, F.least(F.lit(ref_date.day), end)))
             .otherwise(_ymd(year, month, first)))


def date_mentions(text, ref_date: dt.date = DEFAULT_REF_DATE) -> Column:
    """``array<struct<start, end, mention, date>>`` in the order of the text;
    places count characters of the lower-cased text, the end is exclusive."""
    s = F.lower(as_text(text))
    found = F.regexp_extract_all(s, F.lit(DATE_RE), 0)
    gaps = F.split(s, DATE_RE, -1)  # one more than matches
    width = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("g"), found.alias("m")),
                        lambda p: F.struct(F.length(p["g"]).alias("g"), F.length(p["m"]).alias("n"), p["m"].alias("m")))
    empty = F.array().cast("array<struct<start:int,end:int,mention:string>>")

    def add(acc, w):
        start = F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0)) + w["g"]
        return F.concat(acc, F.array(F.struct(start.alias("start"), (start + w["n"]).alias("end"), w["m"].alias("mention"))))

    spans = F.aggregate(width, empty, add)
    dated = F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["mention"].alias("mention"),
        F.date_format(mention_date(x["mention"], ref_date), "yyyy-MM-dd").alias("date")))
    return F.filter(dated, lambda x: x["date"].isNotNull())
