"""Rule-based entity extraction as Column expressions.

Everything matches on the lower-cased text. Output of ``extract_entities`` is
an ``array<struct<type string, value string>>`` in fixed order: OrderID,
Amount, Date, AccountAction*, Intent*. No Python UDF is involved: the whole
extraction is one projection inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.tables import py_strip
from .text import as_text

# Patterns and word lists of the extraction rules.
ORDER_ID_RE = r"\b\d{5,}\b"
AMOUNT_RE = r"\$?\b\d+(?:\.\d{1,2})?\b"
ACCOUNT_ACTIONS = (
    "reset password", "forgot password", "delete account", "close account",
    "change address", "update address", "update email", "edit personal information",
)
DATE_GATE_WORDS = (
    "today", "tomorrow", "yesterday", "monday", "tuesday", "wednesday",
    "thursday", "friday", "saturday", "sunday",
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
)
# Intent rules, tested independently in this order: (substrings, label).
INTENT_RULES = (
    (("refund",), "Refund"),
    (("order",), "Order"),
    (("account",), "Account"),
    (("payment", "pay"), "Payment"),
    (("ship", "delivery"), "Shipping"),
)

# Date rule (our own, fixed): the whole trimmed text must be one of
#   today | tomorrow | yesterday
#   <weekday>                       -> latest such day strictly before ref_date
#   <d> <month> [<yyyy>]            (optional st/nd/rd/th, optional comma)
#   <month> <d> [<yyyy>]
#   <month> <yyyy>                  -> day of ref_date, capped at month end
# with 3-letter or full English month names; a missing year is ref_date's.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
MONTH_RE = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
            r"|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
MONTHS3 = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DAY_RE = r"(\d{1,2})(?:st|nd|rd|th)?"
DMY_RE = rf"^{DAY_RE}\s+{MONTH_RE}(?:,?\s+(\d{{4}}))?$"
MDY_RE = rf"^{MONTH_RE}\s+{DAY_RE}(?:,?\s+(\d{{4}}))?$"
MY_RE = rf"^{MONTH_RE},?\s+(\d{{4}})$"

DEFAULT_REF_DATE = dt.date(2024, 6, 12)


def relative_dates(ref: dt.date) -> dict[str, dt.date]:
    """Words whose date depends only on ``ref``: today/tomorrow/yesterday, weekdays."""
    out = {"today": ref, "tomorrow": ref + dt.timedelta(days=1),
           "yesterday": ref - dt.timedelta(days=1)}
    for k, name in enumerate(WEEKDAYS):
        back = (ref.weekday() - k - 1) % 7 + 1  # 1..7 days back, never 0
        out[name] = ref - dt.timedelta(days=back)
    return out


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lowered(c) -> Column:
    return F.lower(as_text(c))


def order_id(s: Column) -> Column:
    """First run of >= 5 digits between word boundaries, else NULL."""
    return F.regexp_substr(s, F.lit(ORDER_ID_RE))


def amount(s: Column) -> Column:
    """First number with optional $ and 1-2 decimals, else NULL."""
    return F.regexp_substr(s, F.lit(AMOUNT_RE))


def _month_number(m: Column) -> Column:
    table = F.create_map(*[x for i, m3 in enumerate(MONTHS3) for x in (F.lit(m3), F.lit(i + 1))])
    return F.try_element_at(table, F.substring(m, 1, 3))


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def _num(c: Column) -> Column:
    return F.when(c == "", None).otherwise(c.cast("int"))


def date_entity(s: Column, ref_date: dt.date = DEFAULT_REF_DATE) -> Column:
    """``yyyy-MM-dd`` when the gate passes and the whole text is a date."""
    gate = F.exists(F.array(*[F.lit(w) for w in DATE_GATE_WORDS]), lambda w: F.contains(s, w))
    t = py_strip(s)
    year = F.lit(ref_date.year)
    rel = F.create_map(*[x for k, v in relative_dates(ref_date).items() for x in (F.lit(k), F.lit(v))])

    dmy = _ymd(F.coalesce(_num(F.regexp_extract(t, DMY_RE, 3)), year),
               _month_number(F.regexp_extract(t, DMY_RE, 2)),
               _num(F.regexp_extract(t, DMY_RE, 1)))
    mdy = _ymd(F.coalesce(_num(F.regexp_extract(t, MDY_RE, 3)), year),
               _month_number(F.regexp_extract(t, MDY_RE, 1)),
               _num(F.regexp_extract(t, MDY_RE, 2)))
    my_y = _num(F.regexp_extract(t, MY_RE, 2))
    my_m = _month_number(F.regexp_extract(t, MY_RE, 1))
    month_end = F.dayofmonth(F.last_day(_ymd(my_y, my_m, F.lit(1))))
    my = _ymd(my_y, my_m, F.least(F.lit(ref_date.day), month_end))

    parsed = (F.when(t.rlike(DMY_RE), dmy)
              .when(t.rlike(MDY_RE), mdy)
              .when(t.rlike(MY_RE), my)
              .otherwise(F.try_element_at(rel, t)))
    return F.when(gate, F.date_format(parsed, "yyyy-MM-dd"))


def account_actions(s: Column) -> Column:
    """Every listed phrase contained in the text, in list order."""
    return F.filter(F.array(*[F.lit(a) for a in ACCOUNT_ACTIONS]), lambda p: F.contains(s, p))


def intents(s: Column) -> Column:
    """E5: independent substring tests, labels in rule order."""
    hits = []
    for words, label in INTENT_RULES:
        cond = None
        for w in words:
            c = F.contains(s, F.lit(w))
            cond = c if cond is None else (cond | c)
        hits.append(F.when(cond, F.lit(label)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def _ent(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), value.alias("value"))


def extract_entities(text, ref_date: dt.date = DEFAULT_REF_DATE, dates_anywhere: bool = False) -> Column:
    """Ordered concatenation of E1-E5 on the lower-cased text. With
    ``dates_anywhere`` every date in the text counts, not the whole text as one."""
    s = lowered(_col(text))
    singles = F.array(_ent("OrderID", order_id(s)), _ent("Amount", amount(s)))
    if dates_anywhere:
        from .dates import date_mentions

        singles = F.concat(singles, F.transform(date_mentions(text, ref_date), lambda m: _ent("Date", m["date"])))
    else:
        singles = F.concat(singles, F.array(_ent("Date", date_entity(s, ref_date))))
    acts = F.transform(account_actions(s), lambda a: _ent("AccountAction", a))
    ints = F.transform(intents(s), lambda a: _ent("Intent", a))
    return F.filter(F.concat(singles, acts, ints), lambda e: e["value"].isNotNull())


def add_entities_column(df, text_col: str = "clean", ref_date: dt.date = DEFAULT_REF_DATE,
                        out: str = "entities"):
    """Add the ordered entity list of ``text_col`` (cleaned text by default)."""
    return df.withColumn(out, extract_entities(text_col, ref_date))
