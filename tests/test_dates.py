import datetime as dt

import pytest

from supportlens.functions import dates
from supportlens.functions import entities as ent

REF = dt.date(2024, 6, 12)  # a Wednesday

TEXTS = {
    "I paid on 12 May 2024 and again on June 3rd.": ["2024-05-12", "2024-06-03"],
    "Order of 2024-05-12, sent 13.05.2024 or 14/5/2024": ["2024-05-12", "2024-05-13", "2024-05-14"],
    "am 12. Mai 2023 bestellt, am 3. März storniert": ["2023-05-12", "2024-03-03"],
    "le 1er février 2024, puis le 14 août": ["2024-02-01", "2024-08-14"],
    "el 5 de mayo de 2022 y el 6 de septiembre": ["2022-05-05", "2024-09-06"],
    "the 4th of July, 2021": ["2021-07-04"],
    "since May 2024": ["2024-05-12"],
    "since Feb 2023; back in dec. 24": ["2023-02-12", "2024-12-24"],
    "today, not tomorrow. Yesterday?": ["2024-06-12", "2024-06-13", "2024-06-11"],
    "monday wednesday Freitag dimanche martes": ["2024-06-10", "2024-06-05", "2024-06-07", "2024-06-09", "2024-06-11"],
    "aujourd'hui ou hier": ["2024-06-12", "2024-06-11"],
    "31 feb 2024 and 30.02.2024 do not exist, 2024-13-01 neither": [],
    "dismay 5, 12 mayor, summary of the market, may be, 1.2.3.2024, 12/05/20245, x12 may": [],
    "version 10.12.2024.1 and 2024-05-12-7": [],
    "May 5 2024x and 5 May2024": ["2024-05-05"],
    "": [], None: [],
}


@pytest.mark.parametrize("text", list(TEXTS), ids=str)
def test_dates_in_texts(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(dates.date_mentions("t", REF).alias("d")).first().d
    assert [m.date for m in got] == TEXTS[text]
    assert all(text.lower()[m.start:m.end] == m.mention for m in got)


def test_places_and_long_texts(spark):
    text = "été " * 50 + "12 mai 2024" + " filler" * 30_000 + " Today" + " 1" * 5_000 + " 2024-01-02"
    got = spark.createDataFrame([(text,)], "t string").select(dates.date_mentions("t", REF).alias("d")).first().d
    assert [(m.date, text.lower()[m.start:m.end]) for m in got] == [
        ("2024-05-12", "12 mai 2024"), ("2024-06-12", "today"), ("2024-01-02", "2024-01-02")]


def test_entities_with_dates_anywhere(spark):
    df = spark.createDataFrame([("refund order 123456 of 12 May 2024, not Friday",)], "t string")
    whole, found = df.select(ent.extract_entities("t").alias("a"),
                             ent.extract_entities("t", dates_anywhere=True).alias("b")).first()
    assert [e.value for e in whole if e.type == "Date"] == []
    assert [tuple(e) for e in found] == [("OrderID", "123456"), ("Amount", "123456"), ("Date", "2024-05-12"),
                                         ("Date", "2024-06-07"), ("Intent", "Refund"), ("Intent", "Order")]


def test_no_python_worker(spark, capsys):
    spark.createDataFrame([("x",)], "t string").select(dates.date_mentions("t")).explain()
    assert "Python" not in capsys.readouterr().out
