import datetime as dt

from supportlens.functions import entities as ent
from supportlens.sources import views

from .conftest import SF_MID

# Expected entities per template on the raw text, ref_date 2024-06-12.
EXPECTED = {
    "I want a REFUND for order 123456, $45.50 charged twice!":
        [("OrderID", "123456"), ("Amount", "123456"), ("Intent", "Refund"), ("Intent", "Order")],
    "plz help, i forgot password and cant open my account":
        [("AccountAction", "forgot password"), ("Intent", "Account")],
    "Where is my delivery? paid 1,234.50 on monday": [("Amount", "1"), ("Intent", "Shipping")],
    "today": [("Date", "2024-06-12")],
    "12 may 2024": [("Amount", "12"), ("Date", "2024-05-12")],
    "dont cancel, u said 3 days": [("Amount", "3")],
    "update email and change address pls":
        [("AccountAction", "change address"), ("AccountAction", "update email")],
    "summary of the market border": [("Intent", "Order")],
    "2024-05-12": [("Amount", "2024")],
    "gonna close account thx": [("AccountAction", "close account"), ("Intent", "Account")],
    "payment 99.999 failed for item a45 ref_777777": [("Amount", "99"), ("Intent", "Payment")],
    "friday": [("Date", "2024-06-07")],
    "shiping adress of the ordres acn be changed": [("Intent", "Shipping")],
    "!!! 12345 ???": [("OrderID", "12345"), ("Amount", "12345")],
    "im happy, great relationship, thanks": [("Intent", "Shipping")],
    "": [],
}


def test_templates(spark):
    q = views.support_queries(spark, SF_MID).select("short_text").distinct()
    got = {r["short_text"]: [(e["type"], e["value"]) for e in r["e"]]
           for r in q.select("short_text", ent.extract_entities("short_text").alias("e")).collect()}
    assert got == EXPECTED


def test_date_rule(spark):
    cases = {
        "tomorrow": "2024-06-13", "yesterday": "2024-06-11", "wednesday": "2024-06-05",
        "june 3": "2024-06-03", "3rd march 2023": "2023-03-03", "feb 30": None,
        "may 2023": "2023-05-12", "feb 2023": "2023-02-12", "  Dec 25, 2024 ": "2024-12-25",
        "next friday": None, "05/12/2024": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", ent.date_entity(ent.lowered("t")).alias("d")).collect()}
    assert got == cases


def test_relative_dates_never_today_for_weekday():
    rel = ent.relative_dates(dt.date(2024, 6, 12))  # a Wednesday
    assert rel["wednesday"] == dt.date(2024, 6, 5)
    assert rel["thursday"] == dt.date(2024, 6, 6)
    assert rel["tuesday"] == dt.date(2024, 6, 11)
