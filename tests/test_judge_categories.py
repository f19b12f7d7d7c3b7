from supportlens.functions import categories as cat
from supportlens.functions import judge as jg

D = jg.DEFAULT_EXPLANATION
CASES = [
    ('{"relevance":5,"helpfulness":4,"tone":5,"explanation":"ok"}', (5, 4, 5, "ok")),
    ('{"relevance":"4","helpfulness":"4.7","tone":4.7}', (4, 1, 4, D)),
    ('{"relevance":null,"helpfulness":null,"tone":null,"explanation":null}', (1, 1, 1, D)),
    ("{}", (3, 3, 4, D)), ("not json", (3, 3, 4, D)), ("", (3, 3, 4, D)), (None, (3, 3, 4, D)),
    ("[1,2]", (3, 3, 4, D)),
    ('{"relevance":9,"helpfulness":-3,"tone":0}', (5, 1, 1, D)),
    ('{"relevance":true,"helpfulness":"x","tone":" 2 ","explanation":""}', (1, 1, 2, D)),
    ('{"relevance":3}', (3, 3, 4, D)),
    ('{"tone":2,"explanation":"short"}', (3, 3, 2, "short")),
]


def test_parse_judge(spark):
    df = spark.createDataFrame([(r,) for r, _ in CASES], "raw string")
    got = [tuple(r["s"]) for r in df.select(jg.parse_judge("raw").alias("s")).collect()]
    assert got == [want for _, want in CASES]


def test_normalize_category(spark):
    cases = [
        ("x", "Get Refund", "REFUND"), ("x", "cancel_order", "CANCEL"),
        ("x", "Delivery options", "SHIPPING"), ("x", "set up shipping address", "SHIPPING"),
        ("x", "recover PASSWORD", "ACCOUNT"), ("x", "delete account", "ACCOUNT"),
        ("x", "cancel and refund", "REFUND"), ("order", "", "ORDER"), ("order", None, "ORDER"),
        ("", None, "OTHER"), (None, None, "OTHER"), ("feedback", "other", "FEEDBACK"),
    ]
    df = spark.createDataFrame(cases, "c string, s string, want string")
    out = df.select("want", cat.normalize_category("c", "s").alias("got")).collect()
    assert [r["got"] for r in out] == [r["want"] for r in out]


def test_add_normalized_category_absent_columns(spark):
    df = spark.createDataFrame([("Get refund",), ("",)], "`Sub Category` string")
    got = [r["normalized_category"] for r in cat.add_normalized_category(df).collect()]
    assert got == ["REFUND", "OTHER"]
    df2 = spark.createDataFrame([("order",)], "category string")
    assert cat.add_normalized_category(df2).first()["normalized_category"] == "ORDER"
