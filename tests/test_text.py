from pyspark.sql import functions as F

from threadlens.functions.text import clean_text, is_valid_id, label_intent, ngrams, tokens


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_clean(spark):
    got = values(spark, ["  hello \n world ", "", None, "@user", "@Étoile see https://t.co/a?b=1 now　ok", "Keep Case!"], clean_text)
    assert got == ["hello world", "", "", "", "see now ok", "Keep Case!"]


def test_url_goes_before_mention(spark):
    assert values(spark, ["x https://h/@me y"], clean_text) == ["x y"]


def test_valid_id(spark):
    assert values(spark, ["123456789", " 12 ", None, "abc", "", "1.0"], is_valid_id) == [True, True, False, False, False, False]


def test_label_order_and_boundaries(spark):
    cases = {
        "My Apple ID is gone": "account_access", "icloud is locked? icloud lock": "account_access", "icloud": "icloud_sync",
        "repair cost please": "device_hardware", "the screen has a crack": "device_hardware", "the screen cracked": "other",
        "iOS 9 is bad": "software_update", "iOS 11 is bad": "other", "get me a REFUND": "billing_payment", "": "other",
        "no cell signal": "connectivity", "applecare?": "warranty_repair", "my app keeps crash": "app_issue", "hello": "other",
    }
    assert values(spark, list(cases), label_intent) == list(cases.values())
    assert values(spark, [None], label_intent) == ["other"]


def test_tokens_and_ngrams(spark):
    assert values(spark, ["I am, Über ok_2!"], tokens) == [["am", "über", "ok_2"]]
    assert values(spark, ["aa bb cc", "aa", ""], lambda c: ngrams(tokens(c), 3)) == [
        ["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["aa"], []]
