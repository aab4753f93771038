from datetime import datetime

from pyspark.sql import functions as F

from ludolytics import functions as fn


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column.alias("y")).collect()]


def test_price(spark):
    prices = [None, "", "0", "999", "1000", "abc"]
    assert values(spark, fn.price_cents(F.col("x")), prices) == [0, 0, 0, 999, 1000, None]
    assert values(spark, fn.price_label(F.col("x")), prices) == [
        "Free", "Free", "Free", "$9.99", "$10.00", None,
    ]


def test_percent_without_votes(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (1, 1), (None, 1)], "a int, b int")
    got = [r[0] for r in df.select(fn.percent(F.col("a"), F.col("a") + F.col("b"), 1)).collect()]
    assert got == [None, 33.3, 50.0, None]


def test_key_needs_all_parts(spark):
    df = spark.createDataFrame([(None, 5), ("5", None), ("7", 5)], "a string, b int")
    got = [r[0] for r in df.select(fn.md5_key(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == [None, None]
    import hashlib

    assert got[2] == hashlib.md5(b"7_5").hexdigest()


def test_times(spark):
    seconds = [None, 0, 1700000000, 10**15, -(10**15)]
    got = values(spark, fn.epoch_to_ntz(F.col("x")), seconds, "x bigint")
    assert got == [None, None, datetime(2023, 11, 14, 22, 13, 20), None, None]
    texts = ["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05", "2024-01-02T05:04:05.5+02:00", "x", None]
    assert values(spark, fn.iso_to_ntz(F.col("x")), texts) == [
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 5, 500000),
        None,
        None,
    ]


def test_clean_text(spark):
    cases = {
        None: "",
        "": "",
        "https://a.b/c?d=1": "",
        "See www.x.y now": "see now",
        "Größe  \t ÉTÉ — ok!": "größe été ok!",
        "a b c": "a b c",
        "it's 'so-so' \"x\" (y) #z": "it's 'so-so' \"x\" y z",
    }
    assert values(spark, fn.clean_text(F.col("x")), list(cases)) == list(cases.values())
    long = "word " * 2000
    assert len(values(spark, fn.clean_text(F.col("x")), [long])[0]) == 9999
    assert len(values(spark, fn.clean_text(F.col("x"), 5000), [long])[0]) == 5000


def test_words(spark):
    got = values(spark, fn.words(F.col("x")), ["don't stop - the so-so game_1 !", "...", ""])
    assert got == [["don't", "stop", "the", "so-so", "game_1"], [], []]


def test_excerpt(spark):
    got = values(spark, fn.excerpt(F.col("x"), 5), ["12345", "123456", None])
    assert got == ["12345", "12345...", None]


def test_fences(spark):
    texts = ['```json\n{"a": 1}\n```', '```\n{"a": 1}```', ' {"a": 1} ']
    assert set(values(spark, fn.strip_fences(F.col("x")), texts)) == {'{"a": 1}'}
