"""N1, N3-N10 as tables of valid / invalid inputs."""

import pytest
from pyspark.sql import functions as F

from labelqa.functions import phone, rules


def one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_first_number_valid_and_invalid(spark):
    ok2 = ["2", "2 mg/L", "2mgl", "~2", "approximately 2", "2 or 3"]
    ok12 = ["12.5", "12.5 kg", "12.5kg", "~12.5", "approximately 12.5", "12.5 and 15"]
    bad = ["mg/L", "", " ", None, "abc"]
    assert one(spark, ok2, rules.number_from_string) == [2.0] * 6
    assert one(spark, ok12, rules.number_from_string) == [12.5] * 6
    assert one(spark, bad, rules.number_from_string) == [None] * 5


def test_first_number_ignores_sign_and_separators(spark):
    # Sign, thousands separator and leading dot are not part of a number
    got = one(spark, ["-5", "1,234.5", ".5", "18,7", "30 and 40", "6.5/7.0", "10, 15"],
              rules.number_from_string)
    assert got == [5.0, 1.0, 5.0, 18.0, 30.0, 6.5, 10.0]


def test_grade_valid_and_invalid(spark):
    ok = ["10-5-20", "0-0-0", "100-200-300", "10.2-5.5-20.3", "2000-01-01"]
    bad = ["10-abc-20", "20-10", "10--20", "10-5-20-30", "10-5", "10-5-x", "-10-5-20",
           "10--5-20", "abc-def-ghi", "10- 5 - 20", "10:5:20", "10,5,20", "", " ", "10-5-"]
    assert one(spark, ok, rules.grade) == ok
    assert one(spark, bad, rules.grade) == [None] * len(bad)
    parts = one(spark, ["10.2-5.5-20.3"], rules.grade_parts)[0]
    assert (parts.n, parts.p, parts.k) == (10.2, 5.5, 20.3)


def test_registration_id(spark):
    ok = [f"1234567{c}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    bad = ["1234567", "1234567AA", "1234567A1", "1234567A ", "1234567 A", "1234567A-",
           "1234567A.", "1234567A,", "1234", "12345A", "1234567a", "12345678B", "12A34567B"]
    assert one(spark, ok, rules.registration_id) == ok
    assert one(spark, bad, rules.registration_id) == [None] * len(bad)


def test_registration_type(spark):
    vals = ["ingredient_component", "fertilizer_product", "FERTILIZER", "INGREDIENT",
            "PRODUCT", "COMPONENT", None]
    assert one(spark, vals, rules.registration_type) == vals[:2] + [None] * 5


def test_website(spark):
    # The prefix test is case-sensitive and runs before lower-casing
    vals = ["http://www.SOIL-AID.com", "www.A.com", "WWW.a.com", "a.com", None]
    assert one(spark, vals, rules.website) == [
        "www.http://www.soil-aid.com", "www.a.com", "www.www.a.com", "www.a.com", None]


def test_is_minimal(spark):
    df = spark.createDataFrame(
        [("Guaranteed minimum analysis", None), ("Guaranteed analysis", None), (None, None),
         ("", True), (None, False), ("MINIMAL grade", None), ("subminimal", None)],
        "t string, inc boolean")
    got = [r[0] for r in df.select(rules.is_minimal("t", "inc")).collect()]
    # Empty or missing title keeps the incoming flag
    assert got == [True, False, None, True, False, True, False]


def test_empty_if_null(spark):
    df = spark.createDataFrame([(None,), (["a"],)], "l array<string>")
    got = [r[0] for r in df.select(rules.empty_if_null("l", "string")).collect()]
    assert got == [[], ["a"]]


@pytest.mark.parametrize("raw,expected", [
    ("+1 800 640 9605", "+18006409605"),
    ("800 640 9605", "+18006409605"),
    ("(757) 321-4567", "+17573214567"),
    ("+44 20 7946 0958", "+442079460958"),
    ("1-800-327-9462", "+18003279462"),
    ("450 655-6147", "+14506556147"),
    ("1 (866) 337-2943", "+18663372943"),
    ("800-765-4321", "+18007654321"),
    ("+1 800 321-9605 FAX", None),
    ("(757) 123-4567 (800) 456-7890, 1234567890", None),
    ("invalid phone", None),
    ("12345", None),
    ("123-456-7890", None),
    ("098-765-4321", None),
    ("1-800-539-5283 or 713-461-1493", None),
    ("Tel: 800 640 9605", "+18006409605"),          # leading text dropped
    ("800 640 9605 ext. 12", "+18006409605"),       # extension dropped
    ("800-640-9605 x7", "+18006409605"),
    ("1-800-GOT-JUNK", "+18004685865"),             # vanity letters
    ("011 44 20 7946 0958", "+442079460958"),       # international prefix
    ("800 640 9605 A", "+18006409605"),             # fewer than three letters are ignored
    ("800 640 9605 ext", None),                     # three letters become digits: too long
    (None, None),
])
def test_phone(spark, raw, expected):
    assert one(spark, [raw], phone.to_e164) == [expected]
