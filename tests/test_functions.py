"""Edge rows of the column functions."""

import hashlib
import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartlift.functions import clinical, dates, ids, numbers, text


def values(spark, inputs, function, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(function(F.col("v"))).collect()]


def test_extract_number(spark):
    inputs = [None, "", "hey 9.0 33 f", "04,4%", "0.5", "abc", "007", "12.", "x" * 32 + "5"]
    assert values(spark, inputs, numbers.extract_number) == [None, "0", "9.0", "4.4", ".5", "0", "7", "12", "5"]


def test_number_value(spark):
    assert values(spark, ["04,4%", "abc", "1.2.3", None], numbers.number_value) == [4.4, 0.0, 1.2, None]


def test_is_number(spark):
    assert values(spark, [" 5 ", "5.", "1,2", "...", "", None], numbers.is_number) == [False, True, True, False, False, None]


def test_try_fix_date(spark):
    inputs = ["2010-02-31", "2010-15-03", "2010-02-28", "2010-12-31", "2010-04-31", "2010-00-10", "junk", None, "2010-1-5"]
    expected = [date(2010, 3, 1), date(2010, 12, 1), date(2010, 2, 28), date(2010, 12, 31), date(2010, 5, 1), None, None, None, date(2010, 1, 5)]
    assert values(spark, inputs, dates.try_fix_date) == expected


def test_full_years_and_relaxed_birthdate(spark):
    frame = spark.sql("SELECT date'2000-06-15' AS born, date'2010-06-14' AS before, date'2010-06-15' AS after, cast(null AS date) AS death")
    row = frame.select(
        dates.full_years("born", "before").alias("a"), dates.full_years("born", "after").alias("b"),
        dates.relaxed_birthdate("born", "death", "2010-06-15").alias("c"), dates.relaxed_birthdate("born", "death", "2000-07-01").alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (9, 10, date(1995, 6, 15), date(1999, 6, 15))


def test_uuid_name_is_the_standard_name_uuid(spark):
    digest = bytearray(hashlib.md5(f"{ids.NAME_UUID_NAMESPACE}-user-17".encode()).digest())
    expected = str(uuid.UUID(bytes=bytes(digest), version=3))
    assert values(spark, ["17"], lambda v: ids.uuid_name("user", v)) == [expected]


def test_uuid_hash_has_version_and_variant(spark):
    digest = hashlib.sha1(f"{ids.HASH_UUID_NAMESPACE}infant5".encode()).hexdigest()
    [found] = values(spark, ["infant5"], ids.uuid_hash)
    assert found[:8] == digest[:8] and found[14] == "5" and found[19] in "89ab" and found[-12:] == digest[20:32]


def test_vital_values(spark):
    inputs = [("height", 1.7, None, 170.0), ("height", 170.0, None, 170.0), ("weight", 100.0, "lbs", 45.4), ("weight", 60.0, "kgs", 60.0),
              ("weight", 60.0, None, 60.0), ("blood_pressure_dias", 8.0, None, 80.0), ("blood_pressure_sys", 12.0, None, 120.0),
              ("temperature", 98.6, None, 37.0), ("heart_rate", 8.0, None, 8.0)]
    frame = spark.createDataFrame(inputs, "sign string, result double, unit string, expected double")
    assert frame.filter(F.abs(numbers.vital_value("sign", "result", "unit") - F.col("expected")) > 1e-9).count() == 0


def test_weight_policies_differ(spark):
    frame = spark.createDataFrame([(100.0, None)], "w double, u string")
    row = frame.select(numbers.weight_kg_staging("w", "u").alias("s"), numbers.weight_kg_export("w", "u").alias("e")).first()
    assert row.s == 100.0 and abs(row.e - 45.3593) < 1e-3


def test_names(spark):
    names = ["Marie Ange Paul", "Jean", None, " Luc Noel "]
    assert values(spark, names, text.first_names) == ["Marie Ange ", "Jean", None, "Luc "]
    assert values(spark, names, text.last_name) == ["Paul", "Jean", None, "Noel"]


def test_parse_kv_map(spark):
    assert values(spark, ["a=1,b=x=y,,a=2", "k", "", None], text.parse_kv_map) == [{"a": "2", "b": "x=y"}, {"k": None}, {}, None]


def test_concat_with_nulls(spark):
    frame = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert [tuple(r) for r in frame.select(text.concat_skip_null(", ", "x", "y"), text.concat_or_null("x", "y")).collect()] == [("a", None), (None, None)]


def test_username(spark):
    assert values(spark, ["`bob@x", "al@y", "noat", None], lambda v: text.username_from_email(v, F.lit(1))) == ["bob", "al", "", None]


def test_parse_typed_strict_raises(spark):
    assert values(spark, ["5", "x", None], lambda v: clinical.parse_typed(v, "int", strict=False)) == [5, None, None]
    with pytest.raises(PySparkException):
        values(spark, ["maybe"], lambda v: clinical.parse_typed(v, "boolean"))


@pytest.mark.parametrize("test, raw, expected", [
    ("cd4", "20%", (None, 20.0, None, None, None)),
    ("cd4_percent", "140", (None, None, None, None, "140")),
    ("cd4", "500", (500.0, None, None, None, None)),
    ("ppd", "positive:12", (12.0, None, "POSITIVE", None, None)),
    ("ppd", "x:y", (None, None, None, None, "x:y")),
    ("ppd", "12", (12.0, None, None, None, None)),
    ("ppd", "f", (None, None, "NEGATIVE", None, None)),
    ("sputum", "+++", (None, None, "THREE_PLUS", None, None)),
    ("blood_type", "ab+", (None, None, "AB_POSITIVE", None, None)), ("blood_type", "ab_positive", (None, None, None, None, "ab_positive")),
    ("biochemistry", "12", (None, None, None, None, "12")),
    ("rpr", "maybe", (None, None, None, None, "maybe")),
    ("culture", "anything", (None, None, None, "anything", None)),
])
def test_lab_result(spark, test, raw, expected):
    frame = spark.createDataFrame([(test, raw)], "t string, r string")
    assert tuple(frame.select(clinical.lab_result("t", "r").alias("x")).select("x.*").first()) == expected


def test_spelling(spark):
    inputs = ["Négatif", "POS : 12mm", "o mm/h", "neg::5", None]
    assert values(spark, inputs, clinical.spelling_normalise) == ["negative", "positive:12", "0", "negative:5", None]


def test_days_of_texts(spark):
    texts = ["2010-02-03", "2010-02-03 10:00:00", "2010-02-03T10:00:00.5Z", "2010-2-3", "2010-02-03xyz", "x2010-02-03", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.d for r in frame.select(dates.day_part("t").alias("d")).collect()] == ["2010-02-03"] * 3 + ["2010-2-3"] + [None] * 4


def test_numbers_are_found_anywhere_in_a_text(spark):
    frame = spark.createDataFrame([("a" * 40 + " 012,5. kg",)], "t string")
    assert frame.select(numbers.extract_number("t").alias("n")).first().n == "12.5"
