"""Typing of raw clinical values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column
from chartlift.functions.dates import day_part

# Spellings of truth in the source.
TRUE_WORDS = ["t", "T", "true"]
FALSE_WORDS = ["f", "F", "no", "false"]

# How the result of each lab test is typed.
NUMERIC_TESTS = ["blood_glucose", "cholesterol", "creatinine", "eryth_sed_rate", "sgot", "sgpt", "urea", "viral_load"]
SIMPLE_CODED_TESTS = ["elisa", "rpr", "tr", "western_blot"]
PERCENT_TESTS = ["cd4_percent", "hematocrit", "hematocrite"]
NUMBER_OR_PERCENT_TESTS = ["cd4", "hemoglobin", "tot_lymph_count"]
TEXT_TESTS = [
    "abdominal_ultrasound", "chest_xray", "culture", "cxr", "cxr0", "cxr1", "cxr2", "hanging_drop", "other",
    "other_radiology", "other_std", "other_test", "stool", "urinalysis", "vaginal_smear",
]
BLOOD_TYPES = {
    "AB_NEGATIVE": ["AB-"], "AB_POSITIVE": ["AB+"], "B_NEGATIVE": ["B-"], "B_POSITIVE": ["B+"], "O_NEGATIVE": ["O-"],
    "O_POSITIVE": ["O+"], "A_NEGATIVE": ["A-"], "A_POSITIVE": ["A+"],
}
CYTOLOGY_RESULTS = ["ASCUS", "HSIL", "LSIL"]
SENSITIVITY_RESULTS = {
    "PAN_SENSITIVE": ["pan-sensitive:"],
    "RESISTANT_TO_HREZ": ["resistant:HERZ", "resistant:RHEZ"],
}
SMEAR_RESULTS = {
    "NEGATIVE": ["negative"], "POSITIVE": ["positive"], "ONE_PLUS": ["+"], "TWO_PLUS": ["++"],
    "THREE_PLUS": ["+++"], "POOR_SAMPLE": ["poor sample"], "INSUFFICIENT_SAMPLE": ["echantillon insuffisant"],
    "NOT_DONE": ["not_done"],
}
CODED_TESTS = {
    "blood_type": BLOOD_TYPES,
    "cytology": {code: [code] for code in CYTOLOGY_RESULTS},
    "dst": SENSITIVITY_RESULTS,
    "smear1": SMEAR_RESULTS, "smear2": SMEAR_RESULTS, "smear3": SMEAR_RESULTS, "sputum": SMEAR_RESULTS,
}
POSITIVE_WORDS = ["positive", "t"]
NEGATIVE_WORDS = ["negative", "f"]
UNKNOWN_WORDS = ["unknown", "undetermined", "?"]

# Misspelt results and units of the skin test.
NEGATIVE_SPELLINGS = [
    "negatif`", "negatif", "neg", "neagtif", "négatif", "negative", "nã©gatif", "ngatif", "neatif", "nagatif",
]
POSITIVE_SPELLINGS = ["positif", "pos"]
SKIN_TEST_UNITS = ["mms/hres", "mm/h", "mmm", "MM", "mm", "mms", "mn", "m"]

JAVA_DOUBLE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def decode_flag(value: ColumnLike) -> Column:
    """'t'/'f' to true/false, anything else to null."""
    flag = as_column(value)
    return F.when(flag == "t", True).when(flag == "f", False)


def parse_boolean(value: ColumnLike) -> Column:
    """Text to boolean; null where the text is none of the known words."""
    text = as_column(value)
    return F.when(text.isin(TRUE_WORDS), True).when(text.isin(FALSE_WORDS), False)


def parse_double(value: ColumnLike) -> Column:
    """Text to double, null where the text is no plain number."""
    text = as_column(value)
    return F.when(text.rlike(JAVA_DOUBLE), F.trim(text).try_cast("double"))


def parse_typed(value: ColumnLike, kind: str, strict: bool = True) -> Column:
    """Text to 'int', 'double', 'date', 'boolean' or 'string'.

    ``strict`` raises on text that cannot be read, as the source does; otherwise it gives null.
    """
    text = as_column(value).cast("string")
    readers = {
        "int": lambda: F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int")),
        "double": lambda: parse_double(text),
        "date": lambda: day_part(text).try_cast("date"),
        "boolean": lambda: parse_boolean(text),
        "string": lambda: text,
    }
    parsed = readers[kind]()
    if not strict:
        return parsed
    message = F.concat(F.lit("cannot read "), F.coalesce(text, F.lit("null")), F.lit(f" as {kind}"))
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(F.raise_error(message).cast(
        {"string": "string", "int": "int", "double": "double", "date": "date", "boolean": "boolean"}[kind]))


def alias_code(value: ColumnLike, aliases: dict[str, list[str]]) -> Column:
    """The code whose alias list holds the value, ignoring case."""
    text = F.lower(as_column(value))
    chain = None
    for code, words in aliases.items():
        condition = text.isin([word.lower() for word in words])
        chain = F.when(condition, F.lit(code)) if chain is None else chain.when(condition, F.lit(code))
    return chain


def coded_or_noncoded(value: ColumnLike, aliases: dict[str, list[str]]) -> Column:
    """``struct<coded, non_coded>``: the code of a known alias, else the text itself."""
    code = alias_code(value, aliases)
    return F.struct(code.alias("coded"), F.when(code.isNull(), as_column(value)).alias("non_coded"))


def simple_lab_code(value: ColumnLike) -> Column:
    return alias_code(value, {"POSITIVE": POSITIVE_WORDS, "NEGATIVE": NEGATIVE_WORDS, "UNKNOWN": UNKNOWN_WORDS})


def lab_result(
    test: ColumnLike,
    raw: ColumnLike,
) -> Column:
    """Route a raw lab result to ``struct<numeric, percent, coded, text, exception>``.

    A value that does not fit the type of its test, or whose test is not known, becomes the exception value.
    """
    name, value = F.lower(as_column(test)), as_column(raw)
    number = parse_double(value)
    percent_number = parse_double(F.trim(F.regexp_replace(value, "%", "")))
    percent = F.when(percent_number < 100, percent_number)
    simple = simple_lab_code(value)

    parts = F.split(value, ":")
    ppd_single = F.size(parts) == 1
    ppd_code = simple_lab_code(parts[0])
    ppd_number = parse_double(F.get(parts, F.lit(1)))
    ppd_pair = ppd_code.isNotNull() & ppd_number.isNotNull()

    is_text = name.isin(TEXT_TESTS)
    as_percent = name.isin(PERCENT_TESTS) | (name.isin(NUMBER_OR_PERCENT_TESTS) & value.contains("%"))
    as_number = name.isin(NUMERIC_TESTS) | (name.isin(NUMBER_OR_PERCENT_TESTS) & ~value.contains("%"))
    is_ppd = name == "ppd"  # a sign, a size in millimetres, or both as sign:size

    coded = F.when(name.isin(SIMPLE_CODED_TESTS), simple)
    for other, aliases in CODED_TESTS.items():
        coded = coded.when(name == other, alias_code(value, aliases))
    coded = coded.when(is_ppd & ppd_single, simple).when(is_ppd & ppd_pair, ppd_code)

    numeric = (
        F.when(as_number, number)
        .when(is_ppd & ppd_single & simple.isNull(), number)
        .when(is_ppd & ~ppd_single & ppd_pair, ppd_number)
    )
    percent = F.when(as_percent, percent)
    text = F.when(is_text, value)
    typed = F.coalesce(numeric.cast("string"), percent.cast("string"), coded, text)
    exception = F.when(value.isNotNull() & typed.isNull(), value)
    return F.struct(
        numeric.alias("numeric"), percent.alias("percent"), coded.alias("coded"), text.alias("text"),
        exception.alias("exception"),
    )


def _normalise_part(part: Column) -> Column:
    word = F.trim(part)
    lower = F.lower(word)
    spelled = (
        F.when(lower.isin(NEGATIVE_SPELLINGS), "negative").when(lower.isin(POSITIVE_SPELLINGS), "positive").otherwise(word)
    )
    without_unit = F.regexp_replace(spelled, "(?:" + "|".join(SKIN_TEST_UNITS) + ")$", "")
    bare = F.trim(without_unit)
    return F.when(F.lower(bare) == "o", "0").otherwise(bare)


def spelling_normalise(value: ColumnLike) -> Column:
    """Canonical spelling of each ':' part of a skin test result; empty parts go."""
    parts = F.transform(F.split(as_column(value), ":"), _normalise_part)
    return F.array_join(F.filter(parts, lambda part: part != ""), ":")
