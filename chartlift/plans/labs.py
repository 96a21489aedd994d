"""Laboratory results, exam labs, PCR tests and ordered tests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.numbers import extract_number, is_number, number_value
from chartlift.operators import aggregates, eav, filters, quality
from chartlift.sources.readers import coded_by

# Concepts of the laboratory results.
SPECIMEN_NUMBER = "162086AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"
VIRAL_LOAD_GROUP = "11765b8c-a338-48a4-9480-df898c903723"
VIRAL_LOAD_VALUE = "3cd4a882-26fe-102b-80cb-0017a47871b2"
VIRAL_LOAD_QUALITATIVE = "1305AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"
BELOW_LIMIT = "1306AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"
DETECTED = "1301AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"
DETECTABLE_LIMIT = "53cb83ed-5d55-4b63-922f-d6b8fc67a5f8"
NUMERIC_RESULTS = {
    "cd4": "3ceda710-26fe-102b-80cb-0017a47871b2",
    "hematocrit": "3cd69a98-26fe-102b-80cb-0017a47871b2",
    "ppd": "3cecf388-26fe-102b-80cb-0017a47871b2",
}

# Concept of each test that can be ordered; no concept, no observation.
ORDERED_TESTS = {
    "abdominal_ultrasound": "CIEL:845",
    "bun": "LOCAL:12655",
    "cd4": "CIEL:5497",
    "chest_xray": "CIEL:165152",
    "culture": "CIEL:159982",
    "creatinine": "CIEL:164364",
    "cxr": "CIEL:165152",
    "elisa": "CIEL:1041",
    "esr": "LOCAL:1477",
    "glucose": "CIEL:887",
    "hematocrit": "LOCAL:HEMATOCRIT",
    "hemoglobin": "LOCAL:HEMOGLOBIN",
    "malaria_smear": "CIEL:32",
    "platelets": "CIEL:729",
    "ppd": "CIEL:5475",
    "pregnancy_test": "LOCAL:B-HCG",
    "rpr": "CIEL:1619",
    "sgot_ast": "CIEL:653",
    "sgpt_alt": "CIEL:654",
    "tb_smear": "LOCAL:TUBERCULOSIS SMEAR RESULT",
    "viral_load": "CIEL:856",
    "western_blot": "CIEL:1047",
    "white_blood_count": "CIEL:678",
}
RADIOLOGY_ORDERS = ["abdominal_ultrasound", "chest_xray", "cxr"]
CHEST_FILMS = ["cxr0", "cxr1", "cxr2"]
OTHER_RADIOLOGY = ["abdominal_ultrasound", "other_radiology"]

# Coded results of exam labs.
RPR_RESULTS = {"negative": "LOCAL:NON-REACTIVE", "positive": "LOCAL:REACTIVE"}
SPUTUM_RESULTS = {
    "negative": "LOCAL:NEGATIVE", "negatif": "LOCAL:NEGATIVE", "positive": "CIEL:1362",
    "+++": "CIEL:1364", "++": "CIEL:1363", "+": "CIEL:1362",
}


def lab_results_obs(results: DataFrame) -> DataFrame:
    """Lab and rapid test rows: specimen and technician, viral load and rapid test groups, plain numbers."""
    kind, value, sample = F.lower("test_type"), F.col("value_numeric"), F.col("sample_id")
    viral, rapid = kind == "viral_load", kind == "tr"
    below = F.coalesce("vl_beyond_detectable_limit", F.lit(False))
    plain = [
        eav.numeric(concept, "value_numeric", when=kind == test, accession=sample, keep_null=True, tag=test)
        for test, concept in NUMERIC_RESULTS.items()
    ]
    sign = F.when(F.col("value_boolean"), "CIEL:703").otherwise("CIEL:664")
    return eav.emit(results, "lab", ["source_result_id"], "source_encounter_id", [
        eav.text(SPECIMEN_NUMBER, "sample_id"),
        eav.text("LOCAL:Lab tech non-coded", F.trim("performed_by")),
        eav.Group(VIRAL_LOAD_GROUP, [
            eav.numeric(VIRAL_LOAD_VALUE, value),
            eav.coded(VIRAL_LOAD_QUALITATIVE, F.when(below, BELOW_LIMIT).otherwise(DETECTED)),
            eav.numeric(DETECTABLE_LIMIT, "vl_detectable_lower_limit"),
        ], when=viral),
        *plain,
        eav.Group("LOCAL:13135", [eav.coded("CIEL:163722", sign, accession=sample)], when=rapid),
    ])


@dataclass(frozen=True)
class LabRule:
    """How results of one exam lab are read: which are valid, and what they become."""

    valid: Column
    concept: Column
    number: Column
    code: Column


def exam_lab_rules(result: Column) -> dict[str, LabRule]:
    """The value, code and validity rule of each exam lab."""
    nothing_text, nothing_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    number = number_value(result)
    has_number = is_number(extract_number(result))
    signed = result.like("negative%") | result.like("positive%")
    sign = F.when(result.like("negative%"), "LOCAL:NEGATIVE").when(result.like("positive%"), "LOCAL:POSITIVE")
    hemoglobin = filters.matches(result, "^[[:blank:]]*[0-9.]+[[:blank:]]*gr?.dll?$") | is_number(result)
    return {
        "cd4": LabRule(is_number(result) | filters.matches(result, "[0-9]+cell.*"), F.lit("CIEL:5497"), number, nothing_text),
        "hematocrite": LabRule(has_number, F.lit("LOCAL:HEMATOCRIT"), number, nothing_text),
        "ppd": LabRule(
            signed | is_number(result),
            F.when(signed, "LOCAL:1435").when(is_number(result), "LOCAL:TUBERCULIN SKIN TEST"),
            F.when(is_number(result), number), sign,
        ),
        "rpr": LabRule(result.isin(list(RPR_RESULTS)), F.lit("CIEL:1619"), nothing_number, filters.case_map(result, RPR_RESULTS)),
        "sputum": LabRule(result.isin(list(SPUTUM_RESULTS)), F.lit("LOCAL:TUBERCULOSIS SMEAR RESULT"), nothing_number,
                          filters.case_map(result, SPUTUM_RESULTS)),
        "hemoglobin": LabRule(hemoglobin, F.lit("LOCAL:HEMOGLOBIN"), number, nothing_text),
        "eryth_sed_rate": LabRule(has_number, F.lit("LOCAL:ERYTHROCYTE SEDIMENTATION RATE"), number, nothing_text),
    }


def read_exam_labs(labs: DataFrame, encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Exam labs with the rule of their test applied in one pass: valid, concept, number, code, migrated.

    ``encounters`` are the staged ones; ``encounter_type`` null means that the encounter was not migrated.
    """
    rules = exam_lab_rules(F.col("result"))
    test = F.col("lab_test")

    def by_test(part: str) -> Column:
        chain = None
        for name, rule in rules.items():
            value = getattr(rule, part)
            chain = F.when(test == name, value) if chain is None else chain.when(test == name, value)
        return chain

    visits = encounters.select("source_encounter_id", "source_patient_id", "source_encounter_type",
                               F.col("encounter_type").isNotNull().alias("migrated"))
    rows = labs.filter(test.isin(list(rules))).join(visits, "source_encounter_id")
    rows = rows.join(patients.select("source_patient_id", "person_id"), "source_patient_id")
    return rows.withColumns({
        "valid": F.coalesce(by_test("valid"), F.lit(False)), "concept": by_test("concept"),
        "number": by_test("number"), "code": by_test("code"),
    })


def exam_labs_obs(read: DataFrame) -> DataFrame:
    """Valid results of migrated encounters, dated by their test."""
    code = F.col("code").isNotNull()
    good = F.col("valid") & F.col("migrated")
    at = F.col("test_date")
    return eav.emit(read, "exam_lab", ["exam_lab_id"], "source_encounter_id", [
        eav.coded(F.col("concept"), F.col("code"), when=good & code, at=at, tag="c"),
        eav.numeric(F.col("concept"), "number", when=good & ~code, at=at, keep_null=True, tag="n"),
    ])


def exam_lab_warnings(read: DataFrame) -> DataFrame:
    """Invalid results (flagged) and results of encounters that were not migrated."""
    field = F.concat(F.lit("HIV_EXAM_LAB_RESULTS "), "lab_test")
    about = {"patient": "person_id", "encounter": "source_encounter_id", "field": field, "value": "result"}
    return quality.all_warnings(
        quality.warn(read, F.concat(F.lit("Invalid "), "lab_test", F.lit(" value. Not migrated.")),
                     when=~F.col("valid") | F.col("result").isNull(), **about),
        quality.warn(read, F.concat("lab_test", F.lit(" value belongs to an encounter that was not migrated. Value not migrated.")),
                     details=F.concat(F.lit("Source encounter type "), "source_encounter_type"), flag=False,
                     when=~F.col("migrated"), **about),
    )


def radiology_obs(labs: DataFrame) -> DataFrame:
    """Chest films of an encounter as one report; other examinations as one report each."""
    present = F.col("result").isNotNull() | F.col("test_date").isNotNull()
    day = F.date_format("test_date", "yyyy-MM-dd")
    films = labs.filter(F.col("lab_test").isin(CHEST_FILMS) & present)
    line = F.concat_ws(": ", "lab_test", "result", day)
    findings = aggregates.string_agg(films, ["source_encounter_id"], line, "findings", "; ", order=["lab_test"])
    dated = films.groupBy("source_encounter_id").agg(
        F.max(F.when(F.col("result").isNotNull(), F.col("test_date"))).alias("last_date")
    )
    chest = eav.emit(findings.join(dated, "source_encounter_id"), "chest_film", ["source_encounter_id"], "source_encounter_id", [
        eav.Group("LOCAL:Radiology report construct", [
            eav.coded("LOCAL:Radiology procedure performed", "CIEL:165152"),
            eav.text("LOCAL:Radiology report comments", "findings"),
            eav.datetime("LOCAL:12847", "last_date"),
        ]),
    ])
    procedure = F.when(F.col("lab_test") == "abdominal_ultrasound", "CIEL:845").otherwise("LOCAL:OTHER NON-CODED")
    others = labs.filter(F.col("lab_test").isin(OTHER_RADIOLOGY) & present)
    reports = eav.emit(others, "radiology", ["exam_lab_id"], "source_encounter_id", [
        eav.Group("LOCAL:Radiology report construct", [
            eav.coded("LOCAL:Radiology procedure performed", procedure),
            eav.text("LOCAL:Radiology report comments", "result", keep_null=True),
            eav.datetime("LOCAL:12847", "test_date", when=F.col("result").isNotNull()),
        ]),
    ])
    return chest.unionByName(reports)


# Steps of a sample's way through the laboratory.
TRACKING_EVENTS = ["sent_to_central_site", "received_at_central_site", "sent_to_lab", "result_received"]


def stage_pcr(tests: DataFrame, tracking: DataFrame) -> DataFrame:
    """PCR tests with the first date of each tracking event, folded in one pass over the tracking rows."""
    firsts = tracking.groupBy("pcr_test_id").agg(
        *[F.min(F.when(F.col("event_type") == e, F.to_date("event_date"))).alias(f"date_{e}") for e in TRACKING_EVENTS]
    )
    joined = tests.join(firsts, "pcr_test_id", "left")
    return joined.withColumns({
        "result": F.lower("result"),
        "encounter_date": F.coalesce(F.to_date("sample_date"), F.to_date("result_entry_date")),
        "date_of_result": F.col("date_result_received"),
    })


def pcr_obs(staged: DataFrame, infants: DataFrame) -> DataFrame:
    """Result, its date and the sample number of tests with a result (the test is its own encounter)."""
    rows = staged.filter(F.col("result").isNotNull()).join(infants.select("source_infant_id", "person_id"), "source_infant_id")
    code = filters.case_map("result", {"negative": "CIEL:664", "positive": "CIEL:703", "indeterminate": "CIEL:1138"})
    at = F.col("encounter_date")
    return eav.emit(rows, "pcr", ["pcr_test_id"], "pcr_test_id", [
        eav.datetime("LOCAL:Date of test results", "date_of_result", at=at),
        eav.coded("CIEL:1030", code, keep_null=True, at=at, accession=F.col("sample_id"), comments=F.col("comments")),
        eav.text("CIEL:162086", "sample_id", at=at),
    ])


def ordered_tests_obs(orders: DataFrame) -> DataFrame:
    """Ordered tests: none, mapped ones, radiology, and all other ones of an encounter in one comment."""
    tests = coded_by(orders.withColumn("test", F.lower(F.trim("test"))), "test", ORDERED_TESTS, "_ref")
    film = F.col("test").isin(RADIOLOGY_ORDERS)
    question = "LOCAL:Lab test ordered coded"
    each = eav.emit(tests, "ordered_test", ["order_id"], "source_encounter_id", [
        eav.coded(question, "CIEL:1107", when=F.col("test") == "none"),
        eav.coded(question, F.col("_ref"), when=~film),
        eav.coded("LOCAL:Radiology image ordered", F.col("_ref"), when=film),
    ])
    others = aggregates.string_agg(tests.filter(F.col("test").like("other%")), ["source_encounter_id"], "test_other", "listed", ", ")
    other = eav.emit(others, "other_test", ["source_encounter_id"], "source_encounter_id",
                     [eav.coded(question, "LOCAL:OTHER", comments=F.col("listed"))])
    return each.unionByName(other)
