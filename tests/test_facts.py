"""Facts read by declared shapes, and documents folded in one shuffle."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from chartlift.plans import documents, facts


def test_values_are_typed_or_reported(spark):
    rows = spark.createDataFrame(
        [(1, "Cough", "t", "2010-01-02", "3", "days", None, 9), (1, "sore toe", "maybe", "soon", "3.5", "hours", "x", 9), (2, None, None, None, None, None, None, 9), (None, "", "f", "", "", "", "", 9)],
        "source_encounter_id int, symptom string, result string, symptom_date string, duration string, duration_unit string, symptom_comment string, unread int",
    )
    found = {(r.source_encounter_id, r.symptom, r.symptom_other): r for r in facts.symptom_facts(rows).collect()}
    assert len(found) == 4
    good = found[1, "COUGH", None]
    assert (good.present, good.symptom_date, good.duration, good.duration_unit, good.unread) == (True, date(2010, 1, 2), 3, "DAYS", None)
    bad = found[1, None, "sore toe"]
    assert (bad.present, bad.symptom_date, bad.duration, bad.duration_unit) == (None, None, None, None)
    assert bad.unread == "present: maybe; symptom_date: soon; duration: 3.5; duration_unit: hours"
    assert found[2, None, None].unread is None
    assert facts.symptom_facts(rows.limit(0)).collect() == []


def test_strict_reading_raises(spark):
    rows = spark.createDataFrame([(1, "skin", "purple")], "source_encounter_id int, system string, condition string")
    assert facts.system_status_facts(rows).first().unread == "condition: purple"
    with pytest.raises(Exception, match="cannot read condition: purple"):
        facts.read_facts(rows, "source_encounter_id", facts.SYSTEM_STATUS, strict=True).collect()


def test_codes_and_synonyms_ignore_case(spark):
    rows = spark.createDataFrame([(1, "HEMATOCRITE", None), (2, "cd4_Percent", "b"), (3, "hematocrit", None)], "source_encounter_id int, test string, test_other string")
    assert sorted((r.source_encounter_id, r.test) for r in facts.lab_order_facts(rows).collect()) == [(1, "HEMATOCRIT"), (2, "CD4_PERCENT"), (3, "HEMATOCRIT")]


def test_code_lists_hold_each_code_once():
    for codes in (facts.BODY_SYSTEMS, facts.CONDITIONS, facts.DURATION_UNITS, facts.INFECTIONS, facts.SYMPTOMS, facts.WHO_CRITERIA, facts.LAB_TESTS):
        assert len(codes) == len(set(codes)) and all(c == c.upper() for c in codes)


def test_infants_without_an_exam_stay(spark):
    visits = spark.createDataFrame([(1, 10, "infant_followup", date(2010, 1, 1), "u"), (2, 10, "note", date(2010, 1, 2), "u"), (3, 11, "infant_followup", None, None)],
                                   "source_encounter_id int, source_patient_id int, source_encounter_type string, encounter_date date, entered_by string")
    exams = spark.createDataFrame([(1, 77, "pcr", "neg", "alive"), (2, 78, "pcr", "neg", "alive")],
                                  "source_encounter_id int, pregnancy_id int, child_serostatus_test string, child_serostatus_result string, child_status string")
    found = sorted((r.source_patient_id, r.pregnancy_id, r.location) for r in facts.postnatal_facts(visits, exams).collect())
    assert found == [(10, 77, "Unspecified"), (11, None, "Unspecified")]


def test_lists_are_folded_in_one_shuffle(spark):
    base = spark.range(3).withColumnRenamed("id", "k")
    lists = {name: spark.range(20).select(F.when(F.col("id") % 4 < 3, F.col("id") % m).alias("k"), F.lit(None).cast("string").alias("a"), F.col("id").alias(name)) for name, m in (("x", 2), ("y", 1), ("z", 2))}
    nested = documents.nest(base, "k", lists)
    plan = nested._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Join") == 1
    found = {r.k: r for r in nested.collect()}
    assert [c.x for c in found[0].x] == [i for i in range(20) if i % 4 < 3 and i % 2 == 0]
    assert len(found[0].y) == 15 and found[1].y is None and found[2].x is None and found[2].z is None
    assert documents.nest(base, "k", {}).columns == ["k"]
