"""Nested patient and encounter documents, and the facts they are made of."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.clinical import lab_result, simple_lab_code
from chartlift.functions.numbers import height_cm, weight_kg_export
from chartlift.operators import aggregates, eav
from chartlift.operators.keys import assign_ids

PATIENT, ENCOUNTER = "source_patient_id", "source_encounter_id"


# ---- facts of a patient


def address_facts(addresses: DataFrame, localities: DataFrame) -> DataFrame:
    """Addresses with place names of the locality dictionary; ``rank_key`` sorts the current one first."""
    names = ["department", "commune", "section", "locality"]
    known = localities.select("locality_id", *[F.col(c).alias(f"_{c}") for c in names])
    current = F.when(F.col("address_type") == "current", 0).otherwise(1)
    days = F.datediff(F.lit("9999-12-31").cast("date"), F.to_date("entry_date"))
    return addresses.join(known, "locality_id", "left").select(
        PATIENT, (current * 10_000_000 + F.coalesce(days, F.lit(9_999_999))).alias("rank_key"), "entry_date", "address",
        *[F.coalesce(f"_{c}", c).alias(c) for c in names],
    )


def treatment_course_facts(courses: DataFrame) -> DataFrame:
    """One course per patient; the source holds plain duplicates."""
    return courses.select(PATIENT, F.col("patient_tx_id").alias("identifier"), "start_date", "end_date").distinct()


def allergy_facts(allergies: DataFrame) -> DataFrame:
    return allergies.select(PATIENT, F.coalesce("inn", "other_reason").alias("allergen"), "allergy_date", "type_of_reaction")


def diagnosis_facts(patient_diagnoses: DataFrame, diagnoses: DataFrame) -> DataFrame:
    names = diagnoses.select("diagnosis_id", F.col("diagnosis_eng").alias("coded"))
    return patient_diagnoses.join(names, "diagnosis_id", "left").select(
        PATIENT, "coded", F.col("diagnosis_other").alias("non_coded"), F.col("present_p").alias("present"), "diagnosis_date",
        "diagnosis_comments",
    )


def treatment_facts(exposures: DataFrame) -> DataFrame:
    return exposures.select(PATIENT, F.col("inn").alias("coded"), F.col("treatment_other").alias("non_coded"), "start_date", "end_date",
                            F.col("treatment_outcome").alias("outcome"))


def socioeconomic_facts(socio: DataFrame, extra: DataFrame) -> DataFrame:
    return socio.join(extra, PATIENT, "left")


def hiv_status_facts(status: DataFrame) -> DataFrame:
    """The status entered last for each patient."""
    columns = ["hiv_positive_p", "status_date", "test_location", "test_location_other", "entered_date"]
    return aggregates.last_wins_map(status, [PATIENT], columns, ["entered_date", "status_id"])


# ---- facts of an encounter


def responsible_person_facts(intake_extra: DataFrame) -> DataFrame:
    fields = ["responsible_first_name", "responsible_first_name2", "responsible_last_name", "responsible_dossier_id", "responsible_relation"]
    named = intake_extra.filter(F.coalesce(*fields).isNotNull())
    return named.select(
        ENCOUNTER, F.concat_ws(" ", "responsible_first_name", "responsible_first_name2").alias("first_name"),
        F.col("responsible_last_name").alias("last_name"), F.col("responsible_dossier_id").alias("dossier_id"), F.col("responsible_relation").alias("relationship"),
    )


def lab_result_facts(exam_labs: DataFrame, lab_results: DataFrame) -> DataFrame:
    """Results of exams and of the laboratory in one shape, each typed by its test."""
    exam = exam_labs.filter(F.col("result").isNotNull()).select(
        ENCOUNTER, "lab_test", F.col("test_date"), F.lit(None).cast("string").alias("sample_id"), lab_result("lab_test", "result").alias("_r")
    ).select(ENCOUNTER, "lab_test", "test_date", "sample_id", "_r.*")
    words = F.replace("value_text", F.lit(","), F.lit(""))
    typed = lab_result("lab_test", words)
    plain = F.col("value_numeric").isNotNull()
    coded = ~plain & F.col("value_boolean").isNotNull()
    from_text = ~plain & ~coded

    def only(column: str) -> Column:
        return F.when(from_text, typed[column])

    lab = lab_results.select(
        ENCOUNTER, "lab_test", "test_date", "sample_id", F.when(plain, F.col("value_numeric")).otherwise(only("numeric")).alias("numeric"),
        only("percent").alias("percent"), F.when(coded, simple_lab_code("value_boolean")).otherwise(only("coded")).alias("coded"),
        only("text").alias("text"), only("exception").alias("exception"),
    )
    return exam.unionByName(lab)


# Vital signs of documents.
VITAL_FIELDS = {
    "weight": "weight", "height": "height", "bmi": "bmi", "blood_pressure_sys": "systolic_blood_pressure",
    "blood_pressure_dias": "diastolic_blood_pressure", "heart_rate": "heart_rate", "respiration_rate": "respiration_rate",
    "temperature": "temperature",
}


def vital_facts(vitals: DataFrame, signs: Sequence[str] = tuple(VITAL_FIELDS)) -> DataFrame:
    """One column per vital sign and encounter, weights in kg by the export policy, heights in cm."""
    sign, result = F.col("sign"), F.col("result")
    value = F.when(sign == "weight", weight_kg_export("result", "result_unit")).when(sign == "height", height_cm("result")).otherwise(result)
    picked = [F.max(F.when(sign == s, value)).alias(VITAL_FIELDS[s]) for s in signs]
    return vitals.filter(result.isNotNull() & sign.isin(list(signs))).groupBy(ENCOUNTER).agg(*picked)


def user_map(users: DataFrame, parties: DataFrame, persons: DataFrame) -> DataFrame:
    """User id to e-mail, names and credentials."""
    return (
        users.join(parties, users["user_id"] == parties["party_id"]).join(persons, users["user_id"] == persons["person_id"])
        .select("user_id", "email", F.col("first_names").alias("first_name"), "last_name", "password", "salt")
    )


# ---- documents


def list_rows(lists: dict[str, DataFrame], key: str) -> dict[str, DataFrame]:
    """Each list of children as a long frame (key, position, child), for keys of any number of children."""
    return {name: aggregates.child_rows(f, [key], [c for c in f.columns if c != key]) for name, f in lists.items()}


def nest(base: DataFrame, key: str, lists: dict[str, DataFrame], scope: DataFrame | None = None) -> DataFrame:
    """Base rows, one for each key, with one sorted ``array<struct>`` per list of children (null without any).

    All lists travel as one frame, a child in the column of its list, so that one shuffle folds them and one join
    brings them to the base rows, however many lists there are. Children without a key drop out; with a ``scope`` of
    keys, those of other keys leave before they are folded.
    """
    if not lists:
        return base
    tagged = [
        frame.filter(F.col(key).isNotNull()).select(key, F.struct(*[c for c in frame.columns if c != key]).alias(name)) for name, frame in lists.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if scope is not None:
        rows = rows.join(scope, key, "left_semi")
    folded = rows.groupBy(key).agg(*[F.sort_array(F.collect_list(name)).alias(name) for name in lists])
    return base.join(folded.select(key, *[F.when(F.size(name) > 0, F.col(name)).alias(name) for name in lists]), key, "left")


@dataclass(frozen=True)
class DocumentShape:
    """What an encounter document holds: types, one-row forms, lists, vital signs, and a row filter."""

    types: tuple[str, ...]
    forms: tuple[str, ...] = ()
    lists: tuple[str, ...] = ()
    vitals: tuple[str, ...] = ()
    keep: str = "true"


_EXAM_LISTS = ("opportunistic_infections", "symptoms", "lab_orders", "generic_orders", "exam_labs")
_ALL_VITALS = tuple(VITAL_FIELDS)

# The shapes of the exported encounter documents.
DOCUMENTS = {
    "intake": DocumentShape(("intake",), ("intake_forms", "intake_extra", "exams", "exam_extra", "responsible_person"),
                            ("system_statuses", "who_criteria", *_EXAM_LISTS), _ALL_VITALS),
    "followup": DocumentShape(("followup",), ("followup_forms", "exams", "exam_extra", "responsible_person"), _EXAM_LISTS, _ALL_VITALS),
    "patient_contact": DocumentShape(("patient_contact", "anlap_vital_signs"), (), ("exam_labs",), ("weight", "height")),
    "cervical_cancer": DocumentShape(("cervical_cancer",), ("exam_extra",), ("exam_labs",)),
    "nutritional_evaluation": DocumentShape(("food_study",), (), ("exam_labs",), ("weight", "height")),
    "lab_result": DocumentShape(("lab_result", "anlap_lab_result"), (), ("labs",)),
    "food_support": DocumentShape(("food_support",), (), ("observations",)),
    "regimen_change": DocumentShape(("regime",)),
    "medication_pickup": DocumentShape(("accompagnateur",)),
    "note": DocumentShape(("note",), keep="note_title IS NULL OR note_title <> 'Uploaded from'"),
    "pregnancy_entry": DocumentShape(("pregnancy",), ("exam_extra",)),
    "postnatal": DocumentShape(("infant_followup",), ("pregnancy_exam",)),
}


def encounter_documents(
    kind: str, encounters: DataFrame, sources: dict[str, DataFrame], observations: DataFrame | None = None,
    properties: dict[str, Sequence[str] | str] | None = None,
) -> DataFrame:
    """Documents of one kind of encounter: its forms side by side, its lists nested, its named observations
    as columns. ``sources`` maps the names of the shape to frames keyed by ``source_encounter_id``; one that
    is not given is left out."""
    shape = DOCUMENTS[kind]
    rows = encounters.filter(F.col("source_encounter_type").isin(list(shape.types))).filter(shape.keep)
    scope = rows.select(ENCOUNTER)
    for name in shape.forms:
        if name in sources:
            form = sources[name]
            one = aggregates.pick_per_key(form, [ENCOUNTER], [c for c in form.columns if c != ENCOUNTER], [c for c in form.columns if c != ENCOUNTER])
            rows = rows.join(one, ENCOUNTER, "left")
    if shape.vitals and "vitals" in sources:
        rows = rows.join(vital_facts(sources["vitals"], shape.vitals), ENCOUNTER, "left")
    if observations is not None and properties:
        named = observations.join(scope, ENCOUNTER, "left_semi")
        rows = rows.join(eav.eav_pivot(named, [ENCOUNTER], "observation", "value", properties), ENCOUNTER, "left")
    return nest(rows, ENCOUNTER, {name: sources[name] for name in shape.lists if name in sources}, scope)


def patient_documents(patients: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """Patients with all their encounter documents and facts as nested lists."""
    return nest(patients, PATIENT, lists)


# ---- misfiled lab results

# Encounter types that should hold no exam lab results.
NO_LAB_TYPES = ["regime", "food_support", "note", "accompagnateur"]


def misfiled_labs(exam_labs: DataFrame, encounters: DataFrame, start: int) -> tuple[DataFrame, DataFrame]:
    """New lab encounters for results filed under the wrong type, and those results moved to them.

    Each wrong encounter gets one new encounter, numbered from ``start`` in the order of the old ids.
    """
    wrong = encounters.filter(F.col("source_encounter_type").isin(NO_LAB_TYPES)).join(
        exam_labs.select(ENCOUNTER).distinct(), ENCOUNTER, "left_semi"
    ).select(ENCOUNTER, PATIENT, "encounter_date", "date_created")
    fresh = assign_ids(wrong, [ENCOUNTER], "new_encounter_id", start).withColumn("source_encounter_type", F.lit("lab_result"))
    moved = exam_labs.join(fresh.select(ENCOUNTER, "new_encounter_id"), ENCOUNTER)
    return fresh, moved
