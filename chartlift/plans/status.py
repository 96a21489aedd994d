"""Status at intake (HIV, TB) and programme enrolments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.functions import dates
from chartlift.functions.dates import as_of_column
from chartlift.operators import aggregates, eav, filters, quality
from chartlift.operators.joins import attach

# Place of testing.
TEST_LOCATIONS = {
    "vct_clinic": "CIEL:159940",
    "womens_health_clinic": "CIEL:159937",
    "primary_care_clinic": "CIEL:160542",
    "mobile_clinic": "CIEL:159939",
    "family_planning_clinic": "LOCAL:2714",
    "maternity_ward": "LOCAL:2235",
    "surgical_ward": "LOCAL:6298",
    "medicine_ward": "LOCAL:7891",
    "pediatric_ward": "LOCAL:2717",
}

# Encounters whose TB status overrides the one derived for the intake.
TB_OVERRIDES = [277018, 277029, 287844, 341199]

# Programme outcome and treatment state of each treatment status (others have none).
OUTCOMES = {
    "died": "LOCAL:PATIENT DIED",
    "transferred_out": "3c392f4d-9fdd-44ad-99db-d2bad176f974",
    "moved_in_haiti_txfer_conf": "8c1b5627-5f93-4879-83e9-b591aa398148",
    "moved_in_haiti_txfer_not_conf": "0ca1975b-d6cf-4ef3-8038-3aa5c4e3178a",
    "moved_out_haiti_txfer_conf": "c62ae7ac-e0de-42e6-a1d6-0a415e0ffdaa",
    "moved_out_haiti_txfer_not_conf": "7c8aaf44-890b-43af-8e0e-776aef082998",
    "prev_undoc_txfer_conf": "3c392f4d-9fdd-44ad-99db-d2bad176f974",
    "prev_undoc_txfer_not_conf": "3c392f4d-9fdd-44ad-99db-d2bad176f974",
}
TRANSFER_OUTCOME = "3c392f4d-9fdd-44ad-99db-d2bad176f974"
TREATMENT_STATES = {
    "abandoned": "LOCAL:LOST TO FOLLOWUP",
    "lost": "LOCAL:LOST TO FOLLOWUP",
    "treatment_refused": "LOCAL:TREATMENT NEVER STARTED - PATIENT REFUSED",
    "treatment_stopped_other": "LOCAL:Other treatment stopped",
    "treatment_stopped_side_effects": "LOCAL:TREATMENT STOPPED - SIDE EFFECTS",
    "refused_return_to_treatment": "LOCAL:TREATMENT NEVER STARTED - PATIENT REFUSED",
    "traced_not_found": "LOCAL:LOST TO FOLLOWUP",
}
VISIT_TYPES = ["intake", "followup", "patient_contact", "accompagnateur"]


def _intakes(encounters: DataFrame) -> DataFrame:
    return encounters.filter("source_encounter_type = 'intake'").select(
        "source_patient_id", "source_encounter_id", F.to_date("encounter_date").alias("intake_date")
    )


def _linked(status: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """The last entered status row of each encounter that has one."""
    rows = aggregates.last_wins_map(
        status.filter(F.col("source_encounter_id").isNotNull()), ["source_encounter_id"], columns, order
    )
    return rows.select("source_encounter_id", F.lit(True).alias("_on_encounter"), *[F.col(c).alias(f"_l_{c}") for c in columns])


def hiv_status_at_intake(encounters: DataFrame, status: DataFrame) -> DataFrame:
    """One row per intake: the status row linked to it, else the best one known by then.

    An unlinked intake takes the earliest positive date not after it, else the earliest negative, else the
    earliest unknown one; its test place is that of the patient's last entered unlinked row with a place.
    """
    columns = ["status_date", "hiv_positive_p", "test_location", "test_location_other"]
    order = ["entered_date", "status_id"]
    linked = _linked(status, columns, order)
    when = F.to_date(F.coalesce("status_date", "entered_date"))
    signs = {"t": "_t", "f": "_f", "?": "_u"}
    first = status.groupBy("source_patient_id").agg(
        *[F.min(F.when(F.col("hiv_positive_p") == sign, when)).alias(alias) for sign, alias in signs.items()]
    )
    placed = status.filter(
        F.col("source_encounter_id").isNull() & (F.col("test_location").isNotNull() | F.col("test_location_other").isNotNull())
    )
    place = aggregates.last_wins_map(placed, ["source_patient_id"], ["test_location", "test_location_other"], order).select(
        "source_patient_id", F.col("test_location").alias("_place"), F.col("test_location_other").alias("_place_other")
    )
    joined = _intakes(encounters).join(linked, "source_encounter_id", "left")
    for side in (first, place):
        joined = attach(joined, side, ["source_patient_id"], "left")
    best = F.coalesce(*[
        F.when(F.col(alias) <= F.col("intake_date"), F.struct(F.lit(sign).alias("sign"), F.col(alias).alias("at")))
        for sign, alias in signs.items()
    ])
    on_encounter = F.coalesce("_on_encounter", F.lit(False))

    def choose(linked_column, derived):
        return F.when(on_encounter, F.col(linked_column)).otherwise(derived)

    return joined.select(
        "source_patient_id", "source_encounter_id", "intake_date", on_encounter.alias("status_on_encounter"),
        choose("_l_hiv_positive_p", best["sign"]).alias("hiv_positive_p"),
        F.to_date(choose("_l_status_date", best["at"])).alias("status_date"),
        choose("_l_test_location", F.col("_place")).alias("test_location"),
        choose("_l_test_location_other", F.col("_place_other")).alias("test_location_other"),
    )


def hiv_status_obs(intake_status: DataFrame) -> DataFrame:
    """Date, result and place of the test."""
    result = filters.case_map("hiv_positive_p", {"t": "CIEL:703", "f": "CIEL:664", "?": "CIEL:1138"})
    other = (F.col("test_location") == "other") | F.col("test_location_other").isNotNull()
    return eav.emit(intake_status, "hiv_status", ["source_encounter_id"], "source_encounter_id", [
        eav.datetime("CIEL:164400", "status_date"),
        eav.coded("CIEL:1169", result),
        eav.coded("CIEL:159936", filters.case_map("test_location", TEST_LOCATIONS)),
        eav.coded("CIEL:159936", "CIEL:5622", when=other, comments=F.col("test_location_other")),
    ])


TB_FLAGS = ["ppd_positive_p", "tb_active_p", "extrapulmonary_p", "pulmonary_p", "drug_resistant_p"]


def tb_status_at_intake(encounters: DataFrame, status: DataFrame, overrides: list[int] | None = None) -> DataFrame:
    """One row per intake: the linked TB status, else the patient's unlinked rows folded together (first
    date, any-true flags, comments joined); named encounters override date and two flags."""
    linked = _linked(status, ["status_date", *TB_FLAGS, "drug_resistant_comment"], ["entered_date", "status_id"])
    unlinked = status.filter(F.col("source_encounter_id").isNull())
    folded = unlinked.groupBy("source_patient_id").agg(
        F.min("status_date").alias("_d"), F.lit(True).alias("_folded"),
        *[F.when(aggregates.any_true(F.col(flag) == "t"), "t").otherwise("f").alias(f"_a_{flag}") for flag in TB_FLAGS],
    )
    comments = aggregates.string_agg(unlinked, ["source_patient_id"], "drug_resistant_comment", "_comment", " , ")
    named = status.filter(F.col("source_encounter_id").isin(TB_OVERRIDES if overrides is None else overrides))
    override = aggregates.last_wins_map(
        named, ["source_patient_id"], ["status_date", "extrapulmonary_p", "drug_resistant_p"], ["entered_date", "status_id"]
    ).select("source_patient_id", F.lit(True).alias("_over"), F.col("status_date").alias("_o_status_date"),
             F.col("extrapulmonary_p").alias("_o_extrapulmonary_p"), F.col("drug_resistant_p").alias("_o_drug_resistant_p"))
    joined = _intakes(encounters).join(linked, "source_encounter_id", "left")
    for side in (folded, comments, override):
        joined = attach(joined, side, ["source_patient_id"], "left")
    on_encounter = F.coalesce("_on_encounter", F.lit(False))

    def choose(column: str, derived):
        base = F.when(on_encounter, F.col(f"_l_{column}")).otherwise(derived)
        if f"_o_{column}" not in joined.columns:
            return base.alias(column)
        return F.when(F.col("_over"), F.col(f"_o_{column}")).otherwise(base).alias(column)

    return joined.select(
        "source_patient_id", "source_encounter_id", "intake_date", on_encounter.alias("status_on_encounter"),
        choose("status_date", F.col("_d")), *[choose(flag, F.col(f"_a_{flag}")) for flag in TB_FLAGS],
        choose("drug_resistant_comment", F.col("_comment")),
    )


def tb_status_obs(intake_status: DataFrame) -> DataFrame:
    """Date, flags that are true, and the resistance comment."""

    def true(flag):
        return F.col(flag) == "t"

    comment = F.when(F.col("drug_resistant_comment") != "", F.col("drug_resistant_comment"))
    return eav.emit(intake_status, "tb_status", ["source_encounter_id"], "source_encounter_id", [
        eav.datetime("LOCAL:11526", "status_date"),
        eav.coded("CIEL:1389", "CIEL:1065", when=true("tb_active_p")),
        eav.coded("CIEL:160040", "CIEL:42", when=true("pulmonary_p")),
        eav.coded("CIEL:160040", "CIEL:5042", when=true("extrapulmonary_p")),
        eav.coded("LOCAL:3039", "CIEL:1065", when=true("drug_resistant_p")),
        eav.text("CIEL:159391", comment),
        eav.coded("LOCAL:1435", "CIEL:703", when=true("ppd_positive_p")),
    ])


def tb_screening_obs(encounters: DataFrame, status: DataFrame) -> DataFrame:
    """Screening results of follow-up forms of version 3, dated by the status."""
    followups = encounters.filter("source_encounter_type = 'followup' AND form_version = '3'").select("source_encounter_id")
    rows = status.join(followups, "source_encounter_id").filter(F.col("tb_active_p").isNotNull())
    result = filters.case_map("tb_active_p", {"t": "CIEL:703", "f": "CIEL:664"})
    return eav.emit(rows, "tb_screening", ["status_id"], "source_encounter_id",
                    [eav.coded("CIEL:160108", result, at=F.col("status_date"), keep_null=True)])


# ---- programmes


def stage_programs(demographics: DataFrame, encounters: DataFrame, art_starts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Patients with a qualifying visit, with first and last visit, ART start and regimen outcome."""
    visits = encounters.filter(F.col("source_encounter_type").isin(VISIT_TYPES) & F.col("encounter_date").isNotNull()).groupBy(
        "source_patient_id"
    ).agg(F.min(F.to_date("encounter_date")).alias("min_visit_date"), F.max(F.to_date("encounter_date")).alias("max_visit_date"))
    return (
        demographics.join(visits, "source_patient_id")
        .join(art_starts.select("source_patient_id", "art_start_date"), "source_patient_id", "left")
        .join(outcomes.select("source_patient_id", "regimen_outcome_date"), "source_patient_id", "left")
    )


def program_raw(staged: DataFrame, as_of) -> DataFrame:
    """Enrolment, outcome and treatment state of each patient before the split at a transfer."""
    today = as_of_column(as_of)
    status_date = F.to_date("treatment_status_date")
    regimen_date = F.to_date("regimen_outcome_date")
    chosen = F.when(status_date.isNull() | (regimen_date > status_date), regimen_date).otherwise(status_date)
    ended = F.least(F.coalesce(chosen, F.add_months("max_visit_date", 6)), today)
    outcome = filters.case_map("treatment_status", OUTCOMES)
    rows = staged.withColumns({
        "enrollment_date": F.least("min_visit_date", F.to_date("art_start_date")),
        "outcome": outcome,
        "treatment_state": filters.case_map("treatment_status", TREATMENT_STATES),
        "state_start_date": ended,
        "outcome_date": F.when(outcome.isNotNull(), ended),
        "_here": filters.null_if_in("health_center", [0, 42]),
        "_start": filters.null_if_in("starting_health_center", [0, 42]),
    })
    transfer = F.to_date("health_center_transfer_date")
    center = F.coalesce("_here", "_start", F.lit(1))
    superfluous = (
        F.coalesce(F.col("_start") == center, F.lit(False)) | transfer.isNull()
        | F.coalesce(transfer > F.col("outcome_date"), F.lit(False))
        | F.coalesce(transfer < F.col("enrollment_date"), F.lit(False))
    )
    return rows.withColumns({
        "health_center": center,
        "starting_health_center": F.when(~superfluous, F.col("_start")),
        "transfer_date": transfer,
    }).drop("_here", "_start")


def enrolments(raw: DataFrame, patients: DataFrame) -> DataFrame:
    """One or two enrolments per patient; one that would end before it starts is moved back."""
    split = F.col("starting_health_center").isNotNull()
    patient = F.col("source_patient_id")
    art, transfer = F.to_date("art_start_date"), F.col("transfer_date")

    def variant(part, site, start, art_start, end, state_start, outcome, state):
        return {"source_patient_id": patient, "part": F.lit(part), "site": site, "date_enrolled": start,
                "art_start_date": art_start, "date_completed": end, "state_start_date": state_start,
                "outcome": outcome, "treatment_state": state}

    current = (F.col("outcome_date"), F.col("state_start_date"), F.col("outcome"), F.col("treatment_state"))
    nothing_date, nothing_text = F.lit(None).cast("date"), F.lit(None).cast("string")
    rows = eav.split_rows(raw, [
        (~split, variant("single", F.col("health_center"), F.col("enrollment_date"), art, *current)),
        (split, variant("initial", F.col("starting_health_center"), F.col("enrollment_date"), F.when(art < transfer, art),
                        transfer, nothing_date, F.lit(TRANSFER_OUTCOME), nothing_text)),
        (split, variant("current", F.col("health_center"), transfer, art, *current)),
    ])
    created = patients.select("source_patient_id", "person_id", F.to_date("patient_created_date").alias("_created"))
    joined = rows.join(created, "source_patient_id")
    ended_first = F.col("date_completed") < F.col("date_enrolled")
    moved = F.when(F.col("_created") < F.col("date_completed"), F.col("_created")).otherwise(F.col("date_completed"))
    return joined.withColumns({
        "moved_back": F.coalesce(ended_first, F.lit(False)), "original_start": F.col("date_enrolled"),
        "created_before_end": F.col("_created") < F.col("date_completed"),
        "date_enrolled": F.when(ended_first, moved).otherwise(F.col("date_enrolled")),
    }).drop("_created")


def program_states(enrolled: DataFrame) -> DataFrame:
    """A state row for each enrolment with a treatment state."""
    return enrolled.filter(F.col("treatment_state").isNotNull()).select(
        "person_id", "part", F.col("treatment_state").alias("state"), F.col("state_start_date").alias("start_date")
    )


def program_warnings(raw: DataFrame, enrolled: DataFrame, patients: DataFrame) -> DataFrame:
    """ART start after the outcome; enrolment after completion, with what was done about it."""
    rows = raw.join(patients.select("source_patient_id", "person_id"), "source_patient_id")
    late = F.to_date("art_start_date") > F.col("outcome_date")
    moved = enrolled.filter("moved_back").groupBy("person_id").agg(
        F.min(F.struct("original_start", "created_before_end")).alias("_m")
    )
    action = F.when(F.col("_m.created_before_end"), "Setting enrollment date to patient_created_date").otherwise(
        "Setting enrollment date to  completion date"
    )
    return quality.all_warnings(
        quality.warn(rows, "Patient has ART start date(s) after patient outcome date", patient="person_id", field="art_start_date",
                     value=dates.day_text("art_start_date"),
                     details=F.concat(F.lit("Outcome date: "), dates.day_text("outcome_date")), when=late),
        quality.warn(moved, "Patient has program enrollment date after program completion date", patient="person_id",
                     field="enrollment_date", value=F.col("_m.original_start").cast("string"), details=action),
    )
