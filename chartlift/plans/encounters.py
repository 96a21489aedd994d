"""Encounters, notes, visits, unknown locations and duplicate encounters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.functions import dates
from chartlift.functions.dates import as_of_column
from chartlift.functions.ids import uuid_name
from chartlift.operators import aggregates, eav, filters, joins, quality
from chartlift.runtime import settle
from chartlift.sources.readers import stage_table

UNKNOWN_LOCATION = 1

# Target type of each migrated source encounter type.
ENCOUNTER_TYPES = {
    "intake": "HIV Intake",
    "followup": "HIV Followup",
    "lab_result": "Laboratory Results",
    "anlap_lab_result": "Laboratory Results",
    "accompagnateur": "HIV drug dispensing",
    "regime": "Drug Order Documentation",
}

# Form uuid of a source type, and of its version where it has several.
VERSIONED_FORMS = {
    "intake/1": "29a109f6-6dd3-4e98-af88-134cf7e7da1b",
    "intake/2": "12f9aebe-0882-4211-a61e-006e4c7a5a96",
    "intake/3": "53725d05-99c1-4fad-be82-c1ca60a8dd9b",
    "followup/1": "9c180d22-7ef6-49e4-8e52-ff314e218451",
    "followup/2": "60efebcc-a4ff-4459-9754-1eaeafc4dc24",
    "followup/3": "d2cee145-0b53-4588-9836-dadafa122a8e",
}
FORMS = {
    "lab_result": "4d778ef4-0620-11e5-a6c0-1697f925ec7b",
    "anlap_lab_result": "4d778ef4-0620-11e5-a6c0-1697f925ec7b",
    "accompagnateur": "c3af594f-fd77-44b2-b3a0-44d4f3c7cc3a",
    "regime": "96482a6e-5b62-11eb-8f5a-0242ac110002",
}

# Source tables that are staged as they are.
STAGED_TABLES = [
    "HIV_LAB_TRACKING", "HIV_PCR_TRACKING", "HIV_INTAKE_FORMS", "HIV_FOLLOWUP_FORMS", "HIV_DIAGNOSES",
    "HIV_PATIENT_DIAGNOSES", "HIV_INTAKE_EXTRA", "HIV_PREVIOUS_EXPOSURES", "HIV_DATA_AUDIT", "HIV_DATA_AUDIT_ENTRY",
    "HIV_DATA_AUDIT_TRACKING_FORMS", "HIV_PATIENT_OBS", "HIV_COURSE_OF_TX", "HIV_SOCIAL_SUPPORT", "HIV_SOCIOECONOMICS",
    "HIV_SOCIOECONOMICS_EXTRA", "HIV_DEMOGRAPHICS_AUD", "HIV_CONTACTS", "HIV_ORDERED_OTHER", "HIV_ENCOUNTERS_AUD",
    "HIV_PREGNANCY", "HIV_PREGNANCY_EXAM",
]

EARLIEST_DATE = "1990-01-01"


# ---- staging


def stage_all(tables: dict[str, DataFrame], scope: DataFrame, encounters: DataFrame) -> dict[str, DataFrame]:
    """Every given source table staged and scoped, under its name without prefix in lower case."""
    return {
        name.removeprefix("HIV_").lower(): stage_table(table, scope, encounters) for name, table in tables.items()
    }


def load_observations(observations: DataFrame, encounters: DataFrame, scope: DataFrame) -> DataFrame:
    """The raw named observations of encounters in scope."""
    in_scope = encounters.join(scope.select("source_patient_id"), "source_patient_id", "left_semi")
    return observations.join(in_scope.select("source_encounter_id"), "source_encounter_id", "left_semi")


# ---- encounters


def stage_encounters(raw: DataFrame, intake_forms: DataFrame, followup_forms: DataFrame, sites: DataFrame) -> DataFrame:
    """Encounters with form version, target type, form and location."""
    versions = [
        forms.groupBy("source_encounter_id").agg(F.min("form_version").alias(f"_v{i}"))
        for i, forms in enumerate((intake_forms, followup_forms))
    ]
    joined = raw
    for version in versions:
        joined = joined.join(version, "source_encounter_id", "left")
    joined = joined.withColumn("form_version", F.coalesce("_v0", "_v1", F.lit("1"))).drop("_v0", "_v1")
    kind = F.col("source_encounter_type")
    form = F.coalesce(
        filters.case_map(F.concat_ws("/", kind, "form_version"), VERSIONED_FORMS), filters.case_map(kind, FORMS)
    )
    located = joined.join(sites.select(F.col("site").alias("source_location_id"), "location_id"), "source_location_id", "left")
    return located.withColumns({
        "encounter_type": filters.case_map(kind, ENCOUNTER_TYPES), "form_uuid": form,
        "encounter_uuid": uuid_name("encounter", "source_encounter_id"),
    })


def encounters(staged: DataFrame, patients: DataFrame, user_ids: DataFrame) -> DataFrame:
    """Target encounters of the migrated types; a missing date is the day of entry."""
    creators = user_ids.select(F.col("source_user_id").alias("source_creator_id"), "user_id")
    return (
        staged.filter(F.col("encounter_type").isNotNull())
        .join(patients.select("source_patient_id", F.col("person_id").alias("patient_id")), "source_patient_id")
        .join(creators, "source_creator_id", "left")
        .select(
            "source_encounter_id", F.col("encounter_uuid").alias("uuid"), "patient_id", "encounter_type", "form_uuid",
            F.coalesce(F.to_date("encounter_date"), F.to_date("date_created")).alias("encounter_datetime"),
            "date_created", F.coalesce("user_id", F.lit(1)).alias("creator"),
            F.coalesce("location_id", F.lit(UNKNOWN_LOCATION)).alias("location_id"),
        )
    )


def encounter_warnings(staged: DataFrame, patients: DataFrame, as_of) -> DataFrame:
    """Odd, future and missing dates, repeated encounters of a day, several intakes."""
    rows = staged.join(patients.select("source_patient_id", "person_id"), "source_patient_id")
    day, today = F.to_date("encounter_date"), as_of_column(as_of)
    horizon = F.add_months(today, 60)
    source_type = F.concat(F.lit("Source encounter_type :"), F.col("source_encounter_type"))
    about = {"patient": "person_id", "encounter": "source_encounter_id"}
    day_value = dates.day_text("encounter_date")
    repeated = (
        rows.filter(F.col("source_encounter_type").isin("intake", "followup"))
        .groupBy("person_id", "source_encounter_type", day.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("source_encounter_id").alias("first_id"))
        .filter("n > 1")
    )
    intakes = rows.filter("source_encounter_type = 'intake'").withColumn("day", day_value)
    several = intakes.groupBy("person_id").agg(F.countDistinct("source_encounter_id").alias("n")).filter("n > 1")
    listed = (
        joins.attach(intakes, several.select("person_id"), ["person_id"])
        .groupBy("person_id")
        .agg(F.array_sort(F.collect_list(F.struct("source_encounter_id", "day"))).alias("rows"))
    )
    ids = F.array_join(F.transform("rows", lambda r: r["source_encounter_id"].cast("string")), ",")
    days = F.array_join(F.filter(F.transform("rows", lambda r: r["day"]), lambda d: d.isNotNull()), ",")
    return quality.all_warnings(
        quality.warn(rows, "Encounter with nonsensical date", date=day, field="encounter_date", value=day_value,
                     details=source_type, when=(day < F.lit(EARLIEST_DATE).cast("date")) | (day > horizon), **about),
        quality.warn(rows, "Encounter in the future", date=day, field="encounter_date", value=day_value,
                     details=source_type, when=(day > today) & (day < horizon), **about),
        quality.warn(repeated, "Multiple encounters with same type for same patient on same day", patient="person_id",
                     encounter="first_id", date="day", field="duplicate count", value=F.col("n").cast("string"),
                     details=F.concat(F.lit("source encounter type: "), "source_encounter_type"), flag=False),
        quality.warn(rows, "Encounter date is null. `date_created` used as encounter date.", field="encounter_date",
                     details=source_type, when=day.isNull(), **about),
        quality.warn(listed, "Patient has multiple intake encounters", patient="person_id",
                     details=F.concat(F.lit("Encounter IDs: "), ids, F.lit(". Dates: "), days)),
    )


def notes(staged: DataFrame) -> DataFrame:
    """Title and comments of note encounters as one text observation."""
    title, body = F.col("note_title"), F.col("comments")
    both = F.coalesce(F.concat(title, F.lit("\n\n"), body), title, body)
    return eav.emit(staged.filter("source_encounter_type = 'note'"), "note", ["source_encounter_id"], "source_encounter_id",
                    [eav.text("LOCAL:CLINICAL IMPRESSION COMMENTS", both)])


# ---- visits


def visits(
    encounters: DataFrame,
    excluded_types: tuple[str, ...] = ("registration", "drug order", "comment"),
    unknown: str | int = UNKNOWN_LOCATION,
    unlinked_types: tuple[str, ...] = ("registration", "drug order"),
) -> DataFrame:
    """One visit per patient and day: from the first encounter to the end of the last one's day.

    ``encounters``: patient_id, encounter_datetime, encounter_type, location_id and, where some already have a
    visit, visit_id; those are left alone. Types in ``excluded_types`` start no visit and do not stretch one, but all
    that are linked to it (not ``unlinked_types``) vote on its place: the most frequent known one, the greater on a
    tie. A patient's day is folded by counts, so even a day with very many encounters never meets in one task.
    """
    day = F.to_date("encounter_datetime").alias("day")
    free = encounters.filter(F.col("visit_id").isNull()) if "visit_id" in encounters.columns else encounters
    voters = free.filter(~F.col("encounter_type").isin(list(unlinked_types)))
    own = F.when(~F.col("encounter_type").isin(list(excluded_types)), F.col("encounter_datetime"))
    per_place = voters.groupBy("patient_id", day, "location_id").agg(
        F.min(own).alias("_first"), F.max(own).alias("_last"), F.count(own).alias("_own"), F.count(F.lit(1)).alias("_n")
    )
    ranked = F.when(F.col("location_id") != F.lit(unknown), F.struct("_n", "location_id"))
    return per_place.groupBy("patient_id", "day").agg(
        F.min("_first").alias("date_started"),
        dates.end_of_day(F.max("_last")).alias("date_stopped"),
        F.coalesce(F.max(ranked)["location_id"], F.lit(unknown)).alias("location_id"),
        F.sum("_own").alias("encounters"),
    ).filter("encounters > 0")


def locate_by_visit(
    encounters: DataFrame, visit_rows: DataFrame, unlinked_types: tuple[str, ...] = ("registration", "drug order"),
    unknown: str | int = UNKNOWN_LOCATION,
) -> DataFrame:
    """Encounters with the day's visit; one at an unknown place takes the visit's known place."""
    places = visit_rows.select("patient_id", "day", F.col("location_id").alias("visit_location_id"))
    linked = joins.attach(encounters.withColumn("day", F.to_date("encounter_datetime")), places, ["patient_id", "day"], "left")
    visit_place = F.when(~F.col("encounter_type").isin(list(unlinked_types)), F.col("visit_location_id"))
    is_unknown = F.col("location_id") == F.lit(unknown)
    return linked.withColumns({
        "visit_location_id": visit_place,
        "location_id": F.when(is_unknown & visit_place.isNotNull(), visit_place).otherwise(F.col("location_id")),
    })


def visits_before_birth(visit_rows: DataFrame, persons: DataFrame, as_of) -> DataFrame:
    """Visits that start before the birth date; an estimated one is relaxed by half the age."""
    rows = visit_rows.join(
        persons.select(F.col("person_id").alias("patient_id"), "birthdate", "birthdate_estimated", "death_date"), "patient_id"
    )
    start = F.to_date("date_started")
    estimated = F.col("birthdate_estimated") == 1
    born = F.when(estimated, dates.relaxed_birthdate("birthdate", "death_date", as_of)).otherwise(F.to_date("birthdate"))
    details = F.concat(F.lit("Birthdate: "), dates.day_text("birthdate"), F.lit(", estimated: "),
                       F.col("birthdate_estimated").cast("string"))
    return quality.warn(rows, "Visit start date prior to birthdate", patient="patient_id", field="date_started",
                        value=dates.day_text("date_started"), details=details, when=born > start)


# ---- unknown locations


def resolve_unknown_locations(
    encounters: DataFrame, enrolments: DataFrame, patient_sites: DataFrame, unknown: int = UNKNOWN_LOCATION,
    bucket_days: int = 30,
) -> DataFrame:
    """Place of encounters at an unknown location: the active enrolment, else the latest one completed
    before, else the earliest one started after, else the patient's site, else still unknown.

    Returns all encounters with ``location_id`` and ``resolved_by``. The lookups do not wait for one another:
    they run side by side on the encounters at an unknown place, as segmented scans, and the first level that
    knows a place decides.
    """
    open_ones = encounters.filter(F.col("location_id") == F.lit(unknown)).select("encounter_id", "patient_id", "encounter_datetime")
    enrolled = enrolments.filter(F.col("location_id").isNotNull())
    active = joins.active_state(
        open_ones, enrolled, "patient_id", "encounter_id", "encounter_datetime", "date_enrolled", "date_completed",
        "location_id", bucket_days=bucket_days,
    ).withColumnRenamed("location_id", "_active")

    def nearest(state_time: str, direction: str, alias: str) -> DataFrame:
        found = joins.asof_join(open_ones, enrolled, "patient_id", "encounter_datetime", state_time, ["location_id"], direction)
        return found.filter("location_id IS NOT NULL").select("encounter_id", F.col("location_id").alias(alias))

    before = nearest("date_completed", "backward", "_before")
    after = nearest("date_enrolled", "forward", "_after")
    site = patient_sites.groupBy("patient_id").agg(F.min("location_id").alias("_site"))
    joined = encounters.join(active, "encounter_id", "left").join(before, "encounter_id", "left").join(after, "encounter_id", "left")
    joined = joins.attach(joined, site, ["patient_id"], "left")
    is_unknown = F.col("location_id") == F.lit(unknown)
    steps = [("_active", "current enrolment"), ("_before", "previous enrolment"), ("_after", "next enrolment"),
             ("_site", "patient site")]
    place = F.coalesce(*[F.col(c) for c, _ in steps], F.lit(unknown))
    reason = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(name)) for c, name in steps], F.lit("unknown"))
    return joined.select(
        *[F.when(is_unknown, place).otherwise(F.col(c)).alias(c) if c == "location_id" else F.col(c) for c in encounters.columns],
        F.when(is_unknown, reason).alias("resolved_by"),
    )


# Texts of the location warnings.
LOCATION_CHANGES = {
    "current enrolment": "Encounter location changed from Unknown to location of Current Program Enrollment",
    "previous enrolment": "Encounter location changed from Unknown to location of Most Recent Previous Program Enrollment",
    "next enrolment": "Encounter location changed from Unknown to location of Most Recent Subsequent Program Enrollment",
    "patient site": "Encounter location changed from Unknown to overall Health Center",
}
STILL_UNKNOWN = "Unable to determine encounter location; set as unknown"
TWO_PLACES = "Patient has encounters at different locations on same day"


def location_warnings(resolved: DataFrame) -> DataFrame:
    """A note for each changed location, a flag for each that stays unknown."""
    about = {"patient": "patient_id", "encounter": "encounter_id", "date": F.to_date("encounter_datetime")}
    changed = resolved.filter(F.col("resolved_by").isNotNull() & (F.col("resolved_by") != "unknown"))
    details = F.concat(F.lit("Updated to location :"), F.col("location_id").cast("string"))
    return quality.all_warnings(
        quality.warn(changed, filters.case_map("resolved_by", LOCATION_CHANGES), details=details, flag=False, **about),
        quality.warn(resolved.filter("resolved_by = 'unknown'"), STILL_UNKNOWN, **about),
    )


def relocate_visits(visit_rows: DataFrame, resolved: DataFrame, unknown: int = UNKNOWN_LOCATION) -> DataFrame:
    """Visits still at an unknown place take the greatest known place of their encounters."""
    known = resolved.filter(F.col("location_id") != F.lit(unknown)).groupBy(
        "patient_id", F.to_date("encounter_datetime").alias("day")
    ).agg(F.max("location_id").alias("_known"))
    joined = visit_rows.join(known, ["patient_id", "day"], "left")
    place = F.when(F.col("location_id") == F.lit(unknown), F.coalesce("_known", "location_id")).otherwise(F.col("location_id"))
    return joined.withColumn("location_id", place).drop("_known")


def visits_at_two_places(linked: DataFrame, location_names: DataFrame, unknown: int = UNKNOWN_LOCATION) -> DataFrame:
    """Encounters whose known place differs from the known place of their visit."""
    differ = linked.filter(
        (F.col("location_id") != F.col("visit_location_id")) & (F.col("location_id") != F.lit(unknown))
        & (F.col("visit_location_id") != F.lit(unknown))
    )
    here = location_names.select("location_id", F.col("name").alias("_here"))
    there = location_names.select(F.col("location_id").alias("visit_location_id"), F.col("name").alias("_there"))
    named = differ.join(here, "location_id").join(there, "visit_location_id")
    return quality.warn(named, TWO_PLACES, patient="patient_id", encounter="encounter_id", date=F.to_date("encounter_datetime"),
                        field="encounter_location", value=F.concat_ws(", ", "_here", "_there"))


# ---- duplicate encounters


def void_duplicates(
    encounters: DataFrame, obs: DataFrame, value_columns: list[str], excluded_types: tuple[str, ...] = ("drug order",)
) -> DataFrame:
    """Encounters to drop because another of the same patient, day and type says all they say.

    ``encounters``: encounter_id, patient_id, encounter_datetime, encounter_type. ``obs``: encounter_id,
    concept_id and the value columns; null equals null. Of exact copies the highest id stays; a proper
    subset always goes. Returns encounter_id and reason.

    No pairs are built inside a group. Equal contents meet by a fingerprint of the distinct observations
    (count, and two independent hash sums), which combines before the shuffle. For subsets, one encounter
    stands for each content, and it is probed only against contents that hold its rarest observation.
    """
    group = ["patient_id", "day", "encounter_type"]
    eligible = encounters.filter(~F.col("encounter_type").isin(list(excluded_types))).select(
        "encounter_id", "patient_id", F.to_date("encounter_datetime").alias("day"), "encounter_type"
    )
    crowded = eligible.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    members = joins.attach(eligible, crowded.select(*group), group)

    # a hash passes over nulls, so each value goes with a mark that tells whether it is there
    cells = [part for c in ("concept_id", *value_columns) for part in (F.col(c).isNull(), F.col(c))]
    hashed = obs.select("encounter_id", F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit(42), *cells).alias("_h2"))
    # read five times below, so it is written once
    facts = settle(joins.attach(hashed, members.select("encounter_id"), ["encounter_id"], "left_semi").distinct())
    prints = facts.groupBy("encounter_id").agg(
        F.count(F.lit(1)).alias("_size"),
        F.sum(F.col("_h1").cast("decimal(38,0)")).alias("_s1"), F.sum(F.col("_h2").cast("decimal(38,0)")).alias("_s2"),
    )
    content = ["_size", "_s1", "_s2"]
    zero = F.lit(0).cast("decimal(38,0)")
    profiled = settle(members.join(prints, "encounter_id", "left").withColumns({
        "_size": F.coalesce("_size", F.lit(0)), "_s1": F.coalesce("_s1", zero), "_s2": F.coalesce("_s2", zero),
    }))
    contents = profiled.groupBy(*group, *content).agg(F.max("encounter_id").alias("_keeper"))
    holders = joins.attach(profiled, contents, [*group, *content])

    several = contents.groupBy(*group).agg(F.count(F.lit(1)).alias("_contents")).filter("_contents > 1")
    rivals = joins.attach(contents, several, group).select(*group, "_size", "_keeper")
    keeper_facts = settle(facts.join(rivals.select(*group, F.col("_keeper").alias("encounter_id"), "_size"), "encounter_id"))
    spread = keeper_facts.groupBy(*group, "_h1", "_h2").agg(F.count(F.lit(1)).alias("_holders"))
    rarest = (
        joins.attach(keeper_facts, spread, [*group, "_h1", "_h2"])
        .groupBy(*group, "encounter_id", "_size")
        .agg(F.min(F.struct("_holders", "_h1", "_h2")).alias("_rare"))
        .filter("_rare._holders > 1")
        .select(*group, F.col("encounter_id").alias("_small"), F.col("_size").alias("_small_size"), "_rare._h1", "_rare._h2")
    )
    larger = keeper_facts.select(*group, F.col("encounter_id").alias("_large"), F.col("_size").alias("_large_size"), "_h1", "_h2")
    candidates = (
        rarest.join(larger, [*group, "_h1", "_h2"])
        .filter(F.col("_large_size") > F.col("_small_size"))
        .select("_small", "_small_size", "_large")
    )
    small_facts = facts.select(F.col("encounter_id").alias("_small"), "_h1", "_h2")
    large_facts = facts.select(F.col("encounter_id").alias("_large"), "_h1", "_h2")
    contained = (
        candidates.join(small_facts, "_small").join(large_facts, ["_large", "_h1", "_h2"])
        .groupBy("_small", "_large", "_small_size").agg(F.count(F.lit(1)).alias("_shared"))
        .filter(F.col("_shared") == F.col("_small_size"))
        .select(F.col("_small").alias("_keeper")).distinct()
    )
    empty = rivals.filter("_size = 0").select("_keeper")
    subsumed = contained.unionByName(empty).withColumn("_subsumed", F.lit(True))
    reason = F.when(F.col("encounter_id") != F.col("_keeper"), "exact copy").when(F.col("_subsumed"), "subset")
    judged = holders.join(subsumed, "_keeper", "left").select("encounter_id", reason.alias("reason"))
    return judged.filter(F.col("reason").isNotNull())


def keep_unvoided(df: DataFrame, voided: DataFrame) -> DataFrame:
    """Encounters or observations without the voided encounters."""
    return df.join(voided.select("encounter_id"), "encounter_id", "left_anti")
