"""What is known of a patient from the intake: living conditions, contacts, exposures, diagnoses, aid, side effects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.functions import dates, text
from chartlift.functions.columns import blank_to_null
from chartlift.functions.ids import uuid_name
from chartlift.operators import aggregates, eav, filters, quality
from chartlift.operators.joins import attach
from chartlift.sources.readers import inline_mapping

YES, NO = "LOCAL:YES", "LOCAL:NO"

# Living conditions.
ROOFS = {
    "concrete": "LOCAL:CEMENT", "sheet": "LOCAL:SHEET METAL", "thatch": "LOCAL:THATCH", "tile": "CIEL:159679",
    "tin": "LOCAL:SHEET METAL",
}
FLOORS = {
    "beaten ground": "LOCAL:BEATEN EARTH", "cement": "LOCAL:CEMENT", "dirt": "LOCAL:BEATEN EARTH", "mud": "LOCAL:OTHER",
}
EDUCATION = {
    "none": "LOCAL:NONE", "primary": "LOCAL:PRIMARY EDUCATION COMPLETE",
    "secondary": "LOCAL:SECONDARY EDUCATION COMPLETE", "university": "CIEL:159785",
}
TRANSPORT = {
    " bus": "LOCAL:MINI BUS", "bicycle": "LOCAL:BY BICYCLE", "car": "LOCAL:CAR", "foot": "LOCAL:WALKING",
    "horse": "LOCAL:980", "horse_mule": "LOCAL:980", "minibus": "LOCAL:MINI BUS", "other": "LOCAL:OTHER",
    "stretcher": "LOCAL:STRETCHER", "walk": "LOCAL:WALKING",
}
TRAVEL_TIMES = {
    "Less than 30 minutes": "LOCAL:LESS THAN 30 MINUTES", "under_30_min": "LOCAL:LESS THAN 30 MINUTES",
    "30 minutes to 1 hour": "LOCAL:30 TO 60 MINUTES", "30_min_to_1_hour": "LOCAL:30 TO 60 MINUTES",
    "1 to 2 hours": "LOCAL:ONE TO TWO HOURS", "1_to_2_hours": "LOCAL:ONE TO TWO HOURS",
    "2 to 3 hours": "LOCAL:982", "2_to_3_hours": "LOCAL:982",
    "3 to 6 hours": "LOCAL:3669", "3_to_6_hours": "LOCAL:3669",
    "More than 6 hours": "LOCAL:3669", "over_6_hours": "LOCAL:3669", "unknown": "LOCAL:UNKNOWN",
}


def _one_intake(encounters: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """The intake with the lowest id of each patient."""
    return aggregates.pick_per_key(
        encounters.filter("source_encounter_type = 'intake'"), ["source_patient_id"],
        ["source_encounter_id", *columns], ["source_encounter_id"],
    )


def socioeconomic_encounters(patients: DataFrame, socio: DataFrame, extra: DataFrame, encounters: DataFrame) -> DataFrame:
    """A socio-economics encounter at each intake of a patient with something to record."""
    facts = ["num_rooms_in_house", "num_people_in_house", "latrine_p", "radio_p", "education", "type_of_floor", "type_of_roof"]
    extra_facts = ["method_of_transport", "walking_time_to_clinic", "arrival_method_other"]
    told = socio.filter(F.coalesce(*[F.col(c).cast("string") for c in facts]).isNotNull()).select("source_patient_id")
    told = told.unionByName(extra.filter(F.coalesce(*extra_facts).isNotNull()).select("source_patient_id"))
    intakes = encounters.filter("source_encounter_type = 'intake'")
    return intakes.join(told, "source_patient_id", "left_semi").join(
        patients.select("source_patient_id", "person_id"), "source_patient_id"
    ).select(
        "source_patient_id", "person_id", F.col("source_encounter_id").alias("intake_encounter_id"),
        F.to_date("encounter_date").alias("encounter_date"), F.coalesce("location_id", F.lit(1)).alias("location_id"),
        uuid_name("socioeconomics_encounter", "source_encounter_id").alias("uuid"),
    )


def socioeconomics_obs(socio: DataFrame, extra: DataFrame, encounters: DataFrame) -> DataFrame:
    """Living conditions and habits. ``source_encounter_id`` is the patient's intake; key prefixes tell
    what belongs to the socio-economics encounter (socio) and what to the intake itself (habits)."""
    intake = _one_intake(encounters)

    def yes_no(column):
        return filters.case_map(column, {"t": YES, "f": NO})

    home = eav.emit(attach(socio, intake, ["source_patient_id"]), "socio", ["source_patient_id"], "source_encounter_id", [
        eav.numeric("CIEL:1474", "num_people_in_house"),
        eav.numeric("CIEL:1475", "num_rooms_in_house"),
        eav.coded("LOCAL:ROOF MATERIAL", filters.case_map("type_of_roof", ROOFS), when=F.col("type_of_roof").isNotNull(), keep_null=True),
        eav.coded("CIEL:159387", filters.case_map("type_of_floor", FLOORS), when=F.col("type_of_floor").isNotNull(), keep_null=True),
        eav.coded("LOCAL:Latrine", yes_no("latrine_p")),
        eav.coded("LOCAL:1318", yes_no("radio_p")),
        eav.coded("CIEL:1712", filters.case_map("education", EDUCATION), when=F.col("education").isNotNull(), keep_null=True),
    ])
    drinks = [F.trim(c).try_cast("double") for c in ("wine_per_day", "beer_per_day", "drinks_per_day")]
    days = F.trim("num_days_alcohol_per_week").try_cast("double")
    some = F.lit(False)
    for amount in [days, *drinks]:
        some = some | F.coalesce(amount > 0, F.lit(False))
    total = sum((F.coalesce(d, F.lit(0.0)) for d in drinks), F.lit(0.0))
    told = F.coalesce("wine_per_day", "beer_per_day", "drinks_per_day").isNotNull()
    rows = attach(extra, intake, ["source_patient_id"])
    travel = F.coalesce("time_of_transport", "walking_time_to_clinic")
    habits = eav.emit(rows, "habits", ["source_patient_id"], "source_encounter_id", [
        eav.coded("CIEL:163731", filters.case_map("smokes_p", {"t": "LOCAL:CURRENTLY", "f": NO})),
        eav.numeric("CIEL:159931", F.trim("smoking_years").try_cast("double")),
        eav.numeric("LOCAL:11949", F.trim("num_cigarretes_per_day").try_cast("double")),
        eav.coded("CIEL:159449", "LOCAL:CURRENTLY", when=some),
        eav.numeric("LOCAL:2243", days),
        eav.numeric("LOCAL:2246", total, when=told),
    ])
    way = eav.emit(rows, "socio_extra", ["source_patient_id"], "source_encounter_id", [
        eav.coded("LOCAL:975", filters.case_map("method_of_transport", TRANSPORT), when=F.col("method_of_transport").isNotNull(), keep_null=True),
        eav.coded("LOCAL:CLINIC TRAVEL TIME", filters.case_map(travel, TRAVEL_TIMES), when=travel.isNotNull(), keep_null=True),
        eav.text("LOCAL:1301", "arrival_method_other"),
    ])
    return home.unionByName(habits).unionByName(way)


# ---- contacts

# Relationship words, first match wins.
RELATIONSHIPS = [
    ("fil|enf|fiil|garcon|child", "CIEL:1528"),
    ("ex|part|mari|conc|femme|conjoint|epou|cop|fiance|petit|pat|husband", "LOCAL:PARTNER OR SPOUSE"),
    ("mere|pere|mére|pére", "LOCAL:GUARDIAN"),
    ("soeur|frere|frére", "LOCAL:SIBLING"),
]
CONTACT_STATUS = {
    "not_tested": "LOCAL:NO TEST", "unknown": "LOCAL:unknown", "positive": "LOCAL:POSITIVE", "negative": "LOCAL:NEGATIVE",
    "pos": "LOCAL:POSITIVE", "neg": "LOCAL:NEGATIVE",
}


def stage_contacts(contacts: DataFrame, encounters: DataFrame) -> DataFrame:
    """Contacts merged by patient and name, with split name, coded relation and status, and age at intake."""
    merged = aggregates.dedupe_merge(
        contacts, ["source_patient_id", "contact_name"], ["relationship", "birth_date", "deceased_p", "hiv_status"]
    )
    relation = F.col("relationship")
    code = None
    for pattern, ref in RELATIONSHIPS:
        code = F.when(relation.rlike(pattern), ref) if code is None else code.when(relation.rlike(pattern), ref)
    code = code.when(relation.isNotNull(), "LOCAL:OTHER RELATIVE")
    intake = _one_intake(encounters, ("encounter_date",))
    return attach(merged, intake, ["source_patient_id"]).select(
        "source_patient_id", "source_encounter_id", "contact_name", text.first_names("contact_name").alias("first_name"),
        text.last_name("contact_name").alias("last_name"), "relationship", code.alias("relation_ref"),
        dates.full_years("birth_date", "encounter_date").alias("age"),
        F.when(F.col("deceased_p") == "t", "LOCAL:DEATH").alias("death_ref"),
        filters.case_map("hiv_status", CONTACT_STATUS).alias("status_ref"),
    )


def contacts_obs(staged: DataFrame) -> DataFrame:
    """A contact group with the facts that are known; no group without any."""
    return eav.emit(staged, "contact", ["source_encounter_id", "contact_name"], "source_encounter_id", [
        eav.Group("LOCAL:Contact construct", [
            eav.text("LOCAL:FIRST NAME", "first_name"), eav.text("LOCAL:LAST NAME", "last_name"),
            eav.numeric("LOCAL:AGE", "age"), eav.coded("CIEL:164352", F.col("relation_ref")),
            eav.coded("CIEL:163533", F.col("death_ref")), eav.coded("LOCAL:RESULT OF HIV TEST", F.col("status_ref")),
        ], any_child=True),
    ])


def contact_warnings(contacts: DataFrame, staged: DataFrame, patients: DataFrame) -> DataFrame:
    """Merged contacts whose rows disagreed, with all values and the one that was kept."""
    fields = {"relationship": "relation_ref", "birth_date": "age", "deceased_p": "death_ref", "hiv_status": "status_ref"}
    conflicts = quality.conflicting_duplicates(contacts, ["source_patient_id", "contact_name"], list(fields))
    rows = conflicts.join(staged, ["source_patient_id", "contact_name"]).join(
        patients.select("source_patient_id", "person_id"), "source_patient_id"
    )
    shown = F.coalesce(*[F.when(F.col("field") == field, F.col(column).cast("string")) for field, column in fields.items()])
    details = F.concat(F.lit("For contact with name "), F.coalesce("contact_name", F.lit("''")), F.lit(". Migrated as "), shown)
    return quality.warn(rows, "Duplicate contact information with discrepancies", patient="person_id", field=F.col("field"),
                        value="listed", details=details)


# ---- previous exposures

# Treatment name, kind of history group, coded answer.
EXPOSURES = [
    ("CTX", "prophylaxis", "CIEL:105281"),
    ("Isoniazid", "prophylaxis", "CIEL:78280"),
    ("depo_provera", "fp", "CIEL:907"),
    ("AZT_3TC_NVP", "hiv", "LOCAL:13014"),
    ("AZT_3TC_EFV", "hiv", "LOCAL:13014"),
    ("condom", "fp", "CIEL:190"),
    ("oral_contraceptive", "fp", "CIEL:780"),
    ("D4T_3TC_NVP", "hiv", "LOCAL:13012"),
    ("norplant", "fp", "CIEL:78796"),
    ("D4T_3TC_EFV", "hiv", "LOCAL:13012"),
    ("Fluconazole", "prophylaxis", "CIEL:76488"),
    ("sterilization", "fp", "CIEL:1472"),
    ("2HRZE_4HR", "tb", "LOCAL:2406"),
    ("2S+HRZE_1HRZE_5HR+E", "tb", "LOCAL:2S+RHEZ / 1RHEZ / 5RH+E"),
    ("mdr_tb_treatment", "tb", "CIEL:159909"),
    ("AZT_3TC_EFV_NVP", "hiv", "LOCAL:13014"),
    ("TDF_3TC_LPV_r", "hiv", "LOCAL:TENOFOVIR LAMIVUDINE LOPINAVIR RITONAVIR"),
    ("TDF_3TC_EFV_NVP", "hiv", "CIEL:166052"),
    ("2HRZ_4HR", "tb", "LOCAL:2RHZ / 4RH"),
    ("D4T_WITH_REGIMENT", "hiv", "CIEL:166054"),
]
EXPOSURE_GROUPS = {
    "tb": "LOCAL:PREVIOUS TB TREATMENT HISTORY CONSTRUCT",
    "hiv": "LOCAL:PREVIOUS TREATMENT HISTORY HIV CONSTRUCT",
    "prophylaxis": "LOCAL:PREVIOUS TREATMENT PROPHYLAXIS CONSTRUCT",
    "fp": "LOCAL:Family planning history construct",
}
TREATMENT_RESULTS = {"cured": "CIEL:159791", "failed": "CIEL:843", "defaulted": "CIEL:160031"}


def exposures_obs(exposures: DataFrame, encounters: DataFrame) -> DataFrame:
    """Treatment history groups; names without a code are joined into one 'other' text per intake.

    Both halves of that text count: where only one exists it stands alone.
    """
    mapping = inline_mapping(exposures.sparkSession, EXPOSURES, "inn string, kind string, answer string")
    intakes = encounters.filter("source_encounter_type = 'intake'").select("source_patient_id", "source_encounter_id")
    rows = exposures.join(intakes, "source_patient_id").join(mapping, "inn", "left")
    inn, other = F.col("inn"), F.col("treatment_other")
    fp = EXPOSURE_GROUPS["fp"]
    outcome = filters.case_map("treatment_outcome", TREATMENT_RESULTS)

    def period(kind):
        medical = kind.isin("tb", "hiv", "prophylaxis")
        start = F.when(medical, "CIEL:1190").otherwise("CIEL:163757")
        end = F.when(medical, "CIEL:1191").otherwise("CIEL:163758")
        return [eav.datetime(start, "start_date", tag="start"), eav.datetime(end, "end_date", tag="end")]

    kind = F.col("kind")
    question = F.when(kind == "fp", "CIEL:374").otherwise("CIEL:1282")
    family = F.lit("fp")
    items = [
        eav.Group(filters.case_map("kind", EXPOSURE_GROUPS), [
            eav.coded(question, F.col("answer")), *period(kind), eav.coded("CIEL:6098", outcome, tag="result"),
        ], when=kind.isNotNull(), tag="mapped"),
        eav.Group(fp, [
            eav.coded("CIEL:374", "CIEL:5622"), *period(family), eav.coded("CIEL:6098", outcome, tag="result"),
        ], when=inn.isNull(), tag="unnamed"),
        eav.text("LOCAL:2996", other, when=inn.isNull(), tag="unnamed_text"),
        eav.Group(fp, [eav.coded("CIEL:374", "CIEL:79494"), *period(family)], when=other == "DMPA", tag="dmpa"),
    ]
    groups = eav.emit(rows, "exposure", ["exposure_id", "source_encounter_id"], "source_encounter_id", items)

    started = F.concat(F.lit("du "), dates.day_text("start_date"), F.lit(" "))
    ended = F.concat(F.lit("à "), dates.day_text("end_date"))
    has_period = F.col("start_date").isNotNull() | F.col("end_date").isNotNull()
    span = F.when(has_period, F.concat(F.lit(" ("), F.coalesce(started, F.lit("")), F.coalesce(ended, F.lit("")), F.lit(")"))).otherwise("")
    unmapped = inn.isNotNull() & (inn != "other") & other.isNull() & kind.isNull()
    named_other = inn.isNotNull() & other.isNotNull() & (other != "DMPA")
    by_inn = aggregates.string_agg(rows.filter(unmapped), ["source_encounter_id"], F.concat(inn, span), "inn_text", ", ")
    by_other = aggregates.string_agg(rows.filter(named_other), ["source_encounter_id"], F.concat(other, span), "other_text", ", ")
    both = by_inn.join(by_other, "source_encounter_id", "full").withColumn(
        "listed", text.concat_skip_null(", ", "inn_text", "other_text")
    )
    collected = eav.emit(both, "exposure_other", ["source_encounter_id"], "source_encounter_id", [
        eav.Group(EXPOSURE_GROUPS["hiv"], [eav.coded("CIEL:1282", "CIEL:5622")]),
        eav.text("LOCAL:1527", "listed"),
    ])
    return groups.unionByName(collected)


def exposure_warnings(exposures: DataFrame, patients: DataFrame) -> DataFrame:
    rows = exposures.join(patients.select("source_patient_id", "person_id"), "source_patient_id", "left")
    start, end = dates.day_text("start_date"), dates.day_text("end_date")
    details = F.concat(F.lit("inn: "), F.col("inn"), F.lit("; treatment_other: "), F.col("treatment_other"))
    return quality.warn(rows, "Previous exposure start date is after end date", patient="person_id",
                        field="Previous exposure start and end date", value=F.concat(start, F.lit(" vs "), end),
                        details=details, when=F.col("end_date") < F.col("start_date"))


# ---- diagnoses

# Diagnoses of the history section.
DIAGNOSES = {
    "Anemia": "LOCAL:ANEMIA", "Dermatitis": "LOCAL:DERMATITIS", "Diabetes": "LOCAL:DIABETES", "Diarrhea": "LOCAL:DIARRHEA",
    "Enteropathy": "CIEL:119175", "Hepatitis": "LOCAL:HEPATITIS", "Hypertension": "LOCAL:HYPERTENSION",
    "Malaria diagnosed in past 12 months": "LOCAL:MALARIA IN THE LAST TWELVE MONTHS", "Nephropathy": "CIEL:153701",
    "Neuropathy": "CIEL:118983", "Other cardiac problems": "CIEL:119270", "Other neurologic symptoms": "LOCAL:995",
    "Pneumonia": "LOCAL:PNEUMONIA", "Seizure / convulsions": "LOCAL:SEIZURE",
    "Sexually transmitted infection": "LOCAL:SEXUALLY TRANSMITTED INFECTION", "Shingles / zoster": "LOCAL:HERPES ZOSTER",
    "Thrush": "CIEL:5334", "Tuberculosis": "LOCAL:TUBERCULOSIS",
}


def diagnoses_obs(patient_diagnoses: DataFrame, diagnoses: DataFrame, encounters: DataFrame) -> DataFrame:
    """One group per intake and diagnosis; of repeated source rows the one with the lowest id counts."""
    intakes = encounters.filter("source_encounter_type = 'intake'").select("source_patient_id", "source_encounter_id")
    rows = patient_diagnoses.join(intakes, "source_patient_id")
    columns = ["diagnosis_comments", "diagnosis_other", "present_p", "diagnosis_date"]
    named = aggregates.pick_per_key(
        rows.join(diagnoses.select("diagnosis_id", "diagnosis_eng"), "diagnosis_id"),
        ["source_encounter_id", "diagnosis_eng"], columns, ["patient_diagnosis_id"],
    ).select("source_encounter_id", F.concat(F.lit("dx/"), "diagnosis_eng").alias("name"),
             filters.case_map("diagnosis_eng", DIAGNOSES).alias("ref"), F.col("diagnosis_comments").alias("comments"),
             "present_p", "diagnosis_date")
    other = aggregates.pick_per_key(
        rows.filter(F.col("diagnosis_other").isNotNull()), ["source_encounter_id", "diagnosis_other"],
        ["present_p", "diagnosis_date"], ["patient_diagnosis_id"],
    ).select("source_encounter_id", F.concat(F.lit("other/"), "diagnosis_other").alias("name"), F.lit("LOCAL:OTHER").alias("ref"),
             F.col("diagnosis_other").alias("comments"), "present_p", "diagnosis_date")
    present = F.when(F.col("present_p") == "t", YES).otherwise(NO)
    return eav.emit(named.unionByName(other), "diagnosis", ["source_encounter_id", "name"], "source_encounter_id", [
        eav.Group("CIEL:1633", [
            eav.coded("CIEL:1729", present), eav.coded("CIEL:1628", F.col("ref")), eav.text("CIEL:160221", "comments"),
            eav.datetime("CIEL:159948", "diagnosis_date"),
        ]),
    ])


# ---- assistance

# Wording of aid.
AID_NAMES = {
    "financial_aid": "Aide financière", "funeral_aid": "Aide pour funérailles", "house_assistance": "Aide au logement",
    "professional_training": "Formation professionnelle", "school_aid": "Aide scolaire",
}
AID_STATES = {"recommended": "Recommandé", "already_receiving": "Reçu"}


def assistance_obs(ordered: DataFrame, intake_forms: DataFrame, followup_forms: DataFrame) -> DataFrame:
    """Transport and food aid as coded facts, other aid as one text per encounter.

    Rows count if a form of another version than 3 holds them, or if their comment does not say no. The list
    of other aid restricts every row; without brackets around OR the source let rows of other kinds in.
    """
    joined = ordered
    for name, forms in (("_intake", intake_forms), ("_followup", followup_forms)):
        version = forms.groupBy("source_encounter_id").agg(F.min("form_version").cast("int").alias(name))
        joined = joined.join(version, "source_encounter_id", "left")
    old_form = F.coalesce(F.col("_intake") != 3, F.lit(False)) | F.coalesce(F.col("_followup") != 3, F.lit(False))
    comment, kind = F.col("comments"), F.col("ordered")
    wanted = old_form | F.coalesce(comment != "no", F.lit(False))
    question = F.when(comment == "already_receiving", "LOCAL:SOCIO-ECONOMIC ASSISTANCE ALREADY RECEIVED").otherwise(
        "LOCAL:SOCIO-ECONOMIC ASSISTANCE RECOMMENDED"
    )
    coded = eav.emit(joined, "aid", ["ordered_id"], "source_encounter_id", [
        eav.coded(question, "LOCAL:ASSISTANCE WITH TRANSPORT", when=(kind == "tranportation_aid") & wanted),
        eav.coded(question, "LOCAL:NUTRITIONAL AID", when=(kind == "nutritional_aid") & wanted),
    ])
    free = kind == "social_assistance_other"
    said = old_form | F.coalesce(~comment.like("no%") & ~comment.like("aucun"), F.lit(False))
    state = F.coalesce(filters.case_map(comment, AID_STATES), comment)
    suffix = F.when(free | comment.isNull(), "").otherwise(F.concat(F.lit(" ("), state, F.lit(")")))
    label = F.concat(F.when(free, comment).otherwise(filters.case_map(kind, AID_NAMES)), suffix)
    others = joined.filter(kind.isin([*AID_NAMES, "social_assistance_other"]) & said)
    listed = aggregates.string_agg(others, ["source_encounter_id"], label, "listed", ", ")
    text_rows = eav.emit(listed, "aid_other", ["source_encounter_id"], "source_encounter_id",
                         [eav.text("LOCAL:SOCIO-ECONOMIC ASSISTANCE NON-CODED", "listed")])
    return coded.unionByName(text_rows)


# ---- adverse events

# Reactions and side effects.
REACTIONS = {"Rash": "CIEL:512", "Neuropathy": "CIEL:118983", "Aniphylaxis": "CIEL:148888"}
SIDE_EFFECTS = {
    "anemia": "CIEL:121629", "hepatitis": "CIEL:116986", "icterus": "CIEL:136443", "lactic_acidosis": "CIEL:136162",
    "mild_rash": "CIEL:512", "moderate_rash": "CIEL:512", "severe_rash": "CIEL:512", "nausea_vomiting": "CIEL:133473",
    "neuropathy": "CIEL:118983", "none": "CIEL:1107", "other": "CIEL:5622",
}


def allergies_obs(allergies: DataFrame, encounters: DataFrame) -> DataFrame:
    """Allergy groups on the patient's first intake, and one 'yes' group per intake that has any.

    The source joined allergies to intakes without the patient; the patient is the key here.
    """
    rows = attach(allergies, _one_intake(encounters), ["source_patient_id"])
    reaction = F.col("type_of_reaction")
    code = F.coalesce(filters.case_map(reaction, REACTIONS), F.lit("CIEL:5622"))
    group = "LOCAL:ADVERSE EFFECT CONSTRUCT"
    each = eav.emit(rows, "allergy", ["allergy_id"], "source_encounter_id", [
        eav.Group(group, [
            eav.text("LOCAL:GENERAL FREE TEXT", F.coalesce("inn", "other_reason")),
            eav.coded("LOCAL:ADVERSE EFFECT", code, when=reaction.isNotNull(), comments=F.when(~reaction.isin(list(REACTIONS)), reaction)),
            eav.datetime("LOCAL:ADVERSE EFFECT DATE", "allergy_date"),
        ]),
    ])
    any_ = eav.emit(rows.select("source_encounter_id").distinct(), "allergy_any", ["source_encounter_id"], "source_encounter_id",
                    [eav.Group(group, [eav.coded("LOCAL:ADVERSE EFFECT", "CIEL:121764")])])
    return each.unionByName(any_)


def side_effects_obs(observations: DataFrame) -> DataFrame:
    """Side effects ticked in follow-ups, and the free text one."""
    name = F.col("observation")
    other = name == "side_effect.other"
    rows = observations.filter(name.startswith("side_effect.") & ((F.col("value") == "t") | other))
    effect = text.trim_prefix("observation", "side_effect.")
    return eav.emit(rows, "side_effect", ["source_observation_id"], "source_encounter_id", [
        eav.Group("LOCAL:ADVERSE EFFECT CONSTRUCT", [
            eav.coded("LOCAL:ADVERSE EFFECT", filters.case_map(effect, SIDE_EFFECTS), keep_null=True,
                      comments=F.when(other, blank_to_null("value"))),
        ]),
    ])
