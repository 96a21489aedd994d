"""Users, patients, infants, registration, providers, sites and de-identification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlift.functions import dates, text
from chartlift.functions.columns import blank_to_null
from chartlift.functions.dates import as_of_column
from chartlift.functions.ids import modulo_pick, uuid_hash, uuid_name
from chartlift.operators import eav, filters, joins, quality
from chartlift.operators.keys import assign_ids
from chartlift.sources.readers import inline_mapping

UNKNOWN_LOCATION = 1

# Membership states that retire a user.
RETIRED_STATES = ["deleted", "banned"]

# Source site to the uuid of its target location.
SITE_LOCATIONS = [
    (0, "8d6c993e-c2cc-11de-8d13-0010c6dffd0f"),
    (3, "9bc65df6-99a2-4d43-b56b-f42bde3f5d6d"),
    (4, "328f68e4-0370-102d-b0e3-001ec94a0cc1"),
    (5, "d6dafa1a-9a2f-4f61-a33e-410acb64b0e9"),
    (6, "328f6a60-0370-102d-b0e3-001ec94a0cc1"),
    (7, "376b3e7e-f7c0-4268-a98d-c2bddfee8bcf"),
    (8, "23e7bb0d-51f9-4d5f-b34b-2fbbfeea1960"),
    (21, "c741e25d-eb07-4efc-89e4-38ac73948ae1"),
    (22, "209c84cf-4cd7-4908-a946-030499c1ff75"),
    (31, "83f215e4-9644-11eb-b8a1-0242ac110002"),
    (32, "8b23098d-9644-11eb-b8a1-0242ac110002"),
    (33, "a084f714-a536-473b-94e6-ec317b152b43"),
    (34, "90d32dc3-9644-11eb-b8a1-0242ac110002"),
    (35, "93ad149f-9644-11eb-b8a1-0242ac110002"),
    (36, "96f36fcb-9644-11eb-b8a1-0242ac110002"),
    (37, "a7af173a-f623-445a-bf01-e6a64c0b2c98"),
    (38, "99fa069e-9644-11eb-b8a1-0242ac110002"),
    (39, "9c7bb4b3-9644-11eb-b8a1-0242ac110002"),
    (40, "c488ed05-f259-4f7b-a9d4-8f56736da691"),
    (42, "8d6c993e-c2cc-11de-8d13-0010c6dffd0f"),
    (63, "6c1c2579-7d16-4d39-bca2-e77141ff435f"),
    (82, "97c241a0-eaec-11e5-a837-0800200c9a66"),
    (122, "9f960dcd-9644-11eb-b8a1-0242ac110002"),
    (123, "9f960dcd-9644-11eb-b8a1-0242ac110002"),
    (142, "9f960dcd-9644-11eb-b8a1-0242ac110002"),
    (162, "8b23098d-9644-11eb-b8a1-0242ac110002"),
    (163, "83f215e4-9644-11eb-b8a1-0242ac110002"),
]

# Site numbers that stand for 'no site'.
NO_SITE = [0, 42]

# Names given to people whose records are shown outside.
FAMILY_NAMES = [
    "Miranda", "Allen", "Virguna", "Kamikazi", "Inka", "Kichura", "Mukatete", "Seaton", "Ball", "Soucy", "Ioan",
    "Munson", "Kim", "White", "Cardoza", "Istenes", "Dylan", "Young", "Brady", "Lannister",
]
FEMALE_NAMES = [
    "Lucia", "Maria", "Martina", "Daniela", "Alba", "Ella", "Noemi", "Louise", "Mia", "Roseline", "Madeline",
    "Mirlande", "Fabienne", "Islande", "Emma", "Olivia", "Ava", "Sophia", "Charlotte",
]
MALE_NAMES = [
    "Liam", "Noah", "William", "James", "Oliver", "Gabriel", "Raphael", "Alexandre", "Mohamed", "Louis", "Augustin",
    "Mark", "Alejandro", "Hugo", "Pablo", "Martin", "Innocent", "Alvaro", "Lucas",
]
FEMALE_MIDDLE_NAMES = [
    "Charlotte", "Sophia", "Ava", "Olivia", "Emma", "Roseline", "Fabienne", "Mirlande", "Madeline", "Islande", "Mia",
    "Louise", "Noemi", "Ella", "Alba", "Daniela", "Martina", "Maria", "Lucia", "Mirela", "Emilia",
]
MALE_MIDDLE_NAMES = [
    "Lucas", "Alvaro", "Innocent", "Martin", "Pablo", "Hugo", "Alejandro", "Mark", "Augustin", "Louis", "Mohamed",
    "Alexandre", "Paul", "Peter", "Octavian", "Daniel", "Marvin", "Mario", "Luciano", "Eugen", "Joseph",
]

# Civil status words.
CIVIL_STATUS = {
    "DIVORCED": "LOCAL:DIVORCED",
    "MARRIED": "LOCAL:MARRIED",
    "PARTNER": "LOCAL:LIVING WITH PARTNER",
    "PLACE": "LOCAL:LIVING WITH PARTNER",
    "SEPARATED": "LOCAL:SEPARATED",
    "SINGLE": "LOCAL:SINGLE OR A CHILD",
    "WIDOWED": "LOCAL:WIDOWED",
}


# ---- users


def users(view: DataFrame, existing: DataFrame, as_of, reset_reason: str = "migration reset") -> DataFrame:
    """User rows of the staging run: every account is retired, deleted and banned ones say why.

    ``existing`` holds the usernames already taken, in ``username``.
    """
    taken = existing.select(F.col("username").alias("_clean"), F.lit(True).alias("_taken")).distinct()
    named = view.withColumn("_clean", text.username_from_email("email", "source_user_id")).join(taken, "_clean", "left")
    is_taken = F.coalesce("_taken", F.lit(False))
    retired = F.col("member_state").isin(RETIRED_STATES)
    return named.select(
        "source_user_id",
        text.username_from_email("email", "source_user_id", is_taken).alias("username"),
        F.when(~F.coalesce(F.col("email").startswith("`"), F.lit(False)), F.col("email")).alias("email"),
        "first_name", "last_name", "password", "salt",
        uuid_name("user", "source_user_id").alias("user_uuid"),
        uuid_name("user_person", "source_user_id").alias("person_uuid"),
        F.lit(True).alias("retired"),
        as_of_column(as_of).alias("date_retired"),
        F.when(retired, F.col("member_state")).otherwise(F.lit(reset_reason)).alias("retire_reason"),
    )


def users_prototype(view: DataFrame, as_of, max_user_id: int = 100, max_person_id: int = 100) -> dict[str, DataFrame]:
    """The five user files of the prototype, from one derived set of columns."""
    retired = F.col("member_state").isin(RETIRED_STATES)
    today = as_of_column(as_of)
    data = view.withColumns({
        "user_id": F.col("source_user_id") + max_user_id,
        "person_id": F.col("source_user_id") + max_person_id,
        "person_uuid": uuid_name("user_person", "source_user_id"),
        "person_name_uuid": uuid_name("user_person_name", "source_user_id"),
        "user_uuid": uuid_name("user", "source_user_id"),
        "date_created": today,
        "creator": F.lit(1),
        "username": text.username_with_id("email", "source_user_id"),
        "retired": retired,
        "retired_by": F.when(retired, 1),
        "date_retired": F.when(retired, today),
        "retire_reason": F.when(retired, F.col("member_state")),
    })
    return {
        "source_users": data,
        "persons": data.select("person_id", F.col("person_uuid").alias("uuid"), "date_created", "creator"),
        "person_names": data.select(
            "person_id", F.col("person_name_uuid").alias("uuid"), "date_created", "creator",
            F.col("first_name").alias("given_name"), F.col("last_name").alias("family_name"), F.lit(True).alias("preferred"),
        ),
        "users": data.select(
            "user_id", "person_id", F.col("user_uuid").alias("uuid"), "date_created", "creator", "username", "password",
            "salt", "retired", "retired_by", "date_retired", "retire_reason", F.col("username").alias("system_id"),
        ),
        "user_properties": data.select(
            "user_id", F.col("email").alias("property_value"), F.lit("notificationAddress").alias("property")
        ),
    }


# ---- sites


def site_map(spark: SparkSession, locations: DataFrame | None = None) -> DataFrame:
    """site, location_uuid and, with the target's ``locations(uuid, location_id)``, the location id."""
    sites = inline_mapping(spark, SITE_LOCATIONS, "site int, location_uuid string")
    if locations is None:
        return sites
    return sites.join(locations.select(F.col("uuid").alias("location_uuid"), "location_id"), "location_uuid")


# ---- patients


def stage_patients(raw: DataFrame, start: int | None = None) -> DataFrame:
    """Cleaned patients; with ``start`` they also get consecutive person ids in source order."""
    staged = raw.withColumns({
        "nif_id": F.trim("nif_id"),
        "national_id": F.trim("national_id"),
        "gender": F.upper("gender"),
        "health_center": filters.null_if_in("health_center", NO_SITE),
        "starting_health_center": filters.null_if_in("starting_health_center", NO_SITE),
    })
    staged = filters.backfill_pair(staged, "health_center", "starting_health_center")
    estimated = F.coalesce(F.when(F.col("birthdate").isNull(), 0), F.col("birthdate_estimated"))
    staged = staged.withColumns({"birthdate_estimated": estimated, "person_uuid": uuid_name("person", "source_patient_id")})
    return staged if start is None else assign_ids(staged, ["source_patient_id"], "person_id", start)


def patient_persons(staged: DataFrame, user_ids: DataFrame) -> DataFrame:
    """Person rows; ``user_ids(source_user_id, user_id)`` names the creators."""
    dead = F.coalesce(F.col("outcome") == "died", F.lit(False))
    creators = user_ids.select(F.col("source_user_id").alias("patient_created_by"), F.col("user_id").alias("creator"))
    return staged.join(creators, "patient_created_by", "left").select(
        "person_id", F.col("person_uuid").alias("uuid"), "gender", "birthdate", "birthdate_estimated", "creator",
        F.col("patient_created_date").alias("date_created"), dead.alias("dead"),
        F.when(dead, F.col("outcome_date")).alias("death_date"),
    )


def patient_names(staged: DataFrame) -> DataFrame:
    """Names with 'UNKNOWN' where the source has none."""
    given = text.given_name("first_name", "first_name2")
    return staged.select(
        "person_id", uuid_name("person_name", "source_patient_id").alias("uuid"),
        filters.default_unknown(given).alias("given_name"), F.col("nickname").alias("middle_name"),
        filters.default_unknown("last_name").alias("family_name"), F.lit(True).alias("preferred"),
    )


def stage_addresses(addresses: DataFrame, localities: DataFrame) -> DataFrame:
    """Addresses with the locality dictionary's place names where a locality is known."""
    known = localities.select(
        "locality_id", *[F.col(c).alias(f"_{c}") for c in ("department", "commune", "section", "locality")]
    )
    joined = addresses.join(known, "locality_id", "left")
    return joined.select(
        "address_id", "source_patient_id", "address_type", "entry_date", "address",
        *[F.coalesce(f"_{c}", c).alias(c) for c in ("department", "commune", "section", "locality")],
    )


def patient_addresses(staged_addresses: DataFrame, staged: DataFrame, country: str = "Haiti") -> DataFrame:
    return staged_addresses.join(staged.select("source_patient_id", "person_id"), "source_patient_id").select(
        "person_id", (F.col("address_type") == "current").alias("preferred"), F.col("locality").alias("address1"),
        text.truncate_text("address", 255).alias("address2"), F.col("commune").alias("city_village"),
        F.col("department").alias("state_province"), F.lit(country).alias("country"),
        F.col("section").alias("address3"), F.col("entry_date").alias("date_created"),
        uuid_name("person_address", "address_id").alias("uuid"),
    )


def _identifier_rows(people: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """One row per person and identifier that is present."""
    structs = [F.struct(F.lit(kind).alias("kind"), value.alias("identifier")) for kind, value in kinds.items()]
    rows = eav.explode_present(people, structs, keep=["person_id"])
    return rows.filter(F.col("identifier").isNotNull())


def patient_identifiers(staged: DataFrame, pool_ids: DataFrame | None = None) -> DataFrame:
    """One row per present identifier of a patient: kinds source_id, dossier, national, fiscal, and the
    ready-made preferred id of ``pool_ids(person_id, identifier)``."""
    own = _identifier_rows(staged, {
        "source_id": F.col("source_patient_id").cast("string"), "dossier": F.col("dossier_id"),
        "national": blank_to_null("national_id"), "fiscal": blank_to_null("nif_id"),
    }).withColumn("preferred", F.lit(False))
    if pool_ids is None:
        return own
    pooled = pool_ids.join(staged.select("person_id"), "person_id", "left_semi").select(
        "person_id", F.lit("emr").alias("kind"), "identifier", F.lit(True).alias("preferred")
    )
    return own.unionByName(pooled)


def patient_phones(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("phone_number").isNotNull()).select(
        "person_id", F.col("phone_number").alias("value"), F.lit("Telephone Number").alias("attribute")
    )


def missing_name_warning(df: DataFrame, given: Column, family: Column, who: str) -> DataFrame:
    field = (
        F.when(given.isNull() & family.isNull(), "given name and family name")
        .when(given.isNull(), "given name").when(family.isNull(), "family name")
    )
    return quality.warn(df, f'{who} missing name. Defaulted to "UNKNOWN"', patient="person_id", field=field,
                        when=given.isNull() | family.isNull())


def patient_warnings(staged: DataFrame, staged_addresses: DataFrame, as_of) -> DataFrame:
    """The six patient warnings: names, long addresses, death before birth, repeated ids, odd birth dates."""
    given = text.given_name("first_name", "first_name2")
    death = F.when(F.col("outcome") == "died", F.to_date("outcome_date"))

    def repeated(column: str, kind: str) -> DataFrame:
        values = staged.withColumn(column, blank_to_null(F.trim(column)))
        twice = quality.duplicate_values(values, [column]).select(column)
        return quality.warn(joins.attach(values, twice, [column]), kind, patient="person_id", field=column, value=column)

    long_ones = staged_addresses.filter(text.is_truncated("address", 255)).join(
        staged.select("source_patient_id", "person_id"), "source_patient_id"
    )
    odd = filters.implausible_date("birthdate", as_of, years_back=120)
    return quality.all_warnings(
        missing_name_warning(staged, given, F.col("last_name"), "Patient"),
        quality.warn(long_ones, "Address too long. Truncated to 255 characters.", patient="person_id", field="address",
                     value="address"),
        quality.warn(staged, "Death date before birth date", patient="person_id", field="death_date",
                     value=death.cast("string"), when=death < F.to_date("birthdate")),
        repeated("national_id", "Duplicate National_ID"),
        repeated("nif_id", "Duplicate nif_id"),
        quality.warn(staged, "Abnormal birthdate value", patient="person_id", field="birthdate",
                     value=dates.day_text("birthdate"), when=odd),
    )


# ---- infants


def stage_infants(raw: DataFrame, patients: DataFrame, start: int | None = None) -> DataFrame:
    """Infants without a patient record of their own whose known parents are all in scope."""
    ids = patients.select(F.col("source_patient_id").alias("_parent")).distinct()
    kept = raw.filter(F.col("patient_id").isNull())
    for column in ("mother_patient_id", "father_patient_id"):
        outside = kept.filter(F.col(column).isNotNull()).join(ids, F.col(column) == F.col("_parent"), "left_anti")
        kept = kept.join(outside.select("source_infant_id"), "source_infant_id", "left_anti")
    staged = kept.withColumns({"infant_code": F.trim("infant_code"), "gender": F.upper("gender")}).drop("patient_id")
    return staged if start is None else assign_ids(staged, ["source_infant_id"], "person_id", start)


def infant_persons(staged: DataFrame) -> DataFrame:
    dead = F.coalesce(F.col("vital_status") == "dead", F.lit(False))
    person = F.concat(F.lit("infant"), F.col("person_id").cast("string"))
    return staged.select(
        "person_id", uuid_hash(person).alias("uuid"), filters.default_unknown("gender", "U").alias("gender"),
        "birthdate", dead.alias("dead"), F.when(dead, F.col("vital_status_date")).alias("death_date"),
        filters.default_unknown("first_name").alias("given_name"), filters.default_unknown("last_name").alias("family_name"),
    )


def infant_encounters(staged: DataFrame, sites: DataFrame, as_of) -> DataFrame:
    """A registration encounter for each infant, and a documentation encounter where there is something to say."""
    placed = staged.join(sites.select(F.col("site").alias("health_center"), "location_id"), "health_center", "left")
    at = F.coalesce(F.to_date("birthdate"), F.to_date("vital_status_date"), as_of_column(as_of))
    documented = F.col("hiv_status").isNotNull() | F.col("non_emr_mother").isNotNull()
    common = {
        "person_id": F.col("person_id"), "encounter_date": at,
        "location_id": F.coalesce("location_id", F.lit(UNKNOWN_LOCATION)),
        "source_infant_id": F.col("source_infant_id"),
    }
    return eav.split_rows(placed, [
        (F.lit(True), {"encounter_type": F.lit("registration"), **common}),
        (documented, {"encounter_type": F.lit("infant documentation"), **common}),
    ])


def infant_obs(staged: DataFrame) -> DataFrame:
    """HIV status, and a contact group for a mother who is no patient (keyed by the infant's encounter)."""
    status = filters.case_map(
        "hiv_status", {"positive": "LOCAL:POSITIVE", "negative": "LOCAL:NEGATIVE", "undetermined": "LOCAL:unknown"}
    )
    mother = F.col("non_emr_mother")
    return eav.emit(staged, "infant", ["source_infant_id"], "source_infant_id", [
        eav.coded("CIEL:1169", status, when=F.col("hiv_status").isNotNull(), keep_null=True),
        eav.Group("LOCAL:Contact construct", [
            eav.text("LOCAL:FIRST NAME", mother),
            eav.coded("LOCAL:Gender", "LOCAL:FEMALE"),
            eav.coded("LOCAL:RELATIONSHIP OF RELATIVE TO PATIENT", "LOCAL:MOTHER"),
        ], when=mother.isNotNull()),
    ])


def infant_relationships(staged: DataFrame, patients: DataFrame) -> DataFrame:
    """Parent rows for mothers and fathers who are patients."""
    parents = F.array(
        F.struct(F.lit("mother").alias("parent"), F.col("mother_patient_id").alias("source_patient_id")),
        F.struct(F.lit("father").alias("parent"), F.col("father_patient_id").alias("source_patient_id")),
    )
    links = staged.select(F.col("person_id").alias("person_b"), "birthdate", F.explode(parents).alias("_p")).select(
        "person_b", F.col("birthdate").alias("start_date"), "_p.parent", "_p.source_patient_id"
    )
    ids = patients.select("source_patient_id", F.col("person_id").alias("person_a"))
    return links.join(ids, "source_patient_id").select("person_a", "person_b", "parent", "start_date")


def infant_identifiers(staged: DataFrame) -> DataFrame:
    return _identifier_rows(
        staged, {"infant_id": F.col("source_infant_id").cast("string"), "infant_code": blank_to_null("infant_code")}
    )


def infant_warnings(raw: DataFrame, staged: DataFrame, as_of) -> DataFrame:
    """Infants who are patients already, missing names, odd birth dates, relationships in the future."""
    infant = F.col("source_infant_id").cast("string")
    known = F.col("patient_id").isNotNull()
    details = F.concat(F.lit("Infant with INFANT_ID "), infant, F.lit(" has patient record with with PATIENT_ID "),
                       F.col("patient_id").cast("string"), F.lit(", skipping importing infant record"))
    odd = F.col("birthdate").isNull() | filters.implausible_date("birthdate", as_of, years_back=30)
    has_parent = F.col("mother_patient_id").isNotNull() | F.col("father_patient_id").isNotNull()
    return quality.all_warnings(
        quality.warn(raw, "Infant has patient record, skipping importing infant record", field="infant_id", value=infant,
                     details=details, when=known),
        missing_name_warning(staged, F.col("first_name"), F.col("last_name"), "Infant"),
        quality.warn(staged, "Abnormal birthdate value", patient="person_id", field="birthdate",
                     value=dates.day_text("birthdate"), when=F.coalesce(odd, F.lit(True))),
        quality.warn(staged, "Relationship start date in the future", patient="person_id", field="start_date",
                     value=dates.day_text("birthdate"),
                     when=has_parent & (F.to_date("birthdate") > as_of_column(as_of))),
    )


# ---- registration


def registration_encounters(staged: DataFrame) -> DataFrame:
    """One registration encounter per patient, at the date the patient was created."""
    return staged.select(
        "source_patient_id", "person_id", F.lit("registration").alias("encounter_type"),
        F.to_date("patient_created_date").alias("encounter_date"), F.lit(UNKNOWN_LOCATION).alias("location_id"),
        uuid_name("registration_encounter", "source_patient_id").alias("uuid"),
    )


def registration_obs(birthplaces: DataFrame, socioeconomics: DataFrame, jobs: DataFrame, country: str = "Haiti") -> DataFrame:
    """Birthplace groups, civil status and occupation, keyed by patient.

    ``jobs(entry, ref)`` maps occupation spellings to concepts; an entry without one is kept as a comment.
    """
    place = [F.col(c) for c in ("locality", "section", "commune", "department")]
    known = F.coalesce(*place).isNotNull()
    group = eav.Group("LOCAL:Birthplace address construct", [
        eav.text("LOCAL:Address1", "locality"), eav.text("LOCAL:Address3", "section"),
        eav.text("LOCAL:City Village", "commune"), eav.text("LOCAL:State Province", "department"),
        eav.text("LOCAL:Country", F.lit(country)),
    ], when=known)
    birth = eav.emit(birthplaces, "birthplace", ["source_patient_id"], "source_patient_id", [group])

    codes = jobs.groupBy(F.col("entry").alias("primary_activity")).agg(F.min("ref").alias("_ref"))
    coded = joins.attach(socioeconomics, codes, ["primary_activity"], "left")
    status = F.coalesce(filters.case_map(F.upper(F.trim("civil_status")), CIVIL_STATUS), F.lit("LOCAL:OTHER"))
    job = F.coalesce("_ref", F.lit("LOCAL:OTHER"))
    unmapped = F.when(F.col("_ref").isNull() | (F.col("_ref") == "LOCAL:OTHER"), F.col("primary_activity"))
    facts = eav.emit(coded, "registration", ["source_patient_id"], "source_patient_id", [
        eav.coded("LOCAL:CIVIL STATUS", status, when=F.col("civil_status").isNotNull()),
        eav.coded("LOCAL:OCCUPATION", job, when=F.col("primary_activity").isNotNull(), comments=unmapped),
    ])
    return birth.unionByName(facts)


# ---- providers


def providers(encounters: DataFrame, intake_forms: DataFrame, followup_forms: DataFrame) -> DataFrame:
    """Distinct provider names of encounters and both forms; the names of each table are folded first."""
    names = [encounters.select(F.col("performed_by").alias("name")), intake_forms.select(F.col("examining_doctor").alias("name")),
             followup_forms.select(F.col("examining_doctor").alias("name"))]
    together = names[0].union(names[1]).union(names[2])
    return together.select(F.upper(F.trim("name")).alias("provider_name")).distinct()


# ---- de-identification


def de_identify(names: DataFrame, people: DataFrame, source_id: str) -> DataFrame:
    """Replace names by fixed ones picked by the source id (middle names by the person id).

    ``people``: person_id, the source id, gender. 'UNKNOWN' stays, as does a missing middle name.
    """
    female = F.coalesce(F.col("gender") == "F", F.lit(False))
    key = F.col(source_id)
    given = F.when(female, modulo_pick(key, FEMALE_NAMES)).otherwise(modulo_pick(key, MALE_NAMES))
    middle = F.when(female, modulo_pick("person_id", FEMALE_MIDDLE_NAMES)).otherwise(
        modulo_pick("person_id", MALE_MIDDLE_NAMES)
    )
    joined = names.join(people.select("person_id", source_id, "gender"), "person_id")

    def unless_unknown(column: str, new: Column) -> Column:
        return F.when(F.col(column) != "UNKNOWN", new).otherwise(F.col(column))

    return joined.withColumns({
        "given_name": unless_unknown("given_name", given),
        "family_name": unless_unknown("family_name", modulo_pick(key, FAMILY_NAMES)),
        "middle_name": unless_unknown("middle_name", middle),
    }).drop(source_id, "gender")
