"""Jobs on small hand-made rows: the edge cases that the given tables lack."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from chartlift.plans import clinic, documents, encounters, history, labs, orders, people, review, status, treatment

UNKNOWN = 1


def test_visits_ties_and_unknown(spark, rows):
    visits = spark.createDataFrame(
        [(1, datetime(2020, 1, 1), "clinic", 5), (1, datetime(2020, 1, 1, 9), "clinic", 7), (1, datetime(2020, 1, 1), "clinic", 1), (1, datetime(2020, 1, 2), "clinic", 1),
         (2, datetime(2020, 1, 1), "registration", 5)],
        "patient_id int, encounter_datetime timestamp, encounter_type string, location_id int",
    )
    found = encounters.visits(visits)
    assert rows(found, "patient_id", "date_started", "date_stopped", "location_id") == [
        (1, datetime(2020, 1, 1), datetime(2020, 1, 2, 8, 59, 59), 7), (1, datetime(2020, 1, 2), datetime(2020, 1, 2, 23, 59, 59), 1),
    ]


def test_comments_vote_on_the_place_but_start_no_visit(spark, rows):
    visits = spark.createDataFrame(
        [(1, datetime(2020, 1, 1, 9), "intake", 2, None), (1, datetime(2020, 1, 1, 7), "comment", 3, None), (1, datetime(2020, 1, 1, 23), "comment", 3, None),
         (1, datetime(2020, 1, 2), "comment", 3, None), (1, datetime(2020, 1, 3), "intake", 3, 77), (1, datetime(2020, 1, 1), "drug order", 4, None), (1, datetime(2020, 1, 1), "drug order", 4, None)],
        "patient_id int, encounter_datetime timestamp, encounter_type string, location_id int, visit_id int",
    )
    assert rows(encounters.visits(visits), "date_started", "location_id", "encounters") == [(datetime(2020, 1, 1, 9), 3, 1)]


def test_unknown_locations_cascade(spark):
    day = lambda d: datetime(2020, 1, d)
    visits = spark.createDataFrame([(i, p, day(d), place) for i, p, d, place in [
        (1, 1, 5, UNKNOWN), (2, 1, 12, UNKNOWN), (3, 1, 1, UNKNOWN), (4, 2, 5, UNKNOWN), (5, 3, 5, UNKNOWN), (6, 1, 5, 44), (7, 4, 30, UNKNOWN), (8, 1, 10, UNKNOWN)]],
        "encounter_id int, patient_id int, encounter_datetime timestamp, location_id int")
    enrolments = spark.createDataFrame([
        (1, day(2), day(10), 20), (1, day(3), day(10), 10), (4, day(2), None, 30)], "patient_id int, date_enrolled timestamp, date_completed timestamp, location_id int")
    sites = spark.createDataFrame([(2, 70)], "patient_id int, location_id int")
    found = {r.encounter_id: (r.location_id, r.resolved_by) for r in encounters.resolve_unknown_locations(visits, enrolments, sites).collect()}
    assert found == {
        1: (10, "current enrolment"), 2: (10, "previous enrolment"), 3: (20, "next enrolment"), 4: (70, "patient site"), 5: (UNKNOWN, "unknown"), 6: (44, None),
        7: (30, "current enrolment"), 8: (10, "current enrolment"),
    }


def test_void_duplicates_against_brute_force(spark):
    draw = random.Random(3)
    visits = [(i, draw.randrange(3), datetime(2020, 1, 1 + draw.randrange(2)), "clinic") for i in range(80)] + [(900, 0, datetime(2020, 1, 1), "drug order"), (901, 0, datetime(2020, 1, 1), "drug order")]
    facts = [(i, c, a, b) for i in range(80) for c, a, b in [(1, "x", None), (1, None, "x"), (2, None, None), (3, "y", "y")] if draw.random() < 0.5]
    found = encounters.void_duplicates(
        spark.createDataFrame(visits, "encounter_id int, patient_id int, encounter_datetime timestamp, encounter_type string"),
        spark.createDataFrame(facts + facts[:9], "encounter_id int, concept_id int, value_text string, value_coded string"), ["value_text", "value_coded"],
    )
    said = {i: {f[1:] for f in facts if f[0] == i} for i, *_ in visits}
    gone = set()
    for i, *group in visits:
        for j, *other in visits:
            if i != j and group == other and group[2] != "drug order" and said[i] <= said[j] and (said[i] < said[j] or i < j):
                gone.add(i)
    assert sorted(r.encounter_id for r in found.collect()) == sorted(gone)


def test_hiv_status_rules(spark):
    visits = spark.createDataFrame([(p, 100 + p, "intake", date(2010, 6, 1)) for p in (1, 2, 3, 4, 5)], "source_patient_id int, source_encounter_id int, source_encounter_type string, encounter_date date")
    rows = spark.createDataFrame([
        (1, 1, 101, date(2012, 1, 1), date(2012, 1, 1), "f", None, None),          # linked wins although later
        (2, 1, None, date(2001, 1, 1), date(2001, 1, 1), "t", None, None),
        (3, 2, None, date(2009, 1, 1), date(2009, 1, 1), "f", "vct_clinic", None),  # only negative before the intake
        (4, 2, None, date(2011, 1, 1), date(2011, 1, 1), "t", None, None),
        (5, 3, None, date(2011, 1, 1), date(2011, 1, 1), "t", None, "home"),        # positive only after
        (6, 4, None, None, date(2008, 5, 5), "?", None, None),                      # entry date stands in
    ], "status_id int, source_patient_id int, source_encounter_id int, status_date date, entered_date date, hiv_positive_p string, test_location string, test_location_other string")
    found = {r.source_patient_id: (r.status_on_encounter, r.hiv_positive_p, r.status_date, r.test_location, r.test_location_other)
             for r in status.hiv_status_at_intake(visits, rows).collect()}
    assert found == {
        1: (True, "f", date(2012, 1, 1), None, None), 2: (False, "f", date(2009, 1, 1), "vct_clinic", None), 3: (False, None, None, None, "home"),
        4: (False, "?", date(2008, 5, 5), None, None), 5: (False, None, None, None, None),
    }


def test_program_split_and_dates(spark):
    staged = spark.createDataFrame([
        # no site, no outcome date: six months after the last visit
        (1, 0, 42, None, "died", None, None, None, date(2010, 1, 1), date(2010, 2, 1)),
        # transfer between two sites
        (2, 3, 4, date(2010, 6, 1), "lost", date(2011, 1, 1), date(2009, 1, 1), None, date(2010, 1, 1), date(2010, 9, 1)),
        # transfer before enrolment is ignored
        (3, 3, 4, date(2009, 6, 1), None, None, None, None, date(2010, 1, 1), date(2010, 9, 1)),
        # outcome before enrolment
        (4, None, 4, None, "died", date(2009, 1, 1), None, None, date(2010, 1, 1), date(2010, 9, 1)),
    ], "source_patient_id int, starting_health_center int, health_center int, health_center_transfer_date date, treatment_status string, treatment_status_date date, art_start_date date, "
       "regimen_outcome_date date, min_visit_date date, max_visit_date date")
    patients = spark.createDataFrame([(p, p + 100, date(2008, 1, 1)) for p in (1, 2, 3, 4)], "source_patient_id int, person_id int, patient_created_date date")
    found = sorted((r.source_patient_id, r.part, r.site, r.date_enrolled, r.date_completed) for r in status.enrolments(status.program_raw(staged, "2020-01-01"), patients).collect())
    assert found == [
        (1, "single", 1, date(2010, 1, 1), date(2010, 8, 1)),
        (2, "current", 4, date(2010, 6, 1), None), (2, "initial", 3, date(2009, 1, 1), date(2010, 6, 1)),
        (3, "single", 4, date(2010, 1, 1), None), (4, "single", 4, date(2008, 1, 1), date(2009, 1, 1)),
    ]


def test_regimen_dates_and_orders(spark):
    regimens = spark.createDataFrame([
        (1, 10, 11, 1, "a", date(2010, 5, 1), None, date(2010, 4, 1), "died", "HIV", None),     # closed before it starts
        (2, None, None, 1, "b", date(2010, 5, 1), None, date(2030, 1, 1), None, "TB", "ptme"),  # closes in the future
        (3, None, None, 2, "zzz", date(2010, 5, 1), None, None, None, "HIV", "odd"),            # no encounter, unmapped product
    ], "source_regime_id int, encounter_opened_by int, encounter_closed_by int, source_patient_id int, product_name string, start_date date, end_date date, close_date date, "
       "reason_for_closure string, product_type string, regime_type string").withColumns(
        {**{c: F.lit(1) for c in ("ddd", "dwd")}, "prn": F.lit(None).cast("boolean"), **{f"{c}_dose": F.lit(0) for c in ("morning", "noon", "evening", "night")}})
    visits = spark.createDataFrame([(10, 510), (11, 511)], "source_encounter_id int, encounter_id int")
    patients = spark.createDataFrame([(1, 101), (2, 102)], "source_patient_id int, person_id int")
    products = spark.createDataFrame([("a", None, "drugA", "conceptA"), ("b", "conceptB", "", None)], "product_name string, concept string, drug string, drug_concept string")
    made = {(r.source_regime_id, r.order_action): r for r in orders.drug_orders(regimens, visits, patients, products, "2020-01-01").collect()}
    assert set(made) == {(1, "NEW"), (1, "DISCONTINUE"), (2, "NEW"), (3, "NEW")}
    first, stop, second, third = (made[k] for k in [(1, "NEW"), (1, "DISCONTINUE"), (2, "NEW"), (3, "NEW")])
    assert first.date_stopped == date(2010, 5, 1) and first.drug == "drugA" and first.concept == "conceptA" and first.drug_non_coded is None
    assert stop.encounter_id == 511 and stop.previous_order_uuid == first.order_uuid and stop.order_reason == "3cdd446a-26fe-102b-80cb-0017a47871b2"
    assert second.auto_expire_date == date(2030, 1, 1) and second.date_stopped is None and second.drug_non_coded == "b" and second.concept == "conceptB"
    assert second.encounter_id == 510  # same patient and activation date
    assert third.encounter_id is None and third.new_encounter_uuid and third.concept is None and third.order_reason is None
    assert first.dosing_instructions == "1 /day x 1 days/week" and first.as_needed is False
    # rules over several tables: one row of each kind is broken on purpose
    made = orders.drug_orders(regimens, visits, patients, products, "2020-01-01")
    dates_of = visits.selectExpr("encounter_id", "101 AS patient_id", "DATE '2010-04-01' AS encounter_datetime")
    drugs = spark.createDataFrame([("drugA", "another concept")], "drug string, drug_concept string")
    broken = made.withColumns({
        "voided": F.when(F.col("source_regime_id") != 1, F.col("voided")), "orderer": F.when(F.col("source_regime_id") != 2, F.col("orderer")),
        "dosing_type": F.when(F.col("source_regime_id") != 1, F.col("dosing_type")),
        "care_setting": F.when(F.col("source_regime_id") == 3, "elsewhere").otherwise(F.col("care_setting")),
    })
    rules = {r.rule: (r.expected, r.actual) for r in orders.order_rules(broken, dates_of, regimens, "2020-01-01", regimens.limit(2), drugs).collect()}
    assert len(rules) == 26
    assert rules["All orders must have non-null voided"] == (0, 2) and rules["All orders must have non-null orderer"] == (0, 1)
    assert rules["Dosing type is required if action != DISCONTINUE"] == (0, 1) and rules["All rows are outpatient"] == (4, 3)
    assert rules["Concept associated with drug must not have a different concept than the one associated with the order"] == (0, 2)
    assert rules["All data from source should be loaded into staging table"] == (2, 3)
    assert rules["There should be a new order for all regimes"] == (3, 3)


def test_joins_of_orders_carry_no_made_ids_and_no_texts(spark):
    regimens = spark.createDataFrame([(1, 10, 11, 1, "a", date(2010, 5, 1), None, date(2010, 6, 1), "died", "HIV", None), (2, None, None, 1, "a", date(2010, 7, 1), None, None, None, "HIV", None)],
        "source_regime_id int, encounter_opened_by int, encounter_closed_by int, source_patient_id int, product_name string, start_date date, end_date date, close_date date, "
        "reason_for_closure string, product_type string, regime_type string").withColumns({**{c: F.lit(1) for c in ("ddd", "dwd")}, "prn": F.lit(True), **{f"{c}_dose": F.lit(0) for c in ("morning", "noon", "evening", "night")}})
    visits = spark.createDataFrame([(10, 510), (11, None)], "source_encounter_id int, encounter_id int")
    patients = spark.createDataFrame([(1, 101)], "source_patient_id int, person_id int")
    products = spark.createDataFrame([("a", None, "drugA", "conceptA")], "product_name string, concept string, drug string, drug_concept string")
    made = orders.drug_orders(regimens, visits, patients, products, "2020-01-01")
    assert sorted((r.source_regime_id, r.order_action, r.encounter_id, r.date_activated) for r in made.collect()) == [
        (1, "DISCONTINUE", None, date(2010, 6, 1)), (1, "NEW", 510, date(2010, 5, 1)), (2, "NEW", None, date(2010, 7, 1))]

    def below_joins(frame):
        lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return "\n".join(lines[next(i for i, line in enumerate(lines) if "Join" in line):])

    assert "md5" not in below_joins(made)
    # two encounters of one id, one of another patient: the order's row counts twice
    dates_of = spark.createDataFrame([(510, 101, date(2010, 1, 1)), (510, 7, date(2010, 1, 1))], "encounter_id int, patient_id int, encounter_datetime date")
    checked = orders.order_rules(made, dates_of, regimens, "2020-01-01", regimens, products)
    rules = {r.rule: (r.expected, r.actual) for r in checked.collect()}
    assert rules["All orders must have the same patient in the order and the encounter"] == (4, 3)
    assert rules["All rows are outpatient"] == (4, 4) and rules["All discontinue orders must have a previous order id"] == (0, 0)
    kept = [line for line in checked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "_visit_patient" in line and "Project" in line]
    assert kept and not any("dosing_instructions" in line for line in kept)


def test_contacts_merge(spark, rows):
    contacts = spark.createDataFrame([
        (1, "Ann Bee", "fils", date(2000, 1, 1), "t", "pos"), (1, "Ann Bee", "mari", None, None, None), (1, None, None, None, None, None), (1, "Solo", None, None, "f", None),
    ], "source_patient_id int, contact_name string, relationship string, birth_date date, deceased_p string, hiv_status string")
    visits = spark.createDataFrame([(1, 10, "intake", date(2010, 1, 1)), (1, 9, "followup", date(2009, 1, 1))], "source_patient_id int, source_encounter_id int, source_encounter_type string, encounter_date date")
    staged = history.stage_contacts(contacts, visits)
    assert rows(staged, "contact_name", "first_name", "last_name", "relation_ref", "age", "death_ref", "status_ref") == [
        ("Ann Bee", "Ann ", "Bee", "LOCAL:PARTNER OR SPOUSE", 10, "LOCAL:DEATH", "LOCAL:POSITIVE"), ("Solo", "Solo", "Solo", None, None, None, None), (None, None, None, None, None, None, None),
    ]
    drafts = history.contacts_obs(staged)
    assert drafts.filter("group_key IS NULL").count() == 2  # nothing is known of the nameless contact
    patients = spark.createDataFrame([(1, 101)], "source_patient_id int, person_id int")
    assert rows(history.contact_warnings(contacts, staged, patients), "field_name", "field_value") == [("relationship", "fils, mari")]


def test_infants_out_of_scope(spark, rows):
    infants = spark.createDataFrame([(1, None, 1, None), (2, 7, None, None), (3, None, 99, None), (4, None, None, None), (5, None, 1, 99)],
                                    "source_infant_id int, patient_id int, mother_patient_id int, father_patient_id int").withColumns({"infant_code": F.lit(" c "), "gender": F.lit("f")})
    patients = spark.createDataFrame([(1, 101)], "source_patient_id int, person_id int")
    assert rows(people.stage_infants(infants, patients), "source_infant_id") == [(1,), (4,)]


def test_encounter_without_date(spark):
    raw = spark.createDataFrame([(1, 1, "intake", None, None, date(2010, 1, 2), 99, None, None)],
                                "source_encounter_id int, source_patient_id int, source_encounter_type string, source_creator_id int, encounter_date date, date_created date, source_location_id int, "
                                "comments string, note_title string")
    forms = spark.createDataFrame([(1, "3")], "source_encounter_id int, form_version string")
    sites = spark.createDataFrame([(3, 30)], "site int, location_id int")
    staged = encounters.stage_encounters(raw, forms, forms, sites)
    patients = spark.createDataFrame([(1, 101)], "source_patient_id int, person_id int")
    users = spark.createDataFrame([(5, 50)], "source_user_id int, user_id int")
    [row] = encounters.encounters(staged, patients, users).collect()
    assert (row.encounter_datetime, row.location_id, row.creator, row.form_uuid) == (date(2010, 1, 2), 1, 1, encounters.VERSIONED_FORMS["intake/3"])
    kinds = [r.warning_type for r in encounters.encounter_warnings(staged, patients, "2020-01-01").collect()]
    assert kinds == ["Encounter date is null. `date_created` used as encounter date."]


def test_art_regimen_coding(spark, rows):
    observations = spark.createDataFrame([
        (1, 1, "current_tx.art", "tdf 3tc efv"), (2, 1, "current_tx.art_other", "plus herbs"), (3, 2, "current_tx.art_other", "azt/3tc/nvp"),
        (4, 3, "current_tx.art_start_date", "2010-02-31"), (5, 4, "current_tx.art", "mystery"), (6, 5, "current_tx.art", " "),
    ], "source_observation_id int, source_encounter_id int, observation string, value string")
    drafts = treatment.art_status_obs(observations).filter("group_key IS NOT NULL")
    assert rows(drafts, "source_encounter_id", "concept", "value_coded", "value_text", F.date_format("value_datetime", "yyyy-MM-dd")) == [
        (1, "CIEL:5424", None, "plus herbs", None), (1, "LOCAL:1282", "CIEL:164505", None, None), (2, "LOCAL:1282", "CIEL:1652", None, None),
        (3, "CIEL:159599", None, None, "2010-03-01"), (4, "CIEL:5424", None, "mystery", None), (4, "LOCAL:1282", "CIEL:5622", None, None),
    ]


def test_nutrition_and_adherence(spark, rows):
    observations = spark.createDataFrame([
        (1, 1, "receiving_nutritional_assistance_financial_aid", "t", date(2010, 1, 2)), (2, 1, "receiving_nutritional_assistance_dry_ration", "t", date(2010, 1, 1)),
        (3, 2, "num_doses_missed_last_month", " 2 ", date(2010, 1, 1)), (4, 2, "num_doses_missed_last_month", "few", date(2010, 1, 1)), (5, 2, "num_doses_missed_last_month", None, date(2010, 1, 1)),
    ], "source_observation_id int, source_encounter_id int, observation string, value string, entry_date date")
    assert rows(clinic.nutrition_obs(observations), "value_text") == [("A reçu de la ration sèche et de l’aide financière.",)]
    assert rows(clinic.adherence_obs(observations), "value_numeric") == [(2.0,)]
    assert rows(clinic.adherence_warnings(observations), "field_value") == [("few",)]


def test_chest_films_fold(spark, rows):
    films = spark.createDataFrame([(1, 1, "cxr1", "clear", date(2010, 1, 2)), (2, 1, "cxr0", None, date(2010, 1, 1)), (3, 1, "cxr2", None, None), (4, 2, "other_radiology", "ok", None)],
                                  "exam_lab_id int, source_encounter_id int, lab_test string, result string, test_date date")
    found = rows(labs.radiology_obs(films).filter("value_text IS NOT NULL"), "source_encounter_id", "value_text")
    assert found == [(1, "cxr0: 2010-01-01; cxr1: clear: 2010-01-02"), (2, "ok")]


def test_sample_unknowns_exclude_yes(spark):
    patients = spark.createDataFrame([(i, "M", date(1970, 1, 1), f"First{i}", "Last") for i in range(400)], "source_patient_id int, gender string, birthdate date, first_name string, last_name string")
    visits = spark.createDataFrame([(i, i, "intake", date(2010, 1, 1)) for i in range(400)], "source_encounter_id int, source_patient_id int, source_encounter_type string, encounter_date date")
    found = review.sample_population_obs(patients, visits)
    assert found.groupBy("source_encounter_id", "concept").count().filter("count > 1").count() == 0
    assert {r.value_coded for r in found.select("value_coded").distinct().collect()} == {"LOCAL:YES", "LOCAL:UNKNOWN"}


def test_a_hot_patient_is_one_document(spark):
    patients = spark.createDataFrame([(1,), (2,), (3,)], "source_patient_id long")
    lines = spark.range(500).select(F.when(F.col("id") < 450, 1).otherwise(2).alias("source_patient_id"), "id").repartition(6)
    nested = documents.patient_documents(patients, {"lines": lines})
    assert nested.columns == ["source_patient_id", "lines"]
    found = {r.source_patient_id: r.lines and [x.id for x in r.lines] for r in nested.collect()}
    assert found == {1: list(range(450)), 2: list(range(450, 500)), 3: None}
    long = documents.list_rows({"lines": lines}, "source_patient_id")["lines"].collect()
    assert sorted((r.source_patient_id, r.position, r.child.id) for r in long if r.source_patient_id == 1) == [(1, i + 1, i) for i in range(450)]


def test_hiv_positive_is_never_exported_negative(spark):
    """A patient whose last entered status is positive keeps it in the document."""
    rows = spark.createDataFrame([(1, 1, "f", date(2010, 1, 1)), (2, 1, "t", date(2010, 1, 2))], "status_id int, source_patient_id int, hiv_positive_p string, entered_date date").withColumns(
        {c: F.lit(None).cast("string") for c in ("status_date", "test_location", "test_location_other")})
    assert documents.hiv_status_facts(rows).first().hiv_positive_p == "t"
