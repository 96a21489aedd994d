"""Facts of patients and encounters by declared shapes, over stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions.dates import day_text
from chartlift.plans import facts
from chartlift.queries import standins as s
from chartlift.queries.documents import KINDS
from chartlift.queries.registry import query

COUNTS = ["2", "0", "many", None, "11"]
FLAGS = ["t", "f", None, "T", "no", "maybe"]
SYSTEMS, STATES = ["skin", "GENERAL", "heart", "Lymph_Nodes", None], ["normal", "Pale", "odd"]
FOUND = ["malaria", "HIV", "flu", None, "Weight_loss"]
STAGES = ["asymptomatic", "HIV_wasting", "stage 9", None]
FELT, UNITS = ["cough", "Fever", "sore toe", None], ["days", "WEEKS", "hours", None]
TESTS = ["cd4", "Hematocrite", "hematocrit", "x-ray vision", None]


def _coded(column: str, codes: list[str]) -> str:
    return f"CASE WHEN upper({column}) IN ({', '.join(s.sql_literal(c) for c in codes)}) THEN upper({column}) END"


def _flag(column: str) -> str:
    return f"CASE WHEN {column} IN ('t', 'T') THEN true WHEN {column} IN ('f', 'no') THEN false END"


def _unread(*parts: tuple[str, str, str]) -> str:
    """The report over (name, column, condition under which it cannot be read)."""
    listed = ", ".join(f"CASE WHEN {bad} THEN '{name}: ' || {column} END" for name, column, bad in parts)
    return f"nullif(concat_ws('; ', {listed}), '')"


@query("l11_pregnancies", f"""
    WITH p AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, {s.pick_sql('o_orderkey', COUNTS)} AS g, {s.pick_sql('o_orderkey', COUNTS, 1, 5)} AS c, o_orderpriority, o_orderstatus FROM orders)
    SELECT o_custkey AS source_patient_id, CAST(o_orderkey AS INTEGER) AS pregnancy_id, CASE WHEN o_orderkey % 7 <> 0 THEN day END AS last_period, TRY_CAST(g AS INTEGER) AS gravidity, TRY_CAST(c AS INTEGER) AS num_living_children,
        o_orderpriority AS family_planning_method, o_orderstatus AS outcome, {_unread(("last_period_date", "'soon'", "o_orderkey % 7 = 0"), ("gravidity", "g", "g = 'many'"), ("num_living_children", "c", "c = 'many'"))} AS unread FROM p
""")
def pregnancies(t):
    key, text = F.col("o_orderkey"), F.lit(None).cast("string")
    empty = ["expected_delivery_date", "parity", "num_abortions", "post_outcome_family_planning", "comments", "outcome_date", "outcome_location", "outcome_method"]
    rows = t.orders.select(
        F.col("o_custkey").alias("source_patient_id"), key.alias("pregnancy_id"), F.when(key % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_period_date"),
        s.pick("o_orderkey", COUNTS).alias("gravidity"), s.pick("o_orderkey", COUNTS, 1, 5).alias("num_living_children"), F.col("o_orderpriority").alias("family_planning_method"),
        F.col("o_orderstatus").alias("outcome"), *[text.alias(c) for c in empty],
    )
    return facts.pregnancy_facts(rows).select(
        "source_patient_id", "pregnancy_id", day_text("last_period_date").alias("last_period"), "gravidity", "num_living_children", "family_planning_method", "outcome", "unread")


@query("l11_contacts", f"""
    WITH c AS (SELECT *, {s.pick_sql('event_id', COUNTS)} AS a, {s.pick_sql('event_id', FLAGS)} AS f, {s.pick_sql('event_id', FLAGS, 1, 6)} AS d FROM events)
    SELECT user_id AS source_patient_id, event_type AS contact_name, TRY_CAST(a AS INTEGER) AS age, {_flag('f')} AS followed_in_clinic, {_flag('d')} AS deceased,
        {_unread(("age", "a", "a = 'many'"), ("followed_in_clinic", "f", "f = 'maybe'"), ("deceased", "d", "d = 'maybe'"))} AS unread FROM c
""")
def contacts(t):
    text = F.lit(None).cast("string")
    empty = ["relationship", "birth_date", "hiv_status", "clinic_name", "referred_tr_p", "referred_clinic"]
    rows = t.events.select(F.col("user_id").alias("source_patient_id"), F.col("event_type").alias("contact_name"), s.pick("event_id", COUNTS).alias("age"), s.pick("event_id", FLAGS).alias("clinic_p"),
                           s.pick("event_id", FLAGS, 1, 6).alias("deceased_p"), *[text.alias(c) for c in empty])
    return facts.contact_facts(rows).select("source_patient_id", "contact_name", "age", "followed_in_clinic", "deceased", "unread")


@query("l11_postnatal_exams", f"""
    WITH {s.encounters_sql(KINDS)}
    SELECT source_patient_id, strftime(encounter_date, '%Y-%m-%d') AS day, CAST(event_id + 1 AS INTEGER) AS pregnancy_id, event_type AS child_test_type, 'Unspecified' AS location, NULL::VARCHAR AS unread
    FROM enc LEFT JOIN events ON event_id = source_encounter_id WHERE source_encounter_type = 'infant_followup'
""")
def postnatal_exams(t):
    text = F.lit(None).cast("string")
    visits = s.encounters(t, KINDS).withColumn("entered_by", text)
    exams = t.events.select(F.col("event_id").alias("source_encounter_id"), (F.col("event_id") + 1).alias("pregnancy_id"), F.col("event_type").alias("child_serostatus_test"),
                            text.alias("child_serostatus_result"), text.alias("child_status"))
    return facts.postnatal_facts(visits, exams).select("source_patient_id", day_text("encounter_date").alias("day"), "pregnancy_id", "child_test_type", "location", "unread")


@query("l12_system_statuses", f"""
    WITH x AS (SELECT l_orderkey, {s.pick_sql('l_partkey', SYSTEMS)} AS a, {s.pick_sql('l_suppkey', STATES)} AS b FROM lineitem)
    SELECT l_orderkey AS source_encounter_id, {_coded('a', ["SKIN", "GENERAL", "LYMPH_NODES"])} AS system, {_coded('b', ["NORMAL", "PALE"])} AS condition,
        {_unread(("system", "a", "a = 'heart'"), ("condition", "b", "b = 'odd'"))} AS unread FROM x
""")
def system_statuses(t):
    return facts.system_status_facts(t.lineitem.select(F.col("l_orderkey").alias("source_encounter_id"), s.pick("l_partkey", SYSTEMS).alias("system"), s.pick("l_suppkey", STATES).alias("condition")))


@query("l12_infections", f"""
    WITH x AS (SELECT l_orderkey, {s.pick_sql('l_partkey', FOUND)} AS a, l_returnflag FROM lineitem)
    SELECT l_orderkey AS source_encounter_id, {_coded('a', ["MALARIA", "HIV", "WEIGHT_LOSS"])} AS oi, l_returnflag AS comments, {_unread(("oi", "a", "a = 'flu'"))} AS unread FROM x
""")
def infections(t):
    return facts.infection_facts(t.lineitem.select(F.col("l_orderkey").alias("source_encounter_id"), s.pick("l_partkey", FOUND).alias("oi"), F.col("l_returnflag").alias("comments")))


@query("l12_who_criteria", f"""
    WITH x AS (SELECT l_orderkey, {s.pick_sql('l_partkey', STAGES)} AS a FROM lineitem)
    SELECT l_orderkey AS source_encounter_id, {_coded('a', ["ASYMPTOMATIC", "HIV_WASTING"])} AS criterium, {_unread(("criterium", "a", "a = 'stage 9'"))} AS unread FROM x
""")
def who_criteria(t):
    return facts.who_criterion_facts(t.lineitem.select(F.col("l_orderkey").alias("source_encounter_id"), s.pick("l_partkey", STAGES).alias("criterium")))


@query("l12_symptoms", f"""
    WITH x AS (SELECT event_id // 8 AS id, strftime(ts, '%Y-%m-%d') AS day, {s.pick_sql('event_id', FELT)} AS a, {s.pick_sql('event_id', FLAGS, 1, 4)} AS f, {s.pick_sql('event_id', COUNTS, 1, 3)} AS n, {s.pick_sql('event_id', UNITS, 1, 2)} AS u FROM events)
    SELECT id AS source_encounter_id, {_coded('a', ["COUGH", "FEVER"])} AS symptom, CASE WHEN a = 'sore toe' THEN a END AS symptom_other, {_flag('f')} AS present, day, TRY_CAST(n AS INTEGER) AS duration,
        {_coded('u', ["DAYS", "WEEKS"])} AS duration_unit, {_unread(("present", "f", "f = 'maybe'"), ("duration", "n", "n = 'many'"), ("duration_unit", "u", "u = 'hours'"))} AS unread FROM x
""")
def symptoms(t):
    rows = t.events.select(
        F.expr("event_id div 8").alias("source_encounter_id"), s.pick("event_id", FELT).alias("symptom"), s.pick("event_id", FLAGS, 1, 4).alias("result"), F.to_date("ts").alias("symptom_date"),
        s.pick("event_id", COUNTS, 1, 3).alias("duration"), s.pick("event_id", UNITS, 1, 2).alias("duration_unit"), F.lit(None).cast("string").alias("symptom_comment"),
    )
    return facts.symptom_facts(rows).withColumn("day", day_text("symptom_date")).drop("symptom_date", "symptom_comment")


@query("l12_lab_orders", f"""
    WITH x AS (SELECT o_orderkey, {s.pick_sql('o_custkey', TESTS)} AS a, o_orderpriority FROM orders)
    SELECT o_orderkey AS source_encounter_id, CASE WHEN lower(a) = 'hematocrite' THEN 'HEMATOCRIT' ELSE {_coded('a', ["CD4", "HEMATOCRIT"])} END AS test, o_orderpriority AS test_other,
        {_unread(("test", "a", "a = 'x-ray vision'"))} AS unread FROM x
""")
def lab_orders(t):
    return facts.lab_order_facts(t.orders.select(F.col("o_orderkey").alias("source_encounter_id"), s.pick("o_custkey", TESTS).alias("test"), F.col("o_orderpriority").alias("test_other")))
