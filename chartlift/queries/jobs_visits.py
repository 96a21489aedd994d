"""Encounter, visit, status, programme and order jobs over stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions.dates import day_text
from chartlift.plans import encounters as enc
from chartlift.plans import orders, status
from chartlift.queries import standins as s
from chartlift.queries.registry import query

KINDS = ["intake", "followup", "lab_result", "note", "accompagnateur", "regime", "food_study"]
AS_OF = "2000-06-01"


# ---- staging


@query("k3_staging", """
    SELECT 'orders' AS source, source_patient_id, o_orderkey AS source_encounter_id FROM (SELECT o_custkey AS source_patient_id, o_orderkey FROM orders) WHERE source_patient_id % 3 = 0
    UNION ALL SELECT 'lineitem', NULL, l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 3 = 0
""")
def staging(t):
    tables = {
        "HIV_ORDERS": t.orders.select(F.col("o_custkey").alias("PATIENT_ID"), F.col("o_orderkey").alias("ENCOUNTER_ID")),
        "HIV_LINEITEM": t.lineitem.select(F.col("l_orderkey").alias("ENCOUNTER_ID")),
    }
    scope = t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("source_patient_id"))
    staged = enc.stage_all(tables, scope, s.encounters(t, KINDS))
    parts = [frame.withColumn("source", F.lit(name)) for name, frame in staged.items()]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).select("source", "source_patient_id", "source_encounter_id")


OBS_NAMES = ["a", "b", "c"]
OBS_VALUES = ["x", None, "y"]


@query("k31_load_observations", f"""
    WITH {s.observations_sql(OBS_NAMES, OBS_VALUES)}
    SELECT source_observation_id, source_encounter_id, observation, value FROM o WHERE source_encounter_id IN (SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 0)
""")
def load_observations(t):
    scope = t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("source_patient_id"))
    rows = enc.load_observations(s.observations(t, OBS_NAMES, OBS_VALUES), s.encounters(t, KINDS), scope)
    return rows.select("source_observation_id", "source_encounter_id", "observation", "value")


# ---- encounters


def _raw_encounters(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("source_encounter_id"), F.col("o_custkey").alias("source_patient_id"), s.pick("o_orderkey", KINDS).alias("source_encounter_type"),
        (key % 30).alias("source_creator_id"), F.when(key % 19 != 0, F.date_trunc("month", "o_orderdate").cast("date")).alias("encounter_date"),
        F.to_date("o_orderdate").alias("date_created"), (key % 30).cast("int").alias("source_location_id"),
        F.when(key % 9 == 0, F.col("o_orderstatus")).alias("note_title"), F.when(key % 6 == 0, F.col("o_orderpriority")).alias("comments"),
    )


def _staged_encounters(t):
    forms = t.orders.select(F.col("o_orderkey").alias("source_encounter_id"), s.pick("o_orderkey", s.FORM_VERSIONS, 1, 2).alias("form_version"))
    sites = t.nation.select(F.col("n_nationkey").alias("site"), (F.col("n_nationkey") + 100).alias("location_id"))
    return enc.stage_encounters(
        _raw_encounters(t), forms.filter("source_encounter_id % 7 = 0"), forms.filter("source_encounter_id % 7 = 1 AND source_encounter_id % 5 <> 0"), sites
    )


ENC_SQL = f"""e AS (SELECT o_orderkey AS id, o_custkey AS patient, {s.pick_sql('o_orderkey', KINDS)} AS kind, o_orderkey % 30 AS creator_id,
    CASE WHEN o_orderkey % 19 <> 0 THEN date_trunc('month', o_orderdate)::DATE END AS day, o_orderdate::DATE AS created, n_nationkey + 100 AS location_id,
    CASE WHEN o_orderkey % 7 = 0 OR (o_orderkey % 7 = 1 AND o_orderkey % 5 <> 0) THEN {s.pick_sql('o_orderkey', s.FORM_VERSIONS, 1, 2)} ELSE '1' END AS version,
    CASE WHEN o_orderkey % 9 = 0 THEN o_orderstatus END AS title, CASE WHEN o_orderkey % 6 = 0 THEN o_orderpriority END AS body
    FROM orders LEFT JOIN nation ON n_nationkey = o_orderkey % 30)"""


@query("k6_encounters", f"""
    WITH {ENC_SQL}
    SELECT id AS source_encounter_id, patient + 5000 AS patient_id, {s.case_sql('kind', enc.ENCOUNTER_TYPES)} AS encounter_type,
        coalesce({s.case_sql("kind || '/' || version", enc.VERSIONED_FORMS)}, {s.case_sql('kind', enc.FORMS)}) AS form_uuid,
        coalesce(day, created)::VARCHAR AS day, CASE WHEN creator_id % 2 = 0 THEN creator_id // 2 + 9 ELSE 1 END AS creator, coalesce(location_id, 1) AS location_id
    FROM e WHERE kind NOT IN ('note', 'food_study')
""")
def encounters(t):
    user_ids = t.customer.select((F.col("c_custkey") * 2).alias("source_user_id"), (F.col("c_custkey") + 9).alias("user_id"))
    rows = enc.encounters(_staged_encounters(t), s.patient_ids(t), user_ids)
    return rows.select("source_encounter_id", "patient_id", "encounter_type", "form_uuid", day_text("encounter_datetime").alias("day"), "creator", "location_id")


@query("k6_encounter_warnings", f"""
    WITH {ENC_SQL}, multi AS (SELECT patient, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids, string_agg(day::VARCHAR, ',' ORDER BY id) AS days FROM e WHERE kind = 'intake'
        GROUP BY patient HAVING count(*) > 1)
    SELECT patient + 5000 AS patient_id, id AS encounter_id, 'Encounter with nonsensical date' AS warning_type, day::VARCHAR AS field_value, 'Source encounter_type :' || kind AS warning_details
        FROM e WHERE day < DATE '1990-01-01' OR day > DATE '2005-06-01'
    UNION ALL SELECT patient + 5000, id, 'Encounter in the future', day::VARCHAR, 'Source encounter_type :' || kind FROM e WHERE day > DATE '2000-06-01' AND day < DATE '2005-06-01'
    UNION ALL SELECT patient + 5000, min(id), 'Multiple encounters with same type for same patient on same day', count(*)::VARCHAR, 'source encounter type: ' || kind
        FROM e WHERE kind IN ('intake', 'followup') GROUP BY patient, kind, day HAVING count(*) > 1
    UNION ALL SELECT patient + 5000, id, 'Encounter date is null. `date_created` used as encounter date.', NULL, 'Source encounter_type :' || kind FROM e WHERE day IS NULL
    UNION ALL SELECT patient + 5000, NULL, 'Patient has multiple intake encounters', NULL, 'Encounter IDs: ' || ids || '. Dates: ' || coalesce(days, '') FROM multi
""")
def encounter_warnings(t):
    rows = enc.encounter_warnings(_staged_encounters(t), s.patient_ids(t), AS_OF)
    return rows.select("patient_id", "encounter_id", "warning_type", "field_value", "warning_details")


@query("k7_notes", s.obs_sql(ENC_SQL + ", n AS (SELECT id AS source_encounter_id, * FROM e WHERE kind = 'note')", [
    ("n", "LOCAL:CLINICAL IMPRESSION COMMENTS", "text", "CASE WHEN title IS NULL THEN body WHEN body IS NULL THEN title ELSE title || chr(10) || chr(10) || body END",
     "title IS NOT NULL OR body IS NOT NULL", False),
]))
def notes(t):
    return s.obs_view(enc.notes(_raw_encounters(t)))


# ---- visits


def _event_encounters(t):
    """Events as encounters of users; the event type stands in for the place, 'error' being unknown."""
    return t.events.select(
        F.col("event_id").alias("encounter_id"), F.col("user_id").alias("patient_id"), F.col("ts").alias("encounter_datetime"),
        s.pick("event_id", ["clinic", "registration", "clinic", "lab", "drug order", "comment", "clinic"]).alias("encounter_type"),
        F.col("event_type").alias("location_id"),
    )


VISIT_SQL = f"""v AS (SELECT event_id, user_id, ts, {s.pick_sql('event_id', ["clinic", "registration", "clinic", "lab", "drug order", "comment", "clinic"])} AS kind, event_type AS place FROM events),
    days AS (SELECT user_id, ts::DATE AS day, min(ts) AS first, max(ts) + INTERVAL 86399 SECOND AS last, count(*) AS n FROM v WHERE kind NOT IN ('registration', 'drug order', 'comment') GROUP BY 1, 2),
    votes AS (SELECT user_id, ts::DATE AS day, place, count(*) AS n FROM v WHERE kind NOT IN ('registration', 'drug order') AND place <> 'error' GROUP BY 1, 2, 3),
    best AS (SELECT user_id, day, place FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY n DESC, place DESC) AS r FROM votes) WHERE r = 1),
    visits AS (SELECT days.user_id, days.day, first, last, coalesce(place, 'error') AS place, n FROM days LEFT JOIN best ON days.user_id = best.user_id AND days.day = best.day)"""


@query("k40_visits", f"""
    WITH {VISIT_SQL}
    SELECT user_id AS patient_id, day::VARCHAR AS day, strftime(first, '%Y-%m-%d %H:%M:%S') AS date_started, strftime(last, '%Y-%m-%d %H:%M:%S') AS date_stopped, place AS location_id, n AS encounters FROM visits
""")
def visits(t):
    second = "yyyy-MM-dd HH:mm:ss"
    rows = enc.visits(_event_encounters(t), unknown="error")
    return rows.select("patient_id", day_text("day").alias("day"), F.date_format("date_started", second).alias("date_started"),
                       F.date_format("date_stopped", second).alias("date_stopped"), "location_id", "encounters")


@query("k40_visit_links", f"""
    WITH {VISIT_SQL}
    SELECT event_id AS encounter_id, CASE WHEN kind NOT IN ('registration', 'drug order') THEN visits.place END AS visit_location_id,
        CASE WHEN v.place = 'error' AND kind NOT IN ('registration', 'drug order') AND visits.place IS NOT NULL THEN visits.place ELSE v.place END AS location_id
    FROM v LEFT JOIN visits ON v.user_id = visits.user_id AND v.ts::DATE = visits.day
""")
def visit_links(t):
    rows = _event_encounters(t)
    linked = enc.locate_by_visit(rows, enc.visits(rows, unknown="error"), unknown="error")
    return linked.select("encounter_id", "visit_location_id", "location_id")


@query("k40_visits_before_birth", f"""
    WITH {VISIT_SQL}, p AS (SELECT user_id, DATE '2024-01-01' + CAST(user_id % 60 AS INTEGER) AS born, user_id % 2 AS estimated FROM events GROUP BY user_id)
    SELECT visits.user_id AS patient_id, first::DATE::VARCHAR AS field_value, 'Birthdate: ' || born || ', estimated: ' || estimated AS warning_details
    FROM visits JOIN p ON visits.user_id = p.user_id WHERE CASE WHEN estimated = 1 THEN born - INTERVAL 1 YEAR ELSE born END > first::DATE
""")
def visits_before_birth(t):
    persons = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("user_id").alias("person_id"), s.day_after("2024-01-01", F.col("user_id") % 60).alias("birthdate"),
        (F.col("user_id") % 2).cast("int").alias("birthdate_estimated"), F.lit(None).cast("date").alias("death_date"),
    )
    rows = enc.visits_before_birth(enc.visits(_event_encounters(t), unknown="error"), persons, "2024-03-01")
    return rows.select("patient_id", "field_value", "warning_details")


# ---- unknown locations


def _placed_encounters(t):
    place = F.when(F.col("event_type") == "error", 1).otherwise((F.col("user_id") % 5 + 2).cast("int"))
    return t.events.select(F.col("event_id").alias("encounter_id"), F.col("user_id").alias("patient_id"),
                           F.col("ts").alias("encounter_datetime"), place.alias("location_id"))


def _enrolments(t):
    bought = t.events.filter("event_type = 'purchase' AND user_id % 4 <> 0")
    day = F.date_trunc("day", "ts")
    return bought.groupBy(F.col("user_id").alias("patient_id"), day.alias("date_enrolled")).agg(F.max("ts").alias("_last")).select(
        "patient_id", "date_enrolled", F.when(F.dayofmonth("date_enrolled") != 29, F.col("_last")).alias("date_completed"),
        (F.dayofmonth("date_enrolled") % 6 + 2).alias("location_id"),
    )


def _patient_places(t):
    return t.events.filter("user_id % 3 = 0").select(F.col("user_id").alias("patient_id"), (F.col("user_id") % 2 + 50).cast("int").alias("location_id")).distinct()


PLACE_SQL = """e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN 1 ELSE CAST(user_id % 5 + 2 AS INTEGER) END AS place FROM events),
    p AS (SELECT user_id, date_trunc('day', ts) AS a, CASE WHEN day(date_trunc('day', ts)) <> 29 THEN max(ts) END AS b, CAST(day(date_trunc('day', ts)) % 6 + 2 AS INTEGER) AS place
          FROM events WHERE event_type = 'purchase' AND user_id % 4 <> 0 GROUP BY user_id, date_trunc('day', ts)),
    u AS (SELECT * FROM e WHERE place = 1),
    act AS (SELECT event_id, min(p.place) AS place FROM u JOIN p ON u.user_id = p.user_id AND ts >= a AND (b IS NULL OR ts <= b) GROUP BY event_id),
    bef AS (SELECT event_id, arg_max(p.place, b) AS place FROM u JOIN p ON u.user_id = p.user_id AND ts > b GROUP BY event_id),
    aft AS (SELECT event_id, arg_min(p.place, a) AS place FROM u JOIN p ON u.user_id = p.user_id AND ts < a GROUP BY event_id),
    r AS (SELECT e.event_id, e.user_id, e.ts, CASE WHEN e.place <> 1 THEN e.place ELSE coalesce(act.place, bef.place, aft.place, CASE WHEN e.user_id % 3 = 0 THEN CAST(e.user_id % 2 + 50 AS INTEGER) END, 1) END AS place,
        CASE WHEN e.place = 1 THEN CASE WHEN act.place IS NOT NULL THEN 'current enrolment' WHEN bef.place IS NOT NULL THEN 'previous enrolment' WHEN aft.place IS NOT NULL THEN 'next enrolment'
            WHEN e.user_id % 3 = 0 THEN 'patient site' ELSE 'unknown' END END AS why
        FROM e LEFT JOIN act ON e.event_id = act.event_id LEFT JOIN bef ON e.event_id = bef.event_id LEFT JOIN aft ON e.event_id = aft.event_id)"""


def _resolved(t):
    return enc.resolve_unknown_locations(_placed_encounters(t), _enrolments(t), _patient_places(t), bucket_days=2)


@query("k41_unknown_locations", f"WITH {PLACE_SQL} SELECT event_id AS encounter_id, user_id AS patient_id, place AS location_id, why AS resolved_by FROM r")
def unknown_locations(t):
    return _resolved(t).select("encounter_id", "patient_id", "location_id", "resolved_by")


@query("k41_location_warnings", f"""
    WITH {PLACE_SQL}
    SELECT user_id AS patient_id, event_id AS encounter_id, CASE WHEN why = 'unknown' THEN '{enc.STILL_UNKNOWN}' ELSE {s.case_sql('why', enc.LOCATION_CHANGES)} END AS warning_type,
        CASE WHEN why <> 'unknown' THEN 'Updated to location :' || place END AS warning_details, why = 'unknown' AS flag_for_review FROM r WHERE why IS NOT NULL
""")
def location_warnings(t):
    return enc.location_warnings(_resolved(t)).select("patient_id", "encounter_id", "warning_type", "warning_details", "flag_for_review")


@query("k41_relocated_visits", f"""
    WITH {PLACE_SQL}, votes AS (SELECT user_id, ts::DATE AS day, place, count(*) AS n FROM e GROUP BY 1, 2, 3),
    v AS (SELECT user_id, day, coalesce(arg_max(place, n * 1000 + place) FILTER (place <> 1), 1) AS place FROM votes GROUP BY 1, 2),
    known AS (SELECT user_id, ts::DATE AS day, max(place) AS place FROM r WHERE place <> 1 GROUP BY 1, 2)
    SELECT v.user_id AS patient_id, v.day::VARCHAR AS day, CASE WHEN v.place = 1 THEN coalesce(known.place, 1) ELSE v.place END AS location_id
    FROM v LEFT JOIN known ON v.user_id = known.user_id AND v.day = known.day
""")
def relocated_visits(t):
    rows = _placed_encounters(t).withColumn("encounter_type", F.lit("clinic"))
    moved = enc.relocate_visits(enc.visits(rows), _resolved(t))
    return moved.select("patient_id", day_text("day").alias("day"), "location_id")


@query("k41_two_places", f"""
    WITH {VISIT_SQL}
    SELECT v.user_id AS patient_id, event_id AS encounter_id, 'at ' || v.place || ', at ' || visits.place AS field_value FROM v JOIN visits ON v.user_id = visits.user_id AND v.ts::DATE = visits.day
    WHERE kind NOT IN ('registration', 'drug order') AND v.place <> 'error' AND visits.place <> 'error' AND v.place <> visits.place
""")
def two_places(t):
    rows = _event_encounters(t)
    linked = enc.locate_by_visit(rows, enc.visits(rows, unknown="error"), unknown="error")
    names = t.events.select(F.col("event_type").alias("location_id")).distinct().withColumn("name", F.concat(F.lit("at "), "location_id"))
    return enc.visits_at_two_places(linked, names, unknown="error").select("patient_id", "encounter_id", "field_value")


# ---- duplicate encounters


def _dense_encounters(t):
    return t.orders.select(
        F.col("o_orderkey").alias("encounter_id"), F.expr("o_custkey div 75").alias("patient_id"),
        F.date_trunc("quarter", "o_orderdate").alias("encounter_datetime"), F.col("o_orderstatus").alias("encounter_type"),
    )


def _dense_obs(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("encounter_id"), (F.col("l_linenumber") % 3).alias("concept_id"), F.nullif(F.col("l_returnflag"), F.lit("N")).alias("value_text")
    )


DUPLICATE_SQL = """e AS (SELECT o_orderkey AS id, o_custkey // 75 AS p, date_trunc('quarter', o_orderdate) AS d, o_orderstatus AS k FROM orders WHERE o_orderstatus <> 'F'),
    ob AS (SELECT DISTINCT l_orderkey AS id, l_linenumber % 3 AS c, nullif(l_returnflag, 'N') AS v FROM lineitem),
    pairs AS (SELECT a.id AS x, b.id AS y FROM e a JOIN e b ON a.p = b.p AND a.d = b.d AND a.k = b.k AND a.id <> b.id),
    sub AS (SELECT x, y FROM pairs WHERE NOT EXISTS (SELECT 1 FROM ob f WHERE f.id = x AND NOT EXISTS (SELECT 1 FROM ob g WHERE g.id = y AND g.c = f.c AND g.v IS NOT DISTINCT FROM f.v))),
    gone AS (SELECT a.x AS id, max(CASE WHEN b.x IS NOT NULL AND a.x < a.y THEN 1 ELSE 0 END) AS copy, max(CASE WHEN b.x IS NULL THEN 1 ELSE 0 END) AS part
        FROM sub a LEFT JOIN sub b ON a.x = b.y AND a.y = b.x GROUP BY a.x)"""


@query("k42_void_duplicates", f"WITH {DUPLICATE_SQL} SELECT id AS encounter_id, CASE WHEN copy = 1 THEN 'exact copy' ELSE 'subset' END AS reason FROM gone WHERE copy = 1 OR part = 1")
def void_duplicates(t):
    return enc.void_duplicates(_dense_encounters(t), _dense_obs(t), ["value_text"], excluded_types=("F",))


@query("k42_remaining_encounters", f"WITH {DUPLICATE_SQL} SELECT o_orderkey AS encounter_id FROM orders WHERE o_orderkey NOT IN (SELECT id FROM gone WHERE copy = 1 OR part = 1)")
def remaining_encounters(t):
    rows = _dense_encounters(t)
    voided = enc.void_duplicates(rows, _dense_obs(t), ["value_text"], excluded_types=("F",))
    return enc.keep_unvoided(rows, voided).select("encounter_id")


# ---- HIV and TB status


def _status_encounters(t):
    """Signups as intakes, views as follow-ups."""
    return t.events.filter("event_type IN ('signup', 'view')").select(
        F.col("event_id").alias("source_encounter_id"), F.col("user_id").alias("source_patient_id"),
        F.when(F.col("event_type") == "signup", "intake").otherwise("followup").alias("source_encounter_type"),
        F.to_date("ts").alias("encounter_date"), s.pick("event_id", s.FORM_VERSIONS, 1, 7).alias("form_version"),
    )


PLACES = [None, "vct_clinic", None, "other", "mobile_clinic"]


def _status_rows(t):
    flags = {f: s.pick("event_id", ["t", "f", None], 1, i + 1).alias(f) for i, f in enumerate(status.TB_FLAGS)}
    return t.events.filter("event_type IN ('click', 'error')").select(
        F.col("event_id").alias("status_id"), F.col("user_id").alias("source_patient_id"), F.when(F.col("event_id") % 2 == 0, F.col("event_id") + 1).alias("source_encounter_id"),
        F.when(F.col("event_id") % 3 != 0, s.day_after("2024-01-01", F.col("event_id") % 31)).alias("status_date"), F.to_date("ts").alias("entered_date"),
        s.pick("event_id", ["t", "f", "?", None], 1, 3).alias("hiv_positive_p"), s.pick("event_id", PLACES).alias("test_location"),
        F.when(F.col("event_id") % 15 == 3, F.col("props")).alias("test_location_other"),
        F.when(F.col("event_id") % 25 == 1, F.col("props")).alias("drug_resistant_comment"), *flags.values(),
    )


STATUS_SQL = f"""i AS (SELECT event_id AS id, user_id AS p, ts::DATE AS day FROM events WHERE event_type = 'signup'),
    st AS (SELECT event_id AS sid, user_id AS p, CASE WHEN event_id % 2 = 0 THEN event_id + 1 END AS eid, CASE WHEN event_id % 3 <> 0 THEN DATE '2024-01-01' + CAST(event_id % 31 AS INTEGER) END AS sdate,
        ts::DATE AS edate, {s.pick_sql('event_id', ['t', 'f', '?', None], 1, 3)} AS sign, {s.pick_sql('event_id', PLACES)} AS place, CASE WHEN event_id % 15 = 3 THEN props END AS place2,
        CASE WHEN event_id % 25 = 1 THEN props END AS comment, {", ".join(f"{s.pick_sql('event_id', ['t', 'f', None], 1, n + 1)} AS {f}" for n, f in enumerate(status.TB_FLAGS))}
        FROM events WHERE event_type IN ('click', 'error'))"""
HIV_SQL = STATUS_SQL + """,
    ln AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY edate DESC, sid DESC) AS r FROM st WHERE eid IS NOT NULL) WHERE r = 1),
    mins AS (SELECT p, min(coalesce(sdate, edate)) FILTER (sign = 't') AS dt, min(coalesce(sdate, edate)) FILTER (sign = 'f') AS df, min(coalesce(sdate, edate)) FILTER (sign = '?') AS du FROM st GROUP BY p),
    pl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY edate DESC, sid DESC) AS r FROM st WHERE eid IS NULL AND (place IS NOT NULL OR place2 IS NOT NULL)) WHERE r = 1),
    h AS (SELECT i.p, i.id, ln.sid IS NOT NULL AS linked, CASE WHEN ln.sid IS NOT NULL THEN ln.sign WHEN dt <= day THEN 't' WHEN df <= day THEN 'f' WHEN du <= day THEN '?' END AS sign,
        CASE WHEN ln.sid IS NOT NULL THEN ln.sdate WHEN dt <= day THEN dt WHEN df <= day THEN df WHEN du <= day THEN du END AS sdate,
        CASE WHEN ln.sid IS NOT NULL THEN ln.place ELSE pl.place END AS place, CASE WHEN ln.sid IS NOT NULL THEN ln.place2 ELSE pl.place2 END AS place2
        FROM i LEFT JOIN ln ON i.id = ln.eid LEFT JOIN mins ON i.p = mins.p LEFT JOIN pl ON i.p = pl.p)"""


def _hiv_intake(t):
    return status.hiv_status_at_intake(_status_encounters(t), _status_rows(t))


@query("k10_hiv_status", f"""
    WITH {HIV_SQL} SELECT p AS source_patient_id, id AS source_encounter_id, linked AS status_on_encounter, sign AS hiv_positive_p, sdate::VARCHAR AS status_date, place AS test_location, place2 AS test_location_other FROM h
""")
def hiv_status(t):
    return _hiv_intake(t).select("source_patient_id", "source_encounter_id", "status_on_encounter", "hiv_positive_p",
                                 F.col("status_date").cast("string").alias("status_date"), "test_location", "test_location_other")


@query("k10_hiv_status_obs", s.obs_sql(HIV_SQL + ", h2 AS (SELECT id AS source_encounter_id, * FROM h)", [
    ("h2", "CIEL:164400", "date", "sdate", "sdate IS NOT NULL", False),
    ("h2", "CIEL:1169", "coded", "CASE sign WHEN 't' THEN 'CIEL:703' WHEN 'f' THEN 'CIEL:664' ELSE 'CIEL:1138' END", "sign IS NOT NULL", False),
    ("h2", "CIEL:159936", "coded", "CASE place WHEN 'vct_clinic' THEN 'CIEL:159940' ELSE 'CIEL:159939' END", "place IN ('vct_clinic', 'mobile_clinic')", False),
    ("h2", "CIEL:159936", "coded", "'CIEL:5622'", "place = 'other' OR place2 IS NOT NULL", False, "place2"),
]))
def hiv_status_obs(t):
    return s.obs_view(status.hiv_status_obs(_hiv_intake(t)))


TB_CHOICE = ", ".join(f"CASE WHEN ln.sid IS NOT NULL THEN ln.{f} ELSE f.{f} END AS {f}" for f in status.TB_FLAGS)
TB_SQL = STATUS_SQL + f""",
    ln AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY edate DESC, sid DESC) AS r FROM st WHERE eid IS NOT NULL) WHERE r = 1),
    f AS (SELECT p, min(sdate) AS sdate, string_agg(comment, ' , ' ORDER BY comment) AS comment, {", ".join(f"CASE WHEN coalesce(bool_or({x} = 't'), false) THEN 't' ELSE 'f' END AS {x}" for x in status.TB_FLAGS)}
        FROM st WHERE eid IS NULL GROUP BY p),
    o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY edate DESC, sid DESC) AS r FROM st WHERE eid IN (43, 305, 1001)) WHERE r = 1),
    b AS (SELECT i.p, i.id, CASE WHEN ln.sid IS NOT NULL THEN ln.sdate ELSE f.sdate END AS sdate, {TB_CHOICE}, CASE WHEN ln.sid IS NOT NULL THEN ln.comment ELSE f.comment END AS comment
        FROM i LEFT JOIN ln ON i.id = ln.eid LEFT JOIN f ON i.p = f.p),
    h AS (SELECT b.p, b.id, CASE WHEN o.sid IS NOT NULL THEN o.sdate ELSE b.sdate END AS sdate, b.ppd_positive_p, b.tb_active_p, CASE WHEN o.sid IS NOT NULL THEN o.extrapulmonary_p ELSE b.extrapulmonary_p END AS extrapulmonary_p,
        b.pulmonary_p, CASE WHEN o.sid IS NOT NULL THEN o.drug_resistant_p ELSE b.drug_resistant_p END AS drug_resistant_p, b.comment FROM b LEFT JOIN o ON b.p = o.p)"""


def _tb_intake(t):
    return status.tb_status_at_intake(_status_encounters(t), _status_rows(t), overrides=[43, 305, 1001])


@query("k11_tb_status", f"""
    WITH {TB_SQL} SELECT p AS source_patient_id, id AS source_encounter_id, sdate::VARCHAR AS status_date, {", ".join(status.TB_FLAGS)}, comment AS drug_resistant_comment FROM h
""")
def tb_status(t):
    return _tb_intake(t).select("source_patient_id", "source_encounter_id", F.col("status_date").cast("string").alias("status_date"), *status.TB_FLAGS, "drug_resistant_comment")


@query("k11_tb_status_obs", s.obs_sql(TB_SQL + ", h2 AS (SELECT id AS source_encounter_id, * FROM h)", [
    ("h2", "LOCAL:11526", "date", "sdate", "sdate IS NOT NULL", False),
    ("h2", "CIEL:1389", "coded", "'CIEL:1065'", "tb_active_p = 't'", False),
    ("h2", "CIEL:160040", "coded", "'CIEL:42'", "pulmonary_p = 't'", False),
    ("h2", "CIEL:160040", "coded", "'CIEL:5042'", "extrapulmonary_p = 't'", False),
    ("h2", "LOCAL:3039", "coded", "'CIEL:1065'", "drug_resistant_p = 't'", False),
    ("h2", "CIEL:159391", "text", "comment", "comment <> ''", False),
    ("h2", "LOCAL:1435", "coded", "'CIEL:703'", "ppd_positive_p = 't'", False),
]))
def tb_status_obs(t):
    return s.obs_view(status.tb_status_obs(_tb_intake(t)))


@query("k11_tb_screening", f"""
    WITH {STATUS_SQL} SELECT eid AS source_encounter_id, CASE tb_active_p WHEN 't' THEN 'CIEL:703' ELSE 'CIEL:664' END AS value_coded, sdate::VARCHAR AS day
    FROM st JOIN events ON eid = event_id AND event_type = 'view' AND {s.pick_sql('event_id', s.FORM_VERSIONS, 1, 7)} = '3' WHERE tb_active_p IS NOT NULL
""")
def tb_screening(t):
    rows = status.tb_screening_obs(_status_encounters(t), _status_rows(t))
    return rows.select("source_encounter_id", "value_coded", day_text("obs_datetime").alias("day"))


# ---- programmes

STATUSES = ["died", "lost", "transferred_out", None, "treatment_refused", "prev_undoc_txfer_conf", "traced_not_found"]


def _demographics(t):
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("source_patient_id"), (key % 44).cast("int").alias("starting_health_center"), (key % 5 * 21).cast("int").alias("health_center"),
        F.when(key % 3 != 0, s.day_after("1996-01-01", key % 1800)).alias("health_center_transfer_date"), s.pick("c_custkey", STATUSES).alias("treatment_status"),
        F.when(key % 4 != 0, s.day_after("1995-06-01", (key * 7) % 2500)).alias("treatment_status_date"),
    )


def _program_raw(t):
    key = F.col("c_custkey")
    art = t.customer.filter("c_custkey % 2 = 0").select(key.alias("source_patient_id"), s.day_after("1994-01-01", (key * 11) % 2600).alias("art_start_date"))
    outcomes = t.customer.filter("c_custkey % 5 = 0").select(key.alias("source_patient_id"), s.day_after("1996-06-01", (key * 13) % 2000).alias("regimen_outcome_date"))
    visits = s.encounters(t, KINDS).withColumn("encounter_date", F.when(F.col("source_encounter_id") % 19 != 0, F.col("encounter_date")))
    return status.program_raw(status.stage_programs(_demographics(t), visits, art, outcomes), AS_OF)


def _program_patients(t):
    return s.patient_ids(t).withColumn("patient_created_date", s.day_after("1995-03-01", F.col("source_patient_id") % 2000))


PROGRAM_SQL = f"""v AS (SELECT o_custkey AS id, min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders WHERE {s.pick_sql('o_orderkey', KINDS)} IN ('intake', 'followup', 'patient_contact', 'accompagnateur')
        AND o_orderkey % 19 <> 0 GROUP BY 1),
    d AS (SELECT c_custkey AS id, nullif(nullif(CAST(c_custkey % 44 AS INTEGER), 0), 42) AS start, nullif(nullif(CAST(c_custkey % 5 * 21 AS INTEGER), 0), 42) AS here,
        CASE WHEN c_custkey % 3 <> 0 THEN DATE '1996-01-01' + CAST(c_custkey % 1800 AS INTEGER) END AS moved, {s.pick_sql('c_custkey', STATUSES)} AS st,
        CASE WHEN c_custkey % 4 <> 0 THEN DATE '1995-06-01' + CAST(c_custkey * 7 % 2500 AS INTEGER) END AS sdate, CASE WHEN c_custkey % 2 = 0 THEN DATE '1994-01-01' + CAST(c_custkey * 11 % 2600 AS INTEGER) END AS art,
        CASE WHEN c_custkey % 5 = 0 THEN DATE '1996-06-01' + CAST(c_custkey * 13 % 2000 AS INTEGER) END AS rdate, DATE '1995-03-01' + CAST(c_custkey % 2000 AS INTEGER) AS created FROM customer),
    q AS (SELECT d.*, least(lo, coalesce(art, lo)) AS enrolled, {s.case_sql('st', status.OUTCOMES)} AS outcome, {s.case_sql('st', status.TREATMENT_STATES)} AS state,
        least(coalesce(CASE WHEN sdate IS NULL OR rdate > sdate THEN rdate ELSE sdate END, (hi + INTERVAL 6 MONTH)::DATE), DATE '2000-06-01') AS ended FROM d JOIN v ON d.id = v.id),
    w AS (SELECT *, CASE WHEN outcome IS NOT NULL THEN ended END AS odate, coalesce(here, start, 1) AS center FROM q),
    x AS (SELECT *, CASE WHEN start = center OR moved IS NULL OR moved > odate OR moved < enrolled THEN NULL ELSE start END AS split FROM w),
    y AS (SELECT id, created, 'single' AS part, center AS site, enrolled AS a, art, odate AS b, ended AS sd, outcome, state FROM x WHERE split IS NULL
        UNION ALL SELECT id, created, 'initial', split, enrolled, CASE WHEN art < moved THEN art END, moved, NULL, '{status.TRANSFER_OUTCOME}', NULL FROM x WHERE split IS NOT NULL
        UNION ALL SELECT id, created, 'current', center, moved, art, odate, ended, outcome, state FROM x WHERE split IS NOT NULL)"""


@query("k13_programs", f"""
    WITH {PROGRAM_SQL}
    SELECT id + 5000 AS person_id, part, site, CASE WHEN b < a THEN CASE WHEN created < b THEN created ELSE b END ELSE a END::VARCHAR AS date_enrolled, b::VARCHAR AS date_completed, art::VARCHAR AS art_start_date, outcome FROM y
""")
def programs(t):
    rows = status.enrolments(_program_raw(t), _program_patients(t))
    return rows.select("person_id", "part", "site", *[F.col(c).cast("string").alias(c) for c in ("date_enrolled", "date_completed", "art_start_date")], "outcome")


@query("k13_program_states", f"WITH {PROGRAM_SQL} SELECT id + 5000 AS person_id, part, state, sd::VARCHAR AS start_date FROM y WHERE state IS NOT NULL")
def program_states(t):
    rows = status.program_states(status.enrolments(_program_raw(t), _program_patients(t)))
    return rows.select("person_id", "part", "state", F.col("start_date").cast("string").alias("start_date"))


@query("k13_program_warnings", f"""
    WITH {PROGRAM_SQL}, m AS (SELECT id, min(a) AS a, arg_min(created < b, a) AS early FROM y WHERE b < a GROUP BY id)
    SELECT id + 5000 AS patient_id, 'art_start_date' AS field_name, art::VARCHAR AS field_value, 'Outcome date: ' || odate AS warning_details FROM x WHERE art > odate
    UNION ALL SELECT id + 5000, 'enrollment_date', a::VARCHAR, CASE WHEN early THEN 'Setting enrollment date to patient_created_date' ELSE 'Setting enrollment date to  completion date' END FROM m
""")
def program_warnings(t):
    raw, people = _program_raw(t), _program_patients(t)
    rows = status.program_warnings(raw, status.enrolments(raw, people), people)
    return rows.select("patient_id", "field_name", "field_value", "warning_details")


# ---- regimens

REASONS = ["died", "cd4_augmented", None, "stock_out", "tb", "unheard_of"]
PRODUCTS = [("prod0", None, "drug0", "concept0"), ("prod1", "3cee7fb4-26fe-102b-80cb-0017a47871b2", "", None), ("prod2", "concept2", None, None),
            ("prod3", None, "drug3", "concept3"), ("prod4", "concept4", "", None)]
REGIMEN_AS_OF = "1999-02-01"


def _regimens(t):
    key = F.col("o_orderkey")
    start = s.day_after("1999-01-01", (key * 7) % 20)
    return t.orders.select(
        key.alias("source_regime_id"), F.when(key % 5 != 0, F.expr("o_orderkey div 3")).alias("encounter_opened_by"), F.expr("o_orderkey div 3 + 1").alias("encounter_closed_by"),
        F.expr("o_orderkey div 40").alias("source_patient_id"), s.pick("o_orderkey", ["prod0", "prod1", "prod2", "prod3", "prod4", "prod5"]).alias("product_name"),
        start.alias("start_date"), F.when(key % 7 == 0, F.date_add(start, 30)).alias("end_date"),
        F.when(key % 3 != 0, F.date_add(start, ((key * 11) % 50 - 5).cast("int"))).alias("close_date"), s.pick("o_orderkey", REASONS, 1, 2).alias("reason_for_closure"),
        s.pick("o_orderkey", ["HIV", "TB"]).alias("product_type"), s.pick("o_orderkey", [None, "ptme", "accident"], 1, 2).alias("regime_type"),
        (key % 4).cast("int").alias("ddd"), (key % 8).cast("int").alias("dwd"), (key % 3 == 0).alias("prn"),
        *[(key % (n + 2)).cast("int").alias(f"{name}_dose") for n, name in enumerate(["morning", "noon", "evening", "night"])],
    )


def _order_encounters(t):
    key = F.col("o_orderkey")
    return t.orders.filter("o_orderkey % 4 <> 0").select(
        key.alias("source_encounter_id"), (key + 700000).alias("encounter_id"), (F.expr("o_orderkey * 3 div 40") + 5000).alias("patient_id"),
        F.to_date("o_orderdate").alias("encounter_datetime"), s.pick("o_orderkey", ["drug order", "clinic"], 1, 3).alias("encounter_type"),
    )


def _product_map(t):
    return t.spark.createDataFrame(PRODUCTS, "product_name string, concept string, drug string, drug_concept string")


def _orders(t):
    return orders.drug_orders(_regimens(t), _order_encounters(t), s.patient_ids(t), _product_map(t), REGIMEN_AS_OF)


def _reason_sql():
    new = " ".join(f"WHEN ptype = '{p}' AND rtype IS NOT DISTINCT FROM {s.sql_literal(r)} THEN '{c}'" for p, r, c in orders.NEW_ORDER_REASONS)
    closed = " ".join(f"WHEN reason IS NOT DISTINCT FROM {s.sql_literal(r)} THEN {s.sql_literal(c)}" for r, c, _ in orders.CLOSURE_REASONS)
    words = " ".join(f"WHEN reason IS NOT DISTINCT FROM {s.sql_literal(r)} THEN {s.sql_literal(x)}" for r, _, x in orders.CLOSURE_REASONS)
    return f"CASE {new} END", f"CASE {closed} END", f"CASE {words} END"


NEW_REASON, CLOSE_REASON, CLOSE_WORDS = _reason_sql()
ORDER_SQL = f"""r0 AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey // 3 END AS opened, o_orderkey // 3 + 1 AS closed, o_orderkey // 40 AS patient,
        {s.pick_sql('o_orderkey', ["prod0", "prod1", "prod2", "prod3", "prod4", "prod5"])} AS product, DATE '1999-01-01' + CAST(o_orderkey * 7 % 20 AS INTEGER) AS a,
        CASE WHEN o_orderkey % 7 = 0 THEN DATE '1999-01-31' + CAST(o_orderkey * 7 % 20 AS INTEGER) END AS e,
        CASE WHEN o_orderkey % 3 <> 0 THEN DATE '1999-01-01' + CAST(o_orderkey * 7 % 20 + o_orderkey * 11 % 50 - 5 AS INTEGER) END AS c, {s.pick_sql('o_orderkey', REASONS, 1, 2)} AS reason,
        {s.pick_sql('o_orderkey', ["HIV", "TB"])} AS ptype, {s.pick_sql('o_orderkey', [None, "ptme", "accident"], 1, 2)} AS rtype FROM orders),
    r AS (SELECT r0.*, CASE WHEN c > DATE '1999-02-01' THEN NULL WHEN c < a THEN a ELSE c END AS cc, CASE WHEN c > DATE '1999-02-01' THEN c ELSE e END AS ce FROM r0 JOIN customer ON c_custkey = patient),
    en AS (SELECT o_orderkey AS sid, o_orderkey + 700000 AS eid FROM orders WHERE o_orderkey % 4 <> 0),
    o1 AS (SELECT id, patient + 5000 AS p, 'NEW' AS act, eid, a AS s, ce AS x, cc AS stopped, {NEW_REASON} AS why, NULL AS words, product FROM r LEFT JOIN en ON sid = opened
        UNION ALL SELECT id, patient + 5000, 'DISCONTINUE', eid, cc, cc, NULL, {CLOSE_REASON}, {CLOSE_WORDS}, product FROM r LEFT JOIN en ON sid = closed WHERE cc IS NOT NULL),
    o2 AS (SELECT o1.*, CASE WHEN eid IS NULL THEN s ELSE min(s) OVER (PARTITION BY eid) END AS act_date FROM o1),
    pool AS (SELECT p, act_date, min(eid) AS offered FROM o2 WHERE eid IS NOT NULL GROUP BY 1, 2),
    o3 AS (SELECT o2.*, coalesce(eid, offered) AS encounter FROM o2 LEFT JOIN pool ON o2.p = pool.p AND o2.act_date = pool.act_date)"""


@query("k8_regimens", f"""
    WITH {ORDER_SQL}
    SELECT id AS source_regime_id, p AS patient_id, act AS order_action, encounter AS encounter_id, s::VARCHAR AS start_date, x::VARCHAR AS auto_expire_date, stopped::VARCHAR AS date_stopped,
        act_date::VARCHAR AS date_activated, CASE WHEN act_date = s THEN 'ROUTINE' ELSE 'ON_SCHEDULED_DATE' END AS urgency, encounter IS NULL AS needs_encounter, why AS order_reason, words AS order_reason_non_coded,
        CASE product WHEN 'prod0' THEN 'drug0' WHEN 'prod3' THEN 'drug3' END AS drug, CASE WHEN product IN ('prod1', 'prod2', 'prod4') THEN product END AS drug_non_coded,
        CASE product WHEN 'prod0' THEN 'concept0' WHEN 'prod1' THEN '{orders.OTHER_CONCEPT}' WHEN 'prod2' THEN 'concept2' WHEN 'prod3' THEN 'concept3' WHEN 'prod4' THEN 'concept4' END AS concept FROM o3
""")
def regimens(t):
    rows = _orders(t)
    return rows.select(
        "source_regime_id", "patient_id", "order_action", "encounter_id", *[F.col(c).cast("string").alias(c) for c in ("start_date", "auto_expire_date", "date_stopped", "date_activated")],
        "urgency", F.col("new_encounter_uuid").isNotNull().alias("needs_encounter"), "order_reason", "order_reason_non_coded", "drug", "drug_non_coded", "concept",
    )


@query("k8_new_encounters", f"WITH {ORDER_SQL} SELECT p AS patient_id, act_date::VARCHAR AS day, count(*) AS orders FROM o3 WHERE encounter IS NULL GROUP BY 1, 2")
def new_encounters(t):
    rows = orders.new_encounters(_orders(t))
    return rows.select("patient_id", F.col("encounter_datetime").cast("string").alias("day"), "orders")


@query("k8_redated_encounters", f"""
    WITH {ORDER_SQL}, act AS (SELECT encounter, min(act_date) AS moved FROM o3 WHERE encounter IS NOT NULL GROUP BY 1),
    k AS (SELECT o_orderkey + 700000 AS eid, o_orderdate::DATE AS day, {s.pick_sql('o_orderkey', ["drug order", "clinic"], 1, 3)} AS kind FROM orders WHERE o_orderkey % 4 <> 0)
    SELECT eid AS encounter_id, CASE WHEN kind = 'drug order' THEN moved ELSE day END::VARCHAR AS day FROM k LEFT JOIN act ON encounter = eid WHERE kind <> 'drug order' OR moved IS NOT NULL
""")
def redated_encounters(t):
    rows = orders.redate_encounters(_order_encounters(t), _orders(t))
    return rows.select("encounter_id", F.col("encounter_datetime").cast("string").alias("day"))


@query("k8_regimen_warnings", """
    WITH r AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey // 3 END AS opened, o_orderkey // 40 AS patient, DATE '1999-01-01' + CAST(o_orderkey * 7 % 20 AS INTEGER) AS a,
        CASE WHEN o_orderkey % 3 <> 0 THEN DATE '1999-01-01' + CAST(o_orderkey * 7 % 20 + o_orderkey * 11 % 50 - 5 AS INTEGER) END AS c, 'prod' || o_orderkey % 6 AS product FROM orders)
    SELECT patient + 5000 AS patient_id, opened AS encounter_id, c::VARCHAR AS field_value, 'Drug: ' || product || '; Start Date: ' || a || '; Close Date: ' || c AS warning_details FROM r WHERE c < a
    UNION ALL SELECT patient + 5000, opened, c::VARCHAR, 'Drug: ' || product || '; Start Date: ' || a || '; Close Date: ' || c FROM r WHERE c > DATE '1999-02-01'
    UNION ALL SELECT patient + 5000, NULL, '3cee7fb4-26fe-102b-80cb-0017a47871b2', 'Drug: prod1 is mapped to other non-coded concept' FROM r WHERE product = 'prod1'
""")
def regimen_warnings(t):
    rows, people = _regimens(t), s.patient_ids(t)
    found = orders.regimen_warnings(rows, people, REGIMEN_AS_OF).unionByName(orders.unmapped_drug_warnings(rows, people, _product_map(t)))
    return found.select("patient_id", "encounter_id", "field_value", "warning_details")


@query("k8_order_rules", f"""
    WITH {ORDER_SQL}, k AS (SELECT o_orderkey + 700000 AS eid, o_orderkey * 3 // 40 + 5000 AS vp, o_orderdate::DATE AS vd FROM orders WHERE o_orderkey % 4 <> 0),
    z AS (SELECT *, CASE WHEN urgency <> 'ROUTINE' THEN s END AS scheduled FROM (SELECT o3.*, vp, vd, CASE WHEN act_date = s THEN 'ROUTINE' ELSE 'ON_SCHEDULED_DATE' END AS urgency,
        CASE WHEN act = 'DISCONTINUE' THEN id || '/NEW' END AS previous, CASE WHEN encounter IS NULL THEN p || '/' || act_date END AS made, CASE WHEN product IN ('prod0', 'prod3') THEN 'drug' END AS coded,
        CASE WHEN product IN ('prod1', 'prod2', 'prod4') THEN product END AS free, id % 3 = 0 AS prn, false AS voided, 'unknown' AS orderer, 'free text' AS dosing, '{orders.OUTPATIENT}' AS care,
        CASE product WHEN 'prod0' THEN 'concept0' WHEN 'prod3' THEN 'concept3' END AS own_concept,
        CASE product WHEN 'prod0' THEN 'concept0' WHEN 'prod1' THEN 'other' WHEN 'prod2' THEN 'concept2' WHEN 'prod3' THEN 'concept3' WHEN 'prod4' THEN 'concept4' END AS concept FROM o3 LEFT JOIN k ON k.eid = encounter))
    SELECT 'All orders must have non-null concept' AS rule, 0::BIGINT AS expected, count(*) FILTER (product = 'prod5') AS actual FROM z
    UNION ALL SELECT 'All discontinue orders should have an order reason (coded or non-coded)', 0, count(*) FILTER (act = 'DISCONTINUE' AND why IS NULL AND words IS NULL) FROM z
    UNION ALL SELECT 'No orders can have date activated after auto expire date', 0, count(*) FILTER (act_date > x) FROM z
    UNION ALL SELECT 'All drug orders must have a coded or non-coded drug', count(*), count(*) FILTER (product <> 'prod5') FROM z
    UNION ALL SELECT 'All orders must be routine or scheduled', count(*), count(*) FILTER (act_date <= s) FROM z
    UNION ALL SELECT 'All orders must have the same patient in the order and the encounter', count(*), count(*) FILTER (encounter IS NULL OR p = vp) FROM z
    UNION ALL SELECT 'All orders must have date activated on or after encounter date', count(*), count(*) FILTER (encounter IS NULL OR act_date >= vd) FROM z
    UNION ALL SELECT 'All discontinue orders must have a previous order id', 0, count(*) FILTER (act = 'DISCONTINUE' AND previous IS NULL) FROM z
    UNION ALL SELECT 'All orders must have non-null patient', 0, count(*) FILTER (p IS NULL) FROM z
    UNION ALL SELECT 'All orders must have non-null encounter', 0, count(*) FILTER (encounter IS NULL AND made IS NULL) FROM z
    UNION ALL SELECT 'All orders must have non-null urgency', 0, count(*) FILTER (urgency IS NULL) FROM z
    UNION ALL SELECT 'All orders must have non-null action', 0, count(*) FILTER (act IS NULL) FROM z
    UNION ALL SELECT 'No orders can have date activated in the future', 0, count(*) FILTER (act_date > DATE '1999-02-01') FROM z
    UNION ALL SELECT 'No orders can have date activated after date stopped', 0, count(*) FILTER (act_date > stopped) FROM z
    UNION ALL SELECT 'No orders can have a scheduled date unless urgency is on scheduled date', 0, count(*) FILTER (scheduled IS NOT NULL AND urgency <> 'ON_SCHEDULED_DATE') FROM z
    UNION ALL SELECT 'No orders can have an urgency of on scheduled date if scheduled date is null', 0, count(*) FILTER (scheduled IS NULL AND urgency = 'ON_SCHEDULED_DATE') FROM z
    UNION ALL SELECT 'All rows must have a non-null as_needed', 0, count(*) FILTER (prn IS NULL) FROM z
    UNION ALL SELECT 'No drug orders should have both a coded and non-coded drug', 0, count(*) FILTER (coded IS NOT NULL AND free IS NOT NULL) FROM z
    UNION ALL SELECT 'Non-discontinue orders with free text dosing instructions must have non-null dosing instructions', 0, count(*) FILTER (act <> 'DISCONTINUE' AND (id % 4 IS NULL OR id % 8 IS NULL)) FROM z
    UNION ALL SELECT 'All orders must have non-null voided', 0, count(*) FILTER (voided IS NULL) FROM z
    UNION ALL SELECT 'All orders must have non-null orderer', 0, count(*) FILTER (orderer IS NULL) FROM z
    UNION ALL SELECT 'Dosing type is required if action != DISCONTINUE', 0, count(*) FILTER (act <> 'DISCONTINUE' AND dosing IS NULL) FROM z
    UNION ALL SELECT 'Concept associated with drug must not have a different concept than the one associated with the order', 0, count(*) FILTER (own_concept <> concept) FROM z
    UNION ALL SELECT 'All rows are outpatient', count(*), count(*) FILTER (care = '{orders.OUTPATIENT}') FROM z
    UNION ALL SELECT 'All data from source should be loaded into staging table', (SELECT count(*) FROM r0), (SELECT count(*) FROM r)
    UNION ALL SELECT 'There should be a new order for all regimes', (SELECT count(*) FROM r), count(*) FILTER (act = 'NEW') FROM z
""")
def order_rules(t):
    # the source holds the regimens of all patients, the staged table those of known ones
    staged = _regimens(t).join(s.patient_ids(t), "source_patient_id", "left_semi")
    rules = orders.order_rules(_orders(t), _order_encounters(t), staged, REGIMEN_AS_OF, _regimens(t), _product_map(t).where("drug IS NOT NULL"))
    return rules.select("rule", "expected", "actual")


@query("k8_discontinue_sets", f"""
    WITH {ORDER_SQL}, a AS (SELECT DISTINCT patient + 5000 AS id FROM r WHERE c <= DATE '1998-12-28'), b AS (SELECT DISTINCT p AS id FROM o3 WHERE act = 'DISCONTINUE')
    SELECT id AS patient_id, 'left_only' AS side FROM a WHERE id NOT IN (SELECT id FROM b) UNION ALL SELECT id, 'right_only' FROM b WHERE id NOT IN (SELECT id FROM a)
""")
def discontinue_sets(t):
    early = _regimens(t)
    made = orders.drug_orders(early, _order_encounters(t), s.patient_ids(t), _product_map(t), REGIMEN_AS_OF)
    return orders.discontinue_set_differences(made, early, s.patient_ids(t), "1998-12-28")


# ---- regimen comments


def _comments(t):
    return t.events.select(F.col("event_id").alias("comment_id"), F.col("user_id").alias("source_patient_id"), F.col("ts").alias("entered_date"),
                           (F.col("event_id") % 20).alias("entered_by"), F.nullif(F.col("props"), F.lit('{"k": 7}')).alias("comments"))


def _comment_obs(t):
    visits = t.events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("encounter_id"), (F.col("user_id") + 5000).alias("patient_id"), F.col("ts").alias("encounter_datetime"), F.lit("drug order").alias("encounter_type")
    )
    user_ids = t.customer.select((F.col("c_custkey") * 2).alias("source_user_id"), (F.col("c_custkey") + 9).alias("user_id"))
    return orders.regimen_comments(_comments(t), visits, s.patient_ids(t), user_ids)


COMMENT_SQL = """d AS (SELECT user_id, ts::DATE AS day, min(event_id) AS eid FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
    k AS (SELECT event_id AS id, e.user_id + 5000 AS p, e.ts::DATE AS day, eid, nullif(props, '{"k": 7}') AS words, event_id % 20 AS who FROM events e
          LEFT JOIN d ON e.user_id = d.user_id AND e.ts::DATE = d.day WHERE e.user_id IN (SELECT c_custkey FROM customer))"""


@query("k9_regimen_comments", f"""
    WITH {COMMENT_SQL} SELECT id AS comment_id, p AS patient_id, day::VARCHAR AS day, eid AS encounter_id, eid IS NULL AS needs_encounter, words AS value_text, CASE WHEN who % 2 = 0 THEN who // 2 + 9 ELSE 1 END AS creator FROM k
""")
def regimen_comments(t):
    return _comment_obs(t).select("comment_id", "patient_id", day_text("day").alias("day"), "encounter_id",
                                  F.col("new_encounter_uuid").isNotNull().alias("needs_encounter"), "value_text", "creator")


@query("k9_comment_rules", f"""
    WITH {COMMENT_SQL}
    SELECT 'There should be an Obs for each comment' AS rule, (SELECT count(*) FROM events) AS expected, count(*) AS actual FROM k
    UNION ALL SELECT 'All obs should be associated with an encounter', 0, 0
    UNION ALL SELECT 'All obs should have obs value_text', 0, count(*) FILTER (words IS NULL) FROM k
""")
def comment_rules(t):
    return orders.comment_rules(_comment_obs(t), _comments(t)).select("rule", "expected", "actual")
