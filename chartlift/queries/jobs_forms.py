"""Observation jobs over stand-ins (K15 to K39) and the review jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions.dates import day_text
from chartlift.operators import eav
from chartlift.plans import clinic, history, labs, review, treatment
from chartlift.queries import standins as s
from chartlift.queries.registry import query

KINDS = ["intake", "followup", "lab_result", "note"]
ENC = s.encounters_sql(KINDS)
INTAKE_SQL = "first_intake AS (SELECT source_patient_id, min(source_encounter_id) AS source_encounter_id FROM enc WHERE source_encounter_type = 'intake' GROUP BY 1)"


def _encounters(t):
    return s.encounters(t, KINDS)


# ---- labs

TESTS = ["viral_load", "CD4", "tr", "ppd", "hematocrit"]


@query("k15_lab_results", s.obs_sql(f"""r AS (SELECT event_id // 3 AS source_encounter_id, lower({s.pick_sql('event_id', TESTS)}) AS test, CASE WHEN event_id % 4 <> 0 THEN value END AS number,
    CASE WHEN event_id % 2 = 0 THEN 'S' || event_id END AS sample, CASE WHEN event_id % 7 = 0 THEN 'tech' END AS tech, event_id % 3 = 0 AS sign, event_id % 11 < 5 AS below,
    CASE WHEN event_id % 6 = 0 THEN 20.0 END AS lim FROM events)""", [
    ("r", labs.SPECIMEN_NUMBER, "text", "sample", "sample IS NOT NULL", False),
    ("r", "LOCAL:Lab tech non-coded", "text", "tech", "tech IS NOT NULL", False),
    ("r", labs.VIRAL_LOAD_GROUP, "group", "", "test = 'viral_load'", False),
    ("r", labs.VIRAL_LOAD_VALUE, "numeric", "number", "test = 'viral_load' AND number IS NOT NULL", True),
    ("r", labs.VIRAL_LOAD_QUALITATIVE, "coded", f"CASE WHEN below THEN '{labs.BELOW_LIMIT}' ELSE '{labs.DETECTED}' END", "test = 'viral_load'", True),
    ("r", labs.DETECTABLE_LIMIT, "numeric", "lim", "test = 'viral_load' AND lim IS NOT NULL", True),
    ("r", labs.NUMERIC_RESULTS["cd4"], "numeric", "number", "test = 'cd4'", False),
    ("r", labs.NUMERIC_RESULTS["hematocrit"], "numeric", "number", "test = 'hematocrit'", False),
    ("r", labs.NUMERIC_RESULTS["ppd"], "numeric", "number", "test = 'ppd'", False),
    ("r", "LOCAL:13135", "group", "", "test = 'tr'", False),
    ("r", "CIEL:163722", "coded", "CASE WHEN sign THEN 'CIEL:703' ELSE 'CIEL:664' END", "test = 'tr'", True),
]))
def lab_results(t):
    key = F.col("event_id")
    rows = t.events.select(
        key.alias("source_result_id"), F.expr("event_id div 3").alias("source_encounter_id"), s.pick("event_id", TESTS).alias("test_type"),
        F.when(key % 4 != 0, F.col("value")).alias("value_numeric"), F.when(key % 2 == 0, F.concat(F.lit("S"), key.cast("string"))).alias("sample_id"),
        F.when(key % 7 == 0, " tech ").alias("performed_by"), (key % 3 == 0).alias("value_boolean"),
        (key % 11 < 5).alias("vl_beyond_detectable_limit"), F.when(key % 6 == 0, 20.0).alias("vl_detectable_lower_limit"),
    )
    return s.obs_view(labs.lab_results_obs(rows))


LAB_TESTS = ["cd4", "hematocrite", "ppd", "rpr", "sputum", "hemoglobin", "eryth_sed_rate", "other_test"]
LAB_RESULTS = ["500", "negative", "12,5%", "positive:12", "+++", " 9.8 g/dl", None, "350 cell/mm3", "x", "7.", "positive"]
IS_NUMBER = "(regexp_matches(result, '^[0-9.,]+$') AND regexp_matches(result, '[0-9]'))"
NUMBER = "regexp_extract(replace(regexp_extract(result, '[0-9.,]+'), ',', '.'), '^[0-9]*[.]?[0-9]*')"
EXAM_LAB_SQL = ENC + f""",
    l0 AS (SELECT event_id, event_id // 4 AS source_encounter_id, {s.pick_sql('event_id', LAB_TESTS, 5, 3)} AS test, {s.pick_sql('event_id', LAB_RESULTS)} AS result, CASE WHEN event_id % 5 <> 0 THEN ts::DATE END AS day FROM events),
    l AS (SELECT l0.*, source_patient_id, source_encounter_type, source_encounter_type <> 'note' AS migrated, CASE WHEN {NUMBER} IN ('', '.') THEN 0.0 ELSE CAST({NUMBER} AS DOUBLE) END AS number,
        coalesce(CASE test WHEN 'cd4' THEN {IS_NUMBER} OR regexp_matches(result, '[0-9]+cell.*') WHEN 'hematocrite' THEN result IS NOT NULL WHEN 'eryth_sed_rate' THEN result IS NOT NULL
            WHEN 'ppd' THEN result LIKE 'negative%' OR result LIKE 'positive%' OR {IS_NUMBER} WHEN 'rpr' THEN result IN ('negative', 'positive')
            WHEN 'sputum' THEN result IN ('negative', 'negatif', 'positive', '+++', '++', '+') WHEN 'hemoglobin' THEN regexp_matches(result, '^[ \\t]*[0-9.]+[ \\t]*gr?.dll?$') OR {IS_NUMBER} END, false) AS valid
        FROM l0 JOIN enc USING (source_encounter_id) WHERE test <> 'other_test')"""


def _exam_labs(t):
    rows = t.events.select(
        F.col("event_id").alias("exam_lab_id"), F.expr("event_id div 4").alias("source_encounter_id"), s.pick("event_id", LAB_TESTS, 5, 3).alias("lab_test"),
        s.pick("event_id", LAB_RESULTS).alias("result"), F.when(F.col("event_id") % 5 != 0, F.to_date("ts")).alias("test_date"),
    )
    staged = _encounters(t).withColumn("encounter_type", F.when(F.col("source_encounter_type") != "note", F.col("source_encounter_type")))
    return labs.read_exam_labs(rows, staged, s.patient_ids(t))


SIGN_CODE = "CASE WHEN result LIKE 'negative%' THEN 'LOCAL:NEGATIVE' ELSE 'LOCAL:POSITIVE' END"
SIGNED = "(result LIKE 'negative%' OR result LIKE 'positive%')"


@query("k29_exam_labs", s.obs_sql(EXAM_LAB_SQL, [
    ("l", "CIEL:5497", "numeric", "number", "test = 'cd4' AND valid AND migrated", False),
    ("l", "LOCAL:HEMATOCRIT", "numeric", "number", "test = 'hematocrite' AND valid AND migrated", False),
    ("l", "LOCAL:ERYTHROCYTE SEDIMENTATION RATE", "numeric", "number", "test = 'eryth_sed_rate' AND valid AND migrated", False),
    ("l", "LOCAL:HEMOGLOBIN", "numeric", "number", "test = 'hemoglobin' AND valid AND migrated", False),
    ("l", "LOCAL:1435", "coded", SIGN_CODE, f"test = 'ppd' AND {SIGNED} AND migrated", False),
    ("l", "LOCAL:TUBERCULIN SKIN TEST", "numeric", "number", f"test = 'ppd' AND valid AND NOT {SIGNED} AND migrated", False),
    ("l", "CIEL:1619", "coded", "CASE result WHEN 'negative' THEN 'LOCAL:NON-REACTIVE' ELSE 'LOCAL:REACTIVE' END", "test = 'rpr' AND valid AND migrated", False),
    ("l", "LOCAL:TUBERCULOSIS SMEAR RESULT", "coded", s.case_sql("result", labs.SPUTUM_RESULTS), "test = 'sputum' AND valid AND migrated", False),
]))
def exam_labs(t):
    return s.obs_view(labs.exam_labs_obs(_exam_labs(t)))


@query("k29_exam_lab_warnings", f"""
    WITH {EXAM_LAB_SQL}
    SELECT source_patient_id + 5000 AS patient_id, source_encounter_id AS encounter_id, 'HIV_EXAM_LAB_RESULTS ' || test AS field_name, result AS field_value, 'Invalid ' || test || ' value. Not migrated.' AS warning_type, true AS flag_for_review FROM l WHERE NOT valid
    UNION ALL SELECT source_patient_id + 5000, source_encounter_id, 'HIV_EXAM_LAB_RESULTS ' || test, result, test || ' value belongs to an encounter that was not migrated. Value not migrated.', false FROM l WHERE NOT migrated
""")
def exam_lab_warnings(t):
    return labs.exam_lab_warnings(_exam_labs(t)).select("patient_id", "encounter_id", "field_name", "field_value", "warning_type", "flag_for_review")


FILMS = ["cxr0", "cxr1", "abdominal_ultrasound", "cxr2", "other_radiology", "cd4"]
FILM_RESULTS = ["clear", None, "shadow", "?"]


@query("k29_radiology", s.obs_sql(f"""f AS (SELECT event_id // 4 AS source_encounter_id, {s.pick_sql('event_id', FILMS, 5, 3)} AS test, {s.pick_sql('event_id', FILM_RESULTS)} AS result, CASE WHEN event_id % 3 <> 0 THEN ts::DATE END AS day FROM events),
    g AS (SELECT * FROM f WHERE result IS NOT NULL OR day IS NOT NULL),
    c AS (SELECT source_encounter_id, string_agg(concat_ws(': ', test, result, day::VARCHAR), '; ' ORDER BY test, concat_ws(': ', test, result, day::VARCHAR)) AS words, max(day) FILTER (result IS NOT NULL) AS day
        FROM g WHERE test LIKE 'cxr%' GROUP BY 1)""", [
    ("c", "LOCAL:Radiology report construct", "group", "", "true", False), ("c", "LOCAL:Radiology procedure performed", "coded", "'CIEL:165152'", "true", True),
    ("c", "LOCAL:Radiology report comments", "text", "words", "true", True), ("c", "LOCAL:12847", "date", "day", "day IS NOT NULL", True),
    ("g", "LOCAL:Radiology report construct", "group", "", "test IN ('abdominal_ultrasound', 'other_radiology')", False),
    ("g", "LOCAL:Radiology procedure performed", "coded", "CASE test WHEN 'abdominal_ultrasound' THEN 'CIEL:845' ELSE 'LOCAL:OTHER NON-CODED' END", "test IN ('abdominal_ultrasound', 'other_radiology')", True),
    ("g", "LOCAL:Radiology report comments", "text", "result", "test IN ('abdominal_ultrasound', 'other_radiology')", True),
    ("g", "LOCAL:12847", "date", "day", "test IN ('abdominal_ultrasound', 'other_radiology') AND result IS NOT NULL AND day IS NOT NULL", True),
]))
def radiology(t):
    rows = t.events.select(
        F.col("event_id").alias("exam_lab_id"), F.expr("event_id div 4").alias("source_encounter_id"), s.pick("event_id", FILMS, 5, 3).alias("lab_test"),
        s.pick("event_id", FILM_RESULTS).alias("result"), F.when(F.col("event_id") % 3 != 0, F.to_date("ts")).alias("test_date"),
    )
    return s.obs_view(labs.radiology_obs(rows))


PCR_RESULTS = ["Negative", "positive", None, "indeterminate", "lost"]


@query("k30_pcr_tests", s.obs_sql(f"""k AS (SELECT l_orderkey AS id, min(l_shipdate)::DATE AS got FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    p AS (SELECT o_orderkey AS source_encounter_id, lower({s.pick_sql('o_orderkey', PCR_RESULTS)}) AS result, got, CASE WHEN o_orderkey % 2 = 0 THEN 'S' || o_orderkey END AS sample, CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END AS words
        FROM orders LEFT JOIN k ON id = o_orderkey WHERE o_orderkey % 150 IN (SELECT s_suppkey FROM supplier))""", [
    ("p", "LOCAL:Date of test results", "date", "got", "got IS NOT NULL AND result IS NOT NULL", False),
    ("p", "CIEL:1030", "coded", "CASE result WHEN 'negative' THEN 'CIEL:664' WHEN 'positive' THEN 'CIEL:703' WHEN 'indeterminate' THEN 'CIEL:1138' END", "result IS NOT NULL", False, "words"),
    ("p", "CIEL:162086", "text", "sample", "sample IS NOT NULL AND result IS NOT NULL", False),
]))
def pcr_tests(t):
    key = F.col("o_orderkey")
    tests = t.orders.select(
        key.alias("pcr_test_id"), (key % 150).alias("source_infant_id"), s.pick("o_orderkey", PCR_RESULTS).alias("result"), F.when(key % 2 == 0, F.concat(F.lit("S"), key.cast("string"))).alias("sample_id"),
        F.when(key % 3 == 0, F.to_date("o_orderdate")).alias("sample_date"), F.to_date("o_orderdate").alias("result_entry_date"), F.when(key % 5 == 0, F.col("o_orderpriority")).alias("comments"),
    )
    steps = F.when(F.col("l_returnflag") == "R", "result_received").when(F.col("l_returnflag") == "A", "sent_to_lab").otherwise("sent_to_central_site")
    tracking = t.lineitem.select(F.col("l_orderkey").alias("pcr_test_id"), steps.alias("event_type"), F.to_date("l_shipdate").alias("event_date"))
    infants = t.supplier.select(F.col("s_suppkey").alias("source_infant_id"), (F.col("s_suppkey") + 90000).alias("person_id"))
    return s.obs_view(labs.pcr_obs(labs.stage_pcr(tests, tracking), infants))


ORDERED = [" CD4", "none", "other1", "cxr", "biochemistry", "abdominal_ultrasound", "elisa", "other_test", None]


@query("k25_ordered_tests", s.obs_sql(f"""q AS (SELECT o_orderkey // 4 AS source_encounter_id, lower(trim({s.pick_sql('o_orderkey', ORDERED, 5, 3)})) AS test, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS words FROM orders),
    ot AS (SELECT source_encounter_id, string_agg(words, ', ' ORDER BY words) AS words FROM q WHERE test LIKE 'other%' GROUP BY 1)""", [
    ("q", "LOCAL:Lab test ordered coded", "coded", "'CIEL:1107'", "test = 'none'", False),
    ("q", "LOCAL:Lab test ordered coded", "coded", "CASE test WHEN 'cd4' THEN 'CIEL:5497' ELSE 'CIEL:1041' END", "test IN ('cd4', 'elisa')", False),
    ("q", "LOCAL:Radiology image ordered", "coded", "CASE test WHEN 'cxr' THEN 'CIEL:165152' ELSE 'CIEL:845' END", "test IN ('cxr', 'abdominal_ultrasound')", False),
    ("ot", "LOCAL:Lab test ordered coded", "coded", "'LOCAL:OTHER'", "true", False, "words"),
]))
def ordered_tests(t):
    key = F.col("o_orderkey")
    rows = t.orders.select(key.alias("order_id"), F.expr("o_orderkey div 4").alias("source_encounter_id"), s.pick("o_orderkey", ORDERED, 5, 3).alias("test"),
                           F.when(key % 7 != 0, F.col("o_orderpriority")).alias("test_other"))
    return s.obs_view(labs.ordered_tests_obs(rows))


# ---- history

ROOF = ["tin", None, "tile", "straw"]
EDU = ["none", None, "university"]
FLAGS = ["t", "f", "?", None]
DRINKS = [None, "2", " 1 ", "0"]
TIMES = ["1_to_2_hours", None, "unknown", "over_6_hours"]
WAYS = ["walk", None, "boat"]
SOCIO_SQL = ENC + ", " + INTAKE_SQL + f""",
    sc AS (SELECT source_encounter_id, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 9 END AS people, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 4 END AS rooms, {s.pick_sql('c_custkey', ROOF)} AS roof,
        {s.pick_sql('c_custkey', ['dirt', None, 'mud'])} AS floor, {s.pick_sql('c_custkey', FLAGS)} AS latrine, {s.pick_sql('c_custkey', FLAGS, 1, 2)} AS radio, {s.pick_sql('c_custkey', EDU)} AS edu,
        {s.pick_sql('c_custkey', FLAGS, 1, 3)} AS smokes, {s.pick_sql('c_custkey', [None, ' 10 '])} AS years, {s.pick_sql('c_custkey', [None, '5', '20'])} AS cigs, {s.pick_sql('c_custkey', DRINKS)} AS days,
        {s.pick_sql('c_custkey', DRINKS, 1, 2)} AS wine, {s.pick_sql('c_custkey', DRINKS, 1, 4)} AS beer, {s.pick_sql('c_custkey', DRINKS, 1, 8)} AS drinks, {s.pick_sql('c_custkey', WAYS)} AS way,
        {s.pick_sql('c_custkey', TIMES)} AS t1, {s.pick_sql('c_custkey', TIMES, 1, 2)} AS t2, {s.pick_sql('c_custkey', [None, 'on foot'], 1, 5)} AS other_way
        FROM customer JOIN first_intake ON source_patient_id = c_custkey)"""


def _socio(t):
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("source_patient_id"), F.when(key % 5 != 0, key % 9).alias("num_people_in_house"), F.when(key % 7 != 0, key % 4).alias("num_rooms_in_house"), s.pick("c_custkey", ROOF).alias("type_of_roof"),
        s.pick("c_custkey", ["dirt", None, "mud"]).alias("type_of_floor"), s.pick("c_custkey", FLAGS).alias("latrine_p"), s.pick("c_custkey", FLAGS, 1, 2).alias("radio_p"), s.pick("c_custkey", EDU).alias("education"),
    )


def _socio_extra(t):
    return t.customer.select(
        F.col("c_custkey").alias("source_patient_id"), s.pick("c_custkey", FLAGS, 1, 3).alias("smokes_p"), s.pick("c_custkey", [None, " 10 "]).alias("smoking_years"),
        s.pick("c_custkey", [None, "5", "20"]).alias("num_cigarretes_per_day"), s.pick("c_custkey", DRINKS).alias("num_days_alcohol_per_week"), s.pick("c_custkey", DRINKS, 1, 2).alias("wine_per_day"),
        s.pick("c_custkey", DRINKS, 1, 4).alias("beer_per_day"), s.pick("c_custkey", DRINKS, 1, 8).alias("drinks_per_day"), s.pick("c_custkey", WAYS).alias("method_of_transport"),
        s.pick("c_custkey", TIMES).alias("time_of_transport"), s.pick("c_custkey", TIMES, 1, 2).alias("walking_time_to_clinic"), s.pick("c_custkey", [None, "on foot"], 1, 5).alias("arrival_method_other"),
    )


def _n(column):
    return f"coalesce(CAST(trim({column}) AS DOUBLE), 0)"


@query("k16_socioeconomics", s.obs_sql(SOCIO_SQL, [
    ("sc", "CIEL:1474", "numeric", "people", "people IS NOT NULL", False), ("sc", "CIEL:1475", "numeric", "rooms", "rooms IS NOT NULL", False),
    ("sc", "LOCAL:ROOF MATERIAL", "coded", "CASE roof WHEN 'tin' THEN 'LOCAL:SHEET METAL' WHEN 'tile' THEN 'CIEL:159679' END", "roof IS NOT NULL", False),
    ("sc", "CIEL:159387", "coded", "CASE floor WHEN 'dirt' THEN 'LOCAL:BEATEN EARTH' ELSE 'LOCAL:OTHER' END", "floor IS NOT NULL", False),
    ("sc", "LOCAL:Latrine", "coded", "CASE latrine WHEN 't' THEN 'LOCAL:YES' ELSE 'LOCAL:NO' END", "latrine IN ('t', 'f')", False),
    ("sc", "LOCAL:1318", "coded", "CASE radio WHEN 't' THEN 'LOCAL:YES' ELSE 'LOCAL:NO' END", "radio IN ('t', 'f')", False),
    ("sc", "CIEL:1712", "coded", "CASE edu WHEN 'none' THEN 'LOCAL:NONE' ELSE 'CIEL:159785' END", "edu IS NOT NULL", False),
    ("sc", "CIEL:163731", "coded", "CASE smokes WHEN 't' THEN 'LOCAL:CURRENTLY' ELSE 'LOCAL:NO' END", "smokes IN ('t', 'f')", False),
    ("sc", "CIEL:159931", "numeric", "trim(years)", "years IS NOT NULL", False), ("sc", "LOCAL:11949", "numeric", "trim(cigs)", "cigs IS NOT NULL", False),
    ("sc", "CIEL:159449", "coded", "'LOCAL:CURRENTLY'", f"{_n('days')} > 0 OR {_n('wine')} > 0 OR {_n('beer')} > 0 OR {_n('drinks')} > 0", False),
    ("sc", "LOCAL:2243", "numeric", "trim(days)", "days IS NOT NULL", False),
    ("sc", "LOCAL:2246", "numeric", f"{_n('wine')} + {_n('beer')} + {_n('drinks')}", "wine IS NOT NULL OR beer IS NOT NULL OR drinks IS NOT NULL", False),
    ("sc", "LOCAL:975", "coded", "CASE way WHEN 'walk' THEN 'LOCAL:WALKING' END", "way IS NOT NULL", False),
    ("sc", "LOCAL:CLINIC TRAVEL TIME", "coded", s.case_sql("coalesce(t1, t2)", history.TRAVEL_TIMES), "t1 IS NOT NULL OR t2 IS NOT NULL", False),
    ("sc", "LOCAL:1301", "text", "other_way", "other_way IS NOT NULL", False),
]))
def socioeconomics(t):
    return s.obs_view(history.socioeconomics_obs(_socio(t), _socio_extra(t), _encounters(t)))


@query("k16_socio_encounters", f"""
    WITH {ENC} SELECT source_patient_id + 5000 AS person_id, source_encounter_id AS intake_encounter_id, encounter_date::VARCHAR AS day, location_id FROM enc WHERE source_encounter_type = 'intake'
""")
def socio_encounters(t):
    rows = history.socioeconomic_encounters(s.patient_ids(t), _socio(t), _socio_extra(t), _encounters(t))
    return rows.select("person_id", "intake_encounter_id", day_text("encounter_date").alias("day"), "location_id")


RELATIONS = ["fils", "mari", "mère", "soeur", None, "voisin", "pere"]
CONTACT_HIV = ["pos", "unknown", None, "not_tested"]
CONTACT_NAMES = ["Marie Ange Paul", "Jean", None, " Luc Noel "]
CONTACT_SQL = ENC + f""", c0 AS (SELECT o_custkey AS p, {s.pick_sql('o_orderkey', CONTACT_NAMES)} AS name, {s.pick_sql('o_orderkey', RELATIONS, 1, 2)} AS rel, CASE WHEN o_orderkey % 5 <> 0 THEN DATE '1950-01-01' + CAST(o_orderkey % 9000 AS INTEGER) END AS born,
        {s.pick_sql('o_orderkey', FLAGS, 1, 3)} AS dead, {s.pick_sql('o_orderkey', CONTACT_HIV)} AS hiv FROM orders),
    it AS (SELECT source_patient_id, min(source_encounter_id) AS source_encounter_id, arg_min(encounter_date, source_encounter_id) AS day FROM enc WHERE source_encounter_type = 'intake' GROUP BY 1),
    c1 AS (SELECT p, name, max(rel) AS rel, max(born) AS born, max(dead) AS dead, max(hiv) AS hiv FROM c0 GROUP BY 1, 2),
    ct AS (SELECT source_encounter_id, p, name, rel, date_part('year', age(day, born)) AS years,
        CASE name WHEN 'Marie Ange Paul' THEN 'Marie Ange ' WHEN 'Jean' THEN 'Jean' WHEN ' Luc Noel ' THEN 'Luc ' END AS first, CASE name WHEN 'Marie Ange Paul' THEN 'Paul' WHEN 'Jean' THEN 'Jean' WHEN ' Luc Noel ' THEN 'Noel' END AS last,
        CASE rel WHEN 'fils' THEN 'CIEL:1528' WHEN 'mari' THEN 'LOCAL:PARTNER OR SPOUSE' WHEN 'pere' THEN 'LOCAL:GUARDIAN' WHEN 'soeur' THEN 'LOCAL:SIBLING' WHEN 'mère' THEN 'LOCAL:OTHER RELATIVE' WHEN 'voisin' THEN 'LOCAL:OTHER RELATIVE' END AS relref,
        CASE WHEN dead = 't' THEN 'LOCAL:DEATH' END AS deathref, CASE hiv WHEN 'pos' THEN 'LOCAL:POSITIVE' WHEN 'unknown' THEN 'LOCAL:unknown' WHEN 'not_tested' THEN 'LOCAL:NO TEST' END AS hivref FROM c1 JOIN it ON p = source_patient_id)"""
ANY_FACT = "coalesce(first, last, relref, deathref, hivref, years::VARCHAR) IS NOT NULL"


def _contacts(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        F.col("o_custkey").alias("source_patient_id"), s.pick("o_orderkey", CONTACT_NAMES).alias("contact_name"), s.pick("o_orderkey", RELATIONS, 1, 2).alias("relationship"),
        F.when(key % 5 != 0, s.day_after("1950-01-01", key % 9000)).alias("birth_date"), s.pick("o_orderkey", FLAGS, 1, 3).alias("deceased_p"), s.pick("o_orderkey", CONTACT_HIV).alias("hiv_status"),
    )


@query("k17_contacts", s.obs_sql(CONTACT_SQL, [
    ("ct", "LOCAL:Contact construct", "group", "", ANY_FACT, False), ("ct", "LOCAL:FIRST NAME", "text", "first", "first IS NOT NULL", True), ("ct", "LOCAL:LAST NAME", "text", "last", "last IS NOT NULL", True),
    ("ct", "LOCAL:AGE", "numeric", "years", "years IS NOT NULL", True), ("ct", "CIEL:164352", "coded", "relref", "relref IS NOT NULL", True),
    ("ct", "CIEL:163533", "coded", "deathref", "deathref IS NOT NULL", True), ("ct", "LOCAL:RESULT OF HIV TEST", "coded", "hivref", "hivref IS NOT NULL", True),
]))
def contacts(t):
    return s.obs_view(history.contacts_obs(history.stage_contacts(_contacts(t), _encounters(t))))


@query("k17_contact_warnings", f"""
    WITH {CONTACT_SQL}, bad AS (SELECT p, name, string_agg(rel, ', ' ORDER BY rel) AS rels, count(DISTINCT rel) AS n1, string_agg(hiv, ', ' ORDER BY hiv) AS hivs, count(DISTINCT hiv) AS n2,
        string_agg(dead, ', ' ORDER BY dead) AS deads, count(DISTINCT dead) AS n3, string_agg(born::VARCHAR, ', ' ORDER BY born) AS borns, count(DISTINCT born) AS n4 FROM c0 GROUP BY 1, 2)
    SELECT bad.p + 5000 AS patient_id, 'relationship' AS field_name, rels AS field_value, 'For contact with name ' || bad.name || '. Migrated as ' || relref AS warning_details FROM bad JOIN ct ON bad.p = ct.p AND bad.name = ct.name WHERE n1 > 1
    UNION ALL SELECT bad.p + 5000, 'hiv_status', hivs, 'For contact with name ' || bad.name || '. Migrated as ' || hivref FROM bad JOIN ct ON bad.p = ct.p AND bad.name = ct.name WHERE n2 > 1
    UNION ALL SELECT bad.p + 5000, 'deceased_p', deads, 'For contact with name ' || bad.name || '. Migrated as ' || deathref FROM bad JOIN ct ON bad.p = ct.p AND bad.name = ct.name WHERE n3 > 1
    UNION ALL SELECT bad.p + 5000, 'birth_date', borns, 'For contact with name ' || bad.name || '. Migrated as ' || years FROM bad JOIN ct ON bad.p = ct.p AND bad.name = ct.name WHERE n4 > 1
""")
def contact_warnings(t):
    rows = _contacts(t)
    found = history.contact_warnings(rows, history.stage_contacts(rows, _encounters(t)), s.patient_ids(t))
    return found.select("patient_id", "field_name", "field_value", "warning_details")


INNS = ["CTX", "condom", None, "AZT", "2HRZE_4HR", "other", "TDF_3TC_EFV_NVP", "AZT_3TC_NVP"]
TX_OTHER = [None, "DMPA", None, "plants", None, None, None]
EXPOSURE_SQL = ENC + f""", ex AS (SELECT o_orderkey AS id, o_custkey AS p, {s.pick_sql('o_orderkey', INNS, 3, 2)} AS inn, {s.pick_sql('o_orderkey', TX_OTHER)} AS oth, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate::DATE END AS a,
        CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate::DATE + CAST(o_orderkey % 90 - 20 AS INTEGER) END AS b, {s.pick_sql('o_orderkey', ['cured', None, 'failed', 'moved'])} AS res FROM orders),
    xx AS (SELECT enc.source_encounter_id, ex.*, CASE inn WHEN 'CTX' THEN 'prophylaxis' WHEN 'condom' THEN 'fp' WHEN '2HRZE_4HR' THEN 'tb' WHEN 'TDF_3TC_EFV_NVP' THEN 'hiv' WHEN 'AZT_3TC_NVP' THEN 'hiv' END AS kind,
        CASE inn WHEN 'CTX' THEN 'CIEL:105281' WHEN 'condom' THEN 'CIEL:190' WHEN '2HRZE_4HR' THEN 'LOCAL:2406' WHEN 'TDF_3TC_EFV_NVP' THEN 'CIEL:166052' WHEN 'AZT_3TC_NVP' THEN 'LOCAL:13014' END AS answer,
        CASE res WHEN 'cured' THEN 'CIEL:159791' WHEN 'failed' THEN 'CIEL:843' END AS result,
        CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN ' (' || CASE WHEN a IS NOT NULL THEN 'du ' || a || ' ' ELSE '' END || CASE WHEN b IS NOT NULL THEN 'à ' || b ELSE '' END || ')' ELSE '' END AS span
        FROM ex JOIN enc ON p = source_patient_id AND source_encounter_type = 'intake'),
    oi AS (SELECT source_encounter_id, string_agg(inn || span, ', ' ORDER BY inn || span) AS words FROM xx WHERE inn IS NOT NULL AND inn <> 'other' AND oth IS NULL AND kind IS NULL GROUP BY 1),
    oo AS (SELECT source_encounter_id, string_agg(oth || span, ', ' ORDER BY oth || span) AS words FROM xx WHERE inn IS NOT NULL AND oth IS NOT NULL AND oth <> 'DMPA' GROUP BY 1),
    ob AS (SELECT coalesce(oi.source_encounter_id, oo.source_encounter_id) AS source_encounter_id, concat_ws(', ', oi.words, oo.words) AS words FROM oi FULL JOIN oo ON oi.source_encounter_id = oo.source_encounter_id)"""
FP_GROUP, HIV_GROUP = history.EXPOSURE_GROUPS["fp"], history.EXPOSURE_GROUPS["hiv"]


def _exposures(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("exposure_id"), F.col("o_custkey").alias("source_patient_id"), s.pick("o_orderkey", INNS, 3, 2).alias("inn"), s.pick("o_orderkey", TX_OTHER).alias("treatment_other"),
        F.when(key % 3 != 0, F.to_date("o_orderdate")).alias("start_date"), F.when(key % 5 != 0, F.date_add(F.to_date("o_orderdate"), (key % 90 - 20).cast("int"))).alias("end_date"),
        s.pick("o_orderkey", ["cured", None, "failed", "moved"]).alias("treatment_outcome"),
    )


MEDICAL = "kind IN ('tb', 'hiv', 'prophylaxis')"


@query("k19_previous_exposures", s.obs_sql(EXPOSURE_SQL, [
    ("xx", s.case_sql("kind", history.EXPOSURE_GROUPS), "group", "", "kind IS NOT NULL", False),
    ("xx", "CASE WHEN kind = 'fp' THEN 'CIEL:374' ELSE 'CIEL:1282' END", "coded", "answer", "kind IS NOT NULL", True),
    ("xx", f"CASE WHEN {MEDICAL} THEN 'CIEL:1190' ELSE 'CIEL:163757' END", "date", "a", "kind IS NOT NULL AND a IS NOT NULL", True),
    ("xx", f"CASE WHEN {MEDICAL} THEN 'CIEL:1191' ELSE 'CIEL:163758' END", "date", "b", "kind IS NOT NULL AND b IS NOT NULL", True),
    ("xx", "CIEL:6098", "coded", "result", "kind IS NOT NULL AND result IS NOT NULL", True),
    ("xx", FP_GROUP, "group", "", "inn IS NULL", False), ("xx", "CIEL:374", "coded", "'CIEL:5622'", "inn IS NULL", True), ("xx", "CIEL:163757", "date", "a", "inn IS NULL AND a IS NOT NULL", True),
    ("xx", "CIEL:163758", "date", "b", "inn IS NULL AND b IS NOT NULL", True), ("xx", "CIEL:6098", "coded", "result", "inn IS NULL AND result IS NOT NULL", True),
    ("xx", "LOCAL:2996", "text", "oth", "inn IS NULL AND oth IS NOT NULL", False),
    ("xx", FP_GROUP, "group", "", "oth = 'DMPA'", False), ("xx", "CIEL:374", "coded", "'CIEL:79494'", "oth = 'DMPA'", True), ("xx", "CIEL:163757", "date", "a", "oth = 'DMPA' AND a IS NOT NULL", True),
    ("xx", "CIEL:163758", "date", "b", "oth = 'DMPA' AND b IS NOT NULL", True),
    ("ob", HIV_GROUP, "group", "", "true", False), ("ob", "CIEL:1282", "coded", "'CIEL:5622'", "true", True), ("ob", "LOCAL:1527", "text", "words", "true", False),
]))
def previous_exposures(t):
    return s.obs_view(history.exposures_obs(_exposures(t), _encounters(t)))


@query("k19_exposure_warnings", f"""
    WITH {EXPOSURE_SQL} SELECT p + 5000 AS patient_id, a || ' vs ' || b AS field_value, 'inn: ' || inn || '; treatment_other: ' || oth AS warning_details FROM ex WHERE b < a
""")
def exposure_warnings(t):
    return history.exposure_warnings(_exposures(t), s.patient_ids(t)).select("patient_id", "field_value", "warning_details")


DX_NAMES = ["Anemia", "Thrush", "Gout", "Diabetes"]


@query("k37_diagnoses", s.obs_sql(ENC + f""", dd AS (SELECT n_nationkey AS id, {s.pick_sql('n_nationkey', DX_NAMES)} AS name FROM nation),
    pd AS (SELECT event_id AS id, event_id // 8 AS p, event_id % 40 AS dx, CASE WHEN event_id % 6 = 0 THEN props END AS words, CASE WHEN event_id % 5 = 0 THEN event_type END AS oth, {s.pick_sql('event_id', FLAGS)} AS present,
        CASE WHEN event_id % 3 <> 0 THEN ts::DATE END AS day FROM events),
    j AS (SELECT source_encounter_id, pd.* FROM pd JOIN enc ON p = source_patient_id AND source_encounter_type = 'intake'),
    n1 AS (SELECT * FROM (SELECT j.*, name, row_number() OVER (PARTITION BY source_encounter_id, name ORDER BY j.id) AS r FROM j JOIN dd ON dx = dd.id) WHERE r = 1),
    n2 AS (SELECT * FROM (SELECT j.*, row_number() OVER (PARTITION BY source_encounter_id, oth ORDER BY id) AS r FROM j WHERE oth IS NOT NULL) WHERE r = 1),
    g AS (SELECT source_encounter_id, {s.case_sql('name', history.DIAGNOSES)} AS ref, words, present, day FROM n1 UNION ALL SELECT source_encounter_id, 'LOCAL:OTHER', oth, present, day FROM n2)""", [
    ("g", "CIEL:1633", "group", "", "true", False), ("g", "CIEL:1729", "coded", "CASE WHEN present = 't' THEN 'LOCAL:YES' ELSE 'LOCAL:NO' END", "true", True),
    ("g", "CIEL:1628", "coded", "ref", "ref IS NOT NULL", True), ("g", "CIEL:160221", "text", "words", "words IS NOT NULL", True), ("g", "CIEL:159948", "date", "day", "day IS NOT NULL", True),
]))
def diagnoses(t):
    key = F.col("event_id")
    rows = t.events.select(
        key.alias("patient_diagnosis_id"), F.expr("event_id div 8").alias("source_patient_id"), (key % 40).cast("int").alias("diagnosis_id"), F.when(key % 6 == 0, F.col("props")).alias("diagnosis_comments"),
        F.when(key % 5 == 0, F.col("event_type")).alias("diagnosis_other"), s.pick("event_id", FLAGS).alias("present_p"), F.when(key % 3 != 0, F.to_date("ts")).alias("diagnosis_date"),
    )
    names = t.nation.select(F.col("n_nationkey").alias("diagnosis_id"), s.pick("n_nationkey", DX_NAMES).alias("diagnosis_eng"))
    return s.obs_view(history.diagnoses_obs(rows, names, _encounters(t)))


AIDS = ["tranportation_aid", "nutritional_aid", "funeral_aid", "social_assistance_other", "school_aid", "bed_net"]
AID_COMMENTS = ["recommended", None, "already_receiving", "no", "none yet", "bike"]
AID_SQL = s.ordered_other_sql(AIDS, AID_COMMENTS) + """,
    j AS (SELECT w.*, CASE WHEN source_encounter_id % 3 = 0 THEN 1 + source_encounter_id % 4 END AS vi, CASE WHEN source_encounter_id % 3 = 1 THEN 1 + source_encounter_id % 4 END AS vf FROM w),
    k AS (SELECT *, coalesce(vi <> 3, false) OR coalesce(vf <> 3, false) AS old FROM j),
    o AS (SELECT source_encounter_id, CASE ordered WHEN 'funeral_aid' THEN 'Aide pour funérailles' WHEN 'school_aid' THEN 'Aide scolaire' ELSE comments END
        || CASE WHEN ordered = 'social_assistance_other' OR comments IS NULL THEN '' ELSE ' (' || CASE comments WHEN 'recommended' THEN 'Recommandé' WHEN 'already_receiving' THEN 'Reçu' ELSE comments END || ')' END AS words
        FROM k WHERE ordered IN ('funeral_aid', 'school_aid', 'social_assistance_other') AND (old OR comments NOT LIKE 'no%')),
    l AS (SELECT source_encounter_id, string_agg(words, ', ' ORDER BY words) AS words FROM o GROUP BY 1)"""
AID_QUESTION = "CASE WHEN comments = 'already_receiving' THEN 'LOCAL:SOCIO-ECONOMIC ASSISTANCE ALREADY RECEIVED' ELSE 'LOCAL:SOCIO-ECONOMIC ASSISTANCE RECOMMENDED' END"


@query("k39_assistance", s.obs_sql(AID_SQL, [
    ("k", AID_QUESTION, "coded", "'LOCAL:ASSISTANCE WITH TRANSPORT'", "ordered = 'tranportation_aid' AND (old OR comments <> 'no')", False),
    ("k", AID_QUESTION, "coded", "'LOCAL:NUTRITIONAL AID'", "ordered = 'nutritional_aid' AND (old OR comments <> 'no')", False),
    ("l", "LOCAL:SOCIO-ECONOMIC ASSISTANCE NON-CODED", "text", "words", "words IS NOT NULL", False),
]))
def assistance(t):
    key = F.col("source_encounter_id")
    versions = t.orders.select(F.expr("o_orderkey div 4").alias("source_encounter_id")).distinct().withColumn("form_version", (key % 4 + 1).cast("string"))
    rows = history.assistance_obs(s.ordered_other(t, AIDS, AID_COMMENTS), versions.filter(key % 3 == 0), versions.filter(key % 3 == 1))
    return s.obs_view(rows)


@query("k32_allergies", s.obs_sql(ENC + ", " + INTAKE_SQL + f""", a AS (SELECT source_encounter_id, {s.pick_sql('l_orderkey', ['CTX', None, 'AZT'])} AS inn, l_returnflag AS oth, {s.pick_sql('l_orderkey', ['Rash', None, 'itch', 'Neuropathy'], 1, 2)} AS kind,
        CASE WHEN l_linenumber > 2 THEN l_shipdate::DATE END AS day FROM lineitem JOIN first_intake ON source_patient_id = l_suppkey), b AS (SELECT DISTINCT source_encounter_id FROM a)""", [
    ("a", "LOCAL:ADVERSE EFFECT CONSTRUCT", "group", "", "true", False), ("a", "LOCAL:GENERAL FREE TEXT", "text", "coalesce(inn, oth)", "true", True),
    ("a", "LOCAL:ADVERSE EFFECT", "coded", "CASE kind WHEN 'Rash' THEN 'CIEL:512' WHEN 'Neuropathy' THEN 'CIEL:118983' ELSE 'CIEL:5622' END", "kind IS NOT NULL", True, "CASE WHEN kind = 'itch' THEN kind END"),
    ("a", "LOCAL:ADVERSE EFFECT DATE", "date", "day", "day IS NOT NULL", True),
    ("b", "LOCAL:ADVERSE EFFECT CONSTRUCT", "group", "", "true", False), ("b", "LOCAL:ADVERSE EFFECT", "coded", "'CIEL:121764'", "true", True),
]))
def allergies(t):
    rows = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("allergy_id"), F.col("l_suppkey").alias("source_patient_id"), s.pick("l_orderkey", ["CTX", None, "AZT"]).alias("inn"), F.col("l_returnflag").alias("other_reason"),
        s.pick("l_orderkey", ["Rash", None, "itch", "Neuropathy"], 1, 2).alias("type_of_reaction"), F.when(F.col("l_linenumber") > 2, F.to_date("l_shipdate")).alias("allergy_date"),
    )
    return s.obs_view(history.allergies_obs(rows, _encounters(t)))


EFFECTS = ["side_effect.anemia", "side_effect.other", "side_effect.hair", "sideXeffect", "other"]


@query("k32_side_effects", s.obs_sql(s.observations_sql(EFFECTS, ["t", "f", "dizzy", None]) + """, e AS (SELECT * FROM o WHERE starts_with(observation, 'side_effect.') AND (value = 't' OR observation = 'side_effect.other'))""", [
    ("e", "LOCAL:ADVERSE EFFECT CONSTRUCT", "group", "", "true", False),
    ("e", "LOCAL:ADVERSE EFFECT", "coded", "CASE observation WHEN 'side_effect.anemia' THEN 'CIEL:121629' WHEN 'side_effect.other' THEN 'CIEL:5622' END", "true", True, "CASE WHEN observation = 'side_effect.other' THEN value END"),
]))
def side_effects(t):
    return s.obs_view(history.side_effects_obs(s.observations(t, EFFECTS, ["t", "f", "dizzy", None])))


# ---- clinic forms

PROGRESS = ["good", None, "no_progress", "fine"]


@query("k18_forms", s.obs_sql(f"""i AS (SELECT o_orderkey AS source_encounter_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS rec, CASE WHEN o_orderkey % 4 = 0 THEN 'Dr ' || o_orderstatus END AS doc FROM orders WHERE o_orderkey % 2 = 0),
    f AS (SELECT o_orderkey AS source_encounter_id, {s.pick_sql('o_orderkey', PROGRESS)} AS progress, CASE WHEN o_orderkey % 5 = 0 THEN 'Dr ' || o_orderstatus END AS doc FROM orders WHERE o_orderkey % 2 = 1)""", [
    ("i", "CIEL:162749", "text", "rec", "rec IS NOT NULL", False), ("i", "LOCAL:Provider name non-coded", "text", "doc", "doc IS NOT NULL", False),
    ("f", "CIEL:160116", "coded", "CASE progress WHEN 'good' THEN 'LOCAL:GOOD' WHEN 'no_progress' THEN 'CIEL:162679' END", "progress IS NOT NULL", False), ("f", "LOCAL:Provider name non-coded", "text", "doc", "doc IS NOT NULL", False),
]))
def forms(t):
    key, doctor = F.col("o_orderkey"), F.concat(F.lit("Dr "), F.col("o_orderstatus"))
    intake = t.orders.filter("o_orderkey % 2 = 0").select(key.alias("source_encounter_id"), F.when(key % 3 == 0, F.col("o_orderpriority")).alias("recommendation"), F.when(key % 4 == 0, doctor).alias("examining_doctor"))
    followup = t.orders.filter("o_orderkey % 2 = 1").select(key.alias("source_encounter_id"), s.pick("o_orderkey", PROGRESS).alias("progress"), F.when(key % 5 == 0, doctor).alias("examining_doctor"))
    return s.obs_view(clinic.forms_obs(intake, followup))


SIGNS = ["height", "weight", "blood_pressure_dias", "blood_pressure_sys", "heart_rate", "temperature", "bmi", "respiration_rate"]
VITAL_SQL = f"""v AS (SELECT event_id // 8 AS source_encounter_id, {s.pick_sql('event_id', SIGNS, 5, 3)} AS sign, CASE WHEN event_id % 9 <> 0 THEN round(value, 1) END AS r, {s.pick_sql('event_id', ['kgs', 'lbs', None], 1, 2)} AS unit FROM events)"""


def _vitals(t):
    return t.events.select(
        F.col("event_id").alias("vital_id"), F.expr("event_id div 8").alias("source_encounter_id"), s.pick("event_id", SIGNS, 5, 3).alias("sign"),
        F.when(F.col("event_id") % 9 != 0, F.round("value", 1)).alias("result"), s.pick("event_id", ["kgs", "lbs", None], 1, 2).alias("result_unit"),
    )


@query("k20_vitals", s.obs_sql(VITAL_SQL, [
    ("v", clinic.VITAL_SIGNS["height"], "numeric", "CASE WHEN r < 3 THEN round(r * 100, 1) ELSE r END", "sign = 'height' AND r IS NOT NULL", False),
    ("v", clinic.VITAL_SIGNS["weight"], "numeric", "CASE WHEN unit = 'lbs' THEN round(r * 0.453592, 1) ELSE r END", "sign = 'weight' AND r IS NOT NULL", False),
    ("v", clinic.VITAL_SIGNS["blood_pressure_dias"], "numeric", "CASE WHEN r < 20 THEN r * 10 ELSE r END", "sign = 'blood_pressure_dias' AND r IS NOT NULL", False),
    ("v", clinic.VITAL_SIGNS["blood_pressure_sys"], "numeric", "CASE WHEN r < 30 THEN r * 10 ELSE r END", "sign = 'blood_pressure_sys' AND r IS NOT NULL", False),
    ("v", clinic.VITAL_SIGNS["heart_rate"], "numeric", "r", "sign = 'heart_rate' AND r IS NOT NULL", False), ("v", clinic.VITAL_SIGNS["respiration_rate"], "numeric", "r", "sign = 'respiration_rate' AND r IS NOT NULL", False),
    ("v", clinic.VITAL_SIGNS["temperature"], "numeric", "CASE WHEN r > 60 THEN round((r - 32.0) * 0.555555, 1) ELSE r END", "sign = 'temperature' AND r IS NOT NULL", False),
]))
def vitals(t):
    return s.obs_view(clinic.vitals_obs(_vitals(t)))


@query("k20_vitals_encounters", f"WITH {VITAL_SQL} SELECT source_encounter_id, count(*) AS signs FROM v WHERE r IS NOT NULL GROUP BY 1")
def vitals_encounters(t):
    return clinic.vitals_encounters(_vitals(t)).select("source_encounter_id", "signs")


LINES = ["first_line", None, "third_line", "fifth_line"]


@query("k21_dispensing", s.obs_sql(f"""d AS (SELECT o_orderkey AS source_encounter_id, {s.pick_sql('o_orderkey', ['patient', 'accompagnateur', None])} AS who, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS helper,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 = 0 END AS dac, {s.pick_sql('o_orderkey', LINES, 1, 2)} AS line, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 6 END AS months, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::DATE END AS next FROM orders)""", [
    ("d", "d0d91980-6788-4325-80d3-3bd7b54e705a", "coded", f"CASE WHEN who = 'patient' THEN '{clinic.PATIENT_AT_VISIT}' ELSE '{clinic.HELPER_AT_VISIT}' END", "who IS NOT NULL", False),
    ("d", "c29f0c91-0128-445d-a64b-1f85498c5752", "text", "helper", "helper IS NOT NULL", False), ("d", "6c2f54c5-e3f5-44e7-b4bb-215cfdab5e82", "coded", "'5d4db9da-ae1e-4863-98de-cd5095c01cc8'", "dac", False),
    ("d", "0c709500-0cf8-4959-b244-3e9d24dcacc0", "coded", s.case_sql("line", clinic.TREATMENT_LINES), "line IS NOT NULL", False),
    ("d", "9515cb6d-a243-454b-a77f-d762d50cba84", "numeric", "months", "months IS NOT NULL", False), ("d", "3ce94df0-26fe-102b-80cb-0017a47871b2", "date", "next", "next IS NOT NULL", False),
]))
def dispensing(t):
    key = F.col("o_orderkey")
    rows = t.orders.select(
        key.alias("source_encounter_id"), s.pick("o_orderkey", ["patient", "accompagnateur", None]).alias("dispensed_to"), F.when(key % 4 == 0, F.col("o_orderstatus")).alias("accompagnateur_name"),
        F.when(key % 3 != 0, key % 2 == 0).alias("dac"), s.pick("o_orderkey", LINES, 1, 2).alias("art_treatment_line"), F.when(key % 5 != 0, key % 6).alias("months_dispensed"), F.when(key % 7 != 0, F.to_date("o_orderdate")).alias("next_dispense_date"),
    )
    return s.obs_view(clinic.dispensing_obs(rows))


MEDS = ["ABC 20 mg", "TMS 480 mg", None, "aspirin", "DTG Ped"]
MED_SQL = f"""m AS (SELECT event_id AS id, event_id // 3 AS source_encounter_id, user_id AS p, {s.pick_sql('event_id', MEDS)} AS product, {s.pick_sql('event_id', ['arv_1', None, 'tms_1', 'inh_1'], 1, 2)} AS cat, CASE WHEN event_id % 4 <> 0 THEN event_id % 90 END AS qty FROM events)"""


def _meds(t):
    return t.events.select(
        F.col("event_id").alias("med_id"), F.expr("event_id div 3").alias("source_encounter_id"), F.col("user_id").alias("source_patient_id"), s.pick("event_id", MEDS).alias("source_product_name"),
        s.pick("event_id", ["arv_1", None, "tms_1", "inh_1"], 1, 2).alias("source_medication_category"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 90).alias("quantity"),
    )


KNOWN_MEDS = {name: concept for name, _, concept in clinic.DISPENSED_DRUGS if name in MEDS}


@query("k21_dispensed_meds", s.obs_sql(MED_SQL, [
    ("m", "cef4a703-8521-4c2d-9932-d1429a57e684", "group", "", "true", False),
    ("m", "3cdbc4b4-26fe-102b-80cb-0017a47871b2", "coded", "CASE cat WHEN 'arv_1' THEN 'd8252da3-eac3-417e-9f84-b747f07c1c09' WHEN 'inh_1' THEN '3cd27a8a-26fe-102b-80cb-0017a47871b2' ELSE '8b801f21-16a9-42cf-9869-9f491395765b' END", "cat IS NOT NULL", True),
    ("m", "3cd9491e-26fe-102b-80cb-0017a47871b2", "coded", s.case_sql("product", KNOWN_MEDS), "product IN ('ABC 20 mg', 'TMS 480 mg', 'DTG Ped')", True),
    ("m", "95d216d3-8683-4582-97bd-b3ca5131e18d", "numeric", "qty", "qty IS NOT NULL", True),
]))
def dispensed_meds(t):
    return s.obs_view(clinic.dispensed_meds_obs(_meds(t)))


@query("k21_dispensing_warnings", f"""
    WITH {MED_SQL}, n AS (SELECT * FROM m WHERE p IN (SELECT c_custkey FROM customer))
    SELECT p + 5000 AS patient_id, source_encounter_id AS encounter_id, product AS field_value, 'No mapping to a concept or drug.  Not migrating.' AS warning_type FROM n WHERE product = 'aspirin'
    UNION ALL SELECT p + 5000, source_encounter_id, product, 'All DTG Ped Meds migrated to 10mg tablet. Check regimen if this should be 5mg tablet' FROM n WHERE product = 'DTG Ped'
""")
def dispensing_warnings(t):
    return clinic.dispensing_warnings(_meds(t), s.patient_ids(t)).select("patient_id", "encounter_id", "field_value", "warning_type")


DX_CHILDREN = [("LOCAL:CLINICAL IMPRESSION DIAGNOSIS CONFIRMED", "'LOCAL:PRESUMED'"), ("LOCAL:Diagnosis order", "'LOCAL:primary'")]


@query("k22_exams", s.obs_sql(ENC + """, x AS (SELECT o_orderkey AS source_encounter_id, source_encounter_type AS kind, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS hist, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS dx,
    CASE WHEN o_orderkey % 5 = 0 THEN 'note' END AS words FROM orders JOIN enc ON source_encounter_id = o_orderkey)""", [
    ("x", "LOCAL:PRESENTING HISTORY", "text", "hist", "hist IS NOT NULL AND kind = 'intake'", False), ("x", "CIEL:160531", "text", "hist", "hist IS NOT NULL AND kind = 'followup'", False),
    ("x", "LOCAL:Visit Diagnoses", "group", "", "dx IS NOT NULL", False), *[("x", c, "coded", v, "dx IS NOT NULL", True) for c, v in DX_CHILDREN],
    ("x", "LOCAL:Diagnosis or problem, non-coded", "text", "dx", "dx IS NOT NULL", True), ("x", "LOCAL:PHYSICAL SYSTEM COMMENT", "text", "words", "words IS NOT NULL", False),
]))
def exams(t):
    key = F.col("o_orderkey")
    rows = t.orders.select(key.alias("source_encounter_id"), F.when(key % 2 == 0, F.col("o_orderpriority")).alias("presenting_history"), F.when(key % 3 == 0, F.col("o_orderstatus")).alias("diagnosis"), F.when(key % 5 == 0, "note").alias("comments"))
    return s.obs_view(clinic.exams_obs(rows, _encounters(t)))


OIS = [" Malaria", "none", "other", "candidiaris_other", "vaginal_urethral_other", None, "flu", "thrush"]


@query("k23_infections", s.obs_sql(ENC + f""", y AS (SELECT event_id // 8 AS source_encounter_id, lower(trim({s.pick_sql('event_id', OIS, 5, 3)})) AS oi, CASE WHEN event_id % 3 <> 0 THEN props END AS words FROM events WHERE {s.pick_sql('event_id', s.FORM_VERSIONS)} = '3'),
    c AS (SELECT source_encounter_id, comments AS words FROM enc WHERE source_encounter_type IN ('intake', 'followup'))""", [
    ("y", "LOCAL:1401", "coded", "'CIEL:1107'", "oi = 'none'", False), ("y", "LOCAL:Visit Diagnoses", "group", "", "oi <> 'none'", False), *[("y", c, "coded", v, "oi <> 'none'", True) for c, v in DX_CHILDREN],
    ("y", "LOCAL:DIAGNOSIS", "coded", "CASE oi WHEN 'malaria' THEN 'CIEL:116128' ELSE 'CIEL:5334' END", "oi IN ('malaria', 'thrush')", True, "words"),
    ("y", "LOCAL:Diagnosis or problem, non-coded", "text", "words", "oi = 'other' AND words IS NOT NULL", True),
    ("y", "LOCAL:Diagnosis or problem, non-coded", "text", "'Candidiasis (' || coalesce(words, '') || ')'", "oi = 'candidiaris_other'", True),
    ("y", "LOCAL:Diagnosis or problem, non-coded", "text", "oi", "oi = 'vaginal_urethral_other'", True, "words"), ("c", "LOCAL:CLINICAL IMPRESSION COMMENTS", "text", "words", "words IS NOT NULL", False),
]))
def infections(t):
    rows = t.events.select(F.col("event_id").alias("infection_id"), F.expr("event_id div 8").alias("source_encounter_id"), s.pick("event_id", OIS, 5, 3).alias("oi"),
                           F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("comments"), s.pick("event_id", s.FORM_VERSIONS).alias("form_version"))
    return s.obs_view(clinic.infections_obs(rows, _encounters(t)))


CRITERIA = ["asymptomatic", "hiv_wasting", "sneezing"]


@query("k24_staging_criteria", s.obs_sql(f"z AS (SELECT event_id // 8 AS source_encounter_id, {s.pick_sql('event_id', CRITERIA)} AS crit FROM events)", [
    ("z", "CIEL:6042", "coded", "CASE crit WHEN 'asymptomatic' THEN 'CIEL:5327' ELSE 'CIEL:823' END", "crit <> 'sneezing'", False)]))
def staging_criteria(t):
    rows = t.events.select(F.col("event_id").alias("criterion_id"), F.expr("event_id div 8").alias("source_encounter_id"), s.pick("event_id", CRITERIA).alias("criterium"))
    return s.obs_view(clinic.staging_criteria_obs(rows))


SYSTEMS = ["Scleras ", "skin", "oropharynx", "pulmonary", "aura"]
FINDINGS = ["normal", "RALES", "icteric", "odd"]


@query("k26_system_status", s.obs_sql(f"""q AS (SELECT event_id // 8 AS source_encounter_id, lower(trim({s.pick_sql('event_id', SYSTEMS, 5, 3)})) AS exam, lower({s.pick_sql('event_id', FINDINGS)}) AS finding FROM events),
    h AS (SELECT source_encounter_id, string_agg(exam, ', ' ORDER BY exam) AS words FROM q WHERE exam IN ('scleras', 'oropharynx') AND finding = 'normal' GROUP BY 1)""", [
    ("q", "CASE exam WHEN 'skin' THEN 'LOCAL:SKIN EXAM FINDINGS' WHEN 'pulmonary' THEN 'LOCAL:CHEST EXAM FINDINGS' ELSE 'LOCAL:HEENT EXAM FINDINGS' END", "coded",
     "CASE finding WHEN 'normal' THEN 'LOCAL:NORMAL' WHEN 'rales' THEN 'LOCAL:6894' ELSE 'LOCAL:ICTERIC SCLERA' END", "exam <> 'aura' AND finding <> 'odd' AND NOT (exam IN ('scleras', 'oropharynx') AND finding = 'normal')", False),
    ("h", "CIEL:163045", "text", "words || ' : normal'", "true", False),
]))
def system_status(t):
    rows = t.events.select(F.col("event_id").alias("status_id"), F.expr("event_id div 8").alias("source_encounter_id"), s.pick("event_id", SYSTEMS, 5, 3).alias("system"), s.pick("event_id", FINDINGS).alias("condition"))
    return s.obs_view(clinic.system_status_obs(rows))


EXTRA_SQL = ENC + f""", x0 AS (SELECT o_orderkey AS source_encounter_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE END AS next, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS plan, {s.pick_sql('o_orderkey', ['1', '4', None, '7'], 1, 4)} AS stage,
        {s.pick_sql('o_orderkey', FLAGS, 1, 2)} AS preg, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate::DATE END AS period, CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate::DATE END AS due, {s.pick_sql('o_orderkey', ['t', '9', None, 'x'], 1, 3)} AS partner,
        {s.pick_sql('o_orderkey', FLAGS, 1, 5)} AS coun, CASE WHEN o_orderkey % 6 = 0 THEN 'farm' END AS act1, CASE WHEN o_orderkey % 10 = 0 THEN 'well' END AS act2 FROM orders),
    x AS (SELECT * FROM x0 WHERE source_encounter_id IN (SELECT source_encounter_id FROM enc WHERE source_encounter_type IN ('intake', 'followup')))"""


def _extra(t):
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    nothing = F.lit(None).cast("string")
    return t.orders.select(
        key.alias("source_encounter_id"), F.when(key % 3 == 0, day).alias("next_exam_date"), F.when(key % 4 == 0, F.col("o_orderpriority")).alias("plan_extra"), s.pick("o_orderkey", ["1", "4", None, "7"], 1, 4).alias("who_stage"),
        s.pick("o_orderkey", FLAGS, 1, 2).alias("pregnant_p"), F.when(key % 5 == 0, day).alias("last_period_date"), F.when(key % 7 == 0, day).alias("expected_delivery_date"), s.pick("o_orderkey", ["t", "9", None, "x"], 1, 3).alias("partner_referred_for_tr_p"),
        s.pick("o_orderkey", FLAGS, 1, 5).alias("post_test_counseling_p"), F.when(key % 6 == 0, "farm").alias("main_activity_before"), F.when(key % 10 == 0, "well").alias("main_activity_how_now"),
        nothing.alias("other_activities_before"), nothing.alias("other_activities_how_now"),
    )


@query("k27_exam_extra", s.obs_sql(EXTRA_SQL, [
    ("x", "3ce94df0-26fe-102b-80cb-0017a47871b2", "date", "next", "next IS NOT NULL", False), ("x", "LOCAL:1620", "text", "plan", "plan IS NOT NULL", False),
    ("x", "LOCAL:CURRENT WHO HIV STAGE", "coded", "CASE stage WHEN '1' THEN 'LOCAL:WHO STAGE 1 ADULT' ELSE 'LOCAL:1207' END", "stage IN ('1', '4')", False), ("x", "LOCAL:PREGNANCY STATUS", "coded", "'LOCAL:YES'", "preg = 't'", False),
    ("x", "LOCAL:DATE OF LAST MENSTRUAL PERIOD", "date", "period", "period IS NOT NULL", False), ("x", "CIEL:5596", "date", "due", "due IS NOT NULL", False),
    ("x", "LOCAL:PARTNER REFERRED FOR HIV TEST", "coded", "CASE partner WHEN 't' THEN 'LOCAL:YES' WHEN '9' THEN 'LOCAL:NO PARTNER' END", "partner IS NOT NULL", False),
    ("x", "CIEL:159382", "coded", "CASE coun WHEN 't' THEN 'LOCAL:YES' ELSE 'LOCAL:NO' END", "coun IN ('t', 'f')", False), ("x", "LOCAL:1402", "text", "act1", "act1 IS NOT NULL", False), ("x", "LOCAL:11543", "text", "act2", "act2 IS NOT NULL", False),
]))
def exam_extra(t):
    return s.obs_view(clinic.exam_extra_obs(_extra(t), _encounters(t)))


@query("k27_exam_extra_warnings", f"""
    WITH {EXTRA_SQL} SELECT source_encounter_id AS encounter_id, next::VARCHAR AS field_value, 'Encounter type: ' || source_encounter_type AS warning_details FROM x0 JOIN enc USING (source_encounter_id)
    WHERE next IS NOT NULL AND source_encounter_type NOT IN ('intake', 'followup')
""")
def exam_extra_warnings(t):
    return clinic.exam_extra_warnings(_extra(t), _encounters(t)).select("encounter_id", "field_value", "warning_details")


MOVES = ["transfer_out_to", "transfer_p", "transfer_in_from", "weight"]
MOVE_VALUES = ["3", "t", "24", None, "99", "0"]


@query("k27_transfers", s.obs_sql(s.observations_sql(MOVES, MOVE_VALUES) + """, u AS (SELECT source_encounter_id, n_name = 'NATION_0' AS outside, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey // 2 + 100 END AS loc FROM o JOIN nation ON value = n_nationkey::VARCHAR WHERE observation = 'transfer_out_to'),
    fr AS (SELECT source_encounter_id, min(value) AS origin FROM o WHERE observation = 'transfer_in_from' GROUP BY 1),
    inn AS (SELECT o.source_encounter_id, origin FROM o LEFT JOIN fr ON o.source_encounter_id = fr.source_encounter_id WHERE observation = 'transfer_p' AND value = 't')""", [
    ("u", "LOCAL:13170", "group", "", "true", False), ("u", "LOCAL:HUM Disposition categories", "coded", "'LOCAL:PATIENT TRANSFERRED OUT'", "true", True),
    ("u", "LOCAL:Transfer out location", "coded", "CASE WHEN outside THEN 'LOCAL:unsupported site' ELSE 'LOCAL:supported site' END", "true", True), ("u", "LOCAL:8621", "text", "loc", "NOT outside AND loc IS NOT NULL", True, "'location'"),
    ("inn", "LOCAL:13169", "group", "", "true", False), ("inn", "LOCAL:13712", "coded", "'LOCAL:6965'", "true", True), ("inn", "LOCAL:6401", "coded", "'LOCAL:8856'", "origin IS NOT NULL", True), ("inn", "LOCAL:11483", "text", "origin", "origin IS NOT NULL", True),
]))
def transfers(t):
    institutions = t.nation.select(F.col("n_nationkey").alias("institution_id"), F.col("n_name").alias("name"))
    sites = t.nation.select((F.col("n_nationkey") * 2).alias("site"), (F.col("n_nationkey") + 100).alias("location_id"))
    return s.obs_view(clinic.transfers_obs(s.observations(t, MOVES, MOVE_VALUES), institutions, sites, "NATION_0"))


TB_NAMES = ["fever", "cough", "night_sweats", "tb_contact", "chest_pain", "rash"]
TB_ROWS_SQL = f"""y AS (SELECT event_id // 4 AS source_encounter_id, {s.pick_sql('event_id', TB_NAMES, 5, 3)} AS symptom, {s.pick_sql('event_id', ['t', 'f', None])} AS result, CASE WHEN event_id % 2 = 0 THEN event_id % 9 END AS dur, {s.pick_sql('event_id', ['days', None], 1, 2)} AS unit FROM events),
    pv AS (SELECT source_encounter_id, {", ".join(f"max(struct_pack(r := result, d := dur::VARCHAR, u := unit)) FILTER (symptom = '{n}') AS {n}" for n in TB_NAMES[:5])} FROM y GROUP BY 1),
    f AS (SELECT source_encounter_id, coalesce(fever.r = 't', false) OR coalesce(night_sweats.r = 't', false) AS yes, fever.r IS NOT NULL OR night_sweats.r IS NOT NULL AS told, fever.r AS f1, fever.d AS f2, fever.u AS f3, night_sweats.r AS n1, night_sweats.d AS n2, night_sweats.u AS n3,
        cough.r AS c1, cough.d AS c2, cough.u AS c3, tb_contact.r AS t1, chest_pain.r AS p1, chest_pain.d AS p2, chest_pain.u AS p3 FROM pv)"""


def _yes_no(column):
    return f"CASE WHEN {column} THEN 'LOCAL:11563' ELSE 'LOCAL:11564' END"


def _tb_comment(label, d, u):
    return f"'{label}_duration=' || coalesce({d}, '') || ',{label}_duration_unit=' || coalesce({u}, '')"


@query("k27_tb_symptoms", s.obs_sql(TB_ROWS_SQL, [
    ("f", _yes_no("yes"), "coded", "'LOCAL:11565'", "told", False, "'fever_result=' || coalesce(f1, '') || ',fever_duration=' || coalesce(f2, '') || ',fever_duration_unit=' || coalesce(f3, '') || '; night_sweat_result=' || coalesce(n1, '')"
        " || ',night_sweat_duration=' || coalesce(n2, '') || ',night_sweat_duration_unit=' || coalesce(n3, '')"),
    ("f", _yes_no("c1 = 't'"), "coded", "'LOCAL:11567'", "c1 IS NOT NULL", False, _tb_comment("cough", "c2", "c3")), ("f", _yes_no("t1 = 't'"), "coded", "'LOCAL:11568'", "t1 IS NOT NULL", False),
    ("f", _yes_no("p1 = 't'"), "coded", "'LOCAL:136'", "p1 IS NOT NULL", False, _tb_comment("chestPain", "p2", "p3")),
]))
def tb_symptoms(t):
    rows = t.events.select(F.expr("event_id div 4").alias("source_encounter_id"), s.pick("event_id", TB_NAMES, 5, 3).alias("symptom"), s.pick("event_id", ["t", "f", None]).alias("result"),
                           F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 9).alias("duration"), s.pick("event_id", ["days", None], 1, 2).alias("duration_unit"))
    return s.obs_view(clinic.tb_screening_symptoms_obs(rows))


SYMPTOM_NAMES = ["Rash", "sti", "other", "headache", "fatigue"]
SYMPTOM_SQL = ENC + f""", y AS (SELECT event_id // 4 AS source_encounter_id, lower({s.pick_sql('event_id', SYMPTOM_NAMES, 5, 3)}) AS symptom, {s.pick_sql('event_id', ['t', 'f', None])} AS result, CASE WHEN event_id % 2 = 0 THEN event_id % 9 END AS dur,
        {s.pick_sql('event_id', ['days', None, 'hours'], 1, 2)} AS unit, CASE WHEN event_id % 5 <> 0 THEN repeat(props, 40) END AS words FROM events),
    g AS (SELECT y.* FROM y JOIN enc ON y.source_encounter_id = enc.source_encounter_id AND form_version = '3' AND source_encounter_type = 'intake' WHERE symptom IN ('rash', 'other', 'headache')),
    st AS (SELECT y.* FROM y JOIN enc ON y.source_encounter_id = enc.source_encounter_id AND form_version = '3' AND source_encounter_type = 'followup' WHERE symptom = 'sti')"""


def _symptoms(t):
    return t.events.select(
        F.col("event_id").alias("symptom_id"), F.expr("event_id div 4").alias("source_encounter_id"), s.pick("event_id", SYMPTOM_NAMES, 5, 3).alias("symptom"), s.pick("event_id", ["t", "f", None]).alias("result"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 9).alias("duration"), s.pick("event_id", ["days", None, "hours"], 1, 2).alias("duration_unit"), F.when(F.col("event_id") % 5 != 0, F.repeat("props", F.lit(40))).alias("symptom_comment"),
    )


@query("k28_symptoms", s.obs_sql(SYMPTOM_SQL, [
    ("g", "CIEL:1727", "group", "", "true", False), ("g", "CIEL:1728", "coded", "CASE symptom WHEN 'rash' THEN 'CIEL:512' ELSE 'CIEL:139084' END", "symptom <> 'other'", True, "words"),
    ("g", "CIEL:1728", "coded", "'CIEL:5622'", "symptom = 'other'", True, "words"), ("g", "CIEL:1729", "coded", "CASE result WHEN 't' THEN 'CIEL:1065' ELSE 'CIEL:1066' END", "result IS NOT NULL", True),
    ("g", "CIEL:1731", "numeric", "dur", "dur IS NOT NULL AND unit IS NOT NULL", True), ("g", "CIEL:1732", "coded", "CASE unit WHEN 'days' THEN 'CIEL:1072' END", "dur IS NOT NULL AND unit IS NOT NULL", True),
    ("st", "LOCAL:1374", "text", "words", "words IS NOT NULL", False),
]))
def symptoms(t):
    return s.obs_view(clinic.symptoms_obs(clinic.stage_symptoms(_symptoms(t)), _encounters(t)))


@query("k28_full_symptoms", f"WITH {SYMPTOM_SQL} SELECT source_encounter_id, symptom, CASE result WHEN 't' THEN true WHEN 'f' THEN false END AS symptom_present FROM y")
def full_symptoms(t):
    return clinic.stage_symptoms(_symptoms(t)).select("source_encounter_id", "symptom", "symptom_present")


ADHERENCE = ["num_doses_missed_last_month", "visted_by_accomp_daily_p", "accompagnateur_missed_visits_reason", "other"]
ADHERENCE_VALUES = [" 3 ", "t", "two", None, "1,5", "f"]
IS_TRIMMED_NUMBER = "(regexp_matches(trim(value), '^[0-9.,]+$') AND regexp_matches(value, '[0-9]'))"


@query("k33_adherence", s.obs_sql(s.observations_sql(ADHERENCE, ADHERENCE_VALUES), [
    ("o", "CIEL:160110", "numeric", "replace(trim(value), ',', '.')", f"observation = 'num_doses_missed_last_month' AND {IS_TRIMMED_NUMBER}", False),
    ("o", "CIEL:160111", "coded", "CASE WHEN value = 't' THEN 'CIEL:1065' ELSE 'CIEL:1066' END", "observation = 'visted_by_accomp_daily_p' AND value IS NOT NULL", False),
    ("o", "LOCAL:13065", "text", "value", "observation = 'accompagnateur_missed_visits_reason'", False),
]))
def adherence(t):
    return s.obs_view(clinic.adherence_obs(s.observations(t, ADHERENCE, ADHERENCE_VALUES)))


@query("k33_adherence_warnings", f"""
    WITH {s.observations_sql(ADHERENCE, ADHERENCE_VALUES)} SELECT source_encounter_id AS encounter_id, value AS field_value FROM o WHERE observation = 'num_doses_missed_last_month' AND NOT {IS_TRIMMED_NUMBER}
""")
def adherence_warnings(t):
    return clinic.adherence_warnings(s.observations(t, ADHERENCE, ADHERENCE_VALUES)).select("encounter_id", "field_value")


FP_NAMES = ["sexually_active_p", "family_planning.condom", "family_planning_other", "family_planning.abstinence", "family_planning.iud", "family_planningX"]
FP_VALUES = ["t", "f", "herbs", None]
FP_ORDERED = ["abstinence", "condom", "family_planning", "family_planning_other1", "vasectomy", "arv"]
FP_COMMENTS = ["pill", None, "other way"]


@query("k34_family_planning", s.obs_sql(s.observations_sql(FP_NAMES, FP_VALUES) + ", " + s.ordered_other_sql(FP_ORDERED, FP_COMMENTS) + """,
    am AS (SELECT DISTINCT source_encounter_id FROM o WHERE (starts_with(observation, 'family_planning.') AND value = 't') OR observation = 'family_planning_other'),
    ow AS (SELECT source_encounter_id, string_agg(comments, '; ' ORDER BY comments) AS words FROM w WHERE ordered IN ('family_planning', 'family_planning_other1') GROUP BY 1)""", [
    ("o", "CIEL:160109", "coded", "CASE WHEN value = 't' THEN 'LOCAL:YES' ELSE 'LOCAL:NO' END", "observation = 'sexually_active_p' AND value IS NOT NULL", False),
    ("o", "LOCAL:OTHER FAMILY PLANNING METHOD, NON-CODED", "text", "value", "observation = 'family_planning_other'", False),
    ("o", "LOCAL:OTHER FAMILY PLANNING METHOD, NON-CODED", "text", "'abstinence'", "observation = 'family_planning.abstinence'", False),
    ("o", "LOCAL:Family planning construct", "group", "", "observation = 'family_planning.condom' AND value = 't'", False), ("o", "CIEL:374", "coded", "'LOCAL:CONDOMS'", "observation = 'family_planning.condom' AND value = 't'", True),
    ("o", "LOCAL:Family planning construct", "group", "", "observation IN ('family_planning_other', 'family_planning.abstinence')", False), ("o", "CIEL:374", "coded", "'LOCAL:OTHER'", "observation IN ('family_planning_other', 'family_planning.abstinence')", True),
    ("am", "CIEL:1382", "coded", "'LOCAL:YES'", "true", False),
    ("w", "LOCAL:Family planning construct", "group", "", "ordered IN ('abstinence', 'condom', 'vasectomy')", False),
    ("w", "LOCAL:METHOD OF FAMILY PLANNING", "coded", "CASE ordered WHEN 'abstinence' THEN 'LOCAL:ABSTINENCE' WHEN 'condom' THEN 'LOCAL:CONDOMS' ELSE 'LOCAL:VASECTOMY' END", "ordered IN ('abstinence', 'condom', 'vasectomy')", True),
    ("ow", "LOCAL:Family planning construct", "group", "", "true", False), ("ow", "LOCAL:METHOD OF FAMILY PLANNING", "coded", "'LOCAL:OTHER'", "true", True), ("ow", "LOCAL:FAMILY PLANNING COMMENT", "text", "words", "words IS NOT NULL", False),
]))
def family_planning(t):
    return s.obs_view(clinic.family_planning_obs(s.observations(t, FP_NAMES, FP_VALUES), s.ordered_other(t, FP_ORDERED, FP_COMMENTS)))


FOOD = ["receiving_nutritional_assistance_p", "receiving_nutritional_assistance_dry_ration", "receiving_nutritional_assistance_financial_aid"]


@query("k35_nutrition", s.obs_sql(s.observations_sql(FOOD, ["t", "f"]) + """,
    k AS (SELECT source_encounter_id, bool_or(observation LIKE '%dry_ration') AS dry, bool_or(observation LIKE '%financial_aid') AS money FROM o WHERE value = 't' AND observation <> 'receiving_nutritional_assistance_p' GROUP BY 1)""", [
    ("o", "LOCAL:2156", "coded", "'LOCAL:NUTRITIONAL AID'", "observation = 'receiving_nutritional_assistance_p' AND value = 't'", False),
    ("k", "LOCAL:SOCIO-ECONOMIC ASSISTANCE COMMENT", "text", "CASE WHEN dry AND money THEN 'A reçu de la ration sèche et de l’aide financière.' WHEN dry THEN 'A reçu de la ration sèche.' ELSE 'A reçu de l’aide financière.' END", "true", False),
]))
def nutrition(t):
    return s.obs_view(clinic.nutrition_obs(s.observations(t, FOOD, ["t", "f"])))


@query("k38_helper_names", s.obs_sql(ENC + """, m AS (SELECT source_patient_id, max(encounter_date) AS day FROM enc WHERE source_encounter_type IN ('intake', 'followup') GROUP BY 1),
    h AS (SELECT source_encounter_id, 'Helper' || enc.source_patient_id AS name FROM enc JOIN m ON enc.source_patient_id = m.source_patient_id AND encounter_date = day WHERE source_encounter_type IN ('intake', 'followup') AND enc.source_patient_id % 5 = 0)""", [
    ("h", "CIEL:164141", "text", "name", "true", False)]))
def helper_names(t):
    patients = t.customer.select(F.col("c_custkey").alias("source_patient_id"), F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("Helper"), F.col("c_custkey").cast("string"))).alias("accompagnateur_name"))
    return s.obs_view(clinic.helper_name_obs(patients, _encounters(t)))


# ---- treatment

TREATMENT_NAMES = [
    "current_tx.prophylaxis_CTX", "current_tx.prophylaxis_CTX_start_date", "prophylaxis_not_indicated", "current_tx.art", "current_tx.art_other", "current_tx.art_start_date", "arv_treatment_reason", "arvs_for_ptme",
    "arvs_for_accident", "arv_treatment_needed", "current_tx.tb", "current_tx.tb_other", "current_tx.tb_start_date", "tb_treatment_needed", "tb_treatment_reason", "current_tx.other_medications", "current_tx.prophylaxis_Isoniazid",
]
TREATMENT_VALUES = ["t", "2010-02-31", "tdf-3tc-efv", None, "none", "yes", "4RH", "2011-15-03", "cured", "odd", "0000-00-00 00:00:00", "d4t 3tc nvp"]
TREATMENT_ORDERED = ["tmp_smx_prophylaxis", "tmp_smx_prophylaxis_continue", "tmp_smx_prophylaxis_dose", "mosquito_net_reason", "fluconazole_low", "arv_regimen", "arv_regimen_other", "arv_start_date", "tb_start_date", "tb_treatment", "change_arvs", "change_arvs_other", "inh_prophylaxis_stopped"]
TREATMENT_COMMENTS = ["2010-02-31", None, "azt+3tc+nvp", "hrez", "other", "side_effect ", "2009-09-09", "x"]


def _fixed_sql(column):
    """The repaired date of the few texts that look like one."""
    return f"CASE left({column}, 10) WHEN '2010-02-31' THEN DATE '2010-03-01' WHEN '2011-15-03' THEN DATE '2011-12-01' WHEN '2009-09-09' THEN DATE '2009-09-09' END"


def _regimen_sql(column):
    return f"CASE {column} WHEN 'tdf-3tc-efv' THEN 'CIEL:164505' WHEN 'd4t 3tc nvp' THEN 'CIEL:792' WHEN 'azt+3tc+nvp' THEN 'CIEL:1652' END"


def _art_sql(name, source, column, value, coded, other, start):
    return f"""{name}0 AS (SELECT source_encounter_id, min(trim({value})) FILTER ({column} = '{coded}') AS coded, min(trim({value})) FILTER ({column} = '{other}') AS oth, min({value}) FILTER ({column} = '{start}') AS start,
        bool_or({column} IN ('{coded}', '{other}')) AS has_row FROM {source} WHERE {column} IN ('{coded}', '{other}', '{start}') GROUP BY 1),
    {name}1 AS (SELECT *, {_regimen_sql('coded')} AS cref, {_regimen_sql('oth')} AS oref FROM {name}0 WHERE coded IS NOT NULL OR oth IS NOT NULL OR (start IS NOT NULL AND NOT has_row)),
    {name} AS (SELECT *, coalesce(cref, oref, CASE WHEN coded IS NOT NULL OR oth IS NOT NULL THEN 'CIEL:5622' END) AS answer FROM {name}1),
    {name}w AS (SELECT *, CASE WHEN coded <> 'other' AND cref IS NULL THEN coded END AS left_c, CASE WHEN oref IS NULL OR oref <> answer THEN oth END AS left_o FROM {name})"""


def _plan_flag(suffix):
    return f"coalesce(bool_or(suffix = '{suffix}'), false)"


PLAN_BASES = "CASE WHEN starts_with(ordered, 'tmp_smx_prophylaxis') THEN 'tmp_smx_prophylaxis' WHEN starts_with(ordered, 'mosquito_net') THEN 'mosquito_net' WHEN ordered = 'fluconazole_low' THEN 'fluconazole_low' WHEN starts_with(ordered, 'inh_prophylaxis') THEN 'inh_prophylaxis' END"
TREATMENT_SQL = s.observations_sql(TREATMENT_NAMES, TREATMENT_VALUES) + ", " + s.ordered_other_sql(TREATMENT_ORDERED, TREATMENT_COMMENTS) + f""",
    px AS (SELECT source_encounter_id, CASE WHEN observation LIKE '%CTX%' THEN 'CTX' ELSE 'Isoniazid' END AS drug, bool_or(observation NOT LIKE '%start_date') AS ticked,
        min(value) FILTER (observation LIKE '%start_date' AND value <> '0000-00-00 00:00:00') AS start FROM o WHERE starts_with(observation, 'current_tx.prophylaxis_') GROUP BY 1, 2),
    pb AS (SELECT source_encounter_id, {PLAN_BASES} AS base, replace(ordered, {PLAN_BASES}, '') AS suffix, comments FROM w WHERE {PLAN_BASES} IS NOT NULL),
    pp AS (SELECT source_encounter_id, base, {_plan_flag('')} AS started, {_plan_flag('_continue')} AS cont, {_plan_flag('_stopped')} AS stopped, min(comments) FILTER (suffix = '_dose') AS dose, min(comments) FILTER (suffix = '_reason') AS reason,
        min(comments) FILTER (suffix = '') AS oth FROM pb GROUP BY 1, 2),
    {_art_sql('a', 'o', 'observation', 'value', 'current_tx.art', 'current_tx.art_other', 'current_tx.art_start_date')},
    {_art_sql('b', 'w', 'ordered', 'comments', 'arv_regimen', 'arv_regimen_other', 'arv_start_date')},
    only_o AS (SELECT * FROM o WHERE observation = 'current_tx.tb_other' AND source_encounter_id NOT IN (SELECT source_encounter_id FROM o WHERE observation = 'current_tx.tb')),
    cx AS (SELECT source_encounter_id, min(comments) AS extra FROM w WHERE ordered = 'change_arvs_other' GROUP BY 1), ch AS (SELECT w.*, extra FROM w LEFT JOIN cx USING (source_encounter_id) WHERE ordered = 'change_arvs' AND comments IS NOT NULL)"""


def _art_parts(name, group):
    return [
        (name, group, "group", "", "true", False), (name, "CIEL:159599", "date", _fixed_sql("start"), f"{_fixed_sql('start')} IS NOT NULL", True), (name, "LOCAL:1282", "coded", "answer", "answer IS NOT NULL", True),
        (f"{name}w", "CIEL:5424", "text", "concat_ws(', ', left_c, left_o)", "left_c IS NOT NULL OR left_o IS NOT NULL", True),
    ]


@query("k36_treatment", s.obs_sql(TREATMENT_SQL, [
    ("px", "LOCAL:2739", "group", "", "ticked", False), ("px", "LOCAL:2289", "coded", "CASE drug WHEN 'CTX' THEN 'CIEL:105281' ELSE 'CIEL:78280' END", "ticked", True), ("px", "CIEL:163526", "date", _fixed_sql("start"), f"ticked AND {_fixed_sql('start')} IS NOT NULL", True),
    ("o", "LOCAL:2740", "coded", "'CIEL:1066'", "observation = 'prophylaxis_not_indicated' AND value = 't'", False), ("w", "LOCAL:2740", "coded", "'CIEL:1065'", f"{PLAN_BASES} IS NOT NULL", False),
    ("pp", "LOCAL:Prescription construct", "group", "", "true", False),
    ("pp", "CIEL:1282", "coded", "CASE base WHEN 'tmp_smx_prophylaxis' THEN 'CIEL:105281' WHEN 'mosquito_net' THEN 'LOCAL:MOSQUITO NET' WHEN 'fluconazole_low' THEN 'CIEL:76488' ELSE 'CIEL:78280' END", "true", True, "oth"),
    ("pp", "LOCAL:PROPHYLAXIS STARTED", "coded", "'CIEL:1065'", "started", True), ("pp", "LOCAL:Prophylaxis should continue", "coded", "'CIEL:1065'", "cont", True), ("pp", "LOCAL:Stop Rx", "coded", "'CIEL:1065'", "stopped", True),
    ("pp", "LOCAL:Prescription instructions non-coded", "text", "dose", "dose IS NOT NULL", True), ("pp", "LOCAL:REASON TREATMENT STOPPED COMMENT", "text", "reason", "reason IS NOT NULL", True),
    *_art_parts("a", "LOCAL:13156"), ("a", "CIEL:160117", "coded", "'CIEL:1065'", "true", False),
    ("o", "LOCAL:ARV treatment reason non-coded", "text", "value", "observation = 'arv_treatment_reason' AND value IS NOT NULL", False),
    ("o", "CIEL:5576", "coded", "CASE value WHEN 't' THEN 'CIEL:1065' END", "observation = 'arvs_for_ptme' AND value IS NOT NULL", False), ("o", "CIEL:162225", "coded", "'CIEL:1691'", "observation = 'arvs_for_accident' AND value <> 'no'", False, "value"),
    ("o", "CIEL:162703", "coded", "CASE value WHEN 'yes' THEN 'LOCAL:1619' END", "observation = 'arv_treatment_needed' AND value IS NOT NULL", False), *_art_parts("b", "LOCAL:6116"),
    ("o", "CIEL:159798", "coded", "CASE WHEN value <> 'none' THEN 'LOCAL:YES' ELSE 'LOCAL:NO' END", "observation = 'current_tx.tb'", False), ("o", "CIEL:1113", "date", _fixed_sql("value"), f"observation = 'current_tx.tb_start_date' AND {_fixed_sql('value')} IS NOT NULL", False),
    ("o", "CIEL:1111", "coded", "NULL", "observation = 'current_tx.tb' AND value <> 'none'", False), ("o", "CIEL:1111", "coded", "'LOCAL:2406'", "observation = 'current_tx.tb_other' AND value = '4RH'", False),
    ("o", "LOCAL:Anti TB free text", "text", "value", "observation = 'current_tx.tb_other' AND value <> '4RH'", False), ("only_o", "CIEL:159798", "coded", "'LOCAL:YES'", "true", False),
    ("o", "LOCAL:1559", "coded", "CASE value WHEN 'yes' THEN 'CIEL:1065' END", "observation = 'tb_treatment_needed' AND value IS NOT NULL", False), ("o", "CIEL:1269", "coded", "CASE value WHEN 'cured' THEN 'CIEL:159791' END", "observation = 'tb_treatment_reason'", False),
    ("w", "CIEL:1113", "date", "DATE '2009-09-09'", "ordered = 'tb_start_date' AND comments = '2009-09-09'", False), ("w", "CIEL:159792", "coded", "'LOCAL:RHZE'", "ordered = 'tb_treatment' AND comments = 'hrez'", False),
    ("o", "LOCAL:13318", "text", "value", "observation = 'current_tx.other_medications' AND value IS NOT NULL", False),
    ("ch", "LOCAL:REASON ANTIRETROVIRALS CHANGED OR STOPPED", "coded", "CASE trim(comments) WHEN 'side_effect' THEN 'LOCAL:TOXICITY, DRUG' ELSE 'LOCAL:OTHER NON-CODED' END", "true", False, "CASE WHEN comments = 'other' THEN extra ELSE trim(comments) END"),
]))
def treatment_facts(t):
    return s.obs_view(treatment.treatment_obs(s.observations(t, TREATMENT_NAMES, TREATMENT_VALUES), s.ordered_other(t, TREATMENT_ORDERED, TREATMENT_COMMENTS)))


# ---- review


def _vital_obs(t):
    """Resolved vitals, with references as concepts, and a group parent per encounter."""
    rows = clinic.vitals_obs(_vitals(t))
    parents = eav.emit(_vitals(t).select("source_encounter_id").distinct(), "parent", ["source_encounter_id"], "source_encounter_id", [eav.Group("LOCAL:panel")])
    visits = t.events.select(F.expr("event_id div 8").alias("source_encounter_id")).distinct().select(
        "source_encounter_id", F.col("source_encounter_id").alias("encounter_id"), (F.col("source_encounter_id") % 50).alias("patient_id"),
        F.lit("2024-01-01").cast("date").alias("encounter_datetime"), F.lit(3).alias("location_id"), F.lit("2024-01-01").cast("date").alias("date_created"),
    )
    return eav.resolve_obs(rows.unionByName(parents), visits)


WARN_SQL = VITAL_SQL + f""", w AS (SELECT source_encounter_id AS e, CASE sign WHEN 'heart_rate' THEN '{clinic.VITAL_SIGNS["heart_rate"]}' ELSE '{clinic.VITAL_SIGNS["respiration_rate"]}' END AS concept, r, CASE sign WHEN 'heart_rate' THEN 10.0 ELSE 5.0 END AS low, CASE sign WHEN 'heart_rate' THEN 80.0 ELSE 60.0 END AS high
        FROM v WHERE sign IN ('heart_rate', 'respiration_rate') AND r IS NOT NULL),
    f AS (SELECT e % 50 AS p, e, concept, 'Decimal obs for non-decimal numeric concept' AS kind FROM w WHERE r <> ceil(r) AND low = 10 UNION ALL SELECT e % 50, e, concept, 'Decimal obs lower than allowed range' FROM w WHERE r < low
        UNION ALL SELECT e % 50, e, concept, 'Decimal obs higher than allowed range' FROM w WHERE r > high UNION ALL SELECT DISTINCT source_encounter_id % 50, source_encounter_id, 'LOCAL:panel', 'Obs with null value' FROM v)"""


def _global_warnings(t):
    limits = t.spark.createDataFrame(
        [(clinic.VITAL_SIGNS["heart_rate"], 10.0, 80.0, False), (clinic.VITAL_SIGNS["respiration_rate"], 5.0, 60.0, True)], "concept_id string, low double, high double, allow_decimal boolean"
    )
    return review.global_warnings(_vital_obs(t), limits)


@query("k43_data_warnings", f"WITH {WARN_SQL} SELECT p AS patient_id, e AS encounter_id, concept AS field_name, kind AS warning_type FROM f")
def data_warnings(t):
    return _global_warnings(t).select("patient_id", "encounter_id", "field_name", "warning_type")


@query("k43_enriched_warnings", f"""
    WITH {WARN_SQL} SELECT p AS patient_id, e AS encounter_id, kind AS warning_type, concept AS field_name, p - 5 AS source_patient_id, 'E' || p AS emr_id, CASE WHEN p % 2 = 0 THEN 'D' || p END AS dossier_id,
        CASE WHEN p % 3 = 0 THEN p + 7 END AS source_infant_id, CASE WHEN p % 3 = 0 THEN 'I' || p END AS infant_code, CASE WHEN o_orderkey IS NOT NULL THEN e + 100 END AS source_encounter_id FROM f LEFT JOIN orders ON o_orderkey = e AND o_orderstatus = 'F'
""")
def enriched_warnings(t):
    people = t.customer
    key = F.col("c_custkey")
    patients = people.select(key.alias("person_id"), (key - 5).alias("source_patient_id"))
    identifiers = people.select(key.alias("person_id"), F.lit("emr").alias("kind"), F.concat(F.lit("E"), key.cast("string")).alias("identifier")).unionByName(
        people.filter("c_custkey % 2 = 0").select(key.alias("person_id"), F.lit("dossier").alias("kind"), F.concat(F.lit("D"), key.cast("string")).alias("identifier")))
    infants = people.filter("c_custkey % 3 = 0").select(key.alias("person_id"), (key + 7).alias("source_infant_id"), F.concat(F.lit("I"), key.cast("string")).alias("infant_code"))
    visits = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("encounter_id"), (F.col("o_orderkey") + 100).alias("source_encounter_id"))
    rows = review.enriched_warnings(_global_warnings(t), patients, identifiers, infants, visits)
    return rows.select("patient_id", "encounter_id", "warning_type", "field_name", "source_patient_id", "emr_id", "dossier_id", "source_infant_id", "infant_code", "source_encounter_id")


def _p_sql(text, i):
    digits = f"md5({text})"
    terms = [f"(strpos('0123456789abcdef', substr({digits}, {k + 1}, 1)) - 1) * {16 ** (4 + i - 1 - k)}" for k in range(4 + i)]
    return "(" + " + ".join(terms) + ") % 1000 / 1000.0::DOUBLE"


SAMPLE_SQL = ENC + f""", sp AS (SELECT c_custkey AS p, {s.pick_sql('c_custkey', ['M', 'F', 'M'])} AS sex, DATE '1970-01-01' + CAST(c_custkey * 37 % 9000 AS INTEGER) AS born, c_mktsegment || c_name AS name FROM customer),
    h AS (SELECT source_encounter_id, sex, date_part('year', age(encounter_date, born)) < 16 AS young, {_p_sql('name', 1)} AS p1, {_p_sql('name', 2)} AS p2, {_p_sql('name', 3)} AS p3, {_p_sql('name', 4)} AS p4 FROM enc JOIN sp ON p = source_patient_id WHERE source_encounter_type = 'intake'),
    c AS (SELECT *, CASE {" ".join(f"WHEN sex = '{sex}' AND {'young' if young else 'NOT young'} AND p1 > {low} AND p1 <= {high} THEN '{name}'" for (sex, young), bands in review.SAMPLE_BANDS.items() for name, low, high in bands)} END AS pick FROM h),
    d AS (SELECT *, coalesce(pick = 'msm', false) OR coalesce(pick IN ('sw', 'prisoner', 'trans', 'iv') AND p3 < 0.3, false) AS msm, coalesce(pick = 'iv', false) OR coalesce(pick IN ('msm', 'sw', 'prisoner', 'trans') AND p4 < 0.2, false) AS iv,
        coalesce(pick = 'sw', false) AS sw, coalesce(pick = 'prisoner', false) AS prisoner, coalesce(pick = 'trans', false) AS trans FROM c)"""


@query("k45_sample_data", s.obs_sql(SAMPLE_SQL, [
    part for name, concept in review.POPULATIONS.items()
    for part in (("d", concept, "coded", "'LOCAL:YES'", name, False), ("d", concept, "coded", "'LOCAL:UNKNOWN'", f"NOT {name} AND p2 < 0.25", False))
]))
def sample_data(t):
    key = F.col("c_custkey")
    people = t.customer.select(
        key.alias("source_patient_id"), s.pick("c_custkey", ["M", "F", "M"]).alias("gender"), s.day_after("1970-01-01", (key * 37) % 9000).alias("birthdate"),
        F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"),
    )
    return s.obs_view(review.sample_population_obs(people, _encounters(t)))
