"""Documents over stand-ins (L9 to L14) and the change log stream (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions.dates import day_text
from chartlift.plans import documents as docs
from chartlift.queries import standins as s
from chartlift.queries.registry import query
from chartlift.runtime import scratch_path
from chartlift.streaming import changes

KINDS = ["intake", "followup", "patient_contact", "note", "lab_result", "accompagnateur", "regime", "pregnancy", "food_study", "food_support", "cervical_cancer", "infant_followup"]
ENC = s.encounters_sql(KINDS)


def _labs(t):
    """Line items as exam labs of their order."""
    test = F.when(F.col("l_returnflag") == "A", "cd4").when(F.col("l_returnflag") == "N", "rpr").otherwise("culture")
    return t.lineitem.select(
        F.col("l_orderkey").alias("source_encounter_id"), test.alias("lab_test"), F.to_date("l_shipdate").alias("test_date"),
        F.when(F.col("l_linenumber") != 7, F.when(F.col("l_returnflag") == "N", F.lit("Positive")).otherwise(F.col("l_quantity").cast("int").cast("string"))).alias("result"),
    )


LAB_SQL = """x AS (SELECT l_orderkey AS source_encounter_id, CASE l_returnflag WHEN 'A' THEN 'cd4' WHEN 'N' THEN 'rpr' ELSE 'culture' END AS lab_test, l_shipdate::DATE AS day,
        CASE WHEN l_linenumber <> 7 THEN CASE WHEN l_returnflag = 'N' THEN 'Positive' ELSE CAST(l_quantity AS INTEGER)::VARCHAR END END AS result FROM lineitem)"""


def _sources(t):
    key = F.col("o_orderkey")
    orders = t.orders.select(key.alias("source_encounter_id"), "o_orderpriority", "o_orderstatus")
    return {
        "intake_forms": orders.select("source_encounter_id", F.col("o_orderpriority").alias("recommendations")),
        "followup_forms": orders.select("source_encounter_id", F.col("o_orderpriority").alias("progress")),
        "exams": orders.filter("source_encounter_id % 2 = 0").select("source_encounter_id", F.col("o_orderstatus").alias("presenting_complaint")),
        "exam_extra": orders.filter("source_encounter_id % 3 = 0").select("source_encounter_id", F.col("o_orderstatus").alias("who_stage")),
        "exam_labs": _labs(t).filter(F.col("result").isNotNull()),
        "labs": _labs(t).filter(F.col("result").isNotNull()),
        "generic_orders": t.lineitem.select(F.col("l_orderkey").alias("source_encounter_id"), F.col("l_linenumber").alias("ordered"), F.col("l_linestatus").alias("comments")),
        "vitals": t.events.select(F.expr("event_id").alias("source_encounter_id"), s.pick("event_id", ["weight", "height", "temperature"], 1, 12).alias("sign"), F.col("value").alias("result"),
                                  s.pick("event_id", ["kgs", None], 1, 36).alias("result_unit")),
    }


# All kinds of documents with their encounters' types, and the lists of labs and orders as text.
DOCS_SQL = f"""{ENC}, {LAB_SQL}, xl AS (SELECT source_encounter_id AS id, string_agg(lab_test || ':' || strftime(day, '%Y-%m-%d') || ':' || result, ',' ORDER BY lab_test, day, result) AS listed FROM x WHERE result IS NOT NULL GROUP BY 1),
    ol AS (SELECT l_orderkey AS id, string_agg(l_linenumber || l_linestatus, ',' ORDER BY l_linenumber, l_linestatus) AS listed FROM lineitem GROUP BY 1),
    k(kind, type) AS (VALUES ('intake', 'intake'), ('followup', 'followup'), ('patient_contact', 'patient_contact'), ('cervical_cancer', 'cervical_cancer'), ('nutritional_evaluation', 'food_study'), ('lab_result', 'lab_result'),
        ('food_support', 'food_support'), ('regimen_change', 'regime'), ('medication_pickup', 'accompagnateur'), ('note', 'note'), ('pregnancy_entry', 'pregnancy'), ('postnatal', 'infant_followup')),
    d AS (SELECT kind, enc.*, CASE WHEN kind IN ('intake', 'followup', 'patient_contact', 'cervical_cancer', 'nutritional_evaluation', 'lab_result') THEN xl.listed END AS labs, CASE WHEN kind IN ('intake', 'followup') THEN ol.listed END AS ordered
        FROM enc JOIN k ON source_encounter_type = type LEFT JOIN xl ON xl.id = source_encounter_id LEFT JOIN ol ON ol.id = source_encounter_id WHERE kind <> 'note' OR note_title IS NULL OR note_title <> 'Uploaded from')"""


def _lab_text(labs):
    return F.array_join(F.transform(labs, lambda x: F.concat_ws(":", x["lab_test"], day_text(x["test_date"]), x["result"])), ",")


@query("l9_patient_document", f"""
    WITH {DOCS_SQL}
    SELECT c_custkey AS source_patient_id, c_name, {", ".join(f"string_agg(source_encounter_id || '@' || strftime(encounter_date, '%Y-%m-%d') || '[' || coalesce(labs, '') || ']', ' ' ORDER BY source_encounter_id) FILTER (kind = '{k}') AS {k}" for k in docs.DOCUMENTS)}
    FROM customer LEFT JOIN d ON source_patient_id = c_custkey GROUP BY 1, 2
""")
def patient_document(t):
    visits, sources = s.encounters(t, KINDS), _sources(t)
    lists = {kind: docs.encounter_documents(kind, visits, sources) for kind in docs.DOCUMENTS}
    nested = docs.patient_documents(t.customer.select(F.col("c_custkey").alias("source_patient_id"), "c_name"), lists)

    def text(kind):
        column = next((c for c in ("exam_labs", "labs") if c in lists[kind].columns), None)
        one = lambda d: F.concat(d["source_encounter_id"].cast("string"), F.lit("@"), day_text(d["encounter_date"]), F.lit("["),
                                 F.coalesce(_lab_text(d[column]), F.lit("")) if column else F.lit(""), F.lit("]"))
        return F.array_join(F.transform(kind, one), " ").alias(kind)

    return nested.select("source_patient_id", "c_name", *[text(kind) for kind in lists])


@query("l9_patient_json", f"""
    WITH {ENC}, n AS (SELECT source_patient_id AS p, '[' || string_agg('{{"source_encounter_id":' || source_encounter_id || ',"source_encounter_type":"' || source_encounter_type || '"}}', ',' ORDER BY source_encounter_id) || ']' AS items FROM enc GROUP BY 1)
    SELECT c_custkey AS source_patient_id, '{{"source_patient_id":' || c_custkey || CASE WHEN items IS NULL THEN '' ELSE ',"encounters":' || items END || '}}' AS json FROM customer LEFT JOIN n ON p = c_custkey
""")
def patient_json(t):
    from chartlift.sources.writers import export_json

    visits = s.encounters(t, KINDS).select("source_patient_id", "source_encounter_id", "source_encounter_type")
    nested = docs.patient_documents(t.customer.select(F.col("c_custkey").alias("source_patient_id")), {"encounters": visits})
    return export_json(nested, keep=("source_patient_id",))


@query("l10_intake_documents", f"""
    WITH {ENC}, {LAB_SQL}, xc AS (SELECT source_encounter_id, count(*) AS n FROM x WHERE result IS NOT NULL GROUP BY 1), lc AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
    ob AS (SELECT event_id // 8 AS id, max(props) FILTER (event_type = 'click') AS cough FROM events GROUP BY 1)
    SELECT enc.source_encounter_id, source_patient_id, o_orderpriority AS recommendations, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS presenting_complaint, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS who_stage,
        round(CASE WHEN (event_id // 12) % 3 = 0 THEN CASE WHEN (event_id // 36) % 2 = 0 THEN value ELSE value / 2.20462 END END, 6) AS weight, round(CASE WHEN (event_id // 12) % 3 = 1 THEN CASE WHEN value < 3 THEN round(value * 100, 1) ELSE value END END, 6) AS height,
        coalesce(xc.n, 0) AS labs, coalesce(lc.n, 0) AS ordered, cough
    FROM enc JOIN orders ON o_orderkey = enc.source_encounter_id LEFT JOIN events ON event_id = o_orderkey LEFT JOIN xc ON xc.source_encounter_id = o_orderkey LEFT JOIN lc ON l_orderkey = o_orderkey LEFT JOIN ob ON ob.id = o_orderkey
    WHERE source_encounter_type = 'intake'
""")
def intake_documents(t):
    observations = t.events.select(F.expr("event_id div 8").alias("source_encounter_id"), F.col("event_type").alias("observation"), F.col("props").alias("value"))
    nested = docs.encounter_documents("intake", s.encounters(t, KINDS), _sources(t), observations, {"cough": "click"})

    def size(name):
        return F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.size(name)).cast("long")

    return nested.select("source_encounter_id", "source_patient_id", "recommendations", "presenting_complaint", "who_stage", F.round("weight", 6).alias("weight"), F.round("height", 6).alias("height"),
                         size("exam_labs").alias("labs"), size("generic_orders").alias("ordered"), "cough")


@query("l10_encounter_documents", f"""
    WITH {DOCS_SQL}
    SELECT kind, d.source_encounter_id, labs, ordered, CASE WHEN kind = 'followup' THEN o_orderpriority END AS progress, CASE WHEN kind = 'followup' AND o_orderkey % 2 = 0 THEN o_orderstatus END AS presenting_complaint,
        CASE WHEN kind IN ('followup', 'cervical_cancer', 'pregnancy_entry') AND o_orderkey % 3 = 0 THEN o_orderstatus END AS who_stage,
        CASE WHEN kind IN ('followup', 'patient_contact', 'nutritional_evaluation') THEN round(CASE WHEN (event_id // 12) % 3 = 0 THEN CASE WHEN (event_id // 36) % 2 = 0 THEN value ELSE value / 2.20462 END END, 6) END AS weight,
        CASE WHEN kind IN ('followup', 'patient_contact', 'nutritional_evaluation') THEN round(CASE WHEN (event_id // 12) % 3 = 1 THEN CASE WHEN value < 3 THEN round(value * 100, 1) ELSE value END END, 6) END AS height, d.comments, d.note_title
    FROM d JOIN orders ON o_orderkey = d.source_encounter_id LEFT JOIN events ON event_id = o_orderkey WHERE kind <> 'intake'
""")
def encounter_documents(t):
    visits, sources = s.encounters(t, KINDS), _sources(t)
    result = None
    for kind in docs.DOCUMENTS:
        if kind == "intake":
            continue
        rows = docs.encounter_documents(kind, visits, sources)
        column = next((c for c in ("exam_labs", "labs") if c in rows.columns), None)
        labs = _lab_text(F.col(column)) if column else F.lit(None).cast("string")
        ordered = F.array_join(F.transform("generic_orders", lambda x: F.concat(x["ordered"].cast("string"), x["comments"])), ",") if "generic_orders" in rows.columns else F.lit(None).cast("string")
        texts = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("progress", "presenting_complaint", "who_stage")]
        signs = [(F.round(c, 6) if c in rows.columns else F.lit(None).cast("double")).alias(c) for c in ("weight", "height")]
        one = rows.select(F.lit(kind).alias("kind"), "source_encounter_id", labs.alias("labs"), ordered.alias("ordered"), *texts, *signs, "comments", "note_title")
        result = one if result is None else result.unionByName(one)
    return result


@query("l11_addresses", """
    SELECT o_custkey AS source_patient_id, o_orderpriority AS address, coalesce(n_name, 'dep') AS department,
        row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderpriority, o_orderkey)::INTEGER AS position FROM orders LEFT JOIN nation ON n_nationkey = o_orderkey % 30
""")
def addresses(t):
    from chartlift.operators.aggregates import child_rows

    key = F.col("o_orderkey")
    nothing = F.lit(None).cast("string")
    rows = t.orders.select(
        F.col("o_custkey").alias("source_patient_id"), F.when(F.col("o_orderstatus") == "O", "current").otherwise("previous").alias("address_type"), F.to_date("o_orderdate").alias("entry_date"),
        F.col("o_orderpriority").alias("address"), F.lit("dep").alias("department"), nothing.alias("commune"), key.alias("section"), nothing.alias("locality"), (key % 30).cast("int").alias("locality_id"),
    )
    places = t.nation.select(F.col("n_nationkey").alias("locality_id"), F.col("n_name").alias("department"), nothing.alias("commune"), F.lit(None).cast("long").alias("section"), nothing.alias("locality"))
    facts = docs.address_facts(rows, places)
    placed = child_rows(facts, ["source_patient_id"], ["rank_key", "address", "section", "department"], "a")
    return placed.select("source_patient_id", "a.address", "a.department", F.col("position").cast("int").alias("position"))


@query("l11_patient_facts", """
    SELECT 'allergy' AS fact, l_suppkey AS source_patient_id, CASE WHEN l_linenumber > 3 THEN l_linestatus ELSE l_returnflag END AS value FROM lineitem
    UNION ALL SELECT 'diagnosis', event_id // 8, coalesce(n_name, event_type) FROM events LEFT JOIN nation ON n_nationkey = event_id % 40
    UNION ALL SELECT 'treatment', o_custkey, o_orderpriority FROM orders
    UNION ALL SELECT DISTINCT 'course', o_custkey, o_orderstatus FROM orders
    UNION ALL SELECT 'socioeconomics', c_custkey, c_mktsegment || coalesce(n_name, '-') FROM customer LEFT JOIN nation ON n_nationkey = c_custkey
    UNION ALL SELECT 'hiv_status', user_id, arg_max(event_type, struct_pack(a := ts::DATE, b := event_id)) FROM events GROUP BY user_id
""")
def patient_facts(t):
    key = F.col("event_id")
    nothing = F.lit(None).cast("string")
    allergies = t.lineitem.select(F.col("l_suppkey").alias("source_patient_id"), F.when(F.col("l_linenumber") > 3, F.col("l_linestatus")).alias("inn"), F.col("l_returnflag").alias("other_reason"),
                                  F.to_date("l_shipdate").alias("allergy_date"), nothing.alias("type_of_reaction"))
    diagnoses = t.events.select(F.expr("event_id div 8").alias("source_patient_id"), (key % 40).cast("int").alias("diagnosis_id"), F.col("event_type").alias("diagnosis_other"), nothing.alias("present_p"),
                                F.to_date("ts").alias("diagnosis_date"), nothing.alias("diagnosis_comments"))
    names = t.nation.select(F.col("n_nationkey").alias("diagnosis_id"), F.col("n_name").alias("diagnosis_eng"))
    exposures = t.orders.select(F.col("o_custkey").alias("source_patient_id"), F.col("o_orderpriority").alias("inn"), nothing.alias("treatment_other"), F.to_date("o_orderdate").alias("start_date"),
                                F.to_date("o_orderdate").alias("end_date"), nothing.alias("treatment_outcome"))
    courses = t.orders.select(F.col("o_custkey").alias("source_patient_id"), F.col("o_orderstatus").alias("patient_tx_id"), F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    socio = docs.socioeconomic_facts(
        t.customer.select(F.col("c_custkey").alias("source_patient_id"), "c_mktsegment"), t.nation.select(F.col("n_nationkey").cast("long").alias("source_patient_id"), F.col("n_name").alias("way"))
    )
    status = t.events.select(F.col("user_id").alias("source_patient_id"), F.col("event_type").alias("hiv_positive_p"), nothing.alias("status_date"), nothing.alias("test_location"), nothing.alias("test_location_other"),
                             F.to_date("ts").alias("entered_date"), key.alias("status_id"))
    diagnosed = docs.diagnosis_facts(diagnoses, names)
    parts = {
        "allergy": docs.allergy_facts(allergies).withColumn("value", F.col("allergen")), "diagnosis": diagnosed.withColumn("value", F.coalesce("coded", "non_coded")),
        "treatment": docs.treatment_facts(exposures).withColumn("value", F.col("coded")), "course": docs.treatment_course_facts(courses).withColumn("value", F.col("identifier")),
        "socioeconomics": socio.withColumn("value", F.concat("c_mktsegment", F.coalesce("way", F.lit("-")))), "hiv_status": docs.hiv_status_facts(status).withColumn("value", F.col("hiv_positive_p")),
    }
    result = None
    for name, frame in parts.items():
        one = frame.select(F.lit(name).alias("fact"), "source_patient_id", "value")
        result = one if result is None else result.unionByName(one)
    return result


@query("l12_lab_result_facts", f"""
    WITH {LAB_SQL}, r AS (SELECT event_id AS source_encounter_id, CASE WHEN event_id % 3 = 0 THEN value END AS num, CASE WHEN event_id % 3 = 1 THEN CASE event_id % 2 WHEN 0 THEN 't' ELSE 'f' END END AS sign,
        CASE WHEN event_id % 3 = 2 THEN '1,' || CAST(floor(value) AS INTEGER) END AS words FROM events)
    SELECT source_encounter_id, lab_test, CASE WHEN lab_test = 'cd4' THEN CAST(result AS DOUBLE) END AS numeric, CASE WHEN lab_test = 'rpr' THEN 'POSITIVE' END AS coded, CASE WHEN lab_test = 'culture' THEN result END AS text FROM x WHERE result IS NOT NULL
    UNION ALL SELECT source_encounter_id, 'viral_load', coalesce(num, CAST(replace(words, ',', '') AS DOUBLE)), CASE sign WHEN 't' THEN 'POSITIVE' WHEN 'f' THEN 'NEGATIVE' END, NULL FROM r
""")
def lab_result_facts(t):
    key = F.col("event_id")
    lab = t.events.select(
        key.alias("source_encounter_id"), F.lit("viral_load").alias("lab_test"), F.to_date("ts").alias("test_date"), F.lit(None).cast("string").alias("sample_id"), F.when(key % 3 == 0, F.col("value")).alias("value_numeric"),
        F.when(key % 3 == 1, F.when(key % 2 == 0, "t").otherwise("f")).alias("value_boolean"), F.when(key % 3 == 2, F.concat(F.lit("1,"), F.floor("value").cast("int").cast("string"))).alias("value_text"),
    )
    return docs.lab_result_facts(_labs(t), lab).select("source_encounter_id", "lab_test", "numeric", "coded", "text")


@query("l12_responsible_persons", """
    SELECT o_orderkey AS source_encounter_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || ' ' || o_orderpriority ELSE o_orderpriority END AS first_name, CASE WHEN o_orderkey % 5 = 0 THEN 'Last' END AS last_name, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS dossier_id FROM orders
""")
def responsible_persons(t):
    key, nothing = F.col("o_orderkey"), F.lit(None).cast("string")
    rows = t.orders.select(
        key.alias("source_encounter_id"), F.when(key % 2 == 0, F.col("o_orderstatus")).alias("responsible_first_name"), F.col("o_orderpriority").alias("responsible_first_name2"),
        F.when(key % 5 == 0, "Last").alias("responsible_last_name"), F.when(key % 3 == 0, F.col("o_orderstatus")).alias("responsible_dossier_id"), nothing.alias("responsible_relation"),
    )
    return docs.responsible_person_facts(rows).select("source_encounter_id", "first_name", "last_name", "dossier_id")


@query("l12_vital_facts", """
    WITH v AS (SELECT event_id // 8 AS id, (['weight', 'height', 'temperature', 'bmi'])[event_id % 4 + 1] AS sign, value, CASE WHEN event_id % 3 = 0 THEN 'KGS' END AS unit FROM events)
    SELECT id AS source_encounter_id, round(max(CASE WHEN unit = 'KGS' THEN value ELSE value / 2.20462 END) FILTER (sign = 'weight'), 6) AS weight, max(CASE WHEN value < 3 THEN round(value * 100, 1) ELSE value END) FILTER (sign = 'height') AS height,
        max(value) FILTER (sign = 'temperature') AS temperature FROM v WHERE sign <> 'bmi' GROUP BY 1
""")
def vital_facts(t):
    rows = t.events.select(F.expr("event_id div 8").alias("source_encounter_id"), s.pick("event_id", ["weight", "height", "temperature", "bmi"]).alias("sign"), F.col("value").alias("result"), F.when(F.col("event_id") % 3 == 0, "KGS").alias("result_unit"))
    return docs.vital_facts(rows, ("weight", "height", "temperature")).withColumn("weight", F.round("weight", 6))


@query("l13_user_map", "SELECT c_custkey AS user_id, lower(c_mktsegment) AS email, n_name AS first_name, c_name AS last_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def user_map(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.lit("x").alias("password"), F.lit("y").alias("salt"))
    parties = t.customer.select(F.col("c_custkey").alias("party_id"), F.lower("c_mktsegment").alias("email"))
    persons = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("person_id"), F.col("n_name").alias("first_names"), F.col("c_name").alias("last_name"))
    return docs.user_map(users, parties, persons).select("user_id", "email", "first_name", "last_name")


@query("l14_misfiled_labs", f"""
    WITH {ENC}, {LAB_SQL}, w AS (SELECT source_encounter_id, 90000 + row_number() OVER (ORDER BY source_encounter_id) - 1 AS fresh FROM enc WHERE source_encounter_type IN ('regime', 'food_support', 'note', 'accompagnateur')
        AND source_encounter_id IN (SELECT source_encounter_id FROM x))
    SELECT source_encounter_id, fresh AS new_encounter_id, lab_test, result FROM x JOIN w USING (source_encounter_id)
""")
def misfiled_labs(t):
    _, moved = docs.misfiled_labs(_labs(t), s.encounters(t, KINDS), 90000)
    return moved.select("source_encounter_id", "new_encounter_id", "lab_test", "result")


# ---- change log


def _change_log(t):
    """Events written as a change log of several files: id, status, patient, payload."""
    path = scratch_path(t.spark, "change-log")
    rows = t.events.select(
        F.col("event_id").alias("id"), F.when(F.col("event_id") % 10 == 0, "DONE").otherwise("NEW").alias("status"), F.col("user_id").alias("patient_id"), "event_type", "value"
    )
    rows.repartitionByRange(4, "id").write.parquet(path)
    return path, rows.schema


def _applied(t):
    path, schema = _change_log(t)
    state, acks = scratch_path(t.spark, "state"), scratch_path(t.spark, "acks")
    stream = changes.change_log_stream(t.spark, path, schema, files_per_batch=1)
    changes.apply_changes(stream, state, acks, scratch_path(t.spark, "progress"), ["patient_id"]).awaitTermination()
    return state, acks


@query("m1_change_log_stream", "SELECT event_id AS id, user_id AS patient_id, event_type FROM events WHERE event_id % 10 <> 0")
def change_log_stream(t):
    path, schema = _change_log(t)
    target = scratch_path(t.spark, "new-changes")
    stream = changes.change_log_stream(t.spark, path, schema, files_per_batch=2)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(t.spark, "progress")).option("path", target)
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(target).select("id", "patient_id", "event_type")


@query("m2_apply_changes", """
    SELECT user_id AS patient_id, max(event_id) AS id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events WHERE event_id % 10 <> 0 GROUP BY user_id
""")
def apply_changes(t):
    state, _ = _applied(t)
    return changes.current_state(t.spark, state, ["patient_id"]).select("patient_id", "id", "event_type", "value")


@query("m3_ack_processed", "SELECT event_id AS id, 'DONE' AS status FROM events WHERE event_id % 10 <> 0")
def ack_processed(t):
    _, acks = _applied(t)
    return changes.acknowledged(t.spark, acks)
