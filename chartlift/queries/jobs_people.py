"""People jobs over stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions.dates import day_text
from chartlift.plans import people
from chartlift.queries import standins as s
from chartlift.queries.registry import query

AS_OF = "2001-06-01"

# ---- users


def _user_view(t):
    key = F.col("c_custkey")
    email = F.concat(F.when(key % 7 == 0, "`").otherwise(""), F.lower("c_mktsegment"), (key % 40).cast("string"), F.lit("@clinic"))
    return t.customer.select(
        key.alias("source_user_id"), email.alias("email"), F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"),
        F.lit("x").alias("password"), F.lit("y").alias("salt"),
        s.pick("c_custkey", ["approved", "deleted", "banned"], 1, 2).alias("member_state"),
    )


USER_SQL = f"""u AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN '`' ELSE '' END || lower(c_mktsegment) || c_custkey % 40 || '@clinic' AS email,
    lower(c_mktsegment) || c_custkey % 40 AS name, {s.pick_sql('c_custkey', ['approved', 'deleted', 'banned'], 1, 2)} AS state FROM customer)"""


@query("k1_users", f"""
    WITH {USER_SQL}
    SELECT id AS source_user_id, CASE WHEN name IN (SELECT lower(c_mktsegment) || '3' FROM customer) THEN name || '-' || id ELSE name END AS username,
        CASE WHEN email NOT LIKE '`%' THEN email END AS email, true AS retired, CASE WHEN state <> 'approved' THEN state ELSE 'migration reset' END AS retire_reason FROM u
""")
def users(t):
    existing = t.customer.select(F.concat(F.lower("c_mktsegment"), F.lit("3")).alias("username"))
    return people.users(_user_view(t), existing, AS_OF).select("source_user_id", "username", "email", "retired", "retire_reason")


@query("k1_users_prototype", f"""
    WITH {USER_SQL}
    SELECT id + 100 AS user_id, id + 100 AS person_id, split_part(email, '@', 1) || '-' || id AS username, split_part(email, '@', 1) || '-' || id AS system_id,
        state <> 'approved' AS retired, CASE WHEN state <> 'approved' THEN state END AS retire_reason FROM u
""")
def users_prototype(t):
    return people.users_prototype(_user_view(t), AS_OF)["users"].select(
        "user_id", "person_id", "username", "system_id", "retired", "retire_reason"
    )


@query("k2_locations", f"""
    WITH m(site, uuid) AS (VALUES {", ".join(f"({n}, '{u}')" for n, u in people.SITE_LOCATIONS)})
    SELECT c_custkey, c_nationkey AS site, uuid AS location_uuid FROM customer LEFT JOIN m ON site = c_nationkey
""")
def locations(t):
    sites = people.site_map(t.spark)
    return t.customer.select("c_custkey", F.col("c_nationkey").alias("site")).join(sites, "site", "left")


# ---- patients

OUTCOME_WORDS = ["died", "lost", None, "transferred_out"]


def _patients(t):
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("source_patient_id"), F.when(key % 3 != 0, F.concat(F.lit("D"), key.cast("string"))).alias("dossier_id"),
        s.pick("c_custkey", [" F1 ", "", None, "F2", "F3"]).alias("nif_id"),
        F.when(key % 4 != 0, F.concat(F.lit(" N"), (key % 700).cast("string"))).otherwise("").alias("national_id"),
        F.when(key % 13 != 0, F.col("c_mktsegment")).alias("first_name"), s.pick("c_custkey", [None, "Second"]).alias("first_name2"),
        F.when(key % 11 != 0, F.col("c_name")).alias("last_name"), s.pick("c_custkey", [None, "UNKNOWN", "Nick"]).alias("nickname"),
        s.pick("c_custkey", ["m", "f"]).alias("gender"), s.day_after("1875-01-01", (key * 37) % 47000).alias("birthdate"),
        (key % 2).cast("int").alias("birthdate_estimated"), s.pick("c_custkey", [None, "555"]).alias("phone_number"),
        (key % 50).alias("patient_created_by"), s.day_after("1999-01-01", key % 900).alias("patient_created_date"),
        s.pick("c_custkey", OUTCOME_WORDS).alias("outcome"), s.day_after("1980-01-01", key % 9000).alias("outcome_date"),
        (key % 45).cast("int").alias("health_center"), (key % 43).cast("int").alias("starting_health_center"),
        F.when(key % 5 == 0, F.concat(F.lit("Helper"), key.cast("string"))).alias("accompagnateur_name"),
    )


def _staged_patients(t):
    return people.stage_patients(_patients(t)).withColumn("person_id", F.col("source_patient_id") + 5000)


PATIENT_SQL = f"""p AS (SELECT c_custkey AS id, c_custkey + 5000 AS person_id, CASE WHEN c_custkey % 3 <> 0 THEN 'D' || c_custkey END AS dossier,
    trim({s.pick_sql('c_custkey', [' F1 ', '', None, 'F2', 'F3'])}) AS nif, CASE WHEN c_custkey % 4 <> 0 THEN 'N' || c_custkey % 700 ELSE '' END AS national,
    CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS first, {s.pick_sql('c_custkey', [None, 'Second'])} AS second, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS last,
    {s.pick_sql('c_custkey', [None, 'UNKNOWN', 'Nick'])} AS nick, {s.pick_sql('c_custkey', ['M', 'F'])} AS gender,
    DATE '1875-01-01' + CAST(c_custkey * 37 % 47000 AS INTEGER) AS born, {s.pick_sql('c_custkey', OUTCOME_WORDS)} AS outcome,
    DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS ended, nullif(nullif(CAST(c_custkey % 45 AS INTEGER), 0), 42) AS here,
    nullif(nullif(CAST(c_custkey % 43 AS INTEGER), 0), 42) AS start FROM customer)"""
GIVEN_SQL = "first || CASE WHEN second IS NULL THEN '' ELSE ' ' || second END"


@query("k4_patients", f"""
    WITH {PATIENT_SQL}
    SELECT 999 + row_number() OVER (ORDER BY id) AS person_id, gender, born::VARCHAR AS birthdate, coalesce(outcome = 'died', false) AS dead,
        CASE WHEN outcome = 'died' THEN ended::VARCHAR END AS death_date, CASE WHEN id % 50 % 2 = 0 THEN id % 50 // 2 + 7 END AS creator FROM p
""")
def patients(t):
    staged = people.stage_patients(_patients(t), start=999 + 1)
    user_ids = t.customer.select((F.col("c_custkey") * 2).alias("source_user_id"), (F.col("c_custkey") + 7).alias("user_id"))
    return people.patient_persons(staged, user_ids).select(
        "person_id", "gender", day_text("birthdate").alias("birthdate"), "dead", day_text("death_date").alias("death_date"), "creator"
    )


@query("k4_patient_names", f"""
    WITH {PATIENT_SQL}
    SELECT person_id, coalesce({GIVEN_SQL}, 'UNKNOWN') AS given_name, nick AS middle_name, coalesce(last, 'UNKNOWN') AS family_name FROM p
""")
def patient_names(t):
    return people.patient_names(_staged_patients(t)).select("person_id", "given_name", "middle_name", "family_name")


@query("k4_patient_sites", f"""
    WITH {PATIENT_SQL} SELECT person_id, coalesce(here, start) AS health_center, coalesce(start, here) AS starting_health_center FROM p
""")
def patient_sites(t):
    return _staged_patients(t).select("person_id", "health_center", "starting_health_center")


def _addresses(t):
    key = F.col("o_orderkey")
    raw = t.orders.select(
        key.alias("address_id"), F.col("o_custkey").alias("source_patient_id"), s.pick("o_orderkey", ["current", "previous"]).alias("address_type"),
        F.to_date("o_orderdate").alias("entry_date"), F.repeat("o_orderpriority", (key % 40).cast("int") + 1).alias("address"),
        F.lit("dep").alias("department"), F.col("o_orderstatus").alias("commune"), F.lit(None).cast("string").alias("section"),
        F.lit("loc").alias("locality"), (key % 30).cast("int").alias("locality_id"),
    )
    localities = t.nation.select(
        F.col("n_nationkey").alias("locality_id"), F.col("n_name").alias("department"), F.lit(None).cast("string").alias("commune"),
        F.concat(F.lit("sec"), F.col("n_regionkey").cast("string")).alias("section"), F.col("n_name").alias("locality"),
    )
    return people.stage_addresses(raw, localities)


@query("k4_patient_addresses", """
    SELECT o_custkey + 5000 AS person_id, o_orderkey % 2 = 0 AS preferred, coalesce(n_name, 'loc') AS address1,
        left(repeat(o_orderpriority, CAST(o_orderkey % 40 + 1 AS INTEGER)), 255) AS address2, o_orderstatus AS city_village,
        coalesce(n_name, 'dep') AS state_province, 'sec' || n_regionkey AS address3, 'Haiti' AS country
    FROM orders LEFT JOIN nation ON n_nationkey = o_orderkey % 30
""")
def patient_addresses(t):
    rows = people.patient_addresses(_addresses(t), _staged_patients(t))
    return rows.select("person_id", "preferred", "address1", "address2", "city_village", "state_province", "address3", "country")


@query("k4_patient_identifiers", f"""
    WITH {PATIENT_SQL}
    SELECT person_id, 'source_id' AS kind, id::VARCHAR AS identifier, false AS preferred FROM p
    UNION ALL SELECT person_id, 'dossier', dossier, false FROM p WHERE dossier IS NOT NULL
    UNION ALL SELECT person_id, 'national', national, false FROM p WHERE national <> ''
    UNION ALL SELECT person_id, 'fiscal', nif, false FROM p WHERE nif <> ''
    UNION ALL SELECT person_id, 'emr', 'E' || id, true FROM p WHERE id % 2 = 0
""")
def patient_identifiers(t):
    pool = t.customer.filter("c_custkey % 2 = 0").select(
        (F.col("c_custkey") + 5000).alias("person_id"), F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("identifier")
    )
    return people.patient_identifiers(_staged_patients(t), pool)


@query("k4_patient_phones", "SELECT c_custkey + 5000 AS person_id, '555' AS value FROM customer WHERE c_custkey % 2 = 1")
def patient_phones(t):
    return people.patient_phones(_staged_patients(t)).select("person_id", "value")


@query("k4_patient_warnings", f"""
    WITH {PATIENT_SQL}
    SELECT person_id AS patient_id, 'Patient missing name. Defaulted to "UNKNOWN"' AS warning_type,
        CASE WHEN first IS NULL AND last IS NULL THEN 'given name and family name' WHEN first IS NULL THEN 'given name' ELSE 'family name' END AS field_name, NULL AS field_value
        FROM p WHERE first IS NULL OR last IS NULL
    UNION ALL SELECT o_custkey + 5000, 'Address too long. Truncated to 255 characters.', 'address', repeat(o_orderpriority, CAST(o_orderkey % 40 + 1 AS INTEGER))
        FROM orders WHERE length(o_orderpriority) * (o_orderkey % 40 + 1) > 255
    UNION ALL SELECT person_id, 'Death date before birth date', 'death_date', ended::VARCHAR FROM p WHERE outcome = 'died' AND ended < born
    UNION ALL SELECT person_id, 'Duplicate National_ID', 'national_id', national FROM p WHERE national <> '' AND national IN (SELECT national FROM p GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT person_id, 'Duplicate nif_id', 'nif_id', nif FROM p WHERE nif <> '' AND nif IN (SELECT nif FROM p GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT person_id, 'Abnormal birthdate value', 'birthdate', born::VARCHAR FROM p WHERE born > DATE '2001-06-01' OR born < DATE '1881-06-01'
""")
def patient_warnings(t):
    rows = people.patient_warnings(_staged_patients(t), _addresses(t), AS_OF)
    return rows.select("patient_id", "warning_type", "field_name", "field_value")


# ---- infants


def _infants(t):
    key = F.col("s_suppkey")
    return t.supplier.select(
        key.alias("source_infant_id"), F.when(key % 9 == 0, key).alias("patient_id"),
        F.when(key % 4 != 0, key * 17).alias("mother_patient_id"), F.when(key % 5 == 0, key * 3).alias("father_patient_id"),
        F.concat(F.lit(" I"), key.cast("string"), F.lit(" ")).alias("infant_code"), s.pick("s_suppkey", ["Ann", None]).alias("first_name"),
        s.pick("s_suppkey", ["Li", None], 1, 2).alias("last_name"), s.pick("s_suppkey", ["m", None, "f"]).alias("gender"),
        F.when(key % 6 != 0, s.day_after("1965-01-01", (key * 151) % 14000)).alias("birthdate"), (key % 30).cast("int").alias("health_center"),
        s.pick("s_suppkey", ["positive", "negative", "undetermined", None]).alias("hiv_status"),
        s.pick("s_suppkey", ["dead", "alive"]).alias("vital_status"), F.lit("1999-09-09").cast("date").alias("vital_status_date"),
        s.pick("s_suppkey", [None, "Mother"], 1, 3).alias("non_emr_mother"),
    )


def _staged_infants(t):
    return people.stage_infants(_infants(t), s.patient_ids(t)).withColumn("person_id", F.col("source_infant_id") + 90000)


INFANT_SQL = f"""i0 AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 9 = 0 THEN s_suppkey END AS patient_id, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey * 17 END AS mother,
    CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey * 3 END AS father, 'I' || s_suppkey AS code, {s.pick_sql('s_suppkey', ['Ann', None])} AS first,
    {s.pick_sql('s_suppkey', ['Li', None], 1, 2)} AS last, {s.pick_sql('s_suppkey', ['M', None, 'F'])} AS gender,
    CASE WHEN s_suppkey % 6 <> 0 THEN DATE '1965-01-01' + CAST(s_suppkey * 151 % 14000 AS INTEGER) END AS born, s_suppkey % 30 AS site,
    {s.pick_sql('s_suppkey', ['positive', 'negative', 'undetermined', None])} AS status, {s.pick_sql('s_suppkey', [None, 'Mother'], 1, 3)} AS non_emr FROM supplier),
    i AS (SELECT * FROM i0 WHERE patient_id IS NULL AND (mother IS NULL OR mother IN (SELECT c_custkey FROM customer)) AND (father IS NULL OR father IN (SELECT c_custkey FROM customer)))"""


@query("k5_infants", f"""
    WITH {INFANT_SQL}
    SELECT id + 90000 AS person_id, coalesce(gender, 'U') AS gender, born::VARCHAR AS birthdate, id % 2 = 0 AS dead,
        CASE WHEN id % 2 = 0 THEN '1999-09-09' END AS death_date, coalesce(first, 'UNKNOWN') AS given_name, coalesce(last, 'UNKNOWN') AS family_name FROM i
""")
def infants(t):
    return people.infant_persons(_staged_infants(t)).select(
        "person_id", "gender", day_text("birthdate").alias("birthdate"), "dead", day_text("death_date").alias("death_date"), "given_name", "family_name"
    )


@query("k5_infant_encounters", f"""
    WITH {INFANT_SQL}, e AS (SELECT i.*, coalesce(n_nationkey + 100, 1) AS location_id, coalesce(born, DATE '1999-09-09')::VARCHAR AS day FROM i LEFT JOIN nation ON n_nationkey = site)
    SELECT 'registration' AS encounter_type, id + 90000 AS person_id, day, location_id FROM e
    UNION ALL SELECT 'infant documentation', id + 90000, day, location_id FROM e WHERE status IS NOT NULL OR non_emr IS NOT NULL
""")
def infant_encounters(t):
    sites = t.nation.select(F.col("n_nationkey").alias("site"), (F.col("n_nationkey") + 100).alias("location_id"))
    rows = people.infant_encounters(_staged_infants(t), sites, AS_OF)
    return rows.select("encounter_type", "person_id", day_text("encounter_date").alias("day"), "location_id")


@query("k5_infant_obs", s.obs_sql(INFANT_SQL + ", i2 AS (SELECT id AS source_encounter_id, * FROM i)", [
    ("i2", "CIEL:1169", "coded", "CASE status WHEN 'positive' THEN 'LOCAL:POSITIVE' WHEN 'negative' THEN 'LOCAL:NEGATIVE' ELSE 'LOCAL:unknown' END", "status IS NOT NULL", False),
    ("i2", "LOCAL:Contact construct", "group", "", "non_emr IS NOT NULL", False),
    ("i2", "LOCAL:FIRST NAME", "text", "non_emr", "non_emr IS NOT NULL", True),
    ("i2", "LOCAL:Gender", "coded", "'LOCAL:FEMALE'", "non_emr IS NOT NULL", True),
    ("i2", "LOCAL:RELATIONSHIP OF RELATIVE TO PATIENT", "coded", "'LOCAL:MOTHER'", "non_emr IS NOT NULL", True),
]))
def infant_obs(t):
    return s.obs_view(people.infant_obs(_staged_infants(t)))


@query("k5_infant_links", f"""
    WITH {INFANT_SQL}
    SELECT mother + 5000 AS person_a, id + 90000 AS person_b, 'mother' AS parent, born::VARCHAR AS start_date FROM i WHERE mother IS NOT NULL
    UNION ALL SELECT father + 5000, id + 90000, 'father', born::VARCHAR FROM i WHERE father IS NOT NULL
""")
def infant_links(t):
    rows = people.infant_relationships(_staged_infants(t), s.patient_ids(t))
    return rows.select("person_a", "person_b", "parent", day_text("start_date").alias("start_date"))


@query("k5_infant_identifiers", f"""
    WITH {INFANT_SQL} SELECT id + 90000 AS person_id, 'infant_id' AS kind, id::VARCHAR AS identifier FROM i UNION ALL SELECT id + 90000, 'infant_code', code FROM i
""")
def infant_identifiers(t):
    return people.infant_identifiers(_staged_infants(t))


@query("k5_infant_warnings", f"""
    WITH {INFANT_SQL}
    SELECT NULL::BIGINT AS patient_id, 'Infant has patient record, skipping importing infant record' AS warning_type, 'infant_id' AS field_name, id::VARCHAR AS field_value FROM i0 WHERE patient_id IS NOT NULL
    UNION ALL SELECT id + 90000, 'Infant missing name. Defaulted to "UNKNOWN"', CASE WHEN first IS NULL AND last IS NULL THEN 'given name and family name'
        WHEN first IS NULL THEN 'given name' ELSE 'family name' END, NULL FROM i WHERE first IS NULL OR last IS NULL
    UNION ALL SELECT id + 90000, 'Abnormal birthdate value', 'birthdate', born::VARCHAR FROM i WHERE born IS NULL OR born > DATE '2001-06-01' OR born < DATE '1971-06-01'
    UNION ALL SELECT id + 90000, 'Relationship start date in the future', 'start_date', born::VARCHAR FROM i WHERE (mother IS NOT NULL OR father IS NOT NULL) AND born > DATE '2001-06-01'
""")
def infant_warnings(t):
    rows = people.infant_warnings(_infants(t), _staged_infants(t), AS_OF)
    return rows.select("patient_id", "warning_type", "field_name", "field_value")


# ---- registration, providers, de-identification

CIVIL = ["Single ", "married", "partner", None, "nun"]
JOBS = ["farmer", None, "driver", "astronaut", "misc"]


@query("k12_registration", s.obs_sql(
    f"""c AS (SELECT c_custkey AS source_encounter_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS locality, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END AS commune,
        {s.pick_sql('c_custkey', CIVIL)} AS civil, {s.pick_sql('c_custkey', JOBS, 1, 2)} AS job FROM customer)""", [
        ("c", "LOCAL:Birthplace address construct", "group", "", "locality IS NOT NULL OR commune IS NOT NULL", False),
        ("c", "LOCAL:Address1", "text", "locality", "locality IS NOT NULL", True),
        ("c", "LOCAL:City Village", "text", "commune", "commune IS NOT NULL", True),
        ("c", "LOCAL:Country", "text", "'Haiti'", "locality IS NOT NULL OR commune IS NOT NULL", True),
        ("c", "LOCAL:CIVIL STATUS", "coded", "CASE upper(trim(civil)) WHEN 'SINGLE' THEN 'LOCAL:SINGLE OR A CHILD' WHEN 'MARRIED' THEN 'LOCAL:MARRIED' "
            "WHEN 'PARTNER' THEN 'LOCAL:LIVING WITH PARTNER' ELSE 'LOCAL:OTHER' END", "civil IS NOT NULL", False),
        ("c", "LOCAL:OCCUPATION", "coded", "CASE job WHEN 'farmer' THEN 'LOCAL:FARMER' WHEN 'driver' THEN 'LOCAL:DRIVER' ELSE 'LOCAL:OTHER' END", "job IS NOT NULL", False,
            "CASE WHEN job IN ('astronaut', 'misc') THEN job END"),
    ]))
def registration(t):
    key = F.col("c_custkey")
    nothing = F.lit(None).cast("string")
    births = t.customer.select(
        key.alias("source_patient_id"), F.when(key % 3 != 0, F.col("c_mktsegment")).alias("locality"), nothing.alias("section"),
        F.when(key % 2 != 0, F.col("c_name")).alias("commune"), nothing.alias("department"),
    )
    socio = t.customer.select(
        key.alias("source_patient_id"), s.pick("c_custkey", CIVIL).alias("civil_status"), s.pick("c_custkey", JOBS, 1, 2).alias("primary_activity")
    )
    jobs = t.spark.createDataFrame([("farmer", "LOCAL:FARMER"), ("driver", "LOCAL:DRIVER"), ("misc", "LOCAL:OTHER")], "entry string, ref string")
    return s.obs_view(people.registration_obs(births, socio, jobs))


@query("k12_registration_encounters", "SELECT c_custkey + 5000 AS person_id, (DATE '1999-01-01' + CAST(c_custkey % 900 AS INTEGER))::VARCHAR AS day FROM customer")
def registration_encounters(t):
    return people.registration_encounters(_staged_patients(t)).select("person_id", day_text("encounter_date").alias("day"))


@query("k14_providers", """
    SELECT DISTINCT upper(trim(name)) AS provider_name FROM (SELECT o_orderpriority AS name FROM orders UNION SELECT p_name || ' ' FROM part UNION SELECT lower(p_name) FROM part)
""")
def providers(t):
    return people.providers(
        t.orders.select(F.col("o_orderpriority").alias("performed_by")), t.part.select(F.concat("p_name", F.lit(" ")).alias("examining_doctor")),
        t.part.select(F.lower("p_name").alias("examining_doctor")),
    )


def _list_sql(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


@query("k44_de_identify", f"""
    WITH {PATIENT_SQL}
    SELECT person_id, CASE WHEN first IS NULL THEN 'UNKNOWN' WHEN gender = 'F' THEN ({_list_sql(people.FEMALE_NAMES)})[id % 19 + 1] ELSE ({_list_sql(people.MALE_NAMES)})[id % 19 + 1] END AS given_name,
        CASE WHEN last IS NULL THEN 'UNKNOWN' ELSE ({_list_sql(people.FAMILY_NAMES)})[id % 20 + 1] END AS family_name,
        CASE WHEN nick = 'Nick' AND gender = 'F' THEN ({_list_sql(people.FEMALE_MIDDLE_NAMES)})[person_id % 21 + 1] WHEN nick = 'Nick' THEN ({_list_sql(people.MALE_MIDDLE_NAMES)})[person_id % 21 + 1]
            ELSE nick END AS middle_name FROM p
""")
def de_identify(t):
    staged = _staged_patients(t)
    named = people.de_identify(people.patient_names(staged), staged, "source_patient_id")
    return named.select("person_id", "given_name", "family_name", "middle_name")
