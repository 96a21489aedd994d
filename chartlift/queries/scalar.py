"""Scalar functions (H) and SQL registrations (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions import clinical, dates, ids, numbers, register, text
from chartlift.queries.registry import query


def _uuid_sql(digest: str, version: str) -> str:
    nibble = f"substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr({digest}, 17, 1)), 1)"
    return (f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-{version}' || substr({digest}, 14, 3) || '-' || "
            f"{nibble} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)")


def _hex_sql(digits: str, count: int) -> str:
    terms = [f"(strpos('0123456789abcdef', substr({digits}, {i + 1}, 1)) - 1) * {16 ** (count - 1 - i)}" for i in range(count)]
    return "(" + " + ".join(terms) + ")"


NAME_DIGEST = "md5('53a5b5f4-3239-4a27-8674-5c3bb8116692-user-' || c_custkey)"
HASH_DIGEST = "sha1('c73ce727-afd7-40a4-9dd2-6b76842bbcbb' || 'infant' || c_custkey)"


@query("h1_uuid_name", f"SELECT c_custkey, {_uuid_sql(NAME_DIGEST, '3')} AS uuid FROM customer")
def uuid_name(t):
    return t.customer.select("c_custkey", ids.uuid_name("user", "c_custkey").alias("uuid"))


@query("h2_uuid_hash", f"SELECT c_custkey, {_uuid_sql(HASH_DIGEST, '5')} AS uuid FROM customer")
def uuid_hash(t):
    return t.customer.select("c_custkey", ids.uuid_hash(F.concat(F.lit("infant"), F.col("c_custkey").cast("string"))).alias("uuid"))


@query("h3_is_number", """
    WITH p AS (SELECT event_id, regexp_extract(props, ': *([^}]*)', 1) AS a, props AS b FROM events)
    SELECT event_id, regexp_matches(a, '^[0-9.,]+$') AND regexp_matches(a, '[0-9]') AS plain,
        regexp_matches(b, '^[0-9.,]+$') AND regexp_matches(b, '[0-9]') AS whole FROM p
""")
def is_number(t):
    inner = F.regexp_extract("props", ": *([^}]*)", 1)
    return t.events.select("event_id", numbers.is_number(inner).alias("plain"), numbers.is_number("props").alias("whole"))


EXTRACT_SQL = "rtrim(ltrim(replace(regexp_extract({0}, '[0-9.,]+'), ',', '.'), '0'), '.')"


@query("h4_extract_number", f"""
    SELECT doc_id, CASE WHEN {EXTRACT_SQL.format('text')} = '' THEN '0' ELSE {EXTRACT_SQL.format('text')} END AS number FROM documents
""")
def extract_number(t):
    return t.documents.select("doc_id", numbers.extract_number("text").alias("number"))


@query("h5_try_fix_date", """
    WITH p AS (SELECT o_orderkey, 1990 + o_orderkey % 30 AS y, 1 + o_orderkey % 14 AS m, 1 + (o_orderkey // 14) % 31 AS d FROM orders),
         q AS (SELECT *, CASE WHEN m <= 12 THEN day(last_day(make_date(y, m, 1))) END AS top FROM p)
    SELECT o_orderkey, CASE WHEN m > 12 THEN make_date(y, 12, 1) WHEN d > top THEN (make_date(y, m, 1) + INTERVAL 1 MONTH)::DATE
        ELSE make_date(y, m, least(d, top)) END::VARCHAR AS fixed FROM q
""")
def try_fix_date(t):
    key = F.col("o_orderkey")
    raw = F.format_string("%04d-%02d-%02d", 1990 + key % 30, 1 + key % 14, 1 + F.floor(key / 14).cast("long") % 31)
    return t.orders.select("o_orderkey", dates.try_fix_date(raw).cast("string").alias("fixed"))


@query("h6_substring_before", "SELECT page_id, split_part(url, '?', 1) AS path FROM pages")
def substring_before(t):
    return t.pages.select("page_id", text.substring_before("url", "?").alias("path"))


@query("h7_username_from_email", """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '`' ELSE '' END || lower(c_mktsegment) || c_custkey % 40
        || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '@clinic' END AS email FROM customer),
    u AS (SELECT c_custkey, email, CASE WHEN strpos(email, '@') = 0 THEN '' ELSE split_part(email, '@', 1) END AS left_part FROM c),
    v AS (SELECT *, CASE WHEN starts_with(left_part, '`') THEN replace(left_part, '`', '') ELSE left_part END AS name FROM u)
    SELECT c_custkey, CASE WHEN name IN (SELECT lower(p_type) || '7' FROM part UNION ALL SELECT 'machinery3') THEN name || '-' || c_custkey
        ELSE name END AS username, split_part(email, '@', 1) || '-' || c_custkey AS prototype_name FROM v
""")
def username_from_email(t):
    key = F.col("c_custkey")
    email = F.concat(
        F.when(key % 7 == 0, "`").otherwise(""), F.lower("c_mktsegment"), (key % 40).cast("string"),
        F.when(key % 5 == 0, "").otherwise("@clinic"),
    )
    users = t.customer.select("c_custkey", email.alias("email"))
    taken = t.part.select(F.concat(F.lower("p_type"), F.lit("7")).alias("_taken")).distinct()
    taken = taken.unionByName(t.spark.range(1).select(F.lit("machinery3").alias("_taken")))
    named = users.withColumn("name", text.username_from_email("email", "c_custkey"))
    joined = named.join(taken, F.col("name") == F.col("_taken"), "left")
    return joined.select(
        "c_custkey", text.username_from_email("email", "c_custkey", F.col("_taken").isNotNull()).alias("username"),
        text.username_with_id("email", "c_custkey").alias("prototype_name"),
    )


@query("h8_split_person_name", """
    WITH p AS (SELECT DISTINCT p_name || CASE WHEN p_size > 25 THEN ' ' || p_type ELSE '' END AS name FROM part
               UNION SELECT p_brand FROM part)
    SELECT name, regexp_replace(name, '[^ ]+$', '') AS first, regexp_extract(name, '[^ ]+$') AS last FROM p WHERE name LIKE '% %'
    UNION ALL SELECT name, name, name FROM p WHERE name NOT LIKE '% %'
""")
def split_person_name(t):
    full = F.concat("p_name", F.when(F.col("p_size") > 25, F.concat(F.lit(" "), "p_type")).otherwise(""))
    names = t.part.select(F.explode(F.array(full, "p_brand")).alias("name")).distinct()
    return names.select("name", text.first_names("name").alias("first"), text.last_name("name").alias("last"))


@query("h9_name_compose", """
    SELECT p_partkey, p_name || CASE WHEN p_size > 25 THEN ' ' || p_type ELSE '' END AS given FROM part
""")
def name_compose(t):
    second = F.when(F.col("p_size") > 25, F.col("p_type"))
    return t.part.select("p_partkey", text.given_name("p_name", second).alias("given"))


@query("h10_truncate_text", "SELECT doc_id, left(text, 255) AS short, length(text) > 255 AS cut FROM documents")
def truncate_text(t):
    return t.documents.select(
        "doc_id", text.truncate_text("text", 255).alias("short"), text.is_truncated("text", 255).alias("cut")
    )


@query("h11_text_cleanup", """
    SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS bare,
        upper(replace(url, '.', '_')) AS upper, lower(trim('  ' || url || ' ')) AS lower FROM pages
""")
def text_cleanup(t):
    return t.pages.select(
        "page_id", text.trim_prefix("url", "https://").alias("bare"), F.upper(F.replace("url", F.lit("."), F.lit("_"))).alias("upper"),
        F.lower(F.trim(F.concat(F.lit("  "), "url", F.lit(" ")))).alias("lower"),
    )


@query("h12_date_math", """
    SELECT o_orderkey, (o_orderdate + INTERVAL 6 MONTH)::DATE::VARCHAR AS half_year,
        date_part('year', age(DATE '2031-06-01', o_orderdate::DATE))::INTEGER AS years,
        strftime(o_orderdate + INTERVAL '23:59:59' HOUR, '%Y-%m-%d %H:%M:%S') AS closed,
        last_day(o_orderdate::DATE)::VARCHAR AS month_end FROM orders
""".replace("INTERVAL '23:59:59' HOUR", "INTERVAL 86399 SECOND"))
def date_math(t):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.add_months(day, 6).cast("string").alias("half_year"),
        dates.full_years(day, F.lit("2031-06-01").cast("date")).alias("years"),
        F.date_format(dates.end_of_day("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("closed"),
        F.last_day(day).cast("string").alias("month_end"),
    )


@query("h13_null_aware_picks", """
    WITH s AS (SELECT p_partkey, nullif(p_size, 10) AS a, nullif(p_size % 20, 10) AS b FROM part)
    SELECT p_partkey, least(coalesce(a, b), coalesce(b, a)) AS least_kept, greatest(a, b) AS greatest_kept,
        CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS least_strict, coalesce(a, b, 1) AS first_known FROM s
""")
def null_aware_picks(t):
    sizes = t.part.select(
        "p_partkey", F.nullif(F.col("p_size"), F.lit(10)).alias("a"), F.nullif(F.col("p_size") % 20, F.lit(10)).alias("b")
    )
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return sizes.select(
        "p_partkey", F.least("a", "b").alias("least_kept"), F.greatest("a", "b").alias("greatest_kept"),
        F.when(both, F.least("a", "b")).alias("least_strict"), F.coalesce("a", "b", F.lit(1)).alias("first_known"),
    )


@query("h14_concat_ws_null", """
    WITH s AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS a, nullif(o_orderpriority, '5-LOW') AS b FROM orders)
    SELECT o_orderkey, a || ', ' || b AS strict, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a || ', ' || b END AS lenient FROM s
""")
def concat_ws_null(t):
    parts = t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("a"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("b")
    )
    return parts.select(
        "o_orderkey", text.concat_or_null("a", F.lit(", "), "b").alias("strict"),
        text.concat_skip_null(", ", "a", "b").alias("lenient"),
    )


@query("h15_unit_convert", """
    SELECT event_id,
        CASE WHEN value < 3.0 THEN round(value * 100, 1) ELSE value END AS height,
        CASE WHEN event_type = 'click' THEN round(value * 0.453592, 1) ELSE value END AS weight,
        round(CASE WHEN event_type = 'view' THEN value ELSE value / 2.20462 END, 6) AS weight_export,
        CASE WHEN value < 20 THEN value * 10 ELSE value END AS diastolic, CASE WHEN value < 30 THEN value * 10 ELSE value END AS systolic,
        CASE WHEN value > 60 THEN round((value - 32.0) * 0.555555, 1) ELSE value END AS temperature FROM events
""")
def unit_convert(t):
    unit = F.when(F.col("event_type") == "click", "lbs").when(F.col("event_type") == "view", "KGS")
    return t.events.select(
        "event_id", numbers.height_cm("value").alias("height"), numbers.weight_kg_staging("value", unit).alias("weight"),
        F.round(numbers.weight_kg_export("value", unit), 6).alias("weight_export"),
        numbers.shorthand_times_ten("value", 20).alias("diastolic"), numbers.shorthand_times_ten("value", 30).alias("systolic"),
        numbers.temperature_c("value").alias("temperature"),
    )


@query("h16_modulo_pick", "SELECT c_custkey, (['Ann', 'Ben', 'Cleo', 'Dan', 'Eva'])[c_custkey % 5 + 1] AS name FROM customer")
def modulo_pick(t):
    return t.customer.select("c_custkey", ids.modulo_pick("c_custkey", ["Ann", "Ben", "Cleo", "Dan", "Eva"]).alias("name"))


@query("h17_p_hash", f"SELECT c_custkey, {_hex_sql('md5(c_name)', 5)} % 1000 / 1000.0::DOUBLE AS p FROM customer")
def p_hash(t):
    return t.customer.select("c_custkey", ids.p_hash("c_name", 1).alias("p"))


@query("h18_parse_typed", """
    WITH s AS (SELECT event_id, regexp_extract(props, ': *([^}]*)', 1) AS n, CASE event_type WHEN 'click' THEN 't' WHEN 'view' THEN 'no'
        ELSE event_type END AS b, ts::DATE::VARCHAR AS d FROM events)
    SELECT event_id, CASE WHEN regexp_matches(n, '^[+-]?[0-9]+$') THEN CAST(n AS INTEGER) END AS whole, try_cast(n AS DOUBLE) AS number,
        CASE WHEN b = 't' THEN true WHEN b = 'no' THEN false END AS flag, try_cast(d AS DATE)::VARCHAR AS day FROM s
""")
def parse_typed(t):
    number = F.regexp_extract("props", ": *([^}]*)", 1)
    flag = F.when(F.col("event_type") == "click", "t").when(F.col("event_type") == "view", "no").otherwise(F.col("event_type"))
    day = dates.day_text("ts")
    return t.events.select(
        "event_id", clinical.parse_typed(number, "int").alias("whole"), clinical.parse_typed(number, "double").alias("number"),
        clinical.parse_typed(flag, "boolean", strict=False).alias("flag"), clinical.parse_typed(day, "date").cast("string").alias("day"),
    )


@query("h19_coded_or_noncoded", """
    SELECT o_orderkey, CASE WHEN lower(o_orderpriority) IN ('1-urgent', '2-high') THEN 'FAST' WHEN lower(o_orderpriority) = '5-low' THEN 'SLOW' END AS coded,
        CASE WHEN lower(o_orderpriority) NOT IN ('1-urgent', '2-high', '5-low') THEN o_orderpriority END AS non_coded FROM orders
""")
def coded_or_noncoded(t):
    union = clinical.coded_or_noncoded("o_orderpriority", {"FAST": ["1-Urgent", "2-HIGH"], "SLOW": ["5-low"]})
    return t.orders.select("o_orderkey", union["coded"].alias("coded"), union["non_coded"].alias("non_coded"))


@query("h20_age_band", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
        CASE WHEN date_part('year', age(l_shipdate::DATE, DATE '1982-03-15')) < 16 THEN 'child' ELSE 'adult' END AS band FROM lineitem
""")
def age_band(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        dates.age_band(F.lit("1982-03-15").cast("date"), "l_shipdate").alias("band"),
    )


@query("h21_parse_kv_map", """
    SELECT o_orderkey, o_orderstatus AS status, o_orderpriority || '=x' AS priority, 2::BIGINT AS size FROM orders
""")
def parse_kv_map(t):
    raw = F.concat(F.lit("status=?,priority="), "o_orderpriority", F.lit("=x,,status="), "o_orderstatus")
    parsed = t.orders.select("o_orderkey", text.parse_kv_map(raw).alias("m"))
    return parsed.select(
        "o_orderkey", F.col("m")["status"].alias("status"), F.col("m")["priority"].alias("priority"), F.size("m").cast("long").alias("size")
    )


@query("h22_lab_result_route", """
    WITH s AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'cd4' WHEN 'view' THEN 'rpr' WHEN 'purchase' THEN 'ppd'
            WHEN 'signup' THEN 'urea' ELSE CASE event_id % 3 WHEN 0 THEN 'other' WHEN 1 THEN 'blood_type' ELSE 'unheard_of' END END AS test,
        CASE WHEN event_type = 'click' AND event_id % 3 = 0 THEN value * 2 || '%' WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'Positive'
            WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'negative:' || value WHEN event_type = 'purchase' AND event_id % 3 = 1 THEN 'f'
            WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'x' || value WHEN event_type = 'error' AND event_id % 9 = 1 THEN 'ab+' WHEN event_type = 'error' AND event_id % 9 = 4 THEN 'O-' ELSE value::VARCHAR END AS raw, value FROM events)
    SELECT event_id,
        CASE WHEN test IN ('cd4', 'urea', 'ppd') THEN try_cast(CASE WHEN raw LIKE 'negative:%' THEN substr(raw, 10) ELSE raw END AS DOUBLE) END AS numeric,
        CASE WHEN test = 'cd4' AND raw LIKE '%\\%' ESCAPE '\\' AND value * 2 < 100 THEN value * 2 END AS percent,
        CASE WHEN test = 'rpr' AND raw = 'Positive' THEN 'POSITIVE' WHEN test = 'ppd' AND (raw = 'f' OR raw LIKE 'negative:%') THEN 'NEGATIVE' WHEN raw = 'ab+' THEN 'AB_POSITIVE' WHEN raw = 'O-' THEN 'O_NEGATIVE' END AS coded,
        CASE WHEN test = 'other' THEN raw END AS text,
        CASE WHEN (test = 'cd4' AND raw LIKE '%\\%' ESCAPE '\\' AND value * 2 >= 100) OR (test = 'rpr' AND raw <> 'Positive') OR (test = 'urea' AND raw LIKE 'x%') OR (test = 'blood_type' AND raw NOT IN ('ab+', 'O-')) OR test = 'unheard_of'
            THEN raw END AS exception FROM s
""")
def lab_result_route(t):
    kind, key, value = F.col("event_type"), F.col("event_id"), F.col("value")
    test = F.when(kind == "click", "cd4").when(kind == "view", "rpr").when(kind == "purchase", "ppd").when(kind == "signup", "urea").when(key % 3 == 0, "other").when(key % 3 == 1, "blood_type").otherwise("unheard_of")
    raw = (
        F.when((kind == "click") & (key % 3 == 0), F.concat((value * 2).cast("string"), F.lit("%")))
        .when((kind == "view") & (key % 2 == 0), "Positive")
        .when((kind == "purchase") & (key % 3 == 0), F.concat(F.lit("negative:"), value.cast("string")))
        .when((kind == "purchase") & (key % 3 == 1), "f")
        .when((kind == "signup") & (key % 2 == 0), F.concat(F.lit("x"), value.cast("string")))
        .when((kind == "error") & (key % 9 == 1), "ab+")
        .when((kind == "error") & (key % 9 == 4), "O-")
        .otherwise(value.cast("string"))
    )
    return t.events.select("event_id", clinical.lab_result(test, raw).alias("r")).select("event_id", "r.*")


@query("h23_spelling_normalise", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'negative' WHEN 'view' THEN 'positive:' || floor(value)::BIGINT
        WHEN 'error' THEN '0' ELSE floor(value)::BIGINT::VARCHAR END AS result FROM events
""")
def spelling_normalise(t):
    size = F.floor("value").cast("string")
    raw = (
        F.when(F.col("event_type") == "click", " NEGATIF")
        .when(F.col("event_type") == "view", F.concat(F.lit("Pos: "), size, F.lit("mm")))
        .when(F.col("event_type") == "error", "O mm/h").otherwise(F.concat(size, F.lit(" mms")))
    )
    return t.events.select("event_id", clinical.spelling_normalise(raw).alias("result"))


@query("h24_dosing_text", """
    SELECT p_partkey, p_size % 4 || ' /day x ' || p_size % 8 || ' days/week' || CASE WHEN p_size % 3 > 0 THEN ' - ' || p_size % 3 || '/morning' ELSE '' END
        || CASE WHEN p_size % 2 > 0 THEN ' - ' || p_size % 2 || '/night' ELSE '' END AS dosing FROM part
""")
def dosing_text(t):
    size = F.col("p_size")
    return t.part.select("p_partkey", text.dosing_text(size % 4, size % 8, {"morning": size % 3, "night": size % 2}).alias("dosing"))


@query("h25_round_ceil_conv", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(l_extendedprice, 1) AS rounded, l_extendedprice = ceil(l_extendedprice) AS whole,
        l_partkey % 7 AS remainder, printf('%x', l_partkey) AS hex FROM lineitem
""")
def round_ceil_conv(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", numbers.round_half_up("l_extendedprice", 1).alias("rounded"),
        numbers.is_whole("l_extendedprice").alias("whole"), F.pmod(F.col("l_partkey"), F.lit(7)).alias("remainder"),
        numbers.int_to_hex("l_partkey").alias("hex"),
    )


@query("n1_sql_functions", f"""
    SELECT c_custkey, {_uuid_sql(NAME_DIGEST, '3')} AS uuid, split_part(c_name, '#', 1) AS stem FROM customer
""")
def sql_functions(t):
    register.register_sql_functions(t.spark)
    return t.spark.sql(
        "SELECT c_custkey, uuid_name('user', cast(c_custkey AS string)) AS uuid, substring_before(c_name, '#') AS stem FROM {customer}",
        customer=t.customer,
    )


@query("n5_concept_lookup", """
    SELECT p_partkey, n_nationkey + 500 AS concept_id, n_name AS concept_name FROM part LEFT JOIN nation ON 'SRC:' || p_size = 'SRC:' || n_nationkey
""")
def concept_lookup(t):
    """A concept by its mapping (source and code), and its name by its id."""
    from chartlift.operators.joins import lookup

    mapping = t.nation.select(F.concat_ws(":", F.lit("SRC"), F.col("n_nationkey").cast("string")).alias("ref"), (F.col("n_nationkey") + 500).alias("id"))
    names = t.nation.select((F.col("n_nationkey") + 500).alias("id"), "n_name")
    rows = t.part.withColumn("ref", F.concat_ws(":", F.lit("SRC"), F.col("p_size").cast("string")))
    coded = lookup(rows, mapping, "ref", "ref", "id", "concept_id")
    return lookup(coded, names, "concept_id", "id", "n_name", "concept_name").select("p_partkey", "concept_id", "concept_name")
