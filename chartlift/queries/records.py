"""Observations, keys, quality, profiles and documents (G, I, J, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions import dates
from chartlift.operators import aggregates, eav, keys, profile, quality
from chartlift.queries.registry import query

DRAFT_CORE = ["obs_key", "group_key", "source_encounter_id", "concept", "value_coded", "value_numeric", "value_text"]


def line_key(t):
    """Line items with a text key; (order, line) alone repeats."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))
    return t.lineitem.withColumn("line_key", key)


LINE_KEY_SQL = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER)"


# ---- G shape change


@query("g1_emit_obs", f"""
    WITH l AS (SELECT *, {LINE_KEY_SQL} AS k FROM lineitem)
    SELECT 'lines/' || k || '/0' AS obs_key, l_orderkey AS source_encounter_id, 'LOCAL:QUANTITY' AS concept, l_quantity AS value_numeric, NULL::VARCHAR AS value_coded FROM l
    UNION ALL SELECT 'lines/' || k || '/1', l_orderkey, 'LOCAL:DISCOUNT', nullif(l_discount, 0), NULL FROM l WHERE nullif(l_discount, 0) IS NOT NULL
    UNION ALL SELECT 'lines/' || k || '/2', l_orderkey, 'LOCAL:RETURNED', NULL, 'LOCAL:YES' FROM l WHERE l_returnflag = 'R'
""")
def emit_obs(t):
    drafts = eav.emit_obs(
        line_key(t), "lines", ["line_key"], "l_orderkey",
        [
            eav.numeric("LOCAL:QUANTITY", "l_quantity"),
            eav.numeric("LOCAL:DISCOUNT", F.nullif(F.col("l_discount"), F.lit(0.0))),
            eav.coded("LOCAL:RETURNED", "LOCAL:YES", when=F.col("l_returnflag") == "R"),
        ],
    )
    return drafts.select("obs_key", "source_encounter_id", "concept", "value_numeric", "value_coded")


@query("g2_emit_obs_group", """
    SELECT 'orders/' || o_orderkey || '/0' AS obs_key, NULL::VARCHAR AS group_key, o_orderkey AS source_encounter_id, 'LOCAL:CONSTRUCT' AS concept,
        NULL::DOUBLE AS value_numeric, NULL::VARCHAR AS value_text FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'orders/' || o_orderkey || '/0/0', 'orders/' || o_orderkey || '/0', o_orderkey, 'LOCAL:PRICE', o_totalprice, NULL FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'orders/' || o_orderkey || '/0/1', 'orders/' || o_orderkey || '/0', o_orderkey, 'LOCAL:PRIORITY', NULL, o_orderpriority FROM orders
        WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'
""")
def emit_obs_group(t):
    group = eav.Group(
        "LOCAL:CONSTRUCT",
        [eav.numeric("LOCAL:PRICE", "o_totalprice"), eav.text("LOCAL:PRIORITY", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))],
        when=F.col("o_orderstatus") != "F",
    )
    drafts = eav.emit_obs_group(t.orders, "orders", ["o_orderkey"], "o_orderkey", group)
    return drafts.select("obs_key", "group_key", "source_encounter_id", "concept", "value_numeric", "value_text")


@query("g3_eav_pivot", """
    SELECT user_id, ts::DATE::VARCHAR AS day, max(props) FILTER (event_type = 'click') AS click, max(props) FILTER (event_type = 'view') AS view,
        max(props) FILTER (event_type IN ('purchase', 'signup')) AS committed FROM events GROUP BY 1, 2
""")
def eav_pivot(t):
    days = t.events.withColumn("day", dates.day_text("ts"))
    return eav.eav_pivot(
        days, ["user_id", "day"], "event_type", "props", {"click": "click", "view": "view", "committed": ["purchase", "signup"]}
    )


@query("g4_eav_bool_from_value", """
    SELECT o_custkey, CASE WHEN bool_or((o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') OR (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')) THEN true END AS pressing
    FROM orders GROUP BY 1
""")
def eav_bool_from_value(t):
    return eav.eav_bool_from_value(
        t.orders, ["o_custkey"], "o_orderstatus", "o_orderpriority", {"pressing": "O=1-URGENT|P=2-HIGH"}
    )


@query("g5_resolve_obs", f"""
    WITH l AS (SELECT 'lines/' || {LINE_KEY_SQL} || '/0' AS obs_key, * FROM lineitem)
    SELECT obs_key, o_custkey AS person_id, o_orderkey + 1000 AS encounter_id,
        strftime(coalesce(CASE WHEN l_returnflag = 'A' THEN l_shipdate END, o_orderdate), '%Y-%m-%d') AS day,
        coalesce(nullif(o_orderkey % 5, 0), 1) AS location_id, n_nationkey + 500 AS concept_id, l_quantity AS value_numeric
    FROM l JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P' LEFT JOIN nation ON 'C' || l_partkey % 30 = 'C' || n_nationkey
""")
def resolve_obs(t):
    drafts = eav.emit_obs(
        line_key(t), "lines", ["line_key"], "l_orderkey",
        [eav.numeric(F.concat(F.lit("C"), (F.col("l_partkey") % 30).cast("string")), "l_quantity",
                     at=F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")))],
    )
    encounters = t.orders.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("source_encounter_id"), (F.col("o_orderkey") + 1000).alias("encounter_id"),
        F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").alias("encounter_datetime"),
        F.nullif(F.col("o_orderkey") % 5, F.lit(0).cast("long")).alias("location_id"), F.col("o_orderdate").alias("date_created"),
    )
    concepts = t.nation.select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("ref"), (F.col("n_nationkey") + 500).alias("concept_id")
    )
    resolved = eav.resolve_obs(drafts, encounters, concepts)
    return resolved.select(
        "obs_key", "person_id", "encounter_id", dates.day_text("obs_datetime").alias("day"), "location_id", "concept_id", "value_numeric"
    )


@query("g5_number_obs", f"""
    WITH o AS (SELECT 'o/' || o_orderkey AS k, NULL AS g, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 10 END AS old FROM orders
        UNION ALL SELECT 'l/' || {LINE_KEY_SQL}, 'o/' || l_orderkey, NULL FROM lineitem),
    n AS (SELECT k, g, coalesce(old, (SELECT max(old) FROM o) + row_number() OVER (PARTITION BY old IS NULL ORDER BY k)) AS id FROM o)
    SELECT n.k AS obs_key, n.id AS obs_id, p.id AS obs_group_id FROM n LEFT JOIN n p ON p.k = n.g
""")
def number_obs(t):
    """Orders as parents, half of them loaded before, line items as their children."""
    key = F.concat(F.lit("o/"), F.col("o_orderkey").cast("string"))
    parents = t.orders.select(key.alias("obs_key"), F.lit(None).cast("string").alias("group_key"), key.alias("uuid"))
    line = F.concat(F.lit("l/"), F.col("line_key").cast("string"))
    children = line_key(t).select(line.alias("obs_key"), F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("group_key"), line.alias("uuid"))
    loaded = t.orders.filter("o_orderkey % 2 = 0").select((F.col("o_orderkey") + 10).alias("obs_id"), key.alias("uuid"))
    return eav.number_obs(parents.unionByName(children), loaded).select("obs_key", "obs_id", "obs_group_id")


@query("g6_split_row_in_two", """
    SELECT o_orderkey, 'single' AS part, o_totalprice AS amount FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'initial', 0.0::DOUBLE FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'current', o_totalprice FROM orders WHERE o_orderstatus = 'P'
""")
def split_row_in_two(t):
    partial, amount = F.col("o_orderstatus") == "P", F.col("o_totalprice")

    def variant(name, value):
        return {"o_orderkey": F.col("o_orderkey"), "part": F.lit(name), "amount": value}

    return eav.split_rows(
        t.orders,
        [(~partial, variant("single", amount)), (partial, variant("initial", F.lit(0.0))), (partial, variant("current", amount))],
    )


@query("g7_text_kv_compose", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'priority=' || o_orderpriority
        ELSE 'status=' || o_orderstatus || ',priority=' || o_orderpriority END AS comment FROM orders
""")
def text_kv_compose(t):
    from chartlift.functions import text

    pairs = {"status": F.nullif(F.col("o_orderstatus"), F.lit("F")), "priority": F.col("o_orderpriority")}
    return t.orders.select("o_orderkey", text.kv_text(pairs).alias("comment"))


# ---- I surrogate keys


@query("i1_assign_ids", """
    SELECT o_orderkey, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders
""")
def assign_ids(t):
    start = keys.next_id(t.customer, "c_custkey")
    return keys.assign_ids(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "id", start).select("o_orderkey", "id")


@query("i2_reserve_id_range", """
    SELECT 'parent' AS kind, o_orderkey AS key, 1000 + row_number() OVER (ORDER BY o_orderkey) - 1 AS id FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'child', c_custkey, 1000 + (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') + row_number() OVER (ORDER BY c_custkey) - 1 FROM customer
""")
def reserve_id_range(t):
    frames = {
        "parent": t.orders.filter("o_orderstatus = 'P'").select(F.lit("parent").alias("kind"), F.col("o_orderkey").alias("key")),
        "child": t.customer.select(F.lit("child").alias("kind"), F.col("c_custkey").alias("key")),
    }
    starts = keys.reserve_id_ranges(frames, 1000)
    numbered = [keys.assign_ids(frame, ["key"], "id", starts[name]) for name, frame in frames.items()]
    return numbered[0].unionByName(numbered[1])


@query("i3_pair_with_pool", """
    WITH a AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_name) AS n FROM supplier),
         b AS (SELECT c_name, row_number() OVER (ORDER BY c_name DESC) AS n FROM customer)
    SELECT s_suppkey, c_name FROM a JOIN b USING (n)
""")
def pair_with_pool(t):
    pool = t.customer.select("c_name", F.col("c_custkey").alias("_desc")).withColumn("_desc", -F.col("_desc"))
    paired = keys.pair_with_pool(t.supplier.select("s_suppkey", "s_name"), pool, ["s_name"], ["_desc"])
    return paired.select("s_suppkey", "c_name")


@query("i3_pool_allocation", """
    WITH a AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier),
         b AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS n FROM customer),
         u AS (SELECT 'many members' AS pool, s_suppkey AS id, c_name AS member, a.n AS r, b.n AS m FROM a FULL JOIN b USING (n)),
         v AS (SELECT 'few members' AS pool, c_custkey AS id, s_name AS member, x.n AS r, y.n AS m FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS n FROM customer) x
               FULL JOIN (SELECT s_name, row_number() OVER (ORDER BY s_name) AS n FROM supplier) y USING (n))
    SELECT pool, id, member, CASE WHEN m IS NULL THEN 'unassigned' WHEN r IS NULL THEN 'unused' ELSE 'assigned' END AS allocation FROM (SELECT * FROM u UNION ALL SELECT * FROM v)
""")
def pool_allocation(t):
    many = keys.allocate_from_pool(t.supplier.select("s_suppkey"), t.customer.select("c_name"), ["s_suppkey"], ["c_name"])
    few = keys.allocate_from_pool(t.customer.select("c_custkey"), t.supplier.select("s_name"), ["c_custkey"], ["s_name"])
    return many.select(F.lit("many members").alias("pool"), F.col("s_suppkey").alias("id"), F.col("c_name").alias("member"), "allocation").unionByName(
        few.select(F.lit("few members").alias("pool"), F.col("c_custkey").alias("id"), F.col("s_name").alias("member"), "allocation")
    )


@query("i4_natural_to_surrogate", "SELECT o_orderkey, c_custkey + 5000 AS person_id FROM orders JOIN customer ON o_custkey = c_custkey")
def natural_to_surrogate(t):
    id_map = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") + 5000).alias("person_id"))
    return keys.natural_to_surrogate(t.orders, id_map, "o_custkey", "person_id").select("o_orderkey", "person_id")


# ---- J data quality

WARNING_CORE = ["patient_id", "encounter_id", "field_name", "field_value", "warning_type", "warning_details", "flag_for_review"]


@query("j1_warn", """
    SELECT o_custkey AS patient_id, o_orderkey AS encounter_id, 'encounter_date' AS field_name, o_orderdate::DATE::VARCHAR AS field_value,
        'Encounter with nonsensical date' AS warning_type, 'Source encounter_type :' || o_orderstatus AS warning_details, true AS flag_for_review
    FROM orders WHERE o_orderdate < DATE '1995-07-01'
""")
def warn(t):
    return quality.warn(
        t.orders, "Encounter with nonsensical date", patient="o_custkey", encounter="o_orderkey", field="encounter_date",
        value=dates.day_text("o_orderdate"), details=F.concat(F.lit("Source encounter_type :"), "o_orderstatus"),
        when=F.to_date("o_orderdate") < F.lit("1995-07-01").cast("date"),
    ).select(*WARNING_CORE)


@query("j2_warn_duplicates", """
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS rows FROM orders GROUP BY 1, 2, 3 HAVING count(*) > 1
""")
def warn_duplicates(t):
    months = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return quality.duplicate_values(months, ["o_custkey", "month", "o_orderstatus"])


@query("j3_warn_out_of_range", """
    WITH o AS (SELECT event_id, user_id, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 10 AS concept_id FROM events),
         lim AS (SELECT n_nationkey AS concept_id, n_nationkey * 1.0 AS low, 90.0 - n_nationkey AS high, n_nationkey % 2 = 0 AS dec FROM nation)
    SELECT user_id AS patient_id, event_id AS encounter_id, 'Decimal obs for non-decimal numeric concept' AS warning_type, o.concept_id::VARCHAR AS field_name
        FROM o JOIN lim USING (concept_id) WHERE NOT dec AND value <> ceil(value)
    UNION ALL SELECT user_id, event_id, 'Decimal obs lower than allowed range', o.concept_id::VARCHAR FROM o JOIN lim USING (concept_id) WHERE value < low
    UNION ALL SELECT user_id, event_id, 'Decimal obs higher than allowed range', o.concept_id::VARCHAR FROM o JOIN lim USING (concept_id) WHERE value > high
""")
def warn_out_of_range(t):
    obs = t.events.select(
        F.col("event_id").alias("encounter_id"), F.col("user_id").alias("person_id"), F.col("value").alias("value_numeric"),
        (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 10).alias("concept_id"),
    )
    limits = t.nation.select(
        F.col("n_nationkey").alias("concept_id"), (F.col("n_nationkey") * 1.0).alias("low"),
        (F.lit(90.0) - F.col("n_nationkey")).alias("high"), (F.col("n_nationkey") % 2 == 0).alias("allow_decimal"),
    )
    return quality.warn_out_of_range(obs, limits).select("patient_id", "encounter_id", "warning_type", "field_name")


@query("j4_warn_null_values", """
    SELECT o_custkey AS patient_id, o_orderkey AS encounter_id, 'Obs with null value' AS warning_type FROM orders
    WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)
""")
def warn_null_values(t):
    empty = F.lit(None)
    parents = t.orders.select(
        F.col("o_orderkey").cast("string").alias("obs_key"), F.lit(None).cast("string").alias("group_key"),
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("encounter_id"), F.lit(1).alias("concept_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value_numeric"),
    )
    children = t.lineitem.filter("l_quantity > 10").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("obs_key"), F.col("l_orderkey").cast("string").alias("group_key"),
        F.lit(0).cast("long").alias("person_id"), F.col("l_orderkey").alias("encounter_id"), F.lit(2).alias("concept_id"),
        F.col("l_quantity").alias("value_numeric"),
    )
    obs = parents.unionByName(children).withColumns(
        {"value_coded": empty.cast("string"), "value_drug": empty.cast("string"), "value_datetime": empty.cast("timestamp"), "value_text": empty.cast("string")}
    )
    return quality.warn_null_values(obs).select("patient_id", "encounter_id", "warning_type")


@query("j5_warn_unmapped", "SELECT p_partkey, p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size > 48)")
def warn_unmapped(t):
    known = t.part.filter("p_size > 48").select(F.col("p_name").alias("name"))
    return quality.unmapped_codes(t.part, "p_name", known, "name").select("p_partkey", "p_name")


@query("j6_warn_date_order", """
    SELECT o_custkey AS patient_id, o_orderkey AS encounter_id, l_shipdate::DATE::VARCHAR AS field_value, 'Order shipped before it was placed' AS warning_type,
        'Placed: ' || o_orderdate::DATE::VARCHAR AS warning_details FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate
""")
def warn_date_order(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.warn(
        rows, "Order shipped before it was placed", patient="o_custkey", encounter="o_orderkey", value=dates.day_text("l_shipdate"),
        details=F.concat(F.lit("Placed: "), dates.day_text("o_orderdate")), when=F.col("l_shipdate") < F.col("o_orderdate"),
    ).select("patient_id", "encounter_id", "field_value", "warning_type", "warning_details")


@query("j7_warn_conflicting_duplicates", """
    SELECT l_orderkey, l_linenumber, count(DISTINCT l_returnflag) AS values, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS listed
    FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1
""")
def warn_conflicting_duplicates(t):
    return quality.conflicting_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag"]).drop("field")


@query("j8_warn_orphan_encounter", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def warn_orphan_encounter(t):
    kept = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.orphans(t.lineitem, kept, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("j9_warning_enrich", """
    SELECT o_custkey AS patient_id, o_orderkey AS encounter_id, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON n_nationkey = o_custkey % 40 WHERE o_totalprice > 400000
""")
def warning_enrich(t):
    warnings = quality.warn(t.orders, "High price", patient="o_custkey", encounter="o_orderkey", when=F.col("o_totalprice") > 400000)
    warnings = warnings.withColumn("site", (F.col("patient_id") % 40).cast("int"))
    rich = quality.enrich_warnings(warnings, [(t.customer, "patient_id", "c_custkey", "c_name"), (t.nation, "site", "n_nationkey", "n_name")])
    return rich.select("patient_id", "encounter_id", "c_name", "n_name")


@query("j10_check_rules", """
    SELECT 'No order is free' AS rule, 0::BIGINT AS expected, count(*) FILTER (o_totalprice <= 0) AS actual, count(*) FILTER (o_totalprice <= 0) = 0 AS passed FROM orders
    UNION ALL SELECT 'No order is pending', 0, count(*) FILTER (o_orderstatus = 'P'), count(*) FILTER (o_orderstatus = 'P') = 0 FROM orders
    UNION ALL SELECT 'All orders have a priority', count(*), count(o_orderpriority), count(*) = count(o_orderpriority) FROM orders
""")
def check_rules(t):
    return quality.check_rules(
        t.orders,
        {"No order is free": F.col("o_totalprice") <= 0, "No order is pending": F.col("o_orderstatus") == "P"},
        {"All orders have a priority": F.col("o_orderpriority").isNotNull()},
    )


@query("j11_assert_match", """
    WITH a AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2),
         b AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice < 490000 GROUP BY 1, 2),
         d AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
            coalesce(a.n, 0) - coalesce(b.n, 0) AS surplus FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus)
    SELECT o_custkey, o_orderstatus, surplus, 'left' AS side FROM d WHERE surplus <> 0
""")
def assert_match(t):
    columns = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice")
    return quality.assert_match(columns.drop("o_totalprice"), columns.filter("o_totalprice < 490000").drop("o_totalprice"))


@query("j11_assert_counts", """
    SELECT 'orders equal line items' AS rule, (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM lineitem) AS actual, false AS passed
""")
def assert_counts(t):
    return quality.assert_counts_match("orders equal line items", t.orders, t.lineitem)


@query("j12_assert_sets_match", """
    SELECT DISTINCT o_custkey, 'left_only' AS side FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def assert_sets_match(t):
    return aggregates.set_difference_both(t.orders, t.orders.filter("o_orderstatus = 'P'"), "o_custkey")


@query("j13_assert_nonnull_coverage", """
    SELECT 'o_custkey' AS property, count(DISTINCT o_custkey) AS populated, true AS covered FROM orders
    UNION ALL SELECT 'orders[].o_orderkey', count(DISTINCT o_custkey), true FROM orders
    UNION ALL SELECT 'orders[].urgent', count(DISTINCT o_custkey) FILTER (o_orderpriority = '1-URGENT'), true FROM orders
    UNION ALL SELECT 'orders[].never', 0, false
""")
def assert_nonnull_coverage(t):
    rows = t.orders.select(
        "o_custkey", "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("y")).alias("urgent"), F.lit(None).cast("string").alias("never")
    )
    return quality.nonnull_coverage(
        aggregates.collect_nested(rows, ["o_custkey"], ["o_orderkey", "urgent", "never"], "orders")
    )


# ---- L profiles


@query("l1_column_profile", """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders)
    SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS nulls, count(o_orderkey) AS non_nulls, count(DISTINCT o_orderkey) AS distinct_values,
        min(o_orderkey)::VARCHAR AS least, max(o_orderkey)::VARCHAR AS greatest FROM o
    UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey), count(o_custkey), count(DISTINCT o_custkey), min(o_custkey)::VARCHAR, max(o_custkey)::VARCHAR FROM o
    UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus), count(o_orderstatus), count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM o
    UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority), count(o_orderpriority), count(DISTINCT o_orderpriority), min(o_orderpriority), max(o_orderpriority) FROM o
""")
def column_profile(t):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return profile.column_profile(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", priority.alias("o_orderpriority")))


@query("l1_frequent_values", """
    WITH v AS (SELECT 'p_brand' AS "column", p_brand AS value, count(*) AS rows FROM part GROUP BY 2
               UNION ALL SELECT 'p_size', p_size::VARCHAR, count(*) FROM part GROUP BY 2)
    SELECT "column", value, rows, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, value) AS r FROM v) WHERE r <= 20
""")
def frequent_values(t):
    return profile.frequent_values(t.part, ["p_brand", "p_size"])


@query("l2_value_breakdown", """
    SELECT nullif(o_orderpriority, '5-LOW') AS value, count(*) AS rows FROM orders GROUP BY 1
""")
def value_breakdown(t):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    return profile.value_breakdown(t.orders.select(priority), "priority")


@query("l3_columns_with_data", """
    SELECT 'o_orderkey' AS "column", count(*) AS non_nulls FROM orders UNION ALL SELECT 'late', count(*) FROM orders WHERE o_orderdate > DATE '2001-01-01'
""")
def columns_with_data(t):
    late = F.when(F.to_date("o_orderdate") > F.lit("2001-01-01").cast("date"), 1)
    return profile.columns_with_data(t.orders.select("o_orderkey", late.alias("late"), F.lit(None).cast("int").alias("never")))


@query("l4_column_use_by_type", """
    SELECT o_orderstatus, 'o_orderkey' AS "column", count(*) AS non_nulls FROM orders GROUP BY 1
    UNION ALL SELECT o_orderstatus, 'partial', count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
""")
def column_use_by_type(t):
    partial = F.when(F.col("o_orderstatus") == "P", 1)
    return profile.column_use_by_type(t.orders.select("o_orderkey", "o_orderstatus", partial.alias("partial")), "o_orderstatus")


@query("l5_table_type_matrix", """
    SELECT 'lineitem' AS "table", 'l_orderkey' AS "column", o_orderstatus AS type, count(*) AS non_nulls FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 3
    UNION ALL SELECT 'lineitem', 'heavy', o_orderstatus, count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 49 GROUP BY 3
    UNION ALL SELECT 'events', 'event_id', o_orderstatus, count(*) FROM events JOIN orders ON event_id = o_orderkey GROUP BY 3
""")
def table_type_matrix(t):
    lines = t.lineitem.select("l_orderkey", F.when(F.col("l_quantity") > 49, 1).alias("heavy"))
    return profile.table_type_matrix(
        t.orders, "o_orderkey", "o_orderstatus", {"lineitem": (lines, "l_orderkey"), "events": (t.events.select("event_id"), "event_id")}
    )


@query("l6_numeric_share", """
    WITH v AS (SELECT DISTINCT event_type, CASE WHEN event_id % 4 = 0 THEN 'n/a ' || event_id % 8 ELSE value::VARCHAR END AS result FROM events)
    SELECT event_type, count(*) AS distinct_values, count(try_cast(result AS DOUBLE)) AS numeric_values FROM v GROUP BY 1
""")
def numeric_share(t):
    key = F.col("event_id")
    result = F.when(key % 4 == 0, F.concat(F.lit("n/a "), (key % 8).cast("string"))).otherwise(F.col("value").cast("string"))
    return profile.numeric_share(t.events.select("event_type", result.alias("result")), "event_type", "result")
