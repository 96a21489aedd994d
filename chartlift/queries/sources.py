"""Sources and sinks (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.queries.registry import query
from chartlift.runtime import scratch_path
from chartlift.sources import readers, writers

# Stand-in code table for the priorities of the given orders.
PRIORITY_CODES = [("1-URGENT", "stat", 1), ("2-HIGH", "soon", 2), ("3-MEDIUM", "routine", 3), ("5-LOW", "later", 5)]


@query("a2_extract", """
    SELECT o_orderkey AS source_encounter_id, o_custkey AS source_patient_id, c_mktsegment AS segment
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 250000
""")
def extract(t):
    return readers.extract(
        t.spark,
        """SELECT o_orderkey AS source_encounter_id, o_custkey AS source_patient_id, c_mktsegment AS segment
           FROM {orders}, {customer} WHERE o_custkey = c_custkey AND o_totalprice > 250000""",
        {"orders": t.orders, "customer": t.customer},
    )


@query("a2_extract_row_limit", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 500
""")
def extract_limited(t):
    return readers.extract(
        t.spark, "SELECT o_orderkey, o_custkey FROM {orders} WHERE o_orderstatus = 'P'", {"orders": t.orders},
        row_limit=500, order_by=["o_orderkey"],
    )


@query("a3_stage_table", """
    SELECT o_custkey AS source_patient_id, o_orderkey AS source_encounter_id, CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR AS total
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
""")
def stage_table(t):
    source = t.orders.select(
        F.col("o_custkey").alias("PATIENT_ID"), F.col("o_orderkey").alias("ENCOUNTER_ID"), F.col("o_totalprice").alias("TOTAL")
    )
    scope = t.customer.filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("source_patient_id"))
    staged = readers.stage_table(source, scope, types={"TOTAL": "decimal(18,2)"})
    return staged.withColumn("total", F.col("total").cast("string"))


@query("a3_stage_by_encounter", """
    SELECT l_orderkey AS source_encounter_id, l_partkey AS partkey, l_linenumber AS line
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
""")
def stage_by_encounter(t):
    source = t.lineitem.select(
        F.col("l_orderkey").alias("ENCOUNTER_ID"), F.col("l_partkey").alias("PARTKEY"), F.col("l_linenumber").alias("LINE")
    )
    scope = t.customer.filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("source_patient_id"))
    encounters = t.orders.select(
        F.col("o_custkey").alias("source_patient_id"), F.col("o_orderkey").alias("source_encounter_id")
    )
    return readers.stage_table(source, scope, encounters)


@query("a4_load_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def load_csv(t):
    path = scratch_path(t.spark, "part-csv")
    t.part.select("p_partkey", "p_name", "p_size", "p_retailprice").write.csv(path)
    return readers.load_csv(t.spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("a5_write_csv", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered FROM orders
""")
def write_csv(t):
    path = scratch_path(t.spark, "orders-csv")
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").alias("ordered"), "o_orderstatus")
    writers.write_csv(rows.filter("o_orderstatus = 'O'").drop("o_orderstatus"), path, "overwrite")
    writers.write_csv(rows.filter("o_orderstatus <> 'O'").drop("o_orderstatus"), path, "append")
    return t.spark.read.schema("o_orderkey bigint, ordered string").option("header", True).csv(path)


@query("a7_export_json", """
    SELECT c_custkey, json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_mktsegment', c_mktsegment)::VARCHAR AS json
    FROM customer
""")
def export_json(t):
    return writers.export_json(t.customer.select("c_custkey", "c_name", "c_mktsegment"), keep=("c_custkey",))


@query("a8_inline_mapping", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'stat' WHEN '2-HIGH' THEN 'soon'
        WHEN '3-MEDIUM' THEN 'routine' WHEN '5-LOW' THEN 'later' END AS code FROM orders
""")
def inline_mapping(t):
    codes = readers.inline_mapping(t.spark, PRIORITY_CODES, "o_orderpriority string, code string, rank int")
    return t.orders.join(codes, "o_orderpriority", "left").select("o_orderkey", "code")


@query("a9_source_view", """
    SELECT c_custkey AS source_user_id, lower(c_mktsegment) || '@n' || c_nationkey AS email, n_name AS first_name,
        c_name AS last_name, CASE WHEN c_acctbal < 0 THEN 'banned' ELSE 'approved' END AS member_state
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 9000
""")
def source_view(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    users = people.select(F.col("c_custkey").alias("user_id"), F.lit("x").alias("password"), F.lit("y").alias("salt"))
    parties = people.select(
        F.col("c_custkey").alias("party_id"), F.concat(F.lower("c_mktsegment"), F.lit("@n"), "c_nationkey").alias("email")
    )
    persons = people.select(
        F.col("c_custkey").alias("person_id"), F.col("n_name").alias("first_names"), F.col("c_name").alias("last_name")
    )
    relations = people.select(
        (F.col("c_custkey") + 7).alias("rel_id"), F.col("c_custkey").alias("object_id_two"),
        F.lit("membership_rel").alias("rel_type"),
    )
    state = F.when(F.col("c_acctbal") < 0, "banned").when(F.col("c_acctbal") < 9000, "approved")
    memberships = people.select((F.col("c_custkey") + 7).alias("rel_id"), state.alias("member_state"))
    view = readers.user_view(users, parties, persons, relations, memberships)
    return view.drop("password", "salt")


@query("a10_overwrite_stage", """
    SELECT o_orderkey, 'first' AS run FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'second' FROM orders WHERE o_orderstatus = 'O'
""")
def overwrite_stage(t):
    path = scratch_path(t.spark, "stage")
    for status, run in (("F", "first"), ("O", "second"), ("P", "first")):
        writers.overwrite_stage(t.orders.filter(F.col("o_orderstatus") == status).select("o_orderkey"), path, run)
    return t.spark.read.parquet(path).select("o_orderkey", "run")


@query("a10_revert_run", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def revert_run(t):
    return writers.revert_run(t.orders.select("o_orderkey"), t.orders.filter("o_orderstatus = 'F'"), "o_orderkey")
