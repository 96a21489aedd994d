"""Projection, filters, joins, grouping, ranking and set operations (B to F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartlift.functions import clinical, dates
from chartlift.operators import aggregates, filters, joins
from chartlift.queries.registry import query
from chartlift.sources import readers

AS_OF = "2001-06-01"
ENROLMENTS_SQL = """
    enrolments AS (
        SELECT user_id, date_trunc('day', ts) AS started, max(ts) AS completed, min(props) AS place
        FROM events WHERE event_type = 'purchase' GROUP BY user_id, date_trunc('day', ts)
    )"""


def enrolments(t):
    """Stand-in enrolments: one per user and day with a purchase, from midnight to the day's last purchase."""
    purchases = t.events.filter("event_type = 'purchase'")
    return purchases.groupBy("user_id", F.date_trunc("day", "ts").alias("started")).agg(
        F.max("ts").alias("completed"), F.min("props").alias("place")
    )


def errors(t):
    return t.events.filter("event_type = 'error'").select("event_id", "user_id", "ts")


# ---- B projection and predicates


@query("b1_project_rename", "SELECT c_custkey AS person_id, c_name AS given_name, true AS preferred FROM customer")
def project_rename(t):
    return readers.rename_columns(
        t.customer, {"person_id": "c_custkey", "given_name": "c_name", "preferred": F.lit(True)}
    )


@query("b2_derive_column", """
    SELECT c_custkey, c_custkey + 100 AS user_id, c_acctbal < 0 AS retired,
        CASE WHEN c_acctbal < 0 THEN 1 END AS retired_by FROM customer
""")
def derive_column(t):
    overdrawn = F.col("c_acctbal") < 0
    return t.customer.select(
        "c_custkey", (F.col("c_custkey") + 100).alias("user_id"), overdrawn.alias("retired"),
        F.when(overdrawn, 1).alias("retired_by"),
    )


@query("b3_filter_eq_in", """
    SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority NOT IN ('5-LOW')
        AND nullif(o_orderpriority, '4-NOT SPECIFIED') IS NOT NULL
""")
def filter_eq_in(t):
    priority = filters.null_if_in("o_orderpriority", ["4-NOT SPECIFIED"])
    return t.orders.filter(
        F.col("o_orderstatus").isin("O", "P") & ~F.col("o_orderpriority").isin("5-LOW") & priority.isNotNull()
    ).select("o_orderkey")


@query("b4_filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%ring' OR p_brand LIKE 'Brand#1_'")
def filter_like(t):
    named = filters.like_any("p_name", ["red%", "%ring"])
    return t.part.filter(named | filters.like_any("p_brand", ["Brand#1_"])).select("p_partkey", "p_name")


@query("b5_filter_regexp", "SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]+[ \\t]*(mg|kg|%)')")
def filter_regexp(t):
    return t.documents.filter(filters.matches("text", "[0-9]+[[:blank:]]*(mg|kg|%)")).select("doc_id")


@query("b6_filter_range_dates", """
    SELECT o_orderkey FROM orders WHERE o_orderdate < DATE '1996-01-01' OR o_orderdate > DATE '2001-06-01'
""")
def filter_range_dates(t):
    odd = filters.implausible_date("o_orderdate", AS_OF, oldest="1996-01-01")
    return t.orders.filter(odd).select("o_orderkey")


@query("b7_case_map", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'died' WHEN 'O' THEN 'lost' ELSE 'unknown' END AS outcome FROM orders
""")
def case_map(t):
    return t.orders.select(
        "o_orderkey", filters.case_map("o_orderstatus", {"F": "died", "O": "lost"}, "unknown").alias("outcome")
    )


@query("b8_decode_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
        CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS returned FROM lineitem
""")
def decode_flag(t):
    flag = filters.case_map("l_returnflag", {"A": "t", "N": "f"}, "?")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", clinical.decode_flag(flag).cast("int").alias("returned")
    )


@query("b9_null_cleanup", """
    WITH s AS (SELECT c_custkey, nullif(nullif(c_nationkey, 0), 42) AS first_site,
        CASE WHEN c_nationkey % 3 <> 0 THEN nullif(c_nationkey % 10, 0) END AS second_site FROM customer)
    SELECT c_custkey, coalesce(first_site, second_site) AS first_site, coalesce(second_site, first_site) AS second_site FROM s
""")
def null_cleanup(t):
    sites = t.customer.select(
        "c_custkey", filters.null_if_in("c_nationkey", [0, 42]).alias("first_site"),
        F.when(F.col("c_nationkey") % 3 != 0, filters.null_if_in(F.col("c_nationkey") % 10, [0, 42])).alias("second_site"),
    )
    return filters.backfill_pair(sites, "first_site", "second_site")


@query("b10_default_unknown", """
    SELECT o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'UNKNOWN') AS priority FROM orders
""")
def default_unknown(t):
    priority = filters.null_if_in("o_orderpriority", ["4-NOT SPECIFIED"])
    return t.orders.select("o_orderkey", filters.default_unknown(priority).alias("priority"))


@query("b11_row_limit", "SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 1000")
def row_limit(t):
    return filters.row_limit(t.events, 1000, "ts", "event_id").select("event_id", "user_id")


# ---- C joins


@query("c1_join_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("c2_join_left", """
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
""")
def join_left(t):
    some = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(some, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query("c3_join_chain_multi", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, c_name, n_name, r_name, p_brand, s_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey AND p_size > 20 LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
""")
def join_chain_multi(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part.filter("p_size > 20"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(t.supplier.filter("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "c_name", "n_name", "r_name", "p_brand", "s_name")
    )


@query("c4_join_self_pairs", """
    WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus FROM orders)
    SELECT a.o_orderkey, a.o_custkey, a.month, a.o_orderstatus, count(*) AS partners,
        least(a.o_orderkey, min(b.o_orderkey)) AS lowest_id, greatest(a.o_orderkey, max(b.o_orderkey)) AS highest_id
    FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.month = b.month AND a.o_orderstatus = b.o_orderstatus
        AND a.o_orderkey <> b.o_orderkey
    GROUP BY a.o_orderkey, a.o_custkey, a.month, a.o_orderstatus
""")
def join_self_pairs(t):
    orders = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return joins.duplicate_groups(orders, ["o_custkey", "month", "o_orderstatus"], "o_orderkey")


@query("c5_semi_in", """
    SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def semi_in(t):
    poor = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(poor, "o_custkey", "left_semi").select("o_orderkey")


@query("c5_semi_exists", """
    SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49)
""")
def semi_exists(t):
    big = t.lineitem.filter("l_quantity > 49")
    return t.orders.join(big, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderkey")


@query("c6_anti_not_exists", """
    SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def anti_not_exists(t):
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


@query("c6_anti_left_null", """
    SELECT c_custkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' WHERE o_orderkey IS NULL
""")
def anti_left_null(t):
    some = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(some, "c_custkey", "left_anti").select("c_custkey")


@query("c7_anti_not_in", """
    SELECT c_custkey, 'some' AS list FROM customer WHERE nullif(c_custkey % 50, 0) NOT IN (SELECT s_nationkey FROM supplier)
    UNION ALL SELECT c_custkey, 'none' FROM customer WHERE nullif(c_custkey % 50, 0) NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey < 0)
""")
def anti_not_in(t):
    probes = t.customer.select("c_custkey", filters.null_if_in(F.col("c_custkey") % 50, [0]).alias("probe"))
    lists = {"some": t.supplier, "none": t.supplier.filter("s_nationkey < 0")}
    found = [joins.anti_not_in(probes, "probe", f, "s_nationkey").select("c_custkey", F.lit(n).alias("list")) for n, f in lists.items()]
    return found[0].unionByName(found[1])


@query("c8_join_null_safe", """
    WITH a AS (SELECT nullif(p_size, 50) AS size, p_brand, count(*) AS parts FROM part GROUP BY 1, 2),
         b AS (SELECT nullif(p_size, 50) AS size, p_brand, max(p_retailprice) AS top FROM part WHERE p_type = 'SMALL' GROUP BY 1, 2)
    SELECT a.size, a.p_brand, parts, top FROM a JOIN b ON a.size IS NOT DISTINCT FROM b.size AND a.p_brand IS NOT DISTINCT FROM b.p_brand
""")
def join_null_safe(t):
    part = t.part.withColumn("size", filters.null_if_in("p_size", [50]))
    left = part.groupBy("size", "p_brand").agg(F.count(F.lit(1)).alias("parts"))
    right = part.filter("p_type = 'SMALL'").groupBy("size", "p_brand").agg(F.max("p_retailprice").alias("top"))
    return joins.null_safe_join(left, right, ["size", "p_brand"])


@query("c9_join_full_outer", """
    WITH c AS (SELECT user_id, count(*) AS clicks FROM events WHERE event_type = 'click' AND value > 60 GROUP BY 1),
         v AS (SELECT user_id, count(*) AS views FROM events WHERE event_type = 'view' AND value > 60 GROUP BY 1)
    SELECT coalesce(c.user_id, v.user_id) AS user_id, clicks, views FROM c FULL JOIN v ON c.user_id = v.user_id
""")
def join_full_outer(t):
    some = t.events.filter("value > 60")
    clicks = some.filter("event_type = 'click'").groupBy("user_id").agg(F.count(F.lit(1)).alias("clicks"))
    views = some.filter("event_type = 'view'").groupBy("user_id").agg(F.count(F.lit(1)).alias("views"))
    return clicks.join(views, "user_id", "full")


@query("c10_join_interval", f"""
    WITH {ENROLMENTS_SQL}
    SELECT event_id, e.user_id, strftime(started, '%Y-%m-%d') AS started, place
    FROM events e JOIN enrolments p ON e.user_id = p.user_id AND ts >= started AND ts <= completed
    WHERE event_type = 'error'
""")
def join_interval(t):
    joined = joins.interval_join(errors(t), enrolments(t), "user_id", "ts", "started", "completed", bucket_days=1)
    return joined.select("event_id", "user_id", dates.day_text("started").alias("started"), "place")


@query("c11_asof_backward", f"""
    WITH {ENROLMENTS_SQL}
    SELECT event_id, e.user_id, arg_max(place, completed) AS place, strftime(max(completed), '%Y-%m-%d %H:%M:%S') AS completed
    FROM events e JOIN enrolments p ON e.user_id = p.user_id AND ts > completed
    WHERE event_type = 'error' GROUP BY event_id, e.user_id
""")
def asof_backward(t):
    matched = joins.asof_join(errors(t), enrolments(t), "user_id", "ts", "completed", ["place"], "backward")
    return matched.filter("matched_at IS NOT NULL").select(
        "event_id", "user_id", "place", F.date_format("matched_at", "yyyy-MM-dd HH:mm:ss").alias("completed")
    )


@query("c12_asof_forward", f"""
    WITH {ENROLMENTS_SQL}
    SELECT event_id, e.user_id, arg_min(place, started) AS place, strftime(min(started), '%Y-%m-%d %H:%M:%S') AS started
    FROM events e JOIN enrolments p ON e.user_id = p.user_id AND ts < started
    WHERE event_type = 'error' GROUP BY event_id, e.user_id
""")
def asof_forward(t):
    matched = joins.asof_join(errors(t), enrolments(t), "user_id", "ts", "started", ["place"], "forward")
    return matched.filter("matched_at IS NOT NULL").select(
        "event_id", "user_id", "place", F.date_format("matched_at", "yyyy-MM-dd HH:mm:ss").alias("started")
    )


@query("c13_join_update", """
    WITH src AS (SELECT l_orderkey, max(l_linestatus) AS status FROM lineitem WHERE l_quantity > 45 GROUP BY 1)
    SELECT o_orderkey, CASE WHEN l_orderkey IS NOT NULL THEN status ELSE o_orderstatus END AS o_orderstatus
    FROM orders LEFT JOIN src ON l_orderkey = o_orderkey
""")
def join_update(t):
    source = t.lineitem.filter("l_quantity > 45").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_linestatus").alias("o_orderstatus")
    )
    return joins.join_update(t.orders.select("o_orderkey", "o_orderstatus"), source, ["o_orderkey"], ["o_orderstatus"])


@query("c14_lookup_scalar", """
    SELECT c_custkey, (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey < 3) AS nation FROM customer
""")
def lookup_scalar(t):
    known = t.nation.filter("n_regionkey < 3")
    return joins.lookup(t.customer, known, "c_nationkey", "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@query("c15_join_day_match", """
    WITH p AS (SELECT user_id, ts::DATE AS day, count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT event_id, purchases FROM events e JOIN p ON e.user_id = p.user_id AND e.ts::DATE = p.day WHERE event_type = 'view'
""")
def join_day_match(t):
    days = t.events.withColumn("day", F.to_date("ts"))
    bought = days.filter("event_type = 'purchase'").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("purchases"))
    return days.filter("event_type = 'view'").join(bought, ["user_id", "day"]).select("event_id", "purchases")


@query("c16_join_pattern_map", """
    SELECT p_partkey, CASE WHEN p_name LIKE 'red%' THEN 'R' WHEN p_name LIKE '%ring' THEN 'O' WHEN p_name LIKE '%w_dget%' THEN 'W'
        ELSE 'other' END AS code FROM part
""")
def join_pattern_map(t):
    code = joins.pattern_map("p_name", [("red%", "R"), ("%ring", "O"), ("%w_dget%", "W")], "other")
    return t.part.select("p_partkey", code.alias("code"))


@query("c17_delete_anti", """
    SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)
""")
def delete_anti(t):
    candidates = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey")
    children = t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    doomed = candidates.join(children, "o_orderkey", "left_anti")
    return t.orders.select("o_orderkey").join(doomed, "o_orderkey", "left_anti")


# ---- D aggregation


@query("d1_agg_basic", """
    SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts,
        CAST(round(sum(CAST(value AS DECIMAL(18,4))), 2) AS DOUBLE) AS total
    FROM events GROUP BY user_id
""")
def agg_basic(t):
    second = "yyyy-MM-dd HH:mm:ss"
    return t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.date_format(F.min("ts"), second).alias("first_ts"),
        F.date_format(F.max("ts"), second).alias("last_ts"),
        F.round(F.sum(F.col("value").cast("decimal(18,4)")), 2).cast("double").alias("total"),
    )


@query("d2_count_distinct", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS kinds, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1")
def count_distinct(t):
    return t.orders.groupBy("o_custkey").agg(
        F.countDistinct("o_orderpriority").alias("kinds"), F.countDistinct("o_orderdate").alias("days")
    )


@query("d3_having_filter", """
    SELECT o_custkey, o_orderdate::DATE::VARCHAR AS day, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1
""")
def having_filter(t):
    return t.orders.groupBy("o_custkey", dates.day_text("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 1")


@query("d4_conditional_count", """
    SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 50) AS large,
        bool_or(event_type = 'signup') AS signed_up FROM events GROUP BY user_id
""")
def conditional_count(t):
    return t.events.groupBy("user_id").agg(
        aggregates.count_if(F.col("event_type") == "error").alias("errors"),
        aggregates.count_if(F.col("value") > 50).alias("large"),
        aggregates.any_true(F.col("event_type") == "signup").alias("signed_up"),
    )


@query("d5_pivot_flags", """
    SELECT user_id, ts::DATE::VARCHAR AS day, bool_or(event_type IN ('click', 'view')) AS browsing,
        bool_or(event_type = 'purchase') AS buying, bool_or(event_type = 'error') AS failing FROM events GROUP BY 1, 2
""")
def pivot_flags(t):
    days = t.events.withColumn("day", dates.day_text("ts"))
    return aggregates.pivot_flags(
        days, ["user_id", "day"], "event_type",
        {"browsing": ["click", "view"], "buying": ["purchase"], "failing": ["error"]},
    )


@query("d6_string_agg", """
    SELECT o_orderkey, string_agg(l_returnflag || l_linestatus, '; ' ORDER BY l_linenumber, l_returnflag || l_linestatus) AS marks
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def string_agg(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return aggregates.string_agg(
        lines, ["o_orderkey"], F.concat("l_returnflag", "l_linestatus"), "marks", "; ", order=["l_linenumber"]
    )


@query("d6_string_agg_distinct", """
    SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id
""")
def string_agg_distinct(t):
    return aggregates.string_agg(t.events, ["user_id"], "event_type", "kinds", distinct=True)


@query("d7_distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").dropDuplicates()


@query("d8_dedupe_merge", """
    SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_returnflag) AS l_returnflag, max(l_quantity) AS l_quantity
    FROM lineitem GROUP BY 1, 2
""")
def dedupe_merge(t):
    return aggregates.dedupe_merge(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_returnflag", "l_quantity"])


@query("d9_mode_value", """
    WITH n AS (SELECT user_id, ts::DATE::VARCHAR AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT user_id, day, event_type AS mode FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY n DESC, event_type DESC) AS r FROM n) WHERE r = 1
""")
def mode_value(t):
    days = t.events.withColumn("day", dates.day_text("ts"))
    return aggregates.mode_value(days, ["user_id", "day"], "event_type", "mode")


@query("d10_group_members_count", """
    SELECT o_orderkey, count(l_orderkey) AS members FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 30
    GROUP BY o_orderkey
""")
def group_members_count(t):
    return aggregates.member_counts(t.orders.select("o_orderkey"), t.lineitem.filter("l_quantity > 30"), "o_orderkey", "l_orderkey")


@query("d11_collect_nested", """
    SELECT o_custkey, o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_custkey) AS size FROM orders
""")
def collect_nested(t):
    nested = aggregates.collect_nested(
        t.orders, ["o_custkey"], ["o_orderkey", "o_orderstatus"], "orders"
    )
    return nested.select("o_custkey", F.explode("orders").alias("o"), F.size("orders").cast("long").alias("size")).select(
        "o_custkey", "o.o_orderkey", "o.o_orderstatus", "size"
    )


@query("d12_unique_map", "SELECT c_custkey, c_name FROM customer")
def unique_map(t):
    return aggregates.unique_map(t.customer, "c_custkey", "c_name")


@query("d12_map_violations", "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def map_violations(t):
    return aggregates.map_violations(t.orders, "o_custkey")


@query("d13_last_wins_map", """
    SELECT user_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS event_type FROM events GROUP BY user_id
""")
def last_wins_map(t):
    return aggregates.last_wins_map(t.events, ["user_id"], ["event_type"], ["ts", "event_id"])


# ---- E one row per group


@query("e1_latest_per_key", """
    SELECT o_custkey, o_orderkey FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1
""")
def latest_per_key(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return aggregates.latest_per_key(rows, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query("e2_earliest_before", """
    WITH a AS (SELECT user_id, min(ts) AS anchor FROM events WHERE event_type = 'signup' GROUP BY 1),
         f AS (SELECT user_id, min(ts) AS first FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT a.user_id, CASE WHEN first <= anchor THEN strftime(first, '%Y-%m-%d') END AS first_view FROM a LEFT JOIN f ON a.user_id = f.user_id
""")
def earliest_before(t):
    anchors = t.events.filter("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("anchor"))
    views = t.events.filter("event_type = 'view'")
    found = aggregates.earliest_on_or_before(anchors, views, "user_id", "anchor", "ts", "first_view")
    return found.select("user_id", dates.day_text("first_view").alias("first_view"))


@query("e3_priority_fallback", """
    WITH a AS (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS anchor, min(ts) FILTER (event_type = 'purchase') AS p,
        min(ts) FILTER (event_type = 'click') AS c, min(ts) FILTER (event_type = 'view') AS v FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN p <= anchor THEN 'purchase' WHEN c <= anchor THEN 'click' WHEN v <= anchor THEN 'view' END AS kind,
        strftime(CASE WHEN p <= anchor THEN p WHEN c <= anchor THEN c WHEN v <= anchor THEN v END, '%Y-%m-%d') AS day
    FROM a WHERE anchor IS NOT NULL
""")
def priority_fallback(t):
    kinds = ["purchase", "click", "view"]
    firsts = t.events.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("anchor"),
        *[F.min(F.when(F.col("event_type") == kind, F.col("ts"))).alias(kind) for kind in kinds],
    ).filter("anchor IS NOT NULL")
    ranked = F.coalesce(*[
        F.when(F.col(kind) <= F.col("anchor"), F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("at"))) for kind in kinds
    ])
    return firsts.select("user_id", ranked["kind"].alias("kind"), dates.day_text(ranked["at"]).alias("day"))


@query("e4_first_row_per_group", """
    SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1
""")
def first_row_per_group(t):
    return aggregates.pick_per_key(t.orders, ["o_custkey"], ["o_orderkey", "o_orderpriority"], ["o_orderkey"])


@query("e5_nearest_member", """
    SELECT user_id, arg_max(props, struct_pack(a := ts, b := event_id)) AS props, strftime(max(ts), '%Y-%m-%d') AS day
    FROM events WHERE event_type = 'purchase' GROUP BY user_id
""")
def nearest_member(t):
    bought = t.events.filter("event_type = 'purchase'")
    picked = aggregates.pick_per_key(bought, ["user_id"], ["props", "ts"], ["ts", "event_id"], last=True)
    return picked.select("user_id", "props", dates.day_text("ts").alias("day"))


@query("e6_top_n_values", """
    SELECT p_brand AS value, count(*) AS rows FROM part GROUP BY 1 ORDER BY rows DESC, value LIMIT 20
""")
def top_n_values(t):
    return aggregates.top_values(t.part, "p_brand", 20)


# ---- F sort, limit, sets


@query("f1_sort_multi", """
    SELECT o_orderkey, o_orderstatus, o_orderdate::DATE::VARCHAR AS day FROM orders
    ORDER BY o_custkey, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END DESC, o_orderdate DESC, o_orderkey
""")
def sort_multi(t):
    current = F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    ordered = t.orders.orderBy("o_custkey", current.desc(), F.desc("o_orderdate"), "o_orderkey")
    return ordered.select("o_orderkey", "o_orderstatus", dates.day_text("o_orderdate").alias("day"))


@query("f2_top_1", """
    SELECT o_custkey, arg_max(o_orderkey, struct_pack(a := o_totalprice, b := o_orderkey)) AS o_orderkey FROM orders GROUP BY 1
""")
def top_1(t):
    return aggregates.pick_per_key(t.orders, ["o_custkey"], ["o_orderkey"], ["o_totalprice", "o_orderkey"], last=True)


@query("f3_union_distinct", "SELECT p_name AS name FROM part UNION SELECT p_brand FROM part UNION SELECT p_type FROM part")
def union_distinct(t):
    columns = F.explode(F.array("p_name", "p_brand", "p_type"))
    return t.part.select(columns.alias("name")).distinct()


@query("f4_union_all", """
    SELECT c_nationkey AS nation, 'customer' AS role FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier
""")
def union_all(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("role"))
    return customers.unionByName(t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("role")))


@query("f5_set_difference_both", """
    WITH a AS (SELECT DISTINCT user_id AS id FROM events WHERE event_type = 'signup' AND value > 60),
         b AS (SELECT DISTINCT user_id AS id FROM events WHERE event_type = 'error' AND value > 60)
    SELECT id, 'left_only' AS side FROM a WHERE id NOT IN (SELECT id FROM b)
    UNION ALL SELECT id, 'right_only' FROM b WHERE id NOT IN (SELECT id FROM a)
""")
def set_difference_both(t):
    some = t.events.filter("value > 60").withColumnRenamed("user_id", "id")
    return aggregates.set_difference_both(some.filter("event_type = 'signup'"), some.filter("event_type = 'error'"), "id")
