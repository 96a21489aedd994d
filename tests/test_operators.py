"""Operators against brute force and on null and tie rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartlift.operators import aggregates, eav, filters, joins, keys, quality
from chartlift.sources import readers, writers


def test_asof_join_against_brute_force(spark):
    draw = random.Random(7)
    origin = datetime(2020, 1, 1)
    events = [(i, draw.choice([1, 2, None]), origin + timedelta(hours=draw.randrange(0, 4000))) for i in range(300)] + [(999, 1, None)]
    states = [(draw.choice([1, 2]), origin + timedelta(hours=draw.randrange(500, 3500)), draw.randrange(9)) for _ in range(60)]
    frame = spark.createDataFrame(events, "id int, k int, t timestamp")
    other = spark.createDataFrame(states, "k int, s timestamp, place int")
    for direction in ("backward", "forward"):
        found = {r.id: r.place for r in joins.asof_join(frame, other, "k", "t", "s", ["place"], direction).collect()}
        assert len(found) == len(events)
        for i, k, t in events:
            near = [(s, p) for key, s, p in states if t is not None and key == k and ((s < t) if direction == "backward" else (s > t))]
            if not near:
                assert found[i] is None
                continue
            at = (max if direction == "backward" else min)(s for s, _ in near)
            assert found[i] == min(p for s, p in near if s == at)


def test_interval_join_bounds(spark):
    day = datetime(2020, 1, 1)
    events = spark.createDataFrame([(i, 1, day + timedelta(days=i)) for i in (0, 5, 9, 10, 11, 400)], "id int, k int, t timestamp")
    spans = spark.createDataFrame([(1, day + timedelta(days=5), day + timedelta(days=10), "a"), (1, day + timedelta(days=11), None, "b")],
                                  "k int, s timestamp, e timestamp, place string")
    found = sorted((r.id, r.place) for r in joins.interval_join(events, spans, "k", "t", "s", "e", bucket_days=3).collect())
    assert found == [(5, "a"), (9, "a"), (10, "a"), (11, "b"), (400, "b")]


def test_not_in_null_rules(spark, rows):
    probes = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    clean = spark.createDataFrame([(2,)], "y int")
    poisoned = spark.createDataFrame([(2,), (None,)], "y int")
    empty = clean.filter("y > 5")
    assert rows(joins.anti_not_in(probes, "x", clean, "y")) == [(1,)]
    assert rows(joins.anti_not_in(probes, "x", poisoned, "y")) == []
    assert rows(joins.anti_not_in(probes, "x", empty, "y")) == [(1,), (2,), (None,)]


def test_null_safe_join_and_update(spark, rows):
    left = spark.createDataFrame([(None, 1), (3, 2)], "k int, a int")
    right = spark.createDataFrame([(None, 10)], "k int, b int")
    assert rows(joins.null_safe_join(left, right, ["k"])) == [(None, 1, 10)]
    source = spark.createDataFrame([(3, None)], "k int, a int")
    assert rows(joins.join_update(left, source, ["k"], ["a"])) == [(3, None), (None, 1)]
    assert rows(joins.join_update(left, source, ["k"], ["a"], only_null=True)) == [(3, 2), (None, 1)]


def test_string_agg(spark, rows):
    frame = spark.createDataFrame([("k", "b", 2), ("k", "a", 2), ("k", "b", 1), ("k", None, 0), ("n", None, 1), (None, "z", 1)], "k string, v string, o int")
    assert rows(aggregates.string_agg(frame, ["k"], "v", "s", "; ", order=["o"])) == [("k", "b; a; b"), ("n", None), (None, "z")]
    assert rows(aggregates.string_agg(frame, ["k"], "v", "s", distinct=True)) == [("k", "a, b"), ("n", None), (None, "z")]


def test_mode_value_ties(spark, rows):
    frame = spark.createDataFrame([("k", 1), ("k", 2), ("k", None)], "k string, v int")
    assert rows(aggregates.mode_value(frame, ["k"], "v", "m")) == [("k", 2)]


def test_child_rows_of_a_hot_key_are_the_folded_list(spark):
    frame = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), (F.col("id") % 50).alias("v")).repartition(8)
    folded = aggregates.collect_nested(frame, ["k"], ["v"], "vs").select("k", F.posexplode("vs").alias("position", "c"))
    expected = sorted((r.k, r.position + 1, r.c.v) for r in folded.collect())
    found = aggregates.child_rows(frame, ["k"], ["v"])
    assert sorted((r.k, r.position, r.child.v) for r in found.collect()) == expected
    assert aggregates.collect_nested(frame, ["k"], ["v"], "vs").count() == frame.select("k").distinct().count()


def test_unique_map(spark, rows):
    good = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert rows(aggregates.unique_map(good, "k", "v")) == [(1, "a"), (2, None)]
    bad = good.union(good.limit(1))
    assert rows(aggregates.map_violations(bad, "k")) == [(1, 2)]
    with pytest.raises(PySparkException):
        aggregates.unique_map(bad, "k", "v").collect()


def test_latest_keeps_ties(spark, rows):
    frame = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "k int, d int, v string")
    assert rows(aggregates.latest_per_key(frame, ["k"], "d"), "v") == [("a",), ("b",), ("d",)]


def test_set_difference(spark, rows):
    left, right = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(2,), (3,)], "x int")
    assert rows(aggregates.set_difference_both(left, right, "x")) == [(1, "left_only"), (3, "right_only")]


def test_assign_ids_is_dense_and_ordered(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(13)
    numbered = keys.assign_ids(frame, ["x"], "n", 100)
    assert numbered.filter("n <> x + 100").count() == 0 and numbered.count() == 5000


def test_reserve_ranges_do_not_overlap(spark):
    starts = keys.reserve_id_ranges({"a": spark.range(5), "b": spark.range(0), "c": spark.range(2)}, 10)
    assert starts == {"a": 10, "b": 15, "c": 15}


def test_pair_with_pool_stops_at_the_pool(spark, rows):
    people, pool = spark.createDataFrame([(i,) for i in (30, 10, 20)], "p int"), spark.createDataFrame([("x",), ("w",)], "z string")
    assert rows(keys.pair_with_pool(people, pool, ["p"], ["z"])) == [(10, "w"), (20, "x")]


def test_emit_links_children_to_parents(spark):
    frame = spark.createDataFrame([(1, 5.0, None), (2, None, None)], "id int, n double, t string")
    group = eav.Group("G", [eav.numeric("N", "n"), eav.text("T", "t")], any_child=True)
    drafts = eav.emit_obs_group(frame, "job", ["id"], "id", group).collect()
    assert [(d.obs_key, d.group_key, d.concept) for d in drafts] == [("job/1/0", None, "G"), ("job/1/0/0", "job/1/0", "N")]


def test_resolve_obs_drops_orphans_and_defaults(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    drafts = eav.emit_obs(frame, "job", ["id"], "id", [eav.text("C", "t")])
    visits = spark.createDataFrame([(1, 11, 7, date(2020, 1, 2), None, date(2020, 1, 3))],
                                   "source_encounter_id long, encounter_id long, patient_id long, encounter_datetime date, location_id int, date_created date")
    concepts = spark.createDataFrame([("C", 5)], "ref string, concept_id int")
    [row] = eav.resolve_obs(drafts, visits, concepts).collect()
    assert (row.encounter_id, row.person_id, row.location_id, row.concept_id, row.value_text, row.obs_datetime) == (11, 7, 1, 5, "x", datetime(2020, 1, 2))


def test_rules_and_matches(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    found = rows(quality.check_rules(frame, {"x": F.col("x").isNull()}, {"y": F.col("y").isNotNull()}))
    assert found == [("x", 0, 1, False), ("y", 2, 2, True)]
    assert rows(quality.assert_match(frame, frame)) == []
    assert rows(quality.assert_match(frame, frame.limit(1).union(frame.limit(1)))) == [(1, "a", -1, "right"), (None, "b", 1, "left")]


def test_posix_patterns():
    assert filters.posix_to_java("^[[:blank:]]*[0-9]") == "^[ \\t]*[0-9]"


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "t")
    assert plain["dbtable"] == "t" and "numPartitions" not in plain
    split = readers.jdbc_options("jdbc:x", "t", "id", 0, 100, 16)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "16"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")
    assert writers.jdbc_write_options("jdbc:x", "t", writers=4)["numPartitions"] == "4"


def test_extract_needs_an_order_for_a_limit(spark):
    with pytest.raises(ValueError):
        readers.extract(spark, "SELECT * FROM {t}", {"t": spark.range(5)}, row_limit=2)


def test_endless_intervals_take_the_buckets_of_the_events(spark):
    moment = "timestamp'2020-01-05 00:00:00'"
    events = spark.sql(f"SELECT 1 AS id, 1 AS k, {moment} AS t UNION ALL SELECT 2, 1, {moment} + INTERVAL 40 DAYS")
    states = spark.sql("SELECT 1 AS k, timestamp'0001-01-01 00:00:00' AS a, timestamp'9999-12-31 00:00:00' AS b, 7 AS v UNION ALL SELECT 1, timestamp'2020-02-01 00:00:00', NULL, 8")
    found = joins.interval_join(events, states, "k", "t", "a", "b")
    assert sorted((r.id, r.v) for r in found.select("id", "v").collect()) == [(1, 7), (2, 7), (2, 8)]


def test_a_hot_key_is_many_even_segments(spark):
    """A key with most of the rows, all of them within one day, spreads over the parts of the scan."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("k"),
        (F.lit("2020-01-01").cast("timestamp").cast("long") * 1_000_000 + F.col("id") * 1000).alias("_t"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("found"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would be one part
    try:
        sequence = joins.segmented(rows.repartition(8), "k", "_t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in sequence.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert sequence.where("k = 1").select("_part").distinct().count() >= len(sizes) - 2
    found = {(r.k, r._t): r.last for r in joins.last_before(sequence, "k", ["_t"], "found", "last").collect()}
    last, expected = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.k, r._t)):
        if r.found is not None:
            last[r.k] = r.found
        expected[r.k, r._t] = last.get(r.k)
    assert found == expected


def test_pool_shortage_shows_and_raises(spark):
    people, pool = spark.createDataFrame([(i,) for i in range(4)], "id int"), spark.createDataFrame([("x",), ("y",)], "value string")
    made = keys.allocate_from_pool(people, pool, ["id"], ["value"])
    assert sorted((r.allocation, r.id, r.value) for r in made.collect()) == [
        ("assigned", 0, "x"), ("assigned", 1, "y"), ("unassigned", 2, None), ("unassigned", 3, None)]
    turned = keys.allocate_from_pool(pool, people, ["value"], ["id"])
    assert sorted((r.allocation, r.id) for r in turned.collect()) == [("assigned", 0), ("assigned", 1), ("unused", 2), ("unused", 3)]
    assert keys.pair_with_pool(pool, people, ["value"], ["id"], "raise").count() == 2
    with pytest.raises(PySparkException, match="no member"):
        keys.pair_with_pool(people, pool, ["id"], ["value"], "raise").collect()
    assert keys.allocate_from_pool(people.limit(0), pool.limit(0), ["id"], ["value"]).count() == 0
