"""Numbers of observations and their groups at the sink."""

from chartlift.operators import eav


def test_numbers_continue_and_a_second_run_keeps_them(spark, rows):
    obs = spark.createDataFrame([("a", None, "ua"), ("b", "a", "ub"), ("c", "a", "uc"), ("d", "gone", "ud"), ("e", None, "ue")], "obs_key string, group_key string, uuid string")
    target = spark.createDataFrame([(7, "ue"), (9, "other")], "obs_id int, uuid string")
    first = eav.number_obs(obs, target)
    expected = [("a", 10, None), ("b", 11, 10), ("c", 12, 10), ("d", 13, None), ("e", 7, None)]
    assert rows(first, "obs_key", "obs_id", "obs_group_id") == expected
    loaded = target.unionByName(first.selectExpr("int(obs_id) AS obs_id", "uuid").filter("uuid <> 'ue'"))
    assert rows(eav.number_obs(obs, loaded), "obs_key", "obs_id", "obs_group_id") == expected


def test_rows_are_matched_with_the_loaded_ones_once(spark, rows):
    """After the numbers are written down, neither side of the parents' join looks the uuids up again."""
    obs = spark.createDataFrame([("a", None, "ua"), ("a", None, "ua"), ("b", "a", None), ("c", "e", "uc"), (None, None, "ud"), ("e", None, "ue")],
                                "obs_key string, group_key string, uuid string")
    target = spark.createDataFrame([(7, "ue"), (8, "ue"), (None, "uc")], "obs_id int, uuid string")
    made = eav.number_obs(obs, target)
    assert made._jdf.queryExecution().analyzed().toString().count("Join LeftOuter") == 1  # of children to their parents
    # a repeated key, a repeated number of a loaded row, a null key, uuid and number
    assert rows(made, "obs_key", "obs_id", "obs_group_id") == sorted(
        [(None, 9, None), ("a", 10, None), ("a", 11, None), ("b", 12, 10), ("b", 12, 11), ("c", 13, 7), ("c", 13, 8), ("e", 7, None), ("e", 8, None)], key=repr)


def test_nothing_loaded_and_nothing_to_load(spark, rows):
    obs = spark.createDataFrame([("b", "a", "ub"), ("a", None, "ua")], "obs_key string, group_key string, uuid string")
    nothing = spark.createDataFrame([], "obs_id long, uuid string")
    assert rows(eav.number_obs(obs, nothing), "obs_key", "obs_id", "obs_group_id") == [("a", 1, None), ("b", 2, 1)]
    assert eav.number_obs(obs.limit(0), nothing).collect() == []
