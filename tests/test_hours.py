"""Working-hours relations: pivot, slot maps, priority resolution."""

from pyspark.sql import functions as F

from parley.operators import hours as H
from parley.plans import config, report

US = 10**6


def test_pivot_takes_max_start_and_end_independently(spark):
    wh = spark.createDataFrame(
        [("u", "0", 2, 9 * 3600 * US, 17 * 3600 * US), ("u", "0", 2, 8 * 3600 * US, 18 * 3600 * US),
         ("u", "0", 1, 10 * 3600 * US, 12 * 3600 * US)],
        "user_id string, org_id string, day_of_week int, start_us long, end_us long",
    )
    row = H.pivot_week(wh).first()
    assert (row.monday_start, row.monday_end) == (9 * 3600 * US, 18 * 3600 * US)
    assert (row.sunday_start, row.sunday_end) == (10 * 3600 * US, 12 * 3600 * US)
    assert row.tuesday_start is None
    slots = H.weekly_hours_map(wh).first().slots
    assert slots[2] == (9 * 3600 * US, 18 * 3600 * US)


def test_slot_map_lowest_start_and_presence(spark):
    flat = spark.createDataFrame(
        [("1", "0", "monday", "10:00:00", "19:00:00"), ("1", "0", "monday", "07:00:00", "12:00:00"),
         ("1", "0", "Fri day", "09:00:00", "10:00:00"), ("2", "0", "monday,tuesday", "09:00:00", "10:00:00")],
        "user_id string, org_id string, week_day string, start_time string, end_time string",
    )
    maps = {r.user_id: r for r in H.weekly_slot_map(flat).collect()}
    assert maps["1"].hours == {1: (7 * 3600 * 1000, 12 * 3600 * 1000)}
    # an unsplit SET value matches no weekday, but the user is still configured
    assert maps["2"].hours == {}
    assert maps["2"].next_offset == [None] * 7


def _mapping(spark):
    return spark.createDataFrame(
        [(1, 0, 5, 0), (2, 1, 5, 0), (3, 4, 0, 0), (4, 4, 9, 0), (4, 3, 0, 1)],
        "user_id long, team_id long, org_id long, row_order int",
    )


def _config(spark):
    return spark.createDataFrame(
        [("self", 1, "monday,tuesday", "08:00:00", "16:00:00", 0),
         ("team", 1, "Friday", "09:00:00", "17:00:00", 60),
         ("team", 2, "monday", "09:00:00", "17:00:00", 60),
         ("org", 0, "sunday", "06:00:00", "20:00:00", -120)],
        "type string, type_id long, week_day string, start_time string, end_time string, timezone_offset int",
    )


def test_priority_resolution(spark):
    out = config.user_working_hours(_mapping(spark), _config(spark))
    src = {r.user_id: r.source for r in out.select("user_id", "source").distinct().collect()}
    # user 1: self; user 2: team 1; user 3: org 0; user 4: first mapping row (org 9) -> default
    assert src == {1: "self", 2: "team", 3: "org", 4: "default"}
    assert out.where("user_id = 4").count() == 7
    flat = config.user_working_hours_flat(_mapping(spark), _config(spark))
    days = sorted(r.week_day for r in flat.where("user_id = '1'").collect())
    assert days == ["monday", "tuesday"]
    assert [r.week_day for r in flat.where("user_id = '2'").collect()] == ["friday"]


def test_single_user_lookup_matches_team_on_user_id(spark):
    requests = spark.createDataFrame([("2", "7"), ("3", "0"), ("9", "9")], "user_id string, org_id string")
    out = config.working_hours_for(_config(spark), requests)
    src = {r.user_id: (r.source, r.timezone_offset) for r in out.collect()}
    # user 2 has team row type_id = 2 (the user id), user 3 falls to org 0
    assert src["2"] == ("team", 60)
    assert src["3"] == ("org", -120)
    assert src["9"] == ("default", None)
    raw_day = [r.week_day for r in out.where("user_id = '2'").collect()]
    assert raw_day == ["monday"]


def test_distribution_maps(spark):
    msgs = spark.createDataFrame(
        [("u", "2024-01-01", "INCOMING"), ("u", "2024-01-01", "OUTGOING"), ("u", "2024-01-02", "SYSTEM")],
        "user_id string, date string, direction string",
    ).withColumn("date", F.to_date("date"))
    row = report.distribution_maps(report.message_distribution(msgs)).first()
    assert row.date_distribution == {"2024-01-01": 2, "2024-01-02": 1}
    assert row.direction_distribution == {"INCOMING": 1, "OUTGOING": 1, "SYSTEM": 1}


def test_first_mapping_without_read_order(spark):
    mapping = spark.createDataFrame([(7, 3, 2), (7, 1, 5), (8, 0, 0)], "user_id long, team_id long, org_id long")
    got = {r.user_id: (r.team_id, r.org_id) for r in H.first_mapping_per_user(mapping).collect()}
    assert got == {7: (3, 2), 8: (0, 0)}


def test_configured_user_count(spark):
    assert config.configured_user_count(_mapping(spark), _config(spark)).first()["count"] == 4
