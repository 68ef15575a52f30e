"""Sessions, schedules and views against the known answers of the demo day."""

from samples import (ADS, MORNING_CHANNELS, MORNING_SESSIONS, SESSIONS, VIEWS, actions, ads, at,
                     channels, locations, morning_ads, rows, sessions, users)

from airtally.operators import enrich, schedule
from airtally.operators.sessions import device_sessions

VIEW = ["program_id", "program", "channel_id", "channel", "user_id", "device_id", "start_ts", "end_ts"]


def timed(data):
    return sorted(((*r[:-2], at(r[-2]), at(r[-1])) for r in data), key=repr)


def test_device_sessions(spark):
    assert rows(device_sessions(actions(spark))) == timed(SESSIONS)


def test_shows_of_the_night(spark):
    got = rows(schedule.shows_of(channels(spark)), "channel_id", "program_id", "start_ts", "end_ts")
    assert got == timed([
        (57, 12, "2021-02-01 23:55:00", "2021-02-01 23:57:00"),
        (57, 13, "2021-02-01 23:57:00", "2021-02-01 23:58:00"),
        (57, 14, "2021-02-01 23:58:00", "2021-02-02 00:00:00"),
        (57, 15, "2021-02-02 00:00:00", "2021-02-02 00:01:00"),
        (57, 16, "2021-02-02 00:01:00", "2021-02-02 00:04:00"),
        (57, 17, "2021-02-02 00:04:00", "2021-02-03 00:00:00"),
        (58, 12, "2021-02-01 23:55:00", "2021-02-01 23:56:30"),
        (58, 13, "2021-02-01 23:56:30", "2021-02-01 23:58:00"),
        (58, 14, "2021-02-01 23:58:00", "2021-02-02 00:00:00"),
        (58, 15, "2021-02-02 00:00:00", "2021-02-03 00:00:00")])


def test_last_show_of_a_day_ends_at_midnight(spark):
    got = rows(schedule.shows_of(channels(spark, MORNING_CHANNELS)), "channel_id", "program_id", "end_ts")
    assert got == sorted([
        (57, 12, at("2021-02-01 07:45:00")), (57, 13, at("2021-02-02 00:00:00")),
        (57, 14, at("2021-02-02 08:30:00")), (57, 15, at("2021-02-03 00:00:00")),
        (58, 12, at("2021-02-01 07:30:00")), (58, 13, at("2021-02-01 09:10:00")),
        (58, 14, at("2021-02-02 00:00:00"))], key=repr)


def test_show_views(spark):
    shows = schedule.shows_of(channels(spark))
    for method in ("cells", "plain"):
        assert rows(enrich.show_views(sessions(spark), shows, method), *VIEW) == timed(VIEWS)


def test_morning_show_views(spark):
    shows = schedule.shows_of(channels(spark, MORNING_CHANNELS))
    got = rows(enrich.show_views(sessions(spark, MORNING_SESSIONS), shows),
               "program", "user_id", "device_id", "start_ts", "end_ts")
    assert got == timed([
        ("Living Planet", 46, 17, "2021-02-01 09:20:16", "2021-02-01 09:36:56"),
        ("Dune", 46, 17, "2021-02-01 09:10:00", "2021-02-01 09:20:16"),
        ("Wonder Woman", 46, 17, "2021-02-01 08:32:51", "2021-02-01 09:10:00"),
        ("Wonder Woman", 46, 16, "2021-02-01 07:30:00", "2021-02-01 09:05:17"),
        ("Westworld", 46, 16, "2021-02-01 07:00:35", "2021-02-01 07:30:00"),
        ("Living Planet", 45, 14, "2021-02-01 07:45:00", "2021-02-01 08:19:35"),
        ("Animal Planet", 45, 14, "2021-02-01 07:12:35", "2021-02-01 07:45:00"),
        ("Blue Kingdom", 45, 15, "2021-02-02 07:19:35", "2021-02-02 07:57:35")])


def test_ads_end_after_their_duration(spark):
    assert {(r.ad_id, r.start_ts, (r.end_ts - r.start_ts).seconds) for r in ads(spark).collect()} \
        == {(a, at(s), d) for a, _, s, d in ADS}


AD_VIEWS = [
    (17, 57, 45, 15, "2021-02-02 00:02:17", "2021-02-02 00:02:26"),
    (16, 57, 45, 15, "2021-02-02 00:01:31", "2021-02-02 00:01:39"),
    (17, 57, 46, 17, "2021-02-02 00:02:17", "2021-02-02 00:02:26")]


def test_ad_views(spark):
    assert rows(enrich.ad_views(ads(spark), sessions(spark))) == timed(AD_VIEWS)


def test_morning_ad_views_with_unseen_ad(spark):
    seen = [(17, 57, 45, 14, "2021-02-01 07:16:24", "2021-02-01 07:43:51"),
            (17, 57, 45, 15, "2021-02-02 07:22:27", "2021-02-02 07:24:38"),
            (13, 58, 46, 17, "2021-02-01 08:32:51", "2021-02-01 08:43:18"),
            (14, 58, 46, 17, "2021-02-01 09:07:03", "2021-02-01 09:20:16"),
            (13, 58, 46, 16, "2021-02-01 08:19:26", "2021-02-01 08:43:18")]
    unseen = (18, 57, None, None, "2021-02-02 08:47:06", "2021-02-02 08:55:36")
    watched = sessions(spark, MORNING_SESSIONS)
    assert rows(enrich.ad_views(morning_ads(spark), watched)) == timed(seen)
    for method in ("cells", "plain"):
        got = enrich.ad_views(morning_ads(spark), watched, "left_outer", method)
        assert rows(got) == timed([*seen, unseen])


def test_demographics_drop_unknown_users(spark):
    views = enrich.ad_views(ads(spark), sessions(spark))
    got = rows(enrich.with_demographics(views, users(spark)), "ad_id", "user_id", "name", "age", "gender")
    assert got == [(16, 45, "u45", 55, "M"), (17, 45, "u45", 55, "M"), (17, 46, "u46", 18, "M")]
    assert rows(enrich.with_demographics(views, users(spark).filter("user_id != 46")), "user_id") \
        == [(45,), (45,)]


def test_full_show_pipeline(spark):
    shows = schedule.shows_of(channels(spark))
    got = enrich.show_watch_full(sessions(spark), shows, users(spark), locations(spark))
    matched = rows(got.filter("kdts IS NOT NULL"), "program", "user_id", "device_id", "kdts")
    assert matched == sorted([
        ("Westworld", 46, 16, at("2021-02-01 23:56:02")),
        ("Wonder Woman", 46, 16, at("2021-02-01 23:57:03")),
        ("Dune", 46, 16, at("2021-02-01 23:58:04")),
        ("Wild China", 45, 15, at("2021-02-02 00:02:08")),
        ("Avengers", 46, 17, at("2021-02-02 00:01:07")),
        ("Wild China", 46, 17, at("2021-02-02 00:02:08")),
        ("Wild China", 46, 17, at("2021-02-02 00:03:09")),
        ("Living Planet", 45, 14, at("2021-02-01 23:57:03")),
        ("Planet Earth", 45, 14, at("2021-02-01 23:58:04")),
        ("Planet Earth", 45, 14, at("2021-02-01 23:59:05"))], key=repr)
    lonely = rows(got.filter("kdts IS NULL"), "program", "device_id", "view_device_id", "lon")
    assert lonely == [("Animal Planet", None, 14, None), ("Wild Africa", None, 17, None)]


def test_ad_pipeline_demands_containment(spark):
    got = enrich.ad_view_full(ads(spark), sessions(spark), users(spark), locations(spark))
    assert got.count() == 3 and got.filter("kdts IS NOT NULL").count() == 0


def test_average_location(spark):
    shows = schedule.shows_of(channels(spark))
    located = enrich.with_locations(enrich.show_views(sessions(spark), shows), locations(spark))
    got = enrich.average_location(located, ["program", "view_device_id"])
    assert {r.program: r.points for r in got.filter("view_device_id = 14").collect()} \
        == {"Animal Planet": 0, "Living Planet": 1, "Planet Earth": 2}
