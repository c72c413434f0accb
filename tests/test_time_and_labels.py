from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from squall.functions import classify, geo, timeutil as tu
from squall.functions import urls


def _one(spark, expr, ddl=None):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_dst_ambiguous_hour_picks_standard_time(spark):
    # local 2024-11-03 01:00 Toronto happens twice; standard time -> 06:00 UTC
    v = _one(spark, tu.local_date_hour_to_utc(F.lit("2024-11-03").cast("date"), F.lit(1)))
    assert v == datetime(2024, 11, 3, 6, 0)


def test_dst_skipped_hour_moves_forward(spark):
    v = _one(spark, tu.local_date_hour_to_utc(F.lit("2024-03-10").cast("date"), F.lit(2)))
    assert v == datetime(2024, 3, 10, 7, 0)


def test_plain_hours(spark):
    assert _one(spark, tu.local_date_hour_to_utc(F.lit("2024-01-01").cast("date"), F.lit(9))) \
        == datetime(2024, 1, 1, 14, 0)
    assert _one(spark, tu.local_date_hour_to_utc(F.lit("2024-07-01").cast("date"), F.lit(9))) \
        == datetime(2024, 7, 1, 13, 0)


def _occ(spark, ms, hour, strict=True):
    df = spark.createDataFrame([(ms, hour)], "ms bigint, h int")
    return tu.with_incident_occurrence_utc(df, "ms", "h", strict=strict).first()["occ_date_utc"]


def test_epoch_zero_or_null_is_no_date(spark):
    assert _occ(spark, 0, 9) is None
    assert _occ(spark, None, 9) is None


def test_missing_hour_keeps_raw_instant(spark):
    assert _occ(spark, 1704085200000, None) == datetime(2024, 1, 1, 5, 0)


def test_reference_fixture_hours(spark):
    assert [_occ(spark, 1704085200000, h) for h in (9, 12, 17)] == [
        datetime(2024, 1, 1, 14), datetime(2024, 1, 1, 17), datetime(2024, 1, 1, 22)]


def test_hour_out_of_range_strict_fails_lenient_null(spark):
    with pytest.raises(Exception):
        _occ(spark, 1704085200000, 24)
    assert _occ(spark, 1704085200000, 24, strict=False) is None


def test_integer_division_truncates(spark):
    assert _one(spark, tu.epoch_ms_to_seconds(F.lit(-1500))) == -1
    assert _one(spark, tu.epoch_ms_to_seconds(F.lit(1704085200999))) == 1704085200


def test_quarter_end_and_next_local_day(spark):
    assert _one(spark, tu.quarter_end(F.lit("2024-01-01").cast("date"))) == date(2024, 3, 31)
    assert _one(spark, tu.quarter_end(F.lit("2024-11-15").cast("date"))) == date(2024, 12, 31)
    # 2024-01-02 03:00 UTC is still 2024-01-01 in Toronto
    v = _one(spark, tu.next_local_day(F.lit("2024-01-02 03:00:00").cast("timestamp")))
    assert v == date(2024, 1, 2)


def test_calendar_fields(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 6, 15),), (datetime(2024, 4, 1),), (None,)],
                               "t timestamp_ntz")
    rows = df.select(tu.is_weekend("t").alias("w"), tu.season("t").alias("s"),
                     tu.day_start("t").alias("d")).collect()
    assert [(r.w, r.s) for r in rows] == [(True, "Winter"), (False, "Spring"), (False, "Fall")]
    assert rows[0].d == datetime(2024, 1, 6)


def test_rounding_ties_half_away_from_zero(spark):
    assert float(_one(spark, geo.grid_round(F.lit("43.655")))) == 43.66
    assert float(_one(spark, geo.grid_round(F.lit("-79.385")))) == -79.39
    assert float(_one(spark, geo.grid_round(F.lit("43.605")))) == 43.61


def test_invalid_flag_bounds(spark):
    df = spark.createDataFrame(
        [("40", "-80"), ("45", "-78"), ("39.999999", "-79"), ("45.000001", "-79"), (None, "-79")],
        "lat string, lon string").select(F.col("lat").cast("decimal(9,6)").alias("lat"),
                                         F.col("lon").cast("decimal(9,6)").alias("lon"))
    got = [r.f for r in df.select(geo.invalid_coordinate("lat", "lon").alias("f")).collect()]
    assert got == [False, False, True, True, True]


def test_null_pair_rule(spark):
    df = spark.createDataFrame([(0.0, 0.0), (43.6, None), (43.6, -79.4), (0.0, -79.4)], "a double, b double")
    lat, lon = geo.null_unusable_pair("a", "b")
    got = [(r.x, r.y) for r in df.select(lat.alias("x"), lon.alias("y")).collect()]
    assert got == [(None, None), (None, None), (43.6, -79.4), (0.0, -79.4)]


def test_labels(spark):
    df = spark.createDataFrame([(None,), (24,), (3,), (12,), (18,)], "h int")
    assert [r.d for r in df.select(classify.daypart("h").alias("d")).collect()] == [
        "Evening", "Evening", "Night", "Afternoon", "Evening"]
    w = spark.createDataFrame([(None,), (79,), (77,), (1,)], "c int")
    assert [r.c for r in w.select(classify.weather_condition("c").alias("c")).collect()] == [
        "Other", "Other", "Snow", "Cloudy"]
    y = spark.createDataFrame([("YES",), ("NO",), ("yes",), (None,)], "t string")
    assert [r.b for r in y.select(classify.yes_no("t").alias("b")).collect()] == [True, False, None, None]


def test_severity_null_falls_through(spark):
    df = spark.createDataFrame([(0, None, True, True), (1, None, None, None), (0, None, None, None)],
                               "f int, i boolean, t boolean, p boolean")
    rows = df.select(classify.collision_severity("f", "i", "t", "p").alias("s"),
                     classify.collision_severity_rank("f", "i", "t", "p").alias("r")).collect()
    assert [(r.s, r.r) for r in rows] == [("Fail to Remain", 3), ("Fatality", 1), ("Unknown", 5)]


def test_incident_url_matches_rfc3986_encoding(spark):
    from urllib.parse import quote, urlencode
    where = ("OCC_DATE >= TIMESTAMP '2024-01-01 00:00:00' "
             "AND OCC_DATE < TIMESTAMP '2024-01-02 00:00:00'")
    params = {"where": where, "outFields": "*", "f": "json", "resultRecordCount": 1000,
              "resultOffset": 0}
    expected = f"{urls.INCIDENT_BASE_URL}?{urlencode(params, quote_via=quote)}"
    assert _one(spark, urls.incident_url(F.lit("2024-01-01").cast("date"))) == expected


def test_weather_url(spark):
    v = _one(spark, urls.weather_url(F.lit("43.60").cast("decimal(6,2)"), F.lit("-79.56"),
                                     F.lit("2024-01-01").cast("date"), F.lit("2024-01-02").cast("date")))
    assert v.startswith(urls.WEATHER_BASE_URL + "?latitude=43.6&longitude=-79.56&start_date=2024-01-01"
                        "&end_date=2024-01-02&hourly=temperature_2m,")
    assert v.endswith("&timezone=UTC")


def _standard_time_model(local):
    """Local wall clock -> UTC: the unique offset, or standard time when the wall
    clock is repeated or skipped (the rule the reference's localize applies)."""
    from datetime import timezone
    from zoneinfo import ZoneInfo
    tz = ZoneInfo(tu.LOCAL_TZ)
    a = local.replace(tzinfo=tz, fold=0)
    b = local.replace(tzinfo=tz, fold=1)
    if a.utcoffset() == b.utcoffset():
        return a.astimezone(timezone.utc).replace(tzinfo=None)
    standard = min(a.utcoffset(), b.utcoffset())  # west of UTC: standard is the smaller offset
    return local - standard


def test_every_local_hour_of_two_years_matches_standard_time_rule(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-01-01', DATE'2024-12-31')) AS d")
    hours = days.select("d", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    got = hours.select("d", "h", tu.local_date_hour_to_utc("d", "h").alias("u")).collect()
    assert len(got) == 731 * 24
    bad = [(r.d, r.h, r.u) for r in got
           if r.u != _standard_time_model(datetime(r.d.year, r.d.month, r.d.day, r.h))]
    assert not bad, bad[:5]
