"""Request text for the two upstream sources, as columns of a plan table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall.functions import timeutil as tu

# Upstream endpoints and request parameters.
INCIDENT_BASE_URL = (
    "https://services.arcgis.com/S9th0jAJ7bqgIRjw/ArcGIS/rest/services/"
    "Traffic_Collisions_Open_Data/FeatureServer/0/query"
)
INCIDENT_PAGE_SIZE = 1000
WEATHER_BASE_URL = "https://archive-api.open-meteo.com/v1/archive"
WEATHER_HOURLY_VARS = ("temperature_2m,precipitation,snowfall,weathercode,"
                       "windspeed_10m,cloudcover,relative_humidity_2m")
WEATHER_TIMEZONE = "UTC"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def percent_encode(text) -> Column:
    """RFC 3986 encoding (space -> %20, only ``A-Za-z0-9_.-~`` kept).

    ``url_encode`` is form encoding, so three characters differ.
    """
    enc = F.url_encode(_c(text))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    return F.replace(enc, F.lit("%7E"), F.lit("~"))


def incident_where(local_day) -> Column:
    """Half-open local-day predicate sent to the source (F1)."""
    d = _c(local_day)
    return F.format_string(
        "OCC_DATE >= TIMESTAMP '%s 00:00:00' AND OCC_DATE < TIMESTAMP '%s 00:00:00'",
        tu.ymd(d), tu.ymd(F.date_add(d, 1)))


def incident_url(local_day, offset=0) -> Column:
    """Request URL for one local day of incidents, one page."""
    return F.concat(
        F.lit(INCIDENT_BASE_URL + "?where="), percent_encode(incident_where(local_day)),
        F.lit(f"&outFields=%2A&f=json&resultRecordCount={INCIDENT_PAGE_SIZE}&resultOffset="),
        _c(offset).cast("string") if not isinstance(offset, int) else F.lit(str(offset)))


def coordinate_text(x) -> Column:
    """Shortest decimal text of a rounded coordinate, as a float prints (43.6, -79.56)."""
    return _c(x).cast("double").cast("string")


def weather_url(lat, lon, start_date, end_date) -> Column:
    """Request URL for hourly weather at one grid point over a date range."""
    return F.concat(
        F.lit(WEATHER_BASE_URL + "?latitude="), coordinate_text(lat),
        F.lit("&longitude="), coordinate_text(lon),
        F.lit("&start_date="), tu.ymd(start_date),
        F.lit("&end_date="), tu.ymd(end_date),
        F.lit(f"&hourly={WEATHER_HOURLY_VARS}&timezone={WEATHER_TIMEZONE}"))
