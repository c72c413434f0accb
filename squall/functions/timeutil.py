"""Time expressions: epochs, local time to UTC with exact DST rules, calendar fields.

All functions return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen. A UTC session time zone is assumed
(``squall.session.ensure_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall.functions.classify import first_match

# Fixed values (must equal the reference's): the local zone of the incident
# source, and the first local day ingest falls back to when nothing is stored.
LOCAL_TZ = "America/Toronto"
PROJECT_BASELINE = "2024-01-01"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_instant(ms) -> Column:
    """Epoch milliseconds to an instant; 0 and NULL mean 'no date' (X16)."""
    ms = _c(ms)
    return F.when(ms.isNull() | (ms == 0), F.lit(None).cast("timestamp")) \
            .otherwise(F.timestamp_millis(ms))


def epoch_ms_to_seconds(ms) -> Column:
    """Integer division by 1000, truncating toward zero."""
    return F.call_function("div", _c(ms), F.lit(1000))


def epoch_seconds_to_utc_wallclock(sec) -> Column:
    """``to_timestamp(sec) AT TIME ZONE 'UTC'``: a zone-less UTC wall clock."""
    return F.timestamp_seconds(_c(sec)).cast("timestamp_ntz")


def local_wallclock_to_utc(local_ts, tz: str = LOCAL_TZ) -> Column:
    """Local wall-clock time (a ``timestamp`` holding local fields) to the UTC instant.

    Ambiguous hours (the repeated hour when clocks fall back) resolve to
    *standard* time, the later of the two instants; skipped hours move forward
    by the gap. ``to_utc_timestamp`` alone picks the earlier instant for
    ambiguous hours, so one hour is added whenever that still names the same
    local wall clock (X17).
    """
    local_ts = _c(local_ts)
    earlier = F.to_utc_timestamp(local_ts, tz)
    later = earlier + F.make_dt_interval(F.lit(0), F.lit(1))
    return F.when(F.from_utc_timestamp(later, tz) == local_ts, later).otherwise(earlier)


def local_date_hour_to_utc(date, hour, tz: str = LOCAL_TZ) -> Column:
    """A local calendar date and an hour of that day to the UTC instant."""
    local_ts = _c(date).cast("timestamp") + F.make_dt_interval(F.lit(0), _c(hour).cast("int"))
    return local_wallclock_to_utc(local_ts, tz)


def with_incident_occurrence_utc(df, occ_ms: str, occ_hour: str, out: str = "occ_date_utc",
                                 tz: str = LOCAL_TZ, strict: bool = True,
                                 hour_text: str | None = None):
    """Add the UTC instant of an incident from OCC_DATE (epoch ms) and OCC_HOUR (Q2-Q4, Q23).

    No date gives NULL. Without an hour the raw instant is kept. With an hour,
    the local day of the instant at that hour is converted back to UTC. In
    strict mode an hour outside 0-23 (or, when ``hour_text`` is given, a
    present hour that is not an integer) fails the job, as the reference's
    ``int()`` / ``time(h, 0)`` do; lenient mode yields NULL for it.

    Built in steps of plain columns so that each sub-expression is evaluated
    once per row (a nested expression would repeat the JSON reads).
    """
    t = "__occ_instant"
    h = "__occ_hour"
    lt = "__occ_local"
    e = "__occ_earlier"
    hour = F.col(occ_hour)
    if strict and hour_text is not None:
        hour = F.when(F.col(hour_text).isNotNull() & hour.isNull() & F.col(occ_ms).isNotNull()
                      & (F.col(occ_ms) != 0),
                      F.raise_error(F.concat(F.lit("OCC_HOUR is not an integer: "),
                                             F.col(hour_text))).cast("int")).otherwise(hour)
    df = df.withColumns({t: epoch_ms_to_instant(occ_ms), h: hour})
    df = df.withColumn(lt, F.date_trunc("day", F.from_utc_timestamp(F.col(t), tz))
                       + F.make_dt_interval(F.lit(0), F.col(h)))
    df = df.withColumn(e, F.to_utc_timestamp(F.col(lt), tz))
    later = F.col(e) + F.make_dt_interval(F.lit(0), F.lit(1))
    converted = F.when(F.from_utc_timestamp(later, tz) == F.col(lt), later).otherwise(F.col(e))
    bad = (F.raise_error(F.concat(F.lit("OCC_HOUR out of range 0-23: "), F.col(h).cast("string")))
           .cast("timestamp") if strict else F.lit(None).cast("timestamp"))
    value = (F.when(F.col(t).isNull(), F.lit(None).cast("timestamp"))
              .when(F.col(h).isNull(), F.col(t))
              .when(F.col(h).between(0, 23), converted)
              .otherwise(bad))
    return df.withColumn(out, value).drop(t, h, lt, e)


def utc_date(ts) -> Column:
    """``DATE(timestamptz)`` in a UTC session."""
    return F.to_date(_c(ts))


def day_start(ts) -> Column:
    """``date_trunc('day', ts)`` keeping a zone-less timestamp."""
    return F.date_trunc("day", _c(ts)).cast("timestamp_ntz")


def is_weekend(ts) -> Column:
    """ISO day of week 6 or 7; NULL dates are not weekends."""
    return F.coalesce(F.weekday(_c(ts)) >= 5, F.lit(False))


# Season by calendar month; anything else (NULL too) is 'Fall'.
SEASON_MONTHS = [
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
]
SEASON_ELSE = "Fall"


def season(ts) -> Column:
    """Season from the calendar month (X11)."""
    m = F.month(_c(ts))
    return first_match([(m.isin(*months), name) for name, months in SEASON_MONTHS], SEASON_ELSE)


def next_local_day(max_instant, tz: str = LOCAL_TZ) -> Column:
    """Local day after the high-water mark."""
    return F.date_add(F.to_date(F.from_utc_timestamp(_c(max_instant), tz)), 1)


def quarter_end(d) -> Column:
    """Last day of the calendar quarter of ``d``."""
    return F.last_day(F.add_months(F.trunc(_c(d), "quarter"), 2))


def ymd(d) -> Column:
    """``YYYY-MM-DD`` text of a date."""
    return F.date_format(_c(d), "yyyy-MM-dd")
