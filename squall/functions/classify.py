"""Labels: YES/NO flags, collision severity, weather condition, daypart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_match(cases, otherwise) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE otherwise END``; a NULL
    condition is not true, so it falls through to the next case."""
    expr = None
    for cond, value in cases:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(otherwise)


def yes_no(x) -> Column:
    """Exact, case-sensitive 'YES' -> true, 'NO' -> false, else NULL."""
    x = _c(x)
    return F.when(x == "YES", True).when(x == "NO", False).otherwise(F.lit(None).cast("boolean"))


# Severity levels in priority order, with their sort rank.
SEVERITY_LEVELS = [
    ("Fatality", 1),
    ("Injury", 2),
    ("Fail to Remain", 3),
    ("Property Damage", 4),
]
SEVERITY_ELSE = ("Unknown", 5)


def _severity_conditions(fatalities, injury, ftr, pd) -> list[Column]:
    # NULL flags are "not true" and fall through to the next level (Q22).
    return [_c(fatalities) > 0, _c(injury), _c(ftr), _c(pd)]


def collision_severity(fatalities, injury, ftr, pd) -> Column:
    """Severity label, worst first."""
    conds = _severity_conditions(fatalities, injury, ftr, pd)
    return first_match([(c, label) for c, (label, _) in zip(conds, SEVERITY_LEVELS)], SEVERITY_ELSE[0])


def collision_severity_rank(fatalities, injury, ftr, pd) -> Column:
    """Rank 1 (worst) .. 5 (least) for sorting (O3)."""
    conds = _severity_conditions(fatalities, injury, ftr, pd)
    return first_match([(c, rank) for c, (_, rank) in zip(conds, SEVERITY_LEVELS)], SEVERITY_ELSE[1])


# Weather-code buckets (WMO codes) and the fallback label.
WEATHER_BUCKETS = [
    ("Clear", (0,)),
    ("Cloudy", (1, 2, 3)),
    ("Fog", (45, 48)),
    ("Rain/Drizzle", (51, 53, 55, 56, 57)),
    ("Rain", (61, 63, 65, 66, 67)),
    ("Snow", (71, 73, 75, 77, 85, 86)),
    ("Rain showers", (80, 81, 82)),
    ("Thunderstorm", (95, 96, 99)),
]
WEATHER_ELSE = "Other"


def weather_condition(code) -> Column:
    """Bucket a weather code; unknown or NULL codes are 'Other' (X12, Q10)."""
    code = _c(code)
    return first_match([(code.isin(*codes), label) for label, codes in WEATHER_BUCKETS], WEATHER_ELSE)


# Daypart by hour, inclusive bounds; anything else is 'Evening'.
DAYPARTS = [
    ("Night", 0, 5),
    ("Morning", 6, 11),
    ("Afternoon", 12, 17),
]
DAYPART_ELSE = "Evening"


def daypart(hour) -> Column:
    """Time-of-day bucket; NULL or out-of-range hours are 'Evening' (X13, Q11)."""
    hour = _c(hour)
    return first_match([(hour.between(lo, hi), label) for label, lo, hi in DAYPARTS], DAYPART_ELSE)
