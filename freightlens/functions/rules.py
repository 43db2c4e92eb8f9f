"""Business rules that several layers share: bands, flags, text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightlens.functions.measures import as_col

# Band edges and labels as published.
KM_BUCKETS = ((5, "0-5 km"), (10, "5-10 km"), (20, "10-20 km"), (50, "20-50 km"), (None, "50+ km"))
KM_REACH = ((5, "Short"), (15, "Medium"), (30, "Long"), (None, "Very Long"))
KM_REACH_LONG = tuple((e, f"{label} Distance") for e, label in KM_REACH)
KM_FACT_BANDS = ((5, "<5 km"), (10, "5-10 km"), (25, "10-25 km"), (None, "25+ km"))
KM_CUT = ((5, "Short"), (15, "Medium"), (30, "Long"), (50, "Very Long"), (None, "Extreme"))
VALUE_CUT = ((500, "Very Low"), (1000, "Low"), (2500, "Medium"), (5000, "High"), (None, "Very High"))
DELAY_CUT = (
    (0, "On Time"),
    (10, "Minor Delay"),
    (30, "Moderate Delay"),
    (60, "Severe Delay"),
    (None, "Critical Delay"),
)
SCORE_CUT_20 = ((20, "Low"), (50, "Moderate"), (75, "High"), (None, "Critical"))
SCORE_CUT_25 = ((25, "Low"), (50, "Moderate"), (75, "High"), (None, "Critical"))
EXPERIENCE_BANDS = ((2, "0-2 Years"), (5, "2-5 Years"), (10, "5-10 Years"), (None, "10+ Years"))
DONE_STATUSES = ("delivered", "completed")
LOW_SIGNAL_LABELS = ("LOW", "POOR")
JAM_LEVELS = ("HIGH", "SEVERE")
ACTIVE_STATUSES = ("ASSIGNED", "PICKED_UP", "IN_TRANSIT", "OUT_FOR_DELIVERY")
VALID_STATUSES = (
    "delivered",
    "completed",
    "pending",
    "in_transit",
    "cancelled",
    "failed",
    "returned",
    "out_for_delivery",
)


def _banded(c, bands, inside, null_label: bool) -> Column:
    c = as_col(c)
    out = None
    for edge, label in bands:
        if edge is None:
            return out.otherwise(label) if null_label else out.when(c.isNotNull(), label)
        test = inside(c, edge)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def below(c, bands) -> Column:
    """Left-closed bands (value < edge); NULL falls into the last band, as in a SQL CASE."""
    return _banded(c, bands, lambda x, e: x < e, True)


def upto(c, bands) -> Column:
    """Right-closed bands (value <= edge); NULL stays NULL, as in a histogram cut."""
    return _banded(c, bands, lambda x, e: x <= e, False)


def at_least(c, bands, rest: str) -> Column:
    """First label whose threshold the value reaches."""
    c = as_col(c)
    out = F.when(c >= bands[0][0], bands[0][1])
    for edge, label in bands[1:]:
        out = out.when(c >= edge, label)
    return out.otherwise(rest)


def flag(cond: Column) -> Column:
    """1 where cond holds; 0 where it is false or unknown."""
    return F.when(cond, 1).otherwise(0)


def upper_text(c) -> Column:
    return F.upper(F.trim(as_col(c)))


def lower_text(c) -> Column:
    return F.lower(F.trim(as_col(c)))


def is_blank(c) -> Column:
    c = as_col(c)
    return c.isNull() | (F.trim(c) == "")


def bad_coordinates(lat="latitude", lon="longitude") -> Column:
    lat, lon = as_col(lat), as_col(lon)
    return lat.isNull() | lon.isNull() | ~lat.between(-90, 90) | ~lon.between(-180, 180)


def low_signal(c="signal_quality") -> Column:
    """Weak signal: a category LOW or POOR, or a numeric quality below 50."""
    c = upper_text(c)
    return c.isin(*LOW_SIGNAL_LABELS) | (c.try_cast("double") < 50)


def positive_delay(actual="actual_delivery_time_min", promised="promised_delivery_time_min") -> Column:
    """Minutes late, 0 when early, on time or unknown."""
    a, p = as_col(actual), as_col(promised)
    return F.when(a > p, a - p).otherwise(0)


def epoch(c) -> Column:
    """Whole seconds of a wall-clock timestamp."""
    return as_col(c).cast("timestamp").cast("long")
